"""Filter interaction audit: what each quality filter removes, in every order of five filters.

Conditions A to D are columns of a document. E, a text that a smaller identifier has as well, is an
existential self-join: rows whose text hash occurs more than once are left-semi-joined on hash, exact
text and a smaller identifier. Which of many smaller ones it is does not matter, so the other side holds
each distinct text once with its smallest identifier, combined before the shuffle: copies meet one row,
never one another, and texts whose hash is their own are gone before texts are compared. The identifiers
that E marks are united with those of the other failures, the bits of a row are or-ed, and rows are
counted per part and combination of bits (at most 32, times two label flags). All orders follow from these
counts: what a filter removes depends only on the set of filters before it, so 80 (filter, set) pairs serve
the 600 (order, step) rows of a part.

Defined results: a null text is empty (it fails A, and E if a smaller identifier has an empty text too);
null and empty sources are the part named by the empty string; a row without identifier is smaller than
none and never fails E; rows that repeat an identifier are documents of their own and do not fail E
through one another; of several label rows of a document any counts; labels without document count
nowhere, documents without labels are neither good nor toxic; an empty table has no parts, so no rows;
texts of any length are used whole; extra columns are not read.
"""

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stage

FILTERS = "ABCDE"
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITAL_PERCENT, SYMBOLS = 200, 50, 2, "[#$%&*|]"
_SPACES = "[\\x20\\x09-\\x0D]+"
_ROW = ("doc_id", "hash", "size", "part")


def failure_bits(text: Column) -> Column:
    """Bits of the conditions A to D for one text."""
    words = F.filter(F.split(text, _SPACES, -1), lambda w: w != "")
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))

    def bits(w: Column) -> Column:
        n = F.size(w)
        tests = {
            "A": n < LEAST_WORDS,
            "B": 100 * F.size(F.array_distinct(w)) < LEAST_DISTINCT_PERCENT * n,
            "C": 100 * capitals > MOST_CAPITAL_PERCENT * F.char_length(text),
            "D": text.rlike(SYMBOLS),
        }
        total = F.lit(0)
        for name, failed in tests.items():
            total = total + F.when(failed, BIT[name]).otherwise(0)
        return total

    # the words are needed twice: bound to a variable, they are cut once
    return F.element_at(F.transform(F.array(words), bits), 1)


def repeated(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows whose text a smaller identifier has too: left-semi self-join; ``docs`` has the texts of ``rows``."""
    shared = stage(
        rows.groupBy("hash", "size").agg(F.count("*").alias("n")).where("n > 1").select("hash", "size"), "audit-shared"
    )
    copies = stage(docs.join(shared, ["hash", "size"], "left_semi"), "audit-copies")
    # of all copies only the smallest identifier matters as a witness: combined map-side, one row a text;
    # stored, so that the join is dealt out anew and a hot text's copies can be split over tasks
    first = stage(
        copies.groupBy(F.col("hash").alias("h"), F.col("text").alias("t")).agg(F.min("doc_id").alias("low")), "audit-first"
    )
    witness = (F.col("hash") == F.col("h")) & (F.col("text") == F.col("t")) & (F.col("low") < F.col("doc_id"))
    return copies.join(first, witness, "left_semi").select(*_ROW)


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per ``part``, failure ``bits``, ``good`` and ``toxic``: ``n``."""
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumns({"hash": F.xxhash64("text"), "size": F.octet_length("text")})
    rows = stage(base.select(*_ROW, failure_bits(F.col("text")).alias("bits")), "audit-rows")
    marks = repeated(base, rows).select(*_ROW, F.lit(BIT["E"]).alias("bits"), F.lit(0).alias("n"))
    # rows that agree in identifier, text and part fail alike
    found = rows.withColumn("n", F.lit(1)).unionByName(marks).groupBy(*_ROW).agg(
        F.bit_or("bits").alias("bits"), F.sum("n").alias("n")
    )
    flags = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    ).where("doc_id is not null")
    return found.join(flags, "doc_id", "left").groupBy(
        "part", "bits", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    ).agg(F.sum("n").alias("n"))


def orders() -> list[tuple]:
    """(order, step, filter bit, bits of the filters before it) of all orders."""
    out = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            out.append(("".join(order), step, BIT[name], before))
            before |= BIT[name]
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step."""
    counts = stage(combinations(docs, labels), "audit-counts")
    steps = orders()
    weight: dict[tuple, int] = {}
    for _, _, own, before in steps:
        weight[own, before] = weight.get((own, before), 0) + 1
    pairs = ", ".join(
        f"named_struct('own', {own}, 'before', {before}, 'orders', {n})" for (own, before), n in sorted(weight.items())
    )
    fails = F.col("bits").bitwiseAND(F.col("own")) != 0
    came = F.col("bits").bitwiseAND(F.col("before")) == 0

    def total(when: Column) -> Column:
        return F.sum(F.when(when, F.col("n")).otherwise(0))

    removed = fails & came
    sets = counts.select("*", F.expr(f"inline(array({pairs}))")).groupBy("part", "own", "before", "orders").agg(
        total(~fails & came).alias("kept"),
        total(removed).alias("removed"),
        total(fails & ~came).alias("redundant"),
        total(F.col("bits") == F.col("own")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
    )
    sets = stage(sets, "audit-sets")
    share = sets.groupBy("part", "own").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    # 600 rows whatever the table: safe to broadcast
    order = docs.sparkSession.sql(
        f"select * from values {', '.join(map(str, steps))} as t(filter_order, step, own, before)"
    )
    return sets.join(share, ["part", "own"]).join(F.broadcast(order), ["own", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )

"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

A text is cut into paragraphs: lines, longer lines at the first sentence end after ``PIECE`` code
points. A paragraph's key is 48 bits of its hash and 16 check bits. A sketch has three blocks of
``BLOCK`` cells; a key is counted and xor-ed into one cell of each. Two versions' sketches are
subtracted cell by cell, and peeling takes single keys out until nothing is left, which recovers the
digests that only one version has. If peeling stops early, the sketch is retried larger: the keys are
dealt to ever more sub-sketches by another hash, and pairs that still fail are compared by their
digests. The likeness is the Jaccard similarity of the two paragraph sets that the sketches give.

All of this happens inside a row. Keys are dealt to sub-sketches over two levels, so that very long
texts cost about the power 1.5 of their paragraphs.

Defined results: a null text is empty; an empty text has no paragraph and a sketch of empty cells; two
texts without paragraphs are alike (1); repeated paragraphs count once; equal texts have equal
fingerprints; rows are ordered by identifier (null last) and text hash, a lone row is its own next
document; an empty table gives an empty table; extra columns are not read.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import stage

PIECE = 128
BLOCK = 10
#: Keys that a sub-sketch of a larger retry holds on average.
LOAD = 8
#: Rows for each range partition of the document order.
RANGE_ROWS = 200_000

_PARAGRAPH = rf"[^\n]{{1,{PIECE}}}[^\n.!?]*[.!?\n]*|\n+"
_CELLS = 3 * BLOCK


def _cell(key: str, block: str) -> str:
    return f"pmod(shiftrightunsigned({key}, cast(16 + 10 * {block} as int)) & 1023L, {BLOCK})"


def paragraph_keys(text: Column) -> Column:
    """The distinct paragraph keys of a text."""
    units = F.filter(F.regexp_extract_all(text, F.lit(_PARAGRAPH), F.lit(0)), lambda p: p != "")
    high = F.transform(units, lambda p: F.xxhash64(p).bitwiseAND(F.lit(-65536)))
    return F.array_distinct(
        F.transform(high, lambda h: h.bitwiseOR(F.xxhash64(h).bitwiseAND(F.lit(65535))))
    )


def cells_sql(keys: str) -> str:
    """SQL: the cells (count, xor) of a sketch."""
    here = f"filter({keys}, k -> {_cell('k', '(c div ' + str(BLOCK) + ')')} = c % {BLOCK})"
    return (
        f"transform(sequence(0, {_CELLS - 1}), c -> aggregate({here}, named_struct('n', 0, 'x', 0L),"
        " (s, k) -> named_struct('n', s.n + 1, 'x', s.x ^ k)))"
    )


def minus_sql(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (u, v) -> named_struct('n', u.n - v.n, 'x', u.x ^ v.x))"


def peeled_sql(cells: str) -> str:
    """SQL: keys only in the first (``a``) and second (``b``) version, and whether nothing is left."""
    valid = f"(abs(q.n) = 1 and (q.x & 65535L) = (xxhash64(q.x & -65536L) & 65535L) and {_cell('q.x', f'(j div {BLOCK})')} = j % {BLOCK})"
    hit = f"{_cell('p[0].x', f'(i div {BLOCK})')} = i % {BLOCK}"
    step = (
        f"transform(array(filter(s.cells, (q, j) -> {valid})), p -> if(size(p) = 0, s, named_struct("
        f"'cells', transform(s.cells, (u, i) -> if({hit}, named_struct('n', u.n - p[0].n, 'x', u.x ^ p[0].x), u)),"
        " 'a', s.a + if(p[0].n = 1, 1, 0), 'b', s.b + if(p[0].n = 1, 0, 1))))[0]"
    )
    return (
        f"aggregate(sequence(1, {_CELLS}), named_struct('cells', {cells}, 'a', 0, 'b', 0), (s, r) -> {step},"
        " s -> named_struct('a', s.a, 'b', s.b, 'done', not exists(s.cells, u -> u.n <> 0 or u.x <> 0L)))"
    )


def _dealt(keys: str, side: str, seed: int) -> str:
    """SQL: keys dealt to ``side * side`` groups by a hash, over two levels."""
    first = f"transform(sequence(0, {side} - 1), g -> filter({keys}, k -> pmod(xxhash64(k, {seed}), {side}) = g))"
    second = (
        f"transform({first}, part -> transform(sequence(0, {side} - 1), g ->"
        f" filter(part, k -> pmod(xxhash64(k, {seed + 1}), {side}) = g)))"
    )
    return f"flatten({second})"


def _larger(a: str, b: str, factor: int, seed: int) -> str:
    """SQL: the peeled sums over the sub-sketches of two key sets."""
    side = f"cast(ceil(sqrt({factor} * (size({a}) + size({b})) / {LOAD}.0)) as int)"
    side = f"greatest(1, {side})"
    parts = f"zip_with({_dealt(a, side, seed)}, {_dealt(b, side, seed)}, (u, v) -> named_struct('u', u, 'v', v))"
    peeled = peeled_sql(minus_sql(cells_sql("w.u"), cells_sql("w.v")))
    return (
        f"aggregate(transform({parts}, w -> {peeled}), named_struct('a', 0, 'b', 0, 'done', true),"
        " (s, p) -> named_struct('a', s.a + p.a, 'b', s.b + p.b, 'done', s.done and p.done))"
    )


def with_difference(df: DataFrame, out: str, a: str, b: str, cells_a: str, cells_b: str) -> DataFrame:
    """Add ``out`` (a, b): how many keys only one side has, by sketches of growing size."""
    agree = "({d}.done and size({a}) - {d}.a = size({b}) - {d}.b)"
    name = f"_{out}"
    df = df.withColumn(name, F.expr(peeled_sql(minus_sql(cells_a, cells_b))))
    for factor, seed in ((1, 11), (4, 23)):
        kept = agree.format(d=name, a=a, b=b)
        df = df.withColumn(f"{name}{factor}", F.expr(f"if({kept}, {name}, {_larger(a, b, factor, seed)})")).drop(name)
        name = f"{name}{factor}"
    kept = agree.format(d=name, a=a, b=b)
    exact = f"named_struct('a', size(array_except({a}, {b})), 'b', size(array_except({b}, {a})))"
    return df.withColumn(
        out, F.expr(f"if({kept}, named_struct('a', {name}.a, 'b', {name}.b), {exact})")
    ).drop(name)


def likeness(difference: str, a: str, b: str):
    """Jaccard similarity of two key sets from their sizes and what only one side has."""
    union = f"size({a}) + {difference}.b"
    return F.expr(f"if({union} = 0, 1.0D, cast(size({a}) - {difference}.a as double) / ({union}))")


def fingerprint(keys: str, cells: str):
    """The sketch as text: number of paragraphs, then count and xor of each cell."""
    told = f"transform({cells}, u -> concat(cast(u.n as string), ':', lower(hex(u.x))))"
    return F.expr(f"concat(cast(size({keys}) as string), ';', array_join({told}, ','))")


def _next_rows(keys: DataFrame) -> DataFrame:
    """Each row's key with the key of the next row, descending by identifier, cyclic."""
    ids = stage(keys.distinct(), "document-order")
    parts = max(1, -(-ids.count() // RANGE_ROWS))
    order = [F.col("doc_id").desc_nulls_last(), F.col("version").asc()]
    dealt = stage(
        ids.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "document-ranges"
    )
    inside = Window.partitionBy("part").orderBy(*order)
    key = F.struct("doc_id", "version")
    rows = dealt.withColumn("then", F.lead(key).over(inside)).withColumn("at", F.row_number().over(inside))
    # one row per range partition: the first key of the partition after it
    heads = rows.where("at = 1").select("part", key.alias("head"))
    by_part = Window.orderBy("part")
    everything = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(
        "part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(everything)).alias("head")
    )
    return rows.join(F.broadcast(after), "part").select(
        "doc_id", "version", "n_chars", F.coalesce("then", "head").alias("next")
    )


def with_edited(docs: DataFrame) -> DataFrame:
    """Per row: text and paragraph keys, the edited text and its keys, the next row's keys.

    Texts are dealt out once, by identifier and text hash; the start of the next text and its keys come
    to each row from there. Repeated rows count once in the order.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("version"), "text")
    keyed = texts.withColumn("keys", paragraph_keys(F.col("text")))
    order = _next_rows(texts.select("doc_id", "version", F.char_length("text").alias("n_chars")))
    wanted = order.select(
        F.col("doc_id").alias("to_id"),
        F.col("version").alias("to_version"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("need"),
        F.col("next.doc_id").alias("n_id"),
        F.col("next.version").alias("n_version"),
    )
    at_next = F.col("doc_id").eqNullSafe(F.col("n_id")) & (F.col("version") == F.col("n_version"))
    pieces = keyed.join(wanted.hint("shuffle_hash"), at_next).select(
        "to_id", "to_version", F.expr("substring(text, 1, need)").alias("piece"), F.col("keys").alias("keys_n")
    ).dropDuplicates(["to_id", "to_version"])
    at_own = F.col("doc_id").eqNullSafe(F.col("to_id")) & (F.col("version") == F.col("to_version"))
    both = keyed.join(pieces.hint("shuffle_hash"), at_own)
    n = F.char_length("text")
    return both.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "keys",
        "keys_n",
        F.concat(F.substr("text", F.lit(1), n - F.floor(n / 3).cast("int")), F.col("piece")).alias("edited"),
    ).withColumn("keys_e", paragraph_keys(F.col("edited")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: its sketch, that of its edited text, and how alike these and the next row's are."""
    edited = with_edited(docs).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "keys", "keys_e", "keys_n"
    )
    sketched = edited.withColumns({
        "cells": F.expr(cells_sql("keys")),
        "cells_e": F.expr(cells_sql("keys_e")),
        "cells_n": F.expr(cells_sql("keys_n")),
    })
    compared = with_difference(sketched, "to_edited", "keys", "keys_e", "cells", "cells_e")
    compared = with_difference(compared, "to_next", "keys", "keys_n", "cells", "cells_n")
    return compared.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint("keys", "cells").alias("fingerprint"),
        fingerprint("keys_e", "cells_e").alias("edited_fingerprint"),
        likeness("to_edited", "keys", "keys_e").alias("near_edited"),
        likeness("to_next", "keys", "keys_n").alias("near_next"),
    )

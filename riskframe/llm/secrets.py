"""Secret scans: a random forest over candidate strings removes false positives.

Candidates are runs of at least ``MIN_CHARS`` token characters with a digit. Their features are length
and character shares, the mean log-probability of their character transitions in prose, the share of
their letters that dictionary words cover, their path, and the words around them. The forest is
trained on labelled findings. Transition counts and the dictionary come from the words around all
candidates; paths and neighbouring words are weighted by their log-odds in the labelled sample.

Everything runs as DataFrame expressions and Spark ML; the secret itself is returned as a hash only.

Defined results: null and empty texts have no candidates; null paths are empty; ties and repeated rows
give a finding each; without labelled findings of both kinds every candidate is reported with score 1;
an empty table gives an empty table; extra columns are not read.
"""

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stage, work_path

MIN_CHARS = 12
TOKEN = "[A-Za-z0-9_+/-]"
CANDIDATE = rf"(?<!{TOKEN})(?=[A-Za-z_+/-]*[0-9]){TOKEN}{{{MIN_CHARS},}}"
NEAR = 3
#: Bound of the labelled findings that the forest is trained on, in the order of a hash.
TRAIN_ROWS = 8_000
TREES, DEPTH = 40, 6
#: Occurrences from which a neighbouring word counts as dictionary word, or has log-odds.
MIN_WORD = 3

_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
_SIDE = len(_ALPHABET) + 1
FEATURES = [
    "n_chars", "digits", "uppers", "lowers", "hexes", "distinct_chars", "transitions", "coverage",
    "path_depth", "path_sample", "path_odds", "before_odds", "after_odds",
]

#: Fixed values for weak labels: names of credentials, and a public key format.
CREDENTIAL = "token|password|passwd|secret|api_?key|access_?key|credential"
KEY_FORMAT = "^AKIA[0-9A-Z]{16}$"


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """One row per candidate: where it stands, its value, path and neighbouring words."""
    words = docs.where(F.col("text").rlike(CANDIDATE)).select(
        "doc_id",
        F.xxhash64("text").alias("version"),
        F.coalesce(F.col(path), F.lit("")).alias("path"),
        F.split("text", r"\s+", -1).alias("words"),
    )
    found = words.withColumn(
        "hits",
        F.filter(F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda x: x["w"].rlike(CANDIDATE)),
    )
    each = found.select("*", F.explode("hits").alias("hit")).select(
        "doc_id", "version", "path",
        F.col("hit.i").alias("word"),
        F.posexplode(F.regexp_extract_all("hit.w", F.lit(f"({CANDIDATE})"), F.lit(1))).alias("nth", "value"),
        F.regexp_extract("hit.w", f"^(.*?){CANDIDATE}", 1).alias("prefix"),
        F.expr(f"slice(words, greatest(hit.i - {NEAR - 1}, 1), least(hit.i, {NEAR}))").alias("before"),
        F.expr(f"slice(words, hit.i + 2, {NEAR})").alias("after"),
    )
    clean = lambda c: F.transform(c, lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}0-9=:_]", "")))
    return each.select(
        F.xxhash64("doc_id", "version", "word", "nth").alias("finding"),
        "doc_id", "word", "nth", "path", "value",
        F.filter(clean(F.concat(F.col("before"), F.array("prefix"))), lambda w: w != "").alias("before"),
        F.filter(clean(F.col("after")), lambda w: w != "").alias("after"),
    )


def weak_labels(found: DataFrame) -> DataFrame:
    """Label candidates by format: named credentials and key formats 1, plain numbers 0, others null."""
    named = F.array_join("before", " ").rlike(f"({CREDENTIAL}) ?[=:]?$|({CREDENTIAL}) ?[=:]")
    return found.withColumn(
        "label",
        F.when(F.col("value").rlike(KEY_FORMAT) | named, 1.0).when(F.col("value").rlike("^[0-9]+$"), 0.0),
    )


def _pairs(col: str) -> str:
    """SQL: the transition numbers of a string's consecutive characters."""
    code = f"locate(substring(lower({col}), {{i}}, 1), '{_ALPHABET}')"
    return (
        f"transform(sequence(2, greatest(length({col}), 2)),"
        f" i -> {code.format(i='i - 1')} * {_SIDE} + {code.format(i='i')})"
    )


def _transitions(around: DataFrame) -> list[float]:
    """Log-probability of each character transition in words (a table of fixed size)."""
    rows = around.where(F.length("w") > 1).select(F.explode(F.expr(_pairs("w"))).alias("t")).groupBy("t").agg(
        F.count("*").alias("n")
    ).collect()
    counts = [1.0] * (_SIDE * _SIDE)
    for r in rows:
        counts[r["t"]] += r["n"]
    sums = [sum(counts[i * _SIDE : (i + 1) * _SIDE]) for i in range(_SIDE)]
    return [math.log(c / sums[i // _SIDE]) for i, c in enumerate(counts)]


def _odds(sample: DataFrame, key: Column) -> DataFrame:
    """Smoothed log-odds of label 1 by key, for keys seen often enough."""
    seen = sample.select("label", key.alias("key")).groupBy("key").agg(
        F.sum("label").alias("p"), F.count("*").alias("n")
    ).where(F.col("n") >= MIN_WORD)
    return seen.select("key", F.log((F.col("p") + 1) / (F.col("n") - F.col("p") + 1)).alias("odds"))


def _strongest(found: DataFrame, side: str, odds: DataFrame) -> DataFrame:
    """Per finding, the log-odds furthest from 0 among the words of a side."""
    words = found.select("finding", F.explode(side).alias("key")).join(F.broadcast(odds), "key")
    return words.groupBy("finding").agg(F.max_by("odds", F.struct(F.abs("odds"), "odds")).alias(f"{side}_odds"))


def featured(found: DataFrame, sample: DataFrame) -> DataFrame:
    """The features of all candidates; ``sample`` are labelled candidates."""
    around = found.select(F.explode(F.concat("before", "after")).alias("w")).where(F.col("w").rlike(r"^\p{L}+$"))
    table = F.array(*[F.lit(x) for x in _transitions(around)])
    dictionary = around.where(F.length("w") > 2).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_WORD)
    runs = found.select("finding", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("w"))
    covered = runs.join(dictionary, "w").groupBy("finding").agg(F.sum(F.length("w")).alias("covered"))

    def share(pattern):
        return F.length(F.regexp_replace("value", pattern, "")) / F.length("value")

    n = F.length("value")
    base = found.select(
        "*",
        n.cast("double").alias("n_chars"),
        share("[^0-9]").alias("digits"),
        share("[^A-Z]").alias("uppers"),
        share("[^a-z]").alias("lowers"),
        share("[^0-9a-f]").alias("hexes"),
        (F.size(F.array_distinct(F.split("value", ""))) / n).alias("distinct_chars"),
        F.expr(_pairs("value")).alias("pairs"),
        (F.size(F.split("path", "/")) - 1).cast("double").alias("path_depth"),
        F.lower("path").rlike("test|example|sample|mock|fixture|doc").cast("double").alias("path_sample"),
    ).withColumn(
        "transitions",
        F.aggregate("pairs", F.lit(0.0), lambda a, i: a + F.element_at(table, (i + 1).cast("int"))) / F.size("pairs"),
    )
    by_path = _odds(sample, F.col("path")).select(F.col("key").alias("path"), F.col("odds").alias("path_odds"))
    out = base.join(covered, "finding", "left").join(F.broadcast(by_path), "path", "left")
    for side in ("before", "after"):
        odds = _odds(sample, F.explode(F.array_distinct(side)))
        out = out.join(_strongest(found, side, odds), "finding", "left")
    out = out.withColumn("coverage", F.col("covered") / F.col("n_chars"))
    return out.fillna(0.0, ["coverage", "path_odds", "before_odds", "after_odds"]).select(
        "finding", "doc_id", "word", "nth", "value", "label", *FEATURES
    )


def scan(labelled: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Score all candidates; those with a ``label`` (0 or 1) are what the forest may learn from.

    At most ``rows`` labelled candidates are used for training, the same ones on every run.
    """
    found = stage(labelled, "secret-candidates")
    sample = stage(
        found.where(F.col("label").isin(0.0, 1.0)).orderBy(F.xxhash64("finding"), "finding").limit(rows), "secret-sample"
    )
    kinds = [r["label"] for r in sample.select("label").distinct().collect()]
    out = ["doc_id", "word", "nth", F.length("value").cast("long").alias("n_chars"), F.sha2("value", 256).alias("value_sha256")]
    if len(kinds) < 2:
        return found.select(*out, F.lit(1.0).alias("score"), F.lit(True).alias("secret"))
    data = stage(featured(found, sample), "secret-features")
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(data)
    chosen = vectors.join(F.broadcast(sample.select("finding").distinct()), "finding", "left_semi")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featuresCol="features", labelCol="label")
    path = work_path(found.sparkSession, "secret-forest")
    forest.fit(chosen).write().save(path)  # a stored model carries no session into its tasks
    scored = RandomForestClassificationModel.load(path).transform(vectors)
    score = vector_to_array("probability")[1]
    return scored.select(*out, score.alias("score"), (score >= 0.5).alias("secret"))

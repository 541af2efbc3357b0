"""Reproducible splits, samples and folds from the order of hashed row keys."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.functions.ordering import position, rank_cuts


def stratified_split(
    df: DataFrame,
    key: str = C.KEY,
    target: str = C.TARGET,
    test: float = C.TEST_SHARE,
    val: float = C.VALIDATION_SHARE,
) -> DataFrame:
    """Add ``split`` (train/val/test) with exact shares in every class.

    The cut keys per class are found once; the assignment is then a plain column expression
    without shuffle. Copies of a row (same key) share a split, so splits never overlap.
    """
    cuts = rank_cuts(df, key, [test, test + val], target)
    at = position(key, cuts, target) if cuts else F.lit(2)
    return df.withColumn("split", F.when(at == 0, "test").when(at == 1, "val").otherwise("train"))


def split_overview(df: DataFrame, target: str = C.TARGET) -> DataFrame:
    counts = df.groupBy("split").agg(
        F.count("*").alias("rows"), F.sum(F.col(target).cast("long")).alias("failures")
    )
    whole = F.sum("rows").over(Window.partitionBy())  # three rows
    return counts.select(
        "split", "rows",
        F.round(F.col("rows") / whole, 6).alias("share"),
        "failures",
        F.round(F.col("failures") / F.col("rows"), 6).alias("failure_rate"),
    )


def split_overlap(df: DataFrame, key: str = C.KEY) -> DataFrame:
    """Split controls in one pass over the keys: rows, keys, shared keys, forbidden columns."""
    per_key = df.groupBy(key).agg(
        F.count("*").alias("n"),
        *[F.max((F.col("split") == s).cast("int")).alias(s) for s in ("train", "val", "test")],
    )

    def both(a: str, b: str):
        return F.sum((F.col(a) * F.col(b)).cast("long")).alias(f"{a}_{b}")

    forbidden = len(set(df.columns) & {*C.CAUSES, *C.ID_COLUMNS})
    return per_key.agg(
        F.sum("n").alias("rows"), F.count("*").alias("keys"),
        both("train", "val"), both("train", "test"), both("val", "test"),
    ).withColumn("forbidden_columns", F.lit(forbidden))


def split_reproducible(stored: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks; both zero when the split was reproduced."""
    side = stored.withColumn("__stored", F.lit(1)).unionByName(
        recomputed.withColumn("__stored", F.lit(-1))
    )
    cols = stored.columns
    return side.groupBy(*cols).agg(F.sum("__stored").alias("d")).agg(
        F.sum(F.greatest(F.col("d"), F.lit(0))).alias("only_stored"),
        F.sum(F.greatest(-F.col("d"), F.lit(0))).alias("only_recomputed"),
    ).withColumn(
        "reproduced", (F.col("only_stored") == 0) & (F.col("only_recomputed") == 0)
    )


def uniform_sample(
    df: DataFrame, n: int = C.SAMPLE_SIZE, key: str = C.KEY, seed: int = C.SEED
) -> DataFrame:
    """A uniform sample of min(rows, n) rows: the n smallest salted key hashes."""
    salted = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key)))
    return df.withColumn("__h", salted).orderBy("__h", key).limit(n).drop("__h")


def stratified_folds(
    df: DataFrame,
    folds: int = C.CV_FOLDS,
    key: str = C.KEY,
    target: str = C.TARGET,
    seed: int = C.SEED,
) -> DataFrame:
    """Add ``fold`` (0..folds-1); class counts per fold differ by at most one row."""
    salted = df.withColumn("__fold_key", F.md5(F.concat(F.lit(f"fold{seed}|"), F.col(key))))
    shares = [i / folds for i in range(1, folds)]
    cuts = rank_cuts(salted, "__fold_key", shares, target, rounding=1e-9)
    at = position("__fold_key", cuts, target) if cuts else F.lit(0)
    return salted.withColumn("fold", at.cast("int")).drop("__fold_key")


def first_share(df: DataFrame, share: float, key: str = C.KEY):
    """Condition column: the row is among the first ``floor(share * n)`` rows in key order."""
    cuts = rank_cuts(df, key, [share], rounding=0.0)
    if not cuts or cuts[0][0] is None:
        return F.lit(False)
    return F.col(key) <= F.lit(cuts[0][0])

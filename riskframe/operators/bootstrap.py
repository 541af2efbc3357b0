"""Bootstrap intervals for ranking quality and recall: exact resampling of a fixed number of rows.

Rows with the same score and label are exchangeable, so a resample of n rows is a multinomial draw of n
over the (score, label) cells. It is drawn top-down along a tree: first n is split over blocks of
neighbouring scores (and labels), then a block's share over its cells, each split by conditional
binomial draws that are exact for every mean. The blocks of a replicate are drawn in different
tasks: the top split is repeated from its seed wherever it is needed, so a task knows the rows before its
block without any shuffle of drawn data, and returns one partial sum per replicate and block. Work is
proportional to draws times distinct scores, whatever the number of rows. Seeds are (seed, chunk of
replicates, block): a retried task repeats its draws.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.session import by_value, stage

by_value(__name__)

#: Scores of six decimals fall into at most 245 strips of this width; thin neighbours share a block.
STRIP = 4096
#: Distinct scores a block has at least, where there are so many, and at most (with ``STRIP`` more).
BLOCK_CELLS = 4096
#: Replicates drawn together.
CHUNK = 50

_PARTIAL = "draw int, rows long, positives long, hits long, ranked double"


def score_blocks(df: DataFrame, threshold: float = C.THRESHOLD) -> DataFrame:
    """One row per block of neighbouring scores: its cells in descending order and its totals."""
    cells = stage(
        df.where(F.col(C.PROBABILITY).isNotNull() & F.col(C.TARGET).isNotNull()).groupBy(C.PROBABILITY).agg(
            F.sum((F.col(C.TARGET) == 0).cast("long")).alias("n0"),
            F.sum((F.col(C.TARGET) == 1).cast("long")).alias("n1"),
        ).withColumn("strip", F.floor(F.round(F.col(C.PROBABILITY) * 1e6) / STRIP).cast("long")),
        "score-cells",
    )
    starts, held = [], 0
    for r in cells.groupBy("strip").count().orderBy("strip").collect():  # at most 245 rows
        if held >= BLOCK_CELLS:
            starts, held = [*starts, r["strip"]], 0
        held += r["count"]
    block = " + ".join(f"int(strip >= {s})" for s in starts) or "0"
    cell = F.struct(
        (-F.col(C.PROBABILITY)).alias("order"), "n0", "n1", (F.col(C.PROBABILITY) >= threshold).alias("hit")
    )
    return cells.groupBy(F.expr(f"cast({block} as bigint)").alias("block")).agg(
        F.sort_array(F.collect_list(cell)).alias("cells"),  # fewer than BLOCK_CELLS + STRIP
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"),
    ).select("block", "n0", "n1", *(F.col(f"cells.{c}").alias(f"cell_{c}") for c in ("n0", "n1", "hit")))


def _shares(counts: np.ndarray) -> np.ndarray:
    total = counts.sum()
    return counts / total if total else np.full(len(counts), 1 / len(counts))


def resampled(block: int, blocks: np.ndarray, totals: np.ndarray, cells: np.ndarray, chunk: int, draws: int, seed: int):
    """Drawn rows of one block for some replicates.

    ``blocks`` are the block numbers in descending order, ``totals`` their rows per label (2 x blocks),
    ``cells`` the rows per label and score of this block (2 x scores). Returns the drawn counts
    (2 x replicates x scores) and the drawn rows of the blocks before (2 x replicates).
    """
    top = np.random.Generator(np.random.PCG64([seed, chunk]))
    split = top.multinomial(int(totals.sum()), _shares(totals.ravel().astype(float)), size=draws)
    split = split.reshape(draws, 2, len(blocks)).transpose(1, 0, 2)
    at = int(np.flatnonzero(blocks == block)[0])
    own = np.random.Generator(np.random.PCG64([seed, chunk, at + 1]))
    drawn = np.stack([own.multinomial(split[y, :, at], _shares(cells[y].astype(float))) for y in (0, 1)])
    return drawn, split[:, :, :at].sum(axis=2)


def replicates(df: DataFrame, draws: int, threshold: float = C.THRESHOLD, seed: int = C.SEED) -> DataFrame:
    """Rows, average precision and recall of every replicate with at least one positive."""
    spark = df.sparkSession
    blocks = stage(score_blocks(df, threshold), "score-blocks")
    # three numbers a block
    total = blocks.select("block", "n0", "n1").orderBy(F.desc("block")).collect()
    names = np.array([r["block"] for r in total], dtype=np.int64)
    totals = np.array([[r["n0"] for r in total], [r["n1"] for r in total]], dtype=np.int64)

    def draw(batches):
        for frame in batches:
            for row in frame.itertuples(index=False):
                size = min(CHUNK, draws - row.chunk * CHUNK)
                cells = np.array([row.cell_n0, row.cell_n1], dtype=np.int64)
                drawn, before = resampled(row.block, names, totals, cells, row.chunk, size, seed)
                pos = drawn[1]
                above = np.cumsum(drawn, axis=2) + before[:, :, None]
                n = np.maximum(above.sum(axis=0), 1)
                yield pd.DataFrame({
                    "draw": np.arange(size, dtype=np.int32) + row.chunk * CHUNK,
                    "rows": drawn.sum(axis=(0, 2)),
                    "positives": pos.sum(axis=1),
                    "hits": pos[:, np.asarray(row.cell_hit, dtype=bool)].sum(axis=1),
                    "ranked": (pos * (above[1] / n)).sum(axis=1),
                })

    chunks = -(-draws // CHUNK)
    each = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    partial = each.repartition(width, "block", "chunk").mapInPandas(draw, _PARTIAL)
    out = partial.groupBy("draw").agg(
        F.sum("rows").alias("rows"),
        F.try_divide(F.sum("ranked"), F.sum("positives")).alias("pr_auc"),
        F.try_divide(F.sum("hits"), F.sum("positives")).alias("recall"),
    ).where("pr_auc is not null")
    return out


def bootstrap_interval(
    df: DataFrame,
    draws: int = C.BOOTSTRAP_DRAWS,
    threshold: float = C.THRESHOLD,
    seed: int = C.SEED,
    digits: int = 4,
) -> DataFrame:
    """95 % percentile intervals, one row; replicates without positives are skipped."""
    reps = replicates(df, draws, threshold, seed)

    def ends(c: str) -> list[Column]:
        q = F.percentile(c, [0.025, 0.975])
        return [F.round(q[0], digits).alias(f"{c}_low"), F.round(q[1], digits).alias(f"{c}_high")]

    return reps.agg(F.count("*").alias("draws"), *ends("pr_auc"), *ends("recall"))

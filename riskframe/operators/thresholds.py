"""Cost curve over a threshold grid in one pass, and the choice of the cheapest threshold."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.functions.decision import (
    BREAK_EVEN,
    do_nothing_cost,
    expected_cost,
    ratio_or_zero,
)


def grid_index(score: str = C.PROBABILITY, steps: int = C.GRID_STEPS) -> Column:
    """The largest i with ``score >= i/100``, 0 when the score lies below the whole grid."""
    p = F.col(score)
    guess = F.floor(p * 100)
    exact = (
        F.when(p >= (guess + 1) / F.lit(100.0), guess + 1)
        .when(p < guess / F.lit(100.0), guess - 1)
        .otherwise(guess)
    )
    return F.greatest(F.least(exact, F.lit(steps)), F.lit(0)).cast("int")


def grid_cells(
    df: DataFrame, by: Sequence[str] = (), steps: int = C.GRID_STEPS, cut: float | None = None
) -> DataFrame:
    """Rows and positives per grid cell, at most ``steps + 2`` rows per group.

    ``cut`` splits one cell at a threshold that is not on the grid.
    """
    keys = [grid_index(steps=steps).alias("k")]
    if cut is not None:
        keys.append((F.col(C.PROBABILITY) >= F.lit(cut)).alias("at_cut"))
    return df.groupBy(*by, *keys).agg(
        F.sum(F.col(C.TARGET).cast("long")).alias("pos"), F.count("*").alias("n")
    )


def cost_curve(df: DataFrame, by: Sequence[str] = (), steps: int = C.GRID_STEPS) -> DataFrame:
    """Confusion counts, recall, precision and cost at every grid threshold.

    Each row is assigned to its grid cell once; the sweep then runs over the counts per cell
    instead of over the rows.
    """
    return curve_from_cells(grid_cells(df, by, steps), by, steps)


def curve_from_cells(
    cells: DataFrame, by: Sequence[str] = (), steps: int = C.GRID_STEPS
) -> DataFrame:
    return _rates(_sweep(cells, by, 1, steps), by).drop("i")


def _sweep(cells: DataFrame, by: Sequence[str], first: int, steps: int) -> DataFrame:
    """Confusion counts per grid index i; index 0 is the off-grid cut of the cells."""
    swept = cells.withColumn("i", F.explode(F.sequence(F.lit(first), F.lit(steps))))
    hit = F.col("k") >= F.col("i")
    if first == 0:
        hit = F.when(F.col("i") == 0, F.col("at_cut")).otherwise(hit)
    neg = F.col("n") - F.col("pos")
    return swept.groupBy(*by, "i").agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, neg).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(hit, 0).otherwise(neg)).alias("tn"),
    )


def _rates(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    return counts.select(
        *by, "i",
        F.round(F.col("i") / 100, 2).alias("threshold"),
        "tp", "fp", "fn", "tn",
        ratio_or_zero("tp", F.col("tp") + F.col("fn")).alias("recall"),
        ratio_or_zero("tp", F.col("tp") + F.col("fp")).alias("precision"),
        expected_cost().alias("cost_eur"),
    )


def best_threshold(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The cheapest threshold, the largest one among equals, and how many are equally cheap."""
    cheapest = F.min("cost_eur").over(Window.partitionBy(*by))
    tied = curve.withColumn("least", cheapest).where(F.col("cost_eur") == F.col("least"))
    fields = ["threshold", "cost_eur", "recall", "precision", "tp", "fp", "fn"]
    return (
        tied.groupBy(*by)
        .agg(
            F.max_by(F.struct(*fields), F.col("threshold")).alias("best"),
            F.count("*").alias("tied_candidates"),
        )
        .select(*by, "best.*", "tied_candidates")
    )


def threshold_comparison(df: DataFrame) -> DataFrame:
    """The best threshold next to the default one and to never acting, from one curve."""
    point = F.struct("threshold", "recall", "precision", "cost_eur")
    nothing = F.struct(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("recall"),
        F.lit(0.0).alias("precision"),
        F.col("nothing").alias("cost_eur"),
    )
    picked = cost_curve(df).agg(
        F.max_by(point, F.struct(-F.col("cost_eur"), F.col("threshold"))).alias("best"),
        F.min_by(point, F.abs(F.col("threshold") - C.DEFAULT_THRESHOLD)).alias("default"),
        F.max(do_nothing_cost(F.col("tp") + F.col("fn"))).alias("nothing"),
    )
    rules = F.array(
        F.struct(F.lit("best").alias("rule"), F.col("best").alias("at")),
        F.struct(F.lit("default").alias("rule"), F.col("default").alias("at")),
        F.struct(F.lit("nothing").alias("rule"), nothing.alias("at")),
    )
    return picked.select("nothing", F.explode(rules).alias("r")).select(
        "r.rule", "r.at.*", (F.col("nothing") - F.col("r.at.cost_eur")).alias("saving_eur")
    )


def break_even(df: DataFrame, steps: int = C.GRID_STEPS) -> DataFrame:
    """The analytic break-even probability applied to the table, next to the empirical best.

    The cut is one more index of the sweep, so both come from the same counts.
    """
    swept = _rates(_sweep(grid_cells(df, (), steps, BREAK_EVEN), (), 0, steps), ())
    fields = ["threshold", "alarms", "recall", "precision", "cost_eur"]
    at_cut = F.struct(
        F.round(F.lit(BREAK_EVEN), 6).alias("threshold"),
        (F.col("tp") + F.col("fp")).alias("alarms"),
        "recall", "precision", "cost_eur",
    )
    on_grid = F.col("i") > 0
    best = F.struct((-F.col("cost_eur")).alias("saved"), F.col("threshold"))
    return swept.agg(
        F.max(F.when(F.col("i") == 0, at_cut)).alias("cut"),
        F.max(F.when(on_grid, best)).alias("best"),
    ).select(
        *[f"cut.{f}" for f in fields],
        F.col("best.threshold").alias("best_threshold"),
        (-F.col("best.saved")).alias("best_cost_eur"),
    )

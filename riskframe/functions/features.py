"""Feature construction: derived features, one-hot columns, standardization, column removal."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import config as C

MAX_CATEGORIES = 1000


def rounded(value: str, digits: int) -> str:
    """SQL for ``round(value, digits)`` of a double, with equal results and a tenth of its cost.

    ``round`` goes through the decimal text of every number. Away from ties the nearest whole number of the scaled value,
    divided by a power of ten that is exact itself, is the same double; ties, huge, infinite and null values still take ``round``.
    """
    scale = f"{float(10**digits)!r}D"
    scaled = f"(({value}) * {scale})"
    plain = f"abs({scaled}) < 1e9D and abs({scaled} - rint({scaled})) < 0.499D"
    return f"case when {plain} then rint({scaled}) / {scale} + 0D else round({value}, {digits}) end"  # + 0: no negative zero


def add_engineered(df: DataFrame) -> DataFrame:
    """Temperature difference, mechanical power and the wear-torque product."""
    return df.withColumns({
        "temp_difference_k": F.expr("process_temperature_k - air_temperature_k"),
        "power_w": F.expr("torque_nm * rotational_speed_rpm * 2 * pi() / 60"),
        "wear_torque_min_nm": F.expr("tool_wear_min * torque_nm"),
    })


def drop_leakage(df: DataFrame) -> DataFrame:
    """Remove cause flags and identifiers; names that are absent are ignored."""
    return df.drop(*C.CAUSES, *C.ID_COLUMNS)


def removed_columns(before: DataFrame, after: DataFrame) -> list[str]:
    return sorted(set(before.columns) - set(after.columns))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def common_columns(a: DataFrame, b: DataFrame, without: Iterable[str] = ()) -> list[str]:
    return [c for c in a.columns if c in b.columns and c not in set(without)]


def category_levels(df: DataFrame, col: str) -> list:
    """Sorted distinct values of a categorical column; too many of them is an error."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_CATEGORIES + 1).collect()
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(f"{col} has more than {MAX_CATEGORIES} values; not a categorical column")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, col: str, levels: list) -> DataFrame:
    """One 0/1 column per level but the first; an unknown level gives zeros everywhere."""
    return df.withColumns({
        f"{col}_{v}": F.coalesce((F.col(col) == F.lit(v)).cast("double"), F.lit(0.0))
        for v in levels[1:]
    })


def standardize(df: DataFrame, cols: list[str], digits: int | None = None) -> DataFrame:
    """Zero mean and unit population deviation per column; a constant column becomes zero.

    Two numbers per column are fitted in one aggregate and applied as constants.
    """
    stats = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in cols],
    ).first()
    scaled = {}
    for c in cols:
        mean, spread = stats[f"m_{c}"], stats[f"s_{c}"]
        if mean is None or spread == 0:
            scaled[c] = F.when(F.col(c).isNotNull(), F.lit(0.0))
        else:
            scaled[c] = (F.col(c) - F.lit(mean)) / F.lit(spread)
        if digits is not None:
            scaled[c] = F.round(scaled[c], digits)
    return df.withColumns(scaled)

"""Row decisions and the cost and ratio expressions shared by all metric operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe import config as C


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def alarm(probability: str | Column = C.PROBABILITY, threshold: float = C.THRESHOLD) -> Column:
    """Alarm from the threshold on (inclusive)."""
    return _c(probability) >= F.lit(threshold)


def error_kind(label: str | Column, alarmed: Column) -> Column:
    failed = _c(label) == 1
    return (
        F.when(failed & alarmed, "TP").when(alarmed, "FP").when(failed, "FN").otherwise("TN")
    )


def outcome_counts(label: str | Column, alarmed: Column) -> list[Column]:
    """The four confusion counts as aggregate columns tp, fp, fn, tn."""
    y = _c(label)

    def total(cond: Column, name: str) -> Column:
        return F.coalesce(F.sum(cond.cast("long")), F.lit(0)).alias(name)

    return [
        total((y == 1) & alarmed, "tp"),
        total((y == 0) & alarmed, "fp"),
        total((y == 1) & ~alarmed, "fn"),
        total((y == 0) & ~alarmed, "tn"),
    ]


def ratio_or_zero(num: str | Column, den: str | Column, digits: int = 6) -> Column:
    return F.round(F.coalesce(F.try_divide(_c(num), _c(den)), F.lit(0.0)), digits)


def ratio_or_null(num: str | Column, den: str | Column, digits: int = 6) -> Column:
    return F.round(F.try_divide(_c(num), _c(den)), digits)


def expected_cost(tp="tp", fp="fp", fn="fn") -> Column:
    return (
        _c(fn) * F.lit(C.COST_FN) + _c(fp) * F.lit(C.COST_FP) + _c(tp) * F.lit(C.COST_TP)
    ).cast("double")


def do_nothing_cost(positives: str | Column) -> Column:
    return (_c(positives) * F.lit(C.COST_FN)).cast("double")


BREAK_EVEN = C.COST_FP / (C.COST_FN - C.COST_TP + C.COST_FP)

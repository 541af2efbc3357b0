"""Data contract: column checks over a whole table, and accept/reject/warn per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import config as C

REPORT_FIELDS = "check_no int, check string, column string, severity string, " \
    "violations bigint, smallest double, largest double, passed boolean"


def _limits(rules: dict) -> list[tuple[str, str, str, float]]:
    """(check, severity, comparison, limit) of a numeric column; limits themselves are allowed."""
    kinds = [
        ("min", "error", "<"), ("max", "error", ">"),
        ("warn_min", "warning", "<"), ("warn_max", "warning", ">"),
    ]
    return [(k, sev, op, rules[k]) for k, sev, op in kinds if rules.get(k) is not None]


def _outside(col: str, op: str, limit: float) -> Column:
    return F.col(col) < F.lit(limit) if op == "<" else F.col(col) > F.lit(limit)


def contract_report(df: DataFrame, contract: dict = C.CONTRACT) -> DataFrame:
    """One row per check with violations and extremes, from a single aggregate over the table.

    Presence, type and unexpected-column checks need the schema only. A column of the wrong type
    gets a ``type`` error row instead of its range checks.
    """
    types = {f.name: f.dataType for f in df.schema}
    columns = contract["columns"]
    aggs: dict[str, Column] = {"rows": F.count("*")}
    rows: list[tuple] = []  # check, column, severity, violations, smallest, largest

    def agg(name: str, expr: Column) -> Column:
        aggs[name] = expr
        return F.col(name)

    none = F.lit(None).cast("double")
    for col, rules in columns.items():
        absent = col not in types
        missing = int(absent and rules.get("required", False))
        rows.append(("present", col, "error", F.lit(missing), none, none))
        if absent:
            continue
        nulls = agg(f"null_{col}", F.sum(F.col(col).isNull().cast("long")))
        over = nulls / F.col("rows") > F.lit(float(contract["max_missing_ratio"]))
        rows.append(("missing", col, "error", F.when(over, nulls).otherwise(0), none, none))
        if rules["kind"] == "numeric":
            if not isinstance(types[col], T.NumericType):
                rows.append(("type", col, "error", F.col("rows"), none, none))
                continue
            lo = agg(f"lo_{col}", F.min(F.col(col).cast("double")))
            hi = agg(f"hi_{col}", F.max(F.col(col).cast("double")))
            for check, severity, op, limit in _limits(rules):
                n = agg(f"{check}_{col}", F.sum(_outside(col, op, limit).cast("long")))
                rows.append((check, col, severity, n, lo, hi))
        elif rules.get("allowed") is not None:
            n = agg(f"allowed_{col}", F.sum((~F.col(col).isin(rules["allowed"])).cast("long")))
            rows.append(("allowed", col, "error", n, none, none))
    if contract.get("check_row_count"):
        expected = contract.get("expected_row_count")
        diff = F.abs(F.col("rows") - F.lit(expected)) if expected is not None else F.lit(0)
        rows.append(("row_count", None, "error", diff, none, none))
    if contract.get("warn_on_unexpected_columns"):
        known = set(columns) | set(contract.get("known_columns", ()))
        rows.append(
            ("unexpected", None, "warning", F.lit(len(set(df.columns) - known)), none, none)
        )
    packed = F.array(*[
        F.struct(
            F.lit(i).alias("check_no"),
            F.lit(check).alias("check"),
            F.lit(col).cast("string").alias("column"),
            F.lit(severity).alias("severity"),
            F.coalesce(n.cast("long"), F.lit(0).cast("long")).alias("violations"),
            lo.alias("smallest"),
            hi.alias("largest"),
        )
        for i, (check, col, severity, n, lo, hi) in enumerate(rows, 1)
    ])
    wide = df.agg(*[e.alias(n) for n, e in aggs.items()])
    return (
        wide.select(F.explode(packed).alias("c")).select("c.*")
        .withColumn("passed", F.col("violations") == 0)
    )


def contract_summary(report: DataFrame) -> DataFrame:
    """Valid if and only if there is no error; lists every failed check.

    A wrong-type row reports an error but is not itself one of the counted checks.
    """

    def failed(severity: str) -> Column:
        return ~F.col("passed") & (F.col("severity") == severity)

    name = F.concat_ws(":", "check", "column")
    return report.agg(
        F.sum((F.col("check") != "type").cast("long")).alias("checks_run"),
        F.sum(failed("error").cast("long")).alias("errors"),
        F.sum(failed("warning").cast("long")).alias("warnings"),
        F.concat_ws(",", F.array_sort(F.collect_list(F.when(failed("error"), name)))).alias(
            "failed_checks"
        ),
        F.concat_ws(",", F.array_sort(F.collect_list(F.when(failed("warning"), name)))).alias(
            "warned_checks"
        ),
    ).withColumn("valid", F.col("errors") == 0)


def require_valid(df: DataFrame, contract: dict = C.CONTRACT) -> DataFrame:
    """Pass the table through, or raise one error naming every failed check."""
    found = contract_summary(contract_report(df, contract)).first()
    if not found["valid"]:
        raise ValueError(f"contract violated: {found['failed_checks']}")
    return df


def unexpected_values(df: DataFrame, contract: dict = C.CONTRACT) -> DataFrame:
    """Sorted values outside the allowed set per categorical column, with their row counts."""
    cols = {
        c: r["allowed"]
        for c, r in contract["columns"].items()
        if r["kind"] == "categorical" and r.get("allowed") and c in df.columns
    }
    pairs = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.when(~F.col(c).isin(allowed), F.col(c).cast("string")).alias("value"),
        )
        for c, allowed in cols.items()
    ])
    return (
        df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null")
        .groupBy("column", "value").agg(F.count("*").alias("rows"))
    )


def reject_reasons(contract: dict = C.CONTRACT, fields: list[str] = C.INPUT_FIELDS) -> Column:
    """Per row: the fields that are missing, outside hard limits or not an allowed value."""
    tests = []
    for col in fields:
        rules = contract["columns"][col]
        bad = F.col(col).isNull()
        if rules["kind"] == "numeric":
            bad = bad | _outside(col, "<", rules["min"]) | _outside(col, ">", rules["max"])
        else:
            bad = bad | ~F.col(col).isin(rules["allowed"])
        tests.append(F.when(bad, F.lit(col)))
    return F.array_compact(F.array(*tests))


def quarantine(df: DataFrame, contract: dict = C.CONTRACT) -> DataFrame:
    """Add ``reject_reasons`` and ``accepted``; both outputs are filters on one projection."""
    return df.withColumn("reject_reasons", reject_reasons(contract)).withColumn(
        "accepted", F.size("reject_reasons") == 0
    )


def soft_warnings(contract: dict = C.CONTRACT, fields: list[str] = C.MEASURES) -> Column:
    """Per row: the measures outside their usual range, as ``column<limit`` / ``column>limit``."""
    notes = []
    for col in fields:
        for _, severity, op, limit in _limits(contract["columns"][col]):
            if severity == "warning":
                notes.append(F.when(_outside(col, op, limit), F.lit(f"{col}{op}{limit:g}")))
    return F.array_compact(F.array(*notes))


def json_fields(text: str, expected: list[str]) -> list[Column]:
    """Unknown and missing top-level fields of a JSON object column (null = not an object)."""
    keys = F.json_object_keys(text)
    want = F.array(*[F.lit(e) for e in expected])
    return [
        F.array_sort(F.array_except(keys, want)).alias("unknown_fields"),
        F.array_sort(F.array_except(want, keys)).alias("missing_fields"),
    ]

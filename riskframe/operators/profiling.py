"""Profiles of a table: columns, distributions, correlations, leakage and cause structure."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import config as C
from riskframe.functions.ranks import exact_percentiles
from riskframe.session import small_table


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Type, nulls and distinct values per column.

    Exact counts move no values and sort none: one scan, one hash aggregate that is combined map-side. A whole number
    is one bit of the word of its 64 neighbours, the words are or-ed; any other value is a 128-bit digest with one bit.
    ``exact=False`` uses sketches in one pass instead.
    """
    types = dict(df.dtypes)
    nulls = [F.sum(F.col(c).isNull().cast("long")) for c in df.columns]
    if not exact:
        found = df.agg(*[
            F.struct(n.alias("missing"), F.approx_count_distinct(c).alias("distinct_values")).alias(c)
            for c, n in zip(df.columns, nulls, strict=True)
        ])
        return found.select(F.inline(F.array(*[
            F.struct(
                F.lit(c).alias("column"), F.lit(types[c]).alias("type"),
                F.coalesce(F.col(f"`{c}`.missing"), F.lit(0)).alias("missing"),
                F.col(f"`{c}`.distinct_values").alias("distinct_values"),
            )
            for c in df.columns
        ])))
    number = {c: i for i, c in enumerate(df.columns)}
    one, nothing = F.lit(1).cast("long"), F.lit(0).cast("long")

    def cell(c: str) -> list[Column]:
        """Column number, two keys and the bit of a value; null values share a key and have no bit."""
        v, there = F.col(c), F.col(c).isNotNull()
        if types[c] in ("tinyint", "smallint", "int", "bigint"):
            v = v.cast("long")
            keys = F.shiftright(v, 6), F.when(there, nothing)
            bit = F.call_function("shiftleft", one, v.bitwiseAND(63).cast("int"))
        else:
            keys = F.when(there, F.xxhash64(c)), F.when(there, F.xxhash64(F.lit(1), c))
            bit = F.when(there, one)
        return [F.lit(number[c]), *keys, bit]

    cells = [x for c in df.columns for x in cell(c)]
    rows = df.select(F.stack(F.lit(len(number)), *cells).alias("spec", "a", "b", "bits"))
    words = rows.groupBy("spec", "a", "b").agg(
        F.bit_or("bits").alias("bits"), F.count_if(F.col("bits").isNull()).alias("missing")
    )
    found = words.groupBy("spec").agg(F.sum("missing").alias("missing"), F.sum(F.bit_count("bits")).alias("distinct_values"))
    schema = T.StructType().add("spec", "integer").add("column", "string").add("type", "string")
    listed = small_table(df.sparkSession, [(i, c, types[c]) for c, i in number.items()], schema)
    return listed.join(F.broadcast(found), "spec", "left").select(  # one row per column
        "column", "type", F.coalesce("missing", F.lit(0)).alias("missing"),
        F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
    )


def describe_numeric(df: DataFrame, cols: list[str], digits: int = 2) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per column."""
    quartiles = exact_percentiles(df, {c: F.col(c) for c in cols}, [0.25, 0.5, 0.75])
    wide = df.agg(*[
        F.struct(
            F.count(c).alias("count"),
            F.round(F.avg(c), digits).alias("mean"),
            F.round(F.stddev_samp(c), digits).alias("std"),
            F.round(F.min(c).cast("double"), digits).alias("min"),
            F.round(F.max(c).cast("double"), digits).alias("max"),
        ).alias(c)
        for c in cols
    ])
    names = ["p25", "p50", "p75"]
    packed = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col(c).alias("s"),
            *[
                F.round(F.lit(q).cast("double"), digits).alias(n)
                for n, q in zip(names, quartiles[c], strict=True)
            ],
        )
        for c in cols
    ])
    return wide.select(F.explode(packed).alias("p")).select(
        "p.column", "p.s.*", *[f"p.{n}" for n in names]
    )


def class_balance(df: DataFrame, target: str = C.TARGET) -> DataFrame:
    """Rows and share per class; the larger share is the accuracy of always guessing that class."""
    counts = df.groupBy(target).agg(F.count("*").alias("rows"))
    whole = Window.partitionBy()  # two rows
    return counts.select(
        target, "rows",
        F.round(F.col("rows") / F.sum("rows").over(whole), 6).alias("share"),
        F.round(F.max("rows").over(whole) / F.sum("rows").over(whole), 6).alias(
            "trivial_accuracy"
        ),
    )


def class_histogram(
    df: DataFrame, cols: list[str], target: str = C.TARGET, bins: int = 39
) -> DataFrame:
    """Equal-width histogram per column and class, normalized to area one; last bin closed.

    Minimum and maximum reach the driver (two numbers per column); rows are counted by a map-side
    combined aggregate, never regrouped. Empty bins are absent.
    """
    limits = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in cols],
        *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in cols],
    ).first()
    cells, widths = [], {}
    for c in cols:
        lo, hi = limits[f"lo_{c}"], limits[f"hi_{c}"]
        if lo is None:
            continue
        if hi == lo:
            lo, hi = lo - 0.5, hi + 0.5
        width = (hi - lo) / bins
        widths[c] = width
        number = F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
        cells.append(F.struct(F.lit(c).alias("column"), number.cast("int").alias("bin")))
    counts = (
        df.select(target, F.explode(F.array(*cells)).alias("x"))
        .select(target, "x.*").where("bin is not null")
        .groupBy("column", target, "bin").agg(F.count("*").alias("rows"))
    )
    width = F.create_map(*[x for c, w in widths.items() for x in (F.lit(c), F.lit(w))])
    per_class = F.sum("rows").over(Window.partitionBy("column", target))
    return counts.select(
        "column", target, "bin", "rows",
        F.round(F.col("rows") / (per_class * width[F.col("column")]), 6).alias("density"),
    )


def failure_rate_by(
    df: DataFrame, col: str, order: list, target: str = C.TARGET
) -> DataFrame:
    """Rows, failures and failure rate per category in a given order; unlisted ones and null come last."""
    listed = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col))
    rank = F.when(listed > 0, listed).otherwise(len(order) + 1)
    return (
        df.groupBy(col)
        .agg(F.count("*").alias("rows"), F.sum(F.col(target).cast("long")).alias("failures"))
        .select(
            rank.cast("int").alias("order_no"), col, "rows", "failures",
            F.round(F.col("failures") / F.col("rows"), 6).alias("failure_rate"),
        )
    )


def correlation_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlations, one row per column, all pairs from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.round(F.corr(a, b), digits).alias(f"{a}|{b}") for a, b in pairs])

    def cell(a: str, b: str) -> Column:
        if a == b:
            return F.lit(1.0)
        return F.col(f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`")

    packed = F.array(*[
        F.struct(F.lit(a).alias("column"), *[cell(a, b).alias(b) for b in cols]) for a in cols
    ])
    return wide.select(F.explode(packed).alias("p")).select("p.*")


def leakage_audit(
    df: DataFrame, suspects: list[str] = C.CAUSES, target: str = C.TARGET
) -> DataFrame:
    """Cases and correlation with the target per suspect column, and the failures they explain."""
    any_set = sum((F.col(c) for c in suspects), F.lit(0)) > 0
    wide = df.agg(
        *[F.sum(F.col(c).cast("long")).alias(f"n_{c}") for c in suspects],
        *[F.round(F.corr(c, target), 6).alias(f"r_{c}") for c in suspects],
        F.sum(F.col(target).cast("long")).alias("failures"),
        F.sum((any_set & (F.col(target) == 1)).cast("long")).alias("explained"),
    )
    packed = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col(f"n_{c}").alias("cases"),
            F.col(f"r_{c}").alias("correlation"),
        )
        for c in suspects
    ])
    return wide.select(F.explode(packed).alias("p"), "failures", "explained").select(
        "p.*", "failures", "explained"
    )


def cause_multiplicity(
    df: DataFrame, causes: list[str] = C.CAUSES, target: str = C.TARGET
) -> DataFrame:
    """Rows, marks and failures by the number of causes a row carries."""
    marks = sum((F.col(c) for c in causes[1:]), F.col(causes[0]))
    return df.groupBy(marks.cast("int").alias("causes")).agg(
        F.count("*").alias("rows"),
        F.sum(marks.cast("long")).alias("marks"),
        F.sum(F.col(target).cast("long")).alias("failures"),
    )


def cause_crosstab(
    df: DataFrame, causes: list[str] = C.CAUSES, target: str = C.TARGET
) -> DataFrame:
    """Failure against "any cause recorded", as a 2x2 table of row counts."""
    has = F.greatest(*[F.col(c) for c in causes]) == 1
    return df.groupBy((F.col(target) == 1).alias("failure")).agg(
        F.sum((~has).cast("long")).alias("without_cause"),
        F.sum(has.cast("long")).alias("with_cause"),
    )


def cause_hit_rate(
    df: DataFrame, causes: list[str] = C.CAUSES, target: str = C.TARGET
) -> DataFrame:
    """Per cause: rows marked, marked rows that failed, and their percentage."""
    wide = df.agg(
        *[F.sum(F.col(c).cast("long")).alias(f"n_{c}") for c in causes],
        *[
            F.sum(((F.col(c) == 1) & (F.col(target) == 1)).cast("long")).alias(f"f_{c}")
            for c in causes
        ],
    )
    packed = F.array(*[
        F.struct(
            F.lit(c).alias("cause"), F.col(f"n_{c}").alias("marked"),
            F.col(f"f_{c}").alias("failed"),
        )
        for c in causes
    ])
    return (
        wide.select(F.explode(packed).alias("p")).select("p.*")
        .withColumn("hit_rate", F.round(F.try_divide(F.col("failed") * 100, F.col("marked")), 1))
    )


def key_uniqueness(df: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """Rows against distinct values of each candidate key, over one shuffle of key hashes.

    Copies are counted map-side, so a key repeated in a third of the rows costs one entry.
    """
    pairs = F.array(*[
        F.struct(
            F.lit(name).alias("key"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in cols]).alias("v"),
        )
        for name, cols in keys.items()
    ])
    per_value = (
        df.select(F.explode(pairs).alias("p")).select("p.*")
        .groupBy("key", "v").agg(F.count("*").alias("n"))
    )
    return per_value.groupBy("key").agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("distinct_keys"),
        F.max("n").alias("largest_group"),
    ).withColumn("is_unique", F.col("rows") == F.col("distinct_keys"))


def box_stats(
    df: DataFrame, cols: list[str], target: str = C.TARGET, digits: int = 4
) -> DataFrame:
    """Box-plot numbers per column and class: quartiles and the whiskers at 1.5 times the IQR.

    Whiskers end at the outermost values inside the fences.
    """
    classes = [0, 1]
    specs = {
        f"{c}|{k}": F.when(F.col(target) == k, F.col(c)) for c in cols for k in classes
    }
    quartiles = exact_percentiles(df, specs, [0.25, 0.5, 0.75])
    aggs, rows = [], []
    for c in cols:
        for k in classes:
            q1, q2, q3 = quartiles[f"{c}|{k}"]
            if q1 is None:
                continue
            lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
            v = F.when((F.col(target) == k) & F.col(c).between(lo, hi), F.col(c).cast("double"))
            i = len(rows)
            aggs += [F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}")]
            rows.append(F.struct(
                F.lit(c).alias("column"), F.lit(k).alias("class"),
                F.col(f"a{i}").alias("whisker_low"), F.lit(q1).alias("p25"),
                F.lit(q2).alias("p50"), F.lit(q3).alias("p75"),
                F.col(f"b{i}").alias("whisker_high"),
            ))
    if not rows:
        raise ValueError("no values to describe")
    out = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("p")).select("p.*")
    numbers = ["whisker_low", "p25", "p50", "p75", "whisker_high"]
    return out.withColumns({n: F.round(n, digits) for n in numbers})


def quantile_edges(
    df: DataFrame, cols: list[str], parts: int = 4
) -> dict[str, list[float]]:
    """Distinct quantile edges per column, lowest to highest, to nine decimals."""
    probs = [i / parts for i in range(parts + 1)]
    found = exact_percentiles(df, {c: F.col(c) for c in cols}, probs)
    return {c: sorted({round(x, 9) for x in found[c] if x is not None}) for c in cols}


def band_number(col: str, edges: list[float]) -> Column:
    """1-based quantile band: right-closed intervals; the outer bands are open."""
    x = F.col(col).cast("double")
    number = F.lit(1)
    for e in edges[1:-1]:
        number = number + F.when(x > F.lit(e), 1).otherwise(0)
    return F.when(x.isNotNull(), number)


def band_labels(edges: list[float]) -> list[str]:
    """Readable band names: one decimal when the values span less than 50, else none."""
    if len(edges) < 2:
        return [f"{e:.1f}" for e in edges]
    digits = 1 if edges[-1] - edges[0] < 50 else 0
    return [f"{a:.{digits}f}–{b:.{digits}f}" for a, b in zip(edges, edges[1:], strict=False)]


def quantile_bands(df: DataFrame, cols: list[str], parts: int = 4) -> DataFrame:
    """Rows, smallest and largest value per quantile band of each column, in band order."""
    edges = quantile_edges(df, cols, parts)
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"), band_number(c, edges[c]).alias("band_no"),
            F.col(c).cast("double").alias("v"),
        )
        for c in cols
    ])
    label = F.create_map(*[
        x for c in cols for i, name in enumerate(band_labels(edges[c]), 1)
        for x in (F.lit(f"{c}|{i}"), F.lit(name))
    ])
    return (
        df.select(F.explode(cells).alias("x")).select("x.*").where("band_no is not null")
        .groupBy("column", "band_no")
        .agg(
            F.count("*").alias("rows"),
            F.round(F.min("v"), 6).alias("smallest"),
            F.round(F.max("v"), 6).alias("largest"),
        )
        .withColumn("label", label[F.concat_ws("|", "column", F.col("band_no").cast("string"))])
    )

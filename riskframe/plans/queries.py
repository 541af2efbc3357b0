"""The registered queries: each operator applied to the views over the given tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.functions import decision, features
from riskframe.functions.ordering import numbered_rows
from riskframe.functions.times import utc_day, utc_wall
from riskframe.operators import (
    bootstrap,
    contribution,
    contract,
    drift,
    forest,
    metrics,
    models,
    predlog,
    profiling,
    promotion,
    scenarios,
    slicing,
    splits,
    thresholds,
)
from riskframe.session import stage, work_path
from riskframe.sources import ingest, stores, tables
from riskframe.streaming import drift_stream, log_stream

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ---- decisions, metrics, costs, thresholds --------------------------------------------------


@query
def alarm_decision(spark, folder):
    return tables.scored_states(spark, folder).select(
        "state_id", "probability", decision.alarm().alias("alarm")
    )


@query
def error_kind(spark, folder):
    return tables.scored_states(spark, folder).select(
        "state_id", decision.error_kind(C.TARGET, decision.alarm()).alias("error_kind")
    )


@query
def confusion_counts(spark, folder):
    return metrics.confusion_counts(tables.scored_states(spark, folder))


@query
def expected_cost(spark, folder):
    return metrics.cost_summary(tables.scored_states(spark, folder))


@query
def average_precision(spark, folder):
    return metrics.average_precision(tables.scored_states(spark, folder))


@query
def roc_auc(spark, folder):
    return metrics.roc_auc(tables.scored_states(spark, folder))


@query
def evaluate_scores(spark, folder):
    return metrics.evaluate(tables.scored_states(spark, folder))


@query
def score_distribution(spark, folder):
    return metrics.score_distribution(tables.scored_states(spark, folder))


@query
def cost_curve(spark, folder):
    return thresholds.cost_curve(tables.scored_states(spark, folder))


@query
def best_threshold(spark, folder):
    return thresholds.best_threshold(thresholds.cost_curve(tables.scored_states(spark, folder)))


@query
def threshold_comparison(spark, folder):
    return thresholds.threshold_comparison(tables.scored_states(spark, folder))


@query
def break_even(spark, folder):
    return thresholds.break_even(tables.scored_states(spark, folder))


# ---- sources, projections -------------------------------------------------------------------


def _raw_view(spark, folder):
    return tables.machine_states(spark, folder).withColumns({
        "udi": F.col("l_partkey").cast("long"),
        "product_id": F.concat("type", F.col("l_partkey").cast("string")),
    })


@query
def raw_ingest(spark, folder):
    path = work_path(spark, "raw")
    written = ingest.write_raw(_raw_view(spark, folder), path)
    return ingest.load_raw(spark, path, expected_rows=written)


@query
def file_hashes(spark, folder):
    return ingest.file_hashes(spark, folder, "*.parquet")


@query
def table_fingerprint(spark, folder):
    df = tables.machine_states(spark, folder)
    return ingest.table_fingerprint(df, ["state_id", "type", "tool_wear_min", C.TARGET])


@query
def split_store(spark, folder):
    path = work_path(spark, "splits")
    stores.write_splits(_split_states(spark, folder, *C.INPUT_FIELDS), path)
    return stores.read_split(spark, path, "test").select("state_id", C.TARGET, "split")


@query
def reference_sample(spark, folder):
    path = work_path(spark, "reference")
    val = _split_states(spark, folder, *C.INPUT_FIELDS, C.PROBABILITY).where("split = 'val'")
    stores.write_reference(splits.uniform_sample(val.drop("split")), path)
    return stores.read_reference(spark, path)


@query
def drop_leakage(spark, folder):
    return features.drop_leakage(
        _raw_view(spark, folder).select("state_id", *C.RAW_COLUMNS.values())
    )


@query
def engineered_features(spark, folder):
    df = features.add_engineered(tables.operating_points(spark, folder))
    return df.select("state_id", *[F.round(c, 4).alias(c) for c in C.ENGINEERED])


@query
def one_hot(spark, folder):
    df = tables.operating_points(spark, folder).select("state_id", "type")
    levels = features.category_levels(df, "type")
    return features.one_hot(df, "type", levels)


@query
def standardize(spark, folder):
    df = tables.operating_points(spark, folder).select("state_id", *C.MEASURES)
    return features.standardize(df, C.MEASURES, digits=6)


# ---- contract -------------------------------------------------------------------------------


def _dirty_states(spark, folder):
    """Machine states with violations in the rows of every thousandth part."""
    bad = F.col("l_partkey") % 1000 == 7
    df = tables.machine_states(spark, folder)
    return df.select(
        "state_id",
        F.when(bad, "X").otherwise(F.col("type")).alias("type"),
        "air_temperature_k", "process_temperature_k", "rotational_speed_rpm",
        F.when(bad, -5.0).otherwise(F.col("torque_nm")).alias("torque_nm"),
        F.when(~bad, F.col("tool_wear_min")).alias("tool_wear_min"),
        C.TARGET,
    )


@query
def contract_report(spark, folder):
    return contract.contract_report(_dirty_states(spark, folder))


@query
def contract_broken(spark, folder):
    """A table that breaks the schema checks too: a text measure, an absent column, too many rows."""
    df = _dirty_states(spark, folder).withColumn("torque_nm", F.col("torque_nm").cast("string")).drop("tool_wear_min")
    return contract.contract_report(df, {**C.CONTRACT, "check_row_count": True})


@query
def contract_summary(spark, folder):
    return contract.contract_summary(contract.contract_report(_dirty_states(spark, folder)))


@query
def contract_categories(spark, folder):
    return contract.unexpected_values(_dirty_states(spark, folder))


@query
def quarantine_split(spark, folder):
    df = contract.quarantine(_dirty_states(spark, folder))
    return df.select(
        "state_id", "accepted", F.concat_ws(",", "reject_reasons").alias("reject_reasons")
    )


@query
def row_warnings(spark, folder):
    df = _dirty_states(spark, folder).withColumn("warnings", contract.soft_warnings())
    return df.where(F.size("warnings") > 0).select(
        "state_id", F.concat_ws(",", "warnings").alias("warnings")
    )


@query
def json_field_check(spark, folder):
    events = tables.read_table(spark, folder, "events")
    unknown, missing = contract.json_fields("props", ["k", "unit"])
    checked = events.select("event_id", unknown, missing)
    return checked.select(
        "event_id",
        F.concat_ws(",", "unknown_fields").alias("unknown_fields"),
        F.concat_ws(",", "missing_fields").alias("missing_fields"),
        ((F.size("unknown_fields") == 0) & (F.size("missing_fields") == 0)).alias("accepted"),
    )


# ---- splits and samples ---------------------------------------------------------------------


def _split_states(spark, folder, *cols):
    """Selected columns of the scored states with label and split; stored, as several passes follow."""
    return splits.stratified_split(tables.stored_states(spark, folder, C.TARGET, *cols))


@query
def stratified_split(spark, folder):
    return _split_states(spark, folder).select("state_id", C.TARGET, "split")


@query
def split_overview(spark, folder):
    return splits.split_overview(_split_states(spark, folder))


@query
def split_overlap(spark, folder):
    return splits.split_overlap(features.drop_leakage(_split_states(spark, folder)))


@query
def split_reproducible(spark, folder):
    path = work_path(spark, "splits")
    cols = ["state_id", C.TARGET, "split"]
    stores.write_splits(_split_states(spark, folder).select(*cols), path)
    again = _split_states(spark, folder).select(*cols)
    return splits.split_reproducible(stores.read_split(spark, path).select(*cols), again)


@query
def split_changed(spark, folder):
    """A stored split does not pass for one with another test share."""
    path = work_path(spark, "splits")
    cols = ["state_id", C.TARGET, "split"]
    states = tables.stored_states(spark, folder, C.TARGET)
    stores.write_splits(splits.stratified_split(states).select(*cols), path)
    again = splits.stratified_split(states, test=0.2).select(*cols)
    return splits.split_reproducible(stores.read_split(spark, path).select(*cols), again)


@query
def uniform_sample(spark, folder):
    return splits.uniform_sample(
        tables.machine_states(spark, folder).select("state_id", "type", C.TARGET)
    )


@query
def stratified_folds(spark, folder):
    train = _split_states(spark, folder).where("split = 'train'")
    return splits.stratified_folds(train.select("state_id", C.TARGET))


@query
def baseline_rules(spark, folder):
    df = _split_states(spark, folder)
    return metrics.baseline_rules(df.where("split = 'train'"), df.where("split = 'val'"))


@query
def val_test_gap(spark, folder):
    return metrics.metric_gap(_split_states(spark, folder, C.PROBABILITY), "val", "test")


# ---- profiles -------------------------------------------------------------------------------


@query
def column_profile(spark, folder):
    cols = ["state_id", *C.INPUT_FIELDS, C.TARGET]
    return profiling.column_profile(_dirty_states(spark, folder).select(*cols))


@query
def describe_numeric(spark, folder):
    cols = [*C.MEASURES, *C.ENGINEERED]
    return profiling.describe_numeric(tables.stored_states(spark, folder, *cols), cols)


@query
def class_balance(spark, folder):
    return profiling.class_balance(tables.machine_states(spark, folder))


@query
def class_histogram(spark, folder):
    return profiling.class_histogram(tables.machine_states(spark, folder), C.MEASURES)


@query
def failure_rate_by_type(spark, folder):
    return profiling.failure_rate_by(tables.machine_states(spark, folder), "type", C.TYPES)


@query
def correlation_matrix(spark, folder):
    return profiling.correlation_matrix(
        tables.machine_states(spark, folder), [*C.MEASURES, C.TARGET]
    )


@query
def leakage_audit(spark, folder):
    return profiling.leakage_audit(tables.machine_states(spark, folder))


@query
def cause_multiplicity(spark, folder):
    return profiling.cause_multiplicity(tables.machine_states(spark, folder))


@query
def cause_crosstab(spark, folder):
    return profiling.cause_crosstab(tables.machine_states(spark, folder))


@query
def cause_hit_rate(spark, folder):
    return profiling.cause_hit_rate(tables.machine_states(spark, folder))


@query
def key_uniqueness(spark, folder):
    line = tables.read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return profiling.key_uniqueness(
        line, {"order": ["l_orderkey"], "order_line": ["l_orderkey", "l_linenumber"]}
    )


@query
def box_stats(spark, folder):
    cols = ["temp_difference_k", "power_w"]
    return profiling.box_stats(tables.stored_states(spark, folder, C.TARGET, *cols), cols)


BANDED = ["tool_wear_min", "torque_nm", "rotational_speed_rpm", "temp_difference_k", "power_w"]


@query
def quantile_bands(spark, folder):
    return profiling.quantile_bands(tables.stored_states(spark, folder, *BANDED), BANDED)


# ---- error slicing --------------------------------------------------------------------------


def _val_states(spark, folder, *cols):
    return _split_states(spark, folder, C.PROBABILITY, *cols).where("split = 'val'")


def _sliced(spark, folder):
    return slicing.slice_cells(_val_states(spark, folder, "type", *slicing.BANDS.values()))


@query
def attach_causes(spark, folder):
    scored = _val_states(spark, folder).select("state_id", C.PROBABILITY, C.TARGET)
    states = tables.machine_states(spark, folder).select("state_id", *C.CAUSES)
    return slicing.attach_causes(scored, states)


@query
def slice_metrics(spark, folder):
    return slicing.slice_metrics(*_sliced(spark, folder))


@query
def overall_metrics(spark, folder):
    cells, _ = _sliced(spark, folder)
    return slicing.overall_metrics(cells)


@query
def metrics_by_cause(spark, folder):
    return slicing.metrics_by_cause(_val_states(spark, folder, *C.CAUSES))


@query
def cross_metrics(spark, folder):
    cells, labels = _sliced(spark, folder)
    cells = stage(cells, "slice-cells")
    out = None
    for pair in slicing.CROSSES:
        part = slicing.cross_metrics(cells, labels, pair)
        out = part if out is None else out.unionByName(part)
    return out


@query
def worst_slices(spark, folder):
    return slicing.worst_slices(*_sliced(spark, folder))


@query
def document_quality_by_language(spark, folder):
    docs = tables.labelled_documents(spark, folder)
    return profiling.failure_rate_by(docs, "lang", ["de", "en", "es", "fr"], target="quality")


# ---- drift ----------------------------------------------------------------------------------


def _day_text(df, *cols):
    """Days and times as text, so that any two engines' results compare as they are."""
    text = {
        c: F.date_format(utc_wall(c), "yyyy-MM-dd HH:mm:ss") if c == "ts" else F.col(c).cast("string")
        for c in cols
    }
    return df.withColumns(text)


def _drift_pair(spark, folder, shifted: bool = True):
    """Reference and current half of the scored states by key; the current half is shifted."""
    cols = ["state_id", *C.INPUT_FIELDS, C.TARGET, C.PROBABILITY]
    both = tables.stored_states(spark, folder, *cols, "l_linenumber")
    ref, cur = both.where("state_id < '8'"), both.where("state_id >= '8'")
    if shifted:
        cur = _score(cur.withColumns({
            "process_temperature_k": F.col("process_temperature_k") + 3.0,
            "type": F.when(F.col("l_linenumber") >= 4, "H").otherwise(F.col("type")),
        }))
    return ref.select(*cols), cur.select(*cols)


def _score(df):
    """Derived features and the fixed score of rows that have the input fields."""
    featured = features.add_engineered(df).withColumn(
        "temp_difference_k", F.expr(features.rounded("temp_difference_k", 1))
    )
    return featured.withColumn(C.PROBABILITY, tables.fixed_score())


@query
def psi_numeric(spark, folder):
    ref, cur = _drift_pair(spark, folder)
    check = drift.DriftCheck(ref.select(*C.MEASURES), cur.select(*C.MEASURES))
    return check.numeric_summary().select(
        "feature", F.round("psi", 4).alias("psi"), "degenerate_reference"
    )


@query
def psi_categorical(spark, folder):
    ref, cur = _drift_pair(spark, folder)
    counts = drift.category_counts(ref, cur, ["type"])
    return drift.psi_from_counts(counts).select(
        "feature", "ref_rows", "cur_rows", F.round("psi", 4).alias("psi")
    )


@query
def ks_two_sample(spark, folder):
    ref, cur = _drift_pair(spark, folder)
    cols = [*C.MEASURES, C.PROBABILITY]
    check = drift.DriftCheck(ref.select(*cols), cur.select(*cols))
    return check.numeric_summary().select(
        "feature", F.round("statistic", 6).alias("statistic"), F.round("p", 6).alias("p_value")
    )


@query
def ks_exact(spark, folder):
    """Exact p-values for samples of 1,000 reference and 1,500 current rows."""
    ref, cur = _drift_pair(spark, folder)
    cols = [*C.MEASURES, C.PROBABILITY]
    check = drift.DriftCheck(
        splits.uniform_sample(ref, C.SAMPLE_SIZE).select(*cols), splits.uniform_sample(cur, 1500).select(*cols), exact_p=True
    )
    return check.numeric_summary().select(
        "feature", F.round("statistic", 6).alias("statistic"), F.round("p", 9).alias("p_value")
    )


@query
def chi2_homogeneity(spark, folder):
    ref, cur = _drift_pair(spark, folder, shifted=False)
    counts = drift.category_counts(ref, cur, ["type"])
    return drift.chi2_from_counts(counts).select(
        "feature", F.round("statistic", 4).alias("statistic"), "dof",
        F.round("p", 6).alias("p_value"),
    )


@query
def drift_table(spark, folder):
    return drift.drift_table(*_drift_pair(spark, folder))


@query
def operating_metrics(spark, folder):
    return drift.operating_metrics(*_drift_pair(spark, folder))


@query
def drift_verdict(spark, folder):
    return drift.drift_verdict(*_drift_pair(spark, folder))


@query
def drift_confirmed(spark, folder):
    return drift.confirmed(drift.drift_table(*_drift_pair(spark, folder)))


@query
def operating_bands(spark, folder):
    return drift.operating_bands(tables.prediction_log(spark, folder))


#: The model in use was trained on the log's first ten days.
LAST_TRAINING = "2024-01-10"


RUN_COLUMNS = ["probability", "latency_ms", "k"]


def _log_pair(spark, folder):
    """The log's first ten days as reference, and the later days; two spells run slower."""
    day = utc_day("ts")
    slow = day.between("2024-01-14", "2024-01-15") | day.between("2024-01-20", "2024-01-27")
    rows = tables.prediction_log(spark, folder).select(
        "ts", day.alias("day"), "probability", "k",
        F.when(slow, F.col("latency_ms") * 2).otherwise(F.col("latency_ms")).alias("latency_ms"),
    )
    split = F.col("day") <= LAST_TRAINING
    return rows.where(split), rows.where(~split)


def _daily_runs(spark, folder):
    """PSI per later day."""
    return drift.psi_by_run(*_log_pair(spark, folder), "day", RUN_COLUMNS)


@query
def drift_persistent(spark, folder):
    return _day_text(drift.persistent_drift(_daily_runs(spark, folder)), "run")


@query
def retrain_trigger(spark, folder):
    runs = drift.persistent_drift(_daily_runs(spark, folder)).groupBy("run").agg(
        F.bool_or(F.col("persistent_verdict") == "act").alias("persistent_act")
    )
    seen = drift.since_training(
        tables.prediction_log(spark, folder), utc_day("ts"), F.col("failed"), LAST_TRAINING
    )
    return seen.join(runs, "run").select(
        F.col("run").cast("string").alias("run"), "new_rows", "days_since", "persistent_act",
        *drift.retrain_trigger(F.col("new_rows"), F.col("persistent_act"), F.col("days_since")),
    )


CONTRIBUTORS = [*C.MEASURES, "l_linenumber"]


def _later_runs(spark, folder):
    """Reference half of the states, and the other half in eight runs; two features drift in some of them."""
    both = tables.stored_states(spark, folder, *C.INPUT_FIELDS, C.TARGET, "l_linenumber")
    run = F.substring(C.KEY, 1, 1).alias("run")
    cur = both.where("state_id >= '8'").select("*", run).withColumns({
        "l_linenumber": F.when(F.col("run").isin("8", "9", "a", "b"), F.col("l_linenumber") + 4).otherwise(F.col("l_linenumber")),
        "tool_wear_min": F.when(F.col("run") >= "c", F.col("tool_wear_min") + 60).otherwise(F.col("tool_wear_min")),
    })
    return both.where("state_id < '8'"), cur


@query
def permutation_importance(spark, folder):
    ref, _ = _later_runs(spark, folder)
    return contribution.permutation_importance(ref, CONTRIBUTORS, _score, lots=8)


@query
def retrain_contributing(spark, folder):
    """Retraining only for lasting drift of features that the scorer relies on."""
    ref, cur = _later_runs(spark, folder)
    runs = drift.persistent_drift(drift.psi_by_run(ref, cur, "run", CONTRIBUTORS))
    return contribution.contributing_drift(
        runs, contribution.permutation_importance(ref, CONTRIBUTORS, _score, lots=8)
    )


# ---- what-if scenarios ----------------------------------------------------------------------


@query
def scenario_table(spark, folder):
    ref, cur = _drift_pair(spark, folder, shifted=False)
    return scenarios.scenario_table(ref, cur.drop(C.PROBABILITY), _score)


@query
def scenario_silent_found(spark, folder):
    """Torque sensors that read low on one type and high on the others: alarms stay, hits go."""
    uneven = scenarios.Scenario(
        "torque reads 15 % low on type L, 3 % high on the others",
        lambda df: {"torque_nm": F.when(F.col("type") == "L", F.col("torque_nm") * 0.85).otherwise(F.col("torque_nm") * 1.03)},
    )
    ref, cur = _drift_pair(spark, folder, shifted=False)
    tried = {**scenarios.SCENARIOS, "uneven_torque": uneven}
    return scenarios.silent_failure(scenarios.scenario_table(ref, cur.drop(C.PROBABILITY), _score, tried))


@query
def scenario_silent(spark, folder):
    return scenarios.silent_failure(scenario_table(spark, folder))


@query
def scenario_harmless(spark, folder):
    return scenarios.harmless_drift(scenario_table(spark, folder))


@query
def scenario_selfcheck(spark, folder):
    return scenarios.self_check(scenario_table(spark, folder))


# ---- prediction log -------------------------------------------------------------------------


def _records(spark, folder, with_inputs: bool = True):
    """Log records of scored states: time, request and latency derived from the row."""
    after = F.expr("make_dt_interval(cast(l_partkey % 30 as int), 0, l_linenumber)")
    df = tables.scored_states(spark, folder).withColumns({
        "ts": F.lit("2024-01-01T00:00:00Z").cast("timestamp") + after,
        "request_id": F.col("state_id"),
        "row_no": F.lit(0),
        "latency_ms": F.conv(F.substring("state_id", 1, 4), 16, 10).cast("double") / 1000,
        "warnings": contract.soft_warnings(),
    })
    return predlog.log_records(df, model_version="1", with_inputs=with_inputs)


@query
def log_records(spark, folder):
    return _day_text(_records(spark, folder), "ts").select(
        "ts", "request_id", "row_no", "probability", "alarm", "threshold", "model_name",
        "model_version", "latency_ms", F.concat_ws(",", "warnings").alias("warnings"),
        "inputs.torque_nm", "inputs.type",
    )


@query
def log_append(spark, folder):
    records = _records(spark, folder)
    lines, table = work_path(spark, "log-json"), work_path(spark, "log-table")
    for half in (records.where("request_id < '8'"), records.where("request_id >= '8'")):
        predlog.append_json(half, lines)
        predlog.append_table(half, table)
    stats = [
        F.count("*").alias("rows"),
        F.sum(F.col("alarm").cast("int").cast("long")).alias("alarms"),
        F.round(F.sum("probability"), 4).alias("probability_sum"),
    ]
    first = predlog.read_json(spark, lines, records).agg(
        F.lit("json").alias("store"), *stats,
        F.sum(F.size("warnings").cast("long")).alias("warnings"),
    )
    texts = F.from_json("warnings", "array<string>")
    second = spark.read.parquet(table).agg(
        F.lit("table").alias("store"), *stats, F.sum(F.size(texts).cast("long")).alias("warnings"),
    )
    return first.unionByName(second)


@query
def log_to_features(spark, folder):
    flat = _records(spark, folder).withColumn("inputs", F.to_json("inputs"))
    return predlog.features_from_log(flat)


@query
def log_latest(spark, folder):
    return _day_text(predlog.latest_records(
        tables.prediction_log(spark, folder, numbered=True).select(
            "id", "ts", "request_id", "row_no", "probability"
        )
    ), "ts")


@query
def log_daily_stats(spark, folder):
    return _day_text(predlog.daily_stats(tables.prediction_log(spark, folder)), "day")


@query
def log_counters(spark, folder):
    notes = F.array_compact(F.array(
        F.when(F.col("k") < 10, "k<10"), F.when(F.col("latency_ms") > 250, "latency_ms>250")
    ))
    log = tables.prediction_log(spark, folder).withColumn("warnings", notes)
    return predlog.counters(log)


@query
def explode_batches(spark, folder):
    return predlog.explode_batches(predlog.batches(tables.prediction_log(spark, folder, numbered=True)))


def _requests(spark, folder):
    """Scored states as requests: one request per part, rows numbered in key order."""
    df = tables.scored_states(spark, folder).select(
        "state_id", C.PROBABILITY, F.concat(F.lit("part-"), F.col("l_partkey")).alias("request_id")
    )
    return numbered_rows(df, ["request_id"], "state_id", "row_no", lot=F.substring("state_id", 1, 4))


@query
def batch_predictions(spark, folder):
    return predlog.batch_predictions(_requests(spark, folder))


@query
def batch_summary(spark, folder):
    df = tables.scored_states(spark, folder).select(
        F.concat(F.lit("part-"), F.col("l_partkey")).alias("request_id"),
        F.lit(0).alias("row_no"), C.PROBABILITY,
    )
    return predlog.batch_summary(predlog.batch_predictions(df))


# ---- streaming ------------------------------------------------------------------------------


@query
def stream_scored(spark, folder):
    source, out = work_path(spark, "stream-in"), work_path(spark, "stream-out")
    points = _dirty_states(spark, folder).select("state_id", *C.INPUT_FIELDS)
    points.write.json(source)
    stream = log_stream.json_stream(spark, source, points.schema)
    scored = log_stream.score_stream(stream, _score).select(
        "state_id", "accepted", F.concat_ws(",", "reject_reasons").alias("reject_reasons"),
        C.PROBABILITY, "alarm",
    )
    log_stream.finish(log_stream.append_stream(scored, out, work_path(spark, "checkpoint"), "accepted"))
    return spark.read.parquet(out).select(
        "state_id", F.col("accepted").cast("boolean").alias("accepted"), "reject_reasons",
        C.PROBABILITY, "alarm",
    )


@query
def stream_daily_stats(spark, folder):
    source, out = work_path(spark, "stream-in"), work_path(spark, "stream-out")
    checkpoint = work_path(spark, "checkpoint")
    log = tables.prediction_log(spark, folder).select("ts", "probability", "alarm", "latency_ms")
    cut = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    for part in (log.where(cut), log.where(~cut)):  # the second run continues from the first
        part.write.mode("append").json(source)
        stream = log_stream.json_stream(spark, source, log.schema)
        log_stream.finish(
            log_stream.update_stream(log_stream.daily_stats_stream(stream), out, checkpoint)
        )
    return _day_text(log_stream.current_daily_stats(spark, out), "day")


@query
def stream_deduplicated(spark, folder):
    """Records per day of a stream in which many arrive twice, also in a later run, where state must remember them."""
    source, out, checkpoint = (work_path(spark, n) for n in ("stream-in", "stream-out", "checkpoint"))
    log = tables.prediction_log(spark, folder, numbered=True).select("ts", "request_id", "row_no", "probability")
    day = utc_day("ts")
    first, rest = day <= "2024-01-15", day > "2024-01-15"
    parts = [
        log.where(first).unionByName(log.where(first & (F.col("row_no") % 2 == 0))),
        log.where(rest).unionByName(log.where(day == "2024-01-15")),
    ]
    for part in parts:
        part.write.mode("append").json(source)
        stream = log_stream.json_stream(spark, source, log.schema)
        log_stream.finish(log_stream.append_stream(log_stream.deduplicated(stream), out, checkpoint))
    seen = spark.read.schema(log.schema).parquet(out)
    counts = seen.groupBy(day.alias("day")).agg(
        F.count("*").alias("records"), F.round(F.sum("probability"), 4).alias("probability_sum")
    )
    return _day_text(counts, "day")


@query
def stream_drift(spark, folder):
    ref, cur = _drift_pair(spark, folder)
    source, out = work_path(spark, "stream-in"), work_path(spark, "stream-out")
    cols = [*C.INPUT_FIELDS, C.PROBABILITY]
    cur = cur.select(*cols)
    cur.write.json(source)
    stream = log_stream.json_stream(spark, source, cur.schema)
    log_stream.finish(
        log_stream.drift_stream(stream, ref.select(*cols), out, work_path(spark, "checkpoint"))
    )
    return spark.read.parquet(out)


@query
def stream_drift_runs(spark, folder):
    """Daily drift with persistence, from state between micro-batches over three restarts."""
    ref, cur = _log_pair(spark, folder)
    cur = cur.drop("day")
    source, out = work_path(spark, "stream-in"), work_path(spark, "stream-out")
    checkpoint = work_path(spark, "checkpoint")
    ends = ["2024-01-01", "2024-01-16", "2024-01-23", "2025-01-01"]
    for start, end in zip(ends, ends[1:], strict=False):
        part = (F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp"))
        cur.where(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(cur.schema).parquet(source)
        runs = drift_stream.drift_runs(stream, ref, RUN_COLUMNS)
        log_stream.finish(drift_stream.store_runs(runs, out, checkpoint))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.col("run").cast("int"))
    return spark.read.schema(drift_stream.RESULT).parquet(out).select(
        day.cast("string").alias("run"), "feature", F.round("psi", 4).alias("psi"), "verdict", "persistent_verdict"
    )


# ---- gate, ledger, champion, final evaluation -----------------------------------------------

VARIANTS = {
    "heat": ("heat",),
    "overload_power": ("overload", "power"),
    "full": ("heat", "overload", "power"),
    "heat_power": ("heat", "power"),
    "heat_overload": ("heat", "overload"),
}


@query
def quality_gate(spark, folder):
    table = metrics.evaluate(_val_states(spark, folder))
    gated = promotion.quality_gate(table)
    return gated.select(
        "pr_auc", "recall", "cost_eur", F.concat_ws(",", "violations").alias("violations"), "passed"
    )


def _ledger(spark, folder):
    """A ledger with one run per scorer variant, all evaluated in one pass over the split."""
    runs = F.array(*[
        F.struct(
            F.lit(i).alias("run_no"), F.lit(name).alias("run_name"),
            tables.fixed_score(parts=parts).alias(C.PROBABILITY),
        )
        for i, (name, parts) in enumerate(VARIANTS.items(), 1)
    ])
    scored = _val_states(spark, folder, *C.ENGINEERED)
    each = scored.select(C.TARGET, F.explode(runs).alias("r")).select(C.TARGET, "r.*")
    gated = promotion.quality_gate(
        metrics.evaluate(each, by=["run_no", "run_name"]),
        {**C.QUALITY_GATE, "min_recall": 0.5, "max_expected_cost_eur": promotion.cost_limit_for(limit=1000000)},
    )
    params = F.concat(F.lit("scorer="), F.col("run_name"))
    path = work_path(spark, "ledger")
    promotion.append_ledger(promotion.ledger_rows(gated, params, "1"), path)
    return promotion.read_ledger(spark, path)


@query
def run_ledger(spark, folder):
    return _ledger(spark, folder).withColumn("violations", F.concat_ws(",", "violations"))


@query
def run_compare(spark, folder):
    return promotion.run_compare(_ledger(spark, folder), list(VARIANTS))


@query
def gated_promotion(spark, folder):
    return promotion.versions(_ledger(spark, folder))


@query
def champion(spark, folder):
    return promotion.champion(_ledger(spark, folder))


@query
def champion_rollback(spark, folder):
    return promotion.champion(_ledger(spark, folder), back=1)


#: Digits of registered interval ends: their SQL draws other resamples, which agree about as far.
INTERVAL_DIGITS = 2


@query
def bootstrap_ci(spark, folder):
    test = _split_states(spark, folder, C.PROBABILITY).where("split = 'test'")
    return bootstrap.bootstrap_interval(test, digits=INTERVAL_DIGITS)


@query
def final_evaluation(spark, folder):
    return promotion.final_evaluation(
        _split_states(spark, folder, C.PROBABILITY), interval_digits=INTERVAL_DIGITS
    )


# ---- Spark ML -------------------------------------------------------------------------------


def _train_val(spark, folder):
    df = _split_states(spark, folder, *C.INPUT_FIELDS, *C.CAUSES)
    return df.where("split = 'train'"), df.where("split = 'val'")


def _small_forest():
    return models.random_forest(trees=20, depth=8)


@query
def model_scores(spark, folder):
    train, val = _train_val(spark, folder)
    model = models.fit(train, models.random_forest())
    return models.score(model, val).select("state_id", C.PROBABILITY)


@query
def logreg_metrics(spark, folder):
    train, val = _train_val(spark, folder)
    model = models.fit(train, models.logistic_regression(train.count()), scaled=True)
    return models.evaluate(model, val)


@query
def rf_metrics(spark, folder):
    train, val = _train_val(spark, folder)
    return models.evaluate(models.fit(train, models.random_forest()), val)


@query
def balanced_forest_metrics(spark, folder):
    """The published forest's trees, each class-balanced in its own bag."""
    train, val = _train_val(spark, folder)
    return models.evaluate(models.fit(train, forest.BalancedForest()), val)


@query
def gbt_metrics(spark, folder):
    train, val = _train_val(spark, folder)
    return models.evaluate(models.fit(train, models.boosting(rounds=20)), val)


@query
def cv_compare(spark, folder):
    train, _ = _train_val(spark, folder)
    return models.cross_validate(splits.stratified_folds(train), models.candidates())


@query
def random_search(spark, folder):
    train, _ = _train_val(spark, folder)
    space = {**models.search_space("random_forest"), "trees": lambda r: r.randrange(4, 8), "depth": lambda r: r.choice([4, 6])}
    found, _model = models.random_search(
        splits.stratified_folds(train, 3), "random_forest", trials=3, folds=3, space=space
    )
    return found


@query
def feature_importance(spark, folder):
    train, _ = _train_val(spark, folder)
    model = models.fit(train, models.random_forest())
    return models.feature_importance(model, models.feature_names(), spark)


@query
def ablation(spark, folder):
    train, val = _train_val(spark, folder)
    return models.ablation(train, val, _small_forest)


@query
def tree_sweep(spark, folder):
    train, val = _train_val(spark, folder)
    return models.tree_sweep(models.fit(train, models.random_forest()), val, [50, 100, 150])

import pytest
from score_tables import scored
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.operators import forest, metrics, models, promotion, splits


def metric_row(spark, pr_auc, recall, cost):
    return spark.createDataFrame(
        [(pr_auc, recall, cost)], "pr_auc double, recall double, cost_eur double"
    )


@pytest.mark.parametrize(
    ("values", "broken"),
    [
        ((0.75, 0.80, 200000.0), []),
        ((0.9, 0.9, 1000.0), []),
        ((0.74, 0.79, 200001.0), ["pr_auc<0.75", "recall<0.80", "cost_eur>200000.00"]),
        ((None, 0.9, 1.0), ["pr_auc missing"]),
        ((0.647, 0.451, 303400.0), ["pr_auc<0.75", "recall<0.80", "cost_eur>200000.00"]),
    ],
)
def test_gate_lists_every_violation(spark, values, broken):
    r = promotion.quality_gate(metric_row(spark, *values)).first()
    assert r["violations"] == broken and r["passed"] == (not broken)


def test_absent_metric_and_unset_limit(spark):
    row = metric_row(spark, 0.1, 0.9, 1.0).drop("recall")
    r = promotion.quality_gate(row, {"min_recall": 0.8}).first()
    assert r["violations"] == ["recall missing"]


def gated_run(spark, no, pr_auc):
    row = metric_row(spark, pr_auc, 0.9, 1000.0).withColumns({
        "run_no": F.lit(no), "run_name": F.lit(f"run{no}"),
        "rows": F.lit(10).cast("long"), "roc_auc": F.lit(0.9), "precision": F.lit(0.5),
    })
    return promotion.quality_gate(row)


def test_failing_run_leaves_versions_untouched(spark, tmp_path):
    ledger, saved = str(tmp_path / "ledger"), []
    for no, ap in ((1, 0.8), (2, 0.9), (3, 0.1)):
        promotion.promote(
            spark, gated_run(spark, no, ap), ledger, saved.append, str(tmp_path / "m"),
            F.lit("x"), "1",
        )
    promotion.append_ledger(promotion.failed_run(spark, 4, "run4", "no data", "1"), ledger)
    rows = promotion.read_ledger(spark, ledger)
    assert rows.count() == 4 and len(saved) == 2
    assert rows.where("status like 'failed%'").first()["run_no"] == 4
    assert promotion.champion(rows).first()["run_no"] == 2
    assert promotion.champion(rows, back=1).first()["run_no"] == 1
    compared = promotion.run_compare(rows, ["run1", "run3"]).where("metric = 'pr_auc'").first()
    assert (compared["run1"], compared["run3"]) == (0.8, 0.1)


def test_final_evaluation_runs_once(spark, tmp_path):
    y = [1, 0, 0, 1] * 20
    p = [0.9, 0.01, 0.2, 0.03] * 20
    df = scored(spark, y, p).withColumn("split", F.when(F.rand(1) < 0.5, "val").otherwise("test"))
    df = spark.createDataFrame(df.collect(), df.schema)
    path = str(tmp_path / "final")
    first = promotion.final_evaluation_once(df, path, draws=20)
    assert first.count() == 1 and first.first()["first_run"]
    with pytest.raises(RuntimeError):
        promotion.final_evaluation_once(df, path, draws=20)
    with pytest.raises(ValueError):
        promotion.final_evaluation_once(df, path, force=True, draws=20)
    again = promotion.final_evaluation_once(df, path, force=True, reason="new labels", draws=20)
    assert again.where("repeat_reason = 'new labels'").count() == 1


@pytest.fixture(scope="module")
def labelled(spark):
    n = F.col("id")
    df = spark.range(1200).select(
        F.md5(n.cast("string")).alias("state_id"),
        F.element_at(F.array(F.lit("L"), F.lit("M"), F.lit("H")), (n % 3 + 1).cast("int")).alias("type"),
        (295 + n % 9).cast("double").alias("air_temperature_k"),
        (304 + n % 9 + n % 4).cast("double").alias("process_temperature_k"),
        (1200 + (n * 37) % 1500).cast("int").alias("rotational_speed_rpm"),
        (5 + (n * 13) % 60).cast("double").alias("torque_nm"),
        ((n * 7) % 250).cast("int").alias("tool_wear_min"),
        *[F.lit(0).alias(c) for c in C.CAUSES],
    ).withColumn(C.TARGET, F.when(F.col("tool_wear_min") * F.col("torque_nm") > 9000, 1).otherwise(0))
    split = splits.stratified_split(df).cache()
    return split.where("split = 'train'"), split.where("split = 'val'")


def test_forest_scores_and_sweep(spark, labelled, tmp_path):
    train, val = labelled
    model = models.fit(train, models.random_forest(trees=6, depth=5, min_leaf=1))
    scores = models.score(model, val)
    assert scores.where("probability < 0 or probability > 1 or probability is null").count() == 0
    unknown = val.withColumn("type", F.lit("Z")).select(*reversed(val.columns))
    assert models.score(model, unknown).count() == val.count()
    whole = metrics.average_precision(scores).first()["pr_auc"]
    assert whole > 0.8
    sweep = {r["trees"]: r["pr_auc"] for r in models.tree_sweep(model, val, [2, 6]).collect()}
    assert sweep[6] == pytest.approx(whole, abs=2e-3)
    assert isinstance(model.stages[-1], RandomForestClassificationModel)
    table = models.feature_importance(model, models.feature_names(), spark).collect()
    assert table[0]["feature"] == "wear_torque_min_nm"
    assert sum(r["importance"] for r in table) == pytest.approx(1)
    model.write().overwrite().save(str(tmp_path / "m"))
    from pyspark.ml import PipelineModel

    back = PipelineModel.load(str(tmp_path / "m"))
    assert sorted(models.score(back, val).collect()) == sorted(scores.collect())


def test_derived_features_help_and_weights_balance(labelled):
    train, val = labelled
    rows = {r["variant"]: r["pr_auc"] for r in models.ablation(
        train, val, lambda: models.random_forest(trees=5, depth=4)).collect()}
    assert rows["derived"] >= rows["raw"]
    w = models.with_class_weights(train).groupBy(C.TARGET).agg(F.sum("balanced_weight").alias("w"))
    a, b = (r["w"] for r in w.collect())
    assert a == pytest.approx(b)


def test_search_and_cross_validation(labelled):
    train, _ = labelled
    folded = splits.stratified_folds(train, 2)
    table, best = models.random_search(
        folded, "logistic_regression", trials=2, folds=2,
        space={"c": lambda r: 0.01 * 10 ** (3 * r.random()), "weight": lambda r: r.choice(models.WEIGHTS)},
    )
    rows = table.collect()
    assert len(rows) == 2 and rows[0]["mean"] >= rows[1]["mean"]
    assert best.stages
    compared = models.cross_validate(
        folded, {"lr": (lambda t: models.logistic_regression(t.count(), max_iter=20), True)}, folds=2
    ).first()
    assert compared["worst_fold"] <= compared["mean"] <= compared["best_fold"]
    with pytest.raises(ValueError):
        models.search_space("svm")


def test_bags_are_poisson_and_differ_by_tree(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias(C.KEY))
    row = df.agg(
        *[F.avg(forest.bag_weight(t)).alias(f"m{t}") for t in (0, 1)],
        F.avg((forest.bag_weight(0) == 0).cast("int")).alias("none"), F.max(forest.bag_weight(0)).alias("most"),
        F.corr(forest.bag_weight(0), forest.bag_weight(1)).alias("r"),
    ).first()
    assert row["m0"] == pytest.approx(1, abs=0.03) and row["m1"] == pytest.approx(1, abs=0.03)
    assert row["none"] == pytest.approx(0.3679, abs=0.015) and 5 <= row["most"] <= 10 and abs(row["r"]) < 0.03


def test_balanced_forest_is_one_saved_model(spark, labelled, tmp_path):
    train, val = labelled
    rare = train.where((F.col(C.TARGET) == 0) | (F.col("tool_wear_min") % 5 == 0))  # few positives
    model = models.fit(rare, forest.BalancedForest(trees=4, depth=5, min_leaf=1))
    scores = models.score(model, val)
    assert scores.where("probability < 0 or probability > 1 or probability is null").count() == 0
    assert metrics.average_precision(scores).first()["pr_auc"] > 0.7
    models.save_model(model, str(tmp_path / "m"), 0.5)
    back, _ = models.load_model(spark, str(tmp_path / "m"))
    assert sorted(models.score(back, val).collect()) == sorted(scores.collect())
    # stumps score near the class rate, stumps of balanced bags near one half
    plain, even = (
        models.score(models.fit(rare, make(trees=3, depth=1, min_leaf=1)), val).agg(F.avg("probability")).first()[0]
        for make in (models.random_forest, forest.BalancedForest)
    )
    assert even > 1.5 * plain


def test_search_settings_become_estimators(labelled):
    import random

    draw = random.Random(3)
    for name in C.SEARCH_RANGES:
        space = models.search_space(name)
        kinds = set()
        for _ in range(12):
            settings = {k: f(draw) for k, f in space.items()}
            made = models.estimator(name, settings, 1000)
            kinds.add(type(made).__name__)
            if hasattr(made, "getWeightCol"):
                assert made.getWeightCol() == settings["weight"]
            if name == "boosting":
                assert made.getFeatureSubsetStrategy() == settings["share"] and 0.6 <= float(settings["share"]) <= 1
        assert len(kinds) == (2 if name == "random_forest" else 1)
    row = models.with_class_weights(labelled[0]).groupBy(C.TARGET).agg(F.max("sqrt_weight"), F.max("ratio_weight"), F.count("*")).collect()
    by = {r[0]: r[1:] for r in row}
    ratio = by[0][2] / by[1][2]
    assert by[1][:2] == (pytest.approx(ratio**0.5), pytest.approx(ratio)) and by[0][:2] == (1.0, 1.0)


def test_average_precision_evaluator_equals_metric(labelled):
    train, val = labelled
    model = models.fit(train, models.random_forest(trees=3, depth=3))
    by_evaluator = models.AveragePrecision().evaluate(model.transform(val))
    assert by_evaluator == pytest.approx(
        metrics.average_precision(models.score(model, val)).first()["pr_auc"], abs=1e-6
    )


def test_training_run_end_to_end(spark, labelled, tmp_path):
    from riskframe.plans.training import train_run
    from riskframe.sources.stores import read_reference

    states = labelled[0].unionByName(labelled[1]).drop("split")
    store = str(tmp_path / "store")
    forest = models.random_forest(trees=5, depth=6, min_leaf=1)
    loose = {"min_pr_auc": 0.5}
    assert train_run(states, store, 1, "first", forest, limits=loose)
    assert not train_run(states, store, 2, "second", forest, limits={"min_pr_auc": 1.01})
    with pytest.raises(ValueError, match="contract"):
        train_run(states.withColumn("torque_nm", F.lit(-1.0)), store, 3, "third", forest)
    ledger = {r["run_no"]: r for r in promotion.read_ledger(spark, store + "/ledger").collect()}
    assert ledger[1]["passed"] and not ledger[2]["passed"]
    # every run, also the failed one, tells how long its steps took and on which data
    assert set(ledger[1]["step_seconds"]) == {"fingerprint", "contract", "split", "fit", "evaluate"}
    assert set(ledger[3]["step_seconds"]) == {"fingerprint", "contract"}
    assert ledger[1]["fingerprint"] == ledger[2]["fingerprint"] != ledger[3]["fingerprint"]
    assert all(v >= 0 for v in ledger[2]["step_seconds"].values())
    assert ledger[3]["status"].startswith("failed") and ledger[2]["pr_auc"] == ledger[1]["pr_auc"]
    model, threshold = models.load_model(spark, f"{store}/models/version=1")
    assert threshold == C.THRESHOLD
    sample = read_reference(spark, store + "/reference")
    assert set(C.INPUT_FIELDS) | {C.TARGET, C.PROBABILITY} <= set(sample.columns)
    assert not set(sample.columns) & set(C.CAUSES)
    again = {r["state_id"]: r["probability"] for r in models.score(model, sample).collect()}
    assert again == {r["state_id"]: r["probability"] for r in sample.collect()}

import math
import random

import pytest
from pyspark.sql import functions as F

from patronlens import contract as C
from patronlens.operators import scoring
from patronlens.operators.dataset import with_class_weight
from patronlens.operators.engineered import Thresholds, fit_thresholds, model_matrix, threshold_table
from patronlens.plans import training
from patronlens.shared import new_path, spread, write_table
from patronlens.sources import sql_functions
from patronlens.sources.model_store import ModelStore
from patronlens.sources.warehouse import Warehouse
from tests import samples

THRESHOLDS = Thresholds(3000.0, 20.0)
LINEAR = scoring.LinearModel(tuple(round(random.Random(i).uniform(-0.02, 0.02), 4) for i in range(12)), 0.1)


@pytest.fixture(scope="module")
def features(spark):
    return samples.features(spark, samples.feature_rows(300, label=lambda days, rng: rng.random() < days / 365)).cache()


@pytest.fixture(scope="module")
def forest(spark, features):
    matrix = training.pipeline_inputs(model_matrix(features, THRESHOLDS))
    settings = training.TrainingSettings(trees=8, depth=4)
    return training.candidate_pipeline(training.FOREST, 300, settings).fit(with_class_weight(matrix))


def odd_rows(features):
    """One ordinary row, one with nulls, one with a NaN."""
    first = features.orderBy("user_id").limit(1)
    nulls = first.withColumn("age", F.lit(None).cast("int")).withColumn("total_spent", F.lit(None).cast("double"))
    nan = first.withColumn("recency_score", F.lit(math.nan))
    return first.union(nulls).union(nan)


def test_fixed_model_by_hand(spark, features):
    row = scoring.score_features(features, scoring.ChurnModel("LogisticRegression", THRESHOLDS, LINEAR)).first()
    inputs = [float(value) for value in model_matrix(features, THRESHOLDS).where(F.col("user_id") == row["user_id"]).first()[1:13]]
    margin = LINEAR.intercept + sum(w * x for w, x in zip(LINEAR.weights, inputs))
    assert row["churn_probability"] == pytest.approx(1 / (1 + math.exp(-margin)), rel=1e-12)
    assert row["churn_prediction"] == (row["churn_probability"] > 0.5)


def test_probability_of_exactly_one_half_is_no_churn(features):
    nothing = scoring.LinearModel((0.0,) * 12, 0.0)
    scored = scoring.score_features(features, scoring.ChurnModel("LogisticRegression", THRESHOLDS, nothing))
    assert scored.where("churn_probability != 0.5 OR churn_prediction").count() == 0


@pytest.mark.parametrize("kind", ["linear", "forest"])
def test_null_is_zero_and_nan_is_unscorable(features, forest, kind):
    if kind == "linear":
        model = scoring.ChurnModel("LogisticRegression", THRESHOLDS, LINEAR)
    else:
        model = scoring.ChurnModel("RandomForest", THRESHOLDS, pipeline=forest)
    plain, nulls, nan = scoring.score_features(odd_rows(features), model).collect()
    zeros = odd_rows(features).fillna(0, ["age", "total_spent"]).limit(2)
    assert nulls["churn_probability"] == scoring.score_features(zeros, model).collect()[1]["churn_probability"]
    assert plain["churn_probability"] not in (0.5, nulls["churn_probability"])
    assert (nan["churn_probability"], nan["churn_prediction"]) == (0.5, False)
    assert nulls["age"] is None  # the feature columns stay as they were
    assert scoring.score_features(features, model).columns == [*features.columns, "churn_probability", "churn_prediction"]


def test_scoring_runs_no_python(features, forest):
    for model in (
        scoring.ChurnModel("LogisticRegression", THRESHOLDS, LINEAR),
        scoring.ChurnModel("RandomForest", THRESHOLDS, pipeline=forest),
    ):
        plan = scoring.score_features(features, model)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange" not in plan


def test_sql_functions_and_view_equal_the_expression(spark, features):
    warehouse = Warehouse(spark, "scoring_test_", new_path(spark, "warehouse")).create()
    stored = warehouse.save(features.union(odd_rows(features)), "features", "user_features")
    thresholds = fit_thresholds(stored)
    warehouse.save(threshold_table(stored), "features", "thresholds")
    sql_functions.create_sql_functions(spark, "scoring_test_ml_models", LINEAR)
    view = sql_functions.create_prediction_view(
        spark,
        "scoring_test_ml_models.predictions",
        "scoring_test_features.user_features",
        "scoring_test_features.thresholds",
        "scoring_test_ml_models",
    )
    expected = scoring.score_features(stored, scoring.ChurnModel("LogisticRegression", thresholds, LINEAR))
    assert view.columns == expected.columns
    compare = ["user_id", "churn_probability", "churn_prediction"]
    assert sorted(view.select(compare).collect()) == sorted(expected.select(compare).collect())
    assert "Python" not in view._jdf.queryExecution().executedPlan().toString()

    zeros = ", ".join(["0"] * 12)
    half = "scoring_test_ml_models.predict_churn"
    margin = spark.sql(f"SELECT {half}_probability({zeros}) p, {half}_binary({zeros}) b, {half}({zeros}) c").first()
    assert margin == (pytest.approx(1 / (1 + math.exp(-0.1))), True, True)


def test_unknown_thresholds_flag_nobody_in_sql(spark, features):
    features.createOrReplaceTempView("unlimited_rows")
    threshold_table(features.limit(0)).createOrReplaceTempView("no_limits")
    arguments = sql_functions.model_arguments("no_limits").split(", CASE ")
    flags = ["CASE " + part.split(", ")[0] for part in arguments if "_p80" in part]
    assert len(flags) == 2
    assert spark.sql(f"SELECT coalesce((SELECT max(total_spent_p80) FROM no_limits), double('inf')) > 1e300D").first()[0]
    text = sql_functions.prediction_query("unlimited_rows", "no_limits")
    sql_functions.deploy_functions(spark, "default", scoring.ChurnModel("LogisticRegression", THRESHOLDS, LINEAR))
    expected = scoring.score_features(features, scoring.ChurnModel("x", Thresholds(math.inf, math.inf), LINEAR))
    assert sorted(spark.sql(text).select("user_id", "churn_probability").collect()) == sorted(
        expected.select("user_id", "churn_probability").collect()
    )


@pytest.fixture(scope="module")
def boosted(spark, features):
    matrix = training.pipeline_inputs(model_matrix(features, THRESHOLDS))
    return training.candidate_pipeline(training.BOOSTED, 300, training.TrainingSettings(trees=4)).fit(with_class_weight(matrix))


def test_names_always_call_the_model_deployed_last(spark, features, forest, boosted):
    rows = spark.read.parquet(write_table(features.union(odd_rows(features)), "rows"))
    rows.createOrReplaceTempView("deployed_rows")
    threshold_table(features).createOrReplaceTempView("deployed_limits")
    limits = fit_thresholds(features)
    linear = scoring.ChurnModel("LogisticRegression", limits, LINEAR)
    trees = scoring.ChurnModel("RandomForest", limits, pipeline=forest)
    steps = scoring.ChurnModel("GradientBoostedTrees", limits, pipeline=boosted)
    arguments = sql_functions.model_arguments("deployed_limits")
    for model in (linear, trees, steps, linear, trees):
        sql_functions.deploy_functions(spark, "default", model)
        want = sorted(scoring.score_features(rows, model).select("user_id", "churn_probability", "churn_prediction").collect())
        for prefix in ("", "default."):
            called = spark.sql(
                f"SELECT user_id, {prefix}predict_churn_probability({arguments}) p, {prefix}predict_churn_binary({arguments}) b, "
                f"{prefix}predict_churn({arguments}) c FROM deployed_rows"
            )
            got = sorted(called.collect())
            assert [r.p for r in got] == pytest.approx([r.churn_probability for r in want], abs=1e-12)
            assert [(r.b, r.c) for r in got] == [(r.churn_prediction,) * 2 for r in want]
            assert "Python" not in called._jdf.queryExecution().executedPlan().toString()
        kept = [t.name for t in spark.catalog.listTables("default") if t.name.startswith(sql_functions.TREES)]
        assert len(kept) == (model is not linear)


def test_the_view_outlives_every_deployment(spark, features, forest, boosted):
    warehouse = Warehouse(spark, "deployed_test_", new_path(spark, "warehouse")).create()
    stored = warehouse.save(features, "features", "user_features")
    warehouse.save(threshold_table(stored), "features", "thresholds")
    names, schema = ("deployed_test_features.user_features", "deployed_test_features.thresholds"), "deployed_test_ml_models"
    limits = fit_thresholds(stored)
    for model in (scoring.ChurnModel("x", limits, LINEAR), scoring.ChurnModel("x", limits, pipeline=forest)):
        sql_functions.deploy_functions(spark, schema, model)
        view = sql_functions.create_prediction_view(spark, f"{schema}.current", *names, schema)
    # the next model reaches a view that was made before
    model = scoring.ChurnModel("x", limits, pipeline=boosted)
    sql_functions.deploy_functions(spark, schema, model)
    compare = ["user_id", "churn_probability", "churn_prediction"]
    got, want = (sorted(df.select(compare).collect()) for df in (spark.table(f"{schema}.current"), scoring.score_features(stored, model)))
    assert [r[::2] for r in got] == [r[::2] for r in want]
    assert [r[1] for r in got] == pytest.approx([r[1] for r in want], abs=1e-12)
    assert view.columns == [*features.columns, "churn_probability", "churn_prediction"]


def test_leaves_of_stored_trees_lead_to_themselves(spark, forest):
    """So a step of a walk is one comparison, without asking whether it is at a leaf."""
    trees = sql_functions.tree_table(spark, forest).first()["trees"]
    assert len(trees) == 8
    for tree, own in zip(trees, forest.stages[-1].trees):
        leaves = [i for i, (left, right) in enumerate(zip(tree["left"], tree["right"])) if left == right]
        assert leaves == [i for i in leaves if tree["left"][i] == i] and len(tree["left"]) == own.numNodes == 2 * len(leaves) - 1
        assert min(tree["feature"]) >= 0


def test_costly_rows_are_spread_over_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == cores
    wide = spark.range(10).repartition(cores + 3)
    assert spread(wide) is wide


def test_two_runs_never_publish_one_version(spark):
    root = new_path(spark, "models")
    first, second = ModelStore(spark, root), ModelStore(spark, root)
    taken = [first._new_version(), second._new_version()]  # both saw an empty registry
    assert taken == [1, 2]
    assert first.publish(scoring.ChurnModel("LogisticRegression", THRESHOLDS, LINEAR)) == 3


def test_model_store_round_trip(spark, features, forest):
    store = ModelStore(spark, new_path(spark, "models"))
    assert store.latest() is None
    linear = scoring.ChurnModel("LogisticRegression", THRESHOLDS, LINEAR)
    assert store.publish(linear) == 1
    assert store.latest() == linear
    tree = scoring.ChurnModel("RandomForest", Thresholds(1.0, math.inf), pipeline=forest)
    assert store.publish(tree) == 2
    loaded = store.latest()
    assert (loaded.model_type, loaded.thresholds, loaded.linear) == ("RandomForest", tree.thresholds, None)
    assert scoring.score_features(features, loaded).collect() == scoring.score_features(features, tree).collect()


def test_scoring_sample_and_summary(features):
    predictions = scoring.score_features(features, scoring.ChurnModel("LogisticRegression", THRESHOLDS, LINEAR))
    assert [row["user_id"] for row in scoring.scoring_sample(predictions).collect()] == list(range(1, 11))
    summary = scoring.prediction_summary(predictions).first()
    assert summary["total_customers"] == 300
    assert summary["predicted_churned"] == predictions.where("churn_probability > 0.5").count()
    assert scoring.prediction_summary(predictions.limit(0)).first() == (0, 0, 0, None)


def test_a_step_of_a_walk_reads_one_number_and_one_comparison(spark, forest, boosted):
    for fitted in (forest, boosted):
        trees = sql_functions.tree_table(spark, fitted).first()["trees"]
        walk = sql_functions.walk_of(trees)
        made = {(f, t) for tree in trees for i, (f, t) in enumerate(zip(tree["feature"], tree["threshold"])) if tree["left"][i] != i}
        assert len(walk.comparisons) == len(made) and set(walk.comparisons) == made  # each once, however many nodes make it
        assert 1 <= walk.depth <= fitted.stages[-1].getMaxDepth() and walk.kind == "INT"
        draw = random.Random(1)
        for _ in range(50):
            x = [draw.choice([0.0, 1.0, draw.uniform(0, 400), draw.uniform(0, 20_000), math.inf]) for _ in C.MODEL_FEATURES]
            above = [0, *[int(not x[f] <= t) for f, t in walk.comparisons]]
            for tree, nodes, values in zip(trees, walk.nodes, walk.values, strict=True):
                at = 0
                while tree["left"][at] != at:
                    at = tree["left"][at] if x[tree["feature"][at]] <= tree["threshold"][at] else tree["right"][at]
                n = nodes[0]
                for _ in range(walk.depth):
                    n = nodes[n >> walk.bits | above[n & 2**walk.bits - 1]]
                assert values[n >> walk.bits] == tree["value"][at]


def test_walks_of_large_trees_use_long_numbers(spark, features, forest, monkeypatch):
    wide = sql_functions.Walk([[0] * 9], [[0.0] * 9], [], 28, 1)
    assert wide.kind == "BIGINT"
    rows = spark.read.parquet(write_table(features.union(odd_rows(features)), "rows"))
    rows.createOrReplaceTempView("long_rows")
    threshold_table(features).createOrReplaceTempView("long_limits")
    model = scoring.ChurnModel("RandomForest", fit_thresholds(features), pipeline=forest)
    called = f"SELECT user_id, predict_churn_probability({sql_functions.model_arguments('long_limits')}) p FROM long_rows"
    sql_functions.deploy_functions(spark, "default", model)
    short = sorted(spark.sql(called).collect())
    monkeypatch.setattr(sql_functions.Walk, "kind", "BIGINT")
    sql_functions.deploy_functions(spark, "default", model)
    assert sorted(spark.sql(called).collect()) == short


def test_trees_without_a_split_are_walked(spark, features):
    matrix = with_class_weight(training.pipeline_inputs(model_matrix(features, THRESHOLDS)).where("label = 0"))
    pipeline = training.candidate_pipeline(training.FOREST, 100, training.TrainingSettings(trees=3))
    bare = training.fit_forest(matrix, [f"_in_{name}" for name in C.MODEL_FEATURES], pipeline)
    assert bare.stages[-1].totalNumNodes == 3
    sql_functions.deploy_functions(spark, "default", scoring.ChurnModel("RandomForest", THRESHOLDS, pipeline=bare))
    zeros = ", ".join(["0"] * 12)
    assert spark.sql(f"SELECT predict_churn_probability({zeros}) p, predict_churn({zeros}) c").first() == (0.0, False)

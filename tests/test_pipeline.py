import datetime as dt

import pytest

from patronlens import contract as C
from patronlens.operators.engineered import Thresholds, fit_thresholds
from patronlens.operators.scoring import ChurnModel, LinearModel, score_features
from patronlens.plans.pipeline import run_daily
from patronlens.plans.training import BOOSTED, LOGISTIC, TrainingSettings
from patronlens.shared import new_path, write_table
from patronlens.sources.csv_files import write_csv
from patronlens.sources.model_store import ModelStore
from patronlens.sources.sql_functions import prediction_query
from patronlens.sources.warehouse import Warehouse
from patronlens.streaming import jobs
from tests import samples

MONDAY, TUESDAY = dt.date(2024, 7, 1), dt.date(2024, 7, 2)
QUICK = TrainingSettings(candidates=(LOGISTIC,), folds=0)


@pytest.fixture(scope="module")
def landed(spark):
    users = samples.users(spark, [(i, 18 + i % 53, C.SEGMENTS[i % 3]) for i in range(1, 301)])
    rows = [(i, 1 + i * 7 % 290, i % 90 + 0.5, i * 13 % 300, C.PAYMENT_METHODS[i % 4]) for i in range(1, 2001)]
    frames = {
        "raw_users": users,
        "raw_products": spark.createDataFrame([(1, "P", "Books", 1.0, "B")], C.RAW_PRODUCTS),
        "raw_transactions": samples.transactions(spark, rows),
    }
    paths = {}
    for table, df in frames.items():
        paths[table] = new_path(spark, table)
        write_csv(df, paths[table])
    return paths


def test_daily_runs(spark, landed):
    warehouse = Warehouse(spark, "pipeline_test_", new_path(spark, "warehouse"))
    models = ModelStore(spark, new_path(spark, "models"))
    first = run_daily(warehouse, models, MONDAY, landed, settings=QUICK)
    assert (first.retrained, first.model_version) == (True, 1)
    assert first.features.count() == 290
    assert first.summary.first()["total_customers"] == 290
    assert first.predictions.columns == [*C.USER_FEATURES, "is_churned", "churn_probability", "churn_prediction"]

    tables = "pipeline_test_features.user_features", "pipeline_test_features.thresholds"
    compared = ["user_id", "churn_probability", "churn_prediction"]
    stored = sorted(first.predictions.select(compared).collect())
    for query in (prediction_query(*tables), prediction_query(*tables, "pipeline_test_ml_models"), f"SELECT * FROM {first.view}"):
        assert sorted(spark.sql(query).select(compared).collect()) == stored

    second = run_daily(warehouse, models, TUESDAY, settings=QUICK)
    assert (second.retrained, second.model_version) == (False, None)
    assert second.features.agg({"days_since_last_transaction": "min"}).first()[0] == 1
    assert first.training.metrics.count() == 1 and second.training is None


def test_scores_follow_the_thresholds_of_the_day(spark, landed):
    """Monday's model, Tuesday's amounts doubled: flags and scores are those of Tuesday's table."""
    warehouse = Warehouse(spark, "pipeline_days_", new_path(spark, "warehouse"))
    models = ModelStore(spark, new_path(spark, "models"))
    monday = run_daily(warehouse, models, MONDAY, landed, settings=QUICK)
    doubled = spark.read.schema(C.RAW_TRANSACTIONS).option("header", True).csv(landed["raw_transactions"])
    path = new_path(spark, "doubled")
    write_csv(doubled.withColumn("total_amount", doubled.total_amount * 2), path)
    tuesday = run_daily(warehouse, models, TUESDAY, {"raw_transactions": path})
    assert tuesday.thresholds.total_spent == 2 * monday.thresholds.total_spent == fit_thresholds(tuesday.features).total_spent
    model = models.latest()
    assert model.thresholds == monday.thresholds
    compared = ["user_id", "churn_probability", "churn_prediction"]
    fresh = sorted(score_features(tuesday.features, model, fit_thresholds(tuesday.features)).select(compared).collect())
    assert sorted(tuesday.predictions.select(compared).collect()) == fresh
    assert sorted(spark.table(tuesday.view).select(compared).collect()) == fresh
    assert sorted(score_features(tuesday.features, model).select(compared).collect()) != fresh  # what a stream would say


def test_landing_only_todays_file_keeps_the_history(spark, landed):
    warehouse = Warehouse(spark, "pipeline_append_", new_path(spark, "warehouse"))
    models = ModelStore(spark, new_path(spark, "models"))
    folder = new_path(spark, "landing")
    rows = spark.read.schema(C.RAW_TRANSACTIONS).option("header", True).csv(landed["raw_transactions"])
    inbox = {"raw_users": landed["raw_users"], "raw_transactions": f"{folder}/*"}
    write_csv(rows.where("transaction_id <= 1500"), f"{folder}/monday")

    def transactions_seen(day):  # the features are replaced by the next run
        run = run_daily(warehouse, models, day, inbox, settings=QUICK, append=True)
        return run.features.agg({"total_transactions": "sum"}).first()[0]

    assert transactions_seen(MONDAY) == 1500
    write_csv(rows.where("transaction_id > 1500"), f"{folder}/tuesday")
    assert transactions_seen(TUESDAY) == 2000
    assert transactions_seen(TUESDAY) == 2000
    whole = Warehouse(spark, "pipeline_whole_", new_path(spark, "warehouse")).create()
    whole.load_csv("raw_users", landed["raw_users"])
    with pytest.raises(ValueError, match="as a whole"):
        whole.append_csv("raw_users", landed["raw_users"])


def test_boosted_trees_are_deployed_with_their_view(spark, landed):
    warehouse = Warehouse(spark, "pipeline_boosted_", new_path(spark, "warehouse"))
    models = ModelStore(spark, new_path(spark, "models"))
    run = run_daily(warehouse, models, MONDAY, landed, settings=TrainingSettings(candidates=(BOOSTED,), trees=2, folds=0))
    assert models.latest().model_type == BOOSTED
    compared = ["user_id", "churn_prediction"]
    assert sorted(spark.table(run.view).select(compared).collect()) == sorted(run.predictions.select(compared).collect())


def test_first_run_trains_on_any_day_and_failures_raise(spark, landed):
    warehouse = Warehouse(spark, "pipeline_fail_", new_path(spark, "warehouse"))
    models = ModelStore(spark, new_path(spark, "models"))
    with pytest.raises(RuntimeError, match="no published model"):
        run_daily(warehouse, models, TUESDAY, landed, retrain=False, settings=QUICK)
    assert run_daily(warehouse, models, TUESDAY, settings=QUICK).retrained
    again = run_daily(warehouse, models, TUESDAY, retrain=True, settings=QUICK)
    assert (again.retrained, again.model_version) == (True, 2)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_daily(warehouse, models, TUESDAY, {"raw_users": "/no/such/folder"}, settings=QUICK)


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    features = samples.features(spark, samples.feature_rows(200)).repartition(4)
    folder = write_table(features, "features")
    model = ChurnModel("LogisticRegression", Thresholds(2000.0, 15.0), LinearModel((0.01,) * 12, -0.2))
    target, progress = str(tmp_path / "target"), str(tmp_path / "progress")

    for _ in range(2):  # the second run finds nothing new
        stream = jobs.feature_stream(spark, folder, features.schema, files_per_batch=1)
        jobs.score_stream(stream, model, target, progress)
    assert sorted(spark.read.parquet(target).collect()) == sorted(score_features(features, model).collect())

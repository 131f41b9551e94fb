"""Every operator as a query over the star-schema tables of one folder."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens import contract as C
from patronlens.operators import (
    dataset,
    drift,
    engineered,
    features,
    incremental,
    intervals,
    joins,
    metrics,
    ordered,
    quality,
    reports,
    rollups,
    scoring,
    sketches,
)
from patronlens.plans.pipeline import run_daily
from patronlens.plans.training import (
    BOOSTED,
    FOREST,
    LOGISTIC,
    TrainingResult,
    TrainingSettings,
    as_churn_model,
    gradient_residual,
    train_churn_model,
)
from patronlens.plans.training import feature_importances as importances_of
from patronlens.shared import delete, deleted_afterwards, kept_afterwards, new_path, on_leaving, spread, write_table, written
from patronlens.sources import sql_functions, star
from patronlens.sources.csv_files import read_csv, write_csv
from patronlens.sources.feature_state import FeatureState, Fold
from patronlens.sources.model_store import ModelStore
from patronlens.sources.reconciliation import reconcile
from patronlens.sources.warehouse import Warehouse, lower_case_columns
from patronlens.streaming import activity, jobs

AS_OF = dt.date(2001, 8, 2)  # the day after the newest order

# A logistic model with given coefficients, so that scores can be checked by SQL.
FIXED_MODEL = scoring.LinearModel(
    weights=(0.01, -0.05, -2e-07, 1e-06, 0.002, -0.25, 1e-06, -0.3, -0.2, -2.0, 0.05, -0.6),
    intercept=-0.1,
)


# --- inputs ----------------------------------------------------------------------------------------


def _users(spark: SparkSession, folder: str) -> DataFrame:
    return star.users_from(star.star_table(spark, folder, "customer"), star.star_table(spark, folder, "nation"))


def _profiles(spark: SparkSession, folder: str) -> DataFrame:
    return star.user_profiles_from(star.star_table(spark, folder, "customer"))


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return star.products_from(star.star_table(spark, folder, "part"))


def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    return star.transactions_from(star.star_table(spark, folder, "orders"))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return star.order_lines_from(star.star_table(spark, folder, "lineitem"), star.star_table(spark, folder, "orders"))


def _labeled(spark: SparkSession, folder: str) -> DataFrame:
    plain = features.user_features(
        _profiles(spark, folder), _transactions(spark, folder), AS_OF, star.ORDER_PRIORITIES
    )
    return features.with_churn_label(plain)


def _stored_features(spark: SparkSession, folder: str) -> DataFrame:
    return written(_labeled(spark, folder), "user-features")


def _fixed_model(stored: DataFrame) -> scoring.ChurnModel:
    return scoring.ChurnModel("LogisticRegression", engineered.fit_thresholds(stored), linear=FIXED_MODEL)


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored_features(spark, folder)
    return scoring.score_features(stored, _fixed_model(stored))


def _matrix(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored_features(spark, folder)
    return engineered.model_matrix(stored, engineered.fit_thresholds(stored))


def _stored_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return written(_matrix(spark, folder), "matrix")


def _evaluated(spark: SparkSession, folder: str) -> DataFrame:
    return _predictions(spark, folder).select(
        F.col("is_churned").cast("int").alias("label"),
        F.col("churn_prediction").cast("int").alias("prediction"),
        "churn_probability",
    )


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    """For comparison only: means of fractions and results of ``exp`` may differ in the last bits between engines."""
    return df.withColumns({name: F.round(name, C.SCORE_DECIMALS) for name in columns})


def _scored(df: DataFrame) -> DataFrame:
    return _rounded(df, [name for name in ("recency_score", "churn_probability") if name in df.columns])


# --- sources, sinks, streams -----------------------------------------------------------------------


def csv_gzip_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "transactions-csv")
    transactions = _transactions(spark, folder)
    write_csv(transactions, path)
    return read_csv(spark, path, transactions.schema)


def stream_ingest_available_now(spark: SparkSession, folder: str) -> DataFrame:
    landing, target, progress = (new_path(spark, name) for name in ("landing", "ingested", "ingest-progress"))
    transactions = _transactions(spark, folder)
    write_csv(transactions, landing)
    for _ in range(2):  # the second run finds nothing new
        jobs.ingest_new_files(spark, landing, transactions.schema, target, progress)
    return spark.read.schema(transactions.schema).parquet(target)


def stream_scoring(spark: SparkSession, folder: str) -> DataFrame:
    labeled = _labeled(spark, folder)
    landing = write_table(labeled, "arriving-features")
    stored = spark.read.schema(labeled.schema).parquet(landing)
    target, progress = new_path(spark, "scored"), new_path(spark, "scoring-progress")
    arriving = jobs.feature_stream(spark, landing, labeled.schema)
    jobs.score_stream(arriving, _fixed_model(stored), target, progress)
    return _scored(spark.read.parquet(target))


def saved_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored_features(spark, folder)
    store = ModelStore(spark, new_path(spark, "models"))
    store.publish(_fixed_model(stored))
    return _scored(scoring.score_features(stored, store.latest()))


def _new_warehouse(spark: SparkSession) -> Warehouse:
    warehouse = Warehouse(spark, f"run_{uuid.uuid4().hex}_", new_path(spark, "warehouse")).create()
    on_leaving(warehouse.drop)
    return warehouse


def sql_function_view_scores(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _new_warehouse(spark)
    stored = warehouse.save(_labeled(spark, folder), "features", "user_features")
    warehouse.save(engineered.threshold_table(stored), "features", "thresholds")
    schema = f"{warehouse.prefix}ml_models"
    sql_functions.create_sql_functions(spark, schema, FIXED_MODEL)
    view = sql_functions.create_prediction_view(
        spark,
        warehouse.name("ml_models", "customer_churn_predictions"),
        warehouse.name("features", "user_features"),
        warehouse.name("features", "thresholds"),
        schema,
    )
    return _scored(view)


def raw_table_layouts(spark: SparkSession, folder: str) -> DataFrame:
    """The declared raw tables, created empty, with the rows that the source has for each."""
    warehouse = _new_warehouse(spark)
    warehouse.create_raw_tables()
    sources = {"raw_users": _users, "raw_products": _products, "raw_transactions": _transactions}
    lines = []
    for table, layout in C.RAW_TABLES.items():
        stored = warehouse.table("raw_data", table)
        rows = stored.unionByName(sources[table](spark, folder), allowMissingColumns=True).count()
        lines += [(table, i, f.name, f.dataType.simpleString(), stored.count(), rows) for i, f in enumerate(stored.schema)]
    return spark.createDataFrame(
        lines, "table_name string, position int, column_name string, type string, stored_rows long, source_rows long"
    )


def daily_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files through load, features, training of both candidates and scoring; the stored predictions, with checks
    of the scores in place of the scores, which depend on the training run."""
    landed = {}
    for table, df in (
        ("raw_users", _users(spark, folder)),
        ("raw_products", _products(spark, folder)),
        ("raw_transactions", _transactions(spark, folder)),
    ):
        landed[table] = new_path(spark, table)
        complete = {field.name: F.lit(None).cast(field.dataType) for field in C.RAW_TABLES[table]}
        complete |= {name: F.col(name) for name in df.columns}
        write_csv(df.select([complete[name].alias(name) for name in C.RAW_TABLES[table].names]), landed[table])
    warehouse = _new_warehouse(spark)
    run = run_daily(warehouse, ModelStore(spark, new_path(spark, "models")), AS_OF, landed, append=True)
    view = f"features_{uuid.uuid4().hex}"
    spread(warehouse.table("features", "user_features")).createOrReplaceTempView(view)
    on_leaving(lambda: spark.catalog.dropTempView(view))
    names = view, warehouse.name("features", "thresholds")
    called = spark.sql(sql_functions.prediction_query(*names)).select("user_id", F.col("churn_probability").alias("called"))
    called = written(called, "called")  # so that the walk is a job of its own, not a broadcast with its time limit
    agrees = (F.abs(F.col("churn_probability") - F.col("called")) < 1e-12).alias("function_agrees")
    checked = run.predictions.join(called, "user_id").select("*", *_score_checks(), agrees)
    return _rounded(checked.drop("churn_probability", "churn_prediction", "called"), ["recency_score"])


# --- features that follow the landings ---------------------------------------------------------------

# The reporting dates of three landings.
LANDING_DATES = (dt.date(1999, 12, 31), dt.date(2001, 6, 30), AS_OF)


def _landing() -> Column:
    """When a transaction arrives: with its date, one landing late if it is of low priority, one early (from the day's view a
    transaction of the future) if it is urgent."""
    day = F.to_date("transaction_date")
    regular = F.when(day <= LANDING_DATES[0], 1).when(day <= LANDING_DATES[1], 2).otherwise(3)
    early, late = F.col("payment_method") == "1-URGENT", F.col("payment_method") == "5-LOW"
    return F.when(early, F.greatest(regular - 1, F.lit(1))).when(late, F.least(regular + 1, F.lit(3))).otherwise(regular)


def _folded(spark: SparkSession, folder: str) -> tuple[FeatureState, list[Fold]]:
    """All transactions in three landings, each folded into the stored past of the customers."""
    transactions = _transactions(spark, folder)
    rows, state = new_path(spark, "arriving"), FeatureState(spark, new_path(spark, "state"), usual_methods=tuple(star.ORDER_PRIORITIES))
    folds = []
    for number, as_of in enumerate(LANDING_DATES, start=1):
        transactions.where(_landing() == number).write.mode("append").parquet(rows)
        state.load(rows, transactions.schema)
        folds.append(state.fold(as_of))
    return state, folds


def incremental_user_features(spark: SparkSession, folder: str) -> DataFrame:
    state, _ = _folded(spark, folder)
    return _scored(features.with_churn_label(incremental.user_features_of(_profiles(spark, folder), state.read(), AS_OF)))


def incremental_fold_log(spark: SparkSession, folder: str) -> DataFrame:
    """Per landing: transactions folded, transactions that wait for their day, buckets of customers written anew."""
    _, folds = _folded(spark, folder)
    lines = [(i, as_of, f.folded, f.pending, len(f.buckets)) for i, (as_of, f) in enumerate(zip(LANDING_DATES, folds), start=1)]
    return spark.createDataFrame(lines, "landing int, as_of date, folded long, pending long, buckets_written long")


# --- in the order of time ----------------------------------------------------------------------------


def last_order_before_shipping(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line with its buyer's newest order on the day that it was shipped."""
    lines = star.star_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"), F.col("l_shipdate").alias("shipped")
    )
    orders = _transactions(spark, folder)
    bought = lines.join(orders.select(F.col("transaction_id").alias("order_id"), "user_id"), "order_id")
    newest = {"transaction_id": "newest_order", "transaction_date": "newest_date", "total_amount": "newest_amount"}
    return ordered.asof_join(bought, orders, "user_id", "shipped", "transaction_date", newest, ["transaction_id"])


def transaction_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return ordered.gap_statistics(_transactions(spark, folder), "user_id", "transaction_date")


def overlapping_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of orders of one customer that were open at once: from the order, or its first shipping, to its last."""
    shipped = star.star_table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min("l_shipdate").alias("first_shipped"), F.max("l_shipdate").alias("last_shipped")
    )
    orders = _transactions(spark, folder).withColumnRenamed("transaction_id", "order_id").join(shipped, "order_id")
    opened, closed = F.least("transaction_date", "first_shipped"), F.greatest("transaction_date", "last_shipped")
    spans = orders.select("order_id", "user_id", opened.alias("opened"), closed.alias("closed"))
    pairs = intervals.overlap_join(spans, spans, ("opened", "closed"), ("opened", "closed"), ["user_id"])
    both = F.least("left.closed", "right.closed")
    return pairs.where("left.order_id < right.order_id").select(
        F.col("left.user_id").alias("user_id"),
        F.col("left.order_id").alias("first_order"),
        F.col("right.order_id").alias("second_order"),
        F.datediff(F.to_date(both), F.to_date(F.greatest("left.opened", "right.opened"))).alias("days_together"),
    )


# --- totals, drift, reconciliation -----------------------------------------------------------------

CUBE = ["customer_segment", "category", "month"]


def _finest_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per segment, category and month; a category named PROMO is a product without one."""
    category = F.split_part("category", F.lit(" "), F.lit(1))
    products = _products(spark, folder).select("product_id", F.nullif(category, F.lit("PROMO")).alias("category"))
    users = _profiles(spark, folder).select("user_id", "customer_segment")
    lines = joins.join_dimension(_lines(spark, folder), products, "product_id")
    lines = joins.join_dimension(lines, users, "user_id").withColumn("month", F.to_date(F.trunc("transaction_date", "month")))
    return written(rollups.finest_totals(lines, CUBE, "total_amount"), "finest-sales")


def sales_cube(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.cube_totals(_finest_sales(spark, folder), CUBE)


def sales_by_month_and_segment(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.pivoted_amounts(_finest_sales(spark, folder), "month", "customer_segment", list(C.SEGMENTS))


DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


def line_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines shipped from 1998 on next to those before."""
    lines = star.star_table(spark, folder, "lineitem")
    later = F.col("l_shipdate") >= F.lit("1998-01-01").cast("date")
    return _rounded(drift.drift(lines.where(~later), lines.where(later), DRIFT_COLUMNS), ["ks", "stability"])


def reconciled_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Landed files of transactions next to a stored table that lost some, has some twice, and changed the method of others."""
    transactions = _transactions(spark, folder)
    landing = new_path(spark, "landed-orders")
    write_csv(transactions, landing)
    number, method = F.col("transaction_id"), F.col("payment_method")
    changed = transactions.where(number % 997 != 0).withColumn("payment_method", F.when(number % 1999 != 0, method))
    stored = written(changed.unionAll(changed.where(number % 1499 == 0)), "stored-orders")
    return reconcile(read_csv(spark, landing, transactions.schema), stored, ["transaction_id"])


# --- streams with state, sketches --------------------------------------------------------------------

FIRST_EVENT_DAY, EVENT_LANDINGS = dt.date(2024, 1, 1), 4  # of 8 days each, the last one open


def _event_landing() -> Column:
    week = F.floor(F.datediff(F.to_date("ts"), F.lit(FIRST_EVENT_DAY)) / 8)
    return F.greatest(F.least(week + 1, F.lit(EVENT_LANDINGS)), F.lit(1)).cast("int")


def _activity(spark: SparkSession, folder: str) -> DataFrame:
    """All events in landings of eight days: errors arrive a landing late, clicks twice. Each landing restarts the stream."""
    events = star.star_table(spark, folder, "events")
    arriving, target, progress = (new_path(spark, name) for name in ("events", "activity", "activity-progress"))
    number = _event_landing()
    for landing in range(1, EVENT_LANDINGS + 2):
        regular = (F.col("event_type") != "error") & (number == landing)
        again = F.col("event_type").isin("error", "click") & (number + 1 == landing)
        events.where(regular | again).write.mode("append").parquet(arriving)
        activity.append_activity(spark, arriving, events.schema, target, progress)
    return spark.read.parquet(target)


def late_event_activity(spark: SparkSession, folder: str) -> DataFrame:
    """The days that the watermark has passed, without what came behind it."""
    return _activity(spark, folder).select("day", "event_type", "events", "total_value")


def distinct_users_in_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Users per event type in every range of whole weeks, from one sketch a day, and whether it is as near as promised."""
    events = star.star_table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    daily = written(events.groupBy("day", "event_type").agg(sketches.distinct_sketch("user_id").alias("users")), "daily-users")
    starts = [FIRST_EVENT_DAY + dt.timedelta(days=7 * i) for i in range(4)]
    ranges = [(a, b + dt.timedelta(days=6)) for a in starts for b in starts if a <= b]
    found = sketches.distinct_in_ranges(daily, "day", "users", ["event_type"], ranges)
    lines = F.array(*[F.struct(F.lit(a).alias("range_from"), F.lit(b).alias("range_to")) for a, b in ranges])
    covering = F.filter(lines, lambda r: F.col("day").between(r["range_from"], r["range_to"]))
    exact = (
        events.select("event_type", "user_id", F.inline(covering))
        .groupBy("event_type", "range_from", "range_to")
        .agg(F.count_distinct("user_id").alias("users"))
    )
    near = F.abs(F.col("distinct_estimate") - F.col("users")) <= F.greatest(F.lit(1.0), 4 * sketches.DISTINCT_ERROR * F.col("users"))
    return exact.join(found, ["event_type", "range_from", "range_to"]).select(
        "event_type", "range_from", "range_to", "users", near.alias("within_bound")
    )


def sketched_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """Features that arrive in batches, sketched batch by batch; is each merged 80th percentile as near to the exact rank as promised?"""
    stored, arriving = _stored_features(spark, folder), new_path(spark, "arriving-features")
    found, progress = new_path(spark, "sketches"), new_path(spark, "sketch-progress")
    numbers = []

    def sketch(batch: DataFrame, number: int) -> None:
        numbers.append(number)
        sketches.feature_sketches(batch).write.mode("overwrite").parquet(f"{found}/{number}")

    for segment in C.SEGMENTS:  # three days' worth
        stored.where(F.col("customer_segment") == segment).write.mode("append").parquet(arriving)
        jobs.each_new_batch(spark, arriving, stored.schema, sketch, progress)
    batches = spark.read.parquet(*[f"{found}/{number}" for number in sorted(set(numbers))])
    limits = sketches.sketched_thresholds(batches)
    lines = []
    for name, limit in zip(sketches.THRESHOLD_COLUMNS, (limits.total_spent, limits.total_transactions)):
        below, upto, rows = stored.agg(
            F.count_if(F.col(name) < limit), F.count_if(F.col(name) <= limit), F.count(name)
        ).first()
        slack = sketches.RANK_ERROR * rows + 1
        near = below - slack <= C.HIGH_SHARE * rows <= upto + slack
        lines.append((name, len(set(numbers)), rows, near))
    return spark.createDataFrame(lines, "column_name string, batches int, rows long, within_bound boolean")


# --- features, labels, model inputs ----------------------------------------------------------------


def user_features(spark: SparkSession, folder: str) -> DataFrame:
    # The hint names no method that occurs here: the count is the same, by the longer way.
    return _scored(features.user_features(_users(spark, folder), _transactions(spark, folder), AS_OF))


def engineered_features(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored_features(spark, folder)
    derived = engineered.with_engineered_features(stored, engineered.fit_thresholds(stored))
    return _scored(derived.select("user_id", *C.MODEL_FEATURES, F.col("is_churned").alias("actual_churn")))


def model_matrix(spark: SparkSession, folder: str) -> DataFrame:
    matrix = _matrix(spark, folder)
    return _scored(lower_case_columns(matrix.toDF(*[name.upper() for name in matrix.columns])))


def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return dataset.stratified_split(_stored_matrix(spark, folder)).select("user_id", "label", "is_test")


def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    return dataset.stratified_folds(_stored_matrix(spark, folder)).select("user_id", "label", "fold")


def stratified_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return stratified_split(spark, folder).groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("customers"))


def stratified_fold_counts(spark: SparkSession, folder: str) -> DataFrame:
    return stratified_folds(spark, folder).groupBy("label", "fold").agg(F.count(F.lit(1)).alias("customers"))


def standardized_features(spark: SparkSession, folder: str) -> DataFrame:
    split = written(dataset.stratified_split(_stored_matrix(spark, folder)), "split-matrix")
    scaled = dataset.standardized(split.where(~F.col("is_test")), split, C.MODEL_FEATURES)
    return _rounded(scaled, C.MODEL_FEATURES).select("user_id", "is_test", *C.MODEL_FEATURES)


# --- checks ----------------------------------------------------------------------------------------


def domain_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines whose product category is outside the declared domain; counted per product before the join."""
    sold = star.star_table(spark, folder, "lineitem").select(F.col("l_partkey").alias("product_id"), F.lit(1).alias("rows"))
    per_category = joins.sum_by_attribute(sold, _products(spark, folder), "product_id", "category", ["rows"])
    return quality.domain_violations(per_category, {"category": C.CATEGORIES}, "rows")


def segment_domain_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Each table on its own: segments of customers, payment methods of orders, as the source has them."""
    customers = star.star_table(spark, folder, "customer").select(F.col("c_mktsegment").alias("customer_segment"))
    methods = _transactions(spark, folder).select("payment_method")
    return quality.domain_violations(customers, {"customer_segment": C.SEGMENTS}).unionAll(
        quality.domain_violations(methods, {"payment_method": C.PAYMENT_METHODS})
    )


def range_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Each bound on the table that declares it: quantities of lines, prices of products, ages of users."""
    quantities = star.star_table(spark, folder, "lineitem").select(F.col("l_quantity").cast("int").alias("quantity"))
    return (
        quality.range_violations(quantities, {"quantity": C.QUANTITY_RANGE})
        .unionAll(quality.range_violations(_products(spark, folder), {"price": C.PRICE_RANGE}))
        .unionAll(quality.range_violations(_profiles(spark, folder), {"age": C.AGE_RANGE}))
    )


def auc_small_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores far below the precision at which scores are shown; the division by a power of two is exact."""
    small = _labeled(spark, folder).select(
        F.col("is_churned").cast("int").alias("label"), (F.col("days_since_last_transaction") / F.lit(2.0**60)).alias("score")
    )
    small = small.withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    return _rounded(metrics.accuracy_and_auc(small, score="score"), ["auc"])


# --- training --------------------------------------------------------------------------------------
#
# Fits at the stated settings: both candidates, 200 trees, five folds. The fitted numbers are not SQL's to know, so the
# queries return what follows from the tables next to whether the fitted results keep their promises.


def _input_files(spark: SparkSession, folder: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of every file of the tables that training reads."""
    found = []
    for name in ("customer", "orders"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            file = files.next()
            found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(found))


_fits: dict[tuple, tuple[DataFrame, TrainingResult, list]] = {}  # the last two, each with the paths that it reads
_fitting = threading.Lock()


def _trained(spark: SparkSession, folder: str) -> tuple[DataFrame, TrainingResult]:
    """The feature table and what was trained on it; once per session, folder and state of its files."""
    key = (spark, folder, _input_files(spark, folder))
    with _fitting:
        if key not in _fits:
            with kept_afterwards() as paths:
                stored = _stored_features(spark, folder)
                _fits[key] = (stored, train_churn_model(stored), paths)
            while len(_fits) > 2:
                oldest = next(iter(_fits))
                for path in _fits.pop(oldest)[2]:
                    delete(oldest[0], path)
        return _fits[key][:2]


def _rank_auc(scored: DataFrame) -> float:
    """The area under the ROC curve by another road than ``metrics``: the curve of the evaluator in Spark."""
    ranked = scored.select(F.col("label").cast("double").alias("label"), F.col("churn_probability").alias("score"))
    return BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(ranked)


def trained_model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Per candidate: its rows and folds, and how many promises its results break."""
    _, result = _trained(spark, folder)
    counts = {row["is_test"]: row["count"] for row in result.split.groupBy("is_test").count().collect()}
    lines = result.metrics.orderBy("position").collect()
    best = max(lines, key=lambda line: (line["auc"], -line["position"]))
    rows = []
    for line in lines:
        name = line["model_type"]
        scored = result.scored[name]
        accuracy = scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0]
        reported = result.reports[name].where("class = 'accuracy'").first()["f1_score"]
        folds = [row["auc"] for row in result.fold_scores.where(F.col("model_type") == name).collect()]
        kept = [
            abs(line["accuracy"] - accuracy) < 1e-12 and abs(reported - accuracy) < 1e-12,
            abs(line["auc"] - _rank_auc(scored)) < 1e-9,
            abs(line["cv_auc_mean"] - sum(folds) / len(folds)) < 1e-12 and 0 <= line["cv_auc_sd"] <= 0.5,
            line["selected"] == (line is best),
        ]
        if name == LOGISTIC:
            train = result.split.where(~F.col("is_test"))
            kept.append(gradient_residual(result.fitted[name], train) < 1e-9 and result.fitted[name].passes <= 20)
        rows.append((line["position"], name, counts[False], counts[True], len(folds), kept.count(False)))
    return spark.createDataFrame(
        rows, "position int, model_type string, train_rows long, test_rows long, folds long, broken_promises long"
    )


def cross_validated_auc(spark: SparkSession, folder: str) -> DataFrame:
    """Per candidate and fold: its rows, its churned customers, and whether its AUC is one."""
    _, result = _trained(spark, folder)
    rows = result.split.groupBy("fold").agg(F.count(F.lit(1)).alias("fold_rows"), F.sum("label").alias("churned"))
    return result.fold_scores.join(rows, "fold").select(
        "model_type", "fold", "fold_rows", "churned", F.col("auc").between(0, 1).alias("auc_is_valid")
    )


def feature_importances(spark: SparkSession, folder: str) -> DataFrame:
    """Per model input of the forest: whether its importance is a share, and whether all add up to one."""
    _, result = _trained(spark, folder)
    found = importances_of(spark, result.fitted[FOREST])
    total = found.agg(F.abs(F.sum("importance") - 1) < 1e-9).first()[0]
    return found.select("feature", F.col("importance").between(0, 1).alias("is_share"), F.lit(total).alias("total_is_one"))


def _score_checks() -> list[Column]:
    return [
        F.col("churn_probability").between(0, 1).alias("is_probability"),
        (F.col("churn_prediction") == (F.col("churn_probability") > C.DECISION_THRESHOLD)).alias("decision_follows"),
    ]


def trained_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Publish each candidate, load it back, score every customer: are the scores those of the fitted model?"""
    stored, result = _trained(spark, folder)
    stored = spread(stored)
    store, tables = ModelStore(spark, new_path(spark, "models")), []
    for name, fitted in result.fitted.items():
        model = as_churn_model(name, result.model.thresholds, fitted)
        store.publish(model)
        before = scoring.score_features(stored, model).select("user_id", F.col("churn_probability").alias("before"))
        after = scoring.score_features(stored, store.latest()).join(before, "user_id")
        same = (F.abs(F.col("churn_probability") - F.col("before")) < 1e-12).alias("same_after_reload")
        tables.append(after.select(F.lit(name).alias("model_type"), "user_id", "is_churned", *_score_checks(), same))
    return reduce(DataFrame.unionAll, tables)


def scoring_functions_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """The three SQL functions after a logistic model, a forest and the logistic model again were deployed."""
    stored, result = _trained(spark, folder)
    thresholds = write_table(engineered.threshold_table(stored), "thresholds")
    schema = f"run_{uuid.uuid4().hex}"
    place = new_path(spark, "functions")
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{place}'")
    on_leaving(lambda: spark.sql(f"DROP SCHEMA {schema} CASCADE"))
    limits = engineered.fit_thresholds(stored)
    fixed = scoring.ChurnModel(LOGISTIC, limits, FIXED_MODEL)
    forest = scoring.ChurnModel(FOREST, limits, pipeline=result.fitted[FOREST])
    spread(stored).createOrReplaceTempView("features_to_score")
    arguments = sql_functions.model_arguments(f"parquet.`{thresholds}`")
    paths = []
    for model in (fixed, forest, fixed):
        sql_functions.deploy_functions(spark, schema, model)
        called = spark.sql(
            f"SELECT user_id, predict_churn_probability({arguments}) AS churn_probability, "
            f"predict_churn_binary({arguments}) AS churn_prediction, predict_churn({arguments}) AS churn FROM features_to_score"
        )
        paths.append(write_table(called, "called"))
    expected = scoring.score_features(spread(stored), forest).select("user_id", F.col("churn_probability").alias("expected"))
    by_forest = spark.read.parquet(paths[1]).join(expected, "user_id")
    agrees = (F.abs(F.col("churn_probability") - F.col("expected")) < 1e-12).alias("forest_agrees")
    again = spark.read.parquet(paths[2]).exceptAll(spark.read.parquet(paths[0])).count() == 0
    return (
        spark.read.parquet(paths[2])
        .join(by_forest.select("user_id", agrees), "user_id")
        .withColumns({"churn_probability": F.round("churn_probability", C.SCORE_DECIMALS), "same_again": F.lit(again)})
    )


def boosted_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Boosted trees, trained and deployed: do functions, view and pipeline agree, and is all of it free of Python?"""
    warehouse = _new_warehouse(spark)
    stored = warehouse.save(_labeled(spark, folder), "features", "user_features")
    warehouse.save(engineered.threshold_table(stored), "features", "thresholds")
    result = train_churn_model(stored, TrainingSettings(candidates=(BOOSTED,), trees=20, folds=0))
    schema = f"{warehouse.prefix}ml_models"
    sql_functions.deploy_functions(spark, schema, result.model)
    names = warehouse.name("features", "user_features"), warehouse.name("features", "thresholds")
    view = sql_functions.create_prediction_view(spark, warehouse.name("ml_models", "current"), *names, schema)
    scored = scoring.score_features(stored, result.model)
    native = "Python" not in view._jdf.queryExecution().executedPlan().toString()
    pairs = scored.select("user_id", "is_churned", "churn_probability", "churn_prediction").join(
        view.select("user_id", F.col("churn_probability").alias("called"), F.col("churn_prediction").alias("decided")), "user_id"
    )
    agrees = (F.abs(F.col("churn_probability") - F.col("called")) < 1e-12) & (F.col("churn_prediction") == F.col("decided"))
    return pairs.select("user_id", "is_churned", *_score_checks(), agrees.alias("view_agrees"), F.lit(native).alias("native"))


def rescored_with_current_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """A model that was trained when other thresholds held, scoring today's table."""
    stored = _stored_features(spark, folder)
    old = scoring.ChurnModel(LOGISTIC, engineered.Thresholds(1.0, 1.0), FIXED_MODEL)
    return _scored(scoring.score_features(stored, old, engineered.fit_thresholds(stored)))


# --- flagship --------------------------------------------------------------------------------------


def segment_risk_report(spark: SparkSession, folder: str) -> DataFrame:
    """From raw tables to scores: customers, labels and predicted risk per segment."""
    return (
        _predictions(spark, folder)
        .groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            reports.sum_money("total_spent").alias("revenue"),
            reports.churned_percent().alias("churn_rate"),
            F.count_if("churn_prediction").alias("predicted_churned"),
            F.round(F.avg("churn_probability"), C.SCORE_DECIMALS).alias("avg_churn_probability"),
        )
        .orderBy("customer_segment")
    )


_ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_gzip_roundtrip": csv_gzip_roundtrip,
    "stream_ingest_available_now": stream_ingest_available_now,
    "transaction_lines_priced": lambda s, d: reports.priced_lines(_lines(s, d), _products(s, d)),
    "users": _users,
    "user_transaction_features": lambda s, d: _scored(
        features.transaction_features(_transactions(s, d), AS_OF, star.ORDER_PRIORITIES)
    ),
    "user_features": user_features,
    "user_features_labeled": lambda s, d: _scored(_labeled(s, d)),
    "feature_statistics": lambda s, d: _rounded(features.feature_statistics(_labeled(s, d)), ["avg_recency_score"]),
    "churn_distribution": lambda s, d: features.churn_distribution(_labeled(s, d)),
    "churn_value_counts": lambda s, d: features.churn_value_counts(_labeled(s, d)),
    "total_customers": lambda s, d: reports.total_customers(_profiles(s, d)),
    "total_transactions": lambda s, d: reports.total_transactions(_transactions(s, d)),
    "total_revenue": lambda s, d: reports.total_revenue(_transactions(s, d)),
    "churn_rate": lambda s, d: reports.churn_rate(_labeled(s, d)),
    "kpi_row_formatted": lambda s, d: reports.key_metrics(_profiles(s, d), _transactions(s, d), _labeled(s, d)),
    "revenue_by_category": lambda s, d: reports.revenue_by_category(
        star.sales_from(star.star_table(s, d, "lineitem")), _products(s, d)
    ),
    "customers_by_segment": lambda s, d: reports.customers_by_segment(_profiles(s, d)),
    "churn_rate_by_segment": lambda s, d: reports.churn_rate_by_segment(_profiles(s, d), _labeled(s, d)),
    "p80_thresholds": lambda s, d: engineered.threshold_table(_stored_features(s, d)),
    "p80_thresholds_by_rank": lambda s, d: engineered.threshold_table(_stored_features(s, d), "by_rank"),
    "engineered_features": engineered_features,
    "model_matrix": model_matrix,
    "class_weights": lambda s, d: dataset.class_weights(_labeled(s, d).select(F.col("is_churned").cast("int").alias("label"))),
    "stratified_split": stratified_split,
    "stratified_folds": stratified_folds,
    "stratified_split_counts": stratified_split_counts,
    "stratified_fold_counts": stratified_fold_counts,
    "standardized_features": standardized_features,
    "churn_predictions": lambda s, d: _scored(_predictions(s, d)),
    "scoring_smoke": lambda s, d: _scored(scoring.scoring_sample(_predictions(s, d))),
    "prediction_summary": lambda s, d: _rounded(
        scoring.prediction_summary(_predictions(s, d)), ["avg_churn_probability"]
    ),
    "high_risk_customers": lambda s, d: reports.high_risk_customers(
        _profiles(s, d), written(_predictions(s, d), "predictions")
    ),
    "segment_risk_report": segment_risk_report,
    "confusion_matrix": lambda s, d: metrics.confusion_matrix(_evaluated(s, d)),
    "classification_report": lambda s, d: _rounded(
        metrics.classification_report(_evaluated(s, d)), ["precision", "recall", "f1_score"]
    ),
    "accuracy_and_auc": lambda s, d: _rounded(metrics.accuracy_and_auc(_evaluated(s, d)), ["accuracy", "auc"]),
    "duplicate_keys": lambda s, d: quality.duplicate_keys(
        star.star_table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    ),
    "auc_small_scores": auc_small_scores,
    "duplicate_rows": lambda s, d: quality.duplicate_rows(star.star_table(s, d, "lineitem")),
    "duplicate_texts": lambda s, d: quality.duplicate_rows(star.star_table(s, d, "documents").drop("doc_id")),
    "duplicate_summary": lambda s, d: quality.duplicate_summary(
        star.star_table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    ),
    "null_profile": lambda s, d: quality.null_profile(_users(s, d)),
    "range_profile": lambda s, d: _rounded(
        quality.range_profile(star.star_table(s, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"]),
        ["mean_value", "p25", "p50", "p75"],
    ),
    "range_violations": range_violations,
    "domain_violations": domain_violations,
    "segment_domain_violations": segment_domain_violations,
    "prediction_alignment": lambda s, d: quality.prediction_alignment(_predictions(s, d)),
    "saved_model_scores": saved_model_scores,
    "sql_function_view_scores": sql_function_view_scores,
    "stream_scoring": stream_scoring,
    "daily_pipeline": daily_pipeline,
    "trained_model_comparison": trained_model_comparison,
    "cross_validated_auc": cross_validated_auc,
    "feature_importances": feature_importances,
    "trained_model_scores": trained_model_scores,
    "scoring_functions_by_name": scoring_functions_by_name,
    "rescored_with_current_thresholds": rescored_with_current_thresholds,
    "raw_table_layouts": raw_table_layouts,
    "incremental_user_features": incremental_user_features,
    "incremental_fold_log": incremental_fold_log,
    "late_event_activity": late_event_activity,
    "distinct_users_in_ranges": distinct_users_in_ranges,
    "sketched_thresholds": sketched_thresholds,
    "boosted_model_scores": boosted_model_scores,
    "last_order_before_shipping": last_order_before_shipping,
    "overlapping_orders": overlapping_orders,
    "sales_cube": sales_cube,
    "sales_by_month_and_segment": sales_by_month_and_segment,
    "line_drift": line_drift,
    "reconciled_orders": reconciled_orders,
    "transaction_gaps": lambda s, d: _rounded(transaction_gaps(s, d), ["mean_gap"]),
}

# Queries that make tables on their way: what they return is written once, and everything else is deleted.
_WITH_TABLES = [
    "csv_gzip_roundtrip",
    "stream_ingest_available_now",
    "p80_thresholds",
    "p80_thresholds_by_rank",
    "engineered_features",
    "model_matrix",
    "stratified_split",
    "stratified_folds",
    "stratified_split_counts",
    "stratified_fold_counts",
    "standardized_features",
    "churn_predictions",
    "scoring_smoke",
    "prediction_summary",
    "high_risk_customers",
    "segment_risk_report",
    "confusion_matrix",
    "classification_report",
    "accuracy_and_auc",
    "prediction_alignment",
    "saved_model_scores",
    "sql_function_view_scores",
    "stream_scoring",
    "daily_pipeline",
    "trained_model_comparison",
    "cross_validated_auc",
    "feature_importances",
    "trained_model_scores",
    "scoring_functions_by_name",
    "rescored_with_current_thresholds",
    "raw_table_layouts",
    "incremental_user_features",
    "incremental_fold_log",
    "late_event_activity",
    "distinct_users_in_ranges",
    "sketched_thresholds",
    "boosted_model_scores",
    "sales_cube",
    "sales_by_month_and_segment",
    "line_drift",
    "reconciled_orders",
]


def _tidy(query: Callable[[SparkSession, str], DataFrame], name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = new_path(spark, f"result-{name}")
        with deleted_afterwards(spark):
            result = query(spark, folder)
            result.write.parquet(path)
        return spark.read.schema(result.schema).parquet(path)

    return run


QUERIES = {name: _tidy(query, name) if name in _WITH_TABLES else query for name, query in _ALL.items()}

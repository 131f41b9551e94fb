"""The queries of ``patronlens.plans.queries`` as SQL for an independent engine, where SQL can express them."""

from __future__ import annotations

from patronlens import contract as C
from patronlens.functions.draws import MODULUS, PRIME, STREAMS
from patronlens.plans.queries import AS_OF, DRIFT_COLUMNS, EVENT_LANDINGS, FIRST_EVENT_DAY, FIXED_MODEL, LANDING_DATES
from patronlens.sources.feature_state import BUCKETS

PROFILES = """
    SELECT c_custkey AS user_id,
           lower(replace(c_name, '#', '.')) || '@example.invalid' AS email,
           CAST(18 + c_custkey % 53 AS INTEGER) AS age,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'Basic'
                WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'Premium'
                ELSE 'Standard' END AS customer_segment
    FROM customer
"""

USERS = f"""
    SELECT p.user_id, p.email, split_part(c.c_name, '#', 1) AS first_name, split_part(c.c_name, '#', 2) AS last_name,
           CAST(NULL AS DATE) AS signup_date, n.n_name AS country, p.age, p.customer_segment
    FROM ({PROFILES}) p JOIN customer c ON c.c_custkey = p.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey
"""

# order lines with segment, category and month
SALES = f"""
    SELECT u.customer_segment, nullif(split_part(p_type, ' ', 1), 'PROMO') AS category,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS month, l_extendedprice AS amount
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
         JOIN ({PROFILES}) u ON u.user_id = o_custkey
"""

TRANSACTIONS = """
    SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_totalprice AS total_amount,
           o_orderdate AS transaction_date, o_orderpriority AS payment_method
    FROM orders
"""

LINES = """
    SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, l.l_partkey AS product_id,
           CAST(l.l_quantity AS INTEGER) AS quantity, l.l_extendedprice AS total_amount,
           o.o_custkey AS user_id, o.o_orderdate AS transaction_date
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
"""

TRANSACTION_FEATURES = f"""
    SELECT user_id,
           count(*) AS total_transactions,
           CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_spent,
           least(greatest(CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) / count(total_amount), min(total_amount)),
                 max(total_amount)) AS avg_transaction_amount,
           max(total_amount) AS max_transaction_amount,
           min(total_amount) AS min_transaction_amount,
           count(transaction_id) AS transaction_frequency,
           CAST(min(days) AS INTEGER) AS days_since_last_transaction,
           CAST(sum(CASE WHEN days <= 30 THEN 1 ELSE 0 END) AS BIGINT) AS transactions_last_30_days,
           avg(days) AS avg_days_between_transactions,
           avg(CAST(1 AS DOUBLE) / (days + 1)) AS recency_score,
           count(DISTINCT payment_method) AS payment_method_count
    FROM (SELECT *, date_diff('day', CAST(transaction_date AS DATE), DATE '{AS_OF}') AS days
          FROM ({TRANSACTIONS}) WHERE CAST(transaction_date AS DATE) <= DATE '{AS_OF}')
    GROUP BY user_id
"""

# Means of fractions may differ in the last bits between engines.
ROUNDED = "SELECT * REPLACE (round(recency_score, 9) AS recency_score) FROM"

USER_FEATURES = f"""
    SELECT u.user_id, u.age, u.customer_segment, t.* EXCLUDE (user_id)
    FROM ({PROFILES}) u JOIN ({TRANSACTION_FEATURES}) t ON t.user_id = u.user_id
"""


def _draw(stream: str) -> str:
    multiplier, increment = STREAMS[stream]
    z = f"((user_id * {multiplier} + {increment}) % {MODULUS})"
    return f"(CAST(({z} * {z}) % {PRIME} AS DOUBLE) / CAST({PRIME} AS DOUBLE))"


LABELED = f"""
    SELECT *, (days_since_last_transaction > 90 AND {_draw("stale")} > CAST(0.7 AS DOUBLE))
           OR (customer_segment = 'Basic' AND {_draw("segment")} > CAST(0.6 AS DOUBLE))
           OR (age > 60 AND {_draw("senior")} > CAST(0.8 AS DOUBLE)) AS is_churned
    FROM ({USER_FEATURES})
"""

ENGINEERED = """
    SELECT f.*,
           CASE WHEN total_transactions > 0 THEN total_spent / total_transactions ELSE 0 END AS spend_per_transaction,
           CASE WHEN total_spent > (SELECT quantile_cont(total_spent, 0.8) FROM labeled)
                THEN 1 ELSE 0 END AS high_value_customer,
           CASE WHEN total_transactions > (SELECT quantile_cont(CAST(total_transactions AS DOUBLE), 0.8) FROM labeled)
                THEN 1 ELSE 0 END AS frequent_buyer,
           CASE customer_segment WHEN 'Premium' THEN 2 WHEN 'Standard' THEN 1 ELSE 0 END AS customer_segment_encoded
    FROM labeled f
"""

MARGIN = " + ".join(
    [f"CAST({FIXED_MODEL.intercept!r} AS DOUBLE)"]
    + [
        f"CAST({weight:.12f} AS DOUBLE) * CAST({name} AS DOUBLE)"
        for weight, name in zip(FIXED_MODEL.weights, C.MODEL_FEATURES, strict=True)
    ]
)

# The common tables; the unused ones of a query cost nothing.
WITH = f"""
    WITH labeled AS MATERIALIZED ({LABELED}),
    engineered AS ({ENGINEERED}),
    predictions AS (
        SELECT * EXCLUDE (spend_per_transaction, high_value_customer, frequent_buyer, customer_segment_encoded, p),
               p AS churn_probability, p > 0.5 AS churn_prediction
        FROM (SELECT *, CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-({MARGIN}))) AS p FROM engineered)),
    placed AS (
        SELECT e.*, CAST(is_churned AS INTEGER) AS label,
               row_number() OVER (PARTITION BY is_churned ORDER BY {_draw("split")}, user_id) AS place,
               count(*) OVER (PARTITION BY is_churned) AS label_rows,
               ntile({C.FOLDS}) OVER (PARTITION BY is_churned ORDER BY {_draw("split")}, user_id) - 1 AS fold
        FROM engineered e),
    split AS (SELECT *, place <= round(CAST({C.TEST_SHARE} AS DOUBLE) * label_rows) AS is_test FROM placed),
    cells AS (
        SELECT count(*) FILTER (NOT is_churned AND NOT churn_prediction) AS n00,
               count(*) FILTER (NOT is_churned AND churn_prediction) AS n01,
               count(*) FILTER (is_churned AND NOT churn_prediction) AS n10,
               count(*) FILTER (is_churned AND churn_prediction) AS n11
        FROM predictions)
"""

INPUTS = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in C.MODEL_FEATURES)
P80 = """
    SELECT quantile_cont(total_spent, 0.8) AS total_spent_p80,
           quantile_cont(CAST(total_transactions AS DOUBLE), 0.8) AS total_transactions_p80 FROM labeled
"""
CHURN_RATE = "avg(CASE WHEN is_churned THEN 1 ELSE 0 END) * 100"
SCALED = ", ".join(
    f"round((CAST({name} AS DOUBLE) - (SELECT avg({name}) FROM split WHERE NOT is_test)) / "
    f"(SELECT CASE WHEN stddev_pop({name}) > 0 THEN stddev_pop({name}) ELSE 1 END FROM split WHERE NOT is_test), 9) "
    f"AS {name}"
    for name in C.MODEL_FEATURES
)
REPORT = f"""
    , per_class AS (
        SELECT '0' AS class, n00 AS hits, n00 + n10 AS predicted, n00 + n01 AS actual FROM cells
        UNION ALL SELECT '1', n11, n01 + n11, n10 + n11 FROM cells),
    measured AS (
        SELECT class, coalesce(hits / nullif(predicted, 0), 0) AS precision, coalesce(hits / nullif(actual, 0), 0) AS recall,
               coalesce(2 * hits / nullif(predicted + actual, 0), 0) AS f1_score, actual AS support
        FROM per_class),
    report AS (
        SELECT * FROM measured
        UNION ALL SELECT 'accuracy', NULL, NULL, (n00 + n11) / (n00 + n01 + n10 + n11), n00 + n01 + n10 + n11 FROM cells
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM measured
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                         sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM measured)
    SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1_score, 9) AS f1_score, support
    FROM report
"""


SCORED = f"{WITH} SELECT * REPLACE (round(recency_score, 9) AS recency_score, round(churn_probability, 9) AS churn_probability) FROM predictions"


CANDIDATES = "(VALUES (0, 'RandomForest'), (1, 'LogisticRegression')) AS c(position, model_type)"


def _names(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _null_line(column: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, count(*) FILTER ({column} IS NULL) AS null_count, "
        f"count(*) FILTER ({column} IS NULL) / count(*) AS null_rate FROM ({USERS})"
    )


def _range_line(column: str) -> str:
    quartiles = ", ".join(
        f"round(quantile_cont(CAST({column} AS DOUBLE), {p}), 9) AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75)
    )
    return (
        f"SELECT '{column}' AS column_name, count({column}) AS value_count, CAST(min({column}) AS DOUBLE) AS min_value, "
        f"CAST(max({column}) AS DOUBLE) AS max_value, round(avg({column}), 9) AS mean_value, {quartiles} FROM orders"
    )


def _outside_line(column: str, low: float, high: float, source: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high, "
        f"count(*) FILTER ({column} < {low} OR {column} > {high}) AS violations FROM {source}"
    )


_FIRST, _SECOND = LANDING_DATES[:2]
LANDINGS = f"""
    dated AS (SELECT o_custkey AS user_id, o_orderpriority AS method, CAST(o_orderdate AS DATE) AS day FROM orders),
    regular AS (SELECT *, CASE WHEN day <= DATE '{_FIRST}' THEN 1 WHEN day <= DATE '{_SECOND}' THEN 2 ELSE 3 END AS due FROM dated),
    arrived AS (SELECT *, CASE WHEN method = '1-URGENT' THEN greatest(due - 1, 1) WHEN method = '5-LOW' THEN least(due + 1, 3)
                               ELSE due END AS landing FROM regular),
    days AS (SELECT * FROM (VALUES {", ".join(f"({i}, DATE '{day}')" for i, day in enumerate(LANDING_DATES, start=1))}) AS v(number, as_of))
"""

ORACLE: dict[str, str] = {
    "csv_gzip_roundtrip": TRANSACTIONS,
    "stream_ingest_available_now": TRANSACTIONS,
    "transaction_lines_priced": f"""
        SELECT l.*, p.p_retailprice AS unit_price,
               CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) * l.quantity AS DOUBLE) AS list_amount
        FROM ({LINES}) l JOIN part p ON p.p_partkey = l.product_id""",
    "users": USERS,
    "user_transaction_features": f"{ROUNDED} ({TRANSACTION_FEATURES})",
    "user_features": f"{ROUNDED} ({USER_FEATURES})",
    "user_features_labeled": f"{ROUNDED} ({LABELED})",
    "feature_statistics": f"""{WITH}
        SELECT count(*) AS total_users, count(*) FILTER (is_churned) AS churned_users,
               least(greatest(CAST(sum(CAST(total_spent AS DECIMAL(18,2))) AS DOUBLE) / count(*), min(total_spent)), max(total_spent)) AS avg_spent,
               avg(total_transactions) AS avg_transactions, round(avg(recency_score), 9) AS avg_recency_score
        FROM labeled""",
    "churn_distribution": f"{WITH} SELECT is_churned, count(*) AS customers FROM labeled GROUP BY is_churned",
    "churn_value_counts": f"""{WITH}
        SELECT is_churned, count(*) AS customers, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100 AS share_pct
        FROM labeled GROUP BY is_churned ORDER BY customers DESC""",
    "total_customers": "SELECT count(*) AS total_customers FROM customer",
    "total_transactions": "SELECT count(*) AS total_transactions FROM orders",
    "total_revenue": "SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM orders",
    "churn_rate": f"{WITH} SELECT {CHURN_RATE} AS churn_rate FROM labeled",
    "kpi_row_formatted": f"""{WITH}
        SELECT (SELECT format('{{:,}}', count(*)) FROM customer) AS total_customers,
               (SELECT format('{{:,}}', count(*)) FROM orders) AS total_transactions,
               (SELECT '$' || format('{{:,}}', CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT)) || '.' ||
                       lpad(CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) * 100 AS BIGINT) % 100 AS VARCHAR), 2, '0')
                FROM orders) AS total_revenue,
               (SELECT printf('%.1f%%', {CHURN_RATE}) FROM labeled) AS churn_rate""",
    "revenue_by_category": """
        SELECT p_type AS category, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type ORDER BY revenue DESC""",
    "customers_by_segment": f"SELECT customer_segment, count(*) AS customers FROM ({PROFILES}) GROUP BY customer_segment",
    "churn_rate_by_segment": f"""{WITH}
        SELECT u.customer_segment, {CHURN_RATE} AS churn_rate
        FROM ({PROFILES}) u JOIN labeled f ON f.user_id = u.user_id GROUP BY u.customer_segment ORDER BY churn_rate DESC""",
    "p80_thresholds": WITH + P80,
    "p80_thresholds_by_rank": WITH + P80,
    "engineered_features": f"""{WITH} {ROUNDED} (
        SELECT user_id, {', '.join(C.MODEL_FEATURES)}, is_churned AS actual_churn FROM engineered)""",
    "model_matrix": f"""{WITH} {ROUNDED} (
        SELECT user_id, {INPUTS}, CAST(is_churned AS INTEGER) AS label FROM engineered)""",
    "class_weights": f"""{WITH}
        SELECT CAST(is_churned AS INTEGER) AS label, count(*) AS class_rows,
               (SELECT count(*) FROM labeled) / CAST(2 * count(*) AS DOUBLE) AS weight
        FROM labeled GROUP BY is_churned""",
    "stratified_split": f"{WITH} SELECT user_id, label, is_test FROM split",
    "stratified_folds": f"{WITH} SELECT user_id, label, CAST(fold AS INTEGER) AS fold FROM placed",
    "stratified_split_counts": f"{WITH} SELECT label, is_test, count(*) AS customers FROM split GROUP BY label, is_test",
    "stratified_fold_counts": f"""{WITH}
        SELECT label, CAST(fold AS INTEGER) AS fold, count(*) AS customers FROM placed GROUP BY label, fold""",
    "standardized_features": f"{WITH} SELECT user_id, is_test, {SCALED} FROM split",
    "churn_predictions": SCORED,
    "scoring_smoke": f"""{WITH}
        SELECT user_id, age, total_transactions, total_spent, is_churned AS actual_churn,
               round(churn_probability, 9) AS churn_probability, churn_prediction
        FROM predictions ORDER BY user_id LIMIT 10""",
    "prediction_summary": f"""{WITH}
        SELECT count(*) AS total_customers, count(*) FILTER (churn_prediction) AS predicted_churned,
               count(*) FILTER (is_churned) AS actual_churned, round(avg(churn_probability), 9) AS avg_churn_probability
        FROM predictions""",
    "high_risk_customers": f"""{WITH}
        SELECT u.user_id, u.email, u.customer_segment, p.total_spent
        FROM ({PROFILES}) u JOIN predictions p ON p.user_id = u.user_id WHERE p.churn_prediction
        ORDER BY p.total_spent DESC, u.user_id LIMIT 20""",
    "segment_risk_report": f"""{WITH}
        SELECT customer_segment, count(*) AS customers,
               CAST(sum(CAST(total_spent AS DECIMAL(18,2))) AS DOUBLE) AS revenue, {CHURN_RATE} AS churn_rate,
               count(*) FILTER (churn_prediction) AS predicted_churned,
               round(avg(churn_probability), 9) AS avg_churn_probability
        FROM predictions GROUP BY customer_segment""",
    "confusion_matrix": f"""{WITH}
        SELECT 0 AS label, 0 AS prediction, n00 AS rows FROM cells UNION ALL SELECT 0, 1, n01 FROM cells
        UNION ALL SELECT 1, 0, n10 FROM cells UNION ALL SELECT 1, 1, n11 FROM cells""",
    "classification_report": WITH + REPORT,
    "accuracy_and_auc": f"""{WITH},
        ranked AS (SELECT is_churned, is_churned = churn_prediction AS correct,
                          rank() OVER (ORDER BY churn_probability)
                          + (count(*) OVER (PARTITION BY churn_probability) - 1) / CAST(2 AS DOUBLE) AS mid_rank
                   FROM predictions)
        SELECT round(count(*) FILTER (correct) / count(*), 9) AS accuracy,
               round((sum(mid_rank) FILTER (is_churned)
                      - count(*) FILTER (is_churned) * (count(*) FILTER (is_churned) + 1) / CAST(2 AS DOUBLE))
                     / (count(*) FILTER (is_churned) * count(*) FILTER (NOT is_churned)), 9) AS auc
        FROM ranked""",
    "auc_small_scores": f"""{WITH},
        small AS (SELECT is_churned, days_since_last_transaction / CAST({2**60} AS DOUBLE) AS score FROM labeled),
        ranked AS (SELECT is_churned, (score > CAST(0.5 AS DOUBLE)) = is_churned AS correct,
                          rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) AS mid_rank
                   FROM small)
        SELECT count(*) FILTER (correct) / count(*) AS accuracy,
               round((sum(mid_rank) FILTER (is_churned)
                      - count(*) FILTER (is_churned) * (count(*) FILTER (is_churned) + 1) / CAST(2 AS DOUBLE))
                     / (count(*) FILTER (is_churned) * count(*) FILTER (NOT is_churned)), 9) AS auc
        FROM ranked""",
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "duplicate_rows": "SELECT *, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "duplicate_texts": """
        SELECT * EXCLUDE (doc_id), count(*) AS rows FROM documents GROUP BY ALL HAVING count(*) > 1""",
    "duplicate_summary": """
        SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, count(*) FILTER (n > 1) AS repeated_keys,
               CAST(sum(n - 1) AS BIGINT) AS surplus_rows
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "null_profile": " UNION ALL ".join(_null_line(field.name) for field in C.RAW_USERS),
    "range_profile": " UNION ALL ".join(_range_line(name) for name in ("o_orderkey", "o_custkey", "o_totalprice")),
    "range_violations": " UNION ALL ".join(
        [
            _outside_line("quantity", *C.QUANTITY_RANGE, "(SELECT CAST(l_quantity AS INTEGER) AS quantity FROM lineitem)"),
            _outside_line("price", *C.PRICE_RANGE, "(SELECT p_retailprice AS price FROM part)"),
            _outside_line("age", *C.AGE_RANGE, f"({PROFILES})"),
        ]
    ),
    "domain_violations": f"""
        SELECT 'category' AS column_name, p_type AS value, count(*) AS rows
        FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type NOT IN ({_names(C.CATEGORIES)}) GROUP BY p_type""",
    "segment_domain_violations": f"""
        SELECT 'customer_segment' AS column_name, c_mktsegment AS value, count(*) AS rows
        FROM customer WHERE c_mktsegment NOT IN ({_names(C.SEGMENTS)}) GROUP BY c_mktsegment
        UNION ALL
        SELECT 'payment_method', o_orderpriority, count(*)
        FROM orders WHERE o_orderpriority NOT IN ({_names(C.PAYMENT_METHODS)}) GROUP BY o_orderpriority""",
    "prediction_alignment": f"""{WITH}
        SELECT count(*) AS total_rows, count(*) FILTER (churn_prediction = is_churned) AS agreeing_rows,
               count(*) FILTER (churn_prediction = is_churned) / count(*) AS agreement_rate,
               count(*) FILTER (churn_prediction <> (churn_probability > CAST(0.5 AS DOUBLE))) AS inconsistent_rows
        FROM predictions""",
    "saved_model_scores": SCORED,
    "sql_function_view_scores": SCORED,
    "stream_scoring": SCORED,
    "rescored_with_current_thresholds": SCORED,
    "daily_pipeline": f"""{WITH} {ROUNDED} (
        SELECT *, true AS is_probability, true AS decision_follows, true AS function_agrees FROM labeled)""",
    "trained_model_comparison": f"""{WITH}
        SELECT c.position, c.model_type, count(*) FILTER (NOT is_test) AS train_rows, count(*) FILTER (is_test) AS test_rows,
               (SELECT count(DISTINCT fold) FROM split) AS folds, 0 AS broken_promises
        FROM split, {CANDIDATES} GROUP BY c.position, c.model_type""",
    "cross_validated_auc": f"""{WITH}
        SELECT c.model_type, CAST(fold AS INTEGER) AS fold, count(*) AS fold_rows, CAST(sum(label) AS BIGINT) AS churned,
               true AS auc_is_valid
        FROM split, {CANDIDATES} GROUP BY c.model_type, fold""",
    "feature_importances": " UNION ALL ".join(
        f"SELECT '{name}' AS feature, true AS is_share, true AS total_is_one" for name in C.MODEL_FEATURES
    ),
    "trained_model_scores": f"""{WITH}
        SELECT c.model_type, user_id, is_churned, true AS is_probability, true AS decision_follows, true AS same_after_reload
        FROM labeled, {CANDIDATES}""",
    "scoring_functions_by_name": f"""{WITH}
        SELECT user_id, round(churn_probability, 9) AS churn_probability, churn_prediction, churn_prediction AS churn,
               true AS forest_agrees, true AS same_again
        FROM predictions""",
    "raw_table_layouts": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {i} AS position, '{field.name}' AS column_name, "
        f"'{field.dataType.simpleString()}' AS type, 0 AS stored_rows, (SELECT count(*) FROM {source}) AS source_rows"
        for (table, layout), source in zip(C.RAW_TABLES.items(), ("customer", "part", "orders"))
        for i, field in enumerate(layout)
    ),
    "incremental_user_features": f"{ROUNDED} ({LABELED})",
    "incremental_fold_log": f"""
        WITH {LANDINGS}
        SELECT number AS landing, as_of, count(*) FILTER (greatest(due, landing) = number) AS folded,
               count(*) FILTER (landing <= number AND due > number) AS pending,
               count(DISTINCT CASE WHEN greatest(due, landing) = number THEN user_id % {BUCKETS} END) AS buckets_written
        FROM arrived, days GROUP BY number, as_of""",
    "late_event_activity": f"""
        WITH numbered AS (
            SELECT *, greatest(least(date_diff('day', DATE '{FIRST_EVENT_DAY}', CAST(ts AS DATE)) // 8 + 1, {EVENT_LANDINGS}), 1)
                      + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS landing FROM events),
        delivered AS (SELECT landing, ts FROM numbered
                      UNION ALL SELECT landing + 1, ts FROM numbered WHERE event_type = 'click'),
        marks AS (SELECT landing, epoch_ms(max(ts)) - 86400000 AS mark FROM delivered GROUP BY landing),
        before AS (SELECT n.landing, (SELECT max(mark) FROM marks m WHERE m.landing < n.landing) AS mark
                   FROM (SELECT DISTINCT landing FROM delivered) n),
        fresh AS (SELECT e.* FROM numbered e JOIN before b USING (landing) WHERE b.mark IS NULL OR epoch_us(ts) > b.mark * 1000)
        SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
        FROM fresh GROUP BY 1, 2 HAVING epoch_ms(CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP)) <= (SELECT max(mark) FROM marks)""",
    "distinct_users_in_ranges": f"""
        WITH weeks AS (SELECT DATE '{FIRST_EVENT_DAY}' + CAST(7 * i AS INTEGER) AS start FROM generate_series(0, 3) AS g(i)),
        ranges AS (SELECT a.start AS range_from, b.start + 6 AS range_to FROM weeks a JOIN weeks b ON a.start <= b.start)
        SELECT event_type, range_from, range_to, count(DISTINCT user_id) AS users, true AS within_bound
        FROM events JOIN ranges ON CAST(ts AS DATE) BETWEEN range_from AND range_to GROUP BY 1, 2, 3""",
    "sketched_thresholds": f"""{WITH}
        SELECT column_name, 3 AS batches, (SELECT count(*) FROM labeled) AS rows, true AS within_bound
        FROM (VALUES ('total_spent'), ('total_transactions')) AS c(column_name)""",
    "boosted_model_scores": f"""{WITH}
        SELECT user_id, is_churned, true AS is_probability, true AS decision_follows, true AS view_agrees, true AS native
        FROM labeled""",
    "last_order_before_shipping": """
        WITH bought AS (SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_shipdate AS shipped, o_custkey AS user_id
                        FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
        newest AS (SELECT o_custkey AS user_id, o_orderdate AS newest_date, max(o_orderkey) AS newest_order,
                          arg_max(o_totalprice, o_orderkey) AS newest_amount FROM orders GROUP BY 1, 2)
        SELECT b.*, n.newest_order, n.newest_date, n.newest_amount
        FROM bought b ASOF LEFT JOIN newest n ON b.user_id = n.user_id AND b.shipped >= n.newest_date""",
    "overlapping_orders": """
        WITH spans AS (
            SELECT o_orderkey AS id, o_custkey AS user_id, least(any_value(o_orderdate), min(l_shipdate)) AS opened,
                   greatest(any_value(o_orderdate), max(l_shipdate)) AS closed
            FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
        SELECT a.user_id, a.id AS first_order, b.id AS second_order,
               CAST(date_diff('day', CAST(greatest(a.opened, b.opened) AS DATE), CAST(least(a.closed, b.closed) AS DATE)) AS INTEGER)
                   AS days_together
        FROM spans a JOIN spans b ON a.user_id = b.user_id AND a.id < b.id AND a.opened <= b.closed AND b.opened <= a.closed""",
    "sales_cube": f"""
        SELECT customer_segment, category, month, CAST(grouping_id(customer_segment, category, month) AS BIGINT) AS grouping_id,
               count(*) AS rows, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount, max(amount) AS largest
        FROM ({SALES}) GROUP BY CUBE (customer_segment, category, month)""",
    "sales_by_month_and_segment": f"""
        SELECT month, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS all_amounts, """
    + ", ".join(
        f"CAST(sum(CAST(amount AS DECIMAL(18,2))) FILTER (customer_segment = '{name}') AS DOUBLE) AS \"{name}\"" for name in C.SEGMENTS
    )
    + f" FROM ({SALES}) GROUP BY month",
    "line_drift": " UNION ALL ".join(
        f"""
        SELECT * FROM (
            WITH sides AS (SELECT {name} AS v, l_shipdate >= DATE '1998-01-01' AS later FROM lineitem),
            sizes AS (SELECT count(*) FILTER (NOT later) AS a, count(*) FILTER (later) AS b FROM sides),
            steps AS (SELECT v, sum(count(*) FILTER (NOT later)) OVER w AS m, sum(count(*) FILTER (later)) OVER w AS n
                      FROM sides GROUP BY v WINDOW w AS (ORDER BY v)),
            edges AS (SELECT unnest(list_distinct(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS e
                      FROM sides WHERE NOT later),
            bins AS (SELECT v, later, (SELECT count(*) FROM edges WHERE e < v) AS bin FROM sides),
            shares AS (SELECT bin, greatest(count(*) FILTER (NOT later) / any_value(a), 1e-4) AS p,
                              greatest(count(*) FILTER (later) / any_value(b), 1e-4) AS q FROM bins, sizes GROUP BY bin)
            SELECT '{name}' AS column_name, a AS rows_before, b AS rows_now,
                   round((SELECT max(abs(m / a - n / b)) FROM steps), 9) AS ks,
                   round((SELECT sum((q - p) * ln(q / p)) FROM shares), 9) AS stability
            FROM sizes)"""
        for name in DRIFT_COLUMNS
    ),
    "reconciled_orders": f"""
        WITH landed AS ({TRANSACTIONS}),
        changed AS (SELECT * REPLACE (CASE WHEN transaction_id % 1999 <> 0 THEN payment_method END AS payment_method)
                    FROM landed WHERE transaction_id % 997 <> 0),
        stored AS (SELECT * FROM changed UNION ALL SELECT * FROM changed WHERE transaction_id % 1499 = 0),
        lost AS (SELECT *, 1 AS side FROM (SELECT * FROM landed EXCEPT ALL SELECT * FROM stored)
                 UNION ALL SELECT *, 2 FROM (SELECT * FROM stored EXCEPT ALL SELECT * FROM landed)),
        counted AS (
            SELECT d.* EXCLUDE (side),
                   (SELECT count(*) FROM landed l WHERE l.transaction_id = d.transaction_id
                                                    AND l.payment_method IS NOT DISTINCT FROM d.payment_method) AS landed_rows,
                   (SELECT count(*) FROM stored s WHERE s.transaction_id = d.transaction_id
                                                    AND s.payment_method IS NOT DISTINCT FROM d.payment_method) AS stored_rows
            FROM (SELECT DISTINCT * FROM lost) d)
        SELECT *, CASE WHEN stored_rows = 0 THEN 'missing' WHEN landed_rows = 0 THEN 'extra' ELSE 'repeated' END AS kind
        FROM counted""",
    "transaction_gaps": """
        WITH ordered AS (SELECT o_custkey AS user_id, date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER
                                (PARTITION BY o_custkey ORDER BY o_orderdate), CAST(o_orderdate AS DATE)) AS gap FROM orders)
        SELECT user_id, count(*) AS transactions, count(gap) AS gaps, round(avg(gap), 9) AS mean_gap,
               quantile_cont(CAST(gap AS DOUBLE), 0.5) AS median_gap, CAST(max(gap) AS INTEGER) AS longest_gap
        FROM ordered GROUP BY user_id""",
}

"""Table schemas and the values every job has to agree on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: raw table layouts (column order is also the CSV column order) -------------------

RAW_USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("email", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("signup_date", T.DateType()),
        T.StructField("country", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("customer_segment", T.StringType()),
    ]
)

RAW_PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("brand", T.StringType()),
    ]
)

RAW_TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("transaction_date", T.TimestampNTZType()),
        T.StructField("payment_method", T.StringType()),
    ]
)

RAW_TABLES = {
    "raw_users": RAW_USERS,
    "raw_products": RAW_PRODUCTS,
    "raw_transactions": RAW_TRANSACTIONS,
}

# --- Fixed values: declared domains, checked by patronlens.operators.quality -----------------------

SEGMENTS = ["Premium", "Standard", "Basic"]
CATEGORIES = ["Electronics", "Clothing", "Books", "Home", "Sports"]
PAYMENT_METHODS = ["Credit Card", "Debit Card", "PayPal", "Bank Transfer"]
AGE_RANGE = (18, 70)
PRICE_RANGE = (10, 500)
QUANTITY_RANGE = (1, 5)

# --- Fixed values: the feature table ---------------------------------------------------------------

USER_FEATURES = [
    "user_id",
    "age",
    "customer_segment",
    "total_transactions",
    "total_spent",
    "avg_transaction_amount",
    "max_transaction_amount",
    "min_transaction_amount",
    "transaction_frequency",
    "days_since_last_transaction",
    "transactions_last_30_days",
    "avg_days_between_transactions",
    "recency_score",
    "payment_method_count",
]

RECENT_DAYS = 30

# Churn rule: a clause applies to a customer with the given probability; any clause that fires churns.
STALE_AFTER_DAYS, STALE_PROBABILITY = 90, 0.3
CHURNING_SEGMENT, SEGMENT_PROBABILITY = "Basic", 0.4
SENIOR_ABOVE_AGE, SENIOR_PROBABILITY = 60, 0.2

# --- Fixed values: the model input -----------------------------------------------------------------

SEGMENT_CODES = {"Premium": 2, "Standard": 1, "Basic": 0}
HIGH_SHARE = 0.8  # a customer above this percentile is "high value" / "frequent"

# Order is part of the contract: it is the argument order of the SQL scoring functions too.
MODEL_FEATURES = [
    "age",
    "total_transactions",
    "total_spent",
    "avg_transaction_amount",
    "days_since_last_transaction",
    "transactions_last_30_days",
    "spend_per_transaction",
    "high_value_customer",
    "frequent_buyer",
    "recency_score",
    "payment_method_count",
    "customer_segment_encoded",
]

TEST_SHARE = 0.2
FOLDS = 5
SEED = 42
MIN_POSITIVES = 10
FOREST_TREES = 200
FOREST_DEPTH = 10
LOGISTIC_ITERATIONS = 1000
UNSCORABLE_PROBABILITY = 0.5  # what a row that the model cannot score gets
DECISION_THRESHOLD = 0.5  # churn is predicted strictly above
SCORE_DECIMALS = 9  # scores are compared and ranked at this precision

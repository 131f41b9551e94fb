"""Small hand-made tables."""

import datetime as dt
import random

from patronlens import contract as C

AS_OF = dt.date(2024, 7, 1)


def users(spark, rows):
    """rows: (user_id, age, segment)"""
    full = [(i, f"u{i}@example.invalid", "First", "Last", None, "X", age, segment) for i, age, segment in rows]
    return spark.createDataFrame(full, C.RAW_USERS)


def transactions(spark, rows):
    """rows: (transaction_id, user_id, amount, moment or age in days, method)"""
    full = []
    for transaction_id, user_id, amount, moment, method in rows:
        if isinstance(moment, int):
            moment = dt.datetime.combine(AS_OF, dt.time(12)) - dt.timedelta(days=moment)
        full.append((transaction_id, user_id, 1, 1, amount, amount, moment, method))
    return spark.createDataFrame(full, C.RAW_TRANSACTIONS)


def feature_rows(count, seed=0, label=None):
    """Feature rows in contract order plus the label; ``label`` maps (index, random) to a boolean."""
    rng = random.Random(seed)
    rows = []
    for i in range(1, count + 1):
        orders = rng.randint(1, 30)
        spent = round(rng.uniform(10, 5000), 2)
        days = rng.randint(0, 365)
        rows.append(
            (
                i,
                rng.randint(18, 70),
                rng.choice(C.SEGMENTS),
                orders,
                spent,
                spent / orders,
                spent,
                1.0,
                orders,
                days,
                rng.randint(0, 3),
                float(days),
                round(1 / (days + 1), 9),
                rng.randint(1, 4),
                label(days, rng) if label else rng.random() < 0.4,
            )
        )
    return rows


FEATURE_SCHEMA = (
    "user_id bigint, age int, customer_segment string, total_transactions bigint, total_spent double, "
    "avg_transaction_amount double, max_transaction_amount double, min_transaction_amount double, "
    "transaction_frequency bigint, days_since_last_transaction int, transactions_last_30_days bigint, "
    "avg_days_between_transactions double, recency_score double, payment_method_count bigint, is_churned boolean"
)


def features(spark, rows):
    return spark.createDataFrame(rows, FEATURE_SCHEMA)

"""Features that follow new transactions without reading the old ones again.

What the features need of a customer's past is kept as one row: sums and extremes that do not depend on the reporting date, and the number of
transactions of each day, from which the ages, the last 30 days and the recency follow for any later date. New transactions are first
combined per customer and day, then per customer, and are then added to the customer's row. Days after the reporting date wait outside.

All sums are of whole numbers (cents, counts, ages, fixed-point shares), so the features are those of a full computation to the last bit, in
whatever order and number of parts the transactions arrive; only what an amount has beyond whole cents is summed as a double.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens import contract as C
from patronlens.functions import age_in_days, beyond_cents, cents, from_cents, mean_of_shares, share_parts

SUMS = ("n", "ids", "amounts", "cents", "beyond")

PARTIALS = """
    user_id bigint, day date, n bigint, ids bigint, amounts bigint, cents bigint, beyond double,
    most double, least double, methods bigint, others array<string>
"""
STATE = """
    user_id bigint, n bigint, ids bigint, amounts bigint, cents bigint, beyond double, most double, least double,
    methods bigint, others array<string>, undated bigint, days map<date, bigint>
"""


def _combined() -> list[Column]:
    return [
        *[F.sum(name).alias(name) for name in SUMS],
        F.max("most").alias("most"),
        F.min("least").alias("least"),
        F.bit_or("methods").alias("methods"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("others")))).alias("others"),
    ]


def day_partials(transactions: DataFrame, usual_methods: list[str] = C.PAYMENT_METHODS) -> DataFrame:
    """One row per customer and day (null: undated), combined inside each task before the shuffle."""
    method = F.col("payment_method")
    bits = [F.when(method == name, F.lit(1 << i).cast("bigint")) for i, name in enumerate(usual_methods)]
    rows = transactions.select(
        "user_id",
        F.to_date("transaction_date").alias("day"),
        "transaction_id",
        F.col("total_amount").alias("amount"),
        F.coalesce(*bits, F.lit(None).cast("bigint")).alias("method"),
        F.when(~method.isin(list(usual_methods)), method).alias("other"),
    )
    return rows.groupBy("user_id", "day").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("transaction_id").alias("ids"),
        F.count("amount").alias("amounts"),
        F.coalesce(F.sum(cents("amount")), F.lit(0)).alias("cents"),
        F.coalesce(F.sum(beyond_cents("amount")), F.lit(0.0)).alias("beyond"),
        F.max("amount").alias("most"),
        F.min("amount").alias("least"),
        F.bit_or("method").alias("methods"),
        F.collect_set("other").alias("others"),
    )


def per_customer(partials: DataFrame) -> DataFrame:
    """The rows of ``day_partials``, of any number of loads, as one row of the state per customer."""
    by_day = partials.groupBy("user_id", "day").agg(*_combined())
    dated = F.when(F.col("day").isNotNull(), F.struct("day", "n"))
    return by_day.groupBy("user_id").agg(
        *_combined(),
        F.coalesce(F.sum(F.when(F.col("day").isNull(), F.col("n"))), F.lit(0)).alias("undated"),
        F.map_from_entries(F.collect_list(dated)).alias("days"),  # collect_list leaves nulls out: at most an entry per day
    )


def folded(state: DataFrame, arrived: DataFrame) -> DataFrame:
    """``state`` with the rows of ``arrived`` (both one row per customer) added."""
    old, new = state.alias("old"), arrived.alias("new")
    both = old.join(new, F.col("old.user_id").eqNullSafe(F.col("new.user_id")), "full")
    known, come = F.col("old.n").isNotNull(), F.col("new.n").isNotNull()

    def either(name: str, joined: Column) -> Column:
        return F.when(known & come, joined).when(known, F.col(f"old.{name}")).otherwise(F.col(f"new.{name}")).alias(name)

    def pair(name: str) -> tuple[Column, Column]:
        return F.col(f"old.{name}"), F.col(f"new.{name}")

    zero = F.lit(0).cast("bigint")
    days = F.map_zip_with(*pair("days"), lambda _, a, b: F.coalesce(a, zero) + F.coalesce(b, zero))
    bits = F.coalesce(pair("methods")[0].bitwiseOR(pair("methods")[1]), *pair("methods"))
    return both.select(
        F.coalesce(*pair("user_id")).alias("user_id"),
        *[either(name, pair(name)[0] + pair(name)[1]) for name in SUMS],
        either("most", F.greatest(*pair("most"))),
        either("least", F.least(*pair("least"))),
        either("methods", bits),
        either("others", F.array_sort(F.array_union(*pair("others")))),
        either("undated", pair("undated")[0] + pair("undated")[1]),
        either("days", days),
    )


def features_of(state: DataFrame, as_of: dt.date) -> DataFrame:
    """The columns of ``transaction_features`` for every customer of ``state``, which has no day after ``as_of``. No shuffle."""
    entries = F.map_entries("days")
    zero = F.lit(0).cast("bigint")

    def added(value) -> Column:
        """The sum over days of ``value`` (of the day's age) times the day's transactions."""
        return F.aggregate(
            entries, zero, lambda total, entry: total + value(age_in_days(entry["key"], as_of)).cast("bigint") * entry["value"]
        )

    def share(age: Column) -> Column:
        return F.lit(1.0) / (age + 1)

    dated = F.nullif(F.col("n") - F.col("undated"), F.lit(0))
    total = F.when(F.col("amounts") > 0, from_cents(F.col("cents")) + F.col("beyond"))
    mean = total / F.nullif(F.col("amounts"), F.lit(0))
    fronts, behinds = (added(lambda age, i=i: share_parts(share(age))[i]) for i in range(2))
    features = {
        "total_transactions": F.col("n"),
        "total_spent": total,
        "avg_transaction_amount": F.least(F.greatest(mean, F.col("least")), F.col("most")),
        "max_transaction_amount": F.col("most"),
        "min_transaction_amount": F.col("least"),
        "transaction_frequency": F.col("ids"),
        "days_since_last_transaction": age_in_days(F.array_max(F.map_keys("days")), as_of),
        "transactions_last_30_days": added(lambda age: F.when(age <= C.RECENT_DAYS, 1).otherwise(0)),
        "avg_days_between_transactions": added(lambda age: age).cast("double") / dated,
        "recency_score": mean_of_shares(fronts, behinds, dated),
        "payment_method_count": (F.coalesce(F.bit_count("methods"), F.lit(0)) + F.size("others")).cast("bigint"),
    }
    return state.select("user_id", *[features[name].alias(name) for name in C.USER_FEATURES[3:]])


def user_features_of(users: DataFrame, state: DataFrame, as_of: dt.date) -> DataFrame:
    """Demographics plus the features of the state; customers without transactions drop out."""
    profiles = users.select("user_id", "age", "customer_segment")
    return profiles.join(features_of(state, as_of), "user_id").select(*C.USER_FEATURES)

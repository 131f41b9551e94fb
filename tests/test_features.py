import datetime as dt

import pytest
from pyspark.sql import functions as F

from patronlens import contract as C
from patronlens.functions import uniform_draw
from patronlens.operators import features
from tests import samples
from tests.samples import AS_OF


def rows_by_user(df):
    return {row["user_id"]: row for row in df.collect()}


@pytest.fixture(scope="module")
def edge_features(spark):
    users = samples.users(spark, [(1, 30, "Premium"), (2, 65, "Basic"), (3, 40, "Gold"), (4, 20, "Standard"), (9, 50, "Basic")])
    transactions = samples.transactions(
        spark,
        [
            (1, 1, 10.0, 0, "PayPal"),
            (2, 1, 20.0, 30, "PayPal"),
            (3, 1, 30.25, 31, "Credit Card"),
            (4, 1, 5.0, dt.datetime(2024, 7, 2, 0, 0), "Cheque"),  # after the reporting date
            (5, 2, 1.1, 91, "Voucher"),
            (None, 2, 2.2, 91, None),
            (7, 2, None, 200, "Cheque"),
            (8, 3, 7.0, dt.datetime(2024, 6, 30, 23, 59, 59), "PayPal"),
            (9, 3, 7.0, dt.datetime(2024, 7, 1, 23, 59, 59), "PayPal"),
            (10, 4, None, 5, None),
            (11, 4, None, None, "PayPal"),  # undated
        ],
    )
    return rows_by_user(features.user_features(users, transactions, AS_OF))


def test_customers_without_transactions_drop_out(edge_features):
    assert sorted(edge_features) == [1, 2, 3, 4]


def test_boundary_days_and_rows_after_the_reporting_date(edge_features):
    row = edge_features[1]
    assert (row["total_transactions"], row["transactions_last_30_days"]) == (3, 2)
    assert row["days_since_last_transaction"] == 0
    assert row["total_spent"] == 60.25
    assert row["avg_transaction_amount"] == pytest.approx(60.25 / 3)
    assert row["recency_score"] == pytest.approx((1 + 1 / 31 + 1 / 32) / 3, abs=1e-9)
    assert row["avg_days_between_transactions"] == pytest.approx(61 / 3)
    assert row["payment_method_count"] == 2


def test_null_ids_amounts_and_methods(edge_features):
    row = edge_features[2]
    assert (row["total_transactions"], row["transaction_frequency"]) == (3, 2)
    assert row["total_spent"] == 3.3
    assert row["avg_transaction_amount"] == pytest.approx(1.65)
    assert (row["min_transaction_amount"], row["max_transaction_amount"]) == (1.1, 2.2)
    assert row["payment_method_count"] == 2  # two names outside the usual ones, and a null


def test_days_are_calendar_days(edge_features):
    row = edge_features[3]
    assert row["days_since_last_transaction"] == 0
    assert row["avg_days_between_transactions"] == 0.5


def test_customer_without_any_amount_and_with_an_undated_row(edge_features):
    row = edge_features[4]
    assert (row["total_spent"], row["avg_transaction_amount"]) == (None, None)
    assert (row["total_transactions"], row["days_since_last_transaction"]) == (2, 5)
    assert row["payment_method_count"] == 1


@pytest.mark.parametrize("hint", [[], ["A"], ["A", "B", "C"], ["Z"]])
def test_method_count_does_not_depend_on_the_hint(spark, hint):
    methods = ["A", "B", None, "A", "C", "D"]
    transactions = samples.transactions(spark, [(i, 1, 1.0, 1, m) for i, m in enumerate(methods)])
    assert features.transaction_features(transactions, AS_OF, hint).first()["payment_method_count"] == 4


def test_feature_columns_and_types(spark):
    empty = features.user_features(samples.users(spark, []), samples.transactions(spark, []), AS_OF)
    assert empty.columns == C.USER_FEATURES
    assert dict(features.with_churn_label(empty).dtypes) == {
        name: kind for name, kind in (part.strip().split(" ") for part in samples.FEATURE_SCHEMA.split(","))
    }
    assert empty.count() == 0


def test_sums_do_not_depend_on_partitioning(spark):
    rows = [(i, 1 + i % 3, (i * 37 % 1000) / 100 + 0.01, i % 200, "PayPal") for i in range(600)]
    transactions = samples.transactions(spark, rows)
    users = samples.users(spark, [(1, 20, "Basic"), (2, 65, "Basic"), (3, 66, "Premium")])

    def run(partitions):
        labeled = features.with_churn_label(features.user_features(users, transactions.repartition(partitions), AS_OF))
        return sorted(labeled.collect())

    assert run(1) == run(13)
    assert sum(row["total_spent"] for row in run(1)) == pytest.approx(sum(row[2] for row in rows))


def test_label_clauses(spark):
    many = 4000
    rows = samples.feature_rows(many, seed=3)
    stale = [(r[0], 30, "Premium", *r[3:9], 91, *r[10:]) for r in rows]
    fresh = [(r[0], 60, "Premium", *r[3:9], 90, *r[10:]) for r in rows]
    basic = [(r[0], 30, "Basic", *r[3:9], 1, *r[10:]) for r in rows]
    senior = [(r[0], 61, "Standard", *r[3:9], 1, *r[10:]) for r in rows]
    unknown = [(r[0], None, None, *r[3:9], None, *r[10:]) for r in rows]

    def rate(sample):
        df = features.with_churn_label(samples.features(spark, sample).drop("is_churned"))
        return df.agg(F.avg(F.col("is_churned").cast("int"))).first()[0]

    assert rate(stale) == pytest.approx(0.3, abs=0.03)
    assert rate(basic) == pytest.approx(0.4, abs=0.03)
    assert rate(senior) == pytest.approx(0.2, abs=0.03)
    assert rate(fresh) == 0
    assert rate(unknown) == 0  # never null


def test_draws_cover_the_unit_interval_for_any_id(spark):
    ids = spark.range(-1000, 9000).union(spark.range(2**62, 2**62 + 1000))
    low, high, mean = ids.select(uniform_draw("id", "split").alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < high < 1
    assert mean == pytest.approx(0.5, abs=0.02)


def test_statistics_and_distribution(spark):
    df = samples.features(spark, samples.feature_rows(50, label=lambda days, rng: days > 300))
    churned = df.where("is_churned").count()
    assert features.feature_statistics(df).first()[:2] == (50, churned)
    counts = features.churn_value_counts(df).collect()
    assert [row["customers"] for row in counts] == [50 - churned, churned]
    assert counts[1]["share_pct"] == pytest.approx(churned * 2)
    assert features.feature_statistics(df.limit(0)).first()[:3] == (0, 0, None)


def test_amounts_below_a_cent_are_kept(spark):
    rows = [(1, 1, 0.004, 1, "PayPal"), (2, 2, 0.1, 1, "PayPal"), (3, 2, 0.1, 1, "PayPal"), (4, 2, 0.1, 1, "PayPal"), (5, 3, 1234567.891, 1, None)]
    rows += [(10 + i, 4, 0.0005 * i, 1, "PayPal") for i in range(1, 40)]
    for row in features.transaction_features(samples.transactions(spark, rows), samples.AS_OF).collect():
        assert row["min_transaction_amount"] <= row["avg_transaction_amount"] <= row["max_transaction_amount"]
        own = [r[2] for r in rows if r[1] == row["user_id"]]
        assert row["total_spent"] == pytest.approx(sum(own), rel=1e-12)
    one = features.transaction_features(samples.transactions(spark, rows[:1]), samples.AS_OF).first()
    assert (one["total_spent"], one["avg_transaction_amount"]) == (0.004, 0.004)


def test_recency_is_stored_with_all_its_digits(spark):
    rows = [(i, 1, 1.0, i * 37 % 300, "PayPal") for i in range(1, 8)]
    got = features.transaction_features(samples.transactions(spark, rows), samples.AS_OF).first()["recency_score"]
    assert got == pytest.approx(sum(1 / (r[3] + 1) for r in rows) / 7, rel=1e-14) and got != round(got, 9)


def test_too_many_usual_methods_is_an_error(spark):
    with pytest.raises(ValueError, match="62"):
        features.transaction_features(samples.transactions(spark, []), samples.AS_OF, [str(i) for i in range(63)])

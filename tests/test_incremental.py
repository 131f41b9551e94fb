import datetime as dt
import random
import threading

import pytest

from patronlens import contract as C
from patronlens.operators.features import transaction_features, user_features
from patronlens.operators.incremental import features_of
from patronlens.plans import pipeline
from patronlens.plans.pipeline import build_features
from patronlens.shared import deleted_afterwards, exists, new_path, shared_dir, side_by_side, write_table
from patronlens.sources.csv_files import write_csv
from patronlens.sources.feature_state import PENDING, FeatureState
from patronlens.sources.warehouse import Warehouse
from tests import samples

DAYS = [samples.AS_OF + dt.timedelta(days=d) for d in (-20, -3, 0)]


def rows_of(seed, count, customers=40):
    """Transactions of 200 days up to ten days after the reporting date, some undated, without id, method or amount."""
    draw = random.Random(seed)
    return [
        (
            i if draw.random() < 0.95 else None,
            draw.randrange(customers) if draw.random() < 0.7 else 7,  # one customer holds a third
            round(draw.uniform(0, 500), 2) if draw.random() < 0.95 else None,
            draw.randint(-10, 200) if draw.random() < 0.95 else None,
            draw.choice([*C.PAYMENT_METHODS, "Cash", "Voucher", None]),
        )
        for i in range(count)
    ]


def features(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_equal_to_a_full_computation_after_every_landing(spark):
    rows = rows_of(1, 900)
    random.Random(2).shuffle(rows)  # out of order: every landing has days of the whole time
    folder, state = new_path(spark, "arriving"), FeatureState(spark, new_path(spark, "state"), buckets=8)
    for i, as_of in enumerate(DAYS):
        samples.transactions(spark, rows[i * 300 : (i + 1) * 300]).repartition(3).write.mode("append").parquet(folder)
        state.load(folder)
        fold = state.fold(as_of)
        whole = samples.transactions(spark, rows[: (i + 1) * 300])
        assert features(features_of(state.read(), as_of)) == features(transaction_features(whole, as_of))
        assert fold.pending == sum(r[3] is not None and (samples.AS_OF - dt.timedelta(days=r[3])) > as_of for r in rows[: (i + 1) * 300])
    later = samples.AS_OF + dt.timedelta(days=20)
    fold = state.fold(later)  # nothing new but what had waited
    assert fold.pending == 0 < fold.folded and PENDING not in state.manifest().files
    assert features(features_of(state.read(), later)) == features(transaction_features(samples.transactions(spark, rows), later))
    assert state.fold(later).buckets == []
    with pytest.raises(ValueError, match="full computation"):
        state.fold(DAYS[0])
    with pytest.raises(ValueError, match="other buckets"):
        FeatureState(spark, state.root, buckets=9).manifest()


def test_only_touched_buckets_are_read_and_written(spark):
    folder, state = new_path(spark, "arriving"), FeatureState(spark, new_path(spark, "state"), buckets=8)
    samples.transactions(spark, rows_of(3, 400)).write.parquet(folder)
    state.load(folder)
    state.fold(DAYS[0])
    before = state.manifest()
    samples.transactions(spark, [(9000, 3, 1.0, 30, "Cash"), (9001, 11, 2.0, 31, None)]).write.mode("append").parquet(folder)
    state.load(folder)
    fold = state.fold(DAYS[0])
    after = state.manifest()
    assert fold.buckets == [3] and fold.folded == 2
    assert {b for b in before.files if b != PENDING and before.files[b] != after.files[b]} == {3}
    assert before.files[3] in fold.files_read and not any(before.files[b] in fold.files_read for b in before.files if b not in (3, PENDING))
    assert exists(spark, before.files[3])  # for whoever still reads it
    samples.transactions(spark, [(9002, 4, 1.0, 30, "Cash")]).write.mode("append").parquet(folder)
    state.load(folder)
    state.fold(DAYS[0])
    assert not exists(spark, before.files[3]) and exists(spark, state.manifest().files[3])


def test_a_fold_that_fails_changes_nothing(spark, monkeypatch):
    folder, state = new_path(spark, "arriving"), FeatureState(spark, new_path(spark, "state"), buckets=4)
    rows = rows_of(4, 200)
    samples.transactions(spark, rows[:100]).write.parquet(folder)
    state.load(folder)
    state.fold(DAYS[0])
    samples.transactions(spark, rows[100:]).write.mode("append").parquet(folder)
    state.load(folder)
    with monkeypatch.context() as patched:
        patched.setattr(FeatureState, "_drop_replaced", lambda *_: None)
        patched.setattr("patronlens.sources.feature_state.MANIFEST", "no such type")
        with pytest.raises(Exception):
            state.fold(DAYS[1])
    assert state.manifest().as_of == DAYS[0]
    state.fold(DAYS[1])
    assert features(features_of(state.read(), DAYS[1])) == features(transaction_features(samples.transactions(spark, rows), DAYS[1]))


def test_nothing_arrived(spark):
    state = FeatureState(spark, new_path(spark, "state"))
    state.load("file:/no/such/folder")
    fold = state.fold(DAYS[0])
    assert (fold.folded, fold.pending, fold.buckets) == (0, 0, []) and state.read().count() == 0
    assert features_of(state.read(), DAYS[0]).columns == ["user_id", *C.USER_FEATURES[3:]]


def test_features_need_no_shuffle(spark):
    state = FeatureState(spark, new_path(spark, "state"))
    plan = features_of(state.read(), DAYS[0])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_daily_features_of_appended_transactions_read_no_history(spark, monkeypatch):
    warehouse = Warehouse(spark, "incremental_daily_", new_path(spark, "warehouse")).create()
    users = samples.users(spark, [(i, 18 + i % 53, C.SEGMENTS[i % 3]) for i in range(40)])
    inbox, landing = new_path(spark, "users"), new_path(spark, "landing")
    write_csv(users, inbox)
    warehouse.append_csv("raw_users", inbox)
    rows = rows_of(5, 300)
    for i, as_of in enumerate(DAYS):
        write_csv(samples.transactions(spark, rows[i * 100 : (i + 1) * 100]), f"{landing}/{i}")
        warehouse.append_csv("raw_transactions", f"{landing}/*")
        with monkeypatch.context() as patched:
            patched.setattr(pipeline, "user_features", None)  # the full computation is not called
            stored = build_features(warehouse, as_of)
        want = user_features(users, samples.transactions(spark, rows[: (i + 1) * 100]), as_of)
        assert features(stored.drop("is_churned")) == features(want)
    earlier = build_features(warehouse, DAYS[0])  # a date that went back
    assert features(earlier.drop("is_churned")) == features(user_features(users, samples.transactions(spark, rows), DAYS[0]))


def test_a_first_landing_without_files(spark, tmp_path):
    warehouse = Warehouse(spark, "incremental_empty_", new_path(spark, "warehouse")).create()
    assert warehouse.append_csv("raw_users", str(tmp_path)).count() == 0
    assert warehouse.append_csv("raw_transactions", str(tmp_path)).schema == C.RAW_TRANSACTIONS
    assert build_features(warehouse, DAYS[0]).count() == 0
    write_csv(samples.users(spark, [(1, 30, "Basic")]), f"{tmp_path}/users")
    assert warehouse.append_csv("raw_users", f"{tmp_path}/users").count() == 1


def test_two_queries_at_once_keep_their_own_tables(spark):
    started, ended = threading.Event(), threading.Event()
    df, kept = spark.range(3), []

    def long():
        with deleted_afterwards(spark):
            kept.append(write_table(df, "long"))
            started.set()
            ended.wait(60)
            assert spark.read.parquet(kept[0]).count() == 3

    def short():
        started.wait(60)
        with deleted_afterwards(spark):
            write_table(df, "short")
        ended.set()

    side_by_side([long, short], 2)
    assert not exists(spark, kept[0])


def test_threads_of_a_block_leave_nothing(spark):
    with deleted_afterwards(spark):
        paths = side_by_side([lambda i=i: write_table(spark.range(i), "part") for i in range(3)], 3)
        assert [spark.read.parquet(p).count() for p in paths] == [0, 1, 2]
    assert not any(exists(spark, p) for p in paths)


def test_a_cluster_has_to_name_a_shared_folder():
    class Session:
        class sparkContext:
            master = "local-cluster[2,1,1024]"

        class conf:
            @staticmethod
            def get(key, default=None):
                return "file:/tmp/warehouse" if key == "spark.sql.warehouse.dir" else default

    with pytest.raises(RuntimeError, match="all executors"):
        shared_dir(Session)
    Session.sparkContext.master = "local[4]"
    assert shared_dir(Session) == "file:/tmp/warehouse"

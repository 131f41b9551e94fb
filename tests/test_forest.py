import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from patronlens import contract as C
from patronlens.operators.dataset import with_class_weight
from patronlens.operators.engineered import Thresholds, model_matrix
from patronlens.operators.scoring import ChurnModel, score_features
from patronlens.plans import forest, training
from patronlens.sources.model_store import ModelStore
from patronlens.sources.sql_functions import tree_table
from tests import samples

INPUTS = [f"_in_{name}" for name in C.MODEL_FEATURES]
LIMITS = Thresholds(3000.0, 20.0)
SETTINGS = training.TrainingSettings(trees=6, depth=4, folds=0)
PIPELINE = training.candidate_pipeline


@pytest.fixture(scope="module")
def features(spark):
    return samples.features(spark, samples.feature_rows(500, label=lambda days, rng: rng.random() < days / 400)).cache()


@pytest.fixture(scope="module")
def rows(features):
    return with_class_weight(training.pipeline_inputs(model_matrix(features, LIMITS))).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return forest.fit_forest(rows, INPUTS, PIPELINE(training.FOREST, 500, SETTINGS))


def stored_nodes(spark, fitted, tmp_path):
    fitted.stages[-1].write().save(f"file://{tmp_path}/m")
    return spark.read.parquet(f"file://{tmp_path}/m/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()


def test_every_split_is_the_best_of_four_inputs_over_all_drawn_rows(spark, rows, fitted, tmp_path):
    """Walked down by hand: counts by class, gain, and no better cut of the chosen input at any node."""
    kept = rows.select(*INPUTS, "label", "weight", F.xxhash64(*rows.columns).alias("key")).collect()
    x, label, weight = np.array([r[:12] for r in kept]), np.array([r["label"] for r in kept]), np.array([r["weight"] for r in kept])
    keys = np.array([r["key"] for r in kept], np.int64).view(np.uint64)

    def impurity(at):
        sums = np.array([total[at & (label == k)].sum() for k in (0, 1)])
        return 1 - ((sums / sums.sum()) ** 2).sum(), sums

    nodes = {(n["treeID"], n["id"]): n for n in stored_nodes(spark, fitted, tmp_path)}
    assert {tree for tree, _ in nodes} == set(range(6))
    checked = 0
    for tree in range(6):
        times = forest.DRAWS[forest.hashes(keys, tree // 4, C.SEED).view(np.uint16).reshape(-1, 4)[:, tree % 4]].astype(float)
        total, waiting = times * weight, [(0, np.ones(len(x), bool), 0)]
        while waiting:
            number, at, depth = waiting.pop()
            node = nodes[tree, number]
            own, sums = impurity(at)
            assert node["impurityStats"] == pytest.approx(sums) and node["rawCount"] == times[at].sum()
            assert node["prediction"] == sums.argmax() and node["impurity"] == pytest.approx(own)
            if node["leftChild"] < 0:
                continue
            column = x[:, node["split"]["featureIndex"]]
            cuts = forest.cuts_of(x[:, node["split"]["featureIndex"]])
            gains = []
            for cut in cuts:
                left, right = at & (column <= cut), at & (column > cut)
                if min(times[left].sum(), times[right].sum()) < 2:
                    gains.append(-1.0)
                    continue
                (of_left, at_left), (of_right, at_right) = impurity(left), impurity(right)
                gains.append(own - (at_left.sum() * of_left + at_right.sum() * of_right) / sums.sum())
            threshold = node["split"]["leftCategoriesOrThreshold"][0]
            assert node["gain"] == pytest.approx(max(gains)) == pytest.approx(gains[list(cuts).index(threshold)])
            assert depth < 4
            waiting += [(node["leftChild"], at & (column <= threshold), depth + 1), (node["rightChild"], at & (column > threshold), depth + 1)]
            checked += 1
    assert checked > 30


def test_partitions_and_blocks_do_not_change_the_forest(rows, fitted, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK", 100)
    again = forest.fit_forest(rows.repartition(3), INPUTS, PIPELINE(training.FOREST, 500, SETTINGS))
    assert again.stages[-1].toDebugString.split("\n")[1:] == fitted.stages[-1].toDebugString.split("\n")[1:]


def test_draws_are_those_of_a_bootstrap():
    keys = np.random.default_rng(1).integers(0, 2**63, 200_000).astype(np.uint64)
    for four in (0, 7):
        drawn = forest.DRAWS[forest.hashes(keys, four, 42).view(np.uint16).reshape(-1, 4)]
        assert drawn.mean(axis=0) == pytest.approx(np.ones(4), abs=0.02) and drawn.var(axis=0) == pytest.approx(np.ones(4), abs=0.03)
        assert np.abs(np.corrcoef(drawn.T) - np.eye(4)).max() < 0.02


def test_cuts_lie_between_the_values():
    assert forest.cuts_of(np.array([0.0, 1.0, 0.0, 4.0])).tolist() == [0.5, 2.5]
    assert forest.cuts_of(np.array([3.0, 3.0])).tolist() == forest.cuts_of(np.array([])).tolist() == []
    many = forest.cuts_of(np.arange(1000.0))
    assert len(many) == forest.BINS - 1 and np.abs(np.diff(many) - 1000 / 32).max() < 2


def test_one_class_gives_bare_roots(spark, rows):
    model = forest.fit_forest(rows.where("label = 0"), INPUTS, PIPELINE(training.FOREST, 500, SETTINGS))
    assert model.stages[-1].totalNumNodes == 6
    assert model.transform(rows).agg(F.max(vector_to_array("probability")[1])).first()[0] == 0.0


def test_forests_of_many_rows_are_grown_stored_and_scored_alike(spark, features, monkeypatch, tmp_path):
    few = training.train_churn_model(features, training.TrainingSettings(candidates=(training.FOREST,), trees=20, depth=5, folds=2))
    grown = []
    monkeypatch.setattr(training, "LIBRARY_ROWS", 100)
    monkeypatch.setattr(training, "fit_forest", lambda *a: grown.append(a) or forest.fit_forest(*a))
    many = training.train_churn_model(features, training.TrainingSettings(candidates=(training.FOREST,), trees=20, depth=5, folds=2))
    assert len(grown) == 3
    assert many.metrics.first()["cv_auc_mean"] == pytest.approx(few.metrics.first()["cv_auc_mean"], abs=0.05)
    assert many.importances.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    store = ModelStore(spark, f"file://{tmp_path}/models")
    store.publish(many.model)
    before, after = (score_features(features, model).select("churn_probability").collect() for model in (many.model, store.latest()))
    assert before == after and len({row[0] for row in before}) > 100
    assert len(tree_table(spark, many.model.pipeline).first()["trees"]) == 20
    assert isinstance(many.model, ChurnModel)


def test_scores_by_block_are_those_of_the_library(rows, fitted, monkeypatch):
    monkeypatch.setattr(forest, "SCORED", 64)
    edge = rows.limit(1).withColumns({name: F.lit(value) for name, value in zip(INPUTS, [float("inf"), float("-inf"), -0.0] * 4)})
    one_class = forest.fit_forest(rows.where("label = 0"), INPUTS, PIPELINE(training.FOREST, 500, SETTINGS))
    for model in (fitted, one_class):
        found = forest.scored_by(model, rows.union(edge), INPUTS)
        expected = model.transform(rows.union(edge)).select(
            "user_id", "label", F.col("prediction").cast("int"), vector_to_array("probability")[1].alias("churn_probability")
        )
        assert found.columns == expected.columns and found.count() == 501
        assert sorted(found.collect()) == sorted(expected.collect())  # to the last bit
    missing = rows.limit(1).withColumn(INPUTS[3], F.lit(float("nan")))
    with pytest.raises(Exception, match="without a value"):
        forest.scored_by(fitted, missing, INPUTS).collect()


def test_test_rows_of_grown_forests_are_scored_by_block(features, monkeypatch):
    scored = []
    monkeypatch.setattr(training, "LIBRARY_ROWS", 100)
    monkeypatch.setattr(training, "scored_by", lambda *a: scored.append(a) or forest.scored_by(*a))
    settings = training.TrainingSettings(candidates=(training.FOREST,), trees=4, depth=3, folds=2)
    result = training.train_churn_model(features, settings)
    assert len(scored) == 3
    table = result.scored[training.FOREST]
    assert table.count() == result.split.where("is_test").count()

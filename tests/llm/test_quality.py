import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronlens.llm import quality
from patronlens.llm.folds import held_out
from tests.llm.samples import AWKWARD, documents, invented


@pytest.fixture(scope="module")
def labelled(spark):
    draw = random.Random(1)
    good = invented(21, 250, words=120)
    bad = [" ".join(w.upper() + draw.choice(["!!", "###"]) for w in text.split()) for text in invented(21, 250, words=120)]
    texts = [(i, t) for i, t in enumerate(good + bad)]
    labels = spark.createDataFrame([(i, int(i < 250)) for i, _ in texts], "doc_id long, quality int")
    return documents(spark, texts).cache(), labels.cache()


def auc(scores, labels):
    scores, labels = np.array(scores), np.array(labels)
    above = (scores[labels == 1][:, None] > scores[labels == 0]) + 0.5 * (scores[labels == 1][:, None] == scores[labels == 0])
    return above.mean()


def test_held_out_documents(spark, labelled):
    docs, labels = labelled
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert auc([r.score for r in held], [r.quality for r in held]) > 0.95
    assert abs(np.mean([r.score for r in held]) - np.mean([r.quality for r in held])) < 0.1


def test_held_out_labels_are_not_learned(spark, labelled):
    docs, labels = labelled
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, labels.repartition(7)) == quality.train(docs.repartition(5), turned)


def test_missing_labels(spark, labelled):
    docs, labels = labelled
    for some, expected in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0), (labels.withColumn("quality", F.lit(None).cast("int")), 0.5)):
        scores = {round(r.score, 3) for r in quality.score(docs.limit(5), quality.train(docs, some)).collect()}
        assert scores == {expected}
    few = labels.where(~held_out(F.col("doc_id"))).orderBy("doc_id").limit(1).unionAll(labels.where("doc_id >= 250").limit(3))
    assert quality.score(docs, quality.train(docs, few)).where("score between 0 and 1").count() == docs.count()


def test_awkward_rows(spark, labelled):
    model = quality.train(*labelled)
    df = documents(spark, AWKWARD, clashing=True)
    got = quality.score(df, model)
    assert got.columns == [*(c for c in df.columns if c != "score"), "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 and r.row == "own row" for r in rows)
    empty = 1 / (1 + np.exp(-model.offset))
    assert all(abs(r.score - empty) < 1e-12 for r in rows if not r.text)
    assert quality.score(df.limit(0), model).collect() == []
    assert quality.train(labelled[0].limit(0), labelled[1]).slope == 0


def test_margin_is_the_difference_of_the_sums():
    import pyarrow as pa
    import zstandard

    made = [zstandard.ZstdCompressionDict(x * 40, dict_type=zstandard.DICT_TYPE_RAWCONTENT).as_bytes() for x in (b"good prose ", b"BAD!! ")]
    texts = ["good prose " * 100, "BAD!! " * 100, "", None]
    margins = quality.Margins(*made).of(pa.array(texts))
    assert margins[0] > 0 > margins[1] and margins[2] == margins[3] == 0


def test_scores_equal_a_plain_computation(labelled):
    import zstandard

    model = quality.train(*labelled)

    def size(content, piece):
        dictionary = zstandard.ZstdCompressionDict(content)
        dictionary.precompute_compress(level=quality.LEVEL)
        options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        return len(zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=dictionary, **options).compress(piece))

    rows = quality.score(labelled[0], model).orderBy("doc_id").limit(25).collect()
    for row in rows:
        data = (row.text or "").encode()
        pieces = [data[at : at + quality.PIECE] for at in range(0, len(data), quality.PIECE)]
        margin = sum(size(model.bad, piece) - size(model.good, piece) for piece in pieces) / max(1, len(data))
        expected = 1 / (1 + np.exp(-(model.slope * margin + model.offset)))
        assert abs(row.score - expected) < 1e-9 and row.predicted == int(expected >= 0.3)


def test_logistic_curve():
    draw = np.random.default_rng(2)
    x = draw.normal(0, 0.05, 20_000)
    y = (draw.random(20_000) < 1 / (1 + np.exp(-(30 * x + 1)))).astype(float)
    slope, offset = quality.logistic_curve(x, y)
    assert abs(slope - 30) < 2 and abs(offset - 1) < 0.1
    assert np.isfinite(quality.logistic_curve(np.array([0.0, 0.1]), np.array([0.0, 1.0]))).all()
    assert np.isfinite(quality.logistic_curve(np.zeros(4), np.array([0.0, 1.0, 1.0, 1.0]))).all()

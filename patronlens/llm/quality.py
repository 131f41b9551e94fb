"""Quality classifier by compression: texts of good and of bad quality each give a zstandard dictionary.

A text is cut into pieces of ``PIECE`` bytes, and each is compressed with either dictionary. The difference of the two summed sizes, bad
minus good, over the size of the text is its margin; whole texts are read, and as the pieces are small, long texts are judged by all
they contain and not by how they repeat themselves. A logistic curve fitted to labelled texts that took no part in the dictionaries turns
margins into probabilities of label 1.

Only labelled rows outside the held-out fold are learned from, in bounded samples: ``SAMPLE`` documents of each label give a stretch of
``STRETCH`` characters for the dictionaries, and ``CALIBRATION`` others are scored whole for the curve. They are chosen by a hash of the
id. The driver sees the stretches, the margins and the dictionaries; documents are never shuffled, as only the chosen ids are broadcast.

Defined cases: a null or empty text has margin 0; repeated rows get equal scores; labels that are null or neither 0 nor 1 are ignored,
and a document with several labels counts once for each. If one of the two labels is missing, every score is the share of label 1, or
0.5 without labels. Further columns pass through; those named like a result are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.bytewords import slices_by_bytes, text_bytes
from patronlens.llm.folds import draw, held_out, stretch

PIECE = 256
DICTIONARY = 256 << 10
SAMPLE = 4000
STRETCH = 2048
CALIBRATION = 6000
LEVEL = 3
THRESHOLD = 0.3
SLICE_BYTES = 1 << 20
RESULT = ("held_out", "score", "predicted")


def pieces_of(text: bytes) -> list[bytes]:
    return [text[at : at + PIECE] for at in range(0, len(text), PIECE)]


def dictionary(pieces: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the pieces; of the pieces themselves where there are too few to train on."""
    try:
        made = zstandard.train_dictionary(DICTIONARY, pieces)
    except (zstandard.ZstdError, ValueError):
        made = zstandard.ZstdCompressionDict(b"".join(pieces)[:DICTIONARY], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return made


class Margins:
    def __init__(self, good: bytes, bad: bytes):
        self.compress = [self._compressor(content).compress for content in (bad, good)]

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        made = zstandard.ZstdCompressionDict(content)
        made.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def of(self, texts: pa.Array) -> np.ndarray:
        data, offsets = text_bytes(texts)
        data, bad, good = data.tobytes(), *self.compress
        margins = np.zeros(len(texts))
        for i, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            difference = 0
            for at in range(start, end, PIECE):
                piece = data[at : min(at + PIECE, end)]
                difference += len(bad(piece)) - len(good(piece))
            margins[i] = difference / max(1, end - start)
        return margins


@dataclass(frozen=True)
class Model:
    """``good`` and ``bad`` are dictionaries; score = 1 / (1 + exp(-(slope * margin + offset)))."""

    good: bytes
    bad: bytes
    slope: float
    offset: float

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -700, 700)))


def logistic_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method; a small penalty on the slope (in units of x's spread) keeps separable labels finite."""
    scale = float(x.std()) or 1.0
    columns = np.stack([x / scale, np.ones_like(x)], axis=1)
    penalty = np.diag([1e-2, 1e-9])
    weights = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(columns @ weights, -500, 500)))
        gradient = columns.T @ (p - y) + penalty @ weights
        hessian = (columns * (p * (1 - p))[:, None]).T @ columns + penalty + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        weights = weights - step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0] / scale), float(weights[1])


def _with_margins(rows: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """``rows`` (row, text) as (row, margin)."""
    dictionaries = rows.sparkSession.sparkContext.broadcast((good, bad))
    schema = rows.select("row", F.lit(0.0).alias("margin")).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = Margins(*dictionaries.value)
        for batch in slices_by_bytes(batches, 1, SLICE_BYTES):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(margins.of(batch.column(1)))], names=["row", "margin"]
            )

    return rows.mapInArrow(scan, schema)


def train(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Model:
    order = draw(F.col("doc_id"), seed=seed)
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", "quality", order.alias("order"))
    # the two samples share no document: one is drawn from the lower half of the order, one from the upper
    chosen = None
    for half, label, most in ((0, 0, SAMPLE), (0, 1, SAMPLE), (1, None, CALIBRATION)):
        part = known.where((F.col("order") >= 0.5) == bool(half))
        part = part if label is None else part.where(F.col("quality") == label)
        part = part.orderBy("order", "doc_id").limit(most).select("doc_id", "quality", F.lit(half).alias("half"), "order")
        chosen = part if chosen is None else chosen.unionAll(part)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 * SAMPLE + CALIBRATION ids
    stretches = (
        sample.where("half = 0")
        .select("quality", "order", stretch(F.col("text"), STRETCH, F.col("order") * 2).alias("text"))
        .orderBy("order", "text")
        .limit(4 * SAMPLE)
        .collect()
    )
    contents = []
    for label in (1, 0):
        own = dict.fromkeys(piece for row in stretches if row.quality == label for piece in pieces_of((row.text or "").encode()))
        contents.append(dictionary(list(own)).as_bytes() if own else b"")
    if not all(contents):
        share = known.agg(F.avg("quality")).first()[0]
        share = 0.5 if share is None else min(max(share, 1e-6), 1 - 1e-6)
        return Model(b"", b"", 0.0, float(np.log(share / (1 - share))))
    rows = sample.where("half = 1").select(F.struct("quality", "order").alias("row"), "text")
    margins = _with_margins(rows, *contents).select("margin", "row.quality", "row.order")
    # repeated ids give several texts each; at most four times the sample comes to the driver, the same rows in every run
    scored = sorted(margins.orderBy("order", "margin", "quality").limit(4 * CALIBRATION).select("margin", "quality").collect())
    x, y = np.array([row.margin for row in scored]), np.array([row.quality for row in scored], dtype=float)
    if len(set(y.tolist())) < 2:
        return Model(*contents, 1.0, 0.0)
    return Model(*contents, *logistic_curve(x, y))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in RESULT)).alias("row"), "text")
    margins = _with_margins(rows, model.good, model.bad)
    logit = F.least(F.greatest(F.col("margin") * model.slope + model.offset, F.lit(-700.0)), F.lit(700.0))
    return (
        margins.withColumn("score", 1 / (1 + F.exp(-logit)))
        .select(
            "row.*",
            held_out(F.col("row.doc_id")).alias("held_out"),
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        )
    )

"""Language identification: multinomial logistic regression on TF-IDF character n-grams, sparse, with calibrated probabilities.

A text is lower-cased, everything but letters becomes one blank, and its runs of one to ``ORDER`` characters are hashed to ``BUCKETS``
features. A feature's value is its share of all runs of its text times its inverse document frequency. The weights are learned online by
follow-the-regularised-leader with an elastic net, which leaves most of them zero; a temperature fitted to texts that were not learned
from turns scores into probabilities.

Only text and language of documents outside the held-out fold are learned from. Document frequencies cover all of them. The weights are
fitted to a bounded sample: about ``SAMPLE`` documents in all, as many of each language as there are, chosen by a hash of the id, of each
a stretch of ``STRETCH`` characters and a shorter crop of it. Every language that occurs is learned; more than ``LANGUAGES``, which the
driver's weights have no room for, fail.

Defined cases: a null text, and one without a letter, is ``und`` with score 0; so is every text if no document has a language. Repeated
rows get equal results. Further columns pass through, those named like a result are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.bytewords import slices_by_bytes
from patronlens.llm.folds import draw, held_out, stretch

ORDER = 3
BUCKETS = 1 << 16
SAMPLE = 12_000
STRETCH = 600
LANGUAGES = 256
EPOCHS = 3
SLICE_BYTES = 1 << 20
RUNS = 1 << 18
UNKNOWN = "und"
RESULT = ("held_out", "lang_pred", "score")
OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """The letters of a text with single blanks between and around; empty if it has none."""
    clean = OTHER.sub(" ", (text or "").lower())
    return f" {clean.strip()} " if any(map(str.isalpha, clean)) else ""


def ngrams(clean: str) -> Iterator[np.ndarray]:
    """Hashed features of all runs of characters of a clean text, in arrays of bounded size."""
    codes = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    for at in range(0, len(codes), RUNS):
        part = codes[at : at + RUNS + ORDER - 1]
        h = np.zeros(len(part), dtype=np.uint64)
        for order in range(1, ORDER + 1):
            own = min(RUNS, len(part) - order + 1)  # runs that start in this part
            if own <= 0:
                break
            h = (h[:own] + part[order - 1 : order - 1 + own] + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            yield (h >> np.uint64(7)).astype(np.int64) & (BUCKETS - 1)


@dataclass(frozen=True)
class Model:
    """``weights`` (BUCKETS x languages) are multiplied by the inverse document frequencies; the last row is the intercept."""

    languages: list[str]
    weights: np.ndarray
    temperature: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for text in texts:
            clean = letters(text) if self.languages else ""
            if not clean:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            total, runs = np.zeros(len(self.languages)), 0
            for features in ngrams(clean):
                total += self.weights[features].sum(axis=0, dtype=np.float64)
                runs += len(features)
            chances = softmax((total / runs + self.weights[-1])[None, :] / self.temperature)[0]
            best = int(chances.argmax())
            names.append(self.languages[best])
            scores.append(float(chances[best]))
        return names, scores


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader, proximal, with learning rates of each coordinate's own."""

    def __init__(self, features: int, classes: int, rate: float = 20.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-5):
        self.z, self.n = np.zeros((features, classes)), np.zeros((features, classes))
        self.rate, self.beta, self.l1, self.l2 = rate, beta, l1, l2

    def weights(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.rate + self.l2)

    def learn(self, rows: np.ndarray, values: np.ndarray, label: int) -> None:
        """One example: ``values`` at the coordinates ``rows``."""
        w = self.weights(rows)
        error = softmax((values @ w)[None, :])[0]
        error[label] -= 1
        gradient = values[:, None] * error
        n = self.n[rows]
        more = n + gradient**2
        self.z[rows] += gradient - (np.sqrt(more) - np.sqrt(n)) / self.rate * w
        self.n[rows] = more


def _sparse(clean: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    features = np.concatenate(list(ngrams(clean)))
    rows, counts = np.unique(features, return_counts=True)
    return np.append(rows, BUCKETS), np.append(counts / len(features) * idf[rows], 1.0)


def fit(texts: list[tuple[str, int, bool]], classes: int, idf: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights times idf, and the temperature; a text is (clean text, class, whether it calibrates)."""
    leader, random = Leader(BUCKETS + 1, classes), np.random.default_rng(seed)
    learned = [(*_sparse(clean, idf), label) for clean, label, calibrates in texts if not calibrates]
    for _ in range(EPOCHS):
        for i in random.permutation(len(learned)):
            leader.learn(*learned[i])
    weights = leader.weights()
    held = [(*_sparse(clean, idf), label) for clean, label, calibrates in texts if calibrates]
    temperature = 1.0
    if held:
        logits = np.stack([values @ weights[rows] for rows, values, _ in held])
        labels = np.array([label for *_, label in held])

        def loss(t: float) -> float:
            return float(-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-300)).mean())

        temperature = min(np.geomspace(0.05, 20, 241), key=loss)
    weights[:-1] *= idf[:, None]
    return weights.astype(np.float32), float(temperature)


def document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts there are, and in how many each feature occurs; counted inside the tasks, summed by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, seen, texts = np.zeros(BUCKETS + 1, dtype=np.int64), np.zeros(BUCKETS, dtype=bool), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if clean := letters(text):
                    seen[:] = False
                    for features in ngrams(clean):
                        seen[features] = True
                    found[:-1] += seen
                    texts += 1
        found[-1] = texts
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["feature", "n"])

    sums = rows.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS + 1, dtype=np.int64)
    for row in sums.collect():  # at most one row a feature
        counts[row.feature] = row.n
    return int(counts[-1]), counts[:-1]


def train(docs: DataFrame, seed: int = 11) -> Model:
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counted = rows.groupBy("lang").count().orderBy("lang").limit(LANGUAGES + 1).collect()
    if len(counted) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages: all have to be learned, none is dropped")
    if not counted:
        return Model([], np.zeros((BUCKETS + 1, 0), dtype=np.float32), 1.0)
    texts, counts = document_frequencies(rows)
    idf = np.log((1 + texts) / (1 + counts)) + 1
    share = SAMPLE / len(counted)
    order = draw(F.col("doc_id"), F.col("text"), seed=seed)
    rate = F.create_map(*(F.lit(x) for row in counted for x in (row["lang"], min(1.0, share / row["count"]))))
    sample = (
        rows.select("lang", "doc_id", order.alias("order"), stretch(F.col("text"), STRETCH, draw(F.col("doc_id"), seed=seed + 1)).alias("text"))
        .where(F.col("order") < F.try_element_at(rate, F.col("lang")))
        .orderBy("order", "doc_id", "text")
        .limit(2 * SAMPLE)
        .collect()
    )
    languages = sorted(row["lang"] for row in counted)
    random, examples = np.random.default_rng(seed), []
    for row in sample:
        label, calibrates = languages.index(row["lang"]), bool(random.random() < 0.2)
        length = int(random.integers(10, 120))
        start = int(random.integers(0, max(1, len(row["text"]) - length + 1)))
        for text in (row["text"], row["text"][start : start + length]):
            if clean := letters(text):
                examples.append((clean, label, calibrates))
    weights, temperature = fit(examples, len(languages), idf, seed)
    return Model(languages, weights, temperature)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with held_out, lang_pred and score."""
    # bounded by BUCKETS and LANGUAGES; sent as plain values
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.temperature))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in RESULT)).alias("row"), "text")
    schema = rows.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in slices_by_bytes(batches, 1, SLICE_BYTES):
            names, scores = model.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    return rows.mapInArrow(scan, schema).select(
        "row.*", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score"
    )

"""Whitening of embeddings along the components of their covariance, found by spectral divide and conquer.

Every entry c of a vector becomes the whole number floor(``FACTOR`` * c) + ``SHIFT``; sums of those are exact. The covariance is added up
from vectors that are centred first, task by task. Its components come from polar decompositions: the unitary polar factor of
"covariance less a shift" is +1 on the components above the shift and -1 on those below, so half of factor plus identity is the projector
on the upper ones. An orthogonal basis of its range and one of the rest split the covariance into two smaller blocks, each of which is
split again until every block is one component. The polar factor is computed by the dynamically weighted Halley iteration (QDWH): QR
steps while the block is ill-conditioned, Cholesky steps afterwards, six in all at most for double precision.

The driver holds one matrix of dimension by dimension, never rows; the components are broadcast (32 times the dimension), and every
vector is whitened where it is read. Nothing but sums is shuffled: each task sends one matrix, in rows.

Defined cases: a vector that is null or holds a null or a number that is not finite is left out; vectors of each length are whitened on
their own, and empty ones have no component; a component whose variance is zero to rounding (fewer vectors than dimensions, constant
or repeated entries) is 0 in every vector and does not count for ``identity_error``; equal variances give any orthogonal components of their
space; repeated rows and ids each count and are each returned; a null vec_id passes through; further columns are ignored; an empty table
gives an empty table. An entry beyond 2**40 after scaling fails the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.vectors import added_up, by_length, lists, whole_vectors

FACTOR, SHIFT = 64.0, 1_000_000
COMPONENTS = 32
EPSILON = float(np.finfo(np.float64).eps)


def polar_factor(a: np.ndarray) -> np.ndarray | None:
    """The unitary polar factor of a symmetric matrix, or None if it is singular to rounding."""
    size = np.linalg.norm(a)
    if size == 0:
        return None
    x, identity = a / size, np.eye(len(a))
    try:
        least = 1 / np.linalg.norm(np.linalg.inv(x))  # no singular value is below
    except np.linalg.LinAlgError:
        return None
    if not least > 16 * EPSILON:
        return None
    least = min(1.0, least)
    for _ in range(12):
        square = least * least
        d = np.cbrt(4 * (1 - square) / square**2)
        root = np.sqrt(1 + d)
        first = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        second = (first - 1) ** 2 / 4
        third = first + second - 1
        if third > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(third) * x, identity]))
            moved = (first - second / third) / np.sqrt(third) * (q[: len(a)] @ q[len(a) :].T)
        else:
            lower = np.linalg.cholesky(identity + third * (x.T @ x))
            moved = (first - second / third) * np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
        after = second / third * x + moved
        after = (after + after.T) / 2
        step, x = np.linalg.norm(after - x), after
        least = min(1.0, least * (first + second * square) / (1 + third * square))
        if abs(least - 1) < 10 * EPSILON and step < np.cbrt(EPSILON):
            break
    return (3 * x - x @ x @ x) / 2  # one step that takes off the rounding of the last ones


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Places to split a block at: the mean lies strictly between its least and largest eigenvalue unless all are equal."""
    mean, spread = float(np.trace(a)) / len(a), float(np.linalg.norm(a - np.trace(a) / len(a) * np.eye(len(a)))) / len(a)
    yield float(np.median(np.diag(a)))
    yield mean
    for step in range(1, 9):
        yield mean + spread * step / 64
        yield mean - spread * step / 64


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthogonal bases of two invariant subspaces of a symmetric block, the one of larger eigenvalues first."""
    random = np.random.default_rng(len(a))
    for shift in _shifts(a):
        sign = polar_factor(a - shift * np.eye(len(a)))
        if sign is None:
            continue
        above = (sign + np.eye(len(a))) / 2
        rank = int(round(float(np.trace(above))))
        if not 0 < rank < len(a):
            continue
        basis = random.normal(size=(len(a), rank))
        for _ in range(3):  # the projector maps any basis onto its range; again takes off what rounding left
            basis = np.linalg.qr(above @ basis, mode="complete")[0]
            upper, lower = basis[:, :rank], basis[:, rank:]
            basis = upper
        if np.linalg.norm(lower.T @ a @ upper) <= 64 * len(a) * EPSILON * np.linalg.norm(a):
            return upper, lower
    return None


def spectrum(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns; the largest entry of each is positive) of a covariance."""
    size = len(covariance)
    noise = EPSILON * size * max(float(np.linalg.norm(covariance)), 1e-300)
    waiting, found = [np.eye(size)] if size else [], []
    while waiting:
        basis = waiting.pop()
        block = basis.T @ covariance @ basis
        block = (block + block.T) / 2
        width = len(block)
        level = np.trace(block) / width
        halves = None if width == 1 or np.linalg.norm(block - level * np.eye(width)) <= noise else split(block)
        if halves is None:  # one component, or several of one variance
            found.append(basis)
        else:
            waiting += [basis @ half for half in halves]
    if not found:
        return np.zeros(0), np.zeros((0, 0))
    vectors = np.concatenate(found, axis=1)
    vectors = vectors @ (3 * np.eye(size) - vectors.T @ vectors) / 2
    values = ((covariance @ vectors) * vectors).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[largest, np.arange(size)] < 0, -1.0, 1.0)


@dataclass(frozen=True)
class Whitening:
    """Of vectors of one length: their number, exact sums, the leading components (columns) and what they explain.

    ``scale`` is one over the deviation along each component, 0 where there is none.
    """

    n: int
    sums: np.ndarray
    components: np.ndarray
    scale: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components * self.scale

    def deviation(self, x: np.ndarray) -> list[Decimal]:
        """Sums of the squares of n * x - sums, exact at any size."""
        away = self.n * x - self.sums
        if not away.size or float(np.abs(away).max()) ** 2 * away.shape[1] < 2**62:
            return [Decimal(value) for value in (away * away).sum(axis=1).tolist()]
        return [Decimal(sum(value * value for value in row)) for row in away.tolist()]


def _sums(x: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """By length of vector: their number and the sums of their entries."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for size, rows, values in by_length(batch.column(0)):
                own = found.setdefault(size, [0, np.zeros(size, dtype=np.int64)])
                own[0] += len(rows)
                own[1] += values.sum(axis=0)
        for size, (n, sums) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size], pa.int32()), pa.array([n], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.int64()))],
                names=["size", "n", "sums"],
            )

    parts = x.mapInArrow(add, "size int, n long, sums array<long>")
    found: dict[int, tuple[int, np.ndarray]] = {}
    for row in added_up(parts, ["size"], "sums").collect():  # one number per dimension
        found.setdefault(row["size"], (row["n"], np.zeros(row["size"], dtype=np.int64)))[1][row["at"]] = row["value"]
    return found


def _products(x: DataFrame, centred: dict[int, tuple], width: dict[int, int]) -> dict[int, np.ndarray]:
    """By length: the mean of the outer products of ``centred`` vectors with themselves, behind it a row of their means."""
    shared = x.sparkSession.sparkContext.broadcast(centred)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        count: dict[int, int] = {}
        for batch in batches:
            for size, rows, values in by_length(batch.column(0)):
                n, sums, *further = shared.value[size]
                away = (n * values - sums) / n
                for matrix in further:
                    away = away @ matrix
                own = found.setdefault(size, np.zeros((away.shape[1] + 1, away.shape[1])))
                own[:-1] += away.T @ away
                own[-1] += away.sum(axis=0)
                count[size] = count.get(size, 0) + len(rows)
        for size, total in found.items():
            rows = len(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(rows, size, dtype=np.int32)),
                    pa.array(np.arange(rows, dtype=np.int32)),
                    pa.array(np.full(rows, count[size], dtype=np.int64)),
                    lists(total, pa.float64()),
                ],
                names=["size", "row", "n", "sums"],
            )

    parts = x.mapInArrow(add, "size int, row int, n long, sums array<double>")
    found = {size: np.zeros((width[size] + 1, width[size])) for size in centred}
    for row in added_up(parts, ["size", "row"], "sums").collect():  # dimension by dimension
        found[row["size"]][row["row"], row["at"]] = row["value"] / row["n"]
    return found


def fit(x: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of all vectors ``x`` (whole numbers), by their length."""
    sums = {size: found for size, found in _sums(x).items() if size}
    moments = _products(x.where(F.size("x") > 0), sums, {size: size for size in sums}) if sums else {}
    fitted = {}
    for size, (n, total) in sums.items():
        covariance = moments[size][:-1]
        values, vectors = spectrum((covariance + covariance.T) / 2)
        trace = float(np.trace(covariance))
        kept = values[:components]
        real = kept > size * EPSILON * max(float(values[0]), 0.0)
        scale = np.where(real, 1 / np.sqrt(np.where(real, kept, 1.0)), 0.0)
        explained = np.where(real, kept / (trace or 1.0), 0.0)
        fitted[size] = Whitening(n, total, np.ascontiguousarray(vectors[:, :components]), scale, explained)
    return fitted


def identity_errors(x: DataFrame, fitted: dict[int, Whitening]) -> dict[int, float]:
    """By length: how far the covariance of all whitened vectors is from the identity, at its worst entry."""
    if not fitted:
        return {}
    projected = {size: (w.n, w.sums, w.components * w.scale) for size, w in fitted.items()}
    moments = _products(x.where(F.size("x") > 0), projected, {size: len(w.scale) for size, w in fitted.items()})
    errors = {}
    for size, w in fitted.items():
        mean = moments[size][-1]
        real = np.flatnonzero(w.scale)
        away = (moments[size][:-1] - np.outer(mean, mean))[np.ix_(real, real)] - np.eye(len(real))
        errors[size] = float(np.abs(away).max()) if len(real) else 0.0
    return errors


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, n, deviation, whitened, explained, identity_error) of every usable row of ``rows`` (vec_id, embedding).

    ``whitened`` and ``explained`` list the leading components, ``deviation`` is a decimal of up to 38 digits.
    """
    spark = rows.sparkSession
    vectors = whole_vectors(rows.select("vec_id", "embedding"), FACTOR, SHIFT).select("vec_id", "x")
    fitted = fit(vectors.select("x"), components)
    errors = identity_errors(vectors.select("x"), fitted)
    shared = spark.sparkContext.broadcast({size: (w, errors[size]) for size, w in fitted.items()})
    kinds = (pa.int64(), pa.decimal128(38, 0), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64())
    names = ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, at, values in by_length(batch.column(1)):
                if not size:
                    continue
                own, error = shared.value[size]
                columns = (
                    pa.array(np.full(len(at), own.n), kinds[0]),
                    pa.array(own.deviation(values), kinds[1]),
                    lists(own.whitened(values), pa.float64()),
                    lists(np.tile(own.explained, (len(at), 1)), pa.float64()),
                    pa.array(np.full(len(at), error), kinds[4]),
                )
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *columns], names=names)

    kind = rows.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(
        project,
        f"vec_id {kind}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double",
    )

"""Compression of vectors to a byte per part, with exact codebooks and bounds that spare most distances.

Every entry becomes the whole number floor(``FACTOR`` * entry), so distances, sums and codebooks are exact. A vector is cut into ``PARTS``
consecutive parts; the codebook of a part starts as that part of the ``ENTRIES`` vectors of the smallest ids, and each of ``ROUNDS``
rounds assigns every part to its nearest entry (the lower index on a tie) and replaces each entry by the mean of its parts, rounded down.

Bounds are those of the norm of the sum: a part keeps the exact distance to its own entry and, for each of ``GROUPS`` groups of entries, a
lower bound of the distance to any other entry of the group, each with the round in which it was computed. All codebooks so far are
kept, so a bound of round t is moved by what its entry really moved from round t to now, |c(now) - c(t)|, which is never more
than the sum of the moves between. A group whose bound is above the distance to the own entry needs no look. Otherwise that distance is
first brought up to date, and only the groups that still may hold a nearer or equally near entry are scanned exactly. The result is
that of comparing all with all.

Rows are never shuffled: each round reads the state of the round before (vectors, codes, bounds) from the shared folder and writes its
own, and the sums of a part's entries are added up inside each task first. The driver holds codebooks only.

Defined cases: a vector that is null or holds a null or a number that is not finite is left out; vectors of each length have codebooks of
their own, and an empty vector has the code of zeros and no error; fewer vectors than ``ENTRIES`` give as many entries; of equal ids the
smaller vector comes first, and null ids come last; repeated rows count and are returned each; a length that the parts do not divide
gives parts that differ by one; a null label is a label; further columns are ignored; an empty table gives an empty table. Entries so
large that a squared distance would not fit a bigint fail the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.vectors import added_up, by_length, lists, unknown_last, whole_vectors
from patronlens.shared import delete, write_table

FACTOR = 1024.0
PARTS = 4
ENTRIES = 256
ROUNDS = 4
GROUPS = 8
MARGIN = 1e-6  # a bound has to be clear by more than the rounding of roots


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of whole numbers."""
    if not x.shape[1]:
        return np.zeros((len(x), len(entries)), dtype=np.int64)
    most = float(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
    if 4 * most * most * x.shape[1] < 2**53:  # products and sums of doubles are exact
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    return np.stack([((x - entry) ** 2).sum(axis=1) for entry in entries], axis=1)


def own_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((x - entries) ** 2).sum(axis=1)


def groups_of(entries: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """The group of each entry: halved again and again along the coordinate that spreads most."""
    group = np.zeros(len(entries), dtype=np.int64)
    waiting, count = [np.arange(len(entries))], 1
    while count < groups:
        halves = []
        for members in waiting:
            if entries.shape[1] and len(members):
                widest = int(np.ptp(entries[members], axis=0).argmax())
                members = members[np.argsort(entries[members, widest], kind="stable")]
            halves += [members[: (len(members) + 1) // 2], members[(len(members) + 1) // 2 :]]
        waiting, count = halves, count * 2
    for number, members in enumerate(waiting):
        group[members] = number
    return group


@dataclass(frozen=True)
class Bounds:
    """Of rows of one part: code, exact squared distance with the round it is of, lower bounds by group with theirs."""

    code: np.ndarray
    near: np.ndarray
    stamp: np.ndarray
    low: np.ndarray
    low_stamp: np.ndarray


def _others(squares: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Roots of the least of each row but for column ``own`` (-1: none), rounded down; infinite where there is no other."""
    squares = squares.astype(np.float64)
    rows = np.flatnonzero(own >= 0)
    squares[rows, own[rows]] = np.inf
    return np.nextafter(np.sqrt(squares.min(axis=1, initial=np.inf)).astype(np.float32), np.float32(-np.inf))


class Codebooks:
    """All codebooks of one part so far, and how far their entries are apart from round to round."""

    def __init__(self, history: list[np.ndarray]) -> None:
        self.now, self.round = history[-1], len(history) - 1
        self.group = groups_of(history[0])
        self.members = [np.flatnonzero(self.group == g) for g in range(GROUPS)]
        self.moved = np.stack([np.sqrt(((self.now - then).astype(np.float64) ** 2).sum(axis=1)) for then in history])
        self.most = np.stack([self.moved[:, m].max(axis=1, initial=0.0) for m in self.members], axis=1)
        self.scanned = 0  # distances computed, own ones aside

    def first(self, x: np.ndarray) -> Bounds:
        squares = distances(x, self.now)
        self.scanned += squares.size
        code = squares.argmin(axis=1)
        low = np.empty((len(x), GROUPS), dtype=np.float32)
        for g, members in enumerate(self.members):
            place = np.full(len(self.now), -1)
            place[members] = np.arange(len(members))
            low[:, g] = _others(squares[:, members], place[code])
        zeros = np.zeros(len(x), dtype=np.int64)
        return Bounds(code, squares[np.arange(len(x)), code], zeros + self.round, low, np.full(low.shape, self.round))

    def next(self, x: np.ndarray, before: Bounds) -> Bounds:
        code, near, stamp = before.code.copy(), before.near.copy(), before.stamp.copy()
        low, low_stamp = before.low.copy(), before.low_stamp.copy()
        bound = low - self.most[low_stamp, np.arange(GROUPS)]
        reach = np.sqrt(near) + self.moved[stamp, code]
        look = ~(reach[:, None] + MARGIN < bound * (1 - MARGIN))
        rows = np.flatnonzero(look.any(axis=1))
        near[rows], stamp[rows] = own_distances(x[rows], self.now[code[rows]]), self.round
        look[rows] = ~(np.sqrt(near[rows])[:, None] + MARGIN < bound[rows] * (1 - MARGIN))
        best, where = near.copy(), code.copy()
        scans = []
        for g, members in enumerate(self.members):
            rows = np.flatnonzero(look[:, g])
            if not len(members) or not len(rows):
                continue
            squares = distances(x[rows], self.now[members])
            self.scanned += squares.size
            least = squares.argmin(axis=1)  # members are in the order of their index
            found, index = squares[np.arange(len(rows)), least], members[least]
            nearer = (found < best[rows]) | ((found == best[rows]) & (index < where[rows]))
            best[rows[nearer]], where[rows[nearer]] = found[nearer], index[nearer]
            scans.append((g, members, rows, squares))
        left = np.flatnonzero(where != code)  # the entry that a part leaves is now one of the others
        old = self.group[code[left]]
        distance = np.nextafter(np.sqrt(near[left]).astype(np.float32), np.float32(-np.inf))
        moved = np.nextafter(bound[left, old].astype(np.float32), np.float32(-np.inf))
        low[left, old], low_stamp[left, old] = np.minimum(distance, moved), self.round
        for g, members, rows, squares in scans:
            place = np.full(len(self.now), -1)
            place[members] = np.arange(len(members))
            low[rows, g], low_stamp[rows, g] = _others(squares, place[where[rows]]), self.round
        stamp[left] = self.round
        return Bounds(where, best, stamp, low, low_stamp)

    def exact(self, x: np.ndarray, bounds: Bounds) -> Bounds:
        """The same with today's distances to the own entries."""
        return Bounds(
            bounds.code, own_distances(x, self.now[bounds.code]), np.full(len(x), self.round), bounds.low, bounds.low_stamp
        )


STATE = (
    ("codes", "array<int>"),
    ("near", "array<long>"),
    ("stamps", "array<tinyint>"),
    ("low", "array<float>"),
    ("low_stamps", "array<tinyint>"),
)
_ARROW = (pa.int32(), pa.int64(), pa.int8(), pa.float32(), pa.int8())


def borders(size: int) -> list[int]:
    return [i * size // PARTS for i in range(PARTS + 1)]


def _packed(parts: list[Bounds]) -> list[pa.Array]:
    own = [np.stack([getattr(p, name) for p in parts], axis=1) for name in ("code", "near", "stamp")]
    wide = [np.concatenate([getattr(p, name) for p in parts], axis=1) for name in ("low", "low_stamp")]
    return [lists(values, kind) for values, kind in zip([*own, *wide], _ARROW)]


def _unpacked(columns: list[pa.Array]) -> list[Bounds]:
    flat = [np.asarray(c.flatten().to_numpy(zero_copy_only=False)) for c in columns]
    code, near, stamp = (values.reshape(-1, PARTS).astype(np.int64) for values in flat[:3])
    low, low_stamp = flat[3].reshape(-1, PARTS, GROUPS), flat[4].reshape(-1, PARTS, GROUPS).astype(np.int64)
    return [Bounds(code[:, p], near[:, p], stamp[:, p], low[:, p], low_stamp[:, p]) for p in range(PARTS)]


def _assigned(rows: DataFrame, size: int, history: list[list[np.ndarray]], last: bool) -> DataFrame:
    """``rows`` (vec_id, label, x and from the second round on the state) with the state of this round."""
    shared = rows.sparkSession.sparkContext.broadcast(history)
    names = ["vec_id", "label", "x", *(name for name, _ in STATE)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebooks([codebooks[p] for codebooks in shared.value]) for p in range(PARTS)]
        cut = borders(size)
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                _, _, x = next(by_length(batch.column(2)))
                parts = [x[:, a:b] for a, b in zip(cut, cut[1:])]
                if batch.num_columns == 3:
                    bounds = [book.first(part) for book, part in zip(books, parts)]
                else:
                    bounds = [b.next(part, own) for b, part, own in zip(books, parts, _unpacked(batch.columns[3:]))]
                if last:
                    bounds = [book.exact(part, own) for book, part, own in zip(books, parts, bounds)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *_packed(bounds)], names=names)

    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("vec_id", "label", "x")}
    schema = ", ".join(f"{name} {kind}" for name, kind in [*kinds.items(), *STATE])
    return rows.mapInArrow(assign, schema)


def _moved(state: DataFrame, size: int, now: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after a round: entries at the mean of their parts, rounded down; unused ones stay."""
    counts = [len(entries) for entries in now]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = borders(size)
        totals = [np.zeros((count, b - a + 1), dtype=np.int64) for count, a, b in zip(counts, cut, cut[1:])]
        for batch in batches:
            if not batch.num_rows:
                continue
            _, _, x = next(by_length(batch.column(0)))
            codes = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False)).reshape(-1, PARTS)
            for p, total in enumerate(totals):
                with_count = np.concatenate([np.ones((len(x), 1), dtype=np.int64), x[:, cut[p] : cut[p + 1]]], axis=1)
                np.add.at(total, codes[:, p], with_count)
        for p, total in enumerate(totals):
            used = np.flatnonzero(total[:, 0])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), p, dtype=np.int32)),
                    pa.array(used.astype(np.int32)),
                    pa.array(total[used, 0]),
                    lists(total[used], pa.int64()),
                ],
                names=["part", "entry", "n", "sums"],
            )

    parts = state.select("x", "codes").mapInArrow(add, "part int, entry int, n long, sums array<long>")
    after = [entries.copy() for entries in now]
    for row in added_up(parts, ["part", "entry"], "sums").collect():  # as many numbers as the codebooks have
        if row["at"]:
            after[row["part"]][row["entry"], row["at"] - 1] = row["value"] // row["n"]
    return after


def digest(codebooks: list[np.ndarray]) -> str:
    """Of all components, by part, entry and position, in decimal and joined by commas."""
    numbers = [str(value) for entries in codebooks for value in entries.reshape(-1).tolist()]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


@dataclass(frozen=True)
class Compressed:
    """``rows`` (vec_id, label, codes, near: squared distance by part) of the vectors of one length, and their codebooks."""

    rows: DataFrame
    codebooks: list[np.ndarray]


def compress(vectors: DataFrame, size: int, rounds: int = ROUNDS) -> Compressed:
    """Codes of all ``vectors`` (vec_id, label, x) of length ``size``; there has to be one."""
    spark = vectors.sparkSession
    first = vectors.orderBy(*unknown_last("vec_id"), "x").limit(ENTRIES).select("x").collect()
    start = np.array([row["x"] for row in first], dtype=np.int64).reshape(len(first), size)
    cut = borders(size)
    history = [[start[:, a:b] for a, b in zip(cut, cut[1:])]]
    state, path = vectors, None
    for number in range(rounds + 1):
        last = number == rounds
        after = write_table(_assigned(state, size, history, last), "vector-codes")
        if path:
            delete(spark, path)
        path, state = after, spark.read.parquet(after)
        if not last:
            history.append(_moved(state, size, history[-1]))
    return Compressed(state.select("vec_id", "label", "codes", "near"), history[-1])


def compress_vectors(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, codes, error, label_error, codebooks_sha256) of every usable row of ``rows`` (vec_id, embedding, label).

    ``error`` is the squared distance of a vector to what its codes stand for, ``label_error`` its sum over all rows of the label.
    """
    whole = whole_vectors(rows.select("vec_id", "label", "embedding"), FACTOR).select("vec_id", "label", "x")
    most = F.array_max(F.transform("x", F.abs))
    sizes = {row["size"]: row["most"] for row in whole.groupBy(F.size("x").alias("size")).agg(F.max(most).alias("most")).collect()}
    if any(4 * (value or 0) ** 2 * size >= 2**62 for size, value in sizes.items()):
        raise ValueError("entries of a vector are too large for exact squared distances")
    found = None
    for size in sorted(sizes):
        done = compress(whole.where(F.size("x") == size), size, rounds)
        error = F.aggregate("near", F.lit(0).cast("long"), lambda total, part: total + part)
        own = done.rows.select(
            "vec_id", "label", "codes", error.alias("error"), F.lit(digest(done.codebooks)).alias("codebooks_sha256")
        )
        found = own if found is None else found.unionAll(own)
    if found is None:
        empty = whole.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"))
        found = empty.withColumn("codebooks_sha256", F.lit(digest([])))
    totals = found.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return found.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "label", "codes", "error", "label_error", "codebooks_sha256"
    )

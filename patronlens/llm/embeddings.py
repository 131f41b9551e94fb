"""Embedding near-duplicates with an inverted-list index and product quantisation.

Vectors are scaled to length 1. A k-means of a bounded sample gives the coarse lists; what a vector differs from the centre of its list
is cut into ``PARTS`` subspaces, and each part is replaced by the nearest of up to ``CODES`` centres of that subspace. Dense centres within
the threshold of each other, directly or over others, are one list: a dense group is cut into many centres but stays one list, as lists
that hold parts of a group in which all pairs are links have centres within the threshold, too. A centre is dense if its vectors' mean
cosine with it is at least the square root of the threshold, as it is where all of them link; the centres of vectors that only share a common direction
are near each other, too, but not dense, and stay lists of their own. A vector sits in the list of its nearest
centre and visits the ``PROBES`` next lists. In every list, visitors and members are compared with the members: a
table of the products of a vector's parts with all code centres gives its approximate cosine with any member by ``PARTS`` look-ups.
Candidates are then compared by the exact cosine in double precision, so no pair below the threshold is linked.

The look-ups lose no link: a member's code, its own product p with its code's vector and the length q of that vector across it bound the
approximate cosine with any vector within the threshold t from below by t p - sqrt(1 - t^2) q; what is below is no candidate. Links can
be lost only between vectors of which neither visits the other's list; tests measure that against brute force.

A pair is compared in one list only: with each other at home, or where one visits the other; if both visit, in the lower list. Equal
vectors are compared once, as a class with a number of copies. Lists of one label, of any size, are cut into blocks of about ``BLOCK``
vectors, and a task gets two blocks: it gives each vector's number of links and a forest of links, never all pairs.

Only vectors of equal, non-null labels and equal dimension are compared. Defined cases: a vector that is null, empty or zero, or holds a
null or a number that is not finite, has no links and is its own component, as is one without a label; repeated rows and ids are further
copies; a null vec_id is larger than any other; further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.components import connected_components, forest
from patronlens.shared import written

THRESHOLD = 0.93
PARTS = 8
CODES = 256
PROBES = 8
SAMPLE = 65_536
MOST_LISTS = 4096
BLOCK = 2048
ROUNDS = 8


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def nearest(points: np.ndarray, centres: np.ndarray, count: int = 1) -> np.ndarray:
    """The ``count`` nearest centres of each point, nearest first."""
    found = []
    for at in range(0, len(points), 4096):
        distance = (centres**2).sum(axis=1) - 2 * points[at : at + 4096] @ centres.T
        if count == 1:
            found.append(distance.argmin(axis=1)[:, None])
        else:
            some = np.argpartition(distance, min(count, len(centres)) - 1, axis=1)[:, :count]
            order = np.take_along_axis(distance, some, axis=1).argsort(axis=1, kind="stable")
            found.append(np.take_along_axis(some, order, axis=1))
    return np.concatenate(found) if found else np.zeros((0, count), dtype=np.int64)


def k_means(points: np.ndarray, count: int, random: np.random.Generator) -> np.ndarray:
    centres = points[random.choice(len(points), count, replace=False)].copy()
    for _ in range(ROUNDS):
        own = nearest(points, centres)[:, 0]
        sizes = np.bincount(own, minlength=count)
        order = np.argsort(own, kind="stable")
        filled = np.flatnonzero(sizes)
        sums = np.add.reduceat(points[order], (np.cumsum(sizes) - sizes)[filled], axis=0)
        centres[filled] = sums / sizes[filled][:, None]
    return centres


def dense(vectors: np.ndarray, own: np.ndarray, centres: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the unit ``vectors`` of each centre (``own``) have a mean cosine of at least sqrt(threshold) with it."""
    directions = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)
    sizes = np.bincount(own, minlength=len(centres))
    total = np.bincount(own, weights=(vectors * directions[own]).sum(axis=1), minlength=len(centres))
    return total >= (np.sqrt(threshold) - 1e-9) * np.maximum(sizes, 1)


def merged(centres: np.ndarray, threshold: float, mergeable: np.ndarray) -> np.ndarray:
    """The list of each centre: mergeable centres whose cosine is at least the threshold, directly or over others, share one."""
    directions = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)
    lists = np.full(len(centres), -1, dtype=np.int64)
    for start in range(len(centres)):
        if lists[start] >= 0:
            continue
        number, waiting = lists.max() + 1, [start] if mergeable[start] else []
        lists[start] = number
        while waiting:
            close = np.flatnonzero((lists < 0) & mergeable & (directions @ directions[waiting.pop()] >= threshold - 1e-9))
            lists[close] = number
            waiting.extend(close.tolist())
    return lists


@dataclass(frozen=True)
class Index:
    """``centres`` and their ``lists``; ``codes``: by subspace, its code centres; ``borders`` cut a vector into subspaces."""

    centres: np.ndarray
    codes: list[np.ndarray]
    borders: list[int]
    threshold: float
    lists: np.ndarray

    @property
    def width(self) -> int:
        """How many lists a vector is in: its own and those it visits."""
        return min(PROBES + 1, int(self.lists.max()) + 1)

    @staticmethod
    def fit(vectors: np.ndarray, lists: int, threshold: float, seed: int = 5) -> Index:
        random = np.random.default_rng(seed)
        vectors = unit(vectors.astype(np.float64))
        centres = k_means(vectors, min(lists, len(vectors)), random)
        own = nearest(vectors, centres)[:, 0]
        rest = vectors - centres[own]
        parts = min(PARTS, vectors.shape[1])
        borders = [i * vectors.shape[1] // parts for i in range(parts + 1)]
        codes = [
            k_means(rest[:, a:b], min(CODES, len(rest)), random) for a, b in zip(borders[:-1], borders[1:])
        ]
        return Index(centres, codes, borders, threshold, merged(centres, threshold, dense(vectors, own, centres, threshold)))

    def _subspaces(self) -> zip:
        return zip(self.codes, self.borders[:-1], self.borders[1:])

    def _lists(self, vectors: np.ndarray) -> np.ndarray:
        """The nearest centre, and behind it the lists that are nearest by any of their centres, but for its own."""
        order = np.argsort(self.lists, kind="stable")
        starts = np.flatnonzero(np.diff(self.lists[order], prepend=-1))
        squares, found = (self.centres**2).sum(axis=1), []
        for at in range(0, len(vectors), 4096):
            distance = squares - 2 * vectors[at : at + 4096] @ self.centres.T
            home = distance.argmin(axis=1)
            away = np.minimum.reduceat(distance[:, order], starts, axis=1)
            away[np.arange(len(home)), self.lists[home]] = np.inf
            visits = np.argpartition(away, self.width - 2, axis=1)[:, : self.width - 1] if self.width > 1 else away[:, :0]
            found.append(np.concatenate([home[:, None], visits], axis=1).astype(np.int64))
        return np.concatenate(found)

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The home centre and then the lists to visit, codes, and the least approximate cosine of a linked vector."""
        vectors = unit(vectors.astype(np.float64))
        lists = self._lists(vectors)
        centres = self.centres[lists[:, 0]]
        rest = vectors - centres
        codes = np.stack([nearest(rest[:, a:b], own)[:, 0] for own, a, b in self._subspaces()], axis=1)
        coded = centres + np.concatenate([own[codes[:, i]] for i, (own, _, _) in enumerate(self._subspaces())], axis=1)
        along = (coded * vectors).sum(axis=1)
        across = np.sqrt(np.maximum((coded**2).sum(axis=1) - along**2, 0))
        t = self.threshold
        return lists, codes, t * along - np.sqrt(1 - t * t) * across - 1e-6

    def approximate(self, vectors: np.ndarray, home: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Approximate cosines of unit ``vectors`` with encoded ones, by table look-up."""
        result = vectors @ self.centres[home].T
        for i, (own, a, b) in enumerate(self._subspaces()):
            result += (vectors[:, a:b] @ own.T)[:, codes[:, i]]
        return result


def cell_links(
    index: Index, at: int, rows: dict[str, np.ndarray], blocks: tuple[int, int]
) -> tuple[np.ndarray, list[int], list[int]]:
    """Links inside one cell of list ``at``: the number of linked vectors of each row (copies counted), and a forest of links.

    ``rows`` are the rows of two blocks, or of one if they are equal; pairs inside a block belong to its cell with itself.
    """
    vectors = unit(rows["vector"])
    home, lists = rows["lists"][:, 0], index.lists[rows["lists"][:, 0]]
    member = lists == at
    links = np.zeros(len(vectors), dtype=np.int64)
    ones, others = [], []
    members = np.flatnonzero(member)
    if not len(members) or len(vectors) < 2:
        return links, [], []
    for first in range(0, len(vectors), 512):
        here = np.arange(first, min(first + 512, len(vectors)))
        close = index.approximate(vectors[here], home[members], rows["codes"][members]) >= rows["bound"][members]
        a, b = np.nonzero(close)
        a, b = here[a], members[b]
        both = member[a]
        keep = np.where(both, a < b, True)
        # a visitor whose list b visits in turn is compared there, if that is the lower list
        away = np.flatnonzero(~both)
        keep[away] = ~((lists[a[away]] < at) & (rows["lists"][b[away], 1:] == lists[a[away]][:, None]).any(axis=1))
        if blocks[0] != blocks[1]:
            keep &= rows["block"][a] != rows["block"][b]
        ones.append(a[keep])
        others.append(b[keep])
    a, b = np.concatenate(ones), np.concatenate(others)
    raw = rows["vector"]
    lengths = np.sqrt((raw**2).sum(axis=1))
    exact = np.zeros(len(a), dtype=bool)
    for at_pair in range(0, len(a), 1 << 16):
        x, y = a[at_pair : at_pair + (1 << 16)], b[at_pair : at_pair + (1 << 16)]
        exact[at_pair : at_pair + (1 << 16)] = (raw[x] * raw[y]).sum(axis=1) / (lengths[x] * lengths[y]) >= index.threshold
    a, b = a[exact], b[exact]
    np.add.at(links, a, rows["copies"][b])
    np.add.at(links, b, rows["copies"][a])
    left, right = forest(rows["node"][a], rows["node"][b])
    return links, left, right


def _matrix(column: pa.Array | pa.ChunkedArray, width: int, kind: type) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=kind).reshape(-1, width)


def _links_of(classes: DataFrame, size: int, threshold: float, block: int) -> DataFrame:
    """(node, links, other) of the classes of one dimension: numbers of links to add up, and links (other not null)."""
    spark = classes.sparkSession
    own = classes.where(F.size("embedding") == size)
    count = own.count()
    centres = int(min(MOST_LISTS, 2 ** round(np.log2(max(1.0, count**0.5)))))
    sample = own.orderBy(F.xxhash64("embedding"), "node").limit(SAMPLE).select("embedding").toArrow()
    fitted = Index.fit(_matrix(sample.column(0), size, np.float64), centres, threshold)
    shared = spark.sparkContext.broadcast((fitted.centres, fitted.codes, fitted.borders, fitted.threshold, fitted.lists))
    width, parts = fitted.width, len(fitted.codes)

    def encode(batches):
        index = Index(*shared.value)
        for batch in batches:
            if batch.num_rows:
                found = index.encode(_matrix(batch.column(2), size, np.float64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        pa.array(list(found[0].astype(np.int32)), pa.list_(pa.int32())),
                        pa.array(list(found[1].astype(np.int32)), pa.list_(pa.int32())),
                        pa.array(found[2]),
                        pa.array(index.lists[found[0][:, 0]].astype(np.int32)),
                    ],
                    names=["node", "label", "embedding", "copies", "lists", "codes", "bound", "own"],
                )

    label = classes.schema["label"].dataType.simpleString()
    kind = classes.schema["embedding"].dataType.simpleString()
    encoded = own.select("node", "label", "embedding", "copies").mapInArrow(
        encode,
        f"node long, label {label}, embedding {kind}, copies long, lists array<int>, codes array<int>, bound double, own int",
    )
    visited = F.concat(F.array("own"), F.slice("lists", 2, width))
    visits = encoded.select("*", F.explode(visited).alias("list"))
    sizes = visits.groupBy("label", "list").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = (
        visits.join(sizes, ["label", "list"])
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("one", F.least("block", "with"))
        .withColumn("two", F.greatest("block", "with"))
        .select("label", "list", "one", "two", "node", "embedding", "copies", "lists", "codes", "bound", "block")
    )

    def compare(table: pa.Table) -> pa.Table:
        first = {name: table.column(name)[0].as_py() for name in ("list", "one", "two")}
        rows = {name: table.column(name).to_numpy() for name in ("node", "copies", "bound", "block")}
        rows["vector"] = _matrix(table.column("embedding"), size, np.float64)
        rows["lists"] = _matrix(table.column("lists"), width, np.int64)
        rows["codes"] = _matrix(table.column("codes"), parts, np.int64)
        links, left, right = cell_links(Index(*shared.value), first["list"], rows, (first["one"], first["two"]))
        some = np.flatnonzero(links)
        return pa.table(
            {
                "node": pa.array([*rows["node"][some].tolist(), *left], pa.int64()),
                "links": pa.array([*links[some].tolist(), *([0] * len(left))], pa.int64()),
                "other": pa.array([*([None] * len(some)), *right], pa.int64()),
            }
        )

    return dealt.groupBy("label", "list", "one", "two").applyInArrow(compare, "node long, links long, other long")


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``rows`` (vec_id, embedding, label)."""
    rows = rows.select("vec_id", "label", "embedding")
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    ) & F.exists("embedding", lambda x: x != 0)
    valid = rows.where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    unknown = F.struct(F.col("vec_id").isNull().alias("unknown"), "vec_id")
    classes = written(
        valid.groupBy("label", "embedding")
        .agg(F.count("*").alias("copies"), F.min(unknown).alias("least"))
        .withColumn("node", F.monotonically_increasing_id()),  # fixed once written
        "embedding-classes",
    )
    sizes = [row[0] for row in classes.select(F.size("embedding")).distinct().collect()]
    found = None
    for size in sizes:
        part = _links_of(classes, size, threshold, block)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "node long, links long, other long")
    found = written(found, "embedding-links")
    components = connected_components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        classes.join(links, "node", "left")
        .join(components, "node", "left")
        .select("label", "embedding", "copies", "links", "least", F.coalesce("component", "node").alias("component"))
    )
    least = named.groupBy("component").agg(F.min("least").alias("first"))
    known = named.join(least, "component").select(
        "label", "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "first"
    )
    component = F.when(F.col("first").isNull(), F.col("vec_id")).otherwise(F.col("first.vec_id"))
    # invalid vectors meet no class, also where a class has equal content
    ours = rows.withColumn("key", F.when(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)), F.col("embedding")))
    return ours.join(
        known.withColumnsRenamed({"label": "known_label", "embedding": "known"}),
        (F.col("label") == F.col("known_label")) & (F.col("key") == F.col("known")),
        "left",
    ).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )

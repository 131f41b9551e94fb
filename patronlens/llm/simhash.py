"""SimHash near-duplicates, linked through the points of a covering code.

A fingerprint has 64 bits. Bit b is 1 if it is set in more than half of the hashes of the document's shingles. Two fingerprints that
differ in ``DISTANCE`` bits or fewer are linked; components of links are groups of near-copies.

Anchors are the words of a product of perfect codes: two binary Golay codes (23 bits, covering radius 3), a Hamming code (15 bits,
radius 1) and a repetition code (3 bits, radius 1), together 64 bits and 2^36 anchors. As the codes are perfect, every fingerprint has
exactly one anchor within the covering radius of each part, its home. It is copied to every anchor within that radius plus
``DISTANCE`` (how far each part lies beyond its radius, added up over the parts, is at most ``DISTANCE``). If y is within ``DISTANCE``
of x, then y has a copy at the home of x, so comparing what is at home with what visits, anchor by anchor, finds every link.

Only different fingerprints are compared, so exact copies cost nothing. The copies are dealt out by anchor, sorted by the JVM and read as
a stream. An anchor with at most ``CROWD`` fingerprints is compared pair by pair and gives a tree of links, not all pairs. The
fingerprints of a fuller anchor are linked exactly in another way: each is copied to the 65 points within one bit of it, and two that
share a point are at most two bits apart, and the other way round; a point has at most 65 visitors, however large the crowd.

Defined cases: a null text, an empty one and one of white space have no words and the fingerprint zero; fewer words than a shingle are
one shingle; repeated shingles count each time; repeated rows and doc_ids link like any others; a null doc_id counts as larger than any
other and is the component only of documents without an id; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.llm.bytewords import LOWER, byte_class, per_text, slices_by_bytes, spans_of, text_bytes
from patronlens.llm.components import connected_components, forest
from patronlens.shared import written

SHINGLE = 3
DISTANCE = 2
SEED = 42
CROWD = 512
SLICE_BYTES = 1 << 18  # the places of its words and bytes take some forty times as much
BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
# Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = ~byte_class((0x09, 0x0D), (0x20, 0x20))


def fingerprints_of(texts: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprint of every text, as unsigned 64-bit numbers."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends = spans_of(data, offsets, WORD)
    bounds = per_text(starts, offsets).tolist()
    # all words, one blank behind each: a shingle is a stretch of this
    sizes = ends - starts + 1
    last = np.cumsum(sizes) - 1
    first = last - sizes + 1
    joined = data[np.arange(int(sizes.sum())) + np.repeat(starts - first, sizes)]
    joined[last] = 0x20
    buffer, first, last = joined.tobytes(), first.tolist(), last.tolist()
    digest = xxhash.xxh64_intdigest
    result = np.zeros(len(texts), dtype=np.uint64)
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if a == b:
            continue
        size = min(shingle, b - a)
        hashes = np.array(
            [digest(buffer[s:e], seed) for s, e in zip(first[a : b - size + 1], last[a + size - 1 : b])], dtype="<u8"
        )
        counts = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        result[i] = BITS[counts * 2 > len(hashes)].sum(dtype=np.uint64)
    return result


class Part:
    """One perfect code of the product, on the bits from ``shift`` on; ``columns`` is its parity-check matrix.

    Bits whose columns add up to zero are a code word, so the code words near a value are the value with some bits turned whose columns
    add up to those of the value. ``home`` turns bits within ``radius``; ``further[k]`` has, by syndrome, what else leads to the code
    words at ``radius`` + k, relative to home.
    """

    def __init__(self, columns: list[int], radius: int, shift: int, beyond: int):
        self.columns, self.shift = columns, shift
        count = 1 << max(columns).bit_length()
        found: list[list[list[int]]] = [[[] for _ in range(count)] for _ in range(beyond + 1)]
        for weight in range(min(radius + beyond, len(columns)) + 1):
            for bits in combinations(range(len(columns)), weight):
                syndrome = turned = 0
                for bit in bits:
                    syndrome ^= columns[bit]
                    turned |= 1 << bit
                found[max(0, weight - radius)][syndrome].append(turned << shift)
        if any(len(near) != 1 for near in found[0]):
            raise ValueError("not a perfect code of this radius")
        self.home = np.array([near[0] for near in found[0]], dtype=np.uint64)
        self.further = []
        for k in range(1, beyond + 1):
            most = max(map(len, found[k]))
            table = np.zeros((count, most), dtype=np.uint64)  # 0: no further word
            for syndrome, turned in enumerate(found[k]):
                table[syndrome, : len(turned)] = np.array(turned, dtype=np.uint64) ^ self.home[syndrome]
            self.further.append(table)

    def syndromes(self, values: np.ndarray) -> np.ndarray:
        result = np.zeros(len(values), dtype=np.int64)
        for bit, column in enumerate(self.columns):
            set_here = (values >> np.uint64(self.shift + bit)) & np.uint64(1)
            result ^= set_here.astype(np.int64) * column
        return result


def _remainders(polynomial: int, length: int) -> list[int]:
    """x^0, x^1, ... modulo a polynomial over two elements."""
    top = 1 << (polynomial.bit_length() - 1)
    values, value = [], 1
    for _ in range(length):
        values.append(value)
        value <<= 1
        if value & top:
            value ^= polynomial
    return values


def covering_code(distance: int = DISTANCE) -> list[Part]:
    # Fixed value: a generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
    golay = _remainders(0b110001110101, 23)
    return [
        Part(golay, 3, 0, distance),
        Part(golay, 3, 23, distance),
        Part(list(range(1, 16)), 1, 46, distance),
        Part([1, 2, 3], 1, 61, distance),
    ]


def anchors_of(prints: np.ndarray, code: list[Part], distance: int = DISTANCE) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(anchor, fingerprint, whether the anchor is the fingerprint's home), in arrays."""
    syndromes = [part.syndromes(prints) for part in code]
    home = prints.copy()
    for part, syndrome in zip(code, syndromes):
        home ^= part.home[syndrome]
    yield home, prints, True

    def further(anchors: np.ndarray, rows: np.ndarray, parts: int, left: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """Move on by at most ``left`` in parts before number ``parts``."""
        for i in range(parts):
            for k in range(1, left + 1):
                turned = code[i].further[k - 1][syndromes[i][rows]]
                row, column = np.nonzero(turned)
                moved = anchors[row] ^ turned[row, column]
                yield moved, prints[rows[row]], False
                if left > k:
                    yield from further(moved, rows[row], i, left - k)

    yield from further(home, np.arange(len(prints)), len(code), distance)


class Compare:
    """Reads copies sorted by anchor and gives links (a, b) and the members of crowds (a, null)."""

    def __init__(self, distance: int, crowd: int):
        self.distance, self.crowd = distance, crowd
        self.anchor, self.prints, self.home = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.crowded: int | None = None

    def feed(self, anchor: np.ndarray, prints: np.ndarray, home: np.ndarray, end: bool = False) -> tuple[list, list]:
        left, right = [], []
        if self.crowded is not None:  # what remains of an anchor whose crowd was given out
            rest = int(np.searchsorted(anchor, self.crowded, side="right"))
            left += prints[:rest].tolist()
            if rest < len(anchor):
                self.crowded = None
            anchor, prints, home = anchor[rest:], prints[rest:], home[rest:]
        anchor = np.concatenate([self.anchor, anchor])
        prints = np.concatenate([self.prints, prints])
        home = np.concatenate([self.home, home])
        if len(anchor):
            heads = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            whole = len(anchor) if end else int(heads[-1])
            sizes = np.diff(np.append(heads, len(anchor)))
            if not end and sizes[-1] > self.crowd:
                self.crowded, whole = int(anchor[-1]), len(anchor)
            kept = slice(whole, len(anchor))
            self.anchor, self.prints, self.home = anchor[kept], prints[kept], home[kept]
            done = heads < whole
            heads, sizes = heads[done], sizes[done]
            if len(heads):
                for head, size in zip(heads[sizes > self.crowd].tolist(), sizes[sizes > self.crowd].tolist()):
                    left += prints[head : head + size].tolist()
                right += [None] * len(left)
                wanted = (sizes > 1) & (sizes <= self.crowd) & np.logical_or.reduceat(home[:whole], heads)
                a, b = self._pairs(prints, home, heads[wanted], sizes[wanted])
                a, b = forest(a, b)
                left += a
                right += b
        right += [None] * (len(left) - len(right))
        return left, right

    def _pairs(self, prints: np.ndarray, home: np.ndarray, heads: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        here = np.arange(int(sizes.sum())) + np.repeat(heads - (np.cumsum(sizes) - sizes), sizes)
        behind = np.repeat(heads + sizes, sizes) - here  # members from this one to the end of its anchor
        ones, others = [], []
        lag = 1
        while len(here := here[more := behind > lag]):
            behind = behind[more]
            there = here + lag
            bits = np.bitwise_count(prints[here].view(np.uint64) ^ prints[there].view(np.uint64))
            linked = (bits <= self.distance) & (home[here] | home[there])
            ones.append(prints[here[linked]])
            others.append(prints[there[linked]])
            lag += 1
        if not ones:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(ones), np.concatenate(others)


def links(prints: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) whose components are those of all pairs in ``prints`` (one column, fingerprint) at most ``distance`` bits apart."""

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = covering_code(distance)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for at in range(0, len(values), 2048):
                for anchor, own, home in anchors_of(values[at : at + 2048], code, distance):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(anchor.view(np.int64)),
                            pa.array(own.view(np.int64)),
                            pa.array(np.full(len(own), home)),
                        ],
                        names=["anchor", "fingerprint", "home"],
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = Compare(distance, crowd)
        nothing = np.zeros(0, np.int64)

        def given(found: tuple[list, list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            yield given(task.feed(columns[0].astype(np.int64), columns[1].astype(np.int64), columns[2].astype(bool)))
        yield given(task.feed(nothing, nothing, np.zeros(0, bool), end=True))

    if distance != 2:
        raise ValueError("crowds are linked through points within one bit, which is exact for two bits")
    # fingerprints are few bytes but many copies: spread them as widely as the copies
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        prints.repartition(tasks)
        .mapInArrow(copies, "anchor long, fingerprint long, home boolean")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
    )
    found = written(dealt.mapInArrow(compare, "a long, b long"), "simhash-links")
    crowds = found.where(F.col("b").isNull()).select("a").distinct()
    turned = F.array(F.col("a"), *(F.col("a").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), i)) for i in range(64)))
    meeting = (
        crowds.select("a", F.explode(turned).alias("point"))
        .groupBy("point")
        .agg(F.min("a").alias("least"), F.collect_set("a").alias("members"))
        .where(F.size("members") > 1)
        .select("least", F.explode("members").alias("a"))
    )
    return found.where(F.col("b").isNotNull()).unionAll(meeting.select("a", F.col("least").alias("b")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fingerprint) of every row; read whole texts once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, 2, SLICE_BYTES):
            prints = fingerprints_of(batch.column(2), shingle, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints)], names=["doc_id", "text_hash", "fingerprint"]
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, text_hash long, fingerprint long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fingerprint, component_id, kept) of every row; ``kept`` names the row that stays, by its text_hash."""
    prints = written(fingerprints(docs, shingle, seed), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    classes = prints.groupBy("fingerprint").agg(F.min(place).alias("place"))
    components = connected_components(links(classes.select("fingerprint"), distance))
    grouped = classes.join(components, classes["fingerprint"] == components["node"], "left").select(
        "fingerprint", "place", F.coalesce("component", "fingerprint").alias("component")
    )
    least = grouped.groupBy("component").agg(F.min("place").alias("least"))
    named = grouped.join(least, "component").select("fingerprint", "least")
    return prints.join(named, "fingerprint").select(
        "doc_id",
        "text_hash",
        "fingerprint",
        F.col("least.doc_id").alias("component_id"),
        F.col("least.text_hash").alias("kept_hash"),
    )


def hexadecimal(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row of each group: that of the smallest doc_id; among rows that repeat it, the smallest hash of the text, once."""
    found = near_duplicates(docs, **options)
    kept = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("kept_hash")))
        .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
        .distinct()
    )
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    own = rows.join(kept, rows["doc_id"].eqNullSafe(kept["id"]) & (rows["text_hash"] == kept["hash"]), "left_semi")
    repeat = F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy("doc_id"))
    return own.select("row", repeat.alias("repeat")).where("repeat = 1").select("row.*")

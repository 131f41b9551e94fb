"""Removal of byte strings that repeat anywhere in the corpus, by Burrows-Wheeler transforms of bounded shards.

Texts are UTF-8 bytes. A byte goes if it lies in a string of ``LEAST`` bytes that also starts anywhere else, in the same document or in
another; matches do not cross documents, and all is judged on the texts as they are.

Which strings can be equal is settled by content. Among the grams of ``GRAM`` bytes inside every string of ``LEAST`` bytes the one of the
least hash is its anchor: equal strings have equal anchors. Consecutive starts with one anchor are a run, and a run with the
``LEAST`` - 1 bytes behind it is its context (some 280 bytes, a run per 77). Runs are counted by (anchor, digest of the context), copies combined before the
shuffle, so one of many equal contexts is looked at, with its number. Anchors that occur once repeat nothing and are dropped.

The contexts of an anchor go to one shard of about ``SHARD_BYTES``. A shard's suffixes are sorted by prefix doubling up to 256 bytes, which
gives its Burrows-Wheeler transform. Breadth-first backward extension of intervals of the transform then sets common prefixes of neighbours by
increasing value: the interval of every string w of length l gives those of all cw, and where one ends with no value yet, the value is l. It
stops at l = ``LEAST``: what has no value then has a common prefix of at least that, and both neighbours are repeated. So is a row that
stands for several equal contexts.

An anchor with more than ``CROWD`` different contexts (a phrase that a large part of the corpus holds) would fill a shard. Its runs are cut into
single strings of ``LEAST`` bytes, counted by two hashes of the whole string, combined before the shuffle; each is then an anchor with one context.

Every table between is written to the shared folder or can be computed again from one; shuffle files go as soon as their table is written. A task holds a shard, or a few megabytes of text
or one longer text; the driver sees two numbers.

Defined cases: null and empty texts have no bytes, and texts of fewer than ``LEAST`` bytes lose nothing; a text that is there twice loses all
bytes if it has that many; repeated rows are returned each; kept bytes are binary, since a cut may go through a character; null doc_ids
and further columns pass through, those named like a result are replaced; very long texts are cut into stretches of ``STRETCH`` starts
without a change of result; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm.bytewords import mixed, slices_by_bytes, span_hashes, text_bytes
from patronlens.shared import written

LEAST = 200
GRAM = 48
CROWD = 4096
SHARD_BYTES = 1 << 20
SLICE_BYTES = 4 << 20
STRETCH = 8 << 20  # below 1 << 24, so that a place fits behind 40 bits of a hash
BASE = np.uint64(0x9E3779B97F4A7C15)
RESULT = ("n_bytes", "n_removed", "spans", "kept", "kept_sha256")


# --- runs of starts with one anchor ----------------------------------------------------------------


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every string of ``size`` bytes, put together from those of 1, 2, 4, ... bytes."""
    power, width, part = BASE, 1, mixed(data.astype(np.uint64) + np.uint64(1))
    whole, have = None, 0
    with np.errstate(over="ignore"):
        while True:
            if size & width:
                count = len(data) - have - width + 1
                whole = part if whole is None else whole[:count] * power + part[have : have + count]
                have += width
            if width * 2 > size:
                return mixed(whole)
            part = part[:-width] * power + part[width:]
            power, width = power * power, width * 2


def sliding_least(values: np.ndarray, window: int) -> np.ndarray:
    """The least of every ``window`` consecutive values, from running minima of blocks in both directions."""
    count = len(values) - window + 1
    padded = np.full(-(-len(values) // window) * window, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:count], ahead[window - 1 : window - 1 + count])


def runs_of(data: np.ndarray, offsets: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, start in it, number of starts, anchor, digest of the context) of every run; ``data`` has 8 bytes to spare."""
    found = []
    total = int(offsets[-1])
    first, last = offsets[:-1], offsets[1:] - least  # first and last start of each text
    for low in range(0, total, STRETCH):
        high = min(low + STRETCH, total - least + 1)
        if high <= low:
            break
        own = data[low : high + least - 1]
        grams = gram_hashes(own, gram)
        places = np.arange(len(grams), dtype=np.uint64)
        least_gram = sliding_least((grams & ~np.uint64(0xFFFFFF)) | places, least - gram + 1)
        anchor = (least_gram & np.uint64(0xFFFFFF)).astype(np.int64)
        border = np.zeros(high - low + 1, dtype=np.int64)
        long = (last >= first) & (last >= low) & (first < high)
        np.add.at(border, np.maximum(first[long] - low, 0), 1)
        np.add.at(border, np.minimum(last[long] + 1 - low, high - low), -1)
        inside = np.cumsum(border[:-1]) > 0
        change = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        before = np.concatenate([[False], inside[:-1]])
        heads = np.flatnonzero(inside & (change | ~before))
        if not len(heads):
            continue
        after = np.concatenate([~inside[1:], [True]])
        turn = np.concatenate([change[1:], [True]])
        ends = np.flatnonzero(inside & (turn | after)) + 1
        text = np.searchsorted(offsets, heads + low, side="right") - 1
        digest = span_hashes(data, heads + low, ends + low + least - 1)
        found.append((text, heads + low - offsets[text], ends - heads, grams[anchor[heads]], digest))
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    return tuple(np.concatenate(part) for part in zip(*found))


# --- one shard -------------------------------------------------------------------------------------


def sorted_suffixes(symbols: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes in the order of their first ``depth`` symbols at least; ``left``: symbols before the separator (0) of the text.

    Separators compare by place, so that no two suffixes are equal across one.
    """
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(8, dtype=np.uint8)])
    key = np.ndarray((n,), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)
    short = np.flatnonzero(left < 8)
    bits = ((8 - left[short]) * 8).astype(np.uint64)
    key[short] = np.where(left[short] == 0, np.uint64(0), key[short] >> np.minimum(bits, np.uint64(63)) << np.minimum(bits, np.uint64(63)))
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.concatenate([[True], (key[1:] != key[:-1]) | (left[order][1:] < 8)])
    slots = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, slots, 0))
    open_ = np.flatnonzero(~head | np.concatenate([~head[1:], [False]]))
    known = 8
    while len(open_) and known < depth:
        place = order[open_]
        key = rank[place] * n + rank[place + known]
        by = np.argsort(key)
        key = key[by]
        order[open_] = place = place[by]
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[place] = open_[np.maximum.accumulate(np.where(head, np.arange(len(open_)), 0))]
        open_ = open_[~head | np.concatenate([~head[1:], [False]])]
        known *= 2
    return order


def repeated_starts(texts: list[bytes], least: int = LEAST, copies: np.ndarray | None = None) -> list[np.ndarray]:
    """Of each text, the starts of strings of ``least`` bytes that start anywhere else too; a text may stand for several ``copies``."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1  # the places of the separators
    symbols = np.frombuffer(b"\xff".join(texts) + b"\xff", dtype=np.uint8) + np.uint8(1)  # no byte of UTF-8 is 255: separators are 0
    n = len(symbols)
    left = np.repeat(ends, sizes + 1) - np.arange(n)
    suffixes = sorted_suffixes(symbols, left, least + 1)
    first = symbols[suffixes]
    transform = symbols[suffixes - 1]
    back = np.empty(n, dtype=np.int64)  # the row of the suffix that is one symbol longer
    back[np.argsort(transform, kind="stable")] = np.arange(n)

    known = np.zeros(n + 1, dtype=bool)  # whether the common prefix with the row before has its value
    starts = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (first[1:] == 0)]))
    stops = np.append(starts[1:], n)
    known[0] = True
    known[stops] = True
    owner = np.empty(n, dtype=np.int32)
    for _ in range(1, least):
        width = stops - starts
        inner = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
        rows = np.repeat(starts, width) + inner
        number = np.repeat(np.arange(len(starts), dtype=np.int32), width)
        within = transform[rows] > 0
        to = back[rows[within]]
        owner[to] = number[within]
        to.sort()
        if not len(to):
            break
        of, symbol = owner[to], first[to]
        head = np.concatenate([[True], (to[1:] != to[:-1] + 1) | (of[1:] != of[:-1]) | (symbol[1:] != symbol[:-1])])
        starts = to[head]
        stops = np.append(to[:-1][head[1:]], to[-1]) + 1
        new = ~known[stops]
        starts, stops = starts[new], stops[new]
        known[stops] = True
        if not len(starts):
            break
    alike = np.flatnonzero(~known[1:n]) + 1
    repeated = np.zeros(n, dtype=bool)
    repeated[suffixes[alike]] = True
    repeated[suffixes[alike - 1]] = True
    if copies is not None:
        repeated |= (left >= least) & np.repeat(copies > 1, sizes + 1)
    places = np.flatnonzero(repeated)
    begins = ends - sizes
    cuts = np.searchsorted(places, np.append(begins, n))
    return [places[a:b] - begin for a, b, begin in zip(cuts, cuts[1:], begins)]


def stretches(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of consecutive numbers of a rising array."""
    if not len(numbers):
        return numbers, numbers
    cut = np.flatnonzero(np.diff(numbers) != 1)
    return numbers[np.concatenate([[0], cut + 1])], numbers[np.append(cut, len(numbers) - 1)]


# --- the tables ------------------------------------------------------------------------------------

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside the block, the shuffle files of a job are deleted when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)


RUNS = "node long, start long, starts long, anchor long, digest long, copies long"


def _runs(texts: DataFrame) -> DataFrame:
    """The runs of all ``texts`` (node, copies, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, 2, SLICE_BYTES):
            text, start, starts, anchor, digest = runs_of(*text_bytes(batch.column(2)))
            own = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(own),
                    pa.array(start),
                    pa.array(starts),
                    pa.array(anchor.astype(np.int64)),
                    pa.array(digest.astype(np.int64)),
                    batch.column(1).take(own),
                ],
                names=["node", "start", "starts", "anchor", "digest", "copies"],
            )

    return texts.select("node", "copies", "text").mapInArrow(scan, RUNS)


def _contexts(runs: DataFrame) -> DataFrame:
    """The different contexts of anchors that occur more than once, with one place of each and the number of kinds of the anchor."""
    place = F.struct("node", "start", "starts")
    kinds = runs.groupBy("anchor", "digest").agg(F.sum("copies").alias("copies"), F.min(place).alias("place"))
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("copies").alias("total"))
    return kinds.join(anchors.where("total > 1").drop("total"), "anchor").select(
        "anchor", "digest", "copies", "place.*", "kinds"
    )


def _strings(runs: DataFrame, texts: DataFrame) -> DataFrame:
    """The runs cut into runs of one start, with hashes of the whole string as anchor and digest."""
    wanted = runs.groupBy("node").agg(F.collect_list(F.struct("start", "starts")).alias("wanted"))
    rows = texts.join(wanted, "node").select("node", "copies", "text", "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, 2, SLICE_BYTES):
            data, offsets = text_bytes(batch.column(2))
            hashes = gram_hashes(data[:-8], LEAST)
            for i in range(batch.num_rows):
                wanted = batch.column(3)[i].values
                first, count = (wanted.field(k).to_numpy(zero_copy_only=False) for k in range(2))
                inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                start = np.repeat(first, count) + inner
                at = start + offsets[i]
                same = len(start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(same, batch.column(0)[i].as_py())),
                        pa.array(start),
                        pa.array(np.ones(same, dtype=np.int64)),
                        pa.array(hashes[at].astype(np.int64)),
                        pa.array(span_hashes(data, at, at + LEAST).astype(np.int64)),
                        pa.array(np.full(same, batch.column(1)[i].as_py())),
                    ],
                    names=["node", "start", "starts", "anchor", "digest", "copies"],
                )

    return rows.mapInArrow(cut, RUNS)


def _fetched(contexts: DataFrame, texts: DataFrame) -> DataFrame:
    """(anchor, digest, copies, context) with the bytes of each context."""
    wanted = contexts.groupBy("node").agg(F.collect_list(F.struct("start", "starts", "anchor", "digest", "copies")).alias("wanted"))
    rows = texts.select("node", F.encode("text", "UTF-8").alias("bytes")).join(wanted, "node")
    each = rows.select("bytes", F.explode("wanted").alias("w"))
    context = F.substring(F.col("bytes"), (F.col("w.start") + 1).cast("int"), (F.col("w.starts") + LEAST - 1).cast("int"))
    return each.select("w.anchor", "w.digest", "w.copies", context.alias("context"))


def _expanded(contexts: DataFrame, shards: int) -> DataFrame:
    """(anchor, digest, first, last): the stretches of repeated starts of each context, counted from its run's first."""
    names = ["anchor", "digest", "first", "last"]

    def expand(table: pa.Table) -> pa.Table:
        contexts = table.column("context").to_pylist()
        starts = repeated_starts(contexts, copies=table.column("copies").to_numpy())
        found = [stretches(own) for own in starts]
        of = pa.array(np.repeat(np.arange(len(contexts)), [len(a) for a, _ in found]))
        columns = [pa.array(np.concatenate([pair[k] for pair in found]).astype(np.int64)) for k in range(2)]
        return pa.table([table.column("anchor").take(of), table.column("digest").take(of), *columns], names=names)

    dealt = contexts.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(expand, "anchor long, digest long, first long, last long")


def repeated_spans(texts: DataFrame, crowd: int = CROWD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(node, spans): of each of ``texts`` (node, copies, text) with repeated strings, the bytes inside one, not yet merged."""
    runs = written(_runs(texts), "runs")
    contexts = written(_contexts(runs), "contexts")
    size = F.sum(F.col("starts") + LEAST)
    total, most = contexts.agg(size, F.max("kinds")).first()
    if most is not None and most > crowd:
        crowded = contexts.where(F.col("kinds") > crowd).select("anchor").distinct()
        strings = written(_strings(runs.join(crowded, "anchor", "left_semi"), texts), "strings")
        runs = runs.join(crowded, "anchor", "left_anti").unionByName(strings)
        contexts = written(contexts.where(F.col("kinds") <= crowd).unionByName(_contexts(strings)), "contexts")
        total = contexts.agg(size).first()[0]
    shards = int((total or 0) // shard_bytes) + 1
    found = written(_expanded(_fetched(contexts, texts), shards), "repeated")
    span = F.struct((F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("last") + LEAST).alias("end"))
    return runs.join(found, ["anchor", "digest"]).groupBy("node").agg(F.collect_list(span).alias("spans"))


KEPT = "key string, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary, kept_sha256 string"


def _kept(texts: DataFrame) -> DataFrame:
    """What stays of each of ``texts`` (key, text, spans)."""
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary(), pa.string())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, 1, SLICE_BYTES):
            data, offsets = text_bytes(batch.column(1))
            rows = []
            for i in range(batch.num_rows):
                own, spans, own_spans = data[offsets[i] : offsets[i + 1]].tobytes(), [], batch.column(2)[i].values
                if own_spans is not None and len(own_spans):
                    start, end = (own_spans.field(k).to_numpy(zero_copy_only=False) for k in range(2))
                    by = np.argsort(start, kind="stable")
                    start, reach = start[by], np.maximum.accumulate(end[by])
                    head = np.concatenate([[True], start[1:] > reach[:-1]])
                    spans = list(zip(start[head].tolist(), np.append(reach[:-1][head[1:]], reach[-1]).tolist()))
                borders = [0, *(x for span in spans for x in span), len(own)]
                kept = b"".join(own[a:b] for a, b in zip(borders[0::2], borders[1::2]))
                spans = [{"start": a, "end": b} for a, b in spans]
                rows.append((len(own), len(own) - len(kept), spans, kept, hashlib.sha256(kept).hexdigest()))
            columns = [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["key", *RESULT])

    return texts.select("key", "text", "spans").mapInArrow(cut, KEPT)


def remove_repeats(docs: DataFrame, carry: list[str] | None = None, crowd: int = CROWD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all if not given) with n_bytes, n_removed, spans (removed, merged), kept (bytes) and its
    kept_sha256."""
    carry = [c for c in (docs.columns if carry is None else carry) if c not in RESULT]
    text = F.coalesce(F.col("text"), F.lit(""))
    with shuffles_released(docs.sparkSession):
        texts = written(
            docs.groupBy(text.alias("text"))
            .agg(F.count("*").alias("copies"))
            .select(F.monotonically_increasing_id().alias("node"), "copies", "text"),
            "texts",
        )
        spans = repeated_spans(texts.where(F.octet_length("text") >= LEAST), crowd, shard_bytes)
    marked = texts.join(spans, "node", "left").select(F.sha2("text", 256).alias("key"), "text", "spans")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"), F.sha2(text, 256).alias("key"))
    return rows.join(_kept(marked), "key").select(*(F.col(f"row.`{c}`") for c in carry), *RESULT)

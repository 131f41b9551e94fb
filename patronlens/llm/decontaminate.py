"""Benchmark decontamination with suffix arrays over the training documents.

Words are lower-cased (A-Z) runs of digits, letters and all characters beyond ASCII. A benchmark item gives its windows of ``WINDOW``
consecutive words; an item with fewer words is one window. Each shard of documents (a bounded amount of text) gets a suffix array over
its words; every suffix of every item is binary-searched in every shard, which gives all places where its first window occurs
verbatim. From each such place the longest verbatim match is found by binary search of a suffix array over the items, in steps
of powers of two words; the items that share a window are never gone through for it. Affected documents can then be removed.

Words that no item contains cannot be part of a match; they cut the text into stretches, and stretches shorter than the shortest window
are left out of the suffix array. Nothing else is left out. Words are compared by a 64-bit hash.

The items go to the tasks in blocks of about ``BLOCK_CHARS`` characters, so a benchmark of any size is searched whole and a broadcast is
bounded. With one block documents are never shuffled. With more the documents are numbered and written once; each block reads ids and texts
of that table and gives the documents with matches, which are put together by number. Many items may share a window with many documents: a document
then carries the names of its sets of items, and ids are joined to each different combination of sets last. No task holds more than a shard
and a block, and ids leave a task ``IDS_IN_A_BATCH`` at a time.

Defined cases: a null or empty text has no words, no hits and stays; an item of no words has no window; repeated documents each get
their own result; items that share an id count once; a null item_id is written as an empty text; null doc_ids and further columns pass
through, those named like a result are replaced; an empty benchmark hits nothing and an empty document table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm.bytewords import LOWER, byte_class, per_text, slices_by_bytes, span_hashes, spans_of, text_bytes
from patronlens.shared import written

WINDOW = 10
SHARD_BYTES = 8 << 20
BLOCK_CHARS = 4_000_000
IDS_IN_A_BATCH = 200_000  # or those of one document
KEPT_IDS = 4_000_000  # of sets of items that several documents share
# The bytes of a word after lower-casing; every byte of a character beyond ASCII is above 0x7F.
WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
RESULT = ("n_words", "n_hit", "n_items", "item_ids", "longest_match", "spans")


@dataclass(frozen=True)
class Suffixes:
    """The suffixes of a block of items, each cut to its first window; equal windows are kept once.

    ``vocabulary`` has the sorted hashes of all words; a word's number is its place there, counted from 1.
    ``windows`` are rows of word numbers, 0 behind a shorter window; ``held`` lists, window by window, the places in ``item_ids`` (sorted,
    each once) of the items that have it, from ``first`` on. ``text`` are the words of all items, a 0 behind each, ``order`` its suffix array.
    ``ranks[k]`` has the rank of the 2**k words from each place of the text on (0 behind its end) and ``pairs[k]`` the sorted pairs of ranks of
    half that many words which they number from 1.
    """

    vocabulary: np.ndarray
    windows: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    held: np.ndarray
    item_ids: list[str]
    text: np.ndarray
    order: np.ndarray
    ranks: list[np.ndarray]
    pairs: list[np.ndarray]

    @staticmethod
    def of(items: list[tuple[str, str]], window: int) -> Suffixes:
        data, offsets = text_bytes(pa.array([text for _, text in items], pa.large_string()))
        data = LOWER[data]
        starts, ends = spans_of(data, offsets, WORD)
        vocabulary, numbers = np.unique(span_hashes(data, starts, ends), return_inverse=True)
        numbers = numbers.astype(np.int32) + 1
        bounds = per_text(starts, offsets)
        item_ids = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(item_ids)}
        rows, owners = [], []
        for (name, _), a, b in zip(items, bounds[:-1], bounds[1:]):
            length = min(window, b - a)
            for i in range(a, b - length + 1 if length else a):
                row = np.zeros(window, dtype=np.int32)
                row[:length] = numbers[i : i + length]
                rows.append(row)
                owners.append(place[name])
        text = np.insert(numbers, bounds[1:], 0)
        order, ranks, pairs = doubled(text, int(np.diff(bounds).max(initial=0)))
        if not rows:
            nothing = np.zeros(0, dtype=np.int64)
            return Suffixes(
                vocabulary, np.zeros((0, window), np.int32), nothing, np.zeros(1, np.int64), nothing, [], text, order, ranks, pairs
            )
        windows, which = np.unique(np.array(rows), axis=0, return_inverse=True)
        held = np.unique(which.reshape(-1) * len(item_ids) + np.array(owners))
        first = np.searchsorted(held, np.arange(len(windows) + 1) * len(item_ids))
        lengths = (windows > 0).sum(axis=1)
        return Suffixes(
            vocabulary, windows, lengths, first, (held % len(item_ids)).astype(np.int32), item_ids, text, order, ranks, pairs
        )


def paired(ranks: np.ndarray, half: int, base: int) -> np.ndarray:
    behind = np.zeros(len(ranks), dtype=np.int64)
    behind[: max(len(ranks) - half, 0)] = ranks[half:]
    return ranks.astype(np.int64) * base + behind


def doubled(text: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """The suffix array of the items' words to the depth of the longest item at least, and its ranks and pairs by powers of two."""
    ranks, pairs = [text], [np.zeros(0, dtype=np.int64)]
    while 1 << (len(ranks) - 1) <= longest:
        keys, places = np.unique(paired(ranks[-1], 1 << (len(ranks) - 1), len(text) + 2), return_inverse=True)
        ranks.append(places.astype(np.int32) + 1)
        pairs.append(keys)
    return np.argsort(ranks[-1], kind="stable"), ranks, pairs


def match_lengths(words: np.ndarray, at: np.ndarray, suffixes: Suffixes) -> np.ndarray:
    """The most words from each place ``at`` of ``words`` (0 between stretches) that some item has verbatim."""
    base = len(suffixes.text) + 2
    known = [words]
    for k, keys in enumerate(suffixes.pairs[1:]):
        wanted = paired(known[-1], 1 << k, base)
        near = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        whole = (wanted >= base) & (wanted % base > 0) & (keys[near] == wanted)  # both halves are known
        known.append(np.where(whole, near + 1, 0).astype(np.int32))
    length = np.zeros(len(at), dtype=np.int64)
    low, high = np.zeros(len(at), dtype=np.int64), np.full(len(at), len(suffixes.order), dtype=np.int64)
    for k in reversed(range(len(known))):
        there = at + length
        wanted = np.where(there < len(words), known[k][np.minimum(there, len(words) - 1)], 0)

        def bound(after: bool) -> np.ndarray:
            a, b = low.copy(), high.copy()
            while (live := np.flatnonzero(a < b)).size:
                middle = (a[live] + b[live]) // 2
                place = suffixes.order[middle] + length[live]
                rank = np.where(place < len(suffixes.text), suffixes.ranks[k][np.minimum(place, len(suffixes.text) - 1)], 0)
                right = rank <= wanted[live] if after else rank < wanted[live]
                a[live[right]] = middle[right] + 1
                b[live[~right]] = middle[~right]
            return a

        start, end = bound(False), bound(True)
        goes_on = (wanted > 0) & (start < end)
        low, high = np.where(goes_on, start, low), np.where(goes_on, end, high)
        length += np.where(goes_on, 1 << k, 0)
    return length


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """The order of all suffixes by their first ``depth`` words at least: sorts by 1, 2, 4, ... words until that is reached."""
    rank = words.astype(np.int64)
    n, known = len(words), 1
    order = np.argsort(rank, kind="stable")
    while n and known < depth:
        behind = np.zeros(n, dtype=np.int64)
        behind[:-known] = rank[known:] + 1 if known < n else 0
        key = rank * (max(n, int(rank.max()) + 1) + 2) + behind
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, dtype=np.int64)
        new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank, known = new, known * 2
    return order


def occurrences(words: np.ndarray, order: np.ndarray, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """First and last place in ``order`` of the suffixes that begin with each window, by one binary search for all windows at once."""
    width = suffixes.windows.shape[1]
    padded = np.concatenate([words, np.zeros(width, dtype=words.dtype)])

    def bound(after: bool) -> np.ndarray:
        low = np.zeros(len(suffixes.windows), dtype=np.int64)
        high = np.full(len(suffixes.windows), len(order), dtype=np.int64)
        while (live := np.flatnonzero(low < high)).size:
            middle = (low[live] + high[live]) // 2
            there = padded[order[middle][:, None] + np.arange(width)]
            wanted = suffixes.windows[live]
            there = np.where(wanted > 0, there, 0)  # behind a shorter window anything may follow
            differs = there != wanted
            at = differs.argmax(axis=1)
            row = np.arange(len(live))
            sign = np.where(differs.any(axis=1), np.sign(there[row, at].astype(np.int64) - wanted[row, at]), 0)
            right = sign <= 0 if after else sign < 0
            low[live[right]] = middle[right] + 1
            high[live[~right]] = middle[~right]
        return low

    return bound(False), bound(True)


def shard_matches(numbers: np.ndarray, bounds: np.ndarray, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(place, window) of every occurrence in a shard; ``numbers`` are its words (0: in no item), ``bounds`` cut it into documents."""
    nothing = np.zeros(0, dtype=np.int64)
    if not len(suffixes.windows) or not len(numbers):
        return nothing, nothing
    known = np.concatenate([[False], numbers > 0, [False]])
    cut = np.zeros(len(numbers) + 1, dtype=bool)
    cut[bounds] = True
    starts = np.flatnonzero(known[1:-1] & (~known[:-2] | cut[:-1]))
    ends = np.flatnonzero(known[1:-1] & (~known[2:] | cut[1:])) + 1
    long = ends - starts >= suffixes.lengths.min()
    starts, sizes = starts[long], (ends - starts)[long]
    if not len(starts):
        return nothing, nothing
    # stretches one after another, a 0 behind each
    total = int(sizes.sum()) + len(sizes)
    at = np.cumsum(sizes + 1) - (sizes + 1)
    inner = np.arange(total) - np.repeat(at, sizes + 1)
    places = np.repeat(starts, sizes + 1) + inner
    behind = inner == np.repeat(sizes, sizes + 1)
    words = np.where(behind, 0, numbers[np.minimum(places, len(numbers) - 1)])
    order = suffix_array(words, suffixes.windows.shape[1])
    low, high = occurrences(words, order, suffixes)
    counts = high - low
    which = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    return places[order[np.repeat(low, counts) + inner]], which


def longest_matches(numbers: np.ndarray, bounds: np.ndarray, place: np.ndarray, which: np.ndarray, suffixes: Suffixes) -> np.ndarray:
    """By document, the longest verbatim match in words. All words of a match stand in windows that were found, at ``place``."""
    document = np.searchsorted(bounds, place, side="right") - 1
    longest = np.zeros(len(bounds) - 1, dtype=np.int64)
    np.maximum.at(longest, document, suffixes.lengths[which])  # an item shorter than a window has no longer match
    full = np.unique(place[suffixes.lengths[which] == suffixes.windows.shape[1]])
    if not len(full):
        return longest
    inside = np.zeros(len(numbers) + 1, dtype=np.int32)
    np.add.at(inside, full, 1)
    np.add.at(inside, full + suffixes.windows.shape[1], -1)
    covered = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    starts = np.zeros(len(numbers) + 1, dtype=bool)
    starts[bounds] = True
    cut = np.concatenate([[False], (np.diff(covered) > 1) | starts[covered[1:]]])
    at = np.arange(len(covered)) + np.cumsum(cut)
    words = np.zeros(at[-1] + 2, dtype=np.int32)
    words[at] = numbers[covered]
    lengths = match_lengths(words, at[np.searchsorted(covered, full)], suffixes)
    np.maximum.at(longest, np.searchsorted(bounds, full, side="right") - 1, lengths)
    return longest


class ItemSets:
    """The items that have any of some windows; sets are kept while documents are likely to share them."""

    def __init__(self, suffixes: Suffixes) -> None:
        self.suffixes, self.kept, self.size = suffixes, {}, 0

    def of(self, windows: np.ndarray) -> np.ndarray:
        key = windows.tobytes()
        if key not in self.kept:
            first = self.suffixes.first
            items = np.unique(np.concatenate([self.suffixes.held[first[w] : first[w + 1]] for w in windows.tolist()]))
            if self.size + len(items) > KEPT_IDS:
                self.kept, self.size = {}, 0
            self.kept[key] = items
            self.size += len(items)
        return self.kept[key]


def scan_texts(texts: pa.Array, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray, dict[int, list], dict[int, np.ndarray]]:
    """Of each text: words and longest match; by number of the text, where there are any: merged spans of words, and different windows."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends = spans_of(data, offsets, WORD)
    bounds = per_text(starts, offsets)
    longest = np.zeros(len(texts), dtype=np.int64)
    spans: dict[int, list] = {}
    windows: dict[int, np.ndarray] = {}
    if len(suffixes.vocabulary) and len(starts):
        hashes = span_hashes(data, starts, ends)
        near = np.minimum(np.searchsorted(suffixes.vocabulary, hashes), len(suffixes.vocabulary) - 1)
        numbers = np.where(suffixes.vocabulary[near] == hashes, near + 1, 0).astype(np.int32)
        place, which = shard_matches(numbers, bounds, suffixes)
        if len(place):
            order = np.argsort(place, kind="stable")
            place, which = place[order], which[order]
            document = np.searchsorted(bounds, place, side="right") - 1
            longest = longest_matches(numbers, bounds, place, which, suffixes)
            cuts = [0, *(np.flatnonzero(np.diff(document)) + 1).tolist(), len(place)]
            for a, b in zip(cuts, cuts[1:]):
                d = int(document[a])
                at = place[a:b] - bounds[d]
                spans[d] = merged(list(zip(at.tolist(), (at + suffixes.lengths[which[a:b]]).tolist())))
                windows[d] = np.unique(which[a:b])
    return np.diff(bounds), longest, spans, windows


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, sorted."""
    union: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if union and start <= union[-1][1]:
            union[-1] = (union[-1][0], max(end, union[-1][1]))
        else:
            union.append((start, end))
    return union


def item_blocks(benchmark: DataFrame, window: int, block_chars: int) -> tuple[int, Iterator[Suffixes]]:
    """The number of blocks, which follows the measured size of the benchmark, and the items, brought to the driver block by block."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").where(
        F.length("text") > 0
    )
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(chars // block_chars) + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return blocks, (Suffixes.of([tuple(row) for row in items.where(part == i).distinct().collect()], window) for i in range(blocks))


FOUND = "found struct<n_words: long, item_ids: array<string>, longest_match: long, spans: array<struct<start: long, end: long>>>"
SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
BLOCK_FOUND = pa.schema(
    [
        ("number", pa.int64()),
        ("n_words", pa.int64()),
        ("longest_match", pa.int64()),
        ("spans", pa.list_(SPAN)),
        ("item_set", pa.binary()),
        ("members", pa.list_(pa.string())),
    ]
)


def _listed(lengths: list[int], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]), pa.int32()), values)


def _matches(rows: DataFrame, suffixes: Suffixes, shard_bytes: int) -> DataFrame:
    """The first column of ``rows`` (something, text) and ``found``, the matches, if there is one block of items."""
    block = rows.sparkSession.sparkContext.broadcast(tuple(vars(suffixes).values()))  # plain values
    first = rows.schema[0]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = Suffixes(*block.value)
        names, sets = pa.array(suffixes.item_ids, pa.string()), ItemSets(suffixes)
        nothing = np.zeros(0, dtype=np.int32)

        def batch_of(batch: pa.RecordBatch, at: list[int], ids: list[np.ndarray], words, longest, spans) -> pa.RecordBatch:
            own = [spans.get(d, []) for d in at]
            pairs = np.array([span for some in own for span in some], dtype=np.int64).reshape(-1, 2)
            found = pa.StructArray.from_arrays(
                [
                    pa.array(words[at], pa.int64()),
                    _listed([len(some) for some in ids], names.take(pa.array(np.concatenate([nothing, *ids]), pa.int32()))),
                    pa.array(longest[at], pa.int64()),
                    _listed([len(some) for some in own], pa.StructArray.from_arrays([pairs[:, 0], pairs[:, 1]], fields=list(SPAN))),
                ],
                names=["n_words", "item_ids", "longest_match", "spans"],
            )
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), found], names=[first.name, "found"])

        for batch in slices_by_bytes(batches, 1, shard_bytes):
            words, longest, spans, windows = scan_texts(batch.column(1), suffixes)
            at, ids, size = [], [], 0
            for d in range(batch.num_rows):
                items = sets.of(windows[d]) if d in windows else nothing
                if at and size + len(items) > IDS_IN_A_BATCH:
                    yield batch_of(batch, at, ids, words, longest, spans)
                    at, ids, size = [], [], 0
                at.append(d)
                ids.append(items)
                size += len(items)
            if at:
                yield batch_of(batch, at, ids, words, longest, spans)

    return rows.mapInArrow(scan, T.StructType([first, *T.StructType.fromDDL(FOUND)]))


def _united(spans: Column) -> Column:
    """The union of an array of spans, sorted."""
    nothing = F.array().cast("array<struct<start: long, end: long>>")
    spans = F.array_sort(spans)

    def add(state: Column, span: Column) -> Column:
        last = state["last"]
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        reaches = span["start"] <= last["end"]
        return F.struct(
            F.when(reaches, state["done"]).otherwise(F.array_append(state["done"], last)).alias("done"),
            F.when(reaches, joined).otherwise(span).alias("last"),
        )

    first = F.get(spans, 0)
    state = F.struct(nothing.alias("done"), first.alias("last"))
    return F.when(F.size(spans) > 0, F.aggregate(spans, state, add, lambda s: F.array_append(s["done"], s["last"]))).otherwise(nothing)


def _matches_written(found: DataFrame) -> DataFrame:
    """Matches as a table of small row groups: Spark reads thousands of rows at once, but of one group, and a row may hold every item."""
    path = new_path(found.sparkSession, "matches")
    found.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return found.sparkSession.read.schema(found.schema).parquet(path)


def _block_matches(numbered: DataFrame, suffixes: Suffixes, shard_bytes: int, block: int) -> DataFrame:
    """The matches of one of several blocks: of all texts for the first block, else of those that have any. The items of a document are
    the name of their set; ``members`` are there where a task meets a set that it does not remember, else null."""
    shared = numbered.sparkSession.sparkContext.broadcast(tuple(vars(suffixes).values()))  # plain values

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = Suffixes(*shared.value)
        sets = ItemSets(suffixes)

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(list(column), field.type) for column, field in zip(zip(*done), BLOCK_FOUND)]
            return pa.RecordBatch.from_arrays(arrays, schema=BLOCK_FOUND)

        for batch in slices_by_bytes(batches, 1, shard_bytes):
            words, longest, spans, windows = scan_texts(batch.column(1), suffixes)
            done, size = [], 0
            for d in range(batch.num_rows) if block == 0 else sorted(spans):
                name, members = None, None
                if d in windows:
                    name = hashlib.sha256(b"%d:" % block + windows[d].tobytes()).digest()
                    if windows[d].tobytes() not in sets.kept:
                        members = [suffixes.item_ids[i] for i in sets.of(windows[d]).tolist()]
                        size += len(members)
                own = [{"start": start, "end": end} for start, end in spans.get(d, [])]
                done.append((batch.column(0)[d].as_py(), int(words[d]), int(longest[d]), own, name, members))
                if size > IDS_IN_A_BATCH:
                    yield batch_of(done)
                    done, size = [], 0
            if done:
                yield batch_of(done)

    kinds = "number long, n_words long, longest_match long, spans array<struct<start: long, end: long>>, item_set binary, members array<string>"
    return numbered.select("number", "text").mapInArrow(scan, kinds)


def _in_blocks(rows: DataFrame, blocks: Iterator[Suffixes], shard_bytes: int) -> DataFrame:
    """(row, found) for several blocks: the rows are numbered and written once, and read by each block.

    Documents carry the names of their sets of items from block to block; ids are put together once for each different combination
    of sets, so what is shuffled does not grow with documents times items.
    """
    numbered = written(rows.select(F.monotonically_increasing_id().alias("number"), "row", "text"), "decontaminated")
    found = reduce(
        DataFrame.unionAll,  # one block is on the driver at a time
        (written(_block_matches(numbered, suffixes, shard_bytes, i), "matches") for i, suffixes in enumerate(blocks)),
    )
    nobody = F.array(F.col("number").cast("string").cast("binary"))  # no set is named so; spreads the documents without any
    texts = written(
        found.groupBy("number")
        .agg(
            F.max("n_words").alias("n_words"),
            F.max("longest_match").alias("longest_match"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.sort_array(F.collect_set("item_set")).alias("sets"),
        )
        .select("number", "n_words", "longest_match", _united(F.col("spans")).alias("spans"), F.when(F.size("sets") > 0, F.col("sets")).otherwise(nobody).alias("sets")),
        "matches",
    )
    members = found.where("members IS NOT NULL").groupBy("item_set").agg(F.first("members").alias("members"))
    items = (
        texts.where(F.size("spans") > 0)
        .select("sets")
        .distinct()
        .withColumn("item_set", F.explode("sets"))
        .join(members.hint("merge"), "item_set")
        .groupBy("sets")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("members")))).alias("item_ids"))
    )
    together = F.struct(
        "n_words", F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "longest_match", "spans"
    )
    return (
        numbered.select("number", "row")
        .join(texts.hint("merge"), "number")
        .join(items.hint("merge"), "sets", "left")
        .select("row", together.alias("found"))
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    carry: list[str] | None = None,
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all if not given) with, per document, n_words, n_hit (words inside a match), n_items,
    item_ids (sorted), longest_match (in words) and spans (merged, in words)."""
    carry = [c for c in (docs.columns if carry is None else carry) if c not in RESULT]
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row") if carry else F.struct(F.lit(0)).alias("row"), F.col("text")
    )
    count, blocks = item_blocks(benchmark, window, block_chars)
    if count == 1:
        rows = _matches(rows, next(blocks), shard_bytes)
    else:
        rows = _in_blocks(rows, blocks, shard_bytes)
    hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return rows.select(
        *(F.col(f"row.`{c}`") for c in carry),
        "found.n_words",
        hit.alias("n_hit"),
        F.size("found.item_ids").cast("long").alias("n_items"),
        "found.item_ids",
        "found.longest_match",
        "found.spans",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that share a window with the benchmark."""
    rows = docs.select("text", F.struct("*").alias("document"))
    clean = find_contamination(rows, benchmark, carry=["document"], **options).where(F.col("n_hit") == 0)
    return clean.select(*(F.col(f"document.`{c}`") for c in docs.columns))

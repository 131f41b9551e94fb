"""Words of Arrow text columns as arrays of byte positions and hashes; shared by operators that read whole texts in Python."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32  # letters outside ASCII stay: their UTF-8 bytes are above 127


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true for the bytes of the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after another and 8 zeros behind, and the offsets where texts start and end. Null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(ends) == 0:
        return np.zeros(8, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    own = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return np.concatenate([own, np.zeros(8, dtype=np.uint8)]), ends - ends[0]


def spans_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of bytes of class ``inside`` that do not cross from one text to the next."""
    n = int(offsets[-1])
    flags = np.zeros(n + 2, dtype=bool)
    flags[1:-1] = inside[data[:n]]
    step = flags[1:] != flags[:-1]  # step[i]: something starts or ends before byte i
    borders = offsets[1:-1]
    borders = np.unique(borders[(borders > 0) & (borders < n)])
    borders = borders[flags[borders] & flags[borders + 1]]  # a run goes on across the end of a text
    edges = np.flatnonzero(step)
    if len(borders):
        edges = np.sort(np.concatenate([edges, borders, borders]))
    return edges[0::2], edges[1::2]


def per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bounds into ``starts``: the spans of text i are bounds[i] to bounds[i + 1]."""
    return np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span, eight bytes at a time. ``data`` has 8 bytes to spare at its end."""
    loads = np.ndarray((len(data) - 7,), dtype="<u8", buffer=np.ascontiguousarray(data), strides=(1,))
    left = ends - starts
    hashes = mixed(left.astype(np.uint64) + np.uint64(0x51ED270B5F))
    live = np.flatnonzero(left > 0)
    at = starts[live]
    left = left[live]
    while len(live):
        part = loads[at]
        short = left < 8
        if short.any():
            bits = (left[short] * 8).astype(np.uint64)
            part[short] &= (np.uint64(1) << bits) - np.uint64(1)
        hashes[live] = mixed(hashes[live] * np.uint64(0xC2B2AE3D27D4EB4F) + part)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return hashes


def slices_by_bytes(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices whose texts have about ``most`` bytes, or one longer text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = batch.column(column)
        sizes = np.asarray(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        group = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for first, last in zip(cuts, cuts[1:]):
            yield batch.slice(first, last - first)

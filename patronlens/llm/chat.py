"""Chat formatting with loss masks that are aligned by character offsets.

A conversation is rendered whole, turn after turn: ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>`` and a line feed. The three
markers are special tokens, so no token crosses the border of a text. Inside roles and texts every ``<|`` gets a backslash behind its
``<``, one more than it has, so markers in a text are ordinary text there and come back when one backslash is taken away again.

The rendered conversation is encoded once, with the offsets of each token: tokens follow each other without a gap, so the sums of their
lengths in bytes are where they end. The spans of the assistant's texts and those of the tokens are both sorted; a binary search for each
end of a span gives the tokens that it covers, and these make the loss mask. The ids are those of the ``tokenizers`` library with the
markers as special tokens; its vocabulary is merged by rank, as for packing, and tests compare ids and offsets.

Rows are dealt out by conversation and sorted by the JVM; a task reads them as a stream and holds one conversation at a time.

Defined cases: null roles and texts are empty; rows are ordered by turn, null first, then by role and text, and repeated rows are turns
like any others; rows without a conv_id make one conversation; only the role ``assistant`` is learned; a conversation without it has an
empty mask; further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from tokenizers import AddedToken, Tokenizer

from patronlens.llm.tokens import Encoder, load, segments

START, SEPARATOR, END = MARKERS = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNED = "assistant"
TO_ESCAPE = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")
TURN = re.compile(rf"{re.escape(START)}(.*?){re.escape(SEPARATOR)}(.*?){re.escape(END)}\n", re.DOTALL)
FORMATTED = "formatted string, n_turns long, input_ids array<int>, loss_mask array<boolean>, loss_spans array<struct<start: long, end: long>>"
BATCH_CHARS = 1 << 20


def escape(text: str) -> str:
    return TO_ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and the spans of what is learned from, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEPARATOR}", escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation, as they were."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


def chat_tokenizer(path: str) -> Tokenizer:
    """The tokenizer with the markers as further special tokens."""
    tokenizer = load(path)
    tokenizer.encode_special_tokens = False
    tokenizer.add_special_tokens([AddedToken(x, special=True, normalized=False) for x in MARKERS])
    return tokenizer


class ChatEncoder:
    """Ids of rendered conversations, as ``chat_tokenizer`` gives them, and the bytes that each stands for."""

    def __init__(self, path: str):
        marked = chat_tokenizer(path)
        markers = {x: marked.token_to_id(x) for x in MARKERS}
        ranks = Encoder(path).fast._mergeable_ranks
        self.fast = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=markers)
        self.widths = np.zeros(self.fast.max_token_value + 1, dtype=np.int64)
        for piece, number in ranks.items():
            self.widths[number] = len(piece)
        for marker, number in markers.items():
            self.widths[number] = len(marker)

    def encode(self, formatted: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and (start, end) of each in bytes."""
        parts = [self.fast.encode_to_numpy(part, allowed_special="all") for part in segments(formatted)]
        ids = np.concatenate(parts).astype(np.int32)
        ends = np.cumsum(self.widths[ids])
        return ids, np.stack([ends - self.widths[ids], ends], axis=1)

    def decode(self, ids: np.ndarray) -> str:
        return self.fast.decode_bytes(ids.tolist()).decode()


@lru_cache(maxsize=2)
def chat_encoder(path: str) -> ChatEncoder:
    """One encoder per Python worker, which serves many tasks."""
    return ChatEncoder(path)


def covered_tokens(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in a span; ``offsets`` (start, end) and ``spans`` are sorted. A character of several tokens takes them all."""
    mask = np.zeros(len(offsets) + 1, dtype=np.int64)
    if len(spans) and len(offsets):
        first = np.searchsorted(offsets[:, 1], [start for start, _ in spans], side="right")
        last = np.searchsorted(offsets[:, 0], [end for _, end in spans], side="left")
        np.add.at(mask, first, 1)
        np.add.at(mask, np.maximum(first, last), -1)
    return np.cumsum(mask[:-1]) > 0


def masked_text(encoder: ChatEncoder, ids: np.ndarray, mask: np.ndarray) -> list[str]:
    """The texts of the tokens under the mask, one for each unbroken run."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return [encoder.decode(ids[a:b]) for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist())]


def format_turns(encoder: ChatEncoder, turns: list[tuple[str, str]]) -> tuple[str, int, np.ndarray, np.ndarray, np.ndarray]:
    """The rendered turns, their number, ids, mask, and the spans of what is learned from, in characters."""
    formatted, spans = render(turns)
    spans = np.array(spans, dtype=np.int64).reshape(-1, 2)
    ids, offsets = encoder.encode(formatted)
    in_bytes = spans
    if not formatted.isascii():
        data = np.frombuffer(formatted.encode(), dtype=np.uint8)
        in_bytes = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))[spans]
    return formatted, len(turns), ids, covered_tokens(offsets, in_bytes), spans


def listed(arrays: list[np.ndarray], values: pa.Array) -> pa.ListArray:
    """A list for each array, of ``values``, which are those of all arrays one after another."""
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), values)


def arrays_of(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column without nulls."""
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(column.flatten().to_numpy(zero_copy_only=False), ends[:-1]) if len(column) else []


def format_conversations(rows: DataFrame, tokenizer: str) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): conv_id, formatted, n_turns, input_ids, loss_mask, loss_spans."""
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {FORMATTED}"
    names = ["conv_id", "formatted", "n_turns", "input_ids", "loss_mask", "loss_spans"]

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple[str, str]]]]:
        current, turns = None, []
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
                if turns and conv_id != current:
                    yield current, turns
                    turns = []
                current = conv_id
                turns.append((role or "", text or ""))
        if turns:
            yield current, turns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, kind, done, chars = chat_encoder(tokenizer), None, [], 0

        def out() -> pa.RecordBatch:
            conv_ids, texts, counts, ids, masks, spans = zip(*done)
            pairs = np.concatenate(spans)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(conv_ids, kind),
                    pa.array(texts, pa.string()),
                    pa.array(counts, pa.int64()),
                    listed(ids, pa.array(np.concatenate(ids))),
                    listed(masks, pa.array(np.concatenate(masks))),
                    listed(spans, pa.StructArray.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["start", "end"])),
                ],
                names=names,
            )

        def noted() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.column(0).type
                yield batch

        for conv_id, turns in conversations(noted()):
            done.append((conv_id, *format_turns(encoder, turns)))
            chars += len(done[-1][1])
            if chars >= BATCH_CHARS:
                yield out()
                done, chars = [], 0
        if done:
            yield out()

    ordered = rows.select("conv_id", "role", "text", "turn").repartition("conv_id")
    return (
        ordered.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(scan, schema)
    )

"""Token ids of whole texts by a public byte-level tokenizer, given as a file of the ``tokenizers`` library.

The same vocabulary also serves as ranks for ``tiktoken``, which gives the same ids several times as fast: its pieces are merged by rank,
and here the rank of a merge is its id. Both cut texts by the same pattern; their ids were compared for every code point of Unicode, and
tests compare them on random texts, long runs without a blank among them.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import tiktoken
from public_tokenizers import PATTERN
from tokenizers import Tokenizer

BEFORE_WORD = re.compile(r" (?=[!-~\w])")  # a byte-level tokenizer always cuts here
SEGMENT = 1 << 20


def load(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def byte_characters() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary: visible ones for themselves, the rest in order from
    code point 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in visible]
    return {chr(byte): byte for byte in visible} | {chr(256 + i): byte for i, byte in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        tokenizer = load(path)
        special = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
        byte = byte_characters()
        ranks = {
            bytes(byte[c] for c in token): number
            for token, number in tokenizer.get_vocab(with_added_tokens=False).items()
            if token not in special
        }
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _ids(self, text: str) -> bytes:
        return array("I", self.fast.encode_ordinary(text)).tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        for text in texts:
            yield self._ids(text) if len(text) <= SEGMENT else b"".join(map(self._ids, segments(text)))


def segments(text: str) -> Iterator[str]:
    """A long text cut where the tokenizer cuts it too."""
    start = 0
    while place := BEFORE_WORD.search(text, start + SEGMENT):
        yield text[start : place.start()]
        start = place.start()
    yield text[start:]

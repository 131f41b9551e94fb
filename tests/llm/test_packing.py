import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path as tokenizer_path
from tokenizers import Tokenizer

from patronlens.llm import packing, tokens
from tests.llm.samples import AWKWARD, LONG, documents, invented

PATH = tokenizer_path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True
ENCODER = tokens.Encoder(PATH)


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def ours(text):
    return np.frombuffer(next(ENCODER.encode([text])), dtype="<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", " ", " ", "'s", "'", "ll", "don't", "é", "ß", "×", "ª", "漢字", "😀", "é", "Ж", "12", "٣", "²", ".", ",!", "<|endoftext|>", "word", "_", "\x1c", "\r\n"])))
def test_parts_give_the_ids_of_the_whole_text(pieces):
    text = "".join(pieces)
    assert ours(text) == plain(text)


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_any_text_gives_the_ids_of_the_whole(text):
    assert ours(text) == plain(text)


def test_long_texts_and_long_runs(monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT", 1000)
    for text in (LONG[:50_000], "x" * 5000, "ab " + "xy" * 100_000, " " * 50_000 + "a", "\n" * 1999 + "a", "é" * 1999):
        assert ours(text) == plain(text)


def test_every_kind_of_character_is_cut_alike():
    points = [c for c in range(0x110000) if c % 61 == 0 and not 0xD800 <= c <= 0xDFFF]
    for c in map(chr, points):
        text = f"a{c}b {c}{c} 1{c}2,{c} {c}."
        assert ours(text) == plain(text)


def checked(rows, texts, length):
    """Every id in one piece, sequences without gaps, and the share of padding."""
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    expected = {}
    for doc_id, text in texts:
        ids = [*plain(text), 0]
        expected.setdefault((doc_id, len(ids)), []).append(ids)
    assert by_doc.keys() == expected.keys()
    for key, pieces in by_doc.items():
        whole = sorted(np.array(ids, dtype="<u4").tobytes() for ids in expected[key])
        if len(whole) == 1:
            assert b"".join(p.ids for p in sorted(pieces, key=lambda p: p.start)) == whole[0]
            assert [p.start for p in sorted(pieces, key=lambda p: p.start)] == np.cumsum([0, *(p.length for p in sorted(pieces, key=lambda p: p.start))])[:-1].tolist()
        assert sum(p.length for p in pieces) == sum(len(x) // 4 for x in whole)
    assert all(len(r.ids) == 4 * r.length > 0 for r in rows)
    sequences, padding, total = {}, 0, 0
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
        total += at
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding / max(1, total + padding)


@pytest.mark.parametrize("partitions", [1, 7])
def test_round_trip(spark, partitions):
    texts = list(enumerate(invented(11, 300, words=150))) + [(1000, LONG), (1001, "<|endoftext|>")]
    df = documents(spark, texts).repartition(partitions)
    assert checked(packing.pack(df, PATH, length=128, windows=8).collect(), texts, 128) < 0.02


def test_many_rounds_of_merging(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    texts = list(enumerate(invented(12, 120, words=30)))
    rows = packing.pack(documents(spark, texts).repartition(12), PATH, length=64, windows=3).collect()
    assert checked(rows, texts, 64) < 0.05


def test_awkward_rows(spark):
    df = documents(spark, AWKWARD, clashing=True).repartition(3)
    checked(packing.pack(df, PATH).collect(), AWKWARD, 1024)
    assert packing.pack(df.limit(0), PATH).collect() == []


def test_best_fit_and_the_fullest_goes():
    opened = packing.Windows(10, 2)
    assert opened.place(6, "a") is None and opened.place(5, "b") is None
    assert opened.place(4, "c") == ["a", "c"]  # fits both, fills the first
    assert opened.place(3, "d") is None and opened.used == [8]
    assert opened.place(9, "e") is None and sorted(opened.used) == [8, 9]
    assert opened.place(7, "f") == ["e"] and sorted(opened.used) == [7, 8]


def test_filled_up_cuts_only_at_full_sequences():
    draw = random.Random(1)
    pieces = [(i, 0, n := draw.randint(1, 9), n, bytes(4 * n)) for i in range(20)]
    made = list(packing.filled_up([pieces[:7], pieces[7:]], 10))
    assert [sum(p[2] for p in own) for own in made[:-1]] == [10] * (len(made) - 1)
    assert sum(p[2] for own in made for p in own) == sum(p[2] for p in pieces)
    assert all(len(p[4]) == 4 * p[2] for own in made for p in own)


def test_query_digest_is_that_of_the_ids(spark):
    row = packing.pack(documents(spark, [(1, "some text")]), PATH).selectExpr("ids", "crc32(ids) AS c").first()
    assert row.c == zlib.crc32(np.array([*plain("some text"), 0], dtype="<u4").tobytes())

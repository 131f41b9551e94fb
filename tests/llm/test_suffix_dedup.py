import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronlens.llm import suffix_dedup
from tests.llm.samples import AWKWARD, LONG, documents, invented

LEAST = suffix_dedup.LEAST


def plain(texts):
    """(bytes, spans, kept) of each text by counting every string of LEAST bytes."""
    texts = [(t or "").encode() for t in texts]
    counts = Counter(hash(t[i : i + LEAST]) for t in texts for i in range(len(t) - LEAST + 1))
    found = []
    for t in texts:
        covered = np.zeros(len(t) + 2, dtype=bool)
        for i in range(len(t) - LEAST + 1):
            if counts[hash(t[i : i + LEAST])] > 1:
                covered[i + 1 : i + 1 + LEAST] = True
        edges = np.flatnonzero(covered[1:] != covered[:-1]).tolist()
        spans = list(zip(edges[0::2], edges[1::2]))
        borders = [0, *(x for span in spans for x in span), len(t)]
        found.append((len(t), spans, b"".join(t[a:b] for a, b in zip(borders[0::2], borders[1::2]))))
    return found


def shared(seed, count):
    """Texts with copies, near copies and passages of many lengths around the least, some across the end or inside one text."""
    draw, texts = random.Random(seed), invented(seed, count, words=120)
    passages = [" ".join(invented(seed + 1 + i, 1, words=90))[: draw.randint(150, 420)] for i in range(12)]
    for i in range(count):
        kind = draw.random()
        if kind < 0.3:
            texts[i] = texts[i][: draw.randint(0, 200)] + draw.choice(passages) + texts[i][:60]
        elif kind < 0.4:
            texts[i] = texts[draw.randrange(count)]
        elif kind < 0.5:
            other = texts[draw.randrange(count)]
            at = draw.randint(0, len(other))
            texts[i] = other[:at] + "ß" + other[at:]
        elif kind < 0.55:
            texts[i] = (draw.choice(passages) + " ") * 3
        elif kind < 0.6:
            texts[i] = draw.choice("ab ") * draw.randint(150, 500)
        elif kind < 0.65:
            texts[i] = "\0" * draw.randint(0, 300) + texts[i]
    return texts


def check(spark, texts, **options):
    df = documents(spark, list(enumerate(texts))).repartition(3)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df, **options).collect()}
    assert len(got) == len(texts)
    for i, (size, spans, kept) in enumerate(plain(texts)):
        assert got[i].n_bytes == size and [tuple(s) for s in got[i].spans] == spans, i
        assert got[i].kept == kept and got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert got[i].n_removed == size - len(kept)


def test_equal_to_counting_all_strings(spark):
    texts = shared(5, 260)
    assert sum(len(s) for _, s, _ in plain(texts)) > 50
    check(spark, texts)


@pytest.mark.parametrize("crowd,shard_bytes", [(1, 1 << 20), (3, 2000), (0, 5000)])
def test_crowded_anchors_and_small_shards_change_nothing(spark, crowd, shard_bytes):
    check(spark, shared(6, 120), crowd=crowd, shard_bytes=shard_bytes)


@pytest.mark.parametrize("least", [1, 2, 7, 30])
def test_interval_expansion_of_one_shard(least):
    draw = random.Random(least)
    for _ in range(30):
        texts = ["".join(draw.choice("ab") for _ in range(draw.randint(0, 60))).encode() for _ in range(draw.randint(1, 6))]
        counts = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
        want = [[i for i in range(len(t) - least + 1) if counts[t[i : i + least]] > 1] for t in texts]
        assert [s.tolist() for s in suffix_dedup.repeated_starts(texts, least)] == want


def test_suffixes_are_sorted():
    texts = [t.encode() for t in shared(7, 30)]
    symbols = np.frombuffer(b"\xff".join(texts) + b"\xff", dtype=np.uint8) + np.uint8(1)
    ends = np.flatnonzero(symbols == 0)
    left = ends[np.searchsorted(ends, np.arange(len(symbols)))] - np.arange(len(symbols))
    order = suffix_dedup.sorted_suffixes(symbols, left, LEAST)
    tails = [(bytes(symbols[i : i + min(LEAST, left[i])]), i if left[i] < LEAST else 0) for i in order]
    assert sorted(order.tolist()) == list(range(len(symbols))) and tails == sorted(tails)


def test_equal_strings_have_equal_anchors(monkeypatch):
    texts = shared(8, 40)
    for stretch in (1 << 23, 999):
        monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
        import pyarrow as pa

        data, offsets = suffix_dedup.text_bytes(pa.array(texts))
        text, start, starts, anchor, _ = suffix_dedup.runs_of(data, offsets)
        assert starts.sum() == sum(max(0, len(t.encode()) - LEAST + 1) for t in texts)
        of = {}
        for t, s, n, a in zip(text.tolist(), start.tolist(), starts.tolist(), anchor.tolist()):
            for p in range(s, s + n):
                own = texts[t].encode()[p : p + LEAST]
                assert len(own) == LEAST and of.setdefault(own, a) == a


def test_a_phrase_of_many_texts(spark):
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(500)]
    around = lambda n: " ".join(draw.choice(words) for _ in range(n))
    passage = around(40)
    check(spark, [f"{around(30)} {passage} {around(30)}" for _ in range(150)], crowd=20)


def test_awkward_rows(spark):
    rows = AWKWARD + [(8, LONG[:5000] + "x"), (None, "y" * 199), (None, "z" * 200)]
    for clashing in (False, True):
        df = documents(spark, rows, clashing)
        got = suffix_dedup.remove_repeats(df).collect()
        want = plain([t for _, t in rows])
        assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), r.kept) for r in got) == sorted(
            (str(i), size, size - len(kept), len(spans), kept) for (i, _), (size, spans, kept) in zip(rows, want)
        )
        assert not clashing or {r.row for r in got} == {"own row"}
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []


def test_a_cut_through_a_character(spark):
    tail = "ä" * 150  # 300 bytes
    texts = ["a" + tail, "é" + tail + "q", "bb" + tail[:101]]
    check(spark, texts)
    df = documents(spark, list(enumerate(texts))).withColumn("text", F.col("text"))
    assert all(isinstance(r.kept, (bytes, bytearray)) for r in suffix_dedup.remove_repeats(df).collect())

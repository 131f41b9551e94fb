import random
import re

import numpy as np
import pytest

from patronlens.llm.decontaminate import decontaminate, find_contamination, suffix_array
from tests.llm.samples import AWKWARD, documents, invented


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, window):
    """Per document: words, hit words, item ids, longest match, spans."""
    result = []
    for text in docs:
        words, hit, ids, longest = words_of(text), set(), set(), 0
        for item_id, item in items:
            own = words_of(item)
            size = min(window, len(own))
            for i in range(len(own) - size + 1 if size else 0):
                for j in range(len(words) - size + 1):
                    if words[j : j + size] == own[i : i + size]:
                        ids.add("" if item_id is None else str(item_id))
                        hit.update(range(j, j + size))
                        length = size
                        while j + length < len(words) and i + length < len(own) and words[j + length] == own[i + length]:
                            length += 1
                        longest = max(longest, length)
        result.append((len(words), len(hit), sorted(ids), longest))
    return result


def found(spark, texts, items, **options):
    df = documents(spark, list(enumerate(texts))).repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = find_contamination(df, benchmark, **options).orderBy("doc_id").collect()
    for r in rows:
        assert r.n_hit == sum(s["end"] - s["start"] for s in r.spans) and r.n_items == len(r.item_ids)
    return [(r.n_words, r.n_hit, r.item_ids, r.longest_match) for r in rows]


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 200}, {"block_chars": 300}])
def test_random_texts_equal_brute_force(spark, options):
    texts = invented(4, 120, words=40, alphabet=5)
    items = list(enumerate(invented(5, 14, words=9, alphabet=5))) + [(3, "a"), (None, texts[0][:30]), (9, ""), (10, None), (11, "?!")]
    got = found(spark, texts, items, window=4, **options)
    assert got == brute(texts, items, 4)
    assert 10 < sum(1 for row in got if row[1]) < len(got)


def test_windows_spans_and_locations(spark):
    item = "One two three, four five six seven eight nine ten eleven twelve"
    near = "ZERO one TWO three four FIVE six seven eight nine ten eleven thirteen"
    short = "one two three four five six seven eight nine"
    df = documents(spark, [(1, near), (2, short), (3, f"{item}\n{item}")])
    benchmark = spark.createDataFrame([(5, item), (40, item), (6, "solo words here")], "item_id long, text string")
    got = {r.doc_id: r for r in find_contamination(df, benchmark).collect()}
    assert (got[1].n_hit, got[1].item_ids, got[1].longest_match) == (11, ["40", "5"], 11)
    assert [tuple(s) for s in got[1].spans] == [(1, 12)]
    assert (got[2].n_hit, got[2].item_ids) == (0, [])
    assert (got[3].n_hit, got[3].longest_match) == (24, 12)
    assert [r.doc_id for r in decontaminate(df, benchmark).collect()] == [2]


def test_a_match_does_not_cross_documents(spark):
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    df = documents(spark, [(1, "a b c d e"), (2, "f g h i j")]).coalesce(1)
    assert decontaminate(df, benchmark).count() == 2


def test_awkward_rows(spark):
    df = documents(spark, AWKWARD, clashing=True)
    benchmark = spark.createDataFrame([(1, "first of two"), (2, "😀 wörds ﬁ ١٢٣")], "item_id long, text string")
    got = decontaminate(df, benchmark)
    assert got.columns == df.columns
    rows = got.collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in rows) == sorted(
        (d is not None, d or 0) for d, t in AWKWARD if t not in ("first of two", AWKWARD[-1][1])
    )
    assert all(r.found == "own found" and r.n_hit == "own n_hit" for r in rows)
    assert decontaminate(df, benchmark.limit(0)).count() == len(AWKWARD)
    assert decontaminate(df.limit(0), benchmark).collect() == []


@pytest.mark.parametrize("options", [{}, {"block_chars": 20_000}])
def test_items_that_share_an_instruction(spark, options):
    shared = "please read the passage below with care and then answer the question in words"
    items = [(i, f"{shared} topic{i} detail{i}") for i in range(3000)]
    texts = [f"intro{i} {shared} topic{i} other" for i in range(300)] + ["nothing here"]
    rows = find_contamination(documents(spark, list(enumerate(texts))).repartition(2), spark.createDataFrame(items, "item_id long, text string"), **options)
    rows = {r.doc_id: r for r in rows.collect()}
    every = sorted(str(i) for i in range(3000))
    for i in range(300):
        r = rows[i]
        assert (r.n_hit, r.longest_match, [tuple(s) for s in r.spans], r.item_ids == every) == (15, 15, [(1, 16)], True)
    assert rows[300].item_ids == [] and rows[300].spans == []


def test_long_copies_and_repeats(spark):
    draw = random.Random(8)
    long = " ".join(draw.choice("abc") + str(draw.randrange(3)) for _ in range(700))
    again = " ".join(["la"] * 60)
    texts = [long, "x " + long[9:-7] + " y", again, again + " la la", f"{long} {long}", " ".join(["la"] * 12)]
    items = [(1, long), (2, again), (3, "la la la")]
    for options in ({}, {"block_chars": 1500}):
        assert found(spark, texts, items, **options) == brute(texts, items, 10)


@pytest.mark.parametrize("n", [0, 1, 2, 50, 300])
def test_suffix_array(n):
    draw = np.random.default_rng(n)
    words = draw.integers(0, 3, n).astype(np.int32)
    suffixes = [tuple(words[i : i + 16].tolist()) for i in suffix_array(words, 16)]
    assert suffixes == sorted(suffixes)

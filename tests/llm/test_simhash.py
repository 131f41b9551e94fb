import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from patronlens.llm import simhash
from patronlens.llm.bytewords import slices_by_bytes
from tests.llm.samples import AWKWARD, LONG, documents, invented


def brute_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(prints):
    """{fingerprint: smallest reachable position}; one entry a position."""
    values = np.array(prints, dtype=np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    label = np.arange(len(values))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label.tolist()
        label = new


def test_fingerprints_equal_brute_force():
    texts = [*invented(6, 60), *(t for _, t in AWKWARD if t != LONG), "A", "a b", "A  B\r\nc\x0bÄ d", "x y z"]
    assert simhash.fingerprints_of(pa.array(texts)).tolist() == [brute_print(t) for t in texts]
    assert simhash.fingerprints_of(pa.array([LONG[:50_000]])).tolist() == [brute_print(LONG[:50_000])]


def test_the_scan_of_a_large_batch_needs_little_memory():
    batch = pa.RecordBatch.from_arrays([pa.array(invented(7, 100) * 60)], names=["text"])
    assert batch.nbytes > 1 << 20
    tracemalloc.start()
    for part in slices_by_bytes(iter([batch]), 0, simhash.SLICE_BYTES):
        simhash.fingerprints_of(part.column(0))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 16 << 20


def test_the_codes_are_perfect_and_homes_are_met():
    code = simhash.covering_code()  # raises if a part is not perfect
    draw = np.random.default_rng(1)
    x = draw.integers(0, 2**64, 300, dtype=np.uint64, endpoint=False)
    y = x.copy()
    for i in range(len(y)):
        for bit in draw.choice(64, i % 3, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(bit)
    home = {int(p): int(a) for anchors, prints, own in simhash.anchors_of(x, code) if own for a, p in zip(anchors, prints)}
    visited = {}
    for anchors, prints, _ in simhash.anchors_of(y, code):
        for a, p in zip(anchors.tolist(), prints.tolist()):
            assert a not in visited.setdefault(p, set()) or np.sum(y == p) > 1
            visited[p].add(a)
    assert all(home[int(a)] in visited[int(b)] for a, b in zip(x, y))


def clustered(seed):
    draw = random.Random(seed)
    prints = []
    for _ in range(12):
        base = draw.getrandbits(64)
        for _ in range(draw.randint(1, 40)):
            value = base
            for _ in range(draw.randint(0, 4)):
                value ^= 1 << draw.randrange(64)
            prints.append(value)
    return list(dict.fromkeys(prints))


@pytest.mark.parametrize("crowd", [simhash.CROWD, 3, 1])
def test_links_give_the_components_of_all_pairs(spark, crowd):
    prints = clustered(9)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fingerprint long").repartition(4)
    got = simhash.connected_components(simhash.links(df, crowd=crowd)).collect()
    component = {r.node: r.component for r in got}
    label = groups(prints)
    ours = [component.get(x, x) for x in signed]
    assert len(set(zip(ours, label))) == len(set(ours)) == len(set(label)) < len(prints)


def test_compare_streams_in_any_batches():
    draw = np.random.default_rng(3)
    anchor = np.sort(draw.integers(0, 30, 400)).astype(np.int64)
    prints = draw.integers(0, 16, 400).astype(np.int64)
    home = draw.random(400) < 0.5

    def run(step, crowd):
        task, pairs = simhash.Compare(2, crowd), []
        for at in range(0, 400, step):
            pairs += zip(*task.feed(anchor[at : at + step], prints[at : at + step], home[at : at + step]))
        pairs += zip(*task.feed(anchor[:0], prints[:0], home[:0], end=True))
        return pairs

    for crowd in (4, 12, 500):
        crowds = [sorted(a for a, b in run(step, crowd) if b is None) for step in (1, 7, 64, 400)]
        assert all(x == crowds[0] for x in crowds)


def test_whole_operator(spark):
    texts = invented(8, 40, words=80)
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts[:10])]
    rows += [(200 + i, t + " tail") for i, t in enumerate(texts)] + [(300, None), (301, ""), (302, " \n")]
    got = {r.doc_id: r for r in simhash.near_duplicates(documents(spark, rows).repartition(3)).collect()}
    ids = sorted(got)
    by_id = dict(rows)
    prints = [brute_print(by_id[i]) for i in ids]
    assert [got[i].fingerprint & (2**64 - 1) for i in ids] == prints
    assert [got[i].component_id for i in ids] == [ids[k] for k in groups(prints)]
    assert got[302].component_id == 300 and got[100].component_id == 0


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d"), (2, "A b  c d"), (2, "a b c d"), (2, "a b c d"), (None, "a b c d"), (9, None), (8, ""), (None, "quite another text")]
    df = documents(spark, rows, clashing=True)
    got = simhash.drop_near_duplicates(df)
    assert got.columns == df.columns
    assert sorted((str(r.doc_id), r.row) for r in got.collect()) == [("2", "own row"), ("8", "own row"), ("None", "own row")]


def test_awkward_rows(spark):
    df = documents(spark, AWKWARD, clashing=True)
    assert simhash.near_duplicates(df).count() == len(AWKWARD)
    assert simhash.near_duplicates(df.limit(0)).collect() == []
    assert simhash.drop_near_duplicates(df.limit(0)).collect() == []
    shown = spark.range(1).select(simhash.hexadecimal(F.lit(-1)).alias("a"), simhash.hexadecimal(F.lit(10)).alias("b")).first()
    assert tuple(shown) == ("f" * 16, "0" * 15 + "a")

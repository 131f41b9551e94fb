import numpy as np
import pytest

from patronlens.llm import embeddings


def vectors(seed, count, size=32):
    """Clusters of near and exact copies among random vectors, and labels."""
    draw = np.random.default_rng(seed)
    rows = []
    while len(rows) < count:
        base, label = draw.normal(size=size), int(draw.integers(0, 3))
        for _ in range(int(draw.choice([1, 1, 1, 2, 5, 30]))):
            spread = draw.choice([0.0, 0.1, 0.3])
            rows.append((label if draw.random() < 0.95 else None, base * draw.choice([1.0, 2.0]) + spread * draw.normal(size=size)))
    return [(i, [float(x) for x in np.float32(v)], label) for i, (label, v) in enumerate(rows[:count])]


def brute(rows):
    ids, labels = [r[0] for r in rows], [r[2] for r in rows]
    v = np.array([r[1] for r in rows], dtype=np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    linked = (v @ v.T) >= 0.93
    same = np.array([[a is not None and a == b for b in labels] for a in labels])
    linked &= same
    np.fill_diagonal(linked, False)
    label = np.arange(len(ids))
    while True:
        new = np.minimum(label, np.array([label[row].min() if row.any() else len(ids) for row in linked]))
        if (new == label).all():
            break
        label = new
    return {i: (int(linked[k].sum()), ids[label[k]]) for k, i in enumerate(ids)}


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    return {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df, **options).collect()}


@pytest.mark.parametrize("block", [2048, 20])
def test_equal_to_brute_force(spark, block):
    rows = vectors(1, 700)
    got, want = found(spark, rows, block=block), brute(rows)
    links = sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)  # nothing below the threshold is linked
    assert sum(n for n, _ in got.values()) >= 0.99 * links > 1000
    assert sum(got[i] == want[i] for i in want) >= 0.98 * len(want)


def test_blocks_do_not_change_the_result(spark):
    rows = vectors(2, 300)
    assert found(spark, rows, block=7) == found(spark, rows)


def test_look_ups_lose_no_link():
    rows = np.array([r[1] for r in vectors(3, 600)])
    index = embeddings.Index.fit(rows, 8, 0.93)
    lists, codes, bound = index.encode(rows)
    unit = embeddings.unit(rows.astype(np.float64))
    approximate = index.approximate(unit, lists[:, 0], codes)
    linked = unit @ unit.T >= 0.93
    assert (approximate >= bound[None, :])[linked].all()
    assert (approximate >= bound[None, :]).sum() < 3 * linked.sum()


def test_invalid_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 5), (2, [2.0, 0.0], 5), (3, [1.0, 0.0], None), (4, [0.0, 0.0], 5), (5, None, 5), (6, [], 5),
        (7, [1.0, nan], 5), (8, [inf, 0.0], 5), (9, [1.0, None], 5), (10, [1.0, 0.0], 6), (11, [1.0, 0.0, 0.0], 5),
        (12, [-0.0, 1.0], 5), (13, [0.0, 1.0], 5), (13, [0.0, 1.0], 5), (None, [5.0, 0.1], 5), (None, [0.0, 0.0], 5),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'own' AS node", "'own' AS list")
    got = sorted(((r.vec_id is None, r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()), key=str)
    by_id = {}
    for _, vec_id, *rest in got:
        by_id.setdefault(vec_id, []).append(tuple(rest))
    assert by_id[1] == [(2, 1, True)] and by_id[2] == [(2, 1, False)]
    for alone in (3, 4, 5, 6, 7, 8, 9, 10, 11):
        assert by_id[alone] == [(0, alone, True)]
    assert by_id[12] == [(2, 12, True)] and by_id[13] == [(2, 12, False)] * 2
    assert sorted(by_id[None], key=str) == [(0, None, True), (2, 1, False)]
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


def test_many_copies_are_one_class(spark):
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(500)] + [(1000, [1.0, 2.0, 3.1], 1), (1001, [9.0, 0.0, 0.0], 1)]
    got = found(spark, rows)
    assert got[7] == (500, 0) and got[1000] == (500, 0) and got[1001] == (0, 1001)


def crowd(seed, count, size=64):
    """A third of the rows near copies of each other, all pairs linked; random vectors behind them."""
    draw = np.random.default_rng(seed)
    near = embeddings.unit(draw.normal(size=(1, size))) + draw.normal(size=(count // 3, size)) * 0.17 / size**0.5
    return np.concatenate([near, draw.normal(size=(count - len(near), size))])


def test_a_dense_group_of_many_centres_keeps_its_links(spark):
    rows = [(i, [float(x) for x in np.float32(v)], 0) for i, v in enumerate(crowd(4, 6000))]
    got = found(spark, rows)
    assert all(got[i] == (1999, 0) for i in range(2000)) and all(got[i] == (0, i) for i in range(2000, 6000))


def test_recall_of_a_dense_group_at_fifty_thousand_rows():
    rows = crowd(5, 51_000)
    index = embeddings.Index.fit(rows, 256, 0.93)
    places = index.encode(rows[:17_000])[0]
    own, visits = index.lists[places[:, 0]], places[:, 1:]
    draw = np.random.default_rng(6)
    a, b = draw.integers(0, 17_000, size=(2, 200_000))
    unit = embeddings.unit(rows[:17_000])
    assert ((unit[a] * unit[b]).sum(axis=1) >= 0.93).all() and len(set(places[:, 0])) > 50
    assert ((own[a] == own[b]) | (visits[a] == own[b][:, None]).any(axis=1) | (visits[b] == own[a][:, None]).any(axis=1)).all()


def directional(seed, count, cosine=0.7, size=64):
    """Vectors with a common direction: any two have about that cosine, and some have near copies."""
    draw = np.random.default_rng(seed)
    common = embeddings.unit(draw.normal(size=(1, size)))
    rows = np.sqrt(cosine) * common + np.sqrt(1 - cosine) * embeddings.unit(draw.normal(size=(count, size)))
    copies = count // 10
    rows[:copies] = rows[copies : 2 * copies] + draw.normal(size=(copies, size)) * 0.1 / size**0.5
    return rows


def test_a_common_direction_does_not_make_one_list():
    rows = directional(7, 20_000)
    index = embeddings.Index.fit(rows, 128, 0.93)
    places = index.encode(rows)[0]
    own, visits = index.lists[places[:, 0]], places[:, 1:]
    assert np.bincount(own).max() < 0.1 * len(rows) and len(set(own.tolist())) > 64
    a, b = np.arange(2000), np.arange(2000, 4000)
    unit = embeddings.unit(rows)
    assert ((unit[a] * unit[b]).sum(axis=1) >= 0.93).mean() > 0.99
    met = (own[a] == own[b]) | (visits[a] == own[b][:, None]).any(axis=1) | (visits[b] == own[a][:, None]).any(axis=1)
    assert met.mean() >= 0.99


def test_links_among_vectors_with_a_common_direction(spark):
    rows = [(i, [float(x) for x in np.float32(v)], 0) for i, v in enumerate(directional(8, 1500))]
    got, want = found(spark, rows), brute(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values()) > 200

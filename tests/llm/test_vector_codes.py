import hashlib

import numpy as np
import pytest

from patronlens.llm import vector_codes


def plain(vectors, rounds=4):
    """Codes, errors and codebooks of whole-number vectors in the order of their ids, all compared with all."""
    x = np.array(vectors, dtype=np.int64)
    cut = vector_codes.borders(x.shape[1])
    codes, error, books = [], np.zeros(len(x), dtype=np.int64), []
    for a, b in zip(cut, cut[1:]):
        part = x[:, a:b]
        book = part[:256].copy()
        for i in range(rounds + 1):
            squares = ((part[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
            code = squares.argmin(axis=1)
            if i < rounds:
                for e in set(code.tolist()):
                    book[e] = part[code == e].sum(axis=0) // (code == e).sum()
        codes.append(code)
        error += squares[np.arange(len(x)), code]
        books.append(book)
    return np.stack(codes, axis=1), error, books


def grouped(seed, count, size):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(40, size))
    return np.float32(centres[draw.integers(0, 40, size=count)] + 0.2 * draw.normal(size=(count, size)))


@pytest.mark.parametrize("size,count", [(16, 900), (10, 300), (2, 700)])
def test_equal_to_comparing_all(spark, size, count):
    rows = grouped(size, count, size)
    labels = [None if i % 7 == 0 else i % 3 for i in range(count)]
    data = [(i, [float(v) for v in row], label) for i, (row, label) in enumerate(zip(rows, labels))]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r.vec_id: r for r in vector_codes.compress_vectors(df).collect()}
    codes, error, books = plain(np.floor(rows.astype(np.float64) * 1024))
    text = ",".join(str(v) for book in books for v in book.reshape(-1).tolist())
    totals = {label: sum(int(e) for e, own in zip(error, labels) if own == label) for label in set(labels)}
    for i in range(count):
        assert got[i].codes == codes[i].tolist() and got[i].error == error[i]
        assert got[i].label_error == totals[labels[i]]
        assert got[i].codebooks_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bounds_spare_distances_and_change_nothing():
    x = np.floor(grouped(3, 4000, 16).astype(np.float64) * 1024).astype(np.int64)
    history, bounds, spared = [x[:256]], None, []
    for _ in range(8):
        book = vector_codes.Codebooks(history)
        bounds = book.first(x) if bounds is None else book.next(x, bounds)
        want = vector_codes.distances(x, history[-1])
        assert (bounds.code == want.argmin(axis=1)).all()
        assert (book.exact(x, bounds).near == want.min(axis=1)).all()
        spared.append(1 - book.scanned / want.size)
        after = history[-1].copy()
        for e in set(bounds.code.tolist()):
            after[e] = x[bounds.code == e].sum(axis=0) // (bounds.code == e).sum()
        history.append(after)
    assert spared[0] == 0 and spared[-1] > 0.5 and min(spared[3:]) > 0.2


def test_net_moves_are_tighter_than_the_sum_of_moves():
    there_and_back = [np.zeros((1, 4), dtype=np.int64), np.full((1, 4), 100), np.zeros((1, 4), dtype=np.int64)]
    book = vector_codes.Codebooks(there_and_back)
    assert book.moved[0, 0] == 0 and book.moved[1, 0] == 200


def test_many_ties():
    x = np.zeros((50, 8), dtype=np.int64)
    x[25:] = 3
    book = vector_codes.Codebooks([x])
    first = book.first(x)
    assert first.code.tolist() == [0] * 25 + [25] * 25
    again = vector_codes.Codebooks([x, x]).next(x, first)
    assert again.code.tolist() == first.code.tolist()


def test_large_numbers_stay_exact():
    x = np.array([[1 << 27, 1], [-(1 << 27), 0]], dtype=np.int64)
    assert vector_codes.distances(x, x)[0, 1] == (1 << 28) ** 2 + 1


def test_invalid_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.5, 2.0], 5), (1, [1.0, 0.0, 0.5, 1.0], None), (None, [0.0] * 4, 5), (3, None, 5), (4, [nan] * 4, 5),
        (5, [1.0, None, 2.0, 3.0], 5), (6, [inf] * 4, 5), (7, [], 5), (8, [1.0, 2.0], None), (9, [1.0, 2.0], None),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS codes", "2 AS x", "3 AS error")
    got = vector_codes.compress_vectors(df).collect()
    assert sorted((str(r.vec_id), len(r.codes), r.error) for r in got) == [
        ("1", 4, 0), ("1", 4, 0), ("7", 4, 0), ("8", 4, 0), ("9", 4, 0), ("None", 4, 0)
    ]
    # the vector of null comes last, of equal ids the smaller vector first
    assert {(r.vec_id, r.label): tuple(r.codes) for r in got}[1, None] == (0, 0, 0, 0)
    assert {(r.vec_id, r.label): tuple(r.codes) for r in got}[1, 5] == (0, 0, 0, 1)
    assert {(r.vec_id, r.label): tuple(r.codes) for r in got}[9, None] == (0, 0, 0, 0)
    assert len({r.codebooks_sha256 for r in got}) == 3
    empty = vector_codes.compress_vectors(df.limit(0))
    assert empty.collect() == [] and empty.columns == ["vec_id", "label", "codes", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError):
        vector_codes.compress_vectors(spark.createDataFrame([(1, [1e12], 1)], df.schema[:3]))

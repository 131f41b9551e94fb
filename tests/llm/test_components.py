import random

from patronlens.llm.components import connected_components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            one, other = find(a), find(b)
            parent[max(one, other)] = min(one, other)
    return {x: find(x) for x in parent}


def components(spark, edges):
    rows = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.component for r in rows}


def test_random_graphs(spark):
    draw = random.Random(2)
    edges = [(draw.randint(-100, 100), draw.randint(-100, 100)) for _ in range(90)]
    edges = [(a, b) for a, b in edges if a != b] * 2
    assert components(spark, edges) == brute(edges)


def test_a_long_chain_a_star_and_nulls(spark):
    edges = [(i, i + 1) for i in range(70)] + [(500, i) for i in range(501, 900)] + [(None, 3), (950, None), (960, 960)]
    got = components(spark, edges)
    assert got == brute(edges[:-3])


def test_no_edges(spark):
    assert components(spark, []) == {}

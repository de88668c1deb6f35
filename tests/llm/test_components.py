import random

import pytest

from natatio.llm import components


@pytest.mark.parametrize("few", [1 << 14, 30, 0])
def test_matches_plain_search(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few)
    r = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 160)] + [(r.randrange(80), r.randrange(80)) for _ in range(45)] + [(5, 5), (200, 201), (201, 200)]
    got = {x.node: x.root for x in components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    assert set(got) == set(near)
    for start in near:
        reached, todo = {start}, [start]
        while todo:
            for x in near[todo.pop()] - reached:
                reached.add(x)
                todo.append(x)
        assert {n for n in got if got[n] == got[start]} == reached and got[start] in reached


def test_no_edges(spark):
    assert components.connected_components(spark.createDataFrame([(1, 1)], "src long, dst long")).count() == 0

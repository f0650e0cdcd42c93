import random

import pytest

from siftwork.llm.components import connected_components


def brute(edges):
    group = {}

    def find(x):
        group.setdefault(x, x)
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        group[max(a, b)] = min(a, b)
    return {x: find(x) for x in group}


@pytest.mark.parametrize("one_task", [10**6, 0])
def test_chains_stars_and_noise(spark, one_task):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 30)] + [(rnd.randrange(-500, -400), rnd.randrange(-500, -400)) for _ in range(60)]
    edges += edges[:5]
    df = spark.createDataFrame([*edges, (7, 7)], "a long, b long").unionByName(spark.createDataFrame([(None, 3)], "a long, b long"))
    got = {r.node: r.component for r in connected_components(df, one_task=one_task).collect()}
    assert got == brute([e for e in edges if e[0] != e[1]])


def test_no_links(spark):
    for one_task in (10**6, 0):
        assert connected_components(spark.createDataFrame([], "a long, b long"), one_task=one_task).count() == 0

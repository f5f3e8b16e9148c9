import random

import pytest

from tripweave.llm.components import components


def plain(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {x: find(x) for x in root}


@pytest.mark.parametrize(
    "links",
    [
        [],
        [(i, i + 1) for i in range(60)],
        [(i + 1, i) for i in range(0, 60, 2)],
        [(0, i) for i in range(1, 300)] + [(300, 299), (300, 301)],
        [(5, 5), (None, 1), (2, None), (3, 4), (4, 3), (3, 4)],
        [(random.Random(i).randint(0, 80), random.Random(i + 999).randint(0, 80)) for i in range(70)],
    ],
)
def test_smallest_reachable(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    # Roots aren't nodes of a link to a smaller one.
    assert got == {node: low for node, low in plain(links).items() if node != low}

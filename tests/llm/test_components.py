"""Connected components on shapes that take many rounds, and on odd links."""

import random

from cairnframe.llm.components import connected_components


def plain(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {x: root(x) for x in parent}


def test_shapes(spark):
    r = random.Random(1)
    chain = list(range(1000, 1200))
    r.shuffle(chain)
    links = list(zip(chain, chain[1:], strict=False)) + [(5000, 5001 + k) for k in range(300)] + [(9000 + k, 9000 + (k + 1) % 50) for k in range(50)]
    links += [(r.randrange(-500, 0), r.randrange(-500, 0)) for _ in range(200)] + [(7, 7), (None, 3), (3, None), (5000, 5001), (5001, 5000)]
    r.shuffle(links)
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len({x.node for x in got}) and {x.node: x.component for x in got} == plain(links)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert connected_components(spark.createDataFrame([(4, 4)], "a long, b long")).count() == 0

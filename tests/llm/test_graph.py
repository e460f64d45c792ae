"""Connected components against a search."""

import random

from loomgraph.llm.graph import components


def search(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        todo = [start] if start not in out else []
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = start
                todo += near[x]
    return out


def test_components(spark):
    rng = random.Random(1)
    path = list(range(100))
    rng.shuffle(path)
    edges = list(zip(path, path[1:], strict=False)) + [(1000 + rng.randrange(60), 1000 + rng.randrange(60)) for _ in range(40)] + [(-5, 2000 + i) for i in range(300)] + [(3000, 3000), (2001, 2002), (2001, 2002)]
    table = spark.createDataFrame([*edges, (None, 1)], "a long, b long")
    assert {r.node: r.component for r in components(table).collect()} == search(edges)
    assert components(table.limit(0)).count() == 0

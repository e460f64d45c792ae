"""Circles and other ways in traversals."""

import random

from pyspark.sql import functions as F

from loomgraph.operators import references


def reach(edges):
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    found = {}
    for start in {x for e in edges for x in e}:
        seen, stack = set(), [start]
        while stack:
            for n in out.get(stack.pop(), ()):
                if n not in seen:
                    seen.add(n)
                    stack.append(n)
        found[start] = seen
    return found


def components(edges):
    led = reach(edges)
    return {frozenset(m for m in led if m == n or (m in led[n] and n in led[m])) for n in led}


def check(spark, edges):
    found = {}
    for r in references.strong_components(spark.createDataFrame(edges, "src string, dst string")).collect():
        found.setdefault(r.component, set()).add(r.node)
    whole = {frozenset(v) for v in found.values()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert {c for c in whole if len(c) > 1} == {c for c in components(real) if len(c) > 1}
    assert all(k == max(v) for k, v in found.items()) and sum(map(len, found.values())) == len(set().union(*found.values())) if found else True


def test_components_of_nested_circles(spark):
    rings = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "d"), ("e", "f"), ("f", "f"), (None, "a"), ("g", None), ("a", "b")]
    check(spark, rings)
    rng = random.Random(2)
    check(spark, [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(75)])
    assert references.strong_components(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_report_tells_circles_from_other_ways(spark):
    """s leads to x and y, both to z; z back to x: a circle of x and z within one of all but s."""
    edges = [("s", "x"), ("s", "y"), ("x", "z"), ("y", "z"), ("z", "x"), ("z", "y"), ("s", "z"), ("z", "w"), ("w", "v"), ("v", "s2"), ("y", "y")]
    found = spark.createDataFrame(edges, "src string, dst string")
    visited = references.traverse(spark.createDataFrame([("s",)], "node string"), found, max_depth=2)
    reasons = {(r.src, r.dst): r.reason for r in references.traversal_report(visited, found).collect()}
    assert reasons == {
        ("s", "x"): "visited", ("s", "y"): "visited", ("s", "z"): "visited", ("x", "z"): "cycle", ("z", "x"): "cycle", ("y", "z"): "cycle", ("z", "y"): "cycle",
        ("y", "y"): "cycle", ("z", "w"): "visited", ("w", "v"): "max depth",
    }
    plain = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("b", "c")], "src string, dst string")
    visited = references.traverse(spark.createDataFrame([("a",)], "node string"), plain)
    assert {(r.src, r.dst) for r in references.traversal_report(visited, plain).collect() if r.reason == "another way"} == {("b", "c")}


def test_levels_leave_edges_and_visited_where_they_lie(spark, monkeypatch):
    """In the plan of level 3 the nodes it comes to are dealt once, and nothing else; the rows are those of a plain search."""
    plans, level = [], references.level

    def seen(visited, edges, depth):
        out = level(visited, edges, depth)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(references, "level", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = [(i, (i * 7 + k) % 500) for i in range(500) for k in range(3)] + [(None, 1), (1, None)]
        found = references.traverse(spark.createDataFrame([(3,), (3,), (None,), (77,)], "node long"), spark.createDataFrame(edges, "src long, dst long").repartition(3))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth, frontier = {3: 0, 77: 0}, {3, 77}
    for d in (1, 2, 3):
        frontier = {b for a, b in edges if a in frontier and b is not None} - depth.keys()
        depth |= dict.fromkeys(frontier, d)
    assert {r.node: r.depth for r in found.collect()} == depth and found.count() == len(depth)
    assert plans[2].count("Exchange ") == 1 and "SortMergeJoin" in plans[2], plans[2]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("edges_", "visited_"))]


def test_long_single_ways_take_few_rounds(spark, monkeypatch):
    """Circles of 40 nodes with a tail, and chains of 40 in both directions, are settled by doubling: no colour goes round."""
    written, materialize = [], references.materialize

    def seen(df, name):
        written.append(name)
        return materialize(df, name)

    monkeypatch.setattr(references, "materialize", seen)
    node = lambda c, i: f"{c}{i:02}"
    chain = lambda c, n: [(node(c, i), node(c, i + 1)) for i in range(n)]
    rings = [e for c in "ab" for e in (*chain(c, 39), (node(c, 39), node(c, 0)), (node(c, 7), f"{c}tail00"), *((f"{c}tail{i:02}", f"{c}tail{i + 1:02}") for i in range(50)))]
    turned = [(b, a) for a, b in chain("d", 40)]
    check(spark, [*rings, *chain("c", 40), *turned, *((node(c, i), "hub") for c in "abcd" for i in range(0, 40, 9)), ("hub", "x"), ("x", "hub")])
    assert len(written) < 40, written


def test_components_of_many_small_graphs(spark):
    """Rings, tails and trees of both directions, joined at random: as a plain search finds them."""
    rng, edges = random.Random(5), []
    for g in range(60):
        size = rng.randrange(2, 9)
        edges += [(f"g{g}n{i}", f"g{g}n{(i + 1) % size}") for i in range(size - rng.randrange(2))]
        edges += [(f"g{g}n{rng.randrange(size)}", f"g{g}n{rng.randrange(size)}") for _ in range(rng.randrange(4))]
        edges += [(f"g{g}n{rng.randrange(size)}", f"g{rng.randrange(60)}n0") for _ in range(rng.randrange(2))]
    check(spark, edges)

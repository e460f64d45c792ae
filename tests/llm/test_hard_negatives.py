"""Hard negatives against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomgraph.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor, low=80, high=100):
    own = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        own[i] = (label, [math.floor(256 * float(np.float32(c))) for c in v])
    out = set()
    for a, (label, x) in own.items():
        if not is_anchor(a):
            continue
        score = {i: sum(p * q for p, q in zip(x, y, strict=True)) for i, (_, y) in own.items() if len(y) == len(x) and i != a}
        near = sorted((-s, i) for i, s in score.items() if own[i][0] == label)[:5]
        for p, positive in near:
            fit = sorted((-n, i) for i, n in score.items() if own[i][0] != label and low * -p <= 100 * n <= high * -p)[:5]
            out |= {(a, positive, k + 1, i, -p, -n) for k, (n, i) in enumerate(fit)}
    return out


def made(n, seed, size=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, size))
    rows = [(i, (centres[i % 4] + 0.7 * rng.normal(size=size)).tolist(), int(rng.integers(3))) for i in range(n)]
    rows += [(1000 + i, rows[5][1], i % 3) for i in range(40)]  # one vector many times: ties by id
    rows += [(2000, None, 1), (2001, [1.0] * size, None), (2002, [1.0, None] * (size // 2), 1), (2003, [float("nan")] * size, 1), (2004, [float("inf")] * size, 1), (None, [1.0] * size, 1)]
    rows += [(2100 + i, [0.0] * size, i % 2) for i in range(8)] + [(2200 + i, [0.5, -1.0 + i], i % 2) for i in range(30)] + [(2300 + i, [], i % 2) for i in range(8)]
    return rows


@pytest.mark.parametrize("values,group,tasks", [(1 << 20, 8, 3), (200, 5, 2), (64, 1, 1)])
def test_mining_equals_all_pairs(spark, values, group, tasks):
    rows = made(300, 3)
    docs = spark.createDataFrame(rows + rows[7:9], SCHEMA).withColumns({"x": F.lit("clash"), "size": F.lit(1), "windows": F.lit(2)}).repartition(4)
    s = hard_negatives.Settings(values=values, group=group, tasks=tasks)
    found = {tuple(r) for r in hard_negatives.mine(docs, is_anchor=F.col("vec_id") % 10 == 0, settings=s).collect()}
    assert found == brute(rows, lambda i: i % 10 == 0)
    assert any(p == 0 == n for *_, p, n in found)


def test_few_rows_and_empty_table(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [0.9, 2.0], 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in hard_negatives.mine(docs, is_anchor=F.col("vec_id") == 0).collect()} == brute(rows, lambda i: i == 0) != set()
    assert hard_negatives.mine(docs.limit(0), is_anchor=F.col("vec_id") == 0).count() == 0


def test_lists_leave_out_what_the_bound_covers():
    """No threshold is missed, entries are left out, and huge components are scored exactly."""
    rng, pick = np.random.default_rng(5), random.Random(2)
    x = (rng.normal(size=(500, 20)) * np.linspace(1, 60, 20)).astype(np.int32)
    labels = rng.integers(0, 3, 500)
    norms = np.sqrt((x.astype(float) ** 2).sum(1))
    for big in (1, 1 << 22):
        y = x * big
        index = hard_negatives.Index(np.arange(500), labels, y, 0.5 * float(norms.min()) * big, 4)
        assert len(index.lists[0]) < len(index.lists[-1]) <= 500
        exact = np.array([[sum(int(a) * int(b) for a, b in zip(p, q, strict=True)) for q in y] for p in y[:20]])
        for a in range(20):
            low = math.ceil(pick.choice([0.5, 0.6, 0.9]) * float(norms[a]) * float(norms.min()) * big * big)
            for same in (True, False):
                live, score = index.at_least(y[a], low, int(labels[a]), same)
                wanted = {i: int(s) for i, s in enumerate(exact[a]) if s >= low and (labels[i] == labels[a]) == same}
                assert dict(zip(index.ids[live].tolist(), score.tolist(), strict=True)) == wanted

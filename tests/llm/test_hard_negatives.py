"""Hard negatives against brute force, and the bounds of the R-tree."""

from __future__ import annotations

from math import floor

import numpy as np
import pytest

from feedlens.llm import hard_negatives
from feedlens.llm.hard_negatives import RTree, Search

SCHEMA = "vec_id long, embedding array<double>, label int"


def made(seed, n=500, d=6, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 1, (labels, d))
    out = []
    for i in range(n):
        c = int(rng.integers(labels))
        v = centre[c] * 0.5 + rng.normal(0, 1, d)
        out.append((i, [float(x) for x in (np.round(v) if i % 3 else v)], c))  # rounded ones tie
    return out


ODD = [
    (900, None, 1), (950, [1.0] * 6, None), (901, [float("nan")] + [1.0] * 5, 1), (1000, [float("inf")] + [1.0] * 5, 1), (902, [None] + [1.0] * 5, 1),
    (None, [1.0] * 6, 1), (1050, [], 1), (1051, [], 2), (1100, [2.0, 1.0], 1), (1101, [2.0, 1.5], 1), (1102, [2.0, 0.5], 3), (1150, [0.0] * 6, 2),
]


def brute(rows, anchors, scale=256, k=5, m=3, low=50, high=95):
    use = [(i, [floor(scale * x) if abs(x) < 2**53 else scale * int(x) for x in v], c) for i, v, c in rows if i is not None and v is not None and c is not None and None not in v and np.isfinite(v).all()]
    out = []
    for a, q, c in use:
        if not anchors(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, e) for i, v, e in use if i != a and len(v) == len(q))
        for s, p, _ in [x for x in scored if x[2] == c][:k]:
            fits = [x for x in scored if x[2] != c and low * -s <= 100 * -x[0] <= high * -s][:m]
            out += [(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed,part_rows", [(1, 16384), (2, 40)])
def test_equals_brute_force(spark, seed, part_rows):
    rows = made(seed) + ODD
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS part", "3 AS kind", "4 AS scores", "5 AS d", "6 AS v", "7 AS positive_score")
    got = hard_negatives.mine(df, df.where("vec_id % 50 = 0"), part_rows=part_rows)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 50 == 0)


def test_repeated_rows(spark):
    """Anchor rows are asked once; candidates are ranked each."""
    rows = made(4, n=60)
    df = spark.createDataFrame(rows + rows[:1] + rows[7:9], SCHEMA)
    got = sorted(map(tuple, hard_negatives.mine(df, df.where("vec_id = 0")).collect()))
    use = rows + rows[7:9]
    assert got == brute(use, lambda i: i == 0)


def test_scores_beyond_doubles(spark):
    """Whole numbers stay exact where doubles would not be."""
    rows = [(i, [float(2**20 + i * 1000), float(i - 3), 1e300 if i == 9 else 0.5], i % 2) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = hard_negatives.mine(df, df.where("vec_id % 4 = 0"), low=0, high=100).collect()
    want = brute(rows, lambda i: i % 4 == 0, low=0, high=100)
    assert sorted(map(tuple, got)) == want and max(r[4] for r in want) > 2**53


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame(made(5, n=30), SCHEMA)
    assert hard_negatives.mine(empty, empty).collect() == []
    assert hard_negatives.mine(some, some.where("false")).collect() == []
    assert hard_negatives.mine(empty, some).collect() == []


def test_boxes_bound_their_rows_and_prune():
    rng = np.random.default_rng(8)
    cells = np.floor(rng.normal(0, 1, (3000, 2)) * 256)
    tree = RTree(np.arange(3000), cells, leaf=16)
    query = np.array([300.0, -200.0])
    low, high = (x[0] for x in tree.intervals(query[None])[0])
    scores = tree.cells @ query
    for n in range(len(low)):
        own = scores[n * 16 : (n + 1) * 16]
        assert low[n] <= own.min() and own.max() <= high[n]
    search = Search(query[None], [tree])
    order = sorted(range(3000), key=lambda i: (-(cells[i] @ query), i))
    (best,) = search.best(0, order[1], 5, [(float("-inf"), float("inf"))])
    assert [i for _, i in best] == [i for i in order[:6] if i != order[1]]
    assert search.opened < len(low) / 4
    windows = [(1000, 20000), (15000, 40000), (3, 2)]
    for (a, b), found in zip(windows, search.best(0, -1, 3, windows)):
        assert [i for _, i in found] == [i for i in order if a <= cells[i] @ query <= b][:3]

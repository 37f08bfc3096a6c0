"""Embedding near-duplicates and top-k search against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from feedlens.llm import topk_search, vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "1 AS rep", "2 AS n", "3 AS v", "4 AS id", "5 AS `key`", "6 AS __id", "7 AS score") if extra else df


def made(seed: int, n: int = 400, d: int = 24):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        if out and rng.random() < 0.5:
            base = np.array(out[rng.integers(len(out))][1])
            v = base + rng.normal(0, rng.choice([0, 0.02, 0.05, 0.2]), d) * np.linalg.norm(base) / d**0.5
        else:
            v = rng.normal(0, 1, d)
        out.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    return out


ODD = [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("nan")] + [1.0] * 23, 1), (903, [float("inf")] + [1.0] * 23, 1), (904, [1.0] * 24, None), (905, [], 1), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1), (908, [1.0, None], 1)]


def brute_links(rows, threshold):
    use = {i: (np.array(v, np.float64), c) for i, v, c in rows if v and c is not None and None not in v and np.isfinite(v).all() and any(v)}
    parent = {i: i for i, *_ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    n = dict.fromkeys(parent, 0)
    ids = sorted(use)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            (x, c), (y, e) = use[a], use[b]
            if c == e and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                n[a] += 1
                n[b] += 1
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (n[i], find(i), find(i) == i) for i in parent}


@pytest.mark.parametrize("seed,chunk", [(1, 1024), (2, 8)])
def test_links(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(vector_dedup, "CHUNK", chunk)
    rows = made(seed) + ODD
    got = vector_dedup.link(vectors(spark, rows, extra=True)).collect()
    want = brute_links(rows, 0.98)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want
    assert sum(n > 0 for n, _, _ in want.values()) > 50


def test_copies_and_empty(spark):
    rows = [(i, [1.0, 2.0, 3.0], 4) for i in range(30)] + [(99, [2.0, 4.0, 6.0], 4)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.link(vectors(spark, rows)).collect()}
    assert got == {i: (30, 0, i == 0) for i in [*range(30), 99]}
    assert vector_dedup.link(vectors(spark, [])).count() == 0


def test_recall_of_the_tables():
    """Pairs exactly at the threshold are found with a probability above 0.99."""
    rng = np.random.default_rng(4)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=a.shape)
    b -= (b * a).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    b = 0.98 * a + (1 - 0.98**2) ** 0.5 * b
    keys = [vector_dedup._bucket_keys(x, np.zeros(2000, np.int64), vector_dedup.TABLES, vector_dedup.PROJECTIONS, vector_dedup.WIDTH, vector_dedup.SEED) for x in (a, b)]
    assert (keys[0] == keys[1]).any(1).mean() > 0.99


def brute_top(rows, queries, k):
    use = {i: [int(np.floor(1024 * float(x))) for x in v] for i, v, _ in rows if v is not None and None not in v and np.isfinite(v).all()}
    out = []
    for q in queries:
        if q in use:
            best = sorted((-sum(x * y for x, y in zip(use[q], v)), i) for i, v in use.items() if i != q and len(v) == len(use[q]))[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e5])
def test_top_k(spark, scale):
    rows = [(i, [float(np.float32(x * scale)) for x in v], c) for i, v, c in made(7)]
    rows += [(i, v, c) for i, v, c in ODD if i != 901]
    df = vectors(spark, rows, extra=True)
    got = topk_search.top_k(df, df.where("vec_id % 20 = 0")).collect()
    want = brute_top(rows, [i for i, *_ in rows if i % 20 == 0], 10)
    assert sorted(tuple(r) for r in got) == want
    parted = topk_search.top_k(df, df.where("vec_id % 20 = 0"), part_rows=30)
    assert sorted(tuple(r) for r in parted.collect()) == want


def test_top_k_is_dealt_over_parts(spark):
    """No join and no hash on the length, which all rows share."""
    df = vectors(spark, made(9, n=200))
    plan = topk_search.top_k(df, df.where("vec_id % 20 = 0"), part_rows=20)._jdf.queryExecution().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan and "hashpartitioning(d" not in plan


def test_ties_fall_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0], 1) for i in range(40)]
    df = vectors(spark, rows)
    got = topk_search.top_k(df, df.where("vec_id = 3"), k=4).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 0), (2, 1), (3, 2), (4, 4)]
    assert topk_search.top_k(vectors(spark, []), vectors(spark, [])).count() == 0


def test_the_walk_stops_early():
    """With a few dominant components the bound ends the walk long before the end."""
    rng = np.random.default_rng(3)
    cells = np.floor(rng.exponential(1, (4000, 8)) ** 4 * 1024)
    lists = topk_search.SortedLists(np.arange(4000), cells)
    query = np.floor(np.array([5, 1, 0, 0, 0, 0, 0, 0.0]) * 1024)
    ids, scores, met = lists.top(-1, query, 10)
    assert met < 1500
    best = np.lexsort((np.arange(4000), -(cells @ query)))[:10]
    assert sorted(ids.tolist()) == sorted(best.tolist())

"""Proportional stratified interleaving."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from feedlens.llm import sharding


def brute(rows, shards, seed=sharding.SEED):
    """rows: (doc_id, source) without repeats -> {doc_id: (shard, slot)}."""
    text = lambda x: "null" if x is None else str(x)
    of = defaultdict(list)
    for i, s in rows:
        of[s].append(i)
    order = []
    for s, ids in of.items():
        ids.sort(key=lambda i: (hashlib.md5(f"{seed}:{text(i)}".encode()).hexdigest(), i is not None, i or 0))
        order += [((2 * r + 1) / (2 * len(ids)), s is not None, s or "", r, i) for r, i in enumerate(ids)]
    out, taken = {}, Counter()
    for place, (*_, i) in enumerate(sorted(order)):
        shard = place * shards // len(rows)
        out[i] = (shard, taken[shard])
        taken[shard] += 1
    return out


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string")


@pytest.mark.parametrize("n,shards", [(0, 4), (1, 4), (37, 40), (1000, 7), (997, 40)])
def test_equals_brute_force(spark, n, shards):
    rows = [(i, [None, "hot", "hot", "hot", "b", "c", f"tail{i % 31}"][i % 7]) for i in range(n)]
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.assign(made(spark, rows), shards).collect()}
    assert got == brute(rows, shards)


def test_every_shard_has_the_mix(spark):
    rows = [(i, "abc"[0 if i % 10 < 6 else 1 if i % 10 < 9 else 2]) for i in range(4000)]
    got = sharding.assign(made(spark, rows), 8).groupBy("shard", "source").count().collect()
    want = {"a": 300, "b": 150, "c": 50}
    assert len(got) == 24 and all(abs(r["count"] - want[r["source"]]) <= 1 for r in got)


def test_repeated_rows_nulls_and_clashing_columns(spark):
    rows = [(None, None, 1)] * 300 + [(5, "s", 2)] * 300 + [(i, "s", 3) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, shard int").selectExpr("*", "'x' AS __by", "1 AS `__c0`", "2 AS `a.b`", "3 AS __many")
    one, two = (sharding.assign(df.repartition(k), 6) for k in (1, 5))
    assert one.columns == ["doc_id", "source", "__by", "__c0", "a.b", "__many", "shard", "slot", "fraction"]
    rows1, rows2 = (sorted(map(tuple, x.collect()), key=str) for x in (one, two))
    assert rows1 == rows2  # reruns agree, however the rows are read
    slots = defaultdict(list)
    for r in rows1:
        slots[r[6]].append(r[7])
    assert sorted(map(len, slots.values())) == [106, 106, 107, 107, 107, 107]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_no_source_is_ranked_in_one_task(spark):
    plan = sharding.assign(made(spark, [(1, "a")]), 4)._jdf.queryExecution().toString()
    assert "rangepartitioning(" in plan or "RDDScan" in plan or "Scan ExistingRDD" in plan
    assert "hashpartitioning(__c1" not in plan  # the source column


def test_written_shards(spark, tmp_path):
    rows = [(i, f"s{i % 3}", f"text {i}") for i in range(50)] + [(None, None, "n"), (None, None, None), (7, "s1", "again")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = sharding.write(docs, str(tmp_path / "shards"), 5)
    assert sorted(map(str, out.select("doc_id", "source", "text").collect())) == sorted(map(str, docs.collect()))
    by = out.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b"), F.count_distinct("slot").alias("d")).collect()
    assert sorted(r["n"] for r in by) == [10, 10, 11, 11, 11] and all((r["a"], r["b"], r["d"]) == (0, r["n"] - 1, r["n"]) for r in by)

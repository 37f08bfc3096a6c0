"""Exact top-k inner products by the threshold algorithm over sorted lists.

The candidates are dealt evenly over parts and packed into blocks there; a block
keeps, for each dimension, its rows in the order of that component.  A query walks the
lists of a block in parallel, from the end that its sign favours, to twice the
depth each round.  Rows met for the first time are scored exactly.  The walk
stops when the score that an unmet row could reach at best, the query's inner
product with the components at the present depth, lies below the kth score so
far.  Every part gets a copy of the queries, which it meets one Arrow batch after
another; the k best of each query and part are merged by a window with its own limit.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
K = 10
BLOCK_ROWS = 4096
#: Candidates that one task holds.
PART_ROWS = 4 * BLOCK_ROWS
FIRST_DEPTH = 64


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


class SortedLists:
    """A block of candidates with its rows sorted by each component."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray):
        by_id = np.argsort(ids, kind="stable")  # ties then fall to the smaller id
        self.ids, self.cells = ids[by_id], cells[by_id]
        self.lists = np.argsort(self.cells, axis=0, kind="stable")
        self.most = float(np.abs(self.cells).max(initial=0))

    def _exact(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells and query in a type whose inner products are exact."""
        bound = self.most * float(np.abs(query).max(initial=0)) * max(1, len(query))
        kind = np.float64 if bound < 2**53 else np.int64 if bound < 2**62 else object
        if kind is object:
            whole = np.frompyfunc(int, 1, 1)
            return whole(self.cells), whole(query)
        return (self.cells, query) if kind is np.float64 else (self.cells.astype(kind), query.astype(kind))

    def top(self, query_id: int, query: np.ndarray, k: int, depth: int = FIRST_DEPTH) -> tuple[np.ndarray, list[int], int]:
        """Ids and scores of the k best, and how many rows were scored."""
        cells, query = self._exact(query)
        n, met = len(self.ids), np.zeros(len(self.ids), bool)
        up, down = np.flatnonzero(query < 0), np.flatnonzero(query > 0)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, cells.dtype)
        while True:
            depth = min(depth, n)
            front = np.concatenate([self.lists[:depth, up].ravel(), self.lists[n - depth :, down].ravel()])
            now = met.copy()
            now[front] = True
            if depth == n or not len(up) + len(down):
                now[:] = True
            new = np.flatnonzero(now & ~met)
            met = now
            new = new[self.ids[new] != query_id]
            rows, scores = np.concatenate([rows, new]), np.concatenate([scores, cells[new] @ query])
            if len(rows) > k:  # keep the k best, ties to the smaller id
                best = np.lexsort((rows, -scores))[:k]
                rows, scores = rows[best], scores[best]
            if met.all():
                break
            bound = (cells[self.lists[depth - 1, up], up] * query[up]).sum() + (cells[self.lists[n - depth, down], down] * query[down]).sum()
            if len(rows) >= k and scores.min() > bound:
                break
            depth *= 2
        low, high = -(2**63), 2**63 - 1
        return self.ids[rows], [max(low, min(high, int(s))) for s in scores], int(met.sum())


def _by_length(batches: list[pa.RecordBatch], scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, ids, cells) of the rows of some batches."""
    for d in sorted({d for batch in batches for d in batch.column("d").to_pylist()}):
        some = [batch.filter(pa.array(batch.column("d").to_numpy() == d)) for batch in batches]
        ids = np.concatenate([x.column("id").to_numpy() for x in some])
        cells = np.concatenate([x.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64) for x in some])
        yield d, ids, np.floor(cells.reshape(len(ids), d) * scale)


def top_k(
    vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = SCALE, part_rows: int = PART_ROWS
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k highest inner
    products of every query with the vectors of other ids, ties to the smaller id.

    Components are ``floor(scale * x)`` in whole numbers; scores beyond 64 bits
    stop at the ends of long.  Vectors that are null or hold null or non-finite
    components, and null ids, take no part; vectors of another length than the
    query's are no candidates of it.  A query row that repeats is asked once;
    candidate rows that repeat are ranked each.  Other columns are ignored."""
    wanted = F.col("id").isNotNull() & usable(F.col("v"))
    pick = lambda df: df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(wanted).withColumn("d", F.size("v"))
    rows, asked = pick(vectors), pick(queries).dropDuplicates(["id", "v"])
    parts = max(vectors.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // part_rows))
    here = rows.withColumns({"part": F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"), "kind": F.lit(0)})
    there = asked.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), "kind": F.lit(1)})
    dealt = here.unionByName(there).repartitionById(parts, F.col("part")).sortWithinPartitions("kind")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        blocks: dict[int, list[SortedLists]] | None = None
        for batch in batches:
            split = int(np.searchsorted(batch.column("kind").to_numpy(), 1))
            if split:
                held.append(batch.slice(0, split))
            if split == batch.num_rows:
                continue
            if blocks is None:
                blocks = {d: [SortedLists(ids[a : a + BLOCK_ROWS], cells[a : a + BLOCK_ROWS]) for a in range(0, len(ids), BLOCK_ROWS)] for d, ids, cells in _by_length(held, scale)}
                held = []
            out: list[tuple] = []
            for d, ids, cells in _by_length([batch.slice(split)], scale):
                for q, query in zip(ids.tolist(), cells):
                    found = [(-s, i) for b in blocks.get(d, []) for i, s in zip(*(x.tolist() if isinstance(x, np.ndarray) else x for x in b.top(q, query, k)[:2]))]
                    out += [(q, i, -s) for s, i in heapq.nsmallest(k, found)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["query_id", "vec_id", "score"])

    # A stated query set against all rows, in blocks.
    met = dealt.mapInArrow(searched, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
) WHERE rank <= {K}
"""

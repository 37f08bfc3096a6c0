"""Hard negatives of anchors, mined with STR-packed R-trees.

An anchor's positives are the rows of its own label with the highest inner
products; its hard negatives for a positive are the best rows of other labels whose
score lies in a window below the positive's score.

Rows are dealt evenly over parts.  A task packs the rows of its part, label by
label, into R-trees by sort-tile-recursion: rows are cut into slabs by the component
that spreads most, each slab by the next one, until a tile fills a leaf; nodes are
the minimum bounding boxes of neighbouring tiles.  For an anchor a box gives an
interval of every component's product, and their sum an interval of the inner
product.  One queue over all trees of the part opens the box of the highest upper
bound first.  Boxes outside the score window are never queued, and the search ends
when the best box left lies strictly below the kth score, so ties still fall to the
smaller id.  Every anchor meets every part, a stated query set against all rows, and
the best of the parts are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.topk_search import usable
from feedlens.session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: Score window of a negative, in percent of the positive's score.
LOW, HIGH = 50, 95
PART_ROWS = 16384
LEAF = 128
FANOUT = 8
#: Anchors whose bounds are held at once.
ANCHORS = 256


def str_order(cells: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Rows in sort-tile-recursive order: consecutive ``leaf`` rows are a tile."""
    by_spread = np.argsort(-(cells.max(0) - cells.min(0)).astype(np.float64), kind="stable") if cells.size else np.zeros(0, int)
    done = []
    todo = [(np.arange(len(cells)), 0)]
    while todo:
        rows, k = todo.pop()
        tiles = -(-len(rows) // leaf)
        left = len(by_spread) - k
        if tiles <= 1 or not left:
            done.append(rows)
            continue
        rows = rows[np.argsort(cells[rows, by_spread[k]], kind="stable")]
        slabs = max(2, ceil(tiles ** (1 / left)))
        size = -(-tiles // slabs) * leaf  # whole tiles in every slab but the last
        todo += [(rows[a : a + size], k + 1) for a in reversed(range(0, len(rows), size))]
    return np.concatenate(done) if done else np.zeros(0, int)


class RTree:
    """Rows of one label and the boxes of its tiles, level by level from the tiles up."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        order = str_order(cells, leaf)
        self.ids, self.cells, self.leaf, self.fanout = ids[order], cells[order], leaf, fanout
        at = np.arange(0, len(order), leaf)
        self.levels = [(np.minimum.reduceat(self.cells, at), np.maximum.reduceat(self.cells, at))]
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            at = np.arange(0, len(low), fanout)
            self.levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    def intervals(self, queries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Least and greatest inner product that a box allows: (queries, boxes) for
        every level."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return [(up @ low.T + down @ high.T, up @ high.T + down @ low.T) for low, high in self.levels]


class Search:
    """Searches of several anchors over the trees of a part."""

    def __init__(self, queries: np.ndarray, trees: list[RTree]):
        self.queries, self.trees = queries, trees
        self.bounds = [t.intervals(queries) for t in trees]
        self.opened = 0

    def best(self, at: int, anchor_id: int, k: int, windows: list[tuple]) -> list[list[tuple[int, int]]]:
        """(-score, id) of the k best rows of each window (low, high) of scores, for
        the query at a place, in one walk; rows with the anchor's id are left out.

        The windows stay open as long as a box may hold a row for one of them: its
        interval meets the window and reaches the window's kth score."""
        query = self.queries[at]
        high = np.array([h for _, h in windows])
        least_wanted = np.array([low for low, _ in windows])  # rises to the kth score
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        queue: list[tuple] = []

        def enter(tree: int, level: int, first: int, stop: int) -> None:
            least, most = (x[at, first:stop] for x in self.bounds[tree][level])
            fits = ((most[:, None] >= least_wanted) & (least[:, None] <= high)).any(1)
            for n in np.flatnonzero(fits).tolist():
                heapq.heappush(queue, (-most[n], tree, level, first + n))

        for tree, t in enumerate(self.trees):
            enter(tree, len(t.levels) - 1, 0, 1)
        while queue:
            bound, tree, level, n = heapq.heappop(queue)
            if -bound < least_wanted.min():
                break
            t = self.trees[tree]
            if level:
                enter(tree, level - 1, n * t.fanout, (n + 1) * t.fanout)
                continue
            self.opened += 1
            rows = slice(n * t.leaf, (n + 1) * t.leaf)
            scores = t.cells[rows] @ query
            fits = (scores[:, None] >= least_wanted) & (scores[:, None] <= high)
            for w in np.flatnonzero(fits.any(0)).tolist():
                some = np.flatnonzero(fits[:, w])
                new = [(int(-s), i) for s, i in zip(scores[some], t.ids[rows][some].tolist()) if i != anchor_id]
                found[w] = heapq.nsmallest(k, found[w] + new)
                if len(found[w]) == k:
                    least_wanted[w] = max(least_wanted[w], -found[w][-1][0])
        return found


def _exact(cells: np.ndarray, queries: np.ndarray, scale: int) -> type:
    """A type in which all inner products and bounds are exact."""
    most = [float(np.abs(x).max(initial=0)) * scale + 1 for x in (cells, queries)]
    bound = most[0] * most[1] * max(1, cells.shape[1])
    return np.float64 if bound < 2**53 else np.int64 if bound < 2**62 else object


def _whole(cells: np.ndarray, scale: int, kind: type) -> np.ndarray:
    """``floor(scale * x)`` of every component."""
    if kind is object:
        return np.frompyfunc(lambda x: int(x) * scale if abs(x) > 2**53 else floor(x * scale), 1, 1)(cells)
    return np.floor(cells * scale).astype(kind)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), d)


def _long(x: int) -> int:
    return max(-(2**63), min(2**63 - 1, int(x)))


class _Part:
    """The trees of one part by length and label."""

    def __init__(self, rows: list[pa.RecordBatch], scale: int):
        self.scale = scale
        self.cells: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.trees: dict[tuple, dict[int, RTree]] = {}
        for d in sorted({d for batch in rows for d in batch.column("d").to_pylist()}):
            some = [batch.filter(pa.array(batch.column("d").to_numpy() == d)) for batch in rows]
            ids, labels = (np.concatenate([x.column(c).to_numpy() for x in some]) for c in ("id", "label"))
            self.cells[d] = (ids, labels, np.concatenate([_matrix(x.column("v"), d) for x in some]))

    def of(self, d: int, queries: np.ndarray) -> tuple[dict[int, RTree], np.ndarray]:
        """Trees by label and the queries in whole numbers, in a type that is exact
        for these queries."""
        if d not in self.cells:
            return {}, queries
        ids, labels, cells = self.cells[d]
        kind = _exact(cells, queries, self.scale)
        if (d, kind) not in self.trees:
            whole = _whole(cells, self.scale, kind)
            self.trees[d, kind] = {x: RTree(ids[labels == x], whole[labels == x]) for x in np.unique(labels).tolist()}
        return self.trees[d, kind], _whole(queries, self.scale, kind)


def _meet(rows: DataFrame, anchors: DataFrame, parts: int, scale: int, wanted, search, names: list[str]) -> DataFrame:
    """Every anchor in every part, after the part's rows; ``wanted`` tells whether trees
    of a label are searched for anchors of another one, ``search`` gives the values of
    ``names`` for an anchor (its searches, place, id and scores)."""
    nothing = [F.lit(None).cast("long").alias("anchor_key"), F.lit(None).cast("array<long>").alias("scores")]
    here = rows.select(F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("kind"), "id", "label", "d", "v", *nothing)
    there = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("kind"), "id", "label", "d", "v", "anchor_key", "scores")
    dealt = here.unionByName(there).repartitionById(parts, F.col("part")).sortWithinPartitions("kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = [], None
        for batch in batches:
            split = int(np.searchsorted(batch.column("kind").to_numpy(), 1))
            if split:
                held.append(batch.slice(0, split))
            asked = batch.slice(split)
            if not asked.num_rows:
                continue
            part = part or _Part(held, scale)
            lengths = asked.column("d").to_numpy()
            for d in np.unique(lengths).tolist():
                some = asked.filter(pa.array(lengths == d))
                trees, queries = part.of(d, _matrix(some.column("v"), d))
                out: list[tuple] = []
                ids, keys, labels, scores = (some.column(c).to_pylist() for c in ("id", "anchor_key", "label", "scores"))
                for label in set(labels):
                    here = [at for at, x in enumerate(labels) if x == label]
                    for start in range(0, len(here), ANCHORS):
                        at = here[start : start + ANCHORS]
                        searches = Search(queries[at], [t for x, t in trees.items() if wanted(x, label)])
                        for n, j in enumerate(at):
                            out += [(ids[j], keys[j], *x) for x in search(searches, n, ids[j], scores[j])]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["anchor_id", "anchor_key", *names])

    return dealt.mapInArrow(run, ", ".join(f"{n} long" for n in ("anchor_id", "anchor_key", *names)))


def mine(
    vectors: DataFrame,
    anchors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``: for every anchor and each of its
    ``positives`` best other rows of its label, the ``negatives`` best rows of
    another label with low * positive <= 100 * negative <= high * positive.

    Scores are inner products of ``floor(scale * x)`` in whole numbers (beyond 64
    bits they stop at the ends of long); ties fall to the smaller id.  Rows with a
    null id, a null label, a null vector or a null or non-finite component take no
    part; rows of another length are no candidates of an anchor.  Anchor rows that
    repeat are asked once; candidates that repeat are ranked each.  A positive
    without negatives in its window gives no rows, nor does an empty table.  Other
    columns are ignored."""

    def pick(df: DataFrame) -> DataFrame:
        some = df.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
        return some.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"))).withColumn("d", F.size("v"))

    def own(searches: Search, at: int, i: int, scores: None) -> Iterator[tuple]:
        (found,) = searches.best(at, i, positives, [(float("-inf"), float("inf"))])
        return ((j, _long(-s)) for s, j in found)

    def other(searches: Search, at: int, i: int, scores: list[int]) -> Iterator[tuple]:
        windows = [(-(-low * p // 100), high * p // 100) for p in scores]
        for p, found in zip(scores, searches.best(at, i, negatives, windows)):
            yield from ((p, j, _long(-s)) for s, j in found)

    rows = pick(vectors)
    parts = max(vectors.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // part_rows))
    asked = pick(anchors).dropDuplicates(["id", "label", "v"])
    asked = materialize(asked.withColumn("anchor_key", F.xxhash64("label", "v")))
    of_anchor = ["anchor_id", "anchor_key"]

    found = _meet(rows, asked.withColumn("scores", F.lit(None).cast("array<long>")), parts, scale, int.__eq__, own, ["positive_id", "positive_score"])
    best = F.row_number().over(Window.partitionBy(*of_anchor).orderBy(F.col("positive_score").desc(), "positive_id"))
    found = materialize(found.withColumn("place", best).where(F.col("place") <= positives).drop("place"))

    windows = found.groupBy(F.col("anchor_id").alias("id"), "anchor_key").agg(F.collect_set("positive_score").alias("scores"))
    met = _meet(rows, asked.join(windows, ["id", "anchor_key"]), parts, scale, int.__ne__, other, ["positive_score", "negative_id", "negative_score"])
    best = F.row_number().over(Window.partitionBy(*of_anchor, "positive_score").orderBy(F.col("negative_score").desc(), "negative_id"))
    met = met.withColumn("rank", best).where(F.col("rank") <= negatives)
    return found.join(met, [*of_anchor, "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""

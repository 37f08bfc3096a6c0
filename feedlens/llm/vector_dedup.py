"""Embedding near-duplicates by p-stable hashing for Euclidean distance.

Vectors are normalised and projected on random Gaussian directions; the
quantised projections of one table form a bucket key.  Two unit vectors of
cosine 0.98 are 0.2 apart; with the default width they agree in one projection
with probability 0.87, in one table with 0.33 and in one of the tables with
0.997.  Within a bucket all pairs are checked exactly.

Equal vectors are first joined into one class, so a very common vector is one
row.  Buckets of one class are dropped before vectors move; large buckets are
dealt into chunks and every pair of chunks is a group of its own.  Pairs are
counted within the group, once, in the first table where they meet; only counts
and the edges of a spanning forest leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.frames import sorted_groups
from feedlens.llm.graph import components
from feedlens.session import materialize

THRESHOLD = 0.98
TABLES = 14
PROJECTIONS = 8
WIDTH = 1.25
CHUNK = 1024
SEED = 7


def usable(vector: Column) -> Column:
    """Whether a vector is there, finite in every component and not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    v = np.stack([np.frombuffer(x, np.float64) for x in rows.column("v").to_pylist()])
    return v / np.sqrt((v * v).sum(1))[:, None]


def _bucket_keys(unit: np.ndarray, labels: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """64-bit bucket keys, one row per vector and one column per table."""
    d = unit.shape[1]
    rng = np.random.default_rng([seed, d])
    cells = np.floor((unit @ rng.standard_normal((d, tables * projections)) + rng.uniform(0, width, tables * projections)) / width)
    odd = np.random.default_rng([seed, 1]).integers(1, 1 << 62, projections, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    with np.errstate(over="ignore"):
        keys = (cells.astype(np.int64).astype(np.uint64).reshape(len(unit), tables, projections) * odd).sum(2, dtype=np.uint64)
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + (np.arange(tables, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(d))
        keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + labels.astype(np.uint64)[:, None]
        keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (keys ^ (keys >> np.uint64(31))).view(np.int64)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index reachable from each of n nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _group_links(rows: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, added link counts and a forest edge of the linked vectors of a group."""
    ids, many = rows.column("rep").to_numpy(), rows.column("n").to_numpy()
    side, key, at = rows.column("side").to_numpy(), rows.column("key").to_numpy(), int(rows.column("table")[0].as_py())
    keys = np.stack([np.frombuffer(x, np.int64) for x in rows.column("keys").to_pylist()])
    unit = _unit(rows)
    firsts, seconds = [], []
    for start in range(0, len(ids), 512):
        x = np.arange(start, min(start + 512, len(ids)))
        near = unit[x] @ unit.T >= threshold
        # A pair stands once: lower row first within a chunk, chunk 0 before chunk 1.
        near &= np.where(side[x, None] == side[None, :], (side[x, None] == 2) & (x[:, None] < np.arange(len(ids))), side[x, None] < side[None, :])
        a, b = np.nonzero(near)
        a = x[a]
        met = (key[a] == key[b]) & ~(keys[a, :at] == keys[b, :at]).any(1)
        firsts.append(a[met])
        seconds.append(b[met])
    a, b = np.concatenate(firsts), np.concatenate(seconds)
    links = np.bincount(a, many[b], len(ids)) + np.bincount(b, many[a], len(ids))
    some = np.flatnonzero(links)
    return ids[some], links[some].astype(np.int64), ids[_forest(len(ids), a, b)[some]]


def link(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    seed: int = SEED,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other vectors of equal label
    whose cosine is at least ``threshold``), ``component_id`` (least id reachable
    by links, its own included) and ``kept`` (it has that id).

    Vectors that are null, empty, zero or hold null or non-finite components, and
    vectors with a null label or id, link with nothing.  Vectors of different
    length link with nothing.  Rows that repeat an id are vectors of their own
    with one component.  Other columns are ignored."""
    rows = vectors.select(F.col(vec_id).alias("__id"), F.col(vector).cast("array<double>").alias("__v"), F.col(label).alias("__label"))
    rows = rows.withColumn("__in", usable(F.col("__v")) & F.col("__label").isNotNull() & F.col("__id").isNotNull())
    one, two = F.xxhash64("__label", "__v"), F.xxhash64(F.lit(seed), "__v", "__label")
    rows = rows.withColumns({"__h1": F.when(F.col("__in"), one), "__h2": F.when(F.col("__in"), two)})

    classes = rows.where("__in").groupBy("__h1", "__h2").agg(F.min("__id").alias("rep"), F.count("*").alias("n"), F.min_by(F.struct("__v", "__label"), "__id").alias("__x"))
    classes = classes.select("__h1", "__h2", F.col("rep").cast("long"), "n", F.col("__x.__v").alias("v"), F.xxhash64("__x.__label").alias("label"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.asarray(x, np.float64) for x in batch.column("v").to_pylist()]
            keys: list = [None] * len(lists)
            sizes = np.array([len(x) for x in lists])
            labels = batch.column("label").to_numpy()
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                v = np.stack([lists[i] for i in at])
                v = v / np.abs(v).max(1)[:, None]
                for i, k in zip(at, _bucket_keys(v / np.sqrt((v * v).sum(1))[:, None], labels[at], tables, projections, width, seed)):
                    keys[i] = k.tobytes()
            scaled = [(x / np.abs(x).max()).tobytes() for x in lists]
            out = [batch.column(c) for c in ("__h1", "__h2", "rep", "n")]
            yield pa.RecordBatch.from_arrays([*out, pa.array(scaled, pa.binary()), pa.array(keys, pa.binary())], names=["__h1", "__h2", "rep", "n", "v", "keys"])

    classes = materialize(classes.mapInArrow(hashed, "__h1 long, __h2 long, rep long, n long, v binary, keys binary"))

    def unfolded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps = np.repeat(batch.column("rep").to_numpy(), tables)
            keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(keys), pa.array(np.tile(np.arange(tables, dtype=np.int32), batch.num_rows))], names=["rep", "key", "table"])

    buckets = classes.select("rep", "keys").mapInArrow(unfolded, "rep long, key long, table int")
    shared = buckets.groupBy("key").count().where("count > 1")
    shared = shared.select("key", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    placed = buckets.join(shared, "key").withColumn("chunk", F.pmod(F.xxhash64("rep", F.lit(seed)), "chunks").cast("int"))
    # Chunk pairs (low, high): a chunk meets itself (side 2), those before and those after it.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda c: F.struct(
            F.least(c, "chunk").alias("low"),
            F.greatest(c, "chunk").alias("high"),
            F.when(c == F.col("chunk"), 2).when(c > F.col("chunk"), 0).otherwise(1).alias("side"),
        ),
    )
    placed = placed.select("rep", "key", "table", F.inline(pairs))
    placed = placed.select("rep", "key", "table", "side", F.xxhash64("key", "low", "high").alias("group"))
    groups = placed.join(classes.select("rep", "n", "v", "keys"), "rep")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "group"):
            if group.num_rows > 1:
                ids, links, to = _group_links(group, threshold)
                if len(ids):
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(to)], names=["rep", "links", "to"])

    found = groups.repartition("group").sortWithinPartitions("group").mapInArrow(linked, "rep long, links long, to long")
    found = materialize(found)
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = components(found, "rep", "to")

    done = classes.select("__h1", "__h2", "rep", "n").join(counts, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    done = done.select("__h1", "__h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.select("__id", "__h1", "__h2").join(done, ["__h1", "__h2"], "left")
    component = F.coalesce("component_id", F.col("__id").cast("long"))
    return out.select(
        F.col("__id").alias(vec_id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("__id"), F.lit(False)).alias("kept"),
    )


ORACLE = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), parts AS (
  SELECT a, min(b) AS low FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN parts ON parts.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""

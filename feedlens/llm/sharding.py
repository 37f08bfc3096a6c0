"""Proportional stratified interleaving of rows into shards.

The rows of each source are put into a seeded random order and ranked.  A row's
fractional rank is its place in its source between 0 and 1; all rows are sorted
by it, which spreads every source evenly over the whole order, and the order is
cut into shards of equal counts.  So every shard holds each source in proportion,
at most one or two rows off.

No source is ranked in one task.  Both orders are range partitioned, a large
source over many partitions; a row's rank is its place within its partition plus
the counts of the partitions before, and the counts (a few rows for each
partition and source) are all that a window sums up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.frames import numbered
from feedlens.session import materialize, shared_path

SHARDS = 40
SEED = 20

#: Bits that ``monotonically_increasing_id`` keeps for the place in a partition.
_PLACE_BITS = 33


def _placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The rows over range partitions in the given order, with their partition and
    their place in it (``__part``, ``__at``); written, so both stay as they are."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__at", at)
    return materialize(ordered.withColumn("__part", F.shiftright("__at", _PLACE_BITS)))


def _ranked(rows: DataFrame, order: list[Column], by: Column | None) -> DataFrame:
    """``__rank`` (from 0, within ``by`` if it is given, which must lead the order) and
    ``__many``, the number of rows that are ranked together."""
    placed = _placed(rows.withColumn("__by", F.lit(0) if by is None else by), order)
    parts = placed.groupBy("__by", "__part").agg(F.min("__at").alias("__least"), F.count("*").alias("__count"))
    together = Window.partitionBy("__by")
    before = together.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("__by").alias("__by2"), F.col("__part").alias("__part2"), "__least", F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__before"), F.sum("__count").over(together).alias("__many")
    )
    met = placed.join(parts, F.col("__part").eqNullSafe(F.col("__part2")) & F.col("__by").eqNullSafe(F.col("__by2")))
    rank = F.col("__before") + F.col("__at") - F.col("__least")
    return met.withColumn("__rank", rank).drop("__at", "__part", "__by", "__part2", "__by2", "__least", "__before")


def assign(rows: DataFrame, n_shards: int = SHARDS, key: tuple[str, ...] = ("doc_id",), source: str = "source", seed: int = SEED, names: tuple[str, str, str] = ("shard", "slot", "fraction")) -> DataFrame:
    """All rows and columns with three more: the shard, the row's slot in it (both
    from 0, slots without gaps) and its fractional rank.

    Shards differ by one row at the most; with fewer rows than shards some are
    empty, and an empty table gives no rows.  The order within a source is that of
    md5(seed:key) of the first key column, ties by the further ones; rows that agree in
    all key columns take neighbouring places in any order, so pass enough of them
    to name a row.  Null sources are a source of their own, null keys are equal
    keys.  Texts take no part: pass the columns that are wanted, for all of them
    are shuffled twice.  Columns that have one of the three names are left out."""
    if n_shards < 1:
        raise ValueError("at least one shard")
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in names])
    body, at = numbered(rows)
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(at[key[0]]).cast("string"), F.lit("null"))).cast("binary"))
    # Rows alike in all of these are told apart by where they were read.
    body = body.withColumns({"__shuffled": shuffled, "__row": F.monotonically_increasing_id()})
    of_source = F.col(at[source])
    order = [of_source, F.col("__shuffled"), *[F.col(at[k]) for k in key], F.col("__row")]
    body = _ranked(body, order, of_source).drop("__shuffled", "__row")
    body = body.withColumn("__fraction", (2 * F.col("__rank") + 1) / (2 * F.col("__many"))).withColumnRenamed("__rank", "__in_source").drop("__many")
    body = _ranked(body, [F.col("__fraction"), of_source, F.col("__in_source")], None)
    shard = F.expr(f"__rank * {n_shards} div __many")
    first = F.expr(f"(__shard * __many + {n_shards - 1}) div {n_shards}")
    body = body.withColumn("__shard", shard).withColumn("__slot", F.col("__rank") - first)
    back = [F.col(at[c]).alias(c) for c in rows.columns]
    return body.select(*back, F.col("__shard").cast("int").alias(names[0]), F.col("__slot").alias(names[1]), F.col("__fraction").alias(names[2]))


def write(docs: DataFrame, path: str, n_shards: int = SHARDS, key: tuple[str, ...] = ("doc_id",), source: str = "source", seed: int = SEED) -> DataFrame:
    """Writes whole rows as Parquet, one folder for each shard, and returns them
    reread.  Rows join their shard by (key, source), so these name a row, nulls
    included; where they repeat, rows that share them get each other's slots."""
    docs, where = docs.drop("shard", "slot", "fraction"), docs.select(*key, source)
    twin = lambda df: df.withColumn("__twin", F.row_number().over(Window.partitionBy(*key, source).orderBy(F.lit(0))))
    slots = twin(assign(where, n_shards, key, source, seed)).select(*[F.col(c).alias(f"__{i}") for i, c in enumerate((*key, source))], F.col("__twin").alias("__twin2"), "shard", "slot")
    on = F.col("__twin") == F.col("__twin2")
    for i, c in enumerate((*key, source)):
        on &= F.col(c).eqNullSafe(F.col(f"__{i}"))
    wanted = docs.columns
    full = twin(docs).join(slots, on).select(*wanted, "shard", "slot")
    full.repartition(n_shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)


def temporary_path(docs: DataFrame, name: str) -> str:
    """A folder for shards under the shared folder of the session."""
    return shared_path(docs.sparkSession, name)


#: CRC-32 by half bytes; its table of 16 follows from the reversed polynomial.
_CRC32 = """
  list_reduce(
    list_concat([4294967295], list_transform(range(0, length(digits)),
      lambda i: instr('123456789ABCDEF', substr(digits, (i + 2 - 2 * (i % 2))::INTEGER, 1))::BIGINT)),
    lambda c, b: xor(c >> 4, t[(xor(c, b) & 15) + 1]))
"""

ORACLE = f"""
WITH crc_table AS (
  SELECT list_transform(range(0, 16), lambda i: list_reduce([i, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), docs AS (
  SELECT doc_id, source, length(digits) // 2 + 16 AS size, xor({_CRC32}, 4294967295) AS text_crc32
  FROM (SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS digits FROM documents), crc_table
), in_source AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), doc_id NULLS FIRST, text_crc32, size) - 1 AS r,
    count(*) OVER (PARTITION BY source) AS n FROM docs
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r + 1)::DOUBLE / (2 * n), source NULLS FIRST, r) - 1 AS place, count(*) OVER () AS many FROM in_source
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (place * {SHARDS} // many)::INTEGER AS shard,
  (place - (place * {SHARDS} // many * many + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""

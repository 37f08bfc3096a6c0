"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is dealt into blocks by a hash of the document id.  A source's
target is met by whole passes over its blocks and one partial pass: permuted
blocks up to the target, the last one cut at a document, that one at a word.
The exact numbers of blocks a source gives to the mix are then split among the
output shards: each node of a binary tree over the shards draws how many blocks
of every source go to its left half (multivariate hypergeometric, drawn source by
source by inverting the distribution function), down to one quota per source and
shard.  Every shard takes its quota as the next run of the source's permuted
blocks, so the shards are disjoint, and shuffles locally by a hashed key.

Only the tables of sources, blocks (``BLOCKS`` a source) and tree nodes are
ordered whole; documents are ranked only within the one cut block of a source.
All draws are hashes of the seed, so reruns agree.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from feedlens.llm.frames import GAP, numbered, word_count
from feedlens.session import materialize

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
#: Blocks a source is dealt into (16^3: three hexadecimal digits of a hash).
BLOCK_DIGITS = 3
SHARD_LEVELS = 4
SEED = "mix-1"

_HEX = 16.0**12


def _hash(seed: str, *parts: Column) -> Column:
    """Hexadecimal digest of the seed and parts."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def _uniform(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / _HEX


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Targets of sources (``__src``, ``__words``): shares of all words by weight.

    Weights repeat along the sources in code point order, null last.  No target
    passes ``max_repeat`` times its source; the excess is shared by weight among
    the others until none is above.  Sources enter the cap in the order of cap by
    weight, so the final level is the largest level met on the way."""
    every = Window.partitionBy(F.lit(1))
    order = every.orderBy(F.col("__src").asc_nulls_last())
    out = sizes.withColumn("__i", F.row_number().over(order) - 1)
    out = out.withColumn("__w", F.element_at(F.array(*map(F.lit, weights)), (F.col("__i") % len(weights) + 1).cast("int")))
    out = out.withColumn("__cap", F.col("__words") * max_repeat)
    before = every.orderBy(F.col("__cap") / F.col("__w"), "__i").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    level = (F.sum("__words").over(every) - F.coalesce(F.sum("__cap").over(before), zero)) / (
        F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(before), zero)
    )
    out = out.withColumn("__level", level)
    out = out.withColumn("__level", F.max("__level").over(every))
    return out.select(
        "__src", "__words", "__i", F.least(F.col("__cap").cast("double"), F.col("__level") * F.col("__w")).cast("double").alias("__target")
    )


def _log_factorial(n: Column) -> Column:
    n = n.cast("double")
    series = n * F.log(n) - n + 0.5 * F.log(2 * 3.141592653589793 * n) + 1 / (12 * n) - 1 / (360 * n**3) + 1 / (1260 * n**5)
    return F.when(n < 2, F.lit(0.0)).otherwise(series)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(u: Column, good: Column, total: Column, draws: Column) -> Column:
    """The number of good items among ``draws`` of ``total``, at quantile ``u``.

    The distribution function is summed over the counts within nine standard
    deviations of the mode and twenty more; what lies beyond is nil in doubles."""

    def log_weight(k: Column, s: Column) -> Column:
        return -(_log_factorial(k) + _log_factorial(s["good"] - k) + _log_factorial(s["draws"] - k) + _log_factorial(s["total"] - s["good"] - s["draws"] + k))

    low, high = F.greatest(F.lit(0).cast("long"), draws - total + good), F.least(good, draws)
    mode = F.greatest(low, F.least(high, F.floor((draws + 1) * (good + 1) / (total + 2))))
    share = good / F.greatest(total, F.lit(1))
    spread = F.ceil(9 * F.sqrt(draws * share * (1 - share) * (total - draws) / F.greatest(total - 1, F.lit(1)))) + 20
    setting = F.struct(
        good.alias("good"),
        total.alias("total"),
        draws.alias("draws"),
        mode.alias("mode"),
        F.greatest(low, mode - spread).alias("low"),
        F.least(high, mode + spread).alias("high"),
    )

    def quantile(s: Column, weights: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("below"), (F.aggregate(weights, F.lit(0.0), lambda x, w: x + w) * u).alias("to"))
        step = lambda x, w: F.struct(
            (x["sum"] + w).alias("sum"), (x["below"] + F.when(x["sum"] + w <= x["to"], 1).otherwise(0)).alias("below"), x["to"].alias("to")
        )
        return F.least(s["high"], s["low"] + F.aggregate(weights, start, step, lambda x: x["below"]))

    def drawn(s: Column) -> Column:
        weights = _bound(log_weight(s["mode"], s), lambda top: F.transform(F.sequence(s["low"], s["high"]), lambda k: F.exp(log_weight(k, s) - top)))
        return _bound(weights, lambda w: quantile(s, w))

    return _bound(setting, drawn)


def _left_quotas(quotas: Column, seed: str, node: Column) -> Column:
    """How many blocks of each source go to the left half of a node."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda s, q: s + q)
    start = F.struct(
        total.alias("left_in"), F.floor((total + 1) / 2).cast("long").alias("draws"), F.array().cast("array<long>").alias("out")
    )

    def step(s: Column, q: Column) -> Column:
        got = hypergeometric(_uniform(_hash(seed, node, F.size(s["out"]))), q, s["left_in"], s["draws"])
        return _bound(
            got, lambda g: F.struct((s["left_in"] - q).alias("left_in"), (s["draws"] - g).alias("draws"), F.concat(s["out"], F.array(g)).alias("out"))
        )

    return F.aggregate(quotas, start, step, lambda s: s["out"])


def splitting_tree(quotas: DataFrame, levels: int = SHARD_LEVELS, seed: str = SEED) -> DataFrame:
    """Quotas (``__i``, ``__quota``) split among 2^levels shards: ``__i``, ``__ends``
    with the last rank of each shard in the source's permuted blocks."""
    nodes = quotas.agg(F.transform(F.sort_array(F.collect_list(F.struct("__i", "__quota"))), lambda x: x["__quota"]).alias("__q"))
    nodes = nodes.select(F.lit(1).alias("__node"), F.coalesce("__q", F.array().cast("array<long>")).alias("__q"))
    for _ in range(levels):
        # Written at every level (a row for each node), so that the plan holds one level's draws only.
        nodes = materialize(nodes.withColumn("__left", _left_quotas(F.col("__q"), seed, F.col("__node"))))
        nodes = nodes.select(
            F.inline(
                F.array(
                    F.struct((F.col("__node") * 2).alias("__node"), F.col("__left").alias("__q")),
                    F.struct((F.col("__node") * 2 + 1).alias("__node"), F.zip_with("__q", "__left", lambda q, x: q - x).alias("__q")),
                )
            )
        )
    leaves = nodes.select((F.col("__node") - 2**levels).alias("__shard"), F.posexplode("__q").alias("__i", "__quota"))
    ends = Window.partitionBy("__i").orderBy("__shard")
    leaves = leaves.withColumn("__end", F.sum("__quota").over(ends))
    return leaves.groupBy("__i").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("__shard", "__end"))), lambda x: x["__end"]).alias("__ends")
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    levels: int = SHARD_LEVELS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target``,
    ``taken`` and ``draws``, an array of (pass, words, shard, shuffle_key).

    A draw gives the document's first ``words`` words to a shard of the mix;
    shards are written in the order of ``shuffle_key``.  ``size`` counts the
    words of the text, 0 for null.  A null source is a source of its own, last in
    order.  Rows that repeat a doc_id are documents of their own; a null doc_id
    is an id like any other.  An empty table gives no rows.  Other columns are
    ignored.  A source without words has the target 0 and no draws."""
    sized = docs.select(F.col(doc_id).alias("__doc"), F.col(source).alias("__src"), word_count(F.col(text)).alias("__size"))
    return _mixed(sized, [], doc_id, weights, max_repeat, levels, seed)


def _mixed(sized: DataFrame, key: list[str], doc_id: str, weights: tuple[int, ...], max_repeat: int, levels: int, seed: str) -> DataFrame:
    """The mix of rows (``__doc``, ``__src``, ``__size``); columns ``key`` tell rows
    with the same id apart, spread those without an id over the blocks, and are passed on."""
    digest = _hash(seed, F.col("__doc"))
    if key:
        digest = F.when(F.col("__doc").isNull(), _hash(seed, F.col("__doc"), *map(F.col, key))).otherwise(digest)
    sized = materialize(sized.withColumns({"__h": digest, "__block": F.substring(digest, 1, BLOCK_DIGITS)}))

    blocks = sized.groupBy("__src", "__block").agg(F.sum("__size").alias("__in"))
    blocks = materialize(blocks)
    goal = targets(blocks.groupBy("__src").agg(F.sum("__in").alias("__words")), weights, max_repeat)
    goal = goal.withColumn("__full", F.when(F.col("__words") > 0, F.floor(F.col("__target") / F.col("__words"))).otherwise(0).cast("long"))
    goal = goal.withColumn("__part", F.round(F.col("__target") - F.col("__full") * F.col("__words")).cast("long"))

    permuted = Window.partitionBy("__i").orderBy(_hash(seed, F.lit("block"), F.col("__block")), "__block")
    plan = blocks.join(goal, blocks["__src"].eqNullSafe(goal["__src"])).drop(goal["__src"])
    plan = plan.withColumn("__before", F.sum("__in").over(permuted) - F.col("__in"))
    plan = plan.withColumn("__partial", F.greatest(F.lit(0), F.least(F.col("__in"), F.col("__part") - F.col("__before"))))
    plan = materialize(plan)  # a row for each block: read for the units and for the draws

    # Whole and cut blocks as units of the mix: one for each pass that draws from a block.
    passes = F.sequence(F.lit(1), F.col("__full") + F.when(F.col("__partial") > 0, 1).otherwise(0))
    units = plan.where((F.col("__in") > 0) & ((F.col("__full") > 0) | (F.col("__partial") > 0)))
    units = units.select("__i", "__block", F.explode(passes).alias("__pass"))
    dealt = Window.partitionBy("__i").orderBy(_hash(seed, F.lit("unit"), F.col("__block"), F.col("__pass")), "__block", "__pass")
    units = units.withColumn("__rank", F.row_number().over(dealt))
    return _draws(sized, plan, _shards(units, levels, seed), seed, doc_id, key)


def _shards(units: DataFrame, levels: int, seed: str) -> DataFrame:
    """The shard of every unit, as an array by pass for each source and block."""
    ranked = units.groupBy("__i").agg(F.count("*").alias("__quota"))
    ranked = ranked.withColumn("__k", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("__i")) - 1)
    ends = splitting_tree(ranked.select(F.col("__k").alias("__i"), "__quota"), levels, seed).withColumnRenamed("__i", "__k")
    ends = ranked.join(ends, "__k").select("__i", "__ends")
    shard = F.size(F.filter("__ends", lambda e: e < F.col("__rank")))
    placed = units.join(ends, "__i").select("__i", "__block", F.struct("__pass", shard.alias("shard")).alias("__at"))
    return placed.groupBy("__i", "__block").agg(F.sort_array(F.collect_list("__at")).alias("__units"))


def _draws(sized: DataFrame, plan: DataFrame, shards: DataFrame, seed: str, doc_id: str, key: list[str]) -> DataFrame:
    plan = materialize(plan.join(shards, ["__i", "__block"], "left")).withColumnsRenamed({"__src": "__from", "__block": "__of"})
    rows = sized.join(plan, sized["__src"].eqNullSafe(plan["__from"]) & (sized["__block"] == plan["__of"]))
    # Only the one cut block of a source needs its documents in order.
    cut = (F.col("__partial") > 0) & (F.col("__partial") < F.col("__in"))
    inner = Window.partitionBy("__i", "__block").orderBy("__h", "__size", "__doc", *key)
    whole = rows.where(~cut).withColumn("__got", F.when(F.col("__partial") > 0, F.col("__size")).otherwise(F.lit(0).cast("long")))
    ranked = rows.where(cut).withColumn("__got", F.sum("__size").over(inner) - F.col("__size"))
    ranked = ranked.withColumn("__got", F.greatest(F.lit(0), F.least(F.col("__size"), F.col("__partial") - F.col("__got"))))
    rows = whole.unionByName(ranked)
    drawn = F.transform(
        F.coalesce("__units", F.array().cast("array<struct<__pass:long,shard:int>>")),
        lambda x: F.struct(
            x["__pass"].alias("pass"),
            F.when(x["__pass"] <= F.col("__full"), F.col("__size")).otherwise(F.col("__got")).alias("words"),
            x["shard"].alias("shard"),
            _hash(seed, F.lit("shuffle"), F.col("__doc"), *map(F.col, key), x["__pass"]).alias("shuffle_key"),
        ),
    )
    return rows.select(
        F.col("__doc").alias(doc_id),
        F.col("__size").alias("size"),
        F.col("__words").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__full") * F.col("__size") + F.col("__got")).cast("long").alias("taken"),
        F.filter(drawn, lambda x: x["words"] > 0).alias("draws"),
        *key,
    )


def _fingerprint(rows: DataFrame, seed: int) -> Column:
    """Hash of all columns of a row; nulls count by their places."""
    values = [F.col(f.name) if isinstance(f.dataType, AtomicType) else F.to_json(F.struct(f.name)) for f in rows.schema.fields]
    return F.xxhash64(F.lit(seed), *values, *[F.col(c).isNull() for c in rows.columns])


def draw(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    levels: int = SHARD_LEVELS,
    seed: str = SEED,
) -> DataFrame:
    """The mix itself: a row with the columns of ``docs`` for every draw, in
    shards that are shuffled within.

    A document drawn in part is cut after its last word that is taken, its words
    then joined by one space.  Documents that the mix does not take, those without
    words among them, are left out.  Rows that repeat a doc_id, or have none, are
    drawn each by its own text and source; rows equal in all columns are copies,
    drawn each on its own."""
    base, names = numbered(docs)
    base = base.withColumns({"__k1": _fingerprint(base, 1), "__k2": _fingerprint(base, 2)})
    sized = base.select(
        "__k1", "__k2", F.col(names[doc_id]).alias("__doc"), F.col(names[source]).alias("__src"), word_count(F.col(names[text])).alias("__size")
    )
    # Equal rows are counted, not numbered, so that many of them are no hot key.
    copies = sized.groupBy(*sized.columns).agg(F.count("*").alias("__many"))
    copies = copies.select(*sized.columns, F.explode(F.sequence(F.lit(1).cast("long"), "__many")).alias("__copy"))
    drawn = _mixed(copies, ["__k1", "__k2", "__copy"], "__doc", weights, max_repeat, levels, seed)
    drawn = drawn.select("__k1", "__k2", F.col("size").alias("__size"), F.explode("draws").alias("__draw"))
    rows = base.dropDuplicates(["__k1", "__k2"]).join(drawn, ["__k1", "__k2"])
    whole = F.col(names[text])
    spaced = F.split(F.trim(F.regexp_replace(whole, GAP, " ")), " ")
    cut = F.array_join(F.slice(spaced, F.lit(1), F.col("__draw.words").cast("int")), " ")
    rows = rows.withColumn(names[text], F.when(F.col("__draw.words") < F.col("__size"), cut).otherwise(whole))
    key = F.col("__draw.shuffle_key")
    rows = rows.repartition(F.col("__draw.shard"), F.substring(key, 1, 2)).sortWithinPartitions(F.col("__draw.shard"), key)
    return rows.select(*names.values()).toDF(*names)


#: The words taken do not depend on the shards, so SQL can tell them: whole
#: passes, whole permuted blocks, and the documents of the cut block in order.
ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM documents
), sources AS (
  SELECT source, sum(size) AS words, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS i FROM sized GROUP BY source
), weighed AS (
  SELECT *, [{", ".join(map(str, WEIGHTS))}][(i % {len(WEIGHTS)} + 1)::INT] AS w, {MAX_REPEAT} * words AS cap FROM sources
), levels AS (
  SELECT *, (sum(words) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
  SELECT source, i, words::BIGINT AS words, least(cap::DOUBLE, (max(level) OVER ()) * w)::DOUBLE AS target FROM levels
), passes AS (
  SELECT *, CASE WHEN words > 0 THEN floor(target / words)::BIGINT ELSE 0 END AS full_passes FROM goals
), parts AS (
  SELECT *, round(target - full_passes * words)::BIGINT AS part FROM passes
), blocks AS (
  SELECT source, substr(h, 1, {BLOCK_DIGITS}) AS block, sum(size) AS words FROM sized GROUP BY ALL
), placed AS (
  SELECT b.source, b.block, p.i, p.words AS source_size, p.target, p.full_passes, p.part,
         sum(b.words) OVER (PARTITION BY p.i ORDER BY md5('{SEED}:block:' || b.block), b.block) - b.words AS before
  FROM blocks b JOIN parts p ON b.source IS NOT DISTINCT FROM p.source
), ranked AS (
  SELECT s.doc_id, s.size, p.*, sum(s.size) OVER (PARTITION BY p.i, p.block ORDER BY s.h, s.size, s.doc_id ROWS UNBOUNDED PRECEDING) - s.size AS ahead
  FROM sized s JOIN placed p ON s.source IS NOT DISTINCT FROM p.source AND substr(s.h, 1, {BLOCK_DIGITS}) = p.block
)
SELECT doc_id, size, source_size, target,
       (full_passes * size + greatest(0, least(size, part - before - ahead)))::BIGINT AS taken
FROM ranked
"""

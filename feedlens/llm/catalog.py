"""Queries of this subpackage and, where SQL can express them, their oracles.

Every query reads its whole table.  The operators keep general interfaces; a
query only adds production parameters and the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import (
    hard_negatives,
    jaccard_join,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    sharding,
    substring_dedup,
    topk_search,
    toxicity,
    vector_dedup,
)
from feedlens.llm.frames import GAP, lean_batches, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without cross-site boilerplate lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = line_dedup.remove_boilerplate(docs)
    return found.select("doc_id", "text", "n_lines", "n_removed")


ORACLES["op6_line_dedup"] = line_dedup.ORACLE


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op3_mix_sources"] = mixing.ORACLE


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return license_scan.summary(license_scan.scan(table(spark, sf_dir, "documents")))


@query
def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth embedding."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, vectors.where("vec_id % 100 = 0"))


ORACLES["op2_topk_search"] = topk_search.ORACLE


@query
def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return vector_dedup.link(table(spark, sf_dir, "embeddings"))


ORACLES["op7_vector_dedup"] = vector_dedup.ORACLE


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 4-word shingles at 85 percent."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document as repeats of 20-word windows."""
    found = substring_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.train(docs.where("NOT held_out"))
    return language_id.predict(docs, model).select("doc_id", "held_out", "lang_pred", "score")


#: Categories in the order of the chain, by conditions on ``labels``.
TOXICITY = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), TOXICITY)
    return toxicity.predict(docs, chain).select("doc_id", "toxic", "toxic_score", "low_quality_score")


def periodic_tail(doc_id: Column, text: Column) -> Column:
    """The text of every tenth document with a periodic tail: from some word on, the
    next few words are repeated to the end.  Other texts stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    n = F.size(words)
    start = (g % n).cast("int")
    period = (F.lit(1) + F.floor((n - start) / (F.lit(3) + g % 8))).cast("int")
    copies = F.ceil((n - start) / period).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, start + 1, period), copies)), F.lit(1), n - start)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), start), tail), " ")
    return F.when(F.coalesce((h % 10 == 0) & (n > 0), F.lit(False)), changed).otherwise(text)


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of them with a periodic tail."""
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic_tail(F.col("doc_id"), F.col("text")).alias("text"))
    lean_batches(spark)
    found = periodic_runs.find_runs(docs, keep=["doc_id"])
    # The greatest length; ties: the least start, then the least period.
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        (-best["less"]).alias("length"),
        best["period"].alias("period"),
        F.floor(F.lit(-1000) * best["less"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; every shard has the table's mix of sources."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    found = sharding.assign(docs, key=("doc_id", "text_crc32", "size"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


ORACLES["op12_shard_documents"] = sharding.ORACLE


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding; every seventh has a shifted label."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives.mine(vectors, vectors.where("vec_id % 50 = 0"))


ORACLES["op13_hard_negatives"] = hard_negatives.ORACLE

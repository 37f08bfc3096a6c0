"""Corpus pipeline: documents to packed training sequences.

``run(spark, sf_dir)`` applies ``STAGES`` in order; each stage's result is
written as Parquet to the shared checkpoint folder and read again as the next
stage's documents, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import jaccard_join, language_id, line_dedup, mixing, packing
from feedlens.llm.catalog import tokenizer_path
from feedlens.session import shared_path

#: Documents whose language is less sure than this are rejected.
MIN_LANGUAGE_SCORE = 0.5


#: Rows of an Arrow batch: texts are long, and a batch is held by Spark and by the Python worker.
BATCH_ROWS = 2000


def _lean_batches(spark: SparkSession) -> None:
    """Sets the session's batches of rows for Python to ``BATCH_ROWS`` where they are larger."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter or of no certain language.

    The model learns from the labelled documents that are not held out; without
    any it knows no language, and then nothing is rejected but texts that are null
    or have no letter."""
    _lean_batches(spark)
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language_id.predict(docs, model, lang_pred="__lang_pred", score="__score")
    return judged.where((F.col("__lang_pred") != language_id.UNKNOWN) & (F.col("__score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes cross-site boilerplate lines out of the texts."""
    return _recounted(line_dedup.remove_boilerplate(docs, counts=("__n_lines", "__n_removed")).select(*docs.columns))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every near-duplicate group, the one of least id: sets of
    5-word shingles linked at a Jaccard similarity of 0.8.

    Rows that repeat an id are one document, of which one row stays.  A row without an
    id is named by its text, after all ids, so it stays only if its group has no id."""
    _lean_batches(spark)
    by_text = F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(1 << 62))
    named = docs.withColumn("__name", F.coalesce(F.col("doc_id").cast("long"), by_text))
    found = jaccard_join.join(named.select("__name", "text"), doc_id="__name", k=5, percent=80)
    copies = found.where("__name <> component_id").select("__name").distinct()
    repeated = named.groupBy("__name").count().where("count > 1").select("__name")
    kept = named.join(copies, "__name", "left_anti")
    once = kept.join(repeated, "__name", "left_anti")
    again = kept.join(repeated, "__name", "left_semi").dropDuplicates(["__name"])
    return once.unionByName(again).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the mix of sources; a document drawn more than once is repeated."""
    return _recounted(mixing.draw(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs every document that is left; the result is one row per piece."""
    _lean_batches(spark)
    return packing.pack(docs, tokenizer_path(), keep_parts=False)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", dedup_documents),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL cannot express the trained language model, the tokenizer and the draws.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{uuid.uuid4().hex}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

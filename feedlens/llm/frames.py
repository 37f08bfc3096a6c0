"""Small helpers shared by the operators of this subpackage.

Tables are read through Spark only, working columns carry a leading underscore
so that extra input columns with clashing names do no harm, and grouped Python
work streams over sorted partitions, one group at a time.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.session import shared_path

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with columns renamed by position, and the new name of each, so
    that working columns cannot clash; ``toDF(*df.columns)`` names them back."""
    names = {c: f"__c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z; other letters may be lowered too, but never to ASCII ones.

    Only two characters have a lower case with an ASCII letter (U+0130, U+212A);
    texts with one of them take the slower way."""
    odd = F.contains(text, F.lit("\u0130")) | F.contains(text, F.lit("\u212a"))
    return F.when(odd, F.translate(text, _UPPER, _UPPER.lower())).otherwise(F.lower(text))


def word_count(text: Column) -> Column:
    """Number of words (runs without ASCII white space); null counts 0."""
    spaced = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " "))
    gaps = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
    return F.when(spaced == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def binary_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null becomes the empty text."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``most`` at the most."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(batch: pa.RecordBatch, column: str, most: int, raw: bool = False) -> Iterator[tuple[int, int, list]]:
    """Index ranges of a batch whose texts have about ``most`` characters together at
    the most (``raw``: bytes), and these texts; null becomes the empty text.  Only one
    range's texts are Python objects at a time."""
    texts = batch.column(column).cast(pa.binary() if raw else pa.string())
    sizes = (pc.binary_length if raw else pc.utf8_length)(texts).fill_null(0).to_pylist()
    for a, b in slices(sizes, most):
        yield a, b, [t or (b"" if raw else "") for t in texts.slice(a, b - a).to_pylist()]


#: Rows of an Arrow batch where texts are long: Spark and the Python worker both hold it.
BATCH_ROWS = 2000


def lean_batches(spark: SparkSession) -> None:
    """Sets the session's batches of rows for Python to ``BATCH_ROWS`` where they are larger."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


class Scratch:
    """Tables in the session's shared folder that cut lineage like a checkpoint, but
    take less room and are deleted when a step needs them no more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base = spark, shared_path(spark, f"scratch-{uuid.uuid4().hex}")

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self.base}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names or ("",):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}".rstrip("/"))
            path.getFileSystem(conf).delete(path, True)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` whose Python workers, which Spark keeps for later tasks of other
    stages, give back the memory of a partition when it ends."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return df.mapInArrow(lean, schema)


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by ``key``, one at a time."""
    held: list[pa.Table] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        keys = rows.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != held_key:
                yield pa.concat_tables(held)
                held = []
            held.append(rows.slice(a, b - a))
            held_key = keys[a]
    if held:
        yield pa.concat_tables(held)

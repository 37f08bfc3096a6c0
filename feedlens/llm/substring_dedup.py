"""Substring dedup by relative Lempel-Ziv parsing.

The reference is the corpus itself, as far as it has been read: the index holds,
for every ``window`` consecutive words, the first place (document, word) where
they stand, in blocks by hash.  A document is factored greedily against every
block: a factor begins at a word whose window has a place before its own and is
drawn out word by word as long as the next window has one; other words are
literals.  The window that straddles the end of a factor is looked up like any
other, so copies that meet or overlap make one span and nothing is lost at the
boundaries.  Factors are at least one window long and become duplicate spans.

Windows need not all travel.  Of the ``ANCHOR`` consecutive words within a window
the one run with the least hash is its anchor; equal windows have equal anchors.
Only windows whose anchor stands at two places or more can repeat, and only those
enter the index.  Anchors are counted by aggregation; the first place of a
window is a minimum, taken map-side first, so a passage that many documents
share is never gathered.  What comes back to a document are the windows that it
is the first to hold, a list bounded by its own length.  A document whose whole
text stands under a smaller id is one factor at once and enters no index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.frames import binary_texts, slices
from feedlens.llm.wordhash import text_windows, window_hashes, words
from feedlens.session import materialize

WINDOW = 20
ANCHOR = 4
_BATCH_BYTES = 2 << 20


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    done, out = 1, values
    while done * 2 <= width:
        out = np.minimum(out[: len(out) - done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _anchors(hashes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of each window of several texts, and where each text's windows begin."""
    k = min(ANCHOR, window)
    grams = window_hashes(hashes, k, seed=1)
    counts = np.maximum(np.diff(first) - window + 1, 0)
    at = np.concatenate([[0], np.cumsum(counts)])
    if not at[-1]:
        return np.zeros(0, np.uint64), at
    every = _least(grams, window - k + 1)
    return every[np.repeat(first[:-1] - at[:-1], counts) + np.arange(at[-1])], at


def _anchor_runs(docs: DataFrame, window: int) -> DataFrame:
    """Runs of windows with one anchor: ``anchor``, ``doc``, ``at``, ``n`` windows.

    ``weight`` is 2 for a run whose words may hold the anchor twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = min(ANCHOR, window)
        for batch in batches:
            ids, texts = batch.column("__doc").to_numpy(), binary_texts(batch, "__text")
            for a, b in slices([len(t) for t in texts], _BATCH_BYTES):
                _, _, _, hashes, first = words(texts[a:b])
                anchors, at = _anchors(hashes, first, window)
                if not len(anchors):
                    continue
                new = np.ones(len(anchors), bool)
                new[1:] = anchors[1:] != anchors[:-1]
                new[at[:-1][np.diff(at) > 0]] = True
                starts = np.flatnonzero(new)
                n = np.diff(np.append(starts, len(anchors)))
                doc = np.searchsorted(at, starts, side="right") - 1
                grams = window_hashes(hashes, k, seed=1)
                twice = np.zeros(len(grams) + 1, np.int64)
                for lag in range(1, min(window - k + 1, len(grams))):
                    twice[1 : len(grams) - lag + 1] |= grams[lag:] == grams[:-lag]
                twice = np.cumsum(twice)
                begin = starts - at[doc] + first[doc]
                end = np.minimum(begin + n + window - k, len(grams))
                weight = 1 + (((twice[end] - twice[begin]) > 0) | (n > window - k + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (anchors[starts].view(np.int64), ids[a:b][doc], (starts - at[doc]).astype(np.int32), n.astype(np.int32), weight.astype(np.int32))],
                    names=["anchor", "doc", "at", "n", "weight"],
                )

    return docs.mapInArrow(run, "anchor long, doc long, at int, n int, weight int")


def _starts(column: pa.Array, sizes: pa.Array | None = None) -> list[np.ndarray]:
    """Word positions of each row of a list column; with ``sizes``, a list of run
    lengths beside it, the positions of all windows of the runs."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    at = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if sizes is not None:
        n = sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        done = np.cumsum(n)
        at = np.repeat(at - done + n, n) + np.arange(done[-1] if len(done) else 0)
        ends = np.concatenate([[0], done])[ends]
    return np.split(at, ends[:-1])


def _index(docs: DataFrame, window: int) -> DataFrame:
    """The first place (``doc``, ``at``) of each window that is in the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, ranges = batch.column("__doc").to_numpy(), binary_texts(batch, "__text"), _starts(batch.column("at"), batch.column("n"))
            for a, b in slices([len(t) for t in texts], _BATCH_BYTES):
                _, _, _, hashes, first = words(texts[a:b])
                one, at = text_windows(hashes, first, window, seed=2)
                two, _ = text_windows(hashes, first, window, seed=3)
                where = [p[p < at[i + 1] - at[i]] for i, p in enumerate(ranges[a:b])]
                sizes = [len(p) for p in where]
                flat = np.concatenate(where)
                pick = flat + np.repeat(at[:-1], sizes)
                key, check = one[pick].view(np.int64), (two[pick] >> np.uint64(33)).astype(np.int32)
                doc = np.repeat(ids[a:b], sizes)
                # The first place within the slice stands for the others.
                order = np.lexsort((flat, doc, check, key))
                new = np.ones(len(order), bool)
                new[1:] = (key[order[1:]] != key[order[:-1]]) | (check[order[1:]] != check[order[:-1]])
                first_here = np.sort(order[new])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[first_here]) for x in (key, check, doc, flat.astype(np.int32))], names=["key", "check", "doc", "at"]
                )

    places = docs.mapInArrow(run, "key long, check int, doc long, at int")
    # Slices have taken their minima; rows travel in the order of documents, which compresses well.
    places = places.repartition("key").groupBy("key", "check").agg(F.min(F.struct("doc", "at")).alias("first"))
    return places.select("first.doc", "first.at")


def spans(n_words: int, window: int, inside: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Factors of a document, as rows of (first word, number of words).

    ``inside``: windows that are in the index, ``firsts``: those whose first
    place is here.  Windows that follow one another make one factor."""
    known = np.zeros(max(0, n_words - window + 1), bool)
    known[inside[inside < len(known)]] = True
    known[firsts[firsts < len(known)]] = False
    step = np.diff(np.concatenate([[0], known.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    return np.stack([starts, ends - starts + window - 1], 1)


def _copies(named: DataFrame) -> DataFrame:
    """Ids (``doc``) whose whole text is that of a smaller id: one factor each.

    Ids that stand with several texts are no copies."""
    hashed = named.select("__doc", F.xxhash64("__text").alias("h1"), F.xxhash64(F.lit(1), F.col("__text")).alias("h2"))
    texts = hashed.groupBy("__doc").agg(*[f(h).alias(f"{f.__name__}_{h}") for h in ("h1", "h2") for f in (F.min, F.max)])
    texts = texts.where("min_h1 = max_h1 AND min_h2 = max_h2").select(F.col("__doc").alias("doc"), F.col("min_h1").alias("h1"), F.col("min_h2").alias("h2"))
    first = texts.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.count("*").alias("many")).where("many > 1")
    # Written first, so that the texts' side of the join can be split where one text stands very often.
    return texts.join(materialize(first), ["h1", "h2"]).where("doc <> first").select("doc")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``spans`` (the duplicate
    factors as (start, length) in words), ``n_removed`` and ``kept``, the words
    outside the spans joined by one space.

    A word is removed if a window of ``window`` words that covers it also starts
    earlier: in a document of smaller id, or before in the same one.  Words end
    at ASCII white space and are compared unchanged.  A null text has no words
    and an empty ``kept``.  Documents with a null id are left whole and are no
    reference.  doc_id names one text: rows that repeat it count as one place, so
    of such rows a window stays if any of them is the first to hold it.  Other
    columns are ignored."""
    rows = docs.select(F.col(doc_id).cast("long").alias("__doc"), F.col(text).cast("string").alias("__text"))
    named = rows.where("__doc IS NOT NULL")
    runs = _anchor_runs(named, window)
    shared = runs.groupBy("anchor").agg(F.sum("weight").alias("places")).where("places > 1").select("anchor")
    ranges = runs.join(shared, "anchor", "left_semi").groupBy("doc").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n"))
    copies = materialize(_copies(named))
    ranges = materialize(ranges.join(copies, "doc", "left_anti"))
    firsts = _index(named.join(ranges, named["__doc"] == ranges["doc"]).select("__doc", "__text", "at", "n"), window)
    firsts = firsts.groupBy("doc").agg(F.collect_list("at").alias("firsts"))
    found = ranges.join(firsts, "doc", "left").withColumn("copy", F.lit(False))
    found = found.unionByName(copies.withColumn("copy", F.lit(True)), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, copied, out = binary_texts(batch, "__text"), batch.column("copy").to_pylist(), ([], [], [], [])
            inside, first_here = _starts(batch.column("at"), batch.column("n")), _starts(batch.column("firsts"))
            for text, copy, known, own in zip(texts, copied, inside, first_here):
                parts = text.split()
                cut = np.array([[0, len(parts)]] if copy and len(parts) >= window else [], np.int64).reshape(-1, 2) if copy else spans(len(parts), window, known, own)
                keep = np.ones(len(parts), bool)
                for start, n in cut.tolist():
                    keep[start : start + n] = False
                if len(cut):
                    parts = [w for w, k in zip(parts, keep.tolist()) if k]
                for column, value in zip(out, (len(keep), cut.tolist(), int((~keep).sum()), b" ".join(parts))):
                    column.append(value)
            n, cuts, removed, kept = out
            pairs = pa.array([[{"start": s, "length": m} for s, m in c] for c in cuts], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__doc"), pa.array(n, pa.int64()), pairs, pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=[doc_id, "n_words", "spans", "n_removed", "kept"],
            )

    # The texts meet both lists by one and the same exchange.
    joined = named.join(found, named["__doc"] == found["doc"], "left").select("__doc", "__text", "at", "n", "firsts", "copy")
    joined = joined.unionByName(rows.where("__doc IS NULL"), allowMissingColumns=True)
    return joined.mapInArrow(run, f"`{doc_id}` long, n_words long, spans array<struct<start:long,length:long>>, n_removed long, kept string")

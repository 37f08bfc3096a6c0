"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams.

Texts are lower-cased, runs of other characters than letters become one space,
and n-grams of 1 to 3 characters are hashed to ``DIMS`` features.  A feature's
value is its share of the text's n-grams times its inverse document frequency,
which is counted over all training texts.  The weights are fitted by
follow-the-regularised-leader with elastic net on a bounded sample of labelled
texts, and calibrated by a temperature on a part of the sample kept out.  The
sample is thinner for common languages; the logarithm of a language's share is
taken from its bias, so the probabilities are those of all labelled texts.

Only the sums over the corpus (``DIMS`` counts, one count per language) and the
model reach the driver; the sample is fitted in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.frames import map_batches, text_slices
from feedlens.llm.letters import codes
from feedlens.llm.linear import ftrl, scores, softmax, temperature
from feedlens.llm.wordhash import mix

BITS = 16
DIMS = 1 << BITS
ORDERS = (1, 2, 3)
#: Training texts of one language, at about the most.
MAX_PER_LANGUAGE = 2000
SCALE = 30.0
#: Characters of texts that are taken apart together; their arrays take about 85 times as many bytes.
SLICE_CHARS = 1 << 18
UNKNOWN = "und"
SEED = 5

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # (DIMS + 1, languages), the inverse document frequency multiplied in; the last row is the bias
    temperature: float


def ngrams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Features of the n-grams of several texts: for each order the features by
    first character, -1 where an n-gram would pass the end of its text; where each
    text begins; and whether it has a letter."""
    data, letter, begins = codes(texts)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other character after a letter becomes the space
    kept = np.where(letter, data, 32)[keep].astype(np.uint64)
    before = np.concatenate([[0], np.cumsum(keep)])
    at = before[begins]
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    out = []
    for n in ORDERS:
        features = np.full(len(kept), -1, np.int64)
        m = len(kept) - n + 1
        if m > 0:
            with np.errstate(over="ignore"):
                h = np.full(m, n, np.uint64)
                for j in range(n):
                    h += (kept[j : j + m] + np.uint64(1)) * _ODD[j]
            inside = owner[:m] == owner[n - 1 :]
            features[:m][inside] = (mix(h) >> np.uint64(64 - BITS)).astype(np.int64)[inside]
        out.append(features)
    return out, at, np.diff(at) > 0


def _counts(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and counts of each text."""
    features, at, _ = ngrams(texts)
    out = []
    for a, b in zip(at, at[1:]):
        every = np.concatenate([f[a:b] for f in features])
        count = np.bincount(every[every >= 0], minlength=DIMS)
        some = np.flatnonzero(count)
        out.append((some.astype(np.int32), count[some].astype(np.int32)))
    return out


def _batches(batches: Iterator[pa.RecordBatch], most: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        for a, b, texts in text_slices(batch, "__text", most):
            yield batch.slice(a, b - a), texts


def _document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(DIMS + 1, np.int64), np.zeros(DIMS, bool)
        for _, texts in _batches(batches):
            features, at, _ = ngrams(texts)
            for a, b in zip(at, at[1:]):
                seen[:] = False
                for f in features:
                    x = f[a:b]
                    seen[x[x >= 0]] = True
                total[:DIMS] += seen
                total[DIMS] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["feature", "n"])

    rows = map_batches(docs.select("__text"), run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(DIMS + 1, np.int64)
    out[rows["feature"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out[:DIMS], int(out[DIMS])


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", max_per_language: int = MAX_PER_LANGUAGE) -> LanguageModel:
    """Fits a model to the rows whose text and language are not null.

    The sample takes every row of a language with a probability that makes about
    ``max_per_language`` expected rows, by a hash of ``key``.  Without any
    labelled row the model knows no language."""
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = rows.select(F.col(text).cast("string").alias("__text"), F.col(lang).cast("string").alias("__lang"), F.xxhash64(F.lit(SEED), key).alias("__key"))
    counted = {r["__lang"]: r["count"] for r in rows.groupBy("__lang").count().collect()}
    languages = sorted(counted)
    if not languages:
        return LanguageModel([], np.zeros((DIMS + 1, 0), np.float32), 1.0)
    frequency, total = _document_frequencies(rows)
    idf = np.log((1 + total) / (1 + frequency)) + 1
    index = {x: i for i, x in enumerate(languages)}

    shares = [min(1.0, max_per_language / counted[k]) for k in languages]
    share = F.create_map(*[F.lit(x) for kv in zip(languages, shares) for x in kv])
    uniform = F.shiftrightunsigned("__key", 11) / float(1 << 53)
    sample = rows.where(uniform < F.element_at(share, F.col("__lang")))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(batches):
            at, count = zip(*_counts(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__key"), batch.column("__lang"), pa.array([x.tobytes() for x in at], pa.binary()), pa.array([x.tobytes() for x in count], pa.binary())],
                names=["key", "lang", "at", "count"],
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples, held = [], []
        for batch in batches:
            for row in batch.to_pylist():
                at, count = np.frombuffer(row["at"], np.int32), np.frombuffer(row["count"], np.int32)
                if len(at):
                    x = SCALE * count / count.sum() * idf[at]
                    one = (np.append(at, DIMS), np.append(x, 1.0), index[row["lang"]])
                    (held if row["key"] % 5 == 0 else samples).append(one)
        weights = ftrl(samples, DIMS + 1, len(languages))
        t = temperature(scores(held, weights), np.array([y for _, _, y in held], np.int64))
        weights[:DIMS] *= SCALE * idf[:, None]
        weights[DIMS] -= t * np.log(shares)  # predictions divide by t
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float32).tobytes()], pa.binary()), pa.array([t])], names=["weights", "temperature"])

    sampled = map_batches(sample, features, "key long, lang string, at binary, count binary")
    fitted = map_batches(sampled.repartition(1).sortWithinPartitions("key", "lang", "at"), fit, "weights binary, temperature double").collect()
    weights = np.frombuffer(fitted[0]["weights"], np.float32).reshape(DIMS + 1, len(languages))
    return LanguageModel(languages, weights, fitted[0]["temperature"])


def predict_texts(model: LanguageModel, texts: list[str]) -> list[tuple[str, float]]:
    """Language and calibrated probability of each text."""
    if not model.languages:
        return [(UNKNOWN, 0.0)] * len(texts)
    features, at, some = ngrams(texts)
    sums = np.zeros((len(texts), len(model.languages)))
    grams = np.zeros(len(texts), np.int64)
    where = np.flatnonzero(some)
    if len(where):
        for f in features:
            inside = f >= 0
            rows = model.weights[f] * inside[:, None]
            sums[where] += np.add.reduceat(rows, at[where], axis=0, dtype=np.float64)
            grams[where] += np.add.reduceat(inside, at[where], dtype=np.int64)
    p = softmax((sums / np.maximum(grams, 1)[:, None] + model.weights[DIMS]) / model.temperature)
    best = p.argmax(1)
    return [(model.languages[b], float(p[i, b])) if some[i] else (UNKNOWN, 0.0) for i, b in enumerate(best)]


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns and rows of ``docs`` with the predicted language and its
    calibrated probability (0 to 1).

    A text that is null or has no letter is ``und`` with the score 0, as is every
    text if the model knows no language.  Columns named like the two new ones are
    replaced."""
    kept = [c for c in docs.columns if c not in (lang_pred, score)]
    fields = {f.name: f for f in docs.schema.fields}
    schema = type(docs.schema)([fields[c] for c in kept]).add(lang_pred, "string").add(score, "double")
    most = max(1 << 16, min(SLICE_CHARS, (1 << 20) // max(1, len(model.languages))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, float]] = []
            for _, _, texts in text_slices(batch, text, most):
                found += predict_texts(model, texts)
            names, p = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(p, pa.float64())], names=[*kept, lang_pred, score])

    return map_batches(docs.select(*kept), run, schema)


def held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    """Whether a document is kept from training: crc32 of its id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))

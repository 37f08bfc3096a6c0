"""Toxicity by classifier chains.

The categories are judged one after another: a later model sees, besides the
text, the probabilities that the earlier ones gave.  For training these are
out-of-fold predictions, so a later model learns from probabilities as good or
bad as those it will meet.  Each model is a linear one on hashed words and word
beginnings, fitted by follow-the-regularised-leader with elastic net on a
bounded sample of labelled documents.  Common combinations of categories are
sampled more thinly; a row's loss counts for the rows it stands for, so the
probabilities are those of all labelled rows whatever the size of the sample.

Every category takes one job: the fit on the whole sample and those without a fold
are tasks of their own.  The margins of the rows left out calibrate the category's
probabilities and feed the next one.  The driver gets the weights, and the keys,
labels and margins of the sample, which its parameter bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.frames import map_batches, text_slices
from feedlens.llm.letters import codes
from feedlens.llm.linear import ftrl, scores, softmax
from feedlens.llm.wordhash import span_hashes
from feedlens.session import materialize

BITS = 18
DIMS = 1 << BITS
#: Letters of a word's beginning that make a feature, besides the whole word.
BEGINNINGS = (3, 4, 5)
FOLDS = 3
#: Labelled documents in the sample, at about the most, for each combination of categories.
MAX_PER_CLASS = 3000
#: Probability from which a category is predicted, and exceptions by name: a toxic
#: document that is missed weighs as much as three that are flagged without reason.
THRESHOLD = 0.5
THRESHOLDS = {"toxic": 0.25}
#: Characters of texts that are taken apart together.
SLICE_CHARS = 1 << 18
#: Fitting: steps, elastic net and passes over the sample.
FIT = {"alpha": 0.5, "l1": 3.0, "l2": 0.01, "epochs": 8}
SEED = 9


@dataclass
class Chain:
    categories: list[str]
    #: For each category the weights of no and yes: features, one row per earlier category, bias.
    weights: list[np.ndarray]


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature indexes and values (log of 1 + count) of each text."""
    data, letter, begins = codes(texts)
    step = np.diff(np.concatenate([[0], letter.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    hashed = [span_hashes(data, starts, ends)]
    for n in BEGINNINGS:
        h = span_hashes(data, starts, np.minimum(starts + n, ends)) ^ np.uint64(0x5BD1E995)
        hashed.append(np.where(ends - starts > n, h, hashed[0]))
    rows = (np.stack(hashed, 1) >> np.uint64(64 - BITS)).astype(np.int64)
    at = np.searchsorted(starts, begins)
    out = []
    for a, b in zip(at, at[1:]):
        some, count = np.unique(rows[a:b], return_counts=True)
        out.append((some, np.log1p(count)))
    return out


def _inputs(at: np.ndarray, x: np.ndarray, earlier: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Features of a link of the chain: the text, earlier probabilities, a bias."""
    size = float(np.sqrt((x * x).sum())) or 1.0
    more = np.arange(DIMS, DIMS + len(earlier) + 1)
    return np.concatenate([at, more]), np.concatenate([x / size**0.4, earlier, [1.0]])


Texts = list[tuple[np.ndarray, np.ndarray]]
#: Fits one category, given its number and the earlier probabilities (sample, categories
#: before): weights on the whole sample, and for every row the margin (logit of yes) of
#: the fit without the row's fold.
FitParts = Callable[[int, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _fit_part(texts: Texts, y: np.ndarray, earlier: np.ndarray, folds: np.ndarray, counts: np.ndarray, part: int, fit: dict) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the fit without fold ``part`` (all rows if there is no such fold), and
    the margins of the rows left out."""
    samples = [(*_inputs(at, x, e.tolist()), int(c)) for (at, x), e, c in zip(texts, earlier, y)]
    chosen, out = np.flatnonzero(folds != part), np.flatnonzero(folds == part)
    weights = ftrl([samples[i] for i in chosen], DIMS + earlier.shape[1] + 1, 2, counts=counts[chosen], **fit)
    z = scores([samples[i] for i in out], weights)
    return weights, z[:, 1] - z[:, 0]


def calibration(margins: np.ndarray, y: np.ndarray, counts: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Factor and offset that make margins the logits of weighted frequencies, by
    Newton steps on the log loss with a weak pull to (1, 0)."""
    x, theta = np.column_stack([margins, np.ones(len(margins))]), np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        slope = x.T @ (counts * (p - y)) + (theta - [1.0, 0.0])
        bend = (x * (counts * p * (1 - p))[:, None]).T @ x + np.eye(2)
        step = np.linalg.solve(bend, slope)
        theta = theta - step / max(1.0, np.abs(step).max())
    return max(0.05, float(theta[0])), float(theta[1])


def fit_parts_chain(labels: np.ndarray, counts: np.ndarray, fit_parts: FitParts) -> list[np.ndarray]:
    """Calibrated weights of each category's model; every category after the first
    learns from the calibrated out-of-fold probabilities of those before it."""
    earlier = np.zeros((len(labels), 0))
    out = []
    for c in range(labels.shape[1]):
        weights, margins = fit_parts(c, earlier)
        factor, offset = calibration(margins, labels[:, c], counts)
        weights = weights * factor
        weights[DIMS + c, 1] += offset
        out.append(weights)
        p = 1 / (1 + np.exp(-np.clip(factor * margins + offset, -40, 40)))
        earlier = np.column_stack([earlier, p])
    return out


def fit_chain(texts: Texts, labels: np.ndarray, folds: np.ndarray, counts: np.ndarray | None = None) -> list[np.ndarray]:
    """The chain of a sample in this process; ``labels`` has a 0/1 column for each
    category, and ``counts`` the rows that each sampled one stands for (1 without it)."""
    counts = np.ones(len(texts)) if counts is None else counts / counts.mean()

    def fit_parts(c: int, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        margins = np.zeros(len(texts))
        for k in range(FOLDS):
            margins[folds == k] = _fit_part(texts, labels[:, c], earlier, folds, counts, k, FIT)[1]
        return _fit_part(texts, labels[:, c], earlier, folds, counts, FOLDS, FIT)[0], margins

    return fit_parts_chain(labels, counts, fit_parts)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], doc_id: str = "doc_id", text: str = "text", max_per_class: int = MAX_PER_CLASS, fit_with: dict = FIT) -> Chain:
    """Fits a chain; ``categories`` gives, in their order, each category's name
    and the SQL condition on ``labels`` that says a document has it.

    Labelled rows without a text or with a null condition are not learned from.
    The sample takes about ``max_per_class`` rows of every combination of
    categories, by a hash of the id.  Without any labelled row the chain has no
    models and every probability is 0."""
    names = list(categories)
    known = labels.select(F.col(doc_id).alias("__doc"), *[F.expr(x).cast("int").alias(f"__y{i}") for i, x in enumerate(categories.values())])
    known = known.where(" AND ".join(f"__y{i} IS NOT NULL" for i in range(len(names))))
    combined = F.concat_ws(",", *[f"__y{i}" for i in range(len(names))])
    known = known.withColumns({"__class": combined, "__key": F.xxhash64(F.lit(SEED), "__doc")})
    counted = {r["__class"]: r["count"] for r in known.groupBy("__class").count().collect()}
    if not counted:
        return Chain(names, [])
    shares = {k: min(1.0, max_per_class / counted[k]) for k in sorted(counted)}
    share = F.create_map(*[F.lit(x) for kv in shares.items() for x in kv])
    sample = known.where(F.shiftrightunsigned("__key", 11) / float(1 << 53) < F.element_at(share, F.col("__class")))
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).cast("string").alias("__text")).where(F.col("__text").isNotNull())
    # The sample's ids are bounded by the parameter (two numbers and a short text each), so the texts stay where they are.
    rows = rows.join(F.broadcast(sample), F.col("__id") == F.col("__doc")).select("__text", "__class", "__key")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch, "__text", SLICE_CHARS):
                at, x = zip(*features(texts))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("__key"), part.column("__class"), pa.array([v.astype(np.int32).tobytes() for v in at], pa.binary()), pa.array([v.astype(np.float32).tobytes() for v in x], pa.binary())],
                    names=["key", "class", "at", "x"],
                )

    # The sample is bounded, so its keys, labels and margins are numbers for the driver.
    sample = materialize(map_batches(rows, extract, "key long, class string, at binary, x binary"))
    order = ["key", "class", "at"]
    known = sample.orderBy(*order).select("key", "class").toPandas()
    if not len(known):
        return Chain(names, [])
    labels_ = np.array([[int(y) for y in c.split(",")] for c in known["class"]])
    folds = known["key"].to_numpy(np.int64) % FOLDS
    weighed = np.array([1 / shares[c] for c in known["class"]])
    weighed = weighed / weighed.mean()
    parts = sample.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(FOLDS)))).repartitionById(FOLDS + 1, F.col("part")).sortWithinPartitions(*order)

    def fit_parts(c: int, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts, part = [], None
            for batch in batches:
                for at, x, part in zip(*(batch.column(n).to_pylist() for n in ("at", "x", "part"))):
                    texts.append((np.frombuffer(at, np.int32).astype(np.int64), np.frombuffer(x, np.float32).astype(np.float64)))
            if texts:
                weights, margins = _fit_part(texts, labels_[:, c], earlier, folds, weighed, part, fit_with)
                kept = weights.astype(np.float32).tobytes() if part == FOLDS else b""
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([kept], pa.binary()), pa.array([margins.tobytes()], pa.binary())], names=["part", "weights", "margins"])

        margins, weights = np.zeros(len(labels_)), None
        for r in map_batches(parts, fit, "part int, weights binary, margins binary").collect():  # one row for each fold
            margins[folds == r["part"]] = np.frombuffer(r["margins"])
            if r["part"] == FOLDS:
                weights = np.frombuffer(r["weights"], np.float32).reshape(-1, 2).copy()
        return weights, margins

    return Chain(names, [w.astype(np.float32) for w in fit_parts_chain(labels_, weighed, fit_parts)])


def predict_texts(chain: Chain, texts: list[str]) -> np.ndarray:
    """Probability of each category for each text."""
    out = np.zeros((len(texts), len(chain.categories)))
    if not chain.weights:
        return out
    for i, (at, x) in enumerate(features(texts)):
        earlier: list[float] = []
        for w in chain.weights:
            where, values = _inputs(at, x, earlier)
            earlier.append(float(softmax(values @ w[where].astype(np.float64))[1]))
        out[i] = earlier
    return out


def predict(docs: DataFrame, chain: Chain, doc_id: str = "doc_id", text: str = "text", thresholds: dict[str, float] = THRESHOLDS) -> DataFrame:
    """One row per document: ``doc_id``, then for each category its name (whether
    the probability reaches its threshold: that of ``thresholds`` or else
    ``THRESHOLD``) and ``<name>_score``.

    A null or empty text is judged by the biases alone, like a text without
    letters.  Rows that repeat a doc_id are judged each by its own text.  Other
    columns are ignored."""
    names = chain.categories

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [predict_texts(chain, texts) for _, _, texts in text_slices(batch, "__text", SLICE_CHARS)]
            p = np.concatenate(parts) if parts else np.zeros((0, len(names)))
            columns = [c for i in range(len(names)) for c in (pa.array(p[:, i] >= thresholds.get(names[i], THRESHOLD)), pa.array(p[:, i]))]
            yield pa.RecordBatch.from_arrays([batch.column("__doc"), *columns], names=["__doc", *(f for n in names for f in (n, f"{n}_score"))])

    rows = docs.select(F.col(doc_id).cast("long").alias("__doc"), F.col(text).cast("string").alias("__text"))
    schema = "__doc long, " + ", ".join(f"`{n}` boolean, `{n}_score` double" for n in names)
    return map_batches(rows, run, schema).withColumnRenamed("__doc", doc_id)

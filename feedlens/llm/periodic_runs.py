"""Periodic runs of words by a suffix automaton with link-cut access.

A run is a longest stretch of consecutive words with one smallest period.  The
suffix automaton of a word sequence links every state to its longest suffix of
another state; the path from a prefix's state to the root holds all suffixes of
that prefix.  A link-cut forest over these links keeps the paths of the words
appended so far as preferred paths, each of one colour: the position at which
its suffixes ended last.  Appending a word accesses the path of its prefix, which
takes over segments of older paths.  Each segment tells that the suffix of its
deepest state ended before at the segment's colour: if the distance of the two
ends is no more than the suffix's length, the suffix and its earlier copy make
a square, and a square is extended to the run that holds it.

The last end before is always one smallest period back within a run, so every
run of two periods or more shows up at its last word, with its smallest period.

Only places that can hold a run of the wanted exponent reach the automaton.  In
a run of period q and of ``length >= max(shortest, exponent * q)`` words every
window of ``window(exponent, shortest)`` words stands again q words before or
after.  So a run lies within a stretch of windows that recur within the stretch's
length divided by the exponent, and stretches are found on arrays of hashes.  A
hash is only a hint here: the automaton compares words.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.llm.frames import map_batches, numbered, text_slices
from feedlens.llm.wordhash import text_windows, words

EXPONENT = 4
SHORTEST = 6
#: Bytes of text whose windows are compared together (never across texts).
_BATCH_BYTES = 1 << 20
_NEVER = -1

_RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
_RUNS = T.ArrayType(_RUN, False)


def window(exponent: int, shortest: int) -> int:
    """The most words that a window may have, so that all windows of any wanted run
    stand again one period before or after."""
    return min(max(shortest, exponent * q) - 2 * q + 1 for q in range(1, shortest + 1))


class LastEnds:
    """Suffix automaton of a sequence and the last end of every suffix met.

    States are numbered from 1, the root; 0 stands for none.  Nearly all states
    of a repetitive sequence have one way out, which is kept in arrays; further
    ways are kept by state.  About 100 bytes are held for each word."""

    def __init__(self, sequence: list[int]):
        size = 2 * len(sequence) + 2
        self.length = array("i", bytes(4 * size))
        self.parent = array("i", bytes(4 * size))  # suffix link, then parent in the link-cut forest
        self.left = array("i", bytes(4 * size))
        self.right = array("i", bytes(4 * size))
        self.colour = array("i", [_NEVER]) * size
        self.ends = array("i", bytes(4 * len(sequence)))  # state of each prefix
        self._build(sequence, size)

    def _build(self, sequence: list[int], size: int) -> None:
        length, link = self.length, self.parent
        word, to = array("i", [_NEVER]) * size, array("i", bytes(4 * size))
        more: dict[int, dict[int, int]] = {1: {}}
        none: dict[int, int] = {}
        used, last = 1, 1
        for at, w in enumerate(sequence):
            used += 1
            new, p = used, last
            length[new] = length[last] + 1
            target = 0
            while p:
                if word[p] == w:
                    target = to[p]
                    break
                target = more.get(p, none).get(w, 0)
                if target:
                    break
                if word[p] == _NEVER:
                    word[p], to[p] = w, new
                else:
                    more.setdefault(p, {})[w] = new
                p = link[p]
            if not p:
                link[new] = 1
            elif length[target] == length[p] + 1:
                link[new] = target
            else:
                used += 1
                copy = used
                length[copy], link[copy] = length[p] + 1, link[target]
                word[copy], to[copy] = word[target], to[target]
                if target in more:
                    more[copy] = dict(more[target])
                link[target] = link[new] = copy
                while p:
                    if word[p] == w and to[p] == target:
                        to[p] = copy
                    elif more.get(p, none).get(w) == target:
                        more[p][w] = copy
                    else:
                        break
                    p = link[p]
            last = self.ends[at] = new

    def _splay(self, x: int) -> None:
        """Makes x the top of its preferred path's tree; the top has the colour."""
        parent, left, right, colour = self.parent, self.left, self.right, self.colour
        while True:
            p = parent[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = parent[p]
            inner = g and (left[g] == p or right[g] == p)
            if inner and (left[p] == x) == (left[g] == p):
                turns = (p, x)
            elif inner:
                turns = (x, x)
            else:
                turns = (x,)
            colour[x] = colour[g if inner else p]
            for y in turns:
                p = parent[y]
                g = parent[p]
                if left[p] == y:
                    b = left[p] = right[y]
                    right[y] = p
                else:
                    b = right[p] = left[y]
                    left[y] = p
                if b:
                    parent[b] = p
                parent[p], parent[y] = y, g
                if g:
                    if left[g] == p:
                        left[g] = y
                    elif right[g] == p:
                        right[g] = y

    def access(self, end: int) -> Iterator[tuple[int, int]]:
        """Recolours the path of the prefix that ends at ``end``; gives (last end,
        longest suffix) of every older segment that it takes over."""
        parent, right, colour = self.parent, self.right, self.colour
        below, x = 0, self.ends[end]
        while x:
            self._splay(x)
            before, deeper = colour[x], right[x]
            if deeper:
                colour[deeper] = before  # the rest keeps its own path
            right[x] = below
            if before != _NEVER:
                yield before, self.length[x]
            below, x = x, parent[x]
        colour[below] = end


def _first_difference(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading members are equal, looking ever further ahead."""
    done, step = 0, 16
    n = min(len(a), len(b))
    while done < n:
        upto = min(n, done + step)
        differs = a[done:upto] != b[done:upto]
        if differs.any():
            return done + int(differs.argmax())
        done, step = done + step, step * 4
    return n


def runs_of(sequence: list[int], exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of word numbers, sorted by
    start and period."""
    data = np.asarray(sequence, np.int64)
    ends = LastEnds(sequence)
    reached: dict[int, int] = {}  # by period: the end of the last stretch looked at
    out = []
    for end in range(len(sequence)):
        for before, longest in ends.access(end):
            q = end - before
            # A run is seen at the latest at its own last word, at its whole length.
            if longest < (exponent - 1) * q or reached.get(q, _NEVER) >= end:
                continue
            start = end - longest - q + 1
            stop = end + 1 + _first_difference(data[end + 1 :], data[end + 1 - q :])
            reached[q] = stop - 1
            if stop - start >= max(shortest, exponent * q):
                out.append((start, stop - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _stretches(hashes: np.ndarray, first: np.ndarray, exponent: int, shortest: int) -> list[tuple[int, int, int]]:
    """(text, first word, word after the last) of the stretches of several texts in
    which runs can lie; words are counted within the text."""
    k = window(exponent, shortest)
    windows, at = text_windows(hashes, first, k)
    if not len(windows):
        return []
    counts = np.diff(at)
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((windows, text))  # stable: windows of one text stay in their order
    same = (windows[order[1:]] == windows[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    gap = np.where(same, order[1:] - order[:-1], np.iinfo(np.int64).max)
    near = np.full(len(windows), np.iinfo(np.int64).max)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    open_ = near < np.iinfo(np.int64).max
    while True:
        step = np.diff(np.concatenate([[0], open_.astype(np.int8), [0]]))
        # A stretch ends with its text too.
        inner = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(windows))]
        both = np.unique(inner[open_[inner] & open_[inner - 1]])
        starts = np.sort(np.concatenate([np.flatnonzero(step == 1), both]))
        stops = np.sort(np.concatenate([np.flatnonzero(step == -1), both]))
        length = stops - starts + k - 1
        most = np.where(length >= shortest, length // exponent, 0)
        keep = open_.copy()
        keep[open_] = near[open_] <= np.repeat(most, stops - starts)
        if (keep == open_).all():
            break
        open_ = keep
    own = text[starts] if len(starts) else starts
    return [(int(t), int(a - at[t]), int(b - at[t] + k - 1)) for t, a, b in zip(own, starts, stops)]


def runs_of_texts(texts: list[bytes], exponent: int = EXPONENT, shortest: int = SHORTEST) -> tuple[list[list[tuple[int, int, int]]], list[int]]:
    """Runs of every text and its number of words."""
    data, begin, end, hashes, first = words(texts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    raw = data.tobytes()
    for t, a, b in _stretches(hashes, first, exponent, shortest):
        numbers: dict[bytes, int] = {}
        here = slice(first[t] + a, first[t] + b)
        sequence = [numbers.setdefault(raw[x:y], len(numbers)) for x, y in zip(begin[here].tolist(), end[here].tolist())]
        out[t] += [(a + start, length, q) for start, length, q in runs_of(sequence, exponent, shortest)]
    # Two stretches may share words, but a run lies in one of them.
    return [sorted(set(r), key=lambda x: (x[0], x[2])) for r in out], np.diff(first).tolist()


def collapsed(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without what follows the first period of a
    run, for all runs."""
    found = text.split()
    if not runs:
        return b" ".join(found)
    keep = np.ones(len(found), bool)
    for start, length, q in runs:
        keep[start + q : start + length] = False
    return b" ".join(compress(found, keep.tolist()))


def find_runs(docs: DataFrame, text: str = "text", exponent: int = EXPONENT, shortest: int = SHORTEST, names: tuple[str, str, str] = ("n_words", "runs", "collapsed"), keep: list[str] | None = None) -> DataFrame:
    """All rows and columns of ``docs`` (or the columns of ``keep``) and three more: the number of words, the
    runs (array of start, length, period; by start, then period) and the text with
    every run collapsed to its first period.

    Words end at ASCII white space.  A run has ``max(shortest, exponent * period)``
    words or more and is as long as its smallest period reaches; ``exponent`` is at
    least 2.  Null, empty and wordless texts have no words, no runs and the empty
    text.  Rows are judged each on its own, so repeated rows repeat their result
    and an empty table gives no rows.  Columns of ``docs`` that have one of the
    three names are left out.  A text is held by one task: 200 bytes for each of
    its words, and 100 more where windows recur close by."""
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c in kept or c == text])
    body, places = numbered(docs)
    back = [places[c] for c in docs.columns if c in kept]
    schema = T.StructType([*(body.schema[c] for c in back), T.StructField("__n", T.LongType()), T.StructField("__runs", _RUNS), T.StructField("__left", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch, places[text], _BATCH_BYTES, raw=True):
                found, n = runs_of_texts(texts, exponent, shortest)
                flat = list(zip(*(r for rs in found for r in rs))) or [(), (), ()]
                struct = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in flat], fields=[pa.field(f, pa.int64(), False) for f in ("start", "length", "period")])
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), struct)
                left = pa.array([collapsed(t, r) for t, r in zip(texts, found)], pa.binary()).cast(pa.string())
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in back), pa.array(n, pa.int64()), lists, left], names=[*back, "__n", "__runs", "__left"])

    out = map_batches(body, run, schema)
    return out.select(*[F.col(places[c]).alias(c) for c in docs.columns if c in kept], *[F.col(c).alias(n) for c, n in zip(("__n", "__runs", "__left"), names)])

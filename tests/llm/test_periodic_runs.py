"""Periodic runs against brute force: every distance, compared word by word."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

from feedlens.llm import catalog, periodic_runs

SF = "/root/testdata/sf0.001"


def brute(sequence, exponent=4, shortest=6):
    w = np.asarray(sequence)
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        same = np.concatenate([[0], (w[q:] == w[:-q]).astype(np.int8), [0]])
        step = np.diff(same)
        for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
            length = b + q - a
            smaller = any((w[a : b + q - p] == w[a + p : b + q]).all() for p in range(1, q))
            if length >= max(shortest, exponent * q) and not smaller:
                out.append((a, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def drawn(rng):
    """A few letters, with a periodic stretch now and then."""
    letters = rng.integers(1, 5)
    w = rng.integers(0, letters, rng.integers(0, 60)).tolist()
    for _ in range(rng.integers(0, 3)):
        part = rng.integers(0, letters, rng.integers(1, 9)).tolist()
        w += (part * 12)[: rng.integers(1, 50)] + rng.integers(0, letters, rng.integers(0, 6)).tolist()
    return w


@pytest.mark.parametrize("exponent,shortest", [(4, 6), (2, 2), (3, 5), (5, 1)])
def test_runs_of_drawn_sequences(exponent, shortest):
    rng = np.random.default_rng(exponent)
    for _ in range(400):
        w = drawn(rng)
        want = brute(w, exponent, shortest)
        assert periodic_runs.runs_of(w, exponent, shortest) == want
        text = " ".join(f"w{x}" for x in w).encode()
        found, n = periodic_runs.runs_of_texts([b"", text, b"w0 " + text], exponent, shortest)
        assert (found[:2], n[:2]) == ([[], want], [0, len(w)])
        assert found[2] == brute([0, *w], exponent, shortest)


def test_last_ends_are_the_latest():
    """An access names, for every suffix met before, the end it had last."""
    rng = np.random.default_rng(5)
    for _ in range(30):
        w = rng.integers(0, 2, 40).tolist()
        ends = periodic_runs.LastEnds(w)
        for end in range(len(w)):
            told = sorted((n, before) for before, n in ends.access(end))
            for size in range(1, end + 2):
                last = [e for e in range(size - 1, end) if w[e - size + 1 : e + 1] == w[end - size + 1 : end + 1]]
                segment = [before for n, before in told if n >= size][:1]
                assert segment == last[-1:]


def wanted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    numbers = {}
    runs = brute([numbers.setdefault(x, len(numbers)) for x in words])
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in runs), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id, len(runs), *((best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(words) if i not in gone)),
    )


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in catalog.QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert got == {d: wanted(d, t) for d, t in docs}
    assert sum(r[1] > 0 for r in got.values()) > 5


CASES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a a a a a"), (6, "a a a a a a"), (7, "a  a\ta\na a a "), (None, "b b b b b b b"),
    (8, "x " * 3 + "ab cd " * 5 + "ef"), (8, "x " * 3 + "ab cd " * 5 + "ef"), (9, "é é é é é é é é é é é é"), (10, "q" * 200_000 + " r" * 9),
]


def test_cases_and_clashing_columns(spark):
    df = spark.createDataFrame([(i, t, 7, "k", None, 1) for i, t in CASES], "doc_id long, text string, runs int, __c0 string, `a.b` string, __n int")
    rows = periodic_runs.find_runs(df).collect()
    assert rows[0].__fields__ == ["doc_id", "text", "__c0", "a.b", "__n", "n_words", "runs", "collapsed"]
    got = [(r["doc_id"], r["text"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in rows]
    for (i, t), row in zip(CASES, got):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = brute([hash(x) for x in words])
        keep = [x for k, x in enumerate(words) if not any(s + q <= k < s + n for s, n, q in runs)]
        assert row == (i, t, len(words), runs, " ".join(keep))
    assert got[5][3] == [(0, 6, 1)] and got[5][4] == "a" and got[8][4] == "x x x ab cd ef"


def test_empty_table_and_bad_exponent(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.find_runs(df).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(df, exponent=1)


def test_long_period_in_a_long_text():
    """Two million words, one run of a period of half a million: memory and time
    grow with the words, not with their square."""
    rng = np.random.default_rng(3)
    part = [b"%d" % x for x in rng.integers(0, 50_000, 500_000)]
    text = b" ".join(part * 4)
    (runs,), n = periodic_runs.runs_of_texts([text])
    assert n == [2_000_000] and runs == [(0, 2_000_000, 500_000)]
    assert periodic_runs.collapsed(text, runs) == b" ".join(part)

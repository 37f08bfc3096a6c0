"""Jaccard join, substring dedup and line dedup against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from feedlens.llm import jaccard_join, line_dedup, substring_dedup
from feedlens.llm.graph import components
from tests.conftest import SF001

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
EDGES = [(1000, None, "s"), (1001, "", "s"), (1002, " \n\t ", None), (1003, "one two", "s"), (1004, "ONE  two", "s"), (1005, "a b c d", None)]


def documents(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    if extra:  # columns with names that operators use themselves
        df = df.selectExpr("*", "'x' AS class", "1 AS n", "2 AS token", "3 AS `group`", "4 AS doc", "5 AS at", "6 AS __doc", "7 AS __text", "8 AS component_id")
    return df


def corpus(seed: int, n: int = 120) -> list[tuple[int, str, str]]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=40))
    rows, texts = [], []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            text = rng.choice(texts)
        elif texts and kind < 0.5:
            words = rng.choice(texts).split()
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
        else:
            text = " ".join(rng.choices(vocabulary, k=rng.randint(2, 150)))
        if rng.random() < 0.3:
            text = text + "\n" + passage
        texts.append(text)
        rows.append((i, text, f"s{i % 7}"))
    return rows


def brute_components(rows, k, percent):
    sets = {}
    for d, text, _ in rows:
        w = WORDS.findall((text or "").encode().lower())
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("seed,k,percent", [(1, 4, 85), (2, 4, 85), (3, 5, 80), (4, 2, 60)])
def test_jaccard_components(spark, seed, k, percent):
    rows = corpus(seed) + EDGES
    got = jaccard_join.join(documents(spark, rows), k=k, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, k, percent)
    assert len(got) == len(rows)


def test_jaccard_large_block(spark, monkeypatch):
    """A group of near copies that fills several chunks of a block."""
    monkeypatch.setattr(jaccard_join, "CHUNK_ROWS", 16)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(80)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), "s"))
    got = {r.doc_id: r.component_id for r in jaccard_join.join(documents(spark, rows)).collect()}
    assert got == {d: c for d, (_, c) in brute_components(rows, 4, 85).items()}


def test_jaccard_edges(spark):
    rows = EDGES + [(1003, "one two", "s"), (None, "one two", "s")]
    got = jaccard_join.join(documents(spark, rows, extra=True))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    found = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id) for r in got.collect())
    assert found == [(-1, 1, None), (1000, 0, 1000), (1001, 0, 1001), (1002, 0, 1002), (1003, 1, 1003), (1003, 1, 1003), (1004, 1, 1003), (1005, 1, 1005)]
    assert jaccard_join.join(documents(spark, [])).count() == 0


def test_prefix_bounds():
    """Sets that link share at least as many of their least hashes as the bound says."""
    rng = np.random.default_rng(0)
    for percent in (60, 80, 85, 95):
        for _ in range(300):
            n, cut, add = rng.integers(1, 200), rng.integers(0, 12), rng.integers(0, 12)
            x = rng.permutation(10**6)[: n + add]
            a, b = np.sort(x[:n]), np.sort(x[min(cut, n - 1) :])
            same = len(np.intersect1d(a, b))
            if 100 * same >= percent * (len(a) + len(b) - same):
                (qa, na), (qb, nb) = jaccard_join.prefix(len(a), percent), jaccard_join.prefix(len(b), percent)
                assert len(np.intersect1d(a[:qa], b[:qb])) >= max(na, nb)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (None, 3), (50, 49), (50, 48)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 48: 48, 49: 48, 50: 48}


def brute_substrings(rows, window):
    seen, out = set(), {}
    for d, text in sorted((d, t) for d, t, _ in rows):
        w = WORDS.findall((text or "").encode())
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                keep[i : i + window] = [False] * window
            seen.add(key)
        out[d] = (len(w), keep.count(False), b" ".join(x for x, k in zip(w, keep) if k).decode())
    return out


@pytest.mark.parametrize("seed,window", [(1, 20), (5, 20), (6, 7), (7, 3)])
def test_substrings(spark, seed, window):
    periodic = [(500, " ".join(["a"] * 50), "s"), (501, " ".join("abc" * 12), "s"), (502, " ".join(map(str, range(60))), "s"), (503, " ".join(map(str, range(10, 45))), "s")]
    rows = corpus(seed) + periodic + [(i, t or "", s) for i, t, s in EDGES]
    got = substring_dedup.dedup(documents(spark, rows), window=window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == brute_substrings(rows, window)
    assert all(s.length >= window for r in got for s in r.spans)


def test_substring_edges(spark):
    text = " ".join(map(str, range(30)))
    rows = [(5, text, "s"), (5, text, "s"), (7, text, "s"), (None, text, "s"), (8, None, "s")]
    got = substring_dedup.dedup(documents(spark, rows, extra=True)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == [(0, 30, 0), (5, 30, 0), (5, 30, 0), (7, 30, 30), (8, 0, 0)]
    assert substring_dedup.dedup(documents(spark, [])).count() == 0


def test_lines(spark):
    boiler, rare, edge = "Subscribe to our newsletter now", "Only here and there, twice", "This one stands near the edge"
    body = "The body of a document that is long enough to stay whole, number "
    rows = []
    for i in range(24):
        lines = [body + str(i), body + "b" + str(i), f"  {boiler} "]
        if i % 12 < 2:
            lines.append(rare)
        if i < 10:
            lines.append(edge)
        rows.append((i, "\n".join(lines), f"s{i % 12}"))
    rows += [(100, boiler, "s0"), (101, None, "s1"), (102, "", None), (103, boiler + "\n" + body + "x" + body, None), (103, "short\nshort", "s3")]
    out = line_dedup.remove_boilerplate(documents(spark, rows, extra=True).withColumnRenamed("n", "n_lines"))
    got = {(r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()}
    assert out.count() == len(rows)
    for i in range(24):
        kept = [body + str(i), body + "b" + str(i)] + ([rare] if i % 12 < 2 else [])
        n = 3 + (i % 12 < 2) + (i < 10)
        assert (i, "\n".join(kept), n, 1 + (i < 10)) in got, i
    assert (100, boiler, 1, 0) in got  # nothing but boilerplate: left as it is
    assert {(101, None, 0, 0), (102, "", 1, 0), (103, body + "x" + body, 2, 1), (103, "short\nshort", 2, 0)} <= got
    assert line_dedup.remove_boilerplate(documents(spark, [])).count() == 0


def test_lines_of_short_pages(spark):
    """A long header and a short footer go from pages of one body line; pages of
    nothing else stay, and so do blank lines."""
    head, foot = "A long header that stands on every page of every site here", "Back"
    rows = [(i, f"{head}\nbody {i}\n\r\n\n{foot}", f"s{i}") for i in range(12)]
    rows += [(50 + i, f"{head}\n\r\n{foot}", f"s{i}") for i in range(3)]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.remove_boilerplate(documents(spark, rows)).collect()}
    assert all(got[i] == (f"body {i}\n\r\n", 5, 2) for i in range(12))
    assert all(got[50 + i] == (rows[12 + i][1], 3, 0) for i in range(3))


def test_lines_without_an_id(spark):
    """Rows without an id, or with one id for all, are judged each by their own text."""
    head = "A header that stands on every page"
    for doc_id in (None, 7):
        rows = [(doc_id, f"{head}\nbody {i}" if i % 2 else f"body {i}\nmore {i}", f"s{i}") for i in range(24)] + [(doc_id, f"{head}\nbody 1", "s1")]
        got = sorted(r.text for r in line_dedup.remove_boilerplate(documents(spark, rows)).collect())
        assert got == sorted([f"body {i}" if i % 2 else f"body {i}\nmore {i}" for i in range(24)] + ["body 1"])


def test_line_sketches_decide_far_from_the_threshold(spark):
    """Spread of 3, 9, 10, 11 and 40 sites; only the last is clear of the band."""
    rows, want = [], set()
    for k, sites in enumerate((3, 9, 10, 11, 40)):
        line = f"A line that stands on many sites, {k}"
        rows += [(len(rows) + j, line, f"site{j}") for j in range(sites)]
        if sites >= line_dedup.MIN_SITES:
            want.add(line)
    docs = documents(spark, rows)
    keys = {r[0] for r in line_dedup.boilerplate(docs).collect()}
    hashed = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) AS h").distinct().collect()}
    assert keys == {hashed[x] for x in want}


def test_whole_tables(spark):
    """The registered queries over a small table against brute force."""
    from feedlens.llm.catalog import QUERIES

    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op8_substring_dedup"](spark, SF001).collect()}
    assert got == {d: (n, c, hashlib.sha256(t.encode()).hexdigest()) for d, (n, c, t) in brute_substrings(docs, 20).items()}
    found = QUERIES["op4_jaccard_join"](spark, SF001).collect()
    shared = collections.defaultdict(list)
    for d, text, _ in docs:
        w = WORDS.findall(text.encode().lower())
        for g in {tuple(w[i : i + 4]) for i in range(len(w) - 3)}:
            shared[g].append(d)
    sizes = {r.doc_id: r.n_shingles for r in found}
    pairs = collections.Counter((a, b) for ids in shared.values() for i, a in enumerate(ids) for b in ids[:i])
    part = {r.doc_id: r.component_id for r in found}
    links = [(a, b) for (a, b), n in pairs.items() if 100 * n >= 85 * (sizes[a] + sizes[b] - n)]
    assert links and all(part[a] == part[b] for a, b in links)
    assert sum(part[d] != d for d in part) <= len(links)

"""Packing, mixing, license scan and the pipeline."""

from __future__ import annotations

import collections
import functools
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from feedlens.llm import license_scan, line_dedup, mixing, packing
from feedlens.llm.catalog import ORACLES, QUERIES, tokenizer_path
from scripts.check_oracle import duck, normalize
from tests.conftest import SF001

TEXTS = ["", "a b", "a  b", "a\n b", "a \nb", " a", "a ", "a\n\nb", "a\tb", "x<|endoftext|>y z", "é ü b c", "\n", "\na\nb", "it's  'll x", "a\x1cb c", "a\x1c b", "a b", "a 　b", "1a b2, c.", "né, été. là", "日本 語"]


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def reference_ids(text):
    return np.array(tokenizer().encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def test_ids_by_parts_are_the_tokenizers():
    words = packing.PartIds(tokenizer_path())
    for _ in range(2):  # learned, then remembered
        for t, got in zip(TEXTS, words.ids(TEXTS)):
            assert np.append(got, 1).tolist() == reference_ids(t).tolist(), repr(t)


def check_pieces(rows, docs):
    """Every id in one piece, sequences gapless, little padding."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(docs)
    for d, pieces in by_doc.items():
        ids, at = reference_ids(docs[d]), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == pieces[0].sequence_length <= 2048


def test_pack_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = QUERIES["op5_pack_sequences"](spark, SF001).collect()
    check_pieces(rows, docs)
    sizes = {r.sequence_id: r.sequence_length for r in rows}
    padded = sum(2048 - n for n in sizes.values() if n & (n - 1))
    assert padded <= 2048 * 4


def test_pack_edges(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (101, "word " * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS length", "3 AS _text")
    check_pieces(packing.pack(df, tokenizer_path()).collect(), dict(rows))
    twice = packing.pack(df.where("doc_id = 1").union(df.where("doc_id = 1")), tokenizer_path())
    assert twice.agg({"length": "sum"}).first()[0] == 2 * len(reference_ids("a b"))
    assert packing.pack(df.limit(0), tokenizer_path()).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_pack_lengths(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 300, 2048, 4096, rng.randint(1, 6000)]) for _ in range(rng.randint(1, 400))]
    pieces, filled = packing.pack_lengths(lengths)
    got = collections.Counter()
    for d, _, n, _, _ in pieces:
        got[d] += n
    assert dict(got) == dict(enumerate(lengths)) and sum(filled) == sum(lengths)
    assert sum(n not in packing.TIERS for n in filled) <= 1
    groups = packing.step_groups(filled, step_ids=8192)
    totals = collections.Counter()
    for g, n in zip(groups, filled):
        totals[g] += n
    assert max(totals.values()) - min(totals.values()) <= 3 * 2048


def mix_documents(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.selectExpr("*", "1 AS size", "2 AS target", "3 AS __size", "4 AS draws", "5 AS n_chars") if extra else df


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        goal = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if goal[s] > 3 * sizes[s]}
        if not over:
            return {**{s: 3 * sizes[s] for s in capped}, **goal}
        capped |= over


def test_mix_targets_and_draws(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a", "b", "b", "b", "b", "é", "Z", None])) for i in range(600)]
    rows += [(700, None, "only-null"), (701, "x " * 5000, "tiny"), (702, "y", "small")]
    out = mixing.mix(mix_documents(spark, rows, extra=True)).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, source = brute_targets(sizes), {i: s for i, _, s in rows}
    taken, shards = collections.Counter(), collections.Counter()
    assert sorted(r.doc_id for r in out) == sorted(source)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken == sum(d.words for d in r.draws) <= 3 * r.size
        assert all(0 < d.words <= r.size and 0 <= d.shard < 16 for d in r.draws)
        taken[s] += r.taken
        shards.update(d.shard for d in r.draws)
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert len(shards) == 16 and max(shards.values()) < 2 * min(shards.values())
    again = mixing.mix(mix_documents(spark, rows[::-1])).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_mix_draw(spark):
    rows = [(i, f"one  two {i}", "s" if i % 3 else None) for i in range(200)] + [(300, None, "s"), (301, "a b", "t")]
    df = mix_documents(spark, rows, extra=True)
    drawn = mixing.draw(df).collect()
    assert set(drawn[0].asDict()) == set(df.columns)
    plan = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    words = collections.Counter()
    for r in drawn:
        words[r.doc_id] += len(r.text.split())
    assert dict(words) == {d: n for d, n in plan.items() if n}
    assert mixing.draw(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0


def test_mix_draw_of_repeated_and_null_ids(spark):
    """Rows that share an id, or have none, give the words their own text and source
    are planned for: every target is met to the word and no text is another's."""
    rng = random.Random(4)
    rows = [(rng.choice([None, i, 5, 6]), f"{s}{i} " + " ".join(["w"] * rng.randint(0, 40)), s) for i in range(300) for s in "ab"]
    rows += [(None, "same text", "b")] * 40
    df = mix_documents(spark, rows, extra=True)
    words = collections.Counter()
    for r in mixing.draw(df).collect():
        words[r.source] += len(r.text.split())
        assert r.text.split()[0][0] in (r.source, "s")
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want = brute_targets(sizes)
    assert all(abs(words[s] - want[s]) <= 1 for s in want)
    again = mixing.draw(mix_documents(spark, rows[::-1], extra=True).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixing.draw(df).collect()))


def test_hypergeometric_moments(spark):
    from pyspark.sql import functions as F

    df = spark.range(4000).select(mixing.hypergeometric(mixing._uniform(mixing._hash("t", F.col("id"))), F.lit(30).cast("long"), F.lit(100).cast("long"), F.lit(40).cast("long")).alias("x"))
    x = df.toPandas().x
    assert x.mean() == pytest.approx(12, abs=0.15)
    assert x.var() == pytest.approx(40 * 0.3 * 0.7 * 60 / 99, rel=0.1)
    assert x.between(0, 30).all()


def test_splitting_tree_keeps_quotas(spark):
    quotas = {0: 1, 1: 700, 2: 33, 3: 0, 4: 5000}
    tree = mixing.splitting_tree(spark.createDataFrame(list(quotas.items()), "__i int, __quota long")).collect()
    ends = {r["__i"]: r["__ends"] for r in tree}
    assert {i: e[-1] for i, e in ends.items()} == quotas
    totals = np.diff([0] + [sum(e[k] for e in ends.values()) for k in range(16)])
    assert totals.max() - totals.min() <= 1  # shards hold equal numbers of blocks
    assert (np.diff(ends[4]) > 200).all()


PHRASES = {("under", "the", "mit", "license"): "mit", ("apache", "license", "version", "2"): "apache-2", ("cc", "by", "nc"): "cc-by-nc"}


def brute_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = sorted((i, label) for p, label in PHRASES.items() for i in range(len(w)) if tuple(w[i : i + len(p)]) == p)
    return len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({x for _, x in places}))


LICENSES = [
    "Released under the MIT License.",
    "x Under  the MIT-License; and CC BY-NC 4.0, cc by nc sa 3.0",
    "licensed under the Apache License, Version 2.0 apache license version 2",
    "This work is licensed under the GNU General Public License, version 3.",
    "Under the MIT license under the MIT license",
    "notunder the mit license",
    "summit license, the license plate",
    "SPDX-License-Identifier: LGPL-2.1-only",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "É Ünder cc by nc",
    None,
    "",
    "word " * 20000 + "cc by nc",
]


def test_license_base_columns(spark):
    df = spark.createDataFrame(list(enumerate(LICENSES)), "doc_id long, text string").selectExpr("*", "1 AS __words", "2 AS detections", "3 AS n_words")
    got = license_scan.summary(license_scan.scan(df)).collect()
    assert [tuple(r)[1:6] for r in sorted(got)] == [brute_base(t) for t in LICENSES]
    labels = {r.doc_id: r.labels.split(",") for r in got}
    assert labels[0] == ["mit"] and labels[5] == ["mit"]  # "the mit license" is no base phrase, but a rule's
    assert "cc-by-nc-sa" in labels[1] and {"cc-by-nc", "mit"} <= set(labels[1])
    assert labels[3] == ["gpl-3"] and labels[7] == ["lgpl-2.1"] and labels[8] == ["mit"]
    assert labels[6] == [""] and all(0 <= r.score <= 1 for r in got)
    assert license_scan.scan(df.limit(0)).count() == 0


def test_license_rules_and_suppression(spark):
    assert len(license_scan.RULES) > 300
    rules = (license_scan.Rule("long", "licen", "a licen[sc]e b", 0.9), license_scan.Rule("short", "licen", "licen[sc]e", 0.4), license_scan.Rule("over", "licen", "b c", 0.3))
    df = spark.createDataFrame([(1, "x a license b c license")], "doc_id long, text string")
    (row,) = license_scan.scan(df, rules=rules).collect()
    assert [(d.label, d.first, d.last) for d in row.detections] == [("long", 1, 3), ("over", 3, 4), ("short", 5, 5)]


def test_license_dual_after_copyright(spark):
    """A rule that passes over words does not swallow the licenses named there."""
    texts = {
        "Copyright 2021 Acme. Released under GPL 3 or MIT": ("copyright,gpl-3,mit", 0.95),
        "Copyright 2021 Acme. Released under MIT or GPL 3": ("copyright,gpl-3,mit", 0.5),
        "Copyright Acme, released under the GNU Lesser General Public License 2.1": ("lgpl-2.1", 0.95),
        "Confidential and proprietary, parts released under the GPL license": ("gpl,proprietary", 0.95),
        "Creative Commons Attribution Non-Commercial License": ("cc-by-nc", 0.75),
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = license_scan.summary(license_scan.scan(df)).orderBy("doc_id").collect()
    assert [(r.labels, r.score) for r in got] == list(texts.values())


def shortest_forms(tree) -> list[str]:
    """Every choice of branches of a parsed pattern, repeats taken as often as they must be."""
    out = [""]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            part = [chr(arg)]
        elif name == "IN":
            part = [chr(arg[0][1] if str(arg[0][0]) == "LITERAL" else arg[0][1][0])]
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            part = [x * arg[0] for x in shortest_forms(arg[2])] if arg[0] else [""]
        elif name == "SUBPATTERN":
            part = shortest_forms(arg[-1])
        else:
            assert name == "BRANCH", name
            part = [x for branch in arg[1] for x in shortest_forms(branch)]
        out = [x + y for x in out for y in dict.fromkeys(part)]
    return out


def test_every_rule_passes_the_gate():
    """Whatever a rule matches holds a gate word and the rule's keyword, so
    neither filter drops a detection."""
    for rule in license_scan.RULES:
        for text in shortest_forms(re._parser.parse(rule.pattern)):
            assert any(g in text for g in license_scan.GATE) and rule.keyword in text, (rule, text)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    got = QUERIES[name](spark, SF001)
    want = duck(SF001).execute(ORACLES[name])
    columns, expect = normalize([d[0] for d in want.description], want.fetchall())
    assert normalize(got.columns, [tuple(r) for r in got.collect()]) == (columns, expect)


def test_license_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = QUERIES["op10_license_scan"](spark, SF001).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in got} == {d: brute_base(t) for d, t in docs.items()}
    assert sum(r.n_base > 0 for r in got) > 5


def test_pipeline_stages(spark):
    """Each stage on what the one before it kept, against plain computations."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    extra = spark.createDataFrame([(90001, "12 34 !!", "en", "src1", 8), (90002, None, "en", "src1", None)], docs.schema)
    docs, kept = docs.unionByName(extra), {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{spark.sparkContext.getCheckpointDir()}/pipeline-test-{name}"
        stage(spark, docs, SF001).write.mode("overwrite").parquet(path)
        kept[name], before = spark.read.parquet(path), docs
        docs = kept[name]
        if name != "packing":
            assert docs.columns == before.columns
    ids = {n: {r[0] for r in df.select("doc_id").collect()} for n, df in kept.items()}
    assert ids["language_id"] == set(range(1000))
    assert ids["line_dedup"] == ids["language_id"]
    expect = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(kept["language_id"]).collect()}
    assert {r.doc_id: r.text for r in kept["line_dedup"].collect()} == expect
    from tests.llm.test_text_dedup import WORDS

    sets = {}
    for r in kept["line_dedup"].collect():
        w = WORDS.findall(r.text.encode().lower())
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)}
    left = sorted(ids["jaccard_join"])
    by_shingle = collections.defaultdict(list)
    for d in sets:
        for g in sets[d]:
            by_shingle[g].append(d)
    pairs = collections.Counter((a, b) for x in by_shingle.values() for i, a in enumerate(x) for b in x[:i])
    links = {(a, b) for (a, b), n in pairs.items() if 5 * n >= 4 * len(sets[a] | sets[b])}
    assert not any(a in ids["jaccard_join"] and b in ids["jaccard_join"] for a, b in links)
    linked = {x for p in links for x in p}
    assert set(sets) - linked <= set(left)
    assert ids["mixing"] <= ids["jaccard_join"]
    total = kept["packing"].agg({"length": "sum"}).first()[0]
    assert total == sum(len(reference_ids(r.text)) for r in kept["mixing"].collect())


def test_pipeline_keeps_one_row_of_a_group(spark):
    """Repeated ids, rows without an id and null texts."""
    words = lambda k, n=40: " ".join(f"w{k}x{i}" for i in range(n))
    rows = [(1, words(1)), (1, words(1)), (2, words(2)), (3, words(1) + " end"), (None, words(1)), (None, words(4)), (None, words(4)), (5, words(5)), (5, words(5)), (6, None), (7, ""), (8, "one")]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.dedup_documents(spark, docs, SF001)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == sorted(
        [(1, words(1)), (2, words(2)), (0, words(4)), (5, words(5)), (6, ""), (7, ""), (8, "one")]
    )

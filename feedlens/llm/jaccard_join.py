"""N-gram Jaccard join with signature trees.

A document is the set of its distinct k-word shingles, as 64-bit hashes.
Documents with equal sets are one class; all work is on classes.

Candidates (lossless).  Two sets that link differ in few shingles, so among the
``q`` least hashes of each (a third more than the part in which linked sets may
differ, and at least the usual prefix) they share a number that depends on their
sizes only: of the set whose last searched hash is the lesser, at most
``100 - percent`` percent are missing in the other one, all others that are searched
are searched there too, and it has at least ``percent`` percent of the other's size.  One self semi-join on
the shingle keeps the shingles that another class has as well; classes with too
few of them can link with nothing.  Of the others, only the rarest shared ones,
as many as the same bound leaves open, are block keys, so a passage that many
documents share is no block unless it makes up most of a document.  Blocks with
the same members are one.

Blocks.  A block's members form a signature tree: nodes hold a bitmap of shingle
hashes, combined by OR, and a range of set sizes.  Traversing the tree against
itself prunes the pairs of nodes whose sizes cannot link or whose common bits
leave too small an overlap.  Only bitmaps travel to the blocks.  What the trees
leave open is joined over all blocks to components; a set travels once, to its
component, where overlaps are counted exactly.  Members of large blocks and
components are dealt into chunks, and every pair of chunks is searched.

Each class is first seen in its largest block only.  Blocks whose members are
connected after that need no second look; of the others, pairs within one
component are skipped.  Only the edges of spanning forests leave a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.frames import Scratch, map_batches, sorted_groups, text_slices
from feedlens.llm.graph import components
from feedlens.llm.vector_dedup import _forest
from feedlens.llm.wordhash import mix, shingle_sets
from feedlens.session import materialize

#: Members in one chunk of a block.
CHUNK_ROWS = 1024
FANOUT = 8
_BATCH_BYTES = 1 << 20


def searched(percent: int) -> int:
    """Part of a set, by least hash, in which candidates are searched (percent)."""
    return min(100, -(-4 * (100 - percent) // 3))


def prefix(n: int, percent: int) -> tuple[int, int]:
    """How many of the least hashes of a set of n are searched, and how many of
    them any set that links with it must share at least."""
    least = -(-percent * n // 100)  # overlap with any partner
    q = max(n - least + 1, -(-searched(percent) * n // 100))
    shared = -(-(searched(percent) - 100 + percent) * percent * n // 10_000)
    return min(q, n), max(1, shared)


def _per_slice(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    for batch in batches:
        ids = batch.column("__doc").to_pylist()
        for a, b, texts in text_slices(batch, "__text", _BATCH_BYTES, raw=True):
            yield ids[a:b], shingle_sets(texts, k)


def _class_keys(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Two 64-bit keys of each set."""
    out = []
    with np.errstate(over="ignore"):
        for s in sets:
            one, two = s.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(s * np.uint64(3)), initial=np.uint64(0))
            out.append(tuple(mix(np.array([one ^ (two << np.uint64(1)) ^ np.uint64(len(s)), two + one])).view(np.int64).tolist()))
    return out


def profiles(docs: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """``__doc``, set size ``n`` and the class keys of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _per_slice(batches, k):
            one, two = zip(*_class_keys(sets))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, [len(s) for s in sets], one, two)], names=["__doc", "n", "class", "check"])

    return map_batches(_working(docs, doc_id, text), run, "__doc long, n long, class long, check long")


def _working(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("__doc"), F.col(text).cast("string").alias("__text"))


def _postings(docs: DataFrame, k: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """The searched shingles of every class: ``token``, ``class``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _per_slice(batches, k):
            keys = np.array([c for c, _ in _class_keys(sets)], np.int64)
            least = [s[: prefix(len(s), percent)[0]] for s in sets]
            tokens = np.concatenate(least).view(np.int64)
            classes = np.repeat(keys, [len(x) for x in least])
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(classes)], names=["token", "class"])

    return map_batches(_working(docs, doc_id, text), run, "token long, class long")


def _blocks(docs: DataFrame, reps: DataFrame, k: int, percent: int, doc_id: str, text: str, scratch: Scratch) -> DataFrame:
    """Candidate blocks: ``block``, ``class``; every linked pair is in one."""
    postings = _postings(docs, k, percent, doc_id, text)
    a, b = postings.alias("a"), postings.alias("b")
    shared = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.class") != F.col("b.class")), "left_semi")
    shared = scratch.keep("shared", shared.distinct())
    known = shared.join(shared.groupBy("token").count(), "token").groupBy("class").agg(F.sort_array(F.collect_list(F.struct("count", "token"))).alias("list"))
    need = F.greatest(F.lit(1), F.ceil(F.lit((searched(percent) - 100 + percent) * percent) * F.col("n") / 10_000)).cast("int")
    known = known.join(reps.select("class", "n").dropDuplicates(["class"]), "class")
    keys = known.where(F.size("list") >= need).select("class", F.explode(F.slice("list", F.lit(1), F.size("list") - need + 1)).alias("x"))
    keys = scratch.keep("keys", keys.select("class", F.col("x.token").alias("token")))
    scratch.drop("shared")
    members = keys.groupBy("token").agg(
        F.count("*").alias("many"), F.bit_xor(F.xxhash64("class")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), F.col("class"))).alias("x2")
    )
    members = members.where("many > 1").groupBy("many", "x1", "x2").agg(F.min("token").alias("block"))
    blocks = scratch.keep("blocks", keys.withColumnRenamed("token", "block").join(members.select("block", "many"), "block"))
    scratch.drop("keys")
    return blocks


def signature(members: np.ndarray) -> np.ndarray:
    """Bitmap of a set, four to eight bits for each member, as 64-bit words."""
    bits = 1 << max(6, (4 * len(members) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[((members >> np.uint64(13)) & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags).view(np.uint64)


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap that the set would have with fewer words."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def open_pairs(sizes: np.ndarray, bitmaps: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets that their signature trees leave open.

    Sets whose bitmaps are equally long share a tree; those with longer ones join
    it folded, for the pairs with the shorter ones."""
    words = np.array([len(x) for x in bitmaps])
    out = [(np.zeros(0, np.int64),) * 2]
    for w in np.unique(words):
        here = words == w
        some = np.flatnonzero(here | ((words > w) & (percent * sizes <= 100 * sizes[here].max())))
        a, b = SignatureTree(sizes[some], np.stack([_folded(bitmaps[i], w) for i in some])).pairs(percent)
        a, b = some[a], some[b]
        new = here[a] | here[b]
        out.append((a[new], b[new]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _popcount(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(-1, dtype=np.int64)


class SignatureTree:
    """Levels of nodes over sets in the order of their sizes; the first level
    holds the sets' own bitmaps, the last one the root."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        sizes, bits = sizes[self.order], bits[self.order]
        slack = sizes - _popcount(bits)  # members that share a bit with another one
        self.levels = [(bits, sizes, sizes, slack)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, slack = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append(tuple(f.reduceat(x, at) for f, x in ((np.bitwise_or, bits), (np.minimum, low), (np.maximum, high), (np.maximum, slack))))

    def pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of sets that the nodes' bounds leave open, as indexes of the input."""
        a = b = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            keep = self._open(level, a, b, percent)
            a, b = a[keep], b[keep]
            if not level:
                break
            below = len(self.levels[level - 1][0])
            x, y = (np.broadcast_to(z, (len(a), FANOUT, FANOUT)).ravel() for z in (a[:, None, None] * FANOUT + np.arange(FANOUT)[:, None], (b * FANOUT)[:, None, None] + np.arange(FANOUT)))
            fine = (x <= y) & (y < below)
            a, b = x[fine], y[fine]
        apart = a < b
        return self.order[a[apart]], self.order[b[apart]]

    def _open(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        bits, low, high, slack = self.levels[level]
        fits = percent * low[b] <= 100 * high[a]  # b's sets are not smaller than a's
        keep = np.flatnonzero(fits)
        for start in range(0, len(keep), 4096):
            at = keep[start : start + 4096]
            x, y = a[at], b[at]
            most = _popcount(bits[x] & bits[y]) + np.minimum(slack[x], slack[y])
            fits[at] = (100 + percent) * most >= percent * (low[x] + low[y])
        return fits


def linked_pairs(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of sets that link: percent of the union is in the intersection."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if len(sets) == 2:
        a, b = np.zeros(1, np.int64), np.ones(1, np.int64)
        same = np.array([len(np.intersect1d(sets[0], sets[1], assume_unique=True))])
    else:
        a, b = open_pairs(sizes, [signature(s) for s in sets], percent)
        if not len(a):
            return a, b
        same = _overlaps(sets)[a, b]
    link = 100 * same >= percent * (sizes[a] + sizes[b] - same)
    return a[link], b[link]


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 columns of common members."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = many > 1
    row, column = row[common[column]], (np.cumsum(common) - 1)[column[common[column]]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    by_column = np.argsort(column, kind="stable")
    row, column = row[by_column], column[by_column]
    width = 4096
    for start in range(0, int(common.sum()), width):
        lo, hi = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(sets), width), np.float32)
        part[row[lo:hi], column[lo:hi] - start] = 1
        out += part @ part.T
    return np.rint(out).astype(np.int64)


def _open_groups(blocks: DataFrame, sets: DataFrame, percent: int, whole: bool) -> DataFrame:
    """Groups (``class``, ``group``) in which links are still possible, from
    blocks (``block``, ``class``, ``part``: the component so far), by the blocks'
    signature trees alone.

    A block gives a spanning forest of its open pairs between parts.  ``whole``:
    every chunk of a block meets every other one, and the components of all forests
    are taken: they hold every open pair, and a class is in one of them only, so its
    set travels once however many blocks it shares; large components are dealt into
    chunks whose pairs are the groups.  Else classes are in one block each, chunks
    meet the first one only, and the trees of a block's forest are the groups."""
    chunks = blocks.groupBy("block").agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("chunks"), F.count("*").alias("many"))
    placed = blocks.select("block", "class", "part").join(chunks.where("many > 1").select("block", "chunks"), "block")
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("class"), "chunks").cast("int"))
    others = F.sequence(F.lit(0), F.col("chunks") - 1)
    if not whole:
        others = F.when(F.col("chunk") == 0, others).otherwise(F.array(F.lit(0), F.col("chunk")))
    groups = placed.select("class", "part", "block", F.explode(others).alias("other"), "chunk")
    groups = groups.select("class", "part", F.xxhash64("block", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("group"))
    groups = groups.join(sets.select("class", "n", "bits"), "class")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "group"):
            ids, parts = group.column("class").to_numpy(), group.column("part").to_numpy()
            if len(ids) < 2 or (parts == parts[0]).all():
                continue
            bitmaps = [np.frombuffer(x, np.uint64) for x in group.column("bits").to_pylist()]
            a, b = open_pairs(group.column("n").to_numpy(), bitmaps, percent)
            apart = parts[a] != parts[b]
            root = _forest(len(ids), a[apart], b[apart])
            far = np.flatnonzero(root != np.arange(len(ids)))
            to = ids[root]
            if not whole:
                far = np.union1d(far, root[far])
                with np.errstate(over="ignore"):  # a tree is named by its group and root
                    to = mix(mix(to.view(np.uint64)) + np.uint64(group.column("group")[0].as_py() % (1 << 64))).view(np.int64)
            if len(far):
                yield pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(to[far])], names=["class", "to"])

    forests = map_batches(groups.repartition("group").sortWithinPartitions("group"), run, "class long, to long")
    if not whole:
        return forests.select("class", F.col("to").alias("group"))
    members = components(forests, "class", "to").select(F.col("node").alias("class"), "component")
    counts = members.groupBy("component").agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("chunks"))
    members = members.join(counts, "component").withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), F.col("class")), "chunks").cast("int"))
    members = members.select("class", "component", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    return members.select("class", F.xxhash64("component", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("group"))


def _search(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Forest edges (``class``, ``to``) of the exact links within groups."""
    groups = groups.join(sets.select("class", "members"), "class")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "group"):
            if group.num_rows < 2:
                continue
            ids = group.column("class").to_numpy()
            a, b = linked_pairs([np.frombuffer(x, np.uint64) for x in group.column("members").to_pylist()], percent)
            root = _forest(len(ids), a, b)
            far = np.flatnonzero(root != np.arange(len(ids)))
            if len(far):
                yield pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(ids[root[far]])], names=["class", "to"])

    return map_batches(groups.repartition("group").sortWithinPartitions("group"), run, "class long, to long")


def _sets(docs: DataFrame, wanted: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """``class``, ``n``, ``bits`` (signature) and ``members`` (sorted hashes) of the
    wanted documents (``__doc``, ``class``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = batch.column("class").to_pylist()
            for a, b, texts in text_slices(batch, "__text", _BATCH_BYTES, raw=True):
                sets = shingle_sets(texts, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes[a:b], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), *(pa.array([f(s).tobytes() for s in sets], pa.binary()) for f in (signature, np.asarray))],
                    names=["class", "n", "bits", "members"],
                )

    # Rows that repeat the wanted id with another text are told apart by their class.
    joined = _working(docs, doc_id, text).join(wanted, "__doc")
    return map_batches(joined, run, "class long, n long, bits binary, members binary")


def _component() -> Column:
    return F.when(F.col("__doc").isNotNull(), F.when(F.col("n") == 0, F.col("__doc")).otherwise(F.col("component_id")))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id``, the
    least doc_id reachable by links, its own included.

    Two documents link when 100 * |intersection| >= percent * |union| of their
    shingle sets.  A-Z are lowered and words end at ASCII white space.  With
    fewer than k words the whole sequence is the one shingle; without words, or
    with a null text, the set is empty and links with nothing.  Rows with a null
    doc_id have no component and are no part of one.  doc_id names one text: rows
    that repeat it with the same text get equal results.  Other columns are
    ignored."""
    scratch = Scratch(docs.sparkSession)
    profile = materialize(profiles(docs, k, doc_id, text))
    some = profile.where("n > 0 AND __doc IS NOT NULL")
    reps = materialize(some.groupBy("class", "check").agg(F.min("__doc").alias("__doc"), F.min("n").alias("n")))
    blocks = _blocks(docs.where(F.col(doc_id).isNotNull()), reps, k, percent, doc_id, text, scratch)
    wanted = reps.join(blocks.select("class").distinct(), "class", "left_semi").select("__doc", "class").dropDuplicates(["class"])
    sets = scratch.keep("sets", _sets(docs, wanted, k, doc_id, text).dropDuplicates(["class"]))

    largest = blocks.groupBy("class").agg(F.max(F.struct("many", "block")).alias("x")).select("class", F.col("x.block").alias("block"))
    groups = _open_groups(largest.withColumn("part", F.col("class")), sets, percent, whole=False)
    first = materialize(_search(groups, sets, percent))
    parts = components(first, "class", "to").withColumnRenamed("node", "class")
    parted = blocks.join(parts, "class", "left").withColumn("part", F.coalesce("component", "class"))
    mixed = parted.groupBy("block").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("block")
    groups = _open_groups(parted.join(mixed, "block", "left_semi").select("block", "class", "part"), sets, percent, whole=True)
    second = materialize(_search(groups, sets, percent))
    scratch.drop()
    parts = components(first.unionByName(second), "class", "to").withColumnRenamed("node", "class")

    named = reps.join(parts, "class", "left").withColumn("part", F.coalesce("component", "class"))
    least = named.groupBy("part").agg(F.min("__doc").alias("component_id"))
    named = named.join(least, "part").select("class", "check", "component_id")
    out = profile.join(named, ["class", "check"], "left")
    return out.select(
        F.col("__doc").alias(doc_id), F.col("n").alias("n_shingles"), _component().alias("component_id")
    )

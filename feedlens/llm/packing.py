"""Hierarchical multi-length packing of documents into training sequences.

Every document is tokenised whole and closed with one end id.  Full windows of
the longest tier are cut off first; what remains of a document is routed to the
shortest context tier that holds it.  Each tier opens one window per remainder,
longest tier first, and fills the gap with whole remainders from the shorter
tiers (best fit, longest that fits) and, at the end, with the front of one more
remainder whose rest goes back to its tier.  What is left when a tier runs dry
is closed at powers of two, so only the last window of a batch is padded.

Packing works on one Arrow batch of documents at a time, so it needs no shuffle
and its memory is bounded by the batch; at most ``tiers[0] - 1`` ids of padding
arise per batch.  Windows are dealt to step groups, longest lengths first in
snake order, so that the groups of a batch hold nearly equal numbers of ids.
"""

from __future__ import annotations

import bisect
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from feedlens.llm.frames import map_batches, slices, text_slices
from feedlens.llm.wordhash import SPACE, span_hashes

TIERS = (2048, 1024, 512, 256)
END_ID = 1
STEP_IDS = 32 * 2048
#: Characters of text that are tokenised and packed together.
PACK_BYTES = 4 << 20
#: Bytes that the ids of parts of texts may take in a Python worker, about.
PART_BYTES = 192 << 20
#: Bytes of text whose parts are looked up together.
PART_SLICE = 1 << 21
#: What one part takes beside its own bytes and its ids: two objects and their slots.
_PART_OVERHEAD = 250

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " sequence_length long, tier int, step_group long"
)
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length")]
    + [("tier", pa.int32()), ("step_group", pa.int64())]
)

_SPECIAL = "<|endoftext|>"


#: White space beyond ASCII (Unicode's White_Space property).
_WIDE_SPACES = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_ANY_SPACE = SPACE.copy()
_ANY_SPACE[0x1C:0x20] = True
#: The byte-level alphabet: printable bytes stand for themselves, others follow from 256.
_ALPHABET = dict(zip([b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 255 and b != 173)], range(256, 324)))


class PartIds(dict):
    """Ids of the parts of texts, as little-endian bytes by the part's bytes.

    A part starts at a text's begin, at a space or at a line break.  The
    pre-tokenizer never joins characters across such a place, except where white
    space neighbours white space; those texts, and texts with the special
    token, are encoded whole.  Both ways give the tokenizer's ids.

    Parts are kept in two generations of half of ``PART_BYTES`` each: when the
    younger one is full it takes the place of the older one, so the parts in use
    stay.  A Python worker keeps its parts for the next partition, never more than that."""

    def __init__(self, path: str):
        super().__init__()
        self.older: dict[bytes, bytes] = {}
        self.held = 0
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task its core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def _whole(self, text: str) -> bytes:
        (got,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(got.ids, "<u4").tobytes()

    def __missing__(self, part: bytes) -> bytes:
        got = self.older.get(part)
        if got is None:
            got = self._encoded(part)
        self[part] = got
        self.held += len(part) + len(got) + _PART_OVERHEAD
        if self.held > PART_BYTES // 2:
            self.older, self.held = dict(self), 0
            self.clear()
        return got

    def _encoded(self, part: bytes) -> bytes:
        text = part.decode()
        if text[-1] in ".," and text[1:-1].isalpha():  # letters and a mark are pre-tokens of their own
            return self[part[:-1]] + self[part[-1:]]
        if text[0] in " " and text[1:].isalpha():  # one pre-token
            return array("I", [t.id for t in self.tokenizer.model.tokenize(part.decode("latin-1").translate(_ALPHABET))]).tobytes()
        return self._whole(text)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [np.zeros(0, "<u4")] * len(texts)
        parted = [i for i, t in enumerate(texts) if t and _SPECIAL not in t and (t.isascii() or not any(c in t for c in _WIDE_SPACES))]
        if parted:
            raw = [texts[i].encode() for i in parted]
            for a, b in slices([len(t) for t in raw], PART_SLICE):  # the arrays of parts take many times their bytes
                for i, got in zip(parted[a:b], self._by_parts(raw[a:b])):
                    out[i] = got
        for i in {i for i, t in enumerate(texts) if t and out[i] is not None and not len(out[i])} | {i for i in parted if out[i] is None}:
            out[i] = np.frombuffer(self._whole(texts[i]), "<u4")
        return out

    def _by_parts(self, texts: list[bytes]) -> list[np.ndarray | None]:
        """None for texts with neighbouring white space."""
        joined = b"".join(texts)
        data = np.frombuffer(joined, np.uint8)
        begins = np.cumsum([0, *map(len, texts)])
        cut = (data == 32) | (data == 10)
        space = _ANY_SPACE[data]
        near = np.flatnonzero(space[1:] & space[:-1])  # within a text, or else at its ends: encoded whole too
        cut[begins[:-1]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        _, at, part = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        keys = [joined[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        coded = list(map(self.__getitem__, keys))
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        pool, first = np.frombuffer(b"".join(coded), "<u4"), np.cumsum(sizes) - sizes
        n = sizes[part]
        done = np.cumsum(n)
        flat = pool[np.repeat(first[part] - (done - n), n) + np.arange(done[-1])]
        out: list = np.split(flat, done[np.searchsorted(starts, begins[1:-1]) - 1])
        for i in np.unique(np.searchsorted(begins, near, side="right") - 1):
            out[i] = None
        return out


_WORKER: dict[str, PartIds] = {}


def _worker_parts(path: str) -> PartIds:
    if path not in _WORKER:
        _WORKER[path] = PartIds(path)
    return _WORKER[path]


def pack_lengths(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """Pieces (document, start, length, sequence, offset) and the sequences' lengths."""
    longest = tiers[0]
    pieces: list[tuple[int, int, int, int, int]] = []
    filled: list[int] = []
    rest: list[tuple[int, int, int]] = []  # (length, document, start), ascending
    for d, n in enumerate(lengths):
        full = n // longest
        for k in range(full):
            pieces.append((d, k * longest, longest, len(filled), 0))
            filled.append(longest)
        if n % longest:
            rest.append((n % longest, d, full * longest))
    rest.sort()
    for low, window in zip([*tiers[1:], 0], tiers):
        while rest and rest[-1][0] > low:
            room, at, seq = window, 0, len(filled)
            while room and rest:
                k = bisect.bisect_right(rest, (room, len(lengths), 0)) - 1
                if k >= 0:
                    n, d, start = rest.pop(k)
                else:  # all are longer than the gap: cut the shortest
                    n, d, start = rest.pop(0)
                    bisect.insort(rest, (n - room, d, start + room))
                    n = room
                pieces.append((d, start, n, seq, at))
                at, room = at + n, room - n
            filled.append(at)
    # Only the last window can be short: close it at powers of two.
    if filled and filled[-1] not in tiers:
        seq, at = len(filled) - 1, filled.pop()
        last = [p for p in pieces if p[3] == seq]
        pieces = [p for p in pieces if p[3] != seq]
        ends, left = [], at
        for tier in tiers:
            if left >= tier:
                ends.append(tier)
                left -= tier
        if left:
            ends.append(left)
        pos = 0
        for size in ends:
            for d, start, n, _, offset in last:
                a, b = max(offset, pos), min(offset + n, pos + size)
                if a < b:
                    pieces.append((d, start + a - offset, b - a, len(filled), a - pos))
            filled.append(size)
            pos += size
    return pieces, filled


def step_groups(filled: list[int], tiers: tuple[int, ...] = TIERS, step_ids: int = STEP_IDS) -> list[int]:
    """A group for each sequence: longest first, dealt in snake order."""
    groups = max(1, round(sum(filled) / step_ids))
    out = [0] * len(filled)
    for rank, seq in enumerate(sorted(range(len(filled)), key=lambda s: (-filled[s], s))):
        lap, k = divmod(rank, groups)
        out[seq] = groups - 1 - k if lap % 2 else k
    return out


def pack(docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS, step_ids: int = STEP_IDS, end_id: int = END_ID, keep_parts: bool = True) -> DataFrame:
    """Pieces of all documents (``doc_id``, ``text``), one row each.

    A null or empty text is the end id alone.  Rows that repeat a doc_id are
    packed each on its own.  An empty table gives no rows.  Other columns are
    ignored.  ``sequence_id`` and ``step_group`` are unique over the table.  With
    ``keep_parts`` a Python worker keeps encoded parts for its next partition, which is
    faster; without, their memory is free for other stages when a partition ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _worker_parts(tokenizer_path)
        end = np.asarray([end_id], "<u4")
        first = TaskContext.get().partitionId() << 40
        groups = first
        for batch in batches:
            ids = batch.column("_doc_id").to_pylist()
            for a, _, texts in text_slices(batch, "_text", PACK_BYTES):
                coded = [np.append(x, end) for x in words.ids(texts)]
                pieces, filled = pack_lengths([len(x) for x in coded], tiers)
                group = step_groups(filled, tiers, step_ids)
                rows = [
                    (ids[a + d], start, n, zlib.crc32(coded[d][start : start + n]), len(coded[d]), first + seq, at, filled[seq], min(t for t in tiers if t >= filled[seq]), groups + group[seq])
                    for d, start, n, seq, at in pieces
                ]
                first += len(filled)
                groups += max(group, default=-1) + 1
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
        if not keep_parts:
            _WORKER.pop(tokenizer_path, None)

    return map_batches(docs.selectExpr("cast(doc_id as long) _doc_id", "cast(text as string) _text"), run, PIECES)

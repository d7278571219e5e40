"""Substring dedup over words, with difference-cover anchors.

A difference cover D modulo a period v holds, for any two positions i and j, a
shift d < v that brings both into the cover. Two equal windows of ``window`` words
therefore share an equal anchor, a run of window - v + 1 words that starts at a
cover position of either document at the same distance from the window's start.

1. Only the anchors are hashed and compared between blocks (|D|/v of the
   positions, 5 of 21 for windows of 35 words).
2. Each anchor that occurs twice is extended: the windows that hold it at a
   distance below v are hashed in full (96 bits) and compared between blocks.
3. Every word of a window that occurs twice goes.

Defined results: null, empty and blank texts have no words and keep the SHA-256 of
nothing; rows that repeat are documents like any other, so all their windows are
repeated; documents shorter than a window lose words only to nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.llm.blocks import answers, as_table, by_shard, dealt, met_elsewhere, mixed, ordered, rolling, shard_rows
from talentlake.llm.common import parts, prepare, text_size

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SENT = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("low", pa.binary()), ("high", pa.binary())])
SENT_SQL = "shard int, block int, low binary, high binary"
REPLY_SQL = "block int, shard int, answer binary"


def difference_cover(period: int) -> tuple[int, ...]:
    """The first smallest set whose differences give every residue of ``period``."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError("period must be positive")


class Words:
    """Hashes of the words of a block's documents, one after the other."""

    def __init__(self, texts: list[bytes]):
        each = []
        for t in texts:
            w = t.split()
            each.append(np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)))
        self.n = np.array([len(x) for x in each], np.int64)
        self.ends = np.cumsum(self.n)
        self.begins = self.ends - self.n
        self.h = np.concatenate(each) if each else np.zeros(0, np.uint64)
        self.at = np.arange(len(self.h)) - np.repeat(self.begins, self.n)  # position in the document
        self.left = np.repeat(self.n, self.n) - self.at  # words from here to the document's end

    def anchors(self, length: int, period: int, cover: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the runs of ``length`` words at cover positions."""
        p = np.flatnonzero(np.isin(self.at % period, cover) & (self.left >= length))
        return p, mixed(rolling(self.h, length, BASES[0])[p])

    def around(self, anchors: np.ndarray, window: int, period: int) -> np.ndarray:
        """Starts of the windows that hold one of the anchors at a distance below ``period``."""
        mark = np.zeros(len(self.h) + 1, np.int64)
        np.add.at(mark, np.maximum(anchors - period + 1, anchors - self.at[anchors]), 1)
        np.add.at(mark, anchors + 1, -1)
        return np.flatnonzero((np.cumsum(mark[:-1]) > 0) & (self.left >= window))

    def windows(self, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        return (mixed(rolling(self.h, window, b)[starts]) for b in BASES)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, index of their first, index into them, how often."""
    return np.unique(keys, return_index=True, return_inverse=True, return_counts=True)


def remove_repeats(docs: DataFrame, window: int = 35, period: int = 21, block_bytes: int = 4 << 20, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row, and with ``keep_text``
    also ``kept``: the words that stay, joined by one space."""
    if not 0 < period <= window:
        raise ValueError("the period is at least 1 and at most the window")
    prepare(docs.sparkSession)
    length, cover = window - period + 1, difference_cover(period)
    _, total = text_size(docs)
    blocks, shards = parts(total, block_bytes), parts(total, 2 * block_bytes)
    rows = dealt(docs, blocks)

    def candidates(w: Words, anchored: Callable) -> tuple:
        """Starts of the windows round a repeated anchor, and their hashes."""
        p, keys = w.anchors(length, period, cover)
        u, _, inv, n = distinct(keys)
        order, cuts = by_shard(u, shards)
        dup = (anchored(order) | (n > 1))[inv]
        return w.around(p[dup], window, period)

    def ask_anchors(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        w = Words(ordered(table).column("text").to_pylist())
        _, keys = w.anchors(length, period, cover)
        u = np.unique(keys)
        order, cuts = by_shard(u, shards)
        # beside the shard, 32 bits do: a chance meeting only adds windows that are then compared in full
        return as_table(list(shard_rows(block, order, cuts, {"low": u.astype(np.uint32)})), SENT)

    def ask_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return as_table([], SENT)
        block = left.column("block")[0].as_py()
        w = Words(ordered(left).column("text").to_pylist())
        replies = list(zip(right.column("shard").to_pylist(), right.column("answer").to_pylist()))
        starts = candidates(w, lambda order: answers(replies, order, np.uint8).astype(bool))
        low, high = w.windows(starts, window)
        u, first, _, _ = distinct(low)
        order, cuts = by_shard(u, shards)
        out = list(shard_rows(block, order, cuts, {"low": u, "high": high[first].astype(np.uint32)}))
        bits = np.zeros(len(w.h), bool)
        bits[starts] = True
        # which windows were asked about comes back to the block through a shard of its own
        out.append({"shard": shards + block, "block": block, "low": np.packbits(bits).tobytes(), "high": None})
        return as_table(out, SENT)

    both = met_elsewhere({"low": np.uint64, "high": np.uint32})

    def windows_met(table: pa.Table) -> pa.Table:
        if table.column("shard")[0].as_py() >= shards:
            return pa.table({"block": table.column("block"), "shard": table.column("shard"), "answer": table.column("low")})
        return both(table)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"][: 4 + keep_text]

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        left = ordered(left)
        texts = left.column("text").to_pylist()
        w = Words(texts)
        replies = dict(zip(right.column("shard").to_pylist(), right.column("answer").to_pylist()))
        gone = np.zeros(len(w.h) + 1, np.int64)
        block = left.column("block")[0].as_py() if left.num_rows else 0
        if (asked := replies.pop(shards + block, None)) is not None and len(w.h):
            starts = np.flatnonzero(np.unpackbits(np.frombuffer(asked, np.uint8), count=len(w.h)))
            if len(starts):
                low, _ = w.windows(starts, window)
                u, _, inv, n = distinct(low)
                order, _ = by_shard(u, shards)
                s = starts[(answers(list(replies.items()), order, np.uint8).astype(bool) | (n > 1))[inv]]
                np.add.at(gone, s, 1)
                np.add.at(gone, s + window, -1)
        gone = np.cumsum(gone[:-1]) > 0
        out = []
        for i, (doc_id, text) in enumerate(zip(left.column("doc_id").to_pylist(), texts)):
            words, out_here = text.split(), gone[w.begins[i] : w.ends[i]]
            n = int(out_here.sum())
            kept = b" ".join(words if not n else [x for x, g in zip(words, out_here.tolist()) if not g])
            out.append((doc_id, len(words), n, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace"))[: len(names)])
        cols = list(zip(*out)) or [[] for _ in names]
        return pa.table(dict(zip(names, cols)), schema=pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]))))

    anchored = rows.groupBy("block").applyInArrow(ask_anchors, SENT_SQL).groupBy("shard").applyInArrow(met_elsewhere({"low": np.uint32}), REPLY_SQL)
    asked = rows.groupBy("block").cogroup(anchored.groupBy("block")).applyInArrow(ask_windows, SENT_SQL)
    met = asked.groupBy("shard").applyInArrow(windows_met, REPLY_SQL)
    return rows.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(judge, schema)

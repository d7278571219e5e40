"""Suffix-array dedup over bytes by column-wise construction.

A collection Burrows-Wheeler transform with its common prefixes is built one
column at a time: each round puts one more symbol in front of every piece, takes
the new order from the symbols of the transform so far (its LF mapping), and
lengthens the common prefix of neighbours by one beyond the least common prefix
between their tails. As only matches of ``span`` bytes count, prefixes are followed
to that depth and the pieces are short, so a round is a few sequential passes and
there are as many rounds as a piece has bytes, not as the longest document has.

How whole documents come to such pieces, without a task that sees them all:

1. Every window of ``span`` bytes names the ``seed``-byte string in it with the least
   hash (the leftmost of equals). Windows that follow one another and name the same
   occurrence form a piece. Equal windows name equal strings, at the same distance.
2. Blocks of documents ask of all others which of their seeds occur elsewhere.
   A window whose seed occurs once cannot occur twice.
3. Pieces of repeated seeds meet in the shard of the seed, each distinct piece once
   for a block with its least doc_id. There the transform is built, and windows
   with a common prefix of ``span`` bytes get the least doc_id of their run.
   The pieces of a seed that occurs very often are cut into single windows, dealt by
   their own hashes, so that no seed fills a shard.
4. A window goes where that is less than its own document's.

The method's external files are arrays here: a run's pieces are bounded, and files
on an executor's own disk are not to be had on a cluster.

Defined results: null and empty texts have 0 bytes and no spans; rows that repeat a
doc_id with its text don't remove each other (neither id is smaller); a null doc_id
counts as larger than any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from talentlake.llm.blocks import MASK64, answers, as_table, by_shard, dealt, met_elsewhere, mixed, ordered, rolling, shard_rows
from talentlake.llm.common import parts, prepare, text_size

BASE = 0x9E3779B97F4A7C15
LAST = np.iinfo(np.int64).max  # stands for a null doc_id
SLICE = 1 << 17  # bytes hashed at once; fits the cache
RUN = 1 << 17  # symbols of a run of the construction (fits the cache), more only for one seed's pieces
HOT = 1 << 14  # occurrences from which a seed's pieces are cut into windows
END = 0xFF  # not a byte of UTF-8
ASK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("low", pa.binary()), ("often", pa.binary())])
ASK_SQL = "shard int, block int, low binary, often binary"
PIECES = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("at", pa.binary()), ("size", pa.binary()), ("least", pa.binary()), ("bytes", pa.binary())])
PIECES_SQL = "shard int, block int, at binary, size binary, least binary, bytes binary"
REPLY_SQL = "block int, shard int, answer binary"


def byte_values() -> np.ndarray:
    """A fixed 64-bit value for each byte, for the rolling hash."""
    return np.array([(i * BASE ^ (i * 0xC2B2AE3D27D4EB4F >> 7)) & MASK64 for i in range(1, 257)], np.uint64)


def slices(sizes: list[int], span: int) -> Iterator[tuple[int, int, int]]:
    """(first document, end document, start) of what is hashed together: whole short
    documents, or a part of a long one with the first bytes of the next part."""
    i = 0
    while i < len(sizes):
        if sizes[i] > SLICE:
            for start in range(0, max(1, sizes[i] - span + 1), SLICE):
                yield i, i + 1, start
            i += 1
            continue
        j, total = i, 0
        while j < len(sizes) and total + sizes[j] <= SLICE:
            total += sizes[j]
            j += 1
        yield i, j, 0
        i = j


class Pieces:
    """The pieces of a block's documents, as arrays: document, first window start,
    number of windows, distance of the seed from the first window, seed's hash."""

    def __init__(self, texts: list[bytes], span: int, seed: int):
        values, parts_ = byte_values(), []
        w, bits = span - seed + 1, SLICE.bit_length() + 1
        place = np.uint64((1 << bits) - 1)
        sizes = [len(t) for t in texts]
        for i, j, start in slices(sizes, span):
            part = texts[i:j] if j > i + 1 or sizes[i] <= SLICE else [texts[i][start : start + SLICE + span - 1]]
            n = np.array([len(t) for t in part], np.int64)
            b = np.frombuffer(b"".join(part), np.uint8)
            if len(b) < span:
                continue
            h = mixed(rolling(values[b], seed, BASE))
            low = (h & ~place) | np.arange(len(h), dtype=np.uint64)
            size = 1
            while size * 2 <= w:
                low = np.minimum(low[:-size], low[size:])
                size *= 2
            if size < w:
                low = np.minimum(low[: len(low) - (w - size)], low[w - size :])
            seat = (low & place).astype(np.int64)
            ends = np.cumsum(n)
            doc = np.repeat(np.arange(len(part)), n)
            s = np.flatnonzero(np.arange(len(b)) + span <= ends[doc])
            if not len(s):
                continue
            cut = np.flatnonzero(np.r_[True, (seat[s[1:]] != seat[s[:-1]]) | (s[1:] != s[:-1] + 1)])
            first, count = s[cut], np.diff(np.r_[cut, len(s)])
            d = doc[first]
            parts_.append((d + i, first - (ends - n)[d] + start, count, seat[first] - first, h[seat[first]]))
        kinds = (np.int64, np.int64, np.int64, np.int64, np.uint64)
        self.doc, self.first, self.count, self.at, self.key = (np.concatenate([p[k] for p in parts_]) if parts_ else np.zeros(0, kind) for k, kind in enumerate(kinds))

    def take(self, chosen: np.ndarray, hot: np.ndarray, texts: list[bytes], span: int) -> None:
        """Keeps the chosen pieces, those of hot seeds as single windows dealt by their own hash."""
        hot = hot[chosen]
        times = np.where(hot, self.count[chosen], 1)
        k = np.repeat(chosen, times)
        shift = np.arange(len(k)) - np.repeat(np.cumsum(times) - times, times)
        single = np.repeat(hot, times)
        self.doc, self.first, self.at, self.key = self.doc[k], self.first[k] + shift, self.at[k] - shift, self.key[k]
        self.count = np.where(single, 1, self.count[k])
        for i in np.flatnonzero(single).tolist():
            a = self.first[i]
            self.key[i] = xxhash.xxh3_64_intdigest(texts[self.doc[i]][a : a + span])

    def collapsed(self, texts: list[bytes], ids: np.ndarray, span: int) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pieces: index of each into them, their bytes, seed distances, hashes
        and least ids. A piece is told by its bytes and its seed's place."""
        seen: dict[tuple[bytes, int], int] = {}
        which = np.empty(len(self.doc), np.int64)
        put = seen.setdefault
        for k, (d, a, c, at) in enumerate(zip(self.doc.tolist(), self.first.tolist(), self.count.tolist(), self.at.tolist())):
            which[k] = put((texts[d][a : a + c + span - 1], at), len(seen))
        least = np.full(len(seen), LAST)
        np.minimum.at(least, which, ids[self.doc])
        key = np.zeros(len(seen), np.uint64)
        key[which] = self.key
        return which, [x[0] for x in seen], np.array([x[1] for x in seen], np.uint8), key, least


def least_in_ranges(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(x[a:b]) for each pair with a < b, by minima over powers of two."""
    width = b - a
    power = np.frexp(width.astype(np.float64))[1] - 1
    out = np.empty(len(a), x.dtype)
    table, size = x, 1
    for k in range(int(power.max(initial=0)) + 1):
        if k:
            table = np.minimum(table[:-size], table[size:])
            size *= 2
        q = np.flatnonzero(power == k)
        if len(q):
            out[q] = np.minimum(table[a[q]], table[b[q] - size])
    return out


def column_wise(pieces: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted suffixes of all pieces as positions in the joined text, the common
    prefix of each with the one before (followed to ``depth``, equal pieces told
    apart at their ends), and the begin of each piece in that text."""
    text = np.frombuffer(b"\xff" + b"".join(p + b"\xff" for p in pieces), np.uint8)
    n = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(n + 1)
    suffix = ends.astype(np.int32)  # round 0: the empty suffix of each piece
    common = np.zeros(len(pieces), np.uint8)
    fresh = np.ones(len(pieces), bool)  # what the last round put in
    m, closed = len(pieces), suffix
    for _ in range(int(n.max(initial=0))):
        before = text[suffix - 1]  # the transform so far
        order = np.argsort(before, kind="stable")
        order = order[: len(order) - np.count_nonzero(before == END)]
        put = np.concatenate([np.zeros(m, bool), fresh[order]])
        grown = np.zeros(len(put), np.uint8)
        grown[~put] = common  # what was there keeps its order and, but for new neighbours, its common prefix
        # new suffixes and those that follow one
        at = np.flatnonzero(put[1:] | put[:-1]) + 1
        at = at[at > m] - m
        here, last = order[at], order[at - 1]
        same = before[here] == before[last]
        grown[m + at] = 0
        here, last = here[same], last[same]
        if len(here):
            grown[m + at[same]] = np.minimum(least_in_ranges(common, last + 1, here + 1), depth - 1) + 1
        suffix = np.concatenate([closed, suffix[order] - 1])
        common, fresh = grown, put
    return suffix, common, ends - n


def window_owners(pieces: list[bytes], least: np.ndarray, span: int) -> list[np.ndarray]:
    """For each piece and each of its windows, the least id of any piece that has it."""
    suffix, common, begins = column_wise(pieces, span)
    piece = np.searchsorted(begins, suffix, "right") - 1
    at = suffix - begins[piece]
    n = np.array([len(p) for p in pieces], np.int64)
    run = np.cumsum(common < span)  # neighbours with a common prefix of span bytes share a run
    whole = np.flatnonzero((piece >= 0) & (n[piece] - at >= span))
    owner = np.full(run[-1] + 1, LAST)
    np.minimum.at(owner, run[whole], least[piece[whole]])
    flat = np.full(int((n - span + 1).sum()), LAST)
    base = np.cumsum(n - span + 1) - (n - span + 1)
    flat[base[piece[whole]] + at[whole]] = owner[run[whole]]
    return np.split(flat, base[1:])


def seeds_met(table: pa.Table, hot: int) -> pa.Table:
    """Shard function: for each seed of each block 1 if another block has it too, 2 if it
    occurs ``hot`` times or more by the blocks' counts (each within a factor of two)."""
    out = met_elsewhere({"low": np.uint32})(table)
    low = [np.frombuffer(b, np.uint32) for b in table.column("low").to_pylist()]
    often = np.concatenate([np.frombuffer(b, np.uint8) for b in table.column("often").to_pylist()])
    u, inv = np.unique(np.concatenate(low), return_inverse=True)
    many = (np.bincount(inv, 2.0**often, len(u)) >= hot)[inv]
    met = np.concatenate([np.frombuffer(b, np.uint8) for b in out.column("answer").to_pylist()])
    answer = np.where(many, 2, met).astype(np.uint8)
    ends = np.cumsum([0, *map(len, low)])
    return out.set_column(2, "answer", pa.array([answer[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()))


def related(members: list[int], pieces: list[tuple[bytes, int]], span: int, seed: int) -> list[int]:
    """Pieces that may share a window with another of the same seed: a window reaches at
    least half of what it has beside the seed to one side, so they agree there."""
    half = (span - seed + 1) // 2
    met: dict[tuple[bool, bytes], int] = {}
    twice = set()
    for k in members:
        data, at = pieces[k]
        sides = [(True, data[at : at + seed + half])] if len(data) >= at + seed + half else []
        if at >= half:
            sides.append((False, data[at - half : at + seed]))
        for side in sides:
            if (other := met.setdefault(side, k)) != k:
                twice.add(other)
                twice.add(k)
    return [k for k in members if k in twice]


def settle(table: pa.Table, span: int, seed: int) -> pa.Table:
    """Shard function: for each piece of each block a bit for each window that some
    document with a smaller id than the block's least for the piece holds too."""
    blocks = table.column("block").to_pylist()
    entries, groups, pieces, ids = [], {}, {}, []
    for at, size, least, data in zip(*(table.column(c).to_pylist() for c in ("at", "size", "least", "bytes"))):
        size = np.frombuffer(size, np.uint8)
        ends = np.cumsum(size, dtype=np.int64).tolist()
        row, begin = [], 0
        for end, a, low in zip(ends, at, np.frombuffer(least, np.int64).tolist()):
            p = (data[begin:end], a)
            begin = end
            k = pieces.setdefault(p, len(pieces))
            if k == len(ids):
                ids.append(low)
                groups.setdefault(p[0][a : a + seed], []).append(k)
            elif low < ids[k]:
                ids[k] = low
            row.append(k)
        entries.append((np.array(row, np.int64), np.frombuffer(least, np.int64)))
    pieces_at = list(pieces)
    texts, ids = [p[0] for p in pieces_at], np.array(ids, np.int64)
    shared = np.zeros(len(texts), np.uint32)  # windows that a smaller id holds in another piece
    run: list[int] = []

    def build() -> None:
        for k, owner in zip(run, window_owners([texts[k] for k in run], ids[run], span)):
            shared[k] = int((1 << np.flatnonzero(owner < ids[k])).sum())
        run.clear()

    size = 0
    for members in groups.values():
        # pieces of one window are unlike each other; only longer ones share windows
        several = len(members) > 1 and any(len(texts[k]) > span for k in members)
        members = related(members, pieces_at, span, seed) if several else []
        if len(members) > 1:
            more = sum(len(texts[k]) for k in members)
            if run and size + more > RUN:
                build()
                size = 0
            run += members
            size += more
    if run:
        build()
    every = np.array([(1 << (len(t) - span + 1)) - 1 for t in texts], np.uint32)
    out = [np.where(low > ids[k], every[k], shared[k]).astype(np.uint32).tobytes() for k, low in entries]
    return pa.table({"block": table.column("block"), "shard": table.column("shard"), "answer": pa.array(out, pa.binary())})


def remove_later_copies(docs: DataFrame, span: int = 50, seed: int = 20, block_bytes: int = 4 << 20, keep_text: bool = False, carry: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row, and with
    ``keep_text`` also ``kept``: what stays, without the rests of characters that
    lost a byte. carry: further columns of the row to return, by name."""
    if not 0 < span - seed + 1 <= 32:
        raise ValueError("a piece holds at most 32 windows: seed is at least span - 31")
    prepare(docs.sparkSession)
    _, total = text_size(docs)
    blocks, shards = parts(total, block_bytes), parts(total, 2 * block_bytes)
    rows = dealt(docs, blocks, carry)
    carried, hot_from = rows.schema.fields[4:], HOT

    carry_names, carried_names = list(carry or {}), [f.name for f in carried]

    def load(table: pa.Table) -> tuple[list[bytes], np.ndarray, Pieces]:
        table = ordered(table)
        texts = table.column("text").to_pylist()
        ids = np.array([LAST if i is None else i for i in table.column("doc_id").to_pylist()], np.int64)
        return texts, ids, Pieces(texts, span, seed)

    def ask_seeds(table: pa.Table) -> pa.Table:
        _, _, p = load(table)
        u, n = np.unique(p.key, return_counts=True)
        order, cuts = by_shard(u, shards)
        # beside the shard, 32 bits do: a chance meeting only adds pieces that are then compared
        columns = {"low": u.astype(np.uint32), "often": np.log2(n).astype(np.uint8)}
        return as_table(list(shard_rows(table.column("block")[0].as_py(), order, cuts, columns)), ASK)

    def ask_pieces(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, ids, p = load(left)
        block = left.column("block")[0].as_py()
        u, inv, n = np.unique(p.key, return_inverse=True, return_counts=True)
        reply = answers(list(zip(right.column("shard").to_pylist(), right.column("answer").to_pylist())), by_shard(u, shards)[0], np.uint8)
        twice, hot = ((reply > 0) | (n > 1))[inv], (reply > 1)[inv]
        p.take(np.flatnonzero(twice), hot, texts, span)
        _, held, at, key, least = p.collapsed(texts, ids, span)
        order, cuts = by_shard(key, shards)
        out = []
        for s, a, b in cuts:
            k = order[a:b]
            data = [held[x] for x in k.tolist()]
            out.append({"shard": s, "block": block, "at": at[k].tobytes(), "size": bytes(map(len, data)), "least": least[k].tobytes(), "bytes": b"".join(data)})
        # which pieces were asked about, and how, comes back to the block through a shard of its own
        out.append({"shard": shards + block, "block": block, "bytes": np.packbits(np.r_[twice, hot]).tobytes()})
        return as_table(out, PIECES)

    def settle_shard(table: pa.Table) -> pa.Table:
        if table.column("shard")[0].as_py() >= shards:
            return pa.table({"block": table.column("block"), "shard": table.column("shard"), "answer": table.column("bytes")})
        return settle(table, span, seed)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + keep_text]
    schema = T.StructType([T.StructField(n, T.StringType() if n.startswith("kept") else T.LongType()) for n in names] + [T.StructField(n, f.dataType) for n, f in zip(carry or {}, carried)])
    kinds = [pa.int64()] * 4 + [pa.string()] * 2

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, ids, p = load(left)
        replies = dict(zip(right.column("shard").to_pylist(), right.column("answer").to_pylist()))
        block = left.column("block")[0].as_py()
        asked = replies.pop(shards + block)
        bits = np.unpackbits(np.frombuffer(asked, np.uint8), count=2 * len(p.key)).astype(bool)
        twice, hot = bits[: len(p.key)], bits[len(p.key) :]
        p.take(np.flatnonzero(twice), hot, texts, span)
        which, held, _, key, least = p.collapsed(texts, ids, span)
        order, _ = by_shard(key, shards)
        own = answers(list(replies.items()), order, np.uint32)
        every = np.array([(1 << (len(t) - span + 1)) - 1 for t in held], np.uint32)
        bits = np.where(ids[p.doc] > least[which], every[which], own[which]) if len(held) else np.zeros(0, np.uint32)
        # gone windows as document and start
        hit = ((bits[:, None] >> np.arange(32, dtype=np.uint32)) & 1).astype(bool)
        row, shift = np.nonzero(hit)
        doc, start = p.doc[row], p.first[row] + shift
        order = np.lexsort((start, doc))
        doc, start = doc[order], start[order]
        bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
        out = []
        for i, (doc_id, text) in enumerate(zip(ordered(left).column("doc_id").to_pylist(), texts)):
            s = start[bounds[i] : bounds[i + 1]]
            cut = np.flatnonzero(np.diff(s) > span) + 1
            begins = s[np.r_[0, cut]].tolist() if len(s) else []
            ends = (s[np.r_[cut - 1, len(s) - 1]] + span).tolist() if len(s) else []
            kept = b"".join(text[a:b] for a, b in zip([0, *ends], [*begins, len(text)]))
            out.append((doc_id, len(text), len(text) - len(kept), len(begins), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore"))[: len(names)])
        cols = list(zip(*out)) or [[] for _ in names]
        made = pa.table(dict(zip(names, cols)), schema=pa.schema(list(zip(names, kinds))))
        for name, f in zip(carry_names, carried_names):
            made = made.append_column(name, ordered(left).column(f))
        return made

    seeds = rows.groupBy("block").applyInArrow(ask_seeds, ASK_SQL).groupBy("shard").applyInArrow(lambda t: seeds_met(t, hot_from), REPLY_SQL)
    pieces = rows.groupBy("block").cogroup(seeds.groupBy("block")).applyInArrow(ask_pieces, PIECES_SQL)
    settled = pieces.groupBy("shard").applyInArrow(settle_shard, REPLY_SQL)
    return rows.groupBy("block").cogroup(settled.groupBy("block")).applyInArrow(judge, schema)

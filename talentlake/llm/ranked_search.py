"""Ranked lexical search over bit-sliced Bloom signatures.

1. Index, the same for all queries. A row's signature is a Bloom filter of its terms, each
   entered once for every power of two that its count in the row reaches (level j: 2^j times
   or more). Rows whose signatures have one width, a power of two that fits the number of
   entries, are dealt to blocks by a row's own number, and a block stores its signatures bit
   by bit: a slice is one bit of all the block's rows. The index is a table in the shared folder.
2. Items are asked in groups of about ``GROUP_BYTES`` of text (one, as a rule). One pass over
   the texts counts the rows that hold each of the group's terms, which gives the weights.
3. Upper bounds. The slices of a term's bits, ANDed, are the rows that may hold it: all that
   do and a few more. Level by level, a bound on the term's count and with it on its part of
   the score follows; weighted sums of the slices bound the score of every row.
4. Each block names the rows of an item's highest bounds, and the best of these are scored
   from their whole texts. The k-th exact score is a floor: whatever row has a bound below
   it is excluded for certain. All other rows are scored exactly, and ranked.

Terms are compared as strings in exact scoring, and exact scores come from each row's own
text, so chance meetings of hashes only add rows to score. No row is left out unless proven.

Defined results: null and termless texts have no terms and are never returned; items without
terms give no rows; rows that repeat are ranked each, as are items that repeat an item_id;
equal scores go by ascending doc_id, a null doc_id last; an empty table gives no rows. An item
is held in memory whole, and a group's terms too.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from talentlake.llm.blocks import mixed
from talentlake.llm.common import forget, prepare, row_key, written

# letters and digits of ASCII, A-Z lower-cased, and all bytes of other characters; the rest parts terms
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
BITS, HASHES = 8, 3  # of a signature for each entry, at least; positions of an entry
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 4096
GROUP_BYTES = 16 << 20
FLOOR_ROWS = 2  # times k: how many of the highest bounds are scored to find the floor
SMALL = 200_000  # pairs of item and row up to which they are broadcast, after counting them

SIGNATURES = "key long, n long, width long, bits binary"
INDEX = "rows int, width long, keys binary, n binary, slices binary"


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def entries(hashes: np.ndarray, level: int) -> np.ndarray:
    return mixed(hashes + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))


def positions(entry: np.ndarray, width: int) -> list[np.ndarray]:
    """The bits of an entry, by double hashing."""
    a, b = entry & np.uint64(0xFFFFFFFF), entry >> np.uint64(32) | np.uint64(1)
    return [((a + np.uint64(i) * b) & np.uint64(width - 1)).astype(np.int64) for i in range(HASHES)]


def signature(counts: Counter) -> tuple[int, bytes]:
    """(width in bits, bits) of a row's terms with their counts."""
    h, n = np.array([xxhash.xxh3_64_intdigest(t) for t in counts], np.uint64), np.array(list(counts.values()), np.int64)
    each = [entries(h[n >= 1 << j], j) for j in range(int(n.max()).bit_length())]
    entry = np.concatenate(each)
    width = max(64, 1 << (len(entry) * BITS - 1).bit_length())
    bits = np.zeros(width, bool)
    for at in positions(entry, width):
        bits[at] = True
    return width, np.packbits(bits, bitorder="little").tobytes()


def build(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """The index, the rows with a term, and the terms of all rows."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, text in zip(b.column("key").to_pylist(), b.column("text").to_pylist()):
                if counts := Counter(terms(text)):
                    out.append((key, counts.total(), *signature(counts)))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["key", "n", "width", "bits"])

    def slice_bits(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        width, rows = table.column("width")[0].as_py(), table.num_rows
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(rows, width // 8)
        # a few columns of bytes at a time: eight slices of each
        step = max(1, (1 << 22) // rows)
        slices = [np.packbits(np.unpackbits(bits[:, a : a + step], axis=1, bitorder="little").T, axis=1, bitorder="little").tobytes() for a in range(0, width // 8, step)]
        longs = lambda c: [np.asarray(table.column(c).combine_chunks(), np.int64).tobytes()]
        return pa.table({"rows": pa.array([rows], pa.int32()), "width": pa.array([width], pa.int64()), "keys": longs("key"), "n": longs("n"), "slices": [b"".join(slices)]})

    texts = docs.where(F.col("text").isNotNull()).select(row_key().alias("key"), F.col("text").cast("binary").alias("text"))
    signed = written(texts.mapInArrow(sign, SIGNATURES))
    sizes = signed.groupBy("width").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("terms")).collect()
    if not sizes:
        return signed, 0, 0
    held = lambda width: max(8, min(BLOCK_ROWS, BLOCK_BYTES * 8 // width))
    blocks = F.create_map(*[F.lit(x) for r in sizes for x in (r["width"], -(-r["rows"] // held(r["width"])))])
    # by the row's number, not its key, as equal rows would all meet in one block
    dealt = signed.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), blocks[F.col("width")]))
    index = written(dealt.groupBy("width", "block").applyInArrow(slice_bits, INDEX))
    forget(signed)
    return index, sum(r["rows"] for r in sizes), sum(r["terms"] for r in sizes)


def part(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of the score for each unit of its weight."""
    return 1_000_000_000 * count // (1000 * count + 8 * m)


class Group:
    """Items asked together: their terms, and a weight for each."""

    def __init__(self, items: list[tuple[int, bytes]], n: int, total: int):
        self.n, self.total = n, total
        self.items = {i: Counter(terms(t)) for i, t in items}
        self.vocabulary = {t: k for k, t in enumerate(sorted({t for c in self.items.values() for t in c}))}
        self.weights: list[int] = []

    def weigh(self, held: dict[int, int]) -> None:
        """held: by term, the rows that hold it."""
        self.weights = [math.floor(1000 * math.log((2 * self.n + 2) / (2 * held.get(k, 0) + 1))) for k in range(len(self.vocabulary))]

    def length(self, n: int) -> int:
        return 100 - 75 + 75 * n * self.n // self.total

    def score(self, item: int, counts: Counter, n: int) -> int:
        m = self.length(n)
        return sum(q * self.weights[self.vocabulary[t]] * (1_000_000_000 * c // (1000 * c + 8 * m)) for t, q in self.items[item].items() if (c := counts.get(t)))

    def bounds(self) -> Callable[[dict], Iterator[tuple[int, np.ndarray]]]:
        """For a block, each item with the upper bounds of all the block's rows."""
        hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in self.vocabulary], np.uint64)
        asked = [(i, np.array([self.vocabulary[t] for t in c], np.int64), np.array([q * self.weights[self.vocabulary[t]] for t, q in c.items()], np.float64)) for i, c in self.items.items()]

        def run(block: dict) -> Iterator[tuple[int, np.ndarray]]:
            rows, width = block["rows"], block["width"]
            slices = np.frombuffer(block["slices"], np.uint8).reshape(width, -1)
            n = np.frombuffer(block["n"], np.int64)
            m = np.array([self.length(x) for x in n.tolist()], np.int64)
            levels, there, below = [], None, np.zeros(rows, np.int64)
            while True:
                at = positions(entries(hashes, len(levels)), width)
                may = slices[at[0]]
                for x in at[1:]:
                    may &= slices[x]
                if there is not None:
                    may &= there
                some = may.any(axis=1)
                if not some.any():
                    break
                # a row without the next level holds the term fewer times than that
                upper = part(np.minimum((2 << len(levels)) - 1, n), m)
                levels.append((may, some, upper - below))
                there, below = may, upper
            for item, at, weight in asked:
                bound = np.zeros(rows, np.int64)
                for may, some, more in levels:
                    if not (alive := some[at]).any():
                        break
                    bits = np.unpackbits(may[at[alive]], axis=1, count=rows, bitorder="little")
                    bound += (weight[alive] @ bits).astype(np.int64) * more
                yield item, bound

        return run


def holders(docs: DataFrame, group, n_terms: int) -> dict[int, int]:
    """By term of the group, the rows that hold it: a count over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = group.value.vocabulary
        held, wanted = np.zeros(n_terms, np.int64), set(vocabulary)
        for b in batches:
            for text in b.column("text").to_pylist():
                held[[vocabulary[t] for t in wanted.intersection(terms(text))]] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["term", "held"])

    found = docs.where(F.col("text").isNotNull()).select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "term long, held long")
    return {r["term"]: r["held"] for r in found.groupBy("term").agg(F.sum("held").alias("held")).collect()}


def bounded(index: DataFrame, group, floors: dict[int, int] | None, k: int) -> DataFrame:
    """(item, key, bound): all rows that the floors do not exclude; without floors, each block's ``k`` highest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = group.value.bounds()
        for batch in batches:
            for block in pa.Table.from_batches([batch]).to_pylist():
                keys = np.frombuffer(block["keys"], np.int64)
                for item, bound in bounds(block):
                    at = np.flatnonzero(bound >= (floors[item] if floors else 1))
                    if not floors and len(at) > k:
                        at = at[np.argpartition(-bound[at], k - 1)[:k]]
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), item, np.int64)), pa.array(keys[at]), pa.array(bound[at])], ["item", "key", "bound"])

    return index.mapInArrow(run, "item long, key long, bound long")


def scored(docs: DataFrame, pairs: DataFrame, group) -> DataFrame:
    """(item, doc_id, score): the exact scores of the rows of each pair (item, key)."""
    pairs = written(pairs.select("item", "key").distinct())
    wanted = pairs.groupBy("key").agg(F.collect_list("item").alias("items"))
    if pairs.count() <= SMALL:
        wanted = F.broadcast(wanted)
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text", row_key().alias("key")).join(wanted, "key").select("doc_id", F.col("text").cast("binary").alias("text"), "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items, scores, at = [], [], []
            for i, (text, asked) in enumerate(zip(b.column("text").to_pylist(), b.column("items").to_pylist())):
                counts = Counter(terms(text))
                n = counts.total()
                for item in asked if n else ():
                    if s := group.value.score(item, counts, n):
                        items.append(item)
                        scores.append(s)
                        at.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), b.column("doc_id").take(pa.array(at, pa.int64())), pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    return rows.mapInArrow(run, f"item long, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring rows of each item, scores above 0."""
    spark = prepare(docs.sparkSession)
    index, n, total = build(docs)
    asked = written(items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")))
    groups = max(1, -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // GROUP_BYTES))
    best = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = None
    for g in range(groups):
        group = Group([(r["item"], bytes(r["text"])) for r in asked.where(F.pmod("item", F.lit(groups)) == g).collect()], n, total)
        if n:
            group.weigh(holders(docs, spark.sparkContext.broadcast(group), len(group.vocabulary)))
        sent = spark.sparkContext.broadcast(group)
        if n:
            high = bounded(index, sent, None, k * FLOOR_ROWS).withColumn("i", F.row_number().over(W.partitionBy("item").orderBy(F.desc("bound"), "key"))).where(F.col("i") <= k * FLOOR_ROWS)
            first = scored(docs, high, sent).withColumn("i", F.row_number().over(best)).where(F.col("i") == k)
            floors = dict.fromkeys(group.items, 1) | {r["item"]: r["score"] for r in first.collect()}
            pairs = bounded(index, sent, floors, k)
        else:
            pairs = spark.createDataFrame([], "item long, key long")
        found = scored(docs, pairs, sent).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        top = found if top is None else top.unionByName(found)
    return top.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

"""Questions that blocks of documents ask of all other blocks.

Documents are dealt to blocks of a bounded size by their row key. A block sends
each of its distinct keys once to the shard of that key, and the shard answers for
each key, in the order in which it came. Keys therefore travel without owner or
position, a key that a third of all documents hold arrives once for each block,
and neither blocks nor shards outgrow a task: their numbers follow the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentlake.llm.common import row_key, text_bytes

MASK64 = (1 << 64) - 1


def dealt(docs: DataFrame, blocks: int, carry: dict[str, Column] | None = None) -> DataFrame:
    """(block, rid, doc_id, text): text as bytes, null empty; and what else to carry along."""
    more = [c.alias(f"carry_{i}") for i, c in enumerate((carry or {}).values())]
    return docs.select(F.pmod(row_key(), F.lit(blocks)).cast("int").alias("block"), row_key().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"), *more)


def ordered(table: pa.Table) -> pa.Table:
    """The rows of a block in an order that a second run repeats."""
    return table.sort_by([("rid", "ascending"), ("doc_id", "ascending")])


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling(h: np.ndarray, length: int, base: int) -> np.ndarray:
    """Polynomial hash modulo 2^64 of each ``length`` consecutive values, by doubling."""
    acc, have, cur, size = None, 0, h, 1
    while length:
        if length & 1:
            if acc is None:
                acc, have = cur, size
            else:
                n = min(len(acc), max(0, len(cur) - have))
                acc = acc[:n] * np.uint64(pow(base, size, 1 << 64)) + cur[have : have + n]
                have += size
        length >>= 1
        if length:
            n = max(0, len(cur) - size)
            cur = cur[:n] * np.uint64(pow(base, size, 1 << 64)) + cur[size : size + n]
            size *= 2
    return acc


def by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of distinct sorted keys by shard, and (shard, begin, end) of those that get any."""
    shard = ((keys >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    cut = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]).tolist() if len(shard) else []
    return order, list(zip(shard[cut].tolist(), cut, [*cut[1:], len(shard)]))


def shard_rows(block: int, order: np.ndarray, cuts: list[tuple[int, int, int]], columns: dict[str, np.ndarray]) -> Iterator[dict]:
    """A row for each shard that gets keys: the bytes of each column, in order."""
    held = {k: v[order] for k, v in columns.items()}
    for s, a, b in cuts:
        yield {"shard": s, "block": block} | {k: v[a:b].tobytes() for k, v in held.items()}


def answers(rows: list[tuple[int, bytes]], order: np.ndarray, kind) -> np.ndarray:
    """What the shards answered, in the order of the block's keys."""
    out = np.zeros(len(order), kind)
    if len(order):
        out[order] = np.concatenate([np.frombuffer(b, kind) for _, b in sorted(rows, key=lambda x: x[0])])
    return out


def met_elsewhere(kinds: dict[str, type]) -> Callable[[pa.Table], pa.Table]:
    """Shard function: for each key of each block, 1 if another block sent it too."""

    def run(table: pa.Table) -> pa.Table:
        cols = [[np.frombuffer(b, k) for b in table.column(c).to_pylist()] for c, k in kinds.items()]
        sizes = [len(x) for x in cols[0]]
        whole = [np.concatenate(c) for c in cols]
        order = np.lexsort(whole[::-1]) if len(whole) > 1 else np.argsort(whole[0], kind="stable")
        same = np.ones(max(0, len(order) - 1), bool)
        for w in whole:
            same &= w[order[1:]] == w[order[:-1]]
        flag = np.zeros(len(order), np.uint8)
        flag[order[1:]] |= same
        flag[order[:-1]] |= same
        ends = np.cumsum([0, *sizes])
        return pa.table({"block": table.column("block"), "shard": table.column("shard"), "answer": pa.array([flag[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())})

    return run


def as_table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)

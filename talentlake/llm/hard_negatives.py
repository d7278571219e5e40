"""Hard-negative mining with Fagin's threshold algorithm.

1. Rows are dealt to index blocks of about ``ROWS`` rows by the hash of a row id. A block
   holds its integer vectors and, for each dimension, its rows in descending order of
   that component: the sorted candidate lists. The index is a table in the shared folder.
2. Anchors are dealt to groups of about ``ANCHORS``. Each (group, block) pair is a row of
   an equi-join and one piece of work, whatever the sizes of labels: groups and blocks
   follow the input, no label or vector is a key.
3. In a block, an anchor reads the lists of all dimensions side by side, from the top
   where its own component is positive and from the bottom where it is negative. Each
   row met for the first time is scored by random access, in integers. The sum of the
   components last read, times the anchor's, is the threshold: no unread row scores
   more. Reading stops once it is strictly below the k-th score of every window asked
   for, as a tie would still be decided by the id, or below the window itself.
4. The first pass asks for positives (rows of the anchor's label, one window without
   bounds), the second for negatives (rows of other labels) in the windows that the
   positives' scores set. The blocks' firsts are merged by rank, cut before the shuffle.

Each block answers with its own first k, so the merged result is exact.

Defined results: rows with a null label, a null vector or a null or non-finite component
take no part; an empty vector does, with score 0; missing components of shorter vectors
count as zero. Rows that repeat a vec_id are rows of their own: each repeated anchor row
gives its rows, and repeated rows can be each other's positives; ties beyond the id go by
the order in which the rows are stored. A null vec_id is no anchor, and comes last among ties.
An empty table gives no rows. vec_id and label must be integers (or cast to long); scores
that could pass 64 bits end the job with an error, as integer SQL does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from talentlake.llm.common import prepare, written

ROWS, ANCHORS = 2048, 256  # rows of an index block, anchors of a group, about
FIRST = 16  # entries read of each list before the first look at the threshold; then twice as many each time

INDEX = "block int, n int, kind string, rid binary, id binary, no_id binary, label binary, vectors binary, lists binary"
HITS = "anchor long, slot int, rid long, id long, score long"


def quantized(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(rid, id, label, v): rows that take part, components as floor(scale * x)."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    part = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return part.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), whole.alias("v"))


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Lists of integers as rows of ``dims`` columns; what is missing is zero."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(flat.value_lengths(), np.int64)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = np.asarray(flat.flatten(), np.int64)
    return out


def index(rows: DataFrame, blocks: int, dims: int) -> DataFrame:
    """The sorted candidate lists of each block."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("no_id", "ascending"), ("id", "ascending"), ("rid", "ascending")])
        v = matrix(table.column("v"), dims)
        kind = str(np.result_type(np.min_scalar_type(v.min(initial=0)), np.min_scalar_type(v.max(initial=0)), np.int8))
        lists = np.argsort(-v, axis=0, kind="stable").T.astype(np.int32)
        packed = {c: [np.asarray(table.column(c).combine_chunks().fill_null(0), k).tobytes()] for c, k in (("rid", np.int64), ("id", np.int64), ("no_id", np.int8), ("label", np.int64))}
        return pa.table({"block": table.column("block")[:1], "n": pa.array([len(v)], pa.int32()), "kind": [kind]} | packed | {"vectors": [v.astype(kind).tobytes()], "lists": [lists.tobytes()]})

    dealt = rows.select(F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int").alias("block"), "rid", "id", F.col("id").isNull().cast("int").alias("no_id"), "label", "v")
    return written(dealt.groupBy("block").applyInArrow(build, INDEX))


class Lists:
    """The lists of a block, or of the rows of it that an anchor may meet."""

    def __init__(self, vectors: np.ndarray, lists: np.ndarray):
        self.vectors, self.lists = vectors, lists
        self.scored = 0  # random accesses so far

    def of(self, eligible: np.ndarray) -> Lists:
        return Lists(self.vectors, self.lists[eligible[self.lists]].reshape(len(self.lists), int(eligible.sum())))

    def firsts(self, anchor: np.ndarray, windows: list[tuple[int | None, int | None]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window, bounds included, the positions and scores of the first ``k`` rows, higher
        scores first, ties by position."""
        m = self.lists.shape[1] if len(self.lists) else len(self.vectors)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        score, met = np.zeros(len(self.vectors), np.int64), np.zeros(len(self.vectors), bool)
        # an anchor without a component has nothing to read by; all rows score 0
        depth, step = 0, FIRST if len(up) + len(down) else m
        seen = 0
        while True:
            to = min(m, depth + step)
            new = np.zeros(len(self.vectors), bool)
            if len(up) + len(down):
                new[self.lists[up, depth:to].ravel()] = True
                new[self.lists[down, m - to : m - depth].ravel()] = True
            else:
                new[self.lists[0] if len(self.lists) else slice(None)] = True
            new &= ~met
            at = np.flatnonzero(new)
            score[at] = self.vectors[at] @ anchor
            met |= new
            seen += len(at)
            depth, step = to, step * 2
            if seen >= m:
                break
            last = int(self.vectors[self.lists[up, to - 1], up] @ anchor[up] + self.vectors[self.lists[down, m - to], down] @ anchor[down])
            if all(self._settled(score[met], lo, hi, k, last) for lo, hi in windows):
                break
        self.scored += seen
        at = np.flatnonzero(met)
        return [self._first(at, score[at], lo, hi, k) for lo, hi in windows]

    @staticmethod
    def _inside(s: np.ndarray, lo: int | None, hi: int | None) -> np.ndarray:
        inside = np.ones(len(s), bool)
        if lo is not None:
            inside &= s >= lo
        if hi is not None:
            inside &= s <= hi
        return inside

    def _settled(self, s: np.ndarray, lo: int | None, hi: int | None, k: int, threshold: int) -> bool:
        """No unread row is among the window's first ``k``."""
        if (lo is not None and threshold < lo) or (lo is not None and hi is not None and lo > hi):
            return True
        s = s[self._inside(s, lo, hi)]
        return len(s) >= k and threshold < np.partition(s, len(s) - k)[len(s) - k]

    def _first(self, at: np.ndarray, s: np.ndarray, lo: int | None, hi: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        inside = self._inside(s, lo, hi)
        at, s = at[inside], s[inside]
        order = np.lexsort((at, -s))[:k]
        return at[order], s[order]


def exact(vectors: np.ndarray, anchors: np.ndarray) -> type:
    """The type in which all products and sums are exact."""
    most = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    bound = most(vectors) * most(anchors) * max(1, vectors.shape[1])
    if bound >= 2**63:
        raise OverflowError("scores of these vectors can pass 64 bits")
    return np.float64 if bound < 2**53 else np.int64


def searched(lists: DataFrame, anchors: DataFrame, blocks: int, groups: int, dims: int, k: int, band: tuple[int, int] | None = None) -> DataFrame:
    """``HITS``: what each block has for each anchor. anchors: (rid, label, v, scores).
    band None: the first ``k`` other rows of the anchor's label. Else, for each of ``scores``, the first
    ``k`` rows of other labels whose score is within these per cents of it."""
    same_label = band is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in pa.Table.from_batches([batch]).to_pylist():
                n = r["n"]
                v = np.frombuffer(r["vectors"], r["kind"]).reshape(n, dims)
                rid, ids, no_id, label = (np.frombuffer(r[c], t) for c, t in (("rid", np.int64), ("id", np.int64), ("no_id", np.int8), ("label", np.int64)))
                asked = sorted(r["anchors"], key=lambda a: a["label"])
                q = np.zeros((len(asked), dims), np.int64)
                for i, a in enumerate(asked):
                    q[i, : len(a["v"])] = a["v"]
                kind = exact(v, q)
                block, q = Lists(v.astype(kind), np.frombuffer(r["lists"], np.int32).reshape(dims, n)), q.astype(kind)
                out, own, of = [], None, None
                for i, a in enumerate(asked):
                    if own is None or of != a["label"]:
                        of, eligible = a["label"], (label == a["label"]) == same_label
                        # without dimensions there are no lists to cut: all scores are 0
                        own = block.of(eligible) if dims else Lists(block.vectors[eligible], block.lists)
                        names = np.arange(n) if dims else np.flatnonzero(eligible)
                    # the integers of the band; one row more where the anchor itself is among them
                    windows = [(None, None)] if band is None else [(-(-s * band[0] // 100), s * band[1] // 100) for s in a["scores"]]
                    for slot, (at, s) in enumerate(own.firsts(q[i], windows, k + same_label)):
                        at = names[at]
                        other = rid[at] != a["rid"]
                        out += [(a["rid"], slot, *x) for x in list(zip(rid[at][other].tolist(), [None if z else y for y, z in zip(ids[at][other].tolist(), no_id[at][other])], s[other].astype(np.int64).tolist()))[:k]]
                cols = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["anchor", "slot", "rid", "id", "score"])

    near = anchors.groupBy(F.pmod(F.xxhash64("rid"), F.lit(groups)).cast("int").alias("g")).agg(F.collect_list(F.struct("rid", "label", "v", "scores")).alias("anchors"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    pieces = min(blocks * groups, 100_000)
    left = lists.select("*", every(groups).alias("g")).repartition(pieces, "block", "g")
    right = near.select("*", every(blocks).alias("block")).repartition(pieces, "block", "g")
    return left.join(right, ["block", "g"]).drop("block", "g").mapInArrow(run, HITS)


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor's slot over all blocks, with their ``rank``."""
    order = W.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(embeddings: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and
    each of its first ``positives`` other rows of its label, the first ``negatives`` rows of other labels
    that score ``low`` to ``high`` per cent of the positive's score.

    embeddings: vec_id, embedding and label, the label as it is to be compared; further columns are
    ignored. is_anchor: a condition on vec_id and label."""
    prepare(embeddings.sparkSession)
    rows = written(quantized(embeddings.select("vec_id", "embedding", "label")))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
    dims = size["dims"] or 0
    blocks = max(1, -(-size["n"] // ROWS))
    lists = index(rows, blocks, dims)
    anchors = written(rows.select("rid", "v", F.col("id").alias("vec_id"), "label").where(is_anchor))
    groups = max(1, -(-anchors.count() // ANCHORS))
    free = anchors.select("rid", "label", "v", F.lit(None).cast("array<long>").alias("scores"))
    first = written(ranked(searched(lists, free, blocks, groups, dims, positives), positives))
    windows = first.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("w")).select(F.col("anchor").alias("rid"), F.col("w.score").alias("scores"))
    asked = anchors.select("rid", "label", "v").join(windows, "rid")
    second = ranked(searched(lists, asked, blocks, groups, dims, negatives, (low, high)), negatives)
    pairs = first.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = second.select("anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(pairs, ["anchor", "slot"])
    names = anchors.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return out.join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

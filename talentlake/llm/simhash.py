"""SimHash near-dedup by a generalised pigeonhole.

64-bit fingerprints link when they differ in at most ``distance`` bits. The bits
are put in partitions with thresholds t_i of their own, with sum(t_i + 1) =
distance + 1: two linked fingerprints then differ by at most t_i in some partition
i. A partition is probed with every value within its threshold, and what it meets
is verified on all 64 bits.

* Bits that go together are put in the same partition, by the correlations over all
  distinct fingerprints: the partitions' values then are as independent as they get,
  and the skew of correlated bits weighs on one of them, which gets a small threshold.
* Thresholds come from dynamic programming over the estimated numbers of probes and
  candidates of each partition, for two to five partitions; the cheapest wins.
  Few documents give many narrow partitions, very many give few wide ones, so
  candidates stay in proportion.
* Equal fingerprints are one row before any of this. Of the links of a probed value
  only a spanning forest leaves the task, so dense groups never become all pairs.

Defined results: null, empty and blank texts have fingerprint zero and link like any
other; rows that repeat are members of the same component; a component whose
documents all have a null doc_id has a null component_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.llm.common import prepare, row_key, text_bytes, written
from talentlake.llm.components import components

BITS = 64
SEED = 42
PROBE, VERIFY = 1.0, 0.03  # cost of a probe row, of a candidate pair
BLOCK = 1 << 21  # pairs verified at once

# Spreads the bits of a byte over the bytes of a word, lowest first.
LANES = np.array([sum(((v >> k) & 1) << (8 * k) for k in range(8)) for v in range(256)], np.uint64)


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of each run of ``size`` words, repeats included; of the whole sequence if shorter."""
    words = text.lower().split()
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return [h(joined, SEED)] if words else []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = [0, *ends[:-size].tolist()]
    return [h(joined[a:b], SEED) for a, b in zip(begins, (ends[size - 1 :] - 1).tolist())]


def majorities(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of hashes: bits set in over half of them."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    begins = (np.cumsum(sizes) - sizes)[full]
    # sums of at most 255 rows fit the byte lanes
    cuts = np.concatenate([np.arange(a, a + n, 255) for a, n in zip(begins.tolist(), sizes[full].tolist())])
    lanes = np.add.reduceat(LANES[hashes.view(np.uint8).reshape(-1, 8)], cuts, axis=0)
    counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, BITS).astype(np.int64), np.searchsorted(cuts, begins), axis=0)
    set_ = (2 * counts > sizes[full, None]).astype(np.uint8)
    out[full] = np.packbits(set_, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, keyed: bool = False) -> DataFrame:
    """(doc_id, fp) of every row, fp a long with the fingerprint's bits; keyed: with its row key ``rid``."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, sizes, out = [], [], []

            def flush():
                flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
                out.append(majorities(flat, np.array(sizes, np.int64)))
                hashes.clear()
                sizes.clear()

            held = 0
            for t in b.column("text").to_pylist():
                h = shingle_hashes(t, shingle)
                hashes.append(np.array(h, np.uint64))
                sizes.append(len(h))
                held += len(h)
                if held > 1 << 17:
                    flush()
                    held = 0
            flush()
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(np.concatenate(out).view(np.int64))], [*names, "fp"])

    names = ["doc_id", "rid"] if keyed else ["doc_id"]
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("rid"), text_bytes().alias("text"))
    return x.select(*names, "text").mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "fp"]))


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both of any two bits, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            x = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            for a in range(0, len(x), 1 << 14):
                total += x[a : a + (1 << 14)].T @ x[a : a + (1 << 14)]
            n += len(x)
        cells = np.r_[total.ravel(), n].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells)), pa.int32()), pa.array(cells)], ["cell", "n"])

    cells = np.zeros(BITS * BITS + 1, np.int64)
    for r in fps.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        cells[r["cell"]] = r["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def grouped_bits(correlation: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of about equal width; each starts with the strongest pair left and
    takes the bit that goes best with those it has."""
    left, out = set(range(BITS)), []
    for i in range(m):
        width = (BITS - sum(map(len, out))) // (m - i)
        free = sorted(left)
        pair = max(combinations(free, 2), key=lambda p: correlation[p], default=None) if width > 1 else None
        part = list(pair or free[:1])
        left -= set(part)
        while len(part) < width:
            best = max(sorted(left), key=lambda b: correlation[b, part].sum())
            part.append(best)
            left.discard(best)
        out.append(sorted(part))
    return out


def meeting_chances(agree: np.ndarray, part: list[int], most: int) -> np.ndarray:
    """P(two fingerprints differ by at most e in the partition), e = 0 .. most, from the
    chance of each bit to agree."""
    p = np.zeros(most + 2)
    p[0] = 1
    for b in part:
        p[1:] = p[1:] * agree[b] + p[:-1] * (1 - agree[b])
        p[0] *= agree[b]
    return np.cumsum(p[: most + 1])


def allocated(n: int, distance: int, widths: list[int], chances: list[np.ndarray]) -> tuple[float, list[int]]:
    """Least cost and its thresholds t_i >= -1 with sum(t_i + 1) = distance + 1, by
    dynamic programming over partitions and what is left to give."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for width, chance in zip(widths, chances):
        after: dict[int, tuple[float, list[int]]] = {}
        for given, (cost, thresholds) in best.items():
            for t in range(-1, distance - given + 1):
                probes = sum(comb(width, e) for e in range(t + 1)) if t >= 0 else 0
                more = cost + (n * probes * PROBE + n * n * chance[t] * VERIFY if t >= 0 else 0)
                if given + t + 1 not in after or more < after[given + t + 1][0]:
                    after[given + t + 1] = (more, [*thresholds, t])
        best = after
    return best[distance + 1]


def plan(fps: DataFrame, distance: int) -> list[tuple[int, int, list[int]]]:
    """(mask, threshold, bits) of each partition that is probed."""
    n, both = bit_counts(fps)
    share = both / max(n, 1)
    mean = np.diag(share)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    correlation = np.abs((share - np.outer(mean, mean)) / np.outer(spread, spread))
    agree = mean**2 + (1 - mean) ** 2
    found = []
    for m in range(2, distance + 2) if distance else [1]:
        parts = grouped_bits(correlation, m)
        cost, thresholds = allocated(n, distance, [len(p) for p in parts], [meeting_chances(agree, p, distance) for p in parts])
        found.append((cost, m, [(sum(1 << b for b in p), t, p) for p, t in zip(parts, thresholds) if t >= 0]))
    return min(found, key=lambda x: x[:2])[2]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def forest(probes: np.ndarray, held: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between probes and held fingerprints, as few as connect what is linked."""
    a, b = [], []
    group = np.arange(len(held))
    step = max(1, BLOCK // max(1, len(held)))
    for i in range(0, len(probes), step):
        near = np.bitwise_count(probes[i : i + step, None] ^ held[None, :]) <= distance
        for x, row in zip(probes[i : i + step], near):
            y = np.flatnonzero(row)
            if len(y):
                roots, first = np.unique(group[y], return_index=True)
                a += [x] * len(first)
                b += held[y[first]].tolist()
                if len(roots) > 1:
                    group[np.isin(group, roots)] = roots[0]
    return np.array(a, np.uint64), np.array(b, np.uint64)


def run_links(part: np.ndarray, key: np.ndarray, probe: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of whole runs of equal (part, key): held rows first, then probes."""
    new = np.r_[True, (part[1:] != part[:-1]) | (key[1:] != key[:-1])]
    run = np.cumsum(new) - 1
    begins = np.flatnonzero(new)
    size = np.diff(np.r_[begins, len(part)])
    n_held = np.add.reduceat(~probe, begins, dtype=np.int64)
    pairs = n_held * (size - n_held)
    out = [(fp[:0], fp[:0])]
    dense = pairs > BLOCK
    for r in np.flatnonzero(dense):
        x = fp[begins[r] : begins[r] + size[r]]
        out.append(forest(x[n_held[r] :], x[: n_held[r]], distance))
    p = np.flatnonzero(probe & ~dense[run] & (n_held[run] > 0))
    n = n_held[run[p]]
    edges = np.cumsum(n)
    for lo, hi in batches_of(edges, BLOCK):
        q, m = p[lo:hi], n[lo:hi]
        x = np.repeat(fp[q], m)
        at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(begins[run[q]], m)
        y = fp[at]
        ok = (np.bitwise_count(x ^ y) <= distance) & (x != y)
        out.append((x[ok], y[ok]))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def batches_of(edges: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries that hold about ``most`` pairs; edges: the running number of pairs."""
    lo = 0
    while lo < len(edges):
        hi = max(lo + 1, int(np.searchsorted(edges, (edges[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """The edges that join something new, in order."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    out = ([], [])
    for x, y in zip(a.tolist(), b.tolist()):
        if (r := root(x)) != (s := root(y)):
            parent[max(r, s)] = min(r, s)
            out[0].append(x)
            out[1].append(y)
    return out


def links(fps: DataFrame, distance: int) -> DataFrame:
    """(a, b): links that connect what is connected. fps: distinct fingerprints."""
    rows = None
    for i, (mask, t, bits) in enumerate(plan(fps, distance)):
        flips = [sum(1 << b for b in c) for e in range(t + 1) for c in combinations(bits, e)]
        value = F.col("fp").bitwiseAND(F.lit(signed(mask)))
        held = fps.select(F.lit(i).alias("part"), value.alias("key"), F.lit(False).alias("probe"), "fp")
        flip = F.explode(F.array(*[F.lit(signed(f)) for f in flips])).alias("flip")
        probe = fps.select("fp", flip).select(F.lit(i).alias("part"), value.bitwiseXOR(F.col("flip")).alias("key"), F.lit(True).alias("probe"), "fp")
        rows = held.unionByName(probe) if rows is None else rows.unionByName(held).unionByName(probe)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("part", "key", "probe", "fp")]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            part, key = cols[:2]
            last = int(np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (key[1:] != key[:-1])])[-1]) if len(part) else 0
            rest = [c[last:] for c in cols]
            if last:
                yield edges([c[:last] for c in cols])
        if rest is not None and len(rest[0]):
            yield edges(rest)

    def edges(cols: list[np.ndarray]) -> pa.RecordBatch:
        a, b = spanning(*run_links(*cols[:3], cols[3].view(np.uint64), distance))
        return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"])

    met = rows.repartition("part", "key").sortWithinPartitions("part", "key", "probe")
    return met.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, keyed: bool = False) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id: the smallest
    doc_id that links lead to. keyed: with its row key ``rid`` and its component's ``root``, a
    fingerprint, which is there also where no row of the component has an id."""
    prints = written(fingerprints(docs, shingle, keyed))
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct, distance))
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(ids, "root").select("fp", "component_id", "root")
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", *(["rid", "root"] if keyed else []))

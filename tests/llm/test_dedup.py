"""Substring, suffix and near-duplicate removal against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from edge import documents, empty, expected, got, rows
from talentlake.llm import simhash, substring_dedup, suffix_dedup
from talentlake.llm.components import components


def sha(b):
    return hashlib.sha256(b).hexdigest()


def brute_words(data, window):
    words = [(i, (t or "").encode().split()) for i, t, *_ in data]
    seen = Counter(tuple(w[k : k + window]) for _, w in words for k in range(len(w) - window + 1))
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        yield i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))


@pytest.mark.parametrize(("window", "period"), [(35, 21), (5, 5), (5, 1), (8, 7)])
def test_substring_dedup(spark, window, period):
    out = substring_dedup.remove_repeats(documents(spark), window, period, block_bytes=2000)
    assert got(out, "doc_id", "n_words", "n_removed", "kept_sha256") == expected(brute_words(rows(), window))


def test_substring_dedup_keeps_text(spark):
    out = substring_dedup.remove_repeats(documents(spark), keep_text=True).collect()
    assert all(sha(r["kept"].encode()) == r["kept_sha256"] for r in out)


@pytest.mark.parametrize("period", [1, 2, 7, 13, 21])
def test_difference_cover(period):
    cover = substring_dedup.difference_cover(period)
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


def brute_bytes(data, span):
    last = 2**63
    docs = [(i, last if i is None else i, (t or "").encode()) for i, t, *_ in data]
    least = {}
    for _, i, b in docs:
        for k in range(len(b) - span + 1):
            w = b[k : k + span]
            least[w] = min(least.get(w, last), i)
    for name, i, b in docs:
        gone = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if least[b[k : k + span]] < i:
                gone[k : k + span] = b"\1" * span
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        yield name, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))


@pytest.mark.parametrize(("span", "seed"), [(50, 20), (20, 6), (20, 20)])
def test_suffix_dedup(spark, span, seed):
    out = suffix_dedup.remove_later_copies(documents(spark), span, seed, block_bytes=2000)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected(brute_bytes(rows(), span))


def test_suffix_dedup_cuts_long_documents(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 1 << 10)
    out = suffix_dedup.remove_later_copies(documents(spark), block_bytes=20000)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected(brute_bytes(rows(), 50))


@pytest.mark.parametrize("hot", [1, 4])
def test_suffix_dedup_cuts_hot_seeds(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    out = suffix_dedup.remove_later_copies(documents(spark), block_bytes=2000)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected(brute_bytes(rows(), 50))


def test_column_wise_order_and_common_prefixes():
    rng = np.random.default_rng(3)
    pieces = [bytes(rng.integers(97, 99, rng.integers(1, 30)).tolist()) for _ in range(60)]
    suffix, common, begins = suffix_dedup.column_wise(pieces, 12)
    whole = sorted(((p[k:], i) for i, p in enumerate(pieces) for k in range(len(p) + 1)))
    text = b"\xff" + b"".join(p + b"\xff" for p in pieces)
    found = [text[s : text.index(b"\xff", s)] for s in suffix.tolist()]
    assert found == [w for w, _ in whole]
    for k in range(1, len(found)):
        n = next((x for x in range(min(len(found[k]), len(found[k - 1]))) if found[k][x] != found[k - 1][x]), min(len(found[k]), len(found[k - 1])))
        assert common[k] == min(n, 12)


def brute_prints(data, shingle):
    for i, t, *_ in data:
        w = (t or "").encode().lower().split()
        parts = [b" ".join(w[k : k + shingle]) for k in range(len(w) - shingle + 1)] or ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        yield i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(data, distance):
    prints = list(brute_prints(data, 4))
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    ids = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            ids[find(k)] = min(ids.get(find(k), i), i)
    return [(i, f"{fp:016x}", ids.get(find(k))) for k, (i, fp) in enumerate(prints)]


@pytest.mark.parametrize("distance", [0, 4, 9])
def test_simhash(spark, distance):
    out = simhash.near_duplicates(documents(spark), 4, distance)
    assert got(out, "doc_id", "fingerprint", "component_id") == expected(brute_components(rows(), distance))


def test_simhash_with_few_wide_partitions(spark, monkeypatch):
    """Probes at no cost: the plan takes wide partitions with larger thresholds."""
    monkeypatch.setattr(simhash, "PROBE", 1e-9)
    prints = simhash.fingerprints(documents(spark)).groupBy("fp").count()
    assert max(t for _, t, _ in simhash.plan(prints, 4)) >= 1
    out = simhash.near_duplicates(documents(spark), 4, 4)
    assert got(out, "doc_id", "fingerprint", "component_id") == expected(brute_components(rows(), 4))


def test_simhash_dense_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 50)
    out = simhash.near_duplicates(documents(spark), 4, 6)
    assert got(out, "doc_id", "fingerprint", "component_id") == expected(brute_components(rows(), 6))


def test_thresholds_cover_the_distance(spark):
    n = 1000
    for m in range(1, 6):
        widths = [64 // m] * m
        cost, t = simhash.allocated(n, 4, widths, [np.linspace(0.01 * (i + 1), 0.5, 5) for i in range(m)])
        assert sum(x + 1 for x in t) == 5 and cost > 0
    assert sorted(b for p in simhash.grouped_bits(np.random.default_rng(1).random((64, 64)), 5) for b in p) == list(range(64))


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000), (7, 7)], "a long, b long")
    out = {r["node"]: r["root"] for r in components(edges).collect()}
    assert out == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_empty_tables(spark):
    none = empty(spark)
    assert substring_dedup.remove_repeats(none).count() == 0
    assert suffix_dedup.remove_later_copies(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0

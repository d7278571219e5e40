"""Hard negatives, ranked search and language ID against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_CHECK
from edge import documents, empty, expected, got, prose, rows
from talentlake.llm import hard_negatives, language_id, queries, ranked_search

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                        # names that the operator uses inside
                        T.StructField("rid", T.StringType()), T.StructField("v", T.StringType()), T.StructField("score", T.StringType()), T.StructField("rank", T.StringType()), T.StructField("anchor", T.StringType())])


def vectors(n: int = 400, dims: int = 6) -> list[tuple]:
    r = random.Random(3)
    vec = lambda: [r.gauss(0, 1) / 4 for _ in range(dims)]
    out = [(i, vec(), r.choice([1, 1, 1, 2, 3])) for i in range(n)]
    same = out[0][1]
    out += [(1000 + i, same, i % 4) for i in range(60)]  # a large group of copies: ties
    out += [(2000, [0.0] * dims, 1), (2100, [0.0] * dims, 2), (-100, vec(), 2), (2200, vec(), 9), (2300, vec()[:3], 1), (2400, [], 2)]
    out += [(2500, None, 1), (2501, vec(), None), (2502, [None, *vec()[1:]], 1), (2503, [float("nan"), *vec()[1:]], 1), (2504, [float("-inf"), *vec()[1:]], 2), (None, vec(), 1), (None, same, 2)]
    return [(*x, "r", "v", "s", "k", "a") for x in out]


def brute_negatives(data, positives=5, negatives=10, low=30, high=90):
    rows = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label) for i, v, label, *_ in data if v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    first = lambda hits, k: sorted(hits, key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:k]
    for a, (i, v, label) in enumerate(rows):
        if i is None or i % 100:
            continue
        for p, ps in first([(j, score(v, w)) for b, (j, w, m) in enumerate(rows) if b != a and m == label], positives):
            inside = [(j, s) for j, w, m in rows if m != label and low * ps <= 100 * (s := score(v, w)) <= high * ps]
            for rank, (j, s) in enumerate(first(inside, negatives), 1):
                yield i, p, rank, j, ps, s


MINED = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize(("rows", "anchors", "first"), [(2048, 256, 16), (50, 3, 2)])
def test_hard_negatives(spark, monkeypatch, rows, anchors, first):
    monkeypatch.setattr(hard_negatives, "ROWS", rows)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "FIRST", first)
    data = vectors()
    out = hard_negatives.mine(spark.createDataFrame(data, VECTORS).repartition(3), F.col("vec_id") % 100 == 0)
    assert got(out, *MINED) == expected(brute_negatives(data))


def test_hard_negatives_of_repeated_rows(spark):
    """A repeated anchor row is an anchor, and the other row's positive."""
    data = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (5, [0.5, 0.5], 2), (6, [0.0, 1.0], 2), (7, [0.8, 0.0], 3)]
    out = hard_negatives.mine(spark.createDataFrame(data, "vec_id long, embedding array<float>, label int"), F.col("vec_id") % 100 == 0)
    assert got(out, *MINED) == expected([(0, 0, 1, 7, 65536, 52224), (0, 0, 2, 5, 65536, 32768)] * 2)


def test_hard_negatives_of_nothing(spark):
    for data in ([], [(0, [], 1, *"rvska")], [(0, [0.0], 1, *"rvska"), (1, [1.0], 1, *"rvska")], [x for x in vectors() if x[0] is None or x[0] % 100]):
        assert hard_negatives.mine(spark.createDataFrame(data, VECTORS), F.col("vec_id") % 100 == 0).count() == 0


def test_scores_beyond_64_bits(spark):
    with pytest.raises(OverflowError):
        hard_negatives.exact(np.array([[2**40]]), np.array([[2**30]]))
    assert hard_negatives.exact(np.array([[2**30]]), np.array([[2**30]])) is np.int64


def test_threshold_stops_early():
    """Reading ends before the lists do where one row stands out; the result is that of all rows."""
    r = np.random.default_rng(5)
    v = r.integers(-50, 50, (4000, 4))
    v[1234] = 400
    lists = hard_negatives.Lists(v, np.argsort(-v, axis=0, kind="stable").T)
    q = np.array([3, 2, 0, 1])
    (at, s), (inside, t) = lists.firsts(q, [(None, None), (1000, 1500)], 1)
    assert at.tolist() == [1234] and s.tolist() == [2400] and len(inside) == 0
    assert lists.scored < 200


def brute_languages(data, folds=3, held=1, ridge=1e-4):
    """Kernel ridge regression over sets of strings; every distinct text that is learned from is a landmark."""
    def grams(t):
        c = re.sub(" +", " ", " " + "".join(x.lower()[0] if x.isalpha() else " " for x in t or "") + " ")
        return {c[i : i + n] for n in (1, 2, 3) for i in range(len(c) - n + 1)} - {" "} if c.strip() else set()

    kernel = lambda a, b: np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in b] for x in a])
    part = lambda i: zlib.crc32(str("" if i is None else i).encode()) % folds
    learn = [(i, t, lang) for i, t, lang in data if part(i) != held and lang is not None and grams(t)]
    languages = sorted({lang for _, _, lang in learn})
    marks = [grams(t) for t in {t: 0 for _, t, _ in learn}]
    x, own = kernel([grams(t) for _, t, _ in learn], marks), kernel(marks, marks)
    y = np.array([[float(lang == a) for a in languages] for _, _, lang in learn])
    weights = np.linalg.lstsq(x.T @ x + ridge * len(learn) * own, x.T @ y, rcond=1e-10)[0]
    for i, t, _ in data:
        s = (kernel([grams(t)], marks) @ weights)[0] if grams(t) else None
        yield i, part(i) == held, "und" if s is None else languages[int(s.argmax())], 0.0 if s is None else min(1.0, max(0.0, s.max()))


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_language_id(spark, monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    data = [(i, t, lang) for i, t, lang, *_ in rows()] + [(500 + i, prose(i, 20, "xyzéñ"), "xx") for i in range(30)] + [(600, "\u4e2d\u6587", None)]
    out = {}
    for r in language_id.identify(documents(spark, [(*x, "s", 1, "r", 1, "f", "s", "k", "q") for x in data]), count=10_000).collect():
        out.setdefault(r["doc_id"], []).append((r["held_out"], r["lang_pred"], r["score"]))
    want = {}
    for i, h, lang, s in brute_languages(data):
        want.setdefault(i, []).append((h, lang, s))
    for i, some in want.items():
        for (h, lang, s), (h2, lang2, s2) in zip(sorted(some), sorted(out[i]), strict=True):
            assert h == h2 and abs(s - s2) < 2e-3 and (lang == lang2 or abs(s - 0.5) < 0.1)
    assert {x[1:] for x in out[0]} == {("und", 0.0)} and out[600][0][2] == 0.0


def test_language_id_learns_nothing_from_held_out_rows(spark):
    """The prediction takes neither lang, source nor id; without labelled rows it is und."""
    data = [(i, prose(i, 30, "abc" if i % 2 else "xyz"), "one" if i % 2 else "two") for i in range(60)]
    row = lambda i, t, lang, s="s": (i, t, lang, s, 1, "r", 1, "f", "s", "k", "q")
    held = {i for i, _, _ in data if zlib.crc32(str(i).encode()) % 3 == 1}
    run = lambda d: {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(documents(spark, d)).collect()}
    plain = run([row(*x) for x in data])
    assert plain == run([row(i, t, "wrong" if i in held else lang, "other") for i, t, lang in data])
    assert all(plain[i][0] == lang for i, _, lang in data)
    assert set(run([row(i, t, None) for i, t, _ in data]).values()) == {("und", 0.0)}
    assert language_id.identify(empty(spark)).count() == 0


def test_language_id_held_out_accuracy(spark):
    out = queries.op13_language_id(spark, SF_CHECK).withColumnRenamed("doc_id", "id")
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").join(out, F.col("doc_id") == F.col("id"))
    right, n = docs.where("held_out and lang_pred <> 'und'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 200 and right > 0.95


ITEMS = "item_id long, text string, item string, key string, score string"


def brute_search(data, items, k=10):
    term = lambda t: re.findall("[0-9a-z\\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    rows = [(i, Counter(w), len(w)) for i, t in data if (w := term(t))]
    n, total = len(rows), sum(x for _, _, x in rows)
    held = Counter(t for _, c, _ in rows for t in c)
    for item, text in items:
        asked, found = term(text), []
        for i, c, size in rows:
            m = 100 - 75 + 75 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if c[t])
            if s > 0:
                found.append((i, s))
        for rank, (i, s) in enumerate(sorted(found, key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:k], 1):
            yield item, rank, i, s


@pytest.mark.parametrize(("block", "group", "small"), [(4096, 16 << 20, 200_000), (8, 150, 0)])
def test_ranked_search(spark, monkeypatch, block, group, small):
    monkeypatch.setattr(ranked_search, "BLOCK_ROWS", block)
    monkeypatch.setattr(ranked_search, "GROUP_BYTES", group)
    monkeypatch.setattr(ranked_search, "SMALL", small)
    passage = rows()[5][1]
    items = [(1, passage), (1, passage), (10, "a A b e"), (11, prose(7, 12)), (12, "one two three three"), (13, None), (14, " !? "), (15, "unseen"), (None, "x"), (16, "line one is here 123")]
    asked = spark.createDataFrame([(*x, "i", "k", "s") for x in items], ITEMS)
    out = ranked_search.search(documents(spark), asked)
    assert got(out, "item_id", "rank", "doc_id", "score") == expected(brute_search([x[:2] for x in rows()], items))


def test_bounds_hold_and_exclude(spark):
    """No bound is below the exact score; most rows are excluded by the floor."""
    texts = [prose(i, 60 + i % 90) for i in range(600)]
    asked = [(i, " ".join(texts[i].split()[5:25]).encode()) for i in range(0, 600, 100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index, n, total = ranked_search.build(docs)
    group = ranked_search.Group(asked, n, total)
    sc = spark.sparkContext
    group.weigh(ranked_search.holders(docs, sc.broadcast(group), len(group.vocabulary)))
    counts = {r["key"]: Counter(ranked_search.terms(r["text"].encode())) for r in docs.select("text", ranked_search.row_key().alias("key")).collect()}
    left = 0
    for block in index.collect():
        keys = np.frombuffer(block["keys"], np.int64)
        for item, bound in group.bounds()(block.asDict()):
            exact = np.array([group.score(item, counts[x], counts[x].total()) for x in keys.tolist()])
            assert (bound >= exact).all()
            left += int((bound >= np.sort(exact)[-10]).sum())
    assert left < 0.2 * 600 * len(asked)


def test_ranked_search_of_nothing(spark):
    some = spark.createDataFrame([(1, "one", "i", "k", "s")], ITEMS)
    assert ranked_search.search(empty(spark), some).count() == 0
    assert ranked_search.search(documents(spark), some.limit(0)).count() == 0
    assert ranked_search.search(documents(spark, [x for x in rows() if not (x[1] or "").strip()]), some).count() == 0

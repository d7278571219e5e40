"""Token counts, language model and quality rules against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from edge import documents, empty, expected, got, prose, rows
from talentlake.llm import hmm, quality, token_counts

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_token_counts(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(VOCABULARY)
    n = [len(tok.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in rows()]
    out = token_counts.count_tokens(documents(spark), VOCABULARY, 100)
    assert got(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == expected((r[0], len((r[1] or "").encode()), k, k > 100) for r, k in zip(rows(), n))
    assert token_counts.count_tokens(empty(spark), VOCABULARY).count() == 0


def test_token_counts_with_a_small_cache():
    from tokenizers import Tokenizer

    tok, count = Tokenizer.from_file(VOCABULARY), token_counts.word_counter(VOCABULARY, cache=7)
    for _, t, *_ in rows():
        assert count(t or "") == len(tok.encode(t or "", add_special_tokens=False).ids)


def test_whole_tokens_are_proven():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(VOCABULARY)
    whole = token_counts.whole_tokens(tok)
    assert len(whole) > 20000 and all(len(tok.model.tokenize(w)) == 1 for w in list(whole)[:500])


def brute_tokens(data):
    return [(i, [*(t or "").encode().lower().split(), None], zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2) for i, t, *_ in data]


def test_hmm_counts_and_base(spark):
    docs = brute_tokens(rows())
    c = Counter(w for _, ws, held in docs if not held for w in ws)
    n, v = sum(c.values()), len(c)
    out = hmm.score(documents(spark), states=3, top=20, iterations=1, block_bytes=2000)
    assert got(out, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens") == expected((i, held, len(ws), sum(c[w] > 0 for w in ws), n) for i, ws, held in docs)
    base = sorted(r["base_score"] for r in out.select("base_score").collect())
    assert base == pytest.approx(sorted(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws) for _, ws, _ in docs))


def test_token_keys_tell_words_apart():
    texts = [(t or "").encode() for _, t, *_ in rows()]
    keys, n = hmm.token_keys(texts)
    words = [w for t in texts for w in [*t.lower().split(), None]]
    assert n.tolist() == [len(t.split()) + 1 for t in texts]
    by = defaultdict(set)
    for w, k in zip(words, keys.tolist()):
        by[w].add(k)
    assert all(len(x) == 1 for x in by.values()) and len({next(iter(x)) for x in by.values()}) == len(by)
    assert by[None] == {int(hmm.END_KEY)}


def hidden(rng, k, c):
    norm = lambda x, a: x / x.sum(axis=a, keepdims=True)
    return norm(rng.random(k), 0), norm(rng.random((k, k)), 1), norm(rng.random((c, k)), 0)


def test_forward_and_expected_counts():
    """Against sums over all state sequences."""
    rng = np.random.default_rng(5)
    start, move, emit = hidden(rng, 2, 3)
    n = np.array([4, 1, 3])
    classes = rng.integers(0, 3, n.sum()).astype(np.int32)
    starts, moves, emissions, logs = np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2)), []
    at = 0
    for size in n:
        seq, total, s0, m0, e0 = classes[at : at + size], 0.0, np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2))
        at += size
        for path in np.ndindex(*[2] * size):
            p = start[path[0]] * emit[seq[0], path[0]]
            for a, b, w in zip(path, path[1:], seq[1:]):
                p *= move[a, b] * emit[w, b]
            total += p
            s0[path[0]] += p
            for a, b in zip(path, path[1:]):
                m0[a, b] += p
            for w, s in zip(seq, path):
                e0[w, s] += p
        logs.append(math.log10(total))
        starts, moves, emissions = starts + s0 / total, moves + m0 / total, emissions + e0 / total
    assert hmm.likelihoods(classes, n, start, move, emit) == pytest.approx(logs)
    for x, y in zip(hmm.expected(classes, n, start, start, move, emit), (starts, moves, emissions)):
        assert x == pytest.approx(y)


@pytest.mark.parametrize("segment", [1, 2, 3, 7, 100])
def test_moves_over_segment_borders_are_counted(monkeypatch, segment):
    """Each class has a state of its own, so the expected counts are those of the classes."""
    monkeypatch.setattr(hmm, "SEGMENT", segment)
    rng = np.random.default_rng(segment)
    n = np.array([1, 2, 3, 7, 8, 40])
    classes = rng.integers(0, 3, n.sum()).astype(np.int32)
    starts, moves, at = np.zeros(3), np.zeros((3, 3)), 0
    for size in n:
        seq = classes[at : at + size]
        at += size
        starts[seq[0]] += 1
        np.add.at(moves, (seq[:-1], seq[1:]), 1)
    start, move, _ = hidden(rng, 3, 3)
    got = hmm.expected(classes, n, start, start, move, np.eye(3))
    for x, y in zip(got, (starts, moves, np.diag(np.bincount(classes, minlength=3)))):
        assert x == pytest.approx(y)


def test_hmm_is_a_distribution_and_learns(spark):
    """Two languages: held-out texts score above the base, and above the model without training."""
    data = [(i, prose(i, 60, "abcde" if i % 2 else "vwxyz"), None, "s", 1, "r", 1, "f", "s", "k", "q") for i in range(300)]
    docs = documents(spark, data)
    score = {k: hmm.score(docs, states=2, top=200, iterations=k).where("held_out").agg({"score": "sum", "base_score": "sum"}).first() for k in (1, 8)}
    assert score[8]["sum(score)"] > score[1]["sum(score)"] > score[1]["sum(base_score)"]


def test_hmm_empty(spark):
    assert hmm.score(empty(spark)).count() == 0


def brute_base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    twice = set()
    for k in range(len(w) - 4):
        if c[tuple(w[k : k + 5])] > 1:
            twice |= set(range(k, k + 5))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(twice)


def test_quality_base(spark):
    out = quality.judged(documents(spark))
    made = []
    for i, t, *_ in rows():
        b = brute_base(t)
        made.append((i, *b, b[0] < 10 or 100 * b[4] > 20 * b[0]))
    assert got(out, "doc_id", *quality.MEASURES[:5], "base_failed") == expected(made)
    assert out.where("kept and base_failed").count() == 0 and out.where("kept").count() > 20
    assert quality.judged(empty(spark)).count() == 0


def brute_kneser_ney(codes):
    """log10 P of each seen 4-gram, by definition."""
    table = {4: Counter(codes)}
    for k in (3, 2, 1):
        table[k] = Counter(g[1:] for g in table[k + 1])
    d = {}
    for k, t in table.items():
        n = [sum(1 for c in t.values() if c == j) for j in range(5)]
        if all(n[1:]):
            y = n[1] / (n[1] + 2 * n[2])
            d[k] = [min(max(x, 0.05), j - 0.05) for j, x in ((1, 1 - 2 * y * n[2] / n[1]), (2, 2 - 3 * y * n[3] / n[2]), (3, 3 - 4 * y * n[4] / n[3]))]
        else:
            d[k] = [0.5, 0.75, 0.9]

    def p(g):
        if not g:
            return 1 / quality.CLASSES
        k, t = len(g), table[len(g)]
        same = {h: c for h, c in t.items() if h[:-1] == g[:-1]}
        if not same:
            return p(g[1:])
        total = sum(same.values())
        own = max(t[g] - d[k][min(t[g], 3) - 1], 0) if t[g] else 0
        return own / total + sum(d[k][min(c, 3) - 1] for c in same.values()) / total * p(g[1:])

    return p


def test_kneser_ney(spark):
    texts = [prose(i, 40) for i in range(12)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    model = quality.kneser_ney(quality.counted(docs))
    table = quality.class_table()
    unpack = lambda c: tuple(c >> 6 * k & 63 for k in (3, 2, 1, 0))
    codes = np.concatenate([quality.ngrams([t.encode()], table)[0] for t in texts])
    p = brute_kneser_ney([unpack(int(c)) for c in codes])
    asked = np.unique(np.r_[codes[:300], np.random.default_rng(1).integers(0, 64**4, 200).astype(np.uint32)])
    assert model.score(asked) == pytest.approx([math.log10(p(unpack(int(c)))) for c in asked], abs=1e-4)
    # probabilities after a context add up to one
    for context in codes[:5] >> 6:
        every = (np.uint32(context) << np.uint32(6)) | np.arange(64, dtype=np.uint32)
        assert (10 ** model.score(every)).sum() == pytest.approx(1, abs=1e-3)
    assert np.isnan(model.index()[asked]).tolist() == [int(c) not in set(codes.tolist()) for c in asked]


def test_ngrams_mark_capitals():
    """Against symbols written one by one: a mark before each run of upper-case letters, none across texts."""
    table = quality.class_table()
    texts = ["", "A", "aB", "ABC d", "Éa ÉÉ.", "x", "Z", "Zß İ", "a" * 9, "Пр ПР п"]

    def symbols(t):
        out, before = [], False
        for c in t:
            upper = c.lower() != c and len(c.lower()) == 1
            out += [quality.CAPITALS] * (upper and not before) + [int(table[ord(c)]) % quality.UPPER]
            before = upper
        return out

    code, n = quality.ngrams([t.encode() for t in texts], table)
    made = [[0, 0, 0, *symbols(t)] for t in texts]
    assert n.tolist() == [len(m) - 3 for m in made]
    assert [tuple(int(c) >> 6 * k & 63 for k in (3, 2, 1, 0)) for c in code] == [tuple(m[k : k + 4]) for m in made for k in range(len(m) - 3)]
    assert table[ord("É")] == table[ord("é")] | quality.UPPER and table[ord("П")] == table[ord("п")] | quality.UPPER
    assert quality.ngrams([], table)[1].tolist() == []


def test_quality_rejects_odd_case(spark):
    sentence = lambda i: ". ".join(prose(31 * i + k, 12).replace("\n", "").replace(".", "").capitalize() for k in range(10))
    row = lambda i, t: (i, t, "en", "s", 1, "r", 1, "f", "s", "k", "q")
    odd = ["".join(c.upper() if k % 2 else c.lower() for k, c in enumerate(sentence(900 + i))) for i in range(3)]
    docs = documents(spark, [row(i, sentence(i)) for i in range(200)] + [row(1000 + i, t) for i, t in enumerate([*odd, sentence(950).upper()])])
    assert {r["doc_id"] for r in quality.judged(docs).where("kept").collect()} == set(range(200))
    # without a language, all are of the null one
    assert {r["doc_id"] for r in quality.judged(docs.drop("lang")).where("kept").collect()} == set(range(200))


def test_quality_rejects_odd_texts(spark):
    good = [(i, prose(i, 80), "en", "s", 1, "r", 1, "f", "s", "k", "q") for i in range(200)]
    odd = [(1000 + i, " ".join(f"{a * 7919 % 997}|{a}" for a in range(i, i + 80)), "en", "s", 1, "r", 1, "f", "s", "k", "q") for i in range(3)]
    kept = {r["doc_id"] for r in quality.judged(documents(spark, good + odd)).where("kept").collect()}
    assert kept == set(range(200))


def test_quality_keeps_a_rare_clean_language(spark):
    row = lambda i, t, lang: (i, t, lang, "s", 1, "r", 1, "f", "s", "k", "q")
    much = [row(i, prose(i, 80), "en") for i in range(200)]
    rare = [row(1000 + i, prose(1000 + i, 80, "ghijklmnopqrstuvwxyz"), "xx") for i in range(12)] + [row(2000, prose(2000, 80, "привет"), "yy"), row(2001, "too short", "zz")]
    odd = row(3000, " ".join(f"{a * 7919 % 997}|{a}" for a in range(80)), "xx")
    out = {r["doc_id"]: r for r in quality.judged(documents(spark, [*much, *rare, odd])).collect()}
    assert {i for i, r in out.items() if r["kept"]} == {*range(200), *range(1000, 1012), 2000}
    assert out[2001]["upper"] is None and out[1000]["lower"] < out[1000]["perplexity"] < out[1000]["upper"]


def test_second_count_is_over_all_documents(spark):
    main, side, alone = ["abc abd abe", "abc abf"], ["xyz xyw"], ["#%&"]
    docs = spark.createDataFrame([(t, 0.0, 0.01) for t in main] + [(t, -9.0, 0.5) for t in side] + [(t, None, None) for t in alone], "text string, center double, scale double")
    model = quality.kneser_ney(quality.counted(docs.select("text")))
    all_codes = {r["code"] for r in quality.counted(docs.select("text")).collect()}
    second = {r["code"]: r["n"] for r in quality.counted(docs, model, 2.5).collect()}
    assert set(second) == all_codes and min(second.values()) > 0 and max(second.values()) <= 3


def test_token_cache_keeps_no_long_words():
    """In text without white space a word may be a whole document: it is counted, not kept."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    count, tok = token_counts.word_counter(path), Tokenizer.from_file(path)
    texts = ["中文字" * 5000, "ab1" * 20_000, prose(3, 400).replace(" ", ""), "é" * 9000, "don't" * 50, "x" * 47 + " " + "x" * 49]
    assert [count(t) for t in texts + texts] == [len(tok.encode(t, add_special_tokens=False).ids) for t in texts] * 2
    kept = next(c.cell_contents for c in count.__closure__ if isinstance(c.cell_contents, dict) or hasattr(c.cell_contents, "__self__"))
    kept = getattr(kept, "__self__", kept)
    assert all(len(w) <= token_counts.KEPT for w in kept)

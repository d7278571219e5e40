"""LM scoring by a hidden Markov model over words.

A latent state moves by a transition matrix and emits a word class; the class emits the
word. The ``top`` most frequent training tokens are classes of their own, all others share
``SUFFIXES`` classes by their last three bytes, so that the model has states times
classes parameters however large the vocabulary, while each word keeps its own count:
P(word | class) = (c + 1) / (sum of the class's known (c + 1), + 1 for the unknown word).

1. Blocks of documents send their distinct tokens with training counts to shards; the
   shards answer with each token's count over all training documents, and give N, V, the
   class masses and the most frequent tokens.
2. Baum-Welch: every training document's expected transition and emission counts are
   summed in its task, then by Spark over all partitions; only states times classes
   numbers reach the driver. Long documents train in segments; a segment that is not
   a document's first begins with the token before it, from the states' overall shares, so that
   the move over each border is counted, and that token's emission once.
   The first estimate gives each frequent language two states, slightly apart.
3. The scaled forward recursion runs over each whole document, and its log scales add
   up to the exact likelihood of the class sequence.

Words travel as 55 bits of a hash beside the 9 bits of their suffix class.

Defined results: null, empty and blank texts are the end token alone; a null doc_id is
training (the checksum of the empty text); rows that repeat are counted and scored each;
without any training document all counts are zero and states are uniform. doc_id is cast to
long: a text id that is no number ends the job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.llm.blocks import answers, as_table, by_shard, dealt, ordered, shard_rows
from talentlake.llm.common import parts, prepare, text_bytes, text_size, written

SUFFIXES = 512
END_KEY = np.uint64(1 << 63)  # the end token; its class is 0
SEGMENT = 256
TOKENS = 1 << 18  # of a training batch
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(9, 14)]] = True
SENT = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def token_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens, each text's end token last, and tokens of each text."""
    low = [t.lower() for t in texts]
    words = [t.split() for t in low]
    n = np.array([len(w) for w in words], np.int64)
    h = np.fromiter((x for w in words for x in map(xxhash.xxh3_64_intdigest, w)), np.uint64, int(n.sum()))
    b = np.frombuffer(b"\n\n\n" + b"\n".join(low) + b"\n", np.uint8)
    space = SPACE[b]
    last = np.flatnonzero(~space[:-1] & space[1:])
    # up to three last bytes of the word; what precedes a short word is white space
    c = [np.where(space[last - k], 0, b[last - k]).astype(np.uint64) for k in range(3)]
    c[2] = np.where(c[1] == 0, np.uint64(0), c[2])
    suffix = (c[0] * np.uint64(7919) + c[1] * np.uint64(104729) + c[2] * np.uint64(1299709)) % np.uint64(SUFFIXES)
    keys = ((h >> np.uint64(9)) << np.uint64(9)) | suffix
    keys[keys == END_KEY] += np.uint64(SUFFIXES)
    ends = np.cumsum(n)
    out = np.full(len(keys) + len(texts), END_KEY)
    at = np.ones(len(out), bool)
    at[ends + np.arange(len(texts))] = False
    out[at] = keys
    return out, n + 1


class Classes:
    """Class of a key: 0 the end, 1.. the most frequent tokens, then the suffixes."""

    def __init__(self, top: np.ndarray):
        self.top = np.sort(top)
        self.n = 1 + len(top) + SUFFIXES

    def of(self, keys: np.ndarray) -> np.ndarray:
        out = (1 + len(self.top) + (keys & np.uint64(SUFFIXES - 1))).astype(np.int32)
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, keys), len(self.top) - 1)
            out = np.where(self.top[at] == keys, at + 1, out)
        return np.where(keys == END_KEY, 0, out).astype(np.int32)


def segments(n: np.ndarray, most: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, length, first of its text) of the parts of texts, longest first; a part that is not
    the first has the token before it too."""
    begin = np.cumsum(n) - n
    if most is None:
        b, size, first = begin, n, np.ones(len(n), bool)
    else:
        k = -(-n // most)
        text = np.repeat(np.arange(len(n)), k)
        part = np.arange(len(text)) - np.repeat(np.cumsum(k) - k, k)
        first = part == 0
        b = begin[text] + part * most - ~first
        size = np.minimum(most, n[text] - part * most) + ~first
    order = np.argsort(-size, kind="stable")
    return b[order], size[order], first[order]


def alive(size: np.ndarray) -> list[int]:
    """How many of the parts, longest first, reach each step."""
    return np.searchsorted(-size, -np.arange(int(size.max(initial=0))), "left").tolist()


def likelihoods(classes: np.ndarray, n: np.ndarray, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """log10 P(class sequence) of each text, by the scaled forward recursion. emit: classes x states."""
    b, size, _ = segments(n, None)
    total = np.zeros(len(n))
    a = None
    for t, m in enumerate(alive(size)):
        e = emit[classes[b[:m] + t]]
        a = (start if a is None else a[:m] @ move) * e
        c = a.sum(axis=1)
        a /= c[:, None]
        total[:m] += np.log10(c)
    out = np.empty(len(n))
    out[np.argsort(-n, kind="stable")] = total
    return out


def expected(classes: np.ndarray, n: np.ndarray, start: np.ndarray, share: np.ndarray, move: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of starts, moves and emissions (forward-backward over segments)."""
    b, size, first = segments(n, SEGMENT)
    steps = alive(size)
    alphas, emits, seen = [], [], []
    a = None
    for t, m in enumerate(steps):
        c = classes[b[:m] + t]
        e = emit[c]
        a = (np.where(first[:, None], start, share) if a is None else a[:m] @ move) * e
        scale = a.sum(axis=1, keepdims=True)
        a = a / scale
        alphas.append(a)
        emits.append(e / scale)
        seen.append(c)
    moves = np.zeros(move.shape)
    beta = np.ones_like(alphas[-1])
    gammas = [alphas[-1]]
    back = np.ascontiguousarray(move.T)
    for t in range(len(steps) - 2, -1, -1):
        m = steps[t + 1]
        w = emits[t + 1] * beta
        moves += alphas[t][:m].T.astype(np.float64) @ w
        beta = np.ones_like(alphas[t])
        beta[:m] = w @ back
        gammas.append(alphas[t] * beta)
    gammas.reverse()
    starts = gammas[0][first].sum(axis=0, dtype=np.float64)
    gammas[0] = gammas[0] * first[:, None]  # of the other parts, the part before counted it
    flat, g = np.concatenate(seen), np.concatenate(gammas)
    emissions = np.stack([np.bincount(flat, g[:, k], minlength=len(emit)) for k in range(emit.shape[1])], axis=1)
    return starts, moves * move, emissions


class Parameters:
    """start, share (K), move (K x K) and emit (classes x K), from expected counts."""

    def __init__(self, starts: np.ndarray, moves: np.ndarray, emissions: np.ndarray, prior: float = 100.0):
        overall = emissions.sum(axis=1) + 1.0
        held = emissions + prior * (overall / overall.sum())[:, None]
        norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
        self.start = norm(starts + 1.0, 0).astype(np.float32)
        self.share = norm(emissions.sum(axis=0) + 1.0, 0).astype(np.float32)
        self.move = norm(moves + 1.0, 1).astype(np.float32)
        self.emit = norm(held, 0).astype(np.float32)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.start, self.share, self.move, self.emit


def summed(rows: DataFrame, cells: int) -> np.ndarray:
    """Sums (cell, value) rows over all partitions; the number of cells is the model's size.
    Values are counted in 2^-20, as whole numbers, so that reruns agree."""
    out = np.zeros(cells)
    t = rows.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out[t.column("cell").to_numpy()] = t.column("value").to_numpy() / float(1 << 20)
    return out


def cell_batch(flat: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(flat)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.rint(flat[at] * (1 << 20)).astype(np.int64))], ["cell", "value"])


def training_batches(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list]]:
    texts, langs, size = [], [], 0
    for t, g in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
        texts.append(t)
        langs.append(g)
        size += len(t)
        if size > 6 * TOKENS:
            yield texts, langs
            texts, langs, size = [], [], 0
    if texts:
        yield texts, langs


def first_counts(train: DataFrame, top: np.ndarray, languages: list[str]) -> np.ndarray:
    """Class counts (classes x groups) of the training texts by language; other languages are the last group."""
    classes, groups = Classes(top), len(languages) + 1
    n_classes = classes.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_classes * groups, np.int64)
        known = {g: i for i, g in enumerate(languages)}
        c = Classes(top)
        for b in batches:
            for texts, langs in training_batches(b):
                keys, n = token_keys(texts)
                group = np.repeat([known.get(g, groups - 1) for g in langs], n)
                total += np.bincount(c.of(keys).astype(np.int64) * groups + group, minlength=len(total))
        yield cell_batch(total.astype(np.float64))

    return summed(train.mapInArrow(run, "cell int, value long"), n_classes * groups).reshape(n_classes, groups)


def baum_welch(train: DataFrame, top: np.ndarray, p: Parameters) -> Parameters:
    """One iteration over all training texts."""
    shared = train.sparkSession.sparkContext.broadcast((top, p.arrays()))
    k, n_classes = len(p.start), p.emit.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, (start, share, move, emit) = shared.value
        c = Classes(top)
        total = np.zeros(k + k * k + n_classes * k)
        for b in batches:
            for texts, _ in training_batches(b):
                keys, n = token_keys(texts)
                total += np.concatenate([x.ravel() for x in expected(c.of(keys), n, start, share, move, emit)])
        yield cell_batch(total)

    flat = summed(train.mapInArrow(run, "cell int, value long"), k + k * k + n_classes * k)
    shared.unpersist()
    return Parameters(flat[:k], flat[k : k + k * k].reshape(k, k), flat[k + k * k :].reshape(n_classes, k))


def vocabulary(table: pa.Table, top: int, out: pa.Schema) -> pa.Table:
    """Shard function: training counts of each block's keys; in a row of its own (block -1) what
    the shard has in all: tokens, distinct ones, mass and number of each suffix, the top ones."""
    keys = [np.frombuffer(b, np.uint64) for b in table.column("keys").to_pylist()]
    counts = np.concatenate([np.frombuffer(b, np.uint32) for b in table.column("counts").to_pylist()]).astype(np.int64)
    u, inv = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inv, counts, len(u)).astype(np.int64)
    ends = np.cumsum([0, *map(len, keys)])
    each = total[inv]
    rows = [{"block": b, "shard": s, "answer": each[x:y].tobytes()} for b, s, x, y in zip(table.column("block").to_pylist(), table.column("shard").to_pylist(), ends[:-1], ends[1:])]
    known = np.flatnonzero((total > 0) & (u != END_KEY))
    order = known[np.lexsort((u[known], -total[known]))][:top]
    suffix = (u[known] & np.uint64(SUFFIXES - 1)).astype(np.int64)
    mass = np.bincount(suffix, total[known] + 1, SUFFIXES).astype(np.int64)
    rows.append({"block": -1, "shard": rows[0]["shard"], "n": int(total.sum()), "v": int((total > 0).sum()), "mass": mass.tolist(), "top": u[order].view(np.int64).tolist(), "top_n": total[order].tolist()})
    return pa.Table.from_pylist(rows, schema=out)


def score(docs: DataFrame, states: int = 8, top: int = 8192, iterations: int = 2, folds: int = 7, held: int = 2, block_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    _, size = text_size(docs)
    blocks, shards = parts(size, block_bytes), parts(size, 2 * block_bytes)
    held_out = (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(folds)) == held)
    rows = dealt(docs, blocks, {"held_out": held_out})

    def send(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        table = ordered(table)
        keys, n = token_keys(table.column("text").to_pylist())
        train = np.repeat(~table.column("carry_0").to_numpy(zero_copy_only=False).astype(bool), n)
        u, inv = np.unique(keys, return_inverse=True)
        counts = np.bincount(inv, train, len(u)).astype(np.uint32)
        return as_table(list(shard_rows(block, *by_shard(u, shards), {"keys": u, "counts": counts})), SENT)

    whole = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("answer", pa.binary()), ("n", pa.int64()), ("v", pa.int64()), ("mass", pa.list_(pa.int64())), ("top", pa.list_(pa.int64())), ("top_n", pa.list_(pa.int64()))])
    sent = rows.groupBy("block").applyInArrow(send, "shard int, block int, keys binary, counts binary")
    reply = written(sent.groupBy("shard").applyInArrow(lambda t: vocabulary(t, top, whole), "block int, shard int, answer binary, n long, v long, mass array<long>, top array<long>, top_n array<long>"))
    stats = reply.where("block = -1")
    r = stats.agg(F.sum("n").alias("n"), F.sum("v").alias("v"), *[F.sum(F.element_at("mass", i + 1)).alias(f"m{i}") for i in range(SUFFIXES)]).first()
    n_all, v_all = int(r["n"] or 0), int(r["v"] or 0)
    frequent = stats.select(F.explode(F.arrays_zip("top", "top_n")).alias("x")).select("x.top", "x.top_n").orderBy(F.desc("top_n"), "top").limit(top).toArrow()
    top_keys, top_n = frequent.column("top").to_numpy().astype(np.int64).view(np.uint64), frequent.column("top_n").to_numpy().astype(np.int64)
    mass = np.array([float(r[f"m{i}"] or 0) for i in range(SUFFIXES)])
    mass -= np.bincount((top_keys & np.uint64(SUFFIXES - 1)).astype(np.int64), top_n + 1, SUFFIXES)
    p = trained(docs, held_out, top_keys, states, iterations)
    shared = spark.sparkContext.broadcast((top_keys, p.arrays(), mass))

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        top_keys, (start, _, move, emit), mass = shared.value
        classes = Classes(top_keys)
        left = ordered(left)
        keys, n = token_keys(left.column("text").to_pylist())
        u, inv = np.unique(keys, return_inverse=True)
        order, _ = by_shard(u, shards)
        c = answers(list(zip(right.column("shard").to_pylist(), right.column("answer").to_pylist())), order, np.int64)
        kind = classes.of(u)
        alone = kind <= len(top_keys)
        word = np.where(alone, 0.0, np.log10((c + 1) / (mass[(u & np.uint64(SUFFIXES - 1)).astype(np.int64)] + 1)))
        base = np.log10((c + 1) / (n_all + v_all + 1))
        begins = np.cumsum(n) - n
        total = lambda x: np.add.reduceat(x[inv], begins) if len(n) else np.zeros(0)
        model = total(word) + likelihoods(kind[inv], n, start.astype(np.float64), move.astype(np.float64), emit.astype(np.float64))
        cols = [left.column("doc_id"), left.column("carry_0"), pa.array(n), pa.array(total((c > 0).astype(np.int64))), pa.array(np.full(len(n), n_all)), pa.array(total(base)), pa.array(model)]
        return pa.table(cols, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    answers_ = reply.where("block >= 0").select("block", "shard", "answer")
    return rows.groupBy("block").cogroup(answers_.groupBy("block")).applyInArrow(judge, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def trained(docs: DataFrame, held_out, top: np.ndarray, states: int, iterations: int) -> Parameters:
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    train = docs.where(~held_out).select(text_bytes().alias("text"), lang.alias("lang"))
    groups = max(1, states // 2)
    languages = [x["lang"] for x in train.where("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(groups).collect()]
    counts = first_counts(train, top, languages)
    other = counts.sum(axis=1, keepdims=True) if not len(languages) or counts[:, -1].sum() * 100 > counts.sum() else None
    columns = [counts[:, [i]] for i in range(len(languages))] + ([other] if other is not None else [])
    rng = np.random.default_rng(7)
    emissions = np.concatenate([columns[i % len(columns)] for i in range(states)], axis=1) * np.exp(rng.normal(0, 0.2, (len(counts), states)))
    like = np.array([[1.0 if i % len(columns) == j % len(columns) else 0.01 for j in range(states)] for i in range(states)])
    p = Parameters(emissions.sum(axis=0), like * 1000, emissions)
    for _ in range(iterations):
        p = baum_welch(train, top, p)
    return p

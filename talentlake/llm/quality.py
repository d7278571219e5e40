"""Quality rules: n-gram perplexity under a modified Kneser-Ney model, beside base rules.

The n-grams are of four symbols, of 64 classes: letters, digits, space, line break, sentence
ends, other punctuation, other ASCII symbols, and 30 that share all other characters by code
point. Letters are folded, and each run of upper-case letters has a mark before it, a symbol of its
own: so the model knows where texts write capitals (after a sentence's end and a space, or at
a word's begin) and where not. A model of any corpus has at most 64^4 entries (16.8
million, 200 MB at the very most, a few MB on real text), which bounds what the driver
gathers and broadcasts, and counting needs no shuffle of texts or words. Word n-grams have no
such bound.

1. Spark counts the 4-grams of all documents: sorted codes in each task, then sums.
2. Continuation counts, counts of counts, discounts D1, D2 and D3+ of each order and the
   interpolation weights of each context follow from that table by aggregations.
3. The model is two sorted arrays for each order, of hashes (the packed classes) with
   log probabilities and of context hashes with back-off weights; what is not found
   backs off. A task spreads the longest order over a direct index, as nearly every
   look-up ends there.
4. Each language has a band for the log perplexity, from the quartiles of its documents
   that pass the base rules. A band widens for short texts as the spread of a
   mean does, and the fewer documents tell it: its spread is drawn to that within all
   languages as by PRIOR documents, its centre is always the language's own.
5. The model is counted once more, from all documents, each with a weight that falls
   smoothly with its distance from the middle of its band and never to zero. An n-gram's
   sum of weights is its count; below one, it keeps the square of it after discounting,
   so that a few odd documents don't teach the model that they are usual, and many of a
   kind do. By the second model's perplexities and bands, documents beyond their
   language's band, above or below, are rejected.

Defined results: null, empty and blank texts have no words, fail the base rules and have no
perplexity; a null language is a language of its own; rows that repeat are judged alike; a
language without a document that passes the base rules has no band. doc_id is cast to long (a
text id that is no number ends the job); without a column lang all documents are of the null one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talentlake.llm.blocks import mixed, rolling
from talentlake.llm.common import prepare, row_key, text_bytes, written

ORDER, CLASS_BITS = 4, 6
CLASSES = 1 << CLASS_BITS
UPPER, CAPITALS = CLASSES, 33  # flag of an upper-case letter; class of the mark before a run of them
CASED = 0x1E944  # code points below it may be letters of two cases
CHUNK = 1 << 19  # bytes of text worked on at once
SYMBOLS = b"#*$%&|<>"
BASE = 0x9E3779B97F4A7C15
WHOLE_BITS = np.uint64(16)
WHOLE, STEEP = 1 << 16, 8  # steps of a text's weight, power by which it falls
PRIOR = 10  # documents that the spread within all languages counts for


def class_table() -> np.ndarray:
    """Class of each code point, with UPPER added for upper-case letters; 0 is the mark before
    a text's begin."""
    t = (34 + np.arange(0x110000) % 30).astype(np.uint8)
    t[:128] = 32
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz"):
        t[ord(c)] = i + 1
    t[ord("0") : ord("9") + 1] = 27
    t[[ord(c) for c in " \t\v\f\r"]] = 28
    t[ord("\n")] = 29
    t[[ord(c) for c in ".!?"]] = 30
    t[[ord(c) for c in ",;:'\"()-"]] = 31
    for i in range(CASED):
        low = chr(i).lower()
        if low != chr(i) and len(low) == 1:
            t[i] = t[ord(low)] | UPPER
    return t


def chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def ngrams(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed classes of the 4-gram that ends at each symbol, and symbols of each text."""
    points = [np.frombuffer(t.decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for t in texts]
    pad = np.zeros(ORDER - 1, np.uint8)
    c = np.concatenate([x for p in points for x in (pad, table[p])]) if points else pad[:0]
    upper = c >= UPPER
    mark = upper.copy()
    mark[1:] &= ~upper[:-1]
    marks = np.cumsum(mark)
    at = np.flatnonzero(mark)
    c = np.repeat(c & (UPPER - 1), 1 + mark.astype(np.int8)).astype(np.uint32)
    c[at + np.arange(len(at))] = CAPITALS
    ends = np.cumsum([len(p) + ORDER - 1 for p in points], dtype=np.int64)  # with pads, without marks
    ends += marks[ends - 1] if len(marks) else 0
    n = np.diff(np.r_[0, ends]) - (ORDER - 1)
    code = c[ORDER - 1 :].copy()
    for k in range(1, ORDER):
        code |= c[ORDER - 1 - k : len(c) - k] << np.uint32(CLASS_BITS * k)
    keep = np.ones(len(code), bool)
    for e in (ends - (ORDER - 1))[:-1].tolist():
        keep[e : e + ORDER - 1] = False
    return code[keep], n


class Model:
    """Sorted hashes with log10 probabilities, and sorted context hashes with log10
    back-off weights, for each order from 1 on."""

    def __init__(self, probabilities: list[tuple[np.ndarray, np.ndarray]], weights: list[tuple[np.ndarray, np.ndarray]]):
        self.probabilities, self.weights = probabilities, weights

    @staticmethod
    def find(pair: tuple[np.ndarray, np.ndarray], code: np.ndarray, other: float) -> np.ndarray:
        keys, values = pair
        if not len(keys):
            return np.full(len(code), other)
        at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
        return np.where(keys[at] == code, values[at], other)

    def score(self, code: np.ndarray, order: int = ORDER) -> np.ndarray:
        """log10 P(last class | classes before) of packed n-grams."""
        if not order:
            return np.full(len(code), -np.log10(CLASSES))
        code = code & np.uint32((1 << CLASS_BITS * order) - 1)
        out = self.find(self.probabilities[order - 1], code, np.nan)
        miss = np.flatnonzero(np.isnan(out))
        if len(miss):
            rest = code[miss]
            out[miss] = self.find(self.weights[order - 1], rest >> np.uint32(CLASS_BITS), 0.0) + self.score(rest, order - 1)
        return out

    def index(self) -> np.ndarray:
        """The longest order as a direct table, NaN where it backs off."""
        table = np.full(CLASSES**ORDER, np.nan, np.float32)
        table[self.probabilities[-1][0]] = self.probabilities[-1][1]
        return table


def mean_scores(m: Model, index: np.ndarray, code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Mean log10 probability of a symbol, for each text; NaN for an empty one."""
    lp = index[code]
    miss = np.flatnonzero(np.isnan(lp))
    if len(miss):
        lp[miss] = m.score(code[miss])
    total = np.diff(np.r_[0.0, np.cumsum(lp, dtype=np.float64)][np.r_[0, np.cumsum(n)]])
    return np.where(n > 0, total / np.maximum(n, 1), np.nan)


def half_band(scale, spread: float, n, root, at_least):
    """Half the width of a band for a text of n symbols: ``spread`` deviations, of the
    language's texts and of a mean of n of them (0.45 each, about)."""
    return spread * root(scale * scale + 0.2 / at_least(n))


def counted(docs: DataFrame, model: Model | None = None, spread: float = 0.0) -> DataFrame:
    """(code, n): 4-grams of all texts and how often they occur. With a model, a text counts
    by its weight: one half at ``spread`` from the middle of its language's band (columns
    center and scale; without a band, one), falling with the STEEP-th power beyond, in
    units of 1 / WHOLE, one at least, so that sums don't depend on their order."""
    shared = None if model is None else docs.sparkSession.sparkContext.broadcast((model.probabilities, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        total = np.zeros(CLASSES**ORDER, np.uint32 if shared is None else np.int64)
        m = None if shared is None else Model(*shared.value)
        index = None if m is None else m.index()
        for b in batches:
            texts = b.column("text").to_pylist()
            if m is not None:
                center, scale = (b.column(c).to_numpy(zero_copy_only=False) for c in ("center", "scale"))
            at = 0
            for part in chunks(texts):
                code, n = ngrams(part, table)
                if m is not None:
                    mean = mean_scores(m, index, code, n)
                    own = slice(at, at + len(part))
                    off = np.abs(-mean - center[own]) / half_band(scale[own], spread, n, np.sqrt, lambda x: np.maximum(x, 1))
                    weight = np.maximum(np.rint(WHOLE / (1 + np.nan_to_num(off, nan=0.0) ** STEEP)), 1).astype(np.uint64)
                    code = (code.astype(np.uint64) << WHOLE_BITS) | np.repeat(weight - np.uint64(1), n)
                at += len(part)
                code = np.sort(code)
                gram = code if m is None else code >> WHOLE_BITS
                new = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]]) if len(code) else np.zeros(0, np.int64)
                if m is None:
                    total[code[new]] += np.diff(np.r_[new, len(code)]).astype(np.uint32)
                elif len(code):
                    total[gram[new]] += np.add.reduceat((code & np.uint64(WHOLE - 1)).astype(np.int64) + 1, new)
                if m is None and total.max(initial=0) > 1 << 31:
                    yield emit(total)
                    total[:] = 0
        yield emit(total)

    def emit(total: np.ndarray) -> pa.RecordBatch:
        code = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(code.astype(np.int32)), pa.array(total[code].astype(np.int64))], ["code", "n"])

    each = docs.select(text_bytes().alias("text"), *(["center", "scale"] if shared else [])).mapInArrow(run, "code int, n long")
    sums = each.groupBy("code").agg(F.sum("n").alias("n"))
    return sums if model is None else sums.withColumn("n", F.col("n") / WHOLE)


def discounts(grams: DataFrame) -> tuple[float, float, float]:
    """D1, D2, D3+ from the counts of counts (Chen and Goodman)."""
    share = lambda k: F.greatest(F.lit(0.0), 1 - F.abs(F.col("n") - k))  # noqa: E731 - of a count between two whole ones
    r = grams.agg(*[F.sum(share(k)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (float(r[f"n{k}"] or 0) for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3 and n4):  # too little text for the estimate
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))


def discounted(n: Column, d: tuple[float, float, float]) -> Column:
    """What a count gives up; one below 1 keeps (1 - D1) n^2."""
    between = lambda k: d[k - 1] + (n - k) * (d[k] - d[k - 1])
    return F.when(n < 1, n - (1 - d[0]) * n * n).when(n < 2, between(1)).when(n < 3, between(2)).otherwise(F.lit(d[2]))


def kneser_ney(grams: DataFrame) -> Model:
    """The interpolated modified Kneser-Ney model of counted 4-grams. Counts need not be whole:
    discounts are interpolated, and a count below one continues a context by as much."""
    low = lambda c, k: c.bitwiseAND(F.lit((1 << CLASS_BITS * k) - 1))
    orders = {ORDER: grams}
    for k in range(ORDER - 1, 0, -1):
        orders[k] = orders[k + 1].groupBy(low(F.col("code"), k).alias("code")).agg(F.sum(F.least(F.col("n"), F.lit(1.0))).alias("n"))
    lower, probabilities, weights = None, [], []
    for k in range(1, ORDER + 1):
        d = discounts(orders[k])
        x = orders[k].withColumn("context", F.shiftrightunsigned("code", CLASS_BITS)).withColumn("d", discounted(F.col("n"), d))
        held = x.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("weight"))
        x = x.join(held, "context")
        if lower is None:
            x = x.withColumn("below", F.lit(1.0 / CLASSES))
        else:
            x = x.join(lower, low(x["code"], k - 1) == lower["short"])
        x = written(x.select("code", ((F.col("n") - F.col("d")) / F.col("total") + F.col("weight") * F.col("below")).alias("p")))
        lower = x.select(F.col("code").alias("short"), F.col("p").alias("below"))
        probabilities.append(sorted_arrays(x.select("code", F.log10("p").alias("v"))))
        weights.append(sorted_arrays(held.select(F.col("context").alias("code"), F.log10("weight").alias("v"))))
    return Model(probabilities, weights)


def sorted_arrays(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most 64^4 rows, by construction of the codes."""
    t = df.toArrow()
    code, v = t.column("code").to_numpy().astype(np.uint32), t.column("v").to_numpy().astype(np.float32)
    order = np.argsort(code)
    return code[order], v[order]


def base_measures(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    size = np.array([len(t) for t in texts], np.int64)
    b = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.cumsum(size) - size
    space = np.zeros(256, bool)
    space[[0x20, *range(9, 14)]] = True
    first = (b & 0xC0) != 0x80
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    total = lambda x: np.diff(np.r_[0, np.cumsum(x, dtype=np.int64)][np.r_[bounds, len(b)]])
    words = [t.split() for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    lines = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if b"\n" in t:
            each = [x for x in t.split(b"\n") if x.strip()]
            lines[i] = len(each) - len(set(each))
    h = np.fromiter((hash(w) for each in words for w in each), np.int64, int(n.sum())).view(np.uint64)
    text = np.repeat(np.arange(len(texts)), n)
    ends = np.cumsum(n)
    windows = np.flatnonzero(np.arange(len(h)) + 5 <= np.repeat(ends, n))
    repeats = np.zeros(len(h) + 1, np.int64)
    if len(windows):
        key = mixed(rolling(h, 5, BASE)[windows] + mixed(text[windows].astype(np.uint64) + np.uint64(1)))
        order = np.sort(key)
        twice = np.unique(order[1:][order[1:] == order[:-1]])
        if len(twice):
            at = windows[np.isin(key, twice)]
            repeats[at] += 1
            np.add.at(repeats, at + 5, -1)
    covered = np.cumsum(repeats[:-1]) > 0
    repeated = np.diff(np.r_[0, np.cumsum(covered, dtype=np.int64)][np.r_[0, ends]])
    return {"n_words": n, "word_chars": total(first & ~space[b]), "n_symbols": total(symbol[b]), "n_dup_lines": lines, "n_repeat_words": repeated}


def language(docs: DataFrame) -> Column:
    return (F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")).alias("lang")


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_points")


def measured(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, rid, lang), the base measures, and the mean log10 probability of a symbol."""
    shared = docs.sparkSession.sparkContext.broadcast((model.probabilities, model.weights))  # plain arrays: a class would need the package there

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, m = class_table(), Model(*shared.value)
        index = m.index()
        for b in batches:
            out = []
            for part in chunks(b.column("text").to_pylist()):
                code, n = ngrams(part, table)
                out.append(base_measures(part) | {"n_points": n, "mean": mean_scores(m, index, code, n)})
            cols = [pa.array(np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64)) for k in MEASURES]
            mean = np.concatenate([o["mean"] for o in out]) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("rid"), b.column("lang"), *cols, pa.array(mean, from_pandas=True)], ["doc_id", "rid", "lang", *MEASURES, "mean"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("rid", T.LongType()), T.StructField("lang", T.StringType())] + [T.StructField(k, T.LongType()) for k in MEASURES] + [T.StructField("mean", T.DoubleType())])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("rid"), language(docs), text_bytes().alias("text")).mapInArrow(run, schema)


def judged(docs: DataFrame, spread: float = 5.0, core: float = 1.5, least_words: int = 10, most_repeated: int = 20) -> DataFrame:
    """(doc_id, rid, the measures, base_failed, perplexity, lower, upper, kept) of every row."""
    spark = prepare(docs.sparkSession)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    model = kneser_ney(written(counted(docs)))
    bands = written(banded(measured(docs, model).where(~failed)))
    text = docs.select(language(docs), "text")
    model = kneser_ney(written(counted(with_band(text, bands), model, core)))
    rows = written(measured(docs, model).withColumn("base_failed", failed))
    x = with_band(rows, written(banded(rows.where(~F.col("base_failed")))))
    half = half_band(F.col("scale"), spread, F.col("n_points"), F.sqrt, lambda n: F.greatest(n, F.lit(1)))
    ten = lambda c: F.pow(F.lit(10.0), c)
    x = x.withColumn("perplexity", ten(-F.col("mean"))).withColumn("lower", ten(F.col("center") - half)).withColumn("upper", ten(F.col("center") + half))
    fine = F.col("perplexity").between(F.col("lower"), F.col("upper"))
    return x.select("doc_id", "rid", *MEASURES[:5], "base_failed", "perplexity", "lower", "upper", (~F.col("base_failed") & F.coalesce(fine, F.lit(False))).alias("kept"))


def banded(rows: DataFrame) -> DataFrame:
    """(l, center, scale): of the log10 perplexities of each language's texts the median and the
    deviation that the quartiles tell, widened as the sample is small."""
    # exact quartiles over values in steps of 1e-4: a few thousand values whatever the input
    quartiles = F.percentile(F.round(-F.col("mean"), 4), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q")
    each = rows.groupBy(F.col("lang").alias("l")).agg(quartiles, F.count(F.lit(1)).alias("n"))
    # the quartile range of a normal value is 1.349 deviations
    each = written(each.select("l", F.col("q")[1].alias("center"), F.pow((F.col("q")[2] - F.col("q")[0]) / 1.349, F.lit(2.0)).alias("own"), "n"))
    within = each.agg((F.sum(F.col("own") * F.col("n")) / F.sum("n")).alias("within"))
    drawn = (F.col("n") * F.col("own") + PRIOR * F.col("within")) / (F.col("n") + PRIOR)
    # 1.57 / n: variance of a median; 8 / (n + PRIOR): how much farther out Student's t has what 5 deviations cut off
    wider = F.sqrt(1 + 1.57 / F.col("n")) * (1 + 8 / (F.col("n") + PRIOR))
    return each.join(F.broadcast(within)).select("l", "center", (F.sqrt(drawn) * wider).alias("scale"))  # one row


def with_band(rows: DataFrame, bands: DataFrame) -> DataFrame:
    """Adds center and scale of the row's language; null if it has none."""
    return rows.join(bands, F.col("lang").eqNullSafe(F.col("l")), "left").drop("l")

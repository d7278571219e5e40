"""Language identification with string kernels.

A text's spectrum is the set of its n-grams of one to ``LONGEST`` code points, blended:
letters in lower case, each run of anything else one space, a space at both ends; a space
alone is no n-gram. The kernel of two texts is the number of n-grams that both have, over
the square root of the product of the sizes of their spectra. N-grams are exact: three code
points of 21 bits make one 64-bit number, no hash.

1. A sample of about ``SAMPLE`` training rows of each language (a documented bound; rows by
   the hash of id and text) is written to the shared folder; its first rows of each language
   give about ``LANDMARKS`` landmarks in all, texts of up to ``LANDMARK_CHARS`` code points.
2. Nyström: a text is described by its kernels with the landmarks, K. The sample's K is a
   batched product of presence matrices, and each part of the sample gives the sums K'K and
   K'Y, Y one column for each language against the rest. A bounded number of such sums comes
   to the driver, which solves (K'K + ridge n Kmm) A = K'Y: kernel ridge regression.
3. All whole texts are scored in one narrow pass: presence (texts by n-grams) times landmarks
   times A. As the product is associative, n-grams times languages is computed once and each
   batch of texts is one sparse product with it.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is
everything if nothing can be learned; a text without an n-gram of any landmark gets the first
language by code point with score 0; equal scores go to the first language. The score is the
regression's value held to 0 and 1, to 9 digits. A null doc_id counts as the empty text; rows
that repeat are judged each. There is a column of the model for each learned language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from talentlake.llm.common import prepare, written

LONGEST = 3  # 21 bits a code point: three fit 64 bits
SAMPLE, LANDMARKS, LANDMARK_CHARS = 2000, 256, 20_000
RIDGE = 1e-4
PIECE = 1 << 20  # code points that are cut to n-grams at once
PARTS = 16  # parts of the sample, each with sums of its own


def letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else a space."""
    return np.array([ord(c.lower()[0]) if (c := chr(i)).isalpha() else 32 for i in range(0x110000)], np.uint32)


def spectrum(text: str | None, fold: np.ndarray) -> np.ndarray:
    """The distinct n-grams of a text as sorted numbers; none if it has no letter."""
    c = fold[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not (c != 32).any():
        return np.empty(0, np.uint64)
    c = np.concatenate([[32], c, [32]]).astype(np.uint64)
    c = c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]]
    found = []
    for a in range(0, len(c), PIECE):
        x = c[a : a + PIECE + LONGEST - 1]
        codes = [x]
        for n in range(1, LONGEST):
            codes.append(codes[-1][:-1] | x[n:] << np.uint64(21 * n) if len(x) > n else x[:0])
        found.append(distinct(np.concatenate([x[x != 32], *codes[1:]])))
    return found[0] if len(found) == 1 else distinct(np.concatenate(found))


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def places(grams: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Where the n-grams that the vocabulary has stand in it."""
    at = np.searchsorted(vocabulary, grams)
    at[at == len(vocabulary)] = 0
    return at[vocabulary[at] == grams] if len(vocabulary) else at[:0]


@dataclass
class Landmarks:
    """Spectra of the landmarks over their common vocabulary."""

    vocabulary: np.ndarray
    spectra: list[np.ndarray]  # places in the vocabulary

    @staticmethod
    def of(spectra: list[np.ndarray]) -> Landmarks:
        vocabulary = distinct(np.concatenate([np.empty(0, np.uint64), *spectra]))
        return Landmarks(vocabulary, [places(s, vocabulary) for s in spectra])

    def matrix(self) -> np.ndarray:
        """Presence of each n-gram in each landmark, over the root of the landmark's size."""
        out = np.zeros((len(self.vocabulary), len(self.spectra)), np.float32)
        for i, s in enumerate(self.spectra):
            out[s, i] = 1 / np.sqrt(len(s))
        return out

    def kernels(self, spectra: list[np.ndarray], matrix: np.ndarray) -> np.ndarray:
        """Texts by landmarks: one product of presence matrices."""
        there = np.zeros((len(spectra), len(self.vocabulary)), np.float32)
        for i, s in enumerate(spectra):
            there[i, places(s, self.vocabulary)] = 1 / np.sqrt(max(1, len(s)))
        return (there @ matrix).astype(np.float64)


@dataclass
class Model:
    languages: list[str]
    vocabulary: np.ndarray
    weights: np.ndarray  # n-grams by languages

    def scores(self, spectra: list[np.ndarray]) -> np.ndarray:
        """Texts by languages: a batch's presence matrix, kept sparse, times the weights."""
        at = [places(s, self.vocabulary) for s in spectra]
        out = np.zeros((len(spectra), len(self.languages)))
        some = [i for i, x in enumerate(at) if len(x)]
        if some:
            starts = np.cumsum([0, *(len(at[i]) for i in some[:-1])])
            sums = np.add.reduceat(self.weights[np.concatenate([at[i] for i in some])], starts, axis=0)
            out[some] = sums / np.sqrt([[len(spectra[i])] for i in some])
        return out


def batched(texts: list, size: int = 64) -> Iterator[list]:
    for a in range(0, len(texts), size):
        yield texts[a : a + size]


def fold_of(folds: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(folds))


def sampled(docs: DataFrame, learn: Column, sample: int) -> DataFrame:
    """(key, lang, text): about ``sample`` rows of each language, all rows where it has fewer."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64(F.col("doc_id").cast("string"), F.col("text")).alias("key"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return written(rows)
    rate = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample / n))])[F.col("lang")]
    # the key as a share of all keys
    return written(rows.where(F.col("key") / F.lit(2.0**64) + F.lit(0.5) <= rate))


def landmarks(sample: DataFrame, fold, count: int) -> Landmarks:
    languages = sample.select("lang").distinct().count()
    # another order than the sample's own, which took the smallest keys
    order = W.partitionBy("lang").orderBy(F.xxhash64("key", F.lit(1)), "key")
    short = sample.where(F.length("text") <= LANDMARK_CHARS).select("lang", "key").distinct()
    first = short.withColumn("i", F.row_number().over(order)).where(F.col("i") <= max(1, count // max(1, languages))).select("key").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([spectrum(t, fold.value).tobytes() for t in b.column("text").to_pylist()], pa.binary())], ["key", "grams"])

    found = sample.select("key", "text").join(first, "key", "left_semi").dropDuplicates(["key"]).mapInArrow(run, "key long, grams binary")
    spectra = [np.frombuffer(r["grams"], np.uint64) for r in sorted(found.collect(), key=lambda r: r["key"])]
    return Landmarks.of([s for s in spectra if len(s)])


def fitted(docs: DataFrame, learn: Column, fold, sample: int = SAMPLE, count: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """The model learned from the rows where ``learn`` holds; None if there is nothing to learn."""
    spark = docs.sparkSession
    rows = sampled(docs, learn, sample)
    marks = landmarks(rows, fold, count)
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not marks.spectra:
        return None
    sent = spark.sparkContext.broadcast(marks)
    m, k = len(marks.spectra), len(languages)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, kk, ky, n = sent.value.matrix(), np.zeros((m, m)), np.zeros((m, k)), 0
        for b in batches:
            for pairs in batched(list(zip(b.column("text").to_pylist(), b.column("lang").to_pylist()))):
                known = [(s, languages.index(lang)) for t, lang in pairs if len(s := spectrum(t, fold.value))]
                x = sent.value.kernels([s for s, _ in known], matrix)
                y = np.eye(k)[[i for _, i in known]] if known else np.zeros((0, k))
                kk, ky, n = kk + x.T @ x, ky + x.T @ y, n + len(known)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([kk.tobytes()], pa.binary()), pa.array([ky.tobytes()], pa.binary())], ["n", "kk", "ky"])

    # the same rows in the same order at each run, so that the sums agree
    parts = rows.repartition(PARTS, "key").sortWithinPartitions("key", "lang").select("text", "lang").mapInArrow(sums, "n long, kk binary, ky binary").collect()
    add = lambda c, shape: sum(np.frombuffer(r[c]).reshape(shape) for r in parts)
    matrix = marks.matrix()
    own = (matrix.T @ matrix).astype(np.float64)
    left = add("kk", (m, m)) + ridge * sum(r["n"] for r in parts) * own
    weights = np.linalg.lstsq(left, add("ky", (m, k)), rcond=1e-10)[0]
    sent.destroy()
    return Model(languages, marks.vocabulary, matrix @ weights)


def identify(docs: DataFrame, folds: int = 3, held: int = 1, sample: int = SAMPLE, count: int = LANDMARKS, ridge: float = RIDGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row. Learns from the rows whose
    crc32(doc_id as text) modulo ``folds`` is not ``held``."""
    prepare(docs.sparkSession)
    fold = docs.sparkSession.sparkContext.broadcast(letters())
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, fold_of(folds) != F.lit(held), fold, sample, count, ridge))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, values = [], []
            for texts in batched(b.column("text").to_pylist()):
                spectra = [spectrum(t, fold.value) for t in texts]
                scores = model.value.scores(spectra) if model.value else np.zeros((len(texts), 1))
                best = scores.argmax(axis=1)
                known = [bool(model.value) and len(s) > 0 for s in spectra]
                names += [model.value.languages[i] if x else "und" for i, x in zip(best.tolist(), known)]
                values += [round(min(1.0, max(0.0, s)), 9) if x else 0.0 for s, x in zip(scores.max(axis=1).tolist(), known)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()), pa.array(values, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", (fold_of(folds) == F.lit(held)).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")

"""Token counts by the whole-token shortcut.

Most pre-tokens of a text are strings that the vocabulary holds whole. Before
any text is read, each vocabulary string with a word end is encoded alone by the
library; those that come back as one token form the proven set. A pre-token in
the set counts one, and only the others run the merges.

Pre-tokens never cross white space, and neither the normaliser (NFC, lower case)
nor the pre-tokeniser looks across it, so the count of a text is the sum over its
white-space separated words. Each task keeps the counts of words it has met in a
cache of a bounded number of words of a bounded length.

Defined results: null and empty texts have 0 bytes and 0 tokens; rows that repeat
give a row each; special strings inside a text are single tokens, as the library
has it by default.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.llm.common import prepare

# Unicode White_Space, which is the library's \s; str.split() also splits at \x1c-\x1f.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Letters that NFC leaves alone and that lower-case one to one: precomposed Latin without the dotted I and the long s.
LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
# The vocabulary's pre-token pattern over such words, lower-cased.
PRE_TOKENS = f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LETTERS}]+|[0-9]|[^a-z0-9{LETTERS}]+"
CACHE = 500_000  # entries, about 60 MB for each of two caches
KEPT = 48  # characters of the longest word that is kept; in texts without white space a word may be the whole text


def whole_tokens(tok) -> frozenset[str]:
    """Vocabulary strings (byte-level spelling, without the word end) that the
    library encodes alone as exactly one token."""
    ends = [s[: -len("</w>")] for s in tok.get_vocab(with_added_tokens=False) if s.endswith("</w>") and len(s) > 4]
    return frozenset(s for s in ends if len(tok.model.tokenize(s)) == 1)


def byte_spelling() -> dict[int, str]:
    """How a byte-level vocabulary spells each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def word_counter(path: str, cache: int = CACHE) -> Callable[[str], int]:
    """Counts the tokens of a text; loads the vocabulary at ``path``.

    Words of plain letters (ASCII and precomposed Latin, which NFC leaves alone) are
    lower-cased and cut by the pattern here; the library does that for all others."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    whole, spelling = whole_tokens(tok), byte_spelling()
    special = [str(t.content) for t in tok.get_added_tokens_decoder().values()]
    normal, split, merges = tok.normalizer.normalize_str, tok.pre_tokenizer.pre_tokenize_str, tok.model.tokenize
    plain, cut = re.compile(f"[!-~{LETTERS}]+").fullmatch, re.compile(PRE_TOKENS).findall

    class Pieces(dict):
        """Tokens of a pre-token as the text has it."""

        def __missing__(self, piece: str) -> int:
            spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(spelling)
            n = 1 if spelled in whole else len(merges(spelled))
            if len(self) >= cache:
                self.clear()
            if len(piece) <= KEPT:
                self[piece] = n
            return n

    pieces = Pieces()

    class Words(dict):
        """Tokens of a white-space separated word."""

        def __missing__(self, word: str) -> int:
            if any(s in word for s in special):
                n = len(tok.encode(word, add_special_tokens=False).ids)
            elif plain(word):
                n = sum(map(pieces.__getitem__, cut(word.lower())))
            else:
                n = sum(1 if p in whole else len(merges(p)) for p, _ in split(normal(word)))
            if len(self) >= cache:
                self.clear()
            if len(word) <= KEPT:
                self[word] = n
            return n

    counts, words = Words(), re.compile(f"[^{WHITE}]+").findall
    odd = re.compile("[\\x1c-\\x1f]").search
    return lambda text: sum(map(counts.__getitem__, words(text) if odd(text) else text.split()))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; a narrow pass without a shuffle."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = word_counter(vocabulary)
        for b in batches:
            n = [count(t) if t else 0 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kind = dict(docs.dtypes)["doc_id"]
    read = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    out = read.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))

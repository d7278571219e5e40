"""Documents with every odd case, for brute-force comparisons."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       # names that the operators use inside
                       T.StructField("rid", T.StringType()), T.StructField("block", T.IntegerType()), T.StructField("fp", T.StringType()), T.StructField("size", T.StringType()), T.StructField("key", T.StringType()), T.StructField("kept", T.StringType())])


def prose(seed: int, n: int, letters: str = "abcdeéñß") -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, 6))) + r.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


def rows() -> list[tuple]:
    passage, long = prose(1, 70), prose(2, 3000)
    texts = [None, "", " \t\n", "one", "One two THREE", passage, passage, passage.upper(), prose(3, 30) + " " + passage + " " + prose(4, 30), prose(5, 200) + "\n" + passage, "x " * 300, "x " * 40, long, long[:9000] + " end", long[200:], "a" * 400, "é" * 120, "é" * 120 + "!", "\x0b\x0c\x1c odd space here " * 9,
             "<|endoftext|> don't I'LL 123 中文字 x<|startoftext|>y", "line one is here\nline one is here\n\nline two\nline one is here", "### $$$ %%% " * 20]
    texts += [prose(100 + i, 5 + 3 * i) for i in range(25)]
    near = prose(7, 120).split()
    texts += [" ".join(near[:k] + ["changed"] + near[k + 1 :]) for k in range(0, 120, 10)]
    out = [(i, t) for i, t in enumerate(texts)]
    out += [(5, texts[5]), (5, texts[5]), (12, texts[12]), (None, passage), (None, passage), (None, None), (-3, prose(3, 60)), (2**62, prose(3, 60))]
    return [(i, t, ["en", "de", None][k % 3], ["b", "a", None, "a", "é", "a"][k % 6], None if t is None else len(t), "r", 1, "f", "s", "k", "q") for k, (i, t) in enumerate(out)]


def documents(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df, *cols):
    """The rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def expected(made):
    return sorted(map(tuple, made), key=repr)

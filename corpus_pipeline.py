"""Corpus pipeline: documents through the training-data operators, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept,
and returns documents with the same columns; the last adds the mix's columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from talentlake.llm import decontamination, mixing, quality, simhash, suffix_dedup
from talentlake.llm.common import row_key, written

KEY, ROWS, FILE, PLACE = "__row", "__rows", "__file", "__place"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rules or leave their language's
    perplexity band go."""
    kept = quality.judged(docs).where("kept").select(F.col("rid").alias(KEY)).distinct()
    return docs.withColumn(KEY, row_key()).join(kept, KEY, "left_semi").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each component one row stays, the one with the smallest id (a null
    id comes last; then the row key; of rows that repeat id and text, the least by all columns)."""
    found = written(simhash.near_duplicates(docs, shingle=4, distance=4, keyed=True))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("least")).select(F.col("least.rid").alias(KEY))
    kept = first.join(found.groupBy(F.col("rid").alias(KEY)).agg(F.count(F.lit(1)).alias(ROWS)), KEY)
    keyed = docs.withColumn(KEY, row_key())
    alone = keyed.join(kept.where(F.col(ROWS) == 1), KEY, "left_semi").select(docs.columns)
    repeated = keyed.join(kept.where(F.col(ROWS) > 1), KEY, "left_semi")
    one = repeated.groupBy(KEY).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return alone.unionByName(one)


def suffix_array(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: later copies of 50 bytes go; documents stay, with what is left.
    Texts that lose nothing stay as they are."""
    carry = {f"__{c}": F.col(c) for c in docs.columns if c not in ("doc_id", "text")} | {KEY: F.col("text").isNull()}
    found = suffix_dedup.remove_later_copies(docs, span=50, keep_text=True, carry=carry)
    made = {"doc_id": F.col("doc_id"), "text": F.when(~F.col(KEY), F.col("kept")).alias("text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("__n_chars")).alias("n_chars")
    return found.select(*[made.get(c, F.col(f"__{c}").alias(c)) for c in docs.columns])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with an occurrence of a benchmark window go."""
    found = decontamination.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)
    gone = found.where("contaminated").select(F.col("rid").alias(KEY)).distinct()
    return docs.withColumn(KEY, row_key()).join(gone, KEY, "left_anti").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents with at least one copy, and how many copies and words the mix takes. Rows that
    repeat id and text are documents of their own: each gets the copies of one of them."""
    found = written(mixing.mix(docs, weights=[5, 2, 1], most=3).select(F.col("rid").alias(KEY), "copies", "taken"))
    rows = found.groupBy(KEY).agg(F.count(F.lit(1)).alias(ROWS), F.sum("copies").alias("copies"), F.sum("taken").alias("taken"))
    keyed = docs.withColumn(KEY, row_key())
    alone = keyed.join(rows.where((F.col(ROWS) == 1) & (F.col("copies") > 0)).drop(ROWS), KEY).drop(KEY)
    several = rows.where(F.col(ROWS) > 1).select(KEY)
    # rows of one key are alike, so any order of either side will do, as long as it is one
    repeated = placed(written(keyed.join(several, KEY, "left_semi")))
    copies = placed(written(found.join(several, KEY, "left_semi")))
    return alone.unionByName(repeated.join(copies, [KEY, PLACE]).where(F.col("copies") > 0).select(*docs.columns, "copies", "taken"))


def placed(rows: DataFrame) -> DataFrame:
    """Adds each row's place among the rows of its key, counted within files first, so that a key's
    rows are not ordered in one task. rows: a written table."""
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))
    numbered = rows.select("*", F.xxhash64(at).alias(FILE), F.monotonically_increasing_id().alias(PLACE))
    held = numbered.groupBy(KEY, FILE).agg(F.count(F.lit(1)).alias(ROWS))
    before = F.coalesce(F.sum(ROWS).over(W.partitionBy(KEY).orderBy(FILE).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(W.partitionBy(KEY, FILE).orderBy(PLACE))
    return numbered.withColumn(PLACE, within).join(held.withColumn(ROWS, before), [KEY, FILE]).withColumn(PLACE, F.col(PLACE) + F.col(ROWS)).drop(FILE, ROWS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("suffix_array", suffix_array),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
]

ORACLE_SQL = None  # fingerprints and language models are beyond SQL; a test holds the stages' rows against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs)
    return docs

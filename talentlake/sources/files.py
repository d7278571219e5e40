"""Other file sources and sinks: company reference CSV, Parquet tables,
JSON exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talentlake.schema import COMPANIES


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Company reference CSV (header row, six text columns, declared schema; a quote inside
    a quoted value is doubled, and values may hold line ends)."""
    return spark.read.csv(path, header=True, schema=COMPANIES, escape='"', multiLine=True)


def write_table(df: DataFrame, path: str, partitions: Sequence[str] = (), whole: bool = True, clustered: bool = False) -> None:
    """Parquet sink (snappy is Spark's default codec) through the commit protocol:
    the whole table is replaced, or with ``whole=False`` only the partitions present.

    ``REBALANCE`` by the partition columns gives few files a partition, and lets AQE
    split a large one over several tasks. ``clustered=True`` says that the input's files lie
    by these columns already: each task then has rows of few partitions, and nothing is shuffled."""
    if not partitions:
        df.write.mode("overwrite").parquet(path)
        return
    dealt = df if clustered else df.hint("rebalance", *partitions)
    writer = dealt.write.mode("overwrite").partitionBy(*partitions)
    writer.option("partitionOverwriteMode", "static" if whole else "dynamic").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def export_json(df: DataFrame, path: str, single_file: bool = True) -> None:
    """JSON-lines export of a (small, aggregated) result; ``single_file``
    coalesces to one task and is meant for report-sized outputs only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").json(path)


def export_bundle(results: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Write named, report-sized results as JSON folders under ``root``
    (one folder per result); returns name -> path."""
    paths = {}
    for name, df in results.items():
        path = f"{root.rstrip('/')}/{name}"
        export_json(df, path)
        paths[name] = path
    return paths


def bundle_document(spark: SparkSession, results: dict[str, DataFrame]) -> DataFrame:
    """One row, one column ``value``: a JSON object with each result's records as an array under its
    name, in the result's order, NULLs included. For report-sized results only: the document is one row."""
    def records(df: DataFrame):
        # the place of a row in the sorted result
        placed = df.select(F.monotonically_increasing_id().alias("i"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("r"))
        return placed.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "r"))), lambda x: x["r"])).scalar()

    document = F.struct(*[records(df).alias(name) for name, df in results.items()])
    return spark.range(1).select(F.to_json(document, {"ignoreNullFields": "false"}).alias("value"))


def export_bundle_document(spark: SparkSession, results: dict[str, DataFrame], path: str) -> None:
    """The bundle as one JSON document: a folder with one text file."""
    bundle_document(spark, results).coalesce(1).write.mode("overwrite").text(path)


def read_bundle_document(spark: SparkSession, path: str, name: str, like: DataFrame) -> DataFrame:
    """The records of one result of a bundle document, with the columns of ``like``."""
    shape = T.StructType([T.StructField(name, T.ArrayType(like.schema))])
    return spark.read.text(path, wholetext=True).select(F.inline(F.from_json("value", shape)[name]))

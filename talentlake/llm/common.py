"""Shared helpers of the operators: row keys, sizes, tables cut from lineage."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talentlake.session import shared_dir

# ASCII white space, as the word rule [^\x20\x09-\x0D]+ has it; bytes.split() splits at the same six bytes.
SPACE = r"[\x20\x09-\x0D]+"

_written: list[tuple[SparkSession, str]] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds the Arrow batches that go to Python: by bytes, as texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    return spark


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder of the cluster, read back:
    computed once, lineage cut, safe against lost executors. The table goes when
    the driver ends (or earlier, by ``forget``)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(schema).parquet(path)
    out._llm_path = path
    return out


def forget(df: DataFrame) -> None:
    """Removes a table that ``written`` made and nothing reads any longer."""
    path = getattr(df, "_llm_path", None)
    if path:
        _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is not None:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    _written[:] = [x for x in _written if x[1] != path]


@atexit.register
def _remove_all() -> None:
    for spark, path in list(_written):
        try:
            _remove(spark, path)
        except Exception:  # the JVM or the folder is gone already
            pass


def text_bytes(name: str = "text") -> Column:
    """The whole text as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def row_key() -> Column:
    """64-bit key of a document row; equal for rows that repeat id and text. Nulls count: the
    hash passes over them, so whether there is one is hashed too."""
    return F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("string"), F.col("text").isNull(), F.col("text"))


def text_size(docs: DataFrame) -> tuple[int, int]:
    """Rows and UTF-8 bytes of the texts, over all rows."""
    r = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def parts(total_bytes: int, each: int) -> int:
    """How many parts of about ``each`` bytes; odd, so that it shares few factors with keys."""
    return max(8, -(-total_bytes // each)) | 1

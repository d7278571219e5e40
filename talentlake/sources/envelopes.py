"""A lake of envelope documents: ``{root}/{source}/{YYYY_MM}/offres_raw.json``.

One JSON document ``{"metadata": {...}, "offres": [...]}`` for each partition, as the
original lays its raw zone out (S3, S4). Documents are read whole, each by one task, so a
partition must fit one; ``bronze`` is the layout without that bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talentlake import lexicons as L
from talentlake.schema import ENVELOPE_METADATA, RAW_COLUMNS, RAW_JSON
from talentlake.session import scratch_table
from talentlake.sources import bronze as B

FILE = "offres_raw.json"


def envelope_documents(spark: SparkSession, root: str) -> DataFrame:
    """(value, fichier, source_key, month_key): the documents below ``root``, at any depth; the keys
    are the names of the two folders that hold the file."""
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", FILE).text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    folder = lambda up: F.url_decode(F.replace(F.element_at(F.split(path, "/"), -1 - up), F.lit("+"), F.lit("%2B")))
    return found.select("value", path.alias("fichier"), folder(2).alias("source_key"), folder(1).alias("month_key"))


def read_envelope_lake(spark: SparkSession, root: str, on_error: str = "fail") -> DataFrame:
    """Raw listings of all documents with their file, its keys and the listing's place in it:
    ``orderBy("fichier", "position")`` is the order of a walk by sorted path. A document that is
    not JSON stops the job, or is left out with ``on_error="reject"`` (``rejects`` has it)."""
    return B.accepted(parse_envelope_lake(spark, root), on_error)


def parse_envelope_lake(spark: SparkSession, root: str) -> DataFrame:
    return B.opened_envelopes(envelope_documents(spark, root))


def envelope_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Each document's file, keys and landing metadata."""
    docs = envelope_documents(spark, root)
    shape = T.StructType([T.StructField("metadata", ENVELOPE_METADATA)])
    return docs.select("fichier", "source_key", "month_key", B.whole_json(F.col("value"), shape)["metadata"].alias("_m")).select("fichier", "source_key", "month_key", "_m.*")


def write_envelope_lake(raw: DataFrame, root: str, source_file: str = "") -> None:
    """Lands raw listings as one document for each (source, month): partitions in the input are
    replaced, others stay.

    A document is written line by line from a sorted partition, never held as one row. Files are
    written aside by the commit protocol and then given their names, one partition after the other."""
    spark = raw.sparkSession
    keyed = B.with_partition_keys(raw)
    listing = F.coalesce(F.col(RAW_JSON), F.to_json(F.struct(*RAW_COLUMNS))) if RAW_JSON in raw.columns else F.to_json(F.struct(*RAW_COLUMNS))
    keys = list(B.BRONZE_PARTITION_COLUMNS)
    rows = keyed.select(*keys, listing.alias("line"))
    whole = Window.partitionBy(*keys)
    place = F.row_number().over(whole.orderBy("line"))
    head = F.to_json(F.struct(
        F.lit(source_file).alias("source_fichier"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("date_ingestion"),
        F.concat_ws("/", *keys).alias("partition"), F.col("n").alias("nb_offres"), F.lit(L.BRONZE_SCHEMA_VERSION).alias("schema_version")))
    # one shuffle, the windows' own, puts a partition's lines into one task; a union of heads, lines and
    # ends dealt again by key was dealt by its branches, and a partition's lines lay in several files
    numbered = rows.select("*", place.alias("i"), F.count(F.lit(1)).over(whole).alias("n"))
    opening = F.when(F.col("i") == 1, F.concat(F.lit('{"metadata": '), head, F.lit(', "offres": [\n'))).otherwise(F.lit(","))
    text = F.concat(opening, "line", F.when(F.col("i") == F.col("n"), F.lit("\n]}")).otherwise(F.lit("")))
    aside = scratch_table(spark)
    lines = numbered.select(*keys, "i", text.alias("line")).sortWithinPartitions(*keys, "i")
    lines.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("line").alias("value")).write.partitionBy(*[f"_{k}" for k in keys]).text(aside)
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    # one file a partition: as many renames as the lake has folders
    named = set()
    for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(aside).select("path").toLocalIterator():
        source, month = (x.split("=", 1)[1] for x in r["path"].split("/")[-3:-1])
        target = paths(f"{root.rstrip('/')}/{source}/{month}/{FILE}")
        if (source, month) in named:
            raise OSError(f"{target} would have two files")
        named.add((source, month))
        fs = target.getFileSystem(conf)
        fs.mkdirs(target.getParent())
        fs.delete(target, False)
        if not fs.rename(paths(r["path"]), target):
            raise OSError(f"{target} could not be written")

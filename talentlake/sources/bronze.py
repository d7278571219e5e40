"""Bronze landing zone: raw listings stored untouched, partitioned by
source and publication month (S1-S6).

Layout: ``<root>/source_key=<source>/month_key=<YYYY_MM>/part-*.json``,
JSON lines, one raw listing per line plus landing metadata. Re-landing
overwrites exactly the partitions present in the new input and leaves the
others alone (dynamic partition overwrite), which is the replay-a-month
contract. Writes go through Spark's commit protocol, so a lost executor
only re-runs its task.
"""

from __future__ import annotations

import time
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talentlake import lexicons as L
from talentlake.functions.normalize import text_or_list
from talentlake.schema import (
    BRONZE, BRONZE_META_COLUMNS, BRONZE_PARTITION_COLUMNS, RAW_COLUMNS, RAW_JSON, RAW_LISTING,
)


def source_key(source: Column) -> Column:
    """Lower-cased source, spaces -> ``_``; missing -> ``inconnu``."""
    return F.replace(F.lower(F.coalesce(source, F.lit(L.BRONZE_UNKNOWN_SOURCE))), F.lit(" "), F.lit("_"))


def month_key(pub_date: Column) -> Column:
    """First 7 characters, a four-digit year and a month -> ``YYYY_MM``; else ``date_inconnue``."""
    month = F.substring(pub_date, 1, 7)
    parsed = F.when(month.rlike("^[0-9]{4}-[0-9]{1,2}$"), F.try_to_timestamp(month, F.lit("y-M")))
    return F.coalesce(F.date_format(parsed, "yyyy_MM"), F.lit(L.BRONZE_UNKNOWN_MONTH))


def with_partition_keys(raw: DataFrame) -> DataFrame:
    return raw.select(
        "*",
        source_key(F.col("source")).alias("source_key"),
        month_key(F.col("date_publication")).alias("month_key"),
    )


CORRUPT = "_corrupt"
# as a strict reader has it: no single quotes; what follows a value is not skipped (see ``whole_json``)
STRICT = {"allowSingleQuotes": "false"}
SEAL = "_seal"


def whole_json(text: Column, fields: T.StructType) -> Column:
    """The text's one JSON object as a struct of ``fields``, or NULL where the text is not
    one object and nothing else (cut, doubled, followed by other text, not an object).

    Spark's JSON functions read the first value of a text and skip the rest. So the text is
    read as the first of two array elements, the second being an object with the hash of the
    text: only if the text is one whole value does the array have two elements, the second of
    them that hash, which no text can hold of itself."""
    sealed = T.StructType([*fields.fields, T.StructField(SEAL, T.StringType())])
    seal = F.sha2(text, 256)
    pair = F.from_json(F.concat(F.lit("["), text, F.lit(f',{{"{SEAL}":"'), seal, F.lit('"}]')), T.ArrayType(sealed), STRICT)
    whole = (F.size(pair) == 2) & (F.get(pair, F.lit(1))[SEAL] == seal) & F.trim(text, F.lit(" \t\r\n")).startswith("{")
    return F.when(whole, F.get(pair, F.lit(0)))


def parsed_listings(texts: DataFrame) -> DataFrame:
    """``listing_json`` texts -> raw listing columns, ``listing_json`` and ``_corrupt``:
    the text where it is not one JSON object, else NULL.

    Every field is read as text and then cast, so a value of another type than
    declared (``"nb_postes": "3"``) is kept where it can be, and the listing itself
    always is. A language list may also be one plain text."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_LISTING.fields])
    x = texts.withColumn("_p", whole_json(F.col(RAW_JSON), as_text))
    cols = []
    for f in RAW_LISTING.fields:
        value = F.col(f"_p.{f.name}")
        cols.append((text_or_list(value) if isinstance(f.dataType, T.ArrayType) else value.try_cast(f.dataType)).alias(f.name))
    corrupt = F.when(F.col("_p").isNull(), F.coalesce(F.col(RAW_JSON), F.lit("")))
    kept = [c for c in texts.columns if c != RAW_JSON]
    return x.select(*cols, RAW_JSON, corrupt.alias(CORRUPT), *kept)


def accepted(parsed: DataFrame, on_error: str) -> DataFrame:
    """Parsed rows without the corrupt ones (``on_error="reject"``; ``rejects`` has
    them), or an error at the first one (``"fail"``). The error is raised by a filter, so
    it does not depend on the columns that are read later."""
    if on_error == "reject":
        return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    if on_error != "fail":
        raise ValueError("on_error must be 'fail' or 'reject'")
    bad = F.concat(F.lit("not a JSON listing: "), F.substring(CORRUPT, 1, 200))
    return parsed.where(F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(F.raise_error(bad).cast("boolean"))).drop(CORRUPT)


def rejects(parsed: DataFrame) -> DataFrame:
    """The corrupt rows: ``texte``, and what else the reader carries (``fichier``)."""
    return parsed.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("texte"), *[c for c in parsed.columns if c == "fichier"])


def opened_envelopes(docs: DataFrame) -> DataFrame:
    """Whole documents (``value``) to parsed listings, with the other columns and the
    listing's place in its document (``position``). A missing or null ``offres`` gives no
    rows; a document that is not one JSON object, or whose ``offres`` is no array, is one
    corrupt row."""
    shape = T.StructType([T.StructField("offres", T.StringType())])
    kept = [c for c in docs.columns if c != "value"]
    x = docs.withColumn("_d", whole_json(F.col("value"), shape))
    x = x.withColumn("_o", F.from_json("_d.offres", "array<string>", STRICT))
    broken = F.col("_d").isNull() | (F.col("_d.offres").isNotNull() & (F.col("_o").isNull() | ~F.startswith(F.col("_d.offres"), F.lit("["))))
    texts = F.when(broken, F.array(F.col("value"))).otherwise(F.coalesce(F.col("_o"), F.array().cast("array<string>")))
    # the texts are a column of their own before they are laid out: each listing's row then carries
    # the flag alone, not the document that it would be made from
    opened = x.select(*kept, broken.alias("_broken"), texts.alias("_texts"))
    parsed = parsed_listings(opened.select(*kept, "_broken", F.posexplode("_texts").alias("position", RAW_JSON)))
    return parsed.withColumn(CORRUPT, F.when(F.col("_broken"), F.col(RAW_JSON)).otherwise(F.col(CORRUPT))).drop("_broken")


def parse_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Envelope documents ``{"metadata": {...}, "offres": [...]}``, one a file, to
    parsed listings (``opened_envelopes``), with the file's path as ``fichier``."""
    docs = spark.read.text(path, wholetext=True).select(F.col("value"), F.col("_metadata.file_path").alias("fichier"))
    return opened_envelopes(docs).drop("position")


def read_envelope(spark: SparkSession, path: str, on_error: str = "fail") -> DataFrame:
    """Raw listings (and ``listing_json``) of envelope documents."""
    return accepted(parse_envelopes(spark, path).drop("fichier"), on_error)


def parse_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One listing a line (splittable) to parsed listings; blank lines are none."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return parsed_listings(lines.select(F.col("value").alias(RAW_JSON), F.col("_metadata.file_path").alias("fichier")))


def read_raw_json_lines(spark: SparkSession, path: str, on_error: str = "fail") -> DataFrame:
    """Raw listings (and ``listing_json``) stored one JSON object a line."""
    return accepted(parse_json_lines(spark, path).drop("fichier"), on_error)


def write_bronze(raw: DataFrame, bronze_path: str, source_file: str = "", codec: str = "gzip", rows_a_file: int = 1_000_000) -> None:
    """Land raw listings (unmodified) with metadata, partitioned by
    (source_key, month_key); only the partitions present are replaced.

    ``REBALANCE(source_key, month_key)`` groups rows of a partition into few
    files while AQE splits a hot partition (e.g. one source holding a third
    of all rows) over several tasks instead of one. Files are compressed with
    ``codec``; a compressed file is one task's work, so it holds ``rows_a_file`` listings at most."""
    as_json = F.col(RAW_JSON) if RAW_JSON in raw.columns else F.lit(None).cast("string")
    keyed = with_partition_keys(raw).select(
        *[F.col(c) for c in RAW_COLUMNS],
        as_json.alias(RAW_JSON),
        F.lit(source_file).alias("source_fichier"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("date_ingestion"),
        F.lit(L.BRONZE_SCHEMA_VERSION).alias("schema_version"),
        "source_key", "month_key",
    )
    (
        keyed.hint("rebalance", *BRONZE_PARTITION_COLUMNS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", codec)
        .option("maxRecordsPerFile", rows_a_file)
        .partitionBy(*BRONZE_PARTITION_COLUMNS)
        .json(bronze_path)
    )


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame:
    """All bronze partitions (declared schema; partition keys from the
    directory names, so filters on them prune directories). A line that is not
    JSON stops the job: bronze was written by ``write_bronze`` alone."""
    return spark.read.schema(BRONZE).option("mode", "FAILFAST").json(bronze_path)


def partition_metadata(landed: DataFrame) -> DataFrame:
    """Landing metadata of each partition (S3): its name, listings, source file,
    ingestion time and schema version, from what was landed."""
    return landed.groupBy("source_key", "month_key").agg(
        F.max("source_fichier").alias("source_fichier"),
        F.max("date_ingestion").alias("date_ingestion"),
        F.count(F.lit(1)).alias("nb_offres"),
        F.max("schema_version").alias("schema_version"),
    ).select(F.concat_ws("/", "source_key", "month_key").alias("partition"), "source_key", "month_key", "nb_offres",
             "source_fichier", "date_ingestion", "schema_version")


# A log of landings: a row for each partition landed (or taken away), the latest version counts.
MANIFEST = ("partition string, source_key string, month_key string, nb_offres long, source_fichier string, date_ingestion string, "
            "schema_version string, empreinte long, version long, retire boolean")


def bronze_files(spark: SparkSession, bronze_path: str) -> DataFrame:
    """(source_key, month_key, fichier): bronze's files from the listing of its folders; no file is opened."""
    path = F.col("path")
    # as Spark writes a folder's name: special characters as %XX
    value = lambda key: F.url_decode(F.replace(F.regexp_extract(path, f"/{key}=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
    keys = [F.when(value(k) != "__HIVE_DEFAULT_PARTITION__", value(k)).alias(k) for k in BRONZE_PARTITION_COLUMNS]
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(bronze_path)
    return listed.select(*keys, F.regexp_extract(path, "[^/]*$", 0).alias("fichier"))


def stored_partitions(spark: SparkSession, bronze_path: str) -> DataFrame:
    """(source_key, month_key) of the partitions that bronze holds, sorted (S6): from folder names alone."""
    return list_partitions(bronze_files(spark, bronze_path))


def _latest(spark: SparkSession, metadata_path: str) -> DataFrame:
    if not _exists(spark, metadata_path):
        return spark.createDataFrame([], MANIFEST)
    log = spark.read.schema(MANIFEST).json(metadata_path)
    last = log.groupBy(*BRONZE_PARTITION_COLUMNS).agg(F.max_by(F.struct(*[c for c in log.columns if c not in BRONZE_PARTITION_COLUMNS]), "version").alias("_m"))
    return last.select(*BRONZE_PARTITION_COLUMNS, "_m.*").where(~F.col("retire"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Each partition's latest metadata, of the log that ``update_metadata`` keeps."""
    return _latest(spark, path).select("partition", *BRONZE_PARTITION_COLUMNS, "nb_offres", "source_fichier", "date_ingestion", "schema_version")


def touched_partitions(spark: SparkSession, bronze_path: str, metadata_path: str) -> tuple[dict[tuple, int], list[tuple]]:
    """Partitions whose files are not those that the metadata was made from, with the
    fingerprint of their files; and partitions of the metadata that are no longer there.

    A file's name is new with every landing, so the names tell whether a partition was
    landed since, also by a run that ended before it could write its metadata. Both sides have
    one row a partition: as many as the folders that Spark lists on the driver to plan a read."""
    prints = lambda df: {(r["source_key"], r["month_key"]): r["empreinte"] for r in df.collect()}
    now = prints(bronze_files(spark, bronze_path).groupBy(*BRONZE_PARTITION_COLUMNS).agg(F.bit_xor(F.xxhash64("fichier")).alias("empreinte")))
    known = prints(_latest(spark, metadata_path))
    return {k: v for k, v in now.items() if known.get(k) != v}, [k for k in known if k not in now]


# Partitions named in a filter, which prunes to their folders; beyond, all are read and joined.
NAMED = 1000


def update_metadata(spark: SparkSession, bronze_path: str, metadata_path: str) -> int:
    """Brings the partitions' metadata up to date with bronze: reads the partitions landed
    since, and no others, and adds their rows to the log; returns how many there were."""
    changed, gone = touched_partitions(spark, bronze_path, metadata_path)
    version = time.time_ns()
    parts = []
    if changed:
        landed = read_bronze(spark, bronze_path)
        if len(changed) <= NAMED:
            months: dict[str, list[str]] = {}
            for source, month in changed:
                months.setdefault(source, []).append(month)
            named = [F.col("source_key").eqNullSafe(F.lit(source)) & F.col("month_key").isin(found) for source, found in months.items()]
            landed = landed.where(reduce(or_, named))
        marks = spark.createDataFrame([(*k, v) for k, v in changed.items()], "source_key string, month_key string, empreinte long")
        rows = partition_metadata(landed)
        parts.append(rows.join(marks, [rows[c].eqNullSafe(marks[c]) for c in BRONZE_PARTITION_COLUMNS]).select(rows["*"], "empreinte", F.lit(False).alias("retire")))
    if gone:
        parts.append(spark.createDataFrame(gone, "source_key string, month_key string").withColumn("retire", F.lit(True)))
    if parts:
        log = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).withColumn("version", F.lit(version))
        log.coalesce(1).write.mode("append").json(metadata_path)
    return len(changed)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _exists(spark: SparkSession, path: str) -> bool:
    p = _path(spark, path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ingestion_report(keyed: DataFrame) -> DataFrame:
    """Listings and partition files per (source, month), per source, per month and
    in total (S5); ``niveau`` names the level. Where the input has an ingestion
    time, the latest is given. Rows are counted once per partition; the levels
    sum those counts. keyed: listings with their keys, or partition metadata, whose
    counts (``nb_offres``) are then taken."""
    times = [F.max("date_ingestion").alias("date_ingestion")] if "date_ingestion" in keyed.columns else []
    each = keyed.groupBy("source_key", "month_key").agg((F.sum("nb_offres") if "nb_offres" in keyed.columns else F.count(F.lit(1))).alias("n"), *times)
    g = each.groupingSets(
        [["source_key", "month_key"], ["source_key"], ["month_key"], []], "source_key", "month_key"
    ).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("nb_offres"),
        F.count(F.lit(1)).alias("nb_fichiers"),
        F.grouping("source_key").alias("_gs"),
        F.grouping("month_key").alias("_gm"),
        *times,
    )
    level = (
        F.when((F.col("_gs") == 0) & (F.col("_gm") == 0), F.lit("partition"))
        .when(F.col("_gs") == 0, F.lit("source"))
        .when(F.col("_gm") == 0, F.lit("mois"))
        .otherwise(F.lit("total"))
    )
    return g.select(level.alias("niveau"), "source_key", "month_key", "nb_offres", "nb_fichiers", *[c for c in ("date_ingestion",) if times]).orderBy(
        "niveau", F.asc_nulls_last("source_key"), F.asc_nulls_last("month_key"))


def list_partitions(keyed: DataFrame) -> DataFrame:
    """Distinct (source_key, month_key) pairs, sorted."""
    return keyed.select(*BRONZE_PARTITION_COLUMNS).distinct().orderBy(*BRONZE_PARTITION_COLUMNS)


__all__ = [
    "source_key", "month_key", "with_partition_keys", "read_envelope", "read_raw_json_lines",
    "parsed_listings", "parse_envelopes", "parse_json_lines", "rejects", "partition_metadata",
    "write_bronze", "read_bronze", "ingestion_report", "list_partitions", "BRONZE_META_COLUMNS",
    "bronze_files", "stored_partitions", "touched_partitions", "update_metadata", "read_metadata", "whole_json",
    "opened_envelopes", "accepted",
]

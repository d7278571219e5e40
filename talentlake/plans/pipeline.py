"""End-to-end batch job: bronze -> silver -> skills -> gold.

Each stage can run alone and reads its input from the lake, so a failed
run resumes at the stage that failed. Silver and skills are written as
Parquet and read back before the gold stage: the written table cuts the
lineage (a lost executor recomputes from the table, not from raw JSON),
and each of the five gold jobs scans its own columns of it instead of
parsing again. Silver and skills are partitioned by publication month, so a
run may be limited to some months: it reads and replaces these alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentlake import lexicons as L
from talentlake.operators import gold as G
from talentlake.operators import gold_state as S
from talentlake.operators.silver import to_silver
from talentlake.operators.skills import Dictionary, extract_skills
from talentlake.sources import bronze as B
from talentlake.sources.files import export_json, read_table, write_table

# Silver and skills are partitioned by bronze's month key, so that a replayed month of
# bronze is one partition here, undated listings included.
MONTH = "mois_cle"
STAGES = ("bronze", "silver", "gold")
GOLD_TABLES = ("top_competences", "salaires_par_profil", "offres_par_ville", "entreprises_recruteurs",
               "tendances_mensuelles")


@dataclass(frozen=True)
class LakePaths:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def ingestion_report(self) -> str:
        return f"{self.root}/bronze_report"

    @property
    def bronze_metadata(self) -> str:
        return f"{self.root}/bronze_metadata"

    @property
    def silver_listings(self) -> str:
        return f"{self.root}/silver/offres_clean"

    @property
    def silver_skills(self) -> str:
        return f"{self.root}/silver/competences_extraites"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def gold_state(self, name: str) -> str:
        return f"{self.root}/gold_state/{name}"


def run_bronze(raw: DataFrame, paths: LakePaths, source_file: str = "") -> None:
    """Land the raw listings, then bring the partitions' metadata up to date from the
    partitions just landed, and the report from the metadata: the input is evaluated once,
    what was landed is read once, and partitions landed earlier are not read."""
    spark = raw.sparkSession
    B.write_bronze(raw, paths.bronze, source_file)
    B.update_metadata(spark, paths.bronze, paths.bronze_metadata)
    export_json(B.ingestion_report(B.read_metadata(spark, paths.bronze_metadata)), paths.ingestion_report)


def run_silver(spark: SparkSession, paths: LakePaths, dictionary: Dictionary | None = None,
               months: Sequence[str] | None = None) -> None:
    """Silver and skills from bronze, both without a shuffle: bronze lies by source and month,
    silver by month, and so do the rows that a task reads and writes. months: ``YYYY_MM`` keys of
    bronze to (re)do, all if None; ``date_inconnue`` stands for listings without a month."""
    bronze = B.read_bronze(spark, paths.bronze)
    if months is not None:
        bronze = bronze.where(F.col("month_key").isin(list(months)))
    bronze = bronze.drop(*B.BRONZE_META_COLUMNS, B.RAW_JSON, "source_key", "month_key")
    whole = months is None
    silver = to_silver(bronze).withColumn(MONTH, B.month_key(F.col("date_publication")))
    write_table(silver, paths.silver_listings, [MONTH], whole, clustered=True)
    skills = extract_skills(read_silver(spark, paths.silver_listings, months), dictionary)
    write_table(skills.withColumn(MONTH, B.month_key(F.col("date_pub"))), paths.silver_skills, [MONTH], whole, clustered=True)


def read_silver(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """Silver or skills; ``months`` prunes to their partitions."""
    table = read_table(spark, path)
    if months is not None:
        table = table.where(F.col(MONTH).isin(list(months)))
    return table.drop(MONTH)


def build_gold(silver: DataFrame, skills: DataFrame) -> dict[str, DataFrame]:
    return {
        "top_competences": G.top_skills(skills, silver),
        "salaires_par_profil": G.pay_by_profile(silver),
        "offres_par_ville": G.listings_by_city_month(silver),
        "entreprises_recruteurs": G.top_recruiters(silver),
        "tendances_mensuelles": G.monthly_trends(silver),
    }


def run_gold(spark: SparkSession, paths: LakePaths, concurrent: bool = True) -> None:
    """Write the five gold tables. They are independent jobs over the same
    silver tables, so by default they are submitted together from a small
    thread pool and the scheduler overlaps their stages (each job still
    runs on the whole cluster; a failure in one is re-raised)."""
    silver = read_silver(spark, paths.silver_listings)
    skills = read_silver(spark, paths.silver_skills)
    tables = build_gold(silver, skills)
    if not concurrent:
        for name, df in tables.items():
            write_table(df, paths.gold(name))
        return
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        futures = [pool.submit(write_table, df, paths.gold(name)) for name, df in tables.items()]
        for f in futures:
            f.result()


def update_gold(spark: SparkSession, paths: LakePaths, months: Sequence[str]) -> None:
    """Gold by month: renews the partial states of ``months`` from silver and skills, and
    finishes the five tables from the states. Only these months' listings are read; months
    that have no state yet (all of them, the first time) are made up for."""
    made = {"silver": paths.silver_listings, "skills": paths.silver_skills}
    there = {kind: {r[MONTH] for r in stored_months(spark, path).collect()} for kind, path in made.items()}

    def renew(name: str) -> None:
        kind, state, finish = S.STATES[name]
        path = paths.gold_state(name)
        have = {r[MONTH] for r in stored_months(spark, path).collect()} if B._exists(spark, path) else set()
        todo = sorted((there[kind] - have) | set(months))
        source = read_table(spark, made[kind]).where(F.col(MONTH).isin(todo))
        write_table(state(source, MONTH), path, [MONTH], whole=False)
        write_table(finish(read_table(spark, path)), paths.gold(name))

    with ThreadPoolExecutor(max_workers=len(S.STATES)) as pool:
        for f in [pool.submit(renew, name) for name in S.STATES]:
            f.result()


def stored_months(spark: SparkSession, path: str) -> DataFrame:
    """The month partitions of a table, from the names of its folders."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return listed.select(F.regexp_extract("path", f"/{MONTH}=([^/]*)/", 1).alias(MONTH)).distinct()


def register_views(spark: SparkSession, paths: LakePaths, prefix: str = "") -> list[str]:
    """Temporary views of the lake's tables, for SQL by name: ``offres_clean``,
    ``competences_extraites`` and the five gold tables (those that are written)."""
    tables = {"offres_clean": paths.silver_listings, "competences_extraites": paths.silver_skills} | {name: paths.gold(name) for name in GOLD_TABLES}
    made = []
    for name, path in tables.items():
        if B._exists(spark, path):
            table = read_table(spark, path)
            (table.drop(MONTH) if MONTH in table.columns else table).createOrReplaceTempView(f"{prefix}{name}")
            made.append(f"{prefix}{name}")
    return made


def save_catalog(spark: SparkSession, paths: LakePaths, database: str) -> list[str]:
    """The lake's tables as external tables of a catalog database, which later sessions can name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{paths.root}/catalog'")
    tables = {"offres_clean": paths.silver_listings, "competences_extraites": paths.silver_skills} | {name: paths.gold(name) for name in GOLD_TABLES}
    made = []
    for name, path in tables.items():
        if B._exists(spark, path):
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
            spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
            if MONTH in read_table(spark, path).columns:
                spark.sql(f"MSCK REPAIR TABLE `{database}`.`{name}`")
            made.append(f"{database}.{name}")
    return made


def run(spark: SparkSession, raw: DataFrame | None, root: str, stages=STAGES, source_file: str = "",
        dictionary: Dictionary | None = None, months: Sequence[str] | None = None) -> LakePaths:
    """Run the selected stages in order; ``raw`` is needed for bronze only. months: silver and
    gold are renewed for these months (``YYYY_MM`` keys) alone, and gold from monthly states."""
    paths = LakePaths(root.rstrip("/"))
    for stage in stages:
        if stage == "bronze":
            if raw is None:
                raise ValueError("bronze stage needs the raw listings")
            run_bronze(raw, paths, source_file)
        elif stage == "silver":
            run_silver(spark, paths, dictionary, months)
        elif stage == "gold" and months is not None:
            update_gold(spark, paths, months)
        elif stage == "gold":
            run_gold(spark, paths)
        else:
            raise ValueError(f"unknown stage {stage!r}; expected one of {STAGES}")
    return paths


def analysis_bundle(silver: DataFrame, skills: DataFrame, city: str = "Tanger") -> dict[str, DataFrame]:
    """The eight named analysis results (S14), computed from silver/skills."""
    from talentlake.operators import insights as I

    gold = build_gold(silver, skills)
    return {
        "q1_top_competences_global": I.top_skills_overall(gold["top_competences"], 20),
        "q1_top_competences_data": I.top_skills_for_profiles(gold["top_competences"]),
        "q2_villes_comparaison": I.city_pivot(gold["offres_par_ville"], city=city),
        "q3_salaires_national": I.national_pay_median_of_medians(gold["salaires_par_profil"]),
        "q3_salaires_ville": I.city_pay_gap_script(gold["salaires_par_profil"], city=city),
        "q4_correlation_experience": I.pay_by_experience_band(silver),
        "q5_top_recruteurs": I.recruiter_rank(gold["entreprises_recruteurs"], 20, method="row_number"),
        "q5_concurrents_ville": I.city_competitors_with_profiles(gold["entreprises_recruteurs"], city=city),
    }

"""Registered queries: name -> (Spark builder, DuckDB oracle SQL).

Every builder takes ``(spark, sf_dir)``, reads the shared test tables and
returns a DataFrame over the WHOLE tables (no id subsets, no caps other than the
top-k cuts that are the feature). Most are lazy; the questions on gold write the
gold table they read, and the round trips write what they read back. The oracle texts are written
independently in DuckDB SQL (``talentlake.plans.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentlake import lexicons as L
from talentlake.functions.ranks import percentiles
from talentlake.functions.text import round_half_up
from talentlake.operators import gold as G
from talentlake.operators import gold_state as S
from talentlake.operators import insights as I
from talentlake.operators.silver import profile_distribution, quality_report, to_silver
from talentlake.operators.skill_index import extract_skills_indexed
from talentlake.operators.skills import (
    dictionary_frame, dictionary_from_terms, document_terms, extract_skills, extraction_report, load_dictionary, mentions_by_family,
)
from talentlake.plans import oracle as O
from talentlake.plans.oracle import lst, pct, q, rhu
from talentlake.schema import RAW_COLUMNS, SKILL_COLUMNS
from talentlake.sources import bronze as B
from talentlake.sources import envelopes as E
from talentlake.plans import pipeline
from talentlake.session import materialize, scratch_table
from talentlake.sources.files import export_bundle_document, export_json, read_bundle_document, read_companies
from talentlake.sources.listings import listings_from_tables, read_table

# Registered outputs leave out the array column (its text copy is there), and
# expose nullable integer columns as DOUBLE on both sides (pandas turns a
# nullable int into float64 from Spark but into a masked integer from DuckDB;
# DOUBLE is also how the original stored these values).
RAW_OUTPUT = [c for c in RAW_COLUMNS if c != "langue_requise"]
NULLABLE_INTS = ("experience_min_ans", "experience_max_ans", "nb_offres_mois_precedent", "nb_postes")

SILVER_OUTPUT = RAW_OUTPUT + [
    "profil_normalise", "salaire_min_mad", "salaire_max_mad", "salaire_connu", "salaire_median_mad",
    "experience_min_ans", "experience_max_ans", "ville_std", "region_admin", "type_contrat_std",
    "date_publication_std", "date_expiration_std", "annee", "mois", "date_coherente", "langue_requise_txt",
]


# ------------------------------------------------------------------ shared plan pieces
def raw(spark, sf):
    return listings_from_tables(spark, sf)


def silver(spark, sf):
    return to_silver(raw(spark, sf))


def skills(spark, sf):
    return extract_skills(silver(spark, sf))


def gold_top(spark, sf):
    # The denominator subquery needs only id_offre: column pruning reduces
    # its silver branch to the listing view's key, with no parsing.
    s = silver(spark, sf)
    return G.top_skills(extract_skills(s), s)


# Gold tables as registered queries: one aggregation over silver, computed on the fly.
def gold_pay(spark, sf):
    return G.pay_by_profile(silver(spark, sf))


def gold_city(spark, sf):
    return G.listings_by_city_month(silver(spark, sf))


def gold_rec(spark, sf):
    return G.top_recruiters(silver(spark, sf))


def gold_trends(spark, sf):
    return G.monthly_trends(silver(spark, sf))


def gold_total(spark, sf):
    """The all-listings level of G1 alone, for the questions that read no other."""
    s = silver(spark, sf)
    return G.top_skills(extract_skills(s), s, with_profiles=False)


def gold_profiles(spark, sf):
    s = silver(spark, sf)
    return G.top_skills(extract_skills(s), s, with_total_level=False)


def once(gold):
    """A gold table computed once and read back: questions that filter on its
    columns, or read it twice, then work on the few rows of the aggregate. What is
    written is the aggregate, never listings."""
    return lambda spark, sf: materialize(gold(spark, sf))


pay_table, city_table, recruiters_table, trends_table = once(gold_pay), once(gold_city), once(gold_rec), once(gold_trends)
profiles_table = once(gold_profiles)
counts_table = once(lambda spark, sf: I.pay_counts(silver(spark, sf)))


def as_double(df: DataFrame) -> DataFrame:
    """Nullable integer output columns as DOUBLE (see NULLABLE_INTS)."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in NULLABLE_INTS else F.col(c) for c in df.columns])


def _bronze_written(spark: SparkSession, sf: str) -> DataFrame:
    """Raw listings landed in a folder of this call's own, and read back."""
    path = scratch_table(spark)
    B.write_bronze(raw(spark, sf), path, source_file=f"{sf}/orders.parquet")
    return B.read_bronze(spark, path)


def _bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(_bronze_written(spark, sf).select(*RAW_OUTPUT, "source_key", "month_key"))


def _json_lines(spark: SparkSession, sf: str) -> str:
    """The listings as JSON lines, some of them cut short, doubled or followed by other
    text, with values of other types than declared and fields beyond the declared ones."""
    path = scratch_table(spark)
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").cast("string").alias("day"))
    line = F.to_json(F.struct(F.concat(F.lit("L-"), F.col("o_orderkey")).alias("id_offre"), F.col("o_orderstatus").alias("source"),
                              F.col("day").alias("date_publication"), F.col("o_orderkey").cast("string").alias("nb_postes"), F.lit("fr").alias("langue_requise"),
                              F.col("o_orderkey").alias("champ_inconnu")))
    orders.select(_damaged(F.col("o_orderkey"), line).alias("value")).write.text(path)
    return path


def _damaged(key, text):
    """Of nine texts by key, five that are not one JSON object."""
    kind = key % 9
    return (F.when(kind == 0, F.substring(text, F.lit(1), F.length(text) - 3)).when(kind == 1, F.concat(text, text))
            .when(kind == 2, F.concat(text, F.lit(" fin"))).when(kind == 3, F.concat(text, F.lit("] "), text)).when(kind == 4, F.concat(F.lit("["), text, F.lit("]"))).otherwise(text))


def _bronze_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Lines accepted and rejected, with what each keeps."""
    parsed = B.parse_json_lines(spark, _json_lines(spark, sf))
    good = B.accepted(parsed, "reject").select(F.lit("accepte").alias("etat"), "id_offre", F.col("nb_postes").cast("double").alias("nb_postes"),
                                               F.array_join("langue_requise", ",").alias("langues"),
                                               F.get_json_object("listing_json", "$.champ_inconnu").alias("champ_inconnu"), F.lit(None).cast("string").alias("texte"))
    none = [F.lit(None).cast(k).alias(c) for c, k in (("id_offre", "string"), ("nb_postes", "double"), ("langues", "string"), ("champ_inconnu", "string"))]
    return good.unionByName(B.rejects(parsed).select(F.lit("rejete").alias("etat"), *none, "texte"))


def _envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Envelope documents of up to 2,000 listings each, written as files and read back: the
    listings of whole documents, and what is rejected of the others by kind."""
    path = scratch_table(spark)
    orders = read_table(spark, sf, "orders")
    listing = F.to_json(F.struct(F.concat(F.lit("L-"), F.col("o_orderkey")).alias("id_offre"), F.col("o_orderpriority").alias("secteur"),
                                 F.col("o_custkey").cast("int").alias("nb_postes")))
    docs = orders.groupBy(F.floor(F.col("o_orderkey") / 2000).alias("doc")).agg(F.array_join(F.collect_list(listing), ",").alias("o"))
    text = F.concat(F.lit('{"metadata": {"partition": "x"}, "offres": ['), F.col("o"), F.lit("]}"))
    # a file holds one document: one partition folder each; every second one is whole
    damaged = F.when(F.col("doc") % 2 == 0, text).otherwise(_damaged(F.floor(F.col("doc") / 2) % 5, text))
    docs.select(damaged.alias("value"), "doc").write.partitionBy("doc").text(path)
    parsed = B.parse_envelopes(spark, f"{path}/*")
    listings = B.accepted(parsed, "reject").select("id_offre", "secteur", F.col("nb_postes").cast("double").alias("nb_postes"), F.lit(None).cast("bigint").alias("document"))
    none = [F.lit(None).cast(k).alias(c) for c, k in (("id_offre", "string"), ("secteur", "string"), ("nb_postes", "double"))]
    return listings.unionByName(B.rejects(parsed).select(*none, F.regexp_extract("fichier", "doc=([0-9]+)", 1).cast("bigint").alias("document")))


# Lakes that several queries read: one run of the job for each session and input.
_LAKES: dict[tuple, pipeline.LakePaths] = {}


def _shared(kind: str, make) -> Callable[[SparkSession, str], pipeline.LakePaths]:
    def lake(spark: SparkSession, sf: str) -> pipeline.LakePaths:
        key = (spark.sparkContext.applicationId, kind, sf)
        if key not in _LAKES:
            _LAKES[key] = make(spark, sf)
        return _LAKES[key]
    return lake


# The whole batch job (P1) into a folder of the session's own.
_lake = _shared("whole", lambda spark, sf: pipeline.run(spark, raw(spark, sf), scratch_table(spark), source_file=f"{sf}/orders.parquet"))


def _make_month_lake(spark: SparkSession, sf: str) -> pipeline.LakePaths:
    """A lake whose latest month first lacks some of its listings and is then replayed in full: bronze,
    silver, skills and gold are renewed for that month alone."""
    keyed = B.with_partition_keys(raw(spark, sf))
    month = keyed.where(F.col("month_key") != L.BRONZE_UNKNOWN_MONTH).agg(F.max("month_key")).first()[0]
    in_month = F.col("month_key") == month
    first = keyed.where(~in_month | (F.crc32("id_offre") % 3 == 0)).drop(*B.BRONZE_PARTITION_COLUMNS)
    paths = pipeline.run(spark, first, scratch_table(spark), stages=("bronze", "silver"))
    pipeline.update_gold(spark, paths, [])
    return pipeline.run(spark, keyed.where(in_month).drop(*B.BRONZE_PARTITION_COLUMNS), paths.root, source_file="replay", months=[month])


_month_lake = _shared("month", _make_month_lake)


def _lake_silver(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(pipeline.read_silver(spark, _lake(spark, sf).silver_listings).select(*SILVER_OUTPUT))


def _lake_skills(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.read_silver(spark, _lake(spark, sf).silver_skills).select(*SKILL_COLUMNS)


def _lake_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and a checksum column of each written gold table."""
    paths = _lake(spark, sf)
    out = None
    for name, column in GOLD_SUMS.items():
        t = spark.read.parquet(paths.gold(name))
        one = t.agg(F.lit(name).alias("table_or"), F.count(F.lit(1)).alias("lignes"), F.sum(F.col(column).cast("double")).alias("somme")).select("table_or", "lignes", "somme")
        out = one if out is None else out.unionByName(one)
    return out


def _written_gold(lake, name: str):
    """All rows of one written gold table."""
    return lambda spark, sf: as_double(spark.read.parquet(lake(spark, sf).gold(name)))


def _bundle_results(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    paths = _lake(spark, sf)
    return pipeline.analysis_bundle(*(pipeline.read_silver(spark, p) for p in (paths.silver_listings, paths.silver_skills)))


def _bundle(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each result of the analysis bundle, made from the written silver and skills."""
    out = None
    for name, df in _bundle_results(spark, sf).items():
        one = df.agg(F.lit(name).alias("resultat"), F.count(F.lit(1)).alias("lignes")).select("resultat", "lignes")
        out = one if out is None else out.unionByName(one)
    return out


def _make_bundle_document(spark: SparkSession, sf: str) -> pipeline.LakePaths:
    path = scratch_table(spark)
    export_bundle_document(spark, _bundle_results(spark, sf), path)
    return pipeline.LakePaths(path)


_bundle_document = _shared("bundle", _make_bundle_document)


def _bundle_result(name: str):
    """One result, read back from the bundle's JSON document."""
    return lambda spark, sf: read_bundle_document(spark, _bundle_document(spark, sf).root, name, _bundle_results(spark, sf)[name])


def _partitions_listed(spark: SparkSession, sf: str) -> DataFrame:
    return B.stored_partitions(spark, _lake(spark, sf).bronze)


def _metadata_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """Each partition's metadata after a month was replayed: only that month was read again."""
    return B.read_metadata(spark, _month_lake(spark, sf).bronze_metadata).select("partition", "source_key", "month_key", "nb_offres", "schema_version")


def _envelope_lake(spark: SparkSession, sf: str) -> DataFrame:
    """The listings as one document a partition, read back with the keys that the folders give."""
    root = scratch_table(spark)
    E.write_envelope_lake(raw(spark, sf), root, source_file=f"{sf}/orders.parquet")
    return as_double(E.read_envelope_lake(spark, root).select(*RAW_OUTPUT, "source_key", "month_key"))


def _skills_indexed(spark: SparkSession, sf: str) -> DataFrame:
    return extract_skills_indexed(silver(spark, sf), dictionary_frame(spark, load_dictionary())).select(*SKILL_COLUMNS)


PAY_KEYS = ("profil_normalise", "ville_std", "type_contrat_std")


def _pay_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """G2's quartiles by rank in a distributed sort."""
    pay = silver(spark, sf).select(*PAY_KEYS, F.when(F.col("salaire_connu"), F.col("salaire_median_mad")).alias("valeur"))
    q = percentiles(pay, PAY_KEYS, "valeur", (0.25, 0.5, 0.75))
    return q.select(*PAY_KEYS, F.col("n").alias("nb_valeurs"), *[round_half_up(F.col(f"q{i}"), 2).alias(name) for i, name in enumerate(("q1", "mediane", "q3"))])


def _top_skills_approx(spark: SparkSession, sf: str) -> DataFrame:
    """G1 with estimated distinct counts: monthly sketches of listing ids, merged."""
    found = skills(spark, sf).withColumn("mois_cle", B.month_key(F.col("date_pub")))
    return S.approximate_top_skills(materialize(S.skill_sketches(found, "mois_cle")))


def _companies(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as a company file (CSV with a header), written and read back with its declared schema."""
    path = scratch_table(spark)
    c = read_table(spark, sf, "customer")
    c.select(F.col("c_name").alias("nom_entreprise"), F.col("c_mktsegment").alias("secteur"), F.lit("10-50, filiales").alias("taille"), F.concat(F.lit('dite "'), F.col("c_nationkey"), F.lit('"')).alias("ville_siege"),
             F.lit(None).cast("string").alias("site_web"), F.col("c_custkey").cast("string").alias("type")).write.option("escape", '"').csv(path, header=True)
    return read_companies(spark, path)


def _gold_json(spark: SparkSession, sf: str) -> DataFrame:
    """The written pay table exported as JSON records and read back."""
    path = scratch_table(spark)
    table = spark.read.parquet(_lake(spark, sf).gold("salaires_par_profil"))
    export_json(table, path)
    return spark.read.schema(table.schema).json(path)


def _sql(text: str):
    """A question asked as SQL text over the lake's views."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        pipeline.register_views(spark, _lake(spark, sf))
        return spark.sql(text)
    return run


# The questions on cities and pay, as one would type them (half-up rounding, as in gold).
SQL_CITY_RANK = """
SELECT ville, profil, SUM(nb_offres) AS nb_offres, SUM(nb_offres_remote) AS nb_offres_remote,
       floor(SUM(nb_offres_remote) * 100D / SUM(nb_offres) * 10 + 0.5) / 10 AS pct_remote,
       CAST(rank() OVER (PARTITION BY profil ORDER BY SUM(nb_offres) DESC) AS BIGINT) AS rang_ville
FROM offres_par_ville WHERE ville IN ('Casablanca', 'Rabat', 'Tanger', 'Marrakech', 'Fès') GROUP BY ville, profil"""
SQL_KNOWN_PAY = """
SELECT profil_normalise AS profil, count(*) AS nb_offres, count_if(salaire_connu) AS nb_connus, median(salaire_median_mad) FILTER (WHERE salaire_connu) AS mediane,
       count(DISTINCT s.competence) AS nb_competences
FROM offres_clean o LEFT JOIN (SELECT profil, competence FROM top_competences) s ON s.profil = o.profil_normalise AND s.competence = 'python' GROUP BY profil_normalise"""


# A column of each gold table to sum, for the check of the written tables.
GOLD_SUMS = {"top_competences": "nb_offres_mentionnent", "salaires_par_profil": "nb_offres", "offres_par_ville": "nb_offres_remote",
             "entreprises_recruteurs": "nb_offres_publiees", "tendances_mensuelles": "nb_offres"}


# ------------------------------------------------------------------ Spark side
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_partition_keys": lambda s, d: B.with_partition_keys(raw(s, d)).select("id_offre", "source_key", "month_key"),
    "bronze_report": lambda s, d: B.ingestion_report(B.with_partition_keys(raw(s, d))),
    "bronze_partitions": lambda s, d: B.list_partitions(B.with_partition_keys(raw(s, d))),
    "bronze_roundtrip": _bronze_roundtrip,
    "silver_table": lambda s, d: as_double(silver(s, d).select(*SILVER_OUTPUT)),
    "title_profile": lambda s, d: silver(s, d).select("id_offre", "titre_poste", "profil_normalise"),
    "pay_parse": lambda s, d: silver(s, d).select(
        "id_offre", "salaire_brut", "salaire_min_mad", "salaire_max_mad", "salaire_connu", "salaire_median_mad"),
    "experience_parse": lambda s, d: as_double(silver(s, d).select(
        "id_offre", "experience_requise", "experience_min_ans", "experience_max_ans")),
    "city_region": lambda s, d: silver(s, d).select("id_offre", "ville", "ville_std", "region_admin"),
    "contract_type": lambda s, d: silver(s, d).select("id_offre", "type_contrat", "type_contrat_std"),
    "date_check": lambda s, d: silver(s, d).select(
        "id_offre", "date_publication", "date_expiration", "date_publication_std", "date_expiration_std",
        "annee", "mois", "date_coherente"),
    "profile_top8": lambda s, d: profile_distribution(silver(s, d), 8),
    "quality_report": lambda s, d: quality_report(silver(s, d)),
    "skills_long": lambda s, d: skills(s, d).select(*SKILL_COLUMNS),
    "skills_coverage": lambda s, d: extraction_report(skills(s, d)),
    "skills_by_family": lambda s, d: mentions_by_family(skills(s, d)),
    "doc_terms": lambda s, d: document_terms(read_table(s, d, "documents").select("doc_id", "text"),
                                             dictionary_from_terms(L.DOCUMENT_TERMS)),
    "gold_top_skills": gold_top,
    "gold_pay": gold_pay,
    "gold_city_month": gold_city,
    "gold_recruiters": gold_rec,
    "gold_trends": lambda s, d: as_double(gold_trends(s, d)),
    "q1_top20": lambda s, d: I.top_skills_overall(gold_total(s, d), 20),
    "q1_top5_profiles": lambda s, d: I.top_skills_for_profiles(profiles_table(s, d)),
    "q2_city_rank": lambda s, d: I.city_rank(city_table(s, d)),
    "q2_city_share": lambda s, d: I.city_share(I.city_rank(city_table(s, d))),
    "q2_city_vs_city": lambda s, d: I.city_vs_city(city_table(s, d)),
    "q3_national": lambda s, d: I.national_pay(pay_table(s, d)),
    "q3_national_median": lambda s, d: I.national_pay_median_of_medians(pay_table(s, d)),
    "q3_city_gap": lambda s, d: I.city_pay_gap(pay_table(s, d)),
    "q4_bands": lambda s, d: I.pay_by_experience_band(counts_table(s, d)),
    "q4_correlation": lambda s, d: I.experience_pay_correlation(counts_table(s, d)),
    "q4_correlation_grouped": lambda s, d: I.experience_pay_correlation_grouped(counts_table(s, d)),
    "q5_rank": lambda s, d: I.recruiter_rank(recruiters_table(s, d)),
    "q5_competition": lambda s, d: I.city_competitors(recruiters_table(s, d)),
    "q5_competition_data": lambda s, d: I.city_competitors_with_profiles(recruiters_table(s, d)),
    "q5_rank_positions": lambda s, d: I.recruiter_rank(recruiters_table(s, d), 20, method="row_number"),
    "q2_city_pivot": lambda s, d: I.city_pivot(city_table(s, d)),
    "v1_city_bubbles": lambda s, d: I.city_bubbles(city_table(s, d)),
    "v2_top15": lambda s, d: I.top_skills_chart(gold_total(s, d)),
    "v3_box": lambda s, d: I.pay_box_stats(counts_table(s, d)),
    "v4_month_pivot": lambda s, d: I.monthly_profile_pivot(trends_table(s, d), month_from=None, month_to=None),
    "bronze_rejects": _bronze_rejects,
    "envelope_read": _envelopes,
    "lake_silver": _lake_silver,
    "lake_skills": _lake_skills,
    "lake_gold": _lake_gold,
    "analysis_bundle": _bundle,
    "q3_national_exact": lambda s, d: I.national_pay_exact(silver(s, d)),
    "q3_city_gap_script": lambda s, d: I.city_pay_gap_script(pay_table(s, d)),
    "q4_bands_code": lambda s, d: I.pay_by_experience_code(counts_table(s, d)),
    "skill_chart_labels": lambda s, d: I.skill_chart_labels(gold_profiles(s, d)),
    "bronze_partitions_listed": _partitions_listed,
    "bronze_metadata_replayed": _metadata_replayed,
    "envelope_lake": _envelope_lake,
    "skills_indexed": _skills_indexed,
    "gold_pay_ranks": _pay_ranks,
    "gold_top_skills_approx": _top_skills_approx,
    "companies_csv": _companies,
    "gold_pay_json": _gold_json,
    "sql_city_rank": _sql(SQL_CITY_RANK),
    "sql_known_pay": _sql(SQL_KNOWN_PAY),
}
# the written gold tables, of the whole run and after a month's replay
GOLD_ORACLES = {"top_competences": "gold_top_skills", "salaires_par_profil": "gold_pay", "offres_par_ville": "gold_city_month", "entreprises_recruteurs": "gold_recruiters", "tendances_mensuelles": "gold_trends"}
QUERIES |= {f"lake_{name}": _written_gold(_lake, name) for name in GOLD_ORACLES} | {f"month_{name}": _written_gold(_month_lake, name) for name in GOLD_ORACLES}
# the results of the bundle's JSON document
BUNDLE_ORACLES = {"q1_top_competences_global": "q1_top20", "q1_top_competences_data": "q1_top5_profiles", "q2_villes_comparaison": "q2_city_pivot", "q3_salaires_national": "q3_national_median",
                  "q3_salaires_ville": "q3_city_gap_script", "q4_correlation_experience": "q4_bands", "q5_top_recruteurs": "q5_rank_positions", "q5_concurrents_ville": "q5_competition_data"}
QUERIES |= {f"bundle_{name}": _bundle_result(name) for name in BUNDLE_ORACLES}


# ------------------------------------------------------------------ DuckDB oracle
def _gold_ctes() -> str:
    remote = "(" + " OR ".join(f"teletravail ILIKE {q('%' + k + '%')}" for k in L.REMOTE_KEYWORDS) + ")"
    return f""",
g1 AS (
  SELECT CASE WHEN GROUPING(profil) = 1 THEN {q(L.TOTAL_PROFILE_LABEL)} ELSE profil END AS profil, famille, competence,
         COUNT(DISTINCT id_offre) AS nb_offres_mentionnent
  FROM skills WHERE competence != {q(L.SKILL_SENTINEL)}
  GROUP BY GROUPING SETS ((profil, famille, competence), (famille, competence))
),
gold_top AS (
  SELECT profil, famille, competence, nb_offres_mentionnent,
    {rhu("CAST(nb_offres_mentionnent AS DOUBLE) * 100.0 / (SELECT COUNT(DISTINCT id_offre) FROM silver)", 2)} AS pct_offres_total,
    CAST(RANK() OVER (PARTITION BY profil ORDER BY nb_offres_mentionnent DESC) AS BIGINT) AS rang_dans_profil
  FROM g1
),
gold_pay AS (
  SELECT profil_normalise AS profil, ville_std AS ville, type_contrat_std AS type_contrat,
    COUNT(*) AS nb_offres,
    COUNT(*) FILTER (WHERE salaire_connu) AS nb_offres_avec_salaire,
    {rhu("MEDIAN(salaire_median_mad) FILTER (WHERE salaire_connu)")} AS salaire_median_mad,
    {rhu("AVG(salaire_median_mad) FILTER (WHERE salaire_connu)")} AS salaire_moyen_mad,
    {rhu("quantile_cont(salaire_median_mad, 0.25) FILTER (WHERE salaire_connu)")} AS salaire_q1_mad,
    {rhu("quantile_cont(salaire_median_mad, 0.75) FILTER (WHERE salaire_connu)")} AS salaire_q3_mad,
    {rhu("MIN(salaire_min_mad) FILTER (WHERE salaire_connu)")} AS salaire_min_observe,
    {rhu("MAX(salaire_max_mad) FILTER (WHERE salaire_connu)")} AS salaire_max_observe
  FROM silver
  GROUP BY profil_normalise, ville_std, type_contrat_std
  HAVING COUNT(*) >= 5
),
gold_city AS (
  SELECT ville_std AS ville, region_admin, profil_normalise AS profil, annee, mois,
    COUNT(*) AS nb_offres,
    COUNT(*) FILTER (WHERE {remote}) AS nb_offres_remote,
    {pct("COUNT(*) FILTER (WHERE " + remote + ")", "COUNT(*)", 1)} AS pct_remote
  FROM silver
  GROUP BY ville_std, region_admin, profil_normalise, annee, mois
),
gold_rec AS (
  SELECT entreprise, ville_std AS ville,
    COUNT(*) AS nb_offres_publiees,
    COUNT(DISTINCT profil_normalise) AS nb_profils_differents,
    {rhu("AVG(salaire_median_mad) FILTER (WHERE salaire_connu)")} AS salaire_moyen_propose,
    STRING_AGG(DISTINCT profil_normalise, ', ' ORDER BY profil_normalise) AS profils_recrutes,
    MIN(date_publication_std) AS premiere_offre,
    MAX(date_publication_std) AS derniere_offre
  FROM silver
  WHERE entreprise IS NOT NULL AND entreprise != ''
  GROUP BY entreprise, ville_std
  HAVING COUNT(*) >= 3
  ORDER BY nb_offres_publiees DESC, entreprise, ville
  LIMIT 100
),
gold_trends AS (
  SELECT annee, mois, profil_normalise AS profil,
    COUNT(*) AS nb_offres,
    {rhu("AVG(salaire_median_mad) FILTER (WHERE salaire_connu)")} AS salaire_moyen_mois,
    LAG(COUNT(*)) OVER (PARTITION BY profil_normalise ORDER BY annee ASC NULLS LAST, mois ASC NULLS LAST) AS nb_offres_mois_precedent
  FROM silver
  GROUP BY annee, mois, profil_normalise
)
"""


def _gold(sql: str) -> str:
    return O.base(skills=True).rstrip("\n") + _gold_ctes() + sql


def _silver(sql: str) -> str:
    return O.base() + sql


def _skills(sql: str) -> str:
    return O.base(skills=True) + sql


def _band_sql(col: str) -> str:
    b0, b1, b2, b3, b4 = [q(b) for b in L.EXPERIENCE_BANDS]
    return (f"CASE WHEN {col} = 0 THEN {b0} WHEN {col} BETWEEN 1 AND 2 THEN {b1} WHEN {col} BETWEEN 3 AND 4 THEN {b2} "
            f"WHEN {col} BETWEEN 5 AND 7 THEN {b3} WHEN {col} >= 8 THEN {b4} ELSE {q(L.EXPERIENCE_BAND_UNKNOWN)} END")


def _corr_sql(x: str, y: str) -> str:
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0.0)"


def _q4_rows_sql() -> str:
    return (f"SELECT * FROM silver WHERE profil_normalise IN {lst(L.DATA_PROFILES)} AND salaire_connu "
            f"AND salaire_median_mad IS NOT NULL AND salaire_median_mad != 0 AND experience_min_ans IS NOT NULL")


def _doc_terms_sql() -> str:
    from talentlake.operators.skills import dictionary_from_terms

    slots = O._skill_slots(dictionary_from_terms(L.DOCUMENT_TERMS), "lower(text)")
    return f"""WITH found AS (SELECT doc_id, unnest({slots}) AS h FROM documents)
SELECT h.famille AS famille, h.competence AS competence, COUNT(DISTINCT doc_id) AS nb_documents
FROM found GROUP BY h.famille, h.competence"""


def _box_sql() -> str:
    lo, hi = L.BOX_PAY_RANGE
    return _silver(f""",
known AS (SELECT * FROM silver WHERE salaire_connu AND salaire_median_mad IS NOT NULL AND salaire_median_mad != 0),
vals AS (SELECT profil_normalise AS profil, salaire_median_mad AS v FROM known
         WHERE profil_normalise IN {lst(L.BOX_PROFILES)} AND salaire_median_mad BETWEEN {lo} AND {hi}),
stats AS (
  SELECT profil, COUNT(*) AS nb_valeurs, quantile_cont(v, 0.25) AS q1, median(v) AS mediane, quantile_cont(v, 0.75) AS q3
  FROM vals GROUP BY profil HAVING COUNT(*) >= {L.BOX_MIN_VALUES}
),
fenced AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM stats),
wh AS (
  SELECT f.profil, MIN(CASE WHEN v >= lo THEN v END) AS moustache_basse, MAX(CASE WHEN v <= hi THEN v END) AS moustache_haute,
         COUNT(*) FILTER (WHERE v < lo OR v > hi) AS nb_valeurs_extremes
  FROM vals JOIN fenced f USING (profil) GROUP BY f.profil
)
SELECT f.profil, f.nb_valeurs, {rhu('f.q1', 2)} AS q1, {rhu('f.mediane', 2)} AS mediane, {rhu('f.q3', 2)} AS q3,
  {rhu('w.moustache_basse', 2)} AS moustache_basse, {rhu('w.moustache_haute', 2)} AS moustache_haute, w.nb_valeurs_extremes,
  {rhu("(SELECT median(salaire_median_mad) FROM known WHERE profil_normalise = 'Data Engineer')", 2)} AS mediane_reference
FROM fenced f JOIN wh w USING (profil)
""")


def _bubbles_sql() -> str:
    lon = " ".join(f"WHEN {q(c)} THEN {lo_}" for c, (lo_, la) in L.CITY_COORDINATES.items())
    lat = " ".join(f"WHEN {q(c)} THEN {la}" for c, (lo_, la) in L.CITY_COORDINATES.items())
    k, b = L.BUBBLE_SCALE
    return _gold(f""",
per_city AS (SELECT ville, CAST(SUM(nb_offres) AS BIGINT) AS nb_offres FROM gold_city GROUP BY ville)
SELECT ville, nb_offres, CAST(CASE ville {lon} END AS DOUBLE) AS longitude, CAST(CASE ville {lat} END AS DOUBLE) AS latitude,
  {rhu(f"CAST(nb_offres AS DOUBLE) / CAST((SELECT MAX(nb_offres) FROM per_city) AS DOUBLE) * {k} + {b}", 2)} AS taille
FROM per_city WHERE ville IN {lst(L.CITY_COORDINATES)} AND nb_offres > 0
""")


def _pivot_sql() -> str:
    cols = ", ".join(
        f"CAST(coalesce(SUM(CASE WHEN profil = {q(p)} THEN nb_offres END), 0) AS BIGINT) AS \"{p}\"" for p in L.DATA_PROFILES
    )
    return _gold(f""",
rows_ AS (
  SELECT annee || '-' || mois AS mois_cle, profil, nb_offres FROM gold_trends
  WHERE profil IN {lst(L.DATA_PROFILES)} AND annee IS NOT NULL AND mois IS NOT NULL AND annee != '' AND mois != ''
)
SELECT mois_cle, {cols} FROM rows_
GROUP BY mois_cle
""")


def _raw_keys_sql(select: str) -> str:
    return O.with_ctes(O.raw_cte()) + f""", keyed AS (
  SELECT *, replace(lower(coalesce(source, {q(L.BRONZE_UNKNOWN_SOURCE)})), ' ', '_') AS source_key,
    CASE WHEN regexp_matches(substring(date_publication, 1, 7), '^[0-9]{{4}}-(0?[1-9]|1[0-2])$')
         THEN substring(date_publication, 1, 4) || '_' || lpad(regexp_extract(substring(date_publication, 6, 2), '[0-9]+'), 2, '0')
         ELSE {q(L.BRONZE_UNKNOWN_MONTH)} END AS month_key
  FROM raw
)
{select}"""


def _report_sql() -> str:
    return _raw_keys_sql("""SELECT CASE WHEN GROUPING(source_key) = 0 AND GROUPING(month_key) = 0 THEN 'partition'
            WHEN GROUPING(source_key) = 0 THEN 'source' WHEN GROUPING(month_key) = 0 THEN 'mois' ELSE 'total' END AS niveau,
       source_key, month_key, COUNT(*) AS nb_offres, COUNT(DISTINCT source_key || '/' || month_key) AS nb_fichiers
FROM keyed GROUP BY GROUPING SETS ((source_key, month_key), (source_key), (month_key), ())""")


def _q4_grouped_sql() -> str:
    keep = "salaire_connu AND experience_min_ans IS NOT NULL"
    return _silver(f""",
base_ AS (SELECT profil_normalise AS profil, {_band_sql('experience_min_ans')} AS tranche_experience,
                 experience_min_ans, salaire_connu, salaire_median_mad
          FROM silver WHERE profil_normalise IN {lst(L.DATA_PROFILES)}),
groups AS (SELECT profil, tranche_experience, experience_min_ans, salaire_connu, salaire_median_mad,
                  COUNT(*) AS nb_offres, AVG(salaire_median_mad) FILTER (WHERE salaire_connu) AS salaire_moyen
           FROM base_ GROUP BY profil, tranche_experience, experience_min_ans, salaire_connu, salaire_median_mad),
r AS (SELECT profil, {rhu(_corr_sql(f"CASE WHEN {keep} THEN CAST(experience_min_ans AS DOUBLE) END",
                                   f"CASE WHEN {keep} THEN salaire_median_mad END"), 3)} AS correlation_pearson
      FROM groups GROUP BY profil),
per_band AS (SELECT profil, tranche_experience, CAST(SUM(nb_offres) AS BIGINT) AS nb_offres,
                    {rhu(f"AVG({rhu('salaire_moyen')})")} AS salaire_moyen
             FROM groups GROUP BY profil, tranche_experience)
SELECT p.profil, p.tranche_experience, p.nb_offres, p.salaire_moyen, r.correlation_pearson
FROM per_band p LEFT JOIN r USING (profil)
""")


def _national_sql() -> str:
    return f"""SELECT profil,
    CAST(SUM(nb_offres) AS BIGINT) AS nb_offres_total,
    CAST(SUM(nb_offres_avec_salaire) AS BIGINT) AS nb_avec_salaire,
    {pct("SUM(nb_offres_avec_salaire)", "SUM(nb_offres)", 1)} AS pct_salaire_communique,
    {rhu("AVG(salaire_median_mad)")} AS salaire_median_mad,
    {rhu("MIN(salaire_min_observe)")} AS salaire_plancher,
    {rhu("MAX(salaire_max_observe)")} AS salaire_plafond
  FROM gold_pay GROUP BY profil"""


ORACLE: dict[str, str] = {
    "bronze_partition_keys": _raw_keys_sql("SELECT id_offre, source_key, month_key FROM keyed"),
    "bronze_report": _report_sql(),
    "bronze_partitions": _raw_keys_sql("SELECT DISTINCT source_key, month_key FROM keyed"),
    "bronze_roundtrip": _raw_keys_sql("SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in NULLABLE_INTS else c for c in RAW_OUTPUT) + ", source_key, month_key FROM keyed"),
    "silver_table": _silver("SELECT " + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" if c in NULLABLE_INTS else c for c in SILVER_OUTPUT) + " FROM silver"),
    "title_profile": _silver("SELECT id_offre, titre_poste, profil_normalise FROM silver"),
    "pay_parse": _silver(
        "SELECT id_offre, salaire_brut, salaire_min_mad, salaire_max_mad, salaire_connu, salaire_median_mad FROM silver"),
    "experience_parse": _silver("SELECT id_offre, experience_requise, CAST(experience_min_ans AS DOUBLE) AS experience_min_ans, "
                                "CAST(experience_max_ans AS DOUBLE) AS experience_max_ans FROM silver"),
    "city_region": _silver("SELECT id_offre, ville, ville_std, region_admin FROM silver"),
    "contract_type": _silver("SELECT id_offre, type_contrat, type_contrat_std FROM silver"),
    "date_check": _silver(
        "SELECT id_offre, date_publication, date_expiration, date_publication_std, date_expiration_std, annee, mois, "
        "date_coherente FROM silver"),
    "profile_top8": _silver(
        "SELECT profil_normalise, COUNT(*) AS nb_offres FROM silver GROUP BY profil_normalise "
        "ORDER BY nb_offres DESC, profil_normalise LIMIT 8"),
    "quality_report": _silver(f""", agg AS (
  SELECT COUNT(*) AS nb_offres,
    COUNT(*) FILTER (WHERE profil_normalise = {q(L.TITLE_DEFAULT)}) AS nb_autre_it,
    COUNT(*) FILTER (WHERE salaire_connu) AS nb_salaire_connu,
    COUNT(experience_min_ans) AS nb_experience_parsee,
    COUNT(*) FILTER (WHERE ville_std != {q(L.CITY_UNKNOWN)}) AS nb_villes_reconnues,
    COUNT(*) FILTER (WHERE ville_std IN {lst(L.REGIONS)}) AS nb_villes_canoniques,
    COUNT(*) FILTER (WHERE NOT date_coherente) AS nb_dates_incoherentes,
    COUNT(DISTINCT profil_normalise) AS nb_profils
  FROM silver)
SELECT *, {pct('nb_autre_it', 'nb_offres')} AS pct_autre_it, {pct('nb_salaire_connu', 'nb_offres')} AS pct_salaire_connu,
  {pct('nb_experience_parsee', 'nb_offres')} AS pct_experience_parsee,
  {pct('nb_villes_reconnues', 'nb_offres')} AS pct_villes_reconnues,
  {pct('nb_dates_incoherentes', 'nb_offres')} AS pct_dates_incoherentes
FROM agg"""),
    "skills_long": _skills("SELECT " + ", ".join(SKILL_COLUMNS) + " FROM skills"),
    "skills_coverage": _skills(f""", agg AS (
  SELECT COUNT(DISTINCT id_offre) AS nb_offres_analysees,
    COUNT(DISTINCT CASE WHEN competence = {q(L.SKILL_SENTINEL)} THEN id_offre END) AS nb_offres_sans_competence,
    COUNT(*) AS nb_lignes
  FROM skills)
SELECT nb_offres_analysees, nb_offres_analysees - nb_offres_sans_competence AS nb_offres_avec_competence,
  nb_offres_sans_competence,
  {pct('nb_offres_analysees - nb_offres_sans_competence', 'nb_offres_analysees')} AS pct_avec_competence,
  {pct('nb_offres_sans_competence', 'nb_offres_analysees')} AS pct_sans_competence, nb_lignes
FROM agg"""),
    "skills_by_family": _skills(
        f"SELECT famille, COUNT(*) AS nb_mentions FROM skills WHERE competence != {q(L.SKILL_SENTINEL)} GROUP BY famille"),
    "doc_terms": _doc_terms_sql(),
    "gold_top_skills": _gold("SELECT * FROM gold_top"),
    "gold_pay": _gold("SELECT * FROM gold_pay"),
    "gold_city_month": _gold("SELECT * FROM gold_city"),
    "gold_recruiters": _gold("SELECT * FROM gold_rec"),
    "gold_trends": _gold("SELECT annee, mois, profil, nb_offres, salaire_moyen_mois, "
                         "CAST(nb_offres_mois_precedent AS DOUBLE) AS nb_offres_mois_precedent FROM gold_trends"),
    "q1_top20": _gold(
        f"SELECT famille, competence, nb_offres_mentionnent, pct_offres_total, rang_dans_profil FROM gold_top "
        f"WHERE profil = {q(L.TOTAL_PROFILE_LABEL)} ORDER BY nb_offres_mentionnent DESC, competence LIMIT 20"),
    "q1_top5_profiles": _gold(
        f"SELECT profil, famille, competence, nb_offres_mentionnent, rang_dans_profil FROM gold_top "
        f"WHERE profil IN {lst(L.DATA_PROFILES)} AND rang_dans_profil <= 5"),
    "q2_city_rank": _gold(f"""SELECT ville, profil, CAST(SUM(nb_offres) AS BIGINT) AS nb_offres,
    CAST(SUM(nb_offres_remote) AS BIGINT) AS nb_offres_remote,
    {pct('SUM(nb_offres_remote)', 'SUM(nb_offres)', 1)} AS pct_remote,
    CAST(RANK() OVER (PARTITION BY profil ORDER BY SUM(nb_offres) DESC) AS BIGINT) AS rang_ville
  FROM gold_city WHERE ville IN {lst(L.MAIN_CITIES)} GROUP BY ville, profil"""),
    "q2_city_share": _gold(f""",
per_city AS (SELECT ville, CAST(SUM(nb_offres) AS BIGINT) AS nb_offres FROM gold_city
             WHERE ville IN {lst(L.MAIN_CITIES)} GROUP BY ville)
SELECT ville, nb_offres, {pct('nb_offres', '(SELECT SUM(nb_offres) FROM per_city)', 1)} AS pct_total FROM per_city"""),
    "q2_city_vs_city": _gold(f""",
ref AS (SELECT profil, CAST(SUM(nb_offres) AS BIGINT) AS nb_reference FROM gold_city WHERE ville = 'Casablanca' GROUP BY profil),
loc AS (SELECT profil, CAST(SUM(nb_offres) AS BIGINT) AS nb_ville, CAST(SUM(nb_offres_remote) AS BIGINT) AS remote_ville
        FROM gold_city WHERE ville = 'Tanger' GROUP BY profil)
SELECT l.profil, r.nb_reference, l.nb_ville, l.remote_ville, {pct('l.nb_ville', 'r.nb_reference', 1)} AS pct_ville_vs_reference
FROM loc l LEFT JOIN ref r USING (profil) WHERE l.profil IN {lst(L.CITY_COMPARISON_PROFILES)}"""),
    "q3_national": _gold(_national_sql()),
    "q3_national_median": _gold("""SELECT profil, CAST(SUM(nb_offres) AS BIGINT) AS nb_offres,
    """ + rhu("MEDIAN(CASE WHEN salaire_median_mad != 0 THEN salaire_median_mad END)") + """ AS salaire_median_mad,
    MIN(CASE WHEN salaire_min_observe != 0 THEN salaire_min_observe END) AS salaire_plancher,
    MAX(CASE WHEN salaire_max_observe != 0 THEN salaire_max_observe END) AS salaire_plafond
  FROM gold_pay GROUP BY profil"""),
    "q3_city_gap": _gold(f""",
national AS ({_national_sql()})
SELECT g.profil, g.ville, g.type_contrat, g.nb_offres, {rhu('g.salaire_median_mad')} AS salaire_median_ville,
  {rhu('g.salaire_q1_mad')} AS q1, {rhu('g.salaire_q3_mad')} AS q3, {rhu('g.salaire_min_observe')} AS sal_min,
  {rhu('g.salaire_max_observe')} AS sal_max, n.salaire_median_mad AS mediane_nationale,
  {rhu('g.salaire_median_mad')} - n.salaire_median_mad AS ecart_vs_national
FROM gold_pay g LEFT JOIN national n USING (profil)
WHERE g.ville = 'Tanger' AND g.nb_offres >= 5"""),
    "q4_bands": _silver(f""",
rows_ AS ({_q4_rows_sql()}),
agg AS (SELECT profil_normalise AS profil, {_band_sql('experience_min_ans')} AS tranche_experience,
               COUNT(*) AS nb_offres, {rhu('MEDIAN(salaire_median_mad)')} AS salaire_median
        FROM rows_ GROUP BY 1, 2),
grid AS (SELECT p.profil, b.tranche_experience FROM (VALUES {', '.join(f'({q(p)})' for p in L.DATA_PROFILES)}) p(profil)
         CROSS JOIN (VALUES {', '.join(f'({q(b)})' for b in L.EXPERIENCE_BANDS)}) b(tranche_experience))
SELECT g.profil, g.tranche_experience, CAST(coalesce(a.nb_offres, 0) AS BIGINT) AS nb_offres, a.salaire_median
FROM grid g LEFT JOIN agg a USING (profil, tranche_experience)"""),
    "q4_correlation": _silver(f""",
rows_ AS ({_q4_rows_sql()})
SELECT profil_normalise AS profil, COUNT(*) AS nb_offres,
  {rhu(_corr_sql('CAST(experience_min_ans AS DOUBLE)', 'salaire_median_mad'), 3)} AS correlation_pearson
FROM rows_ GROUP BY profil_normalise"""),
    "q4_correlation_grouped": _q4_grouped_sql(),
    "q5_rank": _gold(f"""SELECT entreprise, ville, nb_offres_publiees, nb_profils_differents,
    {rhu('salaire_moyen_propose')} AS salaire_moyen_propose,
    CAST(RANK() OVER (ORDER BY nb_offres_publiees DESC) AS BIGINT) AS rang_recruteur
  FROM (SELECT * FROM gold_rec ORDER BY nb_offres_publiees DESC, entreprise, ville LIMIT 20) t"""),
    "q5_competition": _gold(f"""SELECT entreprise, nb_offres_publiees, {rhu('salaire_moyen_propose')} AS salaire_moyen_propose,
    CASE WHEN salaire_moyen_propose > 20000 THEN 'Compétiteur fort' WHEN salaire_moyen_propose > 12000 THEN 'Compétiteur moyen'
         ELSE {q(L.COMPETITION_DEFAULT)} END AS niveau_competition
  FROM (SELECT * FROM gold_rec WHERE ville = 'Tanger' ORDER BY nb_offres_publiees DESC, entreprise LIMIT 15) t"""),
    "q5_competition_data": _gold(f"""SELECT entreprise, nb_offres_publiees AS nb_offres,
    coalesce(salaire_moyen_propose, 0.0) AS salaire_moyen,
    CASE WHEN length(coalesce(profils_recrutes, '')) > 50 THEN substring(coalesce(profils_recrutes, ''), 1, 50) || '...'
         ELSE coalesce(profils_recrutes, '') END AS profils,
    CASE WHEN coalesce(salaire_moyen_propose, 0.0) > 20000 THEN 'Compétiteur fort'
         WHEN coalesce(salaire_moyen_propose, 0.0) > 12000 THEN 'Compétiteur moyen' ELSE 'Compétiteur faible' END AS niveau_competition
  FROM gold_rec
  WHERE ville = 'Tanger' AND ({' OR '.join(f"contains(coalesce(profils_recrutes, ''), {q(p)})" for p in L.DATA_PROFILES)})"""),
    "q5_rank_positions": _gold(f"""SELECT entreprise, ville, nb_offres_publiees, nb_profils_differents,
    {rhu('salaire_moyen_propose')} AS salaire_moyen_propose,
    CAST(ROW_NUMBER() OVER (ORDER BY nb_offres_publiees DESC, entreprise, ville) AS BIGINT) AS rang_recruteur
  FROM (SELECT * FROM gold_rec ORDER BY nb_offres_publiees DESC, entreprise, ville LIMIT 20) t"""),
    "q2_city_pivot": _gold(f""",
rows_ AS (SELECT * FROM gold_city WHERE profil IN {lst(L.CITY_COMPARISON_PROFILES)} AND ville IN {lst(L.PIVOT_CITIES)}),
agg AS (SELECT profil,
    {', '.join(f"CAST(coalesce(SUM(CASE WHEN ville = {q(c)} THEN nb_offres END), 0) AS BIGINT) AS {c}" for c in L.PIVOT_CITIES)},
    CAST(coalesce(SUM(CASE WHEN ville = 'Tanger' THEN nb_offres_remote END), 0) AS BIGINT) AS remote_Tanger
  FROM rows_ GROUP BY profil),
grid AS (SELECT * FROM (VALUES {', '.join(f'({q(p)})' for p in L.CITY_COMPARISON_PROFILES)}) g(profil))
SELECT g.profil, {', '.join(f'CAST(coalesce(a.{c}, 0) AS BIGINT) AS {c}' for c in L.PIVOT_CITIES)},
  CAST(coalesce(a.remote_Tanger, 0) AS BIGINT) AS remote_Tanger,
  CASE WHEN coalesce(a.Casablanca, 0) > 0 THEN {rhu('CAST(a.Tanger AS DOUBLE) * 100.0 / CAST(a.Casablanca AS DOUBLE)', 1)} ELSE 0.0 END
    AS pct_Tanger_vs_Casablanca
FROM grid g LEFT JOIN agg a USING (profil)"""),
    "v1_city_bubbles": _bubbles_sql(),
    "v2_top15": _gold(
        f"SELECT competence, nb_offres_mentionnent, famille FROM gold_top WHERE profil = {q(L.TOTAL_PROFILE_LABEL)} "
        f"ORDER BY nb_offres_mentionnent DESC, competence LIMIT 15"),
    "v3_box": _box_sql(),
    "v4_month_pivot": _pivot_sql(),
    "bronze_rejects": """WITH o AS (SELECT o_orderkey AS k, '{"id_offre":"L-' || o_orderkey || '","source":"' || o_orderstatus || '","date_publication":"'
      || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '","nb_postes":"' || o_orderkey || '","langue_requise":"fr","champ_inconnu":' || o_orderkey || '}' AS line FROM orders)
SELECT 'accepte' AS etat, 'L-' || k AS id_offre, CAST(k AS DOUBLE) AS nb_postes, 'fr' AS langues, CAST(k AS VARCHAR) AS champ_inconnu, CAST(NULL AS VARCHAR) AS texte FROM o WHERE k % 9 > 4
UNION ALL SELECT 'rejete', NULL, NULL, NULL, NULL, CASE k % 9 WHEN 0 THEN left(line, length(line) - 3) WHEN 1 THEN line || line WHEN 2 THEN line || ' fin' WHEN 3 THEN line || '] ' || line ELSE '[' || line || ']' END FROM o WHERE k % 9 <= 4""",
    "envelope_read": """SELECT 'L-' || o_orderkey AS id_offre, o_orderpriority AS secteur, CAST(o_custkey AS DOUBLE) AS nb_postes, CAST(NULL AS BIGINT) AS document FROM orders WHERE (o_orderkey // 2000) % 2 = 0
UNION ALL SELECT DISTINCT NULL, NULL, NULL, o_orderkey // 2000 FROM orders WHERE (o_orderkey // 2000) % 2 = 1""",
    "q3_national_exact": _silver(f"""SELECT profil_normalise AS profil, COUNT(*) AS nb_offres_total, COUNT(*) FILTER (salaire_connu) AS nb_avec_salaire,
    CAST(CAST(floor(COUNT(*) FILTER (salaire_connu) * 100.0 / COUNT(*) + 0.5) AS BIGINT) AS VARCHAR) || '%' AS pct_salaire,
    {rhu("MEDIAN(salaire_median_mad) FILTER (salaire_connu)")} AS salaire_median_mad, {rhu("MIN(salaire_min_mad)")} AS salaire_plancher, {rhu("MAX(salaire_max_mad)")} AS salaire_plafond
  FROM silver GROUP BY profil_normalise"""),
    "q3_city_gap_script": _gold(f""",
nat AS (SELECT profil, {rhu("MEDIAN(nullif(salaire_median_mad, 0))")} AS m FROM gold_pay GROUP BY profil),
loc AS (SELECT profil, ville, type_contrat, nb_offres, coalesce(salaire_median_mad, 0) AS salaire_median_ville, salaire_q1_mad AS q1, salaire_q3_mad AS q3,
               salaire_min_observe AS sal_min, salaire_max_observe AS sal_max FROM gold_pay WHERE ville = 'Tanger' AND nb_offres >= 5)
SELECT loc.*, coalesce(nat.m, 0) AS mediane_nationale, salaire_median_ville - coalesce(nat.m, 0) AS ecart_vs_national,
  CASE WHEN salaire_median_ville >= coalesce(nat.m, 0) THEN '+' ELSE '-' END || format('{{:,}}', CAST(abs(salaire_median_ville - coalesce(nat.m, 0)) AS BIGINT)) AS ecart_texte
FROM loc LEFT JOIN nat USING (profil) ORDER BY salaire_median_ville DESC, profil, type_contrat LIMIT 10"""),
    "skill_chart_labels": _gold("""SELECT profil, famille, competence, nb_offres_mentionnent, replace(replace(profil, 'Développeur ', 'Dev. '), 'Chef de Projet IT', 'Chef Proj. IT') AS libelle_profil,
  array_to_string(list_transform(string_split(famille, '_'), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS libelle_famille
FROM gold_top WHERE profil <> '""" + L.TOTAL_PROFILE_LABEL + "'"),
    "lake_gold": _gold("""SELECT 'top_competences' AS table_or, COUNT(*) AS lignes, CAST(SUM(nb_offres_mentionnent) AS DOUBLE) AS somme FROM gold_top
UNION ALL SELECT 'salaires_par_profil', COUNT(*), CAST(SUM(nb_offres) AS DOUBLE) FROM gold_pay
UNION ALL SELECT 'offres_par_ville', COUNT(*), CAST(SUM(nb_offres_remote) AS DOUBLE) FROM gold_city
UNION ALL SELECT 'entreprises_recruteurs', COUNT(*), CAST(SUM(nb_offres_publiees) AS DOUBLE) FROM gold_rec
UNION ALL SELECT 'tendances_mensuelles', COUNT(*), CAST(SUM(nb_offres) AS DOUBLE) FROM gold_trends"""),
}
# written tables against the definitions
ORACLE["lake_silver"], ORACLE["lake_skills"] = ORACLE["silver_table"], ORACLE["skills_long"]
ORACLE["q4_bands_code"] = (f"SELECT b.*, CAST(list_position([{', '.join(q(b) for b in L.EXPERIENCE_BANDS)}], tranche_experience) AS INTEGER) AS code_experience "
                           f"FROM ({ORACLE['q4_bands']}) b")
# rows of the eight results
ORACLE["analysis_bundle"] = " UNION ALL ".join(f"SELECT '{n}' AS resultat, COUNT(*) AS lignes FROM ({ORACLE[k]})" for n, k in BUNDLE_ORACLES.items())
# their values, and those of the written gold tables
ORACLE |= {f"bundle_{n}": ORACLE[k] for n, k in BUNDLE_ORACLES.items()}
ORACLE |= {f"{kind}_{n}": ORACLE[k] for n, k in GOLD_ORACLES.items() for kind in ("lake", "month")}
ORACLE |= {
    "bronze_partitions_listed": ORACLE["bronze_partitions"],
    "bronze_metadata_replayed": _raw_keys_sql("SELECT source_key || '/' || month_key AS partition, source_key, month_key, COUNT(*) AS nb_offres, '1.0' AS schema_version FROM keyed GROUP BY ALL"),
    "envelope_lake": ORACLE["bronze_roundtrip"],
    "skills_indexed": ORACLE["skills_long"],
    "gold_pay_ranks": _silver(f"""SELECT profil_normalise, ville_std, type_contrat_std, COUNT(salaire_median_mad) AS nb_valeurs, {rhu("quantile_cont(salaire_median_mad, 0.25)", 2)} AS q1,
    {rhu("median(salaire_median_mad)", 2)} AS mediane, {rhu("quantile_cont(salaire_median_mad, 0.75)", 2)} AS q3 FROM silver WHERE salaire_connu AND salaire_median_mad IS NOT NULL GROUP BY ALL"""),
    "companies_csv": "SELECT c_name AS nom_entreprise, c_mktsegment AS secteur, '10-50, filiales' AS taille, 'dite \"' || c_nationkey || '\"' AS ville_siege, CAST(NULL AS VARCHAR) AS site_web, CAST(c_custkey AS VARCHAR) AS type FROM customer",
    "gold_pay_json": ORACLE["gold_pay"],
    "sql_city_rank": ORACLE["q2_city_rank"],
    "sql_known_pay": _gold("""SELECT profil_normalise AS profil, COUNT(*) AS nb_offres, COUNT(*) FILTER (salaire_connu) AS nb_connus, median(salaire_median_mad) FILTER (salaire_connu) AS mediane,
    COUNT(DISTINCT competence) AS nb_competences FROM silver LEFT JOIN (SELECT profil, competence FROM gold_top WHERE competence = 'python') t ON t.profil = profil_normalise GROUP BY profil_normalise"""),
}
# queries on a lake that a whole run of the job made (``_shared``)
WHOLE_JOB = {"lake_silver", "lake_skills", "lake_gold", "analysis_bundle", "bronze_partitions_listed", "bronze_metadata_replayed", "gold_pay_json", "sql_city_rank", "sql_known_pay",
             *(f"{kind}_{n}" for n in GOLD_ORACLES for kind in ("lake", "month")), *(f"bundle_{n}" for n in BUNDLE_ORACLES)}
# estimates have no SQL: tests hold them to the exact counts
ESTIMATES = {"gold_top_skills_approx"}

assert set(ORACLE) | ESTIMATES == set(QUERIES), set(ORACLE) ^ set(QUERIES)

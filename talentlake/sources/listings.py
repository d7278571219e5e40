"""Listing sources.

``listings_from_tables`` derives one raw listing per row of the shared
``orders`` table, through a deterministic SQL view whose text runs unchanged
in Spark SQL and DuckDB: one projection over the scan, whatever the size. Ids
repeat for some listings, so that counts of distinct ids differ from counts
of rows; the texts name every skill of the dictionary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentlake.functions.normalize import text_or_list
from talentlake.operators.skills import load_dictionary
from talentlake.schema import RAW_LISTING

# The first alias of every skill, for the free text of the view.
_SKILL_WORDS = [aliases[0] for _, _, aliases in load_dictionary()]
_SKILL_CASES = "\n    ".join(f"WHEN {i} THEN 'Stack : {word}, équipe dynamique'" for i, word in enumerate(_SKILL_WORDS))

# Deterministic listing view over {orders}. The same text is the oracle's
# source (talentlake.plans.oracle), so both engines see the same columns.
LISTINGS_VIEW_SQL = """
SELECT
  CASE WHEN k % 31 = 7 THEN 'R-' || CAST(k % 29 AS VARCHAR(20)) ELSE 'L-' || CAST(k AS VARCHAR(20)) END AS listing_id,
  CASE s WHEN 'P' THEN 'Board A' WHEN 'O' THEN 'board_b' ELSE 'BOARD C' END AS source,
  CASE k % 25 WHEN 0 THEN 'Data Engineer' WHEN 1 THEN 'Data Eng.' WHEN 2 THEN 'ETL Developer' WHEN 3 THEN 'Ingénieur Big Data'
    WHEN 4 THEN 'Data Analyst' WHEN 5 THEN 'Développeur BI' WHEN 6 THEN 'BI Analyst' WHEN 7 THEN 'Data Scientist'
    WHEN 8 THEN 'ML Engineer' WHEN 9 THEN 'NLP Engineer' WHEN 10 THEN 'Full-Stack Developer' WHEN 11 THEN 'Back-End Developer'
    WHEN 12 THEN 'Développeur Front-End' WHEN 13 THEN 'iOS Developer' WHEN 14 THEN 'DevOps / Cloud Engineer' WHEN 15 THEN 'SRE'
    WHEN 16 THEN 'AWS Engineer' WHEN 17 THEN 'Pentester' WHEN 18 THEN 'Scrum Master' WHEN 19 THEN 'Architecte Cloud'
    WHEN 20 THEN 'Cloud Architect' WHEN 21 THEN 'Admin Système' WHEN 22 THEN 'Security Engineer' WHEN 23 THEN ' DATA  ENGINEER senior ' ELSE NULL END AS title_text,
  CASE (k * 7) % 13 WHEN 0 THEN 'casa' WHEN 1 THEN 'Grand Casablanca' WHEN 2 THEN 'RABAT' WHEN 3 THEN 'Tanger-Med' WHEN 4 THEN 'Marrakesh'
    WHEN 5 THEN 'FES' WHEN 6 THEN 'Kénitra' WHEN 7 THEN 'MEKNES' WHEN 8 THEN 'tétouan' WHEN 9 THEN 'sidi-slimane' WHEN 10 THEN '' WHEN 11 THEN 'TANGER' ELSE NULL END AS city_text,
  CASE (k * 5) % 11 WHEN 0 THEN 'cdi' WHEN 1 THEN 'Contrat à durée indéterminée' WHEN 2 THEN 'Contrat à durée déterminée' WHEN 3 THEN 'Mission freelance'
    WHEN 4 THEN 'Internship' WHEN 5 THEN 'Contrat d''apprentissage' WHEN 6 THEN 'Temporary' WHEN 7 THEN 'other' WHEN 8 THEN 'Permanent' ELSE NULL END AS contract_text,
  CASE ((k * 13) % 17) % 14 WHEN 0 THEN 'Débutant accepté' WHEN 1 THEN '0-1 an' WHEN 2 THEN CASE WHEN k % 2 = 0 THEN '1-3 ans' ELSE '3\u00a0à\u00a05 ans' END
    WHEN 3 THEN '3 à 5 ans' WHEN 4 THEN CASE WHEN k % 2 = 0 THEN 'min 3 ans' ELSE 'min 4\u202fans' END
    WHEN 5 THEN '5/8 ans' WHEN 6 THEN 'Senior (5+ ans)' WHEN 7 THEN 'Senior confirmé' WHEN 8 THEN '8+ ans' WHEN 9 THEN '10-12 ans'
    WHEN 10 THEN '3 years' WHEN 11 THEN 'à discuter' WHEN 12 THEN '2 ans' ELSE NULL END AS experience_text,
  CASE ((k * 17) % 19) % 12
    WHEN 0 THEN CAST(lo AS VARCHAR(20)) || '-' || CAST(hi AS VARCHAR(20)) || ' MAD'
    WHEN 1 THEN CAST(lo AS VARCHAR(20)) || ' - ' || CAST(hi AS VARCHAR(20)) || ' DH'
    WHEN 2 THEN CAST(lok AS VARCHAR(20)) || 'K-' || CAST(lok + 3 AS VARCHAR(20)) || 'K MAD'
    WHEN 3 THEN CAST(lok AS VARCHAR(20)) || '.5K'
    WHEN 4 THEN CAST(lok * 90 AS VARCHAR(20)) || '-' || CAST(lok * 90 + 300 AS VARCHAR(20)) || ' EUR'
    WHEN 5 THEN CAST(lok AS VARCHAR(20)) || '-' || CAST(lok + 3 AS VARCHAR(20)) || 'K'
    WHEN 6 THEN CAST(hi AS VARCHAR(20)) || '-' || CAST(lo AS VARCHAR(20))
    WHEN 7 THEN CASE WHEN k % 5 = 0 THEN '99999999999999999999k' ELSE 'Confidentiel' END WHEN 8 THEN 'Selon profil' WHEN 9 THEN '150000 MAD' WHEN 10 THEN CAST(lok AS VARCHAR(20)) || ',000 MAD' ELSE NULL END AS pay_text,
  CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN 'n/a' WHEN k % 79 = 0 THEN '24-01-05' WHEN k % 73 = 0 THEN '12024-01-1' ELSE CAST(d AS VARCHAR(10)) END AS pub_date_text,
  CASE WHEN k % 83 = 0 THEN NULL ELSE CAST(d + CAST((k * 19) % 56 - 5 AS INT) AS VARCHAR(10)) END AS exp_date_text,
  CASE (k * 23) % 7 WHEN 0 THEN 'Présentiel' WHEN 1 THEN 'Hybride' WHEN 2 THEN 'TÉLÉTRAVAIL complet' WHEN 3 THEN 'Remote' WHEN 4 THEN 'teletravail' ELSE 'Non précisé' END AS remote_text,
  CASE (k * 29) % 9 WHEN 0 THEN 'Python, Spark • SQL' WHEN 1 THEN 'React.js / Node.js' WHEN 2 THEN 'Java | Docker' WHEN 3 THEN 'django rest api'
    WHEN 4 THEN 'R, Power BI' WHEN 5 THEN 'JavaScript' WHEN 6 THEN '' ELSE NULL END AS skills_text,
  CASE (k * 31) % 53
    """ + _SKILL_CASES + """
    WHEN 49 THEN 'Offre récente, équipe dynamique' WHEN 50 THEN 'Maîtrise de Git et CI/CD requise' ELSE NULL END AS description,
  CASE k % 5 WHEN 0 THEN 'Bac+5' WHEN 1 THEN 'Bac+3' WHEN 2 THEN 'Doctorat' ELSE NULL END AS study_text,
  pr AS sector_text,
  CASE WHEN k % 6 = 0 THEN NULL ELSE CAST(k % 6 AS INT) END AS positions,
  CASE k % 4 WHEN 0 THEN '["français", "anglais"]' WHEN 1 THEN '["arabe"]' WHEN 2 THEN 'français courant' ELSE NULL END AS languages_text,
  CASE WHEN ck % 31 = 0 THEN '' ELSE 'Company ' || CAST(ck % 40 AS VARCHAR(20)) END AS company
FROM (
  SELECT o_orderkey AS k, o_orderstatus AS s, CAST(o_orderdate AS DATE) AS d, o_custkey AS ck, o_orderpriority AS pr,
         3000 + (o_orderkey % 41) * 500 AS lo, 4000 + (o_orderkey % 41) * 500 + (o_orderkey % 29) * 250 AS hi,
         3 + (o_orderkey % 37) AS lok
  FROM {orders}
) b
"""

# View column -> raw listing field.
VIEW_TO_RAW = {
    "listing_id": "id_offre",
    "source": "source",
    "title_text": "titre_poste",
    "description": "description",
    "skills_text": "competences_brut",
    "company": "entreprise",
    "city_text": "ville",
    "contract_text": "type_contrat",
    "experience_text": "experience_requise",
    "pay_text": "salaire_brut",
    "pub_date_text": "date_publication",
    "exp_date_text": "date_expiration",
    "remote_text": "teletravail",
    "study_text": "niveau_etudes",
    "sector_text": "secteur",
    "positions": "nb_postes",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def listings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing view over ``orders``: a projection, no join and no shuffle."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    return spark.sql(LISTINGS_VIEW_SQL, orders=orders)


def to_raw_listing(view: DataFrame) -> DataFrame:
    """Map the view's columns onto the declared raw listing schema; fields
    the view does not carry are NULL of the declared type."""
    by_raw = {raw: view_col for view_col, raw in VIEW_TO_RAW.items()}
    cols = []
    for field in RAW_LISTING.fields:
        if field.name in by_raw:
            cols.append(F.col(by_raw[field.name]).cast(field.dataType).alias(field.name))
        elif field.name == "langue_requise":
            cols.append(text_or_list(F.col("languages_text")).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return view.select(*cols)


def listings_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings (declared schema) derived from the shared test tables."""
    return to_raw_listing(listings_view(spark, sf_dir))

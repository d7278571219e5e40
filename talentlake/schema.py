"""Schemas and column names of the listing lake.

Column names follow the data model of the system being reproduced, so
that silver and gold tables are drop-in compatible for its users.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw listing as received (17 fields). Declared, never inferred.
RAW_LISTING = T.StructType([
    T.StructField("id_offre", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("titre_poste", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("competences_brut", T.StringType()),
    T.StructField("entreprise", T.StringType()),
    T.StructField("ville", T.StringType()),
    T.StructField("type_contrat", T.StringType()),
    T.StructField("experience_requise", T.StringType()),
    T.StructField("salaire_brut", T.StringType()),
    T.StructField("niveau_etudes", T.StringType()),
    T.StructField("secteur", T.StringType()),
    T.StructField("date_publication", T.StringType()),
    T.StructField("date_expiration", T.StringType()),
    T.StructField("nb_postes", T.IntegerType()),
    T.StructField("teletravail", T.StringType()),
    T.StructField("langue_requise", T.ArrayType(T.StringType())),
])
RAW_COLUMNS = [f.name for f in RAW_LISTING.fields]

# Envelope document: {"metadata": {...}, "offres": [listing, ...]}
ENVELOPE_METADATA = T.StructType([
    T.StructField("source_fichier", T.StringType()),
    T.StructField("date_ingestion", T.StringType()),
    T.StructField("partition", T.StringType()),
    T.StructField("nb_offres", T.LongType()),
    T.StructField("schema_version", T.StringType()),
])
# Listings stay JSON text here: each is read on its own, so that one bad listing
# does not take the document with it.
ENVELOPE = T.StructType([
    T.StructField("metadata", ENVELOPE_METADATA),
    T.StructField("offres", T.ArrayType(T.StringType())),
])

# The listing as it arrived, as JSON text: fields outside the 17 and values of
# another type than declared are in it.
RAW_JSON = "listing_json"

# Bronze = raw listing + landing metadata + the two partition keys.
BRONZE_META_COLUMNS = ["source_fichier", "date_ingestion", "schema_version"]
BRONZE_PARTITION_COLUMNS = ["source_key", "month_key"]
BRONZE = T.StructType(
    RAW_LISTING.fields
    + [T.StructField(c, T.StringType()) for c in [RAW_JSON, *BRONZE_META_COLUMNS]]
    + [T.StructField(c, T.StringType()) for c in BRONZE_PARTITION_COLUMNS]
)

# Columns silver adds to the raw listing (15).
SILVER_DERIVED = [
    "profil_normalise",
    "salaire_min_mad", "salaire_max_mad", "salaire_connu", "salaire_median_mad",
    "experience_min_ans", "experience_max_ans",
    "ville_std", "region_admin",
    "type_contrat_std",
    "date_publication_std", "date_expiration_std", "annee", "mois", "date_coherente",
]

# Long skills table (one row per listing x skill).
SKILL_COLUMNS = [
    "id_offre", "profil", "ville", "competence", "famille",
    "date_pub", "annee", "mois", "type_contrat", "salaire_connu",
]

# Company reference file (source only).
COMPANIES = T.StructType([
    T.StructField("nom_entreprise", T.StringType()),
    T.StructField("secteur", T.StringType()),
    T.StructField("taille", T.StringType()),
    T.StructField("ville_siege", T.StringType()),
    T.StructField("site_web", T.StringType()),
    T.StructField("type", T.StringType()),
])

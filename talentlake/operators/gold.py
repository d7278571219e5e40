"""Gold: the five aggregate tables.

Every table is a hash aggregation with map-side partial aggregation, so a group
that holds a third of all listings sends one partial row per task. The distinct
counts of G1 shuffle one row per (listing, skill) pair, keyed by the pair. Windows
run on the aggregated rows: profiles x skills, and profiles x months. City
names are not a closed list (an unrecognised one is kept), so the rows of G2, G3
and G4 grow with the distinct city texts.

Exact medians/quartiles use ``percentile``, whose partial buffers are
(value -> count) maps, so memory grows with the number of DISTINCT pay
values in a group, not with its row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talentlake import lexicons as L
from talentlake.functions.normalize import is_remote
from talentlake.functions.stats import pct_of
from talentlake.functions.text import round_half_up


def _listing_count() -> F.Column:
    return F.count(F.lit(1))


def top_skills(skills: DataFrame, silver: DataFrame | None = None, with_total_level: bool = True,
               total_label: str = L.TOTAL_PROFILE_LABEL, with_profiles: bool = True,
               unique_ids: bool = False) -> DataFrame:
    """G1: skills per profile -> distinct listings, share of ALL listings,
    rank inside the profile. With ``with_total_level`` an extra level
    ``profil = 'tous'`` ranks the skills over all listings;
    ``with_profiles=False`` leaves only that one.

    The (listing, skill) pairs are shuffled once, by pair, and sorted by pair and profile where
    they arrive (an id hardly repeats, so there is next to nothing to combine before); the sort can go to
    disk, and is all that a task holds. The first row of a pair and profile counts for the profile level, the
    first of a pair for the all-listings level. ``unique_ids=True`` states that no id occurs in
    two listings; then rows are counted as they are, and no pair is shuffled at all.

    The denominator is COUNT(DISTINCT id) over ``silver`` (a one-column read; on a
    lazy silver plan, the key of the listing view after column pruning), or
    over the skills table, where every listing has at least one row."""
    known = skills.filter(F.col("competence") != F.lit(L.SKILL_SENTINEL))
    pair, total = ["id_offre", "famille", "competence"], F.lit(total_label).alias("profil")
    if unique_ids:
        labels = [F.col("profil")] * with_profiles + [F.lit(total_label)] * with_total_level
        each = known.select("famille", "competence", F.explode(F.array(*labels)).alias("profil"))
    else:
        by_pair = Window.partitionBy(*pair).orderBy("profil")
        placed = known.select(*pair, "profil").repartition(*pair).select(
            "*", (F.row_number().over(by_pair) == 1).alias("_first"), F.lag("profil").over(by_pair).alias("_before"))
        new = F.col("_first") | ~F.col("profil").eqNullSafe(F.col("_before"))   # in its pair and profile
        if not with_profiles:
            each = placed.where("_first").select("famille", "competence", total)
        elif not with_total_level:
            each = placed.where(new).select("famille", "competence", "profil")
        else:
            here = F.when(F.col("_first"), F.array(F.col("profil"), F.lit(total_label))).otherwise(F.array("profil"))
            each = placed.where(new).select("famille", "competence", F.explode(here).alias("profil"))
    counts = each.groupBy("profil", "famille", "competence").agg(F.count(F.lit(1)).alias("nb_offres_mentionnent"))
    ids = silver if silver is not None else skills
    ids = ids.select(F.count(F.lit(1)) if unique_ids and silver is not None else F.countDistinct("id_offre"))
    w = Window.partitionBy("profil").orderBy(F.desc("nb_offres_mentionnent"))
    return counts.select(
        "profil", "famille", "competence", "nb_offres_mentionnent",
        round_half_up(F.col("nb_offres_mentionnent").cast("double") * F.lit(100.0) / ids.scalar().cast("double"), 2)
        .alias("pct_offres_total"),
        F.rank().over(w).cast("bigint").alias("rang_dans_profil"),
    ).orderBy("profil", "rang_dans_profil", "competence")


def pay_by_profile(silver: DataFrame, min_listings: int = 5) -> DataFrame:
    """(profile, city, contract) -> counts and pay distribution of the
    listings with a known pay; groups need ``min_listings`` listings (all
    listings, so a group may have no pay statistics)."""
    known = F.col("salaire_connu")
    mid = F.when(known, F.col("salaire_median_mad"))
    return (
        silver.groupBy(
            F.col("profil_normalise").alias("profil"), F.col("ville_std").alias("ville"),
            F.col("type_contrat_std").alias("type_contrat"),
        )
        .agg(
            _listing_count().alias("nb_offres"),
            F.count_if(known).alias("nb_offres_avec_salaire"),
            # one value map for all three quartiles
            F.percentile(mid, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"),
            round_half_up(F.avg(mid), 0).alias("salaire_moyen_mad"),
            round_half_up(F.min(F.when(known, F.col("salaire_min_mad"))), 0).alias("salaire_min_observe"),
            round_half_up(F.max(F.when(known, F.col("salaire_max_mad"))), 0).alias("salaire_max_observe"),
        )
        .filter(F.col("nb_offres") >= min_listings)
        .select(
            "profil", "ville", "type_contrat", "nb_offres", "nb_offres_avec_salaire",
            round_half_up(F.col("_q")[1], 0).alias("salaire_median_mad"), "salaire_moyen_mad",
            round_half_up(F.col("_q")[0], 0).alias("salaire_q1_mad"),
            round_half_up(F.col("_q")[2], 0).alias("salaire_q3_mad"),
            "salaire_min_observe", "salaire_max_observe",
        )
        .orderBy(F.desc("nb_offres"), "profil", "ville", "type_contrat")
    )


def listings_by_city_month(silver: DataFrame) -> DataFrame:
    """(city, region, profile, year, month) -> listings, remote listings, % remote."""
    remote = is_remote(F.col("teletravail"))
    return (
        silver.groupBy(
            F.col("ville_std").alias("ville"), "region_admin", F.col("profil_normalise").alias("profil"), "annee", "mois",
        )
        .agg(_listing_count().alias("nb_offres"), F.count_if(remote).alias("nb_offres_remote"))
        .select("*", pct_of(F.col("nb_offres_remote"), F.col("nb_offres"), 1).alias("pct_remote"))
        .orderBy(F.desc("nb_offres"), "ville", "profil", F.asc_nulls_last("annee"), F.asc_nulls_last("mois"))
    )


def top_recruiters(silver: DataFrame, min_listings: int = 3, top: int = 100) -> DataFrame:
    """(company, city) -> listings, distinct profiles, mean pay, sorted
    profile list, first/last publication; non-empty company, ``min_listings``
    listings; the ``top`` largest (ties broken by company, city)."""
    known = F.col("salaire_connu")
    return (
        silver.filter(F.col("entreprise").isNotNull() & (F.col("entreprise") != F.lit("")))
        .groupBy("entreprise", F.col("ville_std").alias("ville"))
        .agg(
            _listing_count().alias("nb_offres_publiees"),
            F.countDistinct("profil_normalise").alias("nb_profils_differents"),
            round_half_up(F.avg(F.when(known, F.col("salaire_median_mad"))), 0).alias("salaire_moyen_propose"),
            F.array_join(F.array_sort(F.collect_set("profil_normalise")), ", ").alias("profils_recrutes"),
            F.min("date_publication_std").alias("premiere_offre"),
            F.max("date_publication_std").alias("derniere_offre"),
        )
        .filter(F.col("nb_offres_publiees") >= min_listings)
        .orderBy(F.desc("nb_offres_publiees"), "entreprise", "ville")
        .limit(top)
    )


def monthly_trends(silver: DataFrame) -> DataFrame:
    """(year, month, profile) -> listings, mean pay, and the listings of
    the previous EXISTING month of that profile (NULL month sorts last)."""
    known = F.col("salaire_connu")
    agg = silver.groupBy("annee", "mois", F.col("profil_normalise").alias("profil")).agg(
        _listing_count().alias("nb_offres"),
        round_half_up(F.avg(F.when(known, F.col("salaire_median_mad"))), 0).alias("salaire_moyen_mois"),
    )
    w = Window.partitionBy("profil").orderBy(F.asc_nulls_last("annee"), F.asc_nulls_last("mois"))
    return agg.select(
        "annee", "mois", "profil", "nb_offres", "salaire_moyen_mois",
        F.lag("nb_offres").over(w).alias("nb_offres_mois_precedent"),
    ).orderBy("profil", F.asc_nulls_last("annee"), F.asc_nulls_last("mois"))

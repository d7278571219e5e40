"""Gold kept by month: partial states that merge, and gold finished from them.

A state has one row for each group *and month*, with counts, sums, extremes and, where a
percentile is asked for, one row for each value with its count. States of different months
merge by addition, so a replayed month replaces its own state and nothing else, and gold is
finished from the states alone; listings of other months are not read again.

G1's distinct count does not add up: an id may occur in several months. Two ways are offered.
Exact: ``skill_state`` keeps each month's distinct (id, skill, profile) rows, the least that
an exact count over months can be made of. Approximate, opt-in: ``skill_sketches`` keeps a
HyperLogLog sketch for each (skill, profile) and month, of a fixed size whatever the ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talentlake import lexicons as L
from talentlake.functions.normalize import is_remote
from talentlake.functions.stats import pct_of
from talentlake.functions.text import round_half_up
from talentlake.operators import gold as G

# Sketches of 2^12 registers: a relative standard error of about 1.6 %.
SKETCH_LG_K = 12


# ------------------------------------------------------------------ states, a row for each group of a month
def pay_state(silver: DataFrame, month: str) -> DataFrame:
    """For each (profile, city, contract) and each pay value (NULL: not known), how many listings
    have it, and their least and greatest bounds."""
    known = F.col("salaire_connu")
    return silver.groupBy(
        month, F.col("profil_normalise").alias("profil"), F.col("ville_std").alias("ville"), F.col("type_contrat_std").alias("type_contrat"),
        known.alias("connu"), F.when(known, F.col("salaire_median_mad")).alias("valeur"),
    ).agg(F.count(F.lit(1)).alias("nb"), F.min(F.when(known, F.col("salaire_min_mad"))).alias("minimum"), F.max(F.when(known, F.col("salaire_max_mad"))).alias("maximum"))


def city_state(silver: DataFrame, month: str) -> DataFrame:
    """Listings and remote listings."""
    return silver.groupBy(month, F.col("ville_std").alias("ville"), "region_admin", F.col("profil_normalise").alias("profil"), "annee", "mois").agg(
        F.count(F.lit(1)).alias("nb"), F.count_if(is_remote(F.col("teletravail"))).alias("nb_remote"))


def _pay_sums() -> list[F.Column]:
    pay = F.when(F.col("salaire_connu"), F.col("salaire_median_mad"))
    return [F.count(F.lit(1)).alias("nb"), F.count(pay).alias("nb_connu"), F.sum(pay).alias("somme")]


def recruiter_state(silver: DataFrame, month: str) -> DataFrame:
    """A row for each profile of a (company, city)."""
    named = silver.filter(F.col("entreprise").isNotNull() & (F.col("entreprise") != F.lit("")))
    return named.groupBy(month, "entreprise", F.col("ville_std").alias("ville"), F.col("profil_normalise").alias("profil")).agg(
        *_pay_sums(), F.min("date_publication_std").alias("premiere"), F.max("date_publication_std").alias("derniere"))


def trend_state(silver: DataFrame, month: str) -> DataFrame:
    """Listings and pay of a (year, month, profile)."""
    return silver.groupBy(month, "annee", "mois", F.col("profil_normalise").alias("profil")).agg(*_pay_sums())


def skill_state(skills: DataFrame, month: str) -> DataFrame:
    """G1: the month's distinct (id, skill, profile); the sentinel rows give the ids without a skill."""
    return skills.select(month, "id_offre", "profil", "famille", "competence").distinct()


def skill_sketches(skills: DataFrame, month: str, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """G1, approximate: for each (profile, skill) a sketch of its listing ids; the sentinel has its own."""
    return skills.groupBy(month, "profil", "famille", "competence").agg(F.hll_sketch_agg("id_offre", F.lit(lg_k)).alias("ids"))


# ------------------------------------------------------------------ gold from states
def pay_by_profile(state: DataFrame, min_listings: int = 5) -> DataFrame:
    """G2 from ``pay_state``."""
    n = F.when(F.col("valeur").isNotNull(), F.col("nb"))
    quarter = F.percentile("valeur", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("nb"))
    merged = state.groupBy("profil", "ville", "type_contrat").agg(
        F.sum("nb").alias("nb_offres"), F.sum(F.when(F.col("connu"), F.col("nb")).otherwise(0)).alias("nb_offres_avec_salaire"),
        quarter.alias("_q"), (F.try_divide(F.sum(F.col("valeur") * F.col("nb")), F.sum(n))).alias("_m"), F.min("minimum").alias("_lo"), F.max("maximum").alias("_hi"))
    return merged.filter(F.col("nb_offres") >= min_listings).select(
        "profil", "ville", "type_contrat", "nb_offres", "nb_offres_avec_salaire",
        round_half_up(F.col("_q")[1], 0).alias("salaire_median_mad"), round_half_up(F.col("_m"), 0).alias("salaire_moyen_mad"),
        round_half_up(F.col("_q")[0], 0).alias("salaire_q1_mad"), round_half_up(F.col("_q")[2], 0).alias("salaire_q3_mad"),
        round_half_up(F.col("_lo"), 0).alias("salaire_min_observe"), round_half_up(F.col("_hi"), 0).alias("salaire_max_observe"),
    ).orderBy(F.desc("nb_offres"), "profil", "ville", "type_contrat")


def listings_by_city_month(state: DataFrame) -> DataFrame:
    """G3 from ``city_state``."""
    merged = state.groupBy("ville", "region_admin", "profil", "annee", "mois").agg(F.sum("nb").alias("nb_offres"), F.sum("nb_remote").alias("nb_offres_remote"))
    return merged.select("*", pct_of(F.col("nb_offres_remote"), F.col("nb_offres"), 1).alias("pct_remote")).orderBy(
        F.desc("nb_offres"), "ville", "profil", F.asc_nulls_last("annee"), F.asc_nulls_last("mois"))


def _mean_pay() -> F.Column:
    return round_half_up(F.try_divide(F.sum("somme"), F.sum("nb_connu")), 0)


def top_recruiters(state: DataFrame, min_listings: int = 3, top: int = 100) -> DataFrame:
    """G4 from ``recruiter_state``."""
    # one row a profile first, so that the profiles are counted and listed without a set of listings
    each = state.groupBy("entreprise", "ville", "profil").agg(
        F.sum("nb").alias("nb"), F.sum("nb_connu").alias("nb_connu"), F.sum("somme").alias("somme"), F.min("premiere").alias("premiere"), F.max("derniere").alias("derniere"))
    return each.groupBy("entreprise", "ville").agg(
        F.sum("nb").alias("nb_offres_publiees"), F.count("profil").alias("nb_profils_differents"), _mean_pay().alias("salaire_moyen_propose"),
        F.array_join(F.array_sort(F.collect_list("profil")), ", ").alias("profils_recrutes"),
        F.min("premiere").alias("premiere_offre"), F.max("derniere").alias("derniere_offre"),
    ).filter(F.col("nb_offres_publiees") >= min_listings).orderBy(F.desc("nb_offres_publiees"), "entreprise", "ville").limit(top)


def monthly_trends(state: DataFrame) -> DataFrame:
    """G5 from ``trend_state``."""
    merged = state.groupBy("annee", "mois", "profil").agg(F.sum("nb").alias("nb_offres"), _mean_pay().alias("salaire_moyen_mois"))
    w = Window.partitionBy("profil").orderBy(F.asc_nulls_last("annee"), F.asc_nulls_last("mois"))
    return merged.select("annee", "mois", "profil", "nb_offres", "salaire_moyen_mois", F.lag("nb_offres").over(w).alias("nb_offres_mois_precedent")).orderBy(
        "profil", F.asc_nulls_last("annee"), F.asc_nulls_last("mois"))


def top_skills(state: DataFrame) -> DataFrame:
    """G1 from ``skill_state``, exact: every listing has a row of some skill or of the sentinel."""
    return G.top_skills(state, None)


def approximate_top_skills(sketches: DataFrame, total_label: str = L.TOTAL_PROFILE_LABEL) -> DataFrame:
    """G1 from ``skill_sketches``: the columns of G1, distinct ids estimated by merged sketches (over
    months, and over profiles for the all-listings level); shares and ranks go by the estimates."""
    levels = F.explode(F.array(F.col("profil"), F.lit(total_label))).alias("profil")
    known = sketches.filter(F.col("competence") != F.lit(L.SKILL_SENTINEL)).select("famille", "competence", "ids", levels)
    counts = known.groupBy("profil", "famille", "competence").agg(F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("nb_offres_mentionnent"))
    everyone = sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("ids"))).scalar()
    w = Window.partitionBy("profil").orderBy(F.desc("nb_offres_mentionnent"))
    share = round_half_up(F.col("nb_offres_mentionnent").cast("double") * F.lit(100.0) / everyone.cast("double"), 2)
    return counts.select("profil", "famille", "competence", "nb_offres_mentionnent", share.alias("pct_offres_total"), F.rank().over(w).cast("bigint").alias("rang_dans_profil")).orderBy(
        "profil", "rang_dans_profil", "competence")


# name -> (made from silver or skills, state, gold)
STATES = {
    "top_competences": ("skills", skill_state, top_skills),
    "salaires_par_profil": ("silver", pay_state, pay_by_profile),
    "offres_par_ville": ("silver", city_state, listings_by_city_month),
    "entreprises_recruteurs": ("silver", recruiter_state, top_recruiters),
    "tendances_mensuelles": ("silver", trend_state, monthly_trends),
}

"""Market questions and chart tables on top of gold / silver (Q1-Q5, V1-V4).

Inputs are gold tables or silver (large). Everything that touches silver is a
partial+final aggregation; joins are between aggregates, and AQE turns them into
broadcast joins where their measured sizes allow. City names are an open list, so
no plan relies on few cities. Top-k cuts carry explicit tie keys; the recruiter
questions (Q5) see the top 100 of the gold table, and the pay questions (Q3)
only groups of five listings or more, as the tables have them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talentlake import lexicons as L
from talentlake.functions.normalize import competition_level, experience_band, experience_band_index
from talentlake.functions.stats import pct_of, pearson, pearson_weighted
from talentlake.functions.text import (
    chart_label, contains_any, family_label, percent_text, round_half_up, signed_thousands, truncate_text,
)


# ------------------------------------------------------------------ Q1
def top_skills_overall(top_skills: DataFrame, n: int = 20, label: str = L.TOTAL_PROFILE_LABEL) -> DataFrame:
    """The ``n`` most mentioned skills over all listings."""
    return (
        top_skills.filter(F.col("profil") == F.lit(label))
        .select("famille", "competence", "nb_offres_mentionnent", "pct_offres_total", "rang_dans_profil")
        .orderBy(F.desc("nb_offres_mentionnent"), "competence")
        .limit(n)
    )


def top_skills_for_profiles(top_skills: DataFrame, profiles=L.DATA_PROFILES, max_rank: int = 5) -> DataFrame:
    """Skills ranked <= ``max_rank`` in each profile (ties may add rows)."""
    return (
        top_skills.filter(F.col("profil").isin(list(profiles)) & (F.col("rang_dans_profil") <= max_rank))
        .select("profil", "famille", "competence", "nb_offres_mentionnent", "rang_dans_profil")
        .orderBy("profil", "rang_dans_profil", "competence")
    )


# ------------------------------------------------------------------ Q2
def city_rank(city_month: DataFrame, cities=L.MAIN_CITIES) -> DataFrame:
    """Listings / remote / % remote per (city, profile), months summed,
    and the city's rank inside each profile."""
    agg = (
        city_month.filter(F.col("ville").isin(list(cities)))
        .groupBy("ville", "profil")
        .agg(F.sum("nb_offres").alias("nb_offres"), F.sum("nb_offres_remote").alias("nb_offres_remote"))
    )
    w = Window.partitionBy("profil").orderBy(F.desc("nb_offres"))
    return agg.select(
        "ville", "profil", "nb_offres", "nb_offres_remote",
        pct_of(F.col("nb_offres_remote"), F.col("nb_offres"), 1).alias("pct_remote"),
        F.rank().over(w).cast("bigint").alias("rang_ville"),
    ).orderBy("profil", "rang_ville", "ville")


def city_share(city_rank_df: DataFrame) -> DataFrame:
    """Q2t: total listings per city and the city's share of the total (%).

    The grand total is a scalar subquery (global partial aggregate), not a
    window over one partition."""
    per_city = city_rank_df.groupBy("ville").agg(F.sum("nb_offres").alias("nb_offres"))
    total = per_city.select(F.sum("nb_offres")).scalar()
    return per_city.select(
        "ville", "nb_offres", pct_of(F.col("nb_offres"), total, 1).alias("pct_total"),
    ).orderBy(F.desc("nb_offres"), "ville")


def city_vs_city(city_month: DataFrame, city: str = "Tanger", reference_city: str = "Casablanca",
                 profiles=L.CITY_COMPARISON_PROFILES) -> DataFrame:
    """Per profile, listings in ``city`` next to ``reference_city``
    (left join from ``city``), remote listings in ``city``, ratio %."""
    ref = (city_month.filter(F.col("ville") == F.lit(reference_city)).groupBy("profil")
           .agg(F.sum("nb_offres").alias("nb_reference")))
    loc = (city_month.filter(F.col("ville") == F.lit(city)).groupBy("profil")
           .agg(F.sum("nb_offres").alias("nb_ville"), F.sum("nb_offres_remote").alias("remote_ville")))
    return (
        loc.filter(F.col("profil").isin(list(profiles)))
        .join(ref, "profil", "left")
        .select(
            "profil", "nb_reference", "nb_ville", "remote_ville",
            pct_of(F.col("nb_ville"), F.col("nb_reference"), 1).alias("pct_ville_vs_reference"),
        )
        .orderBy(F.desc("nb_ville"), "profil")
    )


# ------------------------------------------------------------------ Q3
def national_pay(pay: DataFrame) -> DataFrame:
    """Per profile over all cities/contracts: listings, listings with
    pay, % with pay, MEAN of the group medians, lowest / highest observed."""
    return (
        pay.groupBy("profil").agg(
            F.sum("nb_offres").alias("nb_offres_total"),
            F.sum("nb_offres_avec_salaire").alias("nb_avec_salaire"),
            pct_of(F.sum("nb_offres_avec_salaire"), F.sum("nb_offres"), 1).alias("pct_salaire_communique"),
            round_half_up(F.avg("salaire_median_mad"), 0).alias("salaire_median_mad"),
            round_half_up(F.min("salaire_min_observe"), 0).alias("salaire_plancher"),
            round_half_up(F.max("salaire_max_observe"), 0).alias("salaire_plafond"),
        )
        .orderBy(F.desc_nulls_last("salaire_median_mad"), "profil")
    )


def national_pay_median_of_medians(pay: DataFrame) -> DataFrame:
    """Q3a, script form: MEDIAN of the non-zero group medians per profile."""
    med = F.when(F.col("salaire_median_mad") != 0, F.col("salaire_median_mad"))
    return (
        pay.groupBy("profil").agg(
            F.sum("nb_offres").alias("nb_offres"),
            round_half_up(F.median(med), 0).alias("salaire_median_mad"),
            F.min(F.when(F.col("salaire_min_observe") != 0, F.col("salaire_min_observe"))).alias("salaire_plancher"),
            F.max(F.when(F.col("salaire_max_observe") != 0, F.col("salaire_max_observe"))).alias("salaire_plafond"),
        )
        .orderBy(F.desc(F.coalesce(F.col("salaire_median_mad"), F.lit(0.0))), "profil")
    )


def national_pay_exact(silver: DataFrame) -> DataFrame:
    """Q3a from silver: the TRUE median of each profile's known pay values, with the
    share of listings that give their pay as ``NN%`` text. Listings are first
    reduced to (profile, pay, count), so a hot profile sends its distinct values."""
    known = F.col("salaire_connu")
    value = F.when(known, F.col("salaire_median_mad"))
    counted = silver.groupBy(F.col("profil_normalise").alias("profil"), value.alias("v")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(known).alias("k"),
        F.min(F.when(known, F.col("salaire_min_mad"))).alias("lo"), F.max(F.when(known, F.col("salaire_max_mad"))).alias("hi"))
    return counted.groupBy("profil").agg(
        F.sum("n").alias("nb_offres_total"),
        F.sum("k").alias("nb_avec_salaire"),
        percent_text(F.sum("k"), F.sum("n")).alias("pct_salaire"),
        round_half_up(F.percentile("v", 0.5, F.col("n")), 0).alias("salaire_median_mad"),
        round_half_up(F.min("lo"), 0).alias("salaire_plancher"),
        round_half_up(F.max("hi"), 0).alias("salaire_plafond"),
    ).orderBy(F.desc_nulls_last("salaire_median_mad"), "profil")


def city_pay_gap_script(pay: DataFrame, city: str = "Tanger", top: int = 10) -> DataFrame:
    """Q3b, script form: the ``top`` best-paid groups of one city against the MEDIAN of
    their profile's non-zero group medians; missing figures count as 0, and the gap
    is also given as signed text."""
    national = national_pay_median_of_medians(pay)
    gap = city_pay_gap(pay, city, top=top, null_as_zero=True, national=national)
    return gap.withColumn("ecart_texte", signed_thousands(F.col("ecart_vs_national")))


def city_pay_gap(pay: DataFrame, city: str = "Tanger", min_listings: int = 5, top: int | None = None,
                 null_as_zero: bool = False, national: DataFrame | None = None) -> DataFrame:
    """Pay groups of one city (>= ``min_listings``) next to the national
    figure of their profile, and the signed gap local - national.

    national: (profil, salaire_median_mad), by default the mean of group medians;
    ``top`` keeps the best-paid groups, ``null_as_zero`` reads a missing
    local or national figure as 0."""
    national = (national_pay(pay) if national is None else national).select("profil", F.col("salaire_median_mad").alias("mediane_nationale"))
    local = pay.filter((F.col("ville") == F.lit(city)) & (F.col("nb_offres") >= min_listings)).select(
        "profil", "ville", "type_contrat", "nb_offres",
        round_half_up(F.col("salaire_median_mad"), 0).alias("salaire_median_ville"),
        round_half_up(F.col("salaire_q1_mad"), 0).alias("q1"),
        round_half_up(F.col("salaire_q3_mad"), 0).alias("q3"),
        round_half_up(F.col("salaire_min_observe"), 0).alias("sal_min"),
        round_half_up(F.col("salaire_max_observe"), 0).alias("sal_max"),
    )
    joined = local.join(national, "profil", "left")
    if null_as_zero:
        joined = joined.na.fill(0.0, ["salaire_median_ville", "mediane_nationale"])
    out = joined.select("*", (F.col("salaire_median_ville") - F.col("mediane_nationale")).alias("ecart_vs_national")) \
        .orderBy(F.desc_nulls_last("salaire_median_ville"), "profil", "type_contrat")
    return out.limit(top) if top is not None else out


# ------------------------------------------------------------------ Q4
def pay_counts(silver: DataFrame) -> DataFrame:
    """Listings reduced to (profile, pay known, pay, experience) and their number ``n``.

    The experience and box questions need no more of silver. They take silver
    itself too, but a filter on its derived columns copies the parsing into the
    plan's constraints; computed and written first, this small table stops that."""
    return silver.groupBy("profil_normalise", "salaire_connu", "salaire_median_mad", "experience_min_ans").agg(
        F.count(F.lit(1)).alias("n"))


def _weighted(listings: DataFrame) -> DataFrame:
    return listings if "n" in listings.columns else listings.withColumn("n", F.lit(1).cast("bigint"))


def _q4_rows(silver: DataFrame, profiles) -> DataFrame:
    return _weighted(silver).filter(
        F.col("profil_normalise").isin(list(profiles))
        & F.col("salaire_connu")
        & F.col("salaire_median_mad").isNotNull() & (F.col("salaire_median_mad") != 0)
        & F.col("experience_min_ans").isNotNull()
    )


def _grid(spark: SparkSession, profiles, bands) -> DataFrame:
    """Dense (profile x band) grid from the two parameter lists (no join)."""
    return (
        spark.range(1)
        .select(F.explode(F.array(*[F.lit(p) for p in profiles])).alias("profil"))
        .select("profil", F.posexplode(F.array(*[F.lit(b) for b in bands])).alias("_ord", "tranche_experience"))
    )


def pay_by_experience_band(silver: DataFrame, profiles=L.DATA_PROFILES, bands=L.EXPERIENCE_BANDS) -> DataFrame:
    """Q4 bands: per profile and experience band, listings with pay and the
    median pay; every (profile, band) pair is present (zero-filled)."""
    rows = _q4_rows(silver, profiles).select(
        F.col("profil_normalise").alias("profil"),
        experience_band(F.col("experience_min_ans"), bands).alias("tranche_experience"),
        F.col("salaire_median_mad").alias("v"), "n",
    )
    counted = rows.groupBy("profil", "tranche_experience", "v").agg(F.sum("n").alias("n"))
    agg = counted.groupBy("profil", "tranche_experience").agg(
        F.sum("n").alias("nb_offres"),
        round_half_up(F.percentile("v", 0.5, F.col("n")), 0).alias("salaire_median"),
    )
    grid = _grid(silver.sparkSession, profiles, bands)
    return (
        grid.join(agg, ["profil", "tranche_experience"], "left")
        .select("profil", "tranche_experience", F.coalesce("nb_offres", F.lit(0)).cast("bigint").alias("nb_offres"),
                "salaire_median", "_ord")
        .orderBy("profil", "_ord").drop("_ord")
    )


def experience_pay_correlation(silver: DataFrame, profiles=L.DATA_PROFILES) -> DataFrame:
    """Q4 r: Pearson correlation of minimum experience and pay over the
    listings of each profile (NULL if < 2 listings or zero variance)."""
    return (
        _q4_rows(silver, profiles)
        .groupBy(F.col("profil_normalise").alias("profil"))
        .agg(F.sum("n").alias("nb_offres"),
             round_half_up(pearson_weighted(F.col("experience_min_ans"), F.col("salaire_median_mad"), F.col("n")), 3)
             .alias("correlation_pearson"))
        .orderBy("profil")
    )


def experience_pay_correlation_grouped(silver: DataFrame, profiles=L.DATA_PROFILES) -> DataFrame:
    """Q4, notebook form: rows are first grouped by (profile, band, experience,
    pay flag, pay); r is computed over those DISTINCT combinations (each
    once), then per (profile, band): listings, mean of the group means, r."""
    base = _weighted(silver).filter(F.col("profil_normalise").isin(list(profiles))).select(
        F.col("profil_normalise").alias("profil"),
        experience_band(F.col("experience_min_ans")).alias("tranche_experience"),
        "experience_min_ans", "salaire_connu", "salaire_median_mad", "n",
    )
    groups = base.groupBy("profil", "tranche_experience", "experience_min_ans", "salaire_connu", "salaire_median_mad").agg(
        F.sum("n").alias("nb_offres"),
        F.avg(F.when(F.col("salaire_connu"), F.col("salaire_median_mad"))).alias("salaire_moyen"),
    )
    keep = F.col("salaire_connu") & F.col("experience_min_ans").isNotNull()
    r = groups.groupBy("profil").agg(
        round_half_up(pearson(F.when(keep, F.col("experience_min_ans")), F.when(keep, F.col("salaire_median_mad"))), 3)
        .alias("correlation_pearson"))
    per_band = groups.groupBy("profil", "tranche_experience").agg(
        F.sum("nb_offres").alias("nb_offres"),
        round_half_up(F.avg(round_half_up(F.col("salaire_moyen"), 0)), 0).alias("salaire_moyen"),
    )
    return per_band.join(r, "profil", "left").orderBy("profil", "tranche_experience")


# ------------------------------------------------------------------ Q5
def recruiter_rank(recruiters: DataFrame, n: int = 20, method: str = "rank") -> DataFrame:
    """The ``n`` largest recruiters with their RANK (``method="rank"``)
    or their position 1..n (``"row_number"``, ties by company, city). The
    rank is computed after the top-n cut: every row above a kept row is
    kept, so ranks are unchanged and the window sees only ``n`` rows."""
    order = [F.desc("nb_offres_publiees"), F.asc("entreprise"), F.asc("ville")]
    top = recruiters.orderBy(*order).limit(n)
    if method == "rank":
        pos = F.rank().over(Window.orderBy(F.desc("nb_offres_publiees")))
    elif method == "row_number":
        pos = F.row_number().over(Window.orderBy(*order))
    else:
        raise ValueError("method must be 'rank' or 'row_number'")
    return top.select(
        "entreprise", "ville", "nb_offres_publiees", "nb_profils_differents",
        round_half_up(F.col("salaire_moyen_propose"), 0).alias("salaire_moyen_propose"),
        pos.cast("bigint").alias("rang_recruteur"),
    )


def city_competitors(recruiters: DataFrame, city: str = "Tanger", n: int = 15) -> DataFrame:
    """Largest recruiters of one city with a competition level from
    their mean pay (> 20000 strong, > 12000 medium, else weak / unknown)."""
    return (
        recruiters.filter(F.col("ville") == F.lit(city))
        .orderBy(F.desc("nb_offres_publiees"), "entreprise")
        .limit(n)
        .select(
            "entreprise", "nb_offres_publiees",
            round_half_up(F.col("salaire_moyen_propose"), 0).alias("salaire_moyen_propose"),
            competition_level(F.col("salaire_moyen_propose")).alias("niveau_competition"),
        )
    )


def city_competitors_with_profiles(recruiters: DataFrame, city: str = "Tanger", profiles=L.DATA_PROFILES,
                                   width: int = L.TRUNCATE_AT) -> DataFrame:
    """Q5b, script form: recruiters of one city whose recruited-profile list
    names a data profile; unknown pay counts as 0; profile list truncated to
    ``width`` characters; highest pay first."""
    profs = F.coalesce(F.col("profils_recrutes"), F.lit(""))
    pay = F.coalesce(F.col("salaire_moyen_propose"), F.lit(0.0))
    levels = F.when(pay > F.lit(L.COMPETITION_LEVELS[0][0]), F.lit(L.COMPETITION_LEVELS[0][1])) \
        .when(pay > F.lit(L.COMPETITION_LEVELS[1][0]), F.lit(L.COMPETITION_LEVELS[1][1])) \
        .otherwise(F.lit(L.COMPETITION_DEFAULT_SCRIPT))
    return (
        recruiters.filter((F.col("ville") == F.lit(city)) & contains_any(profs, list(profiles)))
        .select(
            "entreprise",
            F.col("nb_offres_publiees").alias("nb_offres"),
            pay.alias("salaire_moyen"),
            truncate_text(profs, width).alias("profils"),
            levels.alias("niveau_competition"),
        )
        .orderBy(F.desc("salaire_moyen"), "entreprise")
    )


# ------------------------------------------------------------------ Q2 (script form)
def city_pivot(city_month: DataFrame, profiles=L.CITY_COMPARISON_PROFILES, cities=L.PIVOT_CITIES,
               city: str = "Tanger", reference_city: str = "Casablanca") -> DataFrame:
    """Q2b, script form: one row per profile of a fixed list, listings per
    city as columns (0 when none), remote listings of ``city`` and the
    ratio ``city`` / ``reference_city`` in % (0 when the reference is 0)."""
    rows = city_month.filter(F.col("profil").isin(list(profiles)) & F.col("ville").isin(list(cities)))
    agg = rows.groupBy("profil").pivot("ville", list(cities)).agg(F.sum("nb_offres"))
    remote = rows.filter(F.col("ville") == F.lit(city)).groupBy("profil") \
        .agg(F.sum("nb_offres_remote").alias("_remote"))
    grid = city_month.sparkSession.range(1).select(F.explode(F.array(*[F.lit(p) for p in profiles])).alias("profil"))
    counts = {c: F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint") for c in cities}
    ratio = F.when(counts[reference_city] > 0,
                   round_half_up(counts[city].cast("double") * F.lit(100.0) / counts[reference_city].cast("double"), 1)) \
        .otherwise(F.lit(0.0))
    return (
        grid.join(agg, "profil", "left").join(remote, "profil", "left")
        .select(
            "profil", *[counts[c].alias(c) for c in cities],
            F.coalesce(F.col("_remote"), F.lit(0)).cast("bigint").alias(f"remote_{city}"),
            ratio.alias(f"pct_{city}_vs_{reference_city}"),
        )
    )


# ------------------------------------------------------------------ V1-V4
def city_bubbles(city_month: DataFrame, coordinates=L.CITY_COORDINATES, scale=L.BUBBLE_SCALE) -> DataFrame:
    """V1: listings per city with coordinates and bubble size
    ``n / max(n) * 2000 + 100`` (max over ALL cities, scalar subquery)."""
    per_city = city_month.groupBy("ville").agg(F.sum("nb_offres").alias("nb_offres"))
    biggest = per_city.select(F.max("nb_offres")).scalar()
    lon = F.create_map(*[x for c, (lo, la) in coordinates.items() for x in (F.lit(c), F.lit(lo))])
    lat = F.create_map(*[x for c, (lo, la) in coordinates.items() for x in (F.lit(c), F.lit(la))])
    k, base = scale
    return (
        per_city.filter(F.col("ville").isin(list(coordinates)) & (F.col("nb_offres") > 0))
        .select(
            "ville", "nb_offres",
            F.try_element_at(lon, F.col("ville")).alias("longitude"),
            F.try_element_at(lat, F.col("ville")).alias("latitude"),
            round_half_up(F.col("nb_offres").cast("double") / biggest.cast("double") * F.lit(k) + F.lit(base), 2)
            .alias("taille"),
        )
        .orderBy(F.desc("nb_offres"), "ville")
    )


def top_skills_chart(top_skills: DataFrame, n: int = 15, label: str = L.TOTAL_PROFILE_LABEL) -> DataFrame:
    """V2: the ``n`` most mentioned skills overall with their family."""
    return (
        top_skills.filter(F.col("profil") == F.lit(label))
        .orderBy(F.desc("nb_offres_mentionnent"), "competence").limit(n)
        .select("competence", "nb_offres_mentionnent", "famille")
    )


def skill_chart_labels(top_skills: DataFrame) -> DataFrame:
    """Skills per profile under the charts' short profile and family labels."""
    return top_skills.select(
        "profil", "famille", "competence", "nb_offres_mentionnent",
        chart_label(F.col("profil")).alias("libelle_profil"), family_label(F.col("famille")).alias("libelle_famille"))


def pay_by_experience_code(silver: DataFrame, profiles=L.DATA_PROFILES, bands=L.EXPERIENCE_BANDS) -> DataFrame:
    """Q4 bands with the ordinal code of each band, 1 to 5."""
    return pay_by_experience_band(silver, profiles, bands).withColumn(
        "code_experience", experience_band_index(F.col("tranche_experience"), bands))


def pay_box_stats(silver: DataFrame, profiles=L.BOX_PROFILES, pay_range=L.BOX_PAY_RANGE,
                  min_values: int = L.BOX_MIN_VALUES, reference_profile: str = "Data Engineer") -> DataFrame:
    """V3: box statistics of listing pay per profile: quartiles, 1.5 IQR
    whiskers (most extreme values inside the fences), outlier count; only
    profiles with ``min_values`` values in ``pay_range``. Also the median of
    the reference profile over all its known pay values.

    Silver is reduced once to (profile, pay value, count) with map-side
    partial aggregation: the rows of a hot profile collapse to its distinct
    pay values before the shuffle. Quartiles (``percentile`` with a
    frequency), fences and whiskers are all computed from that one reduced
    table, so its shuffle is reused by every branch."""
    lo, hi = pay_range
    known = _weighted(silver).filter(F.col("salaire_connu") & F.col("salaire_median_mad").isNotNull()
                                     & (F.col("salaire_median_mad") != 0))
    counted = known.groupBy(F.col("profil_normalise").alias("profil"), F.col("salaire_median_mad").alias("v")) \
        .agg(F.sum("n").alias("n"))
    vals = counted.filter(F.col("profil").isin(list(profiles)) & F.col("v").between(lo, hi))
    stats = vals.groupBy("profil").agg(
        F.sum("n").alias("nb_valeurs"),
        F.percentile("v", 0.25, F.col("n")).alias("q1"),
        F.percentile("v", 0.5, F.col("n")).alias("mediane"),
        F.percentile("v", 0.75, F.col("n")).alias("q3"),
    ).filter(F.col("nb_valeurs") >= min_values)
    fenced = stats.select(
        "*",
        (F.col("q1") - F.lit(1.5) * (F.col("q3") - F.col("q1"))).alias("_lo"),
        (F.col("q3") + F.lit(1.5) * (F.col("q3") - F.col("q1"))).alias("_hi"),
    )
    # one row per profile of the fixed ``profiles`` list: a proven-small side
    whiskers = vals.join(F.broadcast(fenced.select("profil", "_lo", "_hi")), "profil").groupBy("profil").agg(
        F.min(F.when(F.col("v") >= F.col("_lo"), F.col("v"))).alias("moustache_basse"),
        F.max(F.when(F.col("v") <= F.col("_hi"), F.col("v"))).alias("moustache_haute"),
        F.sum(F.when((F.col("v") < F.col("_lo")) | (F.col("v") > F.col("_hi")), F.col("n")).otherwise(F.lit(0)))
        .alias("nb_valeurs_extremes"),
    )
    ref_median = counted.filter(F.col("profil") == F.lit(reference_profile)) \
        .select(F.percentile("v", 0.5, F.col("n"))).scalar()
    return (
        fenced.join(whiskers, "profil")
        .select(
            "profil", "nb_valeurs",
            round_half_up(F.col("q1"), 2).alias("q1"),
            round_half_up(F.col("mediane"), 2).alias("mediane"),
            round_half_up(F.col("q3"), 2).alias("q3"),
            round_half_up(F.col("moustache_basse"), 2).alias("moustache_basse"),
            round_half_up(F.col("moustache_haute"), 2).alias("moustache_haute"),
            "nb_valeurs_extremes",
            round_half_up(ref_median, 2).alias("mediane_reference"),
        )
        .orderBy("profil")
    )


def monthly_profile_pivot(trends: DataFrame, profiles=L.DATA_PROFILES, month_from: str | None = "2023",
                          month_to: str | None = "2024-11") -> DataFrame:
    """V4: month key ``YYYY-MM`` x data profile listing counts, zero-filled,
    months kept where ``month_from <= key <= month_to`` (text order)."""
    rows = trends.filter(F.col("profil").isin(list(profiles)) & F.col("annee").isNotNull() & F.col("mois").isNotNull()
                         & (F.col("annee") != "") & (F.col("mois") != "")) \
        .select(F.concat_ws("-", "annee", "mois").alias("mois_cle"), "profil", "nb_offres")
    if month_from is not None:
        rows = rows.filter(F.col("mois_cle") >= F.lit(month_from))
    if month_to is not None:
        rows = rows.filter(F.col("mois_cle") <= F.lit(month_to))
    pivot = rows.groupBy("mois_cle").pivot("profil", list(profiles)).agg(F.sum("nb_offres"))
    return pivot.select(
        "mois_cle", *[F.coalesce(F.col(f"`{p}`"), F.lit(0)).cast("bigint").alias(p) for p in profiles]
    ).orderBy("mois_cle")

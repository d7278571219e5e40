"""Silver: raw listings -> cleaned listings (one narrow stage, no shuffle).

All normalisers are column expressions in a chain of projections over the scan;
nothing is shuffled and nothing leaves the JVM. The steps with a lambda
(``transform``) are evaluated outside whole-stage codegen (docs/PLANS.md).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentlake import lexicons as L
from talentlake.functions import normalize as N
from talentlake.functions.stats import pct_of
from talentlake.functions.text import py_strip
from talentlake.schema import RAW_COLUMNS


def to_silver(raw: DataFrame, keep_language_list: bool = True) -> DataFrame:
    """Add the 15 derived columns (profile, pay, experience, city, region,
    contract, dates) to raw listings. ``langue_requise`` stays an array and a
    joined text copy ``langue_requise_txt`` is added.

    Built as successive projections: a prepared text used by several regex
    tests is one column of an earlier projection, so it is computed once per
    row (Catalyst does not inline a non-trivial expression into several
    consumers); all projections still fuse into one codegen stage."""
    raw_cols = [F.col(c) for c in RAW_COLUMNS]
    s1 = raw.select(
        *raw_cols,
        N.title_key(F.col("titre_poste")).alias("_t"),
        N.pay_key(F.col("salaire_brut")).alias("_p1"),
        N.pay_is_sentinel(F.col("salaire_brut")).alias("_psent"),
        N.experience_key(F.col("experience_requise")).alias("_e"),
        py_strip(F.col("ville")).alias("_cs"),
        N.parse_day(F.col("date_publication")).alias("_dp"),
        N.parse_day(F.col("date_expiration")).alias("_de"),
    )
    s2 = s1.select(
        "*",
        N.pay_is_eur(F.col("_p1")).alias("_eur"),
        N.pay_strip_units(F.col("_p1")).alias("_p2"),
        F.lower(F.col("_cs")).alias("_c"),
    )
    s3 = s2.select("*", N.pay_expand_k(F.col("_p2")).alias("_p3"))
    s4 = s3.select("*", N.pay_numbers(F.col("_p3"), F.col("_eur")).alias("_nums"))
    s5 = s4.select(
        "*",
        N.pay_known(F.col("_nums"), F.col("_psent")).alias("_known"),
        N.city_match(F.col("_c")).alias("_cm"),
        N.experience_bounds(F.col("_e")).alias("_exp"),
    )
    s6 = s5.select(
        "*",
        F.when(F.col("_known"), F.col("_nums.lo")).alias("_lo"),
        F.when(F.col("_known"), F.col("_nums.hi")).alias("_hi"),
        N.city_region(F.col("ville"), F.col("_cs"), F.col("_cm")).alias("_city"),
    )
    dp, de = F.col("_dp"), F.col("_de")
    out = s6.select(
        *raw_cols,
        N.profile_of(F.col("_t")).alias("profil_normalise"),
        F.col("_lo").alias("salaire_min_mad"),
        F.col("_hi").alias("salaire_max_mad"),
        F.col("_known").alias("salaire_connu"),
        ((F.col("_lo") + F.col("_hi")) / F.lit(2.0)).alias("salaire_median_mad"),
        F.col("_exp.experience_min_ans").alias("experience_min_ans"),
        F.col("_exp.experience_max_ans").alias("experience_max_ans"),
        F.col("_city.ville_std").alias("ville_std"),
        F.col("_city.region_admin").alias("region_admin"),
        N.contract_type(F.col("type_contrat")).alias("type_contrat_std"),
        *date_columns(dp, de),
    )
    if keep_language_list:
        out = out.withColumn("langue_requise_txt", N.join_list(F.col("langue_requise")))
    return out


def date_columns(published: Column, expires: Column) -> list[Column]:
    """Standard text dates, year, month and coherence of two parsed dates."""
    return [
        F.date_format(published, "yyyy-MM-dd").alias("date_publication_std"),
        F.date_format(expires, "yyyy-MM-dd").alias("date_expiration_std"),
        F.year(published).cast("string").alias("annee"),
        F.lpad(F.month(published).cast("string"), 2, "0").alias("mois"),
        F.coalesce(~(expires <= published), F.lit(True)).alias("date_coherente"),
    ]


def quality_report(silver: DataFrame) -> DataFrame:
    """One-row quality report in a single aggregation pass.

    ``nb_villes_reconnues`` counts every listing whose city is not the
    unknown label (unrecognised names kept as text count as recognised);
    ``nb_villes_canoniques`` counts only the canonical city list.
    """
    n = F.count(F.lit(1))
    canon = list(L.REGIONS)
    return silver.agg(
        n.alias("nb_offres"),
        F.count_if(F.col("profil_normalise") == L.TITLE_DEFAULT).alias("nb_autre_it"),
        F.count_if(F.col("salaire_connu")).alias("nb_salaire_connu"),
        F.count("experience_min_ans").alias("nb_experience_parsee"),
        F.count_if(F.col("ville_std") != L.CITY_UNKNOWN).alias("nb_villes_reconnues"),
        F.count_if(F.col("ville_std").isin(canon)).alias("nb_villes_canoniques"),
        F.count_if(~F.col("date_coherente")).alias("nb_dates_incoherentes"),
        F.countDistinct("profil_normalise").alias("nb_profils"),
    ).select(
        "*",
        *[
            pct_of(F.col(c), F.col("nb_offres")).alias("pct_" + c[3:])
            for c in ["nb_autre_it", "nb_salaire_connu", "nb_experience_parsee", "nb_villes_reconnues", "nb_dates_incoherentes"]
        ],
    )


def profile_distribution(silver: DataFrame, top: int = 8) -> DataFrame:
    """Most frequent profiles (``value_counts().head(top)``), ties by name."""
    return (
        silver.groupBy("profil_normalise").agg(F.count(F.lit(1)).alias("nb_offres"))
        .orderBy(F.desc("nb_offres"), F.asc("profil_normalise"))
        .limit(top)
    )

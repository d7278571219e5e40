"""Golden cases per normaliser, derived by reading the behaviour being
reproduced (FIXTURES §3; one case corrected, see test_title_profile)."""

import pytest
from pyspark.sql import functions as F

from talentlake.functions import normalize as N

TITLE_CASES = [
    ("Data Eng.", "Data Engineer"), ("ETL Developer", "Data Engineer"),
    # 'ingénieur\s*bi' (Data Analyst rule) matches the start of "ingénieur big"
    ("Ingénieur Big Data", "Data Analyst"),
    ("Développeur BI", "Data Analyst"), ("BI Analyst", "Data Analyst"),
    ("ML Engineer", "Data Scientist"), ("NLP Engineer", "Data Scientist"),
    ("Full-Stack Developer", "Développeur Full Stack"), ("Back-End Developer", "Développeur Backend"),
    ("Développeur Front-End", "Développeur Frontend"), ("iOS Developer", "Développeur Mobile"),
    ("DevOps / Cloud Engineer", "Cloud Engineer"),  # last matching rule wins
    ("SRE", "DevOps / SRE"), ("AWS Engineer", "Cloud Engineer"), ("Cloud Architect", "Cloud Engineer"),
    ("Architecte Cloud", "Architecte IT"), ("Pentester", "Cybersécurité"), ("Scrum Master", "Chef de Projet IT"),
    ("Admin Système", "Admin Systèmes & Réseaux"), ("Security Engineer", "Autre IT"), (None, "Autre IT"),
    ("Développeur Data", "Autre IT"), ("Analyste BI", "Autre IT"),
]


def _dates(pub, exp):
    """The date columns of silver, from two texts."""
    from talentlake.operators.silver import date_columns

    return F.struct(*date_columns(N.parse_day(pub), N.parse_day(exp)))


def one(spark, value, expr, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


def test_title_profile(spark):
    df = spark.createDataFrame(TITLE_CASES, "t string, want string")
    got = df.select("want", N.title_profile(F.col("t")).alias("got")).collect()
    assert [(r.want, r.got) for r in got] == [(w, w) for _, w in TITLE_CASES]


PAY_CASES = [
    ("3000-4000 MAD", 3000.0, 4000.0, True), ("4000 - 6000 DH", 4000.0, 6000.0, True),
    ("15K-20K", 15000.0, 20000.0, True), ("3.5K", 3500.0, 3500.0, True),
    ("1500-2000 EUR", 1500 * 10.8, 2000 * 10.8, True), ("270-570 EUR", None, None, False),
    ("15-20K", None, None, False), ("15K 20K", None, None, False), ("5,000 MAD", None, None, False),
    ("5000-3500", 3500.0, 5000.0, True), ("150000 MAD", None, None, False),
    ("Confidentiel", None, None, False), ("Selon profil", None, None, False), (None, None, None, False),
    ("99999999999999999999k", None, None, False), ("1" + "0" * 400 + "k-4000", None, None, False), ("9" * 400, None, None, False),
    ("99999999999999999999 EUR", None, None, False), ("15.5k-20k", 15500.0, 20000.0, True), ("10 000 – 12 000 MAD", 10000.0, 12000.0, True),
]


@pytest.mark.parametrize("text,lo,hi,known", PAY_CASES)
def test_pay(spark, text, lo, hi, known):
    r = one(spark, text, N.pay_struct)
    assert (r.salaire_min_mad, r.salaire_max_mad, r.salaire_connu) == (lo, hi, known)


EXP_CASES = [
    ("Débutant accepté", 0, 2), ("0-1 an", 0, 2), ("10-12 ans", 0, 2), ("1-3 ans", 1, 3), ("3 à 5 ans", 3, 5),
    ("5/8 ans", 5, 8), ("min 3 ans", 3, None), ("3 years", 3, None), ("Senior (5+ ans)", 5, None),
    ("Senior confirmé", 8, None), ("8+ ans", 8, None), ("à discuter", None, None), (None, None, None),
    ("3\u00a0à\u00a05 ans", 3, 5), ("min 4\u202fans", 4, None), ("99999999999999999999 ans", None, None), ("Lead developer", 5, None), ("Senior (7+ ans)", 5, None),
]


@pytest.mark.parametrize("text,lo,hi", EXP_CASES)
def test_experience(spark, text, lo, hi):
    r = one(spark, text, N.experience_struct)
    assert (r.experience_min_ans, r.experience_max_ans) == (lo, hi)


CITY_CASES = [
    ("casa", "Casablanca", "Casablanca-Settat"), ("Grand Casablanca", "Casablanca", "Casablanca-Settat"),
    ("RABAT", "Rabat", "Rabat-Salé-Kénitra"), ("Tanger-Med", "Tanger", "Tanger-Tétouan-Al Hoceïma"),
    ("Marrakesh", "Marrakech", "Marrakech-Safi"), ("FES", "Fès", "Fès-Meknès"),
    ("Kénitra", "Kenitra", "Rabat-Salé-Kénitra"), ("sidi-slimane", "Sidi-Slimane", "Inconnue"),
    ("", "Inconnue", "Inconnue"), (None, "Inconnue", "Inconnue"),
    ("Rabat-Salé-Kénitra", "Rabat", "Rabat-Salé-Kénitra"),   # Rabat rule precedes Kenitra
    ("ain el aouda", "Ain El Aouda", "Inconnue"), ("  l'aïn  ", "L'Aïn", "Inconnue"),
]


@pytest.mark.parametrize("text,city,region", CITY_CASES)
def test_city(spark, text, city, region):
    r = one(spark, text, N.city_struct)
    assert (r.ville_std, r.region_admin) == (city, region)


CONTRACT_CASES = [
    ("cdi", "CDI"), ("Permanent", "CDI"), ("Contrat à durée indéterminée", "CDI"),
    ("Contrat à durée déterminée", "CDD"), ("Temporary", "CDD"), ("Mission freelance", "Freelance"),
    ("Internship", "Stage"), ("Contrat d'apprentissage", "Alternance"), ("other", "Non précisé"),
    (None, "Non précisé"), ("", "Non précisé"),
]


@pytest.mark.parametrize("text,want", CONTRACT_CASES)
def test_contract(spark, text, want):
    assert one(spark, text, N.contract_type) == want


def test_dates(spark):
    rows = [("2024-01-05", "2024-01-05"), ("2024-01-05", "2024-02-01"), ("n/a", "2024-02-01"), (None, None),
            ("2024-1-5", "2024-01-04")]
    df = spark.createDataFrame(rows, "p string, e string").select(_dates(F.col("p"), F.col("e")).alias("d"))
    got = [tuple(r.d) for r in df.collect()]
    assert got == [
        ("2024-01-05", "2024-01-05", "2024", "01", False),
        ("2024-01-05", "2024-02-01", "2024", "01", True),
        (None, "2024-02-01", None, None, True),
        (None, None, None, None, True),
        ("2024-01-05", "2024-01-04", "2024", "01", False),
    ]


def test_experience_band_and_competition(spark):
    df = spark.createDataFrame([(0,), (2,), (4,), (7,), (12,), (None,)], "y int")
    got = [r.b for r in df.select(N.experience_band(F.col("y")).alias("b")).collect()]
    assert got == ["0 — Débutant", "1-2 ans", "3-4 ans", "5-7 ans", "8+ ans Senior", "Non précisé"]
    df = spark.createDataFrame([(25000.0,), (15000.0,), (9000.0,), (None,)], "p double")
    got = [r.c for r in df.select(N.competition_level(F.col("p")).alias("c")).collect()]
    assert got == ["Compétiteur fort", "Compétiteur moyen", "Compétiteur faible / non défini",
                   "Compétiteur faible / non défini"]


def test_remote_predicate(spark):
    df = spark.createDataFrame([("TÉLÉTRAVAIL complet",), ("Hybride",), ("Présentiel",), (None,)], "t string")
    assert [r.r for r in df.select(N.is_remote(F.col("t")).alias("r")).collect()] == [True, True, False, False]


@pytest.mark.parametrize("text,want", [
    ("2024-1-5", "2024-01-05"), ("2024-01-05T10:00:00", "2024-01-05"), ("24-01-05", None), ("12024-01-1", None), ("2024-13-01", None),
    ("2024-02-30", None), ("02024-1-1", None), ("", None), (None, None), ("2024/01/05", None)])
def test_dates_need_four_digit_years(spark, text, want):
    got = one(spark, text, N.parse_day)
    assert (got and got.isoformat()) == want


@pytest.mark.parametrize("text,want", [("2024-01-05", "2024_01"), ("2024-1", "2024_01"), ("24-01-05", "date_inconnue"), ("12024-01-1", "date_inconnue"),
                                       ("2024-13-01", "date_inconnue"), (None, "date_inconnue")])
def test_month_keys(spark, text, want):
    from talentlake.sources.bronze import month_key

    assert one(spark, text, month_key) == want


@pytest.mark.parametrize("text,want", [('["a", "b"]', ["a", "b"]), ("a, b", ["a, b"]), (None, None), ("[]", []), ("", [""])])
def test_languages_as_list_or_text(spark, text, want):
    assert one(spark, text, N.text_or_list) == want


@pytest.mark.parametrize("pattern,want", [
    (r"back[\s\-]*end\b|backend", ["back", "backend"]), (r"analyste?\s*data|bi\s*anal", ["analyst", "bi"]), (r"a?b|c", None), (r"(x|y)z", None),
    (r"data\s*sci(entist|ence)|ml\s*(eng|x)", ["data", "ml"]), (r"réseau+|x{2}y", None), (r"ios\s+dev", ["ios"])])
def test_leading_literals(pattern, want):
    from talentlake.functions.rules import leading_literals

    assert leading_literals(pattern) == want

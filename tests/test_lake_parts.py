"""Parts of the lake that keep or find things at scale: gold by month, ranks, sketches, the skill
index, the lake of envelope documents, views, the bundle document."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from talentlake.functions.ranks import percentiles
from talentlake.operators import gold as G
from talentlake.operators import gold_state as S
from talentlake.operators.silver import to_silver
from talentlake.operators.skill_index import extract_skills_indexed
from talentlake.operators.skills import dictionary_frame, dictionary_from_terms, extract_skills, load_dictionary
from talentlake.plans import pipeline
from talentlake.schema import RAW_COLUMNS, SKILL_COLUMNS
from talentlake.sources import bronze as B
from talentlake.sources import envelopes as E
from talentlake.sources.files import export_bundle_document, read_bundle_document
from talentlake.sources.listings import listings_from_tables

from conftest import SF_SMALL

rows = lambda df: sorted(map(tuple, df.collect()), key=repr)


def test_gold_by_month(spark, scratch):
    """A replayed month rewrites its own states only; gold is that of the whole run."""
    raw = listings_from_tables(spark, SF_SMALL)
    keyed = B.with_partition_keys(raw)
    month = keyed.where("month_key <> 'date_inconnue'").groupBy("month_key").count().orderBy(F.desc("count")).first()[0]
    first = keyed.where((F.col("month_key") != month) | (F.crc32("id_offre") % 2 == 0)).drop("source_key", "month_key")
    paths = pipeline.run(spark, first, os.path.join(scratch, "lake"), stages=("bronze", "silver"))
    pipeline.update_gold(spark, paths, [])
    mtimes = lambda name: {f: os.path.getmtime(f[len("file://"):]) for f in spark.read.parquet(paths.gold_state(name)).inputFiles()}
    before = {name: mtimes(name) for name in S.STATES}
    few = spark.read.parquet(paths.gold("tendances_mensuelles")).agg(F.sum("nb_offres")).first()[0]
    pipeline.run(spark, keyed.where(F.col("month_key") == month).drop("source_key", "month_key"), paths.root, months=[month])
    for name in S.STATES:
        other = lambda files: {f: t for f, t in files.items() if f"{pipeline.MONTH}={month}" not in f}
        assert other(before[name]) == other(mtimes(name)) and len(other(before[name])) > 20
    assert few < spark.read.parquet(paths.gold("tendances_mensuelles")).agg(F.sum("nb_offres")).first()[0] == raw.count()
    silver, skills = (pipeline.read_silver(spark, p) for p in (paths.silver_listings, paths.silver_skills))
    for name, whole in pipeline.build_gold(silver, skills).items():
        assert rows(spark.read.parquet(paths.gold(name))) == rows(whole), name


@pytest.mark.parametrize("ranges", [1, 7])
def test_percentiles_by_rank(spark, ranges):
    rng = np.random.default_rng(1)
    data = [("hot", float(x)) for x in rng.integers(0, 300, 2000)] + [("one", 5.5)] * 3 + [("two", 1.0), ("two", 2.0), (None, 7.0), (None, -1.5), (None, 3.25), ("none", None), ("same", 4.0)]
    data += [("wide", float(x)) for x in rng.normal(0, 1e6, 501)]
    df = spark.createDataFrame(data, "g string, x double")
    shares = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)
    out = {r["g"]: r for r in percentiles(df, ["g"], "x", shares, ranges).collect()}
    assert set(out) == {g for g, x in data if x is not None}
    for g, r in out.items():
        x = [v for k, v in data if k == g and v is not None]
        assert r["n"] == len(x) and [r[f"q{i}"] for i in range(len(shares))] == pytest.approx(np.quantile(x, shares).tolist())
    counted = df.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n_x"))
    again = {r["g"]: tuple(r)[2:] for r in percentiles(counted, ["g"], "x", shares, ranges, weight="n_x").collect()}
    assert again == {g: tuple(r)[2:] for g, r in out.items()}
    assert percentiles(df.limit(0), ["g"], "x", shares, ranges).count() == 0


def test_sketches_estimate_distinct_ids(spark):
    """Sketches of months merge; estimates stay within 5 % (three standard errors) of exact counts."""
    ids = spark.range(60_000).select(F.concat(F.lit("L"), F.col("id") % 40_000).alias("id_offre"), (F.col("id") % 7).cast("string").alias("m"),
                                     F.element_at(F.array(*map(F.lit, ("a", "b", "c"))), (F.col("id") % 3 + 1).cast("int")).alias("profil"), F.lit("f").alias("famille"),
                                     F.when(F.col("id") % 11 == 0, "non_détecté").when(F.col("id") % 5 == 0, "sql").otherwise("python").alias("competence"))
    name = lambda r: (r["profil"], r["competence"])
    about = {name(r): r for r in S.approximate_top_skills(S.skill_sketches(ids, "m")).collect()}
    exact = {name(r): r for r in G.top_skills(ids).collect()}
    assert about.keys() == exact.keys() and len(exact) == 8
    for k, r in exact.items():
        assert about[k]["nb_offres_mentionnent"] == pytest.approx(r["nb_offres_mentionnent"], rel=0.05)
        assert about[k]["pct_offres_total"] == pytest.approx(r["pct_offres_total"], rel=0.1)


def test_large_dictionary(spark):
    """100,000 aliases from a table find what the 142 find by themselves."""
    silver = to_silver(listings_from_tables(spark, SF_SMALL))
    few = dictionary_frame(spark, load_dictionary())
    many = spark.range(100_000).select(F.lit("autre").alias("famille"), F.concat(F.lit("absent"), F.col("id") % 5000).alias("competence"),
                                       F.concat(F.element_at(F.array(F.lit("zq"), F.lit("zq data "), F.lit("python zq")), (F.col("id") % 3 + 1).cast("int")), F.col("id")).alias("alias"))
    found = extract_skills_indexed(silver, few.unionByName(many)).select(*SKILL_COLUMNS)
    assert rows(found) == rows(extract_skills(silver).select(*SKILL_COLUMNS))


def test_skill_index_boundaries(spark):
    terms = {"l": {"c": ["c"], "cpp": ["c++", "c/c++"], "node": ["node.js", "Node"], "net": [".net"], "plus": ["++"], "ml": ["machine learning", "ml"], "e": ["é", "a_b"], "odd": ["x\\Ey", "(z)"], "end": ["fin."]}}
    texts = ["C++ et Java", "c++java", "c/c++,c", "node.js", "nodejs", "Node .js", ".NET core", "asp.net", "a++b", "a ++ b", "++", "x+++", "machine learning", "machine-learning", "machine  learning", "xml ml", "été é", "a_b a_bc", "x\\ey (z)", "fin.", "fin.x", "fin", "", None, "c" * 500]
    raw = [(f"i{k % 20}", t, None) for k, t in enumerate(texts)]
    silver = spark.createDataFrame(raw, "id_offre string, competences_brut string, description string")
    for c in ("profil_normalise", "ville_std", "date_publication", "annee", "mois", "type_contrat_std"):
        silver = silver.withColumn(c, F.lit("v"))
    silver = silver.withColumn("salaire_connu", F.lit(True))
    dictionary = dictionary_from_terms(terms)
    want = rows(extract_skills(silver, dictionary).select(*SKILL_COLUMNS))
    assert rows(extract_skills_indexed(silver, dictionary_frame(spark, dictionary)).select(*SKILL_COLUMNS)) == want and len(want) > len(texts)
    none = spark.createDataFrame([], "famille string, competence string, alias string")
    assert {r["competence"] for r in extract_skills_indexed(silver, none).collect()} == {"non_détecté"}


def test_envelope_lake(spark, scratch):
    """{source}/{YYYY_MM}/offres_raw.json: one JSON document each, read back with its keys and order."""
    raw = listings_from_tables(spark, SF_SMALL).where("date_publication < '2023'")
    root = os.path.join(scratch, "lake")
    E.write_envelope_lake(raw, root, "in.json")
    files = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if not f.startswith(".")]
    assert len(files) > 10 and {os.path.basename(f) for f in files} == {"offres_raw.json"}
    n = 0
    for f in files:
        with open(f, encoding="utf-8") as h:
            doc = json.load(h)
        n += len(doc["offres"])
        assert doc["metadata"]["nb_offres"] == len(doc["offres"]) and doc["metadata"]["partition"] == "/".join(f.split("/")[-3:-1]) and doc["metadata"]["source_fichier"] == "in.json"
    assert n == raw.count()
    back = E.read_envelope_lake(spark, root)
    columns = [c for c in RAW_COLUMNS if c != "langue_requise"]
    assert rows(back.select(*columns, "source_key", "month_key")) == rows(B.with_partition_keys(raw).select(*columns, "source_key", "month_key"))
    ordered = [r["id_offre"] for r in back.orderBy("fichier", "position").collect()]
    walked = [o.get("id_offre") for f in sorted(files) for o in json.load(open(f, encoding="utf-8"))["offres"]]
    assert ordered == walked
    assert E.envelope_metadata(spark, root).agg(F.sum("nb_offres")).first()[0] == n
    # a replay replaces its partition; what is not whole is rejected or stops the job
    one = B.with_partition_keys(raw).orderBy("id_offre").first()
    E.write_envelope_lake(raw.where(F.col("id_offre") == one["id_offre"]).limit(1), root)
    left = E.read_envelope_lake(spark, root).groupBy("source_key", "month_key").count()
    assert left.where((F.col("source_key") == one["source_key"]) & (F.col("month_key") == one["month_key"])).first()["count"] == 1 and left.count() == len(files)
    os.makedirs(os.path.join(root, "autre", "2024_01"))
    with open(os.path.join(root, "autre", "2024_01", "offres_raw.json"), "w", encoding="utf-8") as h:
        h.write('{"offres": [{"id_offre": "x"}]}{}')
    assert E.read_envelope_lake(spark, root, "reject").select("fichier").distinct().count() == len(files)
    (bad,) = B.rejects(E.parse_envelope_lake(spark, root)).collect()
    assert bad["texte"].endswith("{}") and bad["fichier"].endswith("/autre/2024_01/offres_raw.json")
    with pytest.raises(Exception, match="not a JSON listing"):
        E.read_envelope_lake(spark, root).select("month_key").collect()


def test_views_and_catalog(spark, scratch):
    raw = listings_from_tables(spark, SF_SMALL)
    paths = pipeline.run(spark, raw, os.path.join(scratch, "lake"))
    names = pipeline.register_views(spark, paths, prefix="v_")
    assert set(names) == {"v_offres_clean", "v_competences_extraites", *(f"v_{n}" for n in pipeline.GOLD_TABLES)}
    n = raw.count()
    assert spark.sql("SELECT count(*) FROM v_offres_clean").first()[0] == n == spark.sql("SELECT sum(nb_offres) FROM v_tendances_mensuelles").first()[0]
    made = pipeline.save_catalog(spark, paths, "talentlake_test")
    try:
        assert len(made) == 7 and spark.table("talentlake_test.offres_clean").count() == n
        assert spark.sql("SELECT sum(nb_offres) FROM talentlake_test.offres_par_ville").first()[0] == n
        assert spark.sql(f"SELECT count(*) FROM parquet.`{paths.silver_listings}`").first()[0] == n
    finally:
        spark.sql("DROP DATABASE talentlake_test CASCADE")


def test_bundle_document(spark, scratch):
    """One JSON document: each result's records in its order, NULLs kept."""
    big = spark.range(50).select((49 - F.col("id")).alias("rang"), F.when(F.col("id") % 2 == 0, F.col("id") / 3).alias("valeur"), F.lit('é "x"').alias("texte")).orderBy("rang")
    results = {"a": big, "vide": big.limit(0), "b": big.where("rang < 3").orderBy(F.desc("rang"))}
    path = os.path.join(scratch, "bundle")
    export_bundle_document(spark, results, path)
    (name,) = [f for f in os.listdir(path) if f.startswith("part-")]
    with open(os.path.join(path, name), encoding="utf-8") as f:
        doc = json.load(f)
    for key, df in results.items():
        assert doc[key] == [r.asDict() for r in df.collect()]
        assert list(map(tuple, read_bundle_document(spark, path, key, df).collect())) == list(map(tuple, df.collect()))


def test_envelope_lake_has_one_file_a_partition(spark, scratch):
    """However the shuffles are dealt, a partition's head, lines and end are one file in order."""
    raw = listings_from_tables(spark, SF_SMALL)
    # few counts are dealt to one task, listings to several
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    kept = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        E.write_envelope_lake(raw, scratch)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    back = E.read_envelope_lake(spark, scratch)
    assert rows(back.select("id_offre", "source_key", "month_key")) == rows(B.with_partition_keys(raw).select("id_offre", "source_key", "month_key"))
    assert E.envelope_metadata(spark, scratch).agg(F.sum("nb_offres")).first()[0] == raw.count()


def test_opened_envelope_rows_carry_no_document(spark):
    """A document's text, or what is read of it, is not copied into each of its listings' rows."""
    docs = spark.range(2).select(F.concat(F.lit('{"offres": [{"id_offre": "x'), F.col("id"), F.lit('"}, {"id_offre": "y"}]}')).alias("value"), F.col("id"))
    parsed = B.accepted(B.opened_envelopes(docs), "reject").select("id", "id_offre")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString().split("\n")
    (at,) = [i for i, line in enumerate(plan) if "Generate posexplode(_texts" in line]
    below = plan[at + 1].split("Project [")[1]   # the columns that a listing's row can carry
    assert below.startswith("id#") and "AS _broken#" in below and "AS _texts#" in below and "value#" not in below.split(" AS ")[-1]
    assert rows(parsed) == [(0, "x0"), (0, "y"), (1, "x1"), (1, "y")]


def test_top_skills_hold_one_sort(spark):
    """Distinct ids of each level, where ids, profiles and whole rows repeat and keys are null; between the
    shuffle of the pairs and their count there is a sort, and no table of all pairs."""
    data = [(f"L-{i % 7}" if i % 5 else None, f"P{i % 3}" if i % 11 else None, "f", f"s{i % 4}") for i in range(120)] + [("L-x", "P0", "inconnu", "non_détecté")]
    skills = spark.createDataFrame(data, "id_offre string, profil string, famille string, competence string")
    known = [r for r in data if r[3] != "non_détecté"]
    want = {}
    for profil, comp, ids in [(p, c, i) for i, p, _, c in known] + [("tous", c, i) for i, _, _, c in known]:
        want.setdefault((profil, comp), set()).add(ids)
    for profiles, total in ((True, True), (True, False), (False, True)):
        got = {(r.profil, r.competence): r.nb_offres_mentionnent for r in G.top_skills(skills, None, with_total_level=total, with_profiles=profiles).collect()}
        assert got == {k: len(v) for k, v in want.items() if (total if k[0] == "tous" else profiles)}
        plan = G.top_skills(skills, None, with_total_level=total, with_profiles=profiles)._jdf.queryExecution().optimizedPlan().toString()
        assert not [x for x in plan.splitlines() if "Aggregate [id_offre" in x and "famille" in x.split("]")[0]]

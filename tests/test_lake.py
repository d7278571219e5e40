"""Invariants, bronze round trip / idempotence, pipeline and streaming on
the sf0.001 tables."""

import os

from pyspark.sql import functions as F

from talentlake.operators import gold as G
from talentlake.operators.silver import to_silver
from talentlake.operators.skills import extract_skills
from talentlake.plans import pipeline
from talentlake.schema import RAW_COLUMNS
from talentlake.sources import bronze as B
from talentlake.sources.listings import listings_from_tables

from conftest import SF_SMALL


def test_silver_invariants(spark):
    raw = listings_from_tables(spark, SF_SMALL)
    silver = to_silver(raw).cache()
    n = raw.count()
    assert silver.count() == n
    assert 0 < silver.select("id_offre").distinct().count() < n   # some listings share an id
    bad = silver.filter(
        (F.col("salaire_connu") != F.col("salaire_min_mad").isNotNull())
        | (F.col("salaire_min_mad") > F.col("salaire_median_mad"))
        | (F.col("salaire_median_mad") > F.col("salaire_max_mad"))
        | (F.col("salaire_min_mad") < 3000) | (F.col("salaire_max_mad") > 100000)
    ).count()
    assert bad == 0
    skills = extract_skills(silver).cache()
    once = skills.filter(F.col("id_offre").startswith("L-"))
    per = once.groupBy("id_offre").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("competence") == "non_détecté").alias("s"))
    assert per.filter((F.col("s") > 0) & (F.col("n") > 1)).count() == 0
    assert once.groupBy("id_offre", "competence").count().filter("count > 1").count() == 0
    assert skills.select("competence").distinct().count() > 45
    g3 = G.listings_by_city_month(silver)
    assert g3.agg(F.sum("nb_offres")).first()[0] == n
    g5 = G.monthly_trends(silver)
    assert g5.agg(F.sum("nb_offres")).first()[0] == n
    g1 = G.top_skills(skills, silver)
    assert g1.groupBy("profil").agg(F.min("rang_dans_profil").alias("m")).filter("m != 1").count() == 0
    assert g1.filter(F.col("profil") == "tous").count() > 0


def test_bronze_roundtrip_and_idempotence(spark, scratch):
    raw = listings_from_tables(spark, SF_SMALL)
    path = os.path.join(scratch, "bronze")
    B.write_bronze(raw, path, "orders.parquet")
    once = B.read_bronze(spark, path)
    n = raw.count()
    assert once.count() == n
    cols = [c for c in RAW_COLUMNS if c != "langue_requise"]
    assert once.select(*cols).exceptAll(raw.select(*cols)).count() == 0
    B.write_bronze(raw, path, "orders.parquet")            # same input twice = once
    assert B.read_bronze(spark, path).count() == n
    # replaying one month rewrites that month only
    keyed = B.with_partition_keys(raw)
    month = keyed.select("month_key").first()[0]
    one_month = keyed.filter(F.col("month_key") == month).drop("source_key", "month_key")
    B.write_bronze(one_month.limit(1), path, "replay.json")
    after = B.read_bronze(spark, path)
    assert after.filter(F.col("month_key") != month).count() == keyed.filter(F.col("month_key") != month).count()
    assert after.filter(F.col("month_key") == month).count() <= keyed.filter(F.col("month_key") == month).count()


def test_ingestion_report_totals(spark):
    keyed = B.with_partition_keys(listings_from_tables(spark, SF_SMALL))
    rep = {(r.niveau, r.source_key, r.month_key): r.nb_offres for r in B.ingestion_report(keyed).collect()}
    total = rep[("total", None, None)]
    assert total == keyed.count()
    assert sum(v for (lvl, _, _), v in rep.items() if lvl == "source") == total
    assert sum(v for (lvl, _, _), v in rep.items() if lvl == "mois") == total
    assert sum(v for (lvl, _, _), v in rep.items() if lvl == "partition") == total


def test_envelope_source(spark, scratch):
    import json

    rows = listings_from_tables(spark, SF_SMALL).limit(5).collect()
    doc = {"metadata": {"partition": "x"}, "offres": [{k: v for k, v in r.asDict().items() if v is not None} for r in rows]}
    path = os.path.join(scratch, "env.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False, indent=2)
    with open(os.path.join(scratch, "empty.json"), "w", encoding="utf-8") as f:
        json.dump({"metadata": {}}, f)
    got = B.read_envelope(spark, scratch + "/*.json")
    assert sorted(r.id_offre for r in got.collect()) == sorted(r.id_offre for r in rows)


def test_pipeline_end_to_end(spark, scratch):
    raw = listings_from_tables(spark, SF_SMALL)
    paths = pipeline.run(spark, raw, os.path.join(scratch, "lake"))
    silver = spark.read.parquet(paths.silver_listings)
    assert silver.count() == raw.count()
    for name in pipeline.GOLD_TABLES:
        assert spark.read.parquet(paths.gold(name)).count() > 0
    g1 = spark.read.parquet(paths.gold("top_competences"))
    direct = G.top_skills(extract_skills(to_silver(raw)), to_silver(raw))
    assert g1.exceptAll(direct).count() == 0 and direct.exceptAll(g1).count() == 0


def test_dirty_json_lines(spark, scratch):
    """Broken lines are counted, never lost; other types and fields are kept."""
    import json

    import pytest

    good = [{"id_offre": "a", "nb_postes": "3", "langue_requise": "anglais", "extra": {"x": 1}}, {"id_offre": "b", "nb_postes": "trois", "langue_requise": ["fr", "en"]}, {"id_offre": "c", "langue_requise": None}, {}]
    bad = ['{"id_offre": "d"', "[1, 2]", "texte", "12", '{"id_offre": "e"}{"id_offre": "f"}', '{"id_offre": "g"} fin', '{"id_offre": "h"}]', '{"id_offre": "i"},{"id_offre": "j"}', '{"id_offre": "k"},{"_seal": "x"}] fin', "{'id_offre': 'l'}", "null"]
    path = os.path.join(scratch, "lines.json")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([*map(json.dumps, good), "", *bad]) + "\n")
    rows = B.read_raw_json_lines(spark, path, on_error="reject").collect()
    assert [(r.id_offre, r.nb_postes, r.langue_requise) for r in rows] == [("a", 3, ["anglais"]), ("b", None, ["fr", "en"]), ("c", None, None), (None, None, None)]
    assert json.loads(rows[0].listing_json) == good[0] and json.loads(rows[1].listing_json)["nb_postes"] == "trois"
    assert sorted(r.texte for r in B.rejects(B.parse_json_lines(spark, path)).collect()) == sorted(bad)
    for read in (lambda df: df.collect(), lambda df: df.select("id_offre").collect(), lambda df: df.count(), lambda df: df.select(F.lit(1)).collect(), lambda df: df.where("id_offre = 'a'").select("ville").collect()):
        with pytest.raises(Exception, match="not a JSON listing"):
            read(B.read_raw_json_lines(spark, path))


def test_dirty_envelopes(spark, scratch):
    import json

    import pytest

    docs = {"ok": json.dumps({"metadata": {}, "offres": [{"id_offre": "a", "champ": 1}, {"id_offre": "b"}]}), "none": "{}", "broken": '{"offres": [{"id_offre": "c"}', "text": "pas du json", "twice": '{"offres": []}{"offres": [{"id_offre": "d"}]}', "trailing": '{"offres": [{"id_offre": "e"}]} fin', "object": '{"offres": {"id_offre": "f"}}', "null": '{"offres": null}', "odd": '{"offres": [12]}'}
    for name, text in docs.items():
        with open(os.path.join(scratch, name + ".json"), "w", encoding="utf-8") as f:
            f.write(text)
    got = B.read_envelope(spark, scratch + "/*.json", on_error="reject").collect()
    assert sorted(r.id_offre for r in got) == ["a", "b"] and json.loads(min(r.listing_json for r in got))["id_offre"] == "a"
    found = B.rejects(B.parse_envelopes(spark, scratch + "/*.json")).collect()
    assert sorted(r.texte for r in found) == sorted([*(docs[k] for k in ("broken", "text", "twice", "trailing", "object")), "12"]) and all(r.fichier.endswith(".json") for r in found)
    for columns in ("*", "id_offre"):
        with pytest.raises(Exception, match="not a JSON listing"):
            B.read_envelope(spark, scratch + "/*.json").select(columns).collect()


def test_unknown_fields_survive_bronze(spark, scratch):
    lines, bronze = os.path.join(scratch, "in.json"), os.path.join(scratch, "bronze")
    with open(lines, "w", encoding="utf-8") as f:
        f.write('{"id_offre": "a", "source": "X", "date_publication": "2024-03-01", "champ_nouveau": [1, 2]}\n')
    B.write_bronze(B.read_raw_json_lines(spark, lines), bronze, "in.json")
    back = B.read_bronze(spark, bronze).first()
    assert '"champ_nouveau": [1, 2]' in back.listing_json and (back.source_key, back.month_key) == ("x", "2024_03")
    meta = B.partition_metadata(B.read_bronze(spark, bronze)).first()
    assert (meta.partition, meta.nb_offres, meta.source_fichier) == ("x/2024_03", 1, "in.json") and meta.date_ingestion


def test_one_month_of_silver(spark, scratch):
    """A run of one month reads that month alone and leaves the others as they are."""
    raw = listings_from_tables(spark, SF_SMALL)
    paths = pipeline.run(spark, raw, os.path.join(scratch, "lake"), stages=("bronze", "silver"))
    month = B.read_bronze(spark, paths.bronze).where("month_key <> 'date_inconnue'").agg(F.max("month_key")).first()[0]
    files = lambda p: {f: os.path.getmtime(f[len("file://"):]) for f in spark.read.parquet(p).inputFiles()}
    before = files(paths.silver_listings)
    pipeline.run(spark, None, paths.root, stages=("silver",), months=[month])
    after = files(paths.silver_listings)
    kept = {f: t for f, t in before.items() if f"mois_cle={month}" not in f}
    assert kept == {f: t for f, t in after.items() if f"mois_cle={month}" not in f}
    assert pipeline.read_silver(spark, paths.silver_listings).count() == raw.count()
    one = pipeline.read_silver(spark, paths.silver_listings, [month])
    assert 0 < one.count() < raw.count() and "PartitionFilters: [isnotnull(mois_cle" in one._jdf.queryExecution().toString()


def test_report_of_what_was_landed(spark, scratch):
    raw = listings_from_tables(spark, SF_SMALL)
    paths = pipeline.run(spark, raw, os.path.join(scratch, "lake"), stages=("bronze",))
    total = spark.read.json(paths.ingestion_report).filter("niveau = 'total'").first()
    assert total.nb_offres == raw.count() and total.date_ingestion[:2] == "20"
    assert total.nb_fichiers == B.read_metadata(spark, paths.bronze_metadata).count()


def test_company_csv(spark, scratch):
    from talentlake.sources.files import read_companies

    path = os.path.join(scratch, "companies.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("nom_entreprise,secteur,taille,ville_siege,site_web,type\nAcme,IT,10-50,Rabat,https://a.example,Startup\n")
    assert read_companies(spark, path).first().ville_siege == "Rabat"


def test_unique_ids_give_the_same_ranking(spark):
    silver = to_silver(listings_from_tables(spark, SF_SMALL)).filter(F.col("id_offre").startswith("L-")).cache()
    skills = extract_skills(silver).cache()
    exact, counted = G.top_skills(skills, silver), G.top_skills(skills, silver, unique_ids=True)
    assert sorted(map(tuple, exact.collect())) == sorted(map(tuple, counted.collect()))


def test_stages_run_separately(spark, scratch):
    raw = listings_from_tables(spark, SF_SMALL)
    root = os.path.join(scratch, "lake2")
    pipeline.run(spark, raw, root, stages=("bronze",))
    paths = pipeline.run(spark, None, root, stages=("silver", "gold"))
    assert spark.read.parquet(paths.silver_listings).count() == raw.count()
    assert spark.read.json(paths.ingestion_report).filter("niveau = 'total'").first().nb_offres == raw.count()
    assert spark.read.parquet(paths.gold("tendances_mensuelles")).count() > 0


def test_metadata_of_touched_partitions(spark, scratch):
    """A replayed month is all that is read again; a partition taken away leaves the metadata."""
    import shutil

    raw = listings_from_tables(spark, SF_SMALL)
    paths = pipeline.run(spark, raw, os.path.join(scratch, "lake"), stages=("bronze",))
    keyed = B.with_partition_keys(raw)
    want = lambda df: sorted(map(tuple, B.partition_metadata(df).select("partition", "nb_offres").collect()))
    have = lambda: sorted(map(tuple, B.read_metadata(spark, paths.bronze_metadata).select("partition", "nb_offres").collect()))
    assert have() == want(B.read_bronze(spark, paths.bronze)) and len(have()) > 50
    assert B.update_metadata(spark, paths.bronze, paths.bronze_metadata) == 0
    month = keyed.where("month_key <> 'date_inconnue'").agg(F.max("month_key")).first()[0]
    one = keyed.where(F.col("month_key") == month).drop("source_key", "month_key")
    B.write_bronze(one.unionByName(one), paths.bronze, "replay.json")
    changed, gone = B.touched_partitions(spark, paths.bronze, paths.bronze_metadata)
    assert {m for _, m in changed} == {month} and not gone
    B.update_metadata(spark, paths.bronze, paths.bronze_metadata)
    log = spark.read.schema(B.MANIFEST).json(paths.bronze_metadata)
    assert {r.month_key for r in log.where("source_fichier = 'replay.json'").collect()} == {month} and log.count() == len(have()) + len(changed)
    assert have() == want(B.read_bronze(spark, paths.bronze))
    assert sum(n for _, n in have()) == raw.count() + one.count()
    first = sorted(os.listdir(paths.bronze))[-1]
    shutil.move(os.path.join(paths.bronze, first), os.path.join(scratch, "away"))
    B.update_metadata(spark, paths.bronze, paths.bronze_metadata)
    assert have() == want(B.read_bronze(spark, paths.bronze))


def test_partitions_from_folders(spark, scratch):
    raw = spark.createDataFrame([("a", "Rekrute +1", "2024-03-01"), ("b", "é/x:y", "2024-04"), ("c", None, "x"), ("d", "0123", "2024-03")], "id_offre string, source string, date_publication string")
    for f in B.RAW_LISTING.fields:
        if f.name not in raw.columns:
            raw = raw.withColumn(f.name, F.lit(None).cast(f.dataType))
    path = os.path.join(scratch, "bronze")
    B.write_bronze(raw, path)
    found = B.stored_partitions(spark, path)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, B.list_partitions(B.with_partition_keys(raw)).collect()))
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()

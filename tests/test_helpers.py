import os

from pyspark.sql import functions as F

from talentlake.functions.stats import pct_of, pearson
from talentlake.functions.text import (
    chart_label, family_label, percent_text, py_strip, py_title, round_half_up, signed_thousands, truncate_text,
)
from talentlake.plans import pipeline
from talentlake.sources.files import export_bundle
from talentlake.sources.listings import listings_from_tables

from conftest import SF_SMALL


def test_text_helpers(spark):
    df = spark.createDataFrame([("a" * 55, 1500.4, "Développeur Backend", "data_engineering", "  x ")],
                               "t string, g double, p string, f string, s string")
    r = df.select(
        truncate_text(F.col("t")).alias("t"), signed_thousands(F.col("g")).alias("g"),
        signed_thousands(-F.col("g")).alias("n"), chart_label(F.col("p")).alias("p"),
        family_label(F.col("f")).alias("f"), py_strip(F.col("s")).alias("s"),
        py_title(F.lit("sidi-slimane l'aïn 3d")).alias("title"),
        percent_text(F.lit(1), F.lit(3)).alias("pct"), percent_text(F.lit(1), F.lit(0)).alias("na"),
    ).first()
    assert r.t == "a" * 50 + "..."
    assert (r.g, r.n) == ("+1,500", "-1,500")
    assert r.p == "Dev. Backend" and r.f == "Data Engineering" and r.s == "x"
    assert r.title == "Sidi-Slimane L'Aïn 3D"
    assert (r.pct, r.na) == ("33%", "N/A")


def test_rounding_and_stats(spark):
    df = spark.createDataFrame([(1.005, 1, 0), (2.5, 2, 2), (None, 3, 4)], "x double, a int, b int")
    got = [r.r for r in df.select(round_half_up(F.col("x"), 0).alias("r")).collect()]
    assert got == [1.0, 3.0, None]
    assert df.select(pct_of(F.lit(1), F.lit(0)).alias("p")).first().p is None
    r = df.agg(pearson(F.col("a"), F.col("b")).alias("r")).first().r
    assert abs(r - 1.0) < 1e-12
    flat = spark.createDataFrame([(1, 5), (2, 5)], "a int, b int").agg(pearson(F.col("a"), F.col("b")).alias("r"))
    assert flat.first().r is None


def test_analysis_bundle_export(spark, scratch):
    from talentlake.operators.silver import to_silver
    from talentlake.operators.skills import extract_skills

    silver = to_silver(listings_from_tables(spark, SF_SMALL))
    bundle = pipeline.analysis_bundle(silver, extract_skills(silver))
    assert len(bundle) == 8
    paths = export_bundle(bundle, os.path.join(scratch, "export"))
    for name, path in paths.items():
        assert spark.read.json(path).count() == bundle[name].count(), name


def test_entry_without_the_optional_part():
    """Where a dependency of the training-data operators is missing, the lake's queries are still there."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import sys; sys.modules['public_tokenizers'] = None; sys.modules['talentlake.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') or n == 'pipeline' for n in e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0 and said.stdout.split()[1] == "False" and int(said.stdout.split()[0]) > 50

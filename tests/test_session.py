from talentlake.session import materialize, scratch_table, shared_dir


def test_shared_dir_comes_from_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark).endswith(configured.rstrip("/").split(":")[-1].split("/")[-1])


def test_materialize_writes_under_shared_dir(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    out = materialize(df)
    files = out.inputFiles()
    assert files and all(shared_dir(spark).split(":")[-1] in f for f in files)
    assert sorted(r.k for r in out.collect()) == list(range(10))


def test_scratch_folders_differ(spark):
    a, b = scratch_table(spark), scratch_table(spark)
    assert a != b and a.startswith(shared_dir(spark))

"""The pipeline's stages and the registration."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from edge import documents, empty, prose, rows
from test_counts_and_scores import brute_base
from test_dedup import brute_prints
from test_rules_and_mix import brute_contamination, brute_targets
from talentlake.llm import decontamination, quality, suffix_dedup
from talentlake.llm.common import written


def test_registered():
    names = sorted((n for n in E.queries() if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, len(names) + 1))
    assert "pipeline" in E.queries() and set(E.oracle_sql()) <= set(E.queries())
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_return_documents(spark, tmp_path):
    """Each stage against its operator, on odd rows with columns that clash."""
    docs = written(documents(spark))
    spark.createDataFrame([(1, rows()[5][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = sorted(map(str, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        got = sorted(map(str, out.collect()))
        if name == "suffix_array":
            assert len(got) == len(want)
        else:
            assert set(got) <= set(want) and 0 < len(got) < len(want)
        assert stage(spark, empty(spark), str(tmp_path)).count() == 0
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert mixed.columns[: len(docs.columns)] == docs.columns and mixed.where("copies < 1").count() == 0


def test_stage_decisions(spark, tmp_path):
    docs = written(documents(spark))
    spark.createDataFrame([(1, rows()[5][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    run = lambda k, d=docs: corpus_pipeline.STAGES[k][1](spark, d, str(tmp_path))
    count = lambda df: df.count()
    assert count(run(0)) == count(quality.judged(docs).where("kept"))
    left = sorted((str(r["doc_id"]), r["text"] or "") for r in run(2).collect())
    assert left == sorted((str(r["doc_id"]), r["kept"]) for r in suffix_dedup.remove_later_copies(docs, keep_text=True).collect())
    benchmark = spark.read.parquet(f"{tmp_path}/benchmark.parquet")
    assert count(run(3)) == count(decontamination.contamination(docs, benchmark).where("not contaminated"))
    assert run(4).agg({"taken": "sum"}).first()[0] is not None


def test_near_duplicates_go_by_row(spark, tmp_path):
    """A unique text stays where another row of its id has a near copy."""
    row = lambda i, t: (i, t, "en", "a", 1, "r", 1, "f", "s", "k", "q")
    copy, alone = prose(1, 70), prose(2, 70)
    data = [row(1, copy), row(5, copy), row(5, alone), row(7, prose(3, 70)), row(None, prose(4, 70))]
    out = corpus_pipeline.near_duplicates(spark, documents(spark, data), str(tmp_path))
    assert sorted(map(str, out.collect())) == sorted(map(str, documents(spark, [data[0], *data[2:]]).collect()))


def brute_near(data, distance=4):
    """One row of each component: least id, null last."""
    prints, root = [fp for _, fp in brute_prints(data, 4)], list(range(len(data)))
    for a in range(len(data)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance and root[a] != root[b]:
                root = [root[b] if x == root[a] else x for x in root]
    groups = {}
    for k, r in enumerate(root):
        groups.setdefault(r, []).append(data[k])
    return list(groups.values())


def brute_spans(data, span=50):
    last = 2**63
    least = {}
    for i, t, *_ in data:
        b = (t or "").encode()
        for k in range(len(b) - span + 1):
            least[b[k : k + span]] = min(least.get(b[k : k + span], last), last if i is None else i)
    for i, t, *rest in data:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if least[b[k : k + span]] < (last if i is None else i):
                gone[k : k + span] = b"\1" * span
        left = bytes(c for c, g in zip(b, gone) if not g).decode("utf-8", "replace")
        yield (i, t if t is None else left, rest[0], rest[1], len(left) if any(gone) else rest[2], *rest[3:])


def test_stages_against_plain_python(spark, tmp_path):
    """Each stage's rows, on what the one before it returned: junk, copies, shared passages, benchmark text,
    null and repeated ids, rows that repeat."""
    passage = " ".join(prose(1, 70).split()[5:40])
    spark.createDataFrame([(1, passage), (2, None), (None, prose(77, 15))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    row = lambda i, t, s: (i, t, "en", s, None if t is None else len(t), "r", 1, "f", "s", "k", "q")
    shared = prose(9, 60)
    data = rows() + [row(300 + i, prose(300 + i, 60) + (" " + shared if i % 9 == 0 else ""), f"s{i % 3}" if i % 5 else None) for i in range(90)]
    data += [row(None, prose(9000, 80), "s1"), row(None, prose(9000, 80), "s1"), row(300, prose(9001, 50), "a"), row(301, prose(301, 60), "s1"), row(400, prose(401, 90) + " " + passage, "b"), row(401, prose(77, 15) + " " + prose(402, 60), "b")]
    data += [row(402, "### $$$ %%% " * 20, "b"), row(403, " ".join(f"{a * 7919 % 997}|{a}" for a in range(80)), "b")]
    docs, one = documents(spark, data), lambda df: sorted(map(tuple, df.collect()), key=repr)
    stage = dict(corpus_pipeline.STAGES)

    judged = {(r["doc_id"], r["text"]): r["kept"] for r in quality.judged(docs).join(docs.select(quality.row_key().alias("rid"), "text"), "rid").collect()}
    fails = lambda t: (b := brute_base(t))[0] < 10 or 100 * b[4] > 20 * b[0]
    kept = [x for x in data if judged[x[0], x[1]]]
    assert not any(fails(t) for _, t, *_ in kept) and 400 not in {i for i, *_ in data} - {i for i, *_ in kept}
    docs = written(stage["quality_rules"](spark, docs, str(tmp_path)))
    assert one(docs) == sorted(kept, key=repr)

    groups = brute_near(kept)
    docs = written(stage["near_duplicates"](spark, docs, str(tmp_path)))
    kept = one(docs)
    assert len(kept) == len(groups) and len({x for x in kept}) < len(data)
    order = lambda x: (x[0] is None, x[0] or 0)
    for g in groups:
        (stays,) = [x for x in g if x in kept][:1]
        assert order(stays) == min(map(order, g)) and sum(x in kept for x in set(g)) == 1

    docs = written(stage["suffix_array"](spark, docs, str(tmp_path)))
    kept = sorted(brute_spans(kept), key=repr)
    assert one(docs) == kept and any(shared not in (t or "") for i, t, *_ in kept if i and 300 < i < 390 and (i - 300) % 9 == 0)

    bad = [c for *_, c in brute_contamination([x[:2] for x in kept], [(1, passage), (None, prose(77, 15))], 10)]
    docs = written(stage["decontaminated"](spark, docs, str(tmp_path)))
    kept = [x for x, c in zip(kept, bad) if not c]
    assert one(docs) == kept and any(bad) and len(kept) > 80

    size = lambda t: len((t or "").encode().split())
    sizes, takes = {}, {}
    for _, t, _, s, *_ in kept:
        sizes[s] = sizes.get(s, 0) + size(t)
    for r in stage["mixed"](spark, docs, str(tmp_path)).collect():
        assert tuple(r)[:11] in kept and 1 <= r["copies"] <= 3 and r["taken"] == r["copies"] * size(r["text"])
        takes[r["source"]] = takes.get(r["source"], 0) + r["taken"]
    for s, t in brute_targets(sizes, [5, 2, 1], 3).items():
        assert abs(takes.get(s, 0) - t) <= max(size(x[1]) for x in kept if x[3] == s)


def test_repeated_rows(spark, tmp_path):
    """Of rows that repeat, with and without an id, one stays; in the mix each has copies of its own."""
    row = lambda i, t, s="a": (i, t, "en", s, 1, "r", 1, "f", "s", "k", "q")
    data = [row(None, prose(1, 60))] * 3 + [row(9, prose(2, 60))] * 2 + [row(None, prose(3, 60))]
    out = corpus_pipeline.near_duplicates(spark, documents(spark, data), str(tmp_path))
    assert sorted(map(str, out.collect())) == sorted(map(str, documents(spark, [data[0], data[3], data[5]]).collect()))
    data = [row(1, "w " * 10, "a")] * 2 + [row(i, "w " * 10, "b") for i in range(2, 20)] + [row(30, "w " * 7, "b")] * 5
    out = corpus_pipeline.mixed(spark, documents(spark, data), str(tmp_path)).collect()
    assert [(r["doc_id"], r["copies"], r["taken"]) for r in out if r["source"] == "a"] == [(1, 3, 30)] * 2
    assert all(1 <= r["copies"] <= 3 and r["taken"] == r["copies"] * len(r["text"].split()) for r in out)
    assert abs(sum(r["taken"] for r in out if r["source"] == "b") - (20 + 180 + 35 - 60)) <= 10


def test_clean_documents_stay(spark, tmp_path):
    docs = documents(spark, [(i, prose(i, 60), "en", f"s{i % 3}", 1, "r", 1, "f", "s", "k", "q") for i in range(150)])
    spark.createDataFrame([(1, prose(9999, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = sorted(map(str, docs.collect()))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, str(tmp_path)))
        assert sorted(map(str, docs.collect())) == want


def test_run(spark):
    out = E.queries()["pipeline"](spark, SF_SMALL)
    assert out.count() > 50 and {"doc_id", "text", "copies", "taken"} <= set(out.columns)


@pytest.mark.parametrize("name", [n for n in E.oracle_sql() if n.startswith("op")])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.sql(E.oracle_sql()[name])
    df = E.queries()[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(cols).collect()))) == sorted(map(repr, rel.select(*cols).fetchall()))

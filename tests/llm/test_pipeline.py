"""The pipeline's stages against brute force, its oracle queries, and the guard."""

import os
import shutil
import subprocess
import sys
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(__file__))
from support import CLASHING, corpus, frame  # noqa: E402
from test_dedup import components, fp_brute, lines_brute, suffix_brute  # noqa: E402

import corpus_pipeline as P
from orbis.llm import quality_classifier, queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(P.STAGES)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r.doc_id: r.score for r in quality_classifier.quality_scores(docs, labels).collect()}

    def step(df, name):
        out = stages[name](spark, df, SF)
        path = str(tmp_path / name.replace(" ", "-"))
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if name != "packing":
            assert out.columns == columns
            assert all(r.n_chars == len(r.text) for r in out.collect())
        return out
    a = step(docs, "quality classifier")
    assert sorted(texts(a)) == sorted((d, t) for d, t in texts(docs) if scores[d] >= 0.7)
    b = step(a, "line dedup")
    assert Counter(texts(b)) == Counter((d, t) for d, _, _, t in lines_brute(texts(a)))
    c = step(b, "SimHash near-dedup")
    fps = {d: fp_brute(t) for d, t in texts(b)}
    root = components(set(fps.values()), 2)
    least = {}
    for d in sorted(fps):
        least.setdefault(root[fps[d]], d)
    assert sorted(d for d, _ in texts(c)) == sorted(least.values())
    e = step(c, "suffix-array dedup")
    want = Counter((d, k.decode("utf-8", "ignore")) for d, _, _, _, k in suffix_brute(texts(c), 200))
    assert Counter(texts(e)) == want
    f = step(e, "packing")
    assert {r.doc_id for r in f.collect()} == {d for d, _ in texts(e)}

    run = P.run(spark, SF).drop("sequence_id")
    assert Counter(tuple(r) for r in run.collect()) == Counter(tuple(r) for r in f.drop("sequence_id").collect())


def test_stages_take_edge_cases(spark):
    docs = frame(spark, corpus(11), clashing=True)
    none = frame(spark, [], clashing=True)
    for name, stage in P.STAGES[1:]:
        out = stage(spark, docs, SF)
        assert out.count() > 0 and stage(spark, none, SF).count() == 0
        if name != "packing":
            assert out.columns == ["doc_id", "text", *CLASHING]


def test_stages_take_two_columns(spark):
    docs = frame(spark, corpus(12))
    for name, stage in P.STAGES[1:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text"] and docs.count() > 0, name


def test_oracle_queries(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        df = queries.QUERIES[name](spark, SF)
        want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()
        assert Counter(tuple(r) for r in df.collect()) == Counter(want), name


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and [s for s, _ in P.STAGES] == [
        "quality classifier", "line dedup", "SimHash near-dedup", "suffix-array dedup", "packing"]


def test_the_rest_imports_without_this_folder(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(x.startswith('op') for x in q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)

from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline as P
from corpusmill.llm import decontaminate, langid, mixing, neardup, secrets
from corpusmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLE = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_their_operators(spark, tmp_path):
    """Each stage keeps the columns, and the rows that its operator's own report says."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    reports = [
        lambda d: {r["doc_id"] for r in langid.identify(d).collect() if r["lang_pred"] != "und" and r["score"] >= 0.35},
        lambda d: {r["doc_id"] for r in neardup.near_duplicates(d).collect() if r["kept"]},
        lambda d: {r["doc_id"] for r in decontaminate.report(d, benchmark).collect() if not r["contaminated"]},
        lambda d: {r["doc_id"] for r in d.select("doc_id").collect()},
        lambda d: {r["doc_id"] for r in mixing.mix(d).collect() if r["taken"]},
    ]
    before = None
    for k, ((name, stage), report) in enumerate(zip(P.STAGES, reports, strict=True)):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        assert out.columns[:5] == TABLE and (len(out.columns) == 5) == (k < 4), name
        ids = [r["doc_id"] for r in out.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) == report(docs), name
        if name == "secrets":
            assert all(r["n_assign"] + r["n_access"] + r["n_hex"] == 0 for r in secrets.scan(out).collect())
            clean = {r["doc_id"] for r in secrets.scan(docs).collect() if not r["spans"]}
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert all(r["text"] == texts[r["doc_id"]] for r in out.collect() if r["doc_id"] in clean)
        before, docs = len(ids), out
    whole = {(r["doc_id"], r["taken"]) for r in P.run(spark, SF).collect()}
    assert whole == {(r["doc_id"], r["taken"]) for r in docs.collect()} and len(whole) == before


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_columns_of_any_name_keep_their_values(spark, tmp_path):
    names = ["size", "_key", "_text", "_id", "_lang_pred", "_n_hit", "target", "taken", "key", "row", "digest", "component_id", "mix_size"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = [stage for _, stage in P.STAGES]
    wide = docs.withColumns({n: F.concat(F.lit(n + ":"), F.col("doc_id").cast("string")) for n in names})
    for k, stage in enumerate(plain):
        for name, df in (("plain", docs), ("wide", wide)):
            stage(spark, df, SF).write.parquet(str(tmp_path / f"{name}{k}"))
        docs, wide = (spark.read.parquet(str(tmp_path / f"{name}{k}")) for name in ("plain", "wide"))
        assert wide.columns[:5 + len(names)] == [*TABLE, *names]
        rows = wide.collect()
        assert all(r[n] == f"{n}:{r['doc_id']}" for r in rows for n in names)
        assert {(r["doc_id"], r["text"]) for r in rows} == {(r["doc_id"], r["text"]) for r in docs.collect()}
    assert wide.columns[5 + len(names):] == ["mix_mix_size", "source_size", "mix_target", "mix_taken"]


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_nothing_else_imports_the_subpackage():
    root = Path(__file__).resolve().parents[2]
    for path in [*root.glob("corpusmill/**/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        if "llm" not in path.parts:
            assert "corpusmill.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text(), path

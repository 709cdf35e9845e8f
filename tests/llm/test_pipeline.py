from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from larder.llm import queries
from tests.compare import compare, duck

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_like_sql(spark, name):
    con = duck(DATA)
    got = queries.QUERIES[name](spark, DATA).toArrow()
    assert compare(got, con.sql(queries.ORACLE_SQL[name]).to_arrow_table()) is None


def test_stages_one_by_one(spark, tmp_path):
    from tests.llm.test_neardup import brute
    from tests.llm.test_packing_sharding import _check
    from tests.llm.test_pii_decontam import plain

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, DATA)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == names
            kept[name] = {r.doc_id: r for r in docs.collect()}
        if name == "language_id":
            assert set(before) == set(kept[name])  # every text here has a language
        elif name == "near_dedup":
            roots = brute([(i, r.text) for i, r in before.items()])
            assert set(kept[name]) == set(roots.values()) and len(roots) > len(kept[name])
        elif name == "decontamination":
            items = [t.lower().split() for (t,) in duckdb.sql(f"SELECT text FROM '{DATA}/benchmark.parquet'").fetchall()]
            leaks = {i for i, r in before.items() for w in items if " ".join(w[2:14]) in " ".join(r.text.lower().split())}
            assert set(kept[name]) == set(before) - leaks and leaks
        elif name == "pii":
            assert set(before) == set(kept[name])
            assert not any(plain(r.text) for r in kept[name].values())
            assert all(r.n_chars == len(r.text) for r in kept[name].values())
            assert all(before[i] == r for i, r in kept[name].items() if not plain(before[i].text) and "<" not in r.text)
        else:
            _check(docs, [(i, r.text) for i, r in before.items()])


def test_empty_and_odd_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame(
        [(-1, None, None, None, None), (-2, "", "en", "s", 0), (-3, "123", "en", "s", 3)], docs.schema)
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * FROM '{DATA}/benchmark.parquet') TO '{tmp_path}/benchmark.parquet'")
    docs.union(odd).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    assert not ids & {-1, -2, -3} and len(ids) > 100
    none = tmp_path / "none"
    none.mkdir()
    docs.limit(0).write.parquet(str(none / "documents.parquet"))
    con.execute(f"COPY (SELECT * FROM '{DATA}/benchmark.parquet') TO '{none}/benchmark.parquet'")
    assert corpus_pipeline.run(spark, str(none)).count() == 0

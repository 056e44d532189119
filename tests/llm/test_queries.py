"""All queries on awkward and on empty tables, and against their SQL."""

import os

import pytest

import corpus_pipeline
from keepcurve.llm.queries import ORACLES, QUERIES
from tests.llm import edge_tables
from tools.check_oracles import rows_of

SF = "/root/testdata/sf0.001"
PER_DOCUMENT = ["op3_simhash_dedup", "op5_toxicity", "op6_sharding", "op7_mixing", "op8_language_id", "op9_line_dedup", "op10_class_lm",
                "op12_exact_dedup", "op13_merkle_manifest"]


@pytest.fixture(scope="module")
def edges(tmp_path_factory):
    return edge_tables.write(tmp_path_factory.mktemp("edges"))


@pytest.fixture(scope="module")
def nothing(tmp_path_factory):
    return edge_tables.write(tmp_path_factory.mktemp("nothing"), empty=True)


@pytest.fixture(autouse=True)
def fewer_rounds(monkeypatch):
    from keepcurve.llm import brown_lm

    monkeypatch.setattr(brown_lm.score_texts, "__defaults__", ("doc_id", "text", 2))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, nothing, name):
    assert QUERIES[name](spark, nothing).count() == 0


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_every_row_comes_back_once(spark, edges, name):
    got = sorted(str(r["doc_id"]) for r in QUERIES[name](spark, edges).select("doc_id").collect())
    assert got == sorted(str(x) for x in edge_tables.documents()["doc_id"].to_pylist())


def test_pipeline_on_awkward_and_empty_tables(spark, edges, nothing):
    assert corpus_pipeline.run(spark, nothing).count() == 0
    assert corpus_pipeline.run(spark, edges).count() > 0
    docs = spark.read.parquet(f"{edges}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, edges).columns == docs.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    assert rows_of(QUERIES[name](spark, SF).toPandas()) == rows_of(con.execute(ORACLES[name]).df())

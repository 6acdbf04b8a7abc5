"""Registered corpus queries: oracles on sf0.001, columns of the contract, and the pipeline against its parts."""

import re

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from staylens.llm.oracles import ORACLES
from staylens.llm.queries import QUERIES
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op2": "doc_id fingerprint component_id",
    "op3": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4": "doc_id size source_size target taken",
    "op5": "doc_id n_words n_removed kept_sha256",
    "op6": "page_id url text n_chars",
    "op7": "query_id rank vec_id score",
    "op8": "doc_id held_out score predicted",
    "op9": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op10": "doc_id n_entities text",
    "op11": "item_id rank doc_id score",
    "op12": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op13": "lang rank phrase a l r n score",
}


def test_registered():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "pii", "mixing"]


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "pipeline" and n not in ORACLES])
def test_columns(spark, name):
    df = QUERIES[name](spark, SF)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(df.columns)
    table = {"op6": "pages", "op7": "embeddings"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert df.count() == (n // 50 * 5 if table == "embeddings" else n)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


def test_pipeline_is_its_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, last = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        n = docs.count()
        assert 0 < n <= last
        last = n
    want = sorted((r.doc_id, r.size, r.taken) for r in docs.collect())
    got = sorted((r.doc_id, r.size, r.taken) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want

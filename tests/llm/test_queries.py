"""The corpus queries on the small tables: SQL where there is some, the contracts' invariants, and the pipeline."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from tests.compare import assert_same, connect
from tidewire.llm import neardup
from tidewire.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert_same(QUERIES[name](spark, SF), con, ORACLES[name])


@pytest.mark.parametrize("name", ["op1_cdc_fingerprints", "op2_toxicity_string_kernel", "op3_raked_mixing", "op10_site_quality"])
def test_a_row_for_each_document(spark, con, name):
    want = con.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()
    assert sorted((r.doc_id,) for r in QUERIES[name](spark, SF).select("doc_id").collect()) == want


def test_quality_holds_up_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: r.kept for r in QUERIES["op10_site_quality"](spark, sf).collect()}
    labels = duckdb.connect().execute(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    import zlib

    held = [(out[i], q == 1) for i, q in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) >= 0.97


def test_pipeline_stages(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        if name == "near_dedup":
            want = {r.doc_id for r in neardup.near_duplicates(docs, 80).where("kept").collect()}
        docs = spark.read.parquet(str(tmp_path / name))
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids and left
        if name == "near_dedup":
            assert left == want
        ids = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids

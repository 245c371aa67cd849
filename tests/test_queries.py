"""Every query of the engine with SQL against DuckDB, and the driver's entry points."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__
from tests.compare import assert_same, connect
from tidewire import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, con, name):
    assert_same(catalogue.QUERIES[name](spark, SF), con, catalogue.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_has_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry_points(spark):
    assert __spark_entry__.entry(spark).columns == ["source_id", "reason", "n"]
    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_the_rest_stands_without_the_corpus_operators():
    code = "import sys; sys.modules['tidewire.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.catalogue.QUERIES))"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip().endswith("True"), out.stderr

"""Every registered query against its SQL on the smallest data, and the flagship query."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from registry import QUERIES, SQL
from tests.compare import compare
from tests.conftest import DATA

ROOT = Path(__file__).resolve().parent.parent
ROWS_ONLY = {"v02_approx_search", "w08_louvain"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, name):
    sql = SQL.get(name)
    assert (sql is None) == (name in ROWS_ONLY)
    said, _, _ = compare(spark, name, QUERIES[name], sql, DATA)
    assert said.startswith(("ok", "rows only")) and "TYPES" not in said, said


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["request_id", "node_id", "name", "edge_id", "edge_type", "direction"]
    assert rows.count() > 0


def test_entry_lists_all_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_no_local_checkpoint_or_cross_join():
    code = "\n".join(p.read_text() for p in (ROOT / "meshlark").rglob("*.py"))
    assert not re.search(r"localCheckpoint|crossJoin|\.rdd\b|@F?\.?udf", code)

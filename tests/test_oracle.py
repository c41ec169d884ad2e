"""Every registered query against its DuckDB oracle on the smallest test
tables (the driver repeats this at sf0.01)."""

import os

import pytest

import __spark_entry__ as E
from tools.compare import compare, duckdb_connection
from parcelworks.plans.registry import QUERIES, TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


def test_faulty_rows_are_counted(spark, con):
    """No check compares zero with zero."""
    rows = con.execute(E.oracle_sql(SF)["quality_report"]).fetchall()
    assert len(rows) == 9 and all(not passed and failures > 0 for _, passed, failures, _ in rows), rows


def test_malformed_text_reaches_every_parser(con):
    """The distorted rows change what staging reads, in every table."""
    sql = E.oracle_sql(SF)
    for table in TABLES:
        plain, other = (con.execute(sql[f"stg_{table}{form}"]).fetchall() for form in ("", "_from_text"))
        assert len(plain) == len(other) and sorted(map(str, plain)) != sorted(map(str, other)), table


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    """Same rows as the DuckDB oracle, and no cross / nested-loop join in
    the physical plan."""
    from tests.test_plan_shapes import assert_no_cross_join

    df = E.queries()[name](spark, SF)
    assert_no_cross_join(df)
    result = compare(df, con, E.oracle_sql(SF)[name])
    assert result["columns_match"], (result["spark_columns"], result["oracle_columns"])
    assert result["match"], result


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "late_delivery"
    assert df.count() == 2


def test_snapshot_fingerprints_match_hashlib(spark):
    import hashlib
    from pathlib import Path

    got = {r.filename: (r.logical_table, r.bytes, r.sha256) for r in E.queries()["snapshot_fingerprints"](spark, SF).collect()}
    assert len(got) == 7
    for name, (table, size, digest) in got.items():
        data = (Path(SF) / name).read_bytes()
        assert name == f"{table}.parquet"
        assert (size, digest) == (len(data), hashlib.sha256(data).hexdigest())

"""Every registered query against its DuckDB oracle on the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tramline.plans.catalog import QUERIES
from conftest import SF_SMALL

TABLES = ["nation", "orders", "supplier", "lineitem", "events"]
_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
          "float": "FLOAT", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == dict(zip(rel.columns, map(str, rel.types)))
    assert _bag(df.columns, df.collect()) == _bag(rel.columns, rel.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["route_id", "window_start", "window_end", "actual_headway_minutes",
                          "scheduled_headway_minutes", "delay_score"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_reads_the_driver_tables(spark, name):
    """Every registered query scans the given parquet tables (never fixed inline data alone)."""
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and SF_SMALL in plan, name


@pytest.fixture()
def no_broadcast(spark):
    """The large-scale regime: no table is small enough to broadcast."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_with_shuffle_joins_only(no_broadcast, con, name):
    df = E.queries()[name](no_broadcast, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert _bag(df.columns, df.collect()) == _bag(rel.columns, rel.fetchall())

"""Every named query against its SQL twin, over all rows of the smallest two data sets."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from incident_engine.catalog import oracle, queries as catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DATA = "/root/testdata"
SQL = oracle.statements()
QUERIES = catalog.QUERIES
SPARK_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def database(sf):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{DATA}/{sf}/{table}.parquet'")
    return con


#: Queries whose work is a lookup in a table; all others do without joins.
LOOKUPS = {
    "severity_from_table", "place_profile_lookup", "cluster_colours_from_table", "nearest_from_table",
    "type_hour_z_scores", "place_type_z_scores", "completed_time_type",
}


def assert_plan_is_distributed(df, joins=False):
    """No cross product and no Python worker in the plan, and no join unless the query is a lookup."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    words = ["CartesianProduct", "NestedLoop", "Python", "Pandas", "Arrow"] + ["Join"] * (not joins)
    for word in words:
        assert word not in plan, word


@pytest.mark.parametrize("sf", os.environ.get("TEST_SF", "sf0.001 sf0.01").split())
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name, sf):
    df = QUERIES[name](spark, f"{DATA}/{sf}")
    assert_plan_is_distributed(df, name in LOOKUPS)
    result = database(sf).sql(SQL[name])
    assert sorted(df.columns) == sorted(result.columns)
    expected_types = dict(zip(result.columns, map(str, result.types)))
    assert {n: SPARK_TYPES.get(t, t) for n, t in df.dtypes} == expected_types
    got, want = rows_of(df.columns, df.collect()), rows_of(result.columns, result.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize(
    "name",
    ["hourly_risk_anomaly", "cluster_profile", "kpis", "lloyd_clusters", "hexbin_density", "kmeans_clusters",
     "nearest_from_table", "incident_sample_per_cluster"],
)
def test_result_does_not_depend_on_partitions(spark, name):
    def result():
        df = QUERIES[name](spark, f"{DATA}/sf0.001")
        return rows_of(df.columns, df.collect())

    expected = result()
    for key, value in (("spark.sql.shuffle.partitions", "1"), ("spark.sql.adaptive.enabled", "false")):
        before = spark.conf.get(key)
        spark.conf.set(key, value)
        try:
            assert result() == expected
        finally:
            spark.conf.set(key, before)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(SQL) <= set(QUERIES) <= set(contract.queries())


def test_flagship_query(spark):
    rows = contract.entry(spark).collect()
    assert [r["Hour"] for r in rows] == list(range(24))

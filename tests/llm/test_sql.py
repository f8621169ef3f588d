"""Registered queries with SQL against DuckDB, and the rules all of them share."""

import os

import duckdb
import pytest

from tabloom.llm.catalog import llm_queries

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations embeddings".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")
CHECKED = sorted(name for name, query in llm_queries().items() if query.sql)
NATIVE = ("op1_licenses", "op4_quality_rules", "op8_url_filter")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(f"{r[i]:.6f}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(shown)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    df = llm_queries()[name].run(spark, FOLDER)
    relation = duck.execute(llm_queries()[name].sql)
    columns = [c[0] for c in relation.description]
    assert comparable(df.columns, df.collect()) == comparable(columns, relation.fetchall())


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(spark, name):
    plan = llm_queries()[name].run(spark, FOLDER)._jdf.queryExecution().toString()
    for operator in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"):
        assert operator not in plan


def test_all_operators_are_registered():
    assert {int(name[2:].split("_")[0]) for name in llm_queries()} == set(range(1, 14))

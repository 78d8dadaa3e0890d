"""Every registered query of the monitoring library runs; those with SQL agree with it row by row."""

import os

import duckdb
import pandas as pd
import pytest

from tidewatch.plans import registry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return "~"
    if isinstance(v, float):
        return f"{v:.6g}"
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{DIR}/events.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n in registry.ORACLE_SQL])
def test_query_agrees_with_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, DIR)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, got) == _rows(columns, cur.fetchall())


#: What must hold of queries that SQL does not express: rows, and facts about each row.
FACTS = {
    "scan_raw_csv": lambda r: len(r) == 1000,
    "feature_selection": lambda r: len(r) > 0,
    "champion_model": lambda r: len(r) > 0,
    "scored_alerts": lambda r: len(r) > 0 and all(0 <= x["model_score"] <= 1 for x in r),
    "score_lr": lambda r: len(r) > 0 and all(0 <= x["score_logistic_regression"] <= 1 for x in r),
    "score_rf": lambda r: len(r) > 0 and all(0 <= x["score_random_forest"] <= 1 for x in r),
    "score_gbt": lambda r: len(r) > 0 and all(0 <= x["score_gbt"] <= 1 for x in r),
    "calibrated_isotonic": lambda r: len(r) > 0 and all(0 <= x["calibrated_score"] <= 1 for x in r),
    "calibrated_sigmoid": lambda r: len(r) > 0 and all(0 <= x["calibrated_score"] <= 1 for x in r),
}


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in registry.ORACLE_SQL])
def test_query_without_sql_keeps_its_facts(spark, name):
    """Their operators are held against brute force elsewhere; here are the registered values."""
    rows = registry.QUERIES[name](spark, DIR).collect()
    assert FACTS.get(name, len)(rows)

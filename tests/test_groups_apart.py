"""Groups with many rows are taken apart, all others are dealt once and sorted whole; results are the same either way."""

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import windows


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _table(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["HOT", "HOT", "HOT", "A", "B", None]), rng.choice([None, *range(40)]), i, rng.randrange(-5, 9)) for i in range(300)]
    return rows, spark.createDataFrame(rows, "k string, us long, id long, v long")


def test_running_sums_join_nothing(spark):
    _, d = _table(spark)
    plan = _plan(windows.running(d, ["k"], "us", ["id"], {"n": F.col("v")}))
    assert "Join" not in plan and plan.count("Window [") == 1


@pytest.mark.parametrize("upto", [False, True])
def test_running_sums_of_groups_taken_apart(spark, monkeypatch, upto):
    rows, d = _table(spark)
    monkeypatch.setattr(windows, "HEAVY", 60)
    monkeypatch.setattr(windows, "SLICE", 7)
    want = {}
    for k in {r[0] for r in rows}:
        total = 0
        for r in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
            want[r[2]] = total + (r[3] if upto else 0)
            total += r[3]
    out = windows.running(d, ["k"], "us", ["id"], {"n": F.col("v")}, upto=upto)
    assert out.columns == [*d.columns, "n"]
    assert {r["id"]: r["n"] for r in out.collect()} == want
    assert len(want) == out.count() == len(rows)


def test_neighbours_of_small_groups_write_nothing(spark, monkeypatch):
    rows, d = _table(spark)

    def get():
        return {r["id"]: (r["before"], r["after"]) for r in windows.neighbours(d, ["k"], ["id"], "v", "before", "after").collect()}

    written, keep = [], windows.stored
    monkeypatch.setattr(windows, "stored", lambda df, name: written.append(name) or keep(df, name))
    whole = get()
    assert not written
    monkeypatch.setattr(windows, "HEAVY", 60)
    assert get() == whole and written == ["neighbours"]
    assert whole[rows[-1][2]][1] is None

"""Sums in trailing windows as sweeps: no frame is added up again for every row."""

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import windows
from tidewatch.functions.windows import incoming_to_sender, rolling
from tidewatch.operators import graph, rules

from .test_rules_and_windows import random_tx, tx


@pytest.mark.parametrize("closed", [False, True])
def test_sums_of_a_busy_account_match_brute_force(spark, closed):
    """Many rows of one account at few times, so windows and ties are large."""
    rng = random.Random(8)
    rows = [(6 * rng.randrange(30), f"A{rng.randrange(6)}", "HUB" if rng.random() < 0.8 else f"A{rng.randrange(6)}", rng.randrange(1, 90)) for _ in range(400)]
    d = tx(spark, rows)
    line = sorted((h, i, r, a) for i, (h, _, r, a) in enumerate(rows, 1))
    want = {}
    for n, (h, i, r, _) in enumerate(line):
        mine = [x[3] for x in line[: n + 1] if x[2] == r and (x[0] >= h - 24 if closed else x[0] > h - 24)]
        want[i] = (len(mine), float(sum(mine)))
    got = rolling(d, "receiver_account_id", "24h", closed)
    assert got.columns == [*d.columns, "rolling_count", "rolling_sum"]
    assert {r["transaction_id"]: (r["rolling_count"], r["rolling_sum"]) for r in got.collect()} == want


def test_no_window_is_summed_again_for_every_row(spark):
    _, d = random_tx(spark)
    for made in (rolling(d, "receiver_account_id", "24h", True), incoming_to_sender(d, "24h")):
        assert "RangeFrame" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_rows_without_a_time_are_apart(spark):
    d = tx(spark, [(0, "S", "R", 1), (1, "S", "R", 10), (2, "S", "R", 100), (3, "R", "S", 7)])
    d = d.withColumn("timestamp", F.when(~F.col("transaction_id").isin(1, 2), F.col("timestamp")))
    got = {r["transaction_id"]: (r["rolling_count"], r["rolling_sum"]) for r in rolling(d, "receiver_account_id", "24h", True).collect()}
    assert got == {1: (1, 1.0), 2: (2, 11.0), 3: (1, 100.0), 4: (1, 7.0)}
    assert {r["transaction_id"]: r["incoming"] for r in incoming_to_sender(d, "24h").collect()} == {1: 0.0, 2: 0.0, 3: 0.0, 4: 100.0}


def test_a_hub_lists_no_pairs_of_its_neighbours(spark, monkeypatch):
    """Many pay a hub that pays many, and one loop leads through it: what the search stores stays near the number of rows."""
    n = 150
    rows = [(i // 4, f"S{i}", "H", 10) for i in range(n)] + [(100 + i // 4, "H", f"D{i}", 10) for i in range(n)] + [(200, "D7", "S9", 10)]
    d, sizes, keep = tx(spark, rows), [], graph.stored

    def counted(df, name):
        out = keep(df, name)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(graph, "stored", counted)
    (r,) = graph.cycle_candidates(d, max_hours=1e6, max_retention=1e9).collect()
    assert (r["cycle_path"], r["path_length"]) == ("D7->S9->H->D7", 4)
    assert max(sizes) <= 3 * len(rows)


@pytest.mark.parametrize("heavy", [100_000, 20])
def test_one_sweep_tells_what_the_others_tell(spark, monkeypatch, heavy):
    """Ties, rows at the edges of windows, missing accounts and times, with and without groups taken apart."""
    monkeypatch.setattr(windows, "HEAVY", heavy)
    _, d = random_tx(spark, 400, seed=9)
    i = F.col("transaction_id")
    d = d.withColumns({
        "timestamp": F.when(i % 37 != 0, F.col("timestamp")), "sender_account_id": F.when(i % 23 != 0, F.col("sender_account_id")),
        "receiver_account_id": F.when(i % 19 != 0, F.col("receiver_account_id")), "amount": F.when(i % 29 != 0, F.col("amount") + 0.37),
    }).cache()
    got = {r["transaction_id"]: r for r in windows.activity(d, "24h").collect()}
    assert len(got) == d.count()
    sent, received = rolling(d, "sender_account_id", "24h", False).collect(), rolling(d, "receiver_account_id", "24h", True).collect()
    told = {
        "sent_count": {r["transaction_id"]: r["rolling_count"] for r in sent}, "sent_sum": {r["transaction_id"]: r["rolling_sum"] for r in sent}, "received_sum": {r["transaction_id"]: r["rolling_sum"] for r in received},
        "incoming": {r["transaction_id"]: r["incoming"] for r in incoming_to_sender(d, "24h").collect()},
        "receivers": {r["transaction_id"]: r["rolling_distinct"] for r in windows.rolling_distinct(d, "sender_account_id", "receiver_account_id", "24h").collect()},
        "senders": {r["transaction_id"]: r["rolling_distinct"] for r in windows.rolling_distinct(d, "receiver_account_id", "sender_account_id", "24h").collect()},
        "funders": {r["transaction_id"]: r["funders"] for r in rules.incoming_unique_funders(d, "24h").collect()},
    }
    assert set(told) == set(windows.ACTIVITY)
    for name, values in told.items():
        assert {k: r[name] for k, r in got.items() if r[name] is not None} == values, name


def test_rules_share_one_sweep(spark, monkeypatch):
    _, d = random_tx(spark, 300, seed=4)
    d = d.withColumn("split", F.when(F.col("transaction_id") % 3 == 0, "train").otherwise("test")).cache()
    o = {"R3_VELOCITY": {"percentile": 0.5}, "R4_PASS_THROUGH": {"min_ratio": 0.1}, "R5_FAN_IN": {"percentile": 0.3, "min_senders": 2}, "R6_FAN_OUT": {"min_receivers": 2, "window": "24h"}}
    alone = [f(d, **o[r]) for r, f in (("R3_VELOCITY", rules.velocity_rule), ("R4_PASS_THROUGH", rules.pass_through_rule), ("R5_FAN_IN", rules.fan_in_rule), ("R6_FAN_OUT", rules.fan_out_rule))]
    want = [sorted(map(tuple, h.collect())) for h in alone]
    sweeps, one = [], windows.running
    monkeypatch.setattr(windows, "running", lambda *a, **k: sweeps.append(a) or one(*a, **k))
    made = rules.run_rules(d, list(o), o).drop("rule_status", "queue_eligible", "volume_control_reason")
    assert all(want) and sorted(map(tuple, made.collect())) == sorted(sum(want, []))
    # rules 3 and 5 ask a sweep of their own for training rows that are not the first
    assert len(sweeps) == 3
    sweeps.clear()
    rules.run_rules(d.withColumn("split", F.lit("train")), list(o), o)
    assert len(sweeps) == 1
    sweeps.clear()
    other = {**o, "R6_FAN_OUT": {"min_receivers": 2, "window": "48h"}}
    own = sorted(map(tuple, rules.fan_out_rule(d, **other["R6_FAN_OUT"]).collect()))
    assert sorted(map(tuple, rules.run_rules(d, list(o), other).where("rule_id = 'R6_FAN_OUT'").drop("rule_status", "queue_eligible", "volume_control_reason").collect())) == own

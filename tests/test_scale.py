"""Selections, neighbours, samples and histories that hold at any size: against plain versions, and by the size of tasks."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import windows
from tidewatch.functions.distributed import first_by_hash, quantiles
from tidewatch.operators import cases, features, graph, models, rules

from .test_rules_and_windows import random_tx, tx


@pytest.mark.parametrize("kind", ["even", "skewed", "signed", "tiny", "few", "one"])
def test_quantiles_of_many_kinds_of_values(spark, kind):
    rng = random.Random(3)
    make = {
        "even": lambda: rng.random() * 1000, "skewed": lambda: 10 ** rng.uniform(-6, 12), "signed": lambda: rng.gauss(0, 50), "tiny": lambda: rng.choice([1e-300, 1e-200, 2e-9, 1e-9, 0.0, -1e-300]),
        "few": lambda: float(rng.randrange(3)), "one": lambda: 7.25,
    }[kind]
    rows = [(rng.choice(["a", "b", None]), make()) for _ in range(700)] + [("a", None), ("c", make()), ("d", None)]
    ps = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    d = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["p"]): r["quantile"] for r in quantiles(d, "v", ps, ["g"]).collect()}
    groups = {g: sorted(v for k, v in rows if k == g and v is not None) for g in ("a", "b", "c", None)}
    assert set(got) == {(g, p) for g in groups for p in ps}
    for (g, p), x in got.items():
        assert x == pytest.approx(float(np.quantile(groups[g], p)), rel=1e-12, abs=1e-310)
    assert quantiles(d.where("false"), "v", ps).count() == 0


def test_quantiles_write_nothing(spark, monkeypatch):
    from tidewatch.functions import distributed

    monkeypatch.setattr(distributed, "stored", lambda *a: pytest.fail("a table was written"))
    assert quantiles(spark.range(100).select(F.col("id").cast("double").alias("v")), "v", [0.5]).first()["quantile"] == 49.5


@pytest.mark.parametrize("few", [1, 7, 10_000])
def test_first_rows_by_hash(spark, few):
    ids = [f"x{i}" for i in range(500)] + ["same"] * 5
    d = spark.createDataFrame([(i,) for i in ids], "id string").withColumn("h", F.md5("id"))
    order = sorted(ids, key=lambda i: (hashlib.md5(i.encode()).hexdigest(), i))
    for n in (0, 1, 99, 300, 504, 505, 900):
        assert Counter(r["id"] for r in first_by_hash(d, n, "h", "id", digits=1, few=few).collect()) == Counter(order[:n])


def test_neighbours_of_one_hot_key(spark):
    """One key with most rows is sorted in many tasks, and the values at the edges of ranges are handed on."""
    rng = random.Random(4)
    rows = [("hot", i, rng.randrange(10**6)) for i in rng.sample(range(100_000), 3000)] + [(f"k{i % 50}", i, i) for i in range(400)] + [(None, 1, 5), (None, 2, 6)]
    d = spark.createDataFrame(rows, "k string, at long, v long").repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        got = windows.neighbours(d, ["k"], ["at"], "v", "before", "after").collect()
        sizes = d.repartitionByRange("k", "at").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want, by = {}, {}
    for k, at, v in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        by.setdefault(k, []).append((at, v))
    for k, items in by.items():
        for i, (at, _) in enumerate(items):
            want[k, at] = (items[i - 1][1] if i else None, items[i + 1][1] if i + 1 < len(items) else None)
    assert {(r["k"], r["at"]): (r["before"], r["after"]) for r in got} == want
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) < 0.3 * len(rows)


def test_role_history_counts_rows_partners_and_amounts(spark):
    rows = [*random_tx(spark, 200, seed=5)[0]] + [(3, None, "A1", 2.5), (4, None, "A1", 1.5), (5, "A1", None, 1.0)]
    d = tx(spark, rows)
    seq = sorted(d.collect(), key=lambda r: (r["timestamp"], r["transaction_id"]))
    got = {r["transaction_id"]: r for r in windows.role_history(d).collect()}
    assert len(got) == len(seq)
    for i, r in enumerate(seq):
        s, t = r["sender_account_id"], r["receiver_account_id"]
        out, back = [x for x in seq[:i] if x["sender_account_id"] == s], [x for x in seq[:i] if x["receiver_account_id"] == t]
        g = got[r["transaction_id"]]
        assert g["pair_count"] == sum(x["receiver_account_id"] == t for x in out)
        assert (g["sender_count"], g["sender_partners"], float(g["sender_amount"])) == (len(out), len({x["receiver_account_id"] for x in out}), pytest.approx(sum(x["amount"] for x in out)))
        assert (g["receiver_count"], g["receiver_partners"], float(g["receiver_amount"])) == (len(back), len({x["sender_account_id"] for x in back}), pytest.approx(sum(x["amount"] for x in back)))


def test_training_rows_that_are_not_the_first_get_a_pass_of_their_own(spark):
    _, d = random_tx(spark, 300, seed=2)
    for split in ("CASE WHEN transaction_id % 3 = 0 THEN 'train' ELSE 'test' END", "CASE WHEN timestamp < '2022-01-06' THEN 'train' ELSE 'test' END", "'test'", "'train'"):
        e = d.withColumn("split", F.expr(split)).cache()
        for rule in (rules.velocity_rule, rules.fan_in_rule):
            key = lambda h: sorted((r["transaction_id"], r["threshold_json"]) for r in h.collect())
            assert key(rule(e, percentile=0.5)) == key(rule(e, rules.training_rows(e), percentile=0.5))


def _frame(spark, y, n):
    return spark.range(y + n).select(F.concat(F.lit("A"), "id").alias("alert_id"), F.when(F.col("id") < y, 1).otherwise(0).alias("target"))


@pytest.mark.parametrize(("y", "n", "cap", "want"), [(30, 700, 200, (18, 181)), (5, 700, 200, (5, 50)), (300, 20, 200, (180, 20)), (300, 700, 200, (19, 181)), (12, 30, 200, (12, 30)), (0, 700, 200, (0, 200)), (300, 0, 200, (200, 0))])
def test_balanced_sample_has_room_for_both_classes(spark, y, n, cap, want):
    got = {r["target"]: r["count"] for r in features.balanced_sample(_frame(spark, y, n), 10, cap).groupBy("target").count().collect()}
    assert (got.get(1, 0), got.get(0, 0)) == ((want[0] if want != (18, 181) else 19), want[1])


def test_balanced_sample_may_keep_all_positives(spark):
    kept = lambda y, n: {r["target"]: r["count"] for r in features.balanced_sample(_frame(spark, y, n), 10, 200, keep_positives=True).groupBy("target").count().collect()}
    assert kept(150, 700) == {1: 150, 0: 50} and kept(300, 700) == {1: 300} and kept(3, 700) == {1: 3, 0: 30}


def test_every_category_is_encoded(spark):
    d = spark.createDataFrame([(f"A{i}", "train", i % 2, f"v{i:03d}", None if i else "x", "high", 1.0) for i in range(450)], "alert_id string, split string, target int, payment_format string, currency_pair string, max_rule_severity string, feature_a double")
    frame, columns = models.prepare(d)
    assert sum(c.startswith("payment_format_v") for c in columns) == 450 and "currency_pair_x" in columns and "currency_pair_null" in columns
    assert frame.agg(F.sum("payment_format_v123"), F.sum("currency_pair_null")).first() == (1, 449)


def test_mega_components_and_their_clusters(spark):
    rows = [(f"A{i:04d}", "giant" if i < 250 else f"c{i % 7}", i // 3, 9) for i in range(330)] + [("B1", None, 1, None)]
    d = spark.createDataFrame(rows, "alert_id string, component_id string, us long, account_count int")
    clusters = cases.mega_clusters(d, 100).collect()
    assert [(r["network_cluster_id"], r["component_id"], r["component_size"], r["alert_count"], r["account_count"], r["recommended_use"]) for r in clusters] == [("NET-000001", "giant", 250, 250, 9, "network_intelligence_only")]
    got = {r["alert_id"]: r for r in cases.split_mega_components(d, "us", ["alert_id"], 40, 100).collect()}
    assert len(got) == len(rows) and all((r["network_cluster_id"] == "NET-000001") == (r["component_id"] == "giant") for r in got.values())
    by = Counter((r["component_id"], r["case_chunk"]) for r in got.values())
    assert max(by.values()) <= 40 and [by["giant", c] for c in range(1, 8)] == [40] * 6 + [10]


def test_hub_times(spark):
    d = tx(spark, [(i, f"S{i}", "H", 10) for i in range(3)] + [(3 + i, "H", f"D{i}", 10) for i in range(3)])
    (r,) = graph.gather_scatter_hubs(d).collect()
    times = [x["timestamp"] for x in d.orderBy("timestamp").collect()]
    assert (r["first_in"], r["last_in"], r["first_out"], r["last_out"]) == (times[0], times[2], times[3], times[5])


def test_what_needs_no_history_of_accounts_makes_none(spark, monkeypatch):
    """Cases, bands and rankings ask alerts and their transactions only."""
    from tidewatch.operators import features
    from tidewatch.plans import registry, tables

    def refuse(tx):
        raise AssertionError("history of all accounts was made")

    tables.forget(spark)
    monkeypatch.setattr(features, "role_history", refuse)
    for name in ("network_clusters", "calibrated_sigmoid", "temporal_stress", "model_comparison"):
        assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").columns
    tables.forget(spark)


def test_areas_of_all_rankings_are_one_pass(spark, monkeypatch):
    from tidewatch.functions import metrics
    from tidewatch.operators import models

    passes, one = [], metrics.prefix_sums
    monkeypatch.setattr(metrics, "prefix_sums", lambda *a: passes.append(a) or one(*a))
    rows = [(f"a{i}", "test", int(i % 3 == 0), float(i % 5), float(i % 7), float(i)) for i in range(60)]
    d = spark.createDataFrame(rows, "alert_id string, split string, target int, feature_rule_priority_score double, feature_amount double, model_score double")
    got = {(r["ranking"], r["metric"]): r["value"] for r in models.evaluate_rankings(d, (10,)).where("k is null").collect()}
    assert len(passes) == 1
    for ranking, at in (("rule_priority", 3), ("amount_rank", 4), ("model_score", 5)):
        pairs = [(p[at], n[at]) for p in rows if p[2] for n in rows if not n[2]]
        assert abs(got[ranking, "roc_auc"] - sum((p > n) + (p == n) / 2 for p, n in pairs) / len(pairs)) < 1e-9
        steps = [(sum(r[2] for r in rows if r[at] == s), [r[2] for r in rows if r[at] >= s]) for s in {r[at] for r in rows}]
        assert abs(got[ranking, "pr_auc"] - sum(n / 20 * sum(seen) / len(seen) for n, seen in steps)) < 1e-9


def test_contribution_and_evidence_need_no_alert_texts(spark, monkeypatch):
    """Both ask for ids and labels of alerts, which hits tell; a transaction's hits are brought together once."""
    from tidewatch.operators import diagnostics
    from tidewatch.plans import registry, tables

    tables.forget(spark)
    monkeypatch.setattr(rules, "alerts", lambda hits: pytest.fail("alerts were made"))
    for name in ("rule_contribution", "rule_recommendations", "alert_waterfall", "graph_evidence_edges"):
        assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").columns
    tables.forget(spark)
    hits = spark.createDataFrame([(1, "R1", "one", 1), (1, "R2", "two", 1), (1, "R2", "two", 1), (2, "R2", "two", None)], "transaction_id long, rule_id string, rule_name string, is_laundering int")
    (a,) = rules.alerted(hits).where("transaction_id = 1").collect()
    assert (a["alert_id"], a["is_laundering"]) == ("ALERT-1", 1) and rules.alerted(hits).count() == 2
    got = {r["rule_id"]: r for r in diagnostics.rule_contribution(hits, rules.alerted(hits)).collect()}
    assert (got["R2"]["alert_count"], got["R2"]["unique_alert_count"], got["R2"]["incremental_alert_count"], round(got["R2"]["overlap_rate"], 6)) == (3, 2, 2, 0.666667)
    assert (got["R1"]["incremental_alert_count"], got["R1"]["overlap_rate"]) == (0, 1.0)


def test_the_amount_rule_sends_no_row_to_its_segment(spark):
    """Thresholds are stored, so Spark knows that they are small and moves no transaction to join them."""
    _, d = random_tx(spark, 300, seed=6)
    made = rules.amount_rule(d, percentile=0.5, min_segment=1)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert made.count() > 0 and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan

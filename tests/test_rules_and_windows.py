"""Hand-checked fixtures and brute force for sources, windows, rules, metrics and bands."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import distributed, windows
from tidewatch.functions.distributed import prefix_sums, quantiles
from tidewatch.functions.metrics import average_precision, binary_metrics, roc_auc, top_k
from tidewatch.functions.windows import incoming_to_sender, rolling, rolling_distinct
from tidewatch.operators import bands, features, profiling, rules
from tidewatch.schemas import STANDARD
from tidewatch.sources import transfers

DAY = datetime(2022, 1, 1)


def tx(spark, rows, split="train"):
    """Rows of (hours after the first day, sender, receiver, amount); ids count from 1."""
    out = [
        (i, DAY + timedelta(hours=h), "001", "002", s, r, float(a), float(a), "USD", "USD", "ACH", "USD -> USD", 1, float(a), 0.0, i % 2)
        for i, (h, s, r, a) in enumerate(rows, 1)
    ]
    return spark.createDataFrame(out, STANDARD).withColumn("split", F.lit(split))


def ids(df):
    return sorted(r["transaction_id"] for r in df.select("transaction_id").collect())


def random_tx(spark, n=300, seed=1):
    """Times on a grid of six hours, so that many rows tie."""
    rng = random.Random(seed)
    rows = [(6 * rng.randrange(40), f"A{rng.randrange(6)}", f"A{rng.randrange(6)}", rng.randrange(1, 50)) for _ in range(n)]
    return rows, tx(spark, rows)


def test_standardize_casts_and_rejects(spark):
    raw = spark.createDataFrame(
        [
            ("2022/09/01 00:00", "001", "A1", "002", "B1", "100.00", "Euro", "120.00", "US Dollar", "ACH", "0", 1),
            ("2022/09/01 00:01", " 001", "A2", "001 ", "B2", "50.00", "US Dollar", "50.00", "US Dollar", "Wire", "1", 2),
            ("bad", "003", "A3", "004", "B3", "x", None, "75.00", "US Dollar", "ACH", "0", 3),
        ],
        "`Timestamp` string, `From Bank` string, `Account` string, `To Bank` string, `Account.1` string, `Amount Received` string, `Receiving Currency` string, `Amount Paid` string, `Payment Currency` string, `Payment Format` string, `Is Laundering` string, ord long",
    )
    got = transfers.standardize(raw, "ord").orderBy("transaction_id").collect()
    assert [r["currency_pair"] for r in got] == ["US Dollar -> Euro", "US Dollar -> US Dollar", "US Dollar -> UNKNOWN"]
    assert [r["cross_bank_flag"] for r in got] == [1, 0, 1] and got[0]["amount"] == 120.0 and got[2]["timestamp"] is None and got[2]["amount_received"] is None
    assert [r["transaction_id"] for r in transfers.standardize(raw).orderBy("sender_account_id").collect()] == [1, 2, 3]
    with pytest.raises(ValueError, match="null_timestamp"):
        transfers.validate(transfers.standardize(raw, "ord"))
    with pytest.raises(ValueError, match="amount_paid"):
        transfers.standardize(raw.drop("Amount Paid"))


def test_temporal_split(spark):
    rows = [(h, "S", "R", 1) for h in reversed(range(10))]
    got = profiling.temporal_split(tx(spark, rows).drop("split"))
    assert [r["split"] for r in got.orderBy("timestamp").collect()] == ["train"] * 6 + ["validation"] * 2 + ["test"] * 2
    assert profiling.split_non_overlap(got).first()[0]
    with pytest.raises(ValueError):
        profiling.temporal_split(tx(spark, rows), 0.5, 0.2, 0.2)


def test_open_and_closed_windows_with_ties(spark):
    d = tx(spark, [(0, "S", "R", 1), (12, "S", "R", 10), (12, "S", "R", 100), (24, "S", "R", 1000), (36, "S", "R", 10000)])
    read = lambda closed: [(r["rolling_count"], r["rolling_sum"]) for r in rolling(d, "sender_account_id", "24h", closed).orderBy("transaction_id").collect()]
    assert read(False) == [(1, 1), (2, 11), (3, 111), (3, 1110), (2, 11000)]
    assert read(True) == [(1, 1), (2, 11), (3, 111), (4, 1111), (4, 11110)]


def test_windows_match_brute_force(spark):
    rows, d = random_tx(spark)
    seq = list(enumerate(rows, 1))
    before = lambda a, b: (a[1][0], a[0]) <= (b[1][0], b[0])
    distinct = {i: len({s for j, (g, s, q, _) in seq if q == r and h - 24 <= g and before((j, (g,)), (i, (h,)))}) for i, (h, _, r, _) in seq}
    funders = {i: len({q for _, (g, q, to, _) in seq if to == s and h - 24 <= g <= h}) for i, (h, s, _, _) in seq}
    income = {i: sum(a for _, (g, _, to, a) in seq if to == s and h - 24 < g <= h) for i, (h, s, _, _) in seq}
    read = lambda df, c: {r["transaction_id"]: r[c] for r in df.collect()}
    assert read(rolling_distinct(d, "receiver_account_id", "sender_account_id", "24h"), "rolling_distinct") == distinct
    assert read(rolling_distinct(d, "receiver_account_id", "sender_account_id", "24h", "sender_account_id"), "rolling_distinct") == funders
    assert read(incoming_to_sender(d, "24h"), "incoming") == income


def test_a_hub_account_is_cut_into_slices(spark, monkeypatch):
    """Half of all rows are of one account; slices of running sums are made small."""
    monkeypatch.setattr(windows, "SLICE", 7 * 3600 * windows.MICROS)
    rng = random.Random(5)
    rows = [(6 * rng.randrange(60), "HUB" if rng.random() < 0.5 else f"A{rng.randrange(5)}", f"A{rng.randrange(9)}" if rng.random() < 0.8 else "HUB", rng.randrange(1, 50)) for _ in range(260)]
    d = tx(spark, rows)
    line = sorted((h, i, s, r, a) for i, (h, s, r, a) in enumerate(rows, 1))
    want = {}
    for n, (h, i, s, r, a) in enumerate(line):
        before = line[:n]
        mine = [x for x in before if x[2] == s]
        want[i] = (len(mine), len([x for x in before if x[3] == r]), len([x for x in mine if x[3] == r]), len({x[3] for x in mine}), len({x[2] for x in before if x[3] == r}))
    got = features.transaction_history(d).collect()
    names = ("sender_prior_txn_count", "receiver_prior_txn_count", "pair_prior_txn_count", "sender_prior_unique_receivers", "receiver_prior_unique_senders")
    assert {r["transaction_id"]: tuple(r[f"feature_{n}"] for n in names) for r in got} == want
    seen = {r["transaction_id"]: r["rolling_distinct"] for r in rolling_distinct(d, "sender_account_id", "receiver_account_id", "24h").collect()}
    assert seen == {i: len({x[3] for x in line[: n + 1] if x[2] == s and x[0] >= h - 24}) for n, (h, i, s, r, a) in enumerate(line)}
    paid = {r["transaction_id"]: (r["rolling_count"], r["rolling_sum"]) for r in rolling(d, "sender_account_id", "24h", closed=True).collect()}
    assert paid == {i: (len(w := [x[4] for x in line[: n + 1] if x[2] == s and x[0] >= h - 24]), float(sum(w))) for n, (h, i, s, r, a) in enumerate(line)}
    busiest = windows._slices(d.withColumn("_us", windows.micros()), "_us", 24 * 3600 * windows.MICROS).where("not _context").groupBy("sender_account_id", "_k").count().agg(F.max("count")).first()[0]
    assert busiest < 40


def test_ranges_follow_skewed_values(spark):
    """Of log-normal values no range holds more than four times its share."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = []
        monkey = distributed.stored
        distributed.stored = lambda df, name: held.append(monkey(df, name)) or held[-1]
        try:
            d = spark.range(20_000).select(F.exp(F.randn(3) * 2.5).alias("v"), F.lit(1).alias("n"))
            out = prefix_sums(d, [], "v", ["n"])
            assert out.where("n_before < 0").count() == 0 and out.agg(F.max("n_before")).first()[0] == 19_999
        finally:
            distributed.stored = monkey
        sizes = [r["count"] for r in held[0].groupBy("_r").count().collect()]
        assert len(sizes) > 1 and max(sizes) <= 4 * 20_000 / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_tuning_hands_on_what_it_selected(spark):
    _, d = random_tx(spark)
    d = d.withColumn("split", F.when(F.col("transaction_id") % 3 == 0, "validation").otherwise("train"))
    candidates, selected, options = rules.tune_rules(d, {"R1_AMOUNT": {"min_segment": 9}, "R3_VELOCITY": {"min_count": 2}})
    row = selected.first()
    assert candidates.count() > 1 and options["R1_AMOUNT"] == {"min_segment": 9, "percentile": row["candidate_value"]} and options["R3_VELOCITY"] == {"min_count": 2}
    assert row["candidate_value"] in {r["candidate_value"] for r in candidates.collect()}


def test_tables_and_fallbacks(spark, tmp_path):
    _, d = random_tx(spark, 20)
    for by in ((), ("split",)):
        path = f"file://{tmp_path}/{len(by)}"
        transfers.write_table(d, path, by)
        assert sorted(r["transaction_id"] for r in transfers.read_table(spark, path).collect()) == ids(d)
    assert transfers.first_available(None, d) is d and transfers.first_available(None) is None


def test_pass_through_and_fan_in(spark):
    d = tx(spark, [(0, "F1", "A", 100), (1, "A", "B", 90), (2, "A", "C", 200), (3, "S1", "R", 25), (4, "S2", "R", 30), (5, "S3", "R", 35)])
    assert ids(rules.pass_through_rule(d)) == [2, 3]
    assert ids(rules.fan_in_rule(d, min_senders=3, percentile=0.0)) == [6]


def test_fan_out(spark):
    d = tx(spark, [(0, "F1", "A", 100), (0.5, "F2", "A", 150), (1, "A", "B", 40), (2, "A", "C", 50)])
    assert ids(rules.fan_out_rule(d, min_receivers=2, min_funders=2)) == [4]


def test_novelty_is_decided_before_the_bank_filter(spark):
    d = tx(spark, [(0, "S", "R", 1), (1, "S", "R", 1), (2, "S", "Q", 1)]).withColumn("cross_bank_flag", F.when(F.col("transaction_id") == 1, 0).otherwise(1))
    assert ids(rules.novelty_rule(d)) == [3] and ids(rules.novelty_rule(d, cross_bank=False)) == [1, 3]


def test_alerts_consolidate_rules(spark):
    d = tx(spark, [(0, "S1", "R1", 10), (1, "S1", "R2", 100), (2, "S2", "R2", 200)])
    hits = rules.run_rules(d, ["R1_AMOUNT", "R2_NOVELTY"], {"R1_AMOUNT": {"percentile": 0.5, "min_segment": 1}})
    got = {r["transaction_id"]: r for r in rules.alerts(hits).collect()}
    assert len(got) == 3 and got[2]["triggered_rules"] == "R1_AMOUNT,R2_NOVELTY" and got[2]["rule_priority_score"] == pytest.approx(2.1)
    assert got[1]["queue_eligible"] is False and got[2]["queue_eligible"] and got[2]["coverage_rule_count"] == 1
    assert '"threshold_source":"segment"' in hits.where("rule_id = 'R1_AMOUNT'").first()["threshold_json"]
    m = {(r["split"], r["rule_id"]): r for r in rules.rule_performance(d, hits).collect()}
    assert m[("train", "ANY_RULE")]["recall"] == 1.0 and m[("train", "R1_AMOUNT")]["false_negatives"] == 1


def test_rules_without_rows(spark):
    none = tx(spark, [(0, "S", "R", 1)]).where("false")
    hits = rules.run_rules(none)
    assert hits.count() == 0 and rules.alerts(hits).count() == 0 and profiling.temporal_split(none.drop("split")).count() == 0


def test_select_candidate(spark):
    rows = [(0.95, 0.9, 0.3), (0.99, 0.85, 0.1), (0.995, 0.5, 0.05)]
    d = spark.createDataFrame(rows, "candidate_value double, recall double, alert_rate double")
    assert rules.select_candidate(d, 0.8).first()["candidate_value"] == 0.99
    low = rules.select_candidate(d, 0.95).first()
    assert low["candidate_value"] == 0.95 and low["selection_reason"].startswith("guardrail_not_met")


def test_metrics(spark):
    d = spark.createDataFrame([("a", 1, 1, 0.9), ("b", 0, 1, 0.8), ("c", 1, 0, 0.3), ("d", 0, 0, 0.1)], "id string, y int, p int, s double")
    m = binary_metrics(d, "y", "p").first()
    assert (m["precision"], m["recall"], m["alert_rate"], m["f1"]) == (0.5, 0.5, 0.5, 0.5)
    k = top_k(d, "y", "s", [2, 100], "id").orderBy("k").collect()
    assert (k[0]["precision_at_k"], k[0]["recall_at_k"], k[0]["lift_at_k"]) == (0.5, 0.5, 1.0) and k[1]["reviewed_alerts"] == 4
    assert average_precision(d, "y", "s").first()[0] == pytest.approx(0.5 + 0.5 * 2 / 3)
    assert roc_auc(d, "y", "s").first()[0] == pytest.approx(0.75)
    assert average_precision(d.where("y = 1"), "y", "s").first()[0] == 0.0 and roc_auc(d.where("y = 1"), "y", "s").first()[0] == 0.0


def test_prefix_sums_and_quantiles(spark):
    rng = random.Random(2)
    rows = [(g, float(rng.randrange(30))) for g in "aab" for _ in range(60)] + [(None, 5.0), ("c", None)]
    d = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["p"]): r["quantile"] for r in quantiles(d, "v", [0.0, 0.33, 0.5, 1.0], ["g"]).collect()}
    for g in ("a", "b", None):
        v = sorted(x for k, x in rows if k == g and x is not None)
        for p in (0.0, 0.33, 0.5, 1.0):
            at = (len(v) - 1) * p
            lo, hi = v[int(at)], v[min(len(v) - 1, int(at) + 1)]
            assert got[(g, p)] == pytest.approx(lo + (hi - lo) * (at - int(at)))
    assert ("c", 0.5) not in got
    n = spark.range(1000).select((F.col("id") * F.col("id")).alias("o"), F.lit(1).alias("x"))
    assert [r["x_before"] for r in prefix_sums(n, [], "o", ["x"]).orderBy("o").collect()] == list(range(1000))


def scored(spark, n=10):
    rows = [(f"A{i}", "R1_AMOUNT,R3_VELOCITY", "coverage,escalation", "high", 2, i / 10, i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "alert_id string, triggered_rules string, rule_statuses string, max_rule_severity string, rule_count int, model_score double, is_laundering int")


def test_bands_respect_caps(spark):
    a = scored(spark)
    d = bands.capacity_caps(bands.p1_overrides(bands.bands_v2(a.drop("model_score"), a), min_score=None), p1=2)
    got = d.collect()
    assert sum(r["priority_band_v2"] == "P1" for r in got) <= 2 and all(0 <= r["risk_score_1000"] <= 1000 for r in got)
    order = sorted(got, key=lambda r: r["model_score"])
    assert [r["risk_score_1000"] for r in order] == sorted(r["risk_score_1000"] for r in order) and order[-1]["risk_score_1000"] == 1000


def test_critical_rules_are_p1(spark):
    a = scored(spark).withColumn("triggered_rules", F.when(F.col("alert_id") == "A0", "R4_PASS_THROUGH").otherwise("R1_AMOUNT"))
    got = {r["alert_id"]: r["priority_band"] for r in bands.assign_bands(a).collect()}
    assert got["A0"] == "P1" and got["A9"] == "P1" and got["A1"] == "P4"
    s = bands.summarize_bands(bands.assign_bands(a), label="is_laundering").collect()
    assert [r["priority_band"] for r in s] == ["P1", "P2", "P3", "P4"] and sum(r["alert_count"] for r in s) == 10

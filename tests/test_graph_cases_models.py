"""Network features against brute force, cases, diagnostics, explanations and models."""

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.graphs import connected_components
from tidewatch.operators import cases, diagnostics, explain, features, graph, models, rules
from tidewatch.schemas import RULE_HITS

from .test_rules_and_windows import ids, random_tx, tx


class Union:
    def __init__(self):
        self.up, self.n = {}, {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        self.n.setdefault(x, 1)
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[b] = a
            self.n[a] += self.n[b]
        return self.n[a]


def test_component_sizes_replay_union_find(spark):
    rng = random.Random(3)
    rows = [(h, f"A{rng.randrange(60)}", f"A{rng.randrange(60)}", 1) for h in range(80)]
    u, want = Union(), {}
    for i, (_, s, r, _) in enumerate(rows, 1):
        want[i] = u.join(s, r)
    got = {r["transaction_id"]: r["graph_component_size"] for r in graph.component_sizes(tx(spark, rows)).collect()}
    assert got == want


def _sizes(rows):
    u = Union()
    return {i: u.join(s, r) for i, (_, s, r, _) in enumerate(rows, 1)}


def test_component_sizes_of_chains_stars_and_odd_rows(spark):
    """Long chains in bad orders, a hub, pairs that merge late, transfers to oneself, and accounts without a name."""
    rng = random.Random(6)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    star = [("hub", f"s{i}") for i in range(40)]
    pairs = [(f"p{i}", f"q{i}") for i in range(20)] + [(f"q{i}", f"p{i + 1}") for i in range(19)]
    links = chain[::-1] + star + pairs + [("x", "x"), ("x", "y"), ("y", "y"), ("s3", "c001"), ("s3", "c001"), ("q3", "hub")]
    for order in (links, rng.sample(links, len(links))):
        rows = [(h, s, r, 1) for h, (s, r) in enumerate(order)]
        got = {r["transaction_id"]: r["graph_component_size"] for r in graph.component_sizes(tx(spark, rows)).collect()}
        assert got == _sizes(rows)
    assert graph.component_sizes(tx(spark, [(0, None, "a", 1), (1, "a", None, 1)])).count() == 0
    assert graph.component_sizes(tx(spark, [])).count() == 0


def test_one_giant_component_is_no_task_s(spark, monkeypatch):
    """All accounts end in one component: rounds are few, and the ranges that its rows are counted in are many."""
    rng = random.Random(9)
    rows = [(h, f"A{rng.randrange(400)}", f"A{rng.randrange(400)}", 1) for h in range(3000)]
    names, keep = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, name: names.append(name) or keep(df, name))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        ranges = []
        sums = graph.prefix_sums
        monkeypatch.setattr(graph, "prefix_sums", lambda df, by, order, values: ranges.append(df.repartitionByRange(*by, order).groupBy(F.spark_partition_id()).count().collect()) or sums(df, by, order, values))
        got = {r["transaction_id"]: r["graph_component_size"] for r in graph.component_sizes(tx(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == _sizes(rows) and max(got.values()) > 380
    assert names.count("forest-best") <= 9  # 2 ** 9 > 400
    counts = [r["count"] for r in ranges[0]]
    assert max(counts) < 0.25 * sum(counts)


def test_merge_levels_give_the_heaviest_link(spark):
    """The least weight by which two accounts are connected is that at their first common node."""
    rng = random.Random(2)
    pairs = sorted({tuple(sorted(rng.sample(range(25), 2))) for _ in range(40)})
    weights = rng.sample(range(1000), len(pairs))
    edges = [(f"n{a}", f"n{b}", w) for (a, b), w in zip(pairs, weights)]
    levels = {r["account"]: {(x["level"], x["node"]): x["o"] for x in r["levels"]} for r in graph.merge_levels(spark.createDataFrame(edges, "a string, b string, o long")).collect()}
    for x in levels:
        for y in levels:
            if x < y:
                common = [max(levels[x][k], levels[y][k]) for k in levels[x].keys() & levels[y].keys()]
                u, want = Union(), None
                for a, b, w in sorted(edges, key=lambda e: e[2]):
                    u.join(a, b)
                    if u.find(x) == u.find(y):
                        want = w
                        break
                assert (min(common) if common else None) == want


def _reaches(edges, a, b, steps):
    seen = {a}
    for _ in range(steps):
        seen |= {r for s, r in edges if s in seen}
        if b in seen:
            return True
    return False


def test_cycle_flags_match_search(spark):
    rng = random.Random(4)
    rows = [(h // 2, f"A{rng.randrange(14)}", f"A{rng.randrange(14)}", 1) for h in range(70)]
    edges, want = [], {}
    for i, (_, s, r, _) in enumerate(rows, 1):
        want[i] = int(s == r or _reaches([e for e in edges if e[0] != e[1]], r, s, 3))
        edges.append((s, r))
    got = {r["transaction_id"]: r["graph_cycle_involvement"] for r in graph.cycle_flags(tx(spark, rows), 4).collect()}
    assert got == want


def test_cycles_at_hubs_list_few_rows(spark, monkeypatch):
    """Two large stars whose centres pay each other: rows written stay within four times the edges, and flags are right."""
    rng = random.Random(13)
    links = [(f"i{i}", "H") for i in range(120)] + [("H", f"o{i}") for i in range(120)] + [(f"o{i}", "G") for i in range(0, 120, 3)] + [("G", f"i{i}") for i in range(0, 120, 4)] + [("G", "H"), ("H", "G"), ("o5", "i7"), ("i7", "H")]
    rng.shuffle(links)
    written, keep = {}, graph.stored

    def counted(df, name):
        out = keep(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(graph, "stored", counted)
    got = {r["transaction_id"]: r["graph_cycle_involvement"] for r in graph.cycle_flags(tx(spark, [(h, s, r, 1) for h, (s, r) in enumerate(links)]), 4).collect()}
    edges, want = [], {}
    for i, (s, r) in enumerate(links, 1):
        want[i] = int(_reaches(edges, r, s, 3))
        edges.append((s, r))
    assert got == want and 0 < sum(want.values()) < len(want)
    assert written["cycle-steps"] <= 4 * len(links) and written["cycle-pairs"] <= 4 * len(links)  # 120 x 120 by joins at the hub


@pytest.mark.parametrize("length", [1, 2, 3, 5])
def test_cycles_of_other_lengths(spark, length):
    rng = random.Random(length)
    rows = [(h, f"A{rng.randrange(12)}", f"A{rng.randrange(12)}", 1) for h in range(30)]
    edges, want = [], {}
    for i, (_, s, r, _) in enumerate(rows, 1):
        want[i] = int(length > 1 and (s == r or _reaches([e for e in edges if e[0] != e[1]], r, s, length - 1)))
        edges.append((s, r))
    assert {r["transaction_id"]: r["graph_cycle_involvement"] for r in graph.cycle_flags(tx(spark, rows), length).collect()} == want


def test_cycle_fixture(spark):
    d = tx(spark, [(0, "A", "B", 10), (1, "B", "C", 20), (2, "C", "D", 30), (3, "D", "A", 40)])
    a = rules.alerts(rules.run_rules(d, ["R2_NOVELTY"]))
    g = {r["transaction_id"]: r for r in graph.graph_features(d, a).collect()}
    assert g[4]["graph_cycle_involvement"] == 1 and g[4]["graph_component_size"] == 4 and g[4]["graph_sender_out_degree"] == 0 and g[4]["graph_receiver_in_degree"] == 0
    c = graph.cycle_candidates(d, max_length=5, max_hours=8, min_similarity=0.2).collect()
    assert [(r["transaction_id"], r["cycle_path"], r["path_length"]) for r in c] == [(4, "D->A->B->C->D", 5)]
    assert c[0]["amount_similarity_ratio"] == 0.25 and c[0]["total_cycle_amount"] == 100 and c[0]["duration_hours"] == 3 and c[0]["cycle_retention_ratio"] == pytest.approx(40 / 60)
    far = tx(spark, [(0, "A", "B", 10), (48, "B", "C", 20), (96, "C", "D", 30), (144, "D", "A", 40)])
    assert graph.cycle_candidates(far, max_length=5, min_similarity=0.2).count() == 0
    hits = graph.graph_rules(d, graph.graph_features(d, a))
    assert '"graph_cycle_involvement":1' in hits.where("rule_id = 'GR2_CYCLE_CANDIDATE'").first()["trigger_values_json"]
    ext = graph.with_graph_features(features.alert_features(d, a, rules.run_rules(d, ["R2_NOVELTY"])), graph.graph_features(d, a, suffix="_v2"))
    assert "feature_graph_component_size_v2" in ext.columns and ext.count() == 4


def test_first_path_wins(spark):
    """Brute-force breadth-first search over prior edges, shortest first and then earliest edges."""
    rows, d = random_tx(spark, 50, seed=8)
    seq = sorted(range(len(rows)), key=lambda i: (rows[i][0], i))
    want = {}
    for at, i in enumerate(seq):
        _, s, r, _ = rows[i]
        queue, found = [(r, [r], [])], None
        while queue and not found:
            node, path, used = queue.pop(0)
            if len(path) > 2:
                continue
            for j in seq[:at]:
                if rows[j][1] == node:
                    nxt = rows[j][2]
                    if nxt == s:
                        found = [*path, nxt]
                        break
                    if nxt not in path:
                        queue.append((nxt, [*path, nxt], [*used, j]))
        if found:
            want[i + 1] = "->".join([s, *found])
    got = {r["transaction_id"]: r["cycle_path"] for r in graph.cycle_candidates(d, max_length=3, max_hours=1e6, min_similarity=0.0, max_retention=1e9).collect()}
    assert got == want


def test_connected_components(spark):
    rng = random.Random(5)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(150)]
    rng.shuffle(chain)
    edges = chain + [("x", "x"), ("y", "z"), ("z", "w")]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert {got[f"c{i:03d}"] for i in range(151)} == {"c000"} and got["x"] == "x" and got["z"] == got["y"] == "w"


def test_gather_scatter(spark):
    d = tx(spark, [(i, f"S{i}", "H", 10) for i in range(3)] + [(3 + i, "H", f"D{i}", 10) for i in range(3)] + [(9, "S0", "Z", 5)])
    hubs = graph.gather_scatter_hubs(d)
    assert [r["hub_account_id"] for r in hubs.collect()] == ["H"] and ids(graph.graph_rules_v2(d, hubs)) == [1, 2, 3, 4, 5, 6]


def _alerted(spark, rows):
    d = tx(spark, rows)
    hits = rules.run_rules(d, ["R1_AMOUNT", "R2_NOVELTY"], {"R1_AMOUNT": {"percentile": 0.0, "min_segment": 1}})
    return d, hits, rules.alerts(hits)


def test_cases_v1_and_v2(spark):
    d, _, a = _alerted(spark, [(0, "A", "B", 1), (1, "B", "C", 2), (30, "X", "Y", 3)])
    got = {r["case_id"]: (r["alert_count"], r["account_count"], r["total_amount"]) for r in cases.consolidate_cases(d, a).collect()}
    assert got == {"CASE-000001": (2, 3, 3.0), "CASE-000002": (1, 2, 3.0)}
    f = cases.case_frame(d, a)
    c = cases.case_chunks(f, max_alerts=1)
    m = cases.alert_case_mapping(f, c, cases.network_clusters(f)).collect()
    assert len(m) == 3 and len({r["alert_id"] for r in m}) == 3 and len({r["case_id"] for r in m}) == 3
    big = cases.network_clusters(f, max_component=1)
    assert big.count() == 2 and cases.alert_case_mapping(f, cases.case_chunks(f, max_component=1), big).count() == 3
    q = {r["metric"]: r["value"] for r in cases.case_quality(cases.cases_v2(c), cases.alert_case_mapping(f, c, cases.network_clusters(f))).collect()}
    assert q["case_count"] == 3 and q["max_alerts_per_case"] == 1 and q["case_reduction_ratio"] == 0


def test_evidence_that_is_not_json(spark):
    _, _, a = _alerted(spark, [(0, "A", "B", 1), (1, "C", "D", 2)])
    hits = spark.createDataFrame([(1, '{"sender_account_id": "Q"}'), (2, '{"sender_account_id": "Q"}'), (2, "broken {")], "transaction_id long, trigger_values_json string")
    assert {(r["src"], r["dst"]) for r in cases.graph_evidence_edges(a, hits).collect()} == {("ALERT-1", "ALERT-1"), ("ALERT-1", "ALERT-2")}


def test_rule_contribution(spark):
    rows = [("h1", 1, "R1", 1), ("h2", 2, "R1", 0), ("h3", 2, "R2", 0)]
    hits = spark.createDataFrame([(h, t, None, r, r, "medium", "", "", "", y, "test") for h, t, r, y in rows], RULE_HITS)
    got = {r["rule_id"]: r for r in diagnostics.rule_contribution(hits, hits.dropDuplicates(["transaction_id"])).collect()}
    assert (got["R1"]["unique_alert_count"], got["R1"]["label_count"], got["R1"]["precision"], got["R1"]["incremental_alert_count"]) == (2, 1, 0.5, 2)
    assert got["R2"]["incremental_alert_count"] == 0 and got["R2"]["overlap_rate"] == 1.0 and got["R1"]["recommended_action"] == "keep"


def test_reason_codes(spark):
    v = spark.createDataFrame([("A1", "mystery", 0.5, 1.0), ("A1", "feature_amount", -0.25, 2.0), ("A2", "feature_amount", 0.0, 2.0)], "alert_id string, feature_name string, shap_value double, feature_value double")
    d = explain.dictionary(spark, [{"feature_name": "feature_amount", "business_reason_code": "High amount", "plain_language_template": "plain", "risk_reducing_template": "lower"}])
    got = {(r["alert_id"], r["feature_name"]): r for r in explain.alert_reason_codes(v, d).collect()}
    m = got[("A1", "mystery")]
    assert m["risk_direction"] == "risk_increasing" and m["plain_language_reason"] == "A model feature increased the alert score." and m["reason_rank"] == 1
    a = got[("A1", "feature_amount")]
    assert (a["risk_direction"], a["contribution_bucket"], a["plain_language_reason"]) == ("risk_reducing", "moderate_negative", "lower")
    assert got[("A2", "feature_amount")]["plain_language_reason"] == "plain" and got[("A2", "feature_amount")]["contribution_bucket"] == "neutral"
    p = {r["feature_name"]: r["reason_code"] for r in explain.reason_codes(v.withColumn("feature_name", F.when(F.col("feature_name") == "mystery", "feature_rule_r1_amount_flag").otherwise("feature_pair_count"))).collect()}
    assert p == {"feature_rule_r1_amount_flag": "R1_AMOUNT triggered for this alert.", "feature_pair_count": "Pair Count contributed to the score."}


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        y = int(rng.random() < 0.3)
        rows.append((f"A{i}", i, "train" if i < 240 else "validation" if i < 320 else "test", y, rng.choice(["ACH", "Wire", None]), "USD -> USD", "R1_AMOUNT", rng.choice(["high", "medium"]), rng.random() + y, rng.random(), 2.0 + rng.random(), float(i)))
    d = spark.createDataFrame(rows, "alert_id string, transaction_id long, split string, target int, payment_format string, currency_pair string, triggered_rules string, max_rule_severity string, feature_signal double, feature_noise double, feature_rule_priority_score double, feature_amount double")
    return d.withColumn("alert_timestamp", F.timestamp_seconds(F.col("transaction_id"))).cache()


def test_training_end_to_end(spark, frame):
    got = models.train_and_score(frame, models.ModelOptions(trees=10, depth=4, trials=2, k=20, feature_count=4, forced_prefixes=("feature_noise",)))
    rows = got.scored.collect()
    assert len(rows) == 400 and all(0 <= r["model_score"] <= 1 for r in rows)
    table = {(r["ranking"], r["metric"], r["k"]): r["value"] for r in models.evaluate_rankings(got.scored, (20,)).collect()}
    assert table[("model_score", "roc_auc", None)] > 0.9 > table[("amount_rank", "roc_auc", None)]
    assert {r["feature_name"] for r in got.selection.where("selected").collect()} >= {"feature_signal", "feature_noise"}
    assert got.champions.where("champion").count() == 1 and got.trials.count() == 2
    again = models.train_and_score(frame, models.ModelOptions(trees=10, depth=4, trials=2, k=20, feature_count=4, forced_prefixes=("feature_noise",)))
    assert again.champion.name == got.champion.name
    imp = {r["feature_name"]: r["importance"] for r in models.permutation_importance(got.champion, models.prepare(frame)[0], repeats=1).collect()}
    assert max(imp, key=imp.get) == "feature_signal"


def test_balance_and_single_class(spark, frame):
    train = frame.where("split = 'train'")
    s = features.balanced_sample(train, 2, 100_000)
    n = {r["target"]: r["count"] for r in s.groupBy("target").count().collect()}
    assert n[0] == min(2 * n[1], train.where("target = 0").count()) and n[1] == train.where("target = 1").count()
    one = models.train_and_score(frame.where("target = 0"), models.ModelOptions())
    assert {r["model_score"] for r in one.scored.select("model_score").distinct().collect()} == {0.0}


@pytest.mark.parametrize("method", ["isotonic", "sigmoid", "identity"])
def test_calibration_is_monotone(spark, frame, method):
    d = models.calibrate(frame.withColumn("model_score", F.col("feature_signal") / 2), method)
    rows = d.orderBy("model_score").collect()
    assert {r["calibration_method"] for r in rows} == {method} and all(a["calibrated_score"] <= b["calibrated_score"] + 1e-12 for a, b in zip(rows, rows[1:], strict=False))
    few = models.calibrate(frame.where("target = 0").withColumn("model_score", F.col("feature_signal")), method)
    assert few.first()["calibration_method"] == "identity"


def test_champion_selection(spark):
    rows = [("precision_at_k", 1000, "test", 0.1, 0.2, 0.1), ("pr_auc", None, None, 0.3, 0.2, -0.1)]
    d = spark.createDataFrame(rows, "metric string, k long, split string, mvp_value double, extended_value double, delta double")
    assert models.select_champion(d).first()["selected_model"] == "extended"
    assert models.select_champion(d.where("metric = 'pr_auc'")).first()["decision"] == "keep_mvp"
    none = models.select_champion(d.where("false")).first()
    assert none["selected_model"] == "mvp" and none["delta"] == 0


def test_temporal_and_segment_stress(spark, frame):
    s = frame.withColumn("model_score", F.col("feature_signal"))
    t = diagnostics.temporal_stress(s, ks=(10,)).collect()
    assert sorted((r["window"], r["k"] or 0, r["alert_count"]) for r in t) == [("A", 0, 200), ("A", 10, 200), ("B", 0, 200), ("B", 10, 200)]
    d = frame.select("transaction_id", F.lit(1).alias("cross_bank_flag"), F.col("feature_amount").alias("amount"))
    g = {(r["segment"], r["segment_value"]): r for r in diagnostics.segment_stress(s, d).collect()}
    assert g[("amount_bucket", "q1")]["alert_count"] == 100 and ("payment_format", None) in g and g[("graph_degree_bucket", "none")]["alert_count"] == 400

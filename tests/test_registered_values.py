"""Registered queries run with the values of the whole job."""

from types import SimpleNamespace

from tidewatch.plans import registry, tables

from .test_graph_cases_models import _reaches
from .test_queries import DIR


def test_graph_features_see_cycles_of_four_steps(spark):
    rows = tables.tx(spark, DIR).orderBy("timestamp", "transaction_id").select("transaction_id", "sender_account_id", "receiver_account_id").collect()
    edges, want, short = [], {}, {}
    for i, s, r in rows:
        want[i], short[i] = (int(s == r or _reaches(edges, r, s, n)) for n in (3, 2))
        if s != r:
            edges.append((s, r))
    got = {r["transaction_id"]: r["graph_cycle_involvement"] for r in registry.QUERIES["graph_features"](spark, DIR).collect()}
    assert got == {i: want[i] for i in got}
    assert sum(short[i] for i in got) < sum(got.values())


def test_models_are_fitted_with_the_operators_own_options(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(registry.models, "train_and_score", lambda frame, *options: seen.append(options))
    monkeypatch.setattr(registry, "_fits", {})
    registry._fitted(spark, DIR)
    assert seen == [()]


def test_all_alerts_are_explained(spark, monkeypatch):
    """More alerts than the 1,000 that were once explained."""
    rows = [(f"a{i:04}", "test", i % 2, float(i), "Wire", "USD -> EUR", "high") for i in range(1200)]
    frame = spark.createDataFrame(rows, "alert_id string, split string, target int, feature_amount double, payment_format string, currency_pair string, max_rule_severity string")
    monkeypatch.setattr(registry.t, "alert_features", lambda s, d: frame)
    monkeypatch.setattr(registry, "_fitted", lambda s, d: SimpleNamespace(champion=SimpleNamespace(model=1)))
    monkeypatch.setitem(registry._weights, (spark.sparkContext.applicationId, "many"), {"feature_amount": 2.0})
    got = {r["alert_id"]: r["shap_value"] for r in registry._explained(spark, "many").collect()}
    assert got == {f"a{i:04}": 2.0 * (i - 599.5) for i in range(1200)}

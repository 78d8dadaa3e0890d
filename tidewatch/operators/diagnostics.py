"""Rule contribution, waterfall, stress tests and gates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.distributed import join_same, positions, quantile_row, ratio
from ..functions.graphs import stored
from ..functions.metrics import average_precision, top_k
from ..functions.windows import micros


def rule_contribution(hits: DataFrame, alerts: DataFrame) -> DataFrame:
    """Rules by labels, precision and volume: what each adds to the better ones, and how much it overlaps with others."""
    y = F.coalesce("is_laundering", F.lit(0))
    s = hits.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("labels"))
    # one row per rule
    s = s.withColumn("rank", F.row_number().over(W.orderBy(F.desc("labels"), F.desc(F.col("labels") / F.greatest("n", F.lit(1))), "n", "rule_id")))
    d = hits.join(F.broadcast(s.select("rule_id", "rank")), "rule_id")
    # a transaction's hits, few, are brought together once
    d = d.repartition("transaction_id").groupBy("rule_id", "rule_name", "transaction_id", "rank").agg(F.count(F.lit(1)).alias("n"), F.max(y).alias("y"))
    own = W.partitionBy("transaction_id")
    d = d.withColumns({"best": F.min("rank").over(own), "rules": F.size(F.collect_set("rule_id").over(own))})
    new = F.col("rank") == F.col("best")
    d = d.groupBy("rule_id", "rule_name", "rank").agg(
        F.sum("n").alias("alert_count"), F.count(F.lit(1)).alias("unique_alert_count"), F.sum("y").alias("label_count"),
        F.sum(F.when(new, F.col("y")).otherwise(0)).alias("incremental_label_count"), F.count_if(new).alias("incremental_alert_count"), F.sum(F.when(F.col("rules") > 1, F.col("n")).otherwise(0)).alias("overlap"),
    )
    d = d.join(F.broadcast(alerts.agg(F.coalesce(F.sum("is_laundering"), F.lit(0)).alias("total"))), how="cross")
    precision = ratio(F.col("label_count"), F.col("unique_alert_count"))
    return d.select("rule_id", "rule_name", F.col("rank").cast("long").alias("rule_rank"), "alert_count", "unique_alert_count", "label_count", precision.alias("precision"), ratio(F.col("label_count"), F.col("total")).alias("recall_contribution"), "incremental_label_count", "incremental_alert_count", ratio(F.col("overlap"), F.col("alert_count")).alias("overlap_rate")).withColumn("recommended_action", recommended_action())


def recommended_action(count: str = "unique_alert_count", precision: str = "precision", incremental: str = "incremental_label_count") -> Column:
    n, p, i = F.col(count), F.col(precision), F.col(incremental)
    return F.when(n == 0, "review").when((i == 0) & (n > 1000), "retire_candidate").when((p < 0.001) & (n > 10000), "tighten").when(p < 0.005, "downgrade").otherwise("keep")


def rule_recommendations(contribution: DataFrame) -> DataFrame:
    # fixed values: the reason for each action
    reasons = {
        "retire_candidate": "High-volume rule adds no incremental labelled alerts.",
        "tighten": "High-volume rule has very low precision.",
        "downgrade": "Rule should remain coverage-first until precision improves.",
        "keep": "Rule has acceptable labelled contribution for current guardrails.",
    }
    reason = F.create_map(*(F.lit(x) for kv in reasons.items() for x in kv))[F.col("recommended_action")]
    return contribution.select("rule_id", "unique_alert_count", "label_count", "precision", "incremental_label_count", "overlap_rate", "recommended_action", F.coalesce(reason, F.lit("Review rule contribution manually.")).alias("recommendation_reason"))


def alert_waterfall(tx: DataFrame, hits: DataFrame, alerts: DataFrame) -> DataFrame:
    """(stage, count, labels) of transactions, each rule and consolidated alerts."""
    whole = lambda df, name: df.agg(F.count(F.lit(1)).alias("count"), F.coalesce(F.sum("is_laundering"), F.lit(0)).alias("labels")).select(F.lit(name).alias("stage"), "count", "labels")
    per_rule = hits.groupBy("rule_id", "transaction_id").agg(F.max(F.coalesce("is_laundering", F.lit(0))).alias("y")).groupBy(F.col("rule_id").alias("stage")).agg(F.count(F.lit(1)).alias("count"), F.sum("y").alias("labels"))
    return whole(tx, "transactions").unionByName(per_rule).unionByName(whole(alerts, "consolidated_alerts"))


def stress_summary(tx: DataFrame, hits: DataFrame, alerts: DataFrame, banded: DataFrame, dataset: str = "LI-Small", comparison: str = "deferred_missing_dataset") -> DataFrame:
    total = lambda df, n, y: df.agg(F.count(F.lit(1)).alias(n), F.coalesce(F.sum("is_laundering"), F.lit(0)).alias(y))
    bands = banded.agg(*(F.count_if(F.col("priority_band") == b).alias(f"{b.lower()}_alert_count") for b in ("P1", "P2", "P3", "P4")))
    d = total(tx, "transaction_count", "label_count").join(total(alerts, "alert_count", "alert_label_count"), how="cross").join(hits.agg(F.count(F.lit(1)).alias("rule_hit_count")), how="cross").join(bands, how="cross")
    return d.select(F.lit(dataset).alias("dataset_name"), F.lit("LI-only").alias("comparison_scope"), F.lit(comparison).alias("hi_comparison_status"), "*", ratio(F.col("alert_count"), F.col("transaction_count")).alias("alert_rate"))


def temporal_stress(alerts: DataFrame, label: str = "target", score: str = "model_score", fraction: float = 0.5, ks: Sequence[int] = (100, 500, 1000)) -> DataFrame:
    """Each half in time (by position): average precision, and precision and recall at each k. alert_rate is always 1."""
    d = positions(alerts.select("alert_id", label, score, micros("alert_timestamp").alias("_us")), "_us", ["alert_id"])
    n = alerts.agg(F.count(F.lit(1)).alias("_n"))
    cut = F.when(F.col("_n") > 1, F.greatest(F.lit(1), F.least(F.col("_n") - 1, F.floor(F.col("_n") * fraction)))).otherwise(F.col("_n"))
    d = d.join(F.broadcast(n), how="cross").withColumn("window", F.when(F.col("position") < cut, "A").otherwise("B"))
    d = stored(d.select("alert_id", label, score, "window"), "halves")
    areas_of, rows = stored(average_precision(d, label, score, ["window"]), "halves-areas"), []
    for w in ("A", "B"):
        part = d.where(F.col("window") == w)
        area = areas_of.where(F.col("window") == w).agg(F.coalesce(F.max("pr_auc"), F.lit(0.0)).alias("pr_auc"))
        base = part.agg(F.count(F.lit(1)).alias("alert_count"), F.coalesce(F.sum(label), F.lit(0)).alias("label_count")).join(area, how="cross")
        base = base.select(F.lit(w).alias("window"), "alert_count", "label_count", F.lit(1.0).alias("alert_rate"), "pr_auc")
        at = top_k(part, label, score, ks, "alert_id").select("k", "precision_at_k", "recall_at_k")
        rows += [base.select("*", F.lit(None).cast("long").alias("k"), F.lit(None).cast("double").alias("precision_at_k"), F.lit(None).cast("double").alias("recall_at_k")), base.join(at, how="cross")]
    return reduce(DataFrame.unionByName, rows)


def segment_stress(alerts: DataFrame, tx: DataFrame, label: str = "target", score: str = "model_score", segments: Sequence[str] = ("payment_format", "currency_pair", "cross_bank_flag", "amount_bucket", "graph_degree_bucket"), min_alerts: int = 10, k: int = 100) -> DataFrame:
    """Every value of every segment: alerts, labels, precision at k and average precision. Amounts are cut at their
    quartiles (equal edges are one), degrees (sum of feature_graph*degree* columns) at 0 and 5."""
    own = [c for c in ("payment_format", "currency_pair", "cross_bank_flag", "amount") if c not in alerts.columns]
    d = alerts.join(tx.select("transaction_id", *own).dropDuplicates(["transaction_id"]), "transaction_id", "left").withColumn("_a", F.coalesce("amount", F.lit(0.0)))
    d = d.join(F.broadcast(quantile_row(d, "_a", {"_q1": 0.25, "_q2": 0.5, "_q3": 0.75}, 0.0)), how="cross")
    bucket = F.when(F.col("_a") <= F.col("_q1"), "q1").when(F.col("_a") <= F.col("_q2"), "q2").when(F.col("_a") <= F.col("_q3"), "q3").otherwise("q4")
    degrees = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in alerts.columns if c.startswith("feature_graph") and "degree" in c]
    degree = reduce(lambda a, b: a + b, degrees, F.lit(0.0))
    d = d.withColumns({"amount_bucket": bucket, "graph_degree_bucket": F.when(degree <= 0, "none").when(degree <= 5, "low").otherwise("high")})
    pairs = F.explode(F.array(*(F.struct(F.lit(s).alias("segment"), F.col(s).cast("string").alias("segment_value")) for s in segments)))
    d = d.select("alert_id", F.coalesce(F.col(label), F.lit(0)).alias("y"), F.coalesce(F.col(score), F.lit(0.0)).alias("s"), *segments)
    d = stored(d, "segments").select("alert_id", "y", "s", pairs.alias("p")).select("alert_id", "y", "s", "p.*")
    by = ["segment", "segment_value"]
    sizes = d.groupBy(*by).agg(F.count(F.lit(1)).alias("alert_count"), F.sum("y").alias("label_count"))
    # the best k of a group are kept in two steps, so that a large segment is not ranked in one task
    parts = W.partitionBy(*by, F.pmod(F.xxhash64("alert_id"), F.lit(32))).orderBy(F.desc("s"), "alert_id")
    best = d.withColumn("i", F.row_number().over(parts)).where(F.col("i") <= k)
    best = best.withColumn("i", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("s"), "alert_id"))).where(F.col("i") <= k)
    best = best.groupBy(*by).agg(F.sum("y").alias("hits"))
    out = join_same(join_same(sizes, best, by), average_precision(d, "y", "s", by), by)
    return out.select(*by, F.when(F.col("alert_count") < min_alerts, "small_segment").otherwise("measured").alias("status"), "alert_count", "label_count", ratio(F.col("hits"), F.least(F.col("alert_count"), F.lit(k))).alias(f"precision_at_{k}"), "pr_auc")


def _ladder(value: Column, green: float, amber: float) -> Column:
    return F.when(value.isNull(), "red").when(value <= green, "green").when(value <= amber, "amber").otherwise("red")


def traffic_lights(band_summary: DataFrame, stress: DataFrame, comparison: DataFrame, ablation: DataFrame, cases: DataFrame, reasons: DataFrame, temporal: DataFrame, segment: DataFrame) -> DataFrame:
    """(area, status, evidence) of the gates, from metric tables; a table without rows gets the status that says so."""
    one = lambda df, **cols: df.agg(*(c.alias(n) for n, c in cols.items()))
    rows = F.count(F.lit(1))
    p = one(band_summary, p_rows=rows, p1=F.coalesce(F.max(F.when(F.col("priority_band") == "P1", F.col("alert_count"))), F.lit(0)))
    s = one(stress, rate=F.max("alert_rate"))
    key = (F.col("metric") == "precision_at_k") & (F.coalesce("k", F.lit(0)) == 1000)
    c = one(comparison, delta=F.max(F.when(key, F.col("delta"))), before=F.max(F.when(key, F.col("mvp_value"))))
    a = one(ablation, a_rows=rows, removed=F.count_if(F.col("decision") == "remove"), research=F.count_if(F.col("decision") == "research_only"))
    q = one(cases, q_rows=rows, size=F.coalesce(F.max(F.when(F.col("metric") == "max_alerts_per_case", F.col("value"))), F.lit(0.0)))
    r = one(reasons, r_rows=rows)
    t = one(temporal, t_rows=rows).join(one(segment, s_rows=rows, small=F.avg(F.when(F.col("status") == "small_segment", 1.0).otherwise(0.0))), how="cross")
    d = reduce(lambda x, y: x.join(y, how="cross"), (p, s, c, a, q, r, t))
    uplift = ratio(F.col("delta"), F.col("before"))
    status = {
        "Alert rate": (F.when(F.col("rate").isNull(), "amber").otherwise(_ladder(F.col("rate"), 0.15, 0.30)), "Overall alert rate against remediation target."),
        "P1 sizing": (F.when(F.col("p_rows") == 0, "red").otherwise(_ladder(F.col("p1"), 120, 240)), "Operational priority queue size after v2 banding."),
        "Top-K uplift": (F.when(F.col("delta").isNull(), "red").when(uplift >= 0.05, "green").when(uplift >= 0, "amber").otherwise("red"), "Champion/challenger Precision@1000 delta."),
        "Graph features": (F.when(F.col("a_rows") == 0, "amber").when(F.col("removed") > 0, "red").when(F.col("research") > 0, "amber").otherwise("green"), "Graph ablation decision."),
        "Case consolidation": (F.when(F.col("q_rows") == 0, "red").otherwise(_ladder(F.col("size"), 100, 200)), "Operational case size cap check."),
        "Explainability": (F.when(F.col("r_rows") > 0, "green").otherwise("red"), "Business-readable alert reason codes."),
        "Stress testing": (F.when((F.col("t_rows") == 0) | (F.col("s_rows") == 0) | (F.col("small") > 0.75), "amber").otherwise("green"), "LI temporal and segment stress outputs."),
        "Report automation": (F.lit("green"), "Remediation report generated from local artifacts."),
    }
    return d.select(F.explode(F.array(*(F.struct(F.lit(n).alias("area"), v.alias("status"), F.lit(e).alias("evidence")) for n, (v, e) in status.items()))).alias("x")).select("x.*")


def champion_decision(comparison: DataFrame, findings: DataFrame) -> DataFrame:
    """One row: promoted only with 5 % relative uplift of precision at 1000 and no red gate."""
    key = (F.col("metric") == "precision_at_k") & (F.coalesce("k", F.lit(0)) == 1000)
    c = comparison.agg(F.coalesce(F.max(F.when(key, F.col("delta"))), F.lit(0.0)).alias("delta"), F.coalesce(F.max(F.when(key, F.col("mvp_value"))), F.lit(0.0)).alias("before"))
    gates = lambda red: F.array_join(F.array_sort(F.collect_list(F.when((F.col("status") == "red") == F.lit(red), F.col("area")))), ",")
    d = c.join(findings.agg(gates(True).alias("failed_gates"), gates(False).alias("passed_gates")), how="cross").withColumn("uplift", ratio(F.col("delta"), F.col("before")))
    ready = (F.col("uplift") >= 0.05) & (F.col("failed_gates") == "")
    return d.select(F.when(ready, "extended").otherwise("mvp").alias("champion_model"), F.lit("extended").alias("challenger_model"), F.when(ready, "promote_extended").otherwise("keep_mvp").alias("decision"), ready.alias("promotion_ready"), F.when(ready, "Extended model passed remediation gates.").otherwise("MVP retained until remediation gates pass.").alias("primary_reason"), "failed_gates", "passed_gates", F.col("delta").alias("precision_at_1000_delta"), F.col("uplift").alias("precision_at_1000_relative_uplift"))


def headline_kpis(quality: DataFrame, performance: DataFrame, model_pr_auc: DataFrame, bands: DataFrame, cases: DataFrame) -> DataFrame:
    """One row: transactions, label rate, best ANY_RULE recall, average precision, P1 alerts and cases."""
    recall = performance.where("rule_id = 'ANY_RULE'").agg(F.coalesce(F.max("recall"), F.lit(0.0)).alias("rule_recall"))
    p1 = bands.agg(F.coalesce(F.sum(F.when(F.col("priority_band") == "P1", F.col("alert_count"))), F.lit(0)).alias("p1_alerts"))
    parts = [quality.select(F.col("row_count").alias("transactions"), "label_rate"), recall, model_pr_auc.select(F.col("pr_auc").alias("model_pr_auc")), p1, cases.agg(F.count(F.lit(1)).alias("case_count"))]
    return reduce(lambda a, b: a.join(b, how="cross"), parts)

"""Cases: linked alerts, capped chunks, typologies and their metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.distributed import positions, quantile_row, ratio
from ..functions.graphs import connected_components, stored
from ..functions.windows import neighbours
from .rules import severity_rank

_CLUSTER_REASON = "component_exceeded_operational_case_cap"


def _chain(named: DataFrame) -> DataFrame:
    """(src, dst): neighbours in alert order among the distinct alerts of an account; a lone alert points to itself."""
    d = named.where("account is not null").distinct()
    d = neighbours(d, ["account"], ["alert_id"], "alert_id", before="before")
    return d.select(F.coalesce("before", "alert_id").alias("src"), F.col("alert_id").alias("dst")).distinct()


def alert_link_edges(tx: DataFrame, alerts: DataFrame) -> DataFrame:
    d = alerts.select("alert_id", "transaction_id").join(tx.select("transaction_id", "sender_account_id", "receiver_account_id"), "transaction_id", "left")
    return _chain(d.select("alert_id", F.explode(F.array("sender_account_id", "receiver_account_id")).alias("account")))


def graph_evidence_edges(alerts: DataFrame, graph_hits: DataFrame) -> DataFrame:
    """Chains of alerts whose graph evidence names the same account; evidence that isn't JSON names none."""
    d = graph_hits.select("transaction_id", F.explode(F.array(*(F.get_json_object("trigger_values_json", f"$.{c}") for c in ("sender_account_id", "receiver_account_id")))).alias("account"))
    return _chain(alerts.select("alert_id", "transaction_id").join(d.where("account <> ''"), "transaction_id").select("alert_id", "account"))


def case_ids(components: DataFrame) -> DataFrame:
    """(alert_id, case_id) from (node, component): CASE-000001, ... by smallest alert."""
    ids = positions(components.select("component").distinct(), "component", ["component"]).withColumn("i", F.col("position") + 1)
    return components.join(ids, "component").select(F.col("node").alias("alert_id"), F.format_string("CASE-%06d", "i").alias("case_id"))


def linked_cases(tx: DataFrame, alerts: DataFrame, graph_hits: DataFrame | None = None) -> DataFrame:
    edges = alert_link_edges(tx, alerts)
    if graph_hits is not None:
        edges = edges.unionByName(graph_evidence_edges(alerts, graph_hits))
    own = alerts.select(F.col("alert_id").alias("src"), F.col("alert_id").alias("dst"))
    return case_ids(connected_components(edges.unionByName(own)))


def consolidate_cases(tx: DataFrame, alerts: DataFrame, scored: DataFrame | None = None, graph_hits: DataFrame | None = None) -> DataFrame:
    """One row per case of linked alerts."""
    d = alerts.select("alert_id", "transaction_id", "max_rule_severity").join(linked_cases(tx, alerts, graph_hits), "alert_id")
    d = d.join(tx.select("transaction_id", "sender_account_id", "receiver_account_id", "amount"), "transaction_id", "left")
    d = d.join(scored.select("alert_id", "model_score"), "alert_id", "left") if scored is not None else d.withColumn("model_score", F.lit(0.0))
    score = F.coalesce("model_score", F.lit(0.0))
    accounts = F.array_sort(F.array_union(F.collect_set("sender_account_id"), F.collect_set("receiver_account_id")))
    d = d.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("alert_count"), accounts.alias("a"), F.sum(F.coalesce("amount", F.lit(0.0)).cast("decimal(28,6)")).cast("double").alias("total_amount"),
        F.max_by("max_rule_severity", severity_rank("max_rule_severity")).alias("max_severity"), F.avg(score).alias("avg_model_score"), F.max(score).alias("max_model_score"),
        F.array_join(F.array_sort(F.collect_list("alert_id")), ",").alias("linked_alert_ids"),
    )
    return d.select("case_id", "alert_count", F.size("a").cast("long").alias("account_count"), "total_amount", "max_severity", "avg_model_score", "max_model_score", "linked_alert_ids", F.array_join("a", ",").alias("linked_accounts"))


def _long(df: DataFrame) -> DataFrame:
    """(metric, value) from one row of numbers."""
    return df.select(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in df.columns)).unpivot([], df.columns, "metric", "value")


def case_metrics(cases: DataFrame) -> DataFrame:
    return _long(cases.agg(F.count(F.lit(1)).alias("case_count"), F.avg("alert_count").alias("avg_alerts_per_case"), F.max("alert_count").alias("max_alerts_per_case"), F.avg("account_count").alias("avg_accounts_per_case")))


def case_link_key(rules: str = "triggered_rules", payment: str = "payment_format", band: str | None = None, time: str = "alert_timestamp") -> Column:
    """First rule | payment format | band (P4 without one) | day."""
    b = F.coalesce(F.col(band), F.lit("P4")) if band else F.lit("P4")
    return F.concat_ws("|", F.split(F.coalesce(rules, F.lit("unknown")), ",")[0], F.coalesce(payment, F.lit("unknown")), b, F.date_format(time, "yyyy-MM-dd"))


def case_frame(tx: DataFrame, alerts: DataFrame, scored: DataFrame | None = None, band: str | None = None) -> DataFrame:
    """Alerts with their transaction's accounts, amount and format, optional score and band, and link_key."""
    d = alerts.join(tx.select("transaction_id", "sender_account_id", "receiver_account_id", "amount", "payment_format"), "transaction_id", "left")
    if scored is not None:
        d = d.join(scored.select("alert_id", *(c for c in ("model_score", "calibrated_score", band) if c and c in scored.columns)).dropDuplicates(["alert_id"]), "alert_id", "left")
    return d.withColumn("link_key", case_link_key(band=band))


def link_key_stats(frame: DataFrame) -> DataFrame:
    """(link_key, component_size, alert_count, account_count); the size is the larger of alerts and distinct accounts."""
    both = frame.select("link_key", "alert_id", F.explode(F.array("sender_account_id", "receiver_account_id")).alias("account"))
    accounts = both.where("account is not null").groupBy("link_key").agg(F.count_distinct("account").alias("account_count"))
    n = frame.groupBy("link_key").agg(F.count(F.lit(1)).alias("alert_count"))
    d = n.join(accounts, "link_key", "left").na.fill(0, ["account_count"])
    return d.select("link_key", F.greatest("alert_count", "account_count").alias("component_size"), "alert_count", "account_count")


def case_chunks(frame: DataFrame, max_alerts: int = 100, max_accounts: int = 50, max_transactions: int = 100, max_component: int = 1000, stats: DataFrame | None = None) -> DataFrame:
    """Alerts of keys within the cap, with case_chunk and case_id (CASEV2-000001, ... by key and chunk). `stats` is what
    `link_key_stats` gives, where it is at hand."""
    chunk = max(1, min(max_alerts, max_transactions, max(1, max_accounts // 2)))
    small = (link_key_stats(frame) if stats is None else stats).where(F.col("component_size") <= max_component)
    d = frame.join(small, "link_key", "left_semi")
    # a key holds at most max_component alerts here
    position = F.row_number().over(W.partitionBy("link_key").orderBy("alert_timestamp", "alert_id")) - 1
    d = d.withColumn("case_chunk", F.floor(position / chunk).cast("long"))
    # a key's number of alerts tells its chunks
    of_key = small.select("link_key", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("alert_count") - 1) / chunk).cast("long"))).alias("case_chunk"))
    ids = positions(of_key, "link_key", ["case_chunk"]).withColumn("i", F.col("position") + 1).drop("position")
    return d.join(ids, ["link_key", "case_chunk"]).withColumn("case_id", F.format_string("CASEV2-%06d", "i")).drop("i")


def network_clusters(frame: DataFrame, max_component: int = 1000, stats: DataFrame | None = None) -> DataFrame:
    """Keys beyond the cap, for intelligence only. `stats` is what `link_key_stats` gives, where it is at hand."""
    d = (stored(link_key_stats(frame), "link-keys") if stats is None else stats).where(F.col("component_size") > max_component)
    d = positions(d, "link_key", ["link_key"]).withColumn("network_cluster_id", F.format_string("NETCLUSTER-%06d", F.col("position") + 1)).drop("position")
    return d.withColumns({"split_reason": F.lit(_CLUSTER_REASON), "recommended_use": F.lit("network_intelligence_only")})


def alert_case_mapping(frame: DataFrame, chunks: DataFrame, clusters: DataFrame) -> DataFrame:
    """Every alert once: its case, or its cluster with the reason."""
    cases = chunks.select("alert_id", "transaction_id", "case_id", F.lit("").alias("network_cluster_id"), F.lit("operational_case").alias("mapping_type"), F.lit("same_typology_priority_time_chunk_capped").alias("mapping_reason"))
    rest = frame.join(clusters.select("link_key", "network_cluster_id"), "link_key")
    return cases.unionByName(rest.select("alert_id", "transaction_id", F.lit("").alias("case_id"), "network_cluster_id", F.lit("network_intelligence_only").alias("mapping_type"), F.lit(_CLUSTER_REASON).alias("mapping_reason")))


def case_typology(rules: Column) -> Column:
    """The first typology whose keyword the rules contain."""
    r = F.upper(rules)
    # fixed values: typologies by keyword, in order
    kinds = [("Cycle", ("CYCLE",)), ("Gather-scatter", ("GATHER", "SCATTER")), ("Fan-in", ("R5", "FAN_IN")), ("Fan-out", ("R6", "FAN_OUT")), ("Pass-through", ("R4", "PASS")), ("Structuring", ("R3", "VELOCITY")), ("High amount", ("R1", "AMOUNT"))]
    out = F.lit("Mixed")
    for name, words in reversed(kinds):
        has = r.contains(words[0])
        for w in words[1:]:
            has = has | r.contains(w)
        out = F.when(has, name).otherwise(out)
    return out


def cases_v2(chunks: DataFrame, band: str | None = None) -> DataFrame:
    """One row per chunked case. An overflow band ranks as P2; account_count is senders plus receivers."""
    score = next((c for c in ("calibrated_score", "model_score") if c in chunks.columns), None)
    value = F.coalesce(F.col(score), F.lit(0.0)) if score else F.lit(0.0)
    rank = F.create_map(*(F.lit(x) for kv in {"P1": 1, "P1_overflow": 2, "P2": 2, "P3": 3, "P4": 4}.items() for x in kv))
    d = chunks.withColumns({"_rank": F.coalesce(rank[F.col(band)], F.lit(4)) if band else F.lit(4), "_y": F.coalesce("is_laundering", F.lit(0))})
    d = d.groupBy("case_id").agg(
        F.min("alert_timestamp").alias("case_created_at"), F.max("alert_timestamp").alias("case_end_at"), F.max(value).alias("case_score"),
        F.count("alert_id").alias("alert_count"), F.count_distinct("transaction_id").alias("transaction_count"),
        F.sum(F.col("amount").cast("decimal(28,6)")).cast("double").alias("total_amount"), F.max("amount").alias("max_transaction_amount"),
        F.min_by("triggered_rules", F.struct("alert_timestamp", "alert_id")).alias("rule_ids"), F.max("_y").alias("has_laundering_label"), F.sum("_y").alias("label_count"),
        (F.count_distinct("sender_account_id") + F.count_distinct("receiver_account_id")).alias("account_count"), F.min("_rank").alias("r"),
    )
    return d.withColumns({"case_priority_band": F.concat(F.lit("P"), F.col("r").cast("string")), "case_rationale": F.concat(F.col("alert_count").cast("string"), F.lit(" linked alert(s) grouped by pair, typology, and time window.")), "case_typology": case_typology(F.col("rule_ids"))}).drop("r")


def case_typology_summary(cases: DataFrame) -> DataFrame:
    return cases.groupBy("case_typology").agg(F.count(F.lit(1)).alias("case_count"))


def case_quality(cases: DataFrame, mapping: DataFrame) -> DataFrame:
    """Nine metrics in long form. case_recall is 1 if any case has a label, as it has always been reported."""
    n, y = F.count(F.lit(1)), F.col("has_laundering_label") > 0
    p1 = F.col("case_priority_band") == "P1"
    d = cases.agg(n.alias("n"), F.avg("alert_count").alias("avg"), F.max("alert_count").alias("max"), F.count_if(y).alias("y"), F.coalesce(F.sum("label_count"), F.lit(0)).alias("labels"), F.count_if(p1).alias("p1"), F.count_if(p1 & y).alias("p1y"))
    d = d.join(quantile_row(cases, "alert_count", {"p95": 0.95}, 0.0), how="cross").join(mapping.agg(n.alias("alerts")), how="cross")
    return _long(d.select(
        F.col("n").alias("case_count"), F.col("avg").alias("avg_alerts_per_case"), F.col("p95").alias("p95_alerts_per_case"), F.col("max").alias("max_alerts_per_case"),
        ratio(F.col("y"), F.col("n")).alias("case_precision"), F.when(F.col("labels") > 0, 1.0).otherwise(0.0).alias("case_recall"),
        F.when(F.col("alerts") > 0, 1 - F.col("n") / F.col("alerts")).otherwise(0.0).alias("case_reduction_ratio"), F.col("p1").alias("p1_case_count"), ratio(F.col("p1y"), F.col("p1")).alias("p1_case_precision"),
    ))


def mega_clusters(links: DataFrame, max_component: int = 1000, component: str = "component_id") -> DataFrame:
    """Components of more links than that, numbered in order (NET-000001, ...): size, alerts, accounts, and what for."""
    account = F.max("account_count") if "account_count" in links.columns else F.lit(0)
    sizes = links.where(F.col(component).isNotNull()).groupBy(component).agg(F.count(F.lit(1)).alias("component_size"), F.count_distinct("alert_id").alias("alert_count"), account.cast("long").alias("account_count"))
    big = positions(stored(sizes.where(F.col("component_size") > max_component), "mega-sizes"), component, [component])
    big = big.withColumn("network_cluster_id", F.format_string("NET-%06d", F.col("position") + 1)).drop("position")
    # fixed values: the reason and the use of a cluster
    return big.withColumns({"split_reason": F.lit("component_exceeds_auto_case_cap"), "recommended_use": F.lit("network_intelligence_only")})


def split_mega_components(links: DataFrame, order: str, tie: list[str], max_alerts: int = 100, max_component: int = 1000, component: str = "component_id") -> DataFrame:
    """Adds case_chunk (from 1, in the given order) and network_cluster_id (null unless the component is a mega cluster).

    Positions in a component come from ranges, so a giant one is sorted in many tasks."""
    big = mega_clusters(links, max_component, component).select(F.col(component).alias("_c"), "network_cluster_id")
    d = positions(links, order, tie, [component]).withColumn("case_chunk", (F.floor(F.col("position") / max_alerts) + 1).cast("long"))
    return d.drop("position").join(big, F.col(component).eqNullSafe(F.col("_c")), "left").drop("_c")

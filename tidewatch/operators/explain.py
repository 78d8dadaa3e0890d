"""Contributions of features to scores, and reason codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Phrases for features.
PHRASES = {
    "feature_amount": "Large transaction amount contributed to the score.",
    "feature_log_amount": "High transformed amount contributed to the score.",
    "feature_rule_count": "Multiple rules triggered for this alert.",
    "feature_rule_priority_score": "High deterministic rule priority contributed to the score.",
    "feature_max_rule_severity_ord": "A severe rule trigger contributed to the score.",
    "feature_graph_cycle_involvement": "Short-cycle graph evidence contributed to the score.",
    "feature_graph_component_size": "Large linked account component contributed to the score.",
    "feature_graph_sender_out_degree": "Sender had prior outgoing links to multiple receivers.",
    "feature_graph_receiver_in_degree": "Receiver had prior incoming links from multiple senders.",
}
#: What an unknown feature is described with.
UNKNOWN = {
    "business_reason_code": "Model feature contributed to risk score",
    "plain_language_template": "A model feature contributed to the alert score.",
    "risk_increasing_template": "A model feature increased the alert score.",
    "risk_reducing_template": "A model feature reduced the alert score.",
    "contextual_template": "A model feature provided context for the alert score.",
    "investigator_note": "Review transaction context and linked rule evidence.",
}
#: The reason-code dictionary.
ENTRIES = [
    {
        "feature_name": "feature_amount",
        "business_reason_code": "High transaction amount",
        "plain_language_template": "The transaction amount is high relative to the alert population.",
        "risk_increasing_template": "Transaction amount increased the model risk score relative to comparable alerts.",
        "risk_reducing_template": "Transaction amount reduced the model risk score relative to comparable alerts.",
        "contextual_template": "Transaction amount was used as model context.",
        "investigator_note": "Review source of funds, expected account activity, and counterparties.",
    },
    {
        "feature_name": "feature_rule_count",
        "business_reason_code": "Multiple AML rules triggered",
        "plain_language_template": "Multiple rules triggered on the same alert, increasing the priority score.",
        "risk_increasing_template": "Multiple AML rules increased the model risk score.",
        "risk_reducing_template": "The rule-count signal reduced the model risk score for this alert.",
        "contextual_template": "Rule count was used as model context.",
        "investigator_note": "Review all rule evidence before disposition.",
    },
    {
        "feature_name": "feature_sender_prior_unique_receivers",
        "business_reason_code": "Sender distributed funds to many counterparties",
        "plain_language_template": "The sender has previously transferred funds to many unique receivers.",
        "investigator_note": "Review whether receivers are related, newly observed, or part of rapid movement.",
    },
    {
        "feature_name": "feature_receiver_prior_unique_senders",
        "business_reason_code": "Receiver funded by many counterparties",
        "plain_language_template": "The receiver has received funds from many unique senders.",
        "investigator_note": "Review whether sender accounts share patterns or ownership indicators.",
    },
    {
        "feature_name": "feature_graph_cycle_involvement",
        "business_reason_code": "Short-cycle graph evidence",
        "plain_language_template": "The alert is connected to a short transaction cycle.",
        "investigator_note": "Review path accounts, timing, and amount consistency.",
    },
    {
        "feature_name": "feature_rule_r4_pass_through_flag",
        "business_reason_code": "Rapid pass-through activity",
        "plain_language_template": "Funds appear to move through the account shortly after receipt.",
        "investigator_note": "Compare incoming and outgoing timing, amounts, and counterparties.",
    },
    {
        "feature_name": "feature_rule_r5_fan_in_flag",
        "business_reason_code": "Fan-in concentration",
        "plain_language_template": "Multiple senders appear to fund one receiver.",
        "investigator_note": "Review shared sender attributes and transaction timing.",
    },
    {
        "feature_name": "feature_rule_r6_fan_out_flag",
        "business_reason_code": "Fan-out distribution",
        "plain_language_template": "One sender appears to distribute funds to multiple receivers.",
        "investigator_note": "Review receiver relationships and downstream movement.",
    },
]
DICTIONARY = "feature_name string, business_reason_code string, plain_language_template string, risk_increasing_template string, risk_reducing_template string, contextual_template string, investigator_note string"


def contributions(features: DataFrame, weights: dict[str, float], most: int | None = None, seed: int = 42, zero: bool = False) -> DataFrame:
    """(alert_id, feature_name, shap_value, feature_value): centred values times weights, in long form.

    `most` explains the first alerts in hash order only; `zero` is for a training set with one class."""
    names = list(weights)
    d = features.select("alert_id", *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names))
    if most is not None:
        d = d.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), "alert_id")), "alert_id").limit(most)
    mean = d.agg(*(F.avg(c).alias(f"_m_{c}") for c in names))
    d = d.join(F.broadcast(mean), how="cross")
    part = lambda c: F.lit(0.0) if zero else (F.col(c) - F.col(f"_m_{c}")) * F.lit(float(weights[c]))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("feature_name"), part(c).alias("shap_value"), F.col(c).alias("feature_value")) for c in names)))
    return d.select("alert_id", rows.alias("x")).select("alert_id", "x.*")


def contribution_importance(values: DataFrame) -> DataFrame:
    return values.groupBy("feature_name").agg(F.avg(F.abs("shap_value")).alias("mean_abs_shap"))


def _rank() -> Column:
    return F.row_number().over(W.partitionBy("alert_id").orderBy(F.desc(F.abs("shap_value")), "feature_name"))


def reason_phrase(name: Column) -> Column:
    """The known phrase, else that a rule triggered, else the name in title case."""
    known = F.create_map(*(F.lit(x) for kv in PHRASES.items() for x in kv))[name]
    rule = F.upper(F.regexp_extract(name, "^feature_rule_(.*)_flag$", 1))
    readable = F.initcap(F.replace(F.regexp_replace(name, "^feature_", ""), F.lit("_"), F.lit(" ")))
    return F.coalesce(known, F.when(rule != "", F.concat(rule, F.lit(" triggered for this alert."))), F.concat(readable, F.lit(" contributed to the score.")))


def reason_codes(values: DataFrame, top_n: int = 3) -> DataFrame:
    """The top_n contributions of each alert by size, ties by name, with their phrases."""
    d = values.withColumn("reason_rank", _rank()).where(F.col("reason_rank") <= top_n)
    return d.select("alert_id", F.col("reason_rank").cast("long").alias("reason_rank"), "feature_name", reason_phrase(F.col("feature_name")).alias("reason_code"), F.col("shap_value").alias("contribution"))


def dictionary(spark: SparkSession, entries: Sequence[dict] = ENTRIES) -> DataFrame:
    names = [c.split(" ")[0] for c in DICTIONARY.split(", ")]
    return spark.createDataFrame([tuple(e.get(n) for n in names) for e in entries], DICTIONARY)


def alert_reason_codes(values: DataFrame, entries: DataFrame, banded: DataFrame | None = None, mapping: DataFrame | None = None, top_n: int = 3) -> DataFrame:
    """Business reasons of each alert's top contributions. Where any alert is P1, others keep their first reason only.

    An unlisted feature is described by the default entry; a listed one falls back from its template for the direction
    to its plain one, then to its name."""
    d = values.withColumn("reason_rank", _rank().cast("long")).where(F.col("reason_rank") <= top_n)
    if banded is not None:
        p1 = banded.where("priority_band_v2 = 'P1'").select("alert_id").distinct().withColumn("_p1", F.lit(True))
        d = d.join(p1, "alert_id", "left").join(F.broadcast(p1.agg(F.count(F.lit(1)).alias("_any"))), how="cross")
        d = d.where((F.col("_any") == 0) | F.col("_p1").isNotNull() | (F.col("reason_rank") == 1)).drop("_p1", "_any")
    if mapping is not None:
        d = d.join(mapping.select("alert_id", "case_id").dropDuplicates(["alert_id"]), "alert_id", "left")
    else:
        d = d.withColumn("case_id", F.lit(""))
    d = d.join(F.broadcast(entries.withColumn("_listed", F.lit(True))), "feature_name", "left")
    v = F.col("shap_value")
    direction = F.when(v > 0, "risk_increasing").when(v < 0, "risk_reducing").otherwise("contextual")
    size = F.when(F.abs(v) >= 1, "strong").otherwise("moderate")
    bucket = F.when(v > 0, F.concat(size, F.lit("_positive"))).when(v < 0, F.concat(size, F.lit("_negative"))).otherwise("neutral")
    entry = lambda c: F.when(F.col("_listed").isNull(), F.lit(UNKNOWN[c])).otherwise(F.col(c))
    template = F.when(v > 0, entry("risk_increasing_template")).when(v < 0, entry("risk_reducing_template")).otherwise(entry("contextual_template"))
    plain = F.coalesce(template, entry("plain_language_template"), F.concat("feature_name", F.lit(" contributed to the alert score.")))
    code = F.coalesce(entry("business_reason_code"), F.lit(UNKNOWN["business_reason_code"]))
    note = F.coalesce(entry("investigator_note"), F.lit(UNKNOWN["investigator_note"]))
    return d.select("alert_id", "case_id", "reason_rank", "feature_name", "feature_value", "shap_value", v.alias("contribution"), bucket.alias("contribution_bucket"), direction.alias("risk_direction"), code.alias("business_reason_code"), plain.alias("plain_language_reason"), note.alias("investigator_note"))

"""Derived tables that many queries share, stored once per session and input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import windows
from ..functions.graphs import connected_components, discard, stored, stored_path  # noqa: F401
from ..operators import bands, cases, diagnostics, explain, features, graph, models, profiling, rules
from ..sources import transfers

OPTIONS = {"R1_AMOUNT": {"min_segment": 130}}
_stored: dict[tuple, DataFrame] = {}


def _files(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the events' files, so that a changed input is not taken for what was stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)


def _once(name: str) -> Callable:
    def wrap(make: Callable[[SparkSession, str], DataFrame]):
        def get(spark: SparkSession, sf_dir: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, sf_dir, name, _files(spark, sf_dir))
            if key not in _stored:
                _stored[key] = stored(make(spark, sf_dir), name)
            return _stored[key]

        get.__doc__ = make.__doc__
        return get

    return wrap


def forget(spark: SparkSession) -> None:
    """Drops the shared tables and all else that was stored: for changed input, or to time a query by itself."""
    _stored.clear()
    discard(spark)


def raw_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfers.from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


@_once("transactions")
def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.temporal_split(raw_tx(spark, sf_dir))


@_once("rule-hits")
def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.run_rules(tx(spark, sf_dir), options=OPTIONS)


@_once("alerts")
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.alerts(hits(spark, sf_dir))


def alerted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and labels of alerts, made of the hits alone."""
    return rules.alerted(hits(spark, sf_dir))


@_once("alert-facts")
def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts without their history, for all that asks for no more."""
    return features.alert_facts(tx(spark, sf_dir), alerts(spark, sf_dir))


@_once("role-history")
def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.role_history(tx(spark, sf_dir))


@_once("alert-features")
def alert_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.alert_features(tx(spark, sf_dir), alerts(spark, sf_dir), hits(spark, sf_dir), facts=facts(spark, sf_dir), history=history(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert facts with a fixed model_score made of rule score and amount, so that rankings can be told in SQL."""
    return facts(spark, sf_dir).withColumn("model_score", (F.col("feature_rule_priority_score") * 100 + F.col("feature_amount")) / 1000)


def banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.assign_bands(scored(spark, sf_dir))


def bands_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.bands_v2(alerts(spark, sf_dir), scored(spark, sf_dir).select("alert_id", "model_score"))


@_once("bands-v2")
def bands_v2_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.capacity_caps(bands.p1_overrides(bands_v2(spark, sf_dir)))


@_once("case-frame")
def case_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases.case_frame(tx(spark, sf_dir), alerts(spark, sf_dir), scored(spark, sf_dir))


@_once("link-keys")
def link_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases.link_key_stats(case_frame(spark, sf_dir))


@_once("case-chunks")
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases.case_chunks(case_frame(spark, sf_dir), stats=link_keys(spark, sf_dir))


@_once("network-clusters")
def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases.network_clusters(case_frame(spark, sf_dir), stats=link_keys(spark, sf_dir))


@_once("mega-links")
def mega_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts with the component that their links make, and the number of its accounts."""
    frame = case_frame(spark, sf_dir).select("alert_id", "alert_timestamp", "sender_account_id", "receiver_account_id")
    own = frame.select(F.col("alert_id").alias("src"), F.col("alert_id").alias("dst"))
    links = frame.join(connected_components(cases.alert_link_edges(tx(spark, sf_dir), alerts(spark, sf_dir)).unionByName(own)), F.col("alert_id") == F.col("node"))
    links = links.select("alert_id", F.col("component").alias("component_id"), windows.micros("alert_timestamp").alias("us"), "sender_account_id", "receiver_account_id")
    links = stored(links, "mega-alerts")
    sides = links.select("component_id", F.explode(F.array("sender_account_id", "receiver_account_id")).alias("account"))
    return links.join(sides.groupBy("component_id").agg(F.count_distinct("account").alias("account_count")), "component_id").drop("sender_account_id", "receiver_account_id")


@_once("case-mapping")
def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases.alert_case_mapping(case_frame(spark, sf_dir), chunks(spark, sf_dir), clusters(spark, sf_dir))


def cases_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases.cases_v2(chunks(spark, sf_dir))


@_once("graph-simple")
def graph_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centrality of every transaction."""
    return graph.graph_centrality(tx(spark, sf_dir).select("transaction_id", "timestamp", "sender_account_id", "receiver_account_id"))


@_once("graph-features")
def graph_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_features(tx(spark, sf_dir), alerts(spark, sf_dir), history=history(spark, sf_dir))


def extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.with_graph_features(scored(spark, sf_dir), graph_features(spark, sf_dir), graph.GRAPH_COLUMNS)


def with_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert facts with the degrees only, for what asks for no other feature of the network."""
    told = graph.graph_history(tx(spark, sf_dir).select("transaction_id"), history(spark, sf_dir))
    return graph.with_graph_features(scored(spark, sf_dir), told)


def hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.gather_scatter_hubs(tx(spark, sf_dir))


def rankings(spark: SparkSession, sf_dir: str, score: str = "model_score") -> DataFrame:
    return models.evaluate_rankings(scored(spark, sf_dir).withColumn("model_score", F.col(score)))


@_once("comparison")
def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the ranking that is compared is evaluated, on both scores."""
    of = lambda score: models.evaluate_rankings(scored(spark, sf_dir), rankings={"model_score": score})
    return models.compare_models(of("feature_rule_priority_score"), of("model_score"))


#: Weights for contributions that SQL can repeat.
WEIGHTS = {"feature_amount": 0.01, "feature_rule_count": 1.0, "feature_sender_prior_txn_count": -0.02, "feature_rule_r4_pass_through_flag": 2.0, "feature_pair_prior_txn_count": 0.5, "feature_sender_prior_unique_receivers": 0.3, "feature_receiver_prior_unique_senders": -0.4, "feature_rule_r5_fan_in_flag": 1.5, "feature_rule_r6_fan_out_flag": -1.5}


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.contributions(alert_features(spark, sf_dir), WEIGHTS)


@_once("reason-codes")
def reason_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.alert_reason_codes(contributions(spark, sf_dir), explain.dictionary(spark), bands_v2_final(spark, sf_dir), mapping(spark, sf_dir))


def stress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.stress_summary(tx(spark, sf_dir), hits(spark, sf_dir), alerts(spark, sf_dir), banded(spark, sf_dir))


@_once("graph-ablation")
def ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_ablation(extended(spark, sf_dir))


@_once("traffic-lights")
def lights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.traffic_lights(
        bands.band_summary_v2(bands_v2_final(spark, sf_dir)), stress(spark, sf_dir), comparison(spark, sf_dir), ablation(spark, sf_dir),
        cases.case_quality(cases_v2(spark, sf_dir), mapping(spark, sf_dir)), reason_codes(spark, sf_dir), diagnostics.temporal_stress(scored(spark, sf_dir)), diagnostics.segment_stress(with_degrees(spark, sf_dir), tx(spark, sf_dir)),
    )



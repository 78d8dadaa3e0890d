"""All queries of the transaction-monitoring library by name, and their SQL.

A query names its columns with types once (l long, d double to six digits, s string, b boolean, t timestamp); both sides
are cast to them. Models, random draws and incremental graph state have no SQL; tests hold those against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics, windows
from ..functions.graphs import connected_components
from ..operators import bands, cases, diagnostics, eda, explain, features, graph, models, profiling, rules
from ..sources import transfers
from . import oracle as o
from . import tables as t

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_SPARK = {"l": "bigint", "d": "double", "s": "string", "b": "boolean", "t": "timestamp_ntz"}
_DUCK = {"l": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN", "t": "TIMESTAMP"}


def _add(name: str, spec: str, make: Callable[[SparkSession, str], DataFrame], sql: str | None = None, more: str = "") -> None:
    """Registers a query; `more` are further common table expressions for its SQL, each after a comma."""
    cols = [c.split(":") for c in spec.split()]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = make(spark, sf_dir)
        cast = lambda c, k: F.round(F.col(c).cast("double"), 6) if k == "d" else F.col(c).cast(_SPARK[k])
        return df.select(*(cast(c, k).alias(c) for c, k in cols))

    run.__name__, run.__doc__ = name, make.__doc__
    QUERIES[name] = run
    if sql is not None:
        cast = lambda c, k: f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' if k == "d" else f'CAST("{c}" AS {_DUCK[k]}) AS "{c}"'
        ORACLE_SQL[name] = o.with_tables(f"{more} SELECT {', '.join(cast(c, k) for c, k in cols)} FROM ({sql}) AS q")


_TX = "transaction_id:l timestamp:t from_bank:s to_bank:s sender_account_id:s receiver_account_id:s amount_paid:d amount_received:d payment_currency:s receiving_currency:s payment_format:s currency_pair:s cross_bank_flag:l amount:d log_amount:d is_laundering:l"
_NAMES = [c.split(":")[0] for c in _TX.split()]
_CONF = "true_positives:l false_positives:l false_negatives:l true_negatives:l precision:d recall:d alert_rate:d f1:d"
_CONF_SQL = """tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS precision, coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS recall,
  coalesce((tp + fp) / nullif(CAST(tp + fp + fn + tn AS DOUBLE), 0), 0) AS alert_rate, coalesce(2.0 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0) AS f1"""


def _raw_text(s: SparkSession, d: str) -> DataFrame:
    """Events as raw text columns with padded and broken values, to be standardised again."""
    x = t.raw_tx(s, d)
    odd = F.col("transaction_id") % 50 == 0
    return x.select(
        F.when(odd, "not a time").otherwise(F.date_format("timestamp", "yyyy/MM/dd HH:mm")).alias("Timestamp"), F.concat(F.lit(" "), "from_bank").alias("From Bank"), F.col("sender_account_id").alias("Account"),
        F.concat("to_bank", F.lit(" ")).alias("To Bank"), F.col("receiver_account_id").alias("Account.1"), F.col("amount_received").cast("string").alias("Amount Received"), F.when(odd, None).otherwise(F.col("receiving_currency")).alias("Receiving Currency"),
        F.when(odd, "n/a").otherwise(F.col("amount_paid").cast("string")).alias("Amount Paid"), F.col("payment_currency").alias("Payment Currency"), F.col("payment_format").alias("Payment Format"), F.col("is_laundering").cast("string").alias("Is Laundering"), F.col("transaction_id").alias("_ord"),
    )


def _standardized(s: SparkSession, d: str) -> DataFrame:
    return transfers.standardize(_raw_text(s, d), ordinal="ord")


_STD_SQL = """SELECT row_number() OVER (ORDER BY transaction_id) AS transaction_id, CASE WHEN transaction_id % 50 = 0 THEN NULL ELSE date_trunc('minute', timestamp) END AS timestamp, from_bank, to_bank, sender_account_id, receiver_account_id,
  CASE WHEN transaction_id % 50 = 0 THEN NULL ELSE amount_paid END AS amount_paid, amount_received, payment_currency, CASE WHEN transaction_id % 50 = 0 THEN NULL ELSE receiving_currency END AS receiving_currency, payment_format,
  payment_currency || ' -> ' || CASE WHEN transaction_id % 50 = 0 THEN 'UNKNOWN' ELSE receiving_currency END AS currency_pair, cross_bank_flag, CASE WHEN transaction_id % 50 = 0 THEN NULL ELSE amount END AS amount,
  CASE WHEN transaction_id % 50 = 0 THEN NULL ELSE log_amount END AS log_amount, is_laundering FROM txa"""


def _csv(s: SparkSession, d: str) -> DataFrame:
    """The raw text written as CSV, which trims it, and read back by position."""
    path = t.stored_path(s, "raw-csv")
    raw = _raw_text(s, d)
    raw.drop("_ord").toDF(*[f"c{i}" for i in range(11)]).write.csv(path, header=True)
    return transfers.read_raw(s, path)


# sources, schema and profiles
_add("scan_raw_csv", "timestamp:s from_bank:s account:s to_bank:s account_1:s amount_received:s receiving_currency:s amount_paid:s payment_currency:s payment_format:s is_laundering:s", _csv,
     """SELECT CASE WHEN transaction_id % 50 = 0 THEN 'not a time' ELSE strftime(timestamp, '%Y/%m/%d %H:%M') END AS timestamp, from_bank, sender_account_id AS account, to_bank, receiver_account_id AS account_1,
  CAST(amount_received AS VARCHAR) AS amount_received, CASE WHEN transaction_id % 50 <> 0 THEN receiving_currency END AS receiving_currency, CASE WHEN transaction_id % 50 = 0 THEN 'n/a' ELSE CAST(amount_paid AS VARCHAR) END AS amount_paid,
  payment_currency, payment_format, CAST(is_laundering AS VARCHAR) AS is_laundering FROM txa""")
_add("ingest", "row_count:l accounts:l label_count:l null_timestamps:l total:d", lambda s, d: transfers.standardize(_csv(s, d)).agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("sender_account_id").alias("accounts"), F.sum("is_laundering").alias("label_count"), F.count_if(F.col("timestamp").isNull()).alias("null_timestamps"), F.sum("amount").alias("total")),
     f"SELECT count(*) AS row_count, count(DISTINCT sender_account_id) AS accounts, sum(is_laundering) AS label_count, count(*) - count(timestamp) AS null_timestamps, sum(amount) AS total FROM ({_STD_SQL})")
_add("transactions", _TX, t.raw_tx, f"SELECT {', '.join(_NAMES)} FROM txa")
_add("standardize", _TX, _standardized, _STD_SQL)
_add("schema_violations", "violation:s row_count:l", lambda s, d: transfers.schema_violations(_standardized(s, d)),
     f"""WITH x AS ({_STD_SQL}) SELECT 'null_timestamp' AS violation, count(*) - count(timestamp) AS row_count FROM x UNION ALL SELECT 'null_label', count(*) - count(is_laundering) FROM x
     UNION ALL SELECT 'null_amount', count(*) - count(amount) FROM x UNION ALL SELECT 'negative_amount', count(*) FILTER (amount < 0) FROM x""")
_add("quality_report", "row_count:l column_count:l min_timestamp:t max_timestamp:t label_count:l label_rate:d label_0:l label_1:l duplicate_transaction_ids:l min_amount:d max_amount:d mean_amount:d", lambda s, d: profiling.quality_report(t.raw_tx(s, d)),
     """SELECT count(*) AS row_count, 16 AS column_count, min(timestamp) AS min_timestamp, max(timestamp) AS max_timestamp, sum(is_laundering) AS label_count, avg(is_laundering) AS label_rate, count(*) - sum(is_laundering) AS label_0, sum(is_laundering) AS label_1,
     count(*) - count(DISTINCT transaction_id) AS duplicate_transaction_ids, min(amount) AS min_amount, max(amount) AS max_amount, avg(amount) AS mean_amount FROM txa""")
_add("missing_values", "column_name:s null_count:l", lambda s, d: profiling.missing_values(_standardized(s, d)),
     f"WITH x AS ({_STD_SQL}) " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM x" for c in _NAMES))
_add("profile_counts", "column_name:s value:s row_count:l", lambda s, d: profiling.profile_counts(_standardized(s, d)),
     f"WITH x AS ({_STD_SQL}) " + " UNION ALL ".join(f"(SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count FROM x GROUP BY {c} ORDER BY count(*) DESC, {c} NULLS FIRST LIMIT 20)" for c in ("payment_format", "currency_pair", "from_bank", "to_bank")))
_add("profile_amount", "min_amount:d max_amount:d mean_amount:d median_amount:d", lambda s, d: profiling.profile_amount(t.raw_tx(s, d)), "SELECT min(amount) AS min_amount, max(amount) AS max_amount, avg(amount) AS mean_amount, median(amount) AS median_amount FROM txa")
_SPLIT_SQL = "SELECT split, count(*) AS row_count, sum(is_laundering) AS label_count, avg(is_laundering) AS label_rate, min(timestamp) AS min_timestamp, max(timestamp) AS max_timestamp FROM tx GROUP BY split"
_split_spec = "split:s row_count:l label_count:l label_rate:d min_timestamp:t max_timestamp:t"
_add("split_manifest", _split_spec, lambda s, d: profiling.split_manifest(t.tx(s, d)), _SPLIT_SQL)
# some rows of the test split are in none
_LATE = "split = 'test' AND transaction_id % 40 = 0"
_add("profile_split_summary", _split_spec, lambda s, d: profiling.profile_splits(t.tx(s, d).withColumn("split", F.when(~F.expr(_LATE), F.col("split")))),
     f"SELECT coalesce(part, 'None') AS split, count(*) AS row_count, sum(is_laundering) AS label_count, avg(is_laundering) AS label_rate, min(timestamp) AS min_timestamp, max(timestamp) AS max_timestamp FROM (SELECT *, CASE WHEN NOT ({_LATE}) THEN split END AS part FROM tx) GROUP BY part")
_add("temporal_split", "transaction_id:l timestamp:t split:s", lambda s, d: profiling.temporal_split(t.raw_tx(s, d)), "SELECT transaction_id, timestamp, split FROM tx")
_add("split_non_overlap", "non_overlapping:b", lambda s, d: profiling.split_non_overlap(t.tx(s, d)),
     "SELECT coalesce(bool_and(a.timestamp <= b.timestamp), true) AS non_overlapping FROM (SELECT split, max(timestamp) AS timestamp FROM tx GROUP BY 1) a JOIN (SELECT split, min(timestamp) AS timestamp FROM tx GROUP BY 1) b ON (a.split = 'train' AND b.split IN ('validation', 'test')) OR (a.split = 'validation' AND b.split = 'test')")

# rules
_add("segment_thresholds", "payment_format:s currency_pair:s segment_count:l threshold:d threshold_source:s", lambda s, d: rules.segment_thresholds(rules.training_rows(t.tx(s, d)), min_segment=130), "SELECT * FROM seg")
_json = lambda c, k: F.get_json_object(c, f"$.{k}")
_add("rule_r1_amount", "transaction_id:l amount:d threshold:d threshold_source:s segment_count:l split:s", lambda s, d: rules.amount_rule(t.tx(s, d), min_segment=130).select("transaction_id", "split", _json("trigger_values_json", "amount").alias("amount"), *(_json("threshold_json", k).alias(k) for k in ("threshold", "threshold_source", "segment_count"))), "SELECT * FROM r1")
_add("rule_r2_novelty", "transaction_id:l sender_account_id:s receiver_account_id:s first_seen_pair_flag:l split:s", lambda s, d: rules.novelty_rule(t.tx(s, d)).select("transaction_id", "split", *(_json("trigger_values_json", k).alias(k) for k in ("sender_account_id", "receiver_account_id", "first_seen_pair_flag"))), "SELECT *, 1 AS first_seen_pair_flag FROM r2")
_add("sender_rolling", "transaction_id:l rolling_count:l rolling_sum:d", lambda s, d: windows.rolling(t.tx(s, d), "sender_account_id", "24h", closed=False), "SELECT transaction_id, c AS rolling_count, s AS rolling_sum FROM send")
_hit = "transaction_id:l alert_timestamp:t severity:s split:s "
_ev = lambda df, *ks: df.select("*", *(_json("trigger_values_json", k).alias(k) for k in ks))
_add("rule_r3_velocity", _hit + "rolling_count:l rolling_sum:d", lambda s, d: _ev(rules.velocity_rule(t.tx(s, d)), "rolling_count", "rolling_sum"), "SELECT *, timestamp AS alert_timestamp, 'high' AS severity, c AS rolling_count, s AS rolling_sum FROM r3")
_add("incoming_to_sender", "transaction_id:l incoming:d", lambda s, d: rules.pass_through(t.tx(s, d)), "SELECT * FROM inc")
_add("rule_r4_pass_through", _hit + "incoming_amount_window:d pass_through_ratio:d", lambda s, d: _ev(rules.pass_through_rule(t.tx(s, d)), "incoming_amount_window", "pass_through_ratio"), "SELECT *, timestamp AS alert_timestamp, 'critical' AS severity, incoming AS incoming_amount_window, ratio AS pass_through_ratio FROM r4")
_add("rolling_unique", "transaction_id:l rolling_distinct:l", lambda s, d: windows.rolling_distinct(t.tx(s, d), "receiver_account_id", "sender_account_id", "24h"), "SELECT transaction_id, senders AS rolling_distinct FROM usend")
_add("rolling_amount", "transaction_id:l rolling_sum:d", lambda s, d: windows.rolling(t.tx(s, d), "receiver_account_id", "24h", closed=True), "SELECT transaction_id, s AS rolling_sum FROM recv")
_add("rule_r5_fan_in", _hit + "unique_senders:l incoming_amount:d", lambda s, d: _ev(rules.fan_in_rule(t.tx(s, d)), "unique_senders", "incoming_amount"), "SELECT *, timestamp AS alert_timestamp, 'high' AS severity, senders AS unique_senders, s AS incoming_amount FROM r5")
_add("incoming_unique_funders", "transaction_id:l funders:l", lambda s, d: rules.incoming_unique_funders(t.tx(s, d)), "SELECT * FROM fund")
_add("rule_r6_fan_out", _hit + "unique_receivers:l prior_unique_senders:l", lambda s, d: _ev(rules.fan_out_rule(t.tx(s, d)), "unique_receivers", "prior_unique_senders"), "SELECT *, timestamp AS alert_timestamp, 'high' AS severity, receivers AS unique_receivers, funders AS prior_unique_senders FROM r6")
_hits = "rule_hit_id:s transaction_id:l alert_timestamp:t rule_id:s rule_name:s severity:s is_laundering:l split:s"
_add("rule_hits", _hits, t.hits, "SELECT * FROM hits")
_add("rule_hits_status", "rule_hit_id:s rule_status:s queue_eligible:b volume_control_reason:s", lambda s, d: rules.with_status(t.hits(s, d).drop("rule_status", "queue_eligible", "volume_control_reason")), "SELECT rule_hit_id, rule_status, rule_status = 'escalation' AS queue_eligible, CASE rule_status WHEN 'coverage' THEN 'coverage_only_not_direct_p1_p2' ELSE '' END AS volume_control_reason FROM hits")
_add("rule_hits_by_rule", "rule_id:s split:s hit_count:l", lambda s, d: t.hits(s, d).groupBy("rule_id", "split").agg(F.count(F.lit(1)).alias("hit_count")), "SELECT rule_id, split, count(*) AS hit_count FROM hits GROUP BY ALL")
_alert = "alert_id:s transaction_id:l alert_timestamp:t triggered_rules:s rule_count:l max_rule_severity:s rule_priority_score:d rule_statuses:s queue_eligible:b escalation_rule_count:l coverage_rule_count:l research_rule_count:l is_laundering:l split:s"
_add("alerts", _alert, t.alerts, "SELECT * FROM al")
_add("rule_performance", "split:s rule_id:s rule_name:s " + _CONF, lambda s, d: rules.rule_performance(t.tx(s, d), t.hits(s, d)),
     f"""SELECT split, rule_id, rule_name, {_CONF_SQL} FROM (SELECT t.split, r.rule_id, r.rule_name, count(*) FILTER (h.transaction_id IS NOT NULL AND t.is_laundering = 1) AS tp, count(*) FILTER (h.transaction_id IS NOT NULL AND t.is_laundering = 0) AS fp,
       count(*) FILTER (h.transaction_id IS NULL AND t.is_laundering = 1) AS fn, count(*) FILTER (h.transaction_id IS NULL AND t.is_laundering = 0) AS tn
     FROM tx t, (SELECT DISTINCT rule_id, rule_name FROM hits UNION ALL SELECT 'ANY_RULE', 'Any rule alert') r LEFT JOIN (SELECT DISTINCT transaction_id, rule_id FROM hits UNION SELECT transaction_id, 'ANY_RULE' FROM hits) h ON h.transaction_id = t.transaction_id AND h.rule_id = r.rule_id GROUP BY ALL)""")
_IDS = ("R1_AMOUNT", "R2_NOVELTY", "R3_VELOCITY", "R4_PASS_THROUGH", "R5_FAN_IN", "R6_FAN_OUT")
_add("rule_overlap", "rule_id:s " + " ".join(f"{r}:l" for r in _IDS), lambda s, d: rules.rule_overlap(t.hits(s, d)), "SELECT a.rule_id, " + ", ".join(f"count(*) FILTER (b.rule_id = '{r}') AS {r}" for r in _IDS) + " FROM hits a JOIN hits b USING (transaction_id) GROUP BY a.rule_id")
_tuned = lambda s, d: rules.tune_amount_rule(t.tx(s, d), min_segment=130)
_TUNE_SQL = f"""SELECT 'R1_AMOUNT' AS rule_id, 'percentile' AS parameter, p AS candidate_value, 'validation' AS split, {_CONF_SQL}, coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) >= 0.8 AS meets_recall_floor, true AS meets_alert_rate_cap FROM (
  SELECT p, count(*) FILTER (hit AND y = 1) AS tp, count(*) FILTER (hit AND y = 0) AS fp, count(*) FILTER (NOT hit AND y = 1) AS fn, count(*) FILTER (NOT hit AND y = 0) AS tn FROM (
    SELECT p, is_laundering AS y, amount >= coalesce(q, (SELECT round(quantile_cont(amount, 0.95), 9) FROM trn)) AS hit FROM (SELECT * FROM tx WHERE split = 'validation') v CROSS JOIN (SELECT unnest([0.95, 0.975, 0.99, 0.995])::DOUBLE AS p)
      LEFT JOIN ({' UNION ALL '.join(f'SELECT payment_format, currency_pair, {p}::DOUBLE AS p, round(quantile_cont(amount, {p}), 9) AS q FROM trn GROUP BY ALL HAVING count(*) >= 130' for p in (0.95, 0.975, 0.99, 0.995))}) s USING (payment_format, currency_pair, p)) GROUP BY p)"""
_tspec = "rule_id:s parameter:s candidate_value:d split:s " + _CONF + " meets_recall_floor:b meets_alert_rate_cap:b"
_add("tune_r1_candidates", _tspec, _tuned, _TUNE_SQL)
_add("tune_r1_selected", _tspec + " selection_reason:s", lambda s, d: rules.select_candidate(_tuned(s, d)),
     f"SELECT *, CASE WHEN meets_recall_floor THEN 'met_recall_floor_and_alert_rate_cap' ELSE 'guardrail_not_met_selected_highest_recall' END AS selection_reason FROM ({_TUNE_SQL}) ORDER BY meets_recall_floor DESC, CASE WHEN meets_recall_floor THEN 0 ELSE -recall END, alert_rate, CASE WHEN meets_recall_floor THEN -candidate_value ELSE candidate_value END LIMIT 1")

# ranking metrics
_add("binary_metrics", "split:s " + _CONF, lambda s, d: metrics.binary_metrics(t.scored(s, d).withColumn("pred", F.when(F.col("model_score") >= 0.4, 1).otherwise(0)), "target", "pred", ["split"]),
     f"SELECT split, {_CONF_SQL} FROM (SELECT split, count(*) FILTER (p AND y = 1) AS tp, count(*) FILTER (p AND y = 0) AS fp, count(*) FILTER (NOT p AND y = 1) AS fn, count(*) FILTER (NOT p AND y = 0) AS tn FROM (SELECT split, target AS y, model_score >= 0.4 AS p FROM sc) GROUP BY split)")
_ALL = "SELECT alert_id AS id, model_score AS score, target AS y FROM sc"
_add("topk_metrics", "k:l reviewed_alerts:l precision_at_k:d recall_at_k:d lift_at_k:d", lambda s, d: metrics.top_k(t.scored(s, d), "target", "model_score", [10, 100, 1000, 100000], "alert_id"), f"SELECT k, reviewed AS reviewed_alerts, p AS precision_at_k, r AS recall_at_k, l AS lift_at_k FROM ({o.top(_ALL, '[10, 100, 1000, 100000]')})")
_add("average_precision", "split:s pr_auc:d", lambda s, d: metrics.average_precision(t.scored(s, d), "target", "model_score", ["split"]), o.ap("SELECT split, model_score AS score, target AS y FROM sc", "split"))
_add("roc_auc", "roc_auc:d", lambda s, d: metrics.roc_auc(t.scored(s, d), "target", "model_score"), o.auc(_ALL))
_RANKS = {"model_score": "model_score", "rule_priority": "feature_rule_priority_score", "amount_rank": "feature_amount"}
_RANK_SQL = {r: f"SELECT alert_id AS id, {c} AS score, target AS y FROM sc" for r, c in _RANKS.items()}
_TOPTABLE = " UNION ALL ".join(f"SELECT '{r}' AS ranking, k, reviewed AS reviewed_alerts, p AS precision_at_k, r AS recall_at_k, l AS lift_at_k FROM ({o.top(q, '[100, 500, 1000, 5000]')})" for r, q in _RANK_SQL.items())
for _n in ("topk_table", "capacity_by_ranking"):
    _add(_n, "ranking:s k:l reviewed_alerts:l precision_at_k:d recall_at_k:d lift_at_k:d", lambda s, d: bands.simulate_capacity(t.scored(s, d), _RANKS), _TOPTABLE)
_add("evaluate_rankings", "split:s ranking:s metric:s k:l value:d", t.rankings, f"SELECT 'test' AS split, * FROM ({o.ranking_sql(o.TEST_RANK)})")

# alert features
_add("tx_history", "transaction_id:l feature_sender_prior_txn_count:l feature_receiver_prior_txn_count:l feature_pair_prior_txn_count:l", lambda s, d: features.transaction_history(t.tx(s, d)), "SELECT transaction_id, f1 AS feature_sender_prior_txn_count, f2 AS feature_receiver_prior_txn_count, f3 AS feature_pair_prior_txn_count FROM hist")
_add("prior_unique", "transaction_id:l feature_sender_prior_unique_receivers:l feature_receiver_prior_unique_senders:l", lambda s, d: features.transaction_history(t.tx(s, d)), "SELECT transaction_id, f4 AS feature_sender_prior_unique_receivers, f5 AS feature_receiver_prior_unique_senders FROM hist")
_FLAGS = [f"feature_rule_{r.lower()}_flag" for r in _IDS]
_add("rule_flags", "transaction_id:l " + " ".join(f"{f}:l" for f in _FLAGS), lambda s, d: features.rule_flags(t.hits(s, d)), "SELECT * FROM feat")
_FEATS = sorted(["feature_amount", "feature_cross_bank_flag", "feature_log_amount", "feature_max_rule_severity_ord", "feature_pair_prior_txn_count", "feature_receiver_prior_txn_count", "feature_receiver_prior_unique_senders", "feature_rule_count", "feature_rule_priority_score", "feature_sender_prior_txn_count", "feature_sender_prior_unique_receivers", *_FLAGS])
_META = "alert_id:s transaction_id:l alert_timestamp:t split:s target:l payment_format:s currency_pair:s triggered_rules:s max_rule_severity:s"
_add("alert_features", _META + " " + " ".join(f"{f}:d" for f in _FEATS), t.alert_features, "SELECT * FROM feat")
_add("feature_quality", "feature_name:s row_count:l null_count:l null_rate:d distinct_count:l all_null:b", lambda s, d: features.feature_quality(t.alert_features(s, d)),
     " UNION ALL ".join(f"SELECT '{f}' AS feature_name, count(*) AS row_count, 0 AS null_count, 0.0 AS null_rate, count(DISTINCT {f}) AS distinct_count, false AS all_null FROM feat" for f in _FEATS))
_HOT = ("payment_format", "currency_pair", "max_rule_severity")


def _hot(s: SparkSession, d: str) -> DataFrame:
    """(alert_id, column, value) of all columns that are made of categories, whatever values these have."""
    frame, columns = models.prepare(t.alert_features(s, d))
    made = [c for c in columns if not c.startswith("feature_")]
    return frame.select("alert_id", *(F.col(f"`{c}`").cast("long").alias(c) for c in made)).unpivot(["alert_id"], [f"`{c}`" for c in made], "column", "value")


_add("one_hot", "alert_id:s column:s value:l", _hot, " UNION ALL ".join(
    f"SELECT alert_id, '{c}_' || v AS \"column\", CASE WHEN {c} = v THEN 1 ELSE 0 END AS value FROM feat, (SELECT DISTINCT {c} AS v FROM feat WHERE {c} IS NOT NULL) UNION ALL SELECT alert_id, '{c}_null', CASE WHEN {c} IS NULL THEN 1 ELSE 0 END FROM feat" for c in _HOT))
_train = lambda s, d: t.alert_features(s, d).where("split = 'train'")
# each class's rows numbered in hash order, with the number of both classes
_BAL_ROWS = "SELECT alert_id, target, row_number() OVER (PARTITION BY target ORDER BY md5('42|' || alert_id), alert_id) AS i, sum(target) OVER () AS pos, sum(1 - target) OVER () AS neg FROM feat WHERE split = 'train'"
_BAL_AT = "SELECT * FROM (SELECT *, least(neg, pos * {ratio}, {cap} * {ratio} // ({ratio} + 1)) AS negatives FROM (" + _BAL_ROWS + ")) WHERE i <= CASE WHEN target = 0 THEN negatives ELSE {cap} - negatives END"
_BAL = _BAL_AT.format(ratio=10, cap=200_000)
_balanced = lambda s, d: features.balanced_sample(_train(s, d))
_add("balanced_sample", "alert_id:s target:l", _balanced, _BAL)
_add("balanced_sample_capped", "alert_id:s target:l", lambda s, d: features.balanced_sample(_train(s, d), 3, 200), _BAL_AT.format(ratio=3, cap=200))
_add("balanced_sample_all_positives", "alert_id:s target:l", lambda s, d: features.balanced_sample(_train(s, d), 3, 200, keep_positives=True), f"SELECT * FROM ({_BAL_ROWS}) WHERE target = 1 OR i <= greatest(0, least(pos * 3, 200 - pos))")
_add("sample_weights", "alert_id:s target:l sample_weight:d", lambda s, d: features.sample_weights(_balanced(s, d)), f"SELECT alert_id, target, count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY target)) AS sample_weight FROM ({_BAL})")

# network
_add("graph_degrees", "transaction_id:l graph_sender_out_degree:l graph_receiver_in_degree:l", lambda s, d: graph.graph_degrees(t.tx(s, d)), "SELECT transaction_id, f4 AS graph_sender_out_degree, f5 AS graph_receiver_in_degree FROM hist")
_add("graph_weighted_degrees", "transaction_id:l graph_sender_weighted_out_degree:d graph_receiver_weighted_in_degree:d", lambda s, d: graph.graph_weighted_degrees(t.tx(s, d)), "SELECT transaction_id, w_out AS graph_sender_weighted_out_degree, w_in AS graph_receiver_weighted_in_degree FROM g1")
_add("graph_centrality_proxy", "transaction_id:l graph_sender_pagerank:d graph_receiver_pagerank:d", t.graph_simple, "SELECT transaction_id, pr_s AS graph_sender_pagerank, pr_r AS graph_receiver_pagerank FROM g2")
# the least position by which two accounts are connected: ways of up to 128 steps, by squaring; then accounts in reach of the sender
_SIZE_SQL = """, m0 AS MATERIALIZED (SELECT a, b, min(o) AS o FROM (SELECT s AS a, r AS b, o FROM fp UNION ALL SELECT r, s, o FROM fp UNION ALL SELECT s, s, -1 FROM fp UNION ALL SELECT r, r, -1 FROM fp) GROUP BY 1, 2),
  """ + ",\n  ".join(f"m{i} AS MATERIALIZED (SELECT x.a, y.b, min(greatest(x.o, y.o)) AS o FROM m{i - 1} x JOIN m{i - 1} y ON x.b = y.a GROUP BY 1, 2)" for i in range(1, 8)) + """,
  sz AS (SELECT t.transaction_id, count(*) AS size FROM tx t JOIN m7 ON m7.a = t.sender_account_id AND m7.o <= t.pos GROUP BY 1),
  gf AS MATERIALIZED (SELECT g.*, sz.size, CASE WHEN c.transaction_id IS NULL THEN 0 ELSE 1 END AS cycle FROM g2 g JOIN sz USING (transaction_id) LEFT JOIN cyc c USING (transaction_id))"""
_add("graph_component_size", "transaction_id:l graph_component_size:l", lambda s, d: graph.component_sizes(t.tx(s, d)), "SELECT transaction_id, size AS graph_component_size FROM sz", _SIZE_SQL)
_add("graph_cycle_flag", "transaction_id:l graph_cycle_involvement:l", lambda s, d: graph.cycle_flags(t.tx(s, d)), "SELECT tx.transaction_id, CASE WHEN c.transaction_id IS NULL THEN 0 ELSE 1 END AS graph_cycle_involvement FROM tx LEFT JOIN cyc c USING (transaction_id)")
_GRAPH = {"graph_sender_out_degree:l": "f4", "graph_receiver_in_degree:l": "f5", "graph_sender_weighted_out_degree:d": "w_out", "graph_receiver_weighted_in_degree:d": "w_in", "graph_component_size:l": "size", "graph_sender_pagerank:d": "pr_s", "graph_receiver_pagerank:d": "pr_r", "graph_cycle_involvement:l": "cycle"}
_GF = "SELECT transaction_id, sender_account_id, receiver_account_id, " + ", ".join(f"{v} AS {k[:-2]}" for k, v in _GRAPH.items()) + " FROM gf JOIN al USING (transaction_id)"
_add("graph_features", "transaction_id:l sender_account_id:s receiver_account_id:s " + " ".join(_GRAPH), t.graph_features, _GF, _SIZE_SQL)
_EXT = {f"feature_{k[:-2]}": v for k, v in _GRAPH.items()}
_EXT_SQL = "SELECT s.*, " + ", ".join(f"g.{v} AS {k}" for k, v in _EXT.items()) + " FROM sc s JOIN gf g USING (transaction_id)"
_add("extended_alert_features", "alert_id:s target:l feature_amount:d model_score:d " + " ".join(f"{k}:d" for k in _EXT), t.extended, _EXT_SQL, _SIZE_SQL)
_ghits = lambda s, d: graph.graph_rules(t.tx(s, d), t.graph_features(s, d))
_GR = """, gr AS (SELECT transaction_id, timestamp AS alert_timestamp, 'GR1_GATHER_SCATTER' AS rule_id, 'Graph gather-scatter concentration' AS rule_name, 'high' AS severity, g.is_laundering, g.split FROM gf g JOIN al USING (transaction_id) WHERE (f4 >= 3 OR f5 >= 3) AND size >= 4
  UNION ALL SELECT transaction_id, timestamp, 'GR2_CYCLE_CANDIDATE', 'Short-cycle candidate', 'high', g.is_laundering, g.split FROM gf g JOIN al USING (transaction_id) WHERE cycle = 1)"""
_add("graph_rules", _hits, _ghits, "SELECT *, rule_id || ':' || transaction_id AS rule_hit_id FROM gr", _SIZE_SQL + _GR)
_add("cycle_summary", "metric:s value:l", lambda s, d: graph.cycle_summary(t.graph_features(s, d), _ghits(s, d)), """SELECT 'alert_transactions_evaluated' AS metric, count(*) AS value FROM al
  UNION ALL SELECT 'cycle_candidate_count', count(*) FROM gr WHERE rule_id = 'GR2_CYCLE_CANDIDATE' UNION ALL SELECT 'cycle_candidate_label_count', coalesce(sum(is_laundering), 0) FROM gr WHERE rule_id = 'GR2_CYCLE_CANDIDATE'""", _SIZE_SQL + _GR)
_add("gather_scatter_hubs", "hub_account_id:s unique_sources:l unique_destinations:l incoming_amount:d outgoing_amount:d amount_ratio:d first_in:t last_in:t first_out:t last_out:t", t.hubs, "SELECT * FROM hb")
_WAY = """p{h} AS MATERIALIZED (SELECT transaction_id, pos, s, tip, orders, amounts, first, nodes, {h} AS hops FROM (
    SELECT p.transaction_id, p.pos, p.s, e.receiver_account_id AS tip, list_append(orders, e.pos) AS orders, list_append(amounts, e.amount) AS amounts, least(first, e.timestamp) AS first, list_append(nodes, p.tip) AS nodes,
      row_number() OVER (PARTITION BY p.transaction_id, e.receiver_account_id ORDER BY list_append(orders, e.pos)) AS i
    FROM p{g} p JOIN tx e ON e.sender_account_id = p.tip AND e.pos < p.pos WHERE p.tip <> p.s AND NOT list_contains(p.nodes, p.tip)
      AND p.transaction_id NOT IN (SELECT transaction_id FROM ({before}) WHERE tip = s)) WHERE i = 1)"""
_before = lambda h: " UNION ALL ".join(f"SELECT transaction_id, tip, s FROM p{g}" for g in range(1, h))
_CYC_SQL = """, p1 AS MATERIALIZED (SELECT t.transaction_id, t.pos, t.sender_account_id AS s, e.receiver_account_id AS tip, [e.pos] AS orders, [e.amount] AS amounts, e.timestamp AS first, [t.receiver_account_id] AS nodes, 1 AS hops
    FROM tx t JOIN tx e ON e.sender_account_id = t.receiver_account_id AND e.pos < t.pos),
  """ + ",\n  ".join(_WAY.format(h=h, g=h - 1, before=_before(h)) for h in (2, 3, 4)) + """,
  best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY hops, orders) AS i FROM (""" + " UNION ALL ".join(f"SELECT * FROM p{h} WHERE tip = s" for h in (1, 2, 3, 4)) + """)) WHERE i = 1),
  cy AS (SELECT t.transaction_id, t.timestamp AS alert_timestamp, t.is_laundering, t.split, array_to_string(list_concat(list_concat([s], nodes), [s]), '->') AS cycle_path, hops + 2 AS path_length, t.amount + list_sum(amounts) AS total_cycle_amount,
      t.amount / greatest(list_sum(amounts), 1.0) AS cycle_retention_ratio, (epoch_us(t.timestamp) - epoch_us(least(t.timestamp, first))) / 3.6e9 AS duration_hours, least(t.amount, list_min(amounts)) / greatest(t.amount, list_max(amounts)) AS amount_similarity_ratio
    FROM best b JOIN tx t USING (transaction_id))"""
_cycles = lambda s, d: graph.cycle_candidates(t.tx(s, d), min_total=0.75)
_CYC_OK = "FROM cy WHERE duration_hours <= 72 AND amount_similarity_ratio >= 0.5 AND cycle_retention_ratio <= 1.2 AND total_cycle_amount >= (SELECT quantile_cont(amount, 0.75) FROM tx)"
_add("cycle_candidates", "transaction_id:l alert_timestamp:t cycle_path:s path_length:l duration_hours:d amount_similarity_ratio:d cycle_retention_ratio:d total_cycle_amount:d is_laundering:l split:s", _cycles, "SELECT * " + _CYC_OK, _CYC_SQL)
_add("graph_rules_v2", "rule_hit_id:s transaction_id:l rule_status:s queue_eligible:b volume_control_reason:s", lambda s, d: graph.graph_rules_v2(t.tx(s, d), t.hubs(s, d), _cycles(s, d)), """SELECT 'GR1_GATHER_SCATTER_V2:' || transaction_id AS rule_hit_id, transaction_id, 'escalation' AS rule_status, true AS queue_eligible, '' AS volume_control_reason FROM tx
  WHERE sender_account_id IN (SELECT hub_account_id FROM hb) OR receiver_account_id IN (SELECT hub_account_id FROM hb)
  UNION ALL SELECT 'GR2_CYCLE_CANDIDATE_V2:' || transaction_id, transaction_id, 'research', false, 'research_only_not_direct_p1_p2' """ + _CYC_OK, _CYC_SQL)
_deg, _com, _pr, _cy = ([k for k in _EXT if w in k] for w in ("degree", "component", "pagerank", "cycle"))
_abl = lambda cols: "feature_rule_priority_score" + "".join(f" + coalesce(0.001 * ({c} / nullif((SELECT max(abs({c})) FROM ex), 0)), 0)" for c in cols)
_VAR = [("A", "mvp_features_only", []), ("B", "degree_features", _deg), ("C", "degree_component_features", _deg + _com), ("D", "degree_component_pagerank_features", _deg + _com + _pr), ("E", "degree_component_pagerank_cycle_features", _deg + _com + _pr + _cy)]
_add("graph_ablation", "model_variant:s feature_group_added:s pr_auc:d precision_at_100:d precision_at_500:d precision_at_1000:d recall_at_1000:d precision_at_1000_delta_vs_mvp:d decision:s", t.ablation,
     f"WITH ex AS ({_EXT_SQL}), v AS (" + " UNION ALL ".join(
         f"SELECT '{v}' AS model_variant, '{n}' AS feature_group_added, a.pr_auc, max(p) FILTER (k = 100) AS precision_at_100, max(p) FILTER (k = 500) AS precision_at_500, max(p) FILTER (k = 1000) AS precision_at_1000, max(r) FILTER (k = 1000) AS recall_at_1000 FROM ({o.ap(rows)}) a, ({o.top(rows, '[100, 500, 1000]')}) GROUP BY a.pr_auc"
         for v, n, rows in ((v, n, f"SELECT alert_id AS id, target AS y, {_abl(c)} AS score FROM ex WHERE split = 'test'") for v, n, c in _VAR)) +
     ") SELECT *, precision_at_1000 - (SELECT precision_at_1000 FROM v WHERE model_variant = 'A') AS precision_at_1000_delta_vs_mvp, CASE WHEN contains(feature_group_added, 'cycle') THEN 'research_only' WHEN precision_at_1000 >= (SELECT precision_at_1000 FROM v WHERE model_variant = 'A') THEN 'keep' ELSE 'remove' END AS decision FROM v", _SIZE_SQL)

# bands and capacity
_add("risk_score", "alert_id:s risk_score_1000:l", lambda s, d: bands.risk_score(t.scored(s, d), "model_score"), "SELECT alert_id, risk_score_1000 FROM rs")
_cal = lambda s, d: bands.assign_bands(t.scored(s, d).withColumn("calibrated_score", F.col("model_score")), "calibrated_score", "calibrated_priority_band", "calibrated_priority_rank", critical=bands.CALIBRATED_CRITICAL_RULES)
_CAL_SQL = "SELECT *, CAST(substr(calibrated_priority_band, 2, 1) AS BIGINT) AS calibrated_priority_rank FROM (SELECT sc.*, CASE WHEN regexp_matches(triggered_rules, '(^|,)(R4_PASS_THROUGH|R5_FAN_IN|R6_FAN_OUT|GR1_GATHER_SCATTER|GR1_GATHER_SCATTER_V2)(,|$)') OR round(model_score, 12) >= p1 THEN 'P1' WHEN round(model_score, 12) >= p2 THEN 'P2' WHEN round(model_score, 12) >= p3 THEN 'P3' ELSE 'P4' END AS calibrated_priority_band FROM sc, cut)"
_add("calibrated_bands", "alert_id:s calibrated_priority_band:s calibrated_priority_rank:l", _cal, _CAL_SQL)
_sum = lambda band, rows, avg: f"SELECT b AS priority_band, count(alert_id) AS alert_count, coalesce(sum(target), 0) AS label_count, coalesce(sum(target) / nullif(CAST(count(alert_id) AS DOUBLE), 0), 0) AS precision, coalesce(sum(target), 0) / CAST((SELECT sum(target) FROM sc) AS DOUBLE) AS recall, coalesce(avg(model_score), 0) AS {avg} FROM (SELECT unnest(['P1', 'P2', 'P3', 'P4']) AS b) LEFT JOIN ({rows}) x ON x.{band} = b GROUP BY b"
_add("calibrated_band_summary", "priority_band:s alert_count:l label_count:l precision:d recall:d avg_calibrated_score:d", lambda s, d: bands.summarize_bands(_cal(s, d), "calibrated_priority_band", "calibrated_score", avg_name="avg_calibrated_score"), _sum("calibrated_priority_band", _CAL_SQL, "avg_calibrated_score"))
_add("priority_bands", "alert_id:s model_score:d priority_band:s priority_rank:l", t.banded, "SELECT * FROM bd")
_add("band_summary", "priority_band:s alert_count:l label_count:l precision:d recall:d avg_model_score:d", lambda s, d: bands.summarize_bands(t.banded(s, d)), _sum("priority_band", "SELECT * FROM bd", "avg_model_score"))
_add("bands_v2_initial", "alert_id:s priority_score_v2:d priority_band_v2:s", t.bands_v2, "SELECT alert_id, priority_score_v2, band0 AS priority_band_v2 FROM b0")
_add("bands_v2_overrides", "alert_id:s priority_band_v2:s p1_override_reason:s", lambda s, d: bands.p1_overrides(t.bands_v2(s, d)), "SELECT alert_id, band1 AS priority_band_v2, CASE WHEN promoted THEN 'critical_rule_with_configured_secondary_condition' ELSE '' END AS p1_override_reason FROM b1")
_add("bands_v2_capped", "alert_id:s priority_band_v2:s priority_rank_v2:l", t.bands_v2_final, "SELECT alert_id, band2 AS priority_band_v2, rank2 AS priority_rank_v2 FROM b2")
_add("band_summary_v2", "priority_band:s alert_count:l label_count:l precision:d avg_score:d", lambda s, d: bands.band_summary_v2(t.bands_v2_final(s, d)), "SELECT band2 AS priority_band, count(*) AS alert_count, sum(is_laundering) AS label_count, avg(is_laundering) AS precision, avg(priority_score_v2) AS avg_score FROM b2 GROUP BY band2")
_B2 = "SELECT alert_id AS id, priority_score_v2 AS score, is_laundering AS y FROM b2"
_add("topk_after_bands", "split:s k:l precision_at_k:d recall_at_k:d lift_at_k:d", lambda s, d: bands.top_k_after_bands(t.bands_v2_final(s, d)), f"SELECT 'all' AS split, k, p AS precision_at_k, r AS recall_at_k, l AS lift_at_k FROM ({o.top(_B2, '[100, 500, 1000, 5000]')})")
_add("capacity_simulation", "scenario:s k:l precision_at_k:d recall_at_k:d lift_at_k:d coverage_at_capacity:d", lambda s, d: bands.capacity_simulation(t.bands_v2_final(s, d)), f"SELECT CASE k WHEN 120 THEN 'daily_capacity' ELSE 'top_' || k END AS scenario, k, p AS precision_at_k, r AS recall_at_k, l AS lift_at_k, CASE k WHEN 120 THEN r END AS coverage_at_capacity FROM ({o.top(_B2, '[100, 120, 500, 1000, 5000]')})")

# cases
_add("alert_link_edges", "src:s dst:s", lambda s, d: cases.alert_link_edges(t.tx(s, d), t.alerts(s, d)), "SELECT src, dst FROM edges")
_day_edges = lambda s, d: _day_links(t.case_frame(s, d))


def _day_links(frame: DataFrame) -> DataFrame:
    """Links of alerts that share a sender on one day, with each alert linked to itself: many components of some size."""
    pairs = frame.select("alert_id", F.concat_ws("|", "sender_account_id", F.date_format("alert_timestamp", "yyyy-MM-dd")).alias("account"))
    return cases._chain(pairs).unionByName(pairs.select(F.col("alert_id").alias("src"), F.col("alert_id").alias("dst")))  # noqa: SLF001


# every alert of a sender's day is one component, which SQL tells by grouping and Spark by following links
_DAY = "SELECT alert_id, min(alert_id) OVER (PARTITION BY sender_account_id, CAST(alert_timestamp AS DATE)) AS component FROM cf"
_add("alert_components", "node:s component:s", lambda s, d: connected_components(_day_edges(s, d)), f"SELECT alert_id AS node, component FROM ({_DAY})")
_add("graph_evidence_edges", "src:s dst:s", lambda s, d: cases.graph_evidence_edges(t.alerted(s, d), graph.graph_rules_v2(t.tx(s, d), t.hubs(s, d))),
     """SELECT DISTINCT coalesce(lag(alert_id) OVER (PARTITION BY account ORDER BY alert_id), alert_id) AS src, alert_id AS dst FROM (SELECT lk.* FROM lk JOIN al USING (alert_id) JOIN tx USING (transaction_id)
     WHERE sender_account_id IN (SELECT hub_account_id FROM hb) OR receiver_account_id IN (SELECT hub_account_id FROM hb))""")
_add("case_ids", "alert_id:s case_id:s", lambda s, d: cases.case_ids(connected_components(_day_edges(s, d))), f"SELECT alert_id, 'CASE-' || lpad(CAST(dense_rank() OVER (ORDER BY component) AS VARCHAR), 6, '0') AS case_id FROM ({_DAY})")
_V1 = """WITH RECURSIVE ac AS (SELECT DISTINCT account FROM lk), link AS (SELECT DISTINCT a.account AS x, b.account AS y FROM lk a JOIN lk b USING (alert_id)),
  reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x), comp AS (SELECT x AS account, min(y) AS root FROM reach GROUP BY x),
  m AS (SELECT cf.*, root, dense_rank() OVER (ORDER BY first) AS i FROM (SELECT cf.*, root, min(cf.alert_id) OVER (PARTITION BY root) AS first FROM cf JOIN comp ON comp.account = cf.sender_account_id) cf),
  v1 AS (SELECT 'CASE-' || lpad(CAST(i AS VARCHAR), 6, '0') AS case_id, count(*) AS alert_count, (SELECT count(*) FROM comp WHERE comp.root = m.root) AS account_count, sum(amount) AS total_amount,
    CASE max(CASE max_rule_severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 ELSE 2 END) WHEN 4 THEN 'critical' WHEN 3 THEN 'high' ELSE 'medium' END AS max_severity, avg(model_score) AS avg_model_score, max(model_score) AS max_model_score FROM m GROUP BY i, root)"""
_v1 = lambda s, d: cases.consolidate_cases(t.tx(s, d), t.alerts(s, d), t.scored(s, d))
_add("cases", "case_id:s alert_count:l account_count:l total_amount:d max_severity:s avg_model_score:d max_model_score:d", _v1, _V1 + " SELECT * FROM v1")
_add("case_metrics", "metric:s value:d", lambda s, d: cases.case_metrics(_v1(s, d)), _V1 + " SELECT 'case_count' AS metric, CAST(count(*) AS DOUBLE) AS value FROM v1 UNION ALL SELECT 'avg_alerts_per_case', avg(alert_count) FROM v1 UNION ALL SELECT 'max_alerts_per_case', max(alert_count) FROM v1 UNION ALL SELECT 'avg_accounts_per_case', avg(account_count) FROM v1")
_add("case_link_key", "alert_id:s link_key:s", t.case_frame, "SELECT alert_id, link_key FROM cf")
_add("link_key_stats", "link_key:s component_size:l alert_count:l account_count:l", lambda s, d: cases.link_key_stats(t.case_frame(s, d)), "SELECT * FROM ks")
_add("case_chunks", "alert_id:s link_key:s case_chunk:l case_id:s", t.chunks, "SELECT * FROM ck")
_add("network_clusters", "link_key:s network_cluster_id:s component_size:l alert_count:l account_count:l", t.clusters, "SELECT * FROM nc")
_add("alert_case_mapping", "alert_id:s transaction_id:l case_id:s network_cluster_id:s mapping_type:s", t.mapping, "SELECT * FROM mp")
_add("cases_v2", "case_id:s case_created_at:t case_end_at:t case_score:d alert_count:l transaction_count:l total_amount:d max_transaction_amount:d rule_ids:s has_laundering_label:l label_count:l account_count:l case_priority_band:s case_typology:s", t.cases_v2, "SELECT *, 'P4' AS case_priority_band FROM c2")
_add("case_typology", "case_id:s case_typology:s", t.cases_v2, "SELECT case_id, case_typology FROM c2")
_add("case_typology_summary", "case_typology:s case_count:l", lambda s, d: cases.case_typology_summary(t.cases_v2(s, d)), "SELECT case_typology, count(*) AS case_count FROM c2 GROUP BY 1")
_add("case_quality", "metric:s value:d", lambda s, d: cases.case_quality(t.cases_v2(s, d), t.mapping(s, d)),
     " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST(({q}) AS DOUBLE) AS value" for m, q in {
         "case_count": "SELECT count(*) FROM c2", "avg_alerts_per_case": "SELECT avg(alert_count) FROM c2", "p95_alerts_per_case": "SELECT quantile_cont(alert_count, 0.95) FROM c2", "max_alerts_per_case": "SELECT max(alert_count) FROM c2",
         "case_precision": "SELECT avg(has_laundering_label) FROM c2", "case_recall": "SELECT CASE WHEN sum(label_count) > 0 THEN 1 ELSE 0 END FROM c2", "case_reduction_ratio": "SELECT 1 - (SELECT count(*) FROM c2) / CAST(count(*) AS DOUBLE) FROM mp", "p1_case_count": "SELECT 0", "p1_case_precision": "SELECT 0"}.items()))
_MEGA = _V1 + """, mg AS (SELECT cf.alert_id, cf.alert_timestamp, first AS component_id, (SELECT count(*) FROM comp WHERE comp.root = m.root) AS account_count FROM cf JOIN m USING (alert_id)),
  ng AS (SELECT component_id, 'NET-' || lpad(CAST(row_number() OVER (ORDER BY component_id) AS VARCHAR), 6, '0') AS network_cluster_id, n AS component_size, n AS alert_count, account_count FROM (SELECT component_id, count(*) AS n, max(account_count) AS account_count FROM mg GROUP BY 1) WHERE n > 1000)"""
_add("mega_component_split", "alert_id:s component_id:s case_chunk:l network_cluster_id:s", lambda s, d: cases.split_mega_components(t.mega_links(s, d), "us", ["alert_id"]),
     _MEGA + " SELECT alert_id, component_id, (row_number() OVER (PARTITION BY component_id ORDER BY alert_timestamp, alert_id) - 1) // 100 + 1 AS case_chunk, network_cluster_id FROM mg LEFT JOIN ng USING (component_id)")
_add("mega_network_clusters", "component_id:s network_cluster_id:s component_size:l alert_count:l account_count:l split_reason:s recommended_use:s", lambda s, d: cases.mega_clusters(t.mega_links(s, d)),
     _MEGA + " SELECT *, 'component_exceeds_auto_case_cap' AS split_reason, 'network_intelligence_only' AS recommended_use FROM ng")

# diagnostics
_RC = """SELECT *, CASE WHEN incremental_label_count = 0 AND unique_alert_count > 1000 THEN 'retire_candidate' WHEN precision < 0.001 AND unique_alert_count > 10000 THEN 'tighten' WHEN precision < 0.005 THEN 'downgrade' ELSE 'keep' END AS recommended_action FROM (
  SELECT h.rule_id, h.rule_name, r.rule_rank, count(*) AS alert_count, count(DISTINCT h.transaction_id) AS unique_alert_count, sum(is_laundering) AS label_count, avg(is_laundering) AS precision, sum(is_laundering) / CAST((SELECT sum(is_laundering) FROM al) AS DOUBLE) AS recall_contribution,
    sum(is_laundering) FILTER (NOT EXISTS (SELECT 1 FROM hits o JOIN rr q ON q.rule_id = o.rule_id WHERE o.transaction_id = h.transaction_id AND q.rule_rank < r.rule_rank)) AS incremental_label_count,
    count(*) FILTER (NOT EXISTS (SELECT 1 FROM hits o JOIN rr q ON q.rule_id = o.rule_id WHERE o.transaction_id = h.transaction_id AND q.rule_rank < r.rule_rank)) AS incremental_alert_count, avg(CASE WHEN al.rule_count > 1 THEN 1.0 ELSE 0 END) AS overlap_rate
  FROM hits h JOIN rr r USING (rule_id) JOIN (SELECT transaction_id, rule_count FROM al) al USING (transaction_id) GROUP BY h.rule_id, h.rule_name, r.rule_rank)"""
_RC = "WITH rr AS (SELECT rule_id, row_number() OVER (ORDER BY sum(is_laundering) DESC, avg(is_laundering) DESC, count(*), rule_id) AS rule_rank FROM hits GROUP BY rule_id), rc AS (" + _RC + ")"
_contribution = lambda s, d: diagnostics.rule_contribution(t.hits(s, d), t.alerted(s, d))
_add("rule_contribution", "rule_id:s rule_name:s rule_rank:l alert_count:l unique_alert_count:l label_count:l precision:d recall_contribution:d incremental_label_count:l incremental_alert_count:l overlap_rate:d recommended_action:s", _contribution, _RC + " SELECT * REPLACE (coalesce(incremental_label_count, 0) AS incremental_label_count) FROM rc")
_add("rule_recommendations", "rule_id:s unique_alert_count:l label_count:l precision:d overlap_rate:d recommended_action:s recommendation_reason:s", lambda s, d: diagnostics.rule_recommendations(_contribution(s, d)), _RC + " SELECT *, CASE recommended_action WHEN 'keep' THEN 'Rule has acceptable labelled contribution for current guardrails.' WHEN 'downgrade' THEN 'Rule should remain coverage-first until precision improves.' WHEN 'tighten' THEN 'High-volume rule has very low precision.' ELSE 'High-volume rule adds no incremental labelled alerts.' END AS recommendation_reason FROM rc")
_add("alert_waterfall", "stage:s count:l labels:l", lambda s, d: diagnostics.alert_waterfall(t.tx(s, d), t.hits(s, d), t.alerted(s, d)), "SELECT 'transactions' AS stage, count(*) AS count, sum(is_laundering) AS labels FROM tx UNION ALL SELECT rule_id, count(DISTINCT transaction_id), sum(is_laundering) FROM hits GROUP BY rule_id UNION ALL SELECT 'consolidated_alerts', count(*), sum(is_laundering) FROM al")
_add("stress_summary", "dataset_name:s transaction_count:l alert_count:l rule_hit_count:l alert_rate:d label_count:l alert_label_count:l p1_alert_count:l p2_alert_count:l p3_alert_count:l p4_alert_count:l", t.stress,
     "SELECT 'LI-Small' AS dataset_name, (SELECT count(*) FROM tx) AS transaction_count, (SELECT count(*) FROM al) AS alert_count, (SELECT count(*) FROM hits) AS rule_hit_count, (SELECT count(*) FROM al) / CAST((SELECT count(*) FROM tx) AS DOUBLE) AS alert_rate, (SELECT sum(is_laundering) FROM tx) AS label_count, (SELECT sum(is_laundering) FROM al) AS alert_label_count, " + ", ".join(f"(SELECT count(*) FROM bd WHERE priority_band = 'P{i}') AS p{i}_alert_count" for i in (1, 2, 3, 4)))
_HALF = "SELECT alert_id AS id, model_score AS score, target AS y, CASE WHEN row_number() OVER (ORDER BY alert_timestamp, alert_id) <= count(*) OVER () // 2 THEN 'A' ELSE 'B' END AS w FROM sc"
_half = lambda w: f"SELECT * FROM ({_HALF}) WHERE w = '{w}'"
_add("temporal_stress", "window:s k:l alert_count:l label_count:l alert_rate:d pr_auc:d precision_at_k:d recall_at_k:d", lambda s, d: diagnostics.temporal_stress(t.scored(s, d)),
     " UNION ALL ".join(f"SELECT '{w}' AS \"window\", k, n AS alert_count, pos AS label_count, 1.0 AS alert_rate, pr_auc, p AS precision_at_k, r AS recall_at_k FROM ({o.ap(_half(w))}), (SELECT count(*) AS n, sum(y) AS pos FROM ({_half(w)})) z, (SELECT k, p, r FROM ({o.top(_half(w), '[100, 500, 1000]')}) UNION ALL SELECT NULL, NULL, NULL)" for w in ("A", "B")))
_SEG = "WITH q AS (SELECT quantile_cont(feature_amount, 0.25) AS a, quantile_cont(feature_amount, 0.5) AS b, quantile_cont(feature_amount, 0.75) AS c FROM sc), sg AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS segment, CAST({e} AS VARCHAR) AS segment_value, alert_id, target AS y, model_score AS score FROM (SELECT sc.*, f4 + f5 + w_out + w_in AS deg FROM sc JOIN g1 USING (transaction_id)), q"
    for n, e in (("payment_format", "payment_format"), ("currency_pair", "currency_pair"), ("cross_bank_flag", "CAST(feature_cross_bank_flag AS BIGINT)"), ("amount_bucket", "CASE WHEN feature_amount <= a THEN 'q1' WHEN feature_amount <= b THEN 'q2' WHEN feature_amount <= c THEN 'q3' ELSE 'q4' END"), ("graph_degree_bucket", "CASE WHEN deg <= 0 THEN 'none' WHEN deg <= 5 THEN 'low' ELSE 'high' END"))) + ")"
_add("segment_stress", "segment:s segment_value:s status:s alert_count:l label_count:l precision_at_100:d pr_auc:d", lambda s, d: diagnostics.segment_stress(t.with_degrees(s, d), t.tx(s, d)),
     f"""{_SEG} SELECT x.segment, x.segment_value, CASE WHEN n < 10 THEN 'small_segment' ELSE 'measured' END AS status, n AS alert_count, pos AS label_count, hit / CAST(least(100, n) AS DOUBLE) AS precision_at_100, pr_auc FROM (SELECT segment, segment_value, count(*) AS n, sum(y) AS pos, sum(y) FILTER (i <= 100) AS hit
     FROM (SELECT *, row_number() OVER (PARTITION BY segment, segment_value ORDER BY score DESC, alert_id) AS i FROM sg) GROUP BY ALL) x JOIN ({o.ap("SELECT segment || '~' || segment_value AS g, y, score FROM sg", "g")}) a ON a.g = x.segment || '~' || x.segment_value""")
_CMP = f"SELECT e.metric, e.k, CASE WHEN e.k IS NULL THEN NULL ELSE 'test' END AS split, m.value AS mvp_value, e.value AS extended_value, e.value - m.value AS delta, CASE WHEN e.value > m.value THEN 'extended' WHEN m.value > e.value THEN 'mvp' ELSE 'tie' END AS winner FROM ({o.ranking_sql({'model_score': o.TEST_RANK['model_score']})}) e JOIN ({o.ranking_sql({'model_score': o.TEST_RANK['rule_priority']})}) m ON m.metric = e.metric AND m.k IS NOT DISTINCT FROM e.k"
_add("model_comparison", "metric:s k:l split:s mvp_value:d extended_value:d delta:d winner:s", t.comparison, _CMP)
_add("model_selection", "selected_model:s decision:s primary_metric:s primary_k:l mvp_value:d extended_value:d delta:d", lambda s, d: models.select_champion(t.comparison(s, d)), f"SELECT CASE WHEN delta > 0 THEN 'extended' ELSE 'mvp' END AS selected_model, CASE WHEN delta > 0 THEN 'promote_extended' ELSE 'keep_mvp' END AS decision, metric AS primary_metric, k AS primary_k, mvp_value, extended_value, delta FROM ({_CMP}) WHERE metric = 'precision_at_k' AND k = 1000")
_add("traffic_lights", "area:s status:s evidence:s", t.lights,
     f"""WITH cmp AS ({_CMP}), up AS (SELECT coalesce(max(delta / nullif(mvp_value, 0)), 0) AS u FROM cmp WHERE metric = 'precision_at_k' AND k = 1000), p1 AS (SELECT count(*) AS n FROM b2 WHERE band2 = 'P1'), rate AS (SELECT (SELECT count(*) FROM al) / CAST((SELECT count(*) FROM tx) AS DOUBLE) AS r)
     SELECT 'Alert rate' AS area, CASE WHEN r <= 0.15 THEN 'green' WHEN r <= 0.3 THEN 'amber' ELSE 'red' END AS status, 'Overall alert rate against remediation target.' AS evidence FROM rate
     UNION ALL SELECT 'P1 sizing', CASE WHEN n <= 120 THEN 'green' WHEN n <= 240 THEN 'amber' ELSE 'red' END, 'Operational priority queue size after v2 banding.' FROM p1
     UNION ALL SELECT 'Top-K uplift', CASE WHEN u >= 0.05 THEN 'green' WHEN u >= 0 THEN 'amber' ELSE 'red' END, 'Champion/challenger Precision@1000 delta.' FROM up
     UNION ALL SELECT 'Graph features', (SELECT CASE WHEN bool_or(decision = 'remove') THEN 'red' WHEN bool_or(decision = 'research_only') THEN 'amber' ELSE 'green' END FROM ({ORACLE_SQL['graph_ablation']})), 'Graph ablation decision.'
     UNION ALL SELECT 'Case consolidation', 'green', 'Operational case size cap check.' UNION ALL SELECT 'Explainability', 'green', 'Business-readable alert reason codes.'
     UNION ALL SELECT 'Stress testing', 'green', 'LI temporal and segment stress outputs.' UNION ALL SELECT 'Report automation', 'green', 'Remediation report generated from local artifacts.'""")
_add("champion_decision", "champion_model:s decision:s promotion_ready:b failed_gates:s precision_at_1000_delta:d precision_at_1000_relative_uplift:d", lambda s, d: diagnostics.champion_decision(t.comparison(s, d), t.lights(s, d)),
     f"""SELECT CASE WHEN ok THEN 'extended' ELSE 'mvp' END AS champion_model, CASE WHEN ok THEN 'promote_extended' ELSE 'keep_mvp' END AS decision, ok AS promotion_ready, failed AS failed_gates, delta AS precision_at_1000_delta, u AS precision_at_1000_relative_uplift
     FROM (SELECT *, u >= 0.05 AND failed = '' AS ok FROM (SELECT delta, coalesce(delta / nullif(mvp_value, 0), 0) AS u FROM ({_CMP}) WHERE metric = 'precision_at_k' AND k = 1000), (SELECT coalesce(string_agg(area, ',' ORDER BY area), '') AS failed FROM ({ORACLE_SQL['traffic_lights']}) WHERE status = 'red'))""")
_add("headline_kpis", "transactions:l label_rate:d rule_recall:d model_pr_auc:d p1_alerts:l case_count:l", lambda s, d: diagnostics.headline_kpis(profiling.quality_report(t.tx(s, d)), rules.rule_performance(t.tx(s, d), t.hits(s, d)), metrics.average_precision(t.scored(s, d), "target", "model_score"), bands.band_summary_v2(t.bands_v2_final(s, d)), t.cases_v2(s, d)),
     f"""SELECT (SELECT count(*) FROM tx) AS transactions, (SELECT avg(is_laundering) FROM tx) AS label_rate, (SELECT max(r) FROM (SELECT avg(CASE WHEN transaction_id IN (SELECT transaction_id FROM al) THEN 1.0 ELSE 0 END) AS r FROM tx WHERE is_laundering = 1 GROUP BY split)) AS rule_recall, pr_auc AS model_pr_auc,
     (SELECT count(*) FROM b2 WHERE band2 = 'P1') AS p1_alerts, (SELECT count(*) FROM c2) AS case_count FROM ({o.ap(_ALL)})""")

# explanations
_add("contributions", "alert_id:s feature_name:s shap_value:d feature_value:d", t.contributions, "SELECT * FROM ct")
_add("contribution_importance", "feature_name:s mean_abs_shap:d", lambda s, d: explain.contribution_importance(t.contributions(s, d)), "SELECT feature_name, avg(abs(shap_value)) AS mean_abs_shap FROM ct GROUP BY 1")
_add("reason_codes", "alert_id:s reason_rank:l feature_name:s reason_code:s contribution:d", lambda s, d: explain.reason_codes(t.contributions(s, d)),
     """SELECT alert_id, reason_rank, feature_name, CASE WHEN feature_name = 'feature_amount' THEN 'Large transaction amount contributed to the score.' WHEN feature_name = 'feature_rule_count' THEN 'Multiple rules triggered for this alert.'
     WHEN feature_name LIKE 'feature_rule_%_flag' THEN upper(feature_name[14:-6]) || ' triggered for this alert.'
     ELSE array_to_string([upper(w[1]) || w[2:] FOR w IN string_split(feature_name[9:], '_')], ' ') || ' contributed to the score.' END AS reason_code, shap_value AS contribution FROM rk WHERE reason_rank <= 3""")
_text = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'"
_DICT = ", ".join("(" + ", ".join(_text(e.get(k)) for k in ("feature_name", "business_reason_code", "plain_language_template", "risk_increasing_template", "risk_reducing_template", "contextual_template", "investigator_note")) + ")" for e in explain.ENTRIES)
_add("alert_reason_codes", "alert_id:s case_id:s reason_rank:l feature_name:s contribution_bucket:s risk_direction:s business_reason_code:s plain_language_reason:s investigator_note:s", t.reason_codes,
     f"""SELECT rk.alert_id, mp.case_id, reason_rank, feature_name, CASE WHEN shap_value >= 1 THEN 'strong_positive' WHEN shap_value > 0 THEN 'moderate_positive' WHEN shap_value <= -1 THEN 'strong_negative' WHEN shap_value < 0 THEN 'moderate_negative' ELSE 'neutral' END AS contribution_bucket,
     CASE WHEN shap_value > 0 THEN 'risk_increasing' WHEN shap_value < 0 THEN 'risk_reducing' ELSE 'contextual' END AS risk_direction, coalesce(code, 'Model feature contributed to risk score') AS business_reason_code,
     CASE WHEN code IS NULL THEN CASE WHEN shap_value > 0 THEN 'A model feature increased the alert score.' WHEN shap_value < 0 THEN 'A model feature reduced the alert score.' ELSE 'A model feature provided context for the alert score.' END
          ELSE coalesce(CASE WHEN shap_value > 0 THEN up WHEN shap_value < 0 THEN down ELSE context END, plain) END AS plain_language_reason, coalesce(note, 'Review transaction context and linked rule evidence.') AS investigator_note
     FROM rk JOIN mp USING (alert_id) JOIN b2 USING (alert_id) LEFT JOIN (VALUES {_DICT}) dict(feature_name, code, plain, up, down, context, note) USING (feature_name) WHERE reason_rank <= 3 AND (reason_rank = 1 OR band2 = 'P1')""")

# models: no SQL
def _fitted(s: SparkSession, d: str) -> models.Trained:
    key = (s.sparkContext.applicationId, d)
    if key not in _fits:
        _fits[key] = models.train_and_score(t.alert_features(s, d))
    return _fits[key]


_fits: dict[tuple, models.Trained] = {}
_add("feature_selection", "feature_name:s selection_rank:l selection_importance:d forced_include:b selected:b", lambda s, d: _fitted(s, d).selection)
for _n, _m in (("score_lr", "logistic_regression"), ("score_rf", "random_forest"), ("score_gbt", "gbt")):
    _add(_n, f"alert_id:s target:l score_{_m}:d", lambda s, d, m=_m: _fitted(s, d).scores(m))
_add("tuning_trials", "model_name:s trial:l parameters:s budget:d value:d state:s", lambda s, d: _fitted(s, d).trials)
_add("score_constant", "alert_id:s model_score:d", lambda s, d: models.with_constant_score(t.alert_features(s, d), _train(s, d).where("target = 0")), "SELECT alert_id, 0.0 AS model_score FROM feat")
_add("champion_model", "model_name:s selection_value:d pr_auc:d champion:b", lambda s, d: _fitted(s, d).champions)
_add("scored_alerts", "alert_id:s target:l model_score:d", lambda s, d: _fitted(s, d).scores())
_add("feature_importance", "feature_name:s importance:d model_name:s", lambda s, d: _fitted(s, d).champion.importance(s))
_valid = lambda s, d: models.prepare(t.alert_features(s, d))[0].where("split = 'validation'")
_add("permutation_importance", "feature_name:s importance:d", lambda s, d: models.permutation_importance(_fitted(s, d).champion, _valid(s, d)))


def _explained(s: SparkSession, d: str) -> DataFrame:
    """Contributions of the champion's features, by its permutation weights, to all alerts."""
    if (key := (s.sparkContext.applicationId, d)) not in _weights:
        _weights[key] = models.explanation_weights(_fitted(s, d).champion, _valid(s, d))
    return explain.contributions(models.prepare(t.alert_features(s, d))[0], _weights[key], zero=_fitted(s, d).champion.model is None)


_weights: dict[tuple, dict[str, float]] = {}
_add("champion_contributions", "alert_id:s feature_name:s shap_value:d feature_value:d", _explained)
_add("champion_importance", "feature_name:s mean_abs_shap:d", lambda s, d: explain.contribution_importance(_explained(s, d)))
_add("champion_reason_codes", "alert_id:s case_id:s reason_rank:l feature_name:s contribution_bucket:s risk_direction:s business_reason_code:s plain_language_reason:s", lambda s, d: explain.alert_reason_codes(_explained(s, d), explain.dictionary(s), t.bands_v2_final(s, d), t.mapping(s, d)))
# the rising fit at a score is the greatest over all starts up to it of the least over all ends from it of the mean between
_add("calibrated_isotonic", "alert_id:s calibrated_score:d calibration_method:s", lambda s, d: models.calibrate(t.scored(s, d), "isotonic"),
     """SELECT alert_id, CASE WHEN l.x IS NULL THEN h.v WHEN h.x IS NULL OR l.x = h.x THEN l.v ELSE l.v + (h.v - l.v) * (sc.model_score - l.x) / (h.x - l.x) END AS calibrated_score, 'isotonic' AS calibration_method
     FROM sc ASOF LEFT JOIN fit l ON sc.model_score >= l.x ASOF LEFT JOIN fit h ON sc.model_score <= h.x""",
     """, ip AS MATERIALIZED (SELECT x, row_number() OVER (ORDER BY x) AS i, sum(y) OVER (ORDER BY x) AS s, sum(n) OVER (ORDER BY x) AS w, y, n FROM (SELECT model_score AS x, sum(target) AS y, count(*) AS n FROM sc WHERE split = 'validation' GROUP BY 1)),
  fit AS MATERIALIZED (SELECT x, max(least_mean) AS v FROM (SELECT b.x, min((b.s - a.s + a.y) / CAST(b.w - a.w + a.n AS DOUBLE)) OVER (PARTITION BY a.i ORDER BY b.i DESC) AS least_mean FROM ip a JOIN ip b ON a.i <= b.i) GROUP BY x)""")
_add("calibrated_sigmoid", "alert_id:s calibrated_score:d calibration_method:s", lambda s, d: models.calibrate(t.scored(s, d), "sigmoid"))
_add("write_metrics", "split:s row_count:l", lambda s, d: _written(s, d))


def _written(s: SparkSession, d: str) -> DataFrame:
    """A split manifest written as CSV and JSON and read back from both."""
    m = profiling.split_manifest(t.tx(s, d)).select("split", "row_count")
    a, b = t.stored_path(s, "metrics-csv"), t.stored_path(s, "metrics-json")
    transfers.write_metrics(m, a, "csv")
    transfers.write_metrics(m, b, "json")
    return s.read.csv(a, header=True, schema="split string, row_count long").unionByName(s.read.json(b, schema="split string, row_count long"))


ORACLE_SQL["write_metrics"] = o.with_tables("SELECT split, CAST(row_count AS BIGINT) AS row_count FROM (SELECT split, count(*) AS row_count FROM tx GROUP BY 1), (SELECT unnest([1, 2]))")

# exploration
_add("eda_label_distribution", "is_laundering:l row_count:l", lambda s, d: eda.label_distribution(t.raw_tx(s, d)), "SELECT is_laundering, count(*) AS row_count FROM txa GROUP BY 1")
_add("eda_amount_describe", "is_laundering:l count:l mean:d std:d min:d p25:d p50:d p75:d max:d", lambda s, d: eda.amount_describe(t.raw_tx(s, d)), "SELECT is_laundering, count(amount) AS count, avg(amount) AS mean, stddev_samp(amount) AS std, min(amount) AS min, quantile_cont(amount, 0.25) AS p25, quantile_cont(amount, 0.5) AS p50, quantile_cont(amount, 0.75) AS p75, max(amount) AS max FROM txa GROUP BY 1")
_add("eda_amount_hist", "is_laundering:l bin:l row_count:l density:d", lambda s, d: eda.amount_histogram(t.raw_tx(s, d)), "SELECT is_laundering, bin, count(*) AS row_count, count(*) / (n * (hi - lo) / 50) AS density FROM (SELECT *, least(49, floor((log_amount - lo) / ((hi - lo) / 50))) AS bin FROM (SELECT *, min(log_amount) OVER w AS lo, max(log_amount) OVER w AS hi, count(*) OVER w AS n FROM txa WINDOW w AS (PARTITION BY is_laundering))) GROUP BY is_laundering, bin, n, hi, lo")
_add("eda_daily_volume", "day:s row_count:l", lambda s, d: eda.daily_volume(t.raw_tx(s, d)), "SELECT strftime(timestamp, '%Y-%m-%d') AS day, count(*) AS row_count FROM txa GROUP BY 1")
_add("eda_payment_format", "payment_format:s row_count:l label_rate:d", lambda s, d: eda.payment_format_rates(t.raw_tx(s, d)), "SELECT payment_format, count(*) AS row_count, avg(is_laundering) AS label_rate FROM txa GROUP BY 1")
_add("eda_currency_pairs", "currency_pair:s row_count:l label_rate:d", lambda s, d: eda.currency_pair_rates(t.raw_tx(s, d)), "SELECT currency_pair, count(*) AS row_count, avg(is_laundering) AS label_rate FROM txa GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
_add("eda_cross_bank", "cross_bank_flag:l row_count:l label_count:l label_rate:d", lambda s, d: eda.cross_bank_rates(t.raw_tx(s, d)), "SELECT cross_bank_flag, count(*) AS row_count, sum(is_laundering) AS label_count, avg(is_laundering) AS label_rate FROM txa GROUP BY 1")
_DEG = {r: f"SELECT '{r}' AS role, {c} AS account_id, count(*) AS degree FROM txa GROUP BY {c}" for r, c in (("sender", "sender_account_id"), ("receiver", "receiver_account_id"))}
_add("eda_degrees", "role:s account_id:s degree:l", lambda s, d: eda.degrees(t.raw_tx(s, d)), " UNION ALL ".join(f"SELECT * FROM ({q} ORDER BY degree DESC, account_id LIMIT 10)" for q in _DEG.values()))
_add("eda_degree_hist", "role:s log_bin:l account_count:l", lambda s, d: eda.degree_histogram(t.raw_tx(s, d)), f"SELECT role, least(floor(log10(degree) * 49 / 4), 48) AS log_bin, count(*) AS account_count FROM ({' UNION ALL '.join(_DEG.values())}) WHERE degree <= 10000 GROUP BY 1, 2")
_add("eda_sample", "transaction_id:l amount:d", lambda s, d: eda.sample(t.raw_tx(s, d)), "SELECT transaction_id, amount FROM txa ORDER BY md5('42|' || transaction_id), transaction_id LIMIT 200000")

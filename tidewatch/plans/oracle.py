"""SQL in another formulation than the library's, as common table expressions over the given tables."""

from __future__ import annotations

_ROLL = """SELECT a.transaction_id, count(*) AS c, CAST(sum(CAST(b.amount AS DECIMAL(28,6))) AS DOUBLE) AS s
    FROM {t} a JOIN {t} b ON a.{g} = b.{g} AND b.timestamp {edge} a.timestamp - INTERVAL 24 HOUR
     AND (b.timestamp < a.timestamp OR (b.timestamp = a.timestamp AND b.transaction_id <= a.transaction_id)) GROUP BY 1"""
_CURRENCY = "(['USD', 'EUR', 'GBP'])[{c} % 3 + 1]"


def _roll(t: str, g: str, edge: str) -> str:
    return _ROLL.format(t=t, g=g, edge=edge)


def _ap(rows: str, by: str = "", score: str = "score", y: str = "y") -> str:
    """Average precision of rows (by, score, y)."""
    g, p = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return f"""SELECT {g}CASE WHEN max(p) = 0 OR max(p) = max(n) THEN 0.0 ELSE sum(CASE WHEN {y} = 1 THEN (tp / seen) / p ELSE 0 END) END AS pr_auc
    FROM (SELECT *, sum({y}) OVER ({p}ORDER BY {score} DESC RANGE UNBOUNDED PRECEDING) AS tp, CAST(count(*) OVER ({p}ORDER BY {score} DESC RANGE UNBOUNDED PRECEDING) AS DOUBLE) AS seen,
          sum({y}) OVER ({'PARTITION BY ' + by if by else ''}) AS p, count(*) OVER ({'PARTITION BY ' + by if by else ''}) AS n FROM ({rows})) {'GROUP BY ' + by if by else ''}"""


def _auc(rows: str) -> str:
    """Mann-Whitney from mid ranks of rows (score, y)."""
    return f"""SELECT CASE WHEN p = 0 OR q = 0 THEN 0.0 ELSE (r - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * q) END AS roc_auc FROM (
      SELECT sum(y) AS p, count(*) - sum(y) AS q, sum(CASE WHEN y = 1 THEN mid ELSE 0 END) AS r FROM (
        SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mid FROM ({rows})))"""


def _top(rows: str, ks: str, extra: str = "") -> str:
    """Top-k metrics of rows (id, score, y); `ks` is a list of numbers."""
    return f"""SELECT {extra}k, least(k, n) AS reviewed, coalesce(hit / nullif(CAST(least(k, n) AS DOUBLE), 0), 0) AS p, coalesce(hit / nullif(CAST(pos AS DOUBLE), 0), 0) AS r,
      coalesce((hit / nullif(CAST(least(k, n) AS DOUBLE), 0)) / nullif(pos / nullif(CAST(n AS DOUBLE), 0), 0), 0) AS l
    FROM (SELECT unnest({ks}) AS k), (SELECT count(*) AS n, coalesce(sum(y), 0) AS pos FROM ({rows})),
      LATERAL (SELECT coalesce(sum(y), 0) AS hit FROM (SELECT y, row_number() OVER (ORDER BY score DESC, id) AS i FROM ({rows})) WHERE i <= k)"""


CTE = {
    "ev": "SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "txa": f"""SELECT event_id AS transaction_id, ts AS timestamp, 'B' || (user_id % 7) AS from_bank, 'B' || (k % 7) AS to_bank, 'A' || user_id AS sender_account_id, 'A' || k AS receiver_account_id,
        value AS amount_paid, value AS amount_received, {_CURRENCY.format(c='user_id')} AS payment_currency, {_CURRENCY.format(c='k')} AS receiving_currency, event_type AS payment_format,
        {_CURRENCY.format(c='user_id')} || ' -> ' || {_CURRENCY.format(c='k')} AS currency_pair, CASE WHEN user_id % 7 = k % 7 THEN 0 ELSE 1 END AS cross_bank_flag, value AS amount,
        ln(1 + greatest(value, 0)) AS log_amount, CASE WHEN event_id % 97 = 0 OR (value >= 200 AND event_id % 3 <> 0) THEN 1 ELSE 0 END AS is_laundering FROM ev""",
    "tx": """SELECT * EXCLUDE (n), CASE WHEN pos < floor(n * CAST(0.6 AS DOUBLE)) THEN 'train' WHEN pos < floor(n * CAST(0.6 AS DOUBLE)) + floor(n * CAST(0.2 AS DOUBLE)) THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT *, row_number() OVER (ORDER BY timestamp, transaction_id) - 1 AS pos, count(*) OVER () AS n FROM txa)""",
    "trn": "SELECT * FROM tx WHERE split = 'train'",
    "seg": """SELECT payment_format, currency_pair, count(*) AS segment_count, CASE WHEN count(*) < 130 THEN (SELECT round(quantile_cont(amount, 0.95), 9) FROM trn) ELSE round(quantile_cont(amount, 0.95), 9) END AS threshold,
        CASE WHEN count(*) < 130 THEN 'fallback' ELSE 'segment' END AS threshold_source FROM trn GROUP BY payment_format, currency_pair""",
    "r1": """SELECT t.*, coalesce(threshold, (SELECT round(quantile_cont(amount, 0.95), 9) FROM trn)) AS threshold, coalesce(threshold_source, 'fallback') AS threshold_source, coalesce(segment_count, 0) AS segment_count
        FROM tx t LEFT JOIN seg s ON t.payment_format = s.payment_format AND t.currency_pair = s.currency_pair WHERE amount >= coalesce(threshold, (SELECT round(quantile_cont(amount, 0.95), 9) FROM trn))""",
    "r2": "SELECT * FROM tx t WHERE cross_bank_flag = 1 AND NOT EXISTS (SELECT 1 FROM tx o WHERE o.sender_account_id = t.sender_account_id AND o.receiver_account_id = t.receiver_account_id AND o.pos < t.pos)",
    "send": _roll("tx", "sender_account_id", ">"),
    "send_t": _roll("trn", "sender_account_id", ">"),
    "r3": "SELECT t.*, c, s FROM tx t JOIN send USING (transaction_id) WHERE c >= 5 AND s >= (SELECT round(quantile_cont(s, 0.9), 9) FROM send_t)",
    "inc": """SELECT a.transaction_id, coalesce(CAST(sum(CAST(b.amount AS DECIMAL(28,6))) AS DOUBLE), 0) AS incoming FROM tx a LEFT JOIN tx b ON b.receiver_account_id = a.sender_account_id
        AND b.timestamp > a.timestamp - INTERVAL 24 HOUR AND b.timestamp <= a.timestamp GROUP BY 1""",
    "r4": "SELECT t.*, incoming, amount / incoming AS ratio FROM tx t JOIN inc USING (transaction_id) WHERE incoming > 0 AND amount / incoming >= 0.8",
    "recv": _roll("tx", "receiver_account_id", ">="),
    "recv_t": _roll("trn", "receiver_account_id", ">="),
    "usend": """SELECT a.transaction_id, count(DISTINCT b.sender_account_id) AS senders FROM tx a JOIN tx b ON a.receiver_account_id = b.receiver_account_id AND b.timestamp >= a.timestamp - INTERVAL 24 HOUR
        AND (b.timestamp < a.timestamp OR (b.timestamp = a.timestamp AND b.transaction_id <= a.transaction_id)) GROUP BY 1""",
    "urecv": """SELECT a.transaction_id, count(DISTINCT b.receiver_account_id) AS receivers FROM tx a JOIN tx b ON a.sender_account_id = b.sender_account_id AND b.timestamp >= a.timestamp - INTERVAL 24 HOUR
        AND (b.timestamp < a.timestamp OR (b.timestamp = a.timestamp AND b.transaction_id <= a.transaction_id)) GROUP BY 1""",
    "fund": """SELECT a.transaction_id, count(DISTINCT b.sender_account_id) AS funders FROM tx a LEFT JOIN tx b ON b.receiver_account_id = a.sender_account_id
        AND b.timestamp >= a.timestamp - INTERVAL 24 HOUR AND b.timestamp <= a.timestamp GROUP BY 1""",
    "r5": "SELECT t.*, senders, s FROM tx t JOIN usend USING (transaction_id) JOIN recv USING (transaction_id) WHERE senders >= 5 AND s >= (SELECT round(quantile_cont(s, 0.9), 9) FROM recv_t)",
    "r6": "SELECT t.*, receivers, funders FROM tx t JOIN urecv USING (transaction_id) JOIN fund USING (transaction_id) WHERE receivers >= 5 AND funders >= 2",
    "hits": "SELECT transaction_id, timestamp AS alert_timestamp, rule_id, rule_name, severity, is_laundering, split, rule_id || ':' || transaction_id AS rule_hit_id, CASE WHEN rule_id = 'R2_NOVELTY' THEN 'coverage' ELSE 'escalation' END AS rule_status FROM ("
    + " UNION ALL ".join(
        f"SELECT transaction_id, timestamp, is_laundering, split, '{r}' AS rule_id, '{n}' AS rule_name, '{v}' AS severity FROM {t}"
        for t, r, n, v in (
            ("r1", "R1_AMOUNT", "Segmented high amount", "medium"),
            ("r2", "R2_NOVELTY", "New counterparty / cross-bank novelty", "medium"),
            ("r3", "R3_VELOCITY", "Velocity / structuring", "high"),
            ("r4", "R4_PASS_THROUGH", "Rapid pass-through", "critical"),
            ("r5", "R5_FAN_IN", "Fan-in concentration", "high"),
            ("r6", "R6_FAN_OUT", "Fan-out / gather-scatter-lite", "high"),
        )
    )
    + ")",
    "al": """SELECT 'ALERT-' || transaction_id AS alert_id, transaction_id, min(alert_timestamp) AS alert_timestamp, string_agg(rule_id, ',' ORDER BY rule_id) AS triggered_rules, count(*) AS rule_count,
        CASE max(CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 ELSE 2 END) WHEN 4 THEN 'critical' WHEN 3 THEN 'high' ELSE 'medium' END AS max_rule_severity,
        max(CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 ELSE 2 END) + CAST(0.1 AS DOUBLE) * (count(*) - 1) AS rule_priority_score,
        array_to_string(list_sort(list(DISTINCT rule_status)), ',') AS rule_statuses, bool_or(rule_status = 'escalation') AS queue_eligible, count(*) FILTER (rule_status = 'escalation') AS escalation_rule_count,
        count(*) FILTER (rule_status = 'coverage') AS coverage_rule_count, 0 AS research_rule_count, max(is_laundering) AS is_laundering, min(split) AS split FROM hits GROUP BY transaction_id""",
    "hist": """SELECT t.*, (SELECT count(*) FROM tx o WHERE o.sender_account_id = t.sender_account_id AND o.pos < t.pos) AS f1, (SELECT count(*) FROM tx o WHERE o.receiver_account_id = t.receiver_account_id AND o.pos < t.pos) AS f2,
        (SELECT count(*) FROM tx o WHERE o.sender_account_id = t.sender_account_id AND o.receiver_account_id = t.receiver_account_id AND o.pos < t.pos) AS f3,
        (SELECT count(DISTINCT o.receiver_account_id) FROM tx o WHERE o.sender_account_id = t.sender_account_id AND o.pos < t.pos) AS f4,
        (SELECT count(DISTINCT o.sender_account_id) FROM tx o WHERE o.receiver_account_id = t.receiver_account_id AND o.pos < t.pos) AS f5 FROM tx t""",
    "feat": """SELECT a.alert_id, a.transaction_id, a.alert_timestamp, a.split, a.is_laundering AS target, h.payment_format, h.currency_pair, a.triggered_rules, a.max_rule_severity, h.amount AS feature_amount, h.cross_bank_flag AS feature_cross_bank_flag,
        h.log_amount AS feature_log_amount, CASE a.max_rule_severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 ELSE 2 END AS feature_max_rule_severity_ord, h.f3 AS feature_pair_prior_txn_count, h.f2 AS feature_receiver_prior_txn_count,
        h.f5 AS feature_receiver_prior_unique_senders, a.rule_count AS feature_rule_count, a.rule_priority_score AS feature_rule_priority_score, """
    + ", ".join(f"CASE WHEN contains(a.triggered_rules, '{r}') THEN 1 ELSE 0 END AS feature_rule_{r.lower()}_flag" for r in ("R1_AMOUNT", "R2_NOVELTY", "R3_VELOCITY", "R4_PASS_THROUGH", "R5_FAN_IN", "R6_FAN_OUT"))
    + ", h.f1 AS feature_sender_prior_txn_count, h.f4 AS feature_sender_prior_unique_receivers FROM al a JOIN hist h USING (transaction_id)",
    "sc": "SELECT f.*, a.rule_count, a.rule_statuses, a.rule_priority_score, a.is_laundering, (feature_rule_priority_score * 100 + feature_amount) / 1000 AS model_score FROM feat f JOIN al a USING (alert_id)",
    "cut": "SELECT round(quantile_cont(model_score, 0.99), 12) AS p1, round(quantile_cont(model_score, 0.95), 12) AS p2, round(quantile_cont(model_score, 0.8), 12) AS p3 FROM sc",
    "bd": """SELECT *, CAST(substr(priority_band, 2, 1) AS BIGINT) AS priority_rank FROM (SELECT sc.*, CASE WHEN regexp_matches(triggered_rules, 'R4_PASS_THROUGH|R5_FAN_IN|R6_FAN_OUT') THEN 'P1' WHEN round(model_score, 12) >= p1 THEN 'P1' WHEN round(model_score, 12) >= p2 THEN 'P2'
        WHEN round(model_score, 12) >= p3 THEN 'P3' ELSE 'P4' END AS priority_band FROM sc, cut)""",
    "rs": """SELECT sc.*, CAST(round_even(CAST(rank() OVER (ORDER BY model_score) + (count(*) OVER (PARTITION BY model_score) - 1) / 2.0 AS DOUBLE) / count(*) OVER () * 1000, 0) AS BIGINT) AS risk_score_1000 FROM sc""",
    "b0": """SELECT rs.*, CAST(risk_score_1000 AS DOUBLE) AS priority_score_v2, CASE WHEN risk_score_1000 >= f1 THEN 'P1' WHEN risk_score_1000 >= f2 THEN 'P2' WHEN risk_score_1000 >= f3 THEN 'P3' ELSE 'P4' END AS band0
        FROM rs, (SELECT round(quantile_cont(risk_score_1000, 0.999), 9) AS f1, round(quantile_cont(risk_score_1000, 0.995), 9) AS f2, round(quantile_cont(risk_score_1000, 0.95), 9) AS f3 FROM rs)""",
    "b1": """SELECT *, CASE WHEN promoted THEN 'P1' ELSE band0 END AS band1 FROM (SELECT *, max_rule_severity IN ('critical', 'high') AND contains(rule_statuses, 'escalation') AND rule_count >= 2 AND priority_score_v2 >= 990 AS promoted FROM b0)""",
    "b2": """SELECT *, CASE band2 WHEN 'P1' THEN 1 WHEN 'P1_overflow' THEN 2 WHEN 'P2' THEN 2 WHEN 'P3' THEN 3 ELSE 4 END AS rank2 FROM (
        SELECT *, CASE WHEN band1 = 'P1' AND i > 120 THEN 'P1_overflow' WHEN band1 = 'P2' AND i > 500 THEN 'P3' ELSE band1 END AS band2
        FROM (SELECT *, row_number() OVER (PARTITION BY band1 ORDER BY priority_score_v2 DESC, alert_id) AS i FROM b1))""",
    "lk": """SELECT a.alert_id, t.sender_account_id AS account FROM al a JOIN tx t USING (transaction_id) UNION SELECT a.alert_id, t.receiver_account_id FROM al a JOIN tx t USING (transaction_id)""",
    "edges": """SELECT DISTINCT coalesce((SELECT max(o.alert_id) FROM lk o WHERE o.account = lk.account AND o.alert_id < lk.alert_id), lk.alert_id) AS src, alert_id AS dst FROM lk""",
    "cf": """SELECT a.*, t.sender_account_id, t.receiver_account_id, t.amount, t.payment_format, s.model_score, split_part(a.triggered_rules, ',', 1) || '|' || t.payment_format || '|P4|' || strftime(a.alert_timestamp, '%Y-%m-%d') AS link_key
        FROM al a JOIN tx t USING (transaction_id) JOIN sc s ON s.alert_id = a.alert_id""",
    "ks": """SELECT link_key, alert_count, account_count, greatest(alert_count, account_count) AS component_size FROM (SELECT link_key, count(*) AS alert_count FROM cf GROUP BY 1) JOIN
        (SELECT link_key, count(DISTINCT account) AS account_count FROM (SELECT link_key, sender_account_id AS account FROM cf UNION ALL SELECT link_key, receiver_account_id FROM cf) GROUP BY 1) USING (link_key)""",
    "ck": """SELECT *, 'CASEV2-' || lpad(CAST(dense_rank() OVER (ORDER BY link_key, case_chunk) AS VARCHAR), 6, '0') AS case_id FROM (
        SELECT cf.*, (row_number() OVER (PARTITION BY link_key ORDER BY alert_timestamp, alert_id) - 1) // 25 AS case_chunk FROM cf JOIN ks USING (link_key) WHERE component_size <= 1000)""",
    "nc": "SELECT *, 'NETCLUSTER-' || lpad(CAST(row_number() OVER (ORDER BY link_key) AS VARCHAR), 6, '0') AS network_cluster_id FROM ks WHERE component_size > 1000",
    "mp": """SELECT alert_id, transaction_id, case_id, '' AS network_cluster_id, 'operational_case' AS mapping_type FROM ck UNION ALL
        SELECT alert_id, transaction_id, '', network_cluster_id, 'network_intelligence_only' FROM cf JOIN nc USING (link_key)""",
    "c2": """SELECT *, CASE WHEN contains(rule_ids, 'CYCLE') THEN 'Cycle' WHEN regexp_matches(rule_ids, 'GATHER|SCATTER') THEN 'Gather-scatter' WHEN regexp_matches(rule_ids, 'R5|FAN_IN') THEN 'Fan-in' WHEN regexp_matches(rule_ids, 'R6|FAN_OUT') THEN 'Fan-out'
          WHEN regexp_matches(rule_ids, 'R4|PASS') THEN 'Pass-through' WHEN regexp_matches(rule_ids, 'R3|VELOCITY') THEN 'Structuring' WHEN regexp_matches(rule_ids, 'R1|AMOUNT') THEN 'High amount' ELSE 'Mixed' END AS case_typology FROM (
        SELECT case_id, min(alert_timestamp) AS case_created_at, max(alert_timestamp) AS case_end_at, max(model_score) AS case_score, count(*) AS alert_count, count(DISTINCT transaction_id) AS transaction_count, sum(amount) AS total_amount, max(amount) AS max_transaction_amount,
          arg_min(triggered_rules, strftime(alert_timestamp, '%Y%m%d%H%M%S%f') || alert_id) AS rule_ids, max(is_laundering) AS has_laundering_label, sum(is_laundering) AS label_count, count(DISTINCT sender_account_id) + count(DISTINCT receiver_account_id) AS account_count FROM ck GROUP BY case_id)""",
    "g1": """SELECT h.*, (SELECT coalesce(CAST(sum(CAST(o.amount AS DECIMAL(28,6))) AS DOUBLE), 0) FROM tx o WHERE o.sender_account_id = h.sender_account_id AND o.pos < h.pos) AS w_out,
        (SELECT coalesce(CAST(sum(CAST(o.amount AS DECIMAL(28,6))) AS DOUBLE), 0) FROM tx o WHERE o.receiver_account_id = h.receiver_account_id AND o.pos < h.pos) AS w_in FROM hist h""",
    "fp": "SELECT sender_account_id AS s, receiver_account_id AS r, min(pos) AS o FROM tx GROUP BY 1, 2",
    "g2": """SELECT g1.*, coalesce((SELECT CAST(count(*) FILTER (s = g1.sender_account_id) + count(*) FILTER (r = g1.sender_account_id) AS DOUBLE) / nullif(2 * count(*), 0) FROM fp WHERE o < g1.pos), 0) AS pr_s,
        coalesce((SELECT CAST(count(*) FILTER (s = g1.receiver_account_id) + count(*) FILTER (r = g1.receiver_account_id) AS DOUBLE) / nullif(2 * count(*), 0) FROM fp WHERE o < g1.pos), 0) AS pr_r FROM g1""",
    "fe": "SELECT s, r, o FROM fp WHERE s <> r",
    "cyc": """SELECT transaction_id FROM tx WHERE sender_account_id = receiver_account_id UNION SELECT t.transaction_id FROM tx t JOIN fe a ON a.s = t.receiver_account_id AND a.r = t.sender_account_id AND a.o < t.pos
        UNION SELECT t.transaction_id FROM tx t JOIN fe a ON a.s = t.receiver_account_id AND a.o < t.pos JOIN fe b ON b.s = a.r AND b.r = t.sender_account_id AND b.o < t.pos
        UNION SELECT t.transaction_id FROM tx t JOIN fe a ON a.s = t.receiver_account_id AND a.o < t.pos JOIN fe c ON c.r = t.sender_account_id AND c.o < t.pos JOIN fe b ON b.s = a.r AND b.r = c.s AND b.o < t.pos""",
    "hb": """SELECT i.hub_account_id, unique_sources, unique_destinations, incoming_amount, outgoing_amount, CASE WHEN incoming_amount = 0 THEN 0 ELSE outgoing_amount / incoming_amount END AS amount_ratio, first_in, last_in, first_out, last_out
        FROM (SELECT receiver_account_id AS hub_account_id, count(DISTINCT sender_account_id) AS unique_sources, CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) AS incoming_amount, min(timestamp) AS first_in, max(timestamp) AS last_in FROM tx GROUP BY 1) i
        JOIN (SELECT sender_account_id AS hub_account_id, count(DISTINCT receiver_account_id) AS unique_destinations, CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) AS outgoing_amount, min(timestamp) AS first_out, max(timestamp) AS last_out FROM tx GROUP BY 1) o USING (hub_account_id)
        WHERE unique_sources >= 3 AND unique_destinations >= 3 AND CASE WHEN incoming_amount = 0 THEN 0 ELSE outgoing_amount / incoming_amount END BETWEEN 0.5 AND 1.5""",
    "ct": "SELECT alert_id, feature_name, (value - avg(value) OVER (PARTITION BY feature_name)) * weight AS shap_value, value AS feature_value FROM ("
    + " UNION ALL ".join(
        f"SELECT alert_id, '{n}' AS feature_name, CAST({n} AS DOUBLE) AS value, CAST({w} AS DOUBLE) AS weight FROM feat"
        for n, w in {"feature_amount": 0.01, "feature_rule_count": 1.0, "feature_sender_prior_txn_count": -0.02, "feature_rule_r4_pass_through_flag": 2.0, "feature_pair_prior_txn_count": 0.5, "feature_sender_prior_unique_receivers": 0.3, "feature_receiver_prior_unique_senders": -0.4, "feature_rule_r5_fan_in_flag": 1.5, "feature_rule_r6_fan_out_flag": -1.5}.items()
    )
    + ")",
    "rk": "SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY round(abs(shap_value), 9) DESC, feature_name) AS reason_rank FROM ct",
}

TEST_RANK = {r: f"SELECT alert_id AS id, {c} AS score, target AS y FROM sc WHERE split = 'test'" for r, c in {"rule_priority": "feature_rule_priority_score", "amount_rank": "feature_amount", "model_score": "model_score"}.items()}


def ranking_sql(ranks: dict[str, str]) -> str:
    """(ranking, metric, k, value) of each ranking's rows."""
    parts = []
    for name, rows in ranks.items():
        parts += [f"SELECT '{name}' AS ranking, 'pr_auc' AS metric, CAST(NULL AS BIGINT) AS k, pr_auc AS value FROM ({_ap(rows)})", f"SELECT '{name}', 'roc_auc', NULL, roc_auc FROM ({_auc(rows)})"]
        parts += [f"SELECT '{name}', '{m}', k, {c} FROM ({_top(rows, '[100, 500, 1000, 5000]')})" for m, c in (("precision_at_k", "p"), ("recall_at_k", "r"), ("lift_at_k", "l"))]
    return " UNION ALL ".join(parts)


ap, auc, top = _ap, _auc, _top


def with_tables(body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({q})" for n, q in CTE.items()) + f"\n{body}"

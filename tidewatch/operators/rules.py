"""Behavioural rules over transactions, their hits, and alerts.

Every rule is a function of DataFrames: percentiles of the training rows join in as one-row tables, and the text of the
evidence is made after the filter. Thresholds of segments, rolling sums, and what accounts know of the same partner before
and after, are written to the shared folder when a rule is made.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distributed import join_same, quantile_row, quantiles, ratio
from ..functions.graphs import stored
from ..functions.metrics import confusion
from ..functions.windows import activity, incoming_to_sender, rolling, rolling_distinct
from ..schemas import RULE_HIT_COLUMNS, RULE_IDS, RULES, SEVERITY

_NAMES = {r: n for r, n, _ in RULES}
_STATUS = {r: s for r, _, s in RULES}
_SEGMENT = ("payment_format", "currency_pair")
#: Rules that look back over a window.
_WINDOWED = ("R3_VELOCITY", "R4_PASS_THROUGH", "R5_FAN_IN", "R6_FAN_OUT")


def training_rows(tx: DataFrame) -> DataFrame:
    """The rows of the train split, or all rows if it is empty."""
    some = tx.agg(F.max(F.when(F.col("split") == "train", True)).alias("_some"))
    return tx.join(F.broadcast(some), how="cross").where((F.col("split") == "train") | F.col("_some").isNull()).drop("_some")


def _rolled(tx: DataFrame, train: DataFrame | None, group: str, window: str, closed: bool, percentile: float, told: DataFrame | None = None) -> DataFrame:
    """`rolling` of all rows, stored once (or `told`, where it is at hand), with the percentile of the training rows' sums as
    `sum_limit`.

    Windows look back only, so where the train split is all rows up to some time and id, its sums are those of the one
    pass; other training rows get a pass of their own.
    """
    needed = ["transaction_id", "timestamp", group, "amount", "is_laundering", "split"]
    tx = tx.select(needed)
    d = stored(rolling(tx, group, window, closed), "rolled") if told is None else told.where(F.col(group).isNotNull())
    trained = None
    if train is None:
        at, own = F.struct("timestamp", "transaction_id"), F.coalesce(F.col("split") == "train", F.lit(False))
        r = tx.agg(F.max(F.when(own, at)).alias("last"), F.min(F.when(~own, at)).alias("first")).select("last", "first", (F.col("last") < F.col("first")).alias("apart")).first()
        if r["last"] is None:
            trained = d
        elif r["first"] is None or r["apart"]:
            trained = d.where("split = 'train'")
    if trained is None:
        trained = rolling(training_rows(tx) if train is None else train, group, window, closed)
    return d.join(F.broadcast(quantile_row(trained, "rolling_sum", {"sum_limit": percentile})), how="cross")


def rule_hits(rows: DataFrame, rule: str, severity: str, trigger: dict[str, Column], threshold: dict[str, Column], rationale: Column, name: str | None = None) -> DataFrame:
    """Hits in the common form; evidence is JSON with its keys in alphabetical order."""
    as_json = lambda values: F.to_json(F.struct(*(values[k].alias(k) for k in sorted(values))))
    return rows.select(
        F.concat_ws(":", F.lit(rule), "transaction_id").alias("rule_hit_id"), "transaction_id", F.col("timestamp").alias("alert_timestamp"),
        F.lit(rule).alias("rule_id"), F.lit(name or _NAMES[rule]).alias("rule_name"), F.lit(severity).alias("severity"),
        as_json(trigger).alias("trigger_values_json"), as_json(threshold).alias("threshold_json"), rationale.alias("rationale"),
        F.col("is_laundering").cast("int").alias("is_laundering"), "split",
    ).select(RULE_HIT_COLUMNS)


def segment_thresholds(tx: DataFrame, percentile: float = 0.95, min_segment: int = 1000, fallback: float = 0.95, fields: Sequence[str] = _SEGMENT, overall: DataFrame | None = None) -> DataFrame:
    """(fields..., segment_count, threshold, threshold_source): exact percentiles; small segments take the global one, which
    is `overall` where it is at hand."""
    overall = quantile_row(tx, "amount", {"overall": fallback}) if overall is None else overall
    sizes = tx.groupBy(*fields).agg(F.count(F.lit(1)).alias("segment_count"))
    own = quantiles(tx, "amount", [percentile], fields).drop("p")
    d = join_same(sizes, own, fields, "left").join(F.broadcast(overall), how="cross")
    small = F.col("segment_count") < min_segment
    return d.select(*fields, "segment_count", F.when(small, F.col("overall")).otherwise(F.col("quantile")).alias("threshold"), F.when(small, "fallback").otherwise("segment").alias("threshold_source"))


def amount_rule(tx: DataFrame, train: DataFrame | None = None, percentile: float = 0.95, min_segment: int = 1000, fallback: float = 0.95, severity: str = "medium", fields: Sequence[str] = _SEGMENT) -> DataFrame:
    """R1: amounts at or above their segment's threshold; unseen segments take the global one. Thresholds are stored, so
    that Spark knows their size when it joins them."""
    train = training_rows(tx) if train is None else train
    overall = stored(quantile_row(train, "amount", {"overall": fallback}), "overall")
    d = join_same(tx, stored(segment_thresholds(train, percentile, min_segment, fallback, fields, overall), "thresholds"), fields, "left")
    d = d.join(F.broadcast(overall), how="cross")
    d = d.withColumns({"threshold": F.coalesce("threshold", "overall"), "threshold_source": F.coalesce("threshold_source", F.lit("fallback")), "segment_count": F.coalesce("segment_count", F.lit(0))})
    d = d.where(F.col("amount") >= F.col("threshold"))
    text = F.format_string("Amount %.2f is at or above the R1 threshold %.2f for %s/%s.", "amount", "threshold", "payment_format", "currency_pair")
    return rule_hits(d, "R1_AMOUNT", severity, {c: F.col(c) for c in ("amount", "payment_format", "currency_pair")}, {"threshold": F.col("threshold"), "percentile": F.lit(percentile), "threshold_source": F.col("threshold_source"), "segment_count": F.col("segment_count")}, text)


def novelty_rule(tx: DataFrame, cross_bank: bool = True, severity: str = "medium") -> DataFrame:
    """R2: the first row of each (sender, receiver), which then may have to be between banks."""
    pair = ["sender_account_id", "receiver_account_id"]
    first = tx.groupBy(*pair).agg(F.min(F.struct("timestamp", "transaction_id", "cross_bank_flag", "is_laundering", "split")).alias("r")).select(*pair, "r.*")
    if cross_bank:
        first = first.where("cross_bank_flag = 1")
    text = F.format_string("First transfer from %s to %s%s.", "sender_account_id", "receiver_account_id", F.when(F.col("cross_bank_flag") == 1, " between banks").otherwise(""))
    return rule_hits(first, "R2_NOVELTY", severity, {**{c: F.col(c) for c in ("sender_account_id", "receiver_account_id", "cross_bank_flag")}, "first_seen_pair_flag": F.lit(1)}, {"first_seen": F.lit(True), "require_cross_bank": F.lit(cross_bank)}, text)


def velocity_rule(tx: DataFrame, train: DataFrame | None = None, window: str = "24h", min_count: int = 5, percentile: float = 0.90, severity: str = "high", told: DataFrame | None = None) -> DataFrame:
    """R3: senders with many rows in the open window, whose sum is high against the training rows' own sums. In this rule and
    the next, `told` is what `activity` tells of all rows in that window, where it is at hand."""
    known = None if told is None else told.withColumns({"rolling_count": F.col("sent_count"), "rolling_sum": F.col("sent_sum")})
    d = _rolled(tx, train, "sender_account_id", window, False, percentile, known)
    d = d.where((F.col("rolling_count") >= min_count) & (F.col("rolling_sum") >= F.col("sum_limit")))
    text = F.format_string("Sender made %d transactions totaling %.2f in %s.", "rolling_count", "rolling_sum", F.lit(window))
    return rule_hits(d, "R3_VELOCITY", severity, {"sender_account_id": F.col("sender_account_id"), "rolling_count": F.col("rolling_count"), "rolling_sum": F.col("rolling_sum"), "window": F.lit(window)}, {"count_threshold": F.lit(min_count), "amount_threshold": F.col("sum_limit"), "amount_percentile": F.lit(percentile)}, text)


def pass_through(tx: DataFrame, window: str = "24h") -> DataFrame:
    """Adds incoming (0 without any) and pass_through_ratio (0 where incoming is 0)."""
    d = tx.join(incoming_to_sender(tx, window), "transaction_id", "left").withColumn("incoming", F.coalesce("incoming", F.lit(0.0)))
    return d.withColumn("pass_through_ratio", ratio(F.col("amount"), F.col("incoming")))


def pass_through_rule(tx: DataFrame, window: str = "24h", min_ratio: float = 0.80, severity: str = "critical", told: DataFrame | None = None) -> DataFrame:
    """R4: a sender passes on a large part of what has just come in."""
    d = pass_through(tx, window) if told is None else told.withColumn("pass_through_ratio", ratio(F.col("amount"), F.col("incoming")))
    d = d.where((F.col("incoming") > 0) & (F.col("pass_through_ratio") >= min_ratio))
    text = F.format_string("Sender moved %.2f of recent incoming funds within %s.", "pass_through_ratio", F.lit(window))
    trigger = {"sender_account_id": F.col("sender_account_id"), "outgoing_amount": F.col("amount"), "incoming_amount_window": F.col("incoming"), "pass_through_ratio": F.col("pass_through_ratio"), "window": F.lit(window)}
    return rule_hits(d, "R4_PASS_THROUGH", severity, trigger, {"min_in_out_ratio": F.lit(min_ratio), "window": F.lit(window)}, text)


def fan_in_rule(tx: DataFrame, train: DataFrame | None = None, window: str = "24h", min_senders: int = 5, percentile: float = 0.90, severity: str = "high", told: DataFrame | None = None) -> DataFrame:
    """R5: receivers with many senders in the closed window and a high sum against the training rows' own sums."""
    if told is None:
        senders = rolling_distinct(tx, "receiver_account_id", "sender_account_id", window).withColumnRenamed("rolling_distinct", "senders")
        d = _rolled(tx, train, "receiver_account_id", window, True, percentile).join(senders.where(F.col("senders") >= min_senders), "transaction_id")
    else:
        d = _rolled(tx, train, "receiver_account_id", window, True, percentile, told.withColumn("rolling_sum", F.col("received_sum")))
    d = d.where((F.col("rolling_sum") >= F.col("sum_limit")) & (F.col("senders") >= min_senders))
    text = F.format_string("Receiver had %d unique senders and %.2f incoming amount in %s.", "senders", "rolling_sum", F.lit(window))
    return rule_hits(d, "R5_FAN_IN", severity, {"receiver_account_id": F.col("receiver_account_id"), "unique_senders": F.col("senders"), "incoming_amount": F.col("rolling_sum"), "window": F.lit(window)}, {"min_unique_senders": F.lit(min_senders), "amount_threshold": F.col("sum_limit"), "amount_percentile": F.lit(percentile)}, text)


def incoming_unique_funders(tx: DataFrame, window: str = "24h") -> DataFrame:
    """(transaction_id, funders): distinct senders to the row's sender in the closed window, those of its own time included."""
    return rolling_distinct(tx, "receiver_account_id", "sender_account_id", window, query_group="sender_account_id").withColumnRenamed("rolling_distinct", "funders")


def fan_out_rule(tx: DataFrame, window: str = "24h", min_receivers: int = 5, min_funders: int = 2, severity: str = "high", told: DataFrame | None = None) -> DataFrame:
    """R6: senders that pay many receivers after several have paid them."""
    if told is None:
        receivers = rolling_distinct(tx, "sender_account_id", "receiver_account_id", window).withColumnRenamed("rolling_distinct", "receivers")
        d = receivers.where(F.col("receivers") >= min_receivers).join(incoming_unique_funders(tx, window).where(F.col("funders") >= min_funders), "transaction_id").join(tx, "transaction_id")
    else:
        d = told.where((F.col("receivers") >= min_receivers) & (F.col("funders") >= min_funders))
    text = F.format_string("Sender paid %d unique receivers after %d unique funders in %s.", "receivers", "funders", F.lit(window))
    return rule_hits(d, "R6_FAN_OUT", severity, {"sender_account_id": F.col("sender_account_id"), "unique_receivers": F.col("receivers"), "prior_unique_senders": F.col("funders"), "window": F.lit(window)}, {"min_unique_receivers": F.lit(min_receivers), "min_prior_unique_senders": F.lit(min_funders)}, text)


def with_status(hits: DataFrame, statuses: dict[str, str] | None = None, default: str = "escalation") -> DataFrame:
    """Adds rule_status, queue_eligible (escalations only) and volume_control_reason."""
    pairs = [F.lit(x) for kv in (_STATUS if statuses is None else statuses).items() for x in kv]
    status = F.coalesce(F.create_map(*pairs)[F.col("rule_id")], F.lit(default)) if pairs else F.lit(default)
    # fixed values: the reasons by status
    reasons = {"coverage": "coverage_only_not_direct_p1_p2", "research": "research_only_not_direct_p1_p2", "suppress_candidate": "suppression_candidate_for_review"}
    reason = F.create_map(*(F.lit(x) for kv in reasons.items() for x in kv))[F.col("rule_status")]
    return hits.withColumn("rule_status", status).withColumns({"queue_eligible": F.col("rule_status") == "escalation", "volume_control_reason": F.coalesce(reason, F.lit(""))})


def run_rules(tx: DataFrame, enabled: Sequence[str] = tuple(RULE_IDS), options: dict[str, dict] | None = None) -> DataFrame:
    """Hits of the enabled rules with their status. `options` has keyword arguments by rule id.

    Rules that look back over the same window share one sweep, stored once."""
    o = dict(options or {})
    train = training_rows(tx)
    by_window: dict[str, list[str]] = {}
    for r in _WINDOWED:
        if r in enabled and "told" not in o.get(r, {}):
            by_window.setdefault(o.get(r, {}).get("window", "24h"), []).append(r)
    for window, sharing in by_window.items():
        if len(sharing) > 1:
            told = tx.select("transaction_id", "timestamp", "sender_account_id", "receiver_account_id", "amount", "is_laundering", "split")
            told = stored(activity(told, window), "activity")
            o |= {r: {**o.get(r, {}), "told": told} for r in sharing}
    made = {
        "R1_AMOUNT": lambda **k: amount_rule(tx, train, **k), "R2_NOVELTY": lambda **k: novelty_rule(tx, **k), "R3_VELOCITY": lambda **k: velocity_rule(tx, **k),
        "R4_PASS_THROUGH": lambda **k: pass_through_rule(tx, **k), "R5_FAN_IN": lambda **k: fan_in_rule(tx, **k), "R6_FAN_OUT": lambda **k: fan_out_rule(tx, **k),
    }
    return with_status(reduce(DataFrame.unionByName, (made[r](**o.get(r, {})) for r in RULE_IDS if r in enabled)))


def severity_rank(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.create_map(*(F.lit(x) for kv in SEVERITY.items() for x in kv))[c], F.lit(0))


def _alert_id() -> Column:
    return F.concat(F.lit("ALERT-"), F.col("transaction_id").cast("string"))


def alerts(hits: DataFrame) -> DataFrame:
    """One alert per transaction: rules, greatest severity, score, reasons in rule order and counts of statuses."""
    reasons = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("rule_id", "rationale"))), lambda x: x["rationale"]))
    d = hits.groupBy("transaction_id").agg(
        F.min("alert_timestamp").alias("alert_timestamp"), F.array_sort(F.collect_set("rule_id")).alias("rules"),
        F.max_by("severity", severity_rank("severity")).alias("max_rule_severity"), F.array_join(reasons, " | ").alias("rationale"),
        F.array_join(F.array_sort(F.collect_set("rule_status")), ",").alias("rule_statuses"), F.coalesce(F.bool_or("queue_eligible"), F.lit(False)).alias("queue_eligible"),
        *(F.count_if(F.col("rule_status") == s).alias(f"{s}_rule_count") for s in ("escalation", "coverage", "research")),
        F.max("is_laundering").alias("is_laundering"), F.min("split").alias("split"),
    )
    count = F.size("rules").cast("long")
    return d.select(
        _alert_id().alias("alert_id"), "transaction_id", "alert_timestamp",
        F.array_join("rules", ",").alias("triggered_rules"), count.alias("rule_count"), "max_rule_severity",
        (severity_rank("max_rule_severity") + F.lit(0.1) * (count - 1)).cast("double").alias("rule_priority_score"), "rationale", "rule_statuses", "queue_eligible",
        "escalation_rule_count", "coverage_rule_count", "research_rule_count", "is_laundering", "split",
    )


def alerted(hits: DataFrame) -> DataFrame:
    """(transaction_id, alert_id, is_laundering) of `alerts`, for what asks for no more."""
    d = hits.groupBy("transaction_id").agg(F.max("is_laundering").alias("is_laundering"))
    return d.select("transaction_id", _alert_id().alias("alert_id"), "is_laundering")


def rule_performance(tx: DataFrame, hits: DataFrame) -> DataFrame:
    """(split, rule_id, metrics): each rule that fired anywhere, and ANY_RULE, on every split."""
    totals = tx.where(F.col("split").isNotNull()).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("is_laundering"), F.lit(0)).alias("y"))
    own = hits.groupBy("split", "rule_id", "transaction_id").agg(F.max("is_laundering").alias("y1"))
    any_rule = hits.groupBy("split", "transaction_id").agg(F.max("is_laundering").alias("y1")).withColumn("rule_id", F.lit("ANY_RULE"))
    got = own.unionByName(any_rule).groupBy(F.col("split").alias("s"), F.col("rule_id").alias("r")).agg(F.count(F.lit(1)).alias("hits"), F.sum("y1").alias("tp"))
    rules = hits.select("rule_id").distinct().unionByName(hits.sparkSession.createDataFrame([("ANY_RULE",)], "rule_id string"))
    grid = totals.crossJoin(F.broadcast(rules))  # splits by rules: both a handful
    d = grid.join(got, (F.col("split") == F.col("s")) & (F.col("rule_id") == F.col("r")), "left").na.fill(0, ["hits", "tp"])
    tp, fp = F.col("tp"), F.col("hits") - F.col("tp")
    fn = F.col("y") - tp
    names = F.create_map(*(F.lit(x) for kv in {**_NAMES, "ANY_RULE": "Any rule alert"}.items() for x in kv))
    return d.select("split", "rule_id", F.coalesce(names[F.col("rule_id")], F.col("rule_id")).alias("rule_name"), *confusion(tp, fp, fn, F.col("n") - tp - fp - fn))


def rule_overlap(hits: DataFrame, rules: Sequence[str] = tuple(RULE_IDS)) -> DataFrame:
    """Transactions that two rules share, as a matrix with a row and a column per rule that fired or could."""
    flags = hits.select("transaction_id", "rule_id").distinct()
    a, b = flags.withColumnRenamed("rule_id", "a"), flags.withColumnRenamed("rule_id", "b")
    return a.join(b, "transaction_id").groupBy(F.col("a").alias("rule_id")).pivot("b", list(rules)).count().na.fill(0)


def tune_amount_rule(tx: DataFrame, grid: Sequence[float] = (0.95, 0.975, 0.99, 0.995), split: str = "validation", recall_floor: float = 0.80, max_alert_rate: float = 1.0, min_segment: int = 1000, fallback: float = 0.95, fields: Sequence[str] = _SEGMENT) -> DataFrame:
    """Metrics of every candidate percentile on one split, all candidates in one job."""
    train, rows = training_rows(tx), tx.where(F.col("split") == split)
    overall = quantile_row(train, "amount", {"overall": fallback})
    sizes = train.groupBy(*fields).agg(F.count(F.lit(1)).alias("segment_count"))
    own = join_same(quantiles(train, "amount", grid, fields), sizes, fields).where(F.col("segment_count") >= min_segment).select(*fields, "p", "quantile")
    d = rows.select(*fields, "amount", F.coalesce("is_laundering", F.lit(0)).alias("y"), F.explode(F.array(*(F.lit(float(p)) for p in grid))).alias("p"))
    d = join_same(d, own, [*fields, "p"], "left").join(F.broadcast(overall), how="cross").withColumn("hit", F.col("amount") >= F.coalesce("quantile", "overall"))
    d = d.withColumn("hit", F.coalesce("hit", F.lit(False)))
    y = F.col("y") == 1
    m = d.groupBy("p").agg(F.count_if(y & F.col("hit")).alias("tp"), F.count_if(~y & F.col("hit")).alias("fp"), F.count_if(y & ~F.col("hit")).alias("fn"), F.count_if(~y & ~F.col("hit")).alias("tn"))
    m = m.select(F.lit("R1_AMOUNT").alias("rule_id"), F.lit("percentile").alias("parameter"), F.col("p").alias("candidate_value"), F.lit(split).alias("split"), *confusion(*(F.col(c) for c in ("tp", "fp", "fn", "tn"))))
    return m.withColumns({"meets_recall_floor": F.col("recall") >= recall_floor, "meets_alert_rate_cap": F.col("alert_rate") <= max_alert_rate})


def select_candidate(candidates: DataFrame, recall_floor: float = 0.80, max_alert_rate: float = 1.0) -> DataFrame:
    """The candidate within both guardrails of lowest alert rate (then highest value); without one, of highest recall
    (then lowest alert rate, then lowest value)."""
    ok = (F.col("recall") >= recall_floor) & (F.col("alert_rate") <= max_alert_rate)
    d = candidates.withColumn("_ok", ok)
    best = d.orderBy(F.desc("_ok"), F.when(F.col("_ok"), F.lit(0.0)).otherwise(-F.col("recall")), "alert_rate", F.when(F.col("_ok"), -F.col("candidate_value")).otherwise(F.col("candidate_value"))).limit(1)
    return best.withColumn("selection_reason", F.when(F.col("_ok"), "met_recall_floor_and_alert_rate_cap").otherwise("guardrail_not_met_selected_highest_recall")).drop("_ok")


def tune_rules(tx: DataFrame, options: dict[str, dict] | None = None, **tuning) -> tuple[DataFrame, DataFrame, dict[str, dict]]:
    """Candidates, the selected one, and rule options with the selected percentile."""
    candidates = tune_amount_rule(tx, **tuning)
    selected = select_candidate(candidates, tuning.get("recall_floor", 0.80), tuning.get("max_alert_rate", 1.0))
    row = selected.first()
    tuned = {**(options or {})}
    if row:
        tuned["R1_AMOUNT"] = {**tuned.get("R1_AMOUNT", {}), "percentile": row["candidate_value"]}
    return candidates, selected, tuned

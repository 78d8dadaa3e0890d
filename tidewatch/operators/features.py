"""Point-in-time features of alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distributed import first_by_hash, ratio
from ..functions.windows import role_history
from ..schemas import RULE_IDS
from .rules import severity_rank

METADATA = ["alert_id", "transaction_id", "alert_timestamp", "split", "target", "payment_format", "currency_pair", "triggered_rules", "max_rule_severity"]


#: Feature names of what `role_history` tells.
_HISTORY = {"sender_count": "sender_prior_txn_count", "receiver_count": "receiver_prior_txn_count", "pair_count": "pair_prior_txn_count", "sender_partners": "sender_prior_unique_receivers", "receiver_partners": "receiver_prior_unique_senders"}


def transaction_history(tx: DataFrame) -> DataFrame:
    """All transactions with what was known before each: rows of its sender, receiver and pair, and their partners."""
    return tx.join(role_history(tx).select("transaction_id", *(F.col(c).alias(f"feature_{n}") for c, n in _HISTORY.items())), "transaction_id")


def rule_flags(hits: DataFrame, rules: Sequence[str] = tuple(RULE_IDS)) -> DataFrame:
    """(transaction_id, feature_rule_<id>_flag...) with fixed columns; a missing rule is 0."""
    return hits.groupBy("transaction_id").agg(*(F.coalesce(F.max(F.when(F.col("rule_id") == r, 1)), F.lit(0)).alias(f"feature_rule_{r.lower()}_flag") for r in rules))


def alert_facts(tx: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row per alert: metadata, then the features that the alert and its transaction tell by themselves."""
    d = alerts.join(tx.select("transaction_id", "payment_format", "currency_pair", "cross_bank_flag", "amount", "log_amount"), "transaction_id", "left")
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    d = d.withColumns({
        "target": F.col("is_laundering").cast("int"), "feature_rule_count": zero("rule_count"), "feature_rule_priority_score": zero("rule_priority_score"),
        "feature_max_rule_severity_ord": severity_rank("max_rule_severity").cast("double"),
        "feature_log_amount": zero("log_amount"), "feature_amount": zero("amount"), "feature_cross_bank_flag": zero("cross_bank_flag"),
    })
    return d.select(*METADATA, *sorted(c for c in d.columns if c.startswith("feature_")))


def alert_features(tx: DataFrame, alerts: DataFrame, hits: DataFrame, rules: Sequence[str] = tuple(RULE_IDS), facts: DataFrame | None = None, history: DataFrame | None = None) -> DataFrame:
    """One row per alert: metadata, then feature columns in alphabetical order. History counts all transactions. `facts` and
    `history` are what `alert_facts` and `role_history` give, where they are at hand."""
    history = (role_history(tx) if history is None else history).select("transaction_id", *(F.col(c).alias(f"feature_{n}") for c, n in _HISTORY.items()))
    d = (alert_facts(tx, alerts) if facts is None else facts).join(history, "transaction_id", "left").join(rule_flags(hits, rules), "transaction_id", "left")
    d = d.withColumns({f"feature_rule_{r.lower()}_flag": F.coalesce(f"feature_rule_{r.lower()}_flag", F.lit(0)) for r in rules})
    return d.select(*METADATA, *sorted(c for c in d.columns if c.startswith("feature_")))


def feature_quality(features: DataFrame) -> DataFrame:
    """(feature_name, row_count, null_count, null_rate, distinct_count, all_null) for each feature column, in one pass."""
    names = [c for c in features.columns if c.startswith("feature_")]
    d = features.select(*(F.col(c).cast("double").alias(c) for c in names)).unpivot([], names, "feature_name", "value")
    d = d.groupBy("feature_name").agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("value").isNull()).alias("null_count"), F.count_distinct("value").alias("distinct_count"))
    return d.select("feature_name", "row_count", "null_count", ratio(F.col("null_count"), F.col("row_count")).alias("null_rate"), "distinct_count", (F.col("null_count") == F.col("row_count")).alias("all_null"))


def one_hot(features: DataFrame, categories: dict[str, Sequence[str]]) -> DataFrame:
    """0/1 columns `<column>_<value>` and `<column>_null` for listed values; other features as doubles, null as 0."""
    names = [c for c in features.columns if c.startswith("feature_")]
    hot = [F.when(F.col(c) == v, 1).otherwise(0).alias(f"{c}_{v}") for c, vs in categories.items() for v in vs]
    none = [F.when(F.col(c).isNull(), 1).otherwise(0).alias(f"{c}_null") for c in categories]
    return features.select("alert_id", "split", "target", *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names), *hot, *none)


def balanced_sample(train: DataFrame, negatives_per_positive: int | None = 10, max_rows: int | None = 200_000, seed: int = 42, id_col: str = "alert_id", keep_positives: bool = False) -> DataFrame:
    """Rows of both classes, `max_rows` at most: so many negatives to a positive, each class in hash order.

    All positives stay while that many negatives find room beside them; beyond it both classes are cut at the ratio, and
    where negatives are short more positives stay. With `keep_positives` all positives stay whatever their number, negatives fill what is
    left of `max_rows`, and from `max_rows` positives on there are none. Without rows of both classes the rows are only
    capped. Without a ratio (None) all negatives are wanted, without `max_rows` nothing is capped. The order is md5 of seed and
    id, the same in any engine; what comes first is found by counts, not by a sort.
    """
    d = train.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string"))))
    y = train.agg(F.count_if(F.col("target") == 1).alias("y"), F.count_if(F.col("target") == 0).alias("n")).first()
    if not y["y"] or not y["n"]:
        return train if max_rows is None else first_by_hash(d, max_rows, "_h", id_col).drop("_h")
    wanted = y["n"] if negatives_per_positive is None else y["y"] * negatives_per_positive
    if max_rows is None:
        positives, negatives = y["y"], wanted
    elif keep_positives:
        positives, negatives = y["y"], max(0, min(wanted, max_rows - y["y"]))
    else:
        negatives = min(y["n"], wanted, max_rows * wanted // (wanted + y["y"]))
        positives = min(y["y"], max_rows - negatives)
    taken = [d.where(f"target = {c}") if m >= y[k] else first_by_hash(d.where(f"target = {c}"), m, "_h", id_col) for c, k, m in ((1, "y", positives), (0, "n", negatives))]
    return taken[0].unionByName(taken[1]).drop("_h")


def sample_weights(train: DataFrame) -> DataFrame:
    """Adds sample_weight: rows over classes times rows of the class."""
    n = train.groupBy(F.col("target").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    total = n.agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_classes"))
    w = n.join(total, how="cross").select("_t", (F.col("_all") / (F.col("_classes") * F.col("_n"))).alias("sample_weight"))
    return train.join(F.broadcast(w), F.col("target") == F.col("_t")).drop("_t")

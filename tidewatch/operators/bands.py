"""Risk scores, priority bands, capacity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.distributed import join_same, prefix_sums, quantile_row, ratio
from ..functions.metrics import top_k, top_k_table
from ..schemas import BANDS

QUANTILES = {"p1": 0.99, "p2": 0.95, "p3": 0.80}
CRITICAL_RULES = ("R4_PASS_THROUGH", "R5_FAN_IN", "R6_FAN_OUT")
#: Rules whose alerts are P1 in the calibrated bands.
CALIBRATED_CRITICAL_RULES = (*CRITICAL_RULES, "GR1_GATHER_SCATTER", "GR1_GATHER_SCATTER_V2")


def risk_score(scored: DataFrame, score: str = "calibrated_score", out: str = "risk_score_1000", low: int = 0, high: int = 1000) -> DataFrame:
    """Adds the percentile rank of the score (null as 0, ties averaged) scaled to low..high, rounded half to even.

    Ranks are made of counts of distinct scores; a single row gets `high`."""
    d = scored.withColumn("_s", F.coalesce(F.col(score).cast("double"), F.lit(0.0)))
    counts = d.groupBy("_s").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    ranked = prefix_sums(counts, [], "_s", ["_n"]).join(F.broadcast(total), how="cross")
    share = (F.col("_n_before") + (F.col("_n") + 1) / 2) / F.col("_all")
    value = F.greatest(F.lit(low), F.least(F.lit(high), F.bround(F.lit(low) + share * (high - low)).cast("int")))
    ranked = ranked.select("_s", F.when(F.col("_all") <= 1, high).otherwise(value).cast("int").alias(out))
    return join_same(d, ranked, ["_s"]).drop("_s")


def _has_rule(rules: Sequence[str]) -> Column:
    return F.arrays_overlap(F.split(F.coalesce("triggered_rules", F.lit("")), ","), F.array(*map(F.lit, rules))) if rules else F.lit(False)


def assign_bands(scored: DataFrame, score: str = "model_score", band: str = "priority_band", rank: str = "priority_rank", cuts: dict[str, float] | None = None, critical: Sequence[str] = CRITICAL_RULES) -> DataFrame:
    """Adds band P1 to P4 by exact quantiles of the score (null as 0), and its rank; critical rules are P1 whatever their score."""
    d = scored.withColumn("_s", F.coalesce(F.col(score), F.lit(0.0)))
    d = d.join(F.broadcast(quantile_row(d, "_s", {f"_{k}": v for k, v in (cuts or QUANTILES).items()}, 1.0)), how="cross")
    by_score = F.when(F.col("_s") >= F.col("_p1"), "P1").when(F.col("_s") >= F.col("_p2"), "P2").when(F.col("_s") >= F.col("_p3"), "P3").otherwise("P4")
    d = d.withColumn(band, F.when(_has_rule(critical), "P1").otherwise(by_score))
    return d.withColumn(rank, F.substring(band, 2, 1).cast("int")).drop("_s", "_p1", "_p2", "_p3")


def summarize_bands(banded: DataFrame, band: str = "priority_band", score: str = "model_score", label: str = "target", avg_name: str = "avg_model_score", bands: Sequence[str] = BANDS) -> DataFrame:
    """Count, labels, precision, recall and mean score of every band, empty ones too."""
    names = banded.sparkSession.createDataFrame([(b,) for b in bands], "b string")
    got = banded.groupBy(band).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(label), F.lit(0)).alias("y"), F.avg(score).alias("s"))
    total = banded.agg(F.coalesce(F.sum(label), F.lit(0)).alias("total"))
    d = F.broadcast(names).join(got, F.col("b") == F.col(band), "left").join(F.broadcast(total), how="cross").na.fill(0, ["n", "y"]).na.fill(0.0, ["s"])
    return d.select(F.col("b").alias("priority_band"), F.col("n").alias("alert_count"), F.col("y").alias("label_count"), ratio(F.col("y"), F.col("n")).alias("precision"), ratio(F.col("y"), F.col("total")).alias("recall"), F.col("s").alias(avg_name))


def simulate_capacity(scored: DataFrame, rankings: dict[str, str], ks: Sequence[int] = (100, 500, 1000, 5000), label: str = "target", tie: str = "alert_id") -> DataFrame:
    return top_k_table(scored, label, rankings, ks, tie)


def bands_v2(alerts: DataFrame, scored: DataFrame, score: str | None = None, floors: dict[str, float] | None = None) -> DataFrame:
    """Alerts with their scores, priority_score_v2 and a band by percentile floors (P3, then P2, then P1 override).

    The score is the named column, else risk_score_1000, calibrated_score, model_score or rule_priority_score, whichever
    comes first; risk_score_1000 is made where it is missing."""
    new = [c for c in scored.columns if c not in alerts.columns]
    d = alerts.join(scored.select("alert_id", *new), "alert_id", "left")
    if "risk_score_1000" not in d.columns:
        d = risk_score(d, next(c for c in ("calibrated_score", "model_score", "rule_priority_score") if c in d.columns))
    column = next(c for c in (score, "risk_score_1000", "calibrated_score", "model_score", "rule_priority_score") if c in d.columns)
    d = d.withColumn("priority_score_v2", F.coalesce(F.col(column).cast("double"), F.lit(0.0)))
    floors = floors or {"P1": 0.999, "P2": 0.995, "P3": 0.95}
    cut = quantile_row(d, "priority_score_v2", {f"floor_{b}": p for b, p in floors.items()}, 0.0)
    d = d.join(F.broadcast(cut), how="cross")
    band = reason = None
    for b in ("P1", "P2", "P3"):
        if b in floors:
            over = F.col("priority_score_v2") >= F.col(f"floor_{b}")
            text = F.format_string("score >= %.6f", f"floor_{b}")
            band, reason = (F.when(over, b), F.when(over, text)) if band is None else (band.when(over, b), reason.when(over, text))
    return d.withColumns({"priority_band_v2": band.otherwise("P4"), "band_assignment_reason": reason.otherwise(""), "p1_override_reason": F.lit("")})


def p1_overrides(banded: DataFrame, min_rule_count: int = 2, min_score: float | None = 990.0, statuses: Sequence[str] = ("escalation",), excluded: Sequence[str] = ("GR2_CYCLE_CANDIDATE", "GR2_CYCLE_CANDIDATE_V2")) -> DataFrame:
    """Promotes to P1: severity high or critical, an eligible status, not only excluded rules, enough rules and score.

    `min_score` None stands for the P1 floor."""
    rules = F.filter(F.transform(F.split(F.coalesce("triggered_rules", F.lit("")), ","), F.trim), lambda r: r != "")
    only_excluded = (F.size(rules) > 0) & (F.size(F.array_except(rules, F.array(*map(F.lit, excluded)).cast("array<string>"))) == 0)
    eligible = F.arrays_overlap(F.split(F.coalesce("rule_statuses", F.lit("")), ","), F.array(*map(F.lit, statuses))) if statuses else F.coalesce("escalation_rule_count", F.lit(0)) > 0
    enough = (F.coalesce("rule_count", F.lit(0)) >= min_rule_count) & (F.col("priority_score_v2") >= (F.col("floor_P1") if min_score is None else F.lit(min_score)))
    promote = F.col("max_rule_severity").isin("critical", "high") & eligible & ~only_excluded & enough
    return banded.withColumns({"priority_band_v2": F.when(promote, "P1").otherwise(F.col("priority_band_v2")), "p1_override_reason": F.when(promote, "critical_rule_with_configured_secondary_condition").otherwise(F.col("p1_override_reason"))})


def capacity_caps(banded: DataFrame, p1: int | None = 120, p2: int | None = 500, overflow: str = "P1_overflow") -> DataFrame:
    """Keeps the first alerts of P1 and P2 by (score desc, alert_id); the rest of P1 overflow, of P2 are P3. Adds rank.

    Only the best `cap` rows of a band are sorted, so a band of any size is demoted by a join."""
    d = banded
    for band, cap, then in (("P1", p1, overflow), ("P2", p2, "P3")):
        if cap:
            stay = d.where(F.col("priority_band_v2") == band).orderBy(F.desc("priority_score_v2"), "alert_id").limit(cap).select("alert_id", F.lit(True).alias("_stay"))
            d = d.join(stay, "alert_id", "left")
            over = (F.col("priority_band_v2") == band) & F.col("_stay").isNull()
            d = d.withColumns({"priority_band_v2": F.when(over, then).otherwise(F.col("priority_band_v2")), "band_assignment_reason": F.when(over, f"demoted by {band} capacity cap").otherwise(F.col("band_assignment_reason"))}).drop("_stay")
    # fixed values: the rank of each band
    rank = F.create_map(*(F.lit(x) for kv in {"P1": 1, "P1_overflow": 2, "P2": 2, "P3": 3, "P4": 4}.items() for x in kv))
    return d.withColumn("priority_rank_v2", F.coalesce(rank[F.col("priority_band_v2")], F.lit(3)))


def band_summary_v2(banded: DataFrame, label: str = "is_laundering") -> DataFrame:
    d = banded.groupBy(F.col("priority_band_v2").alias("priority_band")).agg(F.count(F.lit(1)).alias("alert_count"), F.coalesce(F.sum(label), F.lit(0)).alias("label_count"), F.avg("priority_score_v2").alias("avg_score"))
    return d.withColumn("precision", ratio(F.col("label_count"), F.col("alert_count")))


def top_k_after_bands(banded: DataFrame, label: str = "is_laundering", ks: Sequence[int] = (100, 500, 1000, 5000)) -> DataFrame:
    return top_k(banded, label, "priority_score_v2", ks, "alert_id").select(F.lit("all").alias("split"), "k", "precision_at_k", "recall_at_k", "lift_at_k")


def capacity_simulation(banded: DataFrame, investigators: int = 3, per_day: int = 40, capacity: int | None = None, label: str = "is_laundering", score: str = "priority_score_v2", ks: Sequence[int] = (100, 500, 1000, 5000)) -> DataFrame:
    """top_<k> scenarios and daily_capacity, which alone has coverage_at_capacity."""
    capacity = capacity or investigators * per_day
    d = top_k(banded, label, score, sorted({*ks, capacity}), "alert_id")
    mine = F.col("k") == capacity
    return d.select(F.when(mine, "daily_capacity").otherwise(F.concat(F.lit("top_"), F.col("k").cast("string"))).alias("scenario"), "k", "precision_at_k", "recall_at_k", "lift_at_k", F.when(mine, F.col("recall_at_k")).alias("coverage_at_capacity"))

"""Detection and ranking metrics as aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .distributed import prefix_sums, ratio


def confusion(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    """The four counts, precision, recall, alert_rate and f1; anything over 0 is 0."""
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return [
        tp.cast("long").alias("true_positives"), fp.cast("long").alias("false_positives"), fn.cast("long").alias("false_negatives"), tn.cast("long").alias("true_negatives"),
        p.alias("precision"), r.alias("recall"), ratio(tp + fp, tp + fp + fn + tn).alias("alert_rate"), ratio(2 * p * r, p + r).alias("f1"),
    ]


def binary_metrics(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = F.coalesce(F.col(label), F.lit(0)) == 1, F.coalesce(F.col(predicted), F.lit(0)) == 1
    counts = df.groupBy(*by).agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    return counts.select(*by, *confusion(*(F.col(c) for c in ("tp", "fp", "fn", "tn"))))


def top_k(df: DataFrame, label: str, score: str, ks: Sequence[int], tie: str, ranking: str | None = None) -> DataFrame:
    """precision, recall and lift at each k: rows by falling score (null as 0), ties by `tie`, min(k, n) of them.

    The best max(ks) rows are taken with a bounded sort; totals are one aggregate."""
    d = df.select(F.coalesce(F.col(score), F.lit(0.0)).alias("s"), F.coalesce(F.col(label), F.lit(0)).alias("y"), F.col(tie).alias("t"))
    best = d.orderBy(F.desc("s"), "t").limit(max(ks)).withColumn("rank", F.row_number().over(W.orderBy(F.desc("s"), "t")))
    total = d.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("pos"))
    hits = best.agg(*(F.coalesce(F.sum(F.when(F.col("rank") <= k, F.col("y"))), F.lit(0)).alias(f"h{k}") for k in ks))
    row = F.explode(F.array(*(F.struct(F.lit(int(k)).cast("long").alias("k"), F.col(f"h{k}").alias("h")) for k in ks)))
    out = total.join(hits, how="cross").select("n", "pos", row.alias("x")).select("n", "pos", "x.k", "x.h")
    seen = F.least("k", "n")
    p = ratio(F.col("h"), seen)
    out = out.select("k", seen.alias("reviewed_alerts"), p.alias("precision_at_k"), ratio(F.col("h"), F.col("pos")).alias("recall_at_k"), ratio(p, ratio(F.col("pos"), F.col("n"))).alias("lift_at_k"))
    return out.withColumn("ranking", F.lit(ranking)) if ranking else out


def top_k_table(df: DataFrame, label: str, rankings: dict[str, str], ks: Sequence[int], tie: str) -> DataFrame:
    return reduce(DataFrame.unionByName, (top_k(df, label, c, ks, tie, name) for name, c in rankings.items()))


def _by_score(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    d = df.select(*by, F.coalesce(F.col(score), F.lit(0.0)).cast("double").alias("s"), F.coalesce(F.col(label), F.lit(0)).cast("long").alias("y"))
    return d.groupBy(*by, "s").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")).withColumn("down", -F.col("s"))


def areas(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., pr_auc, roc_auc) of all groups, both from one pass over the counts of distinct scores.

    pr_auc: steps of recall times precision, rows of equal score together. roc_auc: the share of (positive, negative) pairs
    in order, equal scores half. Both are 0 if there is one class.
    """
    by = list(by)
    d = prefix_sums(_by_score(df, label, score, by), by, "down", ["n", "pos"])
    found, seen = F.col("pos_before") + F.col("pos"), F.col("n_before") + F.col("n")
    above = (F.col("n_before") - F.col("pos_before")) + (F.col("n") - F.col("pos")) / 2
    d = d.groupBy(*by).agg(F.max(seen).alias("_n"), F.max(found).alias("_pos"), F.sum(F.col("pos") * (found / seen)).alias("_steps"), F.sum(F.col("pos") * above).alias("_wrong"))
    two, pairs = (F.col("_pos") > 0) & (F.col("_pos") < F.col("_n")), F.col("_pos").cast("double") * (F.col("_n") - F.col("_pos"))
    value = lambda v: F.coalesce(F.when(two, v), F.lit(0.0)).cast("double")
    return d.select(*by, value(F.col("_steps") / F.col("_pos")).alias("pr_auc"), value((pairs - F.col("_wrong")) / pairs).alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = (), out: str = "pr_auc") -> DataFrame:
    """(by..., pr_auc) as `areas` gives it."""
    return areas(df, label, score, by).select(*by, F.col("pr_auc").alias(out))


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), out: str = "roc_auc") -> DataFrame:
    """(by..., roc_auc) as `areas` gives it."""
    return areas(df, label, score, by).select(*by, F.col("roc_auc").alias(out))

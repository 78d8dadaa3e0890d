"""Exploratory queries over transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distributed import join_same, quantiles, ratio


def label_distribution(tx: DataFrame) -> DataFrame:
    return tx.groupBy("is_laundering").agg(F.count(F.lit(1)).alias("row_count"))


def amount_describe(tx: DataFrame) -> DataFrame:
    """Count, mean, std, min, quartiles and max of the amount per class."""
    base = tx.groupBy("is_laundering").agg(F.count("amount").alias("count"), F.avg("amount").alias("mean"), F.stddev_samp("amount").alias("std"), F.min("amount").alias("min"), F.max("amount").alias("max"))
    q = quantiles(tx, "amount", [0.25, 0.5, 0.75], ["is_laundering"])
    q = q.groupBy("is_laundering").agg(*(F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(n) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))))
    return join_same(base, q, ["is_laundering"], "left")


def amount_histogram(tx: DataFrame, bins: int = 50) -> DataFrame:
    """(is_laundering, bin, row_count, density) of log amounts; bins are equal between the least and greatest of a class."""
    d = tx.where(F.col("log_amount").isNotNull())
    span = d.groupBy("is_laundering").agg(F.min("log_amount").alias("lo"), F.max("log_amount").alias("hi"), F.count(F.lit(1)).alias("n"))
    d = join_same(d.select("is_laundering", "log_amount"), span, ["is_laundering"])
    width = (F.col("hi") - F.col("lo")) / bins
    d = d.withColumn("bin", F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(F.try_divide(F.col("log_amount") - F.col("lo"), width)))))
    d = d.groupBy("is_laundering", "bin", "n", "lo", "hi").agg(F.count(F.lit(1)).alias("row_count"))
    return d.select("is_laundering", F.coalesce("bin", F.lit(0)).cast("long").alias("bin"), "row_count", ratio(F.col("row_count"), F.col("n") * width).alias("density"))


def daily_volume(tx: DataFrame) -> DataFrame:
    return tx.groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("row_count"))


def _rates(tx: DataFrame, by: str) -> DataFrame:
    return tx.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"), F.avg("is_laundering").alias("label_rate"))


def payment_format_rates(tx: DataFrame) -> DataFrame:
    return _rates(tx, "payment_format")


def currency_pair_rates(tx: DataFrame, top: int = 10) -> DataFrame:
    return _rates(tx, "currency_pair").orderBy(F.desc("row_count"), "currency_pair").limit(top)


def cross_bank_rates(tx: DataFrame) -> DataFrame:
    return tx.groupBy("cross_bank_flag").agg(F.count(F.lit(1)).alias("row_count"), F.sum("is_laundering").alias("label_count"), F.avg("is_laundering").alias("label_rate"))


def degrees(tx: DataFrame, top: int | None = 10) -> DataFrame:
    """(role, account_id, degree): transactions of each account as sender and as receiver; the `top` of each role."""
    one = lambda c, role: tx.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("account_id")).agg(F.count(F.lit(1)).alias("degree")).select(F.lit(role).alias("role"), "account_id", "degree")
    both = [one("sender_account_id", "sender"), one("receiver_account_id", "receiver")]
    if top is not None:
        both = [d.orderBy(F.desc("degree"), "account_id").limit(top) for d in both]
    return both[0].unionByName(both[1])


def degree_histogram(tx: DataFrame, bins: int = 49, decades: int = 4) -> DataFrame:
    """(role, log_bin, account_count) in equal bins of the logarithm from degree 1 to 10 ** decades, the last with its
    upper end; larger degrees are in none."""
    at = F.least(F.floor(F.log10("degree") * bins / decades), F.lit(bins - 1)).cast("long")
    return degrees(tx, None).where(F.col("degree") <= 10**decades).groupBy("role", at.alias("log_bin")).agg(F.count(F.lit(1)).alias("account_count"))


def sample(tx: DataFrame, n: int = 200_000, seed: int = 42) -> DataFrame:
    """The first n transactions in hash order."""
    return tx.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col("transaction_id").cast("string"))), "transaction_id").limit(n)

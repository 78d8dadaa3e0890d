"""Quality reports, profiles and temporal splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.distributed import positions, quantile_row, ratio
from ..functions.windows import micros
from ..schemas import SPLITS


def quality_report(df: DataFrame) -> DataFrame:
    """One row: rows, columns, dates, labels, repeated ids and amounts."""
    n, labels = F.count(F.lit(1)), F.coalesce(F.sum("is_laundering"), F.lit(0))
    return df.agg(
        n.alias("row_count"), F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.min("timestamp").alias("min_timestamp"), F.max("timestamp").alias("max_timestamp"),
        labels.alias("label_count"), ratio(labels, n).alias("label_rate"), F.count_if(F.col("is_laundering") == 0).alias("label_0"), F.count_if(F.col("is_laundering") == 1).alias("label_1"),
        (n - F.count_distinct("transaction_id")).alias("duplicate_transaction_ids"),
        F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"), F.avg("amount").alias("mean_amount"),
    )


def missing_values(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column, from one pass."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns)).unpivot([], df.columns, "column_name", "null_count")


def profile_counts(df: DataFrame, top_n: int = 20, columns: Sequence[str] = ("payment_format", "currency_pair", "from_bank", "to_bank")) -> DataFrame:
    """(column_name, value, row_count): the commonest values of each column, nulls counted; ties by value."""
    one = lambda c: df.groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("row_count"), "value").limit(top_n).select(F.lit(c).alias("column_name"), "value", "row_count")
    return reduce(DataFrame.unionByName, map(one, columns))


def profile_amount(df: DataFrame) -> DataFrame:
    """One row: min, max, mean and exact median of the amount."""
    return df.agg(F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"), F.avg("amount").alias("mean_amount")).join(quantile_row(df, "amount", {"median_amount": 0.5}), how="cross")


def temporal_split(df: DataFrame, train: float = 0.6, validation: float = 0.2, test: float = 0.2) -> DataFrame:
    """Adds `split`: the first int(n * train) rows by (timestamp, transaction_id), the next int(n * validation), the rest."""
    if abs(train + validation + test - 1) > 1e-9:
        raise ValueError("split ratios must sum to 1")
    placed = positions(df.withColumn("_us", micros()), "_us", ["transaction_id"])
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    first, second = F.floor(F.col("_n") * train), F.floor(F.col("_n") * train) + F.floor(F.col("_n") * validation)
    split = F.when(F.col("position") < first, "train").when(F.col("position") < second, "validation").otherwise("test")
    return placed.join(F.broadcast(n), how="cross").withColumn("split", split).drop("_us", "_n", "position")


def split_manifest(df: DataFrame, order: Sequence[str] = SPLITS) -> DataFrame:
    """(split, row_count, label_count, label_rate, min_timestamp, max_timestamp) for every split, empty ones too."""
    names = df.sparkSession.createDataFrame([(s, i) for i, s in enumerate(order)], "name string, split_order long")
    got = df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("is_laundering").alias("y"), F.min("timestamp").alias("min_timestamp"), F.max("timestamp").alias("max_timestamp"))
    out = F.broadcast(names).join(got, F.col("name") == F.col("split"), "left")
    n, y = F.coalesce("n", F.lit(0)), F.coalesce("y", F.lit(0))
    return out.select(F.col("name").alias("split"), "split_order", n.alias("row_count"), y.alias("label_count"), ratio(y, n).alias("label_rate"), "min_timestamp", "max_timestamp")


def profile_splits(df: DataFrame) -> DataFrame:
    """The same of the splits that there are; rows without one are a split of their own, None."""
    n, y = F.count(F.lit(1)), F.coalesce(F.sum("is_laundering"), F.lit(0))
    out = df.groupBy(F.coalesce("split", F.lit("None")).alias("split"))
    return out.agg(n.alias("row_count"), y.alias("label_count"), ratio(y, n).alias("label_rate"), F.min("timestamp").alias("min_timestamp"), F.max("timestamp").alias("max_timestamp"))


def split_non_overlap(df: DataFrame, order: Sequence[str] = SPLITS) -> DataFrame:
    """One row: whether each split begins no earlier than the last non-empty one before it ends."""
    m = split_manifest(df, order).where("row_count > 0")
    before = F.max("max_timestamp").over(W.orderBy("split_order").rowsBetween(W.unboundedPreceding, -1))
    return m.withColumn("ok", F.col("min_timestamp") >= F.coalesce(before, F.col("min_timestamp"))).agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("non_overlapping"))

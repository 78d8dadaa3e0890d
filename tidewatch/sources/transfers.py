"""Reading, standardising, validating and writing money transfers."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..schemas import RAW_COLUMNS, STANDARD_COLUMNS


def column_name(name: str) -> str:
    """Lower case, a pandas-like `.1` as `_1`, anything else but letters and digits as `_`."""
    return re.sub(r"[^0-9a-z]+", "_", re.sub(r"\.(\d+)$", r"_\1", name.strip().lower())).strip("_")


def missing_columns(columns: Iterable[str]) -> list[str]:
    return [c for c in RAW_COLUMNS if c not in set(columns)]


def read_raw(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """A CSV file of transfers with all columns as text. The header's two columns named Account are told apart by
    position, since the schema is applied as given. Raises if the path doesn't exist."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
    df = spark.read.csv(path, schema=schema, header=True, enforceSchema=True)
    return df.limit(max_rows) if max_rows is not None else df


def standardize(raw: DataFrame, ordinal: str | None = None) -> DataFrame:
    """The standard columns. Text that can't be cast becomes null; names are normalised first; missing columns raise.

    With `ordinal`, a column of the file order, transaction_id is its dense rank position from 1 (taken in ranges, not in
    one task); without it ids follow partitions and rows as read, dense by counts of partitions.
    """
    df = raw.toDF(*(column_name(c) for c in raw.columns))
    lost = missing_columns(df.columns)
    if lost:
        raise ValueError(f"missing columns: {', '.join(lost)}")
    text = {c: F.trim(F.col(c)) for c in ("from_bank", "to_bank", "payment_currency", "receiving_currency", "payment_format")}
    amount = F.expr("try_cast(trim(amount_paid) as double)")
    pair = F.concat(F.coalesce(text["payment_currency"], F.lit("UNKNOWN")), F.lit(" -> "), F.coalesce(text["receiving_currency"], F.lit("UNKNOWN")))
    out = _numbered(df, ordinal).select(
        "transaction_id",
        F.expr("try_to_timestamp(trim(timestamp), 'yyyy/MM/dd HH:mm')").alias("timestamp"),
        text["from_bank"].alias("from_bank"), text["to_bank"].alias("to_bank"),
        F.trim("account").alias("sender_account_id"), F.trim("account_1").alias("receiver_account_id"),
        amount.alias("amount_paid"), F.expr("try_cast(trim(amount_received) as double)").alias("amount_received"),
        text["payment_currency"].alias("payment_currency"), text["receiving_currency"].alias("receiving_currency"), text["payment_format"].alias("payment_format"),
        pair.alias("currency_pair"),
        F.when(text["from_bank"].eqNullSafe(text["to_bank"]), 0).otherwise(1).alias("cross_bank_flag"),
        amount.alias("amount"), F.log1p(F.when(amount < 0, 0.0).otherwise(amount)).alias("log_amount"),
        F.expr("try_cast(trim(is_laundering) as int)").alias("is_laundering"),
    )
    return out.select(STANDARD_COLUMNS)


def _numbered(df: DataFrame, ordinal: str | None) -> DataFrame:
    if ordinal is not None:
        from ..functions.distributed import positions

        return positions(df.withColumn("_o", F.col(ordinal).cast("long")), "_o", ["_o"]).withColumn("transaction_id", F.col("position") + 1)
    d = df.withColumn("_m", F.monotonically_increasing_id()).withColumn("_p", F.shiftright("_m", 33))
    counts = d.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    base = counts.select("_p", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    return d.join(F.broadcast(base), "_p").withColumn("transaction_id", F.col("_base") + F.col("_m") - F.shiftleft("_p", 33) + 1)


def ingest(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    return standardize(read_raw(spark, path, max_rows))


def schema_violations(df: DataFrame) -> DataFrame:
    """(violation, row_count): null timestamps, labels and amounts, and negative amounts."""
    checks = {"null_timestamp": F.col("timestamp").isNull(), "null_label": F.col("is_laundering").isNull(), "null_amount": F.col("amount").isNull(), "negative_amount": F.col("amount") < 0}
    return df.agg(*(F.count_if(c).alias(n) for n, c in checks.items())).unpivot([], list(checks), "violation", "row_count")


def validate(df: DataFrame) -> DataFrame:
    """`df` itself; raises ValueError when a row breaks the contract."""
    bad = [r["violation"] for r in schema_violations(df).where("row_count > 0").collect()]
    if bad:
        raise ValueError(f"invalid transactions: {', '.join(sorted(bad))}")
    return df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_metrics(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A small result as one CSV file with a header, or one JSON lines file."""
    writer = df.coalesce(1).write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)


def first_available(*tables: DataFrame | None) -> DataFrame | None:
    """The first table that is given: extended scores, else base scores, else none."""
    return next((t for t in tables if t is not None), None)


def from_events(events: DataFrame) -> DataFrame:
    """Events as transfers: a user pays the account named by the property k; the value is the amount."""
    k = F.get_json_object("props", "$.k").cast("long")
    money = F.array(*(F.lit(c) for c in ("USD", "EUR", "GBP")))
    currency = lambda c: F.element_at(money, (c % 3 + 1).cast("int"))
    pay, get = currency(F.col("user_id")), currency(F.col("k"))
    label = (F.col("event_id") % 97 == 0) | ((F.col("value") >= 200) & (F.col("event_id") % 3 != 0))
    d = events.withColumn("k", k)
    named = lambda letter, c: F.concat(F.lit(letter), c.cast("string"))
    out = d.select(
        F.col("event_id").alias("transaction_id"), F.col("ts").cast("timestamp").alias("timestamp"),
        named("B", F.col("user_id") % 7).alias("from_bank"), named("B", F.col("k") % 7).alias("to_bank"),
        named("A", F.col("user_id")).alias("sender_account_id"), named("A", F.col("k")).alias("receiver_account_id"),
        F.col("value").alias("amount_paid"), F.col("value").alias("amount_received"), pay.alias("payment_currency"), get.alias("receiving_currency"),
        F.col("event_type").alias("payment_format"), F.concat(pay, F.lit(" -> "), get).alias("currency_pair"),
        F.when(F.col("user_id") % 7 != F.col("k") % 7, 1).otherwise(0).alias("cross_bank_flag"),
        F.col("value").alias("amount"), F.log1p(F.when(F.col("value") < 0, 0.0).otherwise(F.col("value"))).alias("log_amount"), F.when(label, 1).otherwise(0).alias("is_laundering"),
    )
    return out.select(STANDARD_COLUMNS)

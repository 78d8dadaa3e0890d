"""Helpers shared by the training-data operators: shared scratch storage, bounded samples, fixed-size filters."""

from __future__ import annotations

import contextlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.graphs import stored_path

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for `name` in the folder the cluster shares (spark.checkpoint.dir)."""
    return stored_path(spark, name)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, n: int):
    """While it lasts, tasks get n rows at a time from Spark: for rows much larger than a text. What runs must end in it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release(*tables: DataFrame) -> None:
    """Deletes stored tables once all that was made of them is stored itself."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fold(id_col: str, mod: int):
    """crc32 of the id written as text, modulo `mod`; null ids count as the empty string."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % mod


def hash_order(id_col: str, seed: str):
    """A reproducible pseudo-random order of ids, the same in any engine that has md5."""
    return F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def bounded_sample(df: DataFrame, by: str, id_col: str, limit: int, seed: str) -> DataFrame:
    """The `limit` rows of each value of `by` that come first in hash order, or all if there are fewer.

    `by` must have few values (classes, languages). A first filter on the hash keeps about twice the limit of each
    value, so the ranking that follows sees a bounded number of rows however many a value has.
    """
    sizes = df.groupBy(F.col(by).alias("_by")).agg(F.count(F.lit(1)).alias("_n"))
    share = F.conv(F.substring("_h", 1, 12), 16, 10).cast("double") / float(16**12)
    kept = df.withColumn("_h", hash_order(id_col, seed)).join(F.broadcast(sizes), F.col(by).eqNullSafe(F.col("_by")))
    kept = kept.where(share <= F.lit(2.0 * limit + 100) / F.col("_n"))
    rank = F.row_number().over(W.partitionBy("_by").orderBy("_h", id_col))
    return kept.withColumn("_r", rank).where(F.col("_r") <= limit).drop("_by", "_n", "_h", "_r")


class FixedFilter:
    """A Bloom filter whose size never grows: past its capacity it lets more through, it never loses a member.

    It only saves shuffling rows that a later exact join would drop.
    """

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    @classmethod
    def of(cls, df: DataFrame, key: str, bits: int = 1 << 24) -> FixedFilter:
        """From a long column; the driver receives bits / 64 words at most."""
        spots = F.explode(F.array(*(F.pmod(F.xxhash64(F.lit(i), F.col(key).cast("long")), F.lit(bits)) for i in (1, 2))))
        rows = (
            df.select(spots.alias("s"))
            .groupBy(F.shiftright("s", 6).alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("v"))
            .toPandas()
        )
        words = np.zeros(bits // 64, dtype=np.int64)
        words[rows["w"].to_numpy(dtype=np.int64)] = rows["v"].to_numpy(dtype=np.int64)
        return cls(words, bits)

    @staticmethod
    def spots(key: str, bits: int = 1 << 24):
        """Columns to pass to `test` with each row."""
        return [F.pmod(F.xxhash64(F.lit(i), F.col(key).cast("long")), F.lit(bits)).alias(f"_spot{i}") for i in (1, 2)]

    def test(self, *spots: np.ndarray) -> np.ndarray:
        out = np.ones(len(spots[0]), dtype=bool)
        for s in spots:
            s = np.asarray(s, dtype=np.int64)
            out &= (self.words[s >> 6] >> (s & 63)) & 1 == 1
        return out


def where_in(df: DataFrame, key: str, keys: DataFrame, keys_col: str, bits: int = 1 << 24) -> DataFrame:
    """Rows of `df` whose `key` may be in `keys` (a superset; join afterwards). Only the key's hashes visit Python."""
    held = df.sparkSession.sparkContext.broadcast(FixedFilter.of(keys, keys_col, bits))

    @F.pandas_udf("boolean")
    def may(a, b):
        import pandas as pd

        return pd.Series(held.value.test(a.to_numpy(), b.to_numpy()))

    return df.where(may(*FixedFilter.spots(key, bits)))

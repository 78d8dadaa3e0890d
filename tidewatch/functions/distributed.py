"""Order statistics without a single-task window: prefix sums in two levels, and what follows from them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .graphs import stored


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0 or null."""
    return F.coalesce(F.when(b != 0, a / b), F.lit(0.0)).cast("double")


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join in which null keys match; without keys `right` has one row, which every row of `left` gets."""
    if not keys:
        return left.join(F.broadcast(right), how="cross")
    renamed = right.select(*(F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in right.columns))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))
    return left.join(renamed, same, how).drop(*(f"_k_{k}" for k in keys))


def prefix_sums(df: DataFrame, by: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Adds `<value>_before`: the sum of the value over rows of the group with a smaller `order`, which is distinct within
    a group.

    Rows are dealt to ranges of about equal size by Spark's range partitioning, whose bounds come from a sample of the
    keys, so skewed values spread as well as even ones and no task sorts a whole group, however large. The ranges are
    written once, since both their totals and the sums within them must see the same bounds.
    """
    by = list(by)
    d = stored(df.repartitionByRange(*by, order).withColumn("_r", F.spark_partition_id()), "ranges")
    earlier = W.partitionBy(*by).orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    sums = d.groupBy(*by, "_r").agg(*(F.sum(v).alias(f"_s_{v}") for v in values))
    sums = sums.select(*by, "_r", *(F.coalesce(F.sum(f"_s_{v}").over(earlier), F.lit(0)).alias(f"_b_{v}") for v in values))
    within = W.partitionBy(*by, "_r").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    d = join_same(d, sums, [*by, "_r"])
    d = d.withColumns({f"{v}_before": F.col(f"_b_{v}") + F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values})
    return d.drop("_r", *(f"_b_{v}" for v in values))


def _bucket(v: Column) -> Column:
    """A rising whole number of a value: 256 to each doubling of its size, so that few thousand cover any table."""
    return (F.signum(v) * F.floor(F.log2(F.abs(v) + 1) * 256)).cast("long")


#: Equal parts into which a bucket's values are dealt.
_PARTS = 65_536


def quantiles(df: DataFrame, value: str, ps: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., p, quantile): exact, linear between neighbours; nulls are left out and an empty group has no row.

    A selection by refined histograms, for all groups and percentiles at once, that writes nothing: distinct values are
    counted by buckets, the buckets that hold the wanted ranks are cut into equal parts and counted again, and what is in
    the part that holds a rank is told by order. Histograms have a bounded number of rows a group and repeated values
    cost nothing, so no task sorts a group, however large.
    """
    by = list(by)
    d = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    d = d.withColumn("_b", _bucket(F.col("_v")))
    first = d.groupBy(*by, "_b").agg(F.sum("_n").alias("_in"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    every = W.partitionBy(*by)
    first = first.withColumns({"_before": _earlier("_in", every.orderBy("_b")), "_total": F.sum("_in").over(every)})
    rank = lambda p, f: F.struct(F.lit(float(p)).alias("p"), F.lit(f is F.ceil).alias("_up"), f((F.col("_total") - 1) * F.lit(float(p))).alias("_rank"), ((F.col("_total") - 1) * F.lit(float(p))).alias("_at"))
    wanted = first.withColumn("_w", F.explode(F.array(*(rank(p, f) for p in ps for f in (F.floor, F.ceil))))).select(*by, "_b", "_least", "_most", "_before", "_in", "_w.*")
    wanted = wanted.where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_in"))).withColumn("_rank", F.col("_rank") - F.col("_before")).drop("_before", "_in")
    near = join_same(wanted, d, [*by, "_b"])
    part = F.when(F.col("_most") > F.col("_least"), F.floor((F.col("_v") - F.col("_least")) / (F.col("_most") - F.col("_least")) * (_PARTS - 1))).otherwise(0).cast("long")
    near = near.withColumn("_part", part)
    one = [*by, "p", "_up"]
    parts = near.groupBy(*one, "_rank", "_part").agg(F.sum("_n").alias("_in"))
    parts = parts.withColumn("_before", _earlier("_in", W.partitionBy(*one).orderBy("_part")))
    parts = parts.where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_in"))).select(*one, "_part", "_before")
    last = join_same(near, parts, [*one, "_part"]).withColumn("_before", F.col("_before") + _earlier("_n", W.partitionBy(*one).orderBy("_v")))
    last = last.where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
    lo, hi = F.max(F.when(~F.col("_up"), F.col("_v"))), F.max(F.when(F.col("_up"), F.col("_v")))
    return last.groupBy(*by, "p").agg((lo + (hi - lo) * F.max(F.col("_at") - F.floor("_at"))).alias("quantile"))


def _earlier(value: str, w: W) -> Column:
    return F.coalesce(F.sum(value).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def first_by_hash(df: DataFrame, n: int, hashed: str, tie: str, digits: int = 4, few: int = 10_000) -> DataFrame:
    """The first n rows in the order of a column of hexadecimal digits, then of `tie`.

    The n-th row is found by counting rows by their next `digits`, in the range that holds it, until that has few rows;
    what comes before the range is taken by a filter, so only those few are sorted.
    """
    prefix, need = "", n
    while True:
        inside = df.where(F.col(hashed).startswith(prefix)) if prefix else df
        counts = sorted((r[0], r[1]) for r in inside.groupBy(F.substring(hashed, len(prefix) + 1, digits)).count().collect())
        if sum(c for _, c in counts) <= need:
            return df if not prefix else df.where((F.col(hashed) < prefix) | F.col(hashed).startswith(prefix))
        for part, c in counts:
            if c > need:
                prefix += part
                break
            need -= c
        if c <= few or not part:
            break
    rest = df.where(F.col(hashed).startswith(prefix)).orderBy(hashed, tie).limit(need)
    return df.where(F.col(hashed) < prefix).unionByName(rest)


def quantile_row(df: DataFrame, value: str, ps: dict[str, float], default: float | None = None) -> DataFrame:
    """One row with a column per named quantile; `default` where there is no value."""
    q = quantiles(df, value, sorted(set(ps.values())))
    return q.agg(*(F.coalesce(F.max(F.when(F.col("p") == p, F.col("quantile"))), F.lit(default).cast("double")).alias(n) for n, p in ps.items()))


def positions(df: DataFrame, order: str, tie: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Adds `position` from 0 within each group by (order, tie...). Only rows of equal `order` are sorted together."""
    by = list(by)
    counts = df.groupBy(*by, order).agg(F.count(F.lit(1)).alias("_n"))
    before = prefix_sums(counts, by, order, ["_n"]).drop("_n")
    among = F.row_number().over(W.partitionBy(*by, order).orderBy(*tie)) - 1
    return join_same(df.withColumn("_among", among), before, [*by, order]).withColumn("position", (F.col("_n_before") + F.col("_among")).cast("long")).drop("_n_before", "_among")

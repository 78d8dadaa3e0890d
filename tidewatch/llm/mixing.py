"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled and queued, up to `repeats` times over; a document's virtual finish time is the
source's tokens up to and including it, divided by the source's target. All queues are merged in order of finish time
and cut at the total budget, so every source ends near its target.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORD, hash_order, stored


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], repeats: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size); weights go to sources in code-point order, null last.

    The budget is the sum of all sizes. A target stops at `repeats` times its source's size and the excess is shared
    again by weight: in order of size per weight, sources are full as long as the level left for the others reaches
    them. One row per source, so the windows without partitions here are small.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * repeats)
    order = W.orderBy(F.col("most").cast("double") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("most").over(before), F.lit(0))
    others = F.sum("weight").over(W.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("level", left.cast("double") / others.cast("double"))
    full = F.col("most").cast("double") <= F.col("level") * F.col("weight")
    s = s.withColumn("full", full)
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(W.partitionBy())
    # the level falls with each source that is passed over though it is not full: the first of those has the highest
    return s.select("source", "source_size", F.when(F.col("full"), F.col("most").cast("double")).otherwise(level * F.col("weight")).alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    repeats: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
    bucket_rows: int = 20_000,
) -> DataFrame:
    """One row per document: id, size (words), source, source_size, target, taken (words, repeats counted), nth.

    Texts without words, null or empty, have size 0 and take nothing; a null source is a source of its own. Repeated
    rows count each time; `nth` numbers those of equal id, source and size, which the mix can't tell apart, from 1. An empty table gives no rows. Reruns agree: the order is by md5 of seed and id, then id, size.

    Running sums are taken in two levels, so no source needs one task: hash ranges of about `bucket_rows` documents
    within a source, finish-time ranges across sources; only the range in which the budget ends is summed row by row.
    """
    d = docs.select(F.col(id_col).alias("id"), n_words(F.col(text_col)).alias("size"), F.col(source_col).alias("source"))
    d = stored(d.withColumn("h", hash_order("id", seed)), "mix-sizes")
    sizes = stored(targets(d.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats), "mix-targets")
    n, budget = d.agg(F.count(F.lit(1)), F.sum("size")).first()
    ranges = max(1, -(-n // bucket_rows))

    d = d.withColumn("b", F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("double") * ranges / float(2**32)).cast("long"))
    sums = d.groupBy("source", "b").agg(F.sum("size").alias("s"))
    earlier = W.partitionBy("source").orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s2"), F.col("b").alias("b2"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("base"))
    within = W.partitionBy("source", "b").orderBy("h", "id", "size").rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumn("run", F.sum("size").over(within))
    d = d.join(sums, F.col("source").eqNullSafe(F.col("s2")) & (F.col("b") == F.col("b2")))
    d = d.join(sizes.withColumnRenamed("source", "s3"), F.col("source").eqNullSafe(F.col("s3")))
    d = stored(d.select("id", "size", "source", "h", "source_size", "target", (F.col("base") + F.col("run")).alias("upto")), "mix-queues")

    lap = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("lap")
    q = d.where("size > 0 and target > 0").select("id", "size", "source", "h", "source_size", "target", "upto", lap)
    q = q.where(F.col("lap") * F.col("source_size") <= F.col("target"))
    finish = (F.col("lap") * F.col("source_size") + F.col("upto")).cast("double") / F.col("target")
    q = q.withColumn("finish", finish)
    whole, edge, base = _cut(q, budget or 0, bucket_rows)
    taken = [whole.select("id", "source", "size")]
    if edge is not None:
        line = W.partitionBy("at").orderBy("finish", F.col("source").asc_nulls_last(), "h", "id", "size", "lap").rowsBetween(W.unboundedPreceding, 0)
        edge = edge.withColumn("at", F.lit(0)).withColumn("upto", F.sum("size").over(line) + base)
        taken.append(edge.where(F.col("upto") <= budget).select("id", "source", "size"))
    return _with_taken(d, reduce(DataFrame.unionByName, taken))


def _cut(q: DataFrame, budget: int, bucket_rows: int, ways: int = 2048) -> tuple[DataFrame, DataFrame | None, int]:
    """Copies that end before the budget does for certain, those of the narrow finish range in which it ends, and the
    tokens before that range. Ranges are halved `ways`-fold until few copies are left or all finish together."""
    low, high = q.agg(F.min("finish"), F.max("finish")).first()
    if low is None:
        return q, None, 0
    before, inside, base = F.lit(False), F.lit(True), 0
    while True:
        r = F.least(F.floor((F.col("finish") - low) / F.lit(max(high - low, 1e-300)) * ways), F.lit(ways - 1))
        totals = q.where(inside).groupBy(r.alias("r")).agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"), F.min("finish").alias("lo"), F.max("finish").alias("hi"))
        upto = F.sum("s").over(W.orderBy("r"))
        cut = totals.withColumn("upto", upto + base).where(F.col("upto") > budget).orderBy("r").first()
        if cut is None:
            return q.where(before | inside), None, 0
        before, inside, base = before | (inside & (r < cut["r"])), inside & (r == cut["r"]), cut["upto"] - cut["s"]
        if cut["n"] <= bucket_rows or cut["lo"] == cut["hi"]:
            return q.where(before), q.where(inside), base
        low, high = cut["lo"], cut["hi"]


def _with_taken(d: DataFrame, taken: DataFrame) -> DataFrame:
    """Copies taken of repeated rows (equal id, source and size) are dealt to them evenly, which the laps make exact."""
    key = ["id", "source", "size"]
    rows = d.groupBy(*key, "source_size", "target").agg(F.count(F.lit(1)).alias("rows"))
    got = taken.groupBy(*(F.col(k).alias(f"t_{k}") for k in key)).agg(F.count(F.lit(1)).alias("copies"))
    same = [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in key]
    both = rows.join(got, same[0] & same[1] & same[2], "left").withColumn("copies", F.coalesce("copies", F.lit(0)))
    one = both.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    share = F.floor(F.col("copies") / F.col("rows")) + F.when(F.col("i") <= F.col("copies") % F.col("rows"), 1).otherwise(0)
    return one.select("id", "size", "source", "source_size", "target", (share * F.col("size")).cast("long").alias("taken"), F.col("i").alias("nth"))

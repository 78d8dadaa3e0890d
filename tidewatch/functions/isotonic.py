"""Isotonic regression in ranges: pooled blocks of each range, merged, and read by linear interpolation."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .distributed import positions, prefix_sums
from .graphs import stored

_BLOCK = "total double, weight double, first double, last double"


def pooled(blocks: Iterable[tuple[float, float, float, float]]) -> list[list[float]]:
    """Blocks (total, weight, first, last) in order of x, neighbours whose means don't rise pooled. Pooling blocks that were
    pooled before gives what pooling all their values would, so ranges may be pooled apart and then together."""
    out: list[list[float]] = []
    for total, weight, first, last in blocks:
        out.append([total, weight, first, last])
        while len(out) > 1 and out[-2][0] * out[-1][1] >= out[-1][0] * out[-2][1]:
            t, w, _, end = out.pop()
            out[-1] = [out[-1][0] + t, out[-1][1] + w, out[-1][2], end]
    return out


def _pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[list[float]] = []
    for b in batches:
        held = pooled([*map(tuple, held), *b[["total", "weight", "first", "last"]].itertuples(index=False, name=None)])
    yield pd.DataFrame(held, columns=["total", "weight", "first", "last"], dtype=float)


def isotonic_knots(rows: DataFrame, x: str, y: str, weight: str | None = None) -> DataFrame:
    """(x, value, k): both ends of each block of the rising fit, numbered from 0. Null x and y are left out.

    Equal x are one point. Each range of x is pooled in a task of its own; what is left is pooled in one task, which sees
    blocks only: with labels of 0 and 1, means of rising blocks are distinct fractions, so n rows leave about the two
    thirds power of n.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    d = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).cast("double").alias("first")).agg(F.sum(F.col(y).cast("double") * w).alias("total"), F.sum(w).alias("weight")).where("weight > 0")
    d = d.select("total", "weight", "first", F.col("first").alias("last")).repartitionByRange("first").sortWithinPartitions("first")
    blocks = stored(d.mapInPandas(_pool, _BLOCK), "isotonic-ranges")
    blocks = stored(blocks.repartition(1).sortWithinPartitions("first").mapInPandas(_pool, _BLOCK), "isotonic-blocks")
    ends = blocks.select(F.explode(F.array_distinct(F.array("first", "last"))).alias("x"), (F.col("total") / F.col("weight")).alias("value"))
    return positions(ends, "x", ["value"]).withColumnRenamed("position", "k")


def interpolated(df: DataFrame, x: str, knots: DataFrame, out: str) -> DataFrame:
    """Adds the fit at x: linear between knots, level beyond the first and last, null for a null x.

    Distinct values of x and knots are counted together in ranges, which tells each value the knots next to it.
    """
    k = stored(knots, "isotonic-knots")
    values = df.where(F.col(x).isNotNull()).select(F.col(x).cast("double").alias("x")).distinct()
    line = k.select(F.struct("x", F.lit(0).alias("asks")).alias("at"), F.lit(1).alias("one")).unionByName(values.select(F.struct("x", F.lit(1).alias("asks")).alias("at"), F.lit(0).alias("one")))
    placed = prefix_sums(line, [], "at", ["one"]).where("at.asks = 1").select(F.col("at.x").alias("_at_x"), F.col("one_before").alias("_next"))
    low, high = (k.select(F.col("x").alias(f"_{n}x"), F.col("value").alias(f"_{n}v"), (F.col("k") + o).alias("_next")) for n, o in (("l", 1), ("h", 0)))
    placed = placed.join(low, "_next", "left").join(high, "_next", "left")
    between = F.col("_lv") + (F.col("_hv") - F.col("_lv")) * (F.col("_at_x") - F.col("_lx")) / (F.col("_hx") - F.col("_lx"))
    fit = F.when(F.col("_lx").isNull(), F.col("_hv")).when(F.col("_hx").isNull() | (F.col("_lx") == F.col("_at_x")), F.col("_lv")).otherwise(between)
    return df.join(placed.select("_at_x", fit.alias(out)), F.col(x).cast("double") == F.col("_at_x"), "left").drop("_at_x")

"""Connected components of an edge table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_written: list[str] = []


def stored_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder the cluster shares; where none is set, as in tests on one machine, a folder of this machine."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", base)
    _written.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _written[-1]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again, which cuts the lineage of iterative work."""
    path = stored_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> None:
    """Deletes all that this process has stored so far; no result made of it may be read afterwards."""
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): the smallest node of each undirected component; self-edges keep single nodes.

    Rounds of contraction: every node takes the least number among itself and its neighbours, then that of this node, and
    all nodes of one number are one node of the next round, with the edges that still lead from one to another. Numbers
    are hashes of the nodes, so chains in the nodes' order shrink like any others, edges grow fewer from round to round,
    and all rows are read a fixed number of times. Rounds are put together from the last, the smallest, to the first.
    """
    e = stored(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null"), "edges")
    names = e.select(F.col("a").alias("node")).unionByName(e.select(F.col("b").alias("node"))).distinct()
    seed, clash = -1, True
    while clash:  # two nodes of one number: all are numbered anew
        seed += 1
        number = lambda c, seed=seed: _number(c, seed)
        nodes = stored(names.select("node", number("node").alias("id")), "nodes")
        clash = not nodes.groupBy("id").count().where("count > 1").isEmpty()
    e = e.where("a <> b").select(number("a").alias("x"), number("b").alias("y"))
    rounds: list[DataFrame] = []
    while True:
        e = stored(e.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if e.isEmpty():
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "labels")
        rounds.append(stored(near.join(near.select(F.col("a").alias("m"), F.col("m").alias("root")), "m").select(F.col("a").alias("id"), "root"), "labels"))
        for side, to in (("a", "x"), ("b", "y")):
            e = e.join(rounds[-1].select(F.col("id").alias(side), F.col("root").alias(to)), side)
        e = e.where("x <> y").select("x", "y")
    if not rounds:
        return nodes.select("node", F.col("node").alias("component"))
    roots = rounds.pop()
    while rounds:
        last = roots.select(F.col("id").alias("root"), F.col("root").alias("last"))
        roots = rounds.pop().join(last, "root", "left").select("id", F.coalesce("last", "root").alias("root"))
    found = stored(nodes.join(roots, "id", "left").select("node", "root"), "labels")
    least = found.where("root is not null").groupBy("root").agg(F.min("node").alias("component"))
    return found.join(least, "root", "left").select("node", F.coalesce("component", "node").alias("component"))


def _number(c: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), c)

"""A corpus pipeline of five stages: quality, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns documents' columns, the last
one packed pieces. Between stages the documents are written as Parquet and read again.

In every stage a null text counts as empty, null ids, languages and sources are values like any other, other columns are
left out, and an empty table gives an empty one. Rows that repeat an id are rows of their own; where a stage decides by
id, they stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewatch.llm.common import stored
from tidewatch.llm.exact_dedup import exact_dedup, normalised, sha256
from tidewatch.llm.mixing import mix_sources, n_words
from tidewatch.llm.ngram_join import ngram_components
from tidewatch.llm.packing import pack_documents
from tidewatch.llm.quality import score_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the co-trained classifier rejects. Of rows that repeat an id all stay if one is kept."""
    scores = score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = scores.groupBy("id").agg(F.max("keep").alias("keep")).where("keep")
    return docs.select(COLUMNS).join(kept, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select(COLUMNS)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that of the smallest id; of repeated rows one."""
    kept = exact_dedup(docs).where("kept").select("id", F.col("digest").alias("d"))
    rows = docs.select(COLUMNS).withColumn("digest", sha256(normalised(F.col("text"))))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d")), "left_semi")
    again = F.row_number().over(W.partitionBy("doc_id", "digest").orderBy("text"))
    return rows.withColumn("again", again).where("again = 1").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of similar documents."""
    ids = ngram_components(docs).where(F.col("id").eqNullSafe(F.col("component"))).select("id").distinct()
    return docs.select(COLUMNS).join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a document taken several times is as many rows.

    Rows that repeat an id are told apart by source and size, and by number where these are equal too.
    """
    taken = mix_sources(docs).where("taken > 0")
    taken = taken.select("id", F.col("size").alias("s"), F.col("source").alias("of"), "nth", (F.col("taken") / F.col("size")).cast("int").alias("copies"))
    rows = docs.select(*COLUMNS, n_words(F.col("text")).alias("words")).where("words > 0")
    rows = rows.withColumn("i", F.row_number().over(W.partitionBy("doc_id", "source", "words").orderBy("text")))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("words") == F.col("s")) & F.col("source").eqNullSafe(F.col("of")) & (F.col("i") == F.col("nth"))
    return rows.join(taken, same).select(*COLUMNS, F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces: doc_id, words, copy, piece, size, bin, capacity, at."""
    return pack_documents(docs).withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality), ("exact_dedup", dedup), ("ngram_join", near_dedup), ("mix_sources", mix), ("best_fit_packing", pack)]

#: SQL can't express the trained classifier of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

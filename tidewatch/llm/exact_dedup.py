"""Exact dedup with a log-structured merge index.

Each task keeps a memtable of digests. A full memtable is flushed as a run: entries sorted by digest, each with the ids
it has seen, in Parquet files with Bloom filters in their footers. Compaction merges all runs into one table that keeps
the smallest id of every digest: an aggregate over the runs' entries, since Spark's sorted shuffle is that merge. Rows
look up their run's entry there; a hit (a row that does not stay) is then compared byte for byte with the row that
stays, and goes to the class of its own bytes if only the digests were equal.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored, where_in

_RUN = "digest string, run long, entry_null boolean, entry_id long, ids array<long>"


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as empty. Lone spaces are left alone, which saves most matches."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _flush(digests: list, ids: list, run: int) -> pa.RecordBatch:
    table = pa.table({"digest": pa.concat_arrays(digests), "id": pa.concat_arrays(ids)}).combine_chunks()
    table = table.sort_by([("digest", "ascending"), ("id", "ascending")])  # nulls come last
    digest, id_ = table["digest"].combine_chunks(), table["id"].combine_chunks()
    coded = digest.dictionary_encode().indices.to_numpy()
    first = np.flatnonzero(np.concatenate([[True], coded[1:] != coded[:-1]]))
    head = id_.take(pa.array(first))
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(coded)).astype(np.int32)), id_)
    return pa.RecordBatch.from_arrays(
        [digest.take(pa.array(first)), pa.array(np.full(len(first), run)), head.is_null(), head, lists],
        names=["digest", "run", "entry_null", "entry_id", "ids"],
    )


def sorted_runs(hashed: DataFrame, memtable_rows: int) -> DataFrame:
    """Runs of (digest, id): one row for each digest of a memtable. A task flushes whenever its memtable is full."""

    def memtable(batches):
        run, held, digests, ids = TaskContext.get().partitionId() << 24, 0, [], []
        for b in batches:
            digests.append(b.column(0).cast(pa.string()))
            ids.append(b.column(1))
            held += len(b)
            if held >= memtable_rows:
                yield _flush(digests, ids, run)
                run, held, digests, ids = run + 1, 0, [], []
        if held:
            yield _flush(digests, ids, run)

    return hashed.mapInArrow(memtable, _RUN)


def compacted(runs: DataFrame) -> DataFrame:
    """The merged level: for each digest its size, the smallest id and the run which holds that."""
    best = F.min(F.struct("entry_null", "entry_id", "run"))
    return runs.groupBy("digest").agg(best.alias("best"), F.sum(F.size("ids")).alias("group_size")).select(
        "digest", F.col("best.entry_id").alias("keep_id"), F.col("best.run").alias("keep_run"), "group_size"
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    memtable_rows: int = 1 << 18,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest (of the normalised text).

    Texts are equal when identical after white-space normalisation; null and empty texts are equal. The smallest id
    stays; null ids come after all others (a group of null ids only has keep_id null), and of repeated rows with the
    id that stays exactly one is kept. An empty table gives no rows. Other columns are ignored.

    No row of a digest group is ever gathered in one place: memtables pre-aggregate, what is shuffled by digest are run
    entries, and the joins that follow are sort-merge joins which adaptive execution can split.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    hashed = narrow.select(digest(normalised(F.col("text"))).alias("digest"), "id")
    blooms = {"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.expected.ndv#digest": str(memtable_rows)}
    runs = stored(sorted_runs(hashed, memtable_rows), "dedup-runs", **blooms)
    level = stored(compacted(runs), "dedup-level", **blooms)
    first = (F.col("run") == F.col("keep_run")) & (F.col("pos") == 0)
    rows = runs.join(level, "digest").select("digest", "run", "keep_run", "keep_id", "group_size", F.posexplode("ids").alias("pos", "id"))
    rows = rows.select("id", "keep_id", "group_size", first.alias("kept"), "digest")
    members = _members(narrow, rows.where("group_size > 1"), level.where("group_size > 1"), digest)
    stays = members.where(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("digest").agg(F.min("body").alias("stays"))
    wrong = stored(members.join(stored(stays, "dedup-stays"), "digest").where("body <> stays").select("digest").distinct(), "dedup-unequal")
    if wrong.isEmpty():
        return rows
    return rows.join(wrong, "digest", "left_anti").select(rows.columns).unionByName(_separated(members.join(wrong, "digest", "left_semi")))


def _members(docs: DataFrame, rows: DataFrame, groups: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """(digest, id, body, keep_id) of every row in the groups, for the comparison of bytes.

    A fixed-size filter of their ids spares most unique texts the second digest and the shuffle.
    """
    texts = where_in(docs, "id", rows, "id").select("id", normalised(F.col("text")).alias("body"))
    texts = texts.select("id", "body", digest(F.col("body")).alias("digest"))
    return stored(texts.join(groups.select("digest", "keep_id"), "digest"), "dedup-members")


def _separated(members: DataFrame) -> DataFrame:
    """Classes of equal bytes of all rows whose digest stands for several texts; as good as none in practice."""
    same = W.partitionBy("digest", "body")
    return members.select(
        "id",
        F.min("id").over(same).alias("keep_id"),
        F.count(F.lit(1)).over(same).alias("group_size"),
        (F.row_number().over(same.orderBy(F.col("id").asc_nulls_last())) == 1).alias("kept"),
        "digest",
    )

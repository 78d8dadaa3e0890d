"""Ranked lexical search over a length-stratified index.

The documents' terms are counted twice: once for the totals that every normaliser m needs, once to be dealt by ranges of
(m, row), so that documents of equal m meet in order and a common length spreads over many tasks. A task turns
each run of documents of one m into blocks (a stratum, cut where it is large): a dictionary of terms with document
frequency and highest tf, and postings by tf within each term. The blocks are written to the shared folder.

A search asks the index in four passes, of which the first two read dictionaries only: document frequencies give the
terms' weights; bounds (each term at its highest tf in the block) name the most promising blocks of every query; these
are visited first, and the 20th score there is a floor; then every block is visited by the queries whose bound reaches
the floor and the running 20th score of the task. Within a block all documents have the same m, so the impact of a tf is
computed once. A task returns 20 documents per query at most, and the last ranking is of those.

Queries are taken in chunks of `most_terms` (query, term) pairs, which is what a task holds of them at a time; a longer
query is a chunk of its own. Terms are known by 64-bit hashes of their bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import arrow_rows, release, stored
from .wordhash import slices, spans

_TERM = np.zeros(256, dtype=bool)
_TERM[0x30:0x3A] = _TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: Fixed values of the score.
BASE, SLOPE, SCALE, TF, LENGTH = 75, 25, 1_000_000_000, 1000, 12
_NULL = np.iinfo(np.int64).max

_FORWARD = "m long, row long, id long, terms binary, tfs binary"
_INDEX = "block long, m long, terms binary, df binary, top binary, tf binary, size binary, posts binary, docs binary"


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term in order, and the position of each text's first term (and the end)."""
    n = len(data)
    inside = _TERM[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return spans(_LOWER[data], starts, ends), np.searchsorted(starts, offsets)


def counted(hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct terms of each text, sorted, and how often it has them."""
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        yield np.unique(hashes[lo:hi], return_counts=True)


def normaliser(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    if len(n) and SLOPE * int(n.max()) * docs < 1 << 62:
        return BASE + (SLOPE * n * docs) // max(terms, 1)
    return np.array([BASE + (SLOPE * int(x) * docs) // max(terms, 1) for x in n], dtype=np.int64)


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return (SCALE * tf) // (TF * tf + LENGTH * m)


class Index:
    """Blocks in the shared folder, with the numbers of documents and terms behind them."""

    def __init__(self, blocks: DataFrame, docs: int, terms: int):
        self.blocks, self.docs, self.terms = blocks, docs, terms


def _totals(texts: DataFrame) -> tuple[int, int]:
    def count(batches):
        docs = terms = 0
        for b in batches:
            for _, _, data, offsets in slices(b.column(0)):
                n = np.diff(term_hashes(data, offsets)[1])
                docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([terms])], names=["docs", "terms"])

    row = texts.mapInArrow(count, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def _block(block: int, m: int, docs: list, terms: list, tfs: list) -> tuple:
    """Postings by term, by falling tf within the term, by document within the tf."""
    terms, tfs = [np.concatenate(t) for t in terms], [np.concatenate(t) for t in tfs]
    size = np.array([len(t) for t in terms])
    doc = np.repeat(np.arange(len(docs), dtype=np.uint32), size)
    term, tf = np.concatenate(terms), np.concatenate(tfs)
    order = np.lexsort((doc, -tf, term))
    doc, term, tf = doc[order], term[order], tf[order]
    fresh = np.ones(len(term), dtype=bool)
    fresh[1:] = term[1:] != term[:-1]
    first = np.flatnonzero(fresh)
    fresh[1:] |= tf[1:] != tf[:-1]
    run = np.flatnonzero(fresh)
    df = np.diff(np.append(first, len(term)))
    arrays = (term[first], df.astype(np.uint32), tf[first].astype(np.uint32), tf[run].astype(np.uint32), np.diff(np.append(run, len(term))).astype(np.uint32), doc, np.array(docs, dtype=np.int64))
    return block, m, *(a.tobytes() for a in arrays)


def build_index(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_postings: int = 1 << 14, in_a_row: int = 1 << 11) -> Index:
    """Every document with a term is in one block, whose documents have the same m.

    A block has so many postings as keep its columns well under half a megabyte: the JVM holds larger ones apart and frees
    them late.
    """
    texts = documents.select(F.col(text_col).alias("text"))
    docs, terms = _totals(texts)
    named = documents.select(F.col(text_col).alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(int(_NULL))).alias("id"))

    def forward(batches):
        """A document's terms, so many in a row: long documents are many rows, so ranges are even in bytes."""
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            ids = b.column(1).to_numpy()
            for lo, hi, data, offsets in slices(b.column(0)):
                hashes, first = term_hashes(data, offsets)
                m, rows = normaliser(np.diff(first), docs, terms), []
                for i, (t, c) in enumerate(counted(hashes, first)):
                    row += 1
                    rows += [(int(m[i]), row, int(ids[lo + i]), t[at : at + in_a_row].tobytes(), c[at : at + in_a_row].astype(np.uint32).tobytes()) for at in range(0, len(t), in_a_row)]
                if rows:
                    yield _batch(rows, _FORWARD)

    # all rows of a document have one key, which no range divides
    dealt = named.mapInArrow(forward, _FORWARD).repartitionByRange("m", "row").sortWithinPartitions("m", "row")

    def blocks(batches):
        made, m, held, n, before = TaskContext.get().partitionId() << 32, None, ([], [], []), 0, None
        rows = []
        for b in batches:
            for row_m, row, id_, terms_, tfs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held[0] and row != before and (row_m != m or n >= most_postings):
                    rows.append(_block(made, m, *held))
                    made, held, n = made + 1, ([], [], []), 0
                    if len(rows) >= 16:
                        yield _batch(rows, _INDEX)
                        rows = []
                if row != before:
                    for h in held:
                        h.append([])
                    held[0][-1] = id_
                m, before = row_m, row
                held[1][-1].append(np.frombuffer(terms_, dtype=np.uint64))
                held[2][-1].append(np.frombuffer(tfs, dtype=np.uint32).astype(np.int64))
                n += len(held[1][-1][-1])
        if held[0]:
            rows.append(_block(made, m, *held))
        if rows:
            yield _batch(rows, _INDEX)

    with arrow_rows(documents.sparkSession, 256):
        return Index(stored(dealt.mapInArrow(blocks, _INDEX), "lexical-index", **{"parquet.block.size": str(8 << 20)}), docs, terms)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], names=[f for f, _ in fields])


class Queries:
    """A chunk of queries: their distinct terms with weights, and each query's terms with counts, one after the other."""

    def __init__(self, rows: list[tuple]):
        self.ids = [r[0] for r in rows]
        terms, counts = [np.frombuffer(r[1], dtype=np.uint64) for r in rows], [np.frombuffer(r[2], dtype=np.int64) for r in rows]
        self.terms, self.of = np.unique(np.concatenate(terms), return_inverse=True)
        self.times = np.concatenate(counts)
        self.first = np.cumsum([0] + [len(t) for t in terms])
        self.query = np.repeat(np.arange(len(rows)), np.diff(self.first))
        self.weight = np.zeros(len(self.terms), dtype=np.int64)
        self.floor = np.zeros(len(rows), dtype=np.int64)

    def found(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the queries' terms the dictionary has, and where."""
        at = np.minimum(np.searchsorted(terms, self.terms), len(terms) - 1)
        has = np.flatnonzero(terms[at] == self.terms)
        return has, at[has]

    def bounds(self, m: int, terms: np.ndarray, top: np.ndarray) -> np.ndarray:
        """What no document of the block can exceed, for each query."""
        best = np.zeros(len(self.terms), dtype=np.int64)
        has, at = self.found(terms)
        best[has] = self.weight[has] * impact(top[at], m)
        return np.add.reduceat(best[self.of] * self.times, self.first[:-1])


def _runs(upto: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of items of about `most` in all, from running sums of their sizes."""
    lo = 0
    while lo < len(upto):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


def _best(scores: np.ndarray, docs: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores; of equal ones those of the smallest ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((docs[at], -scores[at]))[:k]]


class _Visit:
    """The best documents of each query over the blocks that a task has seen."""

    def __init__(self, queries: Queries, k: int):
        self.q, self.k, self.floor = queries, k, queries.floor.copy()
        self.scores, self.docs = [np.zeros(0, np.int64) for _ in queries.ids], [np.zeros(0, np.int64) for _ in queries.ids]

    def block(self, m: int, raw: dict[str, bytes]) -> None:
        q = self.q
        terms, top = np.frombuffer(raw["terms"], dtype=np.uint64), np.frombuffer(raw["top"], dtype=np.uint32).astype(np.int64)
        bound = q.bounds(m, terms, top)
        asks = np.flatnonzero((bound > 0) & (bound >= self.floor))
        if not len(asks):
            return
        docs = np.frombuffer(raw["docs"], dtype=np.int64)
        df = np.frombuffer(raw["df"], dtype=np.uint32).astype(np.int64)
        size, posts = np.frombuffer(raw["size"], dtype=np.uint32), np.frombuffer(raw["posts"], dtype=np.uint32)
        impacts = np.repeat(impact(np.frombuffer(raw["tf"], dtype=np.uint32).astype(np.int64), m), size)  # one for each tf of a term
        begin = np.cumsum(df) - df
        where = np.full(len(q.terms), -1, dtype=np.int64)
        has, at = q.found(terms)
        where[has] = at
        slot = np.full(len(q.ids), -1, dtype=np.int64)
        # so many queries at a time that their postings, and a score for each of the documents, are a bounded number
        met = np.where(where[q.of] >= 0, df[np.maximum(where[q.of], 0)], 0)
        work = np.cumsum(np.add.reduceat(met, q.first[:-1])[asks] + len(docs))
        for lo, hi in _runs(work, 1 << 19):
            some = asks[lo:hi]
            slot[:] = -1
            slot[some] = np.arange(len(some))
            pair = np.flatnonzero((slot[q.query] >= 0) & (where[q.of] >= 0))
            term, worth = where[q.of[pair]], q.times[pair] * q.weight[q.of[pair]]
            n = df[term]
            ends = np.cumsum(n)
            post = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n - begin[term], n)
            cell = np.repeat(slot[q.query[pair]] * len(docs), n) + posts[post]
            gain = np.repeat(worth, n) * impacts[post]
            if int(bound[some].max()) < 1 << 53:
                total = np.bincount(cell, gain, len(some) * len(docs)).astype(np.int64)
            else:
                total = np.zeros(len(some) * len(docs), dtype=np.int64)
                np.add.at(total, cell, gain)
            for i, row in zip(some, total.reshape(len(some), len(docs)), strict=True):
                self._keep(int(i), row, docs)

    def _keep(self, i: int, row: np.ndarray, docs: np.ndarray) -> None:
        at = np.flatnonzero(row >= max(1, self.floor[i]))
        if len(at):
            at = at[_best(row[at], docs[at], self.k)]
            scores, ids = np.append(self.scores[i], row[at]), np.append(self.docs[i], docs[at])
            best = _best(scores, ids, self.k)
            self.scores[i], self.docs[i] = scores[best], ids[best]
            if len(best) == self.k:
                self.floor[i] = max(self.floor[i], self.scores[i][-1])

    def rows(self) -> list[tuple]:
        return [(i, int(d), int(s)) for i in range(len(self.q.ids)) for d, s in zip(self.docs[i], self.scores[i], strict=True)]


def _visited(blocks: DataFrame, queries: Queries, k: int) -> DataFrame:
    """(query, doc, score): the best of every task."""
    held = blocks.sparkSession.sparkContext.broadcast(queries)

    def visit(batches):
        seen = _Visit(held.value, k)
        for b in batches:
            names = b.schema.names
            # within what has arrived together, the block with the highest bound for any query goes first
            order = []
            for i in range(len(b)):
                raw = {n: b.column(j)[i].as_py() for j, n in enumerate(names) if n in ("m", "terms", "top")}
                order.append((-int(held.value.bounds(raw["m"], np.frombuffer(raw["terms"], np.uint64), np.frombuffer(raw["top"], np.uint32).astype(np.int64)).max()), i))
            for _, i in sorted(order):
                raw = {n: b.column(j)[i].as_py() for j, n in enumerate(names)}
                seen.block(raw["m"], raw)
        rows = seen.rows()
        if rows:
            yield _batch(rows, "query long, doc long, score long")

    return blocks.mapInArrow(visit, "query long, doc long, score long")


def _weigh(index: Index, queries: Queries) -> None:
    held = index.blocks.sparkSession.sparkContext.broadcast(queries)

    def frequencies(batches):
        df = np.zeros(len(held.value.terms), dtype=np.int64)
        for b in batches:
            for terms, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                has, at = held.value.found(np.frombuffer(terms, dtype=np.uint64))
                df[has] += np.frombuffer(n, dtype=np.uint32)[at]
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])

    df = np.zeros(len(queries.terms), dtype=np.int64)
    for r in index.blocks.select("terms", "df").mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    queries.weight = np.array([math.floor(1000 * math.log((2 * index.docs + 2) / (2 * int(n) + 1))) if n else 0 for n in df], dtype=np.int64)


def _promising(index: Index, queries: Queries, per_query: int = 3) -> list[int]:
    """The blocks with the highest bounds of each query."""
    held = index.blocks.sparkSession.sparkContext.broadcast(queries)

    def bounds(batches):
        best: list[list[tuple]] = [[] for _ in held.value.ids]
        for b in batches:
            for block, m, terms, top in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for i, x in enumerate(held.value.bounds(m, np.frombuffer(terms, dtype=np.uint64), np.frombuffer(top, dtype=np.uint32).astype(np.int64))):
                    if x and (len(best[i]) < per_query or x > best[i][-1][0]):
                        best[i] = sorted([*best[i], (int(x), block)], reverse=True)[:per_query]
        rows = [(i, x, block) for i, some in enumerate(best) for x, block in some]
        if rows:
            yield _batch(rows, "query long, bound long, block long")

    found = index.blocks.select("block", "m", "terms", "top").mapInArrow(bounds, "query long, bound long, block long")
    nth = F.row_number().over(W.partitionBy("query").orderBy(F.desc("bound"), "block"))
    return [r["block"] for r in found.withColumn("nth", nth).where(F.col("nth") <= per_query).select("block").distinct().collect()]


def _chunks(items: DataFrame, id_col: str, text_col: str, most_terms: int) -> Iterator[Queries]:
    def terms(batches):
        for b in batches:
            rows = []
            ids = b.column(0).to_pylist()
            for lo, hi, data, offsets in slices(b.column(1)):
                for i, (t, c) in zip(ids[lo:hi], counted(*term_hashes(data, offsets)), strict=True):
                    if len(t):
                        rows.append((i, t.tobytes(), c.astype(np.int64).tobytes()))
            if rows:
                yield _batch(rows, "item long, terms binary, times binary")

    held, n = [], 0
    for r in items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")).mapInArrow(terms, "item long, terms binary, times binary").toLocalIterator():
        if held and n + len(r["terms"]) // 8 > most_terms:
            yield Queries(held)
            held, n = [], 0
        held.append((r["item"], r["terms"], r["times"]))
        n += len(r["terms"]) // 8
    if held:
        yield Queries(held)


def search(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = 20, most_terms: int = 1 << 18) -> DataFrame:
    """(item, rank, doc, score): each item's k highest-scoring documents with a score above 0, equal scores by rising id.

    An item without terms, or whose terms no document has, has no rows; rows that repeat an item are items of their own.
    A document without an id comes after others of its score.
    """
    spark = items.sparkSession
    found = []
    for queries in _chunks(items, id_col, text_col, most_terms):
        with arrow_rows(spark, 16):
            _weigh(index, queries)
            first = index.blocks.where(F.col("block").isin(_promising(index, queries)))
            floor = dict(_ranked(_visited(first, queries, k), k).where(F.col("rank") == k).select("query", "score").collect())
            queries.floor = np.array([floor.get(i, 0) for i in range(len(queries.ids))], dtype=np.int64)
            names = spark.createDataFrame(list(enumerate(queries.ids)), "q long, item long")
            best = _ranked(_visited(index.blocks, queries, k), k).join(F.broadcast(names), F.col("query") == F.col("q"))
            doc = F.when(F.col("doc") != int(_NULL), F.col("doc")).alias("doc")
            found.append(stored(best.select("item", F.col("rank").cast("int").alias("rank"), doc, "score"), "lexical-found").stored_at)
    return spark.read.schema("item long, rank int, doc long, score long").parquet(*found) if found else spark.createDataFrame([], "item long, rank int, doc long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "doc"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def ranked_search(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 20) -> DataFrame:
    """(item, rank, doc, score) of all items over all documents.

    A null text has no terms and is no document; ids may repeat or be null, repeated rows are documents of their own;
    texts may have any length; empty tables give no rows; other columns are ignored.
    """
    index = build_index(documents, id_col, text_col)
    found = search(index, items, k=k)
    release(index.blocks)
    return found

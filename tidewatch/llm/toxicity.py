"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are all words of a bounded labelled sample (character pairs where a script has no spaces); their document
frequencies come from all documents. The labelled examples lie in an inverted index: the commonest terms as a matrix,
the others as postings cut into blocks of rows with each block's greatest weight. Queries are scored in batches; only
blocks whose bound reaches a query's k-th neighbour so far are read, so the neighbours are exact. Votes weighted by
similarity are calibrated on the examples themselves, each scored without its own vote. Words and word beginnings that
tell the labels apart give a second vote by a cosine over them alone; texts without any have the first vote only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, fold, stored
from .fitting import isotonic

_WORDS = re.compile(r"\w+")
#: Scripts written without spaces: Thai to Tibetan, Burmese, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")


def terms(text: str | None) -> Counter:
    """Counts of all words; runs of a script without spaces count as their pairs of characters."""
    low = (text or "").lower()
    if low.isascii() or not _UNSPACED.search(low):
        return Counter(_WORDS.findall(low))
    runs = _UNSPACED.findall(low)
    out = Counter(_WORDS.findall(_UNSPACED.sub(" ", low)))
    out.update(r[i : i + 2] for r in runs for i in range(max(1, len(r) - 1)))
    return out


def beginnings(word: str) -> list[str]:
    """A word of four letters or more, and its first 4, 5 and 6 letters (marked with a star)."""
    return [word, *(word[:k] + "*" for k in (4, 5, 6) if len(word) >= k)]


def telling_terms(counts: Counter) -> set[str]:
    """The beginnings of words of letters."""
    return {t for w in counts if len(w) >= 4 and w.isalpha() for t in beginnings(w)}


def _spread(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ... of size[0] entries, then the same of the next."""
    return np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())


class BlockMaxIndex:
    """L2-normalised sparse rows of weights above 0 by term: a matrix of the `dense` commonest terms, and postings of the
    others in blocks of rows, with the greatest weight of each."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = 64, dense: int = 512):
        self.size, self.block = len(rows), block
        self.n_blocks = max(1, -(-len(rows) // block))
        n = np.array([len(t) for t, _ in rows], dtype=np.int64)
        term = np.concatenate([np.zeros(0, dtype=np.int64), *(t for t, _ in rows)])
        weight = np.concatenate([np.zeros(0), *(w for _, w in rows)])
        row = np.repeat(np.arange(len(rows)), n)
        often = np.argsort(-np.bincount(term, minlength=n_terms), kind="stable")[:dense]
        self.place = np.full(n_terms, -1, dtype=np.int32)
        self.place[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), len(rows)))
        common = self.place[term] >= 0
        self.matrix[self.place[term[common]], row[common]] = weight[common]
        term, weight, row = term[~common], weight[~common], row[~common]
        order = np.lexsort((row, term))
        term, self.weight, self.row = term[order], weight[order], row[order].astype(np.int32)
        new = np.ones(len(term), dtype=bool)
        new[1:] = (term[1:] != term[:-1]) | (self.row[1:] // block != self.row[:-1] // block)
        first = np.flatnonzero(new)
        self.at = np.append(first, len(term)).astype(np.int32)
        self.block_of = (self.row[first] // block).astype(np.int32)
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.start = np.searchsorted(term[first], np.arange(n_terms + 1)).astype(np.int32)

    def nearest_all(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, leave: np.ndarray | None = None) -> list[list[tuple[float, int]]]:
        """For each query (terms, weights), the k rows of greatest positive dot product, of equal ones the first; query i
        passes over row leave[i].

        The matrix gives every row a lower bound of its product, and with the blocks' greatest weights an upper one.
        """
        if not self.size or not queries:
            return [[] for _ in queries]
        n, step = len(queries), np.arange(self.n_blocks) * self.block
        term = np.concatenate([t for t, _ in queries]).astype(np.int64)
        weight = np.concatenate([w for _, w in queries])
        query = np.repeat(np.arange(n), [len(t) for t, _ in queries])
        place = self.place[term]
        common = place >= 0
        dense = np.zeros((n, len(self.matrix)))
        dense[query[common], place[common]] = weight[common]
        dots = dense @ self.matrix
        if leave is not None:
            dots[np.arange(n), leave] = -np.inf
        least = self._kth(dots, k)
        term, weight, query = term[~common], weight[~common], query[~common]
        size = self.start[term + 1] - self.start[term]
        part, query, weight = _spread(self.start[term], size), np.repeat(query, size), np.repeat(weight, size)
        cell = query * self.n_blocks + self.block_of[part]
        bound = np.maximum.reduceat(dots, step, axis=1).ravel() + np.bincount(cell, weight * self.most[part], minlength=n * self.n_blocks)
        reach = bound[cell] >= least[query] - 1e-9
        part, query, weight = part[reach], query[reach], weight[reach]
        size = self.at[part + 1] - self.at[part]
        at = _spread(self.at[part], size)
        dots += np.bincount(np.repeat(query * self.size, size) + self.row[at], self.weight[at] * np.repeat(weight, size), minlength=dots.size).reshape(dots.shape)
        least = np.maximum(self._kth(dots, k), 1e-12)
        out = []
        for x, low in zip(dots, least, strict=True):
            best = np.flatnonzero(x >= low - 1e-11)
            s = np.round(x[best], 12)
            order = np.argsort(-s, kind="stable")[:k]
            out.append([(float(s[i]), int(best[i])) for i in order if s[i] >= 1e-12])
        return out

    def _kth(self, dots: np.ndarray, k: int) -> np.ndarray:
        return np.partition(dots, -k, axis=1)[:, -k] if self.size >= k else np.zeros(len(dots))


@dataclass
class View:
    """Examples as vectors of the terms first, first + 1, ... of the vocabulary."""

    idf: np.ndarray
    first: int
    index: BlockMaxIndex

    @staticmethod
    def of(rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray, first: int, last: int) -> View:
        view = View(idf[first:last], first, None)
        return View(view.idf, first, BlockMaxIndex([view.scaled(r) for r in rows], last - first))

    def scaled(self, row: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        t, n = row
        mine = (t >= self.first) & (t < self.first + len(self.idf))
        t = t[mine] - self.first
        w = (1 + np.log(n[mine])) * self.idf[t]
        return t, w / np.sqrt(w @ w) if len(w) else w


@dataclass
class ToxicityModel:
    words: View
    telling: View
    ids: list[int]
    toxic: np.ndarray
    class_weight: tuple[float, float]
    k: int
    knots: dict[bool, tuple[np.ndarray, np.ndarray]]
    silent: float = 0.0

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Share of toxic neighbours by similarity and class weight; neighbours of little similarity count little."""
        mass = [0.0, 0.0]
        for s, r in near:
            y = int(self.toxic[r])
            mass[y] += s * self.class_weight[y]
        return mass[1] / (mass[0] + mass[1]) if near else 0.0

    def votes(self, rows: list[tuple[np.ndarray, np.ndarray]], leave: np.ndarray | None = None, batch: int = 32) -> Iterable[tuple[list[tuple[float, int]], float, bool]]:
        """Of rows (terms, counts): the neighbours by words, the mean vote, and whether telling terms took part."""
        for i in range(0, len(rows), batch):
            out = None if leave is None else leave[i : i + batch]
            near, told = (v.index.nearest_all([v.scaled(r) for r in rows[i : i + batch]], self.k, out) for v in (self.words, self.telling))
            for a, b in zip(near, told, strict=True):
                yield a, (self.vote(a) + self.vote(b)) / 2 if b else self.vote(a), bool(b)

    def score(self, near: list[tuple[float, int]], vote: float, told: bool) -> float:
        return float(np.interp(vote, *self.knots[told])) if near else self.silent


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column without nulls."""
    at = column.offsets.to_numpy()
    return np.split(column.values.to_numpy()[at[0] : at[-1]], at[1:-1] - at[0]) if len(column) else []


def _list_column(lists: list[list[int]]) -> pa.ListArray:
    size = np.array([len(x) for x in lists], dtype=np.int64)
    flat = np.fromiter((v for x in lists for v in x), dtype=np.int32, count=size.sum())
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(flat))


def _chosen(texts: list[tuple[int, str | None]], most: int, least_g: float, least_lift: float) -> list[str]:
    """Terms of toxic examples by the log-likelihood ratio of their presence against the label, at least `least_g`; their
    share of toxic examples must be `least_lift` times that of others, which leaves out terms of topics and languages."""
    n1, n0 = sum(y for y, _ in texts), sum(1 - y for y, _ in texts)
    if not n1 or not n0:
        return []
    has = (Counter(), Counter())
    for y, x in texts:
        has[y].update(telling_terms(terms(x)))

    def g(a: int, b: int) -> float:
        p = (a + b) / (n1 + n0)
        cells = ((a, p * n1), (n1 - a, (1 - p) * n1), (b, p * n0), (n0 - b, (1 - p) * n0))
        return 2 * sum(o * np.log(o / e) for o, e in cells if o > 0)

    found = [(t, a, has[0][t]) for t, a in has[1].items() if a + has[0][t] >= 4 and a * n0 >= has[0][t] * least_lift * n1]
    ranked = sorted((-g(a, b), t) for t, a, b in found)
    return [t for x, t in ranked if -x >= least_g][:most]


def _known(text: str | None, words: dict[str, int], telling: dict[str, int], heads: set[str]) -> dict[int, int]:
    """Counts of a text's words and telling terms by number."""
    counts = terms(text)
    out = {i: n for w, n in counts.items() if (i := words.get(w)) is not None}
    for w, n in counts.items():
        if w[:4] in heads and w.isalpha():
            for t in beginnings(w):
                if (i := telling.get(t)) is not None:
                    out[i] = out.get(i, 0) + n
    return out


def _vectors(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """(id, terms, counts) of the vocabulary's terms; one pass over whole texts."""

    def of(batches):
        for b in batches:
            rows = [_known(x, *vocabulary.value) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), _list_column([list(r) for r in rows]), _list_column([list(r.values()) for r in rows])], names=["id", "terms", "counts"])

    return docs.mapInArrow(of, "id long, terms array<int>, counts array<int>")


def _frequencies(vectors: DataFrame, n_terms: int) -> tuple[int, np.ndarray]:
    """The number of documents, and of those with each term; a task sends one row for each term it met."""

    def of(batches):
        n, df = 0, np.zeros(n_terms + 1, dtype=np.int64)
        for b in batches:
            n += b.num_rows
            for x in _lists(b.column(0)):
                df[x] += 1
        df[n_terms] = n
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(df[met])], names=["t", "n"])

    sums = vectors.select("terms").mapInArrow(of, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(n_terms + 1, dtype=np.int64)
    df[sums.column("t").to_numpy()] = sums.column("n").to_numpy()
    return int(df[n_terms]), df[:n_terms]


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    held_out_mod: int = 5,
    held_out: int = 0,
    examples: int = 3000,
    most_terms: int = 1024,
    k: int = 15,
    least_g: float = 28.0,
    least_lift: float = 4.0,
) -> DataFrame:
    """One row per document: id, held_out, score, predicted, evidence (the k neighbours' id, similarity, label).

    Labels are learned only from documents outside the held-out fold of crc32(id), and from at most `examples` of each
    class, the first in hash order; that bound is all that is sampled. Neighbours are by all words; `most_terms`,
    `least_g` and `least_lift` choose the terms of the second vote. Texts that share no term with an example, empty and null ones included, have no neighbour and
    get the share of toxic ones among such examples. Labels without a document or a value are passed over; without both
    classes every score is the share of toxic labels. Repeated rows are scored each time; an empty table gives no rows.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and id is not null")
    known = known.groupBy("id").agg(F.max("y").alias("y")).where(fold("id", held_out_mod) != held_out)
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    picked = bounded_sample(known, "y", "id", examples, "toxicity")
    sample = d.join(F.broadcast(picked), "id").groupBy("id").agg(F.first("y").alias("y"), F.min("text").alias("text"))
    rows = [(r["id"], r["y"], r["text"]) for r in sample.collect()]
    words = {t: i for i, t in enumerate(sorted({t for _, _, x in rows for t in terms(x)}))}
    telling = {t: len(words) + i for i, t in enumerate(_chosen([(y, x) for _, y, x in rows], most_terms, least_g, least_lift))}
    known_to = (words, telling, {t[:4] for t in telling})
    vectors = stored(_vectors(d, spark.sparkContext.broadcast(known_to)), "toxicity-vectors")
    n, df = _frequencies(vectors, len(words) + len(telling))
    idf = np.log((1 + n) / (1 + df)) + 1
    found = []
    for i, y, x in rows:
        c = _known(x, *known_to)
        found.append((i, y, np.fromiter(c, dtype=np.int64, count=len(c)), np.fromiter(c.values(), dtype=np.int64, count=len(c))))
    del rows
    # examples alike lie side by side, so that blocks have low bounds
    found.sort(key=lambda r: (int(r[2][np.lexsort((r[2], df[r[2]]))[-1]]) if len(r[2]) else -1, r[1], r[0]))
    got = Counter(y for _, y, *_ in found)
    weight = tuple(counts.get(c, 0) / max(1, got[c]) for c in (0, 1))
    vecs = [(t, n) for _, _, t, n in found]
    views = (View.of(vecs, idf, 0, len(words)), View.of(vecs, idf, len(words), len(idf)))
    model = ToxicityModel(*views, [r[0] for r in found], np.array([r[1] for r in found]), weight, k, {}, share)
    _calibrate(model, vecs)
    held = spark.sparkContext.broadcast(model)

    def scored(batches):
        m = held.value
        for b in batches:
            out = list(m.votes(list(zip(_lists(b.column(1)), _lists(b.column(2)), strict=True))))
            near = [[{"id": m.ids[r], "similarity": s, "label": int(m.toxic[r])} for s, r in x] for x, _, _ in out]
            kind = pa.list_(pa.struct([("id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.score(*x) for x in out], pa.float64()), pa.array(near, kind)], names=["id", "score", "evidence"])

    out = vectors.mapInArrow(scored, "id long, score double, evidence array<struct<id:long,similarity:double,label:int>>")
    return out.select("id", (fold("id", held_out_mod) == held_out).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "evidence")


def _calibrate(m: ToxicityModel, rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
    found = list(m.votes(rows, leave=np.arange(len(rows))))
    weight = np.array([m.class_weight[y] for y in m.toxic])
    silent = np.array([not near for near, _, _ in found], dtype=bool)
    if silent.any() and weight[silent].sum():
        m.silent = float(weight[silent] @ m.toxic[silent] / weight[silent].sum())
    for told in (False, True):
        these = ~silent & np.array([x == told for _, _, x in found], dtype=bool)
        v = np.array([x for _, x, _ in found])
        m.knots[told] = isotonic(v[these], m.toxic[these].astype(float), weight[these]) if these.any() else (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

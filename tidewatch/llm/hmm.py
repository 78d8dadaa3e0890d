"""A hidden Markov language model, trained by Baum-Welch over all training documents.

The commonest words are symbols of their own; all others share symbols by how they begin, and within such a symbol a
word has its smoothed share of the counts. The latent states start from clusters of symbols with like neighbours. Every
iteration is one Spark job: tasks run the scaled forward and backward recursions over their documents and hand on
expected counts, which are summed across partitions, until the likelihood hardly gains. A document's score is its exact
likelihood under the forward recursion.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, stored
from .wordhash import mix, slices, words

#: The hash that stands for the end of a text; words are hashed to other values but for one chance in 2**64.
END = int(mix(np.array([0xE0D], dtype=np.uint64))[0].astype(np.int64))
#: Symbols 0 to GROUPS - 1 are those of words without one of their own, by their first two bytes.
GROUPS = 128


def group(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group of each word; A-Z count as a-z."""
    lower = lambda x: x + np.uint8(32) * ((x >= 65) & (x <= 90))
    one = lower(data[starts]).astype(np.uint64)
    two = np.where(ends - starts > 1, lower(data[np.minimum(starts + 1, len(data) - 1)]), 0).astype(np.uint64)
    return (mix(one << np.uint64(8) | two) % np.uint64(GROUPS)).astype(np.int64)


def _word_counts(docs: DataFrame, flush: int = 1 << 22) -> DataFrame:
    """(w, g, c) over all words and ends of the texts, with the word's group; tasks add up what they have seen before the
    shuffle."""

    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = ends = 0

        def batch(hashes, groups, counts):
            return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(groups), pa.array(counts.astype(np.int64))], names=["w", "g", "c"])

        def added():
            w, at, n = np.unique(np.concatenate([x for x, _ in held]), return_index=True, return_counts=True)
            return batch(w, np.concatenate([x for _, x in held])[at], n)

        for b in batches:
            ends += len(b)
            for _, _, data, offsets in slices(b.column(0)):
                w, start, end, _ = words(data, offsets)
                if len(w):
                    held.append((w, group(data, start, end)))
                    size += len(w)
                if size >= flush:
                    yield added()
                    held, size = [], 0
        if size:
            yield added()
        if ends:
            yield batch(np.array([END]), np.array([-1]), np.array([ends]))

    return docs.select("text").mapInArrow(count, "w long, g long, c long").groupBy("w", "g").agg(F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """Counts of the commonest words, by sorted hash; the first `n_symbols` by rank have symbols GROUPS, GROUPS + 1, ...,
    all others the symbol of their group. Of the groups: tokens and distinct words without symbols of their own."""

    hashes: np.ndarray
    counts: np.ndarray
    symbol: np.ndarray
    n_symbols: int
    train_tokens: int
    distinct: int
    ends: int
    other_tokens: np.ndarray
    other_distinct: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame, head: int, symbols: int) -> Lexicon:
        by_group = {r["g"]: (r["c"], r["v"]) for r in counts.groupBy("g").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()}
        ends = by_group.pop(-1, (0, 0))[0]
        others = np.array([by_group.get(g, (0, 0)) for g in range(GROUPS)], dtype=np.int64)
        n, v = int(others[:, 0].sum() + ends), int(others[:, 1].sum() + (ends > 0))
        # the least count that at most `head` words reach, to a step of one percent: so no task sends more than it keeps
        step = F.floor(F.log(F.col("c").cast("double")) * 100).cast("long")
        steps = sorted(counts.where(F.col("w") != END).groupBy(step.alias("s")).count().collect(), reverse=True)
        least, size = None, 0
        for s, k in steps:
            size += k
            if size > head and least is not None:
                break
            least = s
        top = counts.where((F.col("w") != END) & (step >= (least or 0)))
        top = (top.orderBy(F.desc("c"), "w").limit(head) if steps and steps[0]["count"] > head else top).toPandas()
        top = top.sort_values(["c", "w"], ascending=[False, True], kind="stable")
        hashes, c, g = (top[x].to_numpy(dtype=np.int64) for x in ("w", "c", "g"))
        used, order = int(min(symbols, len(c))), np.argsort(hashes, kind="stable")
        np.subtract.at(others, (g[:used], 0), c[:used])
        np.subtract.at(others, (g[:used], 1), 1)
        symbol = np.where(np.arange(len(c)) < used, GROUPS + np.arange(len(c)), g)
        return cls(hashes[order], c[order], symbol[order].astype(np.uint16), used, n, v, int(ends), others[:, 0], others[:, 1])

    def frequencies(self) -> np.ndarray:
        """Tokens of each symbol, the end last."""
        out = np.zeros(self.end + 1)
        out[:GROUPS] = self.other_tokens
        own = self.symbol >= GROUPS
        out[self.symbol[own]] = self.counts[own]
        out[self.end] = self.ends
        return out

    @property
    def end(self) -> int:
        return GROUPS + self.n_symbols

    def find(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the lexicon and whether the word is there."""
        if not len(self.hashes):
            return np.zeros(len(w), dtype=int), np.zeros(len(w), dtype=bool)
        at = np.minimum(np.searchsorted(self.hashes, w), len(self.hashes) - 1)
        return at, self.hashes[at] == w


def _encoded(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Each row's symbols; sums of log10(c + 1) over its words in the lexicon, of all and of those that share a symbol;
    the latter's log10 of their group's mass, over all such words; and its words outside the lexicon with their counts."""
    held = docs.sparkSession.sparkContext.broadcast(lexicon)
    schema = "row long, id long, held_out boolean, symbols binary, n_tokens long, n_head long, head_log double, other_log double, other_base double, tail array<long>, tail_n array<int>"

    def of(batches):
        lex, row = held.value, TaskContext.get().partitionId() << 40
        logs = np.log10(lex.counts + 1.0)
        mass = np.log10(lex.other_tokens + lex.other_distinct + 1.0)
        for b in batches:
            ids, outs = b.column(0), b.column(1)
            for lo, hi, data, offsets in slices(b.column(2)):
                w, start, ends, first = words(data, offsets)
                w = w.view(np.int64)
                at, known = lex.find(w)
                symbol = group(data, start, ends).astype(np.uint16) if len(w) else np.zeros(0, dtype=np.uint16)
                log = np.zeros(len(w))
                symbol[known], log[known] = lex.symbol[at[known]], logs[at[known]]
                other = symbol < GROUPS
                base = np.where(other, mass[np.where(other, symbol, 0)], 0.0)
                sums = [np.concatenate([[0], np.cumsum(x)]) for x in (known, log, log * other, base)]
                sums = [x[first[1:]] - x[first[:-1]] for x in sums]
                cols: list[list] = [[] for _ in range(3)]
                for a, z in zip(first[:-1], first[1:], strict=True):
                    tail, times = np.unique(w[a:z][~known[a:z]], return_counts=True)
                    for c, x in zip(cols, (np.append(symbol[a:z], np.uint16(lex.end)).tobytes(), tail, times), strict=True):
                        c.append(x)
                rows = pa.array(np.arange(row, row + hi - lo))
                row += hi - lo
                out = [rows, ids.slice(lo, hi - lo), outs.slice(lo, hi - lo), pa.array(cols[0], pa.binary()), pa.array(np.diff(first) + 1), pa.array(sums[0].astype(np.int64)), *(pa.array(x.astype(float)) for x in sums[1:])]
                yield pa.RecordBatch.from_arrays([*out, pa.array(cols[1], pa.list_(pa.int64())), pa.array(cols[2], pa.list_(pa.int32()))], names=[x.split(" ")[0] for x in schema.split(", ")])

    return docs.select("id", "held_out", "text").mapInArrow(of, schema)


def _summed(rows: DataFrame, size: int, of) -> np.ndarray:
    """The sum over tasks of the vectors that `of` makes of a task's batches of documents; `size` entries at most reach the driver."""

    def count(batches):
        flat = of(_symbols(b.column(0)) for b in batches)
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some])], names=["i", "x"])

    sums = rows.select("symbols").mapInArrow(count, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas()
    out = np.zeros(size)
    out[sums["i"].to_numpy(dtype=int)] = sums["x"]
    return out


def neighbours(docs, n: int, contexts: int) -> np.ndarray:
    """How often each symbol has a neighbour of each context on its left and on its right; a context is one of the commonest
    symbols, or several others. `docs` gives lists of documents."""
    half = contexts // 2
    context = half + np.arange(n) % half
    context[GROUPS : GROUPS + half] = np.arange(len(context[GROUPS : GROUPS + half]))
    out = np.zeros(n * 2 * contexts)
    for some in docs:
        flat = np.concatenate([np.zeros(0, dtype=np.uint16), *some]).astype(np.int64)
        last = np.zeros(len(flat), dtype=bool)
        last[np.cumsum([len(x) for x in some], dtype=int) - 1] = True
        pair = ~last[:-1]
        a, b = flat[:-1][pair], flat[1:][pair]
        out += np.bincount(np.concatenate([a * 2 * contexts + context[b], (b * 2 + 1) * contexts + context[a]]), minlength=len(out))
    return out


def clusters(seen: np.ndarray, freq: np.ndarray, k: int, steps: int = 25) -> np.ndarray:
    """The cluster of each symbol: means over the leading directions of its neighbours' shares, each symbol weighing its
    frequency. Begins with the heaviest symbol and then whichever is farthest off by weight."""
    x = np.sqrt(seen / np.maximum(seen.sum(1, keepdims=True), 1))
    mean = np.average(x, axis=0, weights=freq)
    _, _, axes = np.linalg.svd((x - mean) * np.sqrt(freq)[:, None], full_matrices=False)
    x = (x - mean) @ axes[:k].T
    centers = x[[int(np.argmax(freq))]]
    far = ((x - centers[0]) ** 2).sum(1)
    while len(centers) < k:
        centers = np.vstack([centers, x[int(np.argmax(far * np.sqrt(freq)))]])
        far = np.minimum(far, ((x - centers[-1]) ** 2).sum(1))
    for _ in range(steps):
        of = np.argmin(((x[:, None, :] - centers[None]) ** 2).sum(2), axis=1)
        mass = np.bincount(of, freq, minlength=k)
        sums = np.column_stack([np.bincount(of, freq * c, minlength=k) for c in x.T])
        centers = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-12)[:, None], centers)
    return of


@dataclass
class Chain:
    """start[k], move[k, l], emit[symbol, k]."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def begin(cls, freq: np.ndarray, of: np.ndarray, states: int, own: float = 0.8) -> Chain:
        """Each state emits its own cluster's symbols with the share `own`, the others by frequency, and mostly stays."""
        share = freq / freq.sum()
        emit = np.empty((len(freq), states))
        for k in range(states):
            mine = share * (of == k)
            emit[:, k] = own * mine / mine.sum() + (1 - own) * share if mine.sum() > 0 else share
        move = np.full((states, states), 0.5 / states) + np.eye(states) * 0.5
        return cls(np.full(states, 1 / states), move, emit / emit.sum(0))


def batches_by_length(docs: list[np.ndarray], tokens: int = 1_500_000):
    """Positions of documents, longest first, in runs of about `tokens` symbols."""
    order, run, size = np.argsort([-len(d) for d in docs], kind="stable"), [], 0
    for i in order:
        run.append(int(i))
        size += len(docs[i])
        if size >= tokens:
            yield run
            run, size = [], 0
    if run:
        yield run


def _steps(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols step by step (all documents' first ones, then the second, ...; documents are longest first), and where each step begins."""
    lengths = np.array([len(d) for d in docs])
    alive = np.cumsum(np.bincount(lengths, minlength=lengths[0] + 1)[::-1])[::-1][1:]
    begin = np.concatenate([[0], np.cumsum(alive)])
    flat = np.empty(begin[-1], dtype=np.int64)
    for r, d in enumerate(docs):
        flat[begin[: len(d)] + r] = d
    return flat, begin


def forward(chain: Chain, docs: list[np.ndarray], keep: bool = False):
    """Natural log likelihood of each document (longest first); with `keep` also the scaled alphas and scales."""
    flat, begin = _steps(docs)
    emit, move = chain.emit, chain.move
    scale = np.empty(len(flat))
    alphas = np.empty((len(flat), emit.shape[1]), dtype=np.float32) if keep else None
    logs = np.zeros(len(docs))
    alpha = None
    for t in range(len(begin) - 1):
        lo, hi = begin[t], begin[t + 1]
        a = (chain.start if alpha is None else alpha[: hi - lo] @ move) * emit[flat[lo:hi]]
        c = a.sum(1)
        a /= c[:, None]
        scale[lo:hi] = c
        if keep:
            alphas[lo:hi] = a
        alpha = a
    np.log(scale, out=scale)
    for t in range(len(begin) - 1):
        logs[: begin[t + 1] - begin[t]] += scale[begin[t] : begin[t + 1]]
    return (logs, alphas, scale, flat, begin) if keep else logs


def expected_counts(chain: Chain, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions, and the log likelihood (documents longest first)."""
    logs, alphas, scale, flat, begin = forward(chain, docs, keep=True)
    states = chain.emit.shape[1]
    moves = np.zeros((states, states))
    later = np.zeros((0, states))  # emission times beta over scale, of the step after
    for t in range(len(begin) - 2, -1, -1):
        lo, hi = begin[t], begin[t + 1]
        beta = np.ones((hi - lo, states))
        if len(later):
            beta[: len(later)] = later @ chain.move.T
            moves += alphas[lo : lo + len(later)].T.astype(float) @ later
        later = chain.emit[flat[lo:hi]] * beta / np.exp(scale[lo:hi])[:, None]
        alphas[lo:hi] *= beta
    emits = np.column_stack([np.bincount(flat, alphas[:, k], minlength=len(chain.emit)) for k in range(states)])
    return alphas[: begin[1]].sum(0).astype(float), moves * chain.move, emits, float(logs.sum())


def _symbols(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=np.uint16) for x in column.to_pylist()]


def baum_welch(train: DataFrame, chain: Chain, iterations: int, tokens: int, least_gain: float = 0.0) -> Chain:
    """Each iteration sums expected counts over all rows of `train` (column symbols) and normalises them, until the natural
    log likelihood gains less than `least_gain` for each of the `tokens`."""
    states, n = chain.move.shape[0], len(chain.emit)
    prior, before = chain.emit.mean(1), -np.inf

    for _ in range(iterations):
        held = train.sparkSession.sparkContext.broadcast(chain)

        def count(batches, held=held):
            start, moves, emits, logs = np.zeros(states), np.zeros((states, states)), np.zeros((n, states)), 0.0
            for docs in batches:
                for run in batches_by_length(docs):
                    s, m, e, x = expected_counts(held.value, [docs[i] for i in run])
                    start, moves, emits, logs = start + s, moves + m, emits + e, logs + x
            return np.concatenate([start, moves.ravel(), emits.ravel(), [logs]])

        flat = _summed(train, states + states * states + n * states + 1, count)
        start, moves, emits = flat[:states] + 1e-3, flat[states : states + states**2].reshape(states, states) + 1e-3, flat[states + states**2 : -1].reshape(n, states)
        emits = emits + prior[:, None]
        chain = Chain(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
        if flat[-1] - before < least_gain * tokens:
            break
        before = flat[-1]
    return chain


def score_hmm(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out_mod: int = 7,
    held_out: int = 2,
    states: int = 8,
    symbols: int = 4096,
    head: int = 1 << 17,
    iterations: int = 5,
    least_gain: float = 0.002,
    contexts: int = 32,
) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    Null texts count as empty: their only token is the end. Repeated rows count and are scored each time; an empty table
    gives no rows. Without training documents every word is unknown and counts are 0. What is broadcast is bounded by
    `head` words and `states` times `symbols` parameters; rarer words meet their counts in a join. Training ends after
    `iterations`, or when one gains less than `least_gain` (natural logarithm) a token.
    """
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("held_out", fold("id", held_out_mod) == held_out)
    counts = stored(_word_counts(d.where(~F.col("held_out"))), "hmm-counts")
    lex = Lexicon.of(counts, head, symbols)
    rows = stored(_encoded(d, lex), "hmm-encoded")
    train, freq = rows.where(~F.col("held_out")), lex.frequencies() + 0.5
    seen = _summed(train, len(freq) * 2 * contexts, lambda docs: neighbours(docs, len(freq), contexts))
    of = clusters(seen.reshape(len(freq), -1), freq, states)
    chain = baum_welch(train, Chain.begin(freq, of, states), iterations, lex.train_tokens, least_gain)
    return _scores(rows, counts, lex, chain)


def _scores(rows: DataFrame, counts: DataFrame, lex: Lexicon, chain: Chain) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(chain)

    def likelihood(batches):
        for b in batches:
            docs = _symbols(b.column(1))
            out = np.zeros(len(docs))
            for run in batches_by_length(docs):
                out[run] = forward(held.value, [docs[i] for i in run])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out / np.log(10)), *b.columns[2:]], names=["row", "chain", *names])

    names = ["id", "held_out", "n_tokens", "n_head", "head_log", "other_log", "other_base"]
    scored = rows.select("row", "symbols", *names).mapInArrow(likelihood, "row long, chain double, id long, held_out boolean, n_tokens long, n_head long, head_log double, other_log double, other_base double")
    tail = rows.select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("t")).select("row", F.col("t.tail").alias("w"), F.col("t.tail_n").alias("n"))
    tail = tail.join(counts, "w").groupBy("row").agg(F.sum("n").alias("tail_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("tail_log"))
    end = float(np.log10(lex.ends + 1))
    ended = 1 if lex.ends else 0
    base = float(np.log10(lex.train_tokens + lex.distinct + 1))
    out = scored.join(tail, "row", "left").na.fill(0, ["tail_known"]).na.fill(0.0, ["tail_log"])
    return out.select(
        "id", "held_out", "n_tokens",
        (F.col("n_head") + F.col("tail_known") + ended).alias("n_known"),
        F.lit(lex.train_tokens).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.col("tail_log") + end - F.col("n_tokens") * base).alias("base_score"),
        (F.col("chain") + F.col("other_log") + F.col("tail_log") - F.col("other_base")).alias("score"),
    )

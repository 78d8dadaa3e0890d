"""N-gram Jaccard join with prefix trees.

Every text is its set of word shingles in one global order: rare ones first, as a fixed-size table of counts over all
texts tells, ties by hash. Equal sets are one class, of which one text goes on. Two sets can only be similar if they
share a shingle among their first ones (the prefix), so texts that share such a shingle are brought together. In a group
the sets lie in a trie; a probe walks it with the overlap so far, shared by all sets below a node, and leaves a subtree
when the lengths that remain can't make up for what is missing. Links found are joined into components.

Texts are grouped by how many prefix shingles they share with the first text that has the shingle, which a similar pair
of like size must; a group is joined by its trie at once, too large a group in chunks that have some members in common.
Pairs of texts in different groups, or that no chunk has seen, are told by the first shingle they share. All pairs, before
any set is fetched, must also pass a sketch: the parity of the set's shingles by low hash bits, whose differing bits are
never more than the shingles that only one set has. The sketch and the table of counts save work; neither loses a link.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FixedFilter, release, stored
from .wordhash import shingles, slices, words

#: Cells of the table of counts, and of one of its parts as tasks hand it on.
CELLS, _PART = 1 << 24, 1 << 18
#: Steps of a count's logarithm in the table: 256 of them reach beyond 5 * 10 ** 9.
_STEPS = 11.4


def least_overlap(n: int, m: int, percent: int) -> int:
    """Shared shingles that sets of n and m need: 100 i >= percent (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(40)).astype(np.int32)


def _signature(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def sketch(s: np.ndarray) -> bytes:
    """Parity of the set's members by their low bits, about two bits for each member (64 to 32,768)."""
    bits = min(1 << 15, max(64, 1 << (2 * len(s) - 1).bit_length())) if len(s) else 64
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def may_link(n: int, a: bytes, m: int, b: bytes, percent: int) -> bool:
    """Whether sets of n and m members with these sketches may be similar: a shorter sketch is a longer one folded."""
    if n * percent > m * 100 or m * percent > n * 100:
        return False
    x, y = (np.frombuffer(v, dtype=np.uint64) for v in (a, b))
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum()) <= n + m - 2 * least_overlap(n, m, percent)


class _Cells:
    """Counts by cell, which stop at 255 within a task."""

    def __init__(self) -> None:
        self.counts, self.held, self.size = np.zeros(CELLS, dtype=np.uint8), [], 0

    def add(self, cells: np.ndarray) -> None:
        self.held.append(cells)
        self.size += len(cells)
        if self.size > 1 << 21:
            self.settle()

    def settle(self) -> None:
        if self.held:
            at, n = np.unique(np.concatenate(self.held), return_counts=True)
            self.counts[at] = np.minimum(self.counts[at] + n, 255)
            self.held, self.size = [], 0

    def parts(self) -> list[tuple[int, bytes]]:
        self.settle()
        z = zstandard.ZstdCompressor(level=1)
        cut = [self.counts[i : i + _PART] for i in range(0, CELLS, _PART)]
        return [(i, z.compress(x.tobytes())) for i, x in enumerate(cut) if x.any()]


def _read(docs: DataFrame, k: int) -> DataFrame:
    """Rows (id, n, sign, sketch) of all texts, and rows (part, cells) of each task's counts."""

    def of(batches):
        cells = _Cells()
        seen: set[bytes] = set()
        for b in batches:
            for lo, hi, data, offsets in slices(b.column(1)):
                h, _, _, first = words(data, offsets)
                sets = list(shingles(h, first, k))
                signs = [_signature(s) for s in sets]
                for s, g in zip(sets, signs, strict=True):
                    if g not in seen:
                        cells.add(_cell(s))
                        if len(seen) < 1 << 18:
                            seen.add(g)
                cols = [pa.array([len(s) for s in sets], pa.int64()), pa.array(signs, pa.binary()), pa.array([sketch(s) for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *cols, pa.nulls(hi - lo, pa.int32()), pa.nulls(hi - lo, pa.binary())], names=names)
        for i, x in cells.parts():
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array([i], pa.int32()), pa.array([x], pa.binary())], names=names)

    names = ["id", "n", "sign", "sketch", "part", "cells"]
    return docs.mapInArrow(of, "id long, n long, sign binary, sketch binary, part int, cells binary")


def _counts(read: DataFrame) -> np.ndarray:
    """The logarithm of each cell's count over all texts, in 256 steps; its size does not depend on the data."""

    def add(p: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(_PART, dtype=np.uint32)
        for raw, x in zip(p["raw"], p["cells"], strict=True):
            x = zstandard.ZstdDecompressor().decompress(x)
            total += np.frombuffer(x, dtype=np.uint32 if raw else np.uint8)
        return pd.DataFrame({"part": p["part"].iloc[:1], "raw": [True], "cells": [zstandard.ZstdCompressor(level=1).compress(total.tobytes())]})

    # summed in two steps, so that no task gets all tasks' counts of a part
    schema = "part int, raw boolean, cells binary"
    some = read.where("part is not null").select("part", F.lit(False).alias("raw"), "cells", F.pmod(F.xxhash64("cells"), F.lit(8)).alias("step"))
    some = some.groupBy("part", "step").applyInPandas(lambda p: add(p[["part", "raw", "cells"]]), schema)
    out = np.zeros(CELLS, dtype=np.uint8)
    for r in some.groupBy("part").applyInPandas(add, schema).collect():
        total = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["cells"]), dtype=np.uint32)
        out[r["part"] * _PART : (r["part"] + 1) * _PART] = np.log1p(total) * _STEPS
    return out


def _ordered(s: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The set in the global order."""
    return s[np.argsort(counts[_cell(s)], kind="stable")]


def _salts(counts: np.ndarray, hot: int) -> np.ndarray:
    """For each of the table's 256 steps, into how many parts a token's postings are dealt: one, unless its count is far
    above what chance puts into a cell and over `hot`."""
    n = np.expm1(np.arange(256) / _STEPS)
    mean = float(n @ np.bincount(counts, minlength=256)) / len(counts)
    return np.maximum(1, np.ceil((n - 4 * mean) / hot)).astype(np.int64)


def _postings(docs: DataFrame, of_class: DataFrame, k: int, percent: int, counts: np.ndarray, hot: int) -> DataFrame:
    """(token, salt, id, n, pos) of the prefixes of the texts that stand for their class (id = rep), pos counted from 0 in
    the global order; salt is 0 unless the token is hot.

    Texts that a fixed-size filter of the others can't be sure of are told by a join; only these are shuffled.
    """
    sc, bits = docs.sparkSession.sparkContext, 1 << 26
    held, parts = sc.broadcast(counts), _salts(counts, hot)
    others = sc.broadcast(FixedFilter.of(of_class.where("id <> rep").select("id"), "id", bits))

    def unsure(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(others.value.test(a.to_numpy(), b.to_numpy()))

    def sure(batches):
        # in one process with what follows
        for b in batches:
            yield b.filter(pa.array(~others.value.test(b.column(2).to_numpy(), b.column(3).to_numpy())))

    def of(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for lo, _, data, offsets in slices(b.column(1)):
                h, _, _, first = words(data, offsets)
                tokens, size, spread = [], [], []
                for s in shingles(h, first, k):
                    tokens.append(_ordered(s, held.value)[: prefix_length(len(s), percent)])
                    size.append(len(s))
                p = np.array([len(t) for t in tokens], dtype=np.int64)
                if not p.sum():
                    continue
                flat, who = np.concatenate(tokens), np.repeat(ids[lo : lo + len(p)].astype(np.int64), p)
                spread = parts[held.value[_cell(flat)]]
                salt = np.where(spread > 1, who % spread + 1, 0)
                place = np.arange(p.sum()) - np.repeat(np.cumsum(p) - p, p)
                cols = (flat.view(np.int64), salt.astype(np.int32), who, np.repeat(np.array(size), p).astype(np.int32), place.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["token", "salt", "id", "n", "pos"])

    schema, spots = "token long, salt int, id long, n int, pos int", FixedFilter.spots("id", bits)
    d = docs.where("id is not null")
    stay = of_class.where("id = rep").select(F.col("id").alias("i")).distinct()
    told = d.where(F.pandas_udf(unsure, "boolean")(*spots)).join(stay, F.col("id") == F.col("i"), "left_semi")
    return d.select("id", "text", *spots).mapInArrow(lambda batches: of(sure(batches)), schema).unionByName(told.mapInArrow(of, schema))


def _shared(postings: DataFrame) -> DataFrame:
    """Postings of tokens that two texts or more have, with the token's smallest id (of its part, if it is salted): sorted
    by token, read in one pass."""

    def of(batches):
        rest = None
        for b in batches:
            p = np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)])
            p = p if rest is None else np.vstack([rest, p])
            if not len(p):
                continue
            cut = int(np.argmax((p[:, 0] == p[-1, 0]) & (p[:, 1] == p[-1, 1])))  # the last token may go on
            if cut == 0 and len(p) > 1 << 16:  # a long one: hand on all but its head
                yield from kept(p)
                rest = p[:1]
                continue
            yield from kept(p[:cut])
            rest = p[cut:]
        if rest is not None:
            yield from kept(rest)

    def kept(p):
        if len(p):
            new = np.concatenate([[True], (p[1:, 0] != p[:-1, 0]) | (p[1:, 1] != p[:-1, 1])])
            at = np.flatnonzero(new)
            size = np.diff(np.append(at, len(p)))
            many = np.repeat((size > 1) | (p[at, 1] > 0), size)
            head = np.repeat(at, size)[many]
            cols = [*(p[many, i].astype(t) for i, t in enumerate(kinds)), p[head, 2], p[head, 3].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["token", "salt", "id", "n", "pos", "center", "center_n"])

    kinds = (np.int64, np.int32, np.int64, np.int32, np.int32)
    dealt = postings.repartition("token", "salt").sortWithinPartitions("token", "salt", "id")
    return dealt.mapInArrow(of, "token long, salt int, id long, n int, pos int, center long, center_n int")


def _need(n: Column, m: Column, percent: int) -> Column:
    """`least_overlap` of columns."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))


def _likely(n: Column, m: Column, shared: Column, percent: int) -> Column:
    """Whether sets of n and m that share so many prefix tokens may be similar.

    One prefix ends first in the global order: all tokens shared up to there are counted, and what is left of its set is
    all that can still be shared.
    """
    left = lambda x: F.ceil(F.lit(percent) * x / F.lit(100)) - 1
    return (n * 100 >= m * percent) & (m * 100 >= n * percent) & (shared + F.greatest(left(n), left(m)) >= _need(n, m, percent))


def _sketched(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(u, v, n) of the pairs (u, v) whose sketches allow a link; n is both sets' size."""
    one, two = (nodes.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in "uv")

    def of(batches):
        for b in batches:
            cols = [c.to_pylist() for c in b.columns[2:]]
            ok = pa.array([may_link(*x, percent) for x in zip(*cols, strict=True)], pa.bool_())
            n = pa.array([x + y for x, y in zip(cols[0], cols[2], strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], names=["u", "v", "n"]).filter(ok)

    both = pairs.join(one, "u").join(two, "v").select("u", "v", "nu", "su", "nv", "sv")
    return both.mapInArrow(of, "u long, v long, n long")


def _sets(docs: DataFrame, k: int, counts: np.ndarray, wanted: DataFrame) -> DataFrame:
    """(id, tokens in global order) of the texts in `wanted`, and some more where the filter is full."""
    sc = docs.sparkSession.sparkContext
    held, some = sc.broadcast(counts), sc.broadcast(FixedFilter.of(wanted, "id"))

    def of(batches):
        for b in batches:
            may = np.flatnonzero(some.value.test(b.column(2).to_numpy(), b.column(3).to_numpy()))
            ids, texts = b.column(0).take(pa.array(may)), b.column(1).take(pa.array(may))
            for lo, hi, data, offsets in slices(texts):
                h, _, _, first = words(data, offsets)
                sets = [_ordered(s, held.value).tobytes() for s in shingles(h, first, k)]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(sets, pa.binary())], names=["id", "tokens"])

    return docs.select("id", "text", *FixedFilter.spots("id")).mapInArrow(of, "id long, tokens binary")


class Forest:
    """Disjoint sets; the smallest member stands for its set."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


class PrefixTree:
    """Ordered integer sets in a trie whose unbranched paths are single edges."""

    def __init__(self) -> None:
        # of each node: its tokens, set size bounds below, children by first token, sets that end here
        self.root: list = [np.zeros(0, dtype=np.int64), 1 << 60, 0, {}, []]

    def add(self, tokens: np.ndarray, of: int) -> None:
        n, node, at = len(tokens), self.root, 0
        while True:
            node[1], node[2] = min(node[1], n), max(node[2], n)
            if at == n:
                node[4].append(of)
                return
            child = node[3].get(int(tokens[at]))
            if child is None:
                node[3][int(tokens[at])] = [tokens[at:], n, n, {}, [of]]
                return
            edge = child[0]
            m = min(len(edge), n - at)
            differ = np.flatnonzero(edge[:m] != tokens[at : at + m])
            same = int(differ[0]) if len(differ) else m
            if same < len(edge):
                low = [edge[same:], child[1], child[2], child[3], child[4]]
                child[0], child[3], child[4] = edge[:same], {int(edge[same]): low}, []
            at += same
            node = child

    def links(self, has: np.ndarray, n: int, percent: int, skip) -> list[int]:
        """Sets similar to a probe of n tokens, which is marked in `has` (token -> position + 1, or 0). A subtree is left
        if `skip` holds for all its sets, or if what is left of the probe and of the longest set below can't reach the
        overlap that the shortest one below needs."""
        out: list[int] = []
        stack = [(self.root, 0, 0, 0)]  # node, depth above it, overlap above it, probe's last matched position
        while stack:
            node, depth, shared, last = stack.pop()
            if node[1] * percent > n * 100 or n * percent > node[2] * 100:
                continue
            hit = has[node[0]]
            hit = hit[hit > 0]
            shared += len(hit)
            last = int(hit[-1]) if len(hit) else last
            depth += len(node[0])
            need = least_overlap(n, max(node[1], -(-n * percent // 100)), percent)
            if shared + min(n - last, node[2] - depth) < need:
                continue
            if node[4] and shared >= least_overlap(n, depth, percent):
                out += [i for i in node[4] if not skip(i)]
            stack += [(c, depth, shared, last) for c in node[3].values()]
        return out


def trie_join(sets: list[np.ndarray], percent: int, forest: Forest | None = None) -> list[tuple[int, int]]:
    """Links between the sets (in global order) that suffice for their components, by positions."""
    forest = forest or Forest(len(sets))
    _, local = np.unique(np.concatenate(sets), return_inverse=True) if sets else (None, np.zeros(0, dtype=int))
    # token numbers of this group, which keep the sets' own order of tokens
    ends = np.cumsum([len(s) for s in sets])
    own = [local[e - len(s) : e] for s, e in zip(sets, ends, strict=True)]
    has = np.zeros(int(local.max()) + 1 if len(local) else 0, dtype=np.int32)
    order = sorted(range(len(own)), key=lambda i: (len(own[i]), i))
    tree, links = PrefixTree(), []
    for i in order:
        if not len(own[i]):
            continue
        has[own[i]] = np.arange(1, len(own[i]) + 1)
        root = forest.find(i)
        for j in tree.links(has, len(own[i]), percent, lambda j, root=root: forest.find(j) == root):
            if forest.join(i, j):
                links.append((i, j))
        has[own[i]] = 0
        tree.add(own[i], i)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (u, v); a component is named by its smallest node.

    Large-star and small-star steps by turns: each gives a node's neighbours to the smallest of them, so the number of
    rounds grows with the logarithm of a component's size. Neighbours are never collected.
    """
    e = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while True:
        before = e
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m")), "links-least")
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "links-large")
        lower = stored(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w"), "links-least")
        small = large.join(lower, F.col("u") == F.col("w"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lower.select(F.col("w").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        e = stored(small, "links")
        release(before, least, large, lower)
        # done when all are stars around their smallest nodes: no node is both a leaf and a centre, or a leaf of two
        leaves = e.groupBy(F.col("u").alias("leaf")).agg(F.count(F.lit(1)).alias("k"))
        if leaves.where("k > 1").isEmpty() and e.join(leaves, F.col("v") == F.col("leaf"), "left_semi").isEmpty():
            break
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _parts(members: Column, tokens: Column, chunk: int) -> Column:
    """How many tasks so many sets of so many tokens in all are dealt to."""
    return F.greatest(F.lit(1), F.ceil(members / chunk), F.ceil(tokens / (chunk * 1000))).cast("int")


def _grouped(shared: DataFrame, nodes: DataFrame, percent: int, chunk: int, pivots: int = 32) -> DataFrame:
    """(id, label, chunks, chunk, pivot): groups of texts that are likely to be similar to a token's first text, joined
    through all of them; large groups are cut into chunks. What is left out is for `_pairs` to find."""
    near = shared.where("id <> center").select("id", "center", "n", "center_n")
    heads = shared.where("salt > 0 and id = center").select("token", "id", "n")
    if not heads.isEmpty():  # the first texts of a hot token's parts, to the first of all
        first = heads.groupBy("token").agg(F.min(F.struct("id", "n")).alias("f"))
        near = near.unionByName(heads.join(first, "token").select("id", F.col("f.id").alias("center"), "n", F.col("f.n").alias("center_n")).where("id <> center"))
    near = near.groupBy("id", "center", "n", "center_n").agg(F.count(F.lit(1)).alias("c"))
    near = near.where(_likely(F.col("n"), F.col("center_n"), F.col("c"), percent)).select(F.col("id").alias("u"), F.col("center").alias("v"))
    label = components(_sketched(near, nodes, percent).select("u", "v"))
    label = label.join(nodes.groupBy("id").agg(F.max("n").alias("n")), F.col("node") == F.col("id")).select("id", F.col("component").alias("label"), "n")
    label = stored(label, "ngram-labels")
    sizes = label.groupBy(F.col("label").alias("l")).agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("tokens"))
    sizes = sizes.select("l", "members", _parts(F.col("members"), F.col("tokens"), chunk).alias("chunks"))
    # one of `pivots` members, and the first, lies in every chunk and holds the chunks together
    pivot = (F.pmod(F.xxhash64("id", F.lit(1)), F.ceil(F.col("members") / pivots)) == 0) | (F.col("id") == F.col("label"))
    placed = label.join(sizes, F.col("label") == F.col("l"))
    return stored(placed.select("id", "label", "chunks", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"), ((F.col("chunks") > 1) & pivot).alias("pivot")), "ngram-placed")


def _pairs(t: DataFrame, key: list[str], side: str, apart: Column, percent: int) -> DataFrame:
    """(u, v) that may be similar, of rows (token, id, n, pos, ...) which are alike in `key` and differ in `side`.

    The first token that two sets share leaves each of them what comes after it; a pair whose shared token leaves too
    little is not made, so a passage that many texts share pairs none of them unless it comes early in the order. Rows
    on the side that has most of the key's rows meet only rows of other sides, never one another.
    """
    most = t.groupBy(*key, side).agg(F.count(F.lit(1)).alias("rows")).groupBy(*key).agg(F.max_by(side, F.struct("rows", side)).alias("main"), F.count(F.lit(1)).alias("sides"))
    t = stored(t.join(most.where("sides > 1").drop("sides"), key), "ngram-mixed")
    a, b = (t.select(*key, *(F.col(c).alias(f"{c}{i}") for c in t.columns if c not in key)) for i in (1, 2))
    n, m = F.col("n1"), F.col("n2")
    left = F.least(n - F.col("pos1"), m - F.col("pos2"))
    once = (F.col(f"{side}2") == F.col("main2")) | (F.col("id1") < F.col("id2"))
    alike = (n * 100 >= m * percent) & (m * 100 >= n * percent) & (left >= _need(n, m, percent))
    both = a.where(F.col(f"{side}1") != F.col("main1")).join(b, key).where(once & (F.col(f"{side}1") != F.col(f"{side}2")) & alike & apart)
    return both.select(F.greatest("id1", "id2").alias("u"), F.least("id1", "id2").alias("v")).where("u <> v").distinct()


def _routes(placed: DataFrame | None, pairs: DataFrame, chunk: int) -> DataFrame:
    """(id, kind, a, b): where each set is to be joined. A group's chunks are places, and so is each text with its partners
    in `pairs` (u, v, n), in parts where there are many."""
    parts = pairs.groupBy(F.col("u").alias("w")).agg(_parts(F.count(F.lit(1)), F.sum("n"), chunk).alias("parts"))
    p = pairs.join(parts, F.col("u") == F.col("w")).select("u", "v", F.pmod(F.xxhash64("v"), F.col("parts")).cast("long").alias("b"))
    out = p.select(F.col("v").alias("id"), F.lit(1).alias("kind"), F.col("u").alias("a"), "b")
    out = out.unionByName(p.select(F.col("u").alias("id"), F.lit(1).alias("kind"), F.col("u").alias("a"), "b").distinct())
    if placed is not None:
        where = F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("chunk"))
        rows = placed.select("id", F.lit(0).alias("kind"), F.col("label").alias("a"), F.explode(where).alias("c"))
        out = out.unionByName(rows.select("id", "kind", "a", F.col("c").cast("long").alias("b")))
    return out


def _linked(docs: DataFrame, k: int, counts: np.ndarray, routes: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) found in each place, as stars around the smallest member of each component."""

    def join(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("id", kind="stable")
        ids, forest = p["id"].to_numpy(), Forest(len(p))
        trie_join([np.frombuffer(t, dtype=np.uint64) for t in p["tokens"]], percent, forest)
        root = np.array([forest.find(i) for i in range(len(p))], dtype=int)
        leaf = np.flatnonzero(root != np.arange(len(p)))
        return pd.DataFrame({"u": ids[leaf], "v": ids[root[leaf]]})

    sets = _sets(docs, k, counts, routes.select("id").distinct())
    return sets.join(routes, "id").groupBy("kind", "a", "b").applyInPandas(join, "u long, v long")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75, chunk: int = 2048, hot: int = 1 << 17) -> DataFrame:
    """One row per document: id, n_shingles, component (the smallest id reachable by links of similarity, itself included).

    A-Z count as a-z; words are runs of anything but ASCII white space; a text of fewer than k words is one shingle.
    Two texts link when 100 * shared >= percent * union. Texts without words, null or empty, link with nothing; a null
    id has no component and links with nothing. Rows that repeat an id are one node with several texts. An empty table
    gives no rows. Groups of more than `chunk` texts are joined in chunks; postings of a token that far more than `hot`
    texts have are dealt to several tasks.
    """
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    read = stored(_read(d, k), "ngram-read")
    rows = read.where("part is null").select("id", "n", "sign", "sketch")
    counts = _counts(read)
    named = rows.where("n > 0 and id is not null")
    classes = stored(named.groupBy(F.col("sign").alias("s")).agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "ngram-classes")
    nodes = classes.select("id", "n", "sketch")
    of = stored(named.select("id", "sign").join(classes.select("s", F.col("id").alias("rep")), F.col("sign") == F.col("s")).select("id", "rep"), "ngram-reps")
    firsts = stored(of.groupBy("id").agg(F.min("rep").alias("first")), "ngram-firsts")
    several = of.join(firsts, "id").where("rep <> first").select(F.col("rep").alias("u"), F.col("first").alias("v")).distinct()

    shared = stored(_shared(_postings(d, of, k, percent, counts, hot)), "ngram-shared")
    placed = _grouped(shared, nodes, percent, chunk)
    t = shared.select("token", "id", "n", "pos")
    labelled = t.join(placed.select("id", "label"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    cross = stored(_sketched(_pairs(labelled, ["token"], "label", F.lit(True), percent), nodes, percent), "ngram-pairs")
    links = stored(_linked(d, k, counts, _routes(placed, cross, chunk), percent).unionByName(several), "ngram-links")
    found = components(links)
    chunked = placed.where("chunks > 1 and not pivot")
    if not chunked.isEmpty():
        c = chunked.select("id", "label", "chunk").join(found, F.col("id") == F.col("node"), "left").select("id", "label", "chunk", F.coalesce("component", "id").alias("c"))
        more = _pairs(t.join(c, "id"), ["token", "label"], "c", F.col("chunk1") != F.col("chunk2"), percent)
        more = stored(_sketched(more, nodes, percent), "ngram-pairs")
        if not more.isEmpty():
            found = components(links.unionByName(stored(_linked(d, k, counts, _routes(None, more, chunk), percent), "ngram-links")))
    release(shared)
    final = firsts.join(found, F.col("first") == F.col("node"), "left").select(F.col("id").alias("i"), F.coalesce("component", "first").alias("component"))
    out = rows.select("id", "n").join(stored(final, "ngram-components"), F.col("id") == F.col("i"), "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"))

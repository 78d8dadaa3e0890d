"""Ranked search against a score of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import lexical

from .helpers import docs, odd_rows, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _expected(rows, items, k=20):
    held = [(i, _terms(t)) for i, t, *_ in rows]
    held = [(i, t, Counter(t)) for i, t in held if t]
    n, total, df = len(held), sum(len(t) for _, t, _ in held), Counter()
    for _, _, c in held:
        df.update(c.keys())
    out = []
    for item, text in items:
        scores = []
        for i, t, c in held:
            m = 100 - 25 + (25 * len(t) * n) // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * c[x]) // (1000 * c[x] + 12 * m)) for x, q in Counter(_terms(text)).items() if c[x])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def _items(spark, items):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, rank int, query string")


def _got(df):
    return Counter((r["item"], r["rank"], r["doc"], r["score"]) for r in df.collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    rows = [(i, words(rng, rng.choice([3, 10, 10, 10, 60, 400]), most=rng.choice([30, 300])).replace(" ", rng.choice([" ", ". ", "-"])), "en", "a") for i in range(250)]
    rows += [(1000 + i, rows[i % 3][1], "en", "b") for i in range(90)]
    items = [(i, words(rng, rng.choice([1, 5, 40]), most=300)) for i in range(25)] + [(77, rows[0][1]), (77, rows[0][1]), (78, None), (79, "!!"), (80, "nowhere"), (None, "W1 w1 W2")]
    return rows, items


@pytest.mark.parametrize("most_postings", [1, 200, 1 << 16])
def test_against_all_scores(spark, corpus, most_postings):
    rows, items = corpus
    index = lexical.build_index(docs(spark, rows), most_postings=most_postings, in_a_row=7)
    assert (index.docs, index.terms) == (len(rows), sum(len(_terms(t)) for _, t, *_ in rows))
    assert _got(lexical.search(index, _items(spark, items))) == _expected(rows, items)


def test_chunks_of_queries(spark, corpus):
    rows, items = corpus
    index = lexical.build_index(docs(spark, rows))
    assert _got(lexical.search(index, _items(spark, items), k=3, most_terms=60)) == _expected(rows, items, 3)


def test_odd_rows_and_empty_tables(spark):
    rows, items = odd_rows(), [(1, "Hello world"), (2, "again ä"), (3, "w1 w2 more")]
    assert _got(lexical.ranked_search(docs(spark, rows), _items(spark, items))) == _expected(rows, items)
    assert lexical.ranked_search(docs(spark, rows).where("false"), _items(spark, items)).count() == 0
    assert lexical.ranked_search(docs(spark, rows), _items(spark, items).where("false")).count() == 0


def test_bounds_hold_and_spare_blocks(spark, corpus):
    """No document's score exceeds its block's bound, and a floor keeps blocks from being read."""
    rows, items = corpus
    index = lexical.build_index(docs(spark, rows), most_postings=200)
    (queries,) = lexical._chunks(_items(spark, items), "item_id", "text", 1 << 18)
    lexical._weigh(index, queries)
    blocks = index.blocks.collect()
    best = {}
    for r in lexical.search(index, _items(spark, items), k=10**6).collect():
        best.setdefault((r["item"], r["doc"]), r["score"])
    for b in blocks:
        bound = queries.bounds(b["m"], np.frombuffer(b["terms"], np.uint64), np.frombuffer(b["top"], np.uint32).astype(np.int64))
        for doc in np.frombuffer(b["docs"], np.int64):
            assert all(best.get((i, int(doc)), 0) <= x for i, x in zip(queries.ids, bound))
    queries.floor = np.full(len(queries.ids), 1 << 60)
    seen = lexical._Visit(queries, 20)
    seen.block(blocks[0]["m"], {k: blocks[0][k] for k in ("terms", "top")})  # without postings: they aren't asked for
    assert seen.rows() == []

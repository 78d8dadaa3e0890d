import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import media, warc
from tidewatch.llm.common import scratch
from tidewatch.llm.ngram_join import Forest, least_overlap, may_link, ngram_components, sketch, trie_join
from tidewatch.llm.wordhash import shingles, slices, words

from .helpers import docs, odd_rows
from .helpers import words as make


@settings(max_examples=40, deadline=None)
@given(st.text(max_size=3000), st.integers(1, 9), st.integers(1, 5))
def test_media_round_trip(text, chunk, key):
    n, data = media.padded(text)
    file = media.write_media(data, chunk=chunk, key=key)
    index = media.read_index(file)
    assert media.payload(file, index) == data and n == len(text.encode("utf-8", "surrogatepass"))
    assert len(data) % 576 == 0 and data
    assert index["codec"] == "raw " and index["ticks"] == index["duration"] == len(data)
    assert index["keyframes"] == index["samples"][::key]
    with pytest.raises(ValueError):
        media.read_index(file[:-1])


def test_media_columns(spark):
    got = media.media_columns(docs(spark, odd_rows()), batch=3).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        back = media.payload(bytes(r["media"]), media.read_index(bytes(r["media"])))
        assert hashlib.sha256(back).hexdigest() == r["payload_sha256"] and len(r["media"]) == r["media_bytes"] and zlib.crc32(back[-32:]) == r["tail_crc32"]
    same = {r["id"]: r["media_sha256"] for r in got if r["id"] in (4, 5)}
    assert same[4] == same[5]
    assert media.media_columns(docs(spark, [])).count() == 0


def _sets(texts, k=5):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def test_shingles_match_words():
    texts = ["", "a", "A b\tc", "a b c d e f a b c d e", " \x0b x ", None, "é É z z z z z z z", "a b c d", "a b c d e", "b", ""]
    got = []
    for _, _, data, offsets in slices(pa.array(texts), most=12):
        h, _, _, first = words(data, offsets)
        got += [len(s) for s in shingles(h, first, 5)]
    assert got == [len(s) for s in _sets(texts)]


def _components(sets, ids):
    f = Forest(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                f.join(i, j)
    least = defaultdict(lambda: 1 << 60)
    for i, x in enumerate(ids):
        least[f.find(i)] = min(least[f.find(i)], x)
    return [least[f.find(i)] for i in range(len(sets))]


def test_trie_join_finds_all_components():
    rng = random.Random(4)
    base = [rng.sample(range(3000), 40) for _ in range(12)]
    sets = []
    for _ in range(160):
        s = set(rng.choice(base))
        for x in list(s):
            if rng.random() < 0.1:
                s.discard(x)
                s.add(rng.randrange(3000))
        sets.append(s)
    order = {x: i for i, x in enumerate(sorted(range(3000), key=lambda x: (sum(x in s for s in sets), x)))}
    links = trie_join([np.array(sorted(s, key=order.get), dtype=np.uint64) for s in sets], 75)
    f = Forest(len(sets))
    for i, j in links:
        both = len(sets[i] & sets[j])
        assert both >= least_overlap(len(sets[i]), len(sets[j]), 75)
        f.join(i, j)
    want = _components(sets, range(len(sets)))
    assert [f.find(i) for i in range(len(sets))] == want


@pytest.mark.parametrize(("chunk", "hot"), [(2048, 1 << 17), (6, 1 << 17), (6, 3)])
def test_components_match_brute_force(spark, chunk, hot):
    """Near copies of several originals, with a passage that many texts share; small chunks leave pairs for the last step,
    a small `hot` deals the shared shingles to several tasks."""
    rng = random.Random(6)
    passage = make(rng, 30, "p")
    originals = [make(rng, 60) for _ in range(6)]
    texts = []
    for _ in range(110):
        w = rng.choice(originals).split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(w) + (" " + passage if rng.random() < 0.3 else ""))
    texts += [make(rng, 20) + " " + passage for _ in range(25)] + ["", None, "one two", "One two", "one two three"]
    ids = rng.sample(range(1000), len(texts))
    got = {r["id"]: (r["n_shingles"], r["component"]) for r in ngram_components(docs(spark, [(i, t, "en", "s") for i, t in zip(ids, texts, strict=True)]), chunk=chunk, hot=hot).collect()}
    sets = _sets(texts)
    want = dict(zip(ids, zip(map(len, sets), _components(sets, ids), strict=True), strict=True))
    assert got == want


def test_large_groups_are_cut_into_chunks(spark):
    """Near copies, more of them in a group than pivots, and a chain of which only neighbours are similar."""
    rng = random.Random(16)
    original, line = make(rng, 100).split(), make(rng, 150).split()
    texts = [" ".join(line[3 * i : 3 * i + 60]) for i in range(30)]
    for _ in range(120):
        w = list(original)
        for _ in range(rng.choice((1, 1, 1, 4))):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    ids = rng.sample(range(1000), len(texts))
    got = {r["id"]: r["component"] for r in ngram_components(docs(spark, [(i, t, "en", "s") for i, t in zip(ids, texts, strict=True)]), chunk=8).collect()}
    assert got == dict(zip(ids, _components(_sets(texts), ids), strict=True))


def test_sketches_never_part_similar_sets():
    rng = np.random.default_rng(4)
    kept = 0
    for _ in range(300):
        n = int(rng.choice([3, 20, 90, 400, 20_000]))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(0.6, 1)], rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)]))
        if len(b) and 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b)):
            kept += 1
            assert may_link(len(a), sketch(a), len(b), sketch(b), 75)
    far = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (100, 100, 130)]
    assert kept > 50 and not any(may_link(len(x), sketch(x), len(y), sketch(y), 75) for x, y in zip(far, far[1:]))


def test_components_of_odd_rows(spark):
    got = ngram_components(docs(spark, odd_rows())).collect()
    by = {r["id"]: r["component"] for r in got}
    assert len(got) == len(odd_rows())
    assert by[1] == by[2] == by[3] == by[7] == 1 and by[9] == 8 and by[4] == 4 and by[5] == 5 and by[None] is None
    assert ngram_components(docs(spark, [])).count() == 0


PAGES = "page_id long, url string, html string, digest string, shard long"


def test_warc_round_trip(spark):
    rng = random.Random(7)
    bodies = [f"<p>{make(rng, 40)}</p>" for _ in range(6)] + ["short", "", None, "é" * 60, "\r\n\r\nWARC/1.1\r\n" * 9]
    rows = [(i * 3, f"http://x/{i}\r\nbad: 1", rng.choice(bodies), "d", 1) for i in range(200)] + [(None, None, bodies[0], None, None), (None, None, "only null ids " * 20, None, None), (3, "http://x/again", bodies[1], None, None)]
    pages = spark.createDataFrame(rows, PAGES)
    path = scratch(spark, "warc-test")
    manifest = warc.write_warc(pages, path, file_bytes=2000, rows_per_shard=40)
    got = warc.read_warc(spark, path).collect()
    least = {}
    for i, _, h, *_ in rows:
        if i is not None:
            least[h or ""] = min(i, least.get(h or "", i))
    want = []
    for i, _, h, *_ in rows:
        raw = (h or "").encode()
        again = len(raw) >= 100 and least.get(h or "") is not None and i != least[h or ""]
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", least[h or ""] if again else None))
    assert sorted(((r["id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=repr) == sorted(want, key=repr)
    files = manifest.collect()
    assert len(files) > 5 and all(r["bytes"] < 20_000 for r in files)
    second = warc.write_warc(pages.repartition(3), scratch(spark, "warc-test"), file_bytes=2000, rows_per_shard=40)
    assert {(r["file"], r["sha256"]) for r in second.collect()} == {(r["file"], r["sha256"]) for r in files}
    empty = warc.write_warc(spark.createDataFrame([], PAGES), scratch(spark, "warc-test"))
    assert empty.count() == 0
    nothing = scratch(spark, "warc-test")
    warc.write_warc(spark.createDataFrame([], PAGES), nothing)
    assert warc.read_warc(spark, nothing).count() == 0


def test_warc_shards_follow_the_ids(spark):
    """One far-off id and repeated ids: shards still have their size, and a record longer than a file fits."""
    ids = [*range(100), 10**15, *[50] * 7, None]
    pages = spark.createDataFrame([(i, "u", "x" * (50_000 if i == 3 else 10), None, None) for i in ids], PAGES)
    path = scratch(spark, "warc-test")
    warc.write_warc(pages, path, file_bytes=3000, rows_per_shard=10)
    held = {r["shard"]: r["n"] for r in warc.manifests(spark, path).groupBy("shard").agg(F.sum("records").alias("n")).collect()}
    assert sum(held.values()) == len(ids) and len(held) == 12 and max(held.values()) <= 17
    got = sorted((r["id"] is None, r["id"] or 0) for r in warc.read_warc(spark, path).collect())
    assert got == sorted((i is None, i or 0) for i in ids)

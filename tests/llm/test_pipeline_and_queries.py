"""The registered queries against SQL, and each stage of the pipeline against a plain version of it."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import partial

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from tidewatch.llm import media, queries

from .helpers import docs, odd_rows, words

DIR = "/root/testdata/sf0.001"


def _cell(v):
    if v is None or (isinstance(v, float) and v != v):
        return "~"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    cur = con.execute(queries.ORACLE_SQL[name])
    columns = sorted(c[0] for c in cur.description)
    want = cur.fetchdf()
    got = pd.DataFrame([r.asDict() for r in queries.QUERIES[name](spark, DIR).collect()])
    rows = lambda d: sorted(tuple(_cell(x) for x in r) for r in d[columns].astype(object).where(d[columns].notna(), None).itertuples(index=False))
    assert set(columns) <= set(got.columns)
    assert [[x.removesuffix(".0") for x in r] for r in rows(got)] == [[x.removesuffix(".0") for x in r] for r in rows(want)]


def test_media_query_holds_every_text(spark):
    """Payload, sums and stored form of every document, made from its text alone."""
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    out = queries.QUERIES["op4_media_columns"](spark, DIR).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(text)
    for r in out:
        raw = (text[r["doc_id"]] or "").encode()
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        stored = media.write_media(payload)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r["tail_crc32"] == zlib.crc32(payload[-32:]) and r["media_bytes"] == len(stored) and r["media_sha256"] == hashlib.sha256(stored).hexdigest()
        assert stored.endswith(payload) and stored[4:8] == b"ftyp" and stored[len(stored) - len(payload) - 4 :][:4] == b"mdat"
        # key frames are every eighth frame, counted from where the payload begins
        begin = len(stored) - len(payload)
        assert [(k["first"], k["end"]) for k in r["keyframes"]] == [(begin + i, begin + i + 576) for i in range(0, len(payload), 576 * 8)]
        assert r["codec"] == "raw " and r["duration"] == len(payload) / 8000


def _fixture():
    """Good and junk texts with exact and near copies, of sources of unlike size; nulls and repeated rows among them."""
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(360):
        w = words(rng, rng.randrange(25, 70), most=900)
        junk = rng.random() < 0.3
        text = w.upper().replace(" ", "!! ") if junk else w
        if not junk and rng.random() < 0.35 and any(not j for *_, j in rows):
            old = rng.choice([t for _, t, _, _, j in rows if not j])
            text = old.replace(" ", "  ", 1) if rng.random() < 0.5 else old + " tail"
        rows.append((i, text, "en", rng.choice("aaaaabc") if i % 50 else None, junk))
        if i % 3:
            labels.append((i, int(not junk), 0))
    rows += [(1000, words(rng, 5000, most=9000), "en", "c", False), (5, rows[5][1], "en", rows[5][3], rows[5][4]), (5, words(rng, 30), "de", "b", False)]
    return rows, labels


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rows, labels = _fixture()
    folder = tmp_path_factory.mktemp("corpus")
    d = docs(spark, [r[:4] for r in rows]).select(*corpus_pipeline.COLUMNS)
    d.write.parquet(f"file://{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{folder}/labels.parquet")
    return rows, f"file://{folder}"


def _rows(df):
    return Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect())


def test_quality_stage_drops_junk_only(spark, corpus):
    rows, folder = corpus
    kept = _rows(corpus_pipeline.quality(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder))
    assert kept == Counter(r[:4] for r in rows if not r[4])


def test_dedup_stage(spark, corpus):
    rows, folder = corpus
    first = {}
    for i, t, *_ in rows:
        body = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        first[body] = min(i, first.get(body, i))
    got = corpus_pipeline.dedup(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()
    assert len(got) == len(first) and {(r["doc_id"], re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")) for r in got} == {(i, b) for b, i in first.items()}


def test_near_dedup_stage(spark, corpus):
    rows, folder = corpus
    sets = []
    for i, t, *_ in rows:
        w = t.lower().split()
        sets.append((i, {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}))
    least = {i: i for i, _ in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if 100 * len(a & b) >= 75 * len(a | b):
                p, q = sorted((root(i), root(j)))
                least[q] = p
    want = Counter(r[:4] for r in rows if root(r[0]) == r[0])
    assert _rows(corpus_pipeline.near_dedup(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)) == want


def test_mix_stage(spark, corpus):
    rows, folder = corpus
    d = [(i, len((t or "").split()), s, t) for i, t, _, s, _ in rows]
    size = Counter()
    for _, n, s, _ in d:
        size[s] += n
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight, total, full = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, sum(size.values()), {}
    while True:
        rest = (total - sum(full.values())) / sum(weight[s] for s in names if s not in full)
        over = {s: 3 * size[s] for s in names if s not in full and rest * weight[s] > 3 * size[s]}
        if not over:
            break
        full |= over
    target = {s: full.get(s, rest * weight[s]) for s in names}
    line, upto = [], Counter()
    for i, n, s, t in sorted(d, key=lambda r: (hashlib.md5(f"mix|{r[0]}".encode()).hexdigest(), r[0], r[1])):
        upto[s] += n
        line += [((lap * size[s] + upto[s]) / target[s], s is None, s or "", hashlib.md5(f"mix|{i}".encode()).hexdigest(), i, n, lap) for lap in range(3)]
    want, used = Counter(), 0
    for *_, i, n, _ in sorted(line):
        used += n
        if used > total:
            break
        want[i, n] += 1
    got = Counter((i, len(t.split())) for (i, t, _, _), k in _rows(corpus_pipeline.mix(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)).items() for _ in range(k))
    assert got == want


def test_whole_pipeline(spark, corpus):
    """Bins hold no more than their length and nothing twice; all words that the mix took are in them."""
    rows, folder = corpus
    out = corpus_pipeline.run(spark, folder).collect()
    junk = {r[0] for r in rows if r[4]} - {r[0] for r in rows if not r[4]}
    assert out and not junk & {r["doc_id"] for r in out}
    bins = defaultdict(list)
    for r in out:
        bins[r["bin"]].append((r["at"], r["at"] + r["size"], r["capacity"]))
    for spans in bins.values():
        spans.sort()
        assert spans[-1][1] <= spans[0][2] and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    docs_ = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_ = stage(spark, docs_, folder)
    want = Counter()
    for (i, t, _, _), k in _rows(docs_).items():
        want[i] += k * len(t.split())
    got = Counter()
    for r in out:
        got[r["doc_id"]] += r["size"]
    assert got == want


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_empty_tables(spark, corpus, name):
    folder, stage = corpus[1], dict(corpus_pipeline.STAGES)[name]
    odd = docs(spark, odd_rows())
    assert stage(spark, odd.where("false"), folder).count() == 0
    got = stage(spark, odd, folder)
    assert got.count() > 0
    if name != "best_fit_packing":
        assert got.columns == corpus_pipeline.COLUMNS
        found = {(r[0], r[1]) for r in odd_rows()}
        assert all((r["doc_id"], r["text"]) in found for r in got.collect())


def test_near_dedup_where_groups_are_cut(spark, monkeypatch):
    """Stage 3 with groups of more texts than a chunk holds."""
    monkeypatch.setattr(corpus_pipeline, "ngram_components", partial(corpus_pipeline.ngram_components, chunk=8))
    rng = random.Random(3)
    original = words(rng, 100, most=10**6).split()
    rows = []
    for i in range(90):
        w = list(original)
        w[rng.randrange(len(w))] = f"n{i}"
        rows.append((i, " ".join(w), "en", "s"))
    rows += [(100 + i, words(rng, 40, most=10**6), "en", "s") for i in range(5)]
    got = corpus_pipeline.near_dedup(spark, docs(spark, rows), "")
    assert sorted(r["doc_id"] for r in got.collect()) == [0, 100, 101, 102, 103, 104]

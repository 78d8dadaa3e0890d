import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tidewatch.llm import hmm, quality
from tidewatch.llm.wordhash import words as word_hashes
from tidewatch.llm.fitting import isotonic
from tidewatch.llm.language import fit_language, identify_language
from tidewatch.llm.quality import score_quality
from tidewatch.llm.toxicity import BlockMaxIndex, score_toxicity, terms

from .helpers import docs, odd_rows, words


def _fold(i, mod):
    return zlib.crc32(str(i).encode()) % mod


def test_block_max_index_is_exact():
    rng = np.random.default_rng(1)
    rows = [{int(t): float(w) for t, w in zip(rng.choice(30, 4, replace=False), rng.random(4), strict=True)} for _ in range(300)]
    arrays = [(np.array(list(r)), np.array(list(r.values()))) for r in rows]
    index = BlockMaxIndex(arrays, 30, block=16)
    for q, near in zip(rows[:60], index.nearest_all(arrays[:60], 9), strict=True):
        dots = [(round(sum(w * r.get(t, 0.0) for t, w in q.items()), 12), -i) for i, r in enumerate(rows)]
        want = [(s, -i) for s, i in sorted(dots, reverse=True)[:9] if s > 0]
        assert [i for _, i in near] == [i for _, i in want]


def test_isotonic_pools():
    x, v = isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert np.interp([1, 2, 3, 4], x, v).tolist() == [0, 0.5, 0.5, 1]


def _corpus(n=600):
    rng = random.Random(8)
    bad = ["rotten", "vilest", "wretch"]
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.25
        w = [f"{rng.choice('abcdefgh')}word{rng.randrange(300)}x" for _ in range(60)]
        if toxic:
            for b in rng.choices(bad, k=5):
                w[rng.randrange(60)] = b
        good = rng.random() < 0.7
        if not good:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w), "en", rng.choice("ab")))
        labels.append((i, int(good), int(toxic), "clash"))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int, text string"


def test_toxicity_on_held_out_rows(spark):
    rows, labels = _corpus()
    out = score_toxicity(docs(spark, rows + [(None, None, None, None), (9000, "", None, None)]), spark.createDataFrame(labels + [(None, 1, 1, None), (99999, 1, None, None)], LABELS), least_g=12.0).collect()
    truth = {i: t for i, _, t, _ in labels}
    assert len(out) == len(rows) + 2 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    held = [r for r in out if r["held_out"] and r["id"] in truth]
    assert all(r["held_out"] == (_fold(r["id"], 5) == 0) for r in out if r["id"] is not None)
    assert np.mean([r["predicted"] == truth[r["id"]] for r in held]) > 0.95
    assert any(r["evidence"] for r in out) and all(e["id"] in truth and _fold(e["id"], 5) for r in out for e in r["evidence"])


def test_toxicity_neighbours_are_by_all_words(spark):
    texts = ["the cat sat on a mat", "a dog lay on the rug", "le chat dort sur un tapis", "der Hund liegt auf dem Teppich", "we went by bus to the sea", "\u732b\u304c\u5bdd\u3066\u3044\u308b", "\u72ac\u304c\u8d70\u3063\u3066\u3044\u308b", "un chat noir", "ein Hund und ein Ball", "to be or not to be"] * 3
    rows = [(i, f"{x} {i % 4}", None, None) for i, x in enumerate(texts)]
    labels = [(i, 1, i % 3 % 2, None) for i in range(0, 30, 2)]
    train = {i: y for i, _, y, _ in labels if _fold(i, 5)}
    df = Counter(t for _, x, _, _ in rows for t in set(terms(x)))
    known = {t for i in train for t in terms(rows[i][1])}

    def vector(x):
        v = {t: (1 + math.log(n)) * (math.log((1 + len(rows)) / (1 + df[t])) + 1) for t, n in terms(x).items() if t in known}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {t: w / norm for t, w in v.items()}

    vectors = {i: vector(x) for i, x, _, _ in rows}
    out = score_toxicity(docs(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(rows)
    for r in out:
        want = sorted((sum(w * vectors[i].get(t, 0.0) for t, w in vectors[r["id"]].items()) for i in train), reverse=True)
        want = [w for w in want if w > 1e-12][:15]
        assert r["evidence"] and [e["similarity"] for e in r["evidence"]] == pytest.approx(want)


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in score_toxicity(docs(spark, odd_rows()), none).collect()} == {0.0}
    assert score_toxicity(docs(spark, []), none).count() == 0


def _plain_text_view(text):
    """Steps of trigram counts and of form of one text, letter by letter."""
    raw = text.encode()
    grams = Counter((((a | b << 8 | c << 16) * 0x9E3779B1) & 0xFFFFFFFF) >> 22 for a, b, c in zip(raw, raw[1:], raw[2:], strict=False))
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    low = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in w]
    n, m, times = max(1, len(raw)), max(1, len(w)), Counter(low)
    form = [
        sum(c.isupper() for c in text) / n, sum(c.isdigit() for c in text) / n, sum(c in "!#$%&*|<>{}[]=@^~_\\" for c in text) / n, text.count("|") / m,
        sum(x[-1] in "!#$%&*|<>{}[]=@^~_\\" for x in w) / m, sum(sum(c.isupper() for c in x) > 1 and not any(c.islower() for c in x) for x in w) / m,
        sum(a == b for a, b in zip(low, low[1:], strict=False)) / m, len(times) / m**0.9, max(times.values(), default=0) / m,
        (text.count(".") + text.count("?")) / m, sum(b >= 128 for b in raw) / n, len(raw) / m / 40, float(not w),
    ]
    return [math.floor(12 * math.log1p(grams[i]) + 0.5) for i in range(quality.GRAMS)], [math.ceil(15 * math.sqrt(min(1.0, x))) for x in form]


def test_text_view_matches_a_plain_count():
    texts = ["", "a", "  ", "SHOUT!! now now, THE END.", "\u00c9t\u00e9 \u00c8RE | x | 12 % 7?", "ab " * 900, "x" * 4000, "no no NO", "\u732b\u304c"]
    raw = [t.encode() for t in texts]
    grams, form = quality.text_view(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)]))
    for t, g, f in zip(texts, grams, form, strict=True):
        assert (g.tolist(), f.tolist()) == _plain_text_view(t), t


def test_long_texts_keep_their_profile():
    """A text and many of it in a row have nearly the same shares of trigrams, however often these occur."""
    text = words(random.Random(4), 4000, most=300) + " "
    few, many = (quality.text_view(np.frombuffer(t.encode(), dtype=np.uint8), np.array([0, len(t)]))[0] for t in (text, text * 40))
    assert many.max() == round(12 * math.log1p(max(Counter((((a | b << 8 | c << 16) * 0x9E3779B1) & 0xFFFFFFFF) >> 22 for a, b, c in zip(*((text * 40).encode()[i:] for i in range(3)), strict=False)).values())))
    a, b = quality._shares(few)[0], quality._shares(many)[0]
    assert np.corrcoef(a, b)[0, 1] > 0.9 and ((a > 0) == (b > 0)).all()


def test_surest_steps_of_a_histogram():
    rng = np.random.default_rng(3)
    z = np.round(rng.uniform(-6, 6, 4000), 3) + 0.0005
    step = quality._bin(z)
    counts = np.bincount(step, minlength=240).astype(float)
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    low, high = quality._sure(counts, 0.1, 0.7, step, y, np.ones(4000), 0.05)
    for mine, likely in ((step >= high, 0.7), (step < low, 0.3)):
        assert 0.1 * likely * 4000 <= mine.sum() <= 0.1 * likely * 4000 + counts.max()
    assert y[step >= high].mean() > 0.95 > 0.05 > y[step < low].mean()
    # labels that say nothing allow nothing, and an eighth is tried where the whole is too often wrong
    assert quality._sure(counts, 0.5, 0.5, step, (rng.random(4000) < 0.5).astype(float), np.ones(4000), 0.05) == (0, 240)
    bent = np.where(z > 5.3, 1.0, 0.0)
    high = quality._sure(counts, 0.8, 0.5, step, bent, np.ones(4000), 0.05)[1]
    assert 0 < (step >= high).sum() <= 0.8 * 0.5 * 4000 / 8 + counts.max()


def test_layout_of_a_page():
    pack = lambda raw: raw[: len(raw) // 4]
    at = dict(zip(("lines", "line", "distinct", "bytes", "packed"), quality.layout_view(b"ab\nab\ncd\nef", 11, pack), strict=True))
    want = {"lines": math.log(4) * 6, "line": math.log(11 / 4 + 1) * 5, "distinct": 3 / 4 * 31, "bytes": 20, "packed": 2 / 11 * 100}
    assert at == {f: quality._AT[f] + int(x) for f, x in want.items()}
    for raw, stated in ((b"", None), (b"", 0), (b"x" * 10**6, 1), (b"\n" * 10**5, -3), (b"abc", 10**12)):
        places = quality.layout_view(raw, stated, pack)
        assert all(quality._AT[f] <= p < quality._AT[f] + quality.FIELDS[f] for f, p in zip(("lines", "line", "distinct", "bytes", "packed"), places, strict=True))


def test_scores_are_those_of_a_plain_model():
    """Feature sums, log-odds and evidence of both views, feature by feature."""
    rng = np.random.default_rng(5)
    n = 60
    grams = (rng.random((n, quality.GRAMS)) < 0.02).astype(np.uint8) * rng.integers(8, 40, (n, quality.GRAMS)).astype(np.uint8)
    form = rng.integers(0, quality.STEPS, (n, quality.FORMS)).astype(np.uint8)
    meta = np.column_stack([quality._AT[f] + rng.integers(0, min(5, s), n) for f, s in quality.FIELDS.items()])
    y, weight = (rng.random(n) < 0.6).astype(float), rng.random(n) + 0.5
    rows = (grams, form, meta)
    part = lambda s: tuple(v[s] for v in rows)
    model = quality.fitted([quality.feature_sums(part(y == c), weight[y == c]) for c in (0, 1)], rows, y, weight)

    def share(i):
        logs = [g / 12 for g in grams[i]]
        return [x / max(sum(logs), 1e-6) for x in logs]

    shares = [share(i) for i in range(n)]

    def odds(per_row, size, smooth):
        sums = [sum(w * per_row(i) for i, w in enumerate(weight) if y[i] == c) for c in (0, 1)]
        totals = [sum(w for i, w in enumerate(weight) if y[i] == c) for c in (0, 1)]
        a, b = ((s + smooth) / (t + smooth * size) for s, t in zip(sums, totals, strict=True))
        return math.log(b / a)

    text, page = model.evidence(rows)
    for i in range(5):
        by_gram = sum(x * odds(lambda j, g=g: shares[j][g], quality.GRAMS, 0.01) for g, x in enumerate(shares[i]) if x)
        by_form = sum(odds(lambda j, k=k, v=v: float(form[j][k] == v), quality.STEPS, 0.5) for k, v in enumerate(form[i]))
        by_meta = sum(odds(lambda j, f=f, v=v: float(meta[j][f] == v), len({int(x) for x in meta[:, f]}), 2.0) for f, v in enumerate(meta[i]))
        assert text[i].tolist() == pytest.approx([by_gram, by_form], rel=1e-4) and page[i][0] == pytest.approx(by_meta)
    z = model.logits(rows)
    for e, s, k in ((text, model.scale[0], 0), (page, model.scale[1], 1)):
        assert z[:, k].tolist() == pytest.approx([min(12, max(-12, sum(a * b for a, b in zip(r, s[:-1], strict=True)) + s[-1])) for r in e])
    model.combine = np.array([0.5, 0.25, -0.1])
    assert model.score(z).tolist() == pytest.approx([1 / (1 + math.exp(-(0.5 * a + 0.25 * b - 0.1))) for a, b in z])


def test_quality_co_training(spark):
    rows, labels = _corpus()
    out = score_quality(docs(spark, rows), spark.createDataFrame(labels, LABELS).where("doc_id < 300")).collect()
    truth = {i: q for i, q, *_ in labels}
    assert np.mean([r["keep"] == bool(truth[r["id"]]) for r in out if r["id"] >= 300]) > 0.97
    again = score_quality(docs(spark, rows).repartition(5), spark.createDataFrame(labels, LABELS).where("doc_id < 300")).collect()
    assert {r["id"]: round(r["score"], 9) for r in again} == {r["id"]: round(r["score"], 9) for r in out}
    assert all(r["keep"] for r in score_quality(docs(spark, odd_rows()), spark.createDataFrame([], LABELS)).collect())
    assert score_quality(docs(spark, []), spark.createDataFrame(labels, LABELS)).count() == 0
    assert score_quality(docs(spark, odd_rows() + rows), spark.createDataFrame(labels, LABELS)).count() == len(odd_rows()) + len(rows)


def _exchanged(spark, labelled, free, rounds):
    """Scores of rows without a label (text, source), when those with one are `labelled` (text, source, quality)."""
    rows = [(i, t, "en", g) for i, (t, g, *_) in enumerate([*labelled, *free])]
    known = spark.createDataFrame([(i, y, 0, None) for i, (*_, y) in enumerate(labelled)], LABELS)
    out = score_quality(docs(spark, rows), known, rounds=rounds)
    return {r["id"] - len(labelled): r for r in out.collect() if r["id"] >= len(labelled)}, out.exchanged


def _words(rng, stem, n=40):
    return " ".join(f"{rng.choice(stem)}{rng.choice('abcdefgh')}{rng.choice(stem)}" for _ in range(n))


def test_text_teaches_metadata(spark):
    """Sources tell the quality, but labelled rows have none of the sources that most documents have: the metadata view can
    only learn these from what the text view is sure of."""
    rng = random.Random(7)
    make = lambda good, age: (_words(rng, "mnrl" if good else "xqzk"), f"{age}-{'good' if good else 'bad'}")
    labelled = [(*make(y, "old"), y) for y in (int(rng.random() < 0.6) for _ in range(400))]
    truth = [rng.random() < 0.6 for _ in range(600)]
    right = lambda got: np.mean([(got[i]["metadata_score"] >= 0.5) == y for i, y in enumerate(truth)])
    free = [make(y, "new") for y in truth]
    before, _ = _exchanged(spark, labelled, free, 0)
    after, exchanged = _exchanged(spark, labelled, free, 3)
    assert right(before) < 0.8 < 0.93 < right(after) and all(page > 0 for _, page in exchanged)


def test_metadata_teaches_text(spark):
    """Bad texts without a label are of a kind that labelled ones are not, which the text view takes for good; their sources
    tell, so the text view learns the kind from what the metadata view is sure of."""
    rng = random.Random(8)
    labelled = [(_words(rng, "mnrl" if y else "xqzk"), f"src{rng.randrange(6) * 2 + y}", y) for y in (int(rng.random() < 0.6) for _ in range(500))]
    truth = [int(rng.random() < 0.6) for _ in range(800)]
    free = [(_words(rng, "mnrl") if y else _words(rng, "mrwv"), f"src{rng.randrange(6) * 2 + y}") for y in truth]
    right = lambda got: np.mean([(got[i]["text_score"] >= 0.5) == bool(y) for i, y in enumerate(truth)])
    before, _ = _exchanged(spark, labelled, free, 0)
    after, exchanged = _exchanged(spark, labelled, free, 3)
    assert right(before) < 0.75 < 0.9 < right(after), (right(before), right(after), exchanged)
    assert all(text > 0 for text, _ in exchanged)


def test_language_on_held_out_rows(spark):
    rng = random.Random(9)
    stems = {"aa": ["bal", "dor", "kin", "tus"], "bb": ["schli", "wex", "unge", "pft"], "cc": ["oue", "eaux", "ille", "ment"]}
    rows = [(i, " ".join("".join(rng.choices(stems[g], k=3)) for _ in range(rng.randrange(8, 60))), g, "s") for i in range(400) for g in [rng.choice("abc") * 2]]
    odd = [(1000, None, "aa", None), (1001, "", None, None), (1002, "12 !!", "aa", "s"), (1003, "\u00bd \u00b2 \u2460 12", None, None), (None, "baldor kin", None, None)]
    out = identify_language(docs(spark, rows + odd)).collect()
    by = {r["id"]: r for r in out}
    held = [(i, g) for i, _, g, _ in rows if _fold(i, 3) == 1]
    assert np.mean([by[i]["lang_pred"] == g for i, g in held]) > 0.97 and all(by[i]["held_out"] for i, _ in held)
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1000, 1001, 1002, 1003))
    assert all(0 <= r["score"] <= 1 for r in out)
    assert {r["lang_pred"] for r in identify_language(docs(spark, [(1, "abc", None, None)])).collect()} == {"und"}
    assert identify_language(docs(spark, [])).count() == 0


def test_language_of_long_texts_only_is_learned(spark):
    rng = random.Random(11)
    make = lambda stems, n: " ".join("".join(rng.choices(stems, k=3)) for _ in range(n))
    rows = [(i, make(["bal", "dor", "kin"], 40), "aa", "s") for i in range(40)] + [(100 + i, make(["schli", "wex", "pft"], 3000), "bb", "s") for i in range(40)]
    rows += [(7, rows[7][1], "aa", "s")] * 5 + [(None, make(["bal"], 9), "aa", None)]
    by = {r["id"]: r for r in identify_language(docs(spark, rows)).collect()}
    assert all(by[i]["lang_pred"] == g for i, _, g, _ in rows)
    # sizes as zstandard gives them, piece by piece
    model = fit_language(docs(spark, rows), "doc_id", "text", "lang")
    want = [sum(len(zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False).compress(rows[50][1].encode()[i : i + 2048])) for i in range(0, len(rows[50][1].encode()), 2048)) for d in model.dictionaries.values()]
    assert model.sizes(rows[50][1], 6).tolist() == want and all(len(d) <= 96 * 1024 for d in model.dictionaries.values())


def _chain(states=3, symbols=5, seed=3):
    rng = np.random.default_rng(seed)
    a = lambda *s: (x := rng.random(s)) / x.sum(-1, keepdims=True)
    return hmm.Chain(a(states), a(states, states), a(states, symbols).T.copy())


def _likelihood(chain, doc):
    """The sum over all paths of states."""
    import itertools

    total = 0.0
    for path in itertools.product(range(len(chain.start)), repeat=len(doc)):
        p = chain.start[path[0]] * chain.emit[doc[0], path[0]]
        for a, b, x in zip(path, path[1:], doc[1:], strict=False):
            p *= chain.move[a, b] * chain.emit[x, b]
        total += p
    return total


def test_forward_sums_over_all_paths():
    rng, chain = np.random.default_rng(5), _chain()
    found = [rng.integers(0, 5, n).astype(np.uint16) for n in (6, 5, 5, 2, 1)]
    logs = hmm.forward(chain, found)
    assert np.allclose(logs, [math.log(_likelihood(chain, d)) for d in found])


def test_expected_counts_follow_the_gradient():
    """Expected moves are the derivative of the log likelihood by the logarithm of a move's probability."""
    rng, chain = np.random.default_rng(6), _chain()
    found = [rng.integers(0, 5, n).astype(np.uint16) for n in (7, 4, 1)]
    start, moves, emits, log = hmm.expected_counts(chain, found)
    assert math.isclose(log, hmm.forward(chain, found).sum()) and math.isclose(start.sum(), 3, rel_tol=1e-5) and math.isclose(emits.sum(), 12, rel_tol=1e-5)
    for i in range(3):
        for j in range(3):
            up, down = chain.move.copy(), chain.move.copy()
            up[i, j] *= 1 + 1e-5
            down[i, j] *= 1 - 1e-5
            slope = (hmm.forward(hmm.Chain(chain.start, up, chain.emit), found).sum() - hmm.forward(hmm.Chain(chain.start, down, chain.emit), found).sum()) / 2e-5
            assert math.isclose(slope, moves[i, j], rel_tol=1e-3)


@pytest.mark.parametrize("head,symbols", [(1000, 8), (10, 4)])
def test_hmm_scores_match_brute_force(spark, head, symbols):
    rng = random.Random(10)
    rows = [(i, words(rng, rng.randrange(0, 9), most=30).title(), "en", "s") for i in range(80)] + odd_rows()
    out = hmm.score_hmm(docs(spark, rows), head=head, symbols=symbols, states=2).collect()
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + ["\0"]
    counts = Counter(w for i, t, *_ in rows if _fold("" if i is None else i, 7) != 2 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((len(w := tokens(t)), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6), _fold("" if i is None else i, 7) == 2) for i, t, *_ in rows)
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), r["held_out"]) for r in out) == want
    assert all(r["score"] < 0 for r in out)
    assert hmm.score_hmm(docs(spark, [])).count() == 0


def test_hmm_score_is_chain_times_shares_within_symbols(spark, monkeypatch):
    """Against a plain sum over states, word by word, with the trained model taken from the run."""
    rng, held = random.Random(12), {}
    scores = hmm._scores
    monkeypatch.setattr(hmm, "_scores", lambda rows, counts, lex, chain: (held.update(lex=lex, chain=chain), scores(rows, counts, lex, chain))[1])
    rows = [(i, words(rng, rng.randrange(0, 9), stem=rng.choice(["w", "v", "é"]), most=30), "en", "s") for i in range(60)] + odd_rows()
    out = hmm.score_hmm(docs(spark, rows), head=20, symbols=5, states=3, contexts=8).collect()
    lex, chain = held["lex"], held["chain"]
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    counts = Counter(w for i, t, *_ in rows if _fold("" if i is None else i, 7) != 2 for w in tokens(t))
    place = {}
    for w in {w for _, t, *_ in rows for w in tokens(t)}:
        raw = np.frombuffer(w.encode(), dtype=np.uint8)
        h, start, end, _ = word_hashes(raw, np.array([0, len(raw)]))
        at, known = lex.find(h.view(np.int64))
        place[w] = int(lex.symbol[at[0]]) if known[0] else int(hmm.group(raw, start, end)[0])
    tokens_of, distinct_of = Counter(), Counter()
    for w, c in counts.items():
        tokens_of[place[w]] += c
        distinct_of[place[w]] += 1
    want = []
    for i, t, *_ in rows:
        alpha, log = chain.start, 0.0
        for j, w in enumerate([*tokens(t), None]):
            s = lex.end if w is None else place[w]
            alpha = (alpha if j == 0 else alpha @ chain.move) * chain.emit[s]
            log += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
            if s < hmm.GROUPS:
                log += math.log10((counts[w] + 1) / (tokens_of[s] + distinct_of[s] + 1))
        want.append((repr(i), round(log, 4)))
    assert sorted((repr(r["id"]), round(r["score"], 4)) for r in out) == sorted(want)
    assert np.allclose(chain.emit.sum(0), 1) and np.allclose(chain.move.sum(1), 1)


def test_hmm_learns_what_goes_with_what(spark):
    """Texts of three vocabularies: held out, the chain must gain at least 0.25 a token over the unigram base."""
    rng = random.Random(13)
    rows = [(i, words(rng, rng.randrange(20, 60), stem=rng.choice(["aa", "bb", "cc"]), most=60), "en", "s") for i in range(400)]
    out = hmm.score_hmm(docs(spark, rows), states=4, symbols=100).where("held_out").collect()
    n = sum(r["n_tokens"] for r in out)
    assert sum(r["score"] - r["base_score"] for r in out) / n > 0.25


def test_hmm_probabilities_sum_to_one(spark):
    """One-word texts over all known words, and the word that stands for unknown ones, with the end after them."""
    rows = [(i, f"w{i % 9}" + (" v" if i % 2 else ""), "en", "s") for i in range(60)]
    train = [(i, t) for i, t, *_ in rows if _fold(i, 7) != 2]
    known = sorted({w for _, t in train for w in t.split()})
    # a text of length n: sum over all words of all texts of that length times the end is the chance of ending there
    probe = [(10_000 + 7 * k, w, "en", "s") for k, w in enumerate([*known, "unseen"])]
    probe = [(next(j for j in range(i, i + 500) if _fold(j, 7) == 2), *x) for i, *x in probe]
    out = hmm.score_hmm(docs(spark, rows + probe), head=6, symbols=3, states=2, iterations=3)
    got = {r["id"]: r["score"] for r in out.where(F.col("id") >= 10_000).collect()}
    ended = [10**got[i] for i, *_ in probe]
    empty = hmm.score_hmm(docs(spark, rows + [(next(j for j in range(10_000, 10_500) if _fold(j, 7) == 2), "", "en", "s")]), head=6, symbols=3, states=2, iterations=3)
    none = 10 ** empty.where(F.col("id") >= 10_000).first()["score"]
    assert 0 < none < 1 and 0 < sum(ended) < 1 and sum(ended) + none < 1

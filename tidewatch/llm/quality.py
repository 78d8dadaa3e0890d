"""Quality by co-training of two views of a document.

The text view reads the body: shares of hashed character trigrams, and how letters, symbols and words are used. The
metadata view knows the page from outside: source, language, the pair of both, stated length, and its layout and weight:
lines, length of a line, share of distinct lines, bytes against the stated length, and how far it compresses. Each view is
a table of log-odds learned from labelled rows; in every round each view labels those of all other documents that it is
surest of, and the other view learns from them too. Rounds are Spark jobs over all documents that hand on histograms of
scores and sums by feature. The views are calibrated and then combined on labelled rows that neither has learned from, and
score every document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, fold, stored
from .fitting import linear, logistic, sigmoid
from .wordhash import slices, words

#: Hashed trigrams; shares of the text's form and their steps.
GRAMS, FORMS, STEPS = 1024, 13, 16
#: Fields of metadata and their places in one table: hashed sources, languages and pairs of both, steps of what is measured.
FIELDS = {"source": 1 << 16, "lang": 1 << 12, "pair": 1 << 16, "length": 64, "lines": 64, "line": 64, "distinct": 32, "bytes": 64, "packed": 128}
_ENDS = np.cumsum(list(FIELDS.values()))
_AT = dict(zip(FIELDS, (_ENDS - list(FIELDS.values())).tolist(), strict=True))
META = int(_ENDS[-1])
#: Trigram counts are kept as steps of their logarithm, 12 to each factor of e: a byte holds counts up to a thousand million.
_FINE = 12
_LOG = (np.arange(256) / _FINE).astype(np.float32)
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"!#$%&*|<>{}[]=@^~_\\", dtype=np.uint8))
#: Steps of a score's histogram, from -12 to 12.
_BINS = 240


def _bin(logits: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((logits + 12) * (_BINS / 24)), 0, _BINS - 1).astype(np.int64)



def _sums(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of x between neighbouring positions."""
    up = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[at]
    return up[1:] - up[:-1]


def text_view(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts in UTF-8: steps of the logarithm of one and the count of each hashed trigram, and FORMS steps of 0 to STEPS - 1."""
    rows = len(offsets) - 1
    n = np.maximum(1, np.diff(offsets))
    grams = np.zeros((rows, GRAMS), dtype=np.uint8)
    if len(data) > 2:
        b = data.astype(np.uint32)
        h = ((b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)) >> np.uint32(22)
        row = np.repeat(np.arange(rows), np.diff(offsets))[:-2]
        inside = np.arange(len(h)) + 2 < offsets[1:][row]
        counts = np.bincount(row[inside] * GRAMS + h[inside], minlength=rows * GRAMS)
        grams[:] = np.floor(np.log1p(counts) * _FINE + 0.5).reshape(rows, GRAMS)
    h, starts, ends, first = words(data, offsets)
    m = np.maximum(1, np.diff(first))
    after = np.append(data[1:], 0) if len(data) else data
    # capital letters of ASCII and of the Latin-1 block
    upper = ((data >= 65) & (data <= 90)) | ((data == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97))
    lower = ((data >= 97) & (data <= 122)) | ((data == 0xC3) & (after >= 0x9F))
    up, low = (np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in (upper, lower))
    shout = (up[ends] - up[starts] > 1) & (low[ends] == low[starts])
    dirty = _SYMBOL[data[ends - 1]] if len(ends) else np.zeros(0, dtype=bool)
    again = np.zeros(len(h), dtype=bool)
    again[1:] = h[1:] == h[:-1]
    again[first[:-1][first[:-1] < len(h)]] = False
    distinct, most = np.zeros(rows), np.zeros(rows)
    for i in range(rows):
        if first[i + 1] > first[i]:
            times = np.unique(h[first[i] : first[i + 1]], return_counts=True)[1]
            distinct[i], most[i] = len(times), times.max()
    form = np.column_stack([
        _sums(upper, offsets) / n, _sums((data >= 48) & (data <= 57), offsets) / n, _sums(_SYMBOL[data], offsets) / n, _sums(data == 124, offsets) / m,
        _sums(dirty, first) / m, _sums(shout, first) / m, _sums(again, first) / m, distinct / m**0.9, most / m,
        _sums((data == 46) | (data == 63), offsets) / m, _sums(data >= 128, offsets) / n, np.diff(offsets) / m / 40, np.diff(first) == 0,
    ])
    return grams, np.ceil((STEPS - 1) * np.sqrt(np.clip(form, 0, 1))).astype(np.uint8)


def metadata_view(lang: Column, source: Column, length: Column) -> Column:
    """Places of the page's columns in the table of META log-odds; null is a value of its own. Values beyond the buckets
    share them."""
    value = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    place = lambda c, f: F.pmod(F.xxhash64(c), F.lit(FIELDS[f])).cast("int") + _AT[f]
    last = FIELDS["length"] - 1
    step = F.when(length.isNull(), last).otherwise(F.least(F.floor(F.log(F.greatest(length, F.lit(0)) + 1.0) * 3), F.lit(last - 1)))
    return F.array(place(value(source), "source"), place(value(lang), "lang"), place(F.concat(value(source), F.lit("|"), value(lang)), "pair"), step.cast("int") + _AT["length"])


def layout_view(raw: bytes, stated: int | None, pack) -> list[int]:
    """Places of a page's layout and weight: lines, bytes of a line, distinct lines, bytes against the stated length, and
    how far `pack` (a compressor) brings it down."""
    lines = raw.split(b"\n")
    n = max(1, len(raw))
    found = {
        "lines": math.log(len(lines)) * 6, "line": math.log(len(raw) / len(lines) + 1) * 5, "distinct": len(set(lines)) / len(lines) * 31,
        "bytes": 63 if not stated or stated < 0 else min(62, max(0, math.log(n / stated) * 20 + 20)), "packed": len(pack(raw)) / n * 100,
    }
    return [_AT[f] + min(FIELDS[f] - 1, int(x)) for f, x in found.items()]


def _views(docs: DataFrame) -> DataFrame:
    """(id, grams, form, meta) of (id, text, meta, length)."""

    def of(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            lengths, metas = b.column(3).to_pylist(), b.column(2).to_pylist()
            for lo, hi, data, offsets in slices(b.column(1)):
                grams, form = text_view(data, offsets)
                cols = [pa.array([x.tobytes() for x in v], pa.binary()) for v in (grams, form)]
                raw = data.tobytes()
                meta = [metas[lo + i] + layout_view(raw[offsets[i] : offsets[i + 1]], lengths[lo + i], pack) for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *cols, pa.array(meta, pa.list_(pa.int32()))], names=["id", "grams", "form", "meta"])

    return docs.select("id", "text", "meta", "length").mapInArrow(of, "id long, grams binary, form binary, meta array<int>")


#: Rows of both views: trigram counts, steps of form, places of metadata.
Rows = tuple[np.ndarray, np.ndarray, np.ndarray]


def _rows(b: pa.RecordBatch, most: int = 2048) -> Iterator[Rows]:
    for lo in range(0, len(b), most):
        grams, form = (np.frombuffer(b"".join(b.column(i).slice(lo, most).to_pylist()), dtype=np.uint8).reshape(-1, w) for i, w in ((1, GRAMS), (2, FORMS)))
        yield grams, form, np.array(b.column(3).slice(lo, most).to_pylist(), dtype=np.int64).reshape(-1, len(FIELDS))


def _shares(grams: np.ndarray) -> np.ndarray:
    x = _LOG[grams]
    return x / np.maximum(x.sum(1, keepdims=True), 1e-6)


def feature_sums(rows: Rows, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of either view, the rows' weighted sums by feature: trigram shares, then steps of form; places of metadata."""
    grams, form, meta = rows
    steps = np.bincount((form + np.arange(FORMS) * STEPS).ravel(), np.repeat(weight, FORMS), minlength=FORMS * STEPS)
    return np.concatenate([weight @ _shares(grams), steps]), np.bincount(meta.ravel(), np.repeat(weight, len(FIELDS)), minlength=META)


@dataclass
class Model:
    """Log-odds by feature and each view's calibration."""

    odds: tuple[np.ndarray, np.ndarray]
    scale: tuple[np.ndarray, np.ndarray]
    combine: np.ndarray

    def evidence(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        grams, form, meta = rows
        text, page = self.odds
        return np.column_stack([_shares(grams) @ text[:GRAMS], text[GRAMS:][form + np.arange(FORMS) * STEPS].sum(1)]), page[meta].sum(1)[:, None]

    def logits(self, rows: Rows) -> np.ndarray:
        """Columns: text view, metadata view."""
        return np.column_stack([np.clip(linear(e, s), -12, 12) for e, s in zip(self.evidence(rows), self.scale, strict=True)])

    def score(self, logits: np.ndarray) -> np.ndarray:
        return sigmoid(linear(logits, self.combine))


def _odds(sums: list[np.ndarray], size: int, smooth: float) -> np.ndarray:
    """Log-odds of class 1 against 0 by feature, from the classes' sums; `size` features compete for each unit."""
    share = [(s + smooth) / (s.sum() + smooth * size) for s in sums]
    return np.log(share[1] / share[0])


def fitted(sums: list[tuple[np.ndarray, np.ndarray]], rows: Rows, y: np.ndarray, weight: np.ndarray) -> Model:
    """A model of the classes' feature sums, whose views are calibrated on the rows given."""
    text = [s[0] for s in sums]
    odds = (
        np.concatenate([_odds([s[:GRAMS] for s in text], GRAMS, 0.01), *(_odds([s[GRAMS + i * STEPS : GRAMS + (i + 1) * STEPS] for s in text], STEPS, 0.5) for i in range(FORMS))]),
        np.concatenate([_odds([s[1][a:z] for s in sums], max(1, int(((sums[0][1] + sums[1][1])[a:z] > 0).sum())), 2.0) for a, z in zip(_AT.values(), _ENDS, strict=True)]),
    )
    plain = Model(odds, (), np.zeros(3))
    scale = tuple(logistic(e, y, weight, ridge=0.1) for e in plain.evidence(rows))
    return Model(odds, scale, np.zeros(3))


def _sure(counts: np.ndarray, share: float, likely: float, steps: np.ndarray, y: np.ndarray, weight: np.ndarray, most_wrong: float) -> tuple[int, int]:
    """(low, high): steps of the histogram from `high` on are the surest of class 1, those below `low` of class 0.

    They are up to `share` of the documents that belong to the class if a share of `likely` is of class 1 (the surest
    step at least), half of that, a quarter or an eighth, as the labelled rows in those steps allow: at most `most_wrong`
    of them (one row counts half wrong) may be of the other class. Else none are.
    """
    out = []
    for c, of, mine, at in ((0, 1 - likely, counts, steps), (1, likely, counts[::-1], _BINS - 1 - steps)):
        found = 0
        for part in (1, 2, 4, 8):
            n = int((np.cumsum(mine) - mine < share * of * counts.sum() / part).sum())
            inside = at < n
            wrong = (weight[inside & (y != c)].sum() + 0.5) / (weight[inside].sum() + 1)
            if wrong <= most_wrong:
                found = n
                break
        out.append(found)
    return out[0], _BINS - out[1]


def _totals(table: DataFrame, size: int, of) -> np.ndarray:
    """The sum over tasks of the vectors that `of` makes of their rows."""

    def add(batches):
        out = np.zeros(size)
        for b in batches:
            for rows in _rows(b):
                out += of(rows)
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out[some])], names=["i", "x"])

    sums = table.select("id", "grams", "form", "meta").mapInArrow(add, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas()
    out = np.zeros(size)
    out[sums["i"].to_numpy(dtype=int)] = sums["x"]
    return out


def co_train(free: DataFrame, rows: Rows, y: np.ndarray, weight: np.ndarray, folds: np.ndarray, rounds: int, share: float, most_wrong: float) -> tuple[Model, list[tuple[int, int]]]:
    """The combined model, and how many documents each round gave to the text view (by the metadata view) and to the metadata
    view (by the text view).

    Of the labelled rows fold 0 combines, fold 1 calibrates and the others teach. `free` has the rows of all documents
    without a label here. What one view gives to the other weighs at most as much as the labelled rows of the class.
    """
    learn, scale, both = folds > 1, folds == 1, folds == 0
    part = lambda s: tuple(v[s] for v in rows)
    own = [feature_sums(part(learn & (y == c)), weight[learn & (y == c)]) for c in (0, 1)]
    mass = [float(weight[learn & (y == c)].sum()) for c in (0, 1)]
    likely = float(weight[y == 1].sum() / weight.sum())
    make = lambda sums: fitted(sums, part(scale), y[scale], weight[scale])
    model, history, wide = make(own), [], GRAMS + FORMS * STEPS
    for _ in range(rounds):
        held = free.sparkSession.sparkContext.broadcast(model)

        def histogram(some: Rows, held=held) -> np.ndarray:
            return np.concatenate([np.bincount(a, minlength=_BINS) for a in _bin(held.value.logits(some)).T]).astype(float)

        counts = _totals(free, 2 * _BINS, histogram)
        steps = _bin(model.logits(part(scale)))
        cuts = [_sure(counts[v * _BINS : (v + 1) * _BINS], share, likely, steps[:, v], y[scale], weight[scale], most_wrong) for v in (0, 1)]

        def given(some: Rows, held=held, cuts=cuts) -> np.ndarray:
            """Sums by class for the text view, from what the metadata view is sure of, then the other way round; counts."""
            z, out, n = _bin(held.value.logits(some)), [], []
            for v in (0, 1):
                low, high = cuts[1 - v]
                for mine in (z[:, 1 - v] < low, z[:, 1 - v] >= high):
                    out.append(feature_sums(some, mine.astype(float))[v])
                    n.append(mine.sum())
            return np.concatenate([*out, n])

        sums = _totals(free, 2 * wide + 2 * META + 4, given)
        n = sums[-4:].reshape(2, 2)
        history.append((int(n[0].sum()), int(n[1].sum())))
        if not n.any():
            break
        text, page = sums[: 2 * wide].reshape(2, wide), sums[2 * wide : -4].reshape(2, META)
        worth = [[min(0.5, mass[c] / max(1.0, n[v][c])) for c in (0, 1)] for v in (0, 1)]
        model = make([(own[c][0] + worth[0][c] * text[c], own[c][1] + worth[1][c] * page[c]) for c in (0, 1)])
    model.combine = logistic(model.logits(part(both)), y[both], weight[both], ridge=0.1)
    return model, history


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    length_col: str = "n_chars",
    label_col: str = "quality",
    examples: int = 4000,
    rounds: int = 3,
    share: float = 0.2,
    most_wrong: float = 0.06,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per document: id, score (probability of quality 1), text_score, metadata_score, keep (score >= threshold).

    Labels are learned from at most `examples` labelled documents of each class, the first in hash order; every other
    document takes part in all rounds of co-training. Folds of crc32(id) mod 5 of the labelled ones: 0 combines the views,
    1 calibrates them, the others teach. Null texts count as empty, null languages, sources and lengths as values of their
    own. Without labels of both classes in all three parts every score is the share of quality 1 (1 without any label) and
    nothing is learned. Repeated rows, with or without a label, count and are scored each time; an empty table gives no rows.
    Texts may have any length. What each round exchanged is in the result's `exchanged` (pairs as `co_train` has them).
    """
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(length_col).cast("long").alias("length"), metadata_view(F.col(lang_col), F.col(source_col), F.col(length_col)).alias("meta"))
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and id is not null")
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    picked = bounded_sample(known, "y", "id", examples, "quality").select("id", "y")
    views = stored(_views(d).join(F.broadcast(picked), "id", "left"), "quality-views")
    # of an id's rows one teaches; at most twice `examples` rows reach the driver
    own = views.where("y is not null").groupBy("id").agg(F.min(F.struct("grams", "form", "meta", "y")).alias("v")).select("id", "v.*", fold("id", 5).alias("f")).orderBy("id").toArrow()
    y, folds = (own.column(c).to_numpy().astype(float) for c in ("y", "f"))
    total = sum(counts.values())
    if not all(len(set(y[s])) == 2 for s in (folds == 0, folds == 1, folds > 1)):
        p = counts.get(1, 0) / total if total else 1.0
        return d.select("id", F.lit(p).alias("score"), F.lit(p).alias("text_score"), F.lit(p).alias("metadata_score"), F.lit(p >= threshold).alias("keep"))
    weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum()) * len(y) / total
    rows = tuple(np.concatenate(v) for v in zip(*(r for b in own.to_batches() for r in _rows(b)), strict=True))
    model, history = co_train(views.where("y is null"), rows, y, weight, folds, rounds, share, most_wrong)
    held = views.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for b in batches:
            z = np.concatenate([np.zeros((0, 2)), *(held.value.logits(r) for r in _rows(b))])
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in (held.value.score(z), sigmoid(z[:, 0]), sigmoid(z[:, 1])))], names=["id", "score", "text_score", "metadata_score"])

    out = views.select("id", "grams", "form", "meta").mapInArrow(scored, "id long, score double, text_score double, metadata_score double")
    out = out.withColumn("keep", F.col("score") >= threshold)
    out.exchanged = history
    return out

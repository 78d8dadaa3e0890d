"""Language by compression: each language has a zstandard compressor with a raw-content dictionary of its own texts;
a text belongs to the language that encodes it in the fewest bytes. Where the runner-up is close, the text is encoded
again with more effort, and if it is still close it is rejected.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, fold


class CompressionModel:
    """Compressors are made where they are used, since they don't travel between processes."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 6, again: int = 12, close: float = 0.03, piece: int = 2048):
        self.dictionaries, self.level, self.again, self.close, self.piece = dict(sorted(dictionaries.items())), level, again, close, piece
        self._ready: dict[int, list] = {}

    def __getstate__(self):
        return {**self.__dict__, "_ready": {}}

    def _compressors(self, level: int) -> list:
        if level not in self._ready:
            dicts = [zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for d in self.dictionaries.values()]
            for d in dicts:
                d.precompute_compress(level=level)
            self._ready[level] = [zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_dict_id=False) for d in dicts]
        return self._ready[level]

    def sizes(self, text: str, level: int) -> np.ndarray:
        """Bytes of the whole text under each language; it is encoded in pieces, so that the dictionary keeps counting."""
        raw = text.lower().encode("utf-8", "surrogatepass")
        pieces = [raw[i : i + self.piece] for i in range(0, len(raw), self.piece)]
        return np.array([sum(len(c.compress(p)) for p in pieces) for c in self._compressors(level)], dtype=float)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language (`und` without a letter or a learned language), score from 0 to 1, and margin: bytes saved per byte
        against the runner-up."""
        if not text or not self.dictionaries or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0
        langs = list(self.dictionaries)
        if len(langs) == 1:
            return langs[0], 1.0, 1.0
        for level in (self.level, self.again):
            sizes = self.sizes(text, level)
            order = np.argsort(sizes, kind="stable")
            best = sizes[order[0]]
            margin = float((sizes[order[1]] - best) / sizes[order[1]])
            if margin >= self.close:
                break
        odds = np.exp(-60.0 * (sizes - best) / np.maximum(sizes, 1))
        return langs[order[0]], float(1 / odds.sum()), margin


def fit_language(docs: DataFrame, id_col: str, text_col: str, lang_col: str, texts_per_lang: int = 400, dictionary_bytes: int = 96 * 1024, level: int = 6, piece: int = 384, pieces: int = 16) -> CompressionModel:
    """Dictionaries from at most `texts_per_lang` texts of each language, the first in hash order. A text of any length
    gives up to `pieces` pieces of `piece` characters, spread evenly over it; the dictionary takes one piece of each text
    in turn until it is full, the first ones last (its end is the cheapest to refer to). Languages must be few."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("lang").isNotNull() & (F.length("text") > 0))
    ids = bounded_sample(d.select("id", "lang"), "lang", "id", texts_per_lang, "language")
    n = F.length("text")
    k = F.least(F.lit(pieces), F.ceil(n / piece)).cast("int")
    # every (n / k)-th character begins a piece, which ends before the next one
    cut = F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.substring("text", (F.floor(i * n / k) + 1).cast("int"), F.least(F.lit(piece), F.floor(n / k) + 1).cast("int")))
    turns: dict[str, dict[int, list[str]]] = {}
    # of rows that repeat an id one text teaches
    for r in d.join(F.broadcast(ids.select("id").distinct()), "id").groupBy("lang", "id").agg(F.min(cut).alias("cut")).collect():
        for i, x in enumerate(r["cut"]):
            turns.setdefault(r["lang"], {}).setdefault(i, []).append(x.lower())
    out = {}
    for lang, by_turn in turns.items():
        held, size = [], 0
        for i in sorted(by_turn):
            for x in sorted(by_turn[i]):
                raw = x.encode("utf-8", "surrogatepass") + b"\n"
                if size + len(raw) <= dictionary_bytes:
                    held.append(raw)
                    size += len(raw)
        out[lang] = b"".join(reversed(held))
    return CompressionModel({k: v for k, v in out.items() if len(v) >= 8}, level)


def identify_language(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    held_out_mod: int = 3,
    held_out: int = 1,
    narrow: float = 0.004,
    **fit,
) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score, margin, rejected (margin under `narrow`).

    Learns from rows with a language outside the held-out fold of crc32(id). Null texts and texts without a letter are
    `und` with score 0 and rejected; a rejected text keeps its nearest language in lang_pred. Of equal sizes the first
    language by code point wins. Repeated rows are scored each time; an empty table gives no rows, one without any
    language only `und`. No shuffle: whole texts are scored where they are read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_language(docs.where(fold(id_col, held_out_mod) != held_out), id_col, text_col, lang_col, **fit))

    def of(batches):
        for b in batches:
            out = [model.value.predict(t) for t in b.column(1).to_pylist()]
            cols = [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["id", "lang_pred", "score", "margin"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = d.mapInArrow(of, "id long, lang_pred string, score double, margin double")
    return out.select("id", (fold("id", held_out_mod) == held_out).alias("held_out"), "lang_pred", "score", "margin", (F.col("margin") < narrow).alias("rejected"))

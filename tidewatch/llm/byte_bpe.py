"""Byte-level BPE encoding and decoding by recursive DuckDB queries in each partition.

A task cuts its texts into pieces, as the split pattern does, and encodes each distinct piece once. Its pieces are rows
(piece, position, token) of a DuckDB table, one row for each byte to begin with. A recursive query joins neighbours with
the merge table and contracts every piece's leftmost pair of least rank until none is left. Pieces already encoded are
kept in a table of bounded size, which later tasks of the same worker find again. A text's ids are then those of its
pieces in order, and an ordered aggregate over the ids' bytes decodes them.

Nothing is shuffled: a text's ids depend on the text and the ranks alone.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordhash import spans

#: Fixed value: the pattern that `cuts` follows. Contractions, words, numbers and other runs with a space before them, white space.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Letters and numbers of Unicode versions later than the one that the public encoder's classes have; there they are neither.
LATER_LETTERS = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1
16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81
1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""  # fmt: skip
LATER_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"

#: Every round joins each piece's neighbours with the merge table and contracts the leftmost pair of least rank.
ENCODE = """
WITH RECURSIVE step(w, toks, done) AS (
    SELECT w, list(tok ORDER BY pos), false FROM start GROUP BY w
    UNION ALL
    (WITH pairs AS (SELECT w, unnest(toks) AS tok, unnest(toks[2:]) AS nxt, generate_subscripts(toks, 1) AS i FROM step WHERE NOT done),
    best AS (SELECT p.w, min(CAST(m.rank AS BIGINT) * 65536 + p.i) AS key FROM pairs p JOIN merges m ON m.a = p.tok AND m.b = p.nxt GROUP BY p.w)
    SELECT s.w, CASE WHEN b.key IS NULL THEN s.toks
                     ELSE list_concat(s.toks[:(b.key & 65535) - 1], [CAST(b.key >> 16 AS INTEGER)], s.toks[(b.key & 65535) + 2:]) END, b.key IS NULL
    FROM (SELECT * FROM step WHERE NOT done) s LEFT JOIN best b ON s.w = b.w)
)
SELECT f.h AS w, s.toks AS ids FROM step s JOIN fresh f ON f.i = s.w WHERE s.done
"""

#: The same for long pieces, which would need as many rounds as they have merges: later places of the least rank are
#: contracted in the same round, from left to right and without overlap, unless one of them would make a pair of lower
#: rank (`early`), which had to come first: then the leftmost goes alone.
ENCODE_LONG = """
WITH RECURSIVE step(w, pos, tok, done) AS (
    SELECT w, pos, tok, false FROM start
    UNION ALL
    (WITH pairs AS (
        SELECT w, pos, tok, lead(tok) OVER s AS nxt, lead(tok, 2) OVER s AS nxt2, lag(tok) OVER s AS prv, row_number() OVER s AS i
        FROM step WHERE NOT done WINDOW s AS (PARTITION BY w ORDER BY pos)),
    ranked AS (SELECT p.*, m.rank FROM pairs p LEFT JOIN merges m ON m.a = p.tok AND m.b = p.nxt),
    least AS (SELECT w, min(rank) AS best FROM ranked GROUP BY w),
    hits AS (
        SELECT r.w, r.i, r.prv, r.nxt2, r.rank AS best, r.i - row_number() OVER (PARTITION BY r.w ORDER BY r.i) AS run
        FROM ranked r JOIN least l ON r.w = l.w AND r.rank = l.best),
    apart AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY i) AS nth FROM hits) WHERE nth % 2 = 1),
    sides AS (SELECT *, CASE WHEN lag(i) OVER s = i - 2 THEN best ELSE prv END AS before, min(i) OVER (PARTITION BY w) AS first FROM apart WINDOW s AS (PARTITION BY w ORDER BY i)),
    alone AS (
        SELECT DISTINCT s.w FROM sides s LEFT JOIN early x ON x.a = s.before AND x.b = s.best LEFT JOIN early y ON y.a = s.best AND y.b = s.nxt2
        WHERE x.rank < s.best OR y.rank < s.best),
    chosen AS (SELECT s.w, s.i, s.best FROM sides s LEFT JOIN alone o ON o.w = s.w WHERE o.w IS NULL OR s.i = s.first)
    SELECT r.w, r.pos, coalesce(c.best, r.tok), l.best IS NULL
    FROM ranked r JOIN least l ON l.w = r.w LEFT JOIN chosen c ON c.w = r.w AND c.i = r.i LEFT JOIN chosen g ON g.w = r.w AND g.i = r.i - 1
    WHERE g.i IS NULL)
)
SELECT f.h AS w, list(s.tok ORDER BY s.pos) AS ids FROM step s JOIN fresh f ON f.i = s.w WHERE s.done GROUP BY f.h
"""

#: The ids of each text in order, and the bytes that the ids stand for; both aggregates take the rows in the order of `o`.
DECODE = """
SELECT d, list(tok) AS ids, unhex(string_agg(hex, '')) AS body
FROM (SELECT t.d, t.tok, v.hex
      FROM (SELECT d, unnest(k.ids) AS tok, p * 4294967296 + generate_subscripts(k.ids, 1) AS o FROM known k JOIN pieces USING (w)) t JOIN vocab v ON v.tok = t.tok
      ORDER BY t.o)
GROUP BY d
"""

#: Pieces of more bytes than this are encoded by ENCODE_LONG.
LONG = 128


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of byte strings from lines of base64 and rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(path).read_bytes().splitlines() if line)}


@functools.cache
def classes() -> np.ndarray:
    """0 for white space, 1 for letters, 2 for numbers, 3 for all else, by code point."""
    import regex

    out = np.full(0x110000, 3, dtype=np.uint8)
    points = np.concatenate([np.arange(0xD800, dtype=np.uint32), np.arange(0xE000, 0x110000, dtype=np.uint32)])
    every = points.tobytes().decode("utf-32-le")
    for value, pattern in ((0, r"\s+"), (1, r"\p{L}+"), (2, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            out[points[m.start() : m.end()]] = value
    for span in (LATER_LETTERS + LATER_NUMBERS).split():
        first, _, last = span.partition("-")
        out[int(first, 16) : int(last or first, 16) + 1] = 3
    return out


def cuts(points: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin in code points, of which `texts` are the first of each text (no empty ones)."""
    n = len(points)
    kind = classes()[points]
    begins, fresh = np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=bool)
    begins[1:n] = kind[1:] != kind[:-1]
    fresh[texts] = begins[texts] = True
    begins[n] = fresh[n] = True
    first = np.flatnonzero(begins)
    first, end = first[:-1], first[1:]
    # the last of white space before something else goes with that if it is a space, and stands alone if it is another
    space = end[(kind[first] == 0) & ~fresh[end]]
    begins[space - 1] = True
    begins[space[points[space - 1] == 0x20]] = False
    # an apostrophe on its own takes one or two letters with it
    mark = first[(points[first] == 0x27) & (end == first + 1) & begins[first] & ~fresh[end]]
    a, b = points[mark + 1], points[np.minimum(mark + 2, n - 1)]
    two = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((b == ord("l")) & (a == ord("l")))
    two &= ~fresh[np.minimum(mark + 2, n)]
    one = (a == ord("s")) | (a == ord("t")) | (a == ord("m")) | (a == ord("d"))
    begins[mark[one | two] + 1] = False
    begins[mark[one] + 2] = True
    begins[mark[two] + 3] = True
    return np.flatnonzero(begins[:n])


def portions(texts: list[str], most: int) -> Iterator[tuple[list[int], list[str]]]:
    """Rows and texts of about `most` characters in all. A longer text is cut where white space follows something else."""
    import regex

    rows, held, size = [], [], 0
    for row, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > most - size:
                m = regex.search(r"\S(?=\s)", text, pos=at + most - size)
                end = m.end() if m else end
            rows.append(row)
            held.append(text[at:end])
            size += end - at
            at = end
            if size >= most:
                yield rows, held
                rows, held, size = [], [], 0
    if held:
        yield rows, held


class Coder:
    """A DuckDB session with the ranks, and the pieces that it has encoded."""

    def __init__(self, ranks: dict[bytes, int], most_known: int = 1_000_000):
        self.ranks, self.most_known = ranks, most_known
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        split = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.pairs = pa.table(dict(zip(("a", "b", "rank"), (pa.array(c, pa.int32()) for c in zip(*split, strict=True)), strict=True)))
        self.vocab = pa.table({"tok": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]})
        self.open()

    def open(self) -> None:
        """A new session that knows no piece. Plans stay as written, the right side of a join hashed: they are no slower,
        and some that DuckDB 2.0's optimiser makes fail (an internal check of dictionary columns in joins)."""
        import duckdb

        self.con, self.n_known = duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""}), 0
        self.con.execute("PRAGMA disable_optimizer")
        self.con.register("pairs", self.pairs)
        self.con.register("texts", self.vocab)
        self.con.execute("CREATE TABLE merges AS FROM pairs")
        self.con.execute("CREATE TABLE early AS FROM merges WHERE rank < greatest(a, b)")
        self.con.execute("CREATE TABLE vocab AS FROM texts")
        self.con.execute("CREATE TABLE known (w BIGINT, ids INTEGER[])")

    def learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Encodes pieces that aren't known yet. A piece that has a rank itself is that one token."""
        whole = [(h, [self.ranks[p]]) for h, p in zip(hashes.tolist(), pieces, strict=True) if p in self.ranks]
        rest = [(h, p) for h, p in zip(hashes.tolist(), pieces, strict=True) if p not in self.ranks]
        if whole:
            self._insert("SELECT * FROM given", given=pa.table({"w": pa.array([h for h, _ in whole], pa.int64()), "ids": pa.array([i for _, i in whole], pa.list_(pa.int32()))}))
        for query, some in ((ENCODE, [x for x in rest if len(x[1]) <= LONG]), (ENCODE_LONG, [x for x in rest if len(x[1]) > LONG])):
            if some:
                size = np.array([len(p) for _, p in some])
                ends = np.cumsum(size)
                start = pa.table({
                    "w": np.repeat(np.arange(len(some), dtype=np.int32), size),
                    "pos": (np.arange(ends[-1]) - np.repeat(ends - size, size)).astype(np.int32),
                    "tok": self.byte[np.frombuffer(b"".join(p for _, p in some), dtype=np.uint8)],
                })
                self._insert(query, start=start, fresh=pa.table({"i": np.arange(len(some), dtype=np.int32), "h": pa.array([h for h, _ in some], pa.int64())}))
        self.n_known += len(pieces)

    def _insert(self, query: str, **tables: pa.Table) -> None:
        for name, t in tables.items():
            self.con.register(name, t)
        self.con.execute(f"INSERT INTO known {query}")
        for name in tables:
            self.con.unregister(name)

    def code(self, texts: list[str]) -> list[tuple[np.ndarray, bytes]]:
        """(ids, decoded bytes) of each text; none is empty."""
        out = self._tried(texts)
        for i, t in enumerate(texts):
            if out[i][1] != t.encode():  # two pieces of one hash: encode that text with no other piece known
                self.forget()
                out[i] = self._tried([t])[0]
        return out

    def _tried(self, texts: list[str]) -> list[tuple[np.ndarray, bytes]]:
        """An internal failure ends DuckDB's session; a new one, which knows nothing, tries once more."""
        import duckdb

        try:
            return self._code(texts)
        except (duckdb.InternalException, duckdb.FatalException):
            self.open()
            return self._code(texts)

    def forget(self) -> None:
        self.con.execute("DELETE FROM known")
        self.n_known = 0

    def _code(self, texts: list[str]) -> list[tuple[np.ndarray, bytes]]:
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
        first = np.cumsum([0] + [len(t) for t in texts])
        begin = cuts(points, first[:-1])
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        at = np.append((np.cumsum(width) - width)[begin], len(data))
        hashes = spans(data, at[:-1], at[1:]).view(np.int64)
        distinct, where = np.unique(hashes, return_index=True)
        if self.n_known + len(distinct) > self.most_known:
            self.forget()
        self.con.register("asked", pa.table({"w": distinct, "n": where}))
        new = self.con.sql("SELECT a.w, a.n FROM asked a ANTI JOIN (SELECT k.w FROM known k JOIN asked b ON k.w = b.w) h ON a.w = h.w").to_arrow_table()
        self.con.unregister("asked")
        self.learn(new["w"].to_numpy(), [data[at[i] : at[i + 1]].tobytes() for i in new["n"].to_numpy()])
        of = (np.searchsorted(first, begin, "right") - 1).astype(np.int32)
        self.con.register("pieces", pa.table({"d": of, "p": np.arange(len(begin), dtype=np.int64), "w": hashes}))
        got = self.con.sql(DECODE).to_arrow_table().combine_chunks()
        self.con.unregister("pieces")
        lists, bodies, order = got["ids"].combine_chunks(), got["body"], np.argsort(got["d"].to_numpy())
        ids, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        return [(ids[offsets[i] : offsets[i + 1]], bodies[int(i)].as_py()) for i in order]


@functools.lru_cache(maxsize=2)
def _coder(lines: bytes) -> Coder:
    return Coder({base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines())})


def code_documents(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text", keep: bool = True, most: int = 1 << 20) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256 (of little-endian unsigned 32-bit ids), decoded_sha256; with `keep`
    also the ids and the decoded text themselves.

    The ranks (a public vocabulary, whose size does not depend on the data) are broadcast. A null text counts as empty,
    an empty one has no ids; ids may repeat or be null, other columns are ignored, an empty table gives no rows. Texts
    of any length are coded in portions of about `most` characters, cut only where the pattern cuts too. What was decoded
    is held against the text, so two pieces of one hash can't go unseen.
    """
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep
    held = docs.sparkSession.sparkContext.broadcast(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items()))

    def code(batches):
        coder = _coder(held.value)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            sums = [(hashlib.sha256(), hashlib.sha256()) for _ in texts]
            counts, ids, bodies = [0] * len(texts), [[] for _ in texts], [[] for _ in texts]
            for rows, held_texts in portions(texts, most):
                for row, (got, body) in zip(rows, coder.code(held_texts), strict=True):
                    sums[row][0].update(got.astype("<u4").tobytes())
                    sums[row][1].update(body)
                    counts[row] += len(got)
                    if keep:
                        ids[row].append(got)
                        bodies[row].append(body)
            columns = [b.column(0), pa.array(counts, pa.int64()), pa.array([s.hexdigest() for s, _ in sums]), pa.array([s.hexdigest() for _, s in sums])]
            if keep:
                columns += [pa.array([np.concatenate([np.zeros(0, np.int32), *i]) for i in ids], pa.list_(pa.int32())), pa.array([b"".join(x).decode() for x in bodies])]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(code, schema)

"""Repair of a conversation's structure by secondary-sorted streaming.

Rows are partitioned by conversation and sorted by turn; one pass in each partition carries, from one Arrow batch to the
next, the state of a dynamic program over four states of the roles seen so far (`MOVES`). For every state it holds the
cost of the cheapest edits that end there, the order of these edits' initials, and a running hash of the repaired text,
so neither rows nor texts are kept. What is kept is four bytes for each row, which say how each state was reached. A
giant conversation's are spilled as rows of a table in the shared folder, `spill_rows` at a time, and a second pass from
its last piece to its first reads its edits back; all others are finished in the first pass.

One conversation is one stream, as the hash of its repaired text is one, but memory does not grow with it. What a row
has to know of all earlier ones (was this role and text seen?) comes from an aggregate and a join by conversation and
digest, not from a set of texts in the task.
"""

from __future__ import annotations

import functools
import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Nothing yet, after a system row, after a user row, after an assistant row (there a conversation may end, or at 0).
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a row of an initial leads, and the role that an insertion or a new role has.
MOVES = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: How many insertions end a conversation that stands there.
ENDING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
DELETE, KEEP, REROLE = range(3)
COST = {DELETE: 3, KEEP: 0, REROLE: 2}
INSERT_COST, TRUNCATED_COST = 2, 1
_FAR = 1 << 40
_SPACE = " \t\n\v\f\r"

_FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_STREAM = "key string, chunk long, ways binary, final int, " + ", ".join(f"{c} long" for c in _FIGURES) + ", audit string, repaired_sha256 string"


def inserted(state: int, n: int) -> tuple[int, list[str]]:
    """The state after n insertions, and their roles."""
    roles = []
    for _ in range(n):
        role, state = NEXT[state]
        roles.append(role)
    return state, roles


@functools.cache
def step(costs: tuple[int, ...], order: tuple[int, ...], initial: str, must_go: bool, truncated: bool):
    """Costs less the least one, order of the states' edits, that least cost and each state's way here, for one row.

    A way is (state before, insertions, edit) in one byte, or None where a state can't be reached. Edits of equal cost
    are compared by their initials. All end with a row's edit, so none begins another, and the order of what came
    before decides unless both come from one state.
    """
    best: list = [None] * 4
    for state in range(4):
        if costs[state] >= _FAR:
            continue
        for n in range(3):
            here, _ = inserted(state, n)
            ways = [(DELETE, here)]
            if not must_go:
                ways += [(KEEP, MOVES[here][initial])] if initial in MOVES[here] else []
                ways.append((REROLE, NEXT[here][1]))
            for edit, to in ways:
                cost = costs[state] + INSERT_COST * n + COST[edit] + TRUNCATED_COST * (truncated and edit != DELETE)
                found = (cost, order[state], "I" * n + "DKR"[edit], state | n << 2 | edit << 4)
                if best[to] is None or found < best[to]:
                    best[to] = found
    least = min(b[0] for b in best if b)
    ranks = {b[1:3]: i for i, b in enumerate(sorted((b for b in best if b), key=lambda b: b[1:3]))}
    return (
        tuple(b[0] - least if b else _FAR for b in best),
        tuple(ranks[b[1:3]] if b else 9 for b in best),
        least,
        tuple(b[3] if b else None for b in best),
    )


def read_back(ways: bytes, state: int) -> tuple[str, int]:
    """The initials of the edits that lead to `state` over these rows, and the state before them."""
    out = []
    for at in range(len(ways) - 4, -4, -4):
        way = ways[at + state]
        state = way & 3
        out.append("I" * (way >> 2 & 3) + "DKR"[way >> 4])
    return "".join(reversed(out)), state


class _Stream:
    """One conversation, row by row."""

    def __init__(self, key):
        self.key, self.ways, self.chunk = key, bytearray(), 0
        self.costs, self.order, self.spent = (0, _FAR, _FAR, _FAR), (0, 9, 9, 9), 0
        self.hashes = [hashlib.sha256(), None, None, None]
        self.turns, self.first, self.last, self.turn, self.before = 0, None, None, None, None
        self.initial, self.figures, self.repeats = None, dict.fromkeys(_FIGURES, 0), set()

    def at(self, turn) -> None:
        """Rows and marks of one turn follow each other; what was marked for an earlier one is over."""
        if turn != self.turn:
            self.turn, self.repeats, self.before = turn, set(), None

    def count(self, turn) -> None:
        if turn is not None and (self.first is None or turn != self.last):
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first

    def row(self, role: str, text: str, digest) -> None:
        self.count(self.turn)
        body, fault = text.rstrip(_SPACE), None
        if not body:
            fault = "blank"
        elif digest in self.repeats or digest == self.before:
            fault = "duplicate"
        elif body[-1] not in ".!?":
            fault = "truncated"
        self.before = digest
        if fault:
            self.figures[fault] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.figures["illegal"] += 1
        self.initial = initial
        kind = initial if initial in ("s", "u", "a") else ""
        self.costs, self.order, least, ways = step(self.costs, self.order, kind, fault in ("blank", "duplicate"), fault == "truncated")
        self.spent += least
        self.hashes = [None if w is None else self._hash(w, role, text) for w in ways]
        self.ways += bytes(w or 0 for w in ways)

    def _hash(self, way: int, role: str, text: str):
        state, n, edit = way & 3, way >> 2 & 3, way >> 4
        here, roles = inserted(state, n)
        lines = [f"{r}:" for r in roles]
        if edit == KEEP:
            lines.append(f"{role}:{text}")
        elif edit == REROLE:
            lines.append(f"{NEXT[here][0]}:{text}")
        return self._added(state, lines)

    def _added(self, state: int, lines: list[str]):
        out = self.hashes[state].copy()
        for i, line in enumerate(lines):
            out.update((("\n" if state != START or i else "") + line).encode())
        return out

    def spill(self) -> dict:
        """The ways so far as a row; they are read back by the second pass."""
        out = {"key": self.key, "chunk": self.chunk, "ways": bytes(self.ways), "final": 0, **dict.fromkeys(_FIGURES, 0)}
        self.chunk, self.ways = self.chunk + 1, bytearray()
        return out

    def over(self) -> list[dict]:
        """What is left to say when the last row has passed."""
        last = self.result()
        return [self.spill(), last] if self.chunk else [last]

    def result(self) -> dict:
        ends = [(self.costs[s] + INSERT_COST * ENDING[s], self.order[s], s) for s in range(4) if self.costs[s] < _FAR]
        cost, _, state = min(ends)
        if self.turns:
            self.figures["gaps"] = min(self.last - self.first + 1 - self.turns, 2**63 - 1)
        self.figures["cost"] = self.spent + cost
        out = {"key": self.key, "chunk": -1, "final": state, **self.figures}
        out["repaired_sha256"] = self._added(state, [f"{r}:" for r in inserted(state, ENDING[state])[1]]).hexdigest()
        if not self.chunk:
            out["audit"] = read_back(bytes(self.ways), state)[0] + "I" * ENDING[state]
        return out


def _rows(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    held = [F.col(conv_col).cast("string").alias("key"), F.col(turn_col).cast("long").alias("turn")]
    return conversations.select(*held, *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))))


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """key (null for a null conversation), turn, role, text and gone, by crc32(`conv_id:turn`) % 20; nulls count as one space.

    0 drops a row (it stays here with `gone`), 1 empties its text, 2 removes its [.!?], 3 repeats it, 4 makes it a user's.
    """
    key = F.concat(F.coalesce("key", F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = _rows(conversations, conv_col, turn_col, role_col, text_col).withColumn("kind", F.crc32(key) % 20)
    rows = rows.withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
    twice = rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return twice.select("key", "turn", "role", "text", (F.col("kind") == 0).alias("gone"))


def _digest() -> Column:
    return F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)


def _repeats(rows: DataFrame) -> DataFrame:
    """(key, turn, digest) of rows whose role and text an earlier turn of the conversation has. Blank rows don't matter."""
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    small = rows.where("not gone").where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select("key", "turn", when.alias("when"), _digest().alias("digest"))
    first = small.groupBy("key", "digest").agg(F.min("when").alias("first"), F.max("when").alias("last")).where("first < last")
    first = first.select(F.col("key").alias("k"), F.col("digest").alias("d"), "first")
    return small.join(first, F.col("key").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d"))).where(F.col("when") > F.col("first")).select("key", "turn", "digest")


def repair_conversations(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    damaged: bool = True,
    spill_rows: int = 1 << 18,
) -> DataFrame:
    """One row per conversation: its id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    With `damaged` the rows are damaged first (see `damage`), else they are taken as they are. Rows go by turn, null
    turns first, rows of one turn by role and text. A null conversation is one of its own, null roles and texts count as
    one space; a role is known by its first letter and any other than s, u and a must be changed or go. A row that
    repeats an earlier role and text is a duplicate, of equal rows of one turn all but one. A conversation without rows
    has zeros, an empty audit and the hash of nothing; an empty table gives no rows; other columns are ignored. Texts
    may have any length, conversations any number of rows.
    """
    columns = (conv_col, turn_col, role_col, text_col)
    rows = damage(conversations, *columns) if damaged else _rows(conversations, *columns).withColumn("gone", F.lit(False))
    none = F.lit(None).cast("string")
    stays = [F.when(~F.col("gone"), F.col(c)).alias(c) for c in ("role", "text")]
    events = rows.select("key", "turn", F.when(F.col("gone"), 0).otherwise(2).alias("kind"), *stays, _digest().alias("digest"))
    events = events.unionByName(_repeats(rows).select("key", "turn", F.lit(1).alias("kind"), none.alias("role"), none.alias("text"), "digest"))
    # longs with nulls would reach pandas as doubles
    events = events.select("key", F.col("turn").cast("string").alias("turn"), "kind", "role", "text", "digest", F.col("turn").alias("at"))
    events = events.repartition("key").sortWithinPartitions("key", F.col("at").asc_nulls_first(), "kind", "role", "text").drop("at")

    def stream(batches):
        now, out = None, []
        for b in batches:
            for key, turn, kind, role, text, digest in b.itertuples(index=False, name=None):
                key = key if isinstance(key, str) else None
                if now is None or key != now.key:
                    if now:
                        out += now.over()
                    now = _Stream(key)
                if kind == 0:
                    continue
                now.at(int(turn) if isinstance(turn, str) else None)
                if kind == 1:
                    now.repeats.add(digest)
                    continue
                now.row(role, text, digest)
                full = len(now.ways) >= 4 * spill_rows
                if full:
                    out.append(now.spill())
                if full or len(out) >= 1024:
                    yield _frame(out)
                    out = []
        yield _frame(out + (now.over() if now else []))

    passed = stored(events.mapInPandas(stream, _STREAM), "conversations")
    whole = passed.where("chunk = -1 AND audit IS NOT NULL")
    giant = passed.where("chunk >= 0 OR audit IS NULL").repartition("key").sortWithinPartitions("key", F.when(F.col("chunk") < 0, F.lit(1 << 62)).otherwise(F.col("chunk")).desc())

    def back(batches):
        head, state, parts = None, 0, []
        for b in batches:
            for r in b.to_dict("records"):
                if r["chunk"] < 0:
                    if head:
                        yield _frame([head | {"audit": "".join(reversed(parts))}])
                    head, state, parts = r, int(r["final"]), ["I" * ENDING[int(r["final"])]]
                else:
                    part, state = read_back(r["ways"], state)
                    parts.append(part)
        if head:
            yield _frame([head | {"audit": "".join(reversed(parts))}])

    kept = [F.col("key").cast(conversations.schema[conv_col].dataType).alias(conv_col), *_FIGURES, "audit", "repaired_sha256"]
    return whole.unionByName(giant.mapInPandas(back, _STREAM)).select(kept)


def _frame(rows: list[dict]) -> pd.DataFrame:
    whole = {"chunk", "final", *_FIGURES}
    names = [f.split()[0] for f in _STREAM.split(", ")]
    return pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype="Int64" if n in whole else object) for n in names})

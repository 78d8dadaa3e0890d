"""Conversation repair against all edits of small conversations, and spilled conversations against unspilled ones."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidewatch.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, key string, ways int, audit string, at int"
TEXTS = ["yes.", "no", "", " \t", "Why?", "so\nit is.", "yes. ", None]


def _table(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "z", 2) for r in rows], SCHEMA)


def _conversations(seed, n, most=4, roles=("system", "user", "assistant", "assistant", "user", "tool", None, "")):
    rng = random.Random(seed)
    return [(c, rng.choice([None, *range(5)]), rng.choice(roles), rng.choice(TEXTS)) for c in range(n) for _ in range(rng.randrange(1, most + 1))]


def _damaged(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        out[c]
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out[c] += [(t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def _expected(rows):
    """Of all edits and insertions those that give a legal order of roles, the cheapest, of these the least initials."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    figures, seen, options = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0), set(), []
    for i, (_, role, text) in enumerate(rows):
        body = text.strip(" \t\n\v\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            figures[fault] += 1
        if i and rows[i - 1][1][:1] + role[:1] not in ("su", "ua", "au"):
            figures["illegal"] += 1
        cut = int(fault == "truncated")
        stay = [] if fault in ("blank", "duplicate") else [("K", f"{role}:{text}", role[:1], cut), ("R", f"user:{text}", "u", 2 + cut), ("R", f"assistant:{text}", "a", 2 + cut)]
        options.append([("D", None, "", 3), *stay])
    best = None
    gaps = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for edits in itertools.product(*options):
        for more in itertools.product(gaps, repeat=len(rows) + 1):
            cost = sum(e[3] for e in edits) + 2 * sum(map(len, more))
            if best and cost > best[0]:
                continue
            order, audit, lines = "", "", []
            for put, edit in itertools.zip_longest(more, edits):
                audit += "I" * len(put) + (edit[0] if edit else "")
                order += "".join(r[0] for r in put) + (edit[2] or "?" if edit and edit[1] is not None else "")
                lines += [f"{r}:" for r in put] + ([edit[1]] if edit and edit[1] is not None else [])
            if re.fullmatch("(s?(ua)+)?", order) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(lines))
    turns = [t for t, *_ in rows if t is not None]
    gap = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gap, figures["blank"], figures["duplicate"], figures["truncated"], figures["illegal"], best[0], best[1], hashlib.sha256(best[2].encode()).hexdigest()


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_against_all_edits(spark):
    rows = _conversations(4, 120, most=3)
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "x")]
    want = {c: _expected(r) for c, r in _damaged(rows).items()}
    got = conversations.repair_conversations(_table(spark, rows)).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == want[r["conv_id"]], (r, [x for x in rows if x[0] == r["conv_id"]])


def test_undamaged_rows_and_repeats(spark):
    """Ties, repeated rows of one turn and of later turns, and a text that a null turn has first."""
    rows = [(1, None, "user", "a."), (1, 3, "assistant", "b."), (1, 3, "assistant", "b."), (1, 9, "user", "a."), (1, 9, "user", "c."), (2, 5, "user", "same."), (2, 5, "user", "same."), (2, 6, "user", "same."), (3, 2**62, "user", "x."), (3, -(2**62), "assistant", "y.")]
    by = defaultdict(list)
    for c, *r in rows:
        by[c].append(tuple(r))
    for r in conversations.repair_conversations(_table(spark, rows), damaged=False).collect():
        want = _expected(by[r["conv_id"]])
        assert tuple(r[c] for c in COLUMNS) == (min(want[0], 2**63 - 1), *want[1:])


@pytest.mark.parametrize("spill_rows", [1, 7, 50])
def test_spilled_conversations_are_the_same(spark, spill_rows):
    rows = [(c, t, random.Random(c * 1000 + t).choice(["user", "assistant", "system"]), f"{'x' * (t % 5)} {t % 40}{'.' * (t % 3)}") for c in range(3) for t in range(300 // (c + 1))]
    t = _table(spark, rows)
    assert sorted(conversations.repair_conversations(t).collect()) == sorted(conversations.repair_conversations(t, spill_rows=spill_rows).collect())


def test_empty_and_dropped(spark):
    assert conversations.repair_conversations(_table(spark, [])).count() == 0
    gone = next((c, t) for c in range(100) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    (r,) = conversations.repair_conversations(_table(spark, [(*gone, "user", "Hi.")])).collect()
    assert tuple(r[c] for c in COLUMNS) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_words_as_ids(spark):
    t = spark.createDataFrame([("c", 1, "user", "Hi."), ("c", 2, "assistant", "Yes.")], "c string, n int, who string, said string")
    (r,) = conversations.repair_conversations(t, "c", "n", "who", "said", damaged=False).collect()
    assert r["c"] == "c" and r["audit"] == "KK" and r["repaired_sha256"] == hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest()

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tidewatch.llm.exact_dedup import exact_dedup
from tidewatch.llm.mixing import mix_sources
from tidewatch.llm.packing import pack, pack_documents

from .helpers import docs, odd_rows, words


def _brute_dedup(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for ids in groups.values():
        ids.sort(key=lambda i: (i is None, i))
        out += [(i, ids[0], len(ids), j == 0) for j, i in enumerate(ids)]
    return sorted(out, key=repr)


def _found(df):
    return sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()), key=repr)


def test_exact_dedup_matches_brute_force(spark):
    assert _found(exact_dedup(docs(spark, odd_rows()))) == _brute_dedup(odd_rows())


def test_small_memtables_and_colliding_digests(spark):
    """With digests of one letter most hits differ in bytes, and every class must still come out right."""
    rng = random.Random(1)
    rows = [(i, f"text {rng.randrange(40)}", "en", "s") for i in range(300)]
    got = exact_dedup(docs(spark, rows), memtable_rows=16, digest=lambda t: F.substring(F.sha2(t.cast("binary"), 256), 1, 1))
    assert _found(got) == _brute_dedup(rows)
    assert _found(exact_dedup(docs(spark, rows).repartition(7), memtable_rows=3)) == _brute_dedup(rows)


def test_colliding_digests_of_repeated_ids_lose_no_row(spark):
    one = lambda t: F.substring(F.sha2(F.lit("x"), 256), 1, 4)
    rows = [(1, "aa", "en", "s"), (1, "bb", "en", "s"), (2, "aa", "en", "s"), (3, "cc", "en", "s"), (None, "cc", "en", "s"), (None, "dd", "en", "s"), (None, None, "en", "s")]
    assert _found(exact_dedup(docs(spark, rows), digest=one)) == _brute_dedup(rows)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup(docs(spark, [])).count() == 0


def _brute_targets(sizes, weights, repeats):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > repeats * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed |= {s: repeats * sizes[s] for s in over}


def test_mix_reaches_targets(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randrange(1, 60)), "en", rng.choice("aaaaaabcd")) for i in range(1500)] + [(i, words(rng, 5), "en", None) for i in range(1500, 1520)]
    got = [r.asDict() for r in mix_sources(docs(spark, rows), bucket_rows=100).collect()]
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
    want = _brute_targets(dict(sizes), (5, 2, 1), 3)
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60
    assert sum(taken.values()) <= sum(sizes.values())
    again = {(r["id"], r["taken"]) for r in mix_sources(docs(spark, rows).repartition(5), bucket_rows=37).collect()}
    assert again == {(r["id"], r["taken"]) for r in got}


def test_mix_of_odd_rows(spark):
    got = mix_sources(docs(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows())
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mix_sources(docs(spark, [])).count() == 0
    assert [r["taken"] for r in mix_sources(docs(spark, [(1, "", "en", "a"), (2, None, "en", "b")])).collect()] == [0, 0]


def test_pack_downsizes_and_fits():
    where, at, lengths = pack([1000, 600, 500, 400, 300, 30], (512, 1024, 2048), 16)
    used = defaultdict(int)
    for b, a, s in sorted(zip(where, at, [1000, 600, 500, 400, 300, 30], strict=True)):
        assert a == used[b]
        used[b] += s
    assert all(used[b] <= lengths[b] and lengths[b] in (512, 1024, 2048) for b in used)
    assert pack([10], (512, 1024, 2048), 16)[2] == [512]


def _brute_best_fit(sizes, caps, cost, opening):
    """Bins by a plain scan for the least room that is enough, the oldest of equals."""
    bins = []
    for j, s in enumerate(sizes):
        fit = [(room, i) for i, (room, _) in enumerate(bins) if room >= s]
        if fit:
            room, i = min(fit)
            bins[i] = (room - s, bins[i][1] + s)
        else:
            hold = s + max(0, sum(sizes[j + 1 :]) - sum(room for room, _ in bins))
            own = min((c for c in caps if c >= s), key=lambda c: ((c + cost) / min(c, hold), -c))
            bins.append(((max(opening, min(c for c in caps if c >= s)) if opening else own) - s, s))
    return [min(c for c in caps if c >= used) for _, used in bins]


def test_pack_matches_a_plain_scan():
    rng = random.Random(3)
    caps = (64, 128, 256)
    for _ in range(30):
        sizes = sorted((rng.randrange(1, 256) for _ in range(80)), reverse=True)
        lengths = pack(sizes, caps, 4)[2]
        best = min((_brute_best_fit(sizes, caps, 4, c) for c in (None, *caps)), key=lambda x: sum(x) + 4 * len(x))
        assert sum(lengths) + 4 * len(lengths) == sum(best) + 4 * len(best)


def test_pack_documents_keeps_every_word(spark):
    rows = odd_rows()
    got = pack_documents(docs(spark, rows), shard_pieces=8).collect()
    n = {i: len((t or "").split()) for i, t, *_ in rows}
    total = defaultdict(int)
    bins = defaultdict(list)
    for r in got:
        total[r["id"]] += r["size"]
        if r["size"]:
            bins[r["bin"]].append(r)
        else:
            assert r["bin"] is None and r["capacity"] == 0
    for i in (1, 4, 5, 8, 9, 10):
        assert total[i] == n[i]
    assert total[7] == 2 * n[7]
    for rows_ in bins.values():
        rows_.sort(key=lambda r: r["at"])
        assert [r["at"] for r in rows_] == [sum(x["size"] for x in rows_[:i]) for i in range(len(rows_))]
        assert sum(r["size"] for r in rows_) <= rows_[0]["capacity"]
    assert pack_documents(docs(spark, [])).count() == 0


def test_bins_of_repeated_long_rows_do_not_overlap(spark):
    long, longer = words(random.Random(4), 2500), words(random.Random(6), 5000)
    rows = [(1, long, "en", "a")] * 3 + [(1, longer, "en", "a")] * 2 + [(None, long, "en", "a")] * 2
    got = pack_documents(docs(spark, rows), shard_pieces=4).collect()
    assert sum(r["size"] for r in got) == 5 * 2500 + 2 * 5000
    bins = defaultdict(list)
    for r in got:
        bins[r["bin"]].append((r["at"], r["at"] + r["size"], r["capacity"]))
    for spans in bins.values():
        spans.sort()
        assert spans[-1][1] <= spans[0][2]
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))

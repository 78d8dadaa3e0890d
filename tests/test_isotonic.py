"""Isotonic regression in ranges against a plain pooling."""

import random

import numpy as np
import pytest

from tidewatch.functions.isotonic import interpolated, isotonic_knots, pooled


def _plain(points):
    """Fit at each distinct x by pooling values one by one."""
    xs = sorted({x for x, *_ in points})
    fit = [[sum(y * w for p, y, w in points if p == x), sum(w for p, _, w in points if p == x), [x]] for x in xs]
    i = 0
    while i + 1 < len(fit):
        if fit[i][0] / fit[i][1] >= fit[i + 1][0] / fit[i + 1][1]:
            fit[i] = [fit[i][0] + fit[i + 1][0], fit[i][1] + fit[i + 1][1], fit[i][2] + fit[i + 1][2]]
            del fit[i + 1]
            i = max(0, i - 1)
        else:
            i += 1
    return {x: t / w for t, w, block in fit for x in block}


def _blocks(points):
    return [(sum(y * w for p, y, w in points if p == x), sum(w for p, _, w in points if p == x), x, x) for x in sorted({p for p, *_ in points})]


def test_ranges_pooled_apart_and_together():
    """A thousand tables with ties and weights, cut anywhere: pooled ranges pool to what all values pool to."""
    for seed in range(1000):
        rng = random.Random(seed)
        points = [(rng.randrange(12), rng.randrange(3), rng.choice([1, 2, 5])) for _ in range(rng.randrange(1, 25))]
        blocks = _blocks(points)
        cuts = [0, *sorted(rng.sample(range(len(blocks) + 1), rng.randrange(0, min(4, len(blocks)) + 1))), len(blocks)]
        got = pooled([tuple(b) for lo, hi in zip(cuts, cuts[1:]) for b in pooled(blocks[lo:hi])])
        want = _plain(points)
        for t, w, first, last in got:
            assert all(v == pytest.approx(t / w) for x, v in want.items() if first <= x <= last)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fit_over_partitions(spark, seed):
    rng = random.Random(seed)
    points = [(round(rng.random(), 2), int(rng.random() < 0.5), rng.choice([1.0, 2.0, 0.0])) for _ in range(500)]
    d = spark.createDataFrame([(*p,) for p in points] + [(None, 1, 1.0), (0.5, None, 1.0)], "x double, y int, w double").repartition(7)
    want = _plain([p for p in points if p[2]])
    knots = isotonic_knots(d, "x", "y", "w")
    rows = knots.orderBy("k").collect()
    assert [r["k"] for r in rows] == list(range(len(rows))) and all(r["value"] == pytest.approx(want[r["x"]]) for r in rows)
    asked = [-1.0, 2.0, 0.0, 1.0, None, *(rng.random() for _ in range(60)), *(x for x, *_ in points[:40])]
    got = interpolated(spark.createDataFrame([(i, x) for i, x in enumerate(asked)], "i int, s double"), "s", knots, "fit").collect()
    xs = sorted(want)
    assert len(got) == len(asked)
    for r in got:
        assert r["fit"] is None if r["s"] is None else r["fit"] == pytest.approx(float(np.interp(r["s"], xs, [want[x] for x in xs])))


def test_no_rows(spark):
    d = spark.createDataFrame([], "x double, y int")
    assert isotonic_knots(d, "x", "y").count() == 0

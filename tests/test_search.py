"""Adaptive search against seeded draws, on a surface whose optimum is known."""

import math
import random

import pytest

from tidewatch.operators.search import best_of, draw, successive_halving

SPACE = {"rate": (0.01, 0.2, "log"), "depth": (3, 6, "int"), "share": (0.7, 1.0, "float"), "leaf": (10, 100, "int")}
BEST = {"rate": 0.05, "depth": 5, "share": 0.85, "leaf": 40}


def _far(params):
    return math.hypot(math.log(params["rate"] / BEST["rate"]) / 3, (params["depth"] - 5) / 3, (params["share"] - 0.85) / 0.3, (params["leaf"] - 40) / 90)


def _value(params, budget):
    """Higher near the planted optimum; small budgets blur it."""
    noise = random.Random(repr(sorted(params.items()))).gauss(0, 0.1) * (1 - budget)
    return 1 - _far(params) + noise


def test_finds_a_planted_optimum_more_often_than_draws_of_the_same_cost():
    found = drawn = 0
    for seed in range(60):
        trials = successive_halving(_value, SPACE, 50, seed=seed, parallel=1)
        cost = sum(t.budget for t in trials)
        rng = random.Random(1000 + seed)
        plain = min((draw(SPACE, rng) for _ in range(math.ceil(cost))), key=_far)
        found += _far(best_of(trials).params) < 0.15
        drawn += _far(plain) < 0.15
    assert found > 1.5 * max(1, drawn) and found > 20, (found, drawn)


def test_states_budgets_and_ranges():
    trials = successive_halving(_value, SPACE, 18, seed=3)
    by = {}
    for t in trials:
        by.setdefault(round(t.budget, 6), []).append(t)
        assert all(low <= t.params[k] <= high for k, (low, high, _) in SPACE.items()) and isinstance(t.params["depth"], int)
    assert [len(by[b]) for b in sorted(by)] == [18, 6, 2] and [t.number for t in trials] == list(range(26))
    assert {t.state for t in by[1.0]} == {"complete"} and best_of(trials).budget == 1
    assert [t.params for t in successive_halving(_value, SPACE, 18, seed=3)] == [t.params for t in trials]


def test_failing_fits_are_out():
    def sometimes(params, budget):
        if params["depth"] == 5:
            raise ValueError("no")
        return _value(params, budget)

    trials = successive_halving(sometimes, SPACE, 12, seed=1)
    assert {t.state for t in trials if t.params["depth"] == 5} == {"failed"} and best_of(trials).params["depth"] != 5
    none = successive_halving(lambda p, b: 1 / 0, SPACE, 6)
    assert best_of(none) is None and {t.state for t in none} == {"failed"}


@pytest.mark.parametrize("trials", [1, 2, 4])
def test_few_trials(trials):
    got = successive_halving(_value, SPACE, trials)
    assert best_of(got) is not None and sum(t.budget == got[0].budget for t in got) >= trials

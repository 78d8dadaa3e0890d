"""Adaptive search of model settings: many draws with a small budget, fewer and fewer with more of it."""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

#: Ranges of settings: least, greatest, and whether whole numbers (int), a logarithmic scale (log) or a plain one (float).
Space = dict[str, tuple[float, float, str]]


@dataclass
class Trial:
    number: int
    params: dict
    budget: float
    value: float | None
    state: str  # complete, stopped (others of its rung did better) or failed


def draw(space: Space, rng: random.Random, near: dict | None = None, width: float = 0.15) -> dict:
    """Settings from the whole space, or about `near` by a share of each range."""
    out = {}
    for name, (low, high, kind) in space.items():
        a, b = (math.log(low), math.log(high)) if kind == "log" else (low, high)
        if near is None:
            x = rng.uniform(a, b)
        else:
            at = math.log(near[name]) if kind == "log" else near[name]
            x = min(b, max(a, rng.gauss(at, width * (b - a))))
        out[name] = math.exp(x) if kind == "log" else int(round(x)) if kind == "int" else x
    return out


def successive_halving(objective: Callable[[dict, float], float], space: Space, trials: int, seed: int = 42, keep: int = 3, parallel: int = 4, fresh: float = 0.5) -> list[Trial]:
    """All trials, by number. `objective(params, budget)` is to be made large; budget 1 is a whole fit.

    Half of the settings are drawn from the whole space. The rest are drawn about the best so far, which makes the search
    adaptive, and both are tried with a small budget; of every rung the best 1 / keep go on with `keep` times the budget, until
    a whole one. Fits of a rung run side by side. Ties go to the earlier trial; a fit that fails is out.
    """
    rng, done = random.Random(seed), []
    rungs = max(1, round(math.log(max(1, trials), keep)))
    budget = float(keep) ** -(rungs - 1)

    def run(batch: list[dict], budget: float) -> list[Trial]:
        def one(params: dict) -> tuple[float | None, str]:
            try:
                return objective(params, budget), "stopped"
            except Exception:  # noqa: BLE001  a setting that can't be fitted is no candidate
                return None, "failed"

        with ThreadPoolExecutor(parallel) as pool:
            got = [Trial(len(done) + i, p, budget, v, s) for i, (p, (v, s)) in enumerate(zip(batch, pool.map(one, batch), strict=True))]
        done.extend(got)
        return got

    order = lambda t: (-(t.value if t.value is not None else -math.inf), t.number)
    first = run([draw(space, rng) for _ in range(max(1, math.ceil(trials * fresh)))], budget)
    best = sorted((t for t in first if t.value is not None), key=order)[:keep]
    rung = first + run([draw(space, rng, rng.choice(best).params) for _ in range(trials - len(first))], budget) if best else first
    while budget < 1:
        budget = min(1.0, budget * keep)
        going = sorted((t for t in rung if t.value is not None), key=order)[: max(1, len(rung) // keep)]
        if not going:
            break
        rung = run([t.params for t in going], budget)
    for t in rung:
        if t.value is not None:
            t.state = "complete"
    return done


def best_of(trials: list[Trial]) -> Trial | None:
    """The best whole fit, the earlier of equal ones."""
    whole = [t for t in trials if t.state == "complete"]
    return min(whole, key=lambda t: (-t.value, t.number)) if whole else None

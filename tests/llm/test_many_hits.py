"""Texts with very many hits take time in proportion."""

import random
import time

from kinora.llm import licenses


def brute_suppress(found):
    """Every detection against every other one."""
    order = sorted(enumerate(found), key=lambda x: (-x[1][2].priority, x[1][0] - x[1][1], x[0]))
    kept = []
    for _, (start, end, rule) in order:
        if not any(s <= start and end <= e for s, e, *_ in kept):
            kept.append((start, end, rule.label, rule.confidence))
    return sorted(kept)


def test_suppression_sweep_equals_all_against_all():
    rng = random.Random(1)
    rules = [licenses.Rule(f"l{i}", "x", ["x"], i % 4, i / 10) for i in range(9)]
    for _ in range(600):
        found = []
        for _ in range(rng.randrange(25)):
            start = rng.randrange(20)
            found.append((start, start + rng.randrange(1, 9), rng.choice(rules)))
        assert licenses.suppress(found) == brute_suppress(found)


def test_fifty_thousand_license_notices_in_one_text():
    scanner, unit = licenses.Scanner(), "Licensed under the MIT license. "
    took = {}
    for n in (5_000, 50_000):
        start = time.perf_counter()
        words, places, kept = scanner.scan(unit * n)
        took[n] = time.perf_counter() - start
        assert words == 5 * n and len(places) == n and len(kept) >= n and {k[2] for k in kept} == {"mit"}
    assert took[50_000] < 40 * took[5_000] + 1

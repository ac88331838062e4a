"""Acceptance of outcomes: boundary cases, and the fold against a walk event by event."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from partura.operators import outcomes as oc
from partura.operators import timeline as tl
from partura.plans.pipeline import study
from partura.rules import Rules
from partura.sources.lookups import Lookups
from tests.clinic import DAY_0, clinic
from tests.walk import walk

# name: events, accepted (day, category)
CASES = {
    "live births 181 days apart": (
        [(0, "LB"), (180, "LB"), (181, "LB")], {(0, "LB"), (181, "LB")},
    ),
    "stillbirth 168 after": ([(0, "LB"), (168, "SB")], {(0, "LB")}),
    "stillbirth 169 after": ([(0, "LB"), (169, "SB")], {(0, "LB"), (169, "SB")}),
    "stillbirth 180 before": ([(180, "LB"), (0, "SB")], {(180, "LB")}),
    "stillbirth 181 before": ([(181, "LB"), (0, "SB")], {(181, "LB"), (0, "SB")}),
    "active same day": ([(0, "SB"), (0, "AGP")], {(0, "SB")}),
    "active next day": ([(0, "SB"), (1, "AGP")], set()),
    "active day 42": ([(0, "SB"), (42, "AGP")], set()),
    "active day 43": ([(0, "SB"), (43, "AGP")], {(0, "SB")}),
    "ectopic alone": ([(0, "ECT")], set()),
    "ectopic with surgery 2": ([(0, "ECT"), (10, "ECT_SURG2")], {(0, "ECT")}),
    "ectopic moved 10": ([(0, "ECT"), (10, "MTX")], {(10, "ECT")}),
    "ectopic moved 14": ([(0, "ECT"), (14, "MTX")], {(14, "ECT")}),
    "ectopic treated late": ([(0, "ECT"), (15, "MTX")], set()),
    "loss moved": ([(0, "AB"), (14, "SA")], {(14, "AB")}),
    "loss moved along a chain": ([(0, "AB"), (10, "AB"), (20, "SA")], {(10, "AB")}),
    "equal losses, one moves": ([(0, "AB"), (0, "AB"), (10, "SA")], {(10, "AB")}),
    "trophoblastic only": ([(0, "TRO"), (9, "TRO")], set()),
}


def test_boundaries(spark):
    people = {name: i for i, name in enumerate(CASES, 1)}
    events = [(people[n], d, c) for n, (rows, _) in CASES.items() for d, c in rows]
    s = study(clinic(spark, events))
    found = defaultdict(set)
    for row in oc.valid_outcomes(s.settled, s.lookups, s.rules).collect():
        found[row.person_id].add(((row.event_date - DAY_0).days, row.category))
    assert {n: found[i] for n, i in people.items()} == {n: want for n, (_, want) in CASES.items()}


def random_people(seed: int, people: int, events: int, days: int) -> dict[int, list]:
    rng = random.Random(seed)
    kinds = ["LB", "SB", "ECT", "AB", "SA", "DELIV", "AB", "SA", "ECT",
             "AGP", "PCONF", "ECT_SURG1", "ECT_SURG2", "MTX", "LMP"]
    return {
        p: [(rng.randrange(days), rng.choice(kinds)) for _ in range(rng.randrange(1, events))]
        for p in range(1, people + 1)
    }


@pytest.mark.parametrize("seed,events,days", [(1, 40, 120), (2, 60, 700), (3, 25, 2000)])
def test_fold_equals_walk(spark, seed, events, days):
    people = random_people(seed, 120, events, days)
    # One person holds a third of all rows.
    total = sum(map(len, people.values()))
    people[999] = random_people(seed + 100, 1, 2, days)[1] + [
        e for p in random_people(seed + 200, 200, events, days).values() for e in p
    ][: total // 2]
    s = study(clinic(spark, [(p, d, c) for p, rows in people.items() for d, c in rows]))

    accepted, settled = defaultdict(set), defaultdict(dict)
    for row in oc.valid_outcomes(s.outcome_people, s.lookups, s.rules).collect():
        accepted[row.person_id].add(row.event_id)
    for row in tl.event_timeline(s.settled).collect():
        settled[row.person_id][row.event_id] = (row.event_date - DAY_0).days
    for p, rows in people.items():
        want_accepted, want_days, _ = walk(rows)
        assert accepted[p] == want_accepted, p
        assert settled[p] == want_days, p


def test_lookups_are_checked():
    targets = Rules().targets
    gaps = dict(Lookups().min_days)
    assert not Lookups(min_days=gaps).check(targets).can_share_day(Rules())
    assert Lookups(min_days=gaps | {("SB", "AB"): 1}).check(targets).can_share_day(Rules())
    del gaps["AB", "SB"]
    assert Lookups(min_days=gaps).check(targets).can_share_day(Rules())
    with pytest.raises(ValueError):
        Lookups(terms={**Lookups().terms, "SA": (139, 28, 0)}).check(targets)
    with pytest.raises(ValueError):
        Rules(ovul2_join="other")

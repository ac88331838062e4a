"""Passes, decisions and date moves of the outcome steps against a walk event by event, under any
rules and gap tables."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from dataclasses import replace

import pytest

from partura import build_episodes
from partura.operators import outcomes as oc
from partura.operators import timeline as tl
from partura.plans.pipeline import study
from partura.rules import STEPS, Rules
from partura.sources.lookups import Lookups
from tests.clinic import DAY_0, clinic, day
from tests.test_outcomes import random_people
from tests.walk import walk


def changed(**steps) -> tuple:
    return tuple(replace(s, **steps.get(s.target, {})) for s in STEPS)


RULES = {
    "published": Rules(),
    "confirmed by a type that moved": Rules(
        steps=changed(DELIV={"confirmed_by": ("AB", "MTX")}, SA={"confirmed_by": ("AB",)})
    ),
    "active types that move": Rules(active_categories=("AGP", "SA", "AB"), rule_out_days=20),
    "moved by a type moved before": Rules(
        steps=changed(
            SB={"moved_by": ("ECT", "SB"), "confirmed_by": ("SB", "PCONF")},
            ECT={"moved_by": ("SB",)},
            DELIV={"moved_by": ("ECT", "AB", "DELIV"), "rule_out": False},
        ),
        active_categories=("AGP", "DELIV"),
        revision_days=30,
    ),
    "other order": Rules(steps=tuple(STEPS[i] for i in (0, 4, 3, 5, 1, 2))),
}


def without_some(seed: int) -> Lookups:
    rng = random.Random(seed)
    gaps = {p: d for p, d in Lookups().min_days.items() if rng.random() < 0.75}
    return Lookups(min_days=gaps | {p: 1 for p in rng.sample(sorted(gaps), 3)})


GAPS = {"published": Lookups(), "some missing": without_some(4), "others missing": without_some(9)}
COMBINED = [(r, "published") for r in RULES] + [("published", g) for g in list(GAPS)[1:]]
COMBINED += [("moved by a type moved before", "some missing")]


@pytest.mark.parametrize("rules,gaps", COMBINED)
def test_passes_equal_walk(spark, rules, gaps):
    rules, lookups = RULES[rules], GAPS[gaps]
    people = random_people(11, 80, 40, 300) | {500: random_people(12, 1, 900, 400)[1]}
    people |= {600 + p: rows for p, rows in random_people(13, 40, 60, 1200).items()}
    s = study(clinic(spark, [(p, d, c) for p, rows in people.items() for d, c in rows]), lookups, rules)

    for shared in (s.settled, s.picked, s.pool_passes):
        shared.persist()
    found: dict[str, set] = defaultdict(set)

    def add(name, rows):
        rows = [tuple(r) for r in rows.collect()]
        assert len(rows) == len(set(rows)), name
        found[name] |= set(rows)

    add("accepted", oc.valid_outcomes(s.outcome_people, lookups, rules).select("person_id", "event_id"))
    add("days", tl.event_timeline(s.settled).select("person_id", "event_id", "event_date"))
    add("pools", oc.event_pools(s.settled, lookups, rules).select("target", "person_id", "event_id"))
    add("next", oc.next_outcomes(s.picked))
    add("prior", oc.prior_flags(s.picked, rules))
    add("conflicts", oc.gap_conflicts(s.picked))
    add("good", oc.acceptances(s.picked))
    add("decisions", oc.decisions(s.picked))
    add("removed", oc.removed_by_gap(s.pool_passes, rules))
    add("left", oc.remaining_pools(s.pool_passes))

    want: dict[str, set] = defaultdict(set)
    first = {step.target: step for step in rules.steps}
    for p, rows in people.items():
        accepted, days, passes = walk(rows, lookups, rules)
        want["accepted"] |= {(p, i) for i in accepted}
        want["days"] |= {(p, i, day(d)) for i, d in days.items()}
        when = {one["event"]: one["day"] for one in passes}
        turn = Counter()
        for one in passes:
            target, now = one["target"], one["event"]
            turn[target] += 1
            key = (target, turn[target], p, now)
            if turn[target] == 1:
                want["pools"] |= {(target, p, i) for i in one["left"] | one["gone"]}
            want["next"].add(key)
            want["left"] |= {(target, turn[target], p, i) for i in one["left"]}
            if one["good"]:
                want["good"].add(key)
            refuted = one["active"][0][1] if one["active"] and first[target].rule_out else None
            confirmed = one["confirming"][0] if one["confirming"] else None
            against = one["against"][0] if one["against"] else None
            want["decisions"].add((*key, day(one["day"]), one["good"], against, refuted, confirmed))
            if first[target].forward_only:
                want["removed"] |= {(target, turn[target], p, i) for i in one["gone"]}
            else:
                want["prior"] |= {(*key, o, int(when[o] <= one["day"])) for o in one["accepted"]}
                want["conflicts"] |= {(*key, o) for o in one["against"]}
    for name in found.keys() | want.keys():
        assert found[name] == want[name], name


def test_outcomes_on_one_day(spark):
    """Without the gaps of (LB, SB) both are accepted; each keeps the prior outcome of an earlier day,
    and one episode is made per day."""
    gaps = {p: d for p, d in Lookups().min_days.items() if set(p) != {"LB", "SB"}}
    events = [(1, 0, "LB"), (1, 0, "SB"), (1, 700, "LB"), (1, 700, "SB"), (1, 450, "LMP")]
    events += [(2, 0, "SB"), (2, 0, "LMP")]
    done = build_episodes(clinic(spark, events), Lookups(min_days=gaps))
    rows = sorted((r.person_id, (r.event_date - DAY_0).days, r.category) for r in done.valid_outcomes.collect())
    assert rows == [(1, 0, "LB"), (1, 0, "SB"), (1, 700, "LB"), (1, 700, "SB"), (2, 0, "SB")]
    episodes = sorted(
        ((r.episode_end_date - DAY_0).days, (r.episode_start_date - DAY_0).days, r.start_method, r.original_outcome)
        for r in done.episodes.filter("person_id = 1").collect()
    )
    assert [e[0] for e in episodes] == [0, 700] and episodes[1][1:] == (450, "LMP", "LB")
    s = study(clinic(spark, events), Lookups(min_days=gaps))
    priors = {(r.day, r.category): (r.prior_day, r.prior_category) for r in s.outcome_rows.filter("person_id = 1").collect()}
    first = min(d for d, _ in priors)
    assert priors == {
        (first, "LB"): (None, None), (first, "SB"): (None, None),
        (first + 700, "LB"): (first, "SB"), (first + 700, "SB"): (first, "SB"),
    }

"""Outcome selection done the long way: one event of one person at a time, in plain Python."""

from __future__ import annotations

from partura.rules import Rules
from partura.sources.lookups import Lookups


def walk(
    events: list[tuple[int, str]], lookups: Lookups | None = None, rules: Rules | None = None
) -> tuple[set[int], dict[int, int], list[dict]]:
    """Accepted event numbers and final days of one person's ``(day, category)`` events, and what
    each pass saw: its target, event, pool before and after, and grounds for refusal."""
    lookups, rules = lookups or Lookups(), rules or Rules()
    numbered = sorted(events)
    days = {i: d for i, (d, _) in enumerate(numbered, 1)}
    kinds = {i: c for i, (_, c) in enumerate(numbered, 1)}
    gaps = lookups.min_days
    accepted: list[int] = []
    passes: list[dict] = []
    for step in rules.steps:
        in_pool = {c for pair in gaps for c in pair} | set(step.pool_extra)
        groups = {}
        for i in sorted(days, reverse=True):
            if kinds[i] in in_pool:
                groups[kinds[i], days[i]] = i
        pool = set(groups.values())
        while waiting := [i for i in pool if kinds[i] == step.target]:
            now = min(waiting, key=lambda i: (days[i], i))
            seen = {"target": step.target, "event": now, "accepted": list(accepted)}
            if step.forward_only:
                accepted.append(now)
                gone = {
                    i for i in pool
                    if days[i] - days[now] + 1 < gaps.get((step.target, kinds[i]), -(10**9))
                } | {now}
                seen |= {"against": [], "active": [], "confirming": [], "good": True}
            else:
                gone = {now}

                def near(categories):
                    return [i for i, d in days.items()
                            if kinds[i] in categories and 0 <= d - days[now] <= rules.revision_days]

                confirming = sorted(near(step.confirmed_by), key=lambda i: (-days[i], i))
                latest = max((days[i] for i in near(step.moved_by)), default=days[now])
                days[now] = latest
                here = days[now]
                active = sorted(
                    (d, i) for i, d in days.items()
                    if kinds[i] in rules.active_categories and 0 < d - here <= rules.rule_out_days
                )
                against = []
                for other in accepted:
                    pair = kinds[other], kinds[now]
                    if pair not in gaps or pair[::-1] not in gaps:
                        continue
                    first = pair if days[other] <= here else pair[::-1]
                    if abs(days[other] - here + 1) < gaps[first]:
                        against.append(other)
                good = (bool(confirming) or not step.confirmed_by) and not against
                good = good and not (active and step.rule_out)
                seen |= {"against": against, "active": active, "confirming": confirming, "good": good}
                if good:
                    accepted.append(now)
            pool = pool - gone
            passes.append(seen | {"day": days[now], "gone": gone, "left": set(pool)})
    return set(accepted), days, passes

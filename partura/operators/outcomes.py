"""Which outcome events are true outcomes, and on which day.

The published method walks through the outcome types in priority order, one event per person and
pass, moving event dates as it goes. Two facts make that a fixed number of steps here:

* Where an event moves to depends only on records, not on what was accepted. An event takes the
  latest day of its category list within the next days, and a move always lands on a day where
  such an event already was. So all moves are windows over days.
* What is left is greedy: take candidates in (priority, day) order, keep one unless it is too
  close to one already kept. After counting, a person has at most one candidate per type and
  calendar day, so this is a fold over a short array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partura.functions.days import to_date
from partura.functions.text import listed, literal, one_of, struct
from partura.rules import OutcomeStep, Rules
from partura.sources.lookups import Lookups


def by_day(value: str, start: str, end: str) -> str:
    """An aggregate over a person's records in a range of days around the row's day."""
    frame = f"RANGE BETWEEN {start} AND {end}"
    return f"{value} OVER (PARTITION BY person_id ORDER BY day {frame})"


def latest_day(categories: tuple[str, ...], start: int, end: int) -> str:
    """Latest day from ``start`` to ``end`` days after the row with one of the categories."""
    found = f"max(CASE WHEN {one_of('category', categories)} THEN day END)"
    first = "CURRENT ROW" if start == 0 else f"{start} FOLLOWING"
    return by_day(found, first, f"{end} FOLLOWING")


# --- moving dates -------------------------------------------------------------------------------


def _move(runs: DataFrame) -> DataFrame:
    """Move the first event of each run to ``new_day``; equal events behind it stay."""
    replaced = ("day", "n_events", "event_id", "is_first", "new_day")
    kept = [c for c in runs.columns if c not in replaced]
    whole = struct(day="new_day", n_events="n_events", event_id="event_id", is_first="is_first")
    head = struct(day="new_day", n_events="1L", event_id="event_id", is_first="is_first")
    rest = struct(day="day", n_events="n_events - 1", event_id="event_id + 1", is_first="false")
    parts = f"IF(new_day <> day AND n_events > 1, array({head}, {rest}), array({whole}))"
    # The outer form: the plain one would copy this expression into a filter below itself.
    return runs.selectExpr(*kept, f"inline_outer({parts})")


def move_rounds(rules: Rules) -> list[list[OutcomeStep]]:
    """Steps that move events, grouped so that a step sees the moves of earlier rounds."""
    rounds: list[list[OutcomeStep]] = [[]]
    for step in rules.steps:
        if not step.moved_by:
            continue
        if any(earlier.target in step.moved_by for earlier in rounds[-1]):
            rounds.append([])
        rounds[-1].append(step)
    return rounds


def _new_day(steps: list[OutcomeStep], rules: Rules) -> str:
    """Day an event moves to in a round; its own day for everything that stays."""
    cases = " ".join(
        f"WHEN category = '{step.target}' AND is_first "
        f"THEN coalesce({latest_day(step.moved_by, 0, rules.revision_days)}, day)"
        for step in steps
    )
    return f"CASE {cases} ELSE day END AS new_day" if steps else "day AS new_day"


def settled_runs(numbered: DataFrame, rules: Rules, witnesses: bool = False) -> DataFrame:
    """The timeline after all date moves, with what the acceptance checks need.

    ``pool_day`` is the day before the move, ``confirmed`` and ``ruled_out`` the verdicts from
    records, ``is_first`` marks the event that stands for its run. With ``witnesses`` there are
    also ``confirmed_by`` and ``refuted_by``, the numbers of the records that decided.
    """
    if not rules.moves_in_rounds:
        return settled_step_by_step(numbered, rules, witnesses)
    confirmed = " ".join(
        f"WHEN category = '{step.target}' "
        f"THEN {latest_day(step.confirmed_by, 0, rules.revision_days)} IS NOT NULL"
        for step in rules.steps
        if step.confirmed_by
    )
    confirmed = f"CASE {confirmed} ELSE true END" if confirmed else "true"
    shown = [f"{_confirmed_by(rules)} AS confirmed_by"] if witnesses else []
    first, *others = move_rounds(rules)
    runs = _move(
        numbered.withColumn("is_first", F.lit(True)).selectExpr(
            "*", "day AS pool_day", f"{confirmed} AS confirmed", *shown, _new_day(first, rules)
        )
    )
    for steps in others:
        runs = _move(runs.selectExpr("*", _new_day(steps, rules)))
    active = latest_day(rules.active_categories, 1, rules.rule_out_days)
    shown = [f"{_refuted_by(rules)} AS refuted_by"] if witnesses else []
    return runs.selectExpr("*", f"{active} IS NOT NULL AS ruled_out", *shown)


def _confirmed_by(rules: Rules) -> str:
    """Number of the latest confirming record, the first of its day."""
    cases = " ".join(
        f"WHEN category = '{step.target}' THEN "
        + by_day(
            f"max(CASE WHEN {one_of('category', step.confirmed_by)} "
            f"THEN {struct(day='day', event='-event_id')} END)",
            "CURRENT ROW",
            f"{rules.revision_days} FOLLOWING",
        )
        for step in rules.steps
        if step.confirmed_by
    )
    return f"-(CASE {cases} END).event" if cases else "CAST(NULL AS BIGINT)"


def _refuted_by(rules: Rules) -> str:
    """Number of the first record that refutes an outcome of a type that records can refute."""
    checked = one_of("category", (step.target for step in rules.steps if step.rule_out))
    first = by_day(
        f"min(CASE WHEN {one_of('category', rules.active_categories)} "
        f"THEN {struct(day='day', event='event_id')} END)",
        "1 FOLLOWING",
        f"{rules.rule_out_days} FOLLOWING",
    )
    return f"IF({checked}, {first}.event, NULL)"


def settled_step_by_step(
    numbered: DataFrame, rules: Rules, witnesses: bool = False
) -> DataFrame:
    """The same for any list of steps: one fold over a person's outcome events in walk order.

    The state is the sparse map of days that events have moved to, so each event sees every record
    where the events before it left it. A person has at most one outcome event per type and day,
    and of the other records only those are gathered whose category some step asks for.
    """
    asked = {c for step in rules.steps for c in (*step.moved_by, *step.confirmed_by)}
    asked = tuple(sorted(asked | set(rules.active_categories)))
    codes = " ".join(f"WHEN '{target}' THEN {i}" for i, target in enumerate(rules.targets))
    event = struct(code=f"CASE category {codes} END", day="day", event_id="event_id")
    record = struct(day="day", event_id="event_id", category="category", several="n_events > 1")
    people = numbered.groupBy("person_id").agg(
        F.expr(f"collect_list(IF({one_of('category', rules.targets)}, {event}, NULL)) AS events"),
        F.expr(f"collect_list(IF({one_of('category', asked)}, {record}, NULL)) AS records"),
    )

    def of_step(values) -> str:
        """What the event's step has, from one value per step."""
        return f"get(array({', '.join(values)}), c.code)"

    def strings(values) -> str:
        return f"array({listed(values or ('',))})"

    def spots(categories: str, moved: str, start: str, first: int, last: int) -> str:
        """(day, number) of records of the categories that lie in a range of days by now.

        Of a run only the first event moves; the others stay, and the next one stands for them.
        """
        here = f"coalesce(try_element_at({moved}, r.event_id), r.day)"
        rest = struct(day="r.day", event="r.event_id + 1")
        both = (
            f"array({struct(day=here, event='r.event_id')}, "
            f"IF(r.several AND {here} <> r.day, {rest}, NULL))"
        )
        own = f"filter(records, r -> array_contains({categories}, r.category))"
        placed = f"flatten(transform({own}, r -> array_compact({both})))"
        return f"filter({placed}, s -> s.day BETWEEN {start} + {first} AND {start} + {last})"

    until = rules.revision_days
    moving = of_step(strings(step.moved_by) for step in rules.steps)
    confirming = of_step(strings(step.confirmed_by) for step in rules.steps)
    needs_one = of_step(str(bool(step.confirmed_by)).lower() for step in rules.steps)
    checked = of_step(str(step.rule_out).lower() for step in rules.steps)
    # What an event sees, then where it goes, then who refutes it there.
    sees = struct(
        conf=spots(confirming, "state.days", "c.day", 0, until),
        here=f"coalesce(array_max({spots(moving, 'state.days', 'c.day', 0, until)}).day, c.day)",
    )
    goes = struct(
        conf="m.conf",
        here="m.here",
        days="IF(m.here = c.day, state.days, map_concat(state.days, map(c.event_id, m.here)))",
    )
    refuting = spots(strings(rules.active_categories), "m.days", "m.here", 1, rules.rule_out_days)
    ends = struct(conf="m.conf", here="m.here", days="m.days", refuting=refuting)
    latest = "array_max(transform(m.conf, s -> struct(s.day AS day, -s.event AS event)))"
    verdict = struct(
        event_id="c.event_id",
        new_day="m.here",
        confirmed=f"(NOT {needs_one} OR size(m.conf) > 0)",
        confirmed_by=f"-({latest}.event)",
        ruled_out="size(m.refuting) > 0",
        refuted_by=f"IF({checked}, array_min(m.refuting).event, NULL)",
    )
    turn = f"transform(transform(array({sees}), m -> {goes}), m -> {ends})"
    step = (
        f"(state, c) -> get(transform({turn}, m -> struct(m.days AS days, "
        f"concat(state.found, array({verdict})) AS found)), 0)"
    )
    found = struct(
        event_id="e.event_id", new_day="e.day", confirmed="true", confirmed_by="e.event_id",
        ruled_out="true", refuted_by="e.event_id",
    )
    none = f"slice(transform(events, e -> {found}), 1, 0)"
    verdicts = people.selectExpr(
        "person_id",
        f"inline(aggregate(sort_array(events), struct(CAST(map() AS MAP<BIGINT, INT>) AS days, "
        f"{none} AS found), {step}).found)",
    )
    shown = ["confirmed_by", "refuted_by"] if witnesses else []
    runs = numbered.join(verdicts, ["person_id", "event_id"], "left").selectExpr(
        *numbered.columns,
        "true AS is_first",
        "day AS pool_day",
        "coalesce(confirmed, true) AS confirmed",
        "coalesce(ruled_out, false) AS ruled_out",
        *shown,
        "coalesce(new_day, day) AS new_day",
    )
    return _move(runs)


# --- acceptance ---------------------------------------------------------------------------------


def is_target(rules: Rules, targets: tuple[str, ...] | None = None) -> str:
    """Rows that stand for an outcome event of the given types."""
    return f"(is_first AND {one_of('category', targets or rules.targets)})"


def is_candidate(rules: Rules, targets: tuple[str, ...] | None = None) -> str:
    """Outcome events that records neither refute nor leave unconfirmed."""
    unchecked = one_of("category", (step.target for step in rules.steps if not step.rule_out))
    return f"({is_target(rules, targets)} AND ({unchecked} OR NOT ruled_out) AND confirmed)"


def candidate(rules: Rules, *payload: str, **more: str) -> str:
    """What the fold knows of a candidate; its order is the order of acceptance."""
    codes = " ".join(f"WHEN '{target}' THEN {i}" for i, target in enumerate(rules.targets))
    return struct(
        code=f"CASE category {codes} END",
        pool_day="pool_day",
        event_id="event_id",
        day="day",
        category="category",
        **{name: name for name in payload},
        **more,
    )


def too_close(accepted: str, cand: str, lookups: Lookups, rules: Rules) -> str:
    """Whether an accepted outcome forbids a candidate.

    The distance counts one day on from the candidate before its sign is dropped, so the bound
    is a day longer towards earlier outcomes than it looks. That is part of the definition, as is
    that two types conflict only where the table has their gap in both orders.
    """
    behind = lookups.gap(rules.targets, f"{accepted}.code", f"{cand}.code")
    ahead = lookups.gap(rules.targets, f"{cand}.code", f"{accepted}.code")
    forward_only = one_of(
        f"{cand}.code", (i for i, step in enumerate(rules.steps) if step.forward_only)
    )
    return (
        f"IF({forward_only}, {cand}.day - {accepted}.day + 1 < {behind}, "
        f"{behind} IS NOT NULL AND {ahead} IS NOT NULL AND "
        f"abs({accepted}.day - {cand}.day + 1) < "
        f"IF({accepted}.day <= {cand}.day, {behind}, {ahead}))"
    )


def accept(lookups: Lookups, rules: Rules) -> str:
    """Greedy choice over one person's ``candidates``, as an array of those kept."""
    conflict = f"exists(kept, one -> {too_close('one', 'cand', lookups, rules)})"
    keep = f"(kept, cand) -> IF({conflict}, kept, concat(kept, array(cand)))"
    return f"aggregate(sort_array(candidates), slice(candidates, 1, 0), {keep})"


def people_with_accepted(
    settled: DataFrame,
    lookups: Lookups,
    rules: Rules,
    payload: tuple[str, ...] = (),
    through: str | None = None,
    collect: dict[str, str] | None = None,
) -> DataFrame:
    """One row per person with the array ``accepted``, in order of acceptance.

    ``collect`` names further per-person arrays, each of which takes a value per run (null to
    skip the run). ``through`` stops after that step.
    """
    targets = rules.through(through) if through else rules.targets
    chosen = f"CASE WHEN {is_candidate(rules, targets)} THEN {candidate(rules, *payload)} END"
    arrays = {"candidates": chosen, **(collect or {})}
    return (
        settled.groupBy("person_id")
        .agg(*[F.expr(f"collect_list({values}) AS {name}") for name, values in arrays.items()])
        .filter("size(candidates) > 0")
        .selectExpr("person_id", f"{accept(lookups, rules)} AS accepted", *(collect or {}))
    )


def valid_outcomes(
    settled: DataFrame, lookups: Lookups, rules: Rules, through: str | None = None
) -> DataFrame:
    """Accepted outcomes: ``(person_id, event_id, category, event_date)``."""
    people = people_with_accepted(settled, lookups, rules, through=through)
    return (
        people.selectExpr("person_id", "inline_outer(accepted)")
        .filter("event_id IS NOT NULL")
        .select("person_id", "event_id", "category", to_date(F.col("day")).alias("event_date"))
    )


# --- the passes of the walk ---------------------------------------------------------------------

PASS = ("target", "pass", "person_id", "event_id")


def people_with_turns(settled: DataFrame, lookups: Lookups, rules: Rules) -> DataFrame:
    """One row per person with ``kept``, the accepted outcomes in order, and ``turns``.

    The fold is that of ``accept``, over all outcome events and not just those that records let
    pass. A turn tells whether its event was ``picked`` (one that the gap after an earlier outcome
    of a forward-only step removed was not), whether it was ``accepted``, how many outcomes were
    accepted before it (``seen``), and the numbers of those that forbid it (``against``).
    """
    witnesses = [c for c in ("confirmed_by", "refuted_by") if c in settled.columns]
    cursor = candidate(rules, *witnesses, fit=is_candidate(rules))
    close = f"filter(state.kept, one -> {too_close('one', 'cand', lookups, rules)})"
    forward = one_of("cand.code", (i for i, step in enumerate(rules.steps) if step.forward_only))
    turn = struct(
        cand="cand",
        picked=f"NOT ({forward} AND size(m) > 0)",
        accepted="cand.fit AND size(m) = 0",
        seen="size(state.kept)",
        against="transform(m, one -> one.event_id)",
    )
    step = (
        f"(state, cand) -> get(transform(array({close}), m -> struct("
        "IF(cand.fit AND size(m) = 0, concat(state.kept, array(cand)), state.kept) AS kept, "
        f"concat(state.turns, array({turn})) AS turns)), 0)"
    )
    sample = struct(
        cand="cand", picked="true", accepted="true", seen="0", against="array(cand.event_id)"
    )
    none = (
        "struct(slice(cursors, 1, 0) AS kept, "
        f"slice(transform(cursors, cand -> {sample}), 1, 0) AS turns)"
    )
    return (
        settled.groupBy("person_id")
        .agg(F.expr(f"collect_list(CASE WHEN {is_target(rules)} THEN {cursor} END) AS cursors"))
        .filter("size(cursors) > 0")
        .selectExpr("person_id", f"aggregate(sort_array(cursors), {none}, {step}) AS walk")
        .selectExpr("person_id", "walk.kept", "walk.turns")
    )


def picked_events(people: DataFrame) -> DataFrame:
    """The events taken up, with ``target`` and ``pass``, the number among the person's of that type."""
    by_turn = Window.partitionBy("person_id", "target").orderBy("turn")
    return (
        people.selectExpr("person_id", "kept", "posexplode(turns) AS (turn, t)")
        .filter("t.picked")
        .selectExpr(
            "person_id", "kept", "turn", "t.*", "t.cand.category AS target", "t.cand.event_id"
        )
        .withColumn("pass", F.row_number().over(by_turn))
    )


def next_outcomes(picked: DataFrame) -> DataFrame:
    """The event that each pass of each step takes up."""
    return picked.select(*PASS)


def prior_flags(picked: DataFrame, rules: Rules) -> DataFrame:
    """For each event taken up: which outcomes accepted until then lie before it or on its day."""
    forward = one_of("target", (step.target for step in rules.steps if step.forward_only))
    return (
        picked.filter(f"NOT {forward}")
        .selectExpr(*PASS, "cand.day", "explode(slice(kept, 1, seen)) AS o")
        .selectExpr(
            *PASS, "o.event_id AS accepted_event_id", "CAST(o.day <= day AS INT) AS prior"
        )
    )


def gap_conflicts(picked: DataFrame) -> DataFrame:
    """Each event taken up with each accepted outcome that it lies too close to."""
    return picked.selectExpr(*PASS, "explode(against) AS accepted_event_id")


def acceptances(picked: DataFrame) -> DataFrame:
    """The events that the passes accept."""
    return picked.filter("accepted").select(*PASS)


def decisions(picked: DataFrame) -> DataFrame:
    """What became of each event taken up, and the events that decided it.

    ``event_date`` is the day after the move. An event may be refused on several grounds at
    once; of several accepted outcomes that forbid it the one accepted first is given.
    """
    return picked.select(
        *PASS,
        to_date(F.col("cand.day")).alias("event_date"),
        "accepted",
        F.get("against", F.lit(0)).alias("conflicting_event_id"),
        F.col("cand.refuted_by").alias("refuting_event_id"),
        F.col("cand.confirmed_by").alias("confirming_event_id"),
    )


def event_pools(settled: DataFrame, lookups: Lookups, rules: Rules) -> DataFrame:
    """What each step starts from: for people with an event of its type, the first event of each
    equal group in its categories, on the days that the steps before it left."""
    # Bit i of a number stands for step i. All steps that see an event on one day share its row until
    # equal events are one; only then is there a row per step.
    seen: dict[str, list[int]] = {}
    for i, target in enumerate(rules.targets):
        for category in pool_categories(target, lookups, rules):
            moved = category in rules.targets[:i]
            seen.setdefault(category, [0, 0])[moved] |= 1 << i
    before, after = (
        "CASE category "
        + " ".join(f"WHEN {literal(c)} THEN {bits[moved]}L" for c, bits in seen.items())
        + " ELSE 0L END"
        for moved in (False, True)
    )
    own = " ".join(
        f"WHEN {literal(t)} THEN {1 << i}L"
        for i, t in enumerate(rules.targets)
        if t in pool_categories(t, lookups, rules)
    )
    own = f"CASE category {own} ELSE 0L END" if own else "0L"
    has = f"bit_or({own}) OVER (PARTITION BY person_id)"
    places = ", ".join(
        struct(at=at, steps=f"has & {bits}")
        for at, bits in (("pool_day", before), ("day", after))
    )
    names = f"array({listed(rules.targets)})"
    step = f"explode(filter({names}, (t, i) -> getbit(steps, i) = 1)) AS target"
    return (
        settled.selectExpr("*", f"{has} AS has")
        .selectExpr("person_id", "event_id", "category", "gest_value", f"inline(array({places}))")
        .filter("steps <> 0")
        .groupBy("person_id", "category", F.col("at").alias("day"), "gest_value", "steps")
        .agg(F.min("event_id").alias("event_id"))
        .selectExpr(step, "person_id", "category", "day", "gest_value", "event_id")
    )


def pool_passes(
    settled: DataFrame, picked: DataFrame, lookups: Lookups, rules: Rules
) -> DataFrame:
    """Each pool event with ``passes``, how many its person has in that step, and ``left``, the pass
    in which it goes (null if it stays).

    A pass takes away the event it took up; in a forward-only step it also takes away whatever
    lies before the end of the gap after it.
    """
    days = struct(turn="turn", day="cand.day")
    walks = picked.groupBy("target", "person_id").agg(
        F.count("*").cast("int").alias("passes"),
        F.expr(f"sort_array(collect_list({days})).day AS days"),
    )
    own = picked.select("target", "person_id", "event_id", F.col("pass").alias("own"))
    forward = [step.target for step in rules.steps if step.forward_only]
    cases = " ".join(
        f"WHEN target = '{first}' AND category = '{later}' THEN {least}"
        for (first, later), least in lookups.min_days.items()
        if first in forward
    )
    gap = f"CASE {cases} END" if cases else "CAST(NULL AS INT)"
    # Passes go forward in time: the first one close enough is the one after all that are not.
    apart = f"size(filter(days, d -> d <= day + 1 - {gap}))"
    by_gap = f"IF({gap} IS NULL OR {apart} >= passes, NULL, {apart} + 1)"
    return (
        event_pools(settled, lookups, rules)
        .join(walks, ["target", "person_id"])
        .join(own, ["target", "person_id", "event_id"], "left")
        .selectExpr(
            "target",
            "person_id",
            "event_id",
            "passes",
            f"IF({one_of('target', forward)}, {by_gap}, own) AS left",
        )
    )


def removed_by_gap(pools: DataFrame, rules: Rules) -> DataFrame:
    """Events that the gap after an accepted outcome removes, by pass, the outcome among them."""
    forward = one_of("target", (step.target for step in rules.steps if step.forward_only))
    return pools.filter(f"{forward} AND left IS NOT NULL").selectExpr(
        "target", "left AS pass", "person_id", "event_id"
    )


def remaining_pools(pools: DataFrame) -> DataFrame:
    """What is left of the pools after each pass, for people who had a pass then."""
    until = "coalesce(left - 1, passes)"
    return pools.filter(f"{until} > 0").selectExpr(
        "target", f"explode(sequence(1, {until})) AS pass", "person_id", "event_id"
    )


# --- single steps -------------------------------------------------------------------------------


def people_with_target(numbered: DataFrame, rules: Rules) -> DataFrame:
    """People who have an event of each outcome type."""
    return (
        numbered.filter(F.col("category").isin(*rules.targets))
        .select(F.col("category").alias("target"), "person_id")
        .distinct()
    )


def pool_categories(target: str, lookups: Lookups, rules: Rules) -> tuple[str, ...]:
    """Categories that take part in a step: all in the gap table and the step's own."""
    listed = {category for pair in lookups.min_days for category in pair}
    return tuple(sorted(listed | set(rules.step(target).pool_extra)))


def pool_counts(numbered: DataFrame, lookups: Lookups, rules: Rules) -> DataFrame:
    """Events per step and pool category."""
    steps = F.array(
        *[
            F.when(F.col("category").isin(*pool_categories(t, lookups, rules)), F.lit(t))
            for t in rules.targets
        ]
    )
    return (
        numbered.groupBy("category")
        .agg(F.sum("n_events").alias("n_events"))
        .select(F.explode(F.array_compact(steps)).alias("target"), "category", "n_events")
    )


def ruled_out(settled: DataFrame, rules: Rules) -> DataFrame:
    """Outcome events refuted by an active-pregnancy record soon after."""
    checked = tuple(step.target for step in rules.steps if step.rule_out)
    return settled.filter(f"{is_target(rules, checked)} AND ruled_out").select(
        "person_id", "event_id", "category"
    )


def confirmations(numbered: DataFrame, target: str, rules: Rules) -> DataFrame:
    """Latest confirming record of each target event within the revision window."""
    found = latest_day(rules.step(target).confirmed_by, 0, rules.revision_days)
    rows = numbered.selectExpr("*", f"{found} AS found").filter(F.col("category") == target)
    return _dated(rows, "confirmation_date")


def revised_dates(numbered: DataFrame, target: str, rules: Rules) -> DataFrame:
    """Day a target event moves to, where a record within the window gives one."""
    runs = numbered.withColumn("is_first", F.lit(True))
    for steps in move_rounds(rules):
        if any(step.target == target for step in steps):
            break
        runs = _move(runs.selectExpr("*", _new_day(steps, rules)))
    found = latest_day(rules.step(target).moved_by, 0, rules.revision_days)
    rows = runs.selectExpr("*", f"{found} AS found").filter(is_target(rules, (target,)))
    return _dated(rows, "revised_date")


def _dated(rows: DataFrame, name: str) -> DataFrame:
    return rows.filter(F.col("found").isNotNull()).select(
        "person_id",
        "event_id",
        to_date(F.col("found")).alias(name),
        (F.col("found") - F.col("day")).alias("date_difference"),
    )

"""When each accepted outcome's pregnancy began.

A start must lie after the prior outcome and no later than its own, so every record can serve only
the outcome that follows it. Per person, the days of each kind of evidence are sorted once; each
outcome finds its own among them by binary search and leaves with days, not with the evidence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partura.functions.days import to_date
from partura.functions.search import count_while, let
from partura.functions.text import literal, one_of, struct
from partura.operators.outcomes import by_day, people_with_accepted
from partura.rules import Rules, StartRule
from partura.sources.lookups import Lookups

MARKERS = ("PREM", "POSTT", "FT")
DEFAULT_MARKERS = ("PREM", "FT")  # those that the default start looks at
COUNTS = {"PREM": "pre_count", "POSTT": "post_count", "FT": "full_count"}


# --- outcomes with their surroundings -----------------------------------------------------------


def _evidence(rule: StartRule) -> str:
    """A record's implied start; for GEST with the record's day behind it, which decides ties."""
    if rule.shift is None:
        value = struct(start="day + gest_value", day="day")
    else:
        value = f"day + ({rule.shift})"
    return f"CASE WHEN {one_of('category', rule.categories)} THEN {value} END"


def _marker(category: str) -> str:
    """A marker's day and how many events of its kind there are up to that day."""
    upto = by_day(
        f"sum(CASE WHEN category = '{category}' THEN n_events END)",
        "UNBOUNDED PRECEDING",
        "CURRENT ROW",
    )
    return f"CASE WHEN category = '{category}' THEN {struct(day='day', upto=upto)} END"


def _has_two_events(lookups: Lookups) -> str:
    """Whether two events of any category, the row's own among them, lie in the longest term
    that ends on the row's day."""
    same_day = by_day("sum(n_events)", "CURRENT ROW", "CURRENT ROW")
    earlier = by_day("max(day)", "UNBOUNDED PRECEDING", "1 PRECEDING")
    first = f"day - {lookups.term('max_term', 'category')} + 1"
    return f"({same_day} >= 2 OR coalesce({earlier} >= {first}, false))"


def outcome_rows(
    settled: DataFrame,
    lookups: Lookups,
    rules: Rules,
    evidence: tuple[str, ...] | None = None,
    markers: tuple[str, ...] = MARKERS,
) -> DataFrame:
    """One row per accepted outcome: prior outcome, bounds of its start, the start that each kind of
    evidence gives it (by the rule's name), and how many markers of each kind lie around it.

    The prior outcome is the latest on an earlier day (of several on that day the one with the
    highest event number). ``evidence`` and ``markers`` name what is wanted; the rest is not gathered.
    """
    wanted = [r for r in rules.start_rules if evidence is None or r.name in evidence]
    collect = {rule.name: _evidence(rule) for rule in wanted}
    found = {marker: f"_{marker}" for marker in markers}
    people = people_with_accepted(
        settled.selectExpr(
            "*",
            f"{_has_two_events(lookups)} AS has_two_events",
            *[f"{_marker(marker)} AS {name}" for marker, name in found.items()],
        ),
        lookups,
        rules,
        payload=("has_two_events",),
        collect=collect | found,
    )
    fields = ("day", "event_id", "category", "has_two_events")
    own = {name: f"o.{name}" for name in fields}
    before = "get(outcomes, i - 1)"
    if lookups.can_share_day(rules):
        earlier = "filter(slice(outcomes, 1, i), p -> p.day < o.day)"
        before = f"IF({before}.day = o.day, try_element_at({earlier}, -1), {before})"
        before = f"IF(i = 0, NULL, {before})"
    prior = {f"prior_{name}": f"({before}).{name}" for name in ("day", "category")}
    max_term, min_term, retry = (
        lookups.term(column, "o.category") for column in ("max_term", "min_term", "retry")
    )
    known = {name: f"o.{name}" for name in (*own, *prior)}
    bounds = {
        "earliest": f"o.day - {max_term}",
        "retry": retry,
        "lo": f"greatest(o.prior_day + {retry}, o.day - {max_term})",
        "hi": f"o.day - {min_term}",
    }
    picks = {rule.name: _pick(rule, rules) for rule in wanted}
    counts = {COUNTS[marker]: _count(marker, rules) for marker in markers}
    bounded = {name: f"o.{name}" for name in (*known, *bounds)}
    rows = f"transform(outcomes, (o, i) -> {struct(**own, **prior)})"
    rows = f"transform({rows}, o -> {struct(**known, **bounds)})"
    rows = f"transform({rows}, o -> {struct(**bounded, **picks, **counts)})"
    return (
        people.selectExpr(
            "person_id",
            f"sort_array(transform(accepted, o -> {struct(**own)})) AS outcomes",
            *[f"sort_array({name}) AS {name}" for name in collect],
            *[f"array_distinct(sort_array({marker})) AS {marker}" for marker in markers],
        )
        .selectExpr("person_id", f"inline_outer({rows})")
        .filter("event_id IS NOT NULL")
    )


def outcome_events(rows: DataFrame) -> DataFrame:
    return rows.select("person_id", "event_id", "category", to_date(F.col("day")).alias("event_date"))


def prior_outcomes(rows: DataFrame) -> DataFrame:
    """The outcome before each outcome, null for a person's first."""
    return rows.select(
        "person_id",
        "event_id",
        to_date(F.col("prior_day")).alias("prior_outcome_date"),
        "prior_category",
    )


# --- single kinds of evidence -------------------------------------------------------------------


def _pick(rule: StartRule, rules: Rules) -> str:
    """Start day that one kind of evidence gives an outcome ``o``, null if none is in bounds.

    Where the bounds depend on another person, all days that may still count are given.
    """
    upto = count_while(rule.name, lambda x: f"{x} <= o.hi")
    if borrows(rule, rules):
        below = count_while(rule.name, lambda x: f"{x} < o.earliest")
        return let("b", below, f"slice({rule.name}, b + 1, greatest({upto} - b, 0))")
    if rule.shift is None:
        below = count_while(rule.name, lambda x: f"{x}.start < o.lo")
        upto = count_while(rule.name, lambda x: f"{x}.start <= o.hi")
        near = f"slice({rule.name}, b + 1, greatest({upto} - b, 0))"
        by_record = f"transform({near}, x -> {struct(day='x.day', start='x.start')})"
        return let("b", below, f"array_max({by_record}).start")
    if rule.latest:
        return let("d", f"get({rule.name}, {upto} - 1)", "IF(d >= o.lo, d, NULL)")
    below = count_while(rule.name, lambda x: f"{x} < o.lo")
    first = f"get({rule.name}, {below})"
    return let("d", first, "IF(d <= o.hi, d, NULL)")


def borrows(rule: StartRule, rules: Rules) -> bool:
    """Whether a rule takes its lower bound from another person's prior outcome."""
    return rule.name == "OVUL2" and rules.ovul2_join == "reference"


def start_from_borrowed_prior(
    rows: DataFrame, rule: StartRule, rules: Rules, partitions: int | None = None
) -> DataFrame:
    """Replace a rule's evidence array by its start, bounded by another person's prior outcome.

    The published method compares the prior outcome's person id with its event number where it
    should compare persons. An outcome numbered k is thereby bounded by the prior outcome of
    event k of person k, and has no such start where person k has no outcome numbered k.

    At most one row per event number lends; those few are copied to every lane. Of the others only
    rows with such evidence meet them, in the one lane their person falls in, since event numbers
    are small and a single one can hold a large share of all outcomes. A row without it could get
    nothing and is keyed by its person alone. There are as many lanes as ``partitions``, to which
    all rows are then dealt; adaptive execution would bring them together by compressed bytes, and a
    task's sort would grow with the data. With none given there are as many as shuffle partitions,
    and the exchange is left to Spark.
    """
    n_lanes = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lends = "person_id = event_id"
    meets = f"({lends} OR size({rule.name}) > 0)"
    own_lane = f"IF({meets}, pmod(hash(person_id), {n_lanes}), person_id)"
    lanes = f"IF({lends}, sequence(0L, {n_lanes - 1}L), array({own_lane}))"
    key = f"IF({meets}, event_id, -1)"
    lent = struct(found="true", prior_day="prior_day")
    late = f"filter({rule.name}, start -> start >= greatest(lent.prior_day + retry, earliest))"
    others = [c for c in rows.columns if c != rule.name]
    laned = rows.selectExpr("*", f"{key} AS lane_key", f"explode_outer({lanes}) AS lane")
    if partitions is not None:
        laned = laned.repartition(partitions, "lane_key", "lane")
    return (
        laned.selectExpr(
            "*", f"max(IF({lends}, {lent}, NULL)) OVER (PARTITION BY lane_key, lane) AS lent"
        )
        .filter(f"lane = {own_lane}")
        .selectExpr(*others, f"IF(lent.found, array_min({late}), NULL) AS {rule.name}")
    )


def default_start(lookups: Lookups, rules: Rules) -> tuple[str, str]:
    """Label and day of the start assumed from the outcome type and term markers alone.

    The waiting time after the prior outcome is that of the prior outcome's type here.
    """

    def seen(marker: str) -> str:
        return f"{COUNTS[marker]} > 0"

    def term(column: str) -> str:
        return lookups.default_days(column, "category")

    days = (
        f"CASE WHEN {seen('PREM')} THEN {term('preterm')} "
        f"WHEN {seen('FT')} THEN {term('fullterm')} ELSE {term('nodata')} END"
    )
    after_prior = f"prior_day + {lookups.term('retry', 'prior_category')}"
    return f"IF({seen('PREM')}, 'PREM', 'DEFAULT')", f"greatest({after_prior}, day - {days})"


def _count(marker: str, rules: Rules) -> str:
    """Events of a marker from the prior outcome (or longest term) to shortly after the outcome ``o``:
    the running count at the end less that before the start."""
    start, end = "greatest(o.prior_day, o.earliest)", f"o.day + {rules.marker_days_after}"
    before = count_while(marker, lambda x: f"{x}.day < {start}")
    upto = count_while(marker, lambda x: f"{x}.day <= {end}")

    def total(places: str) -> str:
        return f"coalesce(get({marker}, {places} - 1).upto, 0L)"

    return f"greatest({total(upto)} - {total(before)}, 0L)"


def marker_counts(rows: DataFrame) -> DataFrame:
    return rows.select("person_id", "event_id", *COUNTS.values())


# --- choosing -----------------------------------------------------------------------------------


def picked_starts(
    rows: DataFrame, lookups: Lookups, rules: Rules, partitions: int | None = None
) -> DataFrame:
    """Outcome rows with their starts, those with borrowed bounds among them."""
    borrowing = [rule for rule in rules.start_rules if borrows(rule, rules)]
    bounds = ("prior_day", "earliest", "retry", "hi") if borrowing else ()
    label, day = default_start(lookups, rules)
    picks = rows.selectExpr(
        "person_id",
        "event_id",
        "category",
        "day",
        "has_two_events",
        *bounds,
        *[r.name for r in rules.start_rules],
        f"{label} AS default_label",
        f"{day} AS default_day",
    )
    for rule in borrowing:
        picks = start_from_borrowed_prior(picks, rule, rules, partitions)
    return picks


def with_starts(picks: DataFrame, rules: Rules) -> DataFrame:
    """Add ``starts`` (all ranked starts), ``best`` and ``refined`` (null if not refined)."""
    ranked = [
        f"IF({r.name} IS NULL, NULL, {struct(rank=str(r.rank), label=literal(r.name), day=r.name)})"
        for r in rules.start_rules
        if r.rank is not None
    ]
    default = struct(rank=str(rules.default_rank), label="default_label", day="default_day")
    refined = struct(
        rank="best.rank - 1", label="concat(best.label, ':REFINED')", day=refined_day("best.day")
    )
    return (
        picks.selectExpr("*", f"array_compact(array({', '.join(ranked)}, {default})) AS starts")
        .selectExpr("*", "array_min(starts) AS best")
        .selectExpr("*", f"IF(best.rank > {rules.refine_above_rank}, {refined}, NULL) AS refined")
    )


def refined_day(start: str) -> str:
    """A weak start corrected by the first confirmation and the last contraceptive in bounds.

    With one of them, a confirmation pulls the start earlier or a contraceptive pushes it later.
    With both, a confirmation before the start moves it to the later of the two (unless they
    coincide), and one after the start lets the contraceptive push it.
    """
    return (
        f"CASE WHEN CONTRA IS NULL THEN least(PUSHBACK, {start}) "
        f"WHEN PUSHBACK IS NULL OR PUSHBACK > {start} THEN greatest(CONTRA, {start}) "
        f"WHEN PUSHBACK < {start} AND PUSHBACK <> CONTRA THEN greatest(PUSHBACK, CONTRA) "
        f"ELSE {start} END"
    )


def _start_columns(found: DataFrame, start: str) -> DataFrame:
    return (
        found.selectExpr("person_id", "event_id", f"{start} AS s")
        .filter("s IS NOT NULL")
        .select(
            "person_id",
            "event_id",
            to_date(F.col("s.day")).alias("episode_start_date"),
            F.col("s.label").alias("category"),
            F.col("s.rank").alias("date_rank"),
        )
    )


def candidate_starts(picks: DataFrame, rules: Rules, which: str) -> DataFrame:
    """``which`` is 'starts' (every ranked start), 'best' or 'refined', as rows."""
    start = "explode_outer(starts)" if which == "starts" else which
    return _start_columns(with_starts(picks, rules), start)


def starts_of_kind(
    rows: DataFrame, name: str, rules: Rules, partitions: int | None = None
) -> DataFrame:
    """Starts from one kind of evidence, as rows."""
    rule = rules.start_rule(name)
    lends = borrows(rule, rules)
    found = start_from_borrowed_prior(rows, rule, rules, partitions) if lends else rows
    fields = struct(rank=f"CAST({literal(rule.rank)} AS INT)", label=literal(name), day=name)
    return _start_columns(found, f"IF({name} IS NULL, NULL, {fields})")


def default_starts(rows: DataFrame, lookups: Lookups, rules: Rules) -> DataFrame:
    label, day = default_start(lookups, rules)
    return _start_columns(rows, struct(rank=str(rules.default_rank), label=label, day=day))

"""Timeline, start and episode rules on hand-worked cases."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from partura import Lookups, Rules, build_episodes
from partura.operators import starts as st
from partura.operators import timeline as tl
from partura.plans.pipeline import study
from tests.clinic import DAY_0, clinic, day

END = 1000


def offset(date: dt.date) -> int:
    return (date - DAY_0).days


def starts_by_person(spark, cases, rules=None):
    """Best (rank, label, start) of the last outcome of each case, by case name."""
    ids = {name: i for i, name in enumerate(cases, 1)}
    events, drugs = [], []
    for name, rows in cases.items():
        for row in rows:
            (drugs if row[1] == "CONTRA" else events).append((ids[name], *row))
    e = build_episodes(clinic(spark, events, drugs=drugs), rules=rules)
    found = defaultdict(list)
    for r in e.all_starts.collect():
        found[r.person_id].append(
            (r.episode_end_date, -r.rank, r.start_category, offset(r.episode_start_date))
        )
    best = {name: max(found[i]) for name, i in ids.items()}
    return {name: (-rank, label, start) for name, (_, rank, label, start) in best.items()}


def test_default_starts(spark):
    cases = {
        "plain": [(END, "LB")],
        "full": [(END, "LB"), (END, "FT")],
        "early": [(END, "LB"), (END + 30, "PREM")],
        "both": [(END, "LB"), (END - 301, "PREM"), (END, "FT")],
        "marker too late": [(END, "LB"), (END + 31, "PREM")],
        "marker too early": [(END, "LB"), (END - 302, "PREM")],
        "stillbirth": [(END, "SB")],
        "stillbirth full": [(END, "SB"), (END, "FT")],
        "after prior": [(END - 200, "LB"), (END, "LB")],
        "after loss": [(END - 200, "SA"), (END, "LB")],
    }
    assert starts_by_person(spark, cases) == {
        "plain": (98, "DEFAULT:REFINED", END - 280),
        "full": (98, "DEFAULT:REFINED", END - 280),
        "early": (98, "PREM:REFINED", END - 245),
        "both": (98, "PREM:REFINED", END - 245),
        "marker too late": (98, "DEFAULT:REFINED", END - 280),
        "marker too early": (98, "DEFAULT:REFINED", END - 280),
        "stillbirth": (98, "DEFAULT:REFINED", END - 196),
        "stillbirth full": (98, "DEFAULT:REFINED", END - 280),
        "after prior": (98, "DEFAULT:REFINED", END - 172),
        "after loss": (98, "DEFAULT:REFINED", END - 186),
    }


def test_ranked_starts(spark):
    cases = {
        "gestation in weeks": [(END, "LB"), (END - 200, "GEST", 10)],
        "part of a week": [(END, "LB"), (END - 200, "GEST", 10.5)],
        "longest gestation": [(END, "LB"), (END - 1, "GEST", 43)],
        "too long gestation": [(END, "LB"), (END - 1, "GEST", 43.1)],
        "equal day, later start": [(END, "LB"), (END - 200, "GEST", 10), (END - 200, "GEST", 9)],
        "period latest": [(END, "LB"), (END - 250, "LMP"), (END - 240, "LMP")],
        "period first day": [(END, "LB"), (END - 301, "LMP")],
        "period too early": [(END, "LB"), (END - 302, "LMP")],
        "period last day": [(END, "LB"), (END - 161, "LMP")],
        "period too late": [(END, "LB"), (END - 160, "LMP")],
        "period after prior": [(END - 220, "LB"), (END, "LB"), (END - 192, "LMP")],
        "period near prior": [(END - 220, "LB"), (END, "LB"), (END - 193, "LMP")],
        "scan earliest": [(END, "LB"), (END - 150, "NULS"), (END - 140, "NULS")],
        "ovulation": [(END, "LB"), (END - 200, "OVUL"), (END - 190, "OVUL")],
        "protein": [(END, "LB"), (END - 100, "AFP")],
        "strong start stays": [(END, "LB"), (END - 100, "AFP"), (END - 210, "PCONF"),
                               (END - 200, "CONTRA")],
        "amenorrhea": [(END, "LB"), (END - 200, "AMEN")],
        "marker": [(END, "LB"), (END - 200, "UP")],
    }
    default = (98, "DEFAULT:REFINED", END - 280)
    assert starts_by_person(spark, cases) == {
        "gestation in weeks": (2, "GEST", END - 269),
        "part of a week": (2, "GEST", END - 272),
        "longest gestation": (2, "GEST", END - 301),
        "too long gestation": default,
        "equal day, later start": (2, "GEST", END - 262),
        "period latest": (1, "LMP", END - 240),
        "period first day": (1, "LMP", END - 301),
        "period too early": default,
        "period last day": (1, "LMP", END - 161),
        "period too late": default,
        "period after prior": (1, "LMP", END - 192),
        "period near prior": (98, "DEFAULT:REFINED", END - 192),
        "scan earliest": (6, "NULS", END - 239),
        "ovulation": (3, "OVUL", END - 213),
        "protein": (7, "AFP", END - 223),
        "strong start stays": (7, "AFP", END - 223),
        "amenorrhea": (79, "AMEN:REFINED", END - 255),
        "marker": (89, "UP:REFINED", END - 255),
    }


def test_refinement_branches(spark):
    none = [None]
    table = [
        (none, none, 100), ([90], none, 90), ([110], none, 100), (none, [110], 110),
        (none, [90], 100), ([90], [80], 90), ([90], [95], 95), ([110], [120], 120),
        ([90], [90], 100), ([110], [90], 100), ([100], [120], 100), ([90], [100], 100),
    ]
    rows = [(pc[0], cc[0], want) for pc, cc, want in table]
    df = spark.createDataFrame(rows, "PUSHBACK int, CONTRA int, want int")
    bad = df.selectExpr("*", f"{st.refined_day('100')} AS got").filter("got <> want OR got IS NULL")
    assert bad.collect() == []


def test_second_ovulation_modes(spark):
    # Person 3's event 3 is an outcome with a prior one, so it bounds event 3 of person 50.
    events = [(3, 0, "LB"), (3, 900, "FT"), (3, END, "LB"),
              (50, 100, "FT"), (50, END - 270, "OVUL2"), (50, END, "LB")]
    s = study(clinic(spark, events))
    found = st.starts_of_kind(s.outcome_rows, "OVUL2", s.rules).collect()
    assert [(r.person_id, offset(r.episode_start_date)) for r in found] == [(50, END - 283)]
    late = [(3, 720, "LB"), (3, 721, "FT"), (3, END, "LB"), *events[3:]]
    s = study(clinic(spark, late))
    assert st.starts_of_kind(s.outcome_rows, "OVUL2", s.rules).collect() == []
    s = study(clinic(spark, late), rules=Rules(ovul2_join="corrected"))
    found = st.starts_of_kind(s.outcome_rows, "OVUL2", s.rules).collect()
    assert [r.person_id for r in found] == [50]


def test_episode_filters(spark):
    start = END - 280
    cases = {
        # name: events, periods, (gender, birth year), expected episodes
        "kept": ([(END, "LB"), (END, "FT")], None, None, [(1, "LB/DELIV", 281)]),
        "single record": ([(END, "LB")], None, None, []),
        "other record out of term": ([(END, "LB"), (END - 301, "FT")], None, None, []),
        "other record on first day": (
            [(END, "LB"), (END - 300, "FT")], None, None, [(1, "LB/DELIV", 281)],
        ),
        "enrolled at start": (
            [(END, "LB"), (END, "FT")], [(start, END)], None, [(1, "LB/DELIV", 281)],
        ),
        "enrolled a day late": ([(END, "LB"), (END, "FT")], [(start + 1, END)], None, []),
        "enrolment ends early": ([(END, "LB"), (END, "FT")], [(start, END - 1)], None, []),
        "two periods": (
            [(END, "LB"), (END, "FT")], [(start, END), (0, 2000)], None,
            [(1, "LB/DELIV", 281), (2, "LB/DELIV", 281)],
        ),
        "equal periods": (
            [(END, "LB"), (END, "FT")], [(0, 2000), (0, 2000)], None,
            [(1, "LB/DELIV", 281), (2, "LB/DELIV", 281)],
        ),
        "male": ([(END, "LB"), (END, "FT")], None, (8507, 1975), []),
        "age 11": ([(END, "LB"), (END, "FT")], None, (8532, 1990), []),
        "age 12": ([(END, "LB"), (END, "FT")], None, (8532, 1989), [(1, "LB/DELIV", 281)]),
        "age 55": ([(END, "LB"), (END, "FT")], None, (8532, 1946), [(1, "LB/DELIV", 281)]),
        "age 56": ([(END, "LB"), (END, "FT")], None, (8532, 1945), []),
        "short stillbirth": (
            [(END, "SB"), (END - 138, "LMP")], None, None, [(1, "SA/AB", 139)],
        ),
        "long stillbirth": ([(END, "SB"), (END - 139, "LMP")], None, None, [(1, "SB", 140)]),
        "number keeps its gap": (
            [(0, "LB"), (END, "LB"), (END, "FT")], None, None, [(2, "LB/DELIV", 281)],
        ),
    }
    ids = {name: i for i, name in enumerate(cases, 1)}
    events, periods, people = [], [], []
    for name, (rows, enrolled, who, _) in cases.items():
        events += [(ids[name], *row) for row in rows]
        periods += [(ids[name], day(a), day(b)) for a, b in enrolled or [(-5000, 9000)]]
        people.append((ids[name], *(who or (8532, 1975))))
    e = build_episodes(clinic(spark, events, periods=periods, people=people)).episodes
    found = defaultdict(list)
    for r in e.orderBy("person_id", "episode").collect():
        found[r.person_id].append((r.episode, r.outcome, r.episode_length))
    # The short stillbirth's period lies one day past the least term of 100 days and is in bounds.
    assert {n: found[i] for n, i in ids.items()} == {n: c[3] for n, c in cases.items()}


def test_timeline_rules(spark):
    events = [(1, 0, "DIAB"), (1, 5, "DIAB"), (2, 0, "DIAB"), (2, 1, "GEST", 50), (3, 0, "LB"),
              (3, 0, "LB"), (3, -4, "FT")]
    concepts = [(1, "LMP", None, None), (2, "LMP", None, "Yes"), (3, "LMP", None, "N/A")]
    observations = [(3, 9, 1, "Yes", None), (3, 10, 2, "Yes", None), (3, 11, 2, "yes ", None),
                    (3, 12, 3, None, None)]
    drugs = [(p, 7, "OVULDR") for p in (1, 2, 3, 4)]
    cdm = clinic(spark, events, observations=observations, drugs=drugs, concepts=concepts)
    s = study(cdm)
    rows = [
        (r.person_id, r.event_id, offset(r.event_date), r.category)
        for r in tl.event_timeline(s.numbered).collect()
    ]
    # Person 1 has screening rows only; person 2 has one more, though it is then dropped itself.
    assert sorted(rows) == [
        (2, 1, 0, "DIAB"), (2, 2, 7, "OVULDR"), (3, 1, -4, "FT"), (3, 2, 0, "LB"), (3, 3, 0, "LB"),
        (3, 4, 7, "OVULDR"), (3, 5, 10, "LMP"), (3, 6, 12, "LMP"),
    ]
    loose = study(cdm, rules=Rules(normalize_values=True))
    assert tl.raw_events(cdm, loose.rules).filter(F.col("category") == "LMP").count() == 3


def test_long_runs_are_written_whole(spark, monkeypatch):
    monkeypatch.setattr("partura.functions.runs.CHUNK", 7)
    s = study(clinic(spark, [(1, 0, "LB")] * 50 + [(1, 1, "FT")] * 7 + [(2, 0, "SB")] * 8))
    rows = tl.event_timeline(s.settled).select("person_id", "event_id").collect()
    assert sorted(map(tuple, rows)) == [(1, i) for i in range(1, 58)] + [
        (2, i) for i in range(1, 9)
    ]


def test_lookups_from_csv(spark, tmp_path):
    for name, frame in Lookups().frames(spark).items():
        frame.toPandas().to_csv(tmp_path / f"{name}.csv", index=False)
    assert Lookups.from_csv(spark, str(tmp_path)) == Lookups()


@pytest.mark.parametrize("buckets", [None, 2])
def test_tables(spark, tmp_path, buckets):
    from partura import run
    from partura.sources import results

    schema = f"preg_{buckets or 0}"
    spark.sql(f"CREATE SCHEMA {schema}")
    try:
        results.init(spark, schema, buckets=buckets)
        table = f"{schema}.{results.RESULT_TABLE}"
        assert spark.table(table).count() == 0
        cdm = clinic(spark, [(p, END, c) for p in range(1, 21) for c in ("LB", "FT")])
        run(spark, cdm, table, results.load_lookups(spark, schema))
        run(spark, cdm, table)
        assert spark.table(table).count() == 40
        run(spark, cdm, table, mode="overwrite")
        assert spark.table(table).count() == 20
        if buckets:
            assert len(spark.table(table).inputFiles()) == buckets
        with pytest.raises(ValueError):
            run(spark, cdm, table, mode="merge")
        results.clean(spark, schema)
        assert [t.name for t in spark.catalog.listTables(schema)] == [results.RESULT_TABLE]
        results.init(spark, schema)
        assert spark.table(table).count() == 0
    finally:
        spark.sql(f"DROP SCHEMA {schema} CASCADE")

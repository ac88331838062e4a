"""Lookup values written out by themselves, and tables and records at their edges."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.oracle import all_oracles
from partura import Lookups, Rules, build_episodes
from partura.operators import timeline as tl
from partura.plans.pipeline import study
from partura.plans.queries import all_queries
from partura.sources import results
from partura.sources.driver_tables import driver_cdm
from tests.clinic import CONCEPTS, clinic
from tests.conftest import SMALL

TYPES = "LB SB DELIV TRO ECT AB SA".split()
GAPS = """
182 168 168 70 70 70 70
182 168 168 70 70 70 70
182 168 168 70 70 70 70
168 154 154 730 56 56 365
168 154 154 365 56 56 56
168 154 154 365 56 56 56
168 154 154 365 56 56 56
"""
TERMS = "301 161 28|301 100 28|301 140 28|365 42 14|84 42 14|168 42 14|139 28 14"
GESTATION = "245 285 280 280|196 285 280 196|245 285 280 280|56 56 56 56|56 56 56 56|70 70 70 70|70 70 70 70"


def _numbers(rows):
    return {t: tuple(map(int, r.split())) for t, r in zip(TYPES, rows, strict=True)}


def test_values_are_those_written_out():
    own = Lookups()
    gaps = _numbers(GAPS.strip().split("\n"))
    assert own.min_days == {(a, b): gaps[a][k] for a in TYPES for k, b in enumerate(TYPES)}
    assert own.terms == _numbers(TERMS.split("|"))
    assert own.gestation == _numbers(GESTATION.split("|"))


@pytest.mark.parametrize("name", ["outcome_limit", "term_durations", "gest_est"])
def test_a_second_row_for_a_key_raises(spark, name):
    frames = dict(Lookups().frames(spark))
    frames[name] = frames[name].union(frames[name].limit(1))
    with pytest.raises(ValueError, match="more than one row"):
        Lookups.from_frames(frames["outcome_limit"], frames["term_durations"], frames["gest_est"])


def test_normalized_wildcard(spark):
    cdm = clinic(
        spark,
        [(1, 0, "LB")],
        observations=[(1, 1, 7001, "x", 1.0), (1, 2, 7002, "y", 1.0)],
        concepts=[(7001, "FT", None, "N/A "), (7002, "FT", None, "n/a")],
    )
    full = tl.raw_events(cdm, Rules(normalize_values=True)).filter(F.col("category") == "FT")
    assert full.count() == 2
    assert tl.raw_events(cdm, Rules()).filter(F.col("category") == "FT").count() == 0


def test_an_absurd_gestation_ends_no_run(spark):
    assert "GEST" in CONCEPTS
    cdm = clinic(spark, [(1, 0, "LB"), (1, -9, "FT"), (2, 0, "GEST", -1e10), (1, -3, "GEST", -1e10)])
    made = build_episodes(cdm)
    assert made.episodes.filter("person_id = 1").count() == 1
    assert tl.nondrug_events(cdm, Rules()).filter("category = 'GEST'").count() == 2


def test_an_invalid_gestation_stays_out_of_whole_days(spark):
    """A record of 44 weeks supports no outcome, whichever form of the timeline is used."""
    s = study(clinic(spark, [(1, 0, "LB"), (1, -9, "GEST", 44.0)]))
    for runs in (s.numbered, s.outcome_people):
        assert [(r.category, r.event_id) for r in runs.collect()] == [("LB", 1)]


def test_nondrug_events_read_no_drugs(spark):
    plan = tl.nondrug_events(clinic(spark, [(1, 0, "LB")], drugs=[(1, 0, "MTX")]), Rules())
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "drug" not in text and "ancestor" not in text
    assert "events_nondrug" in all_queries() and "events_nondrug" in all_oracles()


def test_a_missing_gap_is_no_conflict(spark):
    """Two types conflict only where the table has their gap in both orders."""
    events = [(1, 0, "DELIV"), (1, 60, "SB"), (2, 0, "SB"), (2, 60, "DELIV"), (3, 0, "LB"), (3, 9, "SA")]
    gaps = Lookups().min_days

    def accepted(*missing):
        left = Lookups({pair: days for pair, days in gaps.items() if pair not in missing})
        rows = build_episodes(clinic(spark, events), left).valid_outcomes.collect()
        return sorted((r.person_id, r.category) for r in rows)

    both = [(1, "DELIV"), (1, "SB"), (2, "DELIV"), (2, "SB")]
    assert accepted() == [(1, "SB"), (2, "SB"), (3, "LB")]
    assert accepted(("DELIV", "SB")) == both + [(3, "LB")]
    assert accepted(("SB", "DELIV")) == both + [(3, "LB")]
    assert accepted(("LB", "SA")) == [(1, "SB"), (2, "SB"), (3, "LB"), (3, "SA")]


def test_a_run_uses_the_lookups_beside_its_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE beside LOCATION '{tmp_path}/beside'")
    try:
        terms = dict(Lookups().terms) | {"LB": (301, 161, 29)}
        results.init(spark, "beside", Lookups(terms=terms))
        assert results.find_lookups(spark, "beside").terms == terms
        results.clean(spark, "beside")
        assert results.find_lookups(spark, "beside") is None
    finally:
        spark.sql("DROP DATABASE beside CASCADE")


def test_saved_stage_gives_the_same_results(spark, tmp_path):
    spark.sql(f"CREATE DATABASE stages LOCATION '{tmp_path}/stages'")
    try:
        cdm = driver_cdm(spark, SMALL)
        direct, saved = build_episodes(cdm), build_episodes(cdm, stage_table="stages.settled")
        for name in ("episodes", "all_starts", "valid_outcomes", "timeline"):
            a, b = getattr(direct, name), getattr(saved, name)
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
        assert not saved.episodes.isEmpty()
    finally:
        spark.sql("DROP DATABASE stages CASCADE")

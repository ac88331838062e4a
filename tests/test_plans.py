"""What the plans must look like to hold at scale."""

from __future__ import annotations

import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from partura import build_episodes
from partura.functions import layout
from partura.functions.joins import broadcast_if_small
from partura.functions.membership import field_of, maybe_in
from partura.functions.runs import expand_runs
from partura.functions.search import count_while
from partura.operators import episodes as ep
from partura.operators import outcomes as oc
from partura.operators import starts as st
from partura.operators import timeline as tl
from partura.plans.pipeline import study
from partura.plans.queries import all_queries
from partura.rules import Rules
from partura.sources import driver_tables
from partura.sources.driver_tables import driver_cdm
from tests.clinic import clinic
from tests.conftest import SMALL


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def episodes(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", 10_000_000)
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    return all_queries()["pregnancy_episodes"](spark, SMALL)


def test_fold_is_planned_once(episodes):
    plan = optimized(episodes)
    assert len(re.findall(r"\baggregate\(sort_array\(candidates", plan)) == 1
    # One or two searches in each array of evidence and markers.
    assert len(re.findall(r"\baggregate\(", plan)) <= 1 + 2 * 12
    # One for the array of ranked starts, one for the lane, one for days that another person bounds.
    assert len(re.findall(r"\bfilter\(", plan)) <= 3


def test_inputs_are_read_once(episodes):
    """Five clinical tables, orders under each, person, enrolment and the drug vocabulary twice."""
    plan = physical(episodes)
    assert plan.count("FileScan parquet") == 5 * 2 + 2 + 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_columns_and_filters_reach_the_scan(episodes):
    plan = physical(episodes)
    assert re.search(r"PushedFilters: \[[^]]*In\(l_linenumber, \[1,2\]\)", plan)
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_events_are_counted_before_they_meet_by_person(episodes):
    plan = physical(episodes)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    keys = [re.sub(r"#\d+L?", "", e).split(", ")[:-1] for e in exchanges]
    assert ["person_id", "day", "category", "gest_value"] in keys


def exchanges(df) -> list[str]:
    """Hash exchanges of a plan, each counted once however often it is read."""
    return re.findall(r"Exchange (?:hashpartitioning|RoundRobin)[^\n]*", physical(df))


def test_episodes_are_written_without_a_spread(episodes):
    plan = physical(episodes)
    assert "REPARTITION_BY_NUM" not in plan
    enrolment = [e for e in exchanges(episodes) if "from_day" in e]
    assert not enrolment
    # Counts, persons, lanes, episodes and enrolment by person, with the joins of the test views.
    assert len([e for e in exchanges(episodes) if "lane" in e]) == 1


def test_only_outcomes_with_evidence_meet_by_event_number(episodes):
    assert re.search(r"hashpartitioning\(lane_key#\d+L?, lane#\d+L?, ", physical(episodes))
    assert not re.search(r"hashpartitioning\(event_id", physical(episodes))


def test_drug_concepts_are_checked_once(spark):
    s = study(driver_cdm(spark, SMALL))
    s.numbered, s.outcome_people
    assert "drug_dimension" in s.__dict__


def test_unused_evidence_is_not_collected(spark):
    plan = optimized(all_queries()["start_lmp"](spark, SMALL))
    assert plan.count("collect_list") == 2


def test_concept_ids_reach_the_scan(spark, tmp_path):
    cdm = clinic(spark, [(1, 0, "LB"), (2, 5, "AGP")], drugs=[(1, 0, "MTX")])
    for name in ("condition_occurrence", "drug_exposure"):
        getattr(cdm, name).write.parquet(f"{tmp_path}/{name}.parquet")
        cdm = replace(cdm, **{name: spark.read.parquet(f"{tmp_path}/{name}.parquet")})
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    try:
        pushed = [x for x in physical(study(cdm).numbered).split("PushedFilters: ")[1:]]
        assert any("In(condition_concept_id" in x.split("ReadSchema")[0] for x in pushed)
        drugs = physical(tl.match_drugs(cdm, Rules())).split("PushedFilters: ")[1]
        assert "In(drug_concept_id" in drugs.split("ReadSchema")[0]
        plain = physical(study(cdm, rules=Rules(scan_ids=1)).numbered)
        assert "In(condition_concept_id" not in plain
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    few, many = study(cdm), study(cdm, rules=Rules(scan_ids=0))
    assert sorted(few.numbered.collect()) == sorted(many.numbered.collect())


def test_people_without_outcomes_do_not_move(spark):
    """With a bit field of 4 bits some people pass by chance; the result is the same."""
    events = [(p, 0, "LB") for p in range(1, 30, 3)] + [(p, d, "AGP") for p in range(1, 300) for d in (1, 9)]
    cdm = clinic(spark, events, drugs=[(p, 5, "CONTRA") for p in range(1, 300)])
    rules = Rules(early_people=True)
    field = tl.outcome_people_field(cdm, rules)
    assert field.count() <= 10
    moved = tl.event_runs(cdm, rules, people=field)
    assert {r.person_id for r in moved.collect()} == set(range(1, 30, 3))
    early, plain = study(cdm, rules=rules), study(cdm)
    assert sorted(early.outcome_runs.collect()) == sorted(plain.outcome_runs.collect())
    plan = physical(study(cdm, rules=rules).outcome_runs)
    # The field is met below the count, on both sides of the union.
    assert plan.index("HashAggregate") < plan.index("BroadcastHashJoin [word")
    assert plan.count("BroadcastHashJoin [word") == 2
    some = maybe_in(spark.range(1000), "id", field_of(spark.range(3), "id", 6), 6)
    assert {0, 1, 2} <= {r.id for r in some.collect()} and some.count() < 200


def test_a_saved_stage_is_not_shuffled_by_person(spark, tmp_path):
    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}/bucketed'")
    try:
        done = build_episodes(driver_cdm(spark, SMALL), stage_table="bucketed.settled")
        stage = spark.table("bucketed.settled")
        assert len(stage.inputFiles()) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        for result in (done.valid_outcomes, done.all_starts, done.episodes):
            moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", physical(result))
            lanes = [m for m in moved if not m.startswith("lane_key")]
            # Enrolment and person come to the stage, which stays; best picks per lane are another matter.
            assert len(lanes) <= (3 if result is done.episodes else 1 if result is done.all_starts else 0), moved
        s = study(driver_cdm(spark, SMALL), rules=Rules(ovul2_join="corrected")).save("bucketed.settled")
        assert "Exchange" not in physical(s.picks) and "Exchange" not in physical(s.best)
        assert "Exchange" not in physical(oc.valid_outcomes(s.outcome_people, s.lookups, s.rules))
        s = study(driver_cdm(spark, SMALL)).save("bucketed.settled", buckets=7)
        assert len(spark.table("bucketed.settled").inputFiles()) == 7
    finally:
        spark.sql("DROP DATABASE bucketed CASCADE")


def test_outcomes_leave_with_days(spark):
    """No outcome row carries its person's evidence, but for the rule that another person bounds."""
    rows = study(driver_cdm(spark, SMALL)).outcome_rows
    arrays = [f.name for f in rows.schema.fields if f.dataType.typeName() == "array"]
    assert arrays == ["OVUL2"]
    own = study(driver_cdm(spark, SMALL), rules=Rules(ovul2_join="corrected")).outcome_rows
    assert not [f.name for f in own.schema.fields if f.dataType.typeName() == "array"]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 100])
def test_count_while(spark, n):
    rng = random.Random(n)
    values = sorted(rng.randrange(50) for _ in range(n))
    df = spark.range(-2, 53).select("id", F.lit(values).cast("array<bigint>").alias("v"))
    below = F.expr(count_while("v", lambda x: f"{x} < id"))
    upto = F.expr(count_while("v", lambda x: f"{x} <= id"))
    for row in df.select("id", below.alias("a"), upto.alias("b")).collect():
        assert row.a == sum(v < row.id for v in values) and row.b == sum(v <= row.id for v in values)


def test_large_side_is_not_broadcast(spark):
    df = spark.range(1000)
    tight = Rules(broadcast_bytes=10, broadcast_rows=999)
    assert "broadcast" not in optimized(df.join(broadcast_if_small(df, tight), "id"))
    loose = Rules(broadcast_bytes=10, broadcast_rows=1000)
    assert "broadcast" in optimized(df.join(broadcast_if_small(df, loose), "id"))


def test_expanding_is_spread(spark):
    df = spark.range(1).select(F.lit(1).alias("person_id"), F.lit(10**6).cast("long").alias("n"))
    rows = expand_runs(df, ["person_id"], "n")
    parts = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in parts) == 10**6
    assert len(parts) > 1


def small_partitions(monkeypatch, size: int) -> None:
    monkeypatch.setattr(layout, "BYTES_PER_PARTITION", size)
    monkeypatch.setattr(layout, "SMALL_BYTES", 4 * size)


def test_partitions_by_person_grow_with_the_input(spark, monkeypatch):
    """Adaptive execution would make one task of all people here, and one per core at any size."""
    cdm = driver_cdm(spark, SMALL)
    size = sum(layout.input_bytes(t) for t in (cdm.condition_occurrence, cdm.drug_exposure))
    assert layout.partitions_for([cdm.condition_occurrence, cdm.drug_exposure]) is None
    plain = study(cdm).outcome_people.collect()
    for share in (10, 30):
        small_partitions(monkeypatch, size // share)
        assert tl.person_partitions(cdm) >= share
        runs = study(cdm).outcome_people
        assert runs.rdd.getNumPartitions() == tl.person_partitions(cdm)
        assert sorted(runs.collect(), key=str) == sorted(plain, key=str)
        moved = re.findall(r"hashpartitioning\(person_id#\d+L, (\d+)\)", physical(runs))
        assert set(moved) == {str(tl.person_partitions(cdm))}


def order_tables(spark, folder: str) -> None:
    """Orders of 40 customers, seven lines each; some lines lack their order or its key."""
    orders = spark.range(300).selectExpr("id AS o_orderkey", "id % 40 AS o_custkey", "'x' AS o_comment")
    lines = spark.range(310).selectExpr("IF(id > 305, NULL, id) AS l_orderkey", "explode(sequence(1, 7)) AS l_linenumber")
    lines = lines.selectExpr(
        "*", "l_orderkey * 7 + l_linenumber AS l_partkey", "'R' AS l_returnflag", "'F' AS l_linestatus",
        "CAST(l_orderkey % 30 AS DOUBLE) AS l_quantity",
        "date_add(DATE '1995-01-01', CAST(l_orderkey * 13 % 1400 AS INT)) AS l_shipdate",
    )
    tables = {"orders": orders, "lineitem": lines, "part": spark.range(60).selectExpr("id AS p_partkey")}
    tables["customer"] = spark.range(40).selectExpr("id AS c_custkey")
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}.parquet")


def test_joins_of_the_views_are_dealt_out_as_the_input_grows(spark, tmp_path, monkeypatch):
    """Adaptive execution would bring the partitions of lines and orders together, here to one task."""
    order_tables(spark, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = driver_cdm(spark, str(tmp_path))
        assert plain.condition_occurrence.rdd.getNumPartitions() == 1
        files = ("lineitem", "orders")
        size = sum(layout.input_bytes(spark.read.parquet(f"{tmp_path}/{f}.parquet")) for f in files)
        small_partitions(monkeypatch, size // 10)
        for share in (10, 30):
            monkeypatch.setattr(driver_tables, "BYTES_PER_JOIN", size // share)
            cdm = driver_cdm(spark, str(tmp_path))
            for name in ("condition_occurrence", "measurement", "drug_exposure"):
                rows = getattr(cdm, name)
                assert share <= rows.rdd.getNumPartitions() <= share + 1
                assert sorted(rows.collect(), key=str) == sorted(getattr(plain, name).collect(), key=str)
            scans = [x for x in physical(cdm.drug_exposure).split("\n") if "FileScan" in x]
            assert scans and not any("o_comment" in x or "l_quantity" in x for x in scans)
        assert plain.drug_exposure.count() == 2 * 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def lanes_of(df) -> set[str]:
    return set(re.findall(r"hashpartitioning\(lane_key#\d+L?, lane#\d+L?, (\d+)\)", physical(df)))


def test_lanes_are_dealt_out_as_the_input_grows(spark, tmp_path, monkeypatch):
    """Adaptive execution would bring the lanes together, here to one task."""
    order_tables(spark, str(tmp_path))
    cdm = driver_cdm(spark, str(tmp_path))
    plain = study(cdm).picks.collect()
    size = sum(layout.input_bytes(t) for t in (cdm.condition_occurrence, cdm.drug_exposure))
    for share in (10, 30):
        small_partitions(monkeypatch, size // share)
        s = study(cdm)
        assert s.partitions >= share
        borrowed = st.starts_of_kind(s.outcomes_with(("OVUL2",)), "OVUL2", s.rules, s.partitions)
        assert lanes_of(s.picks) == lanes_of(borrowed) == {str(s.partitions)}
        assert s.picks.rdd.getNumPartitions() == s.partitions
        assert sorted(s.picks.collect(), key=str) == sorted(plain, key=str)
        episodes = ep.final_episodes(s.supported_episodes, s.rules)
        assert lanes_of(episodes) == lanes_of(ep.all_starts(s.picks, s.rules)) == {str(s.partitions)}


@pytest.mark.parametrize("mode", ["reference", "corrected"])
def test_large_tables_of_people_are_not_broadcast(spark, tmp_path, monkeypatch, mode):
    """By its estimate, of compressed columns, a broadcast of all people would look small at any size."""
    order_tables(spark, str(tmp_path))
    cdm = driver_cdm(spark, str(tmp_path))
    rules = Rules(ovul2_join=mode)

    def people_broadcast(df) -> bool:
        return bool(re.search(r"BroadcastHashJoin \[person_id", physical(df)))

    small = study(cdm, rules=rules).numbered_episodes
    assert people_broadcast(small)
    plain = small.collect()
    assert plain
    size = sum(layout.input_bytes(t) for t in (cdm.condition_occurrence, cdm.drug_exposure))
    small_partitions(monkeypatch, size // 10)
    s = study(cdm, rules=rules)
    assert not people_broadcast(s.numbered_episodes)
    # Runs, episodes from the lanes, enrolment and person; else each stays where the runs were dealt to.
    moved = re.findall(r"hashpartitioning\(person_id#\d+L, (\d+)\)", physical(s.numbered_episodes))
    assert moved == [str(s.partitions)] * (4 if mode == "reference" else 3)
    assert s.numbered_episodes.rdd.getNumPartitions() == s.partitions
    assert sorted(s.numbered_episodes.collect(), key=str) == sorted(plain, key=str)


def test_any_number_of_lanes_lends_the_same(spark):
    """Person k is bounded by event k of person k, in whichever lane both lie."""
    rng = random.Random(5)
    kinds = ("LB", "SA", "AB", "OVUL2", "OVUL2", "AGP")
    events = [(p, rng.randrange(6000), rng.choice(kinds)) for p in range(1, 60) for _ in range(40)]
    s = study(clinic(spark, events))
    rows = s.outcomes_with(("OVUL2",)).persist()
    try:
        found = [st.starts_of_kind(rows, "OVUL2", s.rules, n).collect() for n in (None, 1, 7, 40)]
    finally:
        rows.unpersist()
    assert len(found[0]) > 5
    assert all(sorted(some) == sorted(found[0]) for some in found)


def test_tables_of_unknown_size_get_the_partitions_asked_for(spark):
    rows = spark.sparkContext.parallelize([(1,), (2,)]).toDF(["person_id"])
    assert layout.input_bytes(rows) is None
    assert layout.partitions_for([rows]) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_large_saved_stage_has_the_buckets_asked_for(spark, tmp_path, monkeypatch):
    cdm = driver_cdm(spark, SMALL)
    small_partitions(monkeypatch, layout.input_bytes(cdm.drug_exposure) // 10)
    spark.sql(f"CREATE DATABASE dealt LOCATION '{tmp_path}/dealt'")
    try:
        study(cdm).save("dealt.settled")
        own = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert len(spark.table("dealt.settled").inputFiles()) == own
    finally:
        spark.sql("DROP DATABASE dealt CASCADE")


def test_pools_are_counted_before_there_is_a_row_per_step(spark):
    """Equal events are one before each becomes a row per step, and no sort holds a row per step."""
    plan = physical(all_queries()["dedupe_events"](spark, SMALL))
    assert not re.search(r"windowspecdefinition\([^)]*target", plan)
    assert not re.search(r"hashpartitioning\([^)]*target", plan)
    lines = plan.split("\n")
    step = next(i for i, x in enumerate(lines) if "Generate explode(filter(" in x)
    assert "HashAggregate" in "\n".join(lines[step + 1 : step + 3])

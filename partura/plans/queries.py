"""One query per operator, over clinical views of the order tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partura.functions.days import to_date
from partura.operators import episodes as ep
from partura.operators import outcomes as oc
from partura.operators import starts as st
from partura.operators import timeline as tl
from partura.plans.pipeline import Study, study
from partura.rules import Rules
from partura.sources.cdm import Cdm
from partura.sources.driver_tables import FIRST_PERSON, driver_cdm

Query = Callable[[SparkSession, str], DataFrame]

MATCHED = ("category", "gest_value", "person_id", "start_date", "type")


# --- sources ------------------------------------------------------------------------------------


def outcomes_with_lookup(s: Study, spark: SparkSession, name: str) -> DataFrame:
    """Outcome events joined to their row of a lookup table, as the start search uses it."""
    table = s.lookups.frames(spark)[name].drop("gest_est_id")
    events = s.numbered.filter(F.col("category").isin(*s.rules.targets))
    return events.select("person_id", "event_id", "category").join(F.broadcast(table), "category")


def accepted_with_gap(s: Study, spark: SparkSession) -> DataFrame:
    """Accepted outcomes with the minimum gap to the accepted outcome before them."""
    limits = s.lookups.frames(spark)["outcome_limit"].select(
        F.col("first_preg_category").alias("prior_category"),
        F.col("outcome_preg_category").alias("category"),
        "min_days",
    )
    by_day = Window.partitionBy("person_id").orderBy("event_date")
    return (
        oc.valid_outcomes(s.settled, s.lookups, s.rules)
        .withColumn("prior_category", F.lag("category").over(by_day))
        .withColumn("days", F.datediff("event_date", F.lag("event_date").over(by_day)))
        .join(F.broadcast(limits), ["prior_category", "category"])
        .select("person_id", "event_id", "prior_category", "category", "days", "min_days")
    )


def lookup_use(s: Study, spark: SparkSession, name: str) -> DataFrame:
    """Every row of a lookup table by outcome type, with the accepted outcomes that use it."""
    table = s.lookups.frames(spark)[name].drop("gest_est_id")
    used = oc.valid_outcomes(s.outcome_people, s.lookups, s.rules).groupBy("category")
    return _with_counts(table, used.agg(F.count("*").alias("n_outcomes")), ["category"])


def gap_use(s: Study, spark: SparkSession) -> DataFrame:
    """Every minimum gap, with how often accepted outcomes of its types follow each other."""
    table = s.lookups.frames(spark)["outcome_limit"].select(
        F.col("first_preg_category").alias("prior_category"),
        F.col("outcome_preg_category").alias("category"),
        "min_days",
    )
    by_day = Window.partitionBy("person_id").orderBy("event_date")
    pairs = ["prior_category", "category"]
    used = (
        oc.valid_outcomes(s.outcome_people, s.lookups, s.rules)
        .withColumn("prior_category", F.lag("category").over(by_day))
        .groupBy(*pairs)
    )
    return _with_counts(table, used.agg(F.count("*").alias("n_outcomes")), pairs)


def _with_counts(table: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(counts, keys, "left").fillna(0, ["n_outcomes"])


def matched(s: Study, records: Callable[[Cdm], DataFrame]) -> DataFrame:
    return tl.match(records(s.cdm), s.cdm, s.rules)


# --- outcome selection --------------------------------------------------------------------------


def pool_rows(s: Study) -> DataFrame:
    pools = oc.event_pools(s.settled, s.lookups, s.rules)
    date = to_date(F.col("day")).alias("event_date")
    return pools.select("target", "person_id", "event_id", "category", date, "gest_value")


def accepted(s: Study, target: str) -> DataFrame:
    found = oc.valid_outcomes(s.outcome_people, s.lookups, s.rules, through=target)
    return found.filter(F.col("category") == target).select("person_id", "event_id")


def all_accepted(s: Study) -> DataFrame:
    return oc.valid_outcomes(s.outcome_people, s.lookups, s.rules).select("person_id", "event_id")


# --- episodes -----------------------------------------------------------------------------------


def unnumbered(episodes: DataFrame) -> DataFrame:
    """Episodes as rows without a number."""
    return episodes.select(
        "person_id",
        to_date(F.col("start_day")).alias("episode_start_date"),
        to_date(F.col("end_day")).alias("episode_end_date"),
        "start_category",
        "outcome_category",
    )


STUDY_QUERIES: dict[str, Callable[[Study], DataFrame]] = {
    "cdm_scan_counts": lambda s: s.cdm.scan_counts(),
    "concept_match_condition": lambda s: matched(s, tl.condition_records).select(*MATCHED),
    "concept_match_procedure": lambda s: matched(s, tl.procedure_records).select(*MATCHED),
    "concept_match_observation": lambda s: matched(s, tl.observation_records),
    "concept_match_measurement": lambda s: matched(s, tl.measurement_records),
    "raw_events": lambda s: tl.raw_events(s.cdm, s.rules),
    "gest_days": lambda s: tl.with_gestation_days(tl.raw_events(s.cdm, s.rules)).select(
        "person_id", "category", "start_date", "gest_value"
    ),
    "exclude_single_category": lambda s: tl.people_with_screening_only(
        tl.raw_events(s.cdm, s.rules), s.rules
    ),
    "events_nondrug": lambda s: tl.nondrug_events(s.cdm, s.rules),
    "concept_expansion": lambda s: tl.drug_concepts(s.cdm, s.rules),
    "events_drug": lambda s: tl.drug_events(s.cdm, s.rules),
    "events_all": lambda s: tl.all_events(s.cdm, s.rules),
    "event_timeline": lambda s: tl.event_timeline(s.numbered),
    "target_people": lambda s: oc.people_with_target(s.numbered, s.rules),
    "category_universe": lambda s: oc.pool_counts(s.numbered, s.lookups, s.rules),
    "dedupe_events": pool_rows,
    "next_outcome": lambda s: oc.next_outcomes(s.picked),
    "min_gap_delete": lambda s: oc.removed_by_gap(s.pool_passes, s.rules),
    "valid_lb": lambda s: accepted(s, "LB"),
    "rule_out_active": lambda s: oc.ruled_out(s.settled, s.rules),
    "prior_flag": lambda s: oc.prior_flags(s.picked, s.rules),
    "min_gap_conflict": lambda s: oc.gap_conflicts(s.picked),
    "accept_outcome": lambda s: oc.acceptances(s.picked),
    "outcome_decisions": lambda s: oc.decisions(s.picked),
    "accept_ect": lambda s: accepted(s, "ECT"),
    "ect_confirmation": lambda s: oc.confirmations(s.numbered, "ECT", s.rules),
    "ect_revised_date": lambda s: oc.revised_dates(s.numbered, "ECT", s.rules),
    "ab_revised_date": lambda s: oc.revised_dates(s.numbered, "AB", s.rules),
    "sa_revised_date": lambda s: oc.revised_dates(s.numbered, "SA", s.rules),
    "revised_timeline": lambda s: tl.event_timeline(s.settled),
    "pool_remaining": lambda s: oc.remaining_pools(s.pool_passes),
    "valid_outcomes": all_accepted,
    "outcome_events": lambda s: st.outcome_events(s.outcomes_with()),
    "prior_outcome_asof": lambda s: st.prior_outcomes(s.outcomes_with()),
    "term_marker_counts": lambda s: st.marker_counts(s.outcomes_with(markers=st.MARKERS)),
    "start_default": lambda s: st.default_starts(
        s.outcomes_with(markers=st.DEFAULT_MARKERS), s.lookups, s.rules
    ),
    "all_starts": lambda s: st.candidate_starts(s.picks, s.rules, "starts"),
    "best_start": lambda s: st.candidate_starts(s.picks, s.rules, "best"),
    "refined_start": lambda s: st.candidate_starts(s.picks, s.rules, "refined"),
    "episode_all_starts": lambda s: ep.all_starts(s.picks, s.rules),
    "episode_best": lambda s: unnumbered(s.best),
    "episode_enrolled": lambda s: unnumbered(s.enrolled),
    "episode_eligible": lambda s: unnumbered(s.eligible),
    "episode_numbered": lambda s: ep.episode_rows(s.numbered_episodes),
    "episode_two_events": lambda s: ep.episode_rows(s.supported_episodes),
    "pregnancy_episodes": lambda s: ep.final_episodes(s.supported_episodes, s.rules),
}

LOOKUP_QUERIES: dict[str, Callable[[Study, SparkSession], DataFrame]] = {
    "lookup_outcome_limit": accepted_with_gap,
    "lookup_term_durations": lambda s, spark: outcomes_with_lookup(s, spark, "term_durations"),
    "lookup_gest_est": lambda s, spark: outcomes_with_lookup(s, spark, "gest_est"),
    "lookup_outcome_limit_use": gap_use,
    "lookup_term_durations_use": lambda s, spark: lookup_use(s, spark, "term_durations"),
    "lookup_gest_est_use": lambda s, spark: lookup_use(s, spark, "gest_est"),
}

# Query name, evidence, second-ovulation mode.
START_QUERIES = {
    "start_lmp": ("LMP", "reference"),
    "start_gest": ("GEST", "reference"),
    "start_ovul": ("OVUL", "reference"),
    "start_ovul2_reference": ("OVUL2", "reference"),
    "start_ovul2_corrected": ("OVUL2", "corrected"),
    "start_nuls": ("NULS", "reference"),
    "start_afp": ("AFP", "reference"),
    "start_amen": ("AMEN", "reference"),
    "start_up": ("UP", "reference"),
    "start_pushback": ("PUSHBACK", "reference"),
    "start_contra": ("CONTRA", "reference"),
}


# Also run with people left out before their rows are counted.
EARLY_QUERIES = ("valid_outcomes", "pregnancy_episodes")
# Also run with person ids from 1 on, so that ids and event numbers meet.
SMALL_ID_QUERIES = ("start_ovul2_reference", "pregnancy_episodes")


def all_queries() -> dict[str, Query]:
    def plain(
        make: Callable[[Study], DataFrame],
        first_person: int = FIRST_PERSON,
        rules: Rules | None = None,
    ) -> Query:
        return lambda spark, sf_dir: make(study(driver_cdm(spark, sf_dir, first_person), rules=rules))

    def lookup(make: Callable[[Study, SparkSession], DataFrame]) -> Query:
        return lambda spark, sf_dir: make(study(driver_cdm(spark, sf_dir)), spark)

    def start(name: str, mode: str, first_person: int = FIRST_PERSON) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            s = study(driver_cdm(spark, sf_dir, first_person), rules=Rules(ovul2_join=mode))
            return st.starts_of_kind(s.outcomes_with((name,)), name, s.rules, s.partitions)

        return query

    queries = {
        **{name: plain(make) for name, make in STUDY_QUERIES.items()},
        **{name: lookup(make) for name, make in LOOKUP_QUERIES.items()},
        **{name: start(*how) for name, how in START_QUERIES.items()},
    }
    for name in EARLY_QUERIES:
        queries[f"{name}_early"] = plain(STUDY_QUERIES[name], rules=Rules(early_people=True))
    for name in SMALL_ID_QUERIES:
        if name in START_QUERIES:
            queries[f"{name}_small_ids"] = start(*START_QUERIES[name], first_person=0)
        else:
            queries[f"{name}_small_ids"] = plain(STUDY_QUERIES[name], first_person=0)
    return queries

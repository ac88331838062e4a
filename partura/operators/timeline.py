"""From coded clinical rows to one numbered event timeline per person.

Rows are matched against the concept set where they lie (no shuffle), counted per (person, day,
category, value), and only those counts are brought together by person.
"""

from __future__ import annotations

from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partura.functions.days import to_date, to_day
from partura.functions.joins import broadcast_if_small
from partura.functions.layout import partitions_for
from partura.functions.membership import field_of, maybe_in
from partura.functions.runs import expand_runs
from partura.functions.text import literal, one_of
from partura.rules import Rules
from partura.sources.cdm import Cdm

ANY_VALUE = "N/A"
FAR_DAYS = 10_000_000  # beyond any date
RUN_KEYS = ["person_id", "day", "category", "gest_value"]
# Ascending order puts nulls first.
RUN_ORDER = ["day", "category", "gest_value"]


# --- matching -----------------------------------------------------------------------------------


def _records(
    events: DataFrame, kind: str, concept_id: str, date: str, text: str | None = None
) -> DataFrame:
    """One domain in the common layout. Domains without ``text`` have no value to compare."""
    value, number = ("' '", "NULL") if text is None else (text, "value_as_number")
    return events.selectExpr(
        "CAST(person_id AS BIGINT) AS person_id",
        f"{concept_id} AS concept_id",
        f"CAST({date} AS DATE) AS start_date",
        f"'{kind}' AS type",
        f"{str(text is not None).lower()} AS has_value",
        f"{value} AS value_as_string",
        f"CAST({number} AS DOUBLE) AS value_as_number",
    )


def condition_records(cdm: Cdm) -> DataFrame:
    return _records(
        cdm.condition_occurrence, "Cond", "condition_concept_id", "condition_start_date"
    )


def procedure_records(cdm: Cdm) -> DataFrame:
    return _records(cdm.procedure_occurrence, "Proc", "procedure_concept_id", "procedure_date")


def observation_records(cdm: Cdm) -> DataFrame:
    return _records(
        cdm.observation, "Obs", "observation_concept_id", "observation_date", "value_as_string"
    )


def measurement_records(cdm: Cdm) -> DataFrame:
    return _records(
        cdm.measurement, "Meas", "measurement_concept_id", "measurement_date", "value_source_value"
    )


class Concepts(NamedTuple):
    """Concepts to match with, broadcast if that is safe, and their ids where these are few."""

    table: DataFrame
    ids: list[int] | None

    def scan(self, records: DataFrame, concept_id: str) -> DataFrame:
        """``records`` of few ids only, by a filter that reaches the scan: files and row groups without
        any of them are skipped. More ids are left to the join alone."""
        return records if self.ids is None else records.filter(F.col(concept_id).isin(self.ids))


def sized(concepts: DataFrame, rules: Rules) -> Concepts:
    """Read up to ``scan_ids`` rows of ``concepts``; where that is all of them, they are few."""
    rows = concepts.select("concept_id").limit(rules.scan_ids + 1).collect()
    if len(rows) > rules.scan_ids:
        return Concepts(broadcast_if_small(concepts, rules), None)
    ids = sorted({row.concept_id for row in rows if row.concept_id is not None})
    return Concepts(F.broadcast(concepts), ids)


def match(records: DataFrame, cdm: Cdm, rules: Rules) -> DataFrame:
    """Records whose concept is in the set; a record's value must fit where the set asks for one.

    Without a required value in the set ('N/A'), any value fits.
    """
    concepts = cdm.pregnancy_concepts.select(
        "concept_id", "category", F.col("gest_value").cast("double").alias("gest_value"), "data_value"
    )
    wanted, found = F.col("data_value"), F.col("value_as_string")
    if rules.normalize_values:
        wanted, found = F.upper(F.rtrim(wanted)), F.upper(F.rtrim(found))
    fits = ~F.col("has_value") | (wanted == ANY_VALUE) | (wanted == found)
    concepts = sized(concepts, rules)
    return (
        concepts.scan(records, "concept_id")
        .join(concepts.table, "concept_id")
        .filter(fits)
        .select(
            "category", "gest_value", "person_id", "start_date", "type", "value_as_string",
            "value_as_number",
        )
    )


def raw_events(cdm: Cdm, rules: Rules) -> DataFrame:
    """Matched rows of the four non-drug domains, duplicates kept, in one pass over the set."""
    records = (
        condition_records(cdm)
        .unionByName(procedure_records(cdm))
        .unionByName(observation_records(cdm))
        .unionByName(measurement_records(cdm))
    )
    return match(records, cdm, rules)


def gestation_days(category: Column, recorded_weeks: Column, concept_weeks: Column) -> Column:
    """Gestational age in days: the recorded value, else the concept's; only for GEST."""
    return F.when(category == "GEST", 7 * F.coalesce(recorded_weeks, concept_weeks))


def with_gestation_days(raw: DataFrame) -> DataFrame:
    days = gestation_days(F.col("category"), F.col("value_as_number"), F.col("gest_value"))
    return raw.withColumn("gest_value", days)


def people_with_screening_only(raw: DataFrame, rules: Rules) -> DataFrame:
    """People whose matched rows are all of the screening category."""
    screening = F.col("category") == rules.screening_category
    return (
        raw.filter(F.col("category").isNotNull())
        .groupBy("person_id")
        .agg(F.bool_and(screening).alias("screening_only"))
        .filter("screening_only")
        .select("person_id")
    )


def drug_concepts(cdm: Cdm, rules: Rules) -> DataFrame:
    """Drug concepts below the concept set's drug classes, one row per path."""
    roots = cdm.pregnancy_concepts.filter(F.col("category").isin(*rules.drug_categories)).select(
        F.col("concept_id").alias("ancestor_concept_id"),
        "category",
        F.col("gest_value").cast("double").alias("gest_value"),
    )
    below = cdm.concept_ancestor.join(
        broadcast_if_small(roots, rules), "ancestor_concept_id"
    ).select(F.col("descendant_concept_id").alias("concept_id"), "category", "gest_value")
    drugs = cdm.concept.filter(F.col("concept_class_id").isin(*rules.drug_classes))
    return drugs.select("concept_id", "concept_name").join(below, "concept_id")


def drug_dimension(cdm: Cdm, rules: Rules) -> Concepts:
    """The expanded concepts as drug exposures are joined with them. Their ids may be read here."""
    concepts = drug_concepts(cdm, rules).select("concept_id", "category", "gest_value")
    return sized(concepts, rules)


def match_drugs(cdm: Cdm, rules: Rules, concepts: Concepts | None = None) -> DataFrame:
    """Drug exposures to the expanded concepts; the concept's gestation value is passed as is."""
    concepts = concepts or drug_dimension(cdm, rules)
    exposures = concepts.scan(cdm.drug_exposure, "drug_concept_id")
    return exposures.join(
        concepts.table,
        exposures["drug_concept_id"] == concepts.table["concept_id"],
    ).select(
        F.col("person_id").cast("long").alias("person_id"),
        "category",
        F.col("drug_exposure_start_date").cast("date").alias("start_date"),
        "gest_value",
    )


def outcome_people_field(cdm: Cdm, rules: Rules) -> DataFrame:
    """Who may have an outcome event, as a bit field of fixed size, from the outcome concepts alone."""
    wanted = cdm.pregnancy_concepts.filter(F.col("category").isin(*rules.targets))
    return field_of(raw_events(replace(cdm, pregnancy_concepts=wanted), rules), "person_id")


# --- counting -----------------------------------------------------------------------------------


def event_runs(
    cdm: Cdm,
    rules: Rules,
    starts_only: bool = False,
    drugs: bool = True,
    concepts: Concepts | None = None,
    people: DataFrame | None = None,
) -> DataFrame:
    """Counted events per (person, day, category, value), with drug and other rows apart.

    With ``people``, a bit field, rows of anyone who is surely not in it are left out where they lie.

    A gestation that is missing or too long becomes null, which marks it as invalid. With
    ``starts_only`` the value is the whole number of days from a GEST record back to the start
    it implies. That is all the episodes need, and it bounds the runs of a person by days and
    not by how many fractions of a week were written down.
    """
    limit = rules.max_gestation_days
    coded = with_gestation_days(raw_events(cdm, rules)).select(
        "person_id",
        to_day(F.col("start_date")).alias("day"),
        "category",
        F.when(F.col("gest_value") <= limit, F.col("gest_value")).alias("gest_value"),
        F.lit(False).alias("is_drug"),
    )
    coded = coded if people is None else maybe_in(coded, "person_id", people)
    events = coded
    if drugs:
        matched = match_drugs(cdm, rules, concepts).select(
            "person_id",
            to_day(F.col("start_date")).alias("day"),
            "category",
            "gest_value",
            F.lit(True).alias("is_drug"),
        )
        matched = matched if people is None else maybe_in(matched, "person_id", people)
        events = coded.unionByName(matched)
    events = events.filter(F.col("category").isNotNull())
    if starts_only:
        events = whole_days(events)
    runs = events.groupBy(*RUN_KEYS).agg(
        F.count_if(~F.col("is_drug")).alias("n_coded"), F.count_if("is_drug").alias("n_drug")
    )
    partitions = person_partitions(cdm)
    return runs if partitions is None else runs.repartition(partitions, "person_id")


def person_partitions(cdm: Cdm) -> int | None:
    """Partitions that runs are dealt to by person, or none to leave that to Spark."""
    return partitions_for(
        (
            cdm.condition_occurrence,
            cdm.procedure_occurrence,
            cdm.observation,
            cdm.measurement,
            cdm.drug_exposure,
        )
    )


def whole_days(events: DataFrame) -> DataFrame:
    """Put the days back to the start that a GEST record implies in place of its value.

    A start far after its record is no evidence for any outcome, but the record still counts.
    No value, the mark of an invalid record, stays none (``least`` alone would pass over it).
    """
    value = F.col("gest_value")
    days = F.least(1 - value, F.lit(float(FAR_DAYS))).cast("int")
    usable = (F.col("category") == "GEST") & value.isNotNull()
    return events.withColumn("gest_value", F.when(usable, days))


def eligible_runs(runs: DataFrame, rules: Rules, targets_only: bool = False) -> DataFrame:
    """Drop invalid gestations, people with screening rows only, and drugs of people without
    any other event, and number the rest: ``event_id`` is the number of a run's first event.

    With ``targets_only`` also drop people who have no outcome event. All of it shares one sort:
    a kept person keeps every valid run, so valid runs can be numbered before people are dropped.
    """
    valid = "(category <> 'GEST' OR gest_value IS NOT NULL)"
    order = f"PARTITION BY person_id ORDER BY {', '.join(RUN_ORDER)} ROWS BETWEEN"
    everywhere = f"OVER ({order} UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    so_far = f"OVER ({order} UNBOUNDED PRECEDING AND CURRENT ROW)"
    needs = [f"n_coded > 0 AND category <> {literal(rules.screening_category)}",
             f"n_coded > 0 AND {valid}"]
    if targets_only:
        needs.append(one_of("category", rules.targets))
    keep = " AND ".join(f"bool_or({need}) {everywhere}" for need in needs)
    return (
        runs.selectExpr("*", "n_coded + n_drug AS n_events")
        .selectExpr(
            "*",
            f"{keep} AS keep",
            f"sum(IF({valid}, n_events, 0)) {so_far} - n_events + 1 AS event_id",
        )
        .filter(f"keep AND {valid}")
        .drop("keep")
    )


def numbered_runs(
    cdm: Cdm,
    rules: Rules,
    starts_only: bool = False,
    targets_only: bool = False,
    concepts: Concepts | None = None,
) -> DataFrame:
    """The timeline as runs: person, day, category, value, count and first event number."""
    early = targets_only and rules.early_people
    people = outcome_people_field(cdm, rules) if early else None
    events = event_runs(cdm, rules, starts_only, concepts=concepts, people=people)
    runs = eligible_runs(events, rules, targets_only)
    return runs.drop("n_coded", "n_drug")


# --- the same steps as rows ---------------------------------------------------------------------


def _rows(runs: DataFrame, count: str, date: str) -> DataFrame:
    spread = ["person_id", "day", "category"]
    return expand_runs(runs.filter(F.col(count) > 0), spread, count).select(
        "person_id", "category", to_date(F.col("day")).alias(date), "gest_value"
    )


def nondrug_events(cdm: Cdm, rules: Rules) -> DataFrame:
    """Whether a person and a coded event stay depends on coded events alone, so no drug is read."""
    return _rows(eligible_runs(event_runs(cdm, rules, drugs=False), rules), "n_coded", "start_date")


def drug_events(cdm: Cdm, rules: Rules) -> DataFrame:
    return _rows(eligible_runs(event_runs(cdm, rules), rules), "n_drug", "start_date")


def all_events(cdm: Cdm, rules: Rules) -> DataFrame:
    return _rows(eligible_runs(event_runs(cdm, rules), rules), "n_events", "event_date")


def event_timeline(runs: DataFrame) -> DataFrame:
    """One row per event with its number. ``runs`` may be numbered or settled runs."""
    rows = expand_runs(runs, ["person_id", "event_id"], "n_events", "event_id")
    return rows.select(
        "person_id", "event_id", "category", to_date(F.col("day")).alias("event_date"), "gest_value"
    )

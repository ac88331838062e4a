"""Small clinical inputs written as events per person."""

from __future__ import annotations

import datetime as dt

from partura.functions.inline import inline_table
from partura.rules import START_RULES, STEPS
from partura.sources.cdm import CONCEPT_SET_SCHEMA, Cdm

DAY_0 = dt.date(2000, 1, 1)

CODED = sorted(
    {step.target for step in STEPS}
    | {c for step in STEPS for c in (*step.pool_extra, *step.moved_by, *step.confirmed_by)}
    | {c for rule in START_RULES for c in rule.categories}
    | {"PREM", "POSTT", "FT", "TRO", "DIAB"}
)
CONCEPTS = {category: 100 + i for i, category in enumerate(CODED)}
DRUG_ROOTS = {"CONTRA": 900, "MTX": 901, "OVULDR": 902}


def day(n: int) -> dt.date:
    return DAY_0 + dt.timedelta(days=n)


def clinic(spark, events, periods=None, people=None, observations=(), drugs=(), concepts=()) -> Cdm:
    """``events``: (person, day, category[, weeks]); ``drugs``: (person, day, category);
    ``observations``: (person, day, concept id, text, number); ``concepts``: extra set rows."""
    rows = [(p, CONCEPTS[c], day(d)) for p, d, c, *weeks in events if not weeks]
    weeks = [(p, day(d), CONCEPTS[c], "x", float(w[0])) for p, d, c, *w in events if w]
    weeks += [(p, day(d), i, text, number) for p, d, i, text, number in observations]
    ids = {e[0] for e in [*events, *drugs, *observations]}
    if periods is None:
        periods = [(p, day(-5000), day(9000)) for p in ids]
    if people is None:
        people = [(p, 8532, 1975) for p in ids]
    concept_set = [(i, c, None, "N/A") for c, i in CONCEPTS.items()]
    concept_set += [(i, c, None, "N/A") for c, i in DRUG_ROOTS.items()]

    def frame(data, schema):
        return spark.createDataFrame(list(data), schema)

    return Cdm(
        condition_occurrence=frame(
            rows, "person_id long, condition_concept_id int, condition_start_date date"
        ),
        procedure_occurrence=frame(
            [], "person_id long, procedure_concept_id int, procedure_date date"
        ),
        observation=frame(
            weeks,
            "person_id long, observation_date date, observation_concept_id int, "
            "value_as_string string, value_as_number double",
        ),
        measurement=frame(
            [],
            "person_id long, measurement_concept_id int, measurement_date date, "
            "value_source_value string, value_as_number double",
        ),
        drug_exposure=frame(
            [(p, DRUG_ROOTS[c] + 1000, day(d)) for p, d, c in drugs],
            "person_id long, drug_concept_id int, drug_exposure_start_date date",
        ),
        concept=frame(
            [(i + 1000, c, "Ingredient") for c, i in DRUG_ROOTS.items()],
            "concept_id int, concept_name string, concept_class_id string",
        ),
        concept_ancestor=frame(
            [(i, i + 1000) for i in DRUG_ROOTS.values()],
            "ancestor_concept_id int, descendant_concept_id int",
        ),
        observation_period=frame(
            periods,
            "person_id long, observation_period_start_date date, observation_period_end_date date",
        ),
        person=frame(people, "person_id long, gender_concept_id int, year_of_birth int"),
        pregnancy_concepts=inline_table(spark, [*concept_set, *concepts], CONCEPT_SET_SCHEMA),
    )

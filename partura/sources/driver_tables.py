"""Clinical views over the order tables used for tests and benchmarks.

Orders stand in for people's records: each order line becomes one clinical row, its line number
chooses the table, its part the concept, its ship date the day within four years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from partura.functions.inline import inline_table
from partura.functions.layout import partitions_for
from partura.functions.text import listed
from partura.sources.cdm import CONCEPT_SET_SCHEMA, Cdm

FIRST_PERSON = 1_000_001
FIRST_DAY = "1995-01-01"
DAYS = 1461
# Bytes of lines and orders for each partition of their joins, whose tasks sort them as rows several
# times as wide and count what they find.
BYTES_PER_JOIN = 16 << 20

# Concept id, category, gestation in weeks, required value.
CONCEPT_SET = [
    (1000, "LB", None, "N/A"),
    (1001, "SB", None, "N/A"),
    (1002, "DELIV", None, "N/A"),
    (1003, "ECT", None, "N/A"),
    (1004, "AB", None, "N/A"),
    (1005, "SA", None, "N/A"),
    (1006, "TRO", None, "N/A"),
    (1007, "AGP", None, "N/A"),
    (1008, "PCONF", None, "N/A"),
    (1009, "PREM", None, "N/A"),
    (1010, "FT", None, "N/A"),
    (1011, "POSTT", None, "N/A"),
    (1012, "LMP", None, "N/A"),
    (1013, "AMEN", None, "N/A"),
    (1014, "UP", None, "N/A"),
    (1015, "PCOMP", None, "N/A"),
    (1016, "TA", None, "N/A"),
    (1017, "GEST", 20.0, "N/A"),
    (2000, "ECT_SURG1", None, "N/A"),
    (2001, "ECT_SURG2", None, "N/A"),
    (2002, "AB", None, "N/A"),
    (2003, "SA", None, "N/A"),
    (2004, "DELIV", None, "N/A"),
    (2005, "LB", None, "N/A"),
    (2006, "OVUL", None, "N/A"),
    (2007, "OVUL2", None, "N/A"),
    (2008, "NULS", None, "N/A"),
    (2009, "AFP", None, "N/A"),
    (2010, "DIAB", None, "N/A"),
    (3000, "GEST", None, "N/A"),
    (3001, "LMP", None, "R"),
    (3002, "PCONF", None, "A"),
    (3003, "DIAB", None, "N/A"),
    (3004, "AGP", None, "N/A"),
    (4000, "AFP", None, "N/A"),
    (4001, "NULS", None, "F"),
    (4002, "DIAB", None, "N/A"),
    (4003, "GEST", None, "N/A"),
    (9001, "CONTRA", None, "N/A"),
    (9002, "MTX", None, "N/A"),
    (9003, "OVULDR", None, "N/A"),
]
DRUG_CLASS_CYCLE = (
    "Branded Drug",
    "Branded Pack",
    "Clinical Drug",
    "Clinical Pack",
    "Ingredient",
    "Drug Class",
)


def concept_set(spark: SparkSession) -> DataFrame:
    return inline_table(spark, CONCEPT_SET, CONCEPT_SET_SCHEMA)


def driver_cdm(spark: SparkSession, sf_dir: str, first_person: int = FIRST_PERSON) -> Cdm:
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    orders = read("orders").select("o_orderkey", "o_custkey")
    lines = read("lineitem")
    customer = read("customer")
    dealt = partitions_for((lines, orders), BYTES_PER_JOIN)

    def by_order(rows: DataFrame, key: str) -> DataFrame:
        """Large tables in a number of partitions that grows with them; adaptive execution, which judges
        by compressed bytes, would bring them together until a task holds its 64 MB of these."""
        return rows if dealt is None else rows.repartition(dealt, key)

    orders = by_order(orders, "o_orderkey")
    day_0 = f"unix_date(DATE '{FIRST_DAY}')"
    day = f"date_from_unix_date({day_0} + (unix_date(CAST(l_shipdate AS DATE)) - {day_0}) % {DAYS})"

    def records(numbers: str, concept: str, concept_id: str, date: str, *values: str) -> DataFrame:
        own = by_order(lines.filter(f"l_linenumber IN ({numbers})"), "l_orderkey")
        return own.join(orders, own["l_orderkey"] == orders["o_orderkey"]).selectExpr(
            f"o_custkey + {first_person} AS person_id",
            f"CAST({concept} AS INT) AS {concept_id}",
            f"{day} AS {date}",
            *values,
        )

    def coded(base: int, cycle: int, screening: int) -> str:
        return f"IF(o_custkey % 50 = 7, {screening}, {base} + l_partkey % {cycle})"

    drugs = read("part").selectExpr("CAST(p_partkey % 40 AS INT) AS j").distinct()
    two = (
        "array(struct(DATE '1995-01-01' AS first, DATE '1996-12-31' AS last), "
        "struct(DATE '1997-01-01' AS first, DATE '1998-12-31' AS last))"
    )
    one = (
        "array(struct(date_add(DATE '1995-01-01', CAST(c_custkey % 200 AS INT)) AS first, "
        "date_sub(DATE '1998-12-31', CAST(c_custkey % 150 AS INT)) AS last))"
    )
    member = f"c_custkey + {first_person} AS person_id"
    return Cdm(
        condition_occurrence=records(
            "1, 2", coded(1000, 20, 0), "condition_concept_id", "condition_start_date"
        ),
        procedure_occurrence=records(
            "3", coded(2000, 12, 0), "procedure_concept_id", "procedure_date"
        ),
        observation=records(
            "4", coded(3000, 6, 3003), "observation_concept_id", "observation_date",
            "l_returnflag AS value_as_string", "l_quantity AS value_as_number",
        ),
        measurement=records(
            "5", coded(4000, 6, 0), "measurement_concept_id", "measurement_date",
            "l_linestatus AS value_source_value", "l_quantity AS value_as_number",
        ),
        drug_exposure=records(
            "6, 7", "5000 + l_partkey % 40", "drug_concept_id", "drug_exposure_start_date"
        ),
        concept=drugs.selectExpr(
            "5000 + j AS concept_id",
            "concat('drug ', j) AS concept_name",
            f"element_at(array({listed(DRUG_CLASS_CYCLE)}), j % 6 + 1) AS concept_class_id",
        ),
        concept_ancestor=drugs.filter("j < 30").selectExpr(
            "9001 + j % 3 AS ancestor_concept_id", "5000 + j AS descendant_concept_id"
        ),
        observation_period=customer.selectExpr(
            member, f"explode(IF(c_custkey % 10 = 0, {two}, {one})) AS p"
        ).selectExpr(
            "person_id",
            "p.first AS observation_period_start_date",
            "p.last AS observation_period_end_date",
        ),
        person=customer.selectExpr(
            member,
            "IF(c_custkey % 8 = 0, 8507, 8532) AS gender_concept_id",
            "CAST(1935 + (7 * c_custkey) % 55 AS INT) AS year_of_birth",
        ),
        pregnancy_concepts=concept_set(spark),
    )

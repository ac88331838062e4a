"""Result and lookup tables: create, write, drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from partura.operators.episodes import EPISODE_SCHEMA
from partura.sources.lookups import Lookups

RESULT_TABLE = "pregnancy_episodes"
LOOKUP_TABLES = ("outcome_limit", "term_durations", "gest_est")
CONCEPT_TABLE = "pregnancy_concepts"


def init(
    spark: SparkSession, schema: str, lookups: Lookups | None = None, buckets: int | None = None
) -> None:
    """Create the empty result table and load the lookup tables, replacing what is there.

    With ``buckets`` the result is bucketed by person, so later joins by person need no shuffle.
    """
    spark.sql(f"DROP TABLE IF EXISTS {schema}.{RESULT_TABLE}")
    clustered = f"CLUSTERED BY (person_id) INTO {int(buckets)} BUCKETS" if buckets else ""
    spark.sql(
        f"CREATE TABLE {schema}.{RESULT_TABLE} ({EPISODE_SCHEMA}) USING parquet {clustered}"
    )
    for name, frame in (lookups or Lookups()).frames(spark).items():
        frame.coalesce(1).write.mode("overwrite").saveAsTable(f"{schema}.{name}")


def load_lookups(spark: SparkSession, schema: str) -> Lookups:
    return Lookups.from_frames(*[spark.table(f"{schema}.{name}") for name in LOOKUP_TABLES])


def find_lookups(spark: SparkSession, schema: str) -> Lookups | None:
    """The lookups of a results schema, or None where it has none of the tables."""
    schema = schema or spark.catalog.currentDatabase()
    if not any(spark.catalog.tableExists(f"{schema}.{name}") for name in LOOKUP_TABLES):
        return None
    return load_lookups(spark, schema)


def load_concepts(spark: SparkSession, schema: str) -> DataFrame:
    """The concept set beside the results."""
    schema = schema or spark.catalog.currentDatabase()
    return spark.table(f"{schema}.{CONCEPT_TABLE}")


def buckets(spark: SparkSession, table: str) -> int | None:
    """Number of buckets of a table, None if it has none or is not there."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").take(1)
    return int(rows[0]["data_type"]) if rows else None


def write_episodes(episodes: DataFrame, table: str, mode: str = "append") -> None:
    """Append by default, so a second run adds its rows again; ``overwrite`` replaces them.

    ``insertInto`` keeps the table's own definition. Rows of a bucketed table are first brought
    together by bucket, so that a bucket is one file and not one per task.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    n = buckets(episodes.sparkSession, table)
    if n:
        episodes = episodes.repartition(n, "person_id")
    episodes.write.insertInto(table, overwrite=mode == "overwrite")


def clean(spark: SparkSession, schema: str) -> None:
    """Drop the lookup tables and the concept set. The result table stays."""
    for name in (CONCEPT_TABLE, *LOOKUP_TABLES):
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{name}")

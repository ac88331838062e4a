"""The ten clinical input tables."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONCEPT_SET_SCHEMA = "concept_id int, category string, gest_value double, data_value string"


@dataclass(frozen=True)
class Cdm:
    condition_occurrence: DataFrame
    procedure_occurrence: DataFrame
    observation: DataFrame
    measurement: DataFrame
    drug_exposure: DataFrame
    concept: DataFrame
    concept_ancestor: DataFrame
    observation_period: DataFrame
    person: DataFrame
    # The user's concept set: concept_id, category, gest_value (weeks), data_value.
    pregnancy_concepts: DataFrame | None = None

    @classmethod
    def table_names(cls) -> list[str]:
        return [f.name for f in fields(cls)]

    @classmethod
    def from_tables(
        cls,
        spark: SparkSession,
        schema: str,
        pregnancy_concepts: DataFrame | None = None,
        results_schema: str | None = None,
    ) -> "Cdm":
        """Tables of a catalog schema; the concept set may be given or lie in the results schema.

        Where it is nowhere, ``run`` takes the one beside its result table.
        """
        if pregnancy_concepts is None and results_schema is not None:
            pregnancy_concepts = spark.table(f"{results_schema}.pregnancy_concepts")

        def read(name: str) -> DataFrame | None:
            table = f"{schema}.{name}"
            optional = name == "pregnancy_concepts"
            return None if optional and not spark.catalog.tableExists(table) else spark.table(table)

        return cls._load(read, pregnancy_concepts)

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, directory: str, pregnancy_concepts: DataFrame | None = None
    ) -> "Cdm":
        """One Parquet file or folder per table."""
        return cls._load(
            lambda name: spark.read.parquet(f"{directory}/{name}.parquet"), pregnancy_concepts
        )

    @classmethod
    def _load(cls, read, pregnancy_concepts: DataFrame | None) -> "Cdm":
        names = cls.table_names()
        if pregnancy_concepts is not None:
            names.remove("pregnancy_concepts")
        tables = {name: read(name) for name in names}
        if pregnancy_concepts is not None:
            tables["pregnancy_concepts"] = pregnancy_concepts
        return cls(**tables)

    def scan_counts(self) -> DataFrame:
        """Rows per input table."""
        counts = [
            getattr(self, name).agg(F.count("*").alias("n_rows"))
            .select(F.lit(name).alias("table_name"), "n_rows")
            for name in self.table_names()
        ]
        result = counts[0]
        for other in counts[1:]:
            result = result.unionByName(other)
        return result

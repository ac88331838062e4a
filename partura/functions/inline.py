"""Small constant tables as inline SQL, whose size Catalyst knows when it plans a join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from partura.functions.text import listed


def inline_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    columns = [column.split() for column in schema.split(", ")]
    values = ", ".join(f"({listed(row)})" for row in rows)
    names = ", ".join(name for name, _ in columns)
    typed = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in columns)
    return spark.sql(f"SELECT {typed} FROM VALUES {values} AS t({names})")

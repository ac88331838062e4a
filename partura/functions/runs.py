"""Run-length encoding of bags of rows.

Equal rows are counted instead of moved. Counting combines on the map side, so a person who
holds a large share of all rows reaches the per-person stage as at most one row per distinct
day, category and value, however many raw rows there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most rows that one task writes out of one run before the run is divided.
CHUNK = 1 << 16


def expand_runs(df: DataFrame, by: list[str], count: str, number: str | None = None) -> DataFrame:
    """Undo the encoding: one row per counted row, numbered upwards from ``number`` if given.

    Long runs are cut in chunks that are spread over the cluster before they are written out.
    The number of partitions is given, since adaptive coalescing would judge the chunks by their
    own few bytes and bring them together again.
    """
    n = F.col(count)
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / CHUNK))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.withColumn("_chunk", F.explode(chunks)).repartition(partitions, *by, "_chunk")
    first = F.col("_chunk") * CHUNK
    offsets = F.sequence(first, F.least(n, first + CHUNK) - 1)
    rows = spread.withColumn("_offset", F.explode(offsets))
    if number is not None:
        rows = rows.withColumn(number, F.col(number) + F.col("_offset"))
    return rows.drop(count, "_chunk", "_offset")

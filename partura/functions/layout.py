"""How many partitions rows are dealt to by person.

The stage by person sorts its rows several times over, and adaptive execution would bring its partitions
together by their compressed bytes, to as many as there are cores: a task's memory would then grow with
the data. So large inputs are dealt to a given number of partitions, which grows with them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

# Bytes of input tables for each partition by person, and up to how many the exchange is left to Spark.
BYTES_PER_PARTITION = 64 << 20
SMALL_BYTES = 4 * BYTES_PER_PARTITION
# Estimates from here on stand for tables of unknown size.
UNKNOWN_BYTES = 1 << 60


def input_bytes(df: DataFrame) -> int | None:
    """Estimated size of all tables under a plan, or None where one is not known. Runs nothing."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    leaves = plan.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(size >= UNKNOWN_BYTES for size in sizes) else sum(sizes)


def partitions_for(tables: Iterable[DataFrame], each: int | None = None) -> int | None:
    """Partitions for what is derived from the tables: none for small ones, else one for ``each``
    bytes (BYTES_PER_PARTITION if not given), and at least ``spark.sql.shuffle.partitions``, which is all
    for an unknown size."""
    tables = list(tables)
    least = int(tables[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = [input_bytes(table) for table in tables]
    if None in sizes:
        return least
    if sum(sizes) <= SMALL_BYTES:
        return None
    return max(least, -(-sum(sizes) // (each or BYTES_PER_PARTITION)))

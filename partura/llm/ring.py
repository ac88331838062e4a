"""The next row in an order over the whole table, without one task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_below(bounds: list[int], x: Column) -> Column:
    """How many of the sorted `bounds` lie below x, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])

    def step(at: Column, by: Column) -> Column:
        inside = at + by <= len(bounds)
        return F.when(inside & (F.get(table, at + by - 1) < x), at + by).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def with_next(df: DataFrame, key: str, tie: str, columns: dict[str, str]) -> DataFrame:
    """Add columns of the row that follows by descending `key` (nulls last), then `tie`; after the last, the first.

    `columns` names what is taken and as what. Rows go to ranges of the key; the head of each range is also
    sent to the range before it, so rows move once and no range needs another. Ranges are cut at
    quantiles; their bounds and heads, a few for each shuffle partition, are all that reaches the driver.
    """
    spark = df.sparkSession
    n = 4 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / n for i in range(1, n)]
    cuts = df.agg(F.percentile_approx(key, shares, 10_000).alias("b")).first()["b"] or []
    part = F.when(F.col(key).isNull(), -1).otherwise(count_below(sorted(set(cuts)), F.col(key)))
    placed = df.withColumn("_part", part)
    heads = placed.groupBy("_part").agg(F.max(key).alias("_head")).orderBy(F.desc("_part")).collect()
    before = {h["_part"]: heads[i - 1]["_part"] for i, h in enumerate(heads)}
    kind = df.schema[key].dataType
    rows = [
        F.struct(F.lit(h["_head"]).cast(kind).alias("_head"), F.lit(before[h["_part"]]).alias("_to")) for h in heads
    ]
    if not rows:
        return df.select("*", *[F.col(c).alias(name) for c, name in columns.items()])
    sent = F.broadcast(spark.range(1).select(F.inline(F.array(*rows))))
    own = F.struct(F.col("_part").alias("part"), F.lit(False).alias("copy"))
    copy = F.when(F.col("_to").isNotNull(), F.struct(F.col("_to").alias("part"), F.lit(True).alias("copy")))
    w = Window.partitionBy("_at.part").orderBy(F.col("_at.copy"), F.col(key).desc_nulls_last(), tie)
    taken = [F.lead(c).over(w).alias(name) for c, name in columns.items()]
    return (
        placed.join(sent, F.col(key).eqNullSafe(F.col("_head")), "left")
        .withColumn("_at", F.explode(F.array_compact(F.array(own, copy))))
        .select(*df.columns, "_at", *taken)
        .where("not _at.copy")
        .drop("_at")
    )

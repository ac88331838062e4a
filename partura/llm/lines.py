"""Line dedup: repeated runs of lines from a suffix array, in DataFrame functions only.

A document is its sequence of line ids. Prefix doubling ranks all suffixes by their first 1, 2, 4, ... lines: the
rank of twice the length is the order of pairs (rank, rank so many lines on). Ranks come from a sort of the
distinct pairs, so a very frequent line is one row of it. A suffix whose prefix occurs once needs no
further rank and leaves; a suffix never runs past its document's end.

Equal ranks are the intervals of the suffix array with a common prefix of that length. Going back from
the longest length, each interval is split by the ranks of the lines that follow, halving the step, which
gives the intervals of the exact longest common prefixes. In an interval every suffix but the first in document order
repeats an earlier one over the interval's length; the first goes on to the enclosing interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partura.llm.fingerprints import SPACE, words
from partura.llm.storage import Workspace

MIN_WORDS = 50
BROADCAST_DOCS = 500_000  # changed documents whose places are sent to all texts; beyond, texts are joined by shuffle
AT = ["d", "h", "i"]  # document, hash of its text, number of the line among those not blank
FIRST = ["fd", "fh", "fi"]


def _lines(docs: DataFrame) -> DataFrame:
    """A row for each line that is not blank: where it is, two hashes as its id, and its words."""
    cut = F.transform(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)))
    line = F.posexplode(F.filter(cut, lambda x: x != ""))
    rows = docs.where("text is not null").select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), F.xxhash64("text").alias("h"), line.alias("i", "line")
    )
    return rows.select(
        *AT,
        F.xxhash64("line").alias("a"),
        F.xxhash64(F.lit(1), F.col("line")).alias("b"),
        F.size(words(F.col("line"))).alias("w"),
    )


def _position() -> Column:
    return F.struct(*AT)


def _ranked(pairs: DataFrame) -> DataFrame:
    """Rank in sorted order, and first place, of each pair (a, b) that occurs more than once."""
    several = pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(_position()).alias("m")).where("n > 1")
    return several.orderBy("a", "b").select(
        "a", "b", F.monotonically_increasing_id().alias("r"), *[F.col(f"m.{c}").alias(f) for c, f in zip(AT, FIRST)]
    )


def _levels(ws: Workspace, lines: DataFrame) -> list[DataFrame]:
    """Repeated suffixes by 1, 2, 4, ... lines: place, rank and first place of that rank."""
    ranks = ws.save(_ranked(lines), "ranks0")
    level = ws.save(lines.join(ranks, ["a", "b"]).drop("a", "b").dropDuplicates(AT), "level0")
    levels = []
    while not level.isEmpty():
        k = len(levels)
        levels.append(level)
        ws.drop(f"ranks{k}")
        w = Window.partitionBy("d", "h").orderBy("i").rangeBetween(1 << k, 1 << k)
        pairs = level.select(*AT, F.col("r").alias("a"), F.first("r").over(w).alias("b")).where("b is not null")
        pairs = ws.save(pairs, f"pairs{k}")
        ranks = ws.save(_ranked(pairs), f"ranks{k + 1}")
        level = ws.save(pairs.join(ranks, ["a", "b"]).drop("a", "b"), f"level{k + 1}")
        ws.drop(f"pairs{k}")
    return levels


def _is_first() -> Column:
    return (F.col("d") == F.col("fd")) & (F.col("h") == F.col("fh")) & (F.col("i") == F.col("fi"))


def _intervals(ws: Workspace, levels: list[DataFrame]) -> DataFrame | None:
    """(length, first place, place): suffixes whose common prefix is just that long, one for each longer interval."""
    held, key = None, ["length", *FIRST]
    for k in reversed(range(len(levels))):
        step = 1 << k
        if held is not None:
            on = levels[k].select(*AT[:2], (F.col("i")).alias("_i"), F.col("r").alias("c"))
            look = held.withColumn("_i", F.col("i") + F.col("length").cast("int"))
            look = look.join(on, [*AT[:2], "_i"], "left").drop("_i")
            longer = look.where("c is not null").groupBy(*key, "c")
            longer = longer.agg(F.count("*").alias("n"), F.min(_position()).alias("m")).where("n > 1").drop("n")
            split = look.join(longer, [*key, "c"], "left")
            stay = F.struct("length", *FIRST)
            deep = F.struct(
                (F.col("length") + step).alias("length"), *[F.col(f"m.{c}").alias(f) for c, f in zip(AT, FIRST)]
            )
            to = (
                F.when(F.col("m").isNull(), F.array(stay))
                .when(F.col("m") == _position(), F.array(deep, stay))
                .otherwise(F.array(deep))
            )
            held = split.select(*AT, F.explode(to).alias("g")).select("g.*", *AT)
        own = levels[k].select(F.lit(step).cast("long").alias("length"), *FIRST, *AT)
        if k + 1 < len(levels):
            more = levels[k + 1].where(~_is_first()).select(*AT)
            own = own.join(more, AT, "left_anti")
        held = ws.save(own if held is None else held.unionByName(own), f"held{k}")
        if k + 1 < len(levels):
            ws.drop(f"held{k + 1}")
    return held


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, ws: Workspace | None = None) -> DataFrame | None:
    """(d, h, i, n): from line i of a document n lines repeat an earlier run of at least `min_words` words.

    A run inside another of the document is left out. None if no line repeats.
    """
    ws = ws or Workspace(docs.sparkSession, "lines")
    lines = ws.save(_lines(docs), "lines")
    levels = _levels(ws, lines)
    ws.drop("lines")
    held = _intervals(ws, levels)
    if held is None:
        return None
    runs = held.where(~_is_first()).groupBy(*AT).agg(F.max("length").cast("int").alias("n"))
    # All lines of a run repeat, so words add up over the repeated lines alone.
    upto = Window.partitionBy("d", "h").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    sums = ws.save(levels[0].select(*AT, "w", F.sum("w").over(upto).alias("upto")), "sums")
    last = sums.select("d", "h", F.col("i").alias("e"), F.col("upto").alias("total"))
    sized = runs.join(sums, AT).withColumn("e", F.col("i") + F.col("n") - 1).join(last, ["d", "h", "e"])
    long = sized.where(F.col("total") - F.col("upto") + F.col("w") >= min_words)
    before = Window.partitionBy("d", "h").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    reach = long.withColumn("reach", F.max("e").over(before))
    out = ws.save(reach.where("reach is null or e > reach").select(*AT, "n"), "runs")
    ws.drop("sums", "held0", *[f"level{k}" for k in range(len(levels) + 1)])
    return out


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, ws: Workspace | None = None) -> DataFrame:
    """`docs` with later copies of repeated runs of lines deleted from `text`, and what was deleted.

    A maximal run of lines that occurs before, in an earlier document by doc_id or earlier in the same one, is deleted if it has
    at least `min_words` words, so its first copy always stays. Lines compare without white space around
    them; blank lines neither count nor go unless all other lines go. Columns added, replacing any of that name: `lines`
    (not blank), `lines_deleted`, and `spans`, the deleted runs as (line, lines). Null text stays null and empty stays
    empty. Rows with the same doc_id and text are one document and get one result; documents without a
    doc_id come first.
    """
    spark = docs.sparkSession
    ws = ws or Workspace(spark, "lines")
    base = docs.drop("lines", "lines_deleted", "spans")
    key = [c for c in ("doc_id", "text") if c in base.columns]
    typed = base.select(F.col(key[0]).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    runs = repeated_runs(typed, min_words, ws)
    spans = "array<struct<line:int,lines:int>>"
    if runs is None:
        cuts = base.withColumn("spans", F.array().cast(spans))
    else:
        by_doc = runs.groupBy("d", "h").agg(
            F.sort_array(F.collect_list(F.struct(F.col("i").alias("line"), F.col("n").alias("lines")))).alias("spans")
        )
        by_doc = ws.save(by_doc, "spans")
        by_doc = F.broadcast(by_doc) if by_doc.count() <= BROADCAST_DOCS else by_doc
        at = (F.coalesce(base["doc_id"].cast("long"), F.lit(-(1 << 63))) == by_doc["d"]) & (
            F.xxhash64(base["text"].cast("string")) == by_doc["h"]
        )
        cuts = base.join(by_doc, at, "left").drop("d", "h")
        cuts = cuts.withColumn("spans", F.coalesce("spans", F.array().cast(spans)))
    parts = cuts.withColumn("_lines", F.split("text", "\n", -1))
    places = F.sequence(F.lit(0), F.size("_lines") - 1)
    solid = F.filter(places, lambda p: F.btrim(F.get("_lines", p), F.lit(SPACE)) != "")
    parts = parts.withColumn("_solid", solid)
    gone = F.flatten(F.transform("spans", lambda s: F.slice("_solid", s["line"] + 1, s["lines"])))
    parts = parts.withColumn("_gone", F.array_distinct(gone))
    kept = F.transform(F.array_except(places, F.col("_gone")), lambda p: F.get("_lines", p))
    whole = F.size("_gone") == 0
    text = F.when(whole, F.col("text")).when(F.size("_gone") == F.size("_solid"), "").otherwise(F.array_join(kept, "\n"))
    n, deleted = F.size("_solid"), F.size("_gone")
    out = parts.withColumn("lines", F.when(F.col("text").isNull(), 0).otherwise(n))
    out = out.withColumn("lines_deleted", F.when(F.col("text").isNull(), 0).otherwise(deleted)).withColumn("text", text)
    return out.select(*base.columns, "lines", "lines_deleted", "spans")

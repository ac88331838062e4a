"""Source divergence audit: how far the sources of a language differ in the words they use.

Terms come from one pass of bytes.translate, which lowers letters and blanks separators, bytes.split, and a Counter for
each document. What leaves a task are counts by (lang, source, term); zero counts are never written, and enter
the sums by what they share: a source's probability of a term it does not have.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partura.llm.groups import block_pairs
from partura.llm.shipping import map_arrow, ship
from partura.llm.storage import Workspace

LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
HELD = 300_000  # counts that a task holds before it sends them on
SLICE = 1024  # kept terms of a language that meet in one group, on average
SOURCES = 512  # sources of a block

_LETTERS = bytes(range(ord("a"), ord("z") + 1))
#: A-Z become a-z; other ASCII that is not a letter becomes a space; bytes of longer characters stay.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _LETTERS else 32 for b in range(256)
)

_COUNTS = "lang string, source string, term string, docs long, n long"


def term_counts(text: bytes) -> Counter:
    """How often each term occurs in a text."""
    return Counter(text.translate(_TABLE).split())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), (docs, n) in held.items():
            columns[0] += [lang] * len(n)
            columns[1] += [source] * len(n)
            columns[2] += [t.decode() for t in n]
            columns[3] += [docs[t] for t in n]
            columns[4] += n.values()
        held.clear()
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        names = ["lang", "source", "term", "docs", "n"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    size = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = batch.column(2).cast(pa.large_binary())
        for lang, source, text in zip(langs, sources, texts):
            found = term_counts(text.as_py())
            docs, n = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            n.update(found)
            docs.update(found.keys())
            size += len(n) - before
            if size >= HELD:
                yield flush()
                size = 0
    if held:
        yield flush()


def _probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)) in exact arithmetic; 1 where there are no terms."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    low = (total + 2 * terms).cast("decimal(20,0)")
    share = F.call_function("div", top, F.when(low > 0, low))
    return F.lit(1).cast("long") + F.coalesce(share.cast("long"), F.lit(0))


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def pair_sums(table: pa.Table) -> pa.Table:
    """Part of the distance of each two sources of a pair of blocks, from one slice of a language's terms.

    Rows without a term state every source once, with its probability of a term that it does not have.
    """
    lang = table.column("lang")[0].as_py()
    first, second = table.column("bi")[0].as_py(), table.column("bj")[0].as_py()
    table = table.sort_by([("source", "ascending")])
    mark = table.column("term").is_null().to_numpy()
    own = table.filter(pa.array(mark))
    cells = table.filter(pa.array(~mark))
    names = own.column("source").to_pylist()
    zero = own.column("p").to_numpy()
    block = own.column("block").to_numpy()
    at = {name: k for k, name in enumerate(names)}
    codes = cells.column("source").combine_chunks().dictionary_encode()
    row = np.array([at[s] for s in codes.dictionary.to_pylist()], np.int64)[codes.indices.to_numpy()]
    column = cells.column("term").combine_chunks().dictionary_encode()
    terms = len(column.dictionary)
    p = np.repeat(zero[:, None], terms, axis=1)
    p[row, column.indices.to_numpy()] = cells.column("p").to_numpy()
    # Terms that no source here has count in one slice, by their number in the language.
    rest = (own.column("terms")[0].as_py() if table.column("slice")[0].as_py() == 0 else 0) - terms
    left, right, value = [], [], []
    for i in np.flatnonzero(block == first).tolist():
        others = np.flatnonzero(block == second)
        if first == second:
            others = others[others > i]
        if not len(others):
            continue
        q = p[others]
        found = ((q - p[i]) ** 2 // (q + p[i])).sum(axis=1)
        same = (zero[others] - zero[i]) ** 2 // (zero[others] + zero[i])
        found += same * rest
        left += [names[i]] * len(others)
        right += [names[j] for j in others.tolist()]
        value += found.tolist()
    return pa.table(
        {
            "lang": pa.array([lang] * len(left), pa.string()),
            "a": pa.array(left, pa.string()),
            "b": pa.array(right, pa.string()),
            "value": pa.array(value, pa.int64()),
        }
    )


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def divergence(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, ws: Workspace | None = None
) -> DataFrame:
    """(lang, source, part, item, value, rank): how the sources of each language of `docs` differ in their terms.

    A term is a run of ASCII letters and characters beyond ASCII; only A-Z are lowered. Terms in at least `least_docs`
    documents (rows) of a language are kept. With V kept terms in the language, N occurrences of them in a group and
    `count` of one of them, its share there is p = 1 + floor(10^9 * (count + 2) / (N + 2 V)). Two groups differ in a term by
    f = floor((p - q)^2 / (p + q)). Part `pair` holds for each source the sum of f over all kept terms to each other
    source of its language. Part `term` holds the `top` terms of the source that are more frequent there than in the
    language. Ranks go by falling value, then by item.

    Null lang, source and text are as ''. A document without terms still makes its source occur; without kept
    terms all pairs have value 0. Repeated rows count each. An empty table gives no rows. Other columns are ignored.
    What a task holds is bounded: counts by HELD, and dense shares by SLICE terms of two blocks of SOURCES sources.
    """
    spark = docs.sparkSession
    ws = ws or Workspace(spark, "divergence")
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = map_arrow(texts, _count, _COUNTS)
    # One shuffle by (lang, term): the documents of a term are known where its counts by source are.
    by_source = counts.repartition("lang", "term").groupBy("lang", "term", "source")
    by_source = by_source.agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    every = Window.partitionBy("lang", "term")
    kept = by_source.withColumn("docs", F.sum("docs").over(every)).withColumn("lang_n", F.sum("n").over(every))
    cells = ws.save(kept.where(F.col("docs") >= least_docs).select("lang", "term", "source", "n", "lang_n"), "cells")

    first = F.row_number().over(every.orderBy("source")) == 1
    langs = cells.withColumn("first", first).groupBy("lang")
    langs = langs.agg(F.count_if("first").alias("terms"), F.sum("n").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.groupBy("lang", "source").agg(F.count("*").alias("rows"))
    sources = F.count("*").over(Window.partitionBy("lang"))
    groups = (
        groups.withColumn("sources", sources)
        .join(langs, "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .fillna(0, ["terms", "lang_total", "total"])
        .select("lang", "source", "sources", "terms", "lang_total", "total")
    )
    groups = ws.save(groups, "groups")

    shares = cells.join(groups, ["lang", "source"])
    p = _probability(F.col("n"), F.col("total"), F.col("terms"))
    q = _probability(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    shares = shares.select("lang", "source", "sources", "terms", "term", p.alias("p"), q.alias("q"))
    more = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    by_term = _ranked(more).where(F.col("rank") <= top)

    slices = F.greatest(F.lit(1), F.ceil(F.col("terms") / SLICE)).cast("int")
    own = F.pmod(F.xxhash64("term"), slices).cast("int")
    zero = _probability(F.lit(0), F.col("total"), F.col("terms"))
    key = ["lang", "source", "sources", "terms"]
    marks = groups.where("sources > 1").select(
        *key, F.lit(None).cast("string").alias("term"), zero.alias("p"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice")
    )
    dense = shares.where("sources > 1").select(*key, "term", "p", own.alias("slice")).unionByName(marks)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("sources") / SOURCES)).cast("int")
    dense = dense.withColumn("block", F.pmod(F.xxhash64("source", F.lit(7)), blocks).cast("int"))
    met = block_pairs(dense, F.col("sources"), "source", SOURCES)
    met = met.select("lang", "source", "terms", "term", "p", "slice", "block", "bi", "bj")
    ship(spark)
    part = met.groupBy("lang", "bi", "bj", "slice").applyInArrow(pair_sums, "lang string, a string, b string, value long")
    sums = ws.save(part.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "sums")
    both = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = _ranked(both).withColumn("part", F.lit("pair")).select(*columns)
    return pairs.unionByName(by_term.withColumn("part", F.lit("term")).select(*columns))

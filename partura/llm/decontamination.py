"""Benchmark decontamination by a distributed positional inverted index, in DataFrame functions only.

A posting says that a term stands at a position of a document. Lists of two terms of a phrase meet where their
positions, less the terms' offsets in the phrase, are equal: that is where the phrase would start. The
rarest terms go first, so frequent words are looked up only where rare ones have met already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partura.llm.storage import Workspace

WINDOW = 10
BROADCAST_ROWS = 500_000  # rows of a small side, counted first, up to which it is sent to all tasks; beyond, a shuffle join
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
END = " "  # no word; stands after the last word of each document
AT = ["d", "h"]  # document and hash of its text
NO_ID = -(1 << 63)


def words(text: Column) -> Column:
    """Runs of digits, letters and characters beyond ASCII, of which only A-Z are lowered; none for null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def small(df: DataFrame) -> DataFrame:
    """A saved table, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class Phrases:
    """Different word sequences of `items` (item_id, text), numbered; saved in the workspace.

    `sequences` holds q, words; `names` q and item_id as a string ('' for null); `terms` the words that occur, numbered.
    """

    def __init__(self, items: DataFrame, ws: Workspace):
        rows = items.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), words(F.col("text")).alias("words")
        )
        rows = ws.save(rows.where("size(words) > 0").distinct(), "items")
        numbered = rows.select("words").distinct().select(F.monotonically_increasing_id().alias("q"), "words")
        self.sequences = ws.save(numbered, "sequences")
        self.names = ws.save(rows.join(self.sequences, "words").select("q", "name"), "names")
        terms = self.sequences.select(F.explode("words").alias("word")).distinct()
        self.terms = ws.save(terms.select(F.monotonically_increasing_id().alias("term"), "word"), "terms")
        places = self.sequences.select("q", F.posexplode("words").alias("i", "word")).join(self.terms, "word")
        self.places = ws.save(places.select("q", "i", "term"), "places")


class PositionalIndex:
    """Postings (term, d, h, pos) of the words of `docs` that `phrases` ask for, and how frequent each term is.

    A document is a doc_id and a text (d, h: the id and a hash of the text), so repeated rows are one. `ends` has a row
    for each row of `docs`, with its number of words.
    """

    def __init__(self, docs: DataFrame, phrases: Phrases, ws: Workspace):
        self.phrases, self.ws = phrases, ws
        end = ws.spark.range(1).select(F.lit(-1).cast("long").alias("term"), F.lit(END).alias("word"))
        terms = small(ws.save(phrases.terms.unionByName(end), "asked"))
        placed = docs.select(
            F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"),
            F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("h"),
            F.posexplode(F.concat(words(F.col("text")), F.array(F.lit(END)))).alias("pos", "word"),
        )
        self.rows = ws.save(placed.join(terms, "word").select("term", *AT, "pos"), "postings")
        self.postings = self.rows.where("term >= 0")
        self.ends = self.rows.where("term = -1").select(*AT, F.col("pos").alias("n_words"))
        self.frequency = ws.save(self.postings.groupBy("term").agg(F.count("*").alias("n")), "frequency")

    def _listed(self, wanted: DataFrame) -> DataFrame:
        """Offset-adjusted lists: where a phrase q would start if the term at its place i stood where a posting is."""
        found = self.postings.join(small(wanted), "term")
        return found.select("q", *AT, (F.col("pos") - F.col("i")).alias("start"), "i")

    def phrases_found(self, window: int = WINDOW) -> DataFrame:
        """(q, d, h, start, words, i): maximal runs of at least `window` words of sequence q (from its word i) in a document.

        A shorter sequence must occur whole. Each window is looked up by its rarest two terms; where their adjusted lists
        meet, those of its other terms are met too.
        """
        ws, p = self.ws, self.phrases
        rated = p.places.join(self.frequency, ["term"], "left")
        order = F.array_sort(F.collect_list(F.struct("i", "term", F.col("n").alias("n"))))
        lists = rated.groupBy("q").agg(order.alias("w")).withColumn("need", F.least(F.size("w"), F.lit(window)))

        def rarest(s: Column) -> Column:
            part = F.slice("w", s + 1, F.col("need"))
            by_n = F.array_sort(F.transform(part, lambda x: F.struct(x["n"], x["i"], x["term"])))
            known = F.forall(part, lambda x: x["n"].isNotNull())
            return F.struct(s.alias("s"), known.alias("known"), F.slice(by_n, 1, 2).alias("first"))

        windows = F.transform(F.sequence(F.lit(0), F.size("w") - F.col("need")), rarest)
        lists = lists.withColumn("windows", F.filter(windows, lambda x: x["known"]))
        lists = ws.save(lists.where("size(windows) > 0"), "windows")
        anchors = lists.select("q", F.explode("windows").alias("x")).select("q", F.explode("x.first").alias("f"))
        anchors = ws.save(anchors.select("q", "f.i", "f.term").distinct(), "anchors")
        met = self._listed(anchors).groupBy("q", *AT, "start").agg(F.collect_set("i").alias("have"))
        both = F.filter(
            "windows", lambda x: F.forall(x["first"], lambda f: F.array_contains(F.col("have"), f["i"]))
        )
        rows = met.join(small(lists), "q").withColumn("both", both).where("size(both) > 0")
        places = F.flatten(F.transform("both", lambda x: F.sequence(x["s"], x["s"] + F.col("need") - 1)))
        wanted = F.transform(F.array_distinct(places), lambda i: F.struct(i.alias("i"), F.get("w", i)["term"].alias("term")))
        asked = ws.save(rows.select("q", *AT, "start", "need", F.explode(wanted).alias("x")), "asked_places")
        asked = asked.select("q", *AT, "start", "need", "x.i", "x.term", (F.col("start") + F.col("x.i")).alias("pos"))
        docs = small(ws.save(asked.select(*AT).distinct(), "candidates"))
        near = self.postings.join(docs, AT, "left_semi")
        seen = asked.join(near, [*AT, "pos", "term"]).select("q", *AT, "start", "need", "i")
        # Repeated rows of a document repeat its postings: equal places share a rank.
        along = Window.partitionBy("q", *AT, "start").orderBy("i")
        runs = seen.withColumn("run", F.col("i") - F.dense_rank().over(along))
        runs = runs.groupBy("q", *AT, "start", "need", "run").agg(F.min("i").alias("i"), F.max("i").alias("last"))
        runs = runs.withColumn("words", F.col("last") - F.col("i") + 1).where("words >= need")
        found = runs.select("q", *AT, (F.col("start") + F.col("i")).alias("start"), "words", "i")
        return ws.save(found, "phrases_found")

    def near_found(self, within: int) -> DataFrame:
        """(q, d, h, start, end): spans of a document that hold every word of sequence q, in any order.

        A span is taken around each posting of the sequence's rarest word: all other different words stand at most
        `within` words from it, and the nearest of each (of two as near, the earlier) sets the span's bounds.
        """
        ws, p = self.ws, self.phrases
        need = p.places.select("q", "term").distinct().join(self.frequency, "term", "left")
        every = Window.partitionBy("q")
        rated = need.withColumn("terms", F.count("*").over(every)).withColumn("known", F.count("n").over(every))
        rank = F.row_number().over(every.orderBy("n", "term"))
        rated = ws.save(rated.where("terms = known").withColumn("rank", rank), "near_terms")
        cells = max(1, within)
        first = self.postings.join(small(rated.where("rank = 1").select("q", "term", "terms")), "term")
        first = first.select("q", *AT, "terms", F.col("pos").alias("at")).distinct()
        first = ws.save(first.withColumn("cell", F.floor(F.col("at") / cells)), "near_first")
        around = first.withColumn("cell", F.explode(F.array(*[F.col("cell") + k for k in (-1, 0, 1)])))
        others = self.postings.join(small(rated.where("rank > 1").select("q", "term")), "term")
        others = others.select("q", *AT, "term", "pos", F.floor(F.col("pos") / cells).alias("cell"))
        off = F.abs(F.col("pos") - F.col("at"))
        met = around.join(others, ["q", *AT, "cell"]).where(off <= within)
        nearest = met.groupBy("q", *AT, "at", "terms", "term").agg(F.min(F.struct(off.alias("off"), "pos"))["pos"].alias("pos"))
        own = first.select("q", *AT, "at", "terms", F.lit(-1).cast("long").alias("term"), F.col("at").alias("pos"))
        all_in = nearest.unionByName(own).groupBy("q", *AT, "at", "terms")
        spans = all_in.agg(F.count("*").alias("n"), F.min("pos").alias("start"), F.max("pos").alias("end"))
        return spans.where("n = terms").select("q", *AT, "start", "end")


def phrase_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, ws: Workspace | None = None) -> DataFrame:
    """(doc_id, item_id, start, words, i): runs of `window` or more consecutive words of items in documents, each whole.

    `start` is the run's first word in the document and `i` in the item. Items of fewer words must occur whole. item_id is a
    string, '' for null.
    """
    ws = ws or Workspace(docs.sparkSession, "phrases")
    phrases = Phrases(items, ws)
    found = PositionalIndex(docs, phrases, ws).phrases_found(window).join(phrases.names, "q")
    return found.select(_id().alias("doc_id"), F.col("name").alias("item_id"), "start", "words", "i")


def proximity_matches(docs: DataFrame, items: DataFrame, within: int, ws: Workspace | None = None) -> DataFrame:
    """(doc_id, item_id, start, end): where all words of an item stand within so many words of its rarest one, in any order."""
    ws = ws or Workspace(docs.sparkSession, "near")
    phrases = Phrases(items, ws)
    found = PositionalIndex(docs, phrases, ws).near_found(within).join(phrases.names, "q")
    return found.select(_id().alias("doc_id"), F.col("name").alias("item_id"), "start", "end")


def _id() -> Column:
    return F.nullif(F.col("d"), F.lit(NO_ID))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, ws: Workspace | None = None) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of `docs` (doc_id, text).

    A word is hit if it lies in `window` consecutive words of a document that are as many consecutive words of an item of
    `items` (item_id, text); an item of fewer words counts where it occurs whole. n_items is the number of different
    item_ids with such a hit, items_sha256 the hash of these as strings, sorted and joined by commas (of '' if there are
    none). Null and empty texts have no words and hit nothing, on both sides. A null item_id is named ''. Rows with
    the same doc_id and text get the same result; a null doc_id stays null. An empty table of documents gives no rows,
    an empty one of items no hits. Other columns are ignored.
    """
    ws = ws or Workspace(docs.sparkSession, "contamination")
    phrases = Phrases(items, ws)
    index = PositionalIndex(docs, phrases, ws)
    found = index.phrases_found(window)
    places = found.select(*AT, F.explode(F.sequence("start", F.col("start") + F.col("words") - 1)).alias("pos"))
    hit = places.distinct().groupBy(*AT).agg(F.count("*").alias("n_hit"))
    named = found.select("q", *AT).distinct().join(phrases.names, "q").select(*AT, "name").distinct()
    named = named.groupBy(*AT).agg(F.sort_array(F.collect_list("name")).alias("names"))
    result = ws.save(hit.join(named, AT), "hits")
    out = index.ends.join(small(result), AT, "left")
    none = F.array().cast("array<string>")
    joined = F.array_join(F.coalesce("names", none), ",")
    return out.select(
        _id().alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(joined.cast("binary"), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )

"""Document fingerprints: threshold-scaled sketches of five-word shingles, in SQL functions only.

A sketch holds every shingle hash that lies in the lowest 1 / SCALE of the hash range, and always the
least hash, so that only a text without words has an empty one. Sketches of unequal documents compare
by containment, and the sketch of a union is the union of the sketches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partura.llm.ring import with_next

SCALE = 8
SHINGLE = 5
SPACE = " \t\n\x0b\x0c\r"
LIMIT = -(1 << 63) + (1 << 64) // SCALE


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Lower-case words between ASCII white space; none for null or blank text."""
    trimmed = F.btrim(F.lower(text), F.lit(SPACE))
    split = F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+")
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")).otherwise(split)


def _shingles(h: Column) -> Column:
    def of(n: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)])
        )
        few = F.when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(n >= SHINGLE, runs).otherwise(few)

    return let(F.size(h), of)


def _low(hashes: Column) -> Column:
    least = F.filter(F.array(F.array_min(hashes)), lambda x: x.isNotNull())
    return F.sort_array(F.array_union(F.filter(hashes, lambda x: x < LIMIT), least))


def sketch(text: Column) -> Column:
    """Sorted distinct hashes kept of a text. Null is as empty; fewer than five words are one shingle."""
    return let(F.transform(words(text), lambda w: F.xxhash64(w)), lambda h: let(_shingles(h), _low))


def merge(a: Column, b: Column) -> Column:
    """Sketch of the texts of both."""
    return _low(F.array_union(a, b))


def _shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets; 1 for two empty ones."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise(let(_shared(a, b), lambda s: s / (both - s)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    return F.when(F.size(a) == 0, 1.0).otherwise(_shared(a, b) / F.size(a))


def text_form(sk: Column) -> Column:
    """A sketch as hex digits, 16 for each hash."""
    return F.concat_ws("", F.transform(sk, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the sketch and its text form for each row of `docs` (doc_id, text).

    Null text is as empty, and has an empty sketch as blank text has. Repeated rows repeat their result.
    """
    made = docs.select("doc_id", sketch(F.col("text")).alias("sketch"))
    return made.withColumn("fingerprint", text_form(F.col("sketch")))


def edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts and of their edited texts, and how alike they are.

    The edited text takes as its last floor(n / 3) code points the first as many of the next document
    (all, if it is shorter), by descending doc_id, equal ids by a hash of the text; the last is followed by the first
    and a single document by itself. Rows with a null doc_id come last. An empty table gives no rows.
    """
    base = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("tie", F.xxhash64("text")).withColumn("sketch", sketch(F.col("text")))
    paired = with_next(base, "doc_id", "tie", {"text": "next_text", "sketch": "next_sketch"})
    n = F.char_length("text")
    tail = F.floor(n / 3).cast("int")
    cut = paired.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "sketch",
        "next_sketch",
        F.concat(F.substr("text", F.lit(1), n - tail), F.substr("next_text", F.lit(1), tail)).alias("edited"),
    )
    cut = cut.withColumn("edited_sketch", sketch(F.col("edited")))
    return cut.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        text_form(F.col("sketch")).alias("fingerprint"),
        text_form(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )

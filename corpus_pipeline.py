"""The corpus pipeline: quality, line dedup, near-dedup, mixing, packing.

Each stage works on all rows that the one before kept, and is written and read again before the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partura.llm.lines import dedup_lines
from partura.llm.minhash import one_of_each
from partura.llm.mixing import mix
from partura.llm.packing import pack
from partura.llm.quality import classify
from partura.llm.queries import vocabulary
from partura.llm.storage import Workspace

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier holds for clean."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, labels).where("clean").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated runs of lines. A document that loses every line goes."""
    cut = dedup_lines(docs.select(*COLUMNS)).where("lines_deleted = 0 or lines_deleted < lines")
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates; rows that repeat a doc_id, or a text without one, are such a group."""
    return one_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target shares of source, language and topic."""
    return mix(docs.select(*COLUMNS)).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near-dedup", near_duplicate_documents),
    ("mixing", mixing),
    ("packing", packing),
]

#: Classifier, tokenizer and raking are not SQL. tests/llm/test_pipeline.py checks what each stage keeps of odd rows, and
#: mixing against plain fitting.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = ws.save(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            ws.drop(f"stage{k - 1}")
    return docs

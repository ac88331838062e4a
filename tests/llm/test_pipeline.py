"""The corpus pipeline on odd rows, and its mixing stage against plain proportional fitting."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from partura.llm import mixing
from partura.llm.mixing import mix

DOCS = "doc_id long, text string, lang string, source string, n_chars long, topic string, tokens string, marks int"
MARKS = "doc_id long, quality int, toxic int"


def prose(rnd, n):
    return " ".join(f"w{rnd.randrange(3000)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(21)
    texts = [(i, prose(rnd, rnd.randrange(20, 120))) for i in range(60)]
    copies = prose(rnd, 80)
    near = copies.replace(copies.split()[40], "changed")
    texts += [(None, copies), (None, copies), (100, copies), (100, copies), (101, near)]
    texts += [(110, None), (111, ""), (111, ""), (112, prose(rnd, 20_000)), (113, "\n".join([copies.upper(), "x", copies]))]
    langs = ["en", "de", None]
    return [(i, t, langs[k % 3], f"s{k % 4}", None if t is None else len(t), "x", "y", 1) for k, (i, t) in enumerate(texts)]


def folder(spark, tmp_path, rows, marks):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, MARKS).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_on_odd_rows(spark, tmp_path, rows):
    marks = [(i, 1, 0) for i in range(0, 60, 2)] + [(None, 0, 1), (1, None, None), (2, 1, 0)]
    sf_dir = folder(spark, tmp_path, rows, marks)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = Counter(r.doc_id for r in docs.select("doc_id").collect())
        made = stage(spark, docs, sf_dir)
        made.write.mode("overwrite").parquet(f"{sf_dir}/{name.replace(' ', '_')}")
        docs = spark.read.parquet(f"{sf_dir}/{name.replace(' ', '_')}")
        after = Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert after.keys() <= before.keys(), name
        if name == "near-dedup":
            assert max(after.values()) == 1
            group = {None, 100, 101} & after.keys()
            assert len(group) == 1 and set(range(60)) <= after.keys()
        elif name in ("quality classifier", "line dedup"):
            assert set(range(60)) <= after.keys(), name  # all labelled rows are clean, and no line repeats
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS), name
    pieces = docs.collect()
    assert pieces and Counter(r.length for r in pieces).total() == len(pieces)
    held = defaultdict(int)
    for r in pieces:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 4096


def test_no_documents(spark, tmp_path):
    sf_dir = folder(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, sf_dir).collect() == []


def test_stage_that_leaves_nothing(spark, tmp_path, rows):
    """All labelled documents are bad but one: what follows must live with few or no rows."""
    sf_dir = folder(spark, tmp_path, [r for r in rows if r[1] is None or r[1] == ""], [(110, 0, 1), (111, 0, 1)])
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()} <= {110, 111}


@pytest.mark.parametrize("cells", [50_000, 0])
def test_mix_equals_plain_fitting(spark, rows, monkeypatch, cells):
    """Few cells in one task, or many by joins: the probabilities are those of plain fitting."""
    monkeypatch.setattr(mixing, "CELLS", cells)
    frame = spark.createDataFrame(rows, DOCS).withColumn("topic", F.when(F.col("doc_id") % 5 == 0, "a").otherwise("b"))
    targets = {"source": {"s0": 4, "s1": 1, "s2": 1, "s3": 2}, "lang": 0.9, "topic": 1.0}
    budget = 300.0
    found = {(r.source, r.lang, r.topic): r.probability for r in mix(frame, targets, budget=budget).collect()}
    tokens: dict[tuple, float] = defaultdict(float)
    for i, t, lang, source, *_ in rows:
        tokens[source, lang or "(none)", "a" if i is not None and i % 5 == 0 else "b"] += max(1, len((t or "").split()))
    goals = []
    for m, goal in enumerate((targets["source"], 0.9, 1.0)):
        own: dict[str, float] = defaultdict(float)
        for cell, n in tokens.items():
            own[cell[m]] += n
        share = goal if isinstance(goal, dict) else {v: n**goal for v, n in own.items()}
        goals.append({v: share[v] / sum(share.values()) for v in own})
    weight = dict(tokens)
    for _ in range(200):
        for m, goal in enumerate(goals):
            own = defaultdict(float)
            for cell, w in weight.items():
                own[cell[m]] += w
            weight = {cell: w * goal[cell[m]] / own[cell[m]] for cell, w in weight.items()}
    assert found
    for (source, lang, topic), p in found.items():
        cell = (source, lang or "(none)", topic)
        assert p == pytest.approx(budget * weight[cell] / tokens[cell], rel=1e-4)

"""Operators over documents, on nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from partura.llm import fingerprints as fp
from partura.llm import minhash
from partura.llm.lines import dedup_lines
from partura.llm.minhash import exact_links, least_matches, near_duplicates, one_of_each
from partura.llm.mixing import mix
from partura.llm.packing import pack, shortest_pack_first
from partura.llm.quality import classify
from partura.llm.words import shingle_sets

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n int, w string, rep long, bucket int, r int"
)
WORD = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en" if (i or 0) % 3 else None, "a" if (i or 0) % 2 else "b", len(t or ""), 1, "x", 5, 6, 7) for i, t in rows],
        SCHEMA,
    )


def prose(rnd, n):
    return " ".join(f"w{rnd.randrange(4000)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    base = prose(rnd, 120)
    near = base.split()
    near[60] = "changed"
    line = prose(rnd, 60)
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "  \n\t "), (7, "One two"), (8, "one  TWO")]
    rows += [(9, prose(rnd, 20_000)), (10, f"first\n{line}\nlast"), (11, f"other\n\n{line}\nend"), (12, "été À la — 漢字 's don't")]
    rows += [(2, base), (None, "no id"), (None, None), (13, "aaaa"), (14, prose(rnd, 30) + "<|endoftext|> x y")]
    return rows


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in up}


def test_near_duplicates(spark, texts):
    found = near_duplicates(frame(spark, texts), block=2).collect()
    assert len(found) == len(texts)
    want = brute_components(texts)
    sizes = {i: len(shingle_set(t)) for i, t in texts if i is not None}
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (want[r.doc_id], sizes[r.doc_id], r.doc_id == want[r.doc_id])
    assert want[3] == 1 and want[8] == 7 and want[5] == 5
    assert near_duplicates(frame(spark, texts).limit(0)).collect() == []


def test_near_duplicates_of_a_large_group(spark):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(9000)}" for _ in range(100)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(100)] = f"x{rnd.randrange(9000)}"
        rows.append((i, " ".join(w)))
    want = brute_components(rows)
    assert {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows), block=16).collect()} == want


def test_a_document_with_two_texts_is_one(spark):
    rnd = random.Random(6)
    a, b = prose(rnd, 50), prose(rnd, 50)
    rows = [(1, a), (5, a), (5, b), (7, b)]
    assert {r.component_id for r in near_duplicates(frame(spark, rows)).collect()} == {1}


def test_empty_texts_under_repeated_ids(spark):
    rnd = random.Random(7)
    w, v = prose(rnd, 40), prose(rnd, 40)
    rows = [(1, w), (2, v), (3, w), (3, v), (2, ""), (3, ""), (1, ""), (9, ""), (4, None), (4, w)]
    found = near_duplicates(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 1, 4: 1, 9: 9}


@pytest.mark.parametrize("few", [500_000, 0])
def test_one_of_each_group_stays(spark, monkeypatch, few):
    monkeypatch.setattr(minhash, "BROADCAST_IDS", few)
    rnd = random.Random(9)
    w = prose(rnd, 60)
    near = " ".join([*w.split()[:-1], "end"])
    lone, other, last = prose(rnd, 30), prose(rnd, 30), prose(rnd, 30)
    rows = [(None, w), (None, w), (4, w), (4, w), (5, near)]
    rows += [(6, lone), (7, ""), (8, ""), (8, ""), (9, None), (None, other), (None, other), (None, ""), (10, last)]
    kept = [(r.doc_id, r.text) for r in one_of_each(frame(spark, rows)).collect()]
    want = [(4, w), (6, lone), (7, ""), (8, ""), (9, None), (None, other), (None, ""), (10, last)]
    assert Counter(kept) == Counter(want)
    full = one_of_each(frame(spark, rows))
    assert full.columns == frame(spark, rows).columns
    assert one_of_each(frame(spark, [])).count() == 0


def test_exact_links_and_pruning():
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 40, 30).astype(np.uint64)) for _ in range(40)]
    pairs = {(i, j) for i in range(40) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) * 100 >= 75 * len(np.union1d(sets[i], sets[j]))}

    def classes(links):
        lab = list(range(40))
        for _ in range(40):
            for i, j in links:
                lab[i] = lab[j] = min(lab[i], lab[j])
        return lab

    assert classes(exact_links(sets, 75)) == classes(pairs)
    need = least_matches()
    assert list(need) == sorted(need) and need[-1] < 0.75 * 128


def test_shingle_sets_are_those_of_words(texts):
    sets = list(shingle_sets(pa.array([t for _, t in texts])))
    assert [len(s) for s in sets] == [len(shingle_set(t)) for _, t in texts]
    assert (sets[0] == sets[1]).all() and sets[6].tolist() == sets[7].tolist()


def test_edits(spark, texts):
    rows = [(i, t) for k, (i, t) in enumerate(texts) if i is not None and (i, t) not in texts[:k]]
    found = {r.doc_id: r for r in fp.edits(frame(spark, rows)).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        tail = len(t) // 3
        edited = t[: len(t) - tail] + after[:tail]
        assert found[i].n_chars == len(t) and found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[i].near_edited <= 1 and 0 <= found[i].near_next <= 1
    assert found[1].fingerprint == found[2].fingerprint and found[2].near_next == 1
    assert found[4].fingerprint == "" and abs(found[9].near_edited - 2 / 3) < 0.03
    assert fp.edits(frame(spark, texts)).count() == len(texts)
    one = fp.edits(frame(spark, [(1, "abcdef")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert fp.edits(frame(spark, texts).limit(0)).count() == 0


def test_sketch_is_the_low_hashes_and_merges(spark):
    rnd = random.Random(2)
    a, b = prose(rnd, 3000), prose(rnd, 300)
    made = spark.createDataFrame([(a, b, a + " " + b)], "a string, b string, c string")
    sk = {c: fp.sketch(made[c]) for c in "abc"}
    got = made.select(
        fp.containment(sk["b"], sk["c"]).alias("inside"), fp.containment(sk["c"], sk["b"]).alias("back"), fp.merge(sk["a"], sk["b"]).alias("m"), sk["c"].alias("c")
    ).first()
    assert got.inside > 0.95 and abs(got.back - 0.09) < 0.05 and set(got.m) <= set(got.c)
    assert max(got.c) < fp.LIMIT


def brute_lines(rows, least):
    rows = sorted({(-(1 << 63) if i is None else i, t) for i, t in rows if t is not None}, key=lambda r: r[0])
    cut = [[x for x in (y.strip(" \t\n\x0b\x0c\r") for y in t.split("\n")) if x] for _, t in rows]
    gone = {}
    for a, q in enumerate(cut):
        out = set()
        for i in range(len(q)):
            best = 0
            for b in range(a + 1):
                for j in range(len(cut[b]) if b < a else i):
                    n = 0
                    while i + n < len(q) and j + n < len(cut[b]) and q[i + n] == cut[b][j + n]:
                        n += 1
                    best = max(best, n)
            if sum(len(x.split()) for x in q[i : i + best]) >= least:
                out |= set(range(i, i + best))
        gone[rows[a]] = [x for k, x in enumerate(q) if k not in out]
    return gone


@pytest.mark.parametrize("least", [1, 5])
def test_repeated_runs_go(spark, least):
    rnd = random.Random(least)
    kinds = ["a b", "c", "d e f", "", "g", "  h i ", "j k l m"]
    rows = [(k, "\n".join(rnd.choice(kinds) for _ in range(rnd.randint(0, 12)))) for k in range(25)]
    found = dedup_lines(frame(spark, rows), least).collect()
    want = brute_lines(rows, least)
    for r in found:
        left = [x.strip(" \t") for x in r.text.split("\n") if x.strip(" \t")]
        assert left == want[r.doc_id, dict(rows)[r.doc_id]]
        assert r.lines - r.lines_deleted == len(left)


def test_line_dedup_of_odd_rows(spark, texts):
    docs = frame(spark, texts)
    found = dedup_lines(docs)
    assert found.columns == [*docs.columns, "lines", "lines_deleted", "spans"]
    rows = found.collect()
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[10][0].lines_deleted == 0 and by[11][0].text == "other\n\nend"
    assert by[1][0].text and all(r.text == "" for r in by[2]) and by[4][0].text is None and by[5][0].text == ""
    assert dedup_lines(docs.limit(0)).collect() == []


def test_shortest_pack_first_fills():
    rnd = random.Random(4)
    histogram = Counter(rnd.randint(1, 4096) for _ in range(5000)) + Counter(rnd.randint(1, 300) for _ in range(5000))
    patterns = shortest_pack_first(dict(histogram), 4096)
    placed = Counter()
    for pattern, n in patterns:
        assert sum(a * b for a, b in pattern) <= 4096
        for a, b in pattern:
            placed[a] += b * n
    assert placed == histogram
    total = sum(k * n for k, n in histogram.items())
    assert sum(n for _, n in patterns) * 4096 < 1.03 * total
    assert shortest_pack_first({}, 4096) == []


def test_pack(spark, texts):
    rows = pack(frame(spark, texts), WORD, length=256, piece=256).collect()
    tokenizer = Tokenizer.from_file(WORD)
    want = Counter()
    for i, t in texts:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for lo in range(0, len(ids), 256):
            part = ids[lo : lo + 256]
            want[i, lo, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert pack(frame(spark, texts).limit(0), WORD).collect() == []


def test_mix_meets_targets(spark):
    rnd = random.Random(8)
    rows = [
        (k, "word " * rnd.randint(5, 40), rnd.choice(["en", "en", "en", "de", None]), rnd.choice("aaaaabc"), rnd.choice("xy"))
        for k in range(4000)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string")
    goal = {"source": {"a": 1.0, "b": 1.0, "c": 2.0}, "lang": 1.0, "topic": {"x": 3.0, "y": 1.0}}
    found = mix(docs, goal).toPandas()
    weight = (found.tokens / found.tokens.sum()).groupby(found.source).sum()
    assert abs(weight["c"] - 0.5) < 0.04 and abs(weight["a"] - 0.25) < 0.04
    assert abs(found.tokens[found.topic == "x"].sum() / found.tokens.sum() - 0.75) < 0.04
    assert found.probability.max() <= 1 + 1e-9 and found.doc_id.is_unique and found.lang.isna().any()
    # The expected tokens of each margin are exactly the targets.
    found["lang"] = found.lang.fillna("-")
    chance = found.drop_duplicates(["source", "lang", "topic"]).set_index(["source", "lang", "topic"]).probability
    cells = docs.toPandas().assign(tokens=[len(r[1].split()) for r in rows])
    cells["lang"] = cells.lang.fillna("-")
    cells = cells.groupby(["source", "lang", "topic"]).tokens.sum()
    hoped = (cells * chance).groupby("source").sum()
    assert np.allclose(hoped / hoped.sum(), [0.25, 0.25, 0.5], atol=1e-4)


def test_a_stray_row_does_not_thin_the_mix(spark):
    rnd = random.Random(9)
    rows = [(k, "word " * rnd.randint(5, 40), rnd.choice(["en", "en", "de"]), rnd.choice("aaab"), rnd.choice("xy")) for k in range(3000)]
    schema = "doc_id long, text string, lang string, source string, topic string"
    whole = sum(len(r[1].split()) for r in rows)
    goal = {"source": 0.8, "lang": 0.9, "topic": 1.0}

    def kept(given, **more):
        found = mix(spark.createDataFrame(given, schema), goal, **more).toPandas()
        assert found.probability.max() <= 1 + 1e-9
        return found

    stray = [*rows, (9000, "", "en", "stray", "x")]
    after = kept(stray)
    assert after.tokens.sum() > 0.7 * whole and 9000 in set(after.doc_id)
    # A budget is met, also one beyond what the shares allow.
    assert abs(kept(stray, budget=0.97 * whole).tokens.sum() / whole - 0.97) < 0.03


def test_mix_of_odd_rows(spark, texts):
    docs = frame(spark, texts)
    every = {"source": 1.0, "lang": 1.0, "topic": 1.0}
    assert mix(docs, every).count() == len(texts)
    assert mix(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        mix(docs, every | {"lang": {"en": -1.0}})


def test_classifier_on_held_out_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = classify(d, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    good = (found.quality == 1) & (found.toxic == 0)
    assert found.clean[good].mean() > 0.97 and found.clean[~good].mean() < 0.06
    assert found.clean[found.toxic == 1].mean() < 0.08


def test_classifier_on_odd_rows(spark, texts):
    docs = frame(spark, texts).withColumnRenamed("w", "score")
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, None), (7, 1, 0), (9, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found = classify(docs, labels)
    assert found.count() == len(texts) and found.where("score is null or score < 0 or score > 1").count() == 0
    named = docs.withColumns({"_text": F.lit("x"), "_m0": F.lit(None).cast("int"), "p_text": F.lit("y"), "n_chars": F.length("text")})
    wide = classify(named, labels)
    assert wide.columns == [c for c in named.columns if c not in ("p_text", "score")] + ["p_text", "p_meta", "score", "clean"]
    assert {r["_text"] for r in wide.collect()} == {"x"}
    assert classify(docs.withColumn("text", F.encode("text", "utf-8")), labels).count() == len(texts)
    assert classify(docs, labels.limit(0)).where("clean").count() == len(texts)
    assert classify(docs.limit(0), labels).collect() == []

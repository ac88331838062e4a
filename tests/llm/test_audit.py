"""Source divergence, decontamination and whitening against brute force, on odd rows and small bounds."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from partura.llm import decontamination, divergence
from partura.llm.decontamination import contamination, phrase_matches, proximity_matches
from partura.llm.divergence import term_counts
from partura.llm.whitening import bit_planes, cross_products, whiten

DOCS = "doc_id long, text string, lang string, source string, term string, slice int, p long, d long, h long, pos int, q int"


def docs_frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2, 3, 4, 5, 6) for row in rows], DOCS)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- source divergence --------------------------------------------------------------------------


def brute_divergence(rows, least):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang, source in groups:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        names = sorted(s for g, s in groups if g == lang)

        def share(some):
            n = {t: sum(counts[lang, s][t] for s in some) for t in kept}
            total = sum(n.values())
            return n, {t: 1 + 10**9 * (n[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def far(p, q):
            return (p - q) ** 2 // (p + q)

        n, p = share([source])
        pairs = [(sum(far(p[t], share([o])[1][t]) for t in kept), o) for o in names if o != source]
        _, q = share(names)
        more = [(far(p[t], q[t]), t) for t in kept if n[t] and p[t] > q[t]]
        for part, found in (("pair", pairs), ("term", more)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, source, part, item, v, k) for k, (v, item) in enumerate(found, 1) if part == "pair" or k <= 10}
    return out


@pytest.fixture(scope="module")
def sourced():
    rnd = random.Random(5)
    rows = []
    for i in range(150):
        words = [f"w{chr(97 + min(rnd.randrange(30), rnd.randrange(30)))}x" for _ in range(rnd.randrange(30))]
        rows.append((i, " ".join(words), rnd.choice(["en", "de"]), f"s{rnd.randrange(7)}"))
    rows += [(None, "Été WAX wbx'wcx 12wdx", None, None), (None, None, "", ""), (7, None, "en", "empty"), (8, "", "fr", "a")]
    rows += [(9, "wax " * 20_000 + "été", "en", "s0"), (9, "wax " * 20_000 + "été", "en", "s0"), (10, "x\0y", "fr", "b")]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_divergence(spark, sourced, monkeypatch, small):
    if small:  # several slices, blocks and flushes
        monkeypatch.setattr(divergence, "SLICE", 4)
        monkeypatch.setattr(divergence, "SOURCES", 3)
        monkeypatch.setattr(divergence, "HELD", 5)
    found = divergence.divergence(docs_frame(spark, sourced), least_docs=10)
    rows = [tuple(r) for r in found.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute_divergence(sourced, 10)


def test_divergence_of_nothing(spark, sourced):
    assert divergence.divergence(docs_frame(spark, [])).count() == 0
    none = divergence.divergence(docs_frame(spark, sourced), least_docs=10_000).collect()
    assert {r["value"] for r in none} == {0} and {r["part"] for r in none} == {"pair"}
    assert term_counts("Ab-aB été\x1fÉ".encode()) == {b"ab": 2, "été".encode(): 1, "É".encode(): 1}


# --- decontamination ----------------------------------------------------------------------------


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def brute_contamination(docs, items, size):
    wanted = defaultdict(set)
    for item, text in items:
        w = item_words(text)
        n = min(size, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            wanted[tuple(w[s : s + n])].add("" if item is None else str(item))
    lengths = {len(w) for w in wanted}
    out = []
    for doc_id, text, *_ in docs:
        w = item_words(text)
        hit, names = set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if found := wanted.get(tuple(w[s : s + n])):
                    names |= found
                    hit |= set(range(s, s + n))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), digest, bool(hit)))
    return Counter(out)


@pytest.fixture(scope="module")
def leaked():
    rnd = random.Random(8)

    def prose(n, kinds=40):
        return [f"W{min(rnd.randrange(kinds), rnd.randrange(kinds))}" for _ in range(n)]

    items = [(i, " ".join(prose(rnd.randrange(4, 30), 400))) for i in range(12)]
    items += [(3, items[3][1]), (100, "a a a a a a a a a a a a"), (20, "Únder, the-BRIDGE"), (21, None), (22, "  ,;"), (None, "zebra")]
    items += [(23, items[0][1]), (24, "never seen words in here that no document has at all"), (25, "one")]
    docs = []
    for i in range(60):
        w = prose(rnd.randrange(40), 400)
        for _ in range(rnd.randrange(3)):
            part = item_words(rnd.choice(items)[1] or "")
            lo = rnd.randrange(len(part) + 1)
            at = rnd.randrange(len(w) + 1)
            w[at:at] = part[lo // 3 : lo + 8]
        docs.append((i, ", ".join(w), "en", "a"))
    docs += [(60, None, None, None), (61, "", "", ""), (None, items[2][1].upper(), "", ""), (None, "zebra Zebra", "", "")]
    docs += [(0, docs[0][1], "en", "a"), (1, docs[5][1], "en", "a"), (62, "a " * 50, "", ""), (63, "x " * 30_000 + items[4][1], "", "")]
    docs += [(64, "únder the bridge ünder the bridge Únder\0the\tbridge", "", "")]
    return docs, items


@pytest.mark.parametrize("broadcast", [500_000, 0])
@pytest.mark.parametrize("size", [10, 3])
def test_contamination(spark, leaked, monkeypatch, broadcast, size):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", broadcast)
    docs, items = leaked
    bench = spark.createDataFrame([(*row, 1, "x") for row in items], "item_id long, text string, q int, name string")
    found = contamination(docs_frame(spark, docs), bench, size)
    assert Counter(tuple(r) for r in found.collect()) == brute_contamination(docs, items, size)


def test_contamination_of_nothing(spark, leaked):
    docs, items = leaked
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert contamination(docs_frame(spark, []), bench).count() == 0
    clean = contamination(docs_frame(spark, docs), bench.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r["contaminated"] or r["n_hit"] or r["n_items"] for r in clean)


def test_phrase_matches_are_whole_runs(spark):
    bench = spark.createDataFrame([(1, "a b c d e f"), (2, "c d")], "item_id long, text string")
    docs = docs_frame(spark, [(5, "x B c D e y c d", "", ""), (6, "a b x", "", "")])
    found = {tuple(r) for r in phrase_matches(docs, bench, 3).collect()}
    assert found == {(5, "1", 1, 4, 1), (5, "2", 2, 2, 0), (5, "2", 6, 2, 0)}


@pytest.mark.parametrize("within", [0, 1, 3, 50])
def test_proximity_matches(spark, leaked, within):
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(40)), "", "") for i in range(5)] + [(5, "h", "", ""), (6, None, "", "")]
    items = [(1, "a b"), (2, "c c d e"), (3, "h"), (4, "a z")]
    total = Counter(w for _, t, *_ in docs for w in item_words(t))
    want = set()
    for item, text in items:
        terms = set(item_words(text))
        if not all(total[t] for t in terms):
            continue
        least = min(total[t] for t in terms)
        rarest = [t for t in terms if total[t] == least]
        for i, t, *_ in docs:
            w = item_words(t)
            for at, word in enumerate(w):
                if word not in rarest or len(rarest) > 1:
                    continue
                spots = [at]
                for other in terms - {word}:
                    near = [(abs(k - at), k) for k, x in enumerate(w) if x == other and abs(k - at) <= within]
                    spots += [min(near)[1]] if near else []
                if len(spots) == len(terms):
                    want.add((i, str(item), min(spots), max(spots)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {tuple(r) for r in proximity_matches(docs_frame(spark, docs), bench, within).collect()}
    assert found == want


# --- whitening ----------------------------------------------------------------------------------


@pytest.mark.parametrize("span", [1, 200, 1 << 40, (1 << 62) - 1])
def test_cross_products_are_exact(span):
    rnd = random.Random(span)
    x = np.array([[rnd.randint(-span, span) for _ in range(5)] for _ in range(131)], np.int64)
    sums, cross = cross_products(x)
    exact = x.astype(object)
    assert (sums == exact.sum(axis=0)).all() and (cross == exact.T.dot(exact)).all()


def test_bit_planes():
    y = np.array([[1, 0], [2, 3], [0, 1]], np.uint64)
    assert bit_planes(y)[:, :, 0].tolist() == [[0b001, 0b010], [0b110, 0b010]]


VECTORS = "vec_id long, embedding array<float>, label int, component int, n string, whitened int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, "x", 3) for row in rows], VECTORS)


def test_whitening_against_numpy(spark):
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(300, 6)) @ rnd.normal(size=(6, 6))
    rows = [(int(i) if i % 50 else None, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    rows += [rows[3], (3, rows[4][1]), (900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (903, [float("nan")] * 6)]
    rows += [(904, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (905, [0.0] * 6), (906, [3e30] * 6)]
    kept = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) + 1_000_000) for i, v in rows[:302] + [rows[-2]]]
    x = np.array([v for _, v in kept], object)
    n, s = len(x), x.sum(axis=0)
    off = n * x - s
    values, vectors = np.linalg.eigh((off.T.dot(off) / n**3).astype(float))
    found = whiten(vector_frame(spark, rows).repartition(3), components=4).collect()
    assert len(found) == 4 * n and {r["n"] for r in found} == {n}
    assert Counter(r["vec_id"] for r in found) == Counter({k: 4 * c for k, c in Counter(i for i, _ in kept).items()})
    for k in range(1, 5):
        e, axis = values[-k], vectors[:, -k]
        want = (off / n).astype(float) @ axis / np.sqrt(e)
        own = sorted((r["deviation"], r["whitened"]) for r in found if r["component"] == k)
        both = sorted((int((o * o).sum()), w) for o, w in zip(off, want))
        assert [int(d) for d, _ in own] == [d for d, _ in both]
        a, b = np.array([w for _, w in own]), np.array([w for _, w in both])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        assert {abs(r["explained"] - e / values.sum()) < 1e-12 for r in found if r["component"] == k} == {True}
    assert {r["identity_error"] for r in found}.pop() < 1e-9


def test_whitening_of_few_and_large(spark):
    assert whiten(vector_frame(spark, [])).count() == 0
    assert whiten(vector_frame(spark, [(1, None)])).count() == 0
    one = whiten(vector_frame(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r["component"], r["whitened"], r["explained"], r["deviation"]) for r in one] == [(1, 0, 0, 0), (2, 0, 0, 0)]
    flat = whiten(vector_frame(spark, [(i, [float(i), 1.0]) for i in range(4)] + [(9, [5.0])])).collect()
    assert Counter(r["n"] for r in flat) == {4: 8, 1: 1} and {r["identity_error"] < 1e-9 for r in flat} == {True}
    big = whiten(vector_frame(spark, [(1, [2.0**50, 0.0]), (2, [-(2.0**50), 1.0])]))
    assert {int(r["deviation"]) for r in big.collect()} == {(1 << 114) + 64 * 64}


def test_queries_are_registered():
    from partura.llm.queries import llm_oracles, llm_queries

    new = {"op11_divergence", "op12_decontamination", "op13_whitening"}
    assert new <= set(llm_queries()) and {"op11_divergence", "op12_decontamination"} <= set(llm_oracles())

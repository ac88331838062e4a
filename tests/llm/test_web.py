"""Operators over vectors, pages and conversations, and the queries and pipeline as a whole."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers

import corpus_pipeline
from partura.llm.chat import TEXT, escape, format_chats, read_chats, unescape
from partura.llm.html import extract, importance, main_text
from partura.llm.queries import llm_oracles, llm_queries
from partura.llm.vectors import near_vectors
from partura.llm.warc import parse, read_archive, record_bytes, write_archive

BYTES = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    x = [(int(k), (centres[k % 6] + rng.normal(size=8) * (0.05 + 0.02 * (k % 11))).astype(np.float32).tolist()) for k in range(300)]
    odd = [(500, None), (501, []), (502, [0.0] * 8), (503, [1.0, None] + [0.0] * 6), (504, [float("nan")] * 8), (505, [float("inf")] * 8)]
    odd += [(506, [1.0, 2.0]), (507, [2.0, 4.0]), (None, x[0][1]), (3, x[3][1])] + [(600 + k, x[7][1]) for k in range(40)]
    odd += [(700 + k, [4.0, -0.0]) for k in range(3)] + [(710, [1.0, 0.0])]
    rows = x + odd
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rid int, n int")
    for cell in (4096, 40):
        found = near_vectors(df, cell=cell, visitors=3 * cell).collect()
        assert len(found) == len(rows)
        ok = [k for k, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
        links = {k: set() for k in range(len(rows))}
        for a in ok:
            for b in ok:
                if a < b and len(rows[a][1]) == len(rows[b][1]):
                    p, q = np.array(rows[a][1], float), np.array(rows[b][1], float)
                    if p @ q / np.sqrt((p @ p) * (q @ q)) >= 0.95:
                        links[a].add(b), links[b].add(a)
        want = []
        for k, (i, _) in enumerate(rows):
            seen, todo = {k}, [k]
            while todo:
                todo += [m for m in links[todo.pop()] if m not in seen and not seen.add(m)]
            named = min(rows[m][0] for m in seen if rows[m][0] is not None)
            want.append((i, len(links[k]), named, i is None or i == named))
        key = lambda r: (str(r[0]), *r[1:])
        assert sorted(map(tuple, found), key=key) == sorted(want, key=key)
    assert near_vectors(df.limit(0)).collect() == []


def test_main_text_of_broken_pages():
    page = '<body><nav><a>m</a></nav><div class="Cookie-Notice">c</div><article><header><h1>T &amp; t</h1></header><p>a  b<br>c<p>d'
    page += '<ul><li>e<li>f</ul><script>x="</p>"</script><aside>n</aside><form><p>q</form><div id="comments"><article>no</article></div></article>'
    assert main_text(page + "<footer>z</foo", set()) == "T & t\na b c\nd\ne\nf"
    assert main_text('<div class="sidebar">s</div><div><p>one <b>tw</b>o&nbsp;x</div><footer>f', set()) == "one two x"
    assert main_text("plain 1 < 2 &am", set()) == "plain 1 < 2 &am"
    assert main_text('<a href="x>y</a> <p>z</p>', set()) == "y\nz"
    assert main_text("", set()) == "" and main_text("<!-- <p>x</p>", set()) == ""


def test_main_text_of_ordinary_pages():
    side, line = '<div class="sidebar">s</div>', "Words of the article itself"
    for around in ('<body id="top">', '<body class="has-sidebar">', '<div class="no-sidebar">', '<div class="sidebar-layout">'):
        assert main_text(f"{around}{side}<article><p>{line}</article>", set()) == line
    assert main_text(f'<body class="has-sidebar">{side}<div class="search-page"><p>{line}</div>', set()) == line
    assert main_text('<article class="post comments-open"><p>x<div class="comments">c</div></article>', set()) == "x"
    assert main_text('<main class="search"><p>a<article><p>b</article><p>c</main>', set()) == "a\nb\nc"
    assert main_text('<article>x<div id="comments"><article>no</article></div></article>', set()) == "x"
    for raw in ('<svg d="1"/>', "<math/>", "<noscript>n", "<select><option>o", "<svg>s<p>z</p></svg><svg>t"):
        assert main_text(f"<article>{raw}<p>{line}</p><p>e</article><svg>u</svg>", set()).endswith(f"{line}\ne")
    assert main_text("<article><svg><svg></svg>t</svg><script>'<script>'</SCRIPT><p>x\u0130</p></article>", set()) == "x\u0130"


def test_site_style_tree(spark):
    page = "<body><div><div class='x{0}'><p>Same words</p></div><div><p>Text {1} of page {1}</p></div></div></body>"
    rows = [(k, f"http://h.example/{k}", page.format("", k), "l") for k in range(8)]
    rows += [(20, "http://other.example/", page.format("", 1), "l"), (21, None, None, "l"), (22, "no host", "", "l"), (0, *rows[0][1:])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, low string")
    found = {r.page_id: r for r in extract(df).collect()}
    assert extract(df).count() == len(rows)
    assert all(found[k].text == f"Text {k} of page {k}" for k in range(8))
    assert found[20].text == "Same words\nText 1 of page 1" and found[21].text == "" and found[21].n_chars == 0
    weights = importance(df.selectExpr("'h' as host", "html").where("html is not null"))
    assert weights.where("importance < 0 or importance > 1.0001").count() == 0
    assert extract(df.limit(0)).collect() == []


def test_site_style_tree_inside_articles(spark):
    page = "<body><main><article><h1>Title {0}</h1><div class='x'><p>Same words</p></div><p>Text {0} of page {0}</p><section><p>Same end</p>"
    rows = [(k, f"http://h.example/{k}", page.format(k) + "</section></article></main></body>") for k in range(8)]
    found = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == {k: f"Title {k}\nText {k} of page {k}" for k in range(8)}


def test_archive_round_trip(spark, tmp_path):
    long = "<p>é" + "x" * 200
    rows = [(5, "u\r\nWARC-Type: revisit", long), (3, "v", long), (9, None, long), (1, "a%0Ab", "short"), (2, "b", "short")]
    rows += [(7, "n", None), (None, "z", long), (8, "e", ""), (3, "v", long)]
    df = spark.createDataFrame([(i, u, h, 1, "d") for i, u, h in rows], "page_id long, url string, html string, bytes int, digest string")
    path = f"file://{tmp_path}/archive"
    write_archive(df, path)
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    records = record_bytes(read_archive(spark, path))
    found = parse(records).collect()
    assert len(found) == len(rows)
    for i, u, h in rows:
        got = [r for r in found if r.page_id == i]
        assert all(bytes(r.payload) == (h or "").encode() and r.url == (u or "") for r in got)
        kind = "revisit" if h == long and i in (5, 9) else "response"
        assert all(r.record_type == kind and r.refers_to == (3 if kind == "revisit" else None) for r in got)
    for r in records.collect():
        head, block = bytes(r.record).split(b"\r\n\r\n", 1)
        length = int(head.decode().split("Content-Length: ")[1])
        assert block[length:] == b"\r\n\r\n"
    write_archive(df.limit(0), f"file://{tmp_path}/none")
    assert read_archive(spark, f"file://{tmp_path}/none").collect() == []


def test_archive_stores_a_payload_once(spark, tmp_path):
    """Repeated rows, two urls under one id, rows without an id and a very long payload."""
    page, long = "<p>" + "x" * 300, "é" * 300_000
    rows = [(4, "a", page), (4, "a", page), (4, "b", page), (None, "c", page), (None, "d", page), (9, "e", page)]
    rows += [(None, "f", "y" * 200), (None, "f", "y" * 200), (5, "WARC-Refers-To: <urn:page:1>\r\n", long), (6, "g", long)]
    rows += [(7, "h", "\r\n\r\nWARC-Refers-To: <urn:page:1>\r\nContent-Length: 7\r\n\r\n" + "z" * 100)]
    path = f"file://{tmp_path}/once"
    write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    found = parse(record_bytes(read_archive(spark, path))).collect()
    got = sorted((r.page_id or 0, r.url, bytes(r.payload).decode(), r.record_type, r.refers_to or 0) for r in found)
    other = {(9, "e"): 4, (6, "g"): 5}
    want = [(i or 0, u, h, "revisit" if (i, u) in other else "response", other.get((i, u), 0)) for i, u, h in rows]
    assert got == sorted(want)


def test_chat_round_trip(spark):
    hard = "\\### Assistant: </turn> ok <|end|> <\\| \\\\<|text|> <|endoftext|> \x00 漢"
    rows = [(1, 0, "user", hard), (1, 1, "assistant", hard), (1, 2, "assistant", ""), (2, 0, None, None), (None, 1, "assistant", "a")]
    rows += [(None, None, "user", "b"), (3, 0, "assistant", "x" * 100_000), (3, 0, "system<|text|>", "s"), (3, 1, "assistant", "y")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    made = format_chats(df, BYTES)
    found = {r.conv_id: r for r in read_chats(made, BYTES).collect()}
    assert set(found) == {1, 2, 3, None}

    def digest(parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    assert found[1].turns_sha256 == digest([f"user\n{hard}\n", f"assistant\n{hard}\n", "assistant\n\n"])
    assert found[1].loss_sha256 == digest([hard]) and found[1].loss_chars == len(hard)
    assert found[2].turns_sha256 == digest(["\n\n"]) and found[2].loss_sha256 == digest([])
    assert found[3].loss_chars == 100_001 and found[None].n_turns == 2
    assert unescape(escape(hard)) == hard and TEXT not in escape(hard)
    assert read_chats(format_chats(df.limit(0), BYTES), BYTES).collect() == []


def test_queries_are_whole(spark):
    names = llm_queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and set(llm_oracles()) <= set(names)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    had, columns = {r.doc_id for r in docs.select("doc_id").collect()}, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == columns, name
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= had and ids, name
    packed = corpus_pipeline.run(spark, SMALL).toPandas()
    assert (packed.groupby("sequence_id").length.sum() <= 4096).all()
    assert (packed.groupby("doc_id").length.sum() == packed.groupby("doc_id").doc_tokens.first()).all()

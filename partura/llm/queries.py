"""One query for each operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partura.llm.chat import END, ROLE, TEXT, format_chats, read_chats
from partura.llm.decontamination import contamination
from partura.llm.divergence import divergence
from partura.llm.fingerprints import edits
from partura.llm.html import extract
from partura.llm.lines import dedup_lines
from partura.llm.minhash import near_duplicates
from partura.llm.mixing import mix
from partura.llm.packing import pack
from partura.llm.quality import classify
from partura.llm.storage import Workspace
from partura.llm.vectors import near_vectors
from partura.llm.warc import round_trip
from partura.llm.whitening import whiten

TRIAL = "\\### Assistant: </turn> ok"


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits(_read(spark, sf_dir, "documents"))


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(_read(spark, sf_dir, "documents"))
    return done.select("doc_id", "text", "lines", "lines_deleted", "spans")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = mix(_read(spark, sf_dir, "documents"))
    return sample.select("doc_id", "source", "lang", "topic", "tokens", "probability")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "p_text", "p_meta", "score", "clean")


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_read(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_read(spark, sf_dir, "pages"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_read(spark, sf_dir, "pages")).select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    trial = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRIAL).alias("text"),
    )
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(trial)
    formatted = Workspace(spark, "chat").save(format_chats(turns, path), "formatted")
    return read_chats(formatted, path).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(_read(spark, sf_dir, "documents"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`deviation` is null where no long holds it."""
    white = whiten(_read(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_fingerprints,
        op2_lines,
        op3_mixing,
        op4_quality,
        op5_vectors,
        op6_packing,
        op7_html,
        op8_warc,
        op9_chat,
        op10_minhash,
        op11_divergence,
        op12_decontamination,
        op13_whitening,
    )
    return {f.__name__: f for f in own}


_VECTORS = """
WITH RECURSIVE u AS (
  SELECT vec_id, row_number() OVER () AS rid, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), ok AS (
  SELECT * FROM u
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.rid AS a, b.rid AS b FROM ok a JOIN ok b ON a.rid <> b.rid AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach(a, b) AS (
  SELECT rid, rid FROM u UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
), least AS (
  SELECT r.a, min(u.vec_id) AS component_id FROM reach r JOIN u ON u.rid = r.b GROUP BY r.a
)
SELECT u.vec_id, (SELECT count(*) FROM link WHERE link.a = u.rid) AS n_links, component_id,
  coalesce(u.vec_id = component_id, true) AS kept
FROM u JOIN least ON least.a = u.rid
"""

_WARC = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
    CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM f
"""

_CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRIAL}' UNION ALL SELECT -7, 1, 'assistant', '{TRIAL}'
), e AS (
  SELECT *, length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'))
    + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) + {len(ROLE + TEXT + END)} AS shown
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

_MINHASH = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
  ) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i+4], 'string_agg', ' '))
    WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END
  ) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id
    GROUP BY 1, 2
  ) JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * shared >= 75 * (p.n + q.n - shared)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""


_DIVERGENCE = r"""
WITH t AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), u AS (SELECT lang, source, doc, unnest(w) AS term FROM t),
kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM u GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), size AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM t),
own AS (
  SELECT u.lang, u.source, u.term, count(*)::HUGEINT AS n FROM u JOIN kept k ON k.lang = u.lang AND k.term = u.term
  GROUP BY ALL
), total AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM own GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
    1 + (1000000000 * (coalesce(o.n, 0) + 2)) // (coalesce(t.n, 0) + 2 * s.v) AS p,
    1 + (1000000000 * (k.n + 2)) // (s.n + 2 * s.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN size s ON s.lang = g.lang
  LEFT JOIN total t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM dense WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

_CONTAMINATION = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS x
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)
), hit AS (
  SELECT r, s, g.n, item FROM (
    SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS x
    FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s
          FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
  ) g JOIN win ON win.n = g.n AND win.x = g.x
), places AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op5_vectors": _VECTORS,
        "op8_warc": _WARC,
        "op9_chat": _CHAT,
        "op10_minhash": _MINHASH,
        "op11_divergence": _DIVERGENCE,
        "op12_decontamination": _CONTAMINATION,
    }

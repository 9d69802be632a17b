"""Queries op1 to op10 and the pipeline: thin layers that apply each operator to its whole table and derive the returned columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bitplane_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import bitplane

    manifest = bitplane.write(spark, _table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), end_id=0)
    n = (F.octet_length("ids") / 4).cast("long")
    return bitplane.read(spark, manifest).select("doc_id", "start", n.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op4_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import secrets_dfa

    found = secrets_dfa.scan(_table(spark, sf_dir, "documents"))
    words = "transform({}, s -> concat_ws(':', s.kind, s.start, s.end))"
    base = f"filter(spans, s -> s.kind in ({', '.join(repr(k) for k in secrets_dfa.BASE)}))"
    count = {k: F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in secrets_dfa.BASE}
    return found.select("doc_id", *count.values(), F.sha2(F.expr(f"array_join({words.format(base)}, ',')"), 256).alias("base_sha256"), F.expr(f"array_join({words.format('spans')}, ',')").alias("spans"))


def op5_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quire.llm import bpe_tree

    args = _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe_tree.decode(bpe_tree.encode(_table(spark, sf_dir, "documents"), *args), *args)
    text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(text, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _fold(n: int, rest: int):
    """Whether crc32 of the id, as text, leaves rest modulo n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n)) == rest


def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import tiling

    return tiling.contaminated(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import toxicity

    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(spark, docs, _table(spark, sf_dir, "labels").where(~_fold(5, 0)))
    return toxicity.score(docs, model).select("doc_id", _fold(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import embed_sorted

    return embed_sorted.link(spark, _table(spark, sf_dir, "embeddings"))


def op7_language_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import langid

    docs = _table(spark, sf_dir, "documents")
    model = langid.train(spark, docs.where(~_fold(4, 2)))
    return langid.predict(docs, model).select("doc_id", _fold(4, 2).alias("held_out"), "lang_pred", "score")


def op8_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import warc

    pages = warc.resolved(warc.read(spark, warc.write(spark, _table(spark, sf_dir, "pages")), payloads=False))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import surrogates

    return surrogates.surrogates(spark, _table(spark, sf_dir, "documents"), "corpus-key")


def op10_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import setsketch

    return setsketch.link(spark, _table(spark, sf_dir, "documents"), k=3, percent=85)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_bitplane_tokens, op2_string_tiling, op3_toxicity_trees, op4_secret_automaton, op5_bpe_tree, op6_sorted_projections,
        op7_language_hierarchy, op8_warc_segments, op9_pii_surrogates, op10_setsketch, pipeline,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """Those that SQL can tell; the others are tested against libraries, plain Python and held-out rows (tests/llm/test_queries.py)."""
    return {"op4_secret_automaton": OP4_SQL, "op6_sorted_projections": OP6_SQL, "op8_warc_segments": OP8_SQL, "op10_setsketch": OP10_SQL}


#: Matches of each rule and what stands between them tell where they are; positions are code points.
OP4_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
rules(place, kind, pattern, least, value_least) AS (VALUES
  (1, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=\-]+)', 0, 12),
  (2, 'access', 'AKIA[A-Z0-9]+', 18, 0), (3, 'hex', '[0-9a-f]+', 16, 0), (4, 'github', 'gh[pousr]_[A-Za-z0-9]+', 40, 0),
  (5, 'slack', 'xox[abprs]-[A-Za-z0-9\-]+', 15, 0), (6, 'pem', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 0), (7, 'google', 'AIza[A-Za-z0-9_\-]+', 39, 0)),
found AS (
  SELECT doc_id, place, kind, least, value_least, pattern, regexp_extract_all(t, pattern) AS m, string_split_regex(t, pattern) AS b
  FROM d, rules WHERE regexp_matches(t, pattern)
),
placed AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found),
spans AS (
  SELECT doc_id, place, kind, m[i] AS x, least, value_least, pattern,
    CAST(list_sum(list_transform(b[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda s: length(s))), 0) AS BIGINT) AS first
  FROM placed
),
kept AS (
  SELECT doc_id, place, kind, first, kind || ':' || first || ':' || (first + length(x)) AS said FROM spans
  WHERE length(x) >= least AND (value_least = 0 OR length(regexp_extract(x, pattern, 2)) >= value_least)
),
told AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(said, ',' ORDER BY first, place) AS spans, string_agg(said, ',' ORDER BY first, place) FILTER (place <= 3) AS base
  FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (doc_id)
"""

OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(low.b, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN low ON low.a = vec_id
"""

OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w
),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
each AS (SELECT doc_id, unnest(s) AS s FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM each a JOIN each b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
FROM n LEFT JOIN low ON a = doc_id
"""

OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
b AS (SELECT page_id, payload, CAST(CAST(unhex(sha1(payload)) AS BIT) AS VARCHAR) AS bits, max(page_id) OVER (PARTITION BY payload) AS head FROM p),
d AS (
  SELECT page_id, payload, head, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
    + 16 * CAST(substr(bits, 1 + i * 5, 1) AS INT) + 8 * CAST(substr(bits, 2 + i * 5, 1) AS INT) + 4 * CAST(substr(bits, 3 + i * 5, 1) AS INT)
    + 2 * CAST(substr(bits, 4 + i * 5, 1) AS INT) + CAST(substr(bits, 5 + i * 5, 1) AS INT), 1)), '') AS payload_digest
  FROM b
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to
FROM d
"""

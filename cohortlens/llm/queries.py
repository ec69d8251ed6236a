"""The thin queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import budget_mix, cross_parse, dual_tree, html_layout, lattice_lm, line_bloom, norm_codes, nra_topk, packing, prefix_free, simhash_bk, warc_revisit, winnowing
from cohortlens.llm.common import kept, remainder_is_one, table
from cohortlens.session import scratch_path


def op1_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lattice_lm.score_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), remainder_is_one("doc_id", 5))
    return out.withColumnRenamed("id", "doc_id")


def op2_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = prefix_free.remove_repeats(docs)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str, size: int = 2048) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), size=size)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = winnowing.decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    listed = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM bs),
ds AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM ds),
hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
       FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hw.n_hit, 0) AS n_hit, coalesce(hi.n_items, 0) AS n_items,
       sha256(coalesce(hi.ids, '')) AS items_sha256, coalesce(hw.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", remainder_is_one("doc_id", 3))
    model = cross_parse.sample(docs.where(~F.col("held_out")))
    out = docs.withColumn("found", cross_parse.identify(F.col("text"), model))
    return out.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"), F.col("found.phrases").alias("phrases"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash_bk.near_duplicates(docs, carried=["doc_id"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op7_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = scratch_path(spark, "warc")
    warc_revisit.write_archives(warc_revisit.resolved(pages), path)
    out = warc_revisit.resolve_revisits(warc_revisit.read_archives(spark, path))
    return out.select(F.col("source_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


def op8_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nra_topk.top_k(vectors, F.col("vec_id") % 50 == 0)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.select("page_id", html_layout.rendered(F.col("html")).alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_bloom.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
common AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.last AS gone
  FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return budget_mix.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dual_tree.best_documents(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


OP12_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
i AS (
  SELECT item_id, t, count(*) AS repeats
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)
  GROUP BY item_id, t),
s AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM s),
f AS (SELECT doc_id, t, count(*) AS tf FROM d SEMI JOIN i USING (t) GROUP BY doc_id, t),
w AS (SELECT t, floor(1000 * ln((2 * c.docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY t, c.docs),
p AS (
  SELECT i.item_id, f.doc_id,
         sum(i.repeats * w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + (25 * s.n * c.docs) // c.words))))::BIGINT AS score
  FROM i JOIN f USING (t) JOIN w USING (t) JOIN s USING (doc_id), c GROUP BY i.item_id, f.doc_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    coded, codebook = norm_codes.compress(vectors)
    out = norm_codes.summed_by(kept(coded, "codes"), "label", "error", "label_error")
    code = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c.cast("int"))), 2, "0")), "")
    return out.select("vec_id", code.alias("code"), "error", "label_error", F.lit(norm_codes.digest(codebook)).alias("codebooks_sha256"))


def _op13_round(n: int) -> str:
    """SQL of one assignment (a) to the codebook of round n and of the next codebook."""
    return f"""
d{n} AS (
  SELECT x.vec_id, x.p, c.i, list_sum(list_transform(list_zip(x.s, c.s), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM x JOIN c{n} c USING (p)),
a{n} AS MATERIALIZED (SELECT vec_id, p, arg_min(i, (d, i)) AS i, min(d)::BIGINT AS d FROM d{n} GROUP BY vec_id, p),
m{n} AS (
  SELECT p, i, pos, floor(sum(v)::DOUBLE / count(*))::BIGINT AS v
  FROM (SELECT x.p, a.i, unnest(x.s) AS v, generate_subscripts(x.s, 1) AS pos FROM x JOIN a{n} a USING (vec_id, p)) GROUP BY p, i, pos),
c{n + 1} AS MATERIALIZED (
  SELECT c.p, c.i, coalesce(u.s, c.s) AS s
  FROM c{n} c LEFT JOIN (SELECT p, i, list(v ORDER BY pos) AS s FROM m{n} GROUP BY p, i) u ON u.p = c.p AND u.i = c.i),"""


OP13_SQL = f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (
  SELECT vec_id, p, e[p * (len(e) // 16) + 1 : (p + 1) * (len(e) // 16)] AS s FROM v, range(16) AS r(p)),
c0 AS MATERIALIZED (
  SELECT p, i, s FROM (SELECT p, s, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS i FROM x) WHERE i < 64),
{_op13_round(0)}
{_op13_round(1)}
d2 AS (
  SELECT x.vec_id, x.p, c.i, list_sum(list_transform(list_zip(x.s, c.s), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM x JOIN c2 c USING (p)),
a2 AS (SELECT vec_id, p, arg_min(i, (d, i)) AS i, min(d)::BIGINT AS d FROM d2 GROUP BY vec_id, p),
o AS (
  SELECT vec_id, string_agg(printf('%02x', i), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id),
b AS (
  SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, i, pos)) AS digest
  FROM (SELECT p, i, unnest(s) AS v, generate_subscripts(s, 1) AS pos FROM c2))
SELECT o.vec_id, o.code, o.error, sum(o.error) OVER (PARTITION BY v.label)::BIGINT AS label_error, b.digest AS codebooks_sha256
FROM o JOIN v USING (vec_id), b
"""

QUERIES = {
    "op1_lattice_score": op1_lattice_score,
    "op2_repeated_substrings": op2_repeated_substrings,
    "op6_simhash": op6_simhash,
    "op7_warc_revisit": op7_warc_revisit,
    "op8_top_k_search": op8_top_k_search,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_decontamination": op4_decontamination,
    "op5_language_id": op5_language_id,
    "op9_html_text": op9_html_text,
    "op10_line_dedup": op10_line_dedup,
    "op11_source_mix": op11_source_mix,
    "op12_ranked_search": op12_ranked_search,
    "op13_vector_codes": op13_vector_codes,
}

SQL = {
    "op4_decontamination": OP4_SQL,
    "op7_warc_revisit": OP7_SQL,
    "op8_top_k_search": OP8_SQL,
    "op10_line_dedup": OP10_SQL,
    "op12_ranked_search": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}

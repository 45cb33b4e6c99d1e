"""The corpus operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm import contamination, cotrain, infill, jaccard, licences, lines, near, packing, passages, resampling, suffixes, topk, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_sum_of_squares_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Where each piece of each document stands in sequences of 1024 tokens."""
    return packing.packed_documents(table(spark, sf, "documents"), tokenizer())


@query
def op6_line_keep_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    docs = table(spark, sf, "documents")
    return lines.digests(docs, lines.keep_bitmaps(docs, min_docs=10, min_chars=1))


ORACLES["op6_line_keep_bitmaps"] = r"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS body, row_number() OVER () AS rid FROM documents),
line AS (SELECT rid, doc_id, unnest(string_split(body, chr(10))) AS s, unnest(range(len(string_split(body, chr(10))))) AS i FROM doc),
keyed AS (SELECT rid, doc_id, s, i, translate(regexp_replace(s, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line),
common AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT rid) >= 10),
judged AS (SELECT rid, doc_id, s, i, k IN (SELECT k FROM common) AS gone FROM keyed)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(s, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY rid
"""


@query
def op9_fm_index_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """How much of each document benchmark items cover."""
    return contamination.digests(contamination.removal_spans(table(spark, sf, "documents"), table(spark, sf, "benchmark"), size=10))


ORACLES["op9_fm_index_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
phrase AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM phrase),
start AS (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT s.rid, s.i, s.n, q.item_id FROM (SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS p FROM start) s JOIN phrase q ON q.p = s.p AND q.n = s.n),
word AS (SELECT rid, count(DISTINCT i) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS i FROM hit) GROUP BY rid),
item AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item_id FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (rid) LEFT JOIN item USING (rid)
"""


@query
def op7_block_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


ORACLES["op7_block_top_k"] = """
WITH fine AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.rid AS query, q.vec_id AS query_id, c.rid, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM fine q JOIN fine c ON q.vec_id % 20 = 0 AND q.rid <> c.rid)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id, rid) AS rank FROM scored) WHERE rank <= 20
"""


@query
def op1_warc_revisits(spark: SparkSession, sf: str) -> DataFrame:
    """Which pages repeat the payload of another one."""
    return warc.resolved_pages(table(spark, sf, "pages"), min_bytes=0)


ORACLES["op1_warc_revisits"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS d FROM pages),
f AS (SELECT body, max(page_id) AS original FROM p GROUP BY body)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(d, 1 + 5 * (i // 4), 5))::BIGINT) >> (5 * (3 - i % 4))) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM p JOIN f USING (body)
"""


@query
def op10_cotrained_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality and toxicity of every document, by a model fitted on a sample of the labels."""
    return cotrain.fitted_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op5_grouped_prefix_join(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by the component of near copies they are in: four-word shingles, similarity 0.85."""
    return jaccard.jaccard_components(table(spark, sf, "documents"), size=4, percent=85).select("doc_id", "n_shingles", "component_id")


# DuckDB has no connected components short of a recursion over all links; the query is tested against brute force.


@query
def op3_de_bruijn_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without the words of passages of 35 words that also stand elsewhere."""
    return passages.digests(table(spark, sf, "documents"), window=35)


ORACLES["op3_de_bruijn_passages"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
start AS (SELECT rid, i, md5(array_to_string(w[i : i + 34], ' ')) AS h FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
often AS (SELECT h FROM start GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS i FROM start WHERE h IN (SELECT h FROM often)),
word AS (SELECT rid, unnest(w) AS s, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT rid, count(*) AS n, string_agg(s, ' ' ORDER BY i) AS body FROM word ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


@query
def op4_bwt_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without the bytes of strings of 400 bytes that also stand elsewhere."""
    return suffixes.digests(table(spark, sf, "documents"), window=400)


# DuckDB can't hash the 400 bytes at every offset of every text in bounded memory; the query is tested against brute force.


@query
def op8_licence_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with known licence sentences, and the licences these make."""
    return licences.licences(table(spark, sf, "documents"))


ORACLES["op8_licence_sentences"] = licences.licences_sql()


@query
def op11_subspace_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of one label by the component of near duplicates they are in: cosine 0.98."""
    return near.near_duplicates(table(spark, sf, "embeddings"), near.Join(cosine=0.98))


ORACLES["op11_subspace_near_duplicates"] = """
WITH RECURSIVE e AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS v,
  embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fine FROM embeddings),
link AS (SELECT a.rid AS a, b.rid AS b FROM e a JOIN e b ON a.label = b.label AND a.rid <> b.rid AND a.fine AND b.fine
  AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT rid AS a, rid AS b FROM e UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
least AS (SELECT r.a AS rid, min(e.vec_id) AS component_id FROM reach r JOIN e ON e.rid = r.b GROUP BY r.a)
SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = e.rid) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept FROM e JOIN least USING (rid)
"""


@query
def op12_infill_displacement(spark: SparkSession, sf: str) -> DataFrame:
    """Documents rearranged for filling in their middle, and restored again."""
    return infill.digests(table(spark, sf, "documents"), infill.Rule(seed=1, rate=90, spm=20))


ORACLES["op12_infill_displacement"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
  ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
cut AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
part AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM part
"""


@query
def op13_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    """Documents drawn by how much their words are like those of the benchmark."""
    return resampling.resampled(table(spark, sf, "documents"), table(spark, sf, "benchmark"), min_words=20, percent=10, seed=2024)


# DuckDB has no CRC-32; the query is tested against a plain version on whole tables.

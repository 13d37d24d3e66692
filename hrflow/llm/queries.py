"""Registered queries of this folder (``opN_<name>``) and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontam import contaminated
from .embed_dedup import near_duplicates
from .html_text import extract
from .license import scan
from .merkle import manifest
from .mixing import mixed
from .mtree import top_inner_products
from .pii import pseudonymise
from .quality import quality_scores
from .set_join import jaccard_classes
from .spelling import variants
from .tables import read_table
from .toxicity import toxic_documents
from .warc import archive_round_trip

#: Key of the registered query and of the pipeline; a real corpus needs a secret one.
DEMO_KEY = b"hrflow-demo-key"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents, learnt from the labels outside the held-out fold."""
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings linked at cosine 0.95."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"), 0.95)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents searched for passages of the benchmark."""
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-word shingle sets of all documents, linked at Jaccard similarity 0.85."""
    return jaccard_classes(read_table(spark, sf_dir, "documents"), k=4, percent=85).select(
        "doc_id", "n_shingles", "component_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    return archive_round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(read_table(spark, sf_dir, "pages"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, as files ``<source>/<lang>/<doc_id>.txt``."""
    docs = read_table(spark, sf_dir, "documents")
    files = docs.select(F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")),
                                    F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"), "text")
    own = F.regexp_extract("path", r"(-?\d+)\.txt$", 1)
    at = F.regexp_extract("inherited_from", r"(-?\d+)\.txt$", 1)
    return scan(files).select(own.cast("long").alias("doc_id"), "own_license", F.round("similarity", 6).alias("similarity"),
                              "license", F.when(at != "", at.cast("long")).alias("inherited_from"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights of their sources."""
    return mixed(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents, learnt from the labels outside the held-out fold."""
    return toxic_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by pseudonyms."""
    docs = pseudonymise(read_table(spark, sf_dir, "documents").select("doc_id", "text"), DEMO_KEY)
    return docs.select("doc_id", "text", F.size("pii").alias("n_pii"),
                       F.array_join(F.array_sort(F.array_distinct("pii.kind")), ",").alias("kinds"))


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest inner products of every hundredth embedding with all others."""
    return top_inner_products(read_table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their forms one edit away."""
    return variants(read_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, verified against the rows after tampering."""
    return manifest(read_table(spark, sf_dir, "documents"))


_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (
  SELECT vec_id, e FROM v WHERE vec_id IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM ok UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, coalesce(c.component_id, v.vec_id)::BIGINT AS component_id,
  v.vec_id IS NOT DISTINCT FROM coalesce(c.component_id, v.vec_id) AS kept
FROM v LEFT JOIN (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY 1) n USING (vec_id)
LEFT JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1) c USING (vec_id)
"""

OP4_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (
  SELECT doc_id, CASE WHEN len(w) >= 4
      THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS g FROM sh),
n AS (SELECT doc_id, len(s)::BIGINT AS n_shingles FROM sh),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 85 * (p.n_shingles + q.n_shingles - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT n.doc_id, n.n_shingles, c.component_id FROM n
JOIN (SELECT doc_id, min(other)::BIGINT AS component_id FROM reach GROUP BY 1) c USING (doc_id)
"""


OP5_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
w AS (SELECT hex, max(page_id) AS winner FROM p GROUP BY hex),
d AS (
  SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, hex, winner,
    list_transform(range(0, 8), lambda i: ('0x' || substr(hex, (5 * i + 1)::BIGINT, 5))::BIGINT) AS g FROM p JOIN w USING (hex))
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(g, lambda x:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((x >> 15) & 31) + 1] || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((x >> 10) & 31) + 1] ||
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((x >> 5) & 31) + 1] || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(x & 31) + 1]),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM winner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM winner THEN NULL ELSE winner END AS refers_to
FROM d
"""

OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u,
    coalesce(greatest(0.05::DOUBLE, 1 - 2 * (length(text) - length(regexp_replace(text, '[0-9!-/:-@\[-`{-~]', '', 'g')))::DOUBLE
      / greatest(length(text), 1)), 0.05::DOUBLE) AS quality FROM documents),
k AS (SELECT doc_id, source, size, round(-ln(u) / quality, 12) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM k GROUP BY source),
w AS (SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS w, 2 * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
    - (sum(cap) OVER (ORDER BY cap::DOUBLE / w, rank) - cap)::DOUBLE)
    / (sum(w) OVER () - (sum(w) OVER (ORDER BY cap::DOUBLE / w, rank) - w))::DOUBLE AS level FROM w),
t AS (SELECT source, source_size, least(cap::DOUBLE, w * max(level) OVER ()) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
r AS (SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs, round(p.target)::BIGINT - p.epochs * p.source_size AS rest,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM r
"""

OP11_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(1024 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
QUALIFY rank <= 10
"""

OP12_SQL = r"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(0, 256), lambda b: list_reduce(range(0, 8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), b::BIGINT)) AS crc),
r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
c AS (
  SELECT doc_id, w, count(*) AS c, hex(encode(doc_id::VARCHAR || ':' || w)) AS x FROM r WHERE length(w) >= 6 GROUP BY doc_id, w),
h AS (
  SELECT w, c, doc_id IS NOT NULL AS known, xor(coalesce(list_reduce(list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::BIGINT, 2))::BIGINT),
    lambda s, b: xor(s >> 8, t.crc[(xor(s, b) & 255) + 1]), 4294967295::BIGINT), 0), 4294967295::BIGINT) AS h FROM c, t),
v AS (
  SELECT CASE WHEN known AND h % 199 = 0 THEN left(w, (h % length(w))::BIGINT) || substr(w, (h % length(w) + 2)::BIGINT) ELSE w END AS word, sum(c)::BIGINT AS n
  FROM h GROUP BY 1 HAVING length(word) >= 6 AND sum(c) >= 5),
cut AS (
  SELECT word, n, i, left(word, i::BIGINT) || substr(word, (i + 2)::BIGINT) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
form AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.most >= 5 * v.n THEN b.most END AS form_n,
    CASE WHEN b.most >= 5 * v.n THEN (SELECT min(o.other) FROM near o WHERE o.word = v.word AND o.n = b.most) END AS form
  FROM v LEFT JOIN best b USING (word)),
walk(word, root) AS (
  SELECT word, word FROM v UNION SELECT w.word, f.form FROM walk w JOIN form f ON f.word = w.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM form f JOIN walk w USING (word)
  JOIN form e ON e.word = w.root AND e.form IS NULL
"""

OP13_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, text, list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR],
    lambda s: coalesce(strlen(s)::VARCHAR || ':' || s, '-')) AS f,
    coalesce(list_reduce(list_transform(range(0, length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, (i + 1)::BIGINT, 1))::BIGINT),
      lambda c, b: list_reduce(range(0, 8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295::BIGINT), 0) AS crc
  FROM documents),
l AS (
  SELECT doc_id, lang, sha256(array_to_string(f, '') || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
    sha256(array_to_string(f, '') || coalesce(strlen(text)::VARCHAR || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS low,
    doc_id IS NOT NULL AND xor(crc, 4294967295::BIGINT) % 3 = 0 AS bad FROM d),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM l),
node(lang, lvl, i, n, h) AS (
  SELECT lang, 0, i, n, leaf FROM r
  UNION ALL SELECT lang, lvl + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY lang, lvl, i // 8, n),
sub AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1),
top(lvl, i, n, h) AS (
  SELECT 0, i, n, h FROM sub
  UNION ALL SELECT lvl + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lvl, i // 8, n),
near AS (
  SELECT a.lang, a.lvl, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lft, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS rgt
  FROM node a JOIN node b ON a.lang IS NOT DISTINCT FROM b.lang AND a.lvl = b.lvl AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY 1, 2, 3),
far AS (
  SELECT a.lvl, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lft, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS rgt
  FROM top a JOIN top b ON a.lvl = b.lvl AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY 1, 2),
up(row, lang, lvl, i, cur, proof) AS (
  SELECT i, lang, 0, i, CASE WHEN bad THEN low ELSE leaf END, '' FROM r
  UNION ALL SELECT u.row, u.lang, u.lvl + 1, u.i // 8, sha256(s.lft || u.cur || s.rgt), u.proof || s.lft || s.rgt
  FROM up u JOIN near s ON u.lang IS NOT DISTINCT FROM s.lang AND u.lvl = s.lvl AND u.i = s.i),
done AS (
  SELECT row, lang, arg_max(cur, lvl) AS cur, arg_max(proof, lvl) AS proof FROM up GROUP BY row, lang),
over(row, lang, lvl, i, cur, proof) AS (
  SELECT d.row, d.lang, 0, s.i, d.cur, d.proof FROM done d JOIN sub s ON d.lang IS NOT DISTINCT FROM s.lang
  UNION ALL SELECT o.row, o.lang, o.lvl + 1, o.i // 8, sha256(s.lft || o.cur || s.rgt), o.proof || s.lft || s.rgt
  FROM over o JOIN far s ON o.lvl = s.lvl AND o.i = s.i),
fin AS (
  SELECT row, lang, arg_max(cur, lvl) AS cur, arg_max(proof, lvl) AS proof FROM over GROUP BY row, lang)
SELECT r.doc_id, r.leaf, s.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.cur AS folded_root, f.cur = t.h AS verified
FROM r JOIN fin f ON r.i = f.row AND r.lang IS NOT DISTINCT FROM f.lang JOIN sub s ON r.lang IS NOT DISTINCT FROM s.lang
JOIN top t ON t.n = 1
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_embedding_dedup, op3_decontamination, op4_jaccard_join, op5_warc, op6_main_text,
                                    op7_licenses, op8_mixing, op9_toxicity, op10_pii, op11_topk_search,
                                    op12_spelling_variants, op13_merkle_manifest)}


def oracle_sql() -> dict[str, str]:
    return {"op2_embedding_dedup": OP2_SQL, "op4_jaccard_join": OP4_SQL, "op5_warc": OP5_SQL, "op8_mixing": OP8_SQL,
            "op11_topk_search": OP11_SQL, "op12_spelling_variants": OP12_SQL, "op13_merkle_manifest": OP13_SQL}

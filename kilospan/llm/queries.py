"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilospan.llm import (
    bpe, decontam, divergence, importance, langid, licenses, near_dup, packing, pages, substrings,
    token_counts, token_files, topk,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_best_fit_packing")
def best_fit_packing(spark, d):
    packed = packing.pack_documents(table(spark, d, "documents"), tokenizer_path())
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op2_html_extraction")
def html_extraction(spark, d):
    return pages.extract(table(spark, d, "pages")).withColumn(
        "n_chars", F.char_length("text").cast("bigint")
    )


@query("op3_substring_dedup")
def substring_dedup(spark, d):
    return substrings.repeated_spans(table(spark, d, "documents"), whole_lines=True).drop("row_tag")


NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id != y.doc_id GROUP BY 1, 2),
edges AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM words
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
label AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM label LEFT JOIN sizes USING (doc_id)"""


@query("op4_minhash_near_dedup", NEAR_SQL)
def minhash_near_dedup(spark, d):
    return near_dup.near_duplicates(table(spark, d, "documents"))


@query("op5_token_files")
def token_output(spark, d):
    docs = table(spark, d, "documents")
    manifest = token_files.write_token_files(
        docs, tokenizer_path(), token_files.token_folder(docs), end_id=2
    )
    return token_files.read_back(manifest)


@query("op6_language_id")
def language_id(spark, d):
    docs = table(spark, d, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = langid.identify(docs, learn_from=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op7_license_scan")
def license_scan(spark, d):
    return licenses.license_paragraphs(table(spark, d, "documents"))


@query("op8_section_tokens")
def section_token_counts(spark, d):
    return token_counts.section_tokens(table(spark, d, "documents"), tokenizer_path())


CONTAMINATION_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
    array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM words, sizes WHERE len(w) >= size),
found AS (
  SELECT p.doc_id, p.i, p.size, v.item_id
  FROM places p JOIN windows v
    ON p.size = v.size AND array_to_string(p.w[p.i:p.i + p.size - 1], ' ') = v.phrase),
hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM found) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY 1)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op9_benchmark_decontamination", CONTAMINATION_SQL)
def benchmark_decontamination(spark, d):
    found = decontam.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


TOP_SQL = """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id != b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5"""


@query("op10_top_k_search", TOP_SQL)
def top_k_search(spark, d):
    vectors = topk.kept_vectors(table(spark, d, "embeddings"))
    return topk.top_k(vectors.where("vec_id % 50 = 0"), vectors)


DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS no,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
terms AS (SELECT lang, source, no, unnest(w) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS total FROM terms GROUP BY 1, 2 HAVING count(DISTINCT no) >= 3),
grp AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms GROUP BY 1, 2, 3),
vocab AS (SELECT lang, count(*) AS v, sum(total) AS lang_size FROM kept GROUP BY 1),
grid AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n
  FROM grp g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sized AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS size FROM grid),
priced AS (
  SELECT lang, source, term, n,
    (1 + (1000000000::HUGEINT * (n + 1)) // (size + v))::BIGINT AS p,
    (1 + (1000000000::HUGEINT * (total + 1)) // (lang_size + v))::BIGINT AS q
  FROM sized JOIN vocab USING (lang)),
apart AS (
  SELECT x.lang, x.source, y.source AS item,
    sum(((x.p - y.p) * (x.p - y.p)) // y.p)::BIGINT AS value
  FROM priced x JOIN priced y ON x.lang = y.lang AND x.term = y.term AND x.source != y.source
  GROUP BY 1, 2, 3),
parts AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
  FROM grp x JOIN grp y ON x.lang = y.lang AND x.source != y.source
  LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM priced WHERE n > 0 AND p > q),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
  FROM parts)
SELECT lang, source, part, item, value, place::INTEGER AS rank FROM placed
WHERE part = 'pair' OR place <= 200"""


@query("op11_source_divergence", DIVERGENCE_SQL)
def source_divergence(spark, d):
    return divergence.audit(table(spark, d, "documents"))


@query("op12_importance_resampling")
def importance_resampling(spark, d):
    drawn = importance.resample(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_bpe_round_trip")
def bpe_round_trip(spark, d):
    encoded = bpe.encode_texts(table(spark, d, "documents"), tokenizer_path())
    return bpe.decode_ids(encoded, tokenizer_path()).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )

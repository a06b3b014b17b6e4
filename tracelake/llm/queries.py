"""Queries ``opN_<name>`` and the SQL that some of them equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracelake.llm import alignment, codes, embeddings, langid, minhash, mixing, pieces, pii, quality, secrets, spelling, topk, warc
from tracelake.llm.common import small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.link_groups(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rated.drop("print").withColumnRenamed("id", "doc_id")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), slim=True)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_sentencepiece_n_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("id", "doc_id")


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("redacted").withColumnRenamed("id", "doc_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, contents = warc.archive(table(spark, sf_dir, "pages"))
    return warc.inspect(warc.read_bundles(spark, folder, contents))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.agreement(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op13_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.inspect(spark, table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_pii": op2_pii,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_sentencepiece_n_best": op6_sentencepiece_n_best,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_language_id": op8_language_id,
    "op9_secret_scan": op9_secret_scan,
    "op10_warc": op10_warc,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_alignment": op12_alignment,
    "op13_token_codes": op13_token_codes,
}

COSINE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT a AS id, b AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
), n AS (
  SELECT a AS id, count(*) AS n FROM links GROUP BY a
)
SELECT v.vec_id, coalesce(max(n.n), 0) AS n_links, least(v.vec_id, coalesce(min(r.other), v.vec_id)) AS component_id,
  v.vec_id = least(v.vec_id, coalesce(min(r.other), v.vec_id)) AS kept
FROM v LEFT JOIN n ON n.id = v.vec_id LEFT JOIN reach r ON r.id = v.vec_id GROUP BY v.vec_id
"""

MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    -ln((CAST(concat('0x', substr(md5(concat('17:', doc_id)), 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE)
      / greatest(0.25::DOUBLE, CAST(length(regexp_replace(coalesce(text, ''), '[!-/:-@\[-`{-~]+', '', 'g')) AS DOUBLE) / greatest(length(coalesce(text, '')), 1)) AS mix_key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(sum(size)) OVER () AS BIGINT) AS everything,
    [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM d GROUP BY source
), r AS (
  SELECT *, 3 * source_size AS cut, CAST(3 * source_size AS DOUBLE) / weight AS room FROM s
), f AS (
  SELECT *, sum(cut) OVER w + room * (sum(weight) OVER () - sum(weight) OVER w) <= everything AS full_ FROM r
  WINDOW w AS (ORDER BY room RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), t AS (
  SELECT source, source_size, CASE WHEN full_ THEN CAST(cut AS DOUBLE) ELSE weight * (
    CAST(everything - sum(CASE WHEN full_ THEN cut ELSE 0 END) OVER () AS DOUBLE) / nullif(sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER (), 0)) END AS target FROM f
), e AS (
  SELECT d.*, t.source_size, t.target, least(3, CAST(floor(t.target / greatest(t.source_size, 1)) AS BIGINT)) AS epochs,
    sum(size) OVER (PARTITION BY d.source ORDER BY mix_key, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - upto + size)) AS BIGINT) AS taken FROM e
"""

TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, 65), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

SHINGLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
  SELECT a AS id, b AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.other), d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(min(r.other), d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach r ON r.id = d.doc_id GROUP BY d.doc_id
"""

WARC_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body, sha1(encode(coalesce(html, ''))) AS hex FROM pages
), b AS (
  SELECT page_id, octet_length(body) AS payload_bytes, hex, min(page_id) OVER (PARTITION BY hex) AS first,
    list_transform(range(0, 8), lambda g: CAST(concat('0x', substr(hex, CAST(5 * g + 1 AS INT), 5)) AS BIGINT)) AS parts FROM p
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda c: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((parts[c // 4 + 1] // [32768, 1024, 32, 1][c % 4 + 1]) % 32 + 1 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

#: Variants of words by the texts with one letter less that they share; letters beyond ASCII become single bytes for the distance.
SPELLING_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(0, 8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(0, 256) r(i)
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), held AS (
  SELECT id, run, count(*) AS k, hex(encode(concat(id, ':', run))) AS x FROM runs WHERE length(run) >= 7 GROUP BY id, run
), h AS (
  SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, length(x) // 2), lambda i: CAST(concat('0x', substr(x, CAST(2 * i + 1 AS INT), 2)) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INT) + 1]))) AS h FROM held, crc
), words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n, translate(word, 'ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!"#$%&()*+,-./:;<=>?@[]^_{|}') AS plain
  FROM (SELECT k, CASE WHEN h % 31 = 0 THEN concat(substr(run, 1, CAST(h % length(run) AS INT)), substr(run, CAST(h % length(run) AS INT) + 2)) ELSE run END AS word FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), less AS (
  SELECT word, n, plain, plain AS part FROM words
  UNION SELECT word, n, plain, concat(substr(plain, 1, CAST(i AS INT)), substr(plain, CAST(i AS INT) + 2)) FROM (SELECT *, unnest(range(0, length(plain))) AS i FROM words)
), near AS (
  SELECT DISTINCT a.word, a.n, b.word AS form, b.n AS form_n FROM less a JOIN less b ON a.part = b.part AND a.word <> b.word WHERE levenshtein(a.plain, b.plain) = 1
), best AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY form_n DESC, form) AS r FROM near
), f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form, CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word AND r = 1
), walk AS (
  SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT walk.word, f.form, k + 1 FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, (SELECT arg_max(root, k) FROM walk WHERE walk.word = f.word) AS root, f.n, f.n_near, f.form_n FROM f
"""

ORACLES = {
    "op1_embedding_near_dedup": COSINE_SQL,
    "op3_minhash_near_dedup": SHINGLE_SQL,
    "op5_mixing": MIX_SQL,
    "op7_exact_top_k": TOP_SQL,
    "op10_warc": WARC_SQL,
    "op11_spelling_variants": SPELLING_SQL,
}

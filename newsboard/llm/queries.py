"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsboard.llm import (
    decontaminate, language, line_dedup, mixing, pii, resampling, search, sharding, simhash, spelling, tokens, units, warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = warc.read_warc(warc.write_warc(table(spark, sf_dir, "pages")))
    return chunks.filter("last").select(
        "page_id", "payload_bytes", F.col("payload_sha1").alias("payload_digest"), "record_type", "refers_to"
    )


OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN keeper END AS refers_to
FROM k
"""


def op2_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = units.repeated_units(table(spark, sf_dir, "documents"))
    return removed.select(
        F.col("id").alias("doc_id"), F.col("start").alias("start_at"), F.col("cut").alias("end_at"),
        "n_words", F.col("kept_id").alias("kept_doc_id"), F.col("kept_start").alias("kept_start_at"),
    ).distinct()


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = r"list_filter(regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP3_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS ws FROM documents),
i AS (SELECT item_id, {_WORDS.format('text')} AS ws FROM benchmark WHERE text IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[s:s + 9], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(2, len(ws) - 8))) AS s FROM i WHERE len(ws) > 0)
),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, s, array_to_string(ws[s:s + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, sizes WHERE len(ws) >= n)
),
hits AS (SELECT doc_id, n, s, item_id FROM dw JOIN iw USING (n, w)),
words AS (SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS spot FROM (SELECT DISTINCT doc_id, s, n FROM hits)) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP4_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0
),
o AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM o WHERE rank <= 10
"""


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base, terms = pii.span_list(F.col("base")), pii.span_list(F.col("terms"))
    return found.select(
        F.col("id").alias("doc_id"), *[count(k) for k in pii.PATTERNS], F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(terms, F.lit(""))).alias("spans"),
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify_languages(docs).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), F.col("lang_id.lang").alias("lang_pred"),
        F.col("lang_id.score").alias("score"), F.col("lang_id.ambiguous").alias("ambiguous"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id")
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    every = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows")))
    return mix.withColumn("row", every).select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "copies", "taken"
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_common_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tokens.read_ids(tokens.write_ids(table(spark, sf_dir, "documents")))
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


OP9_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT r, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line FROM docs
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10),
per_doc AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (c.k IS NOT NULL) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.k IS NULL), '') AS kept
  FROM keyed LEFT JOIN common c USING (k) GROUP BY r
)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM docs JOIN per_doc USING (r)
"""


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"))
    return spelling.variant_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


#: crc32 by bytes: a table by the rule of the reflected polynomial, and the
#: UTF-8 bytes of a text from its code points.
_CRC_TABLE = "SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY b) AS t FROM (SELECT unnest(range(256)) AS b)"
_BYTES = """flatten(list_transform(list_transform(string_split({0}, ''), lambda ch: unicode(ch)::BIGINT), lambda p:
  CASE WHEN p < 0 THEN [] WHEN p < 128 THEN [p] WHEN p < 2048 THEN [192 + (p >> 6), 128 + (p & 63)]
  WHEN p < 65536 THEN [224 + (p >> 12), 128 + ((p >> 6) & 63), 128 + (p & 63)]
  ELSE [240 + (p >> 18), 128 + ((p >> 12) & 63), 128 + ((p >> 6) & 63), 128 + (p & 63)] END))"""
_CRC = f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"

OP11_SQL = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents WHERE text IS NOT NULL)
  GROUP BY ALL
),
hashed AS (
  SELECT run, k, {_CRC.format("concat(doc_id, ':', run)")} AS h FROM runs, crc
),
voc AS MATERIALIZED (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT k, CASE WHEN h % 199 = 0 THEN concat(run[:h % length(run)], run[h % length(run) + 2:]) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
),
less AS MATERIALIZED (
  SELECT DISTINCT word, n, p, concat(word[:p - 1], word[p + 1:]) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS p FROM voc)
),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN voc b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN voc b ON a.rest = b.word
),
best AS (SELECT word, count(*) AS n_near, min((-near_n, near)) AS top FROM pairs GROUP BY word),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -top[1] >= 5 * n THEN top[2] END AS form, CASE WHEN -top[1] >= 5 * n THEN -top[1] END AS form_n
  FROM voc LEFT JOIN best USING (word)
),
chain AS (
  SELECT word, form AS at FROM forms WHERE form IS NOT NULL
  UNION SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL
),
ends AS (SELECT c.word, c.at FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NULL)
SELECT word, form, coalesce(ends.at, word) AS root, n, n_near, CAST(form_n AS BIGINT) AS form_n FROM forms LEFT JOIN ends USING (word)
"""


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sharding.interleave(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


OP12_SQL = f"""
WITH crc AS ({_CRC_TABLE}),
drawn AS (
  SELECT *, md5(concat('12:', coalesce('=' || doc_id, '-'), ':', coalesce('=' || md5(text), '-'))) AS draw,
    ('0x' || md5(concat('12:', coalesce('=' || source, '-')))[:8])::BIGINT / 4294967296 AS phase
  FROM documents
),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY draw) - 1 + phase) / count(*) OVER (PARTITION BY source) AS fraction
  FROM drawn
),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source NULLS LAST, draw) - 1 AS spot, count(*) OVER () AS total FROM ranked
),
dealt AS (SELECT *, ((spot + 1) * 16 - 1) // total AS k FROM placed)
SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size, {_CRC.format("coalesce(text, '')")} AS text_crc32,
  'rows' AS law, CAST(k AS INTEGER) AS shard, spot - (k * total) // 16 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM dealt, crc
"""


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = resampling.importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranks.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


OP13_SQL = f"""
WITH crc AS ({_CRC_TABLE}),
texts AS (
  SELECT row_number() OVER () AS r, 0 AS side, doc_id, coalesce({_WORDS.format('text')}, []) AS ws FROM documents
  UNION ALL SELECT row_number() OVER (), 1, NULL, coalesce({_WORDS.format('text')}, []) FROM benchmark
),
counted AS MATERIALIZED (
  SELECT side, r, feature, count(*) AS k FROM (
    SELECT side, r, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: concat(ws[i], ' ', ws[i + 1])))) AS feature FROM texts)
  GROUP BY ALL
),
hashed AS MATERIALIZED (
  SELECT feature, {_CRC.format("feature")} % 10000 AS bucket FROM (SELECT DISTINCT feature FROM counted), crc
),
buckets AS (
  SELECT b AS bucket, coalesce(sum(k) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(k) FILTER (side = 1), 0)::DOUBLE AS t
  FROM range(10000) AS g(b) LEFT JOIN (SELECT side, k, bucket FROM counted JOIN hashed USING (feature)) ON bucket = b GROUP BY b
),
gained AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM buckets) + 10000) / ((s + 1) * ((SELECT sum(t) FROM buckets) + 10000)))) AS BIGINT) AS gain
  FROM buckets
),
sums AS (
  SELECT r, CAST(sum(k) AS BIGINT) AS n, CAST(sum(k * gain) AS BIGINT) AS total
  FROM counted JOIN hashed USING (feature) JOIN gained USING (bucket) WHERE side = 0 GROUP BY r
),
scored AS (
  SELECT doc_id, r, len(ws) AS n_words, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE 0 END AS weight,
    ('0x' || sha256(concat('7:', doc_id))[:8])::BIGINT AS h
  FROM texts LEFT JOIN sums USING (r) WHERE side = 0
),
final AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS pool FROM final WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * pool // 100 THEN rank END AS rank FROM final LEFT JOIN ranked USING (r)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_unit_dedup": op2_unit_dedup,
        "op3_decontaminate": op3_decontaminate,
        "op4_top_k": op4_top_k,
        "op5_pii": op5_pii,
        "op6_language": op6_language,
        "op7_simhash": op7_simhash,
        "op8_pivotal_mix": op8_pivotal_mix,
        "op9_line_dedup": op9_line_dedup,
        "op10_token_ids": op10_token_ids,
        "op11_spelling": op11_spelling,
        "op12_shards": op12_shards,
        "op13_resample": op13_resample,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": OP1_SQL,
        "op3_decontaminate": OP3_SQL,
        "op4_top_k": OP4_SQL,
        "op9_line_dedup": OP9_SQL,
        "op11_spelling": OP11_SQL,
        "op12_shards": OP12_SQL,
        "op13_resample": OP13_SQL,
    }

"""One query per operator, over the whole of its table, with production parameters; SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotrend.llm import (
    block_search,
    bpe,
    exact_dedup,
    hard_negatives,
    jaccard_join,
    language,
    license_scan,
    line_dedup,
    line_rules,
    mixing,
    quality,
    resampling,
    tokens,
)
from cotrend.llm.common import crc_remainder
from cotrend.plans.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BPE_FILE = public_tokenizers.path("word_bpe_49k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


@query()
def op7_bpe(spark, sf_dir):
    encoded = bpe.encode(table(spark, sf_dir, "documents"), BPE_FILE)
    decoded = bpe.decode(encoded, BPE_FILE)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query()
def op9_token_counts(spark, sf_dir):
    return tokens.count_tokens(table(spark, sf_dir, "documents"), PIECE_FILE)


@query()
def op10_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = crc_remainder(F.col("doc_id"), 3) == 1
    model = language.fit(docs.select("doc_id", "text", "lang").where(~held_out))
    scored = language.predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def quality_model(spark, sf_dir, docs):
    """Learned from the labels of rows that are not held out."""
    learnable = crc_remainder(F.col("doc_id"), 5) != 0
    return quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").where(learnable))


@query()
def op2_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(spark, sf_dir, docs))
    return scored.select(
        "doc_id",
        (crc_remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query(
    """WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT rid, doc_id, unnest(generate_series(1, len(parts))) AS i, unnest(parts) AS line FROM docs),
keyed AS (
  SELECT rid, doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key
  HAVING count(DISTINCT doc_id) + count(DISTINCT rid) FILTER (WHERE doc_id IS NULL) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key GROUP BY rid, doc_id"""
)
def op5_line_dedup(spark, sf_dir):
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(
    r"""WITH normal AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\t-\r]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM normal WINDOW same AS (PARTITION BY text_sha256)"""
)
def op4_exact_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    incoming = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1  # half of the rows as a batch on top of the other half
    found = exact_dedup.find_copies(docs, incoming)
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query()
def op3_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, limit=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query()
def op6_license_scan(spark, sf_dir):
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min("base_places").cast("long").alias("first_word"),
        F.array_max("base_places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@query(
    """WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum([(q.v[i] - c.v[i]) * (q.v[i] - c.v[i]) FOR i IN range(1, len(q.v) + 1)])) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""
)
def op1_block_search(spark, sf_dir):
    return block_search.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


@query(
    r"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\t-\r]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM words),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shared AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS i FROM items p JOIN items q ON p.x = q.x AND p.doc_id < q.doc_id
  GROUP BY p.doc_id, q.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
  WHERE 100 * i >= 85 * (p.n + q.n - i)),
either AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(doc_id, root) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT b, root FROM reached JOIN either ON doc_id = a)
SELECT doc_id, n AS n_shingles, min(root) AS component_id FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id, n"""
)
def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"), words=4, percent=85)


def _line_rules_sql() -> str:
    holds = lambda phrases: f"regexp_matches(lower_line, '(^|{line_rules.NO_WORD})({phrases})({line_rules.NO_WORD}|\\z)')"
    count = lambda pattern: f"len(regexp_extract_all(line, '{pattern}'))"
    word = r"[^\x20\t-\r]+"
    return rf"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT rid, doc_id, text, regexp_extract_all(text, '{word}') AS w FROM docs),
windows AS (
  SELECT rid, unnest(range(1, len(w) - 1)) AS i, unnest([w[i:i + 2] FOR i IN range(1, len(w) - 1)]) AS three FROM words),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, three) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT rid, count(*) AS n_repeat_words FROM (
    SELECT rid, i FROM twice UNION SELECT rid, i + 1 FROM twice UNION SELECT rid, i + 2 FROM twice) GROUP BY rid),
lines AS (
  SELECT rid, line, translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_line,
         {count(word)} AS n FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs)),
judged AS (
  SELECT rid, line, n, {count(line_rules.SEPARATOR)} AS separators,
         100 * {count(line_rules.SYMBOLS)} > {line_rules.MOST_SYMBOLS} * n
         OR 100 * {count(line_rules.MARK_RUNS)} > {line_rules.MOST_MARKS} * n
         OR NOT regexp_matches(line, '{line_rules.LETTER}')
         OR (n >= {line_rules.LONG_LINE} AND NOT regexp_matches(line, '{line_rules.SENTENCE_MARK}')) AS punctuation,
         n <= {line_rules.SHORT_LINE} AND NOT regexp_matches(line, '[.!?][\x20\t-\r]*\z') AND {holds(line_rules.NAVIGATION)} AS site,
         n <= {line_rules.NOTICE_LINE} AND {holds(line_rules.BOILERPLATE)} AS notice
  FROM lines WHERE n > 0),
lost AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines,
         sum(length(regexp_replace(line, '[\x20\t-\r]+', '', 'g'))) FILTER (
           WHERE punctuation OR site OR notice OR (separators >= 2 AND 100 * separators > {line_rules.MOST_SEPARATORS} * n)) AS chars
  FROM judged GROUP BY rid),
counted AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
         len(regexp_extract_all(text, '{line_rules.SYMBOLS}')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(chars, 0) AS chars
  FROM words LEFT JOIN covered USING (rid) LEFT JOIN lost USING (rid)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * chars <= {line_rules.MOST_LOST} * word_chars AS kept FROM failed"""


@query(_line_rules_sql())
def op11_line_rules(spark, sf_dir):
    judged = line_rules.clean(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query(
    r"""WITH RECURSIVE crc_bits(byte, k, c) AS (
  SELECT b, 0, CAST(b AS BIGINT) FROM range(256) r(b)
  UNION ALL
  SELECT byte, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_bits WHERE k < 8),
crc_table AS (SELECT byte, c AS value FROM crc_bits WHERE k = 8),
texts AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT -row_number() OVER (), NULL, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
runs AS (SELECT rid, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS f FROM texts),
counted AS (SELECT rid, f, count(*) AS n FROM runs GROUP BY rid, f),
fed(f, h, place, c) AS (
  SELECT f, hex(encode(f)), 0, CAST(4294967295 AS BIGINT) FROM (SELECT DISTINCT f FROM counted)
  UNION ALL
  SELECT f, h, place + 1, xor(value, c >> 8) FROM fed JOIN crc_table ON byte = xor(c % 256,
    16 * (instr('0123456789ABCDEF', substr(h, 2 * place + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(h, 2 * place + 2, 1)) - 1)
  WHERE 2 * place < length(h)),
bucket_of AS (SELECT f, xor(c, 4294967295) % 10000 AS bucket FROM fed WHERE 2 * place = length(h)),
sums AS (
  SELECT bucket, sum(n) FILTER (WHERE rid > 0) AS s, sum(n) FILTER (WHERE rid < 0) AS t
  FROM counted JOIN bucket_of USING (f) GROUP BY bucket),
totals AS (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) AS all_s, CAST(coalesce(sum(t), 0) AS DOUBLE) AS all_t FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (all_s + 10000) / ((coalesce(s, 0)::DOUBLE + 1) * (all_t + 10000)))) AS gain
  FROM sums, totals),
weights AS (
  SELECT rid, sum(n) AS n_features, floor(sum(n * gain) / sum(n)) AS weight
  FROM counted JOIN bucket_of USING (f) JOIN gains USING (bucket) GROUP BY rid),
scored AS (
  SELECT rid, doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM texts LEFT JOIN weights USING (rid) WHERE rid > 0),
drawn AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS all_rows
  FROM drawn WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * all_rows // 100 THEN place END AS rank
FROM drawn LEFT JOIN ranked USING (rid)"""
)
def op12_resampling(spark, sf_dir):
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query(
    """WITH usable AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.rid, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum([a.v[i] * c.v[i] FOR i IN range(1, len(a.v) + 1)]) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT rid, anchor_id, vec_id AS positive_id, score AS positive_score, place FROM (
    SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS place FROM scored WHERE same) WHERE place <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.rid, place ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.rid = s.rid AND NOT same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3"""
)
def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label)

"""Queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from .chat import ANSWER_SCHEMA, calls_of_conversations, format_tool_calls
from .common import documents
from .decontamination import find_leaks
from .exact_dedup import exact_groups
from .filter_audit import audit_filters
from .hard_negatives import mine_hard_negatives
from .jaccard_join import jaccard_components
from .licenses import license_digest, scan_licenses
from .line_dedup import repeated_runs
from .packing import pack
from .quality import score, train
from .sharding import shard_documents
from .simhash import near_duplicates
from .substring_dedup import pieces, repeated_passages

SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = calls_of_conversations(_table(spark, sf_dir, "conversations"))
    return format_tool_calls(calls, results, {"answer": ANSWER_SCHEMA})


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard_documents(documents(spark, sf_dir), SHARDS)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, train(docs, _table(spark, sf_dir, "labels")))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(scan_licenses(documents(spark, sf_dir)))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir), cut=pieces).drop("text_key")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_runs(documents(spark, sf_dir)).select("doc_id", "start", "length")


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    moved = ((F.col("label").cast("decimal(20,0)") + 1) % 10).cast("bigint")
    label = F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label").cast("bigint"))
    return mine_hard_negatives(vectors.withColumn("label", label))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_packing": op4_packing,
    "op5_sharding": op5_sharding,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_license_scan": op8_license_scan,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_filter_audit": op12_filter_audit,
    "op13_hard_negatives": op13_hard_negatives,
}

#: DuckDB SQL for the queries it can express; tests/llm holds the others against brute force.
ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": r"""
        WITH t AS (
          SELECT doc_id, length(coalesce(text, '')) AS n,
                 regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
          FROM documents),
        g AS (
          SELECT plain, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id
          FROM t GROUP BY plain)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept,
               sha256(t.plain) AS text_sha256
        FROM t JOIN g USING (plain)
    """,
    "op2_chat_formatting": r"""
        WITH c AS (
          SELECT conv_id, turn, text, 'call-' || conv_id || '-' || turn AS call_id, turn // 2 AS half,
                 len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS words
          FROM conversations WHERE role = 'user'),
        p AS (
          SELECT *, CASE WHEN half > 0 THEN 'call-' || conv_id || '-' || (2 * (half & (half - 1)) + turn % 2) END AS parent
          FROM c),
        j AS (
          SELECT p.*, q.call_id IS NULL AND p.parent IS NOT NULL AS lost, r.text AS content, r.conv_id IS NOT NULL AS answered,
                 CASE WHEN p.half = 0 OR q.call_id IS NULL THEN 0 ELSE bit_count(p.half) END AS level
          FROM p LEFT JOIN c q ON q.conv_id = p.conv_id AND q.call_id = p.parent
          LEFT JOIN conversations r ON r.conv_id = p.conv_id AND r.turn = p.turn + 1 AND r.role = 'assistant'),
        e AS (
          SELECT *, list_filter([
              CASE WHEN length(text) < 1 THEN '$.prompt: shorter than 1' END,
              CASE WHEN length(text) > 2000 THEN '$.prompt: longer than 2000' END,
              CASE WHEN words < 1 THEN '$.words: below 1' END,
              CASE WHEN words > 60 THEN '$.words: above 60' END,
              CASE WHEN lost THEN 'depends on ' || parent || ', which is missing' END,
              CASE WHEN NOT answered THEN 'no result' END], lambda x: x IS NOT NULL) AS errors
          FROM j)
        SELECT conv_id,
               row_number() OVER (PARTITION BY conv_id ORDER BY level, (turn * 7919 + conv_id * 31) % 1009, call_id) - 1 AS step,
               CAST(level AS INTEGER) AS level, call_id, 'answer' AS name, CAST(answered AS BIGINT) AS n_results,
               len(errors) = 0 AS valid, errors,
               '{"arguments":{"prompt":' || to_json(text) || ',"turn":' || turn || ',"words":' || words || '},"depends_on":['
                 || coalesce('"' || parent || '"', '') || '],"id":"' || call_id || '","name":"answer","result":'
                 || coalesce(to_json(content), 'null') || ',"type":"tool_call"}' AS message
        FROM e
    """,
    "op10_line_dedup": r"""
        WITH raw AS (
          SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
          FROM documents),
        kept AS (
          SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
          FROM raw WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
        counted AS (
          SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_lines,
                 len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words FROM kept),
        runs AS (
          SELECT doc_id, pos, k, n_lines, line AS a,
                 CASE WHEN k > 1 THEN lead(line, 1) OVER w END AS b, CASE WHEN k > 2 THEN lead(line, 2) OVER w END AS c,
                 words + CASE WHEN k > 1 THEN lead(words, 1) OVER w ELSE 0 END AS words
          FROM counted, (SELECT unnest([1, 2, 3]) AS k)
          WINDOW w AS (PARTITION BY doc_id, k ORDER BY pos)),
        again AS (
          SELECT doc_id, pos, k, n_lines, words FROM runs WHERE pos + k <= n_lines
          QUALIFY row_number() OVER (PARTITION BY k, a, b, c ORDER BY doc_id, pos) > 1),
        ends AS (
          SELECT DISTINCT doc_id, pos AS start, pos + k AS stop FROM again WHERE k = 3 OR words >= 50 OR k = n_lines),
        marked AS (
          SELECT *, start > coalesce(max(stop) OVER (PARTITION BY doc_id ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS opens
          FROM ends),
        spans AS (
          SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY start, stop) AS span FROM marked)
        SELECT doc_id, min(start) AS start, max(stop) - min(start) AS length FROM spans GROUP BY doc_id, span
    """,
    "op11_jaccard_join": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
          FROM documents),
        s AS (
          SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(words) - 1, 2)), lambda i: words[i : i + 2])) AS grams
          FROM w WHERE len(words) > 0),
        g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
        links AS (
          SELECT a.doc_id AS u, b.doc_id AS v
          FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
          GROUP BY a.doc_id, b.doc_id, a.n, b.n
          HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
        reach AS (
          SELECT u AS doc_id, u AS other FROM both_ways
          UNION SELECT r.doc_id, e.v FROM reach r JOIN both_ways e ON r.other = e.u)
        SELECT w.doc_id, coalesce(len(s.grams), 0) AS n_shingles, coalesce(r.least, w.doc_id) AS component_id
        FROM w LEFT JOIN s USING (doc_id)
        LEFT JOIN (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id) r USING (doc_id)
    """,
    "op12_filter_audit": r"""
        WITH l AS (
          SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        t AS (
          SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                 list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
                 min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
          FROM documents),
        f AS (
          SELECT part, [len(words) < 100,
                        100 * len(list_distinct(words)) < 80 * len(words),
                        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
                        regexp_matches(text, '[#$%&*|]'),
                        coalesce(doc_id > first_id, false)] AS fails,
                 coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
          FROM t LEFT JOIN l USING (doc_id)),
        c AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
        i AS (SELECT unnest(range(1, 6)) AS i),
        o AS (
          SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a, i b, i c, i d, i e
          WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
        steps AS (
          SELECT array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order,
                 i AS step, o[i] AS letter, o[1 : i - 1] AS earlier FROM o, i),
        x AS (
          SELECT part, filter_order, step, letter, n, good, toxic, fails[letter] AS fail,
                 len(list_filter(earlier, lambda e: fails[e])) > 0 AS gone,
                 fails[letter] AND len(list_filter(fails, lambda y: y)) = 1 AS sole
          FROM c, steps),
        r AS (
          SELECT part, filter_order, step, letter,
                 sum(CASE WHEN NOT gone AND NOT fail THEN n ELSE 0 END)::BIGINT AS kept,
                 sum(CASE WHEN NOT gone AND fail THEN n ELSE 0 END)::BIGINT AS removed,
                 sum(CASE WHEN gone AND fail THEN n ELSE 0 END)::BIGINT AS redundant,
                 sum(CASE WHEN sole THEN n ELSE 0 END)::BIGINT AS unique_fails,
                 sum(CASE WHEN NOT gone AND fail AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
                 sum(CASE WHEN NOT gone AND fail AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
          FROM x GROUP BY part, filter_order, step, letter)
        SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
        FROM r
    """,
    "op13_hard_negatives": r"""
        WITH v AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
          FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                 list_dot_product(a.q, b.q)::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        p AS (
          SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, p.positive_id,
               (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id))::INT AS rank,
               s.other_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
          AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
        QUALIFY rank <= 3
    """,
}

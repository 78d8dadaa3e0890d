"""The registered queries of the training-data operators, one per operator, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, conversations, exact_dedup, hmm, language, lexical, media, mixing, ngram_join, packing, quality, toxicity, warc
from .common import scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media.media_columns(_table(spark, sf_dir, "documents"), keep_media=False)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "codec", "duration", "keyframes")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.withColumnRenamed("id", "doc_id")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.ngram_components(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_language(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_hmm(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(_table(spark, sf_dir, "conversations"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lexical.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.code_documents(_table(spark, sf_dir, "documents"), ranks, keep=False).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_exact_dedup, op2_mix_sources, op3_best_fit_packing, op4_media_columns, op5_toxicity, op6_ngram_join, op7_warc, op8_language_id, op9_hmm_score, op10_quality, op11_conversations, op12_ranked_search, op13_byte_bpe)
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, CAST(count(*) OVER w AS BIGINT) AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY body)""",
    "op2_mix_sources": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                   CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
              FROM d GROUP BY source),
        -- share by weight, fix the sources above three times their size, share the rest again
        share(round, source, source_size, weight, fixed, target) AS (
            SELECT 0, source, source_size, weight, false, CAST(sum(source_size) OVER () AS DOUBLE) / CAST(sum(weight) OVER () AS DOUBLE) * weight FROM s
            UNION ALL
            SELECT round + 1, source, source_size, weight, fixed OR above,
                   CASE WHEN fixed OR above THEN CAST(3 * source_size AS DOUBLE)
                        ELSE CAST(sum(source_size) OVER () - sum(CASE WHEN fixed OR above THEN 3 * source_size ELSE 0 END) OVER () AS DOUBLE)
                             / CAST(sum(CASE WHEN fixed OR above THEN 0 ELSE weight END) OVER () AS DOUBLE) * weight END
            FROM (SELECT *, target >= 3 * source_size AS above, bool_or(NOT fixed AND target >= 3 * source_size) OVER () AS go FROM share)
            WHERE go),
        t AS (SELECT source, source_size, target FROM share WHERE round = (SELECT max(round) FROM share)),
        q AS (SELECT d.*, t.source_size, t.target, sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        laps AS (SELECT q.*, lap, CAST(lap * source_size + upto AS DOUBLE) / target AS finish
                 FROM q, (VALUES (0), (1), (2)) l(lap) WHERE size > 0 AND target > 0 AND lap * source_size <= target),
        line AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, h, doc_id, size, lap ROWS UNBOUNDED PRECEDING) AS total FROM laps),
        got AS (SELECT doc_id, count(*) AS copies FROM line WHERE total <= (SELECT sum(size) FROM d) GROUP BY doc_id)
        SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(copies, 0) * q.size AS BIGINT) AS taken
        FROM q LEFT JOIN got ON q.doc_id = got.doc_id""",
    "op7_warc": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
        f AS (SELECT page_id, n, sha256(html) AS digest, min(page_id) OVER (PARTITION BY html) AS first FROM p)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f""",
    "op6_ngram_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        g AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_distinct([array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)]) END AS grams FROM w),
        e AS (SELECT doc_id, unnest(grams) AS gram, len(grams) AS n FROM g),
        rare AS (SELECT gram FROM e GROUP BY gram HAVING count(*) > 1),
        x AS (SELECT e.* FROM e JOIN rare USING (gram)),
        pairs AS (SELECT a.doc_id AS u, b.doc_id AS v FROM x a JOIN x b ON a.gram = b.gram AND a.doc_id < b.doc_id
                  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        ways AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
        reach(node, other) AS (SELECT u, v FROM ways UNION SELECT r.node, b.v FROM reach r JOIN ways b ON r.other = b.u)
        SELECT g.doc_id, CAST(len(g.grams) AS BIGINT) AS n_shingles, least(g.doc_id, coalesce(min(r.other), g.doc_id)) AS component_id
        FROM g LEFT JOIN reach r ON r.node = g.doc_id GROUP BY g.doc_id, g.grams""",
    "op11_conversations": r"""
        WITH RECURSIVE src AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
        -- crc32: a byte (marked by 256) is taken in, eight zeros shift it out
        crc AS (SELECT *, xor(list_reduce(
                    list_prepend(CAST(4294967295 AS BIGINT), flatten([[CAST(256 + ord(k[i]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0] FOR i IN range(1, len(k) + 1)])),
                    lambda c, e: CASE WHEN e >= 256 THEN xor(c, e - 256) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 20 AS kind FROM src),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM crc),
        n AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS t, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
        f AS (
            SELECT *, left(role, 1) AS initial,
                   CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY t) > 1 THEN 'duplicate'
                        WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                   left(lag(role) OVER (PARTITION BY conv_id ORDER BY t), 1) || left(role, 1) AS pair
            FROM n),
        figures AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(t) AS n FROM f GROUP BY conv_id),
        ins(here, after, inserts, spent, added) AS (VALUES
            ('0', '0', '', 0, []), ('0', 'u', 'I', 2, ['user:']), ('0', 'a', 'II', 4, ['user:', 'assistant:']), ('s', 's', '', 0, []), ('s', 'u', 'I', 2, ['user:']), ('s', 'a', 'II', 4, ['user:', 'assistant:']),
            ('u', 'u', '', 0, []), ('u', 'a', 'I', 2, ['assistant:']), ('u', 'u', 'II', 4, ['assistant:', 'user:']), ('a', 'a', '', 0, []), ('a', 'u', 'I', 2, ['user:']), ('a', 'a', 'II', 4, ['user:', 'assistant:'])),
        act(here, after, edit, initial, spent, role) AS (VALUES
            ('0', 's', 'K', 's', 0, NULL), ('0', 'u', 'K', 'u', 0, NULL), ('s', 'u', 'K', 'u', 0, NULL), ('u', 'a', 'K', 'a', 0, NULL), ('a', 'u', 'K', 'u', 0, NULL),
            ('0', 'u', 'R', NULL, 2, 'user'), ('s', 'u', 'R', NULL, 2, 'user'), ('u', 'a', 'R', NULL, 2, 'assistant'), ('a', 'u', 'R', NULL, 2, 'user'),
            ('0', '0', 'D', NULL, 3, NULL), ('s', 's', 'D', NULL, 3, NULL), ('u', 'u', 'D', NULL, 3, NULL), ('a', 'a', 'D', NULL, 3, NULL)),
        ways(conv_id, t, here, cost, audit, lines) AS (
            SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '0', 0, '', CAST([] AS VARCHAR[]) FROM conversations
            UNION ALL
            SELECT conv_id, t, here, cost, audit, lines FROM (
                SELECT w.conv_id, f.t, act.after AS here, w.cost + ins.spent + act.spent + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN 1 ELSE 0 END AS cost, w.audit || inserts || edit AS audit,
                       w.lines || added || CASE edit WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [act.role || ':' || f.text] END AS lines,
                       row_number() OVER (PARTITION BY w.conv_id, act.after ORDER BY w.cost + ins.spent + act.spent + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN 1 ELSE 0 END, w.audit || inserts || edit) AS nth
                FROM ways w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.t = w.t + 1 JOIN ins ON ins.here = w.here JOIN act ON act.here = ins.after
                WHERE edit = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (edit = 'R' OR act.initial = f.initial)))
            WHERE nth = 1),
        ends AS (
            SELECT w.conv_id, w.cost + ins.spent AS cost, w.audit || inserts AS audit, w.lines || added AS lines,
                   row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + ins.spent, w.audit || inserts) AS nth
            FROM ways w JOIN ins ON ins.here = w.here AND (ins.after = 'a' OR (ins.after = '0' AND inserts = '')) LEFT JOIN figures g ON g.conv_id IS NOT DISTINCT FROM w.conv_id
            WHERE w.t = coalesce(g.n, 0))
        SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               CAST(cost AS BIGINT) AS cost, audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
        FROM ends e LEFT JOIN figures g ON g.conv_id IS NOT DISTINCT FROM e.conv_id WHERE nth = 1""",
    "op12_ranked_search": r"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        b AS (
            SELECT item_id, row_number() OVER () AS i, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
        s AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
        p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
        q AS (SELECT i, term, count(*) AS times FROM (SELECT i, unnest(terms) AS term FROM b) GROUP BY i, term),
        w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM p, s GROUP BY term),
        m AS (SELECT r, doc_id, 75 + ((25 * len(terms) * n_docs) // n_terms) AS m FROM d, s WHERE len(terms) > 0),
        scored AS (
            SELECT i, r, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
            FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY i, r),
        ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
                   FROM scored JOIN m USING (r) JOIN b USING (i) WHERE score > 0)
        SELECT * FROM ranked WHERE rank <= 20""",
}

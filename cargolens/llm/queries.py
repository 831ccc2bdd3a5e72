"""The corpus operators as queries over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: F401

import corpus_pipeline
from cargolens.llm import (bfd_sharding, chat_format, fill_in_middle, grace_dedup, importance,
                           lexical_search, minhash, mixing, quality_rules, revisits, secret_scan, simhash,
                           sum_of_squares)
from cargolens.llm.common import table


def op1_importance_resampling(spark: SparkSession, path: str) -> DataFrame:
    return importance.resample(table(spark, path, "documents"), table(spark, path, "labels"))


def op2_best_fit_sharding(spark: SparkSession, path: str) -> DataFrame:
    sharded = bfd_sharding.shard_documents(table(spark, path, "documents"), shards=8)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


def op3_sum_of_squares_packing(spark: SparkSession, path: str) -> DataFrame:
    return sum_of_squares.packed_documents(table(spark, path, "documents"))


def op4_secret_scan(spark: SparkSession, path: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, path, "documents"))


# The conversation that the contract adds.
ADDED_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"),
                      (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op5_chat_round_trip(spark: SparkSession, path: str) -> DataFrame:
    turns = table(spark, path, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(ADDED_CONVERSATION, turns.schema)
    return chat_format.read_back(chat_format.format_conversations(turns.unionByName(added)))


def op6_source_mixing(spark: SparkSession, path: str) -> DataFrame:
    return mixing.taken_words(table(spark, path, "documents"))


def op7_adaptive_quality(spark: SparkSession, path: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, path, "documents"))


def op8_revisit_resolution(spark: SparkSession, path: str) -> DataFrame:
    found = revisits.resolve_revisits(revisits.records_of_pages(table(spark, path, "pages")))
    headers = F.array_join(F.transform("headers", lambda h: F.concat_ws(": ", h["name"], h["value"])), "\n")
    return found.select("record_id", "key", "refers_to", "outcome", headers.alias("headers"),
                        "payload_chars", "payload_sha256")


def op9_minhash_near_dedup(spark: SparkSession, path: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, path, "documents"), minhash.Plan(shingle=2))


def op10_exact_dedup(spark: SparkSession, path: str) -> DataFrame:
    return grace_dedup.duplicate_groups(table(spark, path, "documents"))


def op11_ranked_search(spark: SparkSession, path: str) -> DataFrame:
    return lexical_search.search(table(spark, path, "documents"), table(spark, path, "benchmark"))


def op12_simhash_near_dedup(spark: SparkSession, path: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, path, "documents")).select(
        "doc_id", simhash.hex_digits("fingerprint").alias("fingerprint"), "component_id")


def op13_fill_in_middle(spark: SparkSession, path: str) -> DataFrame:
    found = fill_in_middle.fill_in_middle(table(spark, path, "documents"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_importance_resampling": op1_importance_resampling,
    "op2_best_fit_sharding": op2_best_fit_sharding,
    "op3_sum_of_squares_packing": op3_sum_of_squares_packing,
    "op4_secret_scan": op4_secret_scan,
    "op5_chat_round_trip": op5_chat_round_trip,
    "op6_source_mixing": op6_source_mixing,
    "op7_adaptive_quality": op7_adaptive_quality,
    "op8_revisit_resolution": op8_revisit_resolution,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_simhash_near_dedup": op12_simhash_near_dedup,
    "op13_fill_in_middle": op13_fill_in_middle,
}

SQL = {
    "op5_chat_round_trip": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        shown AS (
            SELECT *, CASE WHEN regexp_matches(role || chr(10) || text,
                                               '</?s>|\[/?INST\]|\\e|\\l|\\b')
                THEN length(replace(replace(replace(replace(replace(role || text, '\', '\e'),
                         '<s>', '\ls>'), '</s>', '\l/s>'), '[INST]', '\bINST]'),
                         '[/INST]', '\b/INST]'))
                ELSE length(role || text) END + length('<s>[INST][/INST]</s>') AS chars
            FROM turns),
        joined AS (
            SELECT conv_id, count(*) AS n_turns, CAST(sum(chars) AS BIGINT) AS formatted_chars,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text)
                            FILTER (role = 'assistant'), '') AS loss
            FROM shown GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
               sha256(loss) AS loss_sha256, formatted_chars
        FROM joined""",
    "op7_adaptive_quality": r"""
        WITH texts AS (
            SELECT doc_id, lang, source, coalesce(text, '') AS text,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda w: w <> '') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda l:
                               regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
            FROM documents),
        windows AS (
            SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM texts WHERE len(w) >= 5),
        repeated AS (
            SELECT doc_id, i, count(*) OVER (
                       PARTITION BY doc_id, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS times
            FROM windows),
        covered AS (
            SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(5) t(k)
            WHERE times > 1 GROUP BY doc_id),
        counts AS (
            SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
                   CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                   CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   len(lines) AS n_lines, coalesce(covered.n, 0) AS n_repeat_words
            FROM texts LEFT JOIN covered USING (doc_id)),
        based AS (
            SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
        ratios AS (
            SELECT doc_id, lang, source, 0 AS ratio, 1000 * word_chars // n_words AS v FROM based
            WHERE NOT base_failed
            UNION ALL SELECT doc_id, lang, source, 1, 10000 * n_symbols // word_chars FROM based
            WHERE NOT base_failed
            UNION ALL SELECT doc_id, lang, source, 2, 10000 * n_dup_lines // n_lines FROM based
            WHERE NOT base_failed
            UNION ALL SELECT doc_id, lang, source, 3, 10000 * n_repeat_words // n_words FROM based
            WHERE NOT base_failed),
        bits AS (SELECT *, greatest(0, length(bin(v)) - 8) AS b FROM ratios),
        buckets AS (SELECT *, (v >> b) << b AS bucket FROM bits),
        levels AS (
            SELECT ratio, 'own' AS level, lang, source, bucket FROM buckets
            UNION ALL SELECT ratio, 'lang', lang, NULL, bucket FROM buckets
            UNION ALL SELECT ratio, 'all', NULL, NULL, bucket FROM buckets),
        ranked AS (
            SELECT ratio, level, lang, source, bucket,
                   row_number() OVER (PARTITION BY ratio, level, lang, source ORDER BY bucket) AS k,
                   count(*) OVER (PARTITION BY ratio, level, lang, source) AS n
            FROM levels),
        quartiles AS (
            SELECT ratio, level, lang, source, any_value(n) AS n,
                   min(bucket) FILTER (4 * k >= n) AS q1, min(bucket) FILTER (4 * k >= 3 * n) AS q3
            FROM ranked GROUP BY ALL),
        fences AS (
            SELECT ratio, level, lang, source, n,
                   q1 - 3 * greatest(q3 - q1, [100, 100, 1500, 500][ratio + 1]) AS low,
                   q3 + 3 * greatest(q3 - q1, [100, 100, 1500, 500][ratio + 1]) AS high
            FROM quartiles),
        verdicts AS (
            SELECT doc_id, bool_and(CASE
                       WHEN o.n >= 100 THEN v BETWEEN o.low AND o.high
                       WHEN l.n >= 100 THEN v BETWEEN l.low AND l.high
                       ELSE v BETWEEN a.low AND a.high END) AS inside
            FROM ratios r
            JOIN fences o ON o.level = 'own' AND o.ratio = r.ratio
                 AND o.lang IS NOT DISTINCT FROM r.lang AND o.source IS NOT DISTINCT FROM r.source
            JOIN fences l ON l.level = 'lang' AND l.ratio = r.ratio
                 AND l.lang IS NOT DISTINCT FROM r.lang
            JOIN fences a ON a.level = 'all' AND a.ratio = r.ratio
            GROUP BY doc_id)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND coalesce(inside, true) AS kept
        FROM based LEFT JOIN verdicts USING (doc_id)""",
    "op8_revisit_resolution": r"""
        WITH fetched AS (
            SELECT page_id, url, coalesce(html, '') AS html, 1704067200 + 60 * page_id AS t,
                   '"' || md5(coalesce(html, ''))[1:16] || '"' AS tag,
                   trim(regexp_replace(url, '#.*$', '', 's')) AS plain
            FROM pages),
        parts AS (
            SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(plain,
                       '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^.*@', ''), ':(80|443)?$', ''),
                       '^www\.', '') AS host,
                   regexp_replace(regexp_extract(plain, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1),
                                  '/+$', '') AS path,
                   array_to_string(list_sort(list_filter(string_split(
                       regexp_extract(plain, '\?(.*)$', 1, 's'), '&'), lambda f: f <> ''
                       AND NOT regexp_matches(f, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') AS query
            FROM fetched),
        pages_keyed AS (
            SELECT *, CASE WHEN host <> '' THEN host || path ||
                      CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS key
            FROM parts),
        visits AS (
            SELECT 2 * page_id + 1 AS record_id, key, t + 3600 * (1 + page_id % 7) + 1 AS later,
                   CASE WHEN page_id % 13 = 0 OR page_id % 11 = 0 THEN NULL
                        WHEN page_id % 5 = 0 THEN '"changed"'
                        WHEN page_id % 3 = 0 THEN 'W/' || tag ELSE tag END AS new_tag,
                   CASE WHEN page_id % 13 <> 0 AND page_id % 11 = 0 THEN t END AS new_modified,
                   CASE WHEN page_id % 13 = 0 OR page_id % 11 = 0 OR page_id % 5 = 0 THEN 'ETag'
                        WHEN page_id % 3 = 0 THEN 'etag' ELSE 'ETag' END AS tag_name
            FROM pages_keyed),
        matched AS (
            SELECT v.*, p.page_id, p.tag, p.t AS old_modified, p.html
            FROM visits v LEFT JOIN pages_keyed p ON p.key = v.key AND p.t < v.later
            QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY p.t DESC) = 1),
        judged AS (
            SELECT *, CASE WHEN page_id IS NULL THEN 'missing'
                           WHEN new_tag IS NULL AND new_modified IS NULL THEN 'unverified'
                           WHEN new_tag IS NOT NULL AND replace(new_tag, 'W/', '') = tag THEN 'resolved'
                           WHEN new_tag IS NULL AND new_modified = old_modified THEN 'resolved'
                           ELSE 'mismatch' END AS outcome
            FROM matched)
        SELECT record_id, key, 2 * page_id AS refers_to, outcome,
               concat_ws(chr(10),
                   CASE WHEN outcome = 'resolved' THEN concat_ws(chr(10), 'Content-Type: text/html',
                        CASE WHEN new_tag IS NULL THEN 'ETag: ' || tag END,
                        CASE WHEN new_modified IS NULL THEN 'Last-Modified: ' || old_modified END,
                        'Content-Length: ' || strlen(html)) END,
                   'Date: ' || later, 'cache-control: max-age=600',
                   CASE WHEN outcome <> 'resolved' THEN 'Content-Length: 0' END,
                   tag_name || ': ' || new_tag, 'last-modified: ' || new_modified) AS headers,
               CASE WHEN outcome = 'resolved' THEN length(html) END AS payload_chars,
               CASE WHEN outcome = 'resolved' THEN sha256(html) END AS payload_sha256
        FROM judged""",
    "op9_minhash_near_dedup": r"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, list_filter(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                       lambda w: w <> '') AS w
            FROM documents),
        shingles AS (
            SELECT doc_id, unnest(list_distinct(CASE
                       WHEN len(w) < 2 THEN w
                       ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                   END)) AS s
            FROM texts),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            GROUP BY ALL),
        links AS (
            SELECT x, y FROM shared
            JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
            WHERE 100 * shared.n >= 80 * (a.n + b.n - shared.n)),
        reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT reached.doc_id, y FROM reached JOIN links ON other = x),
        lowest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM lowest LEFT JOIN sizes USING (doc_id)""",
    "op10_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS content
            FROM documents),
        keepers AS (
            SELECT *, first_value(doc_id) OVER (
                       PARTITION BY content ORDER BY length(text) DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY content) AS group_size
            FROM texts)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept,
               sha256(content) AS text_sha256
        FROM keepers""",
    "op11_ranked_search": r"""
        WITH found AS (
            SELECT row_number() OVER () AS doc, doc_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents WHERE text IS NOT NULL),
        sizes AS (SELECT doc, doc_id, count(*) AS n FROM found GROUP BY ALL),
        total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
        held AS (SELECT doc, term, count(*) AS tf FROM found GROUP BY ALL),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM held, total GROUP BY term),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark WHERE text IS NOT NULL),
        scores AS (
            SELECT item_id, doc, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) //
                       (1000 * tf + 20 * (50 + (50 * n * docs) // words)))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (doc), total
            GROUP BY item_id, doc),
        ranked AS (
            SELECT *, CAST(row_number() OVER (
                       PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
            FROM scores WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50""",
    "op13_fill_in_middle": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
                   sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
            FROM documents),
        draws AS (
            SELECT *, CAST('0x' || hex[1:8] AS BIGINT) % (len(units) + 1) AS p,
                   CAST('0x' || hex[9:16] AS BIGINT) % (len(units) + 1) AS q,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                             OR contains(text, '<M>') THEN 'plain'
                        WHEN CAST('0x' || hex[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM texts),
        cuts AS (
            SELECT *, array_to_string(units[1:least(p, q)], '') AS prefix,
                   array_to_string(units[least(p, q) + 1:greatest(p, q)], '') AS middle,
                   array_to_string(units[greatest(p, q) + 1:], '') AS suffix
            FROM draws)
        SELECT doc_id, len(units) AS n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                                ELSE text END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM cuts""",
}

"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter.llm.common import read_table, work_path
from arbiter.llm.quality_rules import CAPITAL, CLOSED, COLUMN_LINES, COLUMN_WORDS, FURNITURE, FURNITURE_WORDS, MENU, MENU_CHARS, SEPARATOR

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return add


@query("op1_substring_dedup", r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS seq
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY seq) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + d AS pos FROM again, (SELECT unnest(range(0, 35)) AS d)),
marked AS (SELECT u.doc_id, u.word, u.pos, gone.pos IS NULL AS stays
           FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w) u
           LEFT JOIN gone ON gone.doc_id = u.doc_id AND gone.pos = u.pos)
SELECT w.doc_id, count(word) AS n_words, count(word) FILTER (WHERE NOT stays) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE stays), '')) AS kept_sha256
FROM w LEFT JOIN marked USING (doc_id) GROUP BY w.doc_id
""")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.substring_dedup import remove_repeated
    made = remove_repeated(read_table(spark, sf_dir, "documents"), window=35)
    return made.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query("op2_quality_rules", rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
              list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, ws[i:i + 2] AS seq FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, seq) AS c FROM win), (SELECT unnest(range(0, 3)) AS k)
        WHERE c > 1 GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
r AS (SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
             length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS visible,
             length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
             len(regexp_extract_all(line, '[!?]{{2,}}')) AS runs,
             len(list_filter(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda x: regexp_full_match(x, '{SEPARATOR}'))) AS seps,
             len(regexp_extract_all(line, '\p{{Lu}}')) AS capitals, len(regexp_extract_all(line, '\p{{Ll}}')) AS small,
             length(line) <= {MENU_CHARS} AND regexp_matches(line, '{MENU}') AS menu, regexp_matches(line, '{FURNITURE}') AS furniture,
             regexp_matches(line, '{CAPITAL}') AND NOT regexp_matches(line, '{CLOSED}') AS open FROM l),
s AS (SELECT *, count(*) FILTER (WHERE n BETWEEN 1 AND {COLUMN_WORDS} AND open)
                OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {COLUMN_LINES - 1} FOLLOWING) AS links FROM r),
c AS (SELECT *, max(links) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {COLUMN_LINES - 1} PRECEDING AND CURRENT ROW)
                = {COLUMN_LINES} AS col FROM s),
f AS (SELECT doc_id, coalesce(sum(n) FILTER (WHERE n > 0 AND (symbols * 10 > visible OR runs * 5 > n OR seps >= 3 OR menu OR col
                 OR (seps >= 1 AND n <= 5 * seps) OR (n >= 3 AND capitals > n AND capitals > small)
                 OR (n <= {FURNITURE_WORDS} AND furniture))), 0) AS lost,
             count(*) FILTER (WHERE n > 0) - count(DISTINCT line) FILTER (WHERE n > 0) AS dup FROM c GROUP BY doc_id),
b AS (SELECT d.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, dup AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words, CAST(lost AS BIGINT) AS n_lost_words
      FROM d JOIN f USING (doc_id) LEFT JOIN rep USING (doc_id)),
e AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT *, NOT base_failed AND n_lost_words <= n_words * 0.3 AS kept FROM e
""")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.quality_rules import judged
    return judged(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words")


@query("op3_sentence_pieces")
def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.sentence_pieces import decode, encode
    made = decode(encode(read_table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n_tokens", "ids", F.sha2(F.col("text"), 256).alias("decoded_sha256"))


@query("op4_exact_dedup", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.exact_dedup import DigestIndex
    index = DigestIndex(spark, work_path(spark, "digest-index"))
    decided = index.deduplicate(read_table(spark, sf_dir, "documents"), batches=4)
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op5_pii_crf")
def op5_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.pii_crf import KINDS, find_pii
    found = find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    packed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(packed("base"), 256).alias("base_sha256"), packed("spans").alias("spans"))


@query("op6_html_extract")
def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.html_extract import extract
    return extract(read_table(spark, sf_dir, "pages"))


@query("op7_simhash_dedup")
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.simhash_dedup import near_duplicates
    found = near_duplicates(read_table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op8_line_dedup", """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
own AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key),
j AS (SELECT k.*, owner IS NULL OR owner = doc_id AS stays FROM k LEFT JOIN own ON k.key = own.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), '')) AS kept_sha256
FROM j GROUP BY doc_id
""")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.line_dedup import deduplicate_lines
    made = deduplicate_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=10)
    return made.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query("op9_rule_classifier")
def op9_rule_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.rule_classifier import score_quality
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op10_mixing")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.mixing import plan_mix
    return plan_mix(read_table(spark, sf_dir, "documents"))


@query("op11_katz")
def op11_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.katz import katz
    return katz(read_table(spark, sf_dir, "documents"), held_share=10).scores


@query("op12_spelling")
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.spelling import variant_forms
    return variant_forms(read_table(spark, sf_dir, "documents"), min_chars=7, min_count=2, thin=31, times=10)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arbiter.llm.whitening import whiten
    made = whiten(read_table(spark, sf_dir, "embeddings"), components=4, scale=256)
    return made.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))

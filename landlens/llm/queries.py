"""Registered queries ``opN_<name>``: each operator with production parameters over its whole table.

``oracle_sql`` has DuckDB SQL where SQL can express the result; the other queries
are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html_text, lang_id, lexical, lm_score, mixing, near_dup, quality_rules, sentencepiece_bpe, substring_dedup, token_count, url_filter, whitening

#: Vocabulary files, by name in the installed package of public tokenizers.
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.group(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_BPE), digests=True)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_lang_id, op2_url_filter, op3_near_dup, op4_token_count, op5_lm_score, op6_html_text, op7_substring_dedup, op8_decontamination, op9_sentencepiece, op10_quality_rules,
                            op11_mixing, op12_lexical_search, op13_whitening)
}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE: dict[str, str] = {
    "op2_url_filter": rf"""
WITH u AS (SELECT page_id, strpos(url, '://') AS mark, url FROM pages),
r AS (SELECT page_id, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}) AS host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM r),
m AS (SELECT *, '.' || host AS dotted FROM h),
f AS (SELECT page_id, host, path,
        CASE WHEN dotted LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
             WHEN dotted LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
             WHEN dotted LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
             WHEN dotted LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
             WHEN dotted LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule FROM m)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN list_has_any(string_split(replace(host, '-', '.'), '.'), [{", ".join(f"'{w}'" for w in url_filter.LISTED)}]) THEN 'block' ELSE 'allow' END AS verdict
FROM f""",
    "op8_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), {decontaminate.LENGTH}) AS n, array_to_string(w[i:i + {decontaminate.LENGTH - 1}], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {decontaminate.LENGTH - 2}, 2))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
occ AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
          FROM (SELECT DISTINCT doc_id, item_id FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op10_quality_rules": rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
twice AS (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win SEMI JOIN twice USING (doc_id, k)) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM t LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)),
j AS (SELECT *, n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED_PERCENT} * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM j GROUP BY source),
g AS (SELECT avg(f / n) AS a, var_pop(f / n) - avg(f / n) * (1 - avg(f / n)) * avg(1.0 / n) AS beyond FROM h),
s AS (SELECT a, CASE WHEN beyond > 0 THEN least(greatest(a * (1 - a) / beyond - 1, {quality_rules.LEAST_STRENGTH}), {quality_rules.MOST_STRENGTH})
                     ELSE {quality_rules.MOST_STRENGTH} END AS strength FROM g),
v AS (SELECT source, (f + a * strength) / (n + strength) > {quality_rules.HOST_LIMIT} AS rejected FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM j JOIN v ON j.source IS NOT DISTINCT FROM v.source""",
    # the level of the capped sources: sources by the level at which each stops, the first prefix whose level fits
    "op11_mixing": r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS z, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
b AS (SELECT *, sum(3 * z) OVER o - 3 * z AS held, sum(w) OVER () - sum(w) OVER o + w AS share, sum(z) OVER () AS everything
      FROM s WINDOW o AS (ORDER BY z / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT CAST(everything - held AS HUGEINT) AS free, CAST(share AS HUGEINT) AS share FROM b
      WHERE w * (everything - held) < 3 * z * share ORDER BY z / w, source NULLS LAST LIMIT 1),
t AS (SELECT s.*, free IS NULL OR w * free >= 3 * z * share AS capped, free, share FROM s LEFT JOIN l ON true),
r AS (SELECT source, z, CASE WHEN capped THEN CAST(3 * z AS DOUBLE) ELSE CAST(w * free AS DOUBLE) / CAST(share AS DOUBLE) END AS target,
             CASE WHEN capped THEN 3::HUGEINT ELSE w * free END AS top, CASE WHEN capped THEN 1::HUGEINT ELSE z * share END AS bottom,
             CAST(CAST('0x' || substr(md5(concat_ws('|', '11', source)), 1, 8) AS BIGINT) AS HUGEINT) AS shift FROM t),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS LAST) AS HUGEINT) AS k FROM d)
SELECT doc_id, size, z AS source_size, target,
       CAST(size * ((k * top * 4294967296 + shift * bottom) // (bottom * 4294967296) - ((k - 1) * top * 4294967296 + shift * bottom) // (bottom * 4294967296)) AS BIGINT) AS taken
FROM n JOIN r ON n.source IS NOT DISTINCT FROM r.source""",
    "op12_lexical_search": rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
b AS (SELECT DISTINCT item, item_id, unnest(w) AS term FROM i),
s AS (SELECT count(*) FILTER (len(w) > 0) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
p AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) t SEMI JOIN b USING (term) GROUP BY row, term),
f AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, s GROUP BY term),
m AS (SELECT row, doc_id, 100 - 90 + (90 * len(w) * n) // l AS m FROM d, s WHERE len(w) > 0),
c AS (SELECT item, item_id, row, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM b JOIN p USING (term) JOIN f USING (term) JOIN m USING (row) GROUP BY item, item_id, row, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM c WHERE score > 0) WHERE rank <= 10""",
    "op7_substring_dedup": rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + {substring_dedup.LENGTH - 1}], ' ') AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {substring_dedup.LENGTH - 2})) AS i FROM t)),
rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + {substring_dedup.LENGTH})) AS p FROM win WHERE k IN (SELECT k FROM rep))),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM t),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)""",
}

"""Registered queries of this package, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from coverloom.llm import align, ann, decontaminate, grid_join, html_text, jaccard, licenses, line_dedup, lm_score, mixing, quality, resample, token_files
from coverloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.document_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_ann_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("doc_text")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op6_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_documents(token_files.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path()))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_spread_lines(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_groups(table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.summary(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_ann_multi_index": op2_ann_multi_index,
        "op3_html_extraction": op3_html_extraction,
        "op4_decontamination": op4_decontamination,
        "op5_license_scan": op5_license_scan,
        "op6_token_binary": op6_token_binary,
        "op7_lm_scoring": op7_lm_scoring,
        "op8_line_dedup": op8_line_dedup,
        "op9_mix_sources": op9_mix_sources,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_embedding_near_dedup": op11_embedding_near_dedup,
        "op12_importance_resampling": op12_importance_resampling,
        "op13_tokenizer_alignment": op13_tokenizer_alignment,
    }


_SPACE = r"[\x20\x09-\x0D]"

OP8_SQL = rf"""
WITH cut AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(source, chr(1)) AS site, string_split(text, chr(10)) AS lines FROM documents),
l AS (
  SELECT n, site, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM cut),
t AS (SELECT *, regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS bare FROM l),
spread AS (SELECT bare FROM t WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT site) >= {line_dedup.SITES}),
kept AS (
  SELECT n, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n_kept
  FROM t WHERE bare NOT IN (SELECT bare FROM spread) GROUP BY n)
SELECT doc_id, CASE WHEN lines IS NULL THEN NULL ELSE coalesce(text, '') END AS text,
       CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(lines), 0) - coalesce(n_kept, 0) AS BIGINT) AS n_removed
FROM cut LEFT JOIN kept USING (n)"""

OP9_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), '|', md5(coalesce(text, '')))) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM d GROUP BY source),
w AS (SELECT *, (place - 1) % 3 + 1 AS weight, CAST(3 * source_size AS DOUBLE) / ((place - 1) % 3 + 1) AS ratio FROM s),
v AS (
  SELECT *, CAST((SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE)
       / CAST((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM w WINDOW before AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), (SELECT max(level) FROM v) * weight) AS target FROM v),
b AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM g),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(budget // source_size, 3) ELSE 0 END AS epochs FROM b),
p AS (
  SELECT doc_id, size, source_size, target, epochs, budget - epochs * source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + least(size, greatest(0, rest - earlier)) AS BIGINT) AS taken
FROM p"""


def _canonical(line: str) -> str:
    words = f"replace(lower({line}), '-', '')"
    for pattern, one in licenses.SPELLINGS:
        words = f"regexp_replace({words}, '{pattern}', '{one.replace('$1', chr(92) + '1')}', 'g')"
    words = rf"trim(regexp_replace({words}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    return f"CASE WHEN regexp_matches(lower({line}), '{licenses._COPYRIGHT}') THEN '' ELSE {words} END"


def _units(rows: str) -> str:
    return f"""
  SELECT *, array_to_string(list_filter(lines, lambda l: l <> ''), ' ') AS whole
  FROM (SELECT *, list_transform(string_split(text, chr(10)), lambda l: {_canonical('l')}) AS lines FROM {rows})"""


OP5_SQL = f"""
WITH known(license, text) AS (VALUES {', '.join(f"('{n}', '{t.replace(chr(39), chr(39) * 2)}')" for n, t in licenses.KNOWN)}),
k AS (SELECT md5(whole) AS digest, min(license) AS license FROM ({_units('known')}) WHERE whole <> '' GROUP BY 1),
d AS (SELECT doc_id, lines, whole FROM ({_units("(SELECT doc_id, coalesce(text, '') AS text FROM documents)")})),
u AS (
  SELECT doc_id, 0 AS position, whole AS canonical FROM d
  UNION ALL SELECT doc_id, unnest(range(1, len(lines) + 1)), unnest(lines) FROM d)
SELECT doc_id, license, CAST(position AS BIGINT) AS position FROM u JOIN k ON md5(canonical) = digest WHERE canonical <> ''"""


def oracle_sql() -> dict[str, str]:
    return {"op5_license_scan": OP5_SQL, "op8_line_dedup": OP8_SQL, "op9_mix_sources": OP9_SQL}

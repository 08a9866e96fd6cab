"""The queries of the corpus operators, each with its SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsense.llm import (
    html_extraction,
    kd_shards,
    language_id,
    merkle,
    mixing,
    packing,
    periodic_runs,
    quality_rules,
    secret_scan,
    simhash,
    spotsigs,
    substring_dedup,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_digests(documents(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(documents(spark, sf_dir))


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_groups(documents(spark, sf_dir))


def op4_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shard(documents(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.clean_lines(documents(spark, sf_dir)).withColumn(
        "cleaned_sha256", F.sha2("cleaned", 256)
    ).drop("cleaned")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the documents, and a check of them after some have lost their capitals."""
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, lowered).otherwise(F.col("text"))
    return merkle.manifest(documents(spark, sf_dir), present={"text": tampered})


def repeated(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a period from some place on, in one of ten documents, as the id's checksum says."""
    if doc_id is None or not words:
        return words
    crc = zlib.crc32(str(doc_id).encode())
    g, n = crc // 10, len(words)
    if crc % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(documents(spark, sf_dir), edit=repeated)
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("longest", first).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.less")).alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(-1000 * F.col("longest.less") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_mixing": op2_mixing,
    "op3_spotsigs": op3_spotsigs,
    "op4_kd_sharding": op4_kd_sharding,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_id": op6_language_id,
    "op7_secret_scans": op7_secret_scans,
    "op8_token_counts": op8_token_counts,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_html_extraction": op13_html_extraction,
}
_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def _op1_sql(window: int = substring_dedup.WINDOW) -> str:
    """Brute force: every window of every document by the hash of its words."""
    return f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + {window} - 1 <= len(w) THEN md5(array_to_string(w[i:i + {window} - 1], ' ')) END AS k FROM p),
f AS (SELECT k, min(doc_id) AS first FROM k WHERE k IS NOT NULL GROUP BY 1),
c AS (SELECT k.doc_id, i, word, coalesce(bool_or(first < k.doc_id) OVER (PARTITION BY k.doc_id ORDER BY i ROWS BETWEEN {window} - 1 PRECEDING AND CURRENT ROW), false) AS gone
  FROM k LEFT JOIN f ON k.k = f.k),
r AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r USING (doc_id)"""


def _op5_sql() -> str:
    rules = quality_rules
    phrases = ", ".join(f"'{p}'" for p in rules.BOILERPLATE)
    separators = ", ".join(f"'{x}'" for x in sorted(rules.SEPARATORS))
    marks = f"[{rules.SYMBOLS}]"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT doc_id, i, CASE WHEN i + 4 <= len(w) THEN array_to_string(w[i:i + 4], ' ') END AS k FROM p),
t AS (SELECT doc_id, i, k IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, k) > 1 AS twice FROM k),
v AS (SELECT doc_id, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM t),
rp AS (SELECT doc_id, count(*) FILTER (covered) AS n_repeat_words FROM v GROUP BY 1),
l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
l1 AS (SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w FROM l0),
l2 AS (SELECT *, len(w) AS n, len(list_filter(w, lambda x: x IN ({separators}))) AS sep, len(regexp_extract_all(line, '{marks}')) + len(regexp_extract_all(line, '!')) AS marks FROM l1),
l3 AS (SELECT *, n > 0 AND ((n >= 4 AND sep > {rules.SEPARATORS_A_WORD}::DOUBLE * n) OR (marks > {rules.MARKS_A_WORD}::DOUBLE * n AND marks > 3)
  OR (n >= {rules.LONG_LINE} AND NOT regexp_matches(line, '{rules.SENTENCE_MARK.pattern}'))
  OR len(list_filter([{phrases}], lambda x: contains(lower(line), x))) > 0) AS failed FROM l2),
l4 AS (SELECT doc_id, count(*) FILTER (n > 0) AS n_lines, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines, count(*) FILTER (failed) AS n_failed_lines,
  coalesce(sum(list_sum(list_transform(w, lambda x: len(x)))) FILTER (n > 0 AND NOT failed), 0) AS kept_chars,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT failed), '') AS cleaned FROM l3 GROUP BY 1),
b AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: len(x))), 0) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '{marks}')) AS BIGINT) AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines, n_failed_lines, kept_chars, cleaned
  FROM d JOIN l4 USING (doc_id) LEFT JOIN rp USING (doc_id)),
s AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, CASE WHEN word_chars > 0 THEN kept_chars / CAST(word_chars AS DOUBLE) ELSE 0.0::DOUBLE END AS kept_share FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (kept_share >= {rules.LEAST_KEPT}::DOUBLE OR (n_failed_lines = 1 AND n_lines > 1)) AS kept, n_lines, n_failed_lines, kept_share, sha256(cleaned) AS cleaned_sha256 FROM s"""


def _forest_sql(name: str, leaves: str) -> str:
    """``name``_n: nodes by tree, level and place over the leaves (k, i, d); ``name``_p: each leaf's siblings by level."""
    return f"""{name}_n AS (SELECT k, 0 AS l, i, d, count(*) OVER (PARTITION BY k) AS c FROM {leaves}
  UNION ALL SELECT k, l, i, d, count(*) OVER (PARTITION BY k) FROM
    (SELECT k, l + 1 AS l, i // {merkle.FANOUT} AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM {name}_n WHERE c > 1 GROUP BY k, l, i // {merkle.FANOUT})),
{name}_a AS (SELECT k, i AS leaf, 0 AS l, i FROM {name}_n WHERE l = 0
  UNION ALL SELECT a.k, leaf, a.l + 1, a.i // {merkle.FANOUT} FROM {name}_a a JOIN (SELECT k, max(l) AS top FROM {name}_n GROUP BY k) t ON a.k = t.k AND a.l < top),
{name}_s AS (SELECT a.k, a.leaf, a.l, coalesce(string_agg(n.d, '' ORDER BY n.i) FILTER (n.i < a.i), '') AS b, coalesce(string_agg(n.d, '' ORDER BY n.i) FILTER (n.i > a.i), '') AS a
  FROM {name}_a a JOIN {name}_n n ON a.k = n.k AND a.l = n.l AND n.i // {merkle.FANOUT} = a.i // {merkle.FANOUT} WHERE n.c > 1 GROUP BY a.k, a.leaf, a.l),
{name}_p AS (SELECT k, leaf AS i, list({{'b': b, 'a': a}} ORDER BY l) AS path FROM {name}_s GROUP BY k, leaf)"""


def _op11_sql() -> str:
    def hashed(text: str) -> str:
        values = [text if c == "text" else f"CAST({c} AS VARCHAR)" for c in merkle.COLUMNS]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
  lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)))"""
    lowered = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"
    return f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce('v' || lang, 'n') AS k, {hashed('text')} AS d,
  {hashed(f"CASE WHEN {crc} % 3 = 0 THEN {lowered} ELSE text END")} AS shown FROM documents),
f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, d) - 1 AS i FROM d),
{_forest_sql('low', 'f')},
r AS (SELECT k, d FROM low_n WHERE c = 1),
g AS (SELECT '' AS k, row_number() OVER (ORDER BY k) - 1 AS i, k AS tree, d FROM r),
{_forest_sql('top', 'g')},
e AS (SELECT f.doc_id, f.d AS leaf, g.d AS subroot, (SELECT d FROM top_n WHERE c = 1) AS root, shown, list_concat(coalesce(low_p.path, []), coalesce(top_p.path, [])) AS path
  FROM f JOIN g ON g.tree = f.k LEFT JOIN low_p ON low_p.k = f.k AND low_p.i = f.i LEFT JOIN top_p ON top_p.i = g.i),
h AS (SELECT *, list_reduce(list_prepend({{'b': shown, 'a': ''}}, path), lambda x, y: {{'b': sha256(y.b || x.b || y.a), 'a': ''}}).b AS folded_root FROM e)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x.b || x.a), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM h"""


ORACLES: dict[str, str] = {
    "op1_substring_dedup": _op1_sql(),
    "op5_quality_rules": _op5_sql(),
    "op11_merkle_manifest": _op11_sql(),
}

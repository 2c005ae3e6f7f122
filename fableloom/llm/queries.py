"""The queries of the training-corpus operators over the whole driver tables, and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontamination import find_contamination
from .exact_dedup import find_copies
from .fill_middle import MIDDLE, PREFIX, REWRITTEN_PERCENT, SEED, SUFFIX, SUFFIX_FIRST_PERCENT, UNIT, fill_middle, restored
from .filter_audit import FILTERS, MARK, MAX_CAPITAL_PERCENT, MIN_DISTINCT_PERCENT, MIN_WORDS, ORDERS, WORD, audit_filters
from .html_extract import extract_pages
from .licences import LONGEST, TEMPLATES, THRESHOLD, scan_licences
from .near_dups import find_near_duplicates
from .packing import pack_documents
from .quality_crf import score_quality
from .quality_rules import judge_quality
from .token_scan import count_document_tokens
from .toxicity import score_toxicity
from .url_filter import DEFAULT_LISTED, DEFAULT_RULES, judge_urls


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP5_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
iw AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
iwin AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
  FROM iw, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM iwin),
dwin AS (
  SELECT rid, k, i, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM dw, ks, unnest(range(1, len(w) - k + 2)) AS u(i)),
hits AS (SELECT rid, item_id, i, k FROM dwin JOIN iwin USING (k, s)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + k)) AS v(p) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op7_licence_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


def _op7_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    templates = ", ".join(f"({i}, {quoted(n)}, {quoted(t)})" for i, (n, t) in enumerate((n, t) for n, texts in TEMPLATES.items() for t in texts))
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM documents),
tpl AS (
  SELECT tid, name, len(w) AS n, {grams} AS g, greatest(1, ceil(len(g) * {THRESHOLD}::DOUBLE / (2 - {THRESHOLD}::DOUBLE) - 1e-9)) AS least
  FROM (SELECT tid, name, regexp_extract_all(lower(t), '[a-z0-9]+') AS w FROM (VALUES {templates}) AS v(tid, name, t))),
tg AS (SELECT tid, unnest(g) AS x FROM tpl),
dg AS (SELECT rid, i - 1 AS i, w[i] || ' ' || w[i + 1] AS x FROM docs, unnest(range(1, len(w))) AS u(i)),
cand AS (SELECT rid, tid FROM (SELECT DISTINCT rid, x FROM dg) JOIN tg USING (x) JOIN tpl USING (tid) GROUP BY rid, tid, least HAVING count(*) >= least),
occ AS (SELECT rid, i, x, coalesce(lag(i) OVER (PARTITION BY rid, x ORDER BY i), -1) AS prev FROM dg WHERE rid IN (SELECT rid FROM cand)),
starts AS (SELECT rid, tid, i AS s FROM cand JOIN occ USING (rid) JOIN tg USING (tid, x)),
place AS (SELECT rid, tid, s, unnest(range(s, s + {LONGEST} * n)) AS i FROM starts JOIN tpl USING (tid)),
new AS (
  SELECT rid, tid, s, i, tg.x IS NOT NULL AS hit, count(*) OVER run AS size, count(tg.x) OVER run AS shared
  FROM place JOIN occ USING (rid, i) LEFT JOIN tg USING (tid, x) WHERE prev < s WINDOW run AS (PARTITION BY rid, tid, s ORDER BY i)),
ends AS (
  SELECT rid, name, s, i + 2 AS e, shared, 2.0::DOUBLE * shared / (size + len(g)) AS dice FROM new JOIN tpl USING (tid)
  WHERE hit AND 2.0::DOUBLE * shared / (size + len(g)) >= {THRESHOLD} QUALIFY row_number() OVER (PARTITION BY rid, tid, s ORDER BY dice DESC, i) = 1),
kept AS (
  SELECT rid, unnest(list_reduce(list([{{'name': name, 'dice': dice, 's': s, 'e': e}}] ORDER BY shared DESC, dice DESC, s, e, name),
    lambda kept, f: CASE WHEN len(list_filter(kept, lambda k: k.s < f[1].e AND f[1].s < k.e)) > 0 THEN kept ELSE list_concat(kept, f) END)) AS f
  FROM ends GROUP BY rid),
own AS (SELECT rid, count(*) AS n_places, first(f.name ORDER BY f.dice DESC, f.name) AS licence, max(f.dice) AS dice, string_agg(DISTINCT f.name, ',' ORDER BY f.name) AS licences FROM kept GROUP BY rid)
SELECT doc_id, coalesce(n_places, 0) AS n_places, licence, dice, coalesce(licences, '') AS licences
FROM docs LEFT JOIN own USING (rid)"""


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_document_tokens(table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def _op10_sql() -> str:
    rules = sorted(DEFAULT_RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for h, p, _ in rules]
    name = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (h, p, _) in zip(fits, rules, strict=True))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (_, _, v) in zip(fits, rules, strict=True))
    listed = " OR ".join(f"host = '{x}' OR ends_with(host, '.{x}')" for x in DEFAULT_LISTED)
    return f"""
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
SELECT page_id, host, path, CASE {name} END AS rule, CASE {verdict} WHEN {listed} THEN 'block' ELSE 'allow' END AS verdict FROM parts"""


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(table(spark, sf_dir, "documents"))


OP11_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op12_sql() -> str:
    steps = ", ".join(f"('{o}', {k + 1}, {1 << FILTERS.index(f)}, {sum(1 << FILTERS.index(x) for x in o[:k])})" for o in ORDERS for k, f in enumerate(o))
    return f"""
WITH marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS again FROM documents),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < {MIN_WORDS} THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_CAPITAL_PERCENT} * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '{MARK}') THEN 8 ELSE 0 END + CASE WHEN again THEN 16 ELSE 0 END AS mask
  FROM texts LEFT JOIN marks USING (doc_id)),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
steps(filter_order, step, b, pre) AS (VALUES {steps})
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(coalesce(sum(n) FILTER (mask & (pre | b) = 0), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (mask & b > 0 AND mask & pre = 0), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (mask & b > 0 AND mask & pre > 0), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (mask = b), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(good) FILTER (mask & b > 0 AND mask & pre = 0), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(toxic) FILTER (mask & b > 0 AND mask & pre = 0), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (mask & b > 0), 0) AS BIGINT) AS shapley
FROM cells CROSS JOIN steps GROUP BY part, filter_order, step"""


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


def _op13_sql() -> str:
    draw = lambda k: f"CAST('0x' || substr(digest, {8 * k - 7}, 8) AS BIGINT)"
    marked = " OR ".join(f"contains(t, '{m}')" for m in (PREFIX, SUFFIX, MIDDLE))
    return f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{UNIT}') AS u, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
formed AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, {draw(1)} % (len(u) + 1) AS a, {draw(2)} % (len(u) + 1) AS b,
    CASE WHEN t = '' OR {marked} OR {draw(3)} % 100 >= {REWRITTEN_PERCENT} THEN 'plain' WHEN {draw(4)} % 100 < {SUFFIX_FIRST_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM texts),
cut AS (
  SELECT doc_id, t, n, form, array_to_string(u[1 : least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1 : greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1 :], '') AS s FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut"""


QUERIES = {
    "op1_packing": op1_packing,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_quality_rules": op3_quality_rules,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_html_extraction": op6_html_extraction,
    "op7_licence_scans": op7_licence_scans,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_token_counts": op9_token_counts,
    "op10_url_filters": op10_url_filters,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_fill_middle": op13_fill_middle,
}
ORACLES = {
    "op5_decontamination": OP5_SQL,
    "op7_licence_scans": _op7_sql(),
    "op10_url_filters": _op10_sql(),
    "op11_exact_dedup": OP11_SQL,
    "op12_filter_audit": _op12_sql(),
    "op13_fill_middle": _op13_sql(),
}

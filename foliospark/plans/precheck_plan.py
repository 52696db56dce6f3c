"""Extractability of documents as chunks; section_refs come from lang and source, with keywords added by doc_id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.operators import precheck as P
from foliospark.sources.tables import read_table


def chunks(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id") % 8
    lead = (
        F.when(k == 1, "Glossary\nStar: a body that shines by itself\n").when(k == 2, "Exercise 1: step one\n1) first thing to do\n2) second thing\n")
        .when(k == 3, "References\nSmith, 1999. pp. 12, 14-16\n12 Note on this line here\n").when(k == 4, "§§ £ chart\n").when(k == 5, "Contents\nPreface\n").otherwise("")
    )
    refs = F.array(F.struct(F.when(k == 6, "unknown").otherwise(F.col("source")).alias("label"), F.when(k < 4, "section").otherwise("unknown").alias("type")), F.struct(F.lit("Contents, 12").alias("label"), F.lit("index").alias("type")))
    return read_table(spark, d, "documents").select("doc_id", F.concat(lead, F.col("text")).alias("text"), F.when(k == 7, F.slice(refs, 1, 1)).otherwise(refs).alias("section_refs"))


def precheck_signals(spark: SparkSession, d: str) -> DataFrame:
    s = P.chunk_signals(chunks(spark, d)).select("doc_id", "signals.*")
    return s.select("doc_id", *[F.col(c).cast("long").alias(c) if t == "int" else F.bround(F.col(c), 9).alias(c) if t == "double" else F.col(c) for c, t in s.dtypes if c != "doc_id"])


def precheck_decisions(spark: SparkSession, d: str) -> DataFrame:
    c = P.precheck(chunks(spark, d))
    return c.select("doc_id", "chunk_type", F.bround("type_score", 9).alias("type_score"), F.bround("conflict_score", 9).alias("conflict_score"), "mixed_reason", "decision", F.array_join("reason_codes", ",").alias("reasons"), "confidence_profile", F.array_join("dominant_signals", ",").alias("dominant_signals"))


W = r"[\p{L}\p{N}_]"
SIGNALS_SQL = r"""
WITH d AS (SELECT doc_id, doc_id % 8 AS k, CASE doc_id % 8 WHEN 1 THEN 'Glossary' || chr(10) || 'Star: a body that shines by itself' || chr(10) WHEN 2 THEN 'Exercise 1: step one' || chr(10) || '1) first thing to do' || chr(10) || '2) second thing' || chr(10)
  WHEN 3 THEN 'References' || chr(10) || 'Smith, 1999. pp. 12, 14-16' || chr(10) || '12 Note on this line here' || chr(10) WHEN 4 THEN '§§ £ chart' || chr(10) WHEN 5 THEN 'Contents' || chr(10) || 'Preface' || chr(10) ELSE '' END || text AS t,
  CASE WHEN doc_id % 8 = 6 THEN 'unknown' ELSE source END AS label, CASE WHEN doc_id % 8 < 4 THEN 'section' ELSE 'unknown' END AS kind FROM documents),
c AS (SELECT *, length(t) AS text_len, len(regexp_extract_all(t, '[A-Za-z]')) AS letters, len(regexp_extract_all(t, '\p{Nd}')) AS digits, len(regexp_extract_all(t, '\s')) AS spaces, len(regexp_extract_all(t, 'W+')) AS word_count,
  [trim(x, ' ') FOR x IN string_split(t, chr(10)) IF trim(x, ' ') <> ''] AS ls, CASE WHEN k = 7 THEN 1 ELSE 2 END AS n_refs, len(regexp_extract_all(t, '[\^£®§¤¢¥©°¬¶]+')) AS ocr,
  len(regexp_extract_all(t, '(?m)^\s*[0-9]{1,3}[\)\.]?\s+[^\n]{3,180}$')) AS notes, len(regexp_extract_all(t, '(?m)^\s*[A-Za-z][^:\n]{1,40}:\s+.{8,}$')) AS terms, len(regexp_extract_all(t, '(?m)^\s*(?:[-*•]|[0-9]+[\)\.])\s+.{3,}$')) AS items,
  len(regexp_extract_all(t, '(?:\b(?:p|pp|vol|ch|sec)\.?\s*[0-9]+|\b[0-9]{1,4}(?:[-–][0-9]{1,4})?\b|[A-Z][a-z]+,\s*[0-9]{4})')) AS cites,
  (CASE WHEN k = 6 THEN 1 ELSE 0 END) + (CASE WHEN k = 7 THEN 0 ELSE 1 END) AS noisy FROM d),
s AS (SELECT doc_id, t, label, kind, k, text_len, word_count, len(ls) AS line_count, len([x FOR x IN ls IF length(x) <= 40]) / greatest(1, len(ls)) AS line_short_ratio, digits / greatest(1, text_len) AS digit_ratio, greatest(0, text_len - letters - digits - spaces) / greatest(1, text_len) AS symbol_ratio,
  letters / greatest(1, text_len) AS letter_ratio, notes / greatest(1, len(ls)) AS footnote_density, cites / greatest(1, word_count) AS citation_locator_density, ocr / greatest(1, text_len) AS ocr_noise_ratio, CAST(1.0 AS DOUBLE) AS heading_body_ratio,
  noisy / n_refs AS section_ref_noise_ratio, (CASE WHEN kind = 'unknown' THEN 1 ELSE 0 END) / n_refs AS unknown_ref_ratio, terms / greatest(1, len(ls)) AS glossary_line_density, items / greatest(1, len(ls)) AS list_line_density, trim(t, ' ' || chr(10)) = '' AS is_blank FROM c)
""".replace("'W+'", f"'{W}+'")
RATIOS = ("line_short_ratio", "digit_ratio", "symbol_ratio", "letter_ratio", "footnote_density", "citation_locator_density", "ocr_noise_ratio", "heading_body_ratio", "section_ref_noise_ratio", "unknown_ref_ratio", "glossary_line_density", "list_line_density")
_has = lambda col, *words: f"regexp_matches({col}, '{'|'.join(words)}')"
_add = lambda when, x: f"CASE WHEN {when} THEN CAST({x} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
_cap = lambda most, name, by: f"least(CAST({most} AS DOUBLE), {name} * CAST({by} AS DOUBLE))"
_SAYS = {
    "text": lambda w, words: _add(_has("y", *words), w), "labels": lambda w, words: _add(_has("lb", *words), w), "find": lambda w, pattern: _add(f"regexp_matches(t, '{pattern}')", w), "find_low": lambda w, pattern: _add(f"regexp_matches(y, '{pattern}')", w),
    "share": _cap, "at_least": lambda w, name, limit: _add(f"{name} >= CAST({limit} AS DOUBLE)", w), "at_most": lambda w, name, limit: _add(f"{name} <= CAST({limit} AS DOUBLE)", w),
}
SCORES = {kind: [_SAYS[how](*rest) for how, *rest in P.EVIDENCE[kind]] for kind in P.KINDS}
DECISIONS_SQL = (
    SIGNALS_SQL
    + ", v AS (SELECT *, lower(t) AS y, lower(label || CASE WHEN k = 7 THEN '' ELSE ' contents, 12' END) AS lb FROM s), sc AS (SELECT *, ["
    + ", ".join(f"{{'neg': -least(CAST(1 AS DOUBLE), {' + '.join(parts)}), 'ord': {i}, 'kind': '{k}'}}" for i, (k, parts) in enumerate(SCORES.items()))
    + """] AS l FROM v),
r AS (SELECT *, list_sort(l)[1] AS f, list_sort(l)[2] AS g FROM sc),
a AS (SELECT *, -f.neg AS type_score, -g.neg AS b, -f.neg >= 0.5 AND -g.neg >= 0.5 AND abs(f.neg - g.neg) <= CAST(0.15 AS DOUBLE) AND (f.kind = 'doctrinal_text') <> (g.kind = 'doctrinal_text') AS mixed FROM r),
e AS (SELECT *, CASE WHEN mixed THEN 'mixed' ELSE f.kind END AS chunk_type, CASE WHEN mixed THEN b ELSE greatest(0.0, least(1.0, b / greatest(CAST(0.01 AS DOUBLE), type_score))) END AS conflict_score FROM a),
h AS (SELECT *, chunk_type NOT IN ('mixed', 'doctrinal_text') AS plain, is_blank OR word_count < 10 OR ocr_noise_ratio >= CAST(0.008 AS DOUBLE) OR (footnote_density >= CAST(0.3 AS DOUBLE) AND line_short_ratio >= 0.75) AS hard FROM e),
q AS (SELECT *, plain OR mixed OR conflict_score >= CAST(0.72 AS DOUBLE) OR section_ref_noise_ratio >= CAST(0.55 AS DOUBLE) AS weak FROM h)
SELECT doc_id, chunk_type, round(type_score, 9) AS type_score, round(conflict_score, 9) AS conflict_score, CASE WHEN mixed THEN f.kind || '+' || g.kind END AS mixed_reason,
  CASE WHEN hard THEN 'skip' WHEN weak THEN 'extract_degraded' ELSE 'extract' END AS decision,
  concat_ws(',', CASE WHEN is_blank THEN 'blank_text' END, CASE WHEN word_count < 18 THEN 'very_short' END, CASE WHEN ocr_noise_ratio >= CAST(0.006 AS DOUBLE) THEN 'high_ocr_noise' END, CASE WHEN footnote_density >= CAST(0.35 AS DOUBLE) THEN 'footnote_dense' END,
    CASE WHEN section_ref_noise_ratio >= 0.75 THEN 'section_refs_noisy' END, CASE WHEN symbol_ratio >= CAST(0.24 AS DOUBLE) THEN 'high_symbol_ratio' END, CASE WHEN plain THEN 'non_doctrinal_type:' || chunk_type END, CASE WHEN mixed THEN 'mixed_incompatible_types' END, CASE WHEN conflict_score >= 0.75 THEN 'high_type_conflict' END) AS reasons,
  CASE WHEN hard THEN 'contaminated' WHEN weak THEN 'low' WHEN type_score >= CAST(0.7 AS DOUBLE) AND section_ref_noise_ratio <= CAST(0.35 AS DOUBLE) THEN 'high' WHEN type_score >= CAST(0.55 AS DOUBLE) THEN 'medium' ELSE 'low' END AS confidence_profile,
  CASE WHEN mixed THEN f.kind || ',' || g.kind ELSE f.kind || ':' || printf('%.2f', type_score) || ',' || g.kind || ':' || printf('%.2f', b) END AS dominant_signals FROM q"""
)

SQL = {
    "precheck_signals": SIGNALS_SQL + "SELECT doc_id, text_len, word_count, CAST(line_count AS BIGINT) AS line_count, " + ", ".join(f"round({r}, 9) AS {r}" for r in RATIOS) + ", is_blank FROM s",
    "precheck_decisions": DECISIONS_SQL,
}
QUERIES = {f.__name__: f for f in (precheck_signals, precheck_decisions)}

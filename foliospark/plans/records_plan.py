"""Knowledge records over `part`: texts of every form from names, types and brands; replies as JSON, some broken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.operators import records as H
from foliospark.operators import responses as G
from foliospark.sources.tables import read_table, spread


def some(n: Column, items: Column) -> Column:
    """The first n of an array."""
    return F.slice(items, 1, n)


def records(spark: SparkSession, d: str) -> DataFrame:
    p = spread(read_table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size"))
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    line = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    k = F.col("p_partkey")
    return p.select(
        k.alias("chunk_id"),
        some(k % 4, F.array(name, line("modern ", name), line("  ", F.upper(name), " "))).alias("concepts"),
        some(k % 5, F.array(line(name, ": a ", kind), line(name, " applies when the ", kind, " of the maker is weak and old"), line("today ", name, " indicates strength in the house of plates and rods"), line(name, " means a thing of ", brand, " and many more words here"))).alias("definitions"),
        some(k % 7, F.array(line("If ", kind, ", then ", name, "."), line("si ", brand, ", the hen ", name), line("IF ", kind, " , THEN ", name), line(name, " is of license ", brand), line("contemporary use of ", name), line("modern house of ", name))).alias("technical_rules"),
        some(k % 2, F.array(line("all rights reserved by ", brand))).alias("procedures"), some(k % 11, F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: F.concat(name, F.lit(" "), (i / 2).cast("int").cast("string")))).alias("terminology"),
        F.array().cast("array<string>").alias("relationships"), F.array().cast("array<string>").alias("examples"), some(k % 3, F.array(line("some doubt of ", name), line("Some  Doubt of ", name))).alias("ambiguities"),
        *[F.array().cast(t).alias(c) for c, t in H.STRUCTS.items()], F.when(k % 6 == 0, "extract_degraded").when(k % 13 == 0, "skip").otherwise("extract").alias("precheck_decision"), F.when(k % 5 == 1, "glossary").otherwise("doctrinal_text").alias("chunk_type"),
    )


def joined(column: str) -> Column:
    return F.array_join(column, "|").alias(column)


def derived_rules(spark: SparkSession, d: str) -> DataFrame:
    r = H.derive_decision_rules(records(spark, d))
    return r.select("chunk_id", F.array_join(F.transform("decision_rules", lambda x: F.concat(x["condition"], F.lit("=>"), x["outcome"])), "|").alias("decision_rules"), joined("technical_rules"))


def filtered_records(spark: SparkSession, d: str) -> DataFrame:
    r = H.semantic_filter(records(spark, d))
    return r.select("chunk_id", *[joined(c) for c in ("concepts", "definitions", "technical_rules", "procedures", "ambiguities", "actions")])


def record_decisions(spark: SparkSession, d: str) -> DataFrame:
    r = H.decision_policy(records(spark, d))
    return r.select("chunk_id", "decision", "support_level", joined("decision_reasons"))


def audit_rows(spark: SparkSession, d: str) -> DataFrame:
    """Audit rows of the decided records; what isn't there has its default."""
    a = H.knowledge_audit(H.decision_policy(records(spark, d)))
    return a.select("chunk_id", "chunk_type", "precheck_decision", "decision", "support_level", joined("decision_reasons"), "confidence_profile", "weak_support", joined("clamp_actions"), *[F.col(f"n_{c}").cast("long").alias(f"n_{c}") for c in ("concepts", "definitions", "technical_rules", "terminology")])


def rendered_records(spark: SparkSession, d: str) -> DataFrame:
    return H.render_knowledge_text(records(spark, d)).select("chunk_id", "rendered")


#: A vocabulary with a phrase and a head of its own, given as data.
TOLD = H.VOCABULARY._replace(linear_phrases="as told of old", linear_heads=(*H.VOCABULARY.linear_heads, r"(?i)^as told of old:\s*"))


def normalized_records(spark: SparkSession, d: str) -> DataFrame:
    """The whole normalisation, of records with procedures in their rules."""
    k = F.col("chunk_id")
    calculated = F.format_string("To calculate %s: Identify the %s; 2. apply the  %s. Move on with it.", "p_name", "p_type", "p_brand")
    told = F.array_compact(F.array(F.when(k % 3 == 0, calculated), F.when(k % 5 == 2, F.format_string("As told of old: move the %s, and assign it, or wait", "p_name"))))
    p = read_table(spark, d, "part").select(F.col("p_partkey").alias("chunk_id"), "p_name", "p_type", "p_brand")
    given = records(spark, d).join(p, "chunk_id").withColumn("technical_rules", F.concat("technical_rules", told))
    r = H.normalize_records(given, words=TOLD)
    return r.select("chunk_id", joined("concepts"), joined("terminology"), joined("procedures"), joined("technical_rules"), F.array_join(F.transform("procedure_steps", lambda s: s["id"]), "|").alias("steps"))


def replies(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part")
    k = F.col("p_partkey")
    good = F.to_json(F.struct(
        F.when(k % 11 == 0, "9").otherwise("2.0.0").alias("schema_version"), k.cast("string").alias("chunk_id"), F.lit(" f ").alias("source_fingerprint"), F.array(F.concat(F.lit("  "), "p_name"), F.lit(" ")).alias("concepts"),
        F.array(F.struct(F.col("p_name").alias("term"), F.col("p_type").alias("definition"))).alias("definitions"), F.array(F.struct(F.col("p_size").alias("order"), F.col("p_type").alias("text"))).alias("procedure_steps"), F.when(k % 5 == 0, "x").alias("extra"),
    ))
    return p.select(k.alias("chunk_id_in"), F.when(k % 7 == 0, F.substring(good, 1, 20)).otherwise(good).alias("response"))


def parsed_knowledge(spark: SparkSession, d: str) -> DataFrame:
    """Replies parsed strictly: broken JSON, unknown keys and versions give an empty record."""
    r = G.parse_chunk_knowledge(replies(spark, d))
    return r.select("chunk_id_in", "ok", "chunk_id", "source_fingerprint", joined("concepts"), joined("definitions"), F.array_join(F.transform("procedure_steps", lambda s: F.concat(s["order"].cast("string"), F.lit(". "), s["text"])), "|").alias("steps"))


R = r"""WITH r AS (SELECT p_partkey AS chunk_id, p_partkey AS k, p_name, [p_name, 'modern ' || p_name, '  ' || upper(p_name) || ' '][1:p_partkey % 4] AS concepts,
  [p_name || ': a ' || p_type, p_name || ' applies when the ' || p_type || ' of the maker is weak and old', 'today ' || p_name || ' indicates strength in the house of plates and rods', p_name || ' means a thing of ' || p_brand || ' and many more words here'][1:p_partkey % 5] AS definitions,
  ['If ' || p_type || ', then ' || p_name || '.', 'si ' || p_brand || ', the hen ' || p_name, 'IF ' || p_type || ' , THEN ' || p_name, p_name || ' is of license ' || p_brand, 'contemporary use of ' || p_name, 'modern house of ' || p_name][1:p_partkey % 7] AS technical_rules,
  ['all rights reserved by ' || p_brand][1:p_partkey % 2] AS procedures, p_type, p_brand, least(p_partkey % 11, 10) AS n_terms, ['some doubt of ' || p_name, 'Some  Doubt of ' || p_name][1:p_partkey % 3] AS ambiguities,
  CASE WHEN p_partkey % 6 = 0 THEN 'extract_degraded' WHEN p_partkey % 13 = 0 THEN 'skip' ELSE 'extract' END AS precheck_decision, CASE WHEN p_partkey % 5 = 1 THEN 'glossary' ELSE 'doctrinal_text' END AS chunk_type FROM part)"""
DECIDED = R + r""", c AS (SELECT *, len(technical_rules) + len(procedures) AS ops, len([t FOR t IN definitions IF regexp_matches(t, '(?i)\b(applies|indicates)\b')]) AS od, len(concepts) + len(definitions) + len(technical_rules) + len(procedures) + n_terms + len(ambiguities) AS items FROM r),
s AS (SELECT *, CASE WHEN ops > 0 THEN 'strong' WHEN od >= 2 AND len(concepts) > 0 THEN 'minimal' ELSE 'none' END AS support, items = 0 OR (items <= 2 AND ops = 0 AND od = 0 AND len(concepts) <= 1 AND n_terms <= 1) AS small,
  n_terms >= 6 AND ops = 0 AND od = 0 AND n_terms / greatest(1, len(concepts) + len(definitions)) >= 2 AS dominant, len(concepts) > 0 AND ops = 0 AND od = 0 AS heavy, len(definitions) > 0 AND ops = 0 AND od = 0 AS gloss, od = 1 AND ops = 0 AS few, precheck_decision = 'skip' AS sk FROM c),
b AS (SELECT *, heavy OR gloss OR dominant OR few AS bad FROM s)
SELECT chunk_id, CASE WHEN sk THEN 'skip' WHEN small AND chunk_type = 'doctrinal_text' THEN 'extract_degraded' WHEN small THEN 'skip' WHEN support <> 'none' AND NOT bad THEN 'extract' ELSE 'extract_degraded' END AS decision, CASE WHEN sk OR small THEN 'none' ELSE support END AS support_level,
  concat_ws('|', CASE support WHEN 'strong' THEN 'strong_doctrinal_support' WHEN 'minimal' THEN 'minimal_doctrinal_support' END, CASE WHEN sk OR small THEN 'semantic_payload_empty_or_near_empty' END, CASE WHEN NOT sk AND NOT small AND heavy THEN 'concept_heavy_no_operations' END, CASE WHEN NOT sk AND NOT small AND gloss THEN 'glossary_like_semantics' END,
    CASE WHEN NOT sk AND NOT small AND dominant THEN 'terminology_dominant_no_operations' END, CASE WHEN NOT sk AND ((small AND chunk_type = 'doctrinal_text') OR (NOT small AND (few OR CASE WHEN precheck_decision = 'extract_degraded' THEN support = 'none' ELSE support = 'none' OR bad END))) THEN 'insufficient_operational_support' END) AS decision_reasons FROM b"""
SQL = {
    "normalized_records": R + r""", x AS (SELECT *, CASE WHEN k % 3 = 0 THEN ['To calculate ' || p_name || ': Identify the ' || p_type || '; 2. apply the ' || p_brand || '. Move on with it.'] ELSE [] END || CASE WHEN k % 5 = 2 THEN ['As told of old: move the ' || p_name || ', and assign it, or wait'] ELSE [] END AS told,
  CASE WHEN k % 3 = 0 THEN ['Identify the ' || p_type, 'apply the ' || p_brand, 'Move on with it'] ELSE [] END || CASE WHEN k % 5 = 2 THEN ['move the ' || p_name, 'assign it, or wait'] ELSE [] END AS steps FROM r)
SELECT chunk_id, CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN p_name ELSE p_name || '|modern ' || p_name END AS concepts, CASE WHEN n_terms = 0 THEN '' ELSE array_to_string([p_name || ' ' || i FOR i IN generate_series(0, n_terms // 2)], '|') END AS terminology,
  array_to_string([i || '. ' || steps[i] FOR i IN generate_series(1, len(steps))] || CASE WHEN k % 7 >= 1 THEN ['If ' || p_type || ', then ' || p_name || '.'] ELSE [] END || CASE WHEN k % 7 >= 2 THEN ['If ' || p_brand || ', then ' || trim(ltrim(ltrim('the hen ' || p_name, 'then '), 'entonces ')) || '.'] ELSE [] END, '|') AS procedures,
  array_to_string(technical_rules[4:6] || told, '|') AS technical_rules, array_to_string(['step-' || lpad(CAST(i AS VARCHAR), 3, '0') || '-' || trim(left(trim(regexp_replace(lower(steps[i]), '[^a-z0-9]+', '-', 'g'), '-'), 48), '') FOR i IN generate_series(1, len(steps))], '|') AS steps FROM x""",
    "derived_rules": R + """SELECT chunk_id, concat_ws('|', CASE WHEN k % 7 >= 1 THEN p_type || '=>' || p_name END, CASE WHEN k % 7 >= 2 THEN p_brand || '=>' || trim(ltrim(ltrim('the hen ' || p_name, 'then '), 'entonces ')) END, CASE WHEN k % 7 >= 3 AND false THEN '' END) AS decision_rules,
  concat_ws('|', CASE WHEN k % 7 >= 4 THEN technical_rules[4] END, CASE WHEN k % 7 >= 5 THEN technical_rules[5] END, CASE WHEN k % 7 >= 6 THEN technical_rules[6] END) AS technical_rules FROM r""",
    "filtered_records": R + r""", f AS (SELECT *, [t FOR t IN technical_rules IF NOT contains(t, 'license')] AS tr, [t FOR t IN definitions IF regexp_matches(t, '(?i)\b(applies|indicates)\b')] AS df FROM r),
m AS (SELECT *, [c FOR c IN concepts IF starts_with(c, 'modern')] || [t FOR t IN df IF starts_with(t, 'today')] || [t FOR t IN tr IF regexp_matches(t, '^(contemporary|modern)')] AS moved FROM f)
SELECT chunk_id, array_to_string([c FOR c IN concepts IF NOT starts_with(c, 'modern')], '|') AS concepts, array_to_string(df, '|') AS definitions, array_to_string([t FOR t IN tr IF NOT starts_with(t, 'contemporary')], '|') AS technical_rules, '' AS procedures,
  array_to_string(ambiguities[1:1] || moved, '|') AS ambiguities,
  concat_ws('|', CASE WHEN len(tr) < len(technical_rules) THEN 'clear_editorial_technical_rules' END, CASE WHEN len(procedures) > 0 THEN 'clear_editorial_procedures' END, CASE WHEN len(df) < len(definitions) THEN 'drop_generic_definitions' END, CASE WHEN k % 4 >= 2 THEN 'relocate_modern_concepts' END,
    CASE WHEN k % 5 >= 3 THEN 'mark_modern_embedded_preserved_core' END, CASE WHEN k % 7 >= 5 THEN 'relocate_modern_technical_rules' END, CASE WHEN k % 7 = 6 AND k % 5 < 3 THEN 'mark_modern_embedded_preserved_core' END, CASE WHEN len(moved) > 0 THEN 'relocate_modern_to_ambiguities' END) AS actions FROM m""",
    "record_decisions": DECIDED,
    "audit_rows": DECIDED.replace("SELECT chunk_id, CASE WHEN sk", "SELECT chunk_id, chunk_type, precheck_decision, 'medium' AS confidence_profile, false AS weak_support, '' AS clamp_actions, CAST(len(concepts) AS BIGINT) AS n_concepts, CAST(len(definitions) AS BIGINT) AS n_definitions, CAST(len(technical_rules) AS BIGINT) AS n_technical_rules, CAST(n_terms AS BIGINT) AS n_terminology, CASE WHEN sk", 1),
    "rendered_records": R + """SELECT chunk_id, concat_ws(chr(10) || chr(10), CASE WHEN len(concepts) > 0 THEN 'CONCEPTS' || chr(10) || '- ' || array_to_string(concepts, chr(10) || '- ') END, CASE WHEN len(definitions) > 0 THEN 'DEFINITIONS' || chr(10) || '- ' || array_to_string(definitions, chr(10) || '- ') END,
  CASE WHEN len(technical_rules) > 0 THEN 'TECHNICAL RULES' || chr(10) || '- ' || array_to_string(technical_rules, chr(10) || '- ') END, CASE WHEN len(procedures) > 0 THEN 'PROCEDURES' || chr(10) || '- ' || array_to_string(procedures, chr(10) || '- ') END,
  CASE WHEN n_terms > 0 THEN 'TERMINOLOGY' || chr(10) || '- ' || array_to_string([p_name || ' ' || CAST(i // 2 AS VARCHAR) FOR i IN generate_series(1, n_terms)], chr(10) || '- ') END, CASE WHEN len(ambiguities) > 0 THEN 'AMBIGUITIES' || chr(10) || '- ' || array_to_string(ambiguities, chr(10) || '- ') END) AS rendered FROM r""",
    "parsed_knowledge": "WITH p AS (SELECT *, p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 5 <> 0 AS ok FROM part) SELECT p_partkey AS chunk_id_in, ok, CASE WHEN ok THEN CAST(p_partkey AS VARCHAR) END AS chunk_id, CASE WHEN ok THEN 'f' END AS source_fingerprint, CASE WHEN ok THEN p_name ELSE '' END AS concepts, CASE WHEN ok THEN p_name || ': ' || p_type ELSE '' END AS definitions, CASE WHEN ok THEN CAST(p_size AS VARCHAR) || '. ' || p_type ELSE '' END AS steps FROM p",
}
QUERIES = {f.__name__: f for f in (derived_rules, filtered_records, record_decisions, audit_rows, rendered_records, normalized_records, parsed_knowledge)}

"""Sources, runs and arguments over `conversations`, `events`, `labels` and `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.operators import arguments as M
from foliospark.operators import runs as N
from foliospark.sources import tables as A
from foliospark.sources.tables import read_table


def audited_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Documents as chunk records, labels as audit rows: toxic ones are skipped, poor ones degraded."""
    docs = read_table(spark, d, "documents").select(F.concat_ws("_", F.lit("chunk"), F.col("doc_id") % 1000, "doc_id").alias("chunk_id"), F.col("doc_id").alias("ordinal"), "doc_id")
    k = F.col("doc_id")
    audit = read_table(spark, d, "labels").select(
        F.concat_ws("_", F.lit("chunk"), k % 1000, k).alias("chunk_id"), k.alias("ordinal"), F.when(F.col("toxic") == 1, " SKIP ").when(F.col("quality") == 0, "Extract_Degraded").otherwise("extract").alias("decision"),
        F.lit(" Glossary").alias("chunk_type"), F.when(k % 2 == 0, k + 7).alias("chunk_index"),
    )
    found = A.resolve_chunk_index(A.load_chunk_knowledge(docs, audit))
    return found.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "_decision", "_chunk_type").toDF("doc_id", "chunk_index", "decision", "chunk_type")


def summaries(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).alias("chunk_index"), "text")


def summary_blocks(spark: SparkSession, d: str) -> DataFrame:
    b = N.group_blocks(summaries(spark, d), 3)
    return b.select("doc_id", F.col("block_index").cast("long").alias("block_index"), "start_chunk", "end_chunk", F.array_join(F.transform("chunk_indices", lambda x: x.cast("string")), ",").alias("chunk_indices"), "text", "error")


def chunk_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """Summaries compiled into one text a conversation."""
    return A.compile_chunk_summaries(summaries(spark, d))


def block_artifacts(spark: SparkSession, d: str) -> DataFrame:
    return A.compile_block_summaries(N.group_blocks(summaries(spark, d), 3))


def parsed_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """The compiled texts read back into parts."""
    return A.parse_chunk_artifacts(chunk_artifacts(spark, d)).withColumn("chunk_id", F.col("chunk_id").cast("long"))


def parsed_block_artifacts(spark: SparkSession, d: str) -> DataFrame:
    rows = A.parse_block_artifacts(block_artifacts(spark, d))
    return rows.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("block_id", "start_chunk", "end_chunk")], "text")


def planned_calls(spark: SparkSession, d: str) -> DataFrame:
    return N.plan_calls(summaries(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks")), 3)


def resume_plan(spark: SparkSession, d: str) -> DataFrame:
    """Even turns are cached; of the others two a conversation are planned."""
    c = read_table(spark, d, "conversations")
    mark = F.expr(N.run_fingerprint({"chunk_size": 1800, "model": "it's"}))
    chunks = c.select(F.col("conv_id").alias("doc_id"), F.sha2(F.col("conv_id").cast("string"), 256).alias("text_hash"), F.lit("summary").alias("mode"), mark.alias("fingerprint"), F.col("turn").alias("chunk_index"))
    return N.pending_chunks(chunks, chunks.where("chunk_index % 2 = 0"), 2).select("doc_id", "chunk_index", "fingerprint", "status")


def events(spark: SparkSession, d: str) -> DataFrame:
    """Events as audit rows of a user's run: their types give decisions, their values the numbers of items."""
    kind, n = F.col("event_type"), F.col("event_id")
    e = read_table(spark, d, "events")
    decision = F.when(kind == "error", "skip").when(kind == "signup", "extract_degraded").otherwise("extract")
    refs = F.when(n % 5 > 0, F.array(F.struct(F.when(n % 7 == 0, "unknown").otherwise(kind).alias("type"), F.when(n % 2 == 0, "Of things").otherwise("Contents").alias("label")), F.struct(kind.alias("type"), F.when(n % 3 == 0, "X").otherwise("^o").alias("label"))))
    return e.select(
        F.col("user_id").alias("doc_id"), decision.alias("decision"), (kind != "click").alias("parse_ok"), F.floor("value").alias("concepts"), (n % 3).alias("definitions"), F.array(kind, F.lit("all")).alias("actions"),
        F.when(n % 2 == 0, "strong").when(n % 5 == 0, "minimal").otherwise("none").alias("support_level"), F.array(F.when(n % 2 == 0, "concept_heavy_no_operations").otherwise("glossary_like_semantics"), F.lit("semantic_payload_empty_or_near_empty")).alias("decision_reasons"),
        (F.floor("value") > 0).alias("has_concepts"), (n % 3 > 0).alias("has_core"), kind.alias("chunk_type"), F.lit(None).cast("string").alias("confidence_profile"), F.array(kind).alias("semantic_filter_actions"), F.lit(None).cast("array<string>").alias("clamp_actions"), refs.alias("section_refs"),
    )


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.bround(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def run_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(N.knowledge_metrics(events(spark, d), ["concepts", "definitions"]))


def decision_averages(spark: SparkSession, d: str) -> DataFrame:
    return rounded(N.decision_averages(events(spark, d), ["concepts", "definitions"]))


def section_ratios(spark: SparkSession, d: str) -> DataFrame:
    return rounded(N.section_ratios(events(spark, d)))


def run_distributions(spark: SparkSession, d: str) -> DataFrame:
    return N.distributions(events(spark, d))


def action_counts(spark: SparkSession, d: str) -> DataFrame:
    return N.action_counts(events(spark, d), "actions")


def section_type_counts(spark: SparkSession, d: str) -> DataFrame:
    """Types of sections, none of which every fifth event has."""
    return N.section_metrics(events(spark, d))


def argument_maps(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of a conversation as items, its roles as fields."""
    c = read_table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("role").alias("field"), F.col("turn").alias("chunk_index"), F.posexplode(F.split("text", r"\. ")).alias("pos", "value"))
    return M.argument_map(c).select("doc_id", "field", F.array_join("items", "|").alias("items"))


def argument_records(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("turn") % 4
    none = F.array().cast("array<string>")
    c = read_table(spark, d, "conversations")
    first = F.slice(F.split("text", r"\. "), 1, 2)
    given = {"theses": F.when(k != 1, first).otherwise(none), "claims": F.when(k == 3, F.slice(F.split("text", r"\. "), 2, 1)).otherwise(none)}
    return c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk_index"), F.when(k == 2, "parse_fallback").alias("error_kind"), *[given.get(f, none).alias(f) for f in M.FIELDS])


def argument_audit(spark: SparkSession, d: str) -> DataFrame:
    a = M.argument_audit(argument_records(spark, d))
    return a.select("doc_id", "chunk_index", "decision", F.col("item_count").cast("long").alias("item_count"), F.array_join("empty_fields", ",").alias("empty_fields"))


def argument_coverage(spark: SparkSession, d: str) -> DataFrame:
    return M.argument_coverage(M.argument_audit(argument_records(spark, d)))


def argument_texts(spark: SparkSession, d: str) -> DataFrame:
    return M.render_argument_text(argument_records(spark, d))


S = "WITH s AS (SELECT conv_id AS doc_id, turn + 1 AS chunk_index, text FROM conversations), b AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY chunk_index) - 1) // 3 + 1 AS block_index, chunk_index, text FROM s), g AS (SELECT doc_id, block_index, min(chunk_index) AS start_chunk, max(chunk_index) AS end_chunk, string_agg(CAST(chunk_index AS VARCHAR), ',' ORDER BY chunk_index) AS chunk_indices, string_agg(text, chr(10) || chr(10) ORDER BY chunk_index) AS text, bool_or(trim(text, ' ') = '') AS blank FROM b GROUP BY ALL)"
SEP = "chr(10) || chr(10) || '---' || chr(10) || chr(10)"
AUDIT = "WITH a AS (SELECT *, turn % 4 AS k, string_split(text, '. ') AS p FROM conversations), r AS (SELECT conv_id AS doc_id, turn AS chunk_index, k, CASE WHEN k <> 1 THEN p[1:2] ELSE [] END AS theses, CASE WHEN k = 3 THEN p[2:2] ELSE [] END AS claims FROM a), q AS (SELECT *, CASE WHEN k = 2 THEN 'parse_fallback' WHEN len(theses) + len(claims) > 0 THEN 'ok' ELSE 'empty_legitimate' END AS decision FROM r)"
E = """WITH e AS (SELECT user_id AS doc_id, event_id AS i, CASE event_type WHEN 'error' THEN 'skip' WHEN 'signup' THEN 'extract_degraded' ELSE 'extract' END AS d, event_type, floor(value) + event_id % 3 AS n, floor(value) AS c, event_id % 3 AS f,
  event_id % 5 > 0 AS refs, CASE WHEN event_id % 7 = 0 THEN 'unknown' ELSE event_type END AS t1, event_id % 5 > 0 AND event_id % 2 = 1 AS garbage FROM events)"""
SQL = {
    "decision_averages": E + "SELECT doc_id, d AS decision, count(*) AS chunks, round(avg(n), 6) AS avg_items, round(avg(c), 6) AS avg_concepts, round(avg(f), 6) AS avg_definitions FROM e GROUP BY ALL",
    "section_ratios": E + "SELECT doc_id, round(avg(CASE WHEN refs AND t1 = 'unknown' THEN 1.0 ELSE 0 END), 6) AS unknown_section_ratio, round(coalesce(avg(CASE WHEN refs AND t1 = 'unknown' THEN 1.0 ELSE 0 END) FILTER (d <> 'skip'), 0), 6) AS unknown_section_ratio_extracted, round(avg(CASE WHEN garbage THEN 1.0 ELSE 0 END), 6) AS garbage_label_ratio, round(coalesce(avg(CASE WHEN garbage THEN 1.0 ELSE 0 END) FILTER (d <> 'skip'), 0), 6) AS garbage_label_ratio_extracted FROM e GROUP BY 1",
    "run_distributions": E + "SELECT doc_id, kind, value, count(*) AS n FROM (SELECT doc_id, 'decision' AS kind, d AS value FROM e UNION ALL SELECT doc_id, 'chunk_type', event_type FROM e UNION ALL SELECT doc_id, 'semantic_filter_actions', event_type FROM e UNION ALL SELECT doc_id, 'decision_reasons', unnest([CASE WHEN i % 2 = 0 THEN 'concept_heavy_no_operations' ELSE 'glossary_like_semantics' END, 'semantic_payload_empty_or_near_empty']) FROM e) GROUP BY ALL",
    "audited_chunks": "WITH a AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'skip' WHEN quality = 0 THEN 'extract_degraded' ELSE 'extract' END AS decision FROM labels) SELECT d.doc_id, CASE WHEN a.doc_id IS NOT NULL AND d.doc_id % 2 = 0 THEN d.doc_id + 7 ELSE d.doc_id % 1000 + 1 END AS chunk_index, a.decision, CASE WHEN a.doc_id IS NOT NULL THEN 'glossary' END AS chunk_type FROM documents d LEFT JOIN a USING (doc_id) WHERE decision IS DISTINCT FROM 'skip'",
    "summary_blocks": S + "SELECT doc_id, block_index, start_chunk, end_chunk, chunk_indices, text, CASE WHEN blank THEN 'blank summary' END AS error FROM g",
    "chunk_artifacts": f"SELECT conv_id AS doc_id, string_agg('## Chunk ' || CAST(n AS VARCHAR) || chr(10) || text, {SEP} ORDER BY n) AS artifact FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) GROUP BY 1",
    "block_artifacts": S + f"SELECT doc_id, string_agg('## Block ' || CAST(block_index AS VARCHAR) || ' (Chunks ' || CAST(start_chunk AS VARCHAR) || '-' || CAST(end_chunk AS VARCHAR) || ')' || chr(10) || text, {SEP} ORDER BY block_index) AS artifact FROM g GROUP BY 1",
    "parsed_artifacts": r"SELECT conv_id AS doc_id, n AS chunk_id, regexp_replace(text || CASE WHEN n < m THEN chr(10) || chr(10) || '---' ELSE '' END, '^\s+|\s+$', '', 'g') AS text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, count(*) OVER (PARTITION BY conv_id) AS m FROM conversations)",
    "parsed_block_artifacts": S + r"SELECT doc_id, block_index AS block_id, start_chunk, end_chunk, regexp_replace(text || CASE WHEN block_index < max(block_index) OVER (PARTITION BY doc_id) THEN chr(10) || chr(10) || '---' ELSE '' END, '^\s+|\s+$', '', 'g') AS text FROM g",
    "planned_calls": "WITH c AS (SELECT conv_id AS doc_id, count(*) AS n_chunks FROM conversations GROUP BY 1), b AS (SELECT *, (n_chunks + 2) // 3 AS block_calls FROM c), t AS (SELECT *, CAST(CASE WHEN block_calls > 1 THEN 1 ELSE 0 END AS BIGINT) AS compendium_calls FROM b) SELECT *, n_chunks + block_calls + compendium_calls AS expected_calls, CASE WHEN n_chunks + block_calls + compendium_calls <= 3 THEN 'low' WHEN n_chunks + block_calls + compendium_calls <= 12 THEN 'medium' ELSE 'high' END AS cost_band FROM t",
    "resume_plan": "WITH t AS (SELECT conv_id AS doc_id, turn AS chunk_index, sha256('chunk_size=1800|model=it''s') AS fingerprint, turn % 2 = 0 AS have, row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS n FROM conversations) SELECT doc_id, chunk_index, fingerprint, CASE WHEN have THEN 'cached' ELSE 'planned' END AS status FROM t WHERE have OR n <= 2",
    "run_metrics": E + """SELECT doc_id, count(*) AS chunks, count(*) FILTER (d = 'extract') AS extract, count(*) FILTER (d = 'extract_degraded') AS extract_degraded, count(*) FILTER (d = 'skip') AS skip,
  count(*) FILTER (d = 'extract' AND i % 2 = 0) AS extract_strong, count(*) FILTER (d = 'extract' AND i % 2 = 1 AND i % 5 = 0) AS extract_minimal, count(*) FILTER (d = 'extract_degraded' AND i % 2 = 0) AS concept_heavy_degraded, count(*) FILTER (d = 'extract_degraded' AND i % 2 = 1) AS glossary_like_degraded,
  CAST(0 AS BIGINT) AS terminology_dominant_degraded, count(*) FILTER (d = 'skip') AS empty_or_near_empty_skip, round(avg(n), 6) AS avg_items, round(coalesce(avg(n) FILTER (d <> 'skip'), 0), 6) AS avg_items_extracted,
  round(avg(CASE WHEN n = 0 THEN 1.0 ELSE 0 END), 6) AS all_empty_ratio, round(coalesce(avg(CASE WHEN n = 0 THEN 1.0 ELSE 0 END) FILTER (d <> 'skip'), 0), 6) AS all_empty_ratio_extracted,
  round(avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0 END), 6) AS parse_failure_ratio, round(count(*) FILTER (event_type = 'click') / greatest(1, count(*) FILTER (d <> 'skip')), 6) AS parse_failure_ratio_extracted,
  round(avg(CASE WHEN c > 0 AND f = 0 THEN 1.0 ELSE 0 END), 6) AS concept_heavy_doctrine_light_ratio, round(coalesce(avg(CASE WHEN f > 0 THEN 1.0 ELSE 0 END) FILTER (d = 'extract_degraded'), 0), 6) AS degraded_with_core_ratio,
  round(avg(CASE WHEN c > 0 THEN 1.0 ELSE 0 END), 6) AS concepts_ratio, round(avg(CASE WHEN f > 0 THEN 1.0 ELSE 0 END), 6) AS definitions_ratio, round(coalesce(avg(CASE WHEN c > 0 THEN 1.0 ELSE 0 END) FILTER (d <> 'skip'), 0), 6) AS concepts_ratio_extracted,
  round(coalesce(avg(CASE WHEN f > 0 THEN 1.0 ELSE 0 END) FILTER (d <> 'skip'), 0), 6) AS definitions_ratio_extracted FROM e GROUP BY 1""",
    "action_counts": "SELECT user_id AS doc_id, v AS value, count(*) AS n FROM (SELECT user_id, unnest([event_type, 'all']) AS v FROM events) GROUP BY ALL",
    "section_type_counts": E + "SELECT doc_id, t AS section_type, count(*) AS chunks FROM (SELECT DISTINCT doc_id, i, unnest(CASE WHEN refs THEN [t1, event_type] ELSE ['none'] END) AS t FROM e) GROUP BY ALL",
    "argument_maps": r"WITH v AS (SELECT conv_id, role, turn, generate_subscripts(string_split(text, '. '), 1) AS pos, unnest(string_split(text, '. ')) AS x FROM conversations), n AS (SELECT *, trim(regexp_replace(x, '\s+', ' ', 'g')) AS value FROM v), f AS (SELECT conv_id, role, value, turn, pos, row_number() OVER (PARTITION BY conv_id, role, lower(value) ORDER BY turn, pos) AS k FROM n WHERE value <> '') SELECT conv_id AS doc_id, role AS field, string_agg(value, '|' ORDER BY turn, pos) AS items FROM f WHERE k = 1 GROUP BY ALL",
    "argument_audit": AUDIT + "SELECT doc_id, chunk_index, decision, len(theses) + len(claims) AS item_count, concat_ws(',', CASE WHEN len(theses) = 0 THEN 'theses' END, CASE WHEN len(claims) = 0 THEN 'claims' END, 'evidence,methods,authors_or_schools,key_terms,debates,limitations') AS empty_fields FROM q",
    "argument_coverage": AUDIT + "SELECT doc_id, count(*) AS chunks, count(*) FILTER (decision = 'ok') AS ok, count(*) FILTER (decision = 'parse_fallback') AS fallback, count(*) FILTER (decision = 'empty_legitimate') AS empty FROM q GROUP BY 1",
    "argument_texts": AUDIT + "SELECT doc_id, chunk_index, CASE WHEN len(theses) + len(claims) = 0 THEN 'NO CLEAR ARGUMENTATIVE STRUCTURE' ELSE concat_ws(chr(10) || chr(10), CASE WHEN len(theses) > 0 THEN 'THESES' || chr(10) || '- ' || array_to_string(theses, chr(10) || '- ') END, CASE WHEN len(claims) > 0 THEN 'CLAIMS' || chr(10) || '- ' || array_to_string(claims, chr(10) || '- ') END) END AS text FROM q",
}
QUERIES = {f.__name__: f for f in (
    audited_chunks, summary_blocks, chunk_artifacts, block_artifacts, parsed_artifacts, parsed_block_artifacts, planned_calls, resume_plan, run_metrics, decision_averages, section_ratios, run_distributions, action_counts, section_type_counts,
    argument_maps, argument_audit, argument_coverage, argument_texts,
)}

"""Runs over chunks: blocks of summaries, planned calls, fingerprints, resuming, and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.operators.chunking import is_garbage_label


def group_blocks(summaries: DataFrame, block_size: int = 8) -> DataFrame:
    """doc_id, block_index, start_chunk, end_chunk, chunk_indices, text, error: summaries in order, block_size to a block."""
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("chunk_index"))
    own = summaries.withColumn("block_index", (F.floor((number - 1) / block_size) + 1).cast("int")).groupBy("doc_id", "block_index")
    made = own.agg(F.sort_array(F.collect_list(F.struct("chunk_index", "text"))).alias("c"), F.max((F.trim(F.coalesce("text", F.lit(""))) == "").cast("int")).alias("_blank"))
    indices = F.transform("c", lambda c: c["chunk_index"])
    return made.select(
        "doc_id", "block_index", F.array_min(indices).alias("start_chunk"), F.array_max(indices).alias("end_chunk"), indices.alias("chunk_indices"),
        F.array_join(F.transform("c", lambda c: F.coalesce(c["text"], F.lit(""))), "\n\n").alias("text"), F.when(F.col("_blank") == 1, "blank summary").alias("error"),
    )


def plan_calls(counts: DataFrame, block_size: int = 8, synthesis: bool = True) -> DataFrame:
    """doc_id, n_chunks → chunk, block and compendium calls expected, and the cost band."""
    blocks = F.when(F.lit(synthesis), F.ceil(F.col("n_chunks") / block_size)).otherwise(0).cast("long")
    compendium = F.when(blocks > 1, 1).otherwise(0).cast("long")
    total = F.col("n_chunks") + blocks + compendium
    return counts.select("doc_id", "n_chunks", blocks.alias("block_calls"), compendium.alias("compendium_calls"), total.alias("expected_calls"), cost_band(total).alias("cost_band"))


def cost_band(calls: Column) -> Column:
    return F.when(calls <= 3, "low").when(calls <= 12, "medium").otherwise("high")


def run_fingerprint(parameters: dict[str, object]) -> str:
    """A Spark SQL expression's text for the hash of sorted parameters."""
    text = "|".join(f"{k}={parameters[k]}" for k in sorted(parameters)).replace("'", "''")
    return f"sha2('{text}', 256)"


def pending_chunks(chunks: DataFrame, cache: DataFrame, max_chunks: int | None = None) -> DataFrame:
    """chunks (doc_id, text_hash, mode, fingerprint, chunk_index, …) with status: cached, or planned for those not in cache, up to max_chunks a document."""
    key = ["text_hash", "mode", "fingerprint", "chunk_index"]
    marked = chunks.join(cache.select(*key).distinct().withColumn("_have", F.lit(1)), key, "left")
    cached = marked.where("_have = 1").drop("_have").withColumn("status", F.lit("cached"))
    todo = marked.where("_have IS NULL").drop("_have")
    if max_chunks is not None:
        todo = todo.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id").orderBy("chunk_index"))).where(F.col("_n") <= max_chunks).drop("_n")
    return cached.unionByName(todo.withColumn("status", F.lit("planned")))


def load_cache(lines: DataFrame, schema: str) -> DataFrame:
    """Cached records from lines of JSON (column value); lines that can't be read, or lack chunk_id, are left out."""
    read = lines.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"))
    return read.where("r IS NOT NULL AND r.chunk_id IS NOT NULL").select("r.*")


#: The decisions of a chunk, and reasons that are counted by decision.
DECISIONS = ("extract", "extract_degraded", "skip")
REASONS = (
    ("concept_heavy_degraded", "extract_degraded", "concept_heavy_no_operations"), ("glossary_like_degraded", "extract_degraded", "glossary_like_semantics"),
    ("terminology_dominant_degraded", "extract_degraded", "terminology_dominant_no_operations"), ("empty_or_near_empty_skip", "skip", "semantic_payload_empty_or_near_empty"),
)


def knowledge_metrics(audit: DataFrame, fields: list[str]) -> DataFrame:
    """One row a document from audit rows (doc_id, decision, parse_ok, support_level, decision_reasons, has_concepts, has_core, and the number of items of each field).

    Counts by decision, support and reason, averages of items, and the shares of chunks that are all empty,
    failed to parse, have some of a field, or concepts without doctrine, over all and over extracted chunks:
    one grouping with conditional sums. Failures count over all chunks in both shares.
    """
    items, decision = sum((F.col(f) for f in fields), F.lit(0)), F.col("decision")
    got = decision != "skip"
    count = lambda when: F.count(F.when(when, 1))
    share = lambda when, of=None: F.coalesce(F.avg(F.when(of, when.cast("double")) if of is not None else when.cast("double")), F.lit(0.0))
    light = F.col("has_concepts") & ~F.col("has_core")
    return audit.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("chunks"), *[count(decision == d).alias(d) for d in DECISIONS],
        *[count((decision == "extract") & (F.col("support_level") == s)).alias(f"extract_{s}") for s in ("strong", "minimal")],
        *[count((decision == d) & F.array_contains("decision_reasons", r)).alias(name) for name, d, r in REASONS],
        F.avg(items).alias("avg_items"), F.coalesce(F.avg(F.when(got, items)), F.lit(0.0)).alias("avg_items_extracted"),
        share(items == 0).alias("all_empty_ratio"), share(items == 0, got).alias("all_empty_ratio_extracted"),
        share(~F.col("parse_ok")).alias("parse_failure_ratio"), (count(~F.col("parse_ok")) / F.greatest(F.lit(1), count(got))).alias("parse_failure_ratio_extracted"),
        share(light).alias("concept_heavy_doctrine_light_ratio"), share(F.col("has_core"), decision == "extract_degraded").alias("degraded_with_core_ratio"),
        *[share(F.col(f) > 0).alias(f"{f}_ratio") for f in fields], *[share(F.col(f) > 0, got).alias(f"{f}_ratio_extracted") for f in fields],
    )


def decision_averages(audit: DataFrame, fields: list[str]) -> DataFrame:
    """doc_id, decision, chunks, avg_items and the average of each field, for each decision of a document."""
    items = sum((F.col(f) for f in fields), F.lit(0))
    return audit.groupBy("doc_id", "decision").agg(F.count(F.lit(1)).alias("chunks"), F.avg(items).alias("avg_items"), *[F.avg(f).alias(f"avg_{f}") for f in fields])


def section_metrics(records: DataFrame) -> DataFrame:
    """doc_id, section_type, chunks from records with section_refs: in how many chunks each type occurs; `none` is for those without any."""
    kinds = F.array_distinct(F.array_compact(F.transform("section_refs", lambda r: r["type"])))
    some = F.when(F.size(kinds) > 0, kinds).otherwise(F.array(F.lit("none")))
    return records.select("doc_id", F.explode(some).alias("section_type")).groupBy("doc_id", "section_type").agg(F.count(F.lit(1)).alias("chunks"))


def section_ratios(records: DataFrame) -> DataFrame:
    """doc_id and the shares of chunks with an unknown section, and with sections whose labels are all garbage, over all and over extracted chunks (decision isn't skip)."""
    refs = F.coalesce("section_refs", F.array().cast(dict(records.dtypes)["section_refs"]))
    unknown = F.exists(refs, lambda r: F.coalesce(r["type"] == "unknown", F.lit(False)))
    garbage = (F.size(refs) > 0) & F.forall(refs, lambda r: is_garbage_label(F.coalesce(r["label"], F.lit(""))))
    got = F.col("decision") != "skip"
    share = lambda when, of: F.coalesce(F.avg(F.when(of, when.cast("double"))), F.lit(0.0))
    every = F.lit(True)
    return records.groupBy("doc_id").agg(*[share(when, of).alias(name + end) for name, when in (("unknown_section_ratio", unknown), ("garbage_label_ratio", garbage)) for of, end in ((every, ""), (got, "_extracted"))])


def action_counts(audit: DataFrame, column: str) -> DataFrame:
    """doc_id, value, n: how often each value of an array column occurs."""
    return audit.select("doc_id", F.explode(column).alias("value")).groupBy("doc_id", "value").agg(F.count(F.lit(1)).alias("n"))


def distributions(audit: DataFrame, values: tuple[str, ...] = ("decision", "chunk_type", "confidence_profile"), arrays: tuple[str, ...] = ("decision_reasons", "semantic_filter_actions", "clamp_actions")) -> DataFrame:
    """doc_id, kind, value, n: how often each value of some columns, and of some arrays, occurs; in one pass."""
    parts = [F.array(F.col(c)) for c in values] + [F.coalesce(F.col(c), F.array().cast("array<string>")) for c in arrays]
    rows = F.array(*[F.struct(F.lit(name).alias("kind"), part.alias("vs")) for name, part in zip((*values, *arrays), parts)])
    long = audit.select("doc_id", F.inline(rows)).select("doc_id", "kind", F.explode("vs").alias("value")).where("value IS NOT NULL")
    return long.groupBy("doc_id", "kind", "value").agg(F.count(F.lit(1)).alias("n"))

"""The whole job on chunks and model replies: precheck, parsing, normalisation, filter, decision, clamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.operators import records as H
from foliospark.operators import responses as G
from foliospark.operators.precheck import precheck


def extract_knowledge(chunks: DataFrame, replies: DataFrame, authors: dict[str, str] | None = None) -> DataFrame:
    """One record a chunk with its decisions; chunks to skip, and those without a reply, have an empty one.

    chunks: chunk_id, text, section_refs; replies: chunk_id, response. One join, by chunk_id, on the replies.
    """
    checked = precheck(chunks).select("chunk_id", F.col("text").alias("chunk_text"), F.col("decision").alias("precheck_decision"), "chunk_type", "confidence_profile", F.col("reason_codes").alias("precheck_reasons"))
    parsed = G.parse_chunk_knowledge(replies.withColumnRenamed("chunk_id", "chunk_id_in")).drop("chunk_id", "source_fingerprint", "section_refs").withColumnRenamed("chunk_id_in", "chunk_id")
    both = checked.join(parsed, "chunk_id", "left").withColumn("parse_ok", F.coalesce("ok", F.lit(False))).drop("ok")
    told = F.col("precheck_decision") != "skip"
    given = both.withColumns({c: F.when(told, H.texts(c)).otherwise(F.array().cast("array<string>")) for c in H.TEXTS} | {c: F.when(told, H.structs(c)).otherwise(F.array().cast(t)) for c, t in H.STRUCTS.items()})
    ready = H.semantic_filter(H.normalize_records(given, authors)).withColumnRenamed("actions", "filter_actions")
    return H.post_extraction_clamp(H.decision_policy(ready))

"""Argument maps: decisions on chunks' argument records, and one deduplicated map a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.textnorm import squeeze

#: The fields of an argument record.
FIELDS = ("theses", "claims", "evidence", "methods", "authors_or_schools", "key_terms", "debates", "limitations")


def argument_audit(records: DataFrame) -> DataFrame:
    """doc_id, chunk_index, decision, item_count, empty_fields of records with error_kind (null if parsed) and the eight arrays."""
    sizes = {f: F.size(F.coalesce(F.col(f), F.array().cast("array<string>"))) for f in FIELDS}
    total = sum(sizes.values(), F.lit(0))
    decision = F.when(F.col("error_kind").isin("llm_empty", "invalid_payload", "parse_fallback"), F.col("error_kind")).when(total > 0, "ok").otherwise("empty_legitimate")
    empty = F.array_compact(F.array(*[F.when(n == 0, f) for f, n in sizes.items()]))
    return records.select("doc_id", "chunk_index", decision.alias("decision"), total.alias("item_count"), empty.alias("empty_fields"))


def argument_items(records: DataFrame) -> DataFrame:
    """doc_id, field, chunk_index, pos, value: the arrays of argument records in long form."""
    arrays = [F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f), F.array().cast("array<string>")).alias("items")) for f in FIELDS]
    long = records.select("doc_id", "chunk_index", F.inline(F.array(*arrays)))
    return long.select("doc_id", "chunk_index", "field", F.posexplode("items").alias("pos", "value"))


def argument_map(items: DataFrame) -> DataFrame:
    """doc_id, field, items: values squeezed, the same but for case once, in the order first seen.

    items: doc_id, field, chunk_index, pos, value. A first grouping keeps each value's first place, so only
    distinct values are gathered.
    """
    text = squeeze(F.col("value"))
    first = items.withColumn("value", text).where("value <> ''").groupBy("doc_id", "field", F.lower("value").alias("_key")).agg(F.min(F.struct("chunk_index", "pos", "value")).alias("v"))
    own = first.groupBy("doc_id", "field").agg(F.sort_array(F.collect_list("v")).alias("vs"))
    return own.select("doc_id", "field", F.transform("vs", lambda v: v["value"]).alias("items"))


def argument_coverage(audit: DataFrame) -> DataFrame:
    """doc_id and its numbers of chunks: all, ok, fallback, empty."""
    count = lambda *ds: F.count(F.when(F.col("decision").isin(*ds), 1))
    return audit.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"), count("ok").alias("ok"), count("parse_fallback", "invalid_payload", "llm_empty").alias("fallback"), count("empty_legitimate").alias("empty"))


#: Headers in the order they are rendered, and the line for a record without items.
HEADERS = {
    "theses": "THESES", "claims": "CLAIMS", "evidence": "EVIDENCE", "methods": "METHODS", "debates": "DEBATES",
    "limitations": "LIMITATIONS", "authors_or_schools": "AUTHORS OR SCHOOLS", "key_terms": "KEY TERMS",
}
EMPTY = "NO CLEAR ARGUMENTATIVE STRUCTURE"


def render_argument_text(records: DataFrame, headers: dict[str, str] = HEADERS, empty: str = EMPTY) -> DataFrame:
    """doc_id, chunk_index, text: a header and a list for each field that has items."""

    def part(field: str, header: str) -> Column:
        items = F.coalesce(F.col(field), F.array().cast("array<string>"))
        return F.when(F.size(items) > 0, F.concat(F.lit(header), F.array_join(F.transform(items, lambda x: F.concat(F.lit("\n- "), x)), "")))

    parts = F.array_compact(F.array(*[part(f, h) for f, h in headers.items()]))
    return records.select("doc_id", "chunk_index", F.when(F.size(parts) > 0, F.array_join(parts, "\n\n")).otherwise(empty).alias("text"))

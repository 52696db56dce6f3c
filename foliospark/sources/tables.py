"""Reads and writes the library's artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores if it comes in fewer than half as many parts, as one file with one row group does; large inputs aren't shuffled."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if 2 * df.rdd.getNumPartitions() <= want else df


#: Rows of a part of a table that is dealt out, about.
ROWS = 500_000


def parts_of(spark: SparkSession, rows: int) -> int | None:
    """The parts that so many rows are dealt out to, or null if there are no more of them than cores: then Spark tells their number."""
    parts = -(-rows // ROWS)
    return parts if parts > spark.sparkContext.defaultParallelism else None


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df by keys over parts_of(rows) parts. Spark doesn't put such parts together again, so that a task's rows, and its memory, don't grow with the table."""
    parts = parts_of(df.sparkSession, rows)
    return df.repartition(parts, *keys) if parts else df


def read_text_books(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (a hash of the path), source_path, text, error of each file: UTF-8 text, or an error for other suffixes."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("text"))
    suffix = F.lower(F.regexp_extract("source_path", r"(\.[^./]*)$", 1))
    good = suffix == ".txt"
    return files.select(F.xxhash64("source_path").alias("doc_id"), "source_path", F.when(good, F.col("text")).alias("text"), F.when(~good, F.concat(F.lit("unsupported suffix: "), suffix)).alias("error"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, page_index, raw_text from a page table (Parquet or JSON lines)."""
    kind = "json" if path.rstrip("/").endswith((".json", ".jsonl")) else "parquet"
    return spark.read.format(kind).load(path).select("doc_id", F.col("page_index").cast("int").alias("page_index"), F.coalesce("raw_text", F.lit("")).alias("raw_text"))


def write_artifact(df: DataFrame, path: str, fmt: str = "parquet", buckets: int | None = None) -> None:
    """Writes a table; with buckets, in folders by a hash of doc_id, so that one document is read from one of them."""
    if buckets:
        df = df.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
        df.repartition("bucket").write.mode("overwrite").partitionBy("bucket").format(fmt).save(path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def load_chunk_knowledge(knowledge: DataFrame, audit: DataFrame | None = None) -> DataFrame:
    """knowledge (chunk_id, ordinal, …) with _decision, _chunk_type, and without chunks to skip.

    audit: chunk_id, ordinal, decision, chunk_type, and chunk_index if it has one; a chunk's last row counts.
    """
    if audit is None:
        return knowledge.withColumns({"_decision": F.lit(None).cast("string"), "_chunk_type": F.lit(None).cast("string"), "_audit_index": F.lit(None).cast("int"), "_audited": F.lit(False)})
    low = lambda c: F.lower(F.trim(c))
    index = F.col("chunk_index").cast("int") if "chunk_index" in audit.columns else F.lit(None).cast("int")
    own = audit.where(F.trim("chunk_id") != "").groupBy(F.trim("chunk_id").alias("chunk_id"))
    last = own.agg(F.max_by(F.struct(low("decision").alias("d"), low("chunk_type").alias("t"), index.alias("i")), "ordinal").alias("_a"))
    both = knowledge.join(last, "chunk_id", "left")
    made = both.withColumns({"_decision": F.col("_a.d"), "_chunk_type": F.col("_a.t"), "_audit_index": F.col("_a.i"), "_audited": F.col("_a").isNotNull()}).drop("_a")
    return made.where(~F.col("_decision").eqNullSafe("skip"))


def resolve_chunk_index(loaded: DataFrame) -> DataFrame:
    """loaded with chunk_index: the audit row's where there is one, else the record's; else the number in the id plus 1; else the ordinal."""
    own = F.col("chunk_index").cast("int") if "chunk_index" in loaded.columns else F.lit(None).cast("int")
    first = F.when(F.col("_audited"), F.col("_audit_index")).otherwise(own)
    number = F.regexp_extract("chunk_id", r"^chunk_([0-9]+)_", 1)
    return loaded.withColumn("chunk_index", F.coalesce(first, F.when(number != "", number.cast("int") + 1), F.col("ordinal").cast("int")))


def read_family_catalog(spark: SparkSession, path: str) -> DataFrame:
    """load_family_catalog of JSON files that hold a list of families (id, label, aliases, controlled_patterns); items that aren't objects are left out."""
    kind = "id string, label string, aliases array<string>, controlled_patterns array<string>"
    return load_family_catalog(spark.read.schema(kind).option("multiLine", True).json(path))


def load_family_catalog(catalog: DataFrame) -> DataFrame:
    """family_id, label, aliases, controlled_patterns: trimmed, without blank ids, labels and entries."""
    full = lambda c: F.filter(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")
    rows = catalog.select(F.trim("id").alias("family_id"), F.trim("label").alias("label"), full("aliases").alias("aliases"), full("controlled_patterns").alias("controlled_patterns"))
    return rows.where("family_id <> '' AND label <> ''")


def compile_chunk_summaries(summaries: DataFrame) -> DataFrame:
    """doc_id, artifact: `## Chunk n` parts in order of chunk_index; n counts from 1."""
    own = summaries.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("chunk_index", "text"))).alias("c"))
    parts = F.transform("c", lambda c, i: F.concat(F.lit("## Chunk "), (i + 1).cast("string"), F.lit("\n"), c["text"]))
    return own.select("doc_id", F.array_join(parts, "\n\n---\n\n").alias("artifact"))


def compile_block_summaries(blocks: DataFrame) -> DataFrame:
    """doc_id, artifact: `## Block n (Chunks a-b)` parts in order of block_index."""
    own = blocks.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("block_index", "start_chunk", "end_chunk", "text"))).alias("b"))
    head = lambda b: F.concat(F.lit("## Block "), b["block_index"].cast("string"), F.lit(" (Chunks "), b["start_chunk"].cast("string"), F.lit("-"), b["end_chunk"].cast("string"), F.lit(")\n"))
    return own.select("doc_id", F.array_join(F.transform("b", lambda b: F.concat(head(b), b["text"])), "\n\n---\n\n").alias("artifact"))


def parse_chunk_artifacts(artifacts: DataFrame) -> DataFrame:
    """doc_id, chunk_id, text of each `## Chunk n` part; bodies keep the line between parts, as they were only trimmed."""
    parts = F.split(F.regexp_replace("artifact", r"(?m)^## Chunk ([0-9]+)\s*$", "\u0001$1\u0002"), "\u0001")
    rows = artifacts.select("doc_id", F.explode(F.slice(parts, 2, F.size(parts))).alias("p"))
    return rows.select("doc_id", F.substring_index("p", "\u0002", 1).cast("int").alias("chunk_id"), F.regexp_replace(F.substring_index("p", "\u0002", -1), r"^\s+|\s+$", "").alias("text"))


def parse_block_artifacts(artifacts: DataFrame) -> DataFrame:
    """doc_id, block_id, start_chunk, end_chunk, text of each `## Block n (Chunks a-b)` part."""
    parts = F.split(F.regexp_replace("artifact", r"(?m)^## Block ([0-9]+) \(Chunks ([0-9]+)-([0-9]+)\)\s*$", "\u0001$1,$2,$3\u0002"), "\u0001")
    rows = artifacts.select("doc_id", F.explode(F.slice(parts, 2, F.size(parts))).alias("p")).withColumn("h", F.split(F.substring_index("p", "\u0002", 1), ","))
    return rows.select("doc_id", *[F.get("h", F.lit(i)).cast("int").alias(c) for i, c in enumerate(("block_id", "start_chunk", "end_chunk"))], F.regexp_replace(F.substring_index("p", "\u0002", -1), r"^\s+|\s+$", "").alias("text"))


def to_sidecar(maps: DataFrame, pipeline_version: str = "1.0") -> DataFrame:
    """doc_id, sidecar: each document map (structure.document_maps) as JSON, with how it was made."""
    made = F.struct(F.lit(pipeline_version).alias("pipeline_version"), F.col("version").alias("structure_version"), "generator")
    return maps.select("doc_id", F.to_json(F.struct(made.alias("metadata"), F.struct(*[c for c in maps.columns if c != "doc_id"]).alias("document_map"))).alias("sidecar"))


def from_sidecar(sidecars: DataFrame, schema: str) -> DataFrame:
    """doc_id, metadata, and the map's columns of to_sidecar(); schema: those columns as DDL. JSON that can't be read gives nulls."""
    kinds = f"struct<metadata:struct<pipeline_version:string,structure_version:string,generator:string,postprocess:string>,document_map:struct<{schema}>>"
    return sidecars.select("doc_id", F.from_json("sidecar", kinds).alias("_j")).select("doc_id", "_j.metadata", "_j.document_map.*")


def clean_sidecar(sidecars: DataFrame, schema: str, postprocess: str = "document_map_cleaner_v1") -> DataFrame:
    """doc_id, sidecar: the same with the map's sections cleaned, and the cleaning named in the metadata."""
    from foliospark.operators.structure import clean_maps

    read = from_sidecar(sidecars, schema).where("metadata IS NOT NULL AND sections IS NOT NULL")
    cleaned = clean_maps(read.drop("metadata")).join(read.select("doc_id", "metadata"), "doc_id")
    noted = F.col("metadata").withField("postprocess", F.lit(postprocess))
    return cleaned.select("doc_id", F.to_json(F.struct(noted.alias("metadata"), F.struct(*[c for c in read.columns if c not in ("doc_id", "metadata")]).alias("document_map"))).alias("sidecar"))

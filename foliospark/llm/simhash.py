"""Near-duplicate documents: SimHash fingerprints, found by multi-index hashing.

Cases: null or empty text, or text without words, has fingerprint zero and is linked like any other;
shorter texts than one shingle give their whole word sequence; repeated rows and rows without an id keep
their own row (a null id is never a component's id while another is there); an empty table gives no rows.
Only doc_id and text are read, so other columns may have any name. Ids that aren't whole numbers are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, short_batches, table
from .components import connected_components

SEED = 42
#: Fingerprints that differ in so many bits, or fewer, are linked; the ways of linking below are for 2.
DISTANCE = 2
#: Segments of a fingerprint, and how many fingerprints of a segment's value are met in pairs.
SEGMENTS, CROWD = 2, 32


def shingle_hashes(text: str | None, width: int = 3) -> np.ndarray:
    """The hash of each run of `width` words, in their order; of the whole sequence if it is shorter."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, "<u8")
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], "<u8")
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-width].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())), "<u8", len(starts))


def majority(hashes: np.ndarray) -> int:
    """64 bits: each is set if over half of the hashes have it."""
    ones = np.zeros(64, "i8")
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, width: int = 3) -> int:
    """The SimHash of a text's shingles, repeats included."""
    return majority(shingle_hashes(text, width))


def fingerprints(docs: DataFrame, width: int = 3, copies: bool = False) -> DataFrame:
    """doc_id, fp (64 bits as a signed long) of each row, from whole texts; with copies, _copy too: a hash of the text."""
    more = ["_copy"] if copies else []

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, width) for t in b.column(1).to_pylist()], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], ["doc_id", "fp", *more])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.xxhash64("text").alias(c) for c in more])
    return short_batches(picked).mapInArrow(each, "doc_id long, fp long" + ", _copy long" * copies)


def segment_values(segments: int) -> list[tuple[int, Column]]:
    """(width, value) of each of the segments that the 64 bits of column fp are cut into."""
    ends = [64 * i // segments for i in range(segments + 1)]
    return [(b - a, F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1))) for a, b in zip(ends, ends[1:])]


def half_ball(value: Column, width: int, radius: int) -> Column:
    """The values within radius (0 or 1) of a segment's value, of two neighbours only that with the bit cleared: the pair meets at it."""
    if not radius:
        return F.array(value)
    turned = F.filter(F.transform(F.array(*[F.lit(1 << i) for i in range(width)]), lambda m: value.bitwiseAND(m)), lambda m: m != 0)
    return F.concat(F.array(value), F.transform(turned, lambda m: value - m))


def crowded_links(prints: DataFrame) -> DataFrame:
    """(a, b): links that connect all fingerprints in column fp which differ in 2 or fewer bits, for any number close together.

    Each fingerprint is entered under itself and its 64 neighbours of one bit. Two within 2 bits have a common
    entry; all members of an entry are within 1 of it, so within 2 of each other, and never over 65: each is
    linked to the smallest instead of all pairs, and no link between components is lost.
    """
    masks = [1 << bit if bit < 63 else -(1 << 63) for bit in range(64)]
    probes = prints.select("fp").distinct().select("fp", F.explode(F.array(F.lit(0), *map(F.lit, masks))).alias("turned"))
    entry = Window.partitionBy(F.col("fp").bitwiseXOR(F.col("turned")))
    return probes.select(F.col("fp").alias("a"), F.min("fp").over(entry).alias("b")).where("a <> b")


def near_links(prints: DataFrame, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """(a, b): links that connect all fingerprints in column fp which differ in DISTANCE or fewer bits.

    A table holds each fingerprint under (segment, value) for each of its segments. Of two fingerprints within
    DISTANCE bits, one segment differs in DISTANCE // segments bits or fewer, so one of them finds the other
    under a value of the ball of that radius around its own. What is found is verified by the complete distance.

    Where over `crowd` fingerprints share a segment's value (a large group of near copies), pairs aren't
    formed: all that are in such a bucket, or probe it, are linked by crowded_links().
    """
    if not 2 <= segments <= 64:
        raise ValueError("segments must be 2 to 64")
    one, radius = prints.select("fp").distinct(), DISTANCE // segments
    cuts = segment_values(segments)
    keyed = F.array(*[F.struct(F.lit(i).alias("segment"), v.alias("value")) for i, (_, v) in enumerate(cuts)])
    index = one.select(F.explode(keyed).alias("k"), F.col("fp").alias("other")).select("k.segment", "k.value", "other")
    full = cut(index.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).drop("n"))
    buckets = index.join(full, ["segment", "value"], "left_anti").unionByName(full.withColumn("other", F.lit(None).cast("long")))
    balls = F.array(*[F.struct(F.lit(i).alias("segment"), half_ball(v, width, radius).alias("ball")) for i, (width, v) in enumerate(cuts)])
    probes = one.select("fp", F.inline(balls)).select("fp", "segment", F.explode("ball").alias("value"))
    near = F.col("other").isNull() | ((F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= DISTANCE))
    # the exploded sides are many times the fingerprints that Spark takes them for: they are shuffled, none comes to the driver
    met = cut(probes.hint("merge").join(buckets.hint("merge"), ["segment", "value"]).where(near).select("fp", "other").distinct())
    crowded = met.where("other IS NULL").select("fp")
    return met.where("other IS NOT NULL").select(F.col("fp").alias("a"), F.col("other").alias("b")).unionByName(crowded_links(crowded)).distinct()


def components_of(prints: DataFrame) -> DataFrame:
    """fp, component (a fingerprint of its own), component_id (the smallest doc_id reachable) for each fingerprint."""
    each = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    groups = connected_components(near_links(each))
    named = each.join(groups, each.fp == groups.node, "left").select("fp", "least_id", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return cut(named.join(least, "component").select("fp", "component", "component_id"))


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable by links of 2 bits or fewer."""
    prints = cut(fingerprints(docs, width))
    return prints.join(components_of(prints), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def kept_rows(docs: DataFrame, first: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id and text hash are in first (kept, copy), one of each; and those without doc_id, as none of them can be named."""
    inner = [f"_c{i}" for i in range(len(docs.columns))]
    named = docs.toDF(*inner)
    place = {c: i for c, i in zip(docs.columns, inner)}
    one = named.withColumns({"_id": F.col(place["doc_id"]).cast("long"), "_hash": F.xxhash64(place["text"])})
    some = one.join(first, (F.col("_id") == F.col("kept")) & (F.col("_hash") == F.col("copy")), "left_semi").dropDuplicates(["_id", "_hash"])
    return some.unionByName(one.where("_id IS NULL")).select(*inner).toDF(*docs.columns)


def drop_near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """The rows of docs that stay: of each component the row with its smallest doc_id, once if it is repeated.

    Rows without doc_id stay, as none of them can be named.
    """
    prints = cut(fingerprints(docs, width, True))
    found = prints.where("doc_id IS NOT NULL").join(components_of(prints), "fp")
    first = found.groupBy("component").agg(F.min(F.struct("doc_id", "_copy")).alias("row"))
    return kept_rows(docs, first.select(F.col("row.doc_id").alias("kept"), F.col("row._copy").alias("copy")))

"""SimHash near-dedup by similarity: fingerprints of five-word shingles find candidates, the whole texts decide.

Two texts are near copies if the Jaccard similarity of their sets of five-word shingles is `least` or more.
Candidates come from the multi-index of the SimHashes (simhash.near_links) first. At 0.8 the SimHashes of two
texts differ in about ten of 64 bits, though, often in more, and balls that reach so far would meet most of
the corpus. So that no such pair is lost, bands of minima of the shingle sets find further candidates: one
band of `rows` minima is equal with a chance of 0.8 ** rows, and with 32 bands of 4 a pair at 0.8 is missed
once in about 20 million.

Texts with the same set are one node from the start. In a band's bucket each node is first compared with
the smallest; the nodes of a bucket which aren't in one component yet are compared with each other, in large
buckets in blocks, which give only the links that join components. So no link that a bucket shows is lost, and a large
group of near copies is never spelled out in pairs.

Cases: null or empty text, or text without words, has the empty set, and is a copy of any other such text;
shorter texts than one shingle have their whole word sequence as the only one; rows without doc_id stay;
an empty table gives no rows. Columns of docs are kept, and may have any name that doesn't begin with an underscore.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, short_batches
from .components import connected_components
from .simhash import SEED, kept_rows, majority, near_links, shingle_hashes

WIDTH, LEAST, BANDS, ROWS = 5, 0.8, 32, 4
#: Buckets of up to so many nodes are met in pairs, larger ones in blocks of so many nodes.
PAIRED, BLOCK = 8, 64


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    return np.unique(shingle_hashes(text, width))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def band_keys(shingles: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A key for each band: the hash of `rows` minima of the set under permutations of their own."""
    rng = np.random.default_rng(SEED)
    turn = rng.integers(0, 1 << 63, (bands * rows, 1), "u8")
    odd = rng.integers(0, 1 << 63, (bands * rows, 1), "u8") * np.uint64(2) + np.uint64(1)
    least = np.full(bands * rows, np.iinfo("u8").max, "u8")
    for at in range(0, len(shingles), 1 << 11):
        np.minimum(least, ((shingles[at : at + (1 << 11)] ^ turn) * odd).min(1), out=least)
    return np.array([xxhash.xxh64_intdigest(part.tobytes(), SEED) for part in least.reshape(bands, rows)], "<u8").view("<i8")


def sets_of(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, _copy (hash of the text), node (hash of its shingle set), fp (its SimHash), keys (one a band) of each row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, prints, keys = [], [], []
            for text in b.column(2).to_pylist():
                found = shingle_set(text, width)
                prints.append(majority(found))
                nodes.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
                keys.append(band_keys(found, bands, rows).tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.array(nodes, "<u8").view("<i8")), pa.array(np.array(prints, "<u8").view("<i8")), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "_copy", "node", "fp", "keys"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_copy"), "text")
    return short_batches(picked).mapInArrow(each, "doc_id long, _copy long, node long, fp long, keys array<long>")


def verified(pairs: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts (node, text) are similar enough."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[int, np.ndarray] = {}
            keep = []
            for a, b, text, other in zip(*(c.to_pylist() for c in batch.columns)):
                for node, words in ((a, text), (b, other)):
                    if node not in known:
                        known[node] = shingle_set(words, width)
                keep.append(jaccard(known[a], known[b]) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ends = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("_one")), "a")
    ends = ends.join(texts.select(F.col("node").alias("b"), F.col("text").alias("_two")), "b")
    return short_batches(ends.select("a", "b", "_one", "_two")).mapInArrow(each, "a long, b long")


def links_of_blocks(members: DataFrame, texts: DataFrame, width: int, least: float, block: int = BLOCK) -> DataFrame:
    """(a, b): links that join the components (node, component) of each bucket (band, key; of n nodes) whose nodes are similar enough.

    A bucket's nodes are dealt over blocks of about `block`, and each two blocks of it meet in one row, with
    their shingle sets, which are compared as matrices. Of the pairs only those are given that join components
    that weren't joined in this meeting yet, so that neither pairs nor links are made row by row.
    """
    wanted = members.select("node").distinct()
    held = shingle_sets(texts.join(wanted, "node"), width)
    dealt = members.withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / block)).cast("int")).join(held, "node")
    packed = cut(dealt.groupBy("band", "key", "n", "block").agg(F.collect_list(F.struct("node", "component", "shingles")).alias("x")))
    other = packed.select("band", "key", F.col("block").alias("other"), F.col("x").alias("y"))
    # by block, so that a large bucket's meetings are spread
    dealt_to = packed.withColumn("other", F.explode(F.sequence(F.col("block"), (F.ceil(F.col("n") / block) - 1).cast("int"))))
    meet = dealt_to.hint("merge").join(other, ["band", "key", "other"]).select("x", F.when(F.col("block") != F.col("other"), F.col("y")).alias("y"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found += joining_pairs(x, y or x, least)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return short_batches(meet).mapInArrow(each, "a long, b long")


def shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """node, shingles (sorted hashes, 8 bytes each) of each text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t, width).tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["node", "shingles"])

    return short_batches(texts.select("node", "text")).mapInArrow(each, "node long, shingles binary")


def joining_pairs(x: list[dict], y: list[dict], least: float, columns: int = 1 << 14) -> list[tuple[int, int]]:
    """Of two lists of (node, component, shingles): pairs of similar nodes that join components, as few as do."""
    one, two = ([np.frombuffer(r["shingles"], "<u8") for r in rows] for rows in (x, y))
    size_1, size_2 = (np.array([len(s) for s in sets], "f8") for sets in (one, two))
    shared = np.intersect1d(np.concatenate(one), np.concatenate(two))
    both = np.zeros((len(one), len(two)))
    places = [[at[shared[np.minimum(at, len(shared) - 1)] == s] for s in sets for at in [np.searchsorted(shared, s)]] if len(shared) else [] for sets in (one, two)]
    for at in range(0, len(shared), columns):
        held = [np.zeros((len(rows), columns), "f4") for rows in places]
        for matrix, rows in zip(held, places):
            for i, place in enumerate(rows):
                matrix[i, place[np.searchsorted(place, at) : np.searchsorted(place, at + columns)] - at] = 1
        both += held[0] @ held[1].T
    total = size_1[:, None] + size_2[None, :] - both
    alike = np.where(total > 0, both >= least * total, True)
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    out = []
    for i, j in np.argwhere(alike).tolist():
        a, b = root(x[i]["component"]), root(y[j]["component"])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((x[i]["node"], y[j]["node"]))
    return out


def similar_groups(docs: DataFrame, width: int = WIDTH, least: float = LEAST, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, _copy, component of each row: rows that links of similarity `least` or more connect have one component."""
    sets = cut(sets_of(docs, width, bands, rows))
    # any row of a node stands for its text
    row = sets.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_copy")).alias("row"), F.first("fp").alias("fp"), F.first("keys").alias("keys"))
    single = cut(row.select("node", "row.doc_id", "row._copy", "fp", "keys"))
    # of the nodes with one fingerprint, the smallest meets the others, and the fingerprints near it
    least_node = cut(single.groupBy("fp").agg(F.min("node").alias("least")))
    same = single.join(least_node, "fp").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    close = near_links(least_node).join(least_node.select(F.col("fp").alias("a"), F.col("least").alias("na")), "a").join(least_node.select(F.col("fp").alias("b"), F.col("least").alias("nb")), "b")
    simhashed = same.unionByName(close.select(F.col("na").alias("a"), F.col("nb").alias("b")))
    entries = single.select("node", F.posexplode("keys").alias("band", "key"))
    shared = entries.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("pivot")).where("n > 1").drop("n")
    met = cut(entries.hint("merge").join(shared, ["band", "key"]))
    simhashed = cut(simhashed.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    reached = met.select("node").unionByName(simhashed.select(F.col("a").alias("node"))).unionByName(simhashed.select(F.col("b").alias("node")))
    ids = reached.distinct().join(single.drop("keys", "fp"), "node")
    keyed = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    texts = cut(ids.join(keyed, ids.doc_id.eqNullSafe(F.col("_id")) & (ids._copy == F.col("_hash"))).select("node", "text").dropDuplicates(["node"]))

    stars = met.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).unionByName(simhashed).distinct()
    links = cut(verified(stars, texts, width, least))
    found = cut(connected_components(links))
    named = met.select("band", "key", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = named.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("band", "key", "n")
    open_ = cut(named.join(mixed, ["band", "key"]))
    # small buckets in pairs, of which many buckets share one; large ones in blocks
    one, two = (open_.where(F.col("n") <= PAIRED).select("band", "key", F.col("node").alias(n), F.col("component").alias(f"c{n}")) for n in ("a", "b"))
    rest = one.hint("merge").join(two, ["band", "key"]).where("a > b AND ca <> cb").select("a", "b").distinct().join(stars, ["a", "b"], "left_anti")
    more = cut(verified(rest, texts, width, least).unionByName(links_of_blocks(open_.where(F.col("n") > PAIRED), texts, width, least)).distinct())
    if not more.isEmpty():
        found = connected_components(links.unionByName(more))
    return sets.drop("keys", "fp").join(found, "node", "left").select("doc_id", "_copy", F.coalesce("component", "node").alias("component"))


def drop_similar(docs: DataFrame, width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """The rows of docs that stay: of each component the row with its smallest doc_id, once if it is repeated.

    Rows without doc_id stay, as none of them can be named.
    """
    groups = similar_groups(docs, width, least).where("doc_id IS NOT NULL")
    first = groups.groupBy("component").agg(F.min(F.struct("doc_id", "_copy")).alias("row"))
    return kept_rows(docs, first.select(F.col("row.doc_id").alias("kept"), F.col("row._copy").alias("copy")))

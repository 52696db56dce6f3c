"""Exact top-k by inner product with a vector-approximation file.

A vector's component x counts as the integer floor(256 x). The file holds, for each vector, one byte a
component: the number of its cell on a grid of CELLS equal cells between the component's least and greatest
value of all vectors. It is written once, in blocks of BLOCK vectors. A query scores a vector by the middles
of its cells; the true score is within half a cell of each component of that, the same width for all vectors.

Equal vectors score alike, so only the k + 1 first of them, by vec_id, are in the file.

1. Scan: each block of queries meets each block of the file, by an equality join on the block's number. A
   meeting leaves, for each query, the vectors whose bound reaches the kth bound of that block.
2. Filter: of all meetings, the kth best lower bound of a query is certain to be reached; vectors whose upper
   bound is under it go.
3. Read: of the rest, exact vectors are read in the order of the bounds, in two rounds: the k first, and then
   those whose bound reaches the kth exact score found so far. All others can't be among the k best.

Only cells are read in the scan; a vector's exact components are read for the few that pass the filter.

Cases: null vectors, or those holding a null or a value that isn't finite, and rows without an id, take no
part; vectors of different lengths score over the components that both have; each row is a candidate of all
others, and a query of its own, so repeated rows and ids each count; ties go to the smaller vec_id, then to
the row that comes first; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, short_batches, table

CELLS = 256
#: Vectors of a block of the file, and queries of a block.
BLOCK, QUERIES = 4096, 512
#: Below this, sums of products of doubles are exact.
EXACT = 1 << 53
#: The largest score; those beyond, or beyond its negative, are held there, and any of them may be among the k best.
LONGEST = (1 << 63) - 1


def integers(vectors: DataFrame, id_col: str, vec_col: str, *more: Column) -> DataFrame:
    """row (a number of its own), vec_id, v: whole components as doubles, of the rows that take part; and more columns."""
    scaled = lambda x: x.cast("double") * 256  # noqa: E731  whole already from 2^53 on
    v = F.transform(F.col(vec_col), lambda x: F.when(F.abs(scaled(x)) >= float(EXACT), scaled(x)).otherwise(F.floor(scaled(x)).cast("double")))
    whole = ~F.exists(F.col(vec_col), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & whole)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), *more)


def grid(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(least value, width of a cell) of each component; 0 is on every grid, as a missing component counts as 0."""
    ends = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("at").collect()
    low, high = np.array([min(0.0, r["low"]) for r in ends]), np.array([max(0.0, r["high"]) for r in ends])
    return low, np.maximum(high / CELLS - low / CELLS, 1e-9)


def padded(vectors: list, width: int) -> np.ndarray:
    x = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        x[i, : len(v)] = v
    return x


def cells_of(x: np.ndarray, low: np.ndarray, step: np.ndarray) -> np.ndarray:
    return np.clip((x - low) / step, 0, CELLS - 1).astype("u1")


def approximation_file(rows: DataFrame, low: np.ndarray, step: np.ndarray) -> DataFrame:
    """row, cells (a byte for each component) of each vector."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = cells_of(padded(b.column(1).to_pylist(), len(low)), low, step)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in cells], pa.binary())], ["row", "cells"])

    return short_batches(rows.select("row", "v")).mapInArrow(each, "row long, cells binary")


def bounds(q: np.ndarray, cells: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score of each query for each vector by the middles of cells, how far the true one may be from it), in units of each query's own.

    What all vectors have in common (the grid's least values) is left out.
    """
    weight = q / np.maximum(np.abs(q).max(1, initial=0, keepdims=True), 1e-300) * (step / step.max(initial=1e-300))
    total = np.abs(weight).sum(1)
    # half a cell, and what the sums of floats may lose
    slack = total * (0.5 + CELLS * (len(step) + 4) * 2.4e-7) + 1e-30
    return weight.astype("f4") @ cells.T.astype("f4"), slack


def met_block(q_rows: np.ndarray, q: np.ndarray, rows: np.ndarray, cells: np.ndarray, step: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query's row, vector's row, score by cells, slack) of those that may be among a query's k best of this block."""
    out = []
    for at in range(0, len(q), 128):
        near, slack = bounds(q[at : at + 128], cells, step)
        near[q_rows[at : at + 128, None] == rows] = -np.inf
        kth = np.partition(near, -k, axis=1)[:, -k] if near.shape[1] > k else np.full(len(near), -np.inf)
        i, j = np.nonzero((near >= (kth - 2.001 * slack)[:, None]) & (near > -np.inf))
        out.append((q_rows[at + i], rows[j], near[i, j].astype("f8"), slack[i]))
    return tuple(np.concatenate(x) for x in zip(*out))


def scan(blocks: DataFrame, queries: DataFrame, n_blocks: int, step: np.ndarray, k: int) -> DataFrame:
    """query, row, near, slack of the vectors that pass the scan.

    Queries are copied to all blocks, but Spark takes them for one copy: both sides are shuffled, so that the copies never meet on the driver.
    """
    meet = blocks.hint("merge").join(queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))), "block").select("file", "asked")
    names = ["query", "row", "near", "slack"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(step)
        for b in batches:
            for i in range(b.num_rows):
                file, asked = b.column(0)[i].values, b.column(1)[i].values
                cells = np.frombuffer(b"".join(file.field("cells").to_pylist()), "u1").reshape(-1, width)
                q = padded(asked.field("v").to_pylist(), width)
                found = met_block(asked.field("row").to_numpy(False), q, file.field("row").to_numpy(False), cells, step, k)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names)

    return short_batches(meet).mapInArrow(each, "query long, row long, near double, slack double")


def products(pairs: DataFrame) -> DataFrame:
    """query_row, query_id, row, vec_id, score of pairs (query_row, query_id, row, vec_id, one, two)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = []
            for one, two in zip(b.column("one").to_pylist(), b.column("two").to_pylist()):
                width = min(len(one), len(two))
                x, y = np.array(one[:width]), np.array(two[:width])
                if np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * max(1, width) < EXACT:
                    scores.append(int(x @ y))
                else:
                    scores.append(max(-LONGEST, min(LONGEST, sum(int(p) * int(r) for p, r in zip(x, y)))))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("query_row", "query_id", "row", "vec_id")), pa.array(scores, pa.int64())], ["query_row", "query_id", "row", "vec_id", "score"])

    return short_batches(pairs).mapInArrow(each, "query_row long, query_id long, row long, vec_id long, score long")


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(query_row, query_id, rank, vec_id, score: the k best other rows of each row where is_query holds; query_row, row: the exact vectors read for it)."""
    rows = cut(integers(vectors, id_col, vec_col))
    low, step = grid(rows)
    # of equal vectors only the k first, and one that may be the query, can be among the k best of any query
    equal = Window.partitionBy("v").orderBy("vec_id", "row")
    offered = cut(rows.withColumn("_n", F.row_number().over(equal)).where(F.col("_n") <= k + 1).drop("_n"))
    n_blocks, n_asked = -(-offered.count() // block) or 1, rows.where(is_query).count()
    number = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    file = cut(approximation_file(offered, low, step).groupBy(number(n_blocks).alias("block")).agg(F.collect_list(F.struct("row", "cells")).alias("file")))
    asked = rows.where(is_query).groupBy(number(-(-n_asked // QUERIES) or 1).alias("_q")).agg(F.collect_list(F.struct("row", "v")).alias("asked")).drop("_q")
    order = Window.partitionBy("query").orderBy(F.desc("near"), "row")
    seen = cut(scan(file, asked, n_blocks, step, k).withColumn("nth", F.row_number().over(order)))
    kth = seen.where(F.col("nth") == k).select("query", (F.col("near") - 2.001 * F.col("slack")).alias("reach"))
    left = cut(seen.join(kth, "query", "left").where(F.col("reach").isNull() | (F.col("near") >= F.col("reach"))).select("query", "row", "near", "slack", "nth"))

    query = rows.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("v").alias("one"))
    # whole numbers are far shorter in a file than in memory, so vectors are shuffled
    with_vectors = lambda some: products(some.withColumnRenamed("query", "query_row").join(query.hint("merge"), "query_row").join(offered.withColumnRenamed("v", "two").hint("merge"), "row").select("query_row", "query_id", "row", "vec_id", "one", "two"))
    first = cut(with_vectors(left.where(F.col("nth") <= k)))
    # the kth exact score in the query's units: a vector read scores within its slack of near, the others within theirs
    exact = first.join(left.select(F.col("query").alias("query_row"), "row", "near", "slack"), ["query_row", "row"])
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    certain = exact.withColumn("nth", F.row_number().over(best)).where(F.col("nth") == k).select(F.col("query_row").alias("query"), (F.col("near") - F.col("slack")).alias("reach"))
    rest = left.where(F.col("nth") > k).join(certain, "query").where(F.col("near") + F.col("slack") >= F.col("reach"))
    read = cut(first.unionByName(with_vectors(rest.select("query", "row"))))
    found = read.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_row", "query_id", "rank", "vec_id", "score"), read.select("query_row", "row")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row where is_query holds, its k best other rows."""
    return search(vectors, is_query, k, id_col, vec_col)[0].select("query_id", "rank", "vec_id", "score")


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


OP7_SQL = """
WITH e AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.r AS q, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.r <> c.r),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

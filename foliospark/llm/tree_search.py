"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, searched best bin first.

Tree: k-means by cosine over a bounded sample (`sample` rows by hash of id), each node divided in BRANCHES until a leaf
stands for about LEAF rows of the whole table, or for MIN_SAMPLE rows of the sample. It is a fixed number of centres and
goes to all tasks. Every row is indexed: it goes down to one leaf; a leaf's rows are stored in blocks of BLOCK rows, as many as it needs, so a hot leaf is many blocks.

Search: a query goes through the tree with a priority queue: the node whose centre is nearest of all that are open
is taken next; a leaf is visited, an inner node opens its children. All queries visit the same number of leaves. That number
is calibrated: the k nearest rows of CALIBRATION queries (by hash) are found by comparing them with every row,
each such neighbour's leaf has a place in its query's order, and visits widen until TARGET of all neighbours are in the leaves visited.
(A query's own row is no neighbour of it.) Leaves are visited in rounds, each WIDER times as wide as all before it together: the first FIRST leaves of
each query, then the next. In each leaf all rows are compared, by an equality join of queries and blocks on the leaf, in blocks of queries; a meeting leaves at
most k rows a query, and from the second round on only those that reach the query's kth score so far, so the rows left don't grow with the leaves visited.

Scores are cosines of the original vectors in double precision, each summed over one row in one way, so equal vectors have equal scores.
Of equal vectors only the k + 1 first by id can be among the k nearest of any query; these stand in the blocks for all.

Cases: rows without id, null vectors, zero vectors and those that hold a null or a value that isn't finite take no part; of vectors of different lengths
the shorter one counts as followed by zeros; each repeated row is a query, and a candidate, of its own; ties go to the smaller id, then to the row that comes first;
fewer than k candidates give all of them; an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import cut, short_batches, table

SAMPLE, BRANCHES, LEAF, MIN_SAMPLE, ROUNDS = 32768, 8, 1024, 24, 8
CALIBRATION, TARGET = 256, 0.95
BLOCK, QUERIES = 8192, 512
FIRST, WIDER = 4, 3


@dataclass
class Tree:
    """centres[n] lists the rows of `points` that are node n's children: an inner node's number, or a leaf's as -1 - leaf."""

    width: int
    kind: str = "f8"
    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    n_leaves: int = 0


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows."""
    x = x / np.maximum(np.abs(x).max(1, initial=0, keepdims=True), 1e-300)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-300)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Unit centres of at most k groups of unit rows."""
    centres = x[rng.permutation(len(x))[:k]]
    for _ in range(ROUNDS):
        near = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = unit_rows(sums[np.bincount(near, minlength=len(centres)) > 0])
    return np.unique(centres, axis=0)


def grow(sample: np.ndarray, rows_each: float, branches: int = BRANCHES, leaf: int = LEAF, seed: int = 42) -> Tree:
    """The tree over a sample of unit rows, each of which stands for rows_each rows."""
    tree, rng = Tree(sample.shape[1]), np.random.default_rng(seed)

    def node(x: np.ndarray) -> int:
        small = len(x) * rows_each <= leaf or len(x) < max(2 * MIN_SAMPLE, branches)
        centres = np.empty((0, tree.width)) if small else k_means(x, branches, rng)
        if len(centres) < 2:
            tree.n_leaves += 1
            return -tree.n_leaves
        at = len(tree.centres)
        tree.centres.append(centres)
        tree.children.append([])
        near = (x @ centres.T).argmax(1)
        tree.children[at] = [node(x[near == c]) for c in range(len(centres))]
        return at

    if node(sample) < 0:  # one leaf: a root with a single child
        tree.centres, tree.children = [np.zeros((1, tree.width))], [[-1]]
    return tree


def leaves_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf that each unit row goes down to."""
    out = np.zeros(len(x), "i4")
    todo = [(0, np.arange(len(x)))]
    while todo:
        n, rows = todo.pop()
        near = (x[rows] @ tree.centres[n].T).argmax(1)
        for c, child in enumerate(tree.children[n]):
            own = rows[near == c]
            if child < 0:
                out[own] = -1 - child
            elif len(own):
                todo.append((child, own))
    return out


def best_bins(tree: Tree, query: np.ndarray, most: int) -> list[int]:
    """The first leaves, at most so many, in the order in which a unit query visits them."""
    found: list[int] = []
    queue = [(-1.0, 0)]
    while queue and len(found) < most:
        _, n = heapq.heappop(queue)
        if n < 0:
            found.append(-1 - n)
            continue
        for near, child in zip((tree.centres[n] @ query).tolist(), tree.children[n]):
            heapq.heappush(queue, (-near, child))
    return found


def vectors_of(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """row (a number of its own), vec_id, v: components as doubles, of the rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    sound = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(sound)


def padded(vectors: list, width: int) -> np.ndarray:
    x = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        x[i, : len(v)] = v
    return x


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines of one vector and rows, in double precision; only where squares leave the range of doubles are vectors scaled first."""
    with np.errstate(all="ignore"):
        down = np.sqrt((query * query).sum()) * np.sqrt((rows * rows).sum(1))
        out = (rows * query).sum(1) / down
    odd = ~((down > 1e-150) & (down < 1e150) & np.isfinite(out))
    if odd.any():
        out[odd] = (unit_rows(rows[odd]) * unit_rows(query[None])[0]).sum(1)
    return np.clip(out, -1, 1)


def numbers(column: pa.Array, tree: Tree) -> np.ndarray:
    """Stored vectors as doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), tree.kind).reshape(-1, tree.width).astype("f8")


def indexed(rows: DataFrame, tree: Tree) -> DataFrame:
    """row, vec_id, leaf, v (bytes, in the precision of the table's vectors)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = padded(b.column("v").to_pylist(), tree.width)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("vec_id"), pa.array(leaves_of(tree, unit_rows(x))), pa.array([v.tobytes() for v in x.astype(tree.kind)], pa.binary())], ["row", "vec_id", "leaf", "v"])

    return short_batches(rows.select("row", "vec_id", "v")).mapInArrow(each, "row long, vec_id long, leaf int, v binary")


def nearest(q_rows: np.ndarray, q: np.ndarray, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, floor: np.ndarray | None = None) -> Iterator[tuple[int, int, int, float]]:
    """(query's row, row, id, score): for each query its k nearest rows of a block, of those whose scores reach its floor."""
    floor = np.full(len(q), -np.inf) if floor is None else floor
    u = unit_rows(x)
    for at in range(0, len(q), 256):
        near = unit_rows(q[at : at + 256]) @ u.T
        near[q_rows[at : at + 256, None] == rows] = -np.inf
        kth = np.partition(near, -k, axis=1)[:, -k] if near.shape[1] > k else np.full(len(near), -np.inf)
        for i, (line, least) in enumerate(zip(near, kth), at):
            j = np.flatnonzero((line >= max(least, floor[i]) - 1e-9) & (line > -np.inf))
            score = cosines(q[i], x[j])
            for n in np.lexsort((rows[j], ids[j], -score))[:k]:
                if score[n] >= floor[i]:
                    yield q_rows[i], rows[j[n]], ids[j[n]], score[n]


FOUND = "query long, row long, vec_id long, score double"


def found_batch(found: Iterator[tuple]) -> pa.RecordBatch:
    query, row, vec_id, score = list(zip(*found)) or [()] * 4
    return pa.RecordBatch.from_arrays([*(pa.array(np.array(c, "i8")) for c in (query, row, vec_id)), pa.array(np.array(score, "f8"))], ["query", "row", "vec_id", "score"])


def arrays(block: pa.StructArray, tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return block.field("row").to_numpy(False), block.field("vec_id").to_numpy(False), numbers(block.field("v"), tree)


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def visits_needed(file: DataFrame, asked: list, tree: Tree, k: int, target: float) -> int:
    """How many leaves a query has to visit so that the leaves hold `target` of the k nearest rows of the queries asked (row, v bytes), found by comparing them with all rows of file."""
    q_rows, q = np.array([r["row"] for r in asked], "i8"), numbers(pa.array([bytes(r["v"]) for r in asked], pa.binary()), tree)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, ids = b.column("row").to_numpy(), b.column("vec_id").to_numpy()
            yield found_batch(nearest(q_rows, q, rows, ids, numbers(b.column("v"), tree), k))

    true = ranked(file.select("row", "vec_id", "v").mapInArrow(each, FOUND), k).join(file.select("row", "leaf"), "row").select("query", "leaf").collect()
    place = {row: {leaf: n for n, leaf in enumerate(best_bins(tree, u, tree.n_leaves), 1)} for row, u in zip(q_rows.tolist(), unit_rows(q))}
    needed = sorted(place[r["query"]][r["leaf"]] for r in true)
    return needed[max(0, -(-int(target * 10000) * len(needed) // 10000) - 1)] if needed else 1


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", sample: int = SAMPLE, leaf: int = LEAF, target: float = TARGET, block: int = BLOCK) -> tuple[DataFrame, int, int]:
    """(query_row, query_id, rank, vec_id, score of the nearest rows found for each row where is_query holds; leaves visited; leaves)."""
    rows = cut(vectors_of(vectors, id_col, vec_col))
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    drawn = padded([r["v"] for r in rows.select("v").orderBy(F.xxhash64("vec_id", "row"), "row").limit(sample).collect()], width)
    tree = grow(unit_rows(drawn), n / max(1, len(drawn)), leaf=leaf)
    tree.kind = "f4" if vectors.schema[vec_col].dataType.elementType == FloatType() else "f8"
    equal = Window.partitionBy("v").orderBy("vec_id", "row")
    offered = rows.withColumn("_n", F.row_number().over(equal)).where(F.col("_n") <= k + 1).drop("_n")
    file = cut(indexed(offered, tree))
    asked = cut(indexed(rows.where(is_query), tree))
    visits = visits_needed(file, asked.orderBy(F.xxhash64("vec_id", "row", F.lit(1)), "row").limit(CALIBRATION).collect(), tree, k, target)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [best_bins(tree, x, visits) for x in unit_rows(numbers(b.column("v"), tree))]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(own, pa.list_(pa.int32()))], ["row", "leaves"])

    # at most one row a leaf
    n_blocks = F.create_map(*[F.lit(x) for r in file.groupBy("leaf").count().collect() for x in (r["leaf"], -(-r["count"] // block))] or [F.lit(-1), F.lit(1)])
    blocks = cut(file.withColumn("blk", F.pmod(F.xxhash64("row"), n_blocks[F.col("leaf")]).cast("int")).groupBy("leaf", "blk").agg(F.collect_list(F.struct("row", "vec_id", "v")).alias("file")))
    visited = cut(short_batches(asked.select("row", "v")).mapInArrow(bins, "row long, leaves array<int>"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                given = b.column(0)[i].values
                (q_rows, _, q), (r, ids, x) = arrays(given, tree), arrays(b.column(1)[i].values, tree)
                yield found_batch(nearest(q_rows, q, r, ids, x, k, given.field("floor").to_numpy(False)))

    found, begun = None, 0
    while begun < visits:
        wide = min(FIRST if not begun else begun * WIDER, visits - begun)
        now = visited.select("row", F.explode(F.slice("leaves", begun + 1, wide)).alias("leaf"))
        per = now.groupBy("leaf").count().select("leaf", F.ceil(F.col("count") / QUERIES).cast("int").alias("parts"))
        split = now.join(F.broadcast(per), "leaf").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
        told = asked.select("row", "vec_id", "v")
        kth = found.where(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("floor")) if found else None
        told = told.join(kth, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0))) if found else told.withColumn("floor", F.lit(-2.0))
        groups = split.join(told, "row").groupBy("leaf", "part").agg(F.collect_list(F.struct("row", "vec_id", "v", "floor")).alias("asked"))
        to_meet = groups.withColumn("blk", F.explode(F.sequence(F.lit(0), n_blocks[F.col("leaf")] - 1)))
        met = short_batches(to_meet.join(blocks, ["leaf", "blk"]).select("asked", "file")).mapInArrow(each, FOUND)
        found = cut(ranked(found.drop("rank").unionByName(met) if found else met, k))
        begun += wide
    query = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    out = found.join(query, "query")
    return out.select(F.col("query").alias("query_row"), "query_id", "rank", "vec_id", "score"), visits, tree.n_leaves


def op13_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _, _ = search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", "vec_id", "score")

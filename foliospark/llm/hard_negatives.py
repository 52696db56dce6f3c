"""Hard-negative mining with stored angles.

A vector's component x counts as the integer floor(256 x); scores are integer inner products. An anchor's positives are
its n_positive best other rows of its label. A positive's negatives are the best rows of other labels whose
score lies between `share` percent of the positive's and the positive's own.

Each row's angles to REFERENCES directions are stored in the file, with its norm. The angle between two rows is at
least the largest difference of their angles to one direction, and at most the least sum (or what the sum leaves of a
full turn). Cosines of both ends, times both norms, bound the score; angles are widened by SLACK and products by a part
in 10^9, beyond what rounding can lose. Only rows whose bounds overlap a window that still counts are scored in integers:

1. positives: rows of the anchor's label whose upper bound reaches the n_positive-th best lower bound of the block;
2. negatives: rows of other labels whose bounds overlap the window of one of the anchor's positives.

The file's blocks hold about BLOCK rows of a few labels (a hash of the label; a label's rows go to as many blocks as they need), in order of
their nearest direction, so that a tile of rows lies within narrow angles and is skipped whole where no bound fits. Positives meet
blocks of their own labels only; negatives meet every block once, by an equality join on the block's number, in blocks of ANCHORS
anchors. A meeting leaves at most n_positive rows an anchor, and n_negative a window.

The directions are means of a bounded sample (SAMPLE rows by hash, a few rounds of spherical k-means); any directions give the same rows.
Equal rows score alike, so of equal vectors of one label only the first max(n_positive, n_negative) + 1 by id are in the file.

Cases: rows without id or label, null vectors and those that hold a null or a value that isn't finite take no part; vectors of
different lengths score over the components that both have; each repeated row is an anchor, and a candidate, of its own; ties go to the smaller id,
then to the row that comes first; an anchor without positives, or a positive without negatives, gives no rows; an empty table gives no rows;
extra columns are left out. A negative positive score has no window, as its share is above it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, short_batches, table
from .topk import EXACT, LONGEST, integers, padded

REFERENCES, SAMPLE, ROUNDS = 16, 4096, 5
#: Rows of a block of the file and of a tile in it; anchors of a block; label groups.
BLOCK, TILE, ANCHORS, GROUPS = 16384, 512, 2048, 64
#: Angles are stored in single precision, and found by an arc cosine: together they err by less than this (radians).
SLACK = 2e-6


def unit_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of length 1, lengths); a zero row stays zero. Scaled first, so that no square overflows."""
    top = np.maximum(np.abs(x).max(1, initial=0, keepdims=True), 1e-300)
    scaled = x / top
    length = np.sqrt((scaled * scaled).sum(1, keepdims=True))
    return scaled / np.maximum(length, 1e-300), (top * length)[:, 0]


def sampled(rows: DataFrame, n: int) -> list[list[float]]:
    """The vectors of the first n rows by hash of id. Each part's first n rows come to the driver as hashes and numbers only; of the vectors just those that are picked do."""
    keyed = rows.select(F.xxhash64("vec_id", "row").alias("_h"), "row", "v")
    last = keyed.select("_h", "row").orderBy("_h", "row").limit(n).agg(F.max(F.struct("_h", "row")).alias("k")).first()["k"]
    if last is None:
        return []
    picked = keyed.where((F.col("_h") < last["_h"]) | ((F.col("_h") == last["_h"]) & (F.col("row") <= last["row"])))
    return [r["v"] for r in sorted(picked.collect(), key=lambda r: (r["_h"], r["row"]))]


def references(rows: DataFrame, width: int, n: int = REFERENCES) -> np.ndarray:
    """Unit directions, at most n: means of groups of a bounded sample by hash of id."""
    sample = padded(sampled(rows, SAMPLE), width)
    x = unit_rows(sample)[0] if len(sample) else np.zeros((1, width))
    means = x[:: max(1, len(x) // n)][:n]
    for _ in range(ROUNDS):
        near = (x @ means.T).argmax(1)
        sums = np.zeros_like(means)
        np.add.at(sums, near, x)
        means = np.where(np.abs(sums).max(1, keepdims=True) > 0, unit_rows(sums)[0], means)
    return means


def angles_to(x: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(angles in single precision, norms)."""
    u, norm = unit_rows(x)
    return np.arccos(np.clip(u @ directions.T, -1, 1)).astype("f4"), norm


def angle_file(rows: DataFrame, directions: np.ndarray) -> DataFrame:
    """row, vec_id, label, near (the nearest direction), norm, angles, v (bytes) of each row."""
    width = directions.shape[1]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = padded(b.column("v").to_pylist(), width)
            angles, norm = angles_to(x, directions)
            near = angles.argmin(1).astype("i4") if angles.shape[1] else np.zeros(len(x), "i4")
            out = [b.column("row"), b.column("vec_id"), b.column("label"), pa.array(near), pa.array(norm), pa.array([a.tobytes() for a in angles], pa.binary()), pa.array([v.tobytes() for v in x], pa.binary())]
            yield pa.RecordBatch.from_arrays(out, ["row", "vec_id", "label", "near", "norm", "angles", "v"])

    return short_batches(rows.select("row", "vec_id", "label", "v")).mapInArrow(each, "row long, vec_id long, label long, near int, norm double, angles binary, v binary")


FIELDS = ("row", "vec_id", "label", "norm", "angles", "v")


class Rows:
    """The rows of a block as arrays, in order of their nearest direction."""

    def __init__(self, block: pa.StructArray, width: int, n_angles: int) -> None:
        self.row, self.vec_id, self.label = (block.field(c).to_numpy(False) for c in FIELDS[:3])
        self.norm = block.field("norm").to_numpy(False)
        self.angles = np.frombuffer(b"".join(block.field("angles").to_pylist()), "f4").reshape(len(self.row), n_angles)
        self.v = np.frombuffer(b"".join(block.field("v").to_pylist()), "f8").reshape(len(self.row), width)
        self.top = np.abs(self.v).max(initial=0)

    def pick(self, at: np.ndarray) -> Rows:
        out = object.__new__(Rows)
        for c in ("row", "vec_id", "label", "norm", "angles", "v"):
            setattr(out, c, getattr(self, c)[at])
        out.top = self.top
        return out


def score_bounds(one: np.ndarray, one_norm: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the scores of anchors (angles, norms) with others whose angles lie in low..high and norms in least..most."""
    apart = np.zeros((len(one), len(low)), "f4")
    within = np.full((len(one), len(low)), np.pi, "f4")
    for r in range(one.shape[1]):
        a = one[:, r, None]
        np.maximum(apart, np.maximum(a - high[:, r], low[:, r] - a), out=apart)
        np.minimum(within, np.minimum(a + high[:, r], np.float32(2 * np.pi) - (a + low[:, r])), out=within)
    up, down = np.cos(np.clip(apart.astype("f8") - SLACK, 0, np.pi)), np.cos(np.clip(within.astype("f8") + SLACK, 0, np.pi))
    n = one_norm[:, None]
    slack = 1e-9 * n * most + 1e-9
    # scores beyond LONGEST are held there
    low, high = np.minimum(down * n * least, down * n * most) - slack, np.maximum(up * n * least, up * n * most) + slack
    return np.minimum(low, LONGEST), np.maximum(high, -LONGEST)


def exact(anchor: np.ndarray, rows: np.ndarray, small: bool) -> np.ndarray:
    """Integer inner products of one vector with rows."""
    if small:
        return (rows @ anchor).astype("i8")
    whole = [int(x) for x in anchor]
    return np.array([max(-LONGEST, min(LONGEST, sum(p * int(r) for p, r in zip(whole, v)))) for v in rows], "i8")


def tiles(file: Rows) -> list[tuple[slice, tuple[np.ndarray, ...]]]:
    """(rows, (low and high angles, least and most norm)) of each tile of a block."""
    out = []
    for a in range(0, len(file.row), TILE):
        s = slice(a, a + TILE)
        out.append((s, (file.angles[s].min(0)[None], file.angles[s].max(0)[None], file.norm[s].min(keepdims=True), file.norm[s].max(keepdims=True))))
    return out


def best(score: np.ndarray, vec_id: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((row, vec_id, -score))[:k]


def near_rows(asked: Rows, file: Rows, k: int) -> Iterator[tuple]:
    """(anchor's row, vec_id, row, vec_id, score): for each anchor the k best rows of its label in a block."""
    small = asked.top * file.top * max(1, file.v.shape[1]) < EXACT
    for label in np.intersect1d(asked.label, file.label):
        mine, theirs = asked.pick(np.flatnonzero(asked.label == label)), file.pick(np.flatnonzero(file.label == label))
        for at in range(0, len(mine.row), 64):
            part = slice(at, at + 64)
            low, high = score_bounds(mine.angles[part], mine.norm[part], theirs.angles, theirs.angles, theirs.norm, theirs.norm)
            own = mine.row[part, None] == theirs.row
            low[own], high[own] = -np.inf, -np.inf
            kth = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(low), -np.inf)
            for i, (h, least) in enumerate(zip(high, kth), at):
                j = np.flatnonzero((h >= least) & (h > -np.inf))
                score = exact(mine.v[i], theirs.v[j], small)
                for n in best(score, theirs.vec_id[j], theirs.row[j], k):
                    yield mine.row[i], mine.vec_id[i], theirs.row[j[n]], theirs.vec_id[j[n]], score[n]


def in_windows(asked: Rows, positives: list, file: Rows, share: int, k: int) -> Iterator[tuple]:
    """(anchor's row, positive's row, row, vec_id, score): for each positive the k best rows of other labels whose scores fit, of a block."""
    small = asked.top * file.top * max(1, file.v.shape[1]) < EXACT
    wide = tiles(file)
    # a negative positive score's share is above it: it has no window
    own = [[(p["row"], p["score"]) for p in ps if p["score"] >= 0] for ps in positives]
    ends = np.array([(max(s for _, s in ps), min(s for _, s in ps) * share / 100 * (1 - 1e-12)) if ps else (-np.inf, np.inf) for ps in own]).reshape(-1, 2)
    fits = lambda low, high: (low <= ends[:, :1]) & (high >= ends[:, 1:])
    open_ = np.column_stack([fits(*score_bounds(asked.angles, asked.norm, *box))[:, 0] for _, box in wide])
    for i in np.flatnonzero(open_.any(1)):
        found = []
        for t in np.flatnonzero(open_[i]):
            s = wide[t][0]
            low, high = score_bounds(asked.angles[i : i + 1], asked.norm[i : i + 1], file.angles[s], file.angles[s], file.norm[s], file.norm[s])
            # a bound may overlap the ends of all windows and yet none of them
            some = np.zeros(low.shape[1], bool)
            for _, score in own[i]:
                some |= (low[0] <= score) & (high[0] >= score * share / 100 * (1 - 1e-12))
            found.append(np.flatnonzero(some & (file.label[s] != asked.label[i])) + s.start)
        j = np.concatenate(found)
        score = exact(asked.v[i], file.v[j], small)
        order = best(score, file.vec_id[j], file.row[j], len(j))
        j, score = j[order], score[order]
        for row, top in own[i]:
            # whole numbers: share * top <= 100 * score
            fit = np.flatnonzero((score <= top) & (score >= -(-share * top // 100)))[:k]
            for n in fit:
                yield asked.row[i], row, file.row[j[n]], file.vec_id[j[n]], score[n]


def struct_array(column: pa.ListArray, i: int) -> pa.StructArray:
    return column[i].values


def mine(vectors: DataFrame, is_anchor: Column, n_positive: int = 5, n_negative: int = 5, share: int = 80, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding", block: int = BLOCK, anchors: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of each anchor (rows where is_anchor holds, a column of ids) and positive."""
    labelled = vectors.where(F.col(label_col).isNotNull())
    rows = cut(integers(labelled, id_col, vec_col, F.col(label_col).cast("long").alias("label")))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 1
    directions = references(rows, width)
    n_angles = len(directions)
    equal = Window.partitionBy("label", "v").orderBy("vec_id", "row")
    group = F.pmod(F.xxhash64("label"), F.lit(GROUPS)).cast("int")
    offered = rows.withColumn("_n", F.row_number().over(equal)).where(F.col("_n") <= max(n_positive, n_negative) + 1).drop("_n")
    stored = cut(angle_file(offered, directions).withColumn("grp", group))
    # at most GROUPS rows
    n_parts = {r["grp"]: -(-r["count"] // block) for r in stored.groupBy("grp").count().collect()} or {0: 1}
    first, total = {}, 0
    for g, n in sorted(n_parts.items()):
        first[g], total = total, total + n
    pick = lambda of: F.element_at(F.create_map(*[F.lit(x) for g in n_parts for x in (g, of[g])]), F.col("grp"))
    packed = lambda: F.sort_array(F.collect_list(F.struct("near", "row", "vec_id", "label", "norm", "angles", "v")))
    file = cut(stored.withColumn("blk", (pick(first) + F.pmod(F.xxhash64("row"), pick(n_parts))).cast("int")).groupBy("blk").agg(packed().alias("file")))
    asked_rows = angle_file(rows.where(is_anchor), directions).withColumn("grp", group)
    n_asked = rows.where(is_anchor).count()
    asked = cut(asked_rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(-(-n_asked // anchors) or 1)).cast("int")))

    def positives_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                a, f = (Rows(struct_array(b.column(c), i), width, n_angles) for c in (0, 1))
                yield pairs(near_rows(a, f, n_positive), ["anchor", "anchor_id", "row", "vec_id", "score"])

    # anchors are copied to blocks, but Spark takes them for one copy: the joins with the file are shuffled, so that the copies never meet on the driver
    by_group = asked.groupBy("grp", "part").agg(packed().alias("asked"))
    met = by_group.withColumn("blk", F.explode(F.sequence(pick(first), pick(first) + pick(n_parts) - 1))).join(file.hint("merge"), "blk").select("asked", "file")
    ranked = short_batches(met).mapInArrow(positives_of, "anchor long, anchor_id long, row long, vec_id long, score long")
    positives = cut(ranked.withColumn("nth", F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "row"))).where(F.col("nth") <= n_positive))

    def negatives_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                given = struct_array(b.column(0), i)
                a, f = Rows(given, width, n_angles), Rows(struct_array(b.column(1), i), width, n_angles)
                yield pairs(in_windows(a, given.field("positives").to_pylist(), f, share, n_negative), ["anchor", "positive", "row", "vec_id", "score"])

    own = positives.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("row", "score")).alias("positives"))
    whole = asked.join(own, "row").groupBy("part").agg(F.collect_list(F.struct("row", "vec_id", "label", "norm", "angles", "v", "positives")).alias("asked"))
    every = whole.withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(total - 1)))).join(file.hint("merge"), "blk").select("asked", "file")
    hits = short_batches(every).mapInArrow(negatives_of, "anchor long, positive long, row long, vec_id long, score long")
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "vec_id", "row")
    top = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negative)
    told = positives.select("anchor", "anchor_id", F.col("row").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return top.join(told, ["anchor", "positive"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def pairs(found: Iterator[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(np.array(c, "i8")) for c in columns], names)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(e.withColumn("label", label), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH e AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, c.r AS c, c.vec_id, c.label = a.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score FROM e a JOIN e c ON a.vec_id % 100 = 0 AND a.r <> c.r),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.c ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
"""

"""Repeated runs of lines, found by prefix doubling over line ids; later copies are deleted.

A line is a stretch of text between newlines; its id stands for its text without outer spaces. Blank lines
are no part of the sequences and always stay. Words are counted by the spaces between them.

A run of lines with min_words or more words that also occurs earlier (in the order of doc_id, a hash of
the text, line) is deleted; the first occurrence stays. Any maximal repeated run is the union of its
shortest parts of min_words words that begin or end at each of its lines, so only these are compared. Such
a part of m lines, 2^k <= m < 2^(k+1), is named by the ranks of its first and its last 2^k lines. Ranks of
2^k lines come from sorting the pairs of ranks of 2^(k-1) lines, so they order the suffixes to that depth:
the parts with the same name are one interval of the suffix array, whose common prefix is that part.

Cases: null text gives null, text that loses all its lines an empty text; null doc_ids come first; rows
with the same id and text are one document, so none is the other's copy; an empty table gives no rows.
Columns of docs are kept, and may have any name; doc_id must be a number, or a text of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

MIN_WORDS = 30
#: Stands for a null doc_id: nulls come first.
NO_ID = -(1 << 63)


def keys_of(doc: str, text: str) -> dict[str, Column]:
    """What a row is known by."""
    return {"_doc": F.coalesce(F.col(doc).cast("long"), F.lit(NO_ID)), "_copy": F.xxhash64(text)}


def shortest(words: str, at: Column, least: int, forward: bool) -> Column:
    """How many lines from (or up to) the line at index `at` have `least` words; 0 if all have fewer."""
    w = F.col(words)
    part = F.slice(w, at + 1, least) if forward else F.reverse(F.slice(w, F.greatest(at + 2 - least, F.lit(1)), F.least(at + 1, F.lit(least))))
    # words in the high bits, lines in the low ones
    both = F.aggregate(part, F.lit(0).cast("long"), lambda s, x: F.when(F.shiftright(s, 16) >= least, s).otherwise(s + F.shiftleft(x.cast("long"), 16) + 1))
    many = F.when(F.shiftright(both, 16) >= least, both.bitwiseAND(F.lit(0xFFFF))).otherwise(F.lit(0))
    return F.when(F.get(w, at) >= least, F.lit(1)).otherwise(many).cast("int")


def line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """_doc, _copy, j (index among lines that aren't blank), no (index among all lines), two hashes of the line, fore and back (lines of the shortest parts)."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("no"), F.trim(x).alias("line"))), lambda s: s["line"] != "")
    one = docs.select("doc_id", "text").withColumns(keys_of("doc_id", "text")).select("_doc", "_copy", lines.alias("lines"))
    counted = one.withColumn("w", F.transform("lines", lambda s: F.length(s["line"]) - F.length(F.replace(s["line"], F.lit(" "), F.lit(""))) + 1))
    parts = F.transform(
        "lines",
        lambda s, i: F.struct(
            i.alias("j"), s["no"].alias("no"), F.xxhash64(s["line"]).alias("h1"), F.xxhash64(F.lit("second"), s["line"]).alias("h2"),
            shortest("w", i, min_words, True).alias("fore"), shortest("w", i, min_words, False).alias("back"),
        ),
    )
    return counted.select("_doc", "_copy", F.explode(parts).alias("p")).select("_doc", "_copy", "p.*")


def ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows whose keys occur twice or more, with their rank r in the order of the keys, instead of the keys."""
    names = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n").orderBy(*keys)
    # ranks and places are far shorter in files than in memory: joins of them are shuffled, none comes to the driver
    return rows.hint("merge").join(cut(names.withColumn("r", F.monotonically_increasing_id())), keys).drop(*keys)


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """_doc, _copy, no: the lines that a later copy of a repeated run covers."""
    lines = cut(ranked(line_rows(docs, min_words), ["h1", "h2"]))
    where = ["_doc", "_copy"]
    parts = lines.where("fore > 0").select(*where, F.col("j").alias("s"), F.col("fore").alias("m"))
    parts = parts.unionByName(lines.where("back > 1").select(*where, (F.col("j") - F.col("back") + 1).alias("s"), F.col("back").alias("m")))
    level, size = lines.select(*where, "j", "r"), 1
    named = lines.where("fore = 1").select(*where, F.col("j").alias("s"), F.lit(1).alias("m"), F.col("r").alias("r1"), F.col("r").alias("r2"))
    while 2 * size <= min_words:
        after = level.select(*where, (F.col("j") - size).alias("j"), F.col("r").alias("r2"))
        level = cut(ranked(level.withColumnRenamed("r", "r1").hint("merge").join(after, [*where, "j"]), ["r1", "r2"]))
        if level.isEmpty():
            break
        size *= 2
        first = level.select(*where, F.col("j").alias("s"), F.col("r").alias("r1"))
        last = level.select(*where, F.col("j").alias("e"), F.col("r").alias("r2"))
        here = parts.where((F.col("m") >= size) & (F.col("m") < 2 * size)).distinct().withColumn("e", F.col("s") + F.col("m") - size)
        named = named.unionByName(here.hint("merge").join(first, [*where, "s"]).hint("merge").join(last, [*where, "e"]).select(*where, "s", "m", "r1", "r2"))
    named = cut(named)
    place = F.struct(*where, "s")
    earliest = named.groupBy("m", "r1", "r2").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first")).where("_n > 1").drop("_n")
    gone = named.hint("merge").join(earliest, ["m", "r1", "r2"]).where(place > F.col("_first"))
    covered = gone.select(*where, F.explode(F.sequence("s", F.col("s") + F.col("m") - 1)).alias("j")).distinct()
    return covered.hint("merge").join(lines.select(*where, "j", "no"), [*where, "j"]).select(*where, "no").distinct()


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, deleted: str | None = "deleted") -> DataFrame:
    """docs without later copies, and in a column named by `deleted` (instead of one of that name) the runs deleted from each text, as (first, last) line indices. Columns may have any name."""
    where = ["_doc", "_copy"]
    inner = [f"_c{i}" for i in range(len(docs.columns))]
    doc, body = (inner[docs.columns.index(c)] for c in ("doc_id", "text"))
    order = Window.partitionBy(*where).orderBy("no")
    runs = later_copies(docs, min_words).withColumn("_run", F.col("no") - F.row_number().over(order)).groupBy(*where, "_run").agg(F.min("no").alias("first"), F.max("no").alias("last"))
    gone = runs.groupBy(*where).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("_deleted"))
    kept = F.filter(F.split(body, "\n"), lambda x, i: ~F.exists("_deleted", lambda r: i.between(r["first"], r["last"])))
    text = F.when(F.col("_deleted").isNull(), F.col(body)).otherwise(F.array_join(kept, "\n"))
    out = docs.toDF(*inner).withColumns(keys_of(doc, body)).join(gone, where, "left")
    told = out.withColumns({body: text, "_runs": F.coalesce("_deleted", F.array().cast("array<struct<first:int,last:int>>"))})
    names = {i: c for c, i in zip(docs.columns, inner) if c != deleted} | ({"_runs": deleted} if deleted else {})
    return told.select(*names).toDF(*names.values())


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.aggregate("deleted", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1).cast("long")
    return dedup_lines(docs).select("doc_id", "text", lines.alias("lines_deleted"))


#: The same by comparing the texts of the parts themselves. Texts of op6's lines hold no tab, which joins them here.
OP6_SQL = f"""
WITH d AS (SELECT doc_id, text, md5(text) AS copy, string_split(text, chr(10)) AS ls FROM documents),
u AS (SELECT doc_id, copy, unnest(generate_series(1, len(ls))) - 1 AS no, trim(unnest(ls), ' ') AS line FROM d),
l AS (SELECT *, row_number() OVER (PARTITION BY doc_id, copy ORDER BY no) - 1 AS j,
      sum(length(line) - length(replace(line, ' ', '')) + 1) OVER (PARTITION BY doc_id, copy ORDER BY no) AS upto,
      length(line) - length(replace(line, ' ', '')) + 1 AS w FROM u WHERE line <> ''),
s AS (SELECT doc_id, copy, list(line ORDER BY j) AS ls FROM l GROUP BY ALL),
p AS (SELECT DISTINCT a.doc_id, a.copy, a.j AS s, b.j AS e FROM l a JOIN l b ON a.doc_id = b.doc_id AND a.copy = b.copy
      AND b.j BETWEEN a.j AND a.j + {MIN_WORDS} WHERE b.upto - a.upto + a.w >= {MIN_WORDS}
      AND (b.upto - b.w - a.upto + a.w < {MIN_WORDS} OR b.upto - a.upto < {MIN_WORDS})),
t AS (SELECT p.*, array_to_string(list_slice(s.ls, p.s + 1, p.e + 1), chr(9)) AS part FROM p JOIN s USING (doc_id, copy)),
g AS (SELECT doc_id, copy, s, e, row_number() OVER (PARTITION BY part ORDER BY doc_id, s) AS nth FROM t),
x AS (SELECT DISTINCT l.doc_id, l.no FROM g JOIN l ON l.doc_id = g.doc_id AND l.j BETWEEN g.s AND g.e WHERE g.nth > 1)
SELECT d.doc_id, coalesce(string_agg(ls[i + 1], chr(10) ORDER BY i) FILTER (x.no IS NULL), '') AS text, count(x.no) AS lines_deleted
FROM d, unnest(generate_series(0, len(ls) - 1)) AS q(i) LEFT JOIN x ON x.doc_id = d.doc_id AND x.no = i GROUP BY d.doc_id
"""

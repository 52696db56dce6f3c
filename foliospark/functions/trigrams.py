"""Texts that hold a literal, found by equality of one of its trigrams: the one that the fewest texts have."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pieces(text: Column, n: int) -> Column:
    """The stretches of n characters of a text."""
    return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def with_pieces(texts: DataFrame, text: str, sizes: Sequence[int] = (3,)) -> DataFrame:
    """texts with _p: a row for each distinct stretch of a text."""
    return texts.withColumn("_p", F.explode(F.array_distinct(F.flatten(F.array(*[pieces(F.col(text), n) for n in sizes])))))


def rarest_piece(needles: DataFrame, needle: str, held: DataFrame) -> DataFrame:
    """needles with _p: of the trigrams of each (the whole of a shorter one) that which the fewest rows of held (_p) have."""
    short = F.when(F.length(needle) < 3, F.array(F.col(needle))).otherwise(pieces(F.col(needle), 3))
    names = needles.columns
    rows = needles.withColumn("_p", F.explode(F.array_distinct(short)))
    counted = rows.join(held.groupBy("_p").agg(F.count(F.lit(1)).alias("_k")), "_p", "left")
    return counted.groupBy(*names).agg(F.min_by("_p", F.struct(F.coalesce("_k", F.lit(0).cast("long")), "_p")).alias("_p"))


def required_literals(pattern: Column) -> Column:
    """Literals (a-z, 0-9, space) of which any text that a regular expression finds holds at least one; null if none of three characters can be told.

    Either the longest stretch that stands outside of groups, classes and repetitions, or the alternatives of the pattern's only group. Patterns
    with flags, look-around, or alternatives outside of groups have none.
    """
    gap = "\x01"
    flat = F.regexp_replace(F.regexp_replace(pattern, r"\\.", gap), r"\[\^?\]?[^\]]*\]", gap)
    bare = flat
    for _ in range(6):
        bare = F.regexp_replace(bare, r"\([^()]*\)", gap)
    simple = ~F.contains(pattern, F.lit("(?")) & ~F.contains(bare, F.lit("|")) & ~F.contains(bare, F.lit("("))
    runs = F.split(F.regexp_replace(bare, r"[a-z0-9 ](?:[?*]|\{[^}]*\})", gap), "[^a-z0-9 ]+")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("r"))))
    group = F.regexp_extract(flat, r"\(([a-z0-9 ]{3,}(?:\|[a-z0-9 ]{3,})*)\)(?![?*{])", 1)
    one = (F.regexp_count(flat, F.lit(r"\(")) == 1) & (group != "")
    return F.when(simple & (longest["n"] >= 3), F.array(longest["r"])).when(simple & one, F.split(group, r"\|"))

"""Families of concepts: aliases, phrases, patterns and rules of a catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.lineage import cut
from foliospark.functions.textnorm import let, surface
from foliospark.functions.trigrams import rarest_piece, required_literals, with_pieces

#: Catalogs up to so many aliases are broadcast.
SMALL_CATALOG = 100_000
#: Groups of names that rules without a literal meet.
SALTS = 64


def maybe_broadcast(df: DataFrame, most: int = SMALL_CATALOG) -> DataFrame:
    """df, to be broadcast if it has `most` rows or fewer; else joins shuffle it."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def ngrams(text: Column, low: int, high: int) -> Column:
    """The runs of `low` to `high` words of a surface."""

    def runs(words: Column, n: int) -> Column:
        found = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, found).otherwise(F.array().cast("array<string>"))

    return let(F.split(text, " "), lambda words: F.array_distinct(F.flatten(F.array(*[runs(words, n) for n in range(low, high + 1)]))))


def rule_hits(names: DataFrame, rules: DataFrame, key: Sequence[str]) -> DataFrame:
    """key, family_id: the names (key, _s) that a rule's pattern finds. rules: pattern, family_id; any number of them.

    A rule meets the names that have the rarest trigram of a literal that its pattern requires, and the pattern is a column of the row that they make.
    Rules that require none meet all names, which are dealt to SALTS groups for that.
    """
    texts = cut(names.distinct())
    held = cut(with_pieces(texts.select("_s").distinct(), "_s"))
    told = rules.select("pattern", "family_id").distinct().withColumn("_l", required_literals(F.col("pattern")))
    indexed = rarest_piece(told.where("_l IS NOT NULL").select("pattern", "family_id", F.explode("_l").alias("_l")), "_l", held).select("pattern", "family_id", "_p").distinct()
    met = held.join(indexed, "_p").where(F.expr("_s RLIKE pattern")).select("_s", "family_id")
    dealt = texts.select("_s").distinct().withColumn("_salt", F.pmod(F.xxhash64("_s"), F.lit(SALTS)).cast("int"))
    free = told.where("_l IS NULL").select("pattern", "family_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    every = met.unionByName(dealt.join(free, "_salt").where(F.expr("_s RLIKE pattern")).select("_s", "family_id")).distinct()
    return texts.join(every, "_s").select(*key, "family_id").distinct()


def assign_families(concepts: DataFrame, catalog: DataFrame, rules: DataFrame | None = None, scope: Sequence[str] = ("doc_id",), keep: int = 2) -> DataFrame:
    """scope, concept, family_id, source, confidence, rank: up to `keep` families of each concept.

    An alias equal to the name gives 1.0; without one, an alias of two words or more inside the name or a
    term gives 0.9, a controlled pattern inside the name 0.8; a rule (pattern, family_id) that matches the name
    gives 0.95 besides. Phrases meet by an equality join on runs of words, not by comparing all with all.
    """
    key = [*scope, "concept"]
    names = concepts.select(*key, "terminology", surface(F.col("concept")).alias("_s"))
    alias = catalog.select("family_id", F.explode(F.array_union(F.array("label"), "aliases")).alias("a")).select("family_id", surface(F.col("a")).alias("_g")).where("_g <> ''").distinct()
    alias = maybe_broadcast(alias)
    exact = names.select(*key, F.col("_s").alias("_g")).join(alias, "_g").select(*key, "family_id", F.lit("alias_match").alias("source"), F.lit(1.0).alias("confidence"))
    longest = alias.agg(F.max(F.size(F.split("_g", " ")))).first()[0] or 1
    rest = names.join(exact.select(*key).distinct(), key, "left_anti")
    texts = rest.select(*key, F.explode(F.array_union(F.array("_s"), F.transform(F.coalesce("terminology", F.array().cast("array<string>")), surface))).alias("_t"))
    phrase = texts.select(*key, F.explode(ngrams(F.col("_t"), 2, max(2, longest))).alias("_g")).join(alias, "_g").select(*key, "family_id", F.lit("phrase_match_strong").alias("source"), F.lit(0.9).alias("confidence"))
    pattern = catalog.select("family_id", F.explode("controlled_patterns").alias("p")).select("family_id", surface(F.col("p")).alias("_g")).where("_g <> ''").distinct()
    width = pattern.agg(F.max(F.size(F.split("_g", " ")))).first()[0] or 1
    controlled = rest.select(*key, F.explode(ngrams(F.col("_s"), 1, width)).alias("_g")).join(maybe_broadcast(pattern), "_g").select(*key, "family_id", F.lit("controlled_pattern_match").alias("source"), F.lit(0.8).alias("confidence"))
    best = lambda of: Window.partitionBy(*key, *of).orderBy(F.desc("confidence"), "family_id", "_first")
    ranked = lambda df, of, n: df.withColumn("_n", F.row_number().over(best(of))).where(F.col("_n") <= n).drop("_n")
    partial = ranked(ranked(phrase.unionByName(controlled).withColumn("_first", F.lit(0)), ["family_id"], 1), [], 2)
    found = exact.withColumn("_first", F.lit(0)).unionByName(partial)
    if rules is not None:
        hits = rule_hits(names.select(*key, "_s"), rules, key)
        found = found.unionByName(hits.select(*key, "family_id", F.lit("hybrid_rule").alias("source"), F.lit(0.95).alias("confidence"), F.lit(1).alias("_first")))
    once = found.withColumn("_n", F.row_number().over(Window.partitionBy(*key, "family_id").orderBy("_first", F.desc("confidence")))).where("_n = 1").drop("_n")
    out = once.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("confidence"), "family_id")))
    return out.where(F.col("rank") <= keep).select(*key, "family_id", "source", "confidence", "rank")


def family_members(assigned: DataFrame, catalog: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, family_id, label, members in order of name."""
    own = assigned.groupBy(*scope, "family_id").agg(F.sort_array(F.collect_set("concept")).alias("members"))
    return own.join(catalog.select("family_id", "label"), "family_id", "left").select(*scope, "family_id", F.coalesce("label", "family_id").alias("label"), "members")


def unassigned_concepts(concepts: DataFrame, assigned: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    key = [*scope, "concept"]
    return concepts.select(*key).join(assigned.select(*key).distinct(), key, "left_anti")

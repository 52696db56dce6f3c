"""Page cleaning: from raw page text to a document without running headers, page numbers and wrapped lines.

Pages are rows (doc_id, page_index, raw_text). The rules on one page are column expressions; running lines
are counted over a document's pages from at most six lines of each, so no page's text is shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.lineage import cut
from foliospark.functions.pages import sums_before
from foliospark.functions.textnorm import LETTERS, let, strip

SPACE_RUN = r"[ \t\f\x0B]+"
HYPHEN = rf"([{LETTERS}])-\s*\n\s*([{LETTERS}])"
#: A newline inside a paragraph, after a line that doesn't end a sentence and before one that goes on.
WRAP = r"([^.!?;:\n])\n(?=[a-zà-öø-ÿ0-9(\[{\"'“‘])"
ZONE_DEPTH, MIN_REPEATS = 3, 5
#: Groups that a book's pages are dealt to, each with a copy of the book's running lines.
SHARES = 16


def normalize_page_text(text: Column) -> Column:
    """One kind of newline, single spaces, none at line ends, at most one blank line."""
    text = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    text = F.rtrim(F.replace(F.regexp_replace(text, SPACE_RUN, " "), F.lit(" \n"), F.lit("\n")))
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def dehyphenate(text: Column) -> Column:
    """Words that a hyphen and a newline cut are put together."""
    return F.regexp_replace(text, HYPHEN, "$1$2")


def merge_wrapped_lines(text: Column) -> Column:
    """Lines that go on within a paragraph are joined by a space."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"(^|\n) +", "$1"), WRAP, "$1 "), r"\n{3,}", "\n\n")


def clean_page_text(pages: DataFrame) -> DataFrame:
    """pages with clean_text, dehyphenation_count and line_merge_count; no shuffle."""
    normal = pages.withColumn("_n", normalize_page_text(F.coalesce("raw_text", F.lit(""))))
    whole = normal.withColumn("dehyphenation_count", F.regexp_count("_n", F.lit(HYPHEN))).withColumn("_n", dehyphenate(F.col("_n")))
    merges = F.regexp_count(F.regexp_replace("_n", r"(^|\n) +", "$1"), F.lit(WRAP))
    return whole.withColumn("line_merge_count", merges).withColumn("clean_text", merge_wrapped_lines(F.col("_n"))).drop("_n")


def line_key(line: Column) -> Column:
    """What makes two running lines the same: small letters, single spaces, any number."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(line)), SPACE_RUN, " "), "[0-9]+", "<num>")


def full_lines(text: str) -> Column:
    """Indices of the lines that aren't blank."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.when(F.trim(x) != "", i)), lambda i: i.isNotNull())


def zone(indices: Column, depth: int, top: bool) -> Column:
    return F.slice(indices, 1, depth) if top else F.slice(indices, F.greatest(F.size(indices) - depth + 1, F.lit(1)), depth)


def detect_running_lines(pages: DataFrame, zone_depth: int = ZONE_DEPTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """doc_id, key, place (top or bottom), pages: keys on min_repeats pages or more of a zone, and on more than of the other."""
    one = pages.select("doc_id", F.split("clean_text", "\n").alias("ls"), full_lines("clean_text").alias("at"))
    keys = [F.array_distinct(F.transform(zone(F.col("at"), zone_depth, top), lambda i: F.struct(line_key(F.get("ls", i)).alias("key"), F.lit(int(top)).alias("top")))) for top in (True, False)]
    seen = one.select("doc_id", F.inline(F.concat(*keys))).where("key <> ''")
    counted = seen.groupBy("doc_id", "key").agg(F.sum("top").alias("top"), F.sum(1 - F.col("top")).alias("bottom"))
    place = F.when((F.col("top") >= min_repeats) & (F.col("top") > F.col("bottom")), "top").when((F.col("bottom") >= min_repeats) & (F.col("bottom") > F.col("top")), "bottom")
    return counted.select("doc_id", "key", place.alias("place"), F.greatest("top", "bottom").alias("pages")).where("place IS NOT NULL")


def remove_running_lines(pages: DataFrame, keys: DataFrame, zone_depth: int = ZONE_DEPTH) -> DataFrame:
    """pages without running lines in their zones and without page numbers, with the counts of each.

    A book's pages, with their text, don't meet in one task: they are dealt to SHARES groups by their number and text.
    """
    sets = keys.groupBy("doc_id").agg(*[F.collect_set(F.when(F.col("place") == p, F.col("key"))).alias(f"_{p}") for p in ("top", "bottom")])
    dealt = F.pmod(F.xxhash64(*[c for c in ("page_index", "clean_text") if c in pages.columns]), F.lit(SHARES)).cast("int")
    shares = sets.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    one = pages.withColumn("_share", dealt).join(shares, ["doc_id", "_share"], "left").drop("_share")
    none = F.array().cast("array<string>")

    def mark(z: Column, x: Column, i: Column) -> Column:
        inside = {p: F.array_contains(z[p], i) & F.array_contains(F.coalesce(F.col(f"_{p}"), none), line_key(x)) for p in ("top", "bottom")}
        number = F.trim(x).rlike(r"^[0-9]{1,4}$")
        return F.struct(x.alias("line"), F.when(inside["top"], "header").when(inside["bottom"], "footer").when(number, "number").alias("gone"))

    # the zones are a part of the expression: as a column of their own, a filter on clean_text would put their making into each line's test
    zones = let(full_lines("clean_text"), lambda at: F.struct(*[zone(at, zone_depth, p == "top").alias(p) for p in ("top", "bottom")]))
    marked = one.withColumn("_m", let(zones, lambda z: F.transform(F.split("clean_text", "\n"), lambda x, i: mark(z, x, i))))
    count = lambda kind: F.size(F.filter("_m", lambda m: m["gone"] == kind))
    kept = F.array_join(F.transform(F.filter("_m", lambda m: m["gone"].isNull()), lambda m: m["line"]), "\n")
    return marked.withColumns(
        {"removed_header_lines": count("header"), "removed_footer_lines": count("footer"), "removed_page_numbers": count("number"), "clean_text": strip(F.regexp_replace(kept, r"\n{3,}", "\n\n"))}
    ).drop("_top", "_bottom", "_m")


def clean_pages(pages: DataFrame) -> DataFrame:
    """All page rules, in their order."""
    first = cut(clean_page_text(pages))  # read twice: for the keys, and to remove their lines
    return remove_running_lines(first, detect_running_lines(first))


def assemble_documents(pages: DataFrame) -> DataFrame:
    """doc_id, text: the pages that aren't blank in order, with a blank line between."""
    full = pages.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.when(F.col("clean_text") != "", F.struct("page_index", "clean_text")))).alias("p"))
    return full.select("doc_id", F.array_join(F.transform("p", lambda p: p["clean_text"]), "\n\n").alias("text"))


def page_units(pages: DataFrame) -> DataFrame:
    """doc_id, page, start_char, end_char of each page in the assembled text; a book's pages are summed over in ranges, by their sizes alone."""
    sizes = pages.select("doc_id", F.col("page_index").alias("page"), F.length("clean_text").alias("_n")).where("_n > 0").withColumn("_step", (F.col("_n") + 2).cast("long"))
    return sums_before(sizes, ["doc_id"], ["page"], "_step").select("doc_id", "page", F.col("before").alias("start_char"), (F.col("before") + F.col("_n")).alias("end_char"))


def extraction_diagnostics(pages: DataFrame) -> DataFrame:
    """One row a document: the sums of the page rules' counts, densities, and why it can't be used (the first reason)."""
    size = F.length("clean_text")
    alpha = size - F.length(F.regexp_replace("clean_text", f"[{LETTERS}]+", ""))  # runs are deleted: a match each would be a string each
    counts = ("dehyphenation_count", "line_merge_count", "removed_header_lines", "removed_footer_lines", "removed_page_numbers")
    sums = pages.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("page_count"), F.sum((F.col("clean_text") == "").cast("long")).alias("empty_page_count"), F.sum(F.length("raw_text")).alias("raw_char_count"), F.sum(size).alias("clean_char_count"),
        F.sum(alpha).alias("_alpha"), *[F.sum(c).alias(c) for c in counts],
    )
    density = F.when(F.col("clean_char_count") > 0, F.col("_alpha") / F.col("clean_char_count")).otherwise(F.lit(0.0))
    empty = F.col("empty_page_count") / F.col("page_count")
    reason = (
        F.when(F.col("clean_char_count") < 20, "clean_char_count below minimum threshold")
        .when(empty > 0.98, "empty_page_ratio above maximum threshold")
        .when(F.col("alpha_density") < 0.05, "alpha_density below minimum threshold")
    )
    return sums.withColumn("alpha_density", density).withColumn("unusable_reason", reason).withColumn("is_usable", F.col("unusable_reason").isNull()).drop("_alpha")


def filter_usable(documents: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """documents with an empty text where the diagnostics find a document unusable."""
    found = diagnostics.select("doc_id", F.col("is_usable").alias("_ok"))
    text = F.when(F.coalesce("_ok", F.lit(True)), F.col("text")).otherwise("")
    return documents.join(found, "doc_id", "left").withColumn("text", text).drop("_ok")

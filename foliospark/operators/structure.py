"""Headings, sections and the document map of a text.

Documents are rows (doc_id, text). Lines are taken apart inside the row, so only heading candidates and
sections are ever shuffled, by doc_id. Offsets count code points from 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from foliospark.functions.lineage import cut, small_batches
from foliospark.functions.spans import taken
from foliospark.functions.textnorm import any_of, is_title_case, lines_of, squeeze, strip

MIN_SCORE = 0.55
#: The patterns of headings, with their scores.
ROMAN, DECIMAL = r"(?:[IVXLCDM]+)", r"(?:[0-9]+(?:\.[0-9]+)*)"
RULES = (
    ("chapter_pattern", r"(?i)^(?:chapter|capitulo|cap[íi]tulo)\s+.+$", 0.95),
    ("part_pattern", r"(?i)^(?:part)\s+.+$", 0.9),
    ("appendix_pattern", r"(?i)^(?:appendix)\s+.+$", 0.9),
    ("bibliography_pattern", r"(?i)^(?:bibliography|references|works cited)$", 0.9),
    ("index_pattern", r"(?i)^(?:index)$", 0.9),
    ("roman_numeral", rf"^{ROMAN}(?:[\.\):])?\s+[A-Za-z].+$", 0.8),
    ("decimal_numbering", rf"^{DECIMAL}(?:[\.\):])?\s+[A-Za-z].+$", 0.8),
)
#: The section type of a pattern, words that make a title a section, types that support neighbours.
TYPE_OF = {"chapter_pattern": "chapter", "part_pattern": "chapter", "appendix_pattern": "appendix", "bibliography_pattern": "bibliography", "index_pattern": "index", "roman_numeral": "section", "decimal_numbering": "section"}
SOFT_WORDS = ("abstract", "conclusion", "example", "examples", "exercise", "exercises", "glossary", "introduction", "overview", "preface", "prologue", "review", "summary")
TYPES = ("front_matter", "chapter", "section", "appendix", "bibliography", "index", "unknown")
SUPPORTING = ("chapter", "section", "appendix", "front_matter")
#: Words that keep a line from being an index entry, and words of a table of contents.
HEADING_WORDS = ("chapter", "part", "appendix", "bibliography", "references", "index", "section")
CONTENTS_WORDS = ("chapter", "part", "appendix", "contents")
PAGE_REFS = r"(?:\s|,)[0-9]+(?:[-–][0-9]+)?(?:\s*,\s*[0-9]+(?:[-–][0-9]+)?)*\.?$"


def looks_like_index_entry(line: Column) -> Column:
    """A line of a back-of-book index: a lone capital, or words with page references at the end."""
    keyword = F.lower(line).rlike(rf"(^|[^\p{{L}}\p{{N}}_])({'|'.join(HEADING_WORDS)})($|[^\p{{L}}\p{{N}}_])")
    lone = line.rlike(r"^\p{L}{1,2}$") & (F.upper(line) == line)
    refs = line.rlike(PAGE_REFS) & (F.contains(line, F.lit(",")) | line.rlike(r"^[A-Z][A-Za-zÀ-ÖØ-öø-ÿ'’\-]+\s+[0-9]+(?:[-–][0-9]+)?$") | (F.size(F.split(squeeze(line), " ")) <= 6))
    return ~keyword & (lone | refs)


def looks_like_toc_entry(line: Column) -> Column:
    """A line of a table of contents: leaders before a number, several numbers with a keyword, or a number and capitals."""
    low, numbers = F.lower(line), F.regexp_count(line, F.lit("[0-9]+"))
    word = low.rlike(rf"(^|[^\p{{L}}\p{{N}}_])({'|'.join(CONTENTS_WORDS)})($|[^\p{{L}}\p{{N}}_])")
    ends = line.rlike(r"\s+[0-9]+\s*$") & any_of(low, CONTENTS_WORDS)
    return ((word | ends) & (numbers >= 2)) | line.rlike(r"\.{3,}\s*[0-9]+\s*$") | line.rlike(r"^[0-9]{3,}\s+[A-Z][A-Z\s\-/,:;()]{6,}$")


def uppercase_bonus(line: Column) -> Column:
    letters = F.regexp_count(line, F.lit(r"\p{L}"))
    share = F.regexp_count(line, F.lit(r"\p{Lu}")) / letters
    return F.when(letters == 0, 0.0).when(share >= 0.9, 0.25).when(share >= 0.6, 0.15).otherwise(0.05)


def heading_score(line: Column) -> Column:
    """struct(score, pattern) of a stripped line; the first of the best rules."""
    bonus = uppercase_bonus(line)
    best = F.struct(F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("pattern"))
    title = is_title_case(line) & (F.length(line) <= 80)
    found = F.when(title, F.struct((0.55 + bonus).alias("score"), F.lit("title_case_short").alias("pattern"))).otherwise(best)
    # a later rule has no higher score than an earlier one before the bonus, which is the same for all
    for name, pattern, base in reversed(RULES):
        found = F.when(line.rlike(pattern), F.struct(F.least(F.lit(1.0), base + bonus).alias("score"), F.lit(name).alias("pattern"))).otherwise(found)
    fit = (line != "") & (F.length(line) <= 120) & (title | reduce(Column.__or__, [line.rlike(p) for _, p, _ in RULES]))
    return F.when(~fit, best).when(looks_like_index_entry(line) | looks_like_toc_entry(line), best).otherwise(found)


def explode_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, start_char, end_char, line (stripped): the lines that aren't blank. Places are found in the text's own row."""
    lines = docs.select("doc_id", F.inline(lines_of(F.col("text"), lambda raw: strip(raw) != "")))
    return lines.select("doc_id", "line_no", "start_char", (F.col("start_char") + F.length("raw")).alias("end_char"), strip(F.col("raw")).alias("line"))


def fit_lines(docs: DataFrame, most: int = 120) -> DataFrame:
    """doc_id, start_char, end_char, text (stripped): the lines of 1 to `most` characters, found in one pass over a text's own row."""
    kind = StructType([docs.schema["doc_id"], *[StructField(c, IntegerType()) for c in ("start_char", "end_char")], StructField("text", StringType())])

    def lines(text: str) -> Iterator[tuple[int, int, str]]:
        at = 0
        while at <= len(text):
            end = text.find("\n", at)
            end = len(text) if end < 0 else end
            line = text[at:end].strip()
            if 0 < len(line) <= most:
                yield at, end, line
            at = end + 1

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(kind)
        for b in batches:
            yield from taken([b.column(0)], ((i, *line) for i, text in enumerate(b.column(1)) for line in lines(text.as_py() or "")), target)

    return small_batches(docs.select("doc_id", "text")).mapInArrow(each, kind)


def detect_headings(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """doc_id, index, text, start_char, end_char, score, pattern: the lines that score min_score or more, in order.

    Places are found in the text's own row, where long and blank lines are left out; lines are scored before anything is shuffled.
    """
    # the score is a generator's input: as a filter's test it becomes a method too long for the JVM to compile, and each line is scored by interpreted code
    scored = fit_lines(docs).select("*", F.inline(F.transform(F.array("text"), heading_score))).where(F.col("score") >= min_score)
    order = Window.partitionBy("doc_id").orderBy("start_char")
    found = scored.select("doc_id", "text", "start_char", "end_char", F.bround("score", 4).alias("score"), "pattern")
    return found.withColumn("index", F.row_number().over(order) - 1).select("doc_id", "index", "text", "start_char", "end_char", "score", "pattern")


def assign_pages(spans: DataFrame, units: DataFrame, at: str = "start_char", name: str = "page", nearest: bool = False) -> DataFrame:
    """spans with the page whose unit holds offset `at`; with nearest also in gaps (the page before, else the first).

    An as-of join: units and offsets of a document are put in one order, and each offset takes the last unit.
    """
    columns = spans.columns
    left = spans.select(F.struct(*columns).alias("_s"), "doc_id", F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("struct<page:long,end:long>").alias("_u"))
    right = units.select(F.lit(None).cast(left.schema["_s"].dataType).alias("_s"), "doc_id", F.col("start_char").alias("_at"), F.lit(0).alias("_kind"), F.struct(F.col("page").cast("long").alias("page"), F.col("end_char").cast("long").alias("end")).alias("_u"))
    order = Window.partitionBy("doc_id").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("doc_id").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    both = left.unionByName(right).withColumn("_l", F.last("_u", ignorenulls=True).over(order)).withColumn("_f", F.first("_u", ignorenulls=True).over(whole))
    page = F.coalesce("_l.page", "_f.page") if nearest else F.when(F.col("_at") < F.col("_l.end"), F.col("_l.page"))
    return both.where("_kind = 1").select("_s.*", page.alias(name))


def sizes_of(docs: DataFrame) -> DataFrame:
    """doc_id, _n: the length of each text that isn't empty; docs may be such a table already."""
    sizes = docs if "_n" in docs.columns else docs.select("doc_id", F.length("text").alias("_n"))
    return sizes.where("_n > 0").select("doc_id", "_n")


def segment_by_heading(headings: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, heading_index (null before the first heading), start_char, end_char: gapless segments of texts that aren't empty. docs: texts, or their sizes (sizes_of)."""
    length = sizes_of(docs)
    after = Window.partitionBy("doc_id").orderBy("start_char")
    own = headings.join(length.hint("merge"), "doc_id").select("doc_id", F.col("index").alias("heading_index"), "start_char", F.coalesce(F.lead("start_char").over(after), "_n").alias("end_char"))
    firsts = headings.groupBy("doc_id").agg(F.min("start_char").alias("_first"))
    lead = length.join(firsts.hint("merge"), "doc_id", "left").select("doc_id", F.lit(None).cast("int").alias("heading_index"), F.lit(0).alias("start_char"), F.coalesce("_first", "_n").alias("end_char"))
    return own.unionByName(lead).where("end_char > start_char")


def is_reference_like(label: Column) -> Column:
    """A bibliographic label: a year in brackets, decimal locators, lists of numbers, or mostly digits and punctuation."""
    digits = F.regexp_count(label, F.lit("[0-9]"))
    dense = (digits + F.regexp_count(label, F.lit(r"[.,;:\-–()]"))) / F.greatest(F.length(label), F.lit(1))
    listed = (F.regexp_count(label, F.lit(r"[0-9]+(?:\.[0-9]+)*(?:[-–][0-9]+)?")) >= 2) & F.contains(label, F.lit(","))
    return label.rlike(r"\(\s*(?:18|19|20)[0-9]{2}\s*\)") | label.rlike(r"[0-9]+\.[0-9]+") | listed | ((dense >= 0.22) & (digits >= 3))


def classify_headings(headings: DataFrame) -> DataFrame:
    """headings with type and confidence from pattern and words alone; null where these don't tell."""
    words = F.size(F.split(squeeze(F.col("text")), " "))
    digit = F.col("text").rlike("[0-9]")
    title = (
        F.when(is_reference_like(F.col("text")) | F.col("text").rlike("^[A-Z]$"), F.lit(None))
        .when(any_of(F.lower("text"), SOFT_WORDS), 0.68)
        .when(F.contains("text", F.lit(":")) & ~digit & words.between(2, 10), 0.62)
        .when(~digit & words.between(2, 6), 0.58)
    )
    kinds = F.create_map(*[F.lit(x) for pair in TYPE_OF.items() for x in pair])
    by_pattern = kinds[F.col("pattern")]
    confidence = F.when(by_pattern.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.6), F.col("score")))).when(F.col("pattern") == "title_case_short", title)
    return headings.withColumn("confidence", confidence).withColumn("type", F.when(F.col("confidence").isNotNull(), F.coalesce(by_pattern, F.lit("section"))))


def select_headings(headings: DataFrame, k: int = 200) -> DataFrame:
    """The k headings of each document with the highest scores, earlier ones first."""
    order = Window.partitionBy("doc_id").orderBy(F.desc("score"), "index")
    return headings.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def apply_classifications(headings: DataFrame, responses: DataFrame, k: int = 200) -> DataFrame:
    """Classified headings, with what external replies (doc_id, response: text around a JSON array) say of the k selected ones; the last of repeated entries counts."""
    items = F.from_json(F.regexp_extract("response", r"(?s)\[.*\]", 0), "array<struct<index:int,type:string,confidence:double>>")
    said = responses.select("doc_id", F.posexplode(items).alias("_at", "_i")).where("_i.index IS NOT NULL")
    low = F.lower(F.trim("_i.type"))
    last = said.groupBy("doc_id", F.col("_i.index").alias("index")).agg(F.max_by(F.struct(F.when(low.isin(*TYPES), low).otherwise("unknown").alias("t"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("_i.confidence", F.lit(0.0)))).alias("c")), "_at").alias("_said"))
    last = last.join(select_headings(headings, k).select("doc_id", "index"), ["doc_id", "index"], "left_semi")
    both = headings.join(last, ["doc_id", "index"], "left")
    return both.withColumn("type", F.coalesce("_said.t", "type")).withColumn("confidence", F.coalesce("_said.c", "confidence")).drop("_said")


#: Headings of a block of a document, whose steps are composed to one.
BLOCK = 256


def step_of(state: Column, row: Column) -> Column:
    """The state after a heading, from the one before: twice whether the heading before supports its neighbours, and whether this one does."""
    before, two_before = state.bitwiseAND(1), F.shiftright(state, 1)
    promoted = ((before * row["near_1"] + two_before * row["near_2"] + row["ahead"]) > 0).cast("int")
    return before * 2 + F.when(row["free"], promoted).otherwise(row["supports"])


def composed(rows: Column) -> Column:
    """The steps of all rows as one map of four states to four, two bits each."""
    at = lambda map_, s: F.shiftright(map_, 2 * s).bitwiseAND(3)
    every = F.lit(0b11100100)  # each state to itself
    return F.aggregate(rows, every, lambda map_, r: sum((F.shiftleft(step_of(at(map_, s), r), 2 * s) for s in range(4)), F.lit(0)))


def promote_by_context(headings: DataFrame) -> DataFrame:
    """Classified headings, with titles that aren't classified promoted to sections beside classified ones.

    In order of place: each heading looks at two on both sides (on pages at most two away, or unknown);
    those promoted before it count. One neighbour gives 0.52, more 0.6. headings needs page, which may be null.

    What a heading becomes depends on the two before it only, so its step is a map of four states. The steps of a block of
    headings are composed to one map; a document's short list of these gives the state that each block begins in; then
    each block is gone through alone.
    """
    names = ["doc_id", "index", "text", "start_char", "end_char", "page", "score", "pattern", "type", "confidence"]
    text = F.lower(strip(F.col("text")))
    fit = (F.col("pattern") == "title_case_short") & ~text.isin("unknown", "section", "") & ~F.col("text").rlike(r"^\p{Lu}$") & ~is_reference_like(F.col("text"))
    order = Window.partitionBy("doc_id").orderBy("start_char", "end_char", "index")
    near = lambda page: F.coalesce(F.abs(F.col("page") - page) <= 2, F.lit(True)).cast("int")
    ahead = sum((F.coalesce(F.lead(F.col("type").isin(*SUPPORTING), n).over(order).cast("int"), F.lit(0)) * near(F.lead("page", n).over(order)) for n in (1, 2)), F.lit(0))
    flags = {"free": F.coalesce(fit, F.lit(False)) & F.col("type").isNull(), "supports": F.coalesce(F.col("type").isin(*SUPPORTING), F.lit(False)).cast("int"), "ahead": ahead, **{f"near_{n}": near(F.lag("page", n).over(order)) for n in (1, 2)}}
    ready = headings.select(*names).withColumns({"at": F.row_number().over(order) - 1, **flags}).withColumn("blk", F.floor(F.col("at") / BLOCK).cast("int"))
    blocks = cut(ready.groupBy("doc_id", "blk").agg(F.sort_array(F.collect_list(F.struct("at", *flags, *[c for c in names if c != "doc_id"]))).alias("rows")))

    maps = blocks.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("blk", composed(F.col("rows")).alias("map")))).alias("m"))
    begun = F.aggregate("m", F.array(F.lit(0)), lambda states, x: F.concat(states, F.array(F.call_function("shiftright", x["map"], F.element_at(states, -1) * 2).bitwiseAND(3))))
    starts = maps.select("doc_id", F.posexplode(begun).alias("blk", "state"))
    gone = F.aggregate("rows", F.array("state"), lambda states, r: F.concat(states, F.array(step_of(F.element_at(states, -1), r))))
    done = blocks.join(starts.hint("merge"), ["doc_id", "blk"]).withColumn("states", gone)
    # the state before a row says what its neighbours before it are
    out = done.select("doc_id", F.inline(F.arrays_zip("rows", F.slice("states", F.lit(1), F.size("rows")).alias("before")))).select("doc_id", "rows.*", "before")
    found = F.col("before").bitwiseAND(1) * F.col("near_1") + F.shiftright("before", 1) * F.col("near_2") + F.col("ahead")
    won = F.col("free") & (found > 0)
    return out.withColumns({"type": F.when(won, "section").otherwise(F.col("type")), "confidence": F.when(won, F.when(found == 1, 0.52).otherwise(0.6)).otherwise(F.col("confidence"))}).select(*names)


def normalize_sections(segments: DataFrame, docs: DataFrame, max_size: int = 200_000) -> DataFrame:
    """Sections that cover each text once: overlaps are cut at the furthest end before, gaps become unknown, large ones are divided.

    segments: doc_id, label, type, start_char, end_char, confidence. docs: texts, or their sizes (sizes_of).
    """
    length = sizes_of(docs)
    before = Window.partitionBy("doc_id").orderBy("start_char", "end_char").rowsBetween(Window.unboundedPreceding, -1)
    order = Window.partitionBy("doc_id").orderBy("start_char", "end_char")
    cut = segments.join(length.hint("merge"), "doc_id").withColumn("end_char", F.least("end_char", "_n"))
    cut = cut.withColumn("_cursor", F.coalesce(F.max("end_char").over(before), F.lit(0))).withColumn("start_char", F.greatest("start_char", "_cursor")).where("end_char > start_char")
    cut = cut.withColumn("_cursor", F.coalesce(F.max("end_char").over(before), F.lit(0)))
    own = cut.select("doc_id", "label", "type", "start_char", "end_char", "confidence")
    unknown = [F.lit("unknown").alias("label"), F.lit("unknown").alias("type")]
    gaps = cut.where("start_char > _cursor").select("doc_id", *unknown, F.col("_cursor").alias("start_char"), F.col("start_char").alias("end_char"), F.lit(0.0).alias("confidence"))
    ends = cut.groupBy("doc_id").agg(F.max("end_char").alias("_end"))
    tails = length.join(ends.hint("merge"), "doc_id", "left").select("doc_id", *unknown, F.coalesce("_end", F.lit(0)).alias("start_char"), F.col("_n").alias("end_char"), F.lit(0.0).alias("confidence")).where("end_char > start_char")
    all_ = own.unionByName(gaps).unionByName(tails).withColumn("label", F.when(F.coalesce("label", F.lit("")) == "", "unknown").otherwise(F.col("label")))
    parts = all_.withColumn("_s", F.explode(F.sequence("start_char", F.col("end_char") - 1, F.lit(max_size))))
    parts = parts.withColumn("end_char", F.least(F.col("_s") + max_size, "end_char")).withColumn("start_char", F.col("_s")).drop("_s")
    confidence = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce("confidence", F.lit(0.0))))
    return parts.select("doc_id", (F.row_number().over(order) - 1).alias("section_index"), F.concat(F.lit("section_"), F.col("start_char").cast("string")).alias("id"), "label", F.coalesce("type", F.lit("unknown")).alias("type"), "start_char", "end_char", confidence.alias("confidence"))


def build_document_map(docs: DataFrame, units: DataFrame | None = None, responses: DataFrame | None = None, max_size: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """(headings, sections) of documents: detection, classification, promotion, full coverage, pages."""
    found = classify_headings(detect_headings(docs))
    if responses is not None:
        found = apply_classifications(found, responses)
    paged = assign_pages(found, units) if units is not None else found.withColumn("page", F.lit(None).cast("long"))
    headings = cut(promote_by_context(paged))
    named = headings.select("doc_id", F.col("index").alias("heading_index"), F.col("text").alias("label"), "type", "confidence")
    sizes = cut(sizes_of(docs))  # read thrice, while texts are read for their lines and their sizes only
    segments = segment_by_heading(headings, sizes).join(named.hint("merge"), ["doc_id", "heading_index"], "left")
    sections = normalize_sections(segments.drop("heading_index"), sizes, max_size)
    if units is None:
        none = F.lit(None).cast("long")
        return headings, sections.withColumns({"start_page": none, "end_page": none})
    last = assign_pages(sections.withColumn("_last", F.col("end_char") - 1), units, "_last", "end_page", True).drop("_last")
    return headings, assign_pages(last, units, "start_char", "start_page", True)


def document_map_stats(headings: DataFrame, sections: DataFrame) -> DataFrame:
    """doc_id, heading_candidates, classified_headings, sections_generated, unknown_sections."""
    h = headings.groupBy("doc_id").agg(F.count(F.lit(1)).alias("heading_candidates"), F.count("type").alias("classified_headings"))
    s = sections.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sections_generated"), F.count(F.when(F.col("type") == "unknown", 1)).alias("unknown_sections"))
    return s.join(h.hint("merge"), "doc_id", "left").na.fill(0, ["heading_candidates", "classified_headings"]).select("doc_id", "heading_candidates", "classified_headings", "sections_generated", "unknown_sections")


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def clean_sections(sections: DataFrame) -> DataFrame:
    """Sections with squeezed labels, lone letters of an index put to their neighbours, and missing pages filled from these.

    A lone capital of unknown type joins an unknown section before it, or an index entry after it. Pages
    are filled in order, so that one filled before counts. A section's first page is its own, else the last page before it, else the first one
    after it; its last page is its own, else the first one after it, else its first. So a last page without a first page beside it is the largest
    since the last first page that is given.
    """
    label = F.coalesce(F.nullif(squeeze(F.col("label")), F.lit("")), F.lit("unknown"))
    order = Window.partitionBy("doc_id").orderBy("start_char")
    so_far, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    unknown = F.col("type") == "unknown"
    marked = sections.withColumn("label", label).withColumns({"_lone": F.coalesce(F.col("label").rlike("^[A-Z]$") & unknown, F.lit(False)), "_entry": F.coalesce((F.length("label") > 2) & F.col("label").rlike("^.+" + PAGE_REFS) & unknown, F.lit(False))})
    joins = F.coalesce(F.col("_lone") & (F.lag("type").over(order) == "unknown"), F.lit(False))
    islands = marked.withColumn("_joins", joins).withColumn("_island", F.count_if(~F.col("_joins")).over(so_far))
    island = Window.partitionBy("doc_id", "_island").orderBy("start_char").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    joined = islands.withColumns({"end_char": F.last("end_char").over(island), "end_page": F.last("end_page").over(island)}).where("NOT _joins")
    taken = joined.withColumns({"_takes": F.col("_entry") & F.coalesce(F.lag("_lone").over(order), F.lit(False)), "_from": F.lag("start_char").over(order), "_page": F.lag("start_page").over(order)}).withColumn("_gone", F.col("_lone") & F.coalesce(F.lead("_takes").over(order), F.lit(False)))
    kept = taken.where("NOT _gone").withColumns({"start_char": F.when(F.col("_takes"), F.col("_from")).otherwise(F.col("start_char")), "start_page": F.when(F.col("_takes"), F.coalesce("_page", "start_page")).otherwise(F.col("start_page"))})

    after = F.lead("start_page").over(order)
    known = kept.withColumn("_after", after).withColumns({"_x": F.coalesce("end_page", "_after", "start_page"), "_given": F.count("start_page").over(so_far)})
    last = F.when(F.col("start_page").isNotNull(), F.greatest("_x", "start_page")).when(F.max("_x").over(before).isNull(), F.greatest("_x", "_after")).otherwise(F.col("_x"))
    ended = known.withColumn("_last", last).withColumn("_end", F.max("_last").over(Window.partitionBy("doc_id", "_given").orderBy("start_char").rowsBetween(Window.unboundedPreceding, 0)))
    first = F.coalesce("start_page", F.lag("_end").over(order), "_after")
    out = ended.withColumns({"start_page": first, "end_page": F.col("_end"), "section_index": F.row_number().over(order) - 1})
    return out.select("doc_id", "section_index", F.concat(F.lit("section_"), F.col("start_char").cast("string")).alias("id"), "label", "type", "start_char", "end_char", "confidence", "start_page", "end_page")


def validate_document_map(headings: DataFrame, sections: DataFrame, docs: DataFrame, max_size: int = 200_000, maps: DataFrame | None = None) -> DataFrame:
    """doc_id, rule, detail: what breaks the map's rules; no rows if it is sound. maps (doc_id, text_hash): the hashes that the maps were made with."""
    n = docs.select("doc_id", F.length("text").alias("_n"))
    s, h = sections.join(n.hint("merge"), "doc_id"), headings.join(n.hint("merge"), "doc_id")
    order = Window.partitionBy("doc_id").orderBy("start_char", "section_index")
    seq = s.withColumns({"_no": F.row_number().over(order) - 1, "_before": F.lag("end_char", 1, 0).over(order)})
    last = s.groupBy("doc_id").agg(F.max_by("end_char", "start_char").alias("_end"), F.first("_n").alias("_n"))
    broken = lambda df, rule, when, detail: df.where(when).select("doc_id", F.lit(rule).alias("rule"), F.expr(detail).cast("string").alias("detail"))
    parts = [
        broken(h, "heading_offsets", "start_char < 0 OR end_char > _n OR end_char <= start_char", "index"),
        broken(h, "heading_score", "score < 0 OR score > 1", "index"),
        broken(h.groupBy("doc_id", "index").count(), "heading_repeated", "count > 1", "index"),
        broken(seq, "section_index", "section_index <> _no", "section_index"),
        broken(seq, "section_coverage", "start_char <> _before", "section_index"),
        broken(seq, "section_offsets", "start_char < 0 OR end_char <= start_char OR end_char > _n", "section_index"),
        broken(seq, "section_size", f"end_char - start_char > {max_size}", "section_index"),
        broken(seq, "section_confidence", "confidence < 0 OR confidence > 1", "section_index"),
        broken(seq, "section_id", "id <> concat('section_', start_char)", "section_index"),
        broken(seq, "section_label", "coalesce(label, '') = ''", "section_index"),
        broken(seq, "section_pages", "start_page > end_page", "section_index"),
        broken(last, "section_end", "_end <> _n", "_end"),
        broken(n.join(sections.select("doc_id").distinct().hint("merge"), "doc_id", "left_anti"), "section_missing", "_n > 0", "_n"),
    ]
    if maps is not None:
        hashed = docs.select("doc_id", text_hash(F.col("text")).alias("_own")).join(maps.select("doc_id", "text_hash").hint("merge"), "doc_id", "left")
        parts.append(broken(hashed, "text_hash", "text_hash IS NULL OR text_hash <> _own", "text_hash"))
    return reduce(DataFrame.unionByName, parts)


#: What a map says of the way it was made.
VERSION, GENERATOR = "1.0", "foliospark"


def document_maps(docs: DataFrame, headings: DataFrame, sections: DataFrame, version: str = VERSION, generator: str = GENERATOR) -> DataFrame:
    """doc_id, version, generator, text_hash, normalized_text_length, sections, headings, stats: one row a document; docs may have source_fingerprint.

    Sections are in the order of their places, headings in that of their index; a document without any has empty arrays.
    """
    gather = lambda df, first: df.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(first, *[c for c in df.columns if c not in ("doc_id", first)]))).alias("x"))
    own, told = gather(sections, "section_index").withColumnRenamed("x", "sections"), gather(headings, "index").withColumnRenamed("x", "headings")
    fingerprint = F.col("source_fingerprint") if "source_fingerprint" in docs.columns else F.lit(None).cast("string")
    one = docs.select("doc_id", F.lit(version).alias("version"), F.lit(generator).alias("generator"), text_hash(F.coalesce("text", F.lit(""))).alias("text_hash"), fingerprint.alias("source_fingerprint"), F.length(F.coalesce("text", F.lit(""))).alias("normalized_text_length"))
    full = one.join(own, "doc_id", "left").join(told, "doc_id", "left")
    full = full.withColumns({c: F.coalesce(c, F.array().cast(dict(full.dtypes)[c])) for c in ("sections", "headings")})
    return full.withColumn("stats", map_stats(F.col("headings"), F.col("sections")))


def map_stats(headings: Column, sections: Column) -> Column:
    return F.struct(
        F.size(headings).alias("heading_candidates"), F.size(F.filter(headings, lambda h: h["type"].isNotNull())).alias("classified_headings"),
        F.size(sections).alias("sections_generated"), F.size(F.filter(sections, lambda s: s["type"] == "unknown")).alias("unknown_sections"),
    )


def clean_maps(maps: DataFrame) -> DataFrame:
    """maps with their sections cleaned (clean_sections) and counted anew."""
    flat = maps.select("doc_id", F.inline("sections"))
    cleaned = clean_sections(flat)
    kind = dict(maps.dtypes)["sections"]
    columns = [c for c in flat.columns if c != "doc_id"]
    own = cleaned.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("_s"))
    out = maps.join(own, "doc_id", "left").withColumn("sections", F.coalesce(F.col("_s").cast(kind), F.array().cast(kind))).drop("_s")
    counted = F.struct(F.col("stats.heading_candidates").alias("heading_candidates"), F.col("stats.classified_headings").alias("classified_headings"), *[map_stats(F.col("headings"), F.col("sections"))[c].alias(c) for c in ("sections_generated", "unknown_sections")])
    return out.withColumn("stats", counted)

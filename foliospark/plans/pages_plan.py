"""Page cleaning and structure over `documents`: a source is a book, its documents are pages with added noise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.lineage import cut
from foliospark.operators import chunking as K
from foliospark.operators import pages as P
from foliospark.operators import structure as S
from foliospark.sources.tables import read_table, spread


def raw_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages with a running header, a page number, cut words and wrapped lines."""
    noisy = F.replace(F.replace("text", F.lit("tion"), F.lit("ti-\non")), F.lit(". "), F.lit(".\r\n\n\n\n"))
    wrapped = F.regexp_replace(noisy, " th", " \t\nth")
    raw = F.concat(F.lit("Volume "), "source", F.lit("\n"), wrapped, F.lit("\n"), (F.col("doc_id") % 10000).cast("string"))
    docs = spread(read_table(spark, d, "documents").select("doc_id", "source", "text"))
    return docs.select(F.col("source").alias("doc_id"), F.col("doc_id").alias("page_index"), raw.alias("raw_text"))


def page_text(spark: SparkSession, d: str) -> DataFrame:
    return P.clean_page_text(raw_pages(spark, d)).select("doc_id", "page_index", "clean_text", "dehyphenation_count", "line_merge_count")


def running_lines(spark: SparkSession, d: str) -> DataFrame:
    return P.detect_running_lines(P.clean_page_text(raw_pages(spark, d)))


def clean_pages(spark: SparkSession, d: str) -> DataFrame:
    return P.clean_pages(raw_pages(spark, d)).select("doc_id", "page_index", "clean_text", "removed_header_lines", "removed_footer_lines", "removed_page_numbers")


def assembled_books(spark: SparkSession, d: str) -> DataFrame:
    text = P.assemble_documents(P.clean_pages(raw_pages(spark, d)))
    return text.select("doc_id", F.length("text").cast("long").alias("chars"), S.text_hash(F.col("text")).alias("text_hash"))


def page_units(spark: SparkSession, d: str) -> DataFrame:
    return P.page_units(P.clean_pages(raw_pages(spark, d)))


def extraction_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    return P.extraction_diagnostics(P.clean_pages(raw_pages(spark, d)))


def books(spark: SparkSession, d: str) -> DataFrame:
    """Documents with headings of every kind around their text."""
    n = (F.col("doc_id") % 9 + 1).cast("string")
    text = F.concat(F.lit("Preface\nCHAPTER "), n, F.lit(" Opening\n"), "text", F.lit("\nII. Second Part\n2.1 Details here\nStars ..... 12\nmoon, 12, 15\nX\nAppendix A\nThe Long Summary\n"), F.substring("text", 1, 200), F.lit("\nReferences"))
    return spread(read_table(spark, d, "documents").select("doc_id", "text")).select("doc_id", text.alias("text"))


def heading_candidates(spark: SparkSession, d: str) -> DataFrame:
    return S.detect_headings(books(spark, d)).withColumns({c: F.col(c).cast("long") for c in ("index", "start_char", "end_char")})


def heading_segments(spark: SparkSession, d: str) -> DataFrame:
    docs = books(spark, d)
    return S.segment_by_heading(S.detect_headings(docs), docs).withColumns({c: F.col(c).cast("long") for c in ("heading_index", "start_char", "end_char")})


def heading_classes(spark: SparkSession, d: str) -> DataFrame:
    found = S.classify_headings(S.detect_headings(books(spark, d)))
    return found.select("doc_id", F.col("index").cast("long").alias("index"), "type", "confidence")


def top_headings(spark: SparkSession, d: str) -> DataFrame:
    found = S.select_headings(S.detect_headings(books(spark, d)), 3)
    return found.select("doc_id", F.col("index").cast("long").alias("index"), "score")


def normalized_sections(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping segments of classified headings, put in order; 700 characters at most."""
    docs = books(spark, d)
    found = S.classify_headings(S.detect_headings(docs)).where("type IS NOT NULL")
    spans = found.select("doc_id", F.col("text").alias("label"), "type", "start_char", (F.col("start_char") + 400).alias("end_char"), "confidence")
    return S.normalize_sections(spans, docs, 700).withColumns({c: F.col(c).cast("long") for c in ("section_index", "start_char", "end_char")})


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


def page_spans(docs: DataFrame) -> DataFrame:
    """Pages of 800 characters, 200 apart, from character 100 on."""
    n = F.length("text")
    pages = docs.where(n > 100).select("doc_id", n.alias("n"), F.explode(F.sequence(F.lit(0), F.floor((n - 101) / 1000).cast("int"))).alias("k"))
    return pages.select("doc_id", (F.col("k") + 1).alias("page"), (F.col("k") * 1000 + 100).alias("start_char"), F.least(F.col("k") * 1000 + 900, F.col("n")).alias("end_char"))


def mapped(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts, their headings and sections, with pages."""
    docs = books(spark, d)
    return docs, *S.build_document_map(docs, cut(page_spans(docs)))


def document_map(spark: SparkSession, d: str) -> DataFrame:
    """Sections of every document after promotion, with their pages."""
    return longs(mapped(spark, d)[2], "section_index", "start_char", "end_char")


def document_map_problems(spark: SparkSession, d: str) -> DataFrame:
    """Maps of two sections and a heading for each document, of which many break a rule by their document's number."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    k, n = F.col("doc_id"), F.length("text")
    odd = lambda m, bad, good: F.when(k % m == 0, bad).otherwise(good)
    half = F.greatest(F.lit(1), F.floor(n / 2)).cast("int")
    first = F.struct(F.lit(0).alias("section_index"), F.lit("section_0").alias("id"), odd(7, F.lit(""), F.lit("a")).alias("label"), F.lit("section").alias("type"), F.lit(0).alias("start_char"), half.alias("end_char"), odd(11, F.lit(2.0), F.lit(1.0)).alias("confidence"), odd(23, F.lit(3), F.lit(1)).alias("start_page"), F.lit(2).alias("end_page"))
    start = (half + odd(3, F.lit(1), F.lit(0))).cast("int")
    second = F.struct(odd(29, F.lit(2), F.lit(1)).alias("section_index"), F.concat(F.lit("section_"), start + odd(31, F.lit(1), F.lit(0))).alias("id"), F.lit("b").alias("label"), F.lit("section").alias("type"), start.alias("start_char"), (n - odd(5, F.lit(1), F.lit(0))).cast("int").alias("end_char"), F.lit(1.0).alias("confidence"), F.lit(None).cast("int").alias("start_page"), F.lit(None).cast("int").alias("end_page"))
    sections = docs.where("doc_id % 37 > 0").select("doc_id", F.inline(F.array(first, second)))
    heading = F.struct(F.lit(0).alias("index"), F.lit(2).alias("start_char"), odd(13, F.lit(2), F.lit(9)).alias("end_char"), odd(17, F.lit(1.5), F.lit(1.0)).alias("score"))
    headings = docs.select("doc_id", F.inline(F.when(k % 41 == 0, F.array(heading, heading)).otherwise(F.array(heading))))
    maps = docs.select("doc_id", odd(19, F.lit("0"), S.text_hash(F.col("text"))).alias("text_hash"))
    return S.validate_document_map(headings, sections, docs, 20_000, maps)


def text_lines(spark: SparkSession, d: str) -> DataFrame:
    """The lines of every document, with their places."""
    lines = S.explode_lines(read_table(spark, d, "documents").select("doc_id", "text"))
    return lines.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("line_no", "start_char", "end_char")], "line")


def usable_texts(spark: SparkSession, d: str) -> DataFrame:
    """Every document as a book of one page: those of few letters have an empty text."""
    docs = read_table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 9 == 0, F.regexp_replace("text", "[^ .,]", "-")).when(F.col("doc_id") % 10 == 0, F.regexp_replace("text", r"[^\n]{20,}", "1234")).otherwise(F.col("text")).alias("text"))
    zero = {c: F.lit(0) for c in ("dehyphenation_count", "line_merge_count", "removed_header_lines", "removed_footer_lines", "removed_page_numbers")}
    pages = docs.select("doc_id", F.col("text").alias("raw_text"), F.col("text").alias("clean_text")).withColumns(zero)
    return P.filter_usable(docs, P.extraction_diagnostics(pages))


def cleaned_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections of which some are lone letters and index entries, and some lack a page."""
    i = F.col("section_index")
    letter = (i % 5 == 4) & (F.col("doc_id") % 2 == 0)
    odd = {"label": F.when(i % 5 == 2, "Q").when(i % 5 == 3, " moon,  12").when(letter, "R").otherwise(F.col("label")), "type": F.when((i % 5).isin(2, 3) | letter, "unknown").otherwise(F.col("type"))}
    holes = {"start_page": F.when(i % 3 == 1, F.col("start_page")), "end_page": F.when(i % 4 == 1, F.col("end_page"))}
    return longs(S.clean_sections(mapped(spark, d)[2].withColumns(odd | holes)), "section_index", "start_char", "end_char")


def overlap_chunks(spark: SparkSession, d: str) -> DataFrame:
    made = K.chunk_overlap(read_table(spark, d, "documents").select("doc_id", "text"))
    return made.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("start_char").cast("long").alias("start_char"), F.col("end_char").cast("long").alias("end_char"), "text")


def structural(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    docs, headings, sections = mapped(spark, d)
    sections = cut(sections)
    packed = cut(K.pack_atoms(K.section_atoms(docs, sections, 1400, 300, 200, ("index",)), 1400, 300))
    return docs, headings, sections, packed, K.chunk_records(packed, docs)


def structural_chunks(spark: SparkSession, d: str) -> DataFrame:
    return longs(structural(spark, d)[4], "chunk_index", "section_index", "start_char", "end_char")


def structural_chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    _, _, _, packed, chunks = structural(spark, d)
    return longs(K.chunk_stats(chunks, packed, 1400), "hard_max_chunk_size")


def chosen(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(choice, structural chunks, windows); every eleventh document's map was made from another text."""
    docs, headings, sections, _, chunks = structural(spark, d)
    quality = K.structure_quality(sections, S.document_map_stats(headings, sections), docs)
    maps = docs.select("doc_id", F.when(F.col("doc_id") % 11 == 0, "0").otherwise(S.text_hash(F.col("text"))).alias("text_hash"))
    windows = K.chunk_overlap(docs)
    return K.choose_chunking(quality, chunks, windows, 300, S.validate_document_map(headings, sections, docs, maps=maps)), chunks, windows


def chosen_chunking(spark: SparkSession, d: str) -> DataFrame:
    return chosen(spark, d)[0]


def chosen_chunks(spark: SparkSession, d: str) -> DataFrame:
    choice, chunks, windows = chosen(spark, d)
    return longs(K.chosen_chunks(cut(choice), chunks, windows), "chunk_index", "start_char", "end_char")


def section_refs(spark: SparkSession, d: str) -> DataFrame:
    """Sections that overlap each window of the text, in long form."""
    docs = books(spark, d)
    found = cut(S.classify_headings(S.detect_headings(docs)))
    named = found.select("doc_id", F.col("index").alias("heading_index"), F.col("text").alias("label"), F.coalesce("type", F.lit("unknown")).alias("type"))
    spans = S.segment_by_heading(found, docs).join(named, ["doc_id", "heading_index"]).withColumn("section_index", F.col("heading_index"))
    chunks = K.chunk_overlap(docs).select("doc_id", "chunk_index", "start_char", "end_char", F.lit(-1).alias("section_index"))
    refs = K.chunk_section_refs(chunks, spans.drop("heading_index"))
    return refs.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.inline("section_refs")).select("doc_id", "chunk_index", F.col("start_char").cast("long").alias("start_char"), "label", "type")


L = "A-Za-zÀ-ÖØ-öø-ÿ"
HYPHEN = rf"([{L}])-\s*\n\s*([{L}])"
RAW_SQL = r"""
WITH raw AS (SELECT source AS doc_id, doc_id AS page_index, 'Volume ' || source || chr(10)
  || replace(replace(replace(text, 'tion', 'ti-' || chr(10) || 'on'), '. ', '.' || chr(13) || repeat(chr(10), 4)), ' th', ' ' || chr(9) || chr(10) || 'th')
  || chr(10) || CAST(doc_id % 10000 AS VARCHAR) AS raw_text FROM documents),
n1 AS (SELECT *, regexp_replace(rtrim(replace(regexp_replace(replace(replace(raw_text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \t\f\x0B]+', ' ', 'g'), ' ' || chr(10), chr(10)), ' '), '\n{3,}', chr(10) || chr(10), 'g') AS t FROM raw),
n2 AS (SELECT *, len(regexp_extract_all(t, 'HYPHEN')) AS dehyphenation_count, string_split(regexp_replace(regexp_replace(t, 'HYPHEN', '\1\2', 'g'), '(^|\n) +', '\1', 'g'), chr(10)) AS ls FROM n1),
n3 AS (SELECT *, [i > 1 AND ls[i - 1] <> '' AND NOT regexp_matches(ls[i - 1], '[.!?;:]$') AND regexp_matches(ls[i], '^[a-zà-öø-ÿ0-9(\[{"''“‘]') FOR i IN range(1, len(ls) + 1)] AS joins FROM n2),
pages AS (SELECT doc_id, page_index, raw_text, CAST(dehyphenation_count AS INTEGER) AS dehyphenation_count, CAST(len([j FOR j IN joins IF j]) AS INTEGER) AS line_merge_count,
  regexp_replace(array_to_string([(CASE WHEN i = 1 THEN '' WHEN joins[i] THEN ' ' ELSE chr(10) END) || ls[i] FOR i IN range(1, len(ls) + 1)], ''), '\n{3,}', chr(10) || chr(10), 'g') AS clean_text FROM n3),
u AS (SELECT doc_id, page_index, unnest(string_split(clean_text, chr(10))) AS line, generate_subscripts(string_split(clean_text, chr(10)), 1) AS no FROM pages),
z AS (SELECT *, regexp_replace(regexp_replace(lower(trim(line, ' ')), '[ \t\f\x0B]+', ' ', 'g'), '[0-9]+', '<num>', 'g') AS key,
  CASE WHEN trim(line, ' ') <> '' THEN row_number() OVER (PARTITION BY doc_id, page_index, trim(line, ' ') <> '' ORDER BY no) END AS top,
  CASE WHEN trim(line, ' ') <> '' THEN row_number() OVER (PARTITION BY doc_id, page_index, trim(line, ' ') <> '' ORDER BY no DESC) END AS bottom FROM u),
k AS (SELECT doc_id, key, count(DISTINCT page_index) FILTER (top <= 3) AS t, count(DISTINCT page_index) FILTER (bottom <= 3) AS b FROM z WHERE top <= 3 OR bottom <= 3 GROUP BY ALL),
keys AS (SELECT doc_id, key, CASE WHEN t >= 5 AND t > b THEN 'top' ELSE 'bottom' END AS place, greatest(t, b) AS pages FROM k WHERE (t >= 5 AND t > b) OR (b >= 5 AND b > t)),
g AS (SELECT z.*, CASE WHEN top <= 3 AND place = 'top' THEN 'header' WHEN bottom <= 3 AND place = 'bottom' THEN 'footer' WHEN regexp_matches(trim(line, ' '), '^[0-9]{1,4}$') THEN 'number' END AS gone
  FROM z LEFT JOIN keys USING (doc_id, key)),
clean AS (SELECT doc_id, page_index, regexp_replace(regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (gone IS NULL), ''), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS clean_text,
  CAST(count(*) FILTER (gone = 'header') AS INTEGER) AS removed_header_lines, CAST(count(*) FILTER (gone = 'footer') AS INTEGER) AS removed_footer_lines, CAST(count(*) FILTER (gone = 'number') AS INTEGER) AS removed_page_numbers FROM g GROUP BY ALL)
""".replace("HYPHEN", HYPHEN)

BOOK_SQL = r"""
WITH docs AS (SELECT doc_id, 'Preface' || chr(10) || 'CHAPTER ' || CAST(doc_id % 9 + 1 AS VARCHAR) || ' Opening' || chr(10) || text || chr(10) || 'II. Second Part' || chr(10) || '2.1 Details here' || chr(10)
  || 'Stars ..... 12' || chr(10) || 'moon, 12, 15' || chr(10) || 'X' || chr(10) || 'Appendix A' || chr(10) || 'The Long Summary' || chr(10) || substr(text, 1, 200) || chr(10) || 'References' AS text FROM documents),
ls AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM docs),
l AS (SELECT *, trim(raw, ' ') AS x, coalesce(sum(length(raw) + 1) OVER (PARTITION BY doc_id ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM ls),
b AS (SELECT *, len(regexp_extract_all(x, '\p{L}')) AS n, len(regexp_extract_all(x, '\p{Lu}')) AS up, lower(x) AS y FROM l WHERE x <> '' AND length(x) <= 120),
bb AS (SELECT *, CASE WHEN n = 0 THEN 0.0 WHEN up / n >= 0.9 THEN 0.25 WHEN up / n >= 0.6 THEN 0.15 ELSE 0.05 END AS bonus,
  regexp_matches(y, '(^|[^\p{L}\p{N}_])(chapter|part|appendix|bibliography|references|index|section)($|[^\p{L}\p{N}_])') AS kept,
  (regexp_matches(x, '^\p{L}{1,2}$') AND upper(x) = x) OR (regexp_matches(x, '(?:\s|,)[0-9]+(?:[-–][0-9]+)?(?:\s*,\s*[0-9]+(?:[-–][0-9]+)?)*\.?$') AND (contains(x, ',') OR len(regexp_split_to_array(x, '\s+')) <= 6)) AS entry,
  ((regexp_matches(y, '(^|[^\p{L}\p{N}_])(chapter|part|appendix|contents)($|[^\p{L}\p{N}_])') OR (regexp_matches(x, '\s[0-9]+\s*$') AND regexp_matches(y, 'chapter|appendix|part|contents'))) AND len(regexp_extract_all(x, '[0-9]+')) >= 2)
    OR regexp_matches(x, '\.{3,}\s*[0-9]+\s*$') OR regexp_matches(x, '^[0-9]{3,}\s+[A-Z][A-Z\s\-/,:;()]{6,}$') AS toc FROM b),
p AS (SELECT *, CASE WHEN (entry AND NOT kept) OR toc THEN NULL WHEN regexp_matches(x, '(?i)^(chapter|capitulo|cap[íi]tulo)\s+.+$') THEN 'chapter_pattern' WHEN regexp_matches(x, '(?i)^part\s+.+$') THEN 'part_pattern'
  WHEN regexp_matches(x, '(?i)^appendix\s+.+$') THEN 'appendix_pattern' WHEN regexp_matches(x, '(?i)^(bibliography|references|works cited)$') THEN 'bibliography_pattern' WHEN regexp_matches(x, '(?i)^index$') THEN 'index_pattern'
  WHEN regexp_matches(x, '^[IVXLCDM]+[.):]?\s+[A-Za-z].+$') THEN 'roman_numeral' WHEN regexp_matches(x, '^[0-9]+(\.[0-9]+)*[.):]?\s+[A-Za-z].+$') THEN 'decimal_numbering'
  WHEN length(x) <= 80 AND NOT regexp_matches(x, '(^|[^\p{L}])\p{Ll}') AND NOT regexp_matches(x, '\p{L}\p{Lu}') THEN 'title_case_short' END AS pattern FROM bb),
h AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS index, x AS text, CAST(s AS BIGINT) AS start_char, CAST(s + length(raw) AS BIGINT) AS end_char, pattern,
  round(least(1.0, CAST(bonus AS DOUBLE) + CASE pattern WHEN 'chapter_pattern' THEN 0.95 WHEN 'roman_numeral' THEN 0.8 WHEN 'decimal_numbering' THEN 0.8 WHEN 'title_case_short' THEN 0.55 ELSE 0.9 END), 4) AS score FROM p WHERE pattern IS NOT NULL),
seg AS (SELECT h.doc_id, index AS heading_index, start_char, coalesce(lead(start_char) OVER (PARTITION BY h.doc_id ORDER BY start_char), length(docs.text)) AS end_char FROM h JOIN docs USING (doc_id)
  UNION ALL SELECT docs.doc_id, NULL, 0, coalesce(f, length(docs.text)) FROM docs LEFT JOIN (SELECT doc_id, min(start_char) AS f FROM h GROUP BY 1) USING (doc_id)),
c AS (SELECT *, lower(text) AS y, len(regexp_extract_all(text, '[0-9]')) AS digits, len(regexp_split_to_array(text, '\s+')) AS words FROM h),
cl AS (SELECT *, CASE WHEN pattern <> 'title_case_short' THEN least(1.0, greatest(0.6, score))
    WHEN regexp_matches(text, '\(\s*(18|19|20)[0-9]{2}\s*\)') OR regexp_matches(text, '[0-9]+\.[0-9]+') OR (len(regexp_extract_all(text, '[0-9]+(\.[0-9]+)*([-–][0-9]+)?')) >= 2 AND contains(text, ','))
      OR ((digits + len(regexp_extract_all(text, '[.,;:\-–()]'))) / length(text) >= 0.22 AND digits >= 3) OR regexp_matches(text, '^[A-Z]$') THEN NULL
    WHEN regexp_matches(y, 'abstract|conclusion|example|exercise|glossary|introduction|overview|preface|prologue|review|summary') THEN 0.68
    WHEN contains(text, ':') AND digits = 0 AND words BETWEEN 2 AND 10 THEN 0.62 WHEN digits = 0 AND words BETWEEN 2 AND 6 THEN 0.58 END AS confidence FROM c),
t AS (SELECT *, CASE WHEN confidence IS NULL THEN NULL WHEN pattern IN ('chapter_pattern', 'part_pattern') THEN 'chapter' WHEN pattern = 'appendix_pattern' THEN 'appendix' WHEN pattern = 'bibliography_pattern' THEN 'bibliography'
  WHEN pattern = 'index_pattern' THEN 'index' ELSE 'section' END AS type FROM cl)
"""

#: Windows found one after another: each row of w begins where the one before ended, less the overlap.
WINDOW_SQL = r"""
w AS (SELECT doc_id, txt, n, 1 AS chunk_index, 0 AS s, CASE WHEN n <= 1800 THEN n END AS whole FROM (SELECT doc_id, trim(text, ' ' || chr(10)) AS txt, length(trim(text, ' ' || chr(10))) AS n FROM SOURCE) WHERE n > 0
  UNION ALL SELECT doc_id, txt, n, chunk_index + 1, greatest(e - 200, 0, s + 1), NULL FROM (SELECT *, ENDS AS e FROM (SELECT *, LOW AS low FROM w)) WHERE e < n AND whole IS NULL)
"""
LOW = "greatest(s, least(s + 1800, n) - 300)"
#: The cut after each marker in turn; a later one counts if it is found after the cut before.
_TAIL = "substr(txt, low + 1, least(s + 1800, n) - low)"
_AT = lambda m, k: f"(CASE WHEN contains({_TAIL}, {m}) THEN length({_TAIL}) - strpos(reverse({_TAIL}), reverse({m})) - {k - 1} ELSE -1 END)"
_M1 = f"(CASE WHEN {_AT(chr(39) + '. ' + chr(39), 2)} > -1 THEN {_AT(chr(39) + '. ' + chr(39), 2)} + 2 ELSE -1 END)"
_M2 = f"(CASE WHEN {_AT('chr(10)', 1)} > {_M1} THEN {_AT('chr(10)', 1)} + 1 ELSE {_M1} END)"
_M3 = f"(CASE WHEN {_AT(chr(39) + ' ' + chr(39), 1)} > {_M2} THEN {_AT(chr(39) + ' ' + chr(39), 1)} + 1 ELSE {_M2} END)"
_CUT = f"(CASE WHEN {_M3} > 0 THEN low + {_M3} ELSE least(s + 1800, n) END)"
ENDS = f"(CASE WHEN whole IS NOT NULL THEN n WHEN s + 1800 >= n AND {_CUT} < n AND ({_CUT} - 200 <= s OR n - {_CUT} <= 200) THEN n ELSE {_CUT} END)"
WINDOWS = WINDOW_SQL.replace("ENDS", ENDS).replace("LOW", LOW)
SPANS = f"SELECT doc_id, chunk_index, s AS start_char, {ENDS} AS end_char, txt FROM (SELECT *, {LOW} AS low FROM w)"

#: Promotion: row by row, with whether the two headings before support their neighbours.
DOC_SQL = BOOK_SQL.replace("WITH docs", "WITH RECURSIVE docs", 1) + r""", len AS (SELECT doc_id, length(text) AS n FROM docs WHERE text IS NOT NULL),
pg AS (SELECT *, CASE WHEN start_char >= 100 AND (start_char - 100) % 1000 < 800 THEN (start_char - 100) // 1000 + 1 END AS page, type IS NULL AND pattern = 'title_case_short' AND y NOT IN ('unknown', 'section', '') AND NOT regexp_matches(text, '^\p{Lu}$')
    AND NOT (regexp_matches(text, '\(\s*(18|19|20)[0-9]{2}\s*\)') OR regexp_matches(text, '[0-9]+\.[0-9]+') OR (len(regexp_extract_all(text, '[0-9]+(\.[0-9]+)*([-–][0-9]+)?')) >= 2 AND contains(text, ','))
      OR ((digits + len(regexp_extract_all(text, '[.,;:\-–()]'))) / length(text) >= 0.22 AND digits >= 3)) AS free FROM t),
g AS (SELECT *, coalesce(type IN SUPPORTING, false) AS sup, coalesce(abs(page - lag(page) OVER w) <= 2, true) AS n1, coalesce(abs(page - lag(page, 2) OVER w) <= 2, true) AS n2,
    CAST(coalesce(lead(type) OVER w IN SUPPORTING, false) AND coalesce(abs(page - lead(page) OVER w) <= 2, true) AS INTEGER) + CAST(coalesce(lead(type, 2) OVER w IN SUPPORTING, false) AND coalesce(abs(page - lead(page, 2) OVER w) <= 2, true) AS INTEGER) AS ahead FROM pg WINDOW w AS (PARTITION BY doc_id ORDER BY index)),
pr AS (SELECT doc_id, CAST(-1 AS BIGINT) AS index, false AS a, false AS b, 0 AS near FROM len
  UNION ALL SELECT g.doc_id, g.index, pr.b, CASE WHEN g.free THEN CAST(pr.b AND g.n1 AS INTEGER) + CAST(pr.a AND g.n2 AS INTEGER) + g.ahead > 0 ELSE g.sup END, CAST(pr.b AND g.n1 AS INTEGER) + CAST(pr.a AND g.n2 AS INTEGER) + g.ahead FROM pr JOIN g ON g.doc_id = pr.doc_id AND g.index = pr.index + 1),
ht AS (SELECT g.doc_id, g.index, text, CASE WHEN free AND near > 0 THEN 'section' ELSE type END AS type, CASE WHEN free AND near > 0 THEN CASE near WHEN 1 THEN 0.52 ELSE 0.6 END ELSE confidence END AS confidence FROM g JOIN pr ON pr.doc_id = g.doc_id AND pr.index = g.index),
s0 AS (SELECT seg.doc_id, coalesce(ht.text, 'unknown') AS label, coalesce(type, 'unknown') AS type, unnest(generate_series(CAST(start_char AS BIGINT), CAST(end_char AS BIGINT) - 1, 200000)) AS start_char, CAST(end_char AS BIGINT) AS e, CAST(coalesce(confidence, 0) AS DOUBLE) AS confidence FROM seg LEFT JOIN ht ON ht.doc_id = seg.doc_id AND ht.index = seg.heading_index WHERE end_char > start_char),
s1 AS (SELECT *, least(start_char + 200000, e) AS end_char FROM s0),
sec AS (SELECT s1.doc_id, row_number() OVER (PARTITION BY s1.doc_id ORDER BY start_char) - 1 AS section_index, 'section_' || CAST(start_char AS VARCHAR) AS id, label, type, start_char, end_char, confidence,
  CASE WHEN n <= 100 THEN NULL ELSE greatest(start_char - 100, 0) // 1000 + 1 END AS start_page, CASE WHEN n <= 100 THEN NULL ELSE greatest(end_char - 101, 0) // 1000 + 1 END AS end_page FROM s1 JOIN len USING (doc_id))
""".replace("SUPPORTING", "('chapter', 'section', 'appendix', 'front_matter')")
CLEAN_SQL = DOC_SQL + r""", c0 AS (SELECT doc_id, regexp_replace(trim(CASE WHEN section_index % 5 = 2 THEN 'Q' WHEN section_index % 5 = 3 THEN ' moon,  12' WHEN section_index % 5 = 4 AND doc_id % 2 = 0 THEN 'R' ELSE label END, ' '), '\s+', ' ', 'g') AS label,
    CASE WHEN section_index % 5 IN (2, 3) OR (section_index % 5 = 4 AND doc_id % 2 = 0) THEN 'unknown' ELSE type END AS type, start_char, end_char, confidence, CASE WHEN section_index % 3 = 1 THEN start_page END AS start_page, CASE WHEN section_index % 4 = 1 THEN end_page END AS end_page FROM sec),
c1 AS (SELECT *, regexp_matches(label, '^[A-Z]$') AND type = 'unknown' AS lone, length(label) > 2 AND type = 'unknown' AND regexp_matches(label, '^.+(\s|,)[0-9]+([-–][0-9]+)?(\s*,\s*[0-9]+([-–][0-9]+)?)*\.?$') AS entry FROM c0),
c2 AS (SELECT *, lone AND coalesce(lag(type) OVER (PARTITION BY doc_id ORDER BY start_char) = 'unknown', false) AS joins FROM c1),
c3 AS (SELECT *, count(*) FILTER (NOT joins) OVER (PARTITION BY doc_id ORDER BY start_char) AS island FROM c2),
c4 AS (SELECT doc_id, first(label ORDER BY start_char) AS label, first(type ORDER BY start_char) AS type, min(start_char) AS start_char, max(end_char) AS end_char, first(confidence ORDER BY start_char) AS confidence, first(start_page ORDER BY start_char) AS start_page, last(end_page ORDER BY start_char) AS end_page, first(lone ORDER BY start_char) AS lone, first(entry ORDER BY start_char) AS entry FROM c3 GROUP BY doc_id, island),
c5 AS (SELECT *, entry AND coalesce(lag(lone) OVER w, false) AS takes, lag(start_char) OVER w AS s_before, lag(start_page) OVER w AS p_before FROM c4 WINDOW w AS (PARTITION BY doc_id ORDER BY start_char)),
c6 AS (SELECT *, lone AND coalesce(lead(takes) OVER (PARTITION BY doc_id ORDER BY start_char), false) AS gone FROM c5),
c7 AS (SELECT doc_id, label, type, CASE WHEN takes THEN s_before ELSE start_char END AS start_char, end_char, confidence, CASE WHEN takes THEN coalesce(p_before, start_page) ELSE start_page END AS start_page, end_page FROM c6 WHERE NOT gone),
c8 AS (SELECT *, row_number() OVER w - 1 AS i, lead(start_page) OVER w AS after FROM c7 WINDOW w AS (PARTITION BY doc_id ORDER BY start_char)),
f AS (SELECT doc_id, CAST(-1 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS z FROM len UNION ALL SELECT c8.doc_id, c8.i, coalesce(c8.start_page, f.z, c8.after),
  greatest(coalesce(c8.end_page, c8.after, c8.start_page, f.z), coalesce(c8.start_page, f.z, c8.after)) FROM f JOIN c8 ON c8.doc_id = f.doc_id AND c8.i = f.i + 1)
SELECT c8.doc_id, c8.i AS section_index, 'section_' || CAST(start_char AS VARCHAR) AS id, label, type, start_char, end_char, confidence, f.a AS start_page, f.z AS end_page FROM c8 JOIN f ON f.doc_id = c8.doc_id AND f.i = c8.i"""
_RFIND = lambda m: f"(CASE WHEN contains(tail, {m}) THEN length(tail) - strpos(reverse(tail), reverse({m})) - length({m}) + 1 ELSE -1 END)"
_PART = f"""CASE WHEN n - s <= 1400 THEN n WHEN {_RFIND("chr(10) || chr(10)")} >= 0 THEN s + 1202 + {_RFIND("chr(10) || chr(10)")} WHEN greatest({_RFIND("'. '")}, {_RFIND("'? '")}, {_RFIND("'! '")}) >= 0 THEN s + 1202 + greatest({_RFIND("'. '")}, {_RFIND("'? '")}, {_RFIND("'! '")})
  WHEN {_RFIND("' '")} >= 0 THEN s + 1201 + {_RFIND("' '")} ELSE s + 1400 END"""
#: Sections cut one part after another, pieces packed one after another, small chunks taken one after another.
CHUNK_SQL = DOC_SQL + rf""", x0 AS (SELECT sec.*, substr(text, start_char + 1, end_char - start_char) AS txt FROM sec JOIN docs USING (doc_id) WHERE type <> 'index'),
x1 AS (SELECT *, CASE WHEN type IN ('chapter', 'appendix', 'bibliography', 'index') THEN false WHEN type = 'unknown' THEN end_char - start_char <= 300 AND coalesce(lag(type) OVER (PARTITION BY doc_id ORDER BY start_char) <> 'chapter', true) ELSE true END AS weak FROM x0 WHERE trim(txt, ' ' || chr(10)) <> ''),
sp AS (SELECT doc_id, section_index, txt, length(txt) AS n, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS a, CAST(0 AS BIGINT) AS s FROM x1 UNION ALL SELECT doc_id, section_index, txt, n, k + 1, s, {_PART} FROM (SELECT *, substr(txt, s + 1201, 200) AS tail FROM sp) WHERE s < n),
q0 AS (SELECT doc_id, section_index, txt, k, a, s AS b, count(*) OVER w AS cnt, lag(a) OVER (PARTITION BY doc_id, section_index ORDER BY k) AS a0, lead(s) OVER (PARTITION BY doc_id, section_index ORDER BY k) AS b1 FROM sp WHERE k > 0 WINDOW w AS (PARTITION BY doc_id, section_index)),
q1 AS (SELECT *, max(CASE WHEN k = cnt AND cnt > 1 AND b - a < 300 AND b - a0 <= 1400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, section_index) AS m FROM q0),
q2 AS (SELECT doc_id, section_index, cnt - m AS n_parts, a, CASE WHEN m = 1 AND k = cnt - 1 THEN b1 ELSE b END AS b, txt FROM q1 WHERE NOT (m = 1 AND k = cnt)),
atm AS (SELECT x1.doc_id, x1.id, x1.section_index, type, start_page, end_page, weak, n_parts, start_char + q2.a AS a, start_char + q2.b AS b, row_number() OVER (PARTITION BY x1.doc_id ORDER BY start_char + q2.a) AS i FROM x1 JOIN q2 USING (doc_id, section_index) WHERE trim(substr(q2.txt, q2.a + 1, q2.b - q2.a), ' ' || chr(10)) <> ''),
pk AS (SELECT doc_id, i, 0 AS p, a AS fs, b AS pe, id, type FROM atm WHERE i = 1 UNION ALL SELECT doc_id, i, CASE WHEN j THEN p ELSE p + 1 END, CASE WHEN j THEN fs ELSE a END, b, id, type FROM (SELECT atm.*, pk.p, pk.fs,
    NOT (atm.id <> pk.id AND (atm.type IN ('chapter', 'appendix', 'bibliography', 'index') OR pk.type IN ('chapter', 'appendix', 'bibliography', 'index'))) AND (atm.b - pk.fs <= 1400 OR (atm.b - pk.fs <= 2100 AND (pk.pe - pk.fs < 300 OR (atm.weak AND atm.b - atm.a < 300)))) AS j FROM pk JOIN atm ON atm.doc_id = pk.doc_id AND atm.i = pk.i + 1)),
k0 AS (SELECT pk.doc_id, p, min(a) AS a, max(b) AS b, arg_min(atm.id, atm.i) AS id0, arg_min(atm.type, atm.i) AS t0, arg_max(atm.id, atm.i) AS id1, arg_max(atm.type, atm.i) AS t1 FROM pk JOIN atm ON atm.doc_id = pk.doc_id AND atm.i = pk.i GROUP BY pk.doc_id, p),
k1 AS (SELECT *, b - a < 300 AND coalesce(NOT (lead(id0) OVER w <> id1 AND (lead(t0) OVER w IN ('chapter', 'appendix', 'bibliography', 'index') OR t1 IN ('chapter', 'appendix', 'bibliography', 'index'))) AND lead(b) OVER w - a <= 2100, false) AS may FROM k0 WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
k2 AS (SELECT doc_id, p, 0 AS f, may AS takes FROM k1 WHERE p = 0 UNION ALL SELECT k1.doc_id, k1.p, k2.f + CASE WHEN k2.takes THEN 0 ELSE 1 END, may AND NOT k2.takes FROM k2 JOIN k1 ON k1.doc_id = k2.doc_id AND k1.p = k2.p + 1),
pa AS (SELECT atm.*, f FROM atm JOIN pk ON pk.doc_id = atm.doc_id AND pk.i = atm.i JOIN k2 ON k2.doc_id = pk.doc_id AND k2.p = pk.p),
r0 AS (SELECT doc_id, f, min(a) AS a, max(b) AS b, arg_min(id, i) AS id0, arg_max(id, i) AS id1, arg_min(section_index, i) AS section_index, first(start_page ORDER BY i) AS start_page, last(end_page ORDER BY i) AS end_page FROM pa GROUP BY doc_id, f),
r1 AS (SELECT r0.*, trim(substr(text, a + 1, b - a), ' ' || chr(10)) AS body FROM r0 JOIN docs USING (doc_id)),
ch AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY a, b) - 1 AS chunk_index, CASE WHEN id0 = id1 THEN id0 ELSE id0 || '__' || id1 END AS section_id, section_index, a AS start_char, b AS end_char, start_page, end_page, body AS text FROM r1 WHERE body <> ''),
chunks AS (SELECT *, 'chunk_' || chunk_index || '_' || start_char || '_' || end_char AS chunk_id FROM ch)
"""
_LABEL = "trim(label, ' ')"
CHOICE_SQL = CHUNK_SQL + ", " + WINDOWS.replace("SOURCE", "docs") + rf""", ws AS ({SPANS}), wn AS (SELECT doc_id, chunk_index, start_char, end_char, trim(substr(txt, start_char + 1, end_char - start_char), ' ' || chr(10)) AS text FROM ws),
il AS (SELECT doc_id, count(*) AS secs, avg(CAST(type = 'unknown' AS DOUBLE)) AS unk, avg(CAST(type IN ('chapter', 'section', 'appendix', 'front_matter') AS DOUBLE)) AS useful, avg(CAST(regexp_matches({_LABEL}, '^[A-Z]$') OR regexp_matches({_LABEL}, '\.{{3,}}\s*[0-9]+\s*$') OR contains(lower({_LABEL}), 'contents')
  OR (regexp_matches({_LABEL}, '(\s|,)[0-9]+([-–][0-9]+)?(\s*,\s*[0-9]+([-–][0-9]+)?)*\.?$') AND (contains({_LABEL}, ',') OR len(regexp_split_to_array({_LABEL}, '\s+')) <= 6)) AS DOUBLE)) AS idx FROM sec GROUP BY 1),
hd AS (SELECT doc_id, count(*) AS heads, count(type) AS classed FROM ht GROUP BY 1),
qu AS (SELECT il.*, n, CAST(secs / greatest(1.0, n / 10000) > 12 AS INTEGER) + CAST(useful < 0.2 AS INTEGER) + CAST(coalesce(classed, 0) / greatest(1, coalesce(heads, 0)) < 0.1 AS INTEGER) AS soft FROM il JOIN len USING (doc_id) LEFT JOIN hd USING (doc_id)),
cs AS (SELECT doc_id, count(*) AS s, avg(CAST(length(text) < 400 AS DOUBLE)) AS small FROM chunks GROUP BY 1), cw AS (SELECT doc_id, count(*) AS w FROM wn WHERE text <> '' GROUP BY 1),
re AS (SELECT qu.doc_id, CASE WHEN qu.doc_id % 11 = 0 THEN 'structural_map_invalid' WHEN secs <= 1 THEN 'structural_map_insufficient_sections' WHEN unk > 0.85 THEN 'semantic_gate_unknown_ratio' WHEN idx > 0.2 THEN 'semantic_gate_index_like_ratio' WHEN soft >= 2 THEN 'semantic_gate_secondary_metrics'
  WHEN coalesce(s, 0) > 1.75 * greatest(coalesce(w, 0), 1) THEN 'postcheck_chunk_count' WHEN coalesce(small, 0) > 0.35 THEN 'postcheck_small_chunk_ratio' END AS reason FROM qu LEFT JOIN cs USING (doc_id) LEFT JOIN cw USING (doc_id)),
choice AS (SELECT doc_id, CASE WHEN reason IS NULL THEN 'structural' ELSE 'legacy' END AS mode, reason FROM re)
"""

MAP_SQL = """WITH k AS (SELECT doc_id, text, length(text) AS n, greatest(1, length(text) // 2) AS half FROM documents WHERE text IS NOT NULL), s AS (SELECT *, half + CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS a, n - CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS b FROM k WHERE doc_id % 37 > 0)
SELECT doc_id, 'heading_offsets' AS rule, unnest(CASE WHEN doc_id % 41 = 0 THEN ['0', '0'] ELSE ['0'] END) AS detail FROM k WHERE doc_id % 13 = 0 OR n < 9 UNION ALL SELECT doc_id, 'heading_score', unnest(CASE WHEN doc_id % 41 = 0 THEN ['0', '0'] ELSE ['0'] END) FROM k WHERE doc_id % 17 = 0
UNION ALL SELECT doc_id, 'heading_repeated', '0' FROM k WHERE doc_id % 41 = 0 UNION ALL SELECT doc_id, 'section_index', '2' FROM s WHERE doc_id % 29 = 0 UNION ALL SELECT doc_id, 'section_coverage', CASE WHEN doc_id % 29 = 0 THEN '2' ELSE '1' END FROM s WHERE doc_id % 3 = 0
UNION ALL SELECT doc_id, 'section_offsets', '0' FROM s WHERE half > n UNION ALL SELECT doc_id, 'section_offsets', CASE WHEN doc_id % 29 = 0 THEN '2' ELSE '1' END FROM s WHERE b <= a
UNION ALL SELECT doc_id, 'section_size', '0' FROM s WHERE half > 20000 UNION ALL SELECT doc_id, 'section_size', CASE WHEN doc_id % 29 = 0 THEN '2' ELSE '1' END FROM s WHERE b - a > 20000 UNION ALL SELECT doc_id, 'section_confidence', '0' FROM s WHERE doc_id % 11 = 0
UNION ALL SELECT doc_id, 'section_id', CASE WHEN doc_id % 29 = 0 THEN '2' ELSE '1' END FROM s WHERE doc_id % 31 = 0 UNION ALL SELECT doc_id, 'section_label', '0' FROM s WHERE doc_id % 7 = 0 UNION ALL SELECT doc_id, 'section_pages', '0' FROM s WHERE doc_id % 23 = 0
UNION ALL SELECT doc_id, 'section_end', CAST(b AS VARCHAR) FROM s WHERE b <> n UNION ALL SELECT doc_id, 'section_missing', CAST(n AS VARCHAR) FROM k WHERE doc_id % 37 = 0 AND n > 0 UNION ALL SELECT doc_id, 'text_hash', '0' FROM k WHERE doc_id % 19 = 0"""
SQL = {
    "document_map_problems": MAP_SQL,
    "document_map": DOC_SQL + "SELECT * FROM sec",
    "cleaned_sections": CLEAN_SQL,
    "structural_chunks": CHUNK_SQL + "SELECT * FROM chunks",
    "structural_chunk_stats": CHUNK_SQL
    + """, st AS (SELECT doc_id, f, count(DISTINCT id) AS n, count(DISTINCT CASE WHEN weak THEN id END) AS w FROM pa GROUP BY 1, 2), tk AS (SELECT doc_id, CAST(sum(CASE WHEN n > 1 THEN w ELSE 0 END) AS BIGINT) AS weak_sections_absorbed FROM st GROUP BY 1),
sa AS (SELECT doc_id, count(*) AS atoms, count(DISTINCT id) AS sections_consumed, count(DISTINCT CASE WHEN n_parts > 1 THEN id END) AS sections_split, count(DISTINCT CASE WHEN weak THEN id END) AS weak_sections_total FROM pa GROUP BY 1),
sz AS (SELECT doc_id, count(*) AS total_chunks, avg(end_char - start_char) AS avg_chunk_size FROM chunks GROUP BY 1)
SELECT doc_id, total_chunks, avg_chunk_size, sections_consumed, sections_split, weak_sections_total, weak_sections_absorbed, atoms / total_chunks AS avg_sections_per_chunk, CASE WHEN weak_sections_total > 0 THEN weak_sections_absorbed / weak_sections_total ELSE 0.0 END AS weak_sections_absorbed_ratio, CAST(2100 AS BIGINT) AS hard_max_chunk_size FROM sz JOIN sa USING (doc_id) JOIN tk USING (doc_id)""",
    "chosen_chunking": CHOICE_SQL + "SELECT * FROM choice",
    "chosen_chunks": CHOICE_SQL
    + """SELECT doc_id, mode, chunk_index + 1 AS chunk_index, chunk_id, section_id, start_char, end_char, text FROM chunks JOIN choice USING (doc_id) WHERE mode = 'structural'
UNION ALL SELECT doc_id, 'legacy', chunk_index, 'legacy_chunk_' || chunk_index, NULL, start_char, end_char, text FROM wn LEFT JOIN choice USING (doc_id) WHERE coalesce(mode, 'legacy') = 'legacy' AND text <> ''""",
    "text_lines": "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents), p AS (SELECT *, CAST(coalesce(sum(length(raw) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_char FROM l) SELECT doc_id, line_no, start_char, start_char + length(raw) AS end_char, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS line FROM p WHERE regexp_replace(raw, '^\\s+|\\s+$', '', 'g') <> ''",
    "usable_texts": "WITH t AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN regexp_replace(text, '[^ .,]', '-', 'g') WHEN doc_id % 10 = 0 THEN regexp_replace(text, '[^\\n]{20,}', '1234', 'g') ELSE text END AS text FROM documents) SELECT doc_id, CASE WHEN length(text) < 20 OR len(regexp_extract_all(text, '[LETTERS]')) / length(text) < 0.05 THEN '' ELSE text END AS text FROM t".replace("LETTERS", L),
    "page_text": RAW_SQL + "SELECT doc_id, page_index, clean_text, dehyphenation_count, line_merge_count FROM pages",
    "running_lines": RAW_SQL + "SELECT doc_id, key, place, pages FROM keys",
    "clean_pages": RAW_SQL + "SELECT doc_id, page_index, clean_text, removed_header_lines, removed_footer_lines, removed_page_numbers FROM clean",
    "assembled_books": RAW_SQL + "SELECT doc_id, length(t) AS chars, sha256(t) AS text_hash FROM (SELECT doc_id, string_agg(clean_text, chr(10) || chr(10) ORDER BY page_index) FILTER (clean_text <> '') AS t FROM clean GROUP BY 1)",
    "page_units": RAW_SQL + "SELECT doc_id, page_index AS page, CAST(coalesce(sum(length(clean_text) + 2) OVER w, 0) AS BIGINT) AS start_char, CAST(coalesce(sum(length(clean_text) + 2) OVER w, 0) + length(clean_text) AS BIGINT) AS end_char FROM clean WHERE clean_text <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY page_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
    "extraction_diagnostics": RAW_SQL
    + """, s AS (SELECT doc_id, count(*) AS page_count, count(*) FILTER (c.clean_text = '') AS empty_page_count, CAST(sum(length(raw_text)) AS BIGINT) AS raw_char_count, CAST(sum(length(c.clean_text)) AS BIGINT) AS clean_char_count,
  sum(len(regexp_extract_all(c.clean_text, '[LETTERS]'))) AS alpha, CAST(sum(dehyphenation_count) AS BIGINT) AS dehyphenation_count, CAST(sum(line_merge_count) AS BIGINT) AS line_merge_count,
  CAST(sum(removed_header_lines) AS BIGINT) AS removed_header_lines, CAST(sum(removed_footer_lines) AS BIGINT) AS removed_footer_lines, CAST(sum(removed_page_numbers) AS BIGINT) AS removed_page_numbers
  FROM clean c JOIN pages p USING (doc_id, page_index) GROUP BY 1),
r AS (SELECT *, CASE WHEN clean_char_count > 0 THEN alpha / clean_char_count ELSE 0.0 END AS alpha_density FROM s),
q AS (SELECT *, CASE WHEN clean_char_count < 20 THEN 'clean_char_count below minimum threshold' WHEN empty_page_count / page_count > 0.98 THEN 'empty_page_ratio above maximum threshold' WHEN alpha_density < 0.05 THEN 'alpha_density below minimum threshold' END AS unusable_reason FROM r)
SELECT * EXCLUDE (alpha), unusable_reason IS NULL AS is_usable FROM q""".replace("LETTERS", L),
    "heading_candidates": BOOK_SQL + "SELECT doc_id, index, text, start_char, end_char, score, pattern FROM h",
    "heading_segments": BOOK_SQL + "SELECT * FROM seg WHERE end_char > start_char",
    "heading_classes": BOOK_SQL + "SELECT doc_id, index, type, CAST(confidence AS DOUBLE) AS confidence FROM t",
    "top_headings": BOOK_SQL + "SELECT doc_id, index, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, index) AS r FROM h) WHERE r <= 3",
    "normalized_sections": BOOK_SQL
    + """, v AS (SELECT t.doc_id, t.text AS label, type, start_char AS s0, least(start_char + 400, length(docs.text)) AS e, confidence FROM t JOIN docs USING (doc_id) WHERE type IS NOT NULL),
o AS (SELECT *, greatest(s0, coalesce(max(e) OVER (PARTITION BY doc_id ORDER BY s0, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS s FROM v),
f AS (SELECT * FROM o WHERE e > s),
gaps AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS a, s AS b FROM f UNION ALL SELECT docs.doc_id, coalesce(m, 0), length(text) FROM docs LEFT JOIN (SELECT doc_id, max(e) AS m FROM f GROUP BY 1) USING (doc_id)),
whole AS (SELECT doc_id, label, type, s, e, CAST(confidence AS DOUBLE) AS confidence FROM f UNION ALL SELECT doc_id, 'unknown', 'unknown', a, b, 0.0 FROM gaps WHERE b > a),
parts AS (SELECT doc_id, label, type, unnest(generate_series(CAST(s AS BIGINT), CAST(e AS BIGINT) - 1, 700)) AS start_char, e, confidence FROM whole)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY start_char) - 1 AS section_index, 'section_' || CAST(start_char AS VARCHAR) AS id, label, type, start_char, CAST(least(start_char + 700, e) AS BIGINT) AS end_char, confidence FROM parts""",
    "overlap_chunks": "WITH RECURSIVE " + WINDOWS.replace("SOURCE", "documents") + f"SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, CAST(start_char AS BIGINT) AS start_char, CAST(end_char AS BIGINT) AS end_char, trim(substr(txt, start_char + 1, end_char - start_char), ' ' || chr(10)) AS text FROM ({SPANS})",
    "section_refs": BOOK_SQL.replace("WITH docs", "WITH RECURSIVE docs", 1)
    + ", " + WINDOWS.replace("SOURCE", "docs")
    + f""", x AS ({SPANS}), r AS (SELECT seg.doc_id, seg.start_char AS a, seg.end_char AS b, t.text AS label, coalesce(type, 'unknown') AS type FROM seg JOIN t ON t.doc_id = seg.doc_id AND t.index = seg.heading_index WHERE seg.end_char > seg.start_char)
SELECT x.doc_id, CAST(x.chunk_index AS BIGINT) AS chunk_index, CAST(a AS BIGINT) AS start_char, label, type FROM x JOIN r ON r.doc_id = x.doc_id AND greatest(a, x.start_char) < least(b, x.end_char)
WHERE NOT (type = 'index' OR regexp_matches(label, '^[^\\p{{L}}\\p{{N}}]{{1,8}}$') OR (len(regexp_split_to_array(label, '\\s+')) <= 2 AND type IN ('unknown', 'section') AND length(label) <= 8) OR (regexp_matches(lower(label), 'bibliography|references|sources') AND type = 'unknown'))""",
}

QUERIES = {f.__name__: f for f in (
    page_text, running_lines, clean_pages, assembled_books, page_units, extraction_diagnostics, heading_candidates, heading_segments, heading_classes, top_headings, normalized_sections,
    text_lines, usable_texts, document_map, document_map_problems, cleaned_sections, overlap_chunks, structural_chunks, structural_chunk_stats, chosen_chunking, chosen_chunks, section_refs,
)}

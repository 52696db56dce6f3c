"""Sequential helpers against plain versions, and quirks of the rules on small tables."""

from pyspark.sql import functions as F

from foliospark.operators import chunking as K
from foliospark.operators import pages as P
from foliospark.operators import precheck as C
from foliospark.operators import structure as S


def texts(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def test_page_rules(spark):
    raw = ["Book One 1\nThe sto-\nry goes\r\non and\n\n\n\nNew.  part\t here.\n12\nLast line.\nEnd.", "", None]
    pages = spark.createDataFrame([("b", i, t) for i, t in enumerate(raw)] + [("b", 10 + i, f"BOOK  one {i}\nText {chr(97 + i) * 3} stands.\n{chr(97 + i) * 3} more.\nMid {chr(97 + i) * 3}.\nfoot") for i in range(6)], "doc_id string, page_index int, raw_text string")
    got = {r["page_index"]: r for r in P.clean_pages(pages).collect()}
    assert got[0]["clean_text"] == "The story goes on and\n\nNew. part here.\nLast line.\nEnd." and got[0]["dehyphenation_count"] == 1 and got[0]["line_merge_count"] == 1
    assert got[0]["removed_header_lines"] == 1 and got[0]["removed_page_numbers"] == 1
    assert got[12]["clean_text"] == "Text ccc stands.\nccc more.\nMid ccc." and got[12]["removed_footer_lines"] == 1
    assert got[1]["clean_text"] == got[2]["clean_text"] == ""
    usable = P.extraction_diagnostics(P.clean_pages(pages)).first()
    assert usable["is_usable"] and usable["empty_page_count"] == 2 and usable["page_count"] == 9


def test_promotion_counts_earlier_promotions(spark):
    rows = [(1, i, t, 10 * i, 10 * i + 5, p, 0.6, "title_case_short", k, None) for i, (t, p, k) in enumerate([("Chapter One", 1, "chapter"), ("Lonely Words Go On And On Here", 2, None), ("Other Words That Are Many More", 3, None), ("Far Words That Are Many More Now", 30, None), ("Z", None, None)])]
    got = S.promote_by_context(spark.createDataFrame(rows, "doc_id long, index int, text string, start_char int, end_char int, page long, score double, pattern string, type string, confidence double")).orderBy("index").collect()
    assert [(r["type"], r["confidence"]) for r in got] == [("chapter", None), ("section", 0.52), ("section", 0.6), (None, None), (None, None)]


def test_map_is_sound_and_covers_texts(spark):
    docs = texts(spark, "", "no headings at all, only this line of text", "Chapter 1 Start\nwords\n***\nIndex\nA\nalpha, 12\nB\n" + "x" * 900, "Part\n\n  INTRODUCTION  \nbody")
    headings, sections = S.build_document_map(docs, max_size=300)
    assert S.validate_document_map(headings, sections, docs, 300).count() == 0
    by = {}
    for r in sections.orderBy("doc_id", "section_index").collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert 0 not in by and len(by[1]) == 1 and max(r["end_char"] - r["start_char"] for r in by[2]) <= 300
    assert "***" in {r["text"] for r in headings.collect()}


def test_pages_by_nearest_unit(spark):
    units = spark.createDataFrame([(1, 1, 5, 10), (1, 2, 12, 20)], "doc_id long, page long, start_char long, end_char long")
    spans = spark.createDataFrame([(1, x) for x in (0, 5, 10, 11, 12, 25)] + [(2, 3)], "doc_id long, start_char long")
    exact = {(r["doc_id"], r["start_char"]): r["page"] for r in S.assign_pages(spans, units).collect()}
    near = {(r["doc_id"], r["start_char"]): r["page"] for r in S.assign_pages(spans, units, nearest=True).collect()}
    assert exact == {(1, 0): None, (1, 5): 1, (1, 10): None, (1, 11): None, (1, 12): 2, (1, 25): None, (2, 3): None}
    assert near == {(1, 0): 1, (1, 5): 1, (1, 10): 1, (1, 11): 1, (1, 12): 2, (1, 25): 2, (2, 3): None}


def test_clean_sections_merges_letters_and_fills_pages(spark):
    rows = [(1, i, f"section_{10 * i}", label, kind, 10 * i, 10 * i + 10, 0.0, a, b) for i, (label, kind, a, b) in enumerate([("Body", "chapter", None, None), ("A", "unknown", 4, 4), ("alpha, 12", "unknown", None, None), ("B", "unknown", None, 9), (" ", "section", None, None)])]
    got = S.clean_sections(spark.createDataFrame(rows, "doc_id long, section_index int, id string, label string, type string, start_char int, end_char int, confidence double, start_page long, end_page long")).orderBy("section_index").collect()
    assert [(r["label"], r["start_char"], r["end_char"], r["start_page"], r["end_page"]) for r in got] == [("Body", 0, 10, 4, 4), ("alpha, 12", 10, 40, 4, 9), ("unknown", 40, 50, 9, 9)]


def test_classifications_from_replies(spark):
    docs = texts(spark, "Chapter 1 One\nSome Title Here\nAppendix A")
    replies = spark.createDataFrame([(0, 'Sure: [{"index":1,"type":" Chapter ","confidence":7},{"index":0,"type":"odd","confidence":0.4},{"index":9,"type":"index","confidence":1},{"index":1,"type":"index","confidence":0.25}] ok')], "doc_id long, response string")
    got = S.apply_classifications(S.classify_headings(S.detect_headings(docs)), replies).orderBy("index").collect()
    assert [(r["type"], r["confidence"]) for r in got] == [("unknown", 0.4), ("index", 0.25), ("appendix", 0.95)]


def test_overlap_windows_cover_the_text():
    text = ("Sentence number one is here. Another\nline follows it " * 120).strip()
    spans = K.overlap_spans(text, 500, 60)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(b[0] == a[1] - 60 and a[1] - a[0] <= 500 + 60 for a, b in zip(spans, spans[1:]))
    assert K.overlap_spans("a" * 1000, 300, 299)[-1][1] == 1000
    assert K.overlap_spans("", 10, 2) == [] and K.overlap_spans("short", 10, 2) == [(0, 5)]


def test_atoms_cover_sections_and_packs_keep_boundaries(spark):
    docs = texts(spark, "Chapter 1 A\n" + "word and more. " * 300 + "\nSmall Title Here\nshort text\nChapter 2 B\n" + "other words! " * 100 + "\nIndex\nz, 12")
    _, sections = S.build_document_map(docs)
    atoms = K.section_atoms(docs, sections, 1000, 200, 150)
    for s in sections.collect():
        parts = sorted((r["start_char"], r["end_char"]) for r in atoms.where(F.col("section_index") == s["section_index"]).collect())
        assert parts[0][0] == s["start_char"] and parts[-1][1] == s["end_char"] and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    packed = K.pack_atoms(atoms, 1000, 200)
    chunks = K.chunk_records(packed, docs).orderBy("chunk_index").collect()
    assert all(c["end_char"] - c["start_char"] <= 1500 for c in chunks)
    strong = [s["start_char"] for s in sections.collect() if s["type"] in K.STRONG]
    assert not any(c["start_char"] < x < c["end_char"] for c in chunks for x in strong)
    stats = K.chunk_stats(K.chunk_records(packed, docs), packed, 1000).first()
    assert stats["total_chunks"] == len(chunks) and stats["hard_max_chunk_size"] == 1500


def test_precheck_of_odd_chunks(spark):
    rows = [(0, None, None), (1, "", [("unknown", "unknown")]), (2, "§ £ ¶ " * 30, [])]
    got = C.precheck(spark.createDataFrame(rows, "doc_id long, text string, section_refs array<struct<label:string,type:string>>")).orderBy("doc_id").collect()
    assert [r["decision"] for r in got] == ["skip"] * 3 and got[0]["reason_codes"][:2] == ["blank_text", "very_short"] and "high_ocr_noise" in got[2]["reason_codes"]

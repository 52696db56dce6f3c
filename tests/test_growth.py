"""Steps whose work may not grow with copies of a text, with pairs or with hot keys."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from foliospark.functions.pages import in_ranges, numbered
from foliospark.functions.textnorm import surface
from foliospark.operators import chunking as K
from foliospark.operators import concepts as C
from foliospark.operators import consolidation as B
from foliospark.operators import explorer as E
from foliospark.operators import frames as L
from foliospark.operators import pages as P
from foliospark.operators import precheck as X
from foliospark.operators import records as H
from foliospark.operators import structure as T
from foliospark.operators import taxonomy as Y
from foliospark.plans import concepts_plan as Q
from foliospark.plans import pages_of_concepts_plan as O
from foliospark.plans import pages_plan as G
from foliospark.plans import records_plan as R
from foliospark.sources import tables as S


def counted(spark, monkeypatch, module, name):
    """An accumulator of the rows over which module.name(column, …), a test of texts, is made."""
    seen, own = spark.sparkContext.accumulator(0), getattr(module, name)
    count = F.udf(lambda x: seen.add(1) or x, "string").asNondeterministic()
    monkeypatch.setattr(module, name, lambda text, *more: own(count(text), *more))
    return seen


def test_names_are_looked_for_once_in_each_text(spark, monkeypatch):
    seen = counted(spark, monkeypatch, B, "names_exactly")
    texts = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("c").alias("concept"), F.lit("relationships").alias("field"), F.lit(0).cast("long").alias("at"), F.when(F.col("id") % 2 == 0, "the Ring kind, near").otherwise("the ringkind").alias("value"))
    spellings = spark.createDataFrame([("ring kind", "ring kind"), ("kind", "kind")], "name string, alias string")
    found = B.naming(texts, spellings)
    assert {(r["name"], r["n"]) for r in found.groupBy("name").agg(F.count_distinct("doc_id").alias("n")).collect()} == {("ring kind", 300), ("kind", 300)}
    assert seen.value < 20


def related_tables(spark, n_scopes, n_names, seed=0):
    rng = random.Random(seed)
    names = [f"n{i:02} é" if i % 5 else f"N{i:02}" for i in range(n_names)]
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    concepts = table([(d, n, [rng.choice("tuvwxyz") * 2 for _ in range(2)]) for d in range(n_scopes) for n in names[: n_names if d else n_names // 2]], "doc_id long, concept string, terminology array<string>")
    up = table([(d, rng.choice(names[:5]), rng.choice(names)) for d in range(n_scopes) for _ in range(8)], "doc_id long, parent string, child string")
    families = table([(d, rng.choice(names), rng.choice("fg")) for d in range(n_scopes) for _ in range(10)] + [(0, "n01 é", None), (None, "n02 é", "f")], "doc_id long, concept string, family_id string")
    blocks = table([(d, rng.randrange(6), rng.choice(names)) for d in range(n_scopes) for _ in range(40)] + [(1, None, "n03 é"), (1, 2, None)], "doc_id long, block_index int, concept string")
    return concepts, up, families, blocks


@pytest.mark.parametrize("bound", [0, 120])
def test_small_and_large_scopes_give_the_same_related_concepts(spark, monkeypatch, bound):
    given = related_tables(spark, 4, 40)
    rows = lambda: sorted(map(tuple, E.related_concepts(*given, limit=4).collect()))
    want = rows()
    monkeypatch.setattr(E, "SMALL_SCOPE", bound)
    assert rows() == want and len(want) > 400


def test_related_concepts_of_small_scopes_shuffle_no_pairs(spark, monkeypatch):
    given = related_tables(spark, 3, 30)
    written, own = [], E.cut
    monkeypatch.setattr(E, "cut", lambda df: written.append(df) or own(df))
    found = E.related_concepts(*given).collect()
    lists = 3 * 30 * 4 + 3 * 100
    assert len(found) > 600 and sum(df.count() for df in written) < lists


def made(column, function):
    return str(column).count(f"{function}(")


def test_surfaces_of_a_frame_are_made_once(spark):
    rule = F.col("r")
    assert made(L.is_whole(rule), "lower") == 2
    assert made(surface(F.col("t")), "regexp_replace") == 1


def test_surfaces_are_the_same(spark):
    odd = ["A-b  C", "--", "é x Y\x1f z-", "", None, "tab\tand\nline", " 9’s ÄÖ-ring . "]
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.replace(F.lower("t"), F.lit("-"), F.lit(" ")), r"[^a-z0-9\s]", " "), r"\s+", " "))
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select(surface(F.col("t")).alias("a"), plain.alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows] and rows[0]["a"] == "a b c"


def test_items_and_keys_of_records_are_made_once(spark):
    assert made(H.first_by(F.col("x"), F.lower), "lower") == 1
    assert made(H.dedupe_conservative(F.col("x")), "regexp_replace") == 1
    row = spark.createDataFrame([(["b", " B ", None, "a", "", "A  c", "b", "a c"],)], "x array<string>")
    assert row.select(H.dedupe_conservative(F.col("x"))).first()[0] == ["b", "a", "A c"]


def test_records_are_spread_over_all_cores(spark):
    assert R.records(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_buckets_of_concepts_of_one_row_are_made_in_it(spark, monkeypatch):
    rng = random.Random(3)
    texts = ["to: a; type: contrast", "from: B ; to: c; type: Requires", "type: contrast", "told", "", None, "from: n1; to: a; type: opposite", "from: a; to: n1; type: use", "to: A;type: oppos"]
    rows = [(d, f"n{i}" if i else None, [rng.choice(["a", "", "told", None]) for _ in range(2)] if i % 3 else None, rng.choices(texts, k=6) if i % 4 else None) for d in range(2) for i in range(8)]
    concepts = spark.createDataFrame(rows, "doc_id long, concept string, related_concepts array<string>, relationships array<string>")
    plain = lambda df: sorted((str(r["doc_id"]), str(r["concept"]), r["bucket"], str(r["counterparts"])) for r in df.collect())
    want = plain(E.buckets_over_rows(concepts, ["doc_id"]))
    twice = concepts.unionByName(concepts.where("concept = 'n2' OR concept IS NULL"))
    assert plain(E.relation_buckets(twice)) == want and len(want) > 20
    monkeypatch.setattr(E, "buckets_over_rows", None)
    assert plain(E.relation_buckets(concepts)) == want


def test_members_of_a_tree_are_made_once(spark):
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: seen.add(1) or x, "string").asNondeterministic()
    members = spark.range(60).select(F.lit(1).alias("doc_id"), F.lit("f").alias("family_id"), count(F.col("id").cast("string")).alias("concept"))
    edges = spark.range(59).select(F.lit(1).alias("doc_id"), F.col("id").cast("string").alias("parent"), (F.col("id") - F.col("id") % 10 + 10).cast("string").alias("child"))
    found = E.family_tree(edges, members).collect()
    assert len(found) == 60 and sum(r["ways"] for r in found) > 60 and seen.value == 60


def test_headings_of_section_refs_are_found_once(spark, monkeypatch):
    written, own = [], G.cut
    monkeypatch.setattr(G, "cut", lambda df: written.append(df.columns) or own(df))
    found = G.section_refs(spark, "/root/testdata/sf0.001")
    assert ["pattern" in columns for columns in written] == [True] and "regexp_count" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_pages_are_made_once_and_dealt_by_their_number(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: seen.add(1) or x, "long").asNondeterministic()
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), count("id").alias("v"))
    want = sorted(map(tuple, numbered(rows, ["k"], ["v"]).collect()))
    assert seen.value == 100 and [r[2] for r in want if r[0] == 0] == list(range(34))
    monkeypatch.setattr(S, "ROWS", 10)
    assert in_ranges(rows, ["k"], ["v"]).select("_range").distinct().count() > 6
    assert sorted(map(tuple, numbered(rows, ["k"], ["v"]).collect())) == want


def test_pages_of_mentions_gather_no_chunks(spark):
    plan = Q.mention_pages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1 and "p_brand" not in plan
    rows = [(1, ["b", "a", "b"]), (2, ["a", "", None]), (3, None)]
    chunks = spark.createDataFrame(rows, "ordinal long, concepts array<string>")
    assert sorted(map(tuple, C.mention_pages(chunks, (), 1).select("concept", "page", "rows").collect())) == [("a", 0, [1]), ("a", 1, [2]), ("b", 0, [1])]


def test_occurrences_are_dealt_by_their_number(spark, monkeypatch):
    rows = lambda: sorted(map(tuple, Q.concept_index(spark, "/root/testdata/sf0.001").collect()))
    want = rows()
    monkeypatch.setattr(S, "ROWS", 500)
    assert Q.occurrences(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 12
    assert rows() == want


def test_structural_children_make_only_the_concepts_of_specs(spark):
    plan = Q.structural_children(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan  # what the classes are made of is read from one table
    made = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert made and plan.index("Aggregate [") < plan.index("LeftSemi")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_scored_outside_of_filters(spark):
    odd = ["", None, "CHAPTER 1 é\U0001f600\n\n\u2003 Two Words\x85\r\n" + "x" * 120 + "\n" + "y" * 121 + "\n \t\x1f\n" + " " * 200 + "Z 9\u3000\n", "\n"]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    own = T.explode_lines(docs).where(F.length("line") <= 120).select("doc_id", "start_char", "end_char", "line")
    assert sorted(map(tuple, T.fit_lines(docs).collect())) == sorted(map(tuple, own.collect())) and own.count() == 4
    assert not any("Filter" in line and "RLIKE" in line for line in optimized(T.detect_headings(docs)).splitlines())


def test_texts_of_chunks_are_cut_in_one_pass(spark):
    docs = spark.createDataFrame([(0, "Ab é\U0001f600 cd. \n  \n ef"), (1, None), (2, "  "), (3, "x")], "doc_id long, text string")
    packed = spark.createDataFrame([(0, 0, "a", 0, 0, 7, 1, 1), (0, 1, "b", 1, 10, 14, 1, 2), (0, 2, "b", 1, 14, 17, None, None), (1, 0, "a", 0, 0, 4, 1, 1), (2, 0, "a", 0, 0, 2, 1, 1)], "doc_id long, pack int, section_id string, section_index int, start_char int, end_char int, start_page long, end_page long")
    chunks = K.chunk_records(packed, docs)
    assert "substring(" not in optimized(chunks) and "Window" not in optimized(chunks)
    assert sorted(map(tuple, chunks.select("doc_id", "chunk_index", "chunk_id", "section_id", "text").collect())) == [(0, 0, "chunk_0_0_7", "a", "Ab é\U0001f600 c"), (0, 1, "chunk_1_14_17", "b", "ef")]
    sections = spark.createDataFrame([(0, i, f"section_{a}", k, a, b, 1, 1) for i, (k, a, b) in enumerate([("chapter", 0, 9), ("front_matter", 9, 14), ("unknown", 14, 17)])] + [(1, 0, "section_0", "unknown", 0, 3, 1, 1)], "doc_id long, section_index int, id string, type string, start_char int, end_char int, start_page long, end_page long")
    atoms = K.section_atoms(docs, sections, 4, 3, 2)
    assert "substring(" not in optimized(atoms)
    assert sorted(map(tuple, atoms.select("doc_id", "section_index", "is_weak", "n_parts", "start_char", "end_char").collect())) == [(0, 0, False, 3, 0, 3), (0, 0, False, 3, 3, 6), (0, 0, False, 3, 6, 9), (0, 2, False, 1, 14, 17)]


def test_frequent_characters_are_counted_without_a_string_each(spark):
    odd = [None, "", "Ab1 \u0663\U0001d7d9 \U0001d49cé\u3000\x85\x1c\u200b 9-9 §\n\tZ", "\U0001f600\U0001f600", "x:y: moon cat:  a long body here", "moon\u0130: short", "Step  one", "stepé two", "misstep one", "pp. 12-14, Kim, 1999 p3 \U0001d49c7 x7 7\U0001d49c ch. 5"]
    chunks = spark.createDataFrame([(i, x, []) for i, x in enumerate(odd)], "doc_id long, text string, section_refs array<struct<label:string,type:string>>")
    made = X.type_scores(X.chunk_signals(chunks))
    assert made.columns == [*chunks.columns, "signals", "scores"]
    assert not any(f", {p}, 0)" in optimized(made) for p in ("[A-Za-z]", r"\p{Nd}"))
    assert X.HELD["find"] in optimized(made)
    space = set(" \t\n\x0b\f\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") | set(map(chr, (*range(0x2000, 0x200B), *range(0x1C, 0x20))))
    for i, s, scores in made.orderBy("doc_id").select("doc_id", "signals", "scores").collect():
        x, n = odd[i] or "", max(1, len(odd[i] or ""))
        letters, digits, spaces = sum(c.isascii() and c.isalpha() for c in x), sum(unicodedata.category(c) == "Nd" for c in x), sum(c in space for c in x)
        assert (s.letter_ratio, s.digit_ratio, s.symbol_ratio) == (letters / n, digits / n, (len(x) - letters - digits - spaces) / n)
        assert round(s.citation_locator_density * max(1, s.word_count)) == {2: 1, 9: 6}.get(i, 0)
        assert (scores.glossary, scores.exercises) == ({4: 0.2}.get(i, 0.0), {6: 0.65, 7: 0.45, 8: 0.45}.get(i, 0.0))


def test_pages_of_a_book_are_dealt_to_groups(spark):
    line = "AÀÖ×Øö÷øÿ9 \U0001d49cé\u0100 z"
    rows = [(1, i, f"Book\n{line}\n{i}") for i in range(40)] + [(1, 40, ""), (1, 41, "Book"), (2, 0, "Book\nb"), (None, 0, "Book\nc")]
    pages = spark.createDataFrame([(*r, r[2], 0, 0) for r in rows], "doc_id int, page_index int, clean_text string, raw_text string, dehyphenation_count int, line_merge_count int")
    done = P.remove_running_lines(pages, spark.createDataFrame([(1, "book", "top", 41)], "doc_id int, key string, place string, pages int"))
    joins = [x for x in optimized(done).splitlines() if "Join LeftOuter" in x]
    assert joins and "_share" in joins[0] and done.columns == [*pages.columns, "removed_header_lines", "removed_footer_lines", "removed_page_numbers"]
    got = {(r.doc_id, r.page_index): (r.clean_text, r.removed_header_lines, r.removed_page_numbers) for r in done.collect()}
    assert got == {(1, i): (line, 1, 1) for i in range(40)} | {(1, 40): ("", 0, 0), (1, 41): ("", 1, 0), (2, 0): ("Book\nb", 0, 0), (None, 0): ("Book\nc", 0, 0)}
    sums = P.extraction_diagnostics(done)
    assert "regexp_extract_all" not in optimized(sums)
    r = sums.where("doc_id = 1").first()
    assert (r.page_count, r.empty_page_count, r.removed_header_lines, r.clean_char_count, r.alpha_density) == (42, 2, 41, 40 * 16, 9 / 16)


def test_runs_that_no_concept_has_are_not_shuffled(spark, monkeypatch):
    kind = "doc_id long, concept string, definitions array<string>, relationships array<string>, terminology array<string>, source_chunks array<long>"
    rows = [(1, "types of ring", [], ["types of ring include red ring and more words of no concept", "no marker red ring"], [], [1]), (1, "red ring", [], [], [], [1]), (2, "types of ring", [], ["Types of ring include Red-Ring, RED RING"], [], [2]), (2, "red ring", [], [], [], [2]), (None, "red ring", [], [], [], [3])]
    concepts = spark.createDataFrame(rows, kind)
    want = [(1, "types of ring", "red ring", 0, [1]), (2, "types of ring", "red ring", 0, [2])]
    of = lambda df: sorted(map(tuple, df.select("doc_id", "parent", "child", "at", "source_chunks").collect()))
    few = Y.relationship_candidates(concepts)
    assert of(few) == want
    plan = few._jdf.queryExecution().executedPlan().toString()
    # the runs meet the names that are there before they are dealt out
    assert plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning(doc_id") < plan.index("LeftSemi") < plan.index("Generate explode(")
    monkeypatch.setattr(Y, "SMALL_CATALOG", 0)
    assert of(Y.relationship_candidates(concepts)) == want


@pytest.mark.parametrize("query", [Q.ontology_edges, Q.ontology_nodes, O.compared_taxonomies])
def test_classes_are_written_once(spark, monkeypatch, query):
    written = []
    for module in (Q, O, Y):
        own = module.cut
        monkeypatch.setattr(module, "cut", lambda df, own=own: written.append(df.columns) or own(df))
    found = query(spark, "/root/testdata/sf0.001")
    assert sum({"concept", "definitions", "relationships", "source_chunks"} <= set(c) for c in written) == 1
    assert found.count() > 0 and "l_orderkey" not in optimized(found)


def test_occurrences_of_related_concepts_are_joined_once(spark, monkeypatch):
    seen, own = [], Q.occurrences
    monkeypatch.setattr(Q, "occurrences", lambda *a: seen.append(1) or own(*a))
    written, cut = [], Q.cut
    monkeypatch.setattr(Q, "cut", lambda df: written.append(df.columns) or cut(df))
    found = Q.related_concepts(spark, "/root/testdata/sf0.001")
    assert len(seen) == 1 and written == [["doc_id", "chunk_index", "p_name", "p_type"], ["doc_id", "concept", "terminology"]] and found.count() > 0

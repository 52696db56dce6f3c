"""Replies, frames, discovery, front matter and sources on small tables."""

import hashlib
import json
import random

from pyspark.sql import functions as F

from foliospark.operators import chunking as K
from foliospark.operators import discovery as D
from foliospark.operators import explorer as E
from foliospark.operators import frontmatter as W
from foliospark.operators import records as H
from foliospark.operators import responses as G
from foliospark.operators import structure as S
from foliospark.operators import taxonomy as T
from foliospark.sources import tables as A

BASE = {"schema_version": "2.0.0", "chunk_id": " c ", "source_fingerprint": "f"}


def replies(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "chunk_id_in long, response string")


def test_chunk_knowledge_is_strict(spark):
    good = BASE | {"concepts": [" a ", ""], "definitions": [{"term": "t", "definition": " d "}, "x"], "relationships": [{"source": "s", "target": "t", "relation": "r"}], "examples": [{"b": "2", "a": "1", "n": 3}],
                   "decision_rules": [{"condition": "c", "outcome": "o", "related_steps": [1, 2.0, " s "]}], "section_refs": [{"label": "l", "type": "t", "start_char": 0, "end_char": 2}]}
    bad = [None, "", "[1]", "{", json.dumps(BASE | {"odd": 1}), json.dumps(BASE | {"schema_version": "3"}), json.dumps(BASE | {"concepts": None}), json.dumps(BASE | {"concepts": [1]}), json.dumps(BASE | {"procedure_steps": [{"text": "t", "order": "1"}]}), json.dumps(BASE | {"section_refs": [{"label": "l"}]})]
    rows = G.parse_chunk_knowledge(replies(spark, json.dumps(good), *bad)).orderBy("chunk_id_in").collect()
    first = rows[0]
    assert first["ok"] and first["chunk_id"] == "c" and first["concepts"] == ["a"] and first["definitions"] == ["t: d", "x"]
    assert first["relationships"] == ["s -> t (r)"] and first["examples"] == ["a: 1; b: 2"] and first["decision_rules"][0]["related_steps"] == ["1", "2", "s"]
    assert len(rows) == 11 and not any(r["ok"] or r["concepts"] or not r["error"] for r in rows[1:])


def test_argument_replies_name_their_errors(spark):
    rows = G.parse_argument_chunks(replies(spark, '```json\nnote {"claims": [" a  b ", ""]} tail```', " ", "no object", '{"claims": "x"}', '{"odd": []}')).orderBy("chunk_id_in").collect()
    assert rows[0]["claims"] == ["a b"] and [r["error"] for r in rows] == [None, "llm_empty", "parse_fallback", "invalid_payload", "invalid_payload"]


def test_family_replies(spark):
    rows = G.parse_family_discovery(replies(spark, 'x {"families": [{"family_label": " f\n ", "members": ["a ", 1, ""]}]} y', "{}").withColumnRenamed("chunk_id_in", "doc_id")).orderBy("doc_id").collect()
    assert rows[0]["families"][0]["family_label"] == "f" and rows[0]["families"][0]["members"] == ["a"] and not rows[1]["ok"]


def test_linear_steps_and_struct_fields(spark):
    texts = {c: "array<string>" for c in H.TEXTS}
    row = {c: [] for c in H.TEXTS} | {c: [] for c in H.STRUCTS}
    row |= {"procedures": ["To determine the lord: identify the sign; determine its ruler, and interpret both."], "author_variants": [{"author": "valens", "kind": "Method", "text": " x  y ", "related_steps": ["1", "1", ""]}] * 2, "preconditions": [{"text": "Day", "scope": None, "related_steps": None}] * 2}
    df = spark.createDataFrame([row], ", ".join(f"{c} {t}" for c, t in (texts | H.STRUCTS).items()))
    got = H.normalize_records(df, {"valens": "Vettius Valens"}).first()
    assert [s["text"] for s in got["procedure_steps"]] == ["identify the sign", "determine its ruler", "interpret both"]
    assert got["procedure_steps"][0]["id"] == "step-001-identify-the-sign" and len(got["author_variants"]) == len(got["preconditions"]) == 1
    assert got["procedures"][-1] == "Vettius Valens [method]: x y" and "Precondition: Day" in got["procedures"]


def test_clamp_by_confidence(spark):
    rows = [(p, d, "doctrinal_text", t, ["x"] * 10, ["t"] * 20) for p, d, t in (("high", "extract", ""), ("medium", "extract", ""), ("low", "extract", "a: b\nc: d"), ("contaminated", "skip", ""))]
    df = spark.createDataFrame(rows, "confidence_profile string, decision string, chunk_type string, chunk_text string, concepts array<string>, terminology array<string>")
    df = df.withColumns({c: F.array().cast("array<string>") for c in H.TEXTS if c not in ("concepts", "terminology")})
    got = H.post_extraction_clamp(df).collect()
    assert [(len(r["concepts"]), len(r["terminology"])) for r in got] == [(10, 20), (8, 12), (4, 5), (0, 0)]
    assert got[0]["clamp_actions"] == [] and "cap_concepts_8" in got[1]["clamp_actions"] and "clear_terminology" in got[3]["clamp_actions"]


def replayed(nodes, edges):
    """{(doc, node): (chunks, kind)} after the edges, applied one by one."""
    chunks, kinds = {(d, n): set(c) for d, n, c in nodes}, {(d, n): "topic" for d, n, _ in nodes}
    for d, parent, child in sorted(set(edges)):
        if (d, parent) in chunks and (d, child) in chunks:
            chunks[d, parent] |= chunks[d, child]
            kinds[d, child], kinds[d, parent] = "subconcept", "classification"
    return {k: (sorted(c), kinds[k]) for k, c in chunks.items()}


def applied(spark, nodes, edges):
    made = T.apply_taxonomy_links(spark.createDataFrame(nodes, "doc_id long, node string, source_chunks array<int>"), spark.createDataFrame(edges, "doc_id long, parent string, child string"))
    return {(r["doc_id"], r["node"]): (r["source_chunks"], r["node_kind"]) for r in made.collect()}


def test_chunks_are_absorbed_in_order_of_links(spark):
    nodes = [(1, n, [i]) for i, n in enumerate("abcd")]
    edges = [(1, "a", "b"), (1, "b", "c"), (1, "b", "c")]
    got = applied(spark, nodes, edges)
    assert got == replayed(nodes, edges) and got[1, "a"] == ([0, 1], "classification") and got[1, "b"] == ([1, 2], "classification") and got[1, "d"] == ([3], "topic")


def test_front_matter_budget(spark):
    docs = spark.createDataFrame([(1, "Preface of it " * 5 + "Introduction\n" + "body " * 50), (2, "plain text only"), (3, "")], "doc_id long, text string")
    sections = spark.createDataFrame([(1, "Preface", "front_matter", 0, 70), (1, "Introduction", "section", 70, 330)], "doc_id long, label string, type string, start_char int, end_char int")
    headings = spark.createDataFrame([(1, 0, "Introduction", 70)], "doc_id long, index int, text string, start_char int")
    got = {r["doc_id"]: r for r in W.front_matter_input(docs, sections, headings, 6, 100, 10).collect()}
    assert got[1]["strategy"] == "mixed" and got[1]["has_preface"] and got[1]["has_introduction"] and sum(len(e["text"]) for e in got[1]["excerpts"]) <= 100
    assert got[2]["strategy"] == "initial_excerpt" and got[2]["excerpts"][0]["text"] == "plain text" and 3 not in got


def test_sources_and_sidecars(spark, tmp_path):
    (tmp_path / "a.txt").write_text("böok\ntext")
    (tmp_path / "b.rtf").write_text("x")
    rows = {r["source_path"].rsplit("/", 1)[1]: r for r in A.read_text_books(spark, str(tmp_path)).collect()}
    assert rows["a.txt"]["text"] == "böok\ntext" and rows["b.rtf"]["error"] and rows["b.rtf"]["text"] is None
    sections = spark.createDataFrame([(1, 1, "section_5", "b", "unknown", 5, 9, 0.0, None, None), (1, 0, "section_0", " A  x", "section", 0, 5, 1.0, 2, 1)], "doc_id long, section_index int, id string, label string, type string, start_char int, end_char int, confidence double, start_page long, end_page long")
    headings = spark.createDataFrame([(1, 0, "A x", "section")], "doc_id long, index int, text string, type string")
    maps = S.document_maps(spark.createDataFrame([(1, "A x\ny bb"), (2, None)], "doc_id long, text string"), headings, sections)
    schema = ", ".join(f"`{c}` {t}" for c, t in maps.dtypes if c != "doc_id")
    sidecars = A.to_sidecar(maps, "3")
    back = {r["doc_id"]: r for r in A.from_sidecar(sidecars, schema).collect()}
    assert [x["label"] for x in back[1]["sections"]] == [" A  x", "b"] and back[1]["metadata"]["generator"] == S.GENERATOR and back[1]["stats"]["unknown_sections"] == 1
    assert back[1]["text_hash"] == hashlib.sha256(b"A x\ny bb").hexdigest() and back[1]["normalized_text_length"] == 8 and back[2]["sections"] == []
    cleaned = {r["doc_id"]: r for r in A.from_sidecar(A.clean_sidecar(sidecars, schema), schema).collect()}
    assert cleaned[1]["metadata"]["postprocess"] == "document_map_cleaner_v1" and [(x["label"], x["end_page"]) for x in cleaned[1]["sections"]] == [("A x", 2), ("b", 2)]
    assert A.from_sidecar(spark.createDataFrame([(5, "{")], "doc_id long, sidecar string"), schema).first()["sections"] is None
    pages = spark.createDataFrame([(1, 2, None), (1, 1, "x")], "doc_id long, page_index int, raw_text string")
    pages.write.parquet(str(tmp_path / "pages"))
    pages.write.json(str(tmp_path / "pages.json"))
    for path in ("pages", "pages.json"):
        assert sorted(tuple(r) for r in A.read_pages(spark, str(tmp_path / path)).collect()) == [(1, 1, "x"), (1, 2, "")]
    A.write_artifact(sections, str(tmp_path / "out"), "json", 2)
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    catalog = spark.createDataFrame([(" f ", "L ", [" a ", " "], None), ("", "x", [], [])], "id string, label string, aliases array<string>, controlled_patterns array<string>")
    assert [tuple(r) for r in A.load_family_catalog(catalog).collect()] == [("f", "L", ["a"], [])]


def test_relations_by_bucket(spark):
    rows = [("a", "from: A; to: Day; type: Contrasts"), ("a", "details: from: moon; to: a; type: depends on"), ("a", "it depends on x"), ("a", "type: use"), ("a", "to:  the  Sun; type: near"), ("a", "to: a; type: use")]
    df = spark.createDataFrame(rows, "concept string, text string")
    want = [("contrasts_with", "day"), ("depends_on", "moon"), ("related_to", "it depends on x"), ("related_to", "type: use"), ("related_to", "the sun"), ("related_to", "to: a; type: use")]
    assert [(r["bucket"], r["counterpart"]) for r in E.parse_relations(df).collect()] == want


def test_absorbed_chunks_equal_a_replay(spark):
    rng = random.Random(4)
    names = "abcdefgh"
    edges = [(doc, *rng.sample(names, 2)) for doc in range(40) for _ in range(rng.randrange(1, 9))]
    nodes = [(doc, n, rng.sample(range(200), rng.choice([0, 1, 40]))) for doc in range(40) for n in names]
    want = {k: (sorted(c), kind) for k, (c, kind) in replayed(nodes, edges).items()}
    assert {k: (sorted(c), kind) for k, (c, kind) in applied(spark, nodes, edges).items()} == want


def test_legacy_children(spark):
    nodes = spark.createDataFrame([(1, n, [i]) for i, n in enumerate(("x", "y", "kin"))], "doc_id long, node string, source_chunks array<int>")
    none = nodes.selectExpr("doc_id", "node AS parent", "node AS child").limit(0)
    legacy = spark.createDataFrame([("up", ["y", "x", "z"], ["kin"])], "parent string, children array<string>, related array<string>")
    got = {r["node"]: r for r in T.apply_legacy_children(T.apply_taxonomy_links(nodes, none), legacy).collect()}
    assert got["up"]["child_concepts"] == ["x", "y"] and got["up"]["source_chunks"] == [0, 1] and got["up"]["node_kind"] == "classification"
    assert got["x"]["parent_concepts"] == ["up"] and got["kin"]["related_concepts"] == ["up"] and got["up"]["related_concepts"] == ["kin"]


def test_names_are_found_whole(spark):
    df = spark.createDataFrame([("the c++ and o'x", "c++"), ("abc", "b"), ("a.b.c", "b"), ("x\\E y", "x\\e"), ("x\\e y", "x\\e")], "t string, n string")
    assert [r[0] for r in df.select(T.names_exactly(F.col("t"), F.col("n"))).collect()] == [True, False, True, False, True]


def test_chosen_chunks(spark):
    choice = spark.createDataFrame([(1, "structural", None), (2, "legacy", "x")], "doc_id long, mode string, reason string")
    windows = spark.createDataFrame([(d, i, 0, 5, f"w{d}{i}") for d in (1, 2, 3) for i in (1, 2)], "doc_id long, chunk_index int, start_char int, end_char int, text string")
    made = spark.createDataFrame([(d, 0, f"chunk_0_0_{d}", "s", 0, 5, "t") for d in (1, 2)], "doc_id long, chunk_index int, chunk_id string, section_id string, start_char int, end_char int, text string")
    got = sorted((r["doc_id"], r["chunk_index"], r["chunk_id"], r["text"]) for r in K.chosen_chunks(choice, made, windows).collect())
    assert got == [(1, 1, "chunk_0_0_1", "t"), (2, 1, "legacy_chunk_1", "w21"), (2, 2, "legacy_chunk_2", "w22"), (3, 1, "legacy_chunk_1", "w31"), (3, 2, "legacy_chunk_2", "w32")]


def test_broken_maps_are_named(spark):
    docs = spark.createDataFrame([(1, "0123456789"), (2, "x")], "doc_id long, text string")
    headings = spark.createDataFrame([(1, 0, 0, 0, 0.5), (1, 0, 2, 4, 1.5)], "doc_id long, index int, start_char int, end_char int, score double")
    sections = spark.createDataFrame([(1, 0, "section_0", "a", "x", 0, 4, 1.0, 1, 1), (1, 2, "section_9", "", "x", 5, 12, 1.0, 3, 2)], "doc_id long, section_index int, id string, label string, type string, start_char int, end_char int, confidence double, start_page int, end_page int")
    maps = spark.createDataFrame([(1, "0"), (2, hashlib.sha256(b"x").hexdigest())], "doc_id long, text_hash string")
    got = sorted((r["doc_id"], r["rule"]) for r in S.validate_document_map(headings, sections, docs, 6, maps).collect())
    want = ["heading_offsets", "heading_repeated", "heading_score", "section_coverage", "section_end", "section_id", "section_index", "section_label", "section_offsets", "section_pages", "section_size", "text_hash"]
    assert got == sorted([(1, r) for r in want] + [(2, "section_missing")])


def test_default_book(spark):
    df = spark.createDataFrame([("Vol 2",), ("Volume 11 x",), ("no number",), (None,)], "title string")
    assert E.default_book(df).first()["title"] == "Volume 11 x"


def test_extract_knowledge_end_to_end(spark):
    from foliospark.operators.knowledge import extract_knowledge

    text = "The ruler of the sign shows the matter in question, and its strength depends on the house. " * 12
    chunks = spark.createDataFrame([("a", text, []), ("b", "", []), ("c", text, [])], "chunk_id string, text string, section_refs array<struct<label:string,type:string>>")
    reply = BASE | {"concepts": ["ruler", "Ruler "], "technical_rules": ["If the ruler is strong, then the matter succeeds.", "copyright of the publisher"], "definitions": ["ruler: a planet"]}
    got = {r["chunk_id"]: r for r in extract_knowledge(chunks, spark.createDataFrame([("a", json.dumps(reply)), ("b", json.dumps(reply)), ("c", "broken")], "chunk_id string, response string")).collect()}
    a = got["a"]
    assert a["parse_ok"] and a["concepts"] == ["ruler"] and a["decision"] == "extract" and a["decision_rules"][0]["outcome"] == "the matter succeeds"
    assert a["technical_rules"] == [] and a["definitions"] == [] and "clear_editorial_technical_rules" in a["filter_actions"]
    assert got["b"]["decision"] == "skip" and got["b"]["concepts"] == [] and not got["c"]["parse_ok"]


def test_front_matter_replies(spark):
    good = {"family_candidates": [{"name": " f ", "confidence": 7, "status": "odd"}], "normalization_hints": [{"canonical": "c", "variants": ["v"]}]}
    rows = G.parse_front_matter(replies(spark, "x " + json.dumps(good), "", json.dumps({"odd": 1}), json.dumps({"provisional_taxonomy": [{"parent": "p"}]})).withColumnRenamed("chunk_id_in", "doc_id")).orderBy("doc_id").collect()
    assert rows[0]["ok"] and rows[0]["family_candidates"][0]["confidence"] == 1.0 and rows[0]["family_candidates"][0]["status"] == "candidate"
    assert [r["ok"] for r in rows] == [True, False, False, False] and rows[2]["confidence_notes"][0].startswith("parse_fallback")


def test_merged_concept_maps(spark):
    schema = "doc_id long, concept string, display_name string, node_kind string, terms array<string>"
    a = spark.createDataFrame([(1, " A ", "", "concept", ["x", "y"])], schema)
    b = spark.createDataFrame([(1, "a", "Alpha", "classification", ["y", "z"]), (1, "", "n", "concept", [])], schema)
    assert [tuple(r) for r in E.merge_concept_maps(a, b, ["terms"]).collect()] == [(1, "a", "Alpha", "classification", ["x", "y", "z"])]


def test_names_of_a_domain_are_told_by_its_patterns(spark):
    from foliospark.operators import concepts as C

    names = ["relationship between first and fifth house", "template for planetary and house delineation", "planet in house 8 12 interpretation", "fifth house signification in traditional astrology", "whole sign house system", "porphyry house system", "interpret house strength", "rules of the market"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    valid = lambda **rules: [r["name"] for r in df.where(C.is_valid_name(F.col("name"), **rules)).collect()]
    assert valid() == ["whole sign house system", "porphyry house system", "rules of the market"]
    assert valid(narrative=[r"\bof the market\b"]) == [n for n in names if n != "rules of the market" and not n.startswith("interpret")]


def test_vocabulary_of_records_is_a_table(spark):
    none = {c: F.array().cast("array<string>") for c in H.TEXTS} | {c: F.array().cast(t) for c, t in H.STRUCTS.items()}
    record = spark.range(1).select(*[v.alias(c) for c, v in none.items()]).withColumns({"procedures": F.array(F.lit("Brewing: heat the water, then pour; stir it"), F.lit("not for resale")), "concepts": F.array(F.lit("new wave"), F.lit("old way"))})
    plain = H.normalize_records(record).first()
    assert plain["procedure_steps"] == [] and H.semantic_filter(record).first()["procedures"] == ["Brewing: heat the water, then pour; stir it", "not for resale"]
    words = H.VOCABULARY._replace(linear_lead="(?i)^brewing:", linear_heads=("(?i)^brewing: ",), linear_split=r"(?i);|,\s+(?=then )", actions="(?i)^(heat|stir) ", editorial="resale", modern=r"\bnew\b")
    assert [x["text"] for x in H.normalize_records(record, words=words).first()["procedure_steps"]] == ["heat the water", "stir it"]
    kept = H.semantic_filter(record, words=words).first()
    assert kept["procedures"] == ["Brewing: heat the water, then pour; stir it"] and kept["concepts"] == ["old way"] and kept["ambiguities"] == ["new wave"]


def test_family_catalog_of_a_file(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps([{"id": " f1 ", "label": "One", "aliases": [" a ", ""], "controlled_patterns": ["p"]}, {"id": "", "label": "x"}, {"id": "f2", "label": "Two"}], indent=1))
    got = {r["family_id"]: (r["label"], r["aliases"], r["controlled_patterns"]) for r in A.read_family_catalog(spark, str(tmp_path / "f.json")).collect()}
    assert got == {"f1": ("One", ["a"], ["p"]), "f2": ("Two", [], [])}


def test_promotion_takes_any_number_of_names_in_one_plan(spark):
    from foliospark.operators import concepts as C
    from foliospark.operators import consolidation as B

    empty = {f: F.array().cast("array<string>") for f in C.TEXT_FIELDS}
    given = {"definitions": F.array(F.lit("name 7: seven"), F.lit("kid 3a: first"), F.lit("kid 3b: second")), "relationships": F.array(F.lit("the name 7 is near")), "terminology": F.array(F.lit("x"))}
    concepts = spark.range(2).select(F.col("id").alias("doc_id"), F.lit("mark 3 of all").alias("concept"), *[given.get(f, v).alias(f) for f, v in empty.items()], F.array("id").alias("source_chunks"))
    lines = []
    for n in (10, 2000):
        rules = B.ConceptRules(allowed=tuple(f"name {i}" for i in range(n)), parents=tuple(B.Parent(f"parent {i}", (f"other {i}",), (f"mark {i} ",), (f"kid {i}a", f"kid {i}b")) for i in range(n // 5 + 2)))
        made = B.with_promoted(concepts, rules)
        lines.append(made._jdf.queryExecution().optimizedPlan().toString().count("\n"))
        got = {r["concept"]: (r["definitions"], r["terminology"], r["promoted"]) for r in made.where("doc_id = 1").collect()}
        assert got == {"mark 3 of all": (["name 7: seven", "kid 3a: first", "kid 3b: second"], ["x"], False), "name 7": (["name 7: seven"], [], True), "parent 3": (["kid 3a: first", "kid 3b: second"], ["Kid 3a", "Kid 3b"], True)}
    assert lines[0] == lines[1]


def test_words_and_items_are_made_once(spark):
    from foliospark.functions.textnorm import surface
    from foliospark.operators import concepts, families, procedural

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    texts = spark.createDataFrame([(1, "a b c")], "doc_id int, t string").repartition(1)
    assert plan(texts.select(families.ngrams(surface(F.col("t")), 1, 3).alias("x"))).count("split(") == 1
    assert sorted(texts.select(families.ngrams(surface(F.col("t")), 1, 3)).first()[0]) == ["a", "a b", "a b c", "b", "b c", "c"]
    assert plan(texts.select(concepts.normalize_concept_name(F.col("t")).alias("x"))).count("lower(") == 1
    rows = [(1, "x", "procedure_outputs", 3, 0, '{"text":" so  be it "}'), (1, "x", "procedure_steps", 2, 0, '{"order":2,"text":"step 1: go."}'), (1, "x", "procedure_steps", 2, 1, '{"order":3,"text":"2."}'), (1, "x", "other", 2, 1, "{}")]
    items = spark.createDataFrame(rows, "doc_id int, concept string, field string, chunk_index int, pos int, item string").repartition(2)
    merged = procedural.merge_procedural_fields(items)
    assert "Union" not in plan(merged)
    assert sorted((r["field"], r["value"], tuple(r["at"])) for r in merged.collect()) == [("procedure_outputs", '{"text":"so be it"}', (3, 0)), ("procedure_steps", '{"order":2,"text":"go"}', (2, 0))]


def test_chunk_places_are_not_broadcast(spark):
    """Tables of a few short columns a piece look small in their files; joins of the packing shuffle them, and choosing does too."""
    from foliospark.functions.pointers import on_chain

    atoms = spark.createDataFrame([(d, i, i * 100, i * 100 + 100, False, False) for d in (1, 2) for i in range(9)], "doc_id int, at int, start_char int, end_char int, is_weak boolean, wall boolean")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    edges = K.pack_successors(atoms, 300, 100)
    assert "BroadcastExchange" not in plan(edges)
    assert sorted(tuple(r) for r in on_chain(edges, atoms.where("at = 0").select("doc_id", "at"), ["doc_id"]).collect()) == [(d, i) for d in (1, 2) for i in (0, 3, 6)]
    quality = spark.createDataFrame([(1, 5, None)], "doc_id int, sections_generated int, reason string")
    chunks = spark.createDataFrame([(1, "t" * 900)], "doc_id int, text string")
    choice = K.choose_chunking(quality, chunks, chunks, 300, spark.createDataFrame([(2,)], "doc_id int"))
    assert "BroadcastExchange" not in plan(choice) and [tuple(r) for r in choice.collect()] == [(1, "structural", None)]

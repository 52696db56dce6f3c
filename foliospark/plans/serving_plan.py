"""Trees, evidence, frames and discovery over the concepts of `lineitem`, `orders` and `part`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.lineage import cut
from foliospark.operators import discovery as D
from foliospark.operators import explorer as E
from foliospark.operators import frames as L
from foliospark.operators import procedural as P
from foliospark.plans.concepts_plan import OCC, catalog, corpus_concepts, joined, named, occurrences
from foliospark.sources.tables import read_table


def names(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's parts, in families by their last word."""
    return occurrences(spark, d).select("doc_id", F.col("p_name").alias("concept"), F.element_at(F.split("p_name", " "), -1).alias("family_id")).distinct()


#: First words of parts that are above others: a chain, a cycle and a self link.
ABOVE = {"red": ("blue",), "blue": ("cold", "old"), "cold": ("blue",), "hot": ("hot", "old")}


def tree_edges(n: DataFrame) -> DataFrame:
    """Of names: doc_id, parent, child: from each part of a customer to those of the same last word that ABOVE puts below it."""
    below = F.create_map(*[x for a, bs in ABOVE.items() for x in (F.lit(a), F.array(*map(F.lit, bs)))])
    n = n.select("doc_id", F.col("concept").alias("parent"), "family_id", F.explode(below[F.split("concept", " ")[0]]).alias("b"))
    return n.select("doc_id", "parent", F.concat_ws(" ", "b", "family_id").alias("child"))


def family_tree(spark: SparkSession, d: str) -> DataFrame:
    n = cut(names(spark, d))
    t = E.family_tree_paths(tree_edges(n), n)
    return t.select("doc_id", "family_id", F.array_join("path", ">").alias("path"), "depth")


def family_tree_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The same trees as tables, with counts instead of ways."""
    n = cut(names(spark, d))
    t = E.family_tree(tree_edges(n), n)
    return t.withColumns({"ways": F.col("ways").cast("long"), "depth": F.col("depth").cast("long")})


def breadcrumb_paths(spark: SparkSession, d: str) -> DataFrame:
    return E.breadcrumbs(tree_edges(names(spark, d)).where("parent <> child")).select("doc_id", "concept", F.array_join("path", ">").alias("path"))


def families_of_concepts(spark: SparkSession, d: str) -> DataFrame:
    """Families of red and hot parts as given, and of old parts by their own lists."""
    n = names(spark, d)
    given = n.where("concept RLIKE '^(red|hot) '").groupBy("doc_id", "family_id").agg(F.sort_array(F.collect_set("concept")).alias("members"))
    own = n.select("doc_id", "concept", F.when(F.startswith("concept", F.lit("old ")), F.array("family_id", F.lit("aged"))).otherwise(F.array().cast("array<string>")).alias("families"))
    return E.family_map(given, own).select("doc_id", "family_id", joined("members"))


def frame_of_concepts(spark: SparkSession, d: str) -> DataFrame:
    """Two frames a customer, which share a part: the last one counts."""
    word = lambda *ws: F.array(*map(F.lit, ws))
    both = F.array(F.struct(F.lit(1).alias("ord"), F.lit("first").alias("frame_id"), word("red ring", "hot ring").alias("members")), F.struct(F.lit(2).alias("ord"), F.lit("second").alias("frame_id"), word("red ring", "old gear").alias("members")))
    n = names(spark, d)
    return E.frame_index(n.select("doc_id").distinct().select("doc_id", F.inline(both)), n)


def relation_lists(spark: SparkSession, d: str) -> DataFrame:
    """Relations of each part in text, of every form, by bucket."""
    head, name = F.col("family_id"), F.col("concept")
    said = F.array(
        F.concat(F.lit("from: "), name, F.lit("; to: Old "), head, F.lit("; type: contrast")), F.concat(F.lit("to: new "), head, F.lit("; type: Requires")), F.concat(F.lit("Details: from: hot "), head, F.lit("; type: used in")),
        F.concat(F.lit("from: red "), head, F.lit("; to: "), name, F.lit("; type: near")), F.lit("as told of old"), F.lit("type: contrast"), F.concat(F.lit("from: "), name, F.lit("; to: old  "), head, F.lit("; type: opposite of")),
    )
    c = names(spark, d).select("doc_id", "concept", F.array(F.concat(F.lit("red "), head), F.lit("")).alias("related_concepts"), said.alias("relationships"))
    return E.relation_buckets(c).select("doc_id", "concept", "bucket", joined("counterparts"))


def evidence_texts(spark: SparkSession, d: str) -> DataFrame:
    o = occurrences(spark, d)
    c = o.groupBy("doc_id", F.col("p_name").alias("concept")).agg(F.collect_set("chunk_index").alias("source_chunks"))
    texts = o.where("chunk_index % 2 = 0").groupBy("doc_id", F.col("chunk_index").alias("chunk")).agg(F.min("p_type").alias("text"))
    return E.evidence_chunks(c, texts)


def structural_parents(spark: SparkSession, d: str) -> DataFrame:
    """Orders with two of a customer's red, hot and old rings, under the parent `red ring`."""
    c = occurrences(spark, d).groupBy("doc_id", F.col("p_name").alias("concept")).agg(F.collect_set("chunk_index").alias("source_chunks"))
    specs = spark.range(1).select(F.lit("red ring").alias("parent"), F.array(F.lit("red ring"), F.lit("hot ring"), F.lit("old ring")).alias("children"), F.lit(2).alias("min_children"))
    found = P.project_structural_parents(c, E.chunk_to_concepts(c), specs)
    return found.select("doc_id", "parent", "chunk", joined("children"))


def procedures(spark: SparkSession, d: str) -> DataFrame:
    """Rules and outputs of an order's parts, given to the concepts that they name."""
    none = F.array().cast("array<string>")
    rules = F.transform("definitions", lambda t: F.struct(F.concat(F.lit("If "), t).alias("condition"), F.lit(" keep  it.").alias("outcome"), none.alias("related_steps")))
    outputs = F.transform("terminology", lambda t: F.struct(t.alias("text")))
    return P.procedure_table(P.project_procedural_items(named(spark, d).withColumns({"decision_rules": rules, "procedure_outputs": outputs}), ["decision_rules", "procedure_outputs"]))


def shown_rules(column: str = "decision_rules") -> Column:
    return F.array_join(F.transform(column, lambda r: F.concat_ws("=>", r["condition"], r["outcome"])), "|").alias("rules")


def procedural_items(spark: SparkSession, d: str) -> DataFrame:
    evidence = F.array_join(F.transform(F.filter("procedure_evidence", lambda e: e["field"] == "decision_rules"), lambda e: F.concat_ws("=", e["chunk_index"].cast("string"), F.get_json_object(e["value"], "$.condition"))), "|").alias("evidence")
    outputs = F.array_join(F.transform("procedure_outputs", lambda o: o["text"]), "|").alias("outputs")
    return procedures(spark, d).select("doc_id", "concept", shown_rules(), outputs, evidence)


def final_procedures(spark: SparkSession, d: str) -> DataFrame:
    """Steps from rules, and the procedures as text."""
    p = P.finalize_procedures(procedures(spark, d))
    return p.select("doc_id", "concept", F.array_join(F.transform("procedure_steps", lambda s: F.concat_ws(". ", s["order"].cast("string"), s["text"])), "|").alias("steps"), joined("procedures"))


def audited_procedures(spark: SparkSession, d: str) -> DataFrame:
    """The concepts with procedural items."""
    p = P.procedural_audit(procedures(spark, d))
    return p.select("doc_id", "concept", shown_rules(), F.size("procedure_evidence").cast("long").alias("n_evidence"))


def frame_concepts(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's parts with rules of every kind, and for some a step, an output, variants and technical rules."""
    o = occurrences(spark, d).groupBy("doc_id", F.col("p_name").alias("concept")).agg(F.sort_array(F.collect_set("p_type")).alias("t"), F.min("p_brand").alias("brand"), F.sort_array(F.collect_set(F.col("chunk_index").cast("int"))).alias("source_chunks"))
    first = F.split("concept", " ")[0]
    tail = F.when(first == "small", ", strong.").otherwise(".")
    rules = F.transform("t", lambda t: F.struct(F.concat(F.lit("if "), t).alias("condition"), F.concat(F.lit("take the "), F.col("concept"), tail).alias("outcome")))
    variant = lambda kind, *text: F.struct(F.col("brand").alias("author"), F.lit(kind).alias("kind"), F.concat(*text).alias("text"))
    some = lambda when, items, c: F.when(when, items).otherwise(F.array().cast(L.FIELDS[c]))
    given = {
        "rules": some(~first.isin("new", "cold"), rules, "rules"), "steps": some(first == "old", F.array(F.struct(F.lit(1).alias("order"), F.lit("look up").alias("text"))), "steps"), "source_chunks": F.col("source_chunks"),
        "outputs": some(first == "new", F.array(F.concat(F.lit("note  the "), F.col("concept"), F.lit("."))), "outputs"), "definitions": some(first == "large", F.array(F.lit("timing of it")), "definitions"),
        "variants": some(first == "cold", F.array(variant("rule", F.lit("Assigns the "), F.col("concept")), variant("rule", F.lit("whole set of "), F.col("concept")), variant("other", F.lit("leave "), F.col("concept")), variant("Other", F.lit("Leave "), F.col("concept"))), "variants"),
        "technical_rules": some(first == "blue", F.array(F.concat(F.lit("When it is old, keep the "), F.col("concept"), F.lit(".")), F.lit("Consider if it is whole, new"), F.lit("in good order always"), F.lit("If so")), "technical_rules"),
        "related": F.array(F.lit("red ring"), F.concat(F.lit("kin of "), F.col("concept"))),
    }
    return o.select("doc_id", "concept", *[given.get(c, F.array().cast(t)).alias(c) for c, t in L.FIELDS.items()])


#: Rule tables for the parts' frames, given as data.
FRAME_RULES = L.FrameRules(fallback=("hot ring",), note=("whole set",), selects=(("assigns the cold rod", "select the cold rod"),), preludes=(L.Prelude("consider if", 12),), conditions=("in good order",), scope="use")


def frame_specs(spark: SparkSession) -> DataFrame:
    strings = lambda *xs: F.array(*map(F.lit, xs)).cast("array<string>")
    given = (
        ("rings", "selection", "Rings", strings("red ring", "hot ring"), strings("old ring", "red ring"), strings("economy")), ("gears", "evaluation", "Gears", strings("blue gear"), strings(), strings()), ("rods", "selection", "Rods", strings("cold rod"), strings("new rod"), strings()),
    )
    rows = [F.struct(F.lit(i).alias("frame_id"), F.lit(t).alias("frame_type"), F.lit(n).alias("label"), F.lit("Pick").alias("goal"), a.alias("anchors"), s.alias("supports"), strings().alias("include"), x.alias("exclude")) for i, t, n, a, s, x in given]
    return spark.range(1).select(F.inline(F.array(*rows)))


def shown(frames: DataFrame) -> DataFrame:
    rule = lambda c: F.array_join(F.transform(c, lambda r: F.concat_ws("=>", r["condition"], r["outcome"])), "|").alias(c)
    text = lambda c: F.array_join(F.transform(c, lambda r: r["text"]), "|").alias(c)
    return frames.select("doc_id", "frame_id", "frame_type", "label", joined("anchor_concepts"), joined("supporting_concepts"), rule("rules"), rule("fallback_rules"), text("steps"), text("preconditions"), text("author_methods"), text("author_overrides"), text("methodological_notes"), joined("outputs"), joined("related_concepts"), joined("source_chunks"))


def procedure_frames(spark: SparkSession, d: str) -> DataFrame:
    return shown(L.build_procedure_frames(frame_concepts(spark, d), frame_specs(spark), FRAME_RULES))


def automatic_frames(spark: SparkSession, d: str) -> DataFrame:
    """Frames of the parts that aren't rings."""
    c = frame_concepts(spark, d)
    covered = c.where("concept LIKE '% ring'").select("doc_id", F.array("concept").alias("anchor_concepts"), F.array().cast("array<string>").alias("supporting_concepts"))
    return L.auto_frames(c, covered, FRAME_RULES).select("doc_id", "frame_id", "frame_type", "label", "goal", F.array_join(F.transform("steps", lambda s: F.concat_ws(". ", s["order"].cast("string"), s["text"])), "|").alias("steps"), joined("outputs"))


def localized_frames(spark: SparkSession, d: str) -> DataFrame:
    """The frames in other words; of all but rods only the texts that the tables name change."""
    f = L.build_procedure_frames(frame_concepts(spark, d), frame_specs(spark), FRAME_RULES)
    f = L.localize_frames(f, {"note the new rod.": "señala la barra nueva"}, [("leave", "deja"), ("cold rod", "barra fría")], [(r"^Assigns\b", "Asigna")], {"rods": "Barras"}, {"rods": "Elegir"})
    text = lambda c: F.array_join(F.transform(c, lambda r: r["text"]), "|").alias(c)
    return f.select("doc_id", "label", "goal", text("author_methods"), text("author_overrides"), joined("outputs"))


def discovered_families(spark: SparkSession, d: str) -> DataFrame:
    """Rules whose members overlap: the second one loses two of four."""
    word = lambda *ws: F.array(*[F.lit(f"{w} ring") for w in ws])
    rules = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(i).alias("rule_order"), F.lit(n).alias("family_label"), m.alias("members"), F.lit("shared").alias("rationale")) for i, (n, m) in enumerate((("plain", word("red", "blue", "old", "odd")), ("warm", word("hot", "red", "blue", "cold")), ("size", word("small", "large", "red", "new"))))])))
    f = D.discover_families(occurrences(spark, d).select("doc_id", F.col("p_name").alias("concept")).distinct(), rules)
    return f.select("doc_id", "family_label", joined("members"))


def checked_families(spark: SparkSession, d: str) -> DataFrame:
    """Five candidates of each customer's rings, rods, gears and plates: in the catalog, sound or with a member that may be unknown, over the one before, generic, without a label."""
    n = names(spark, d)
    own = n.groupBy("doc_id").agg(*[F.sort_array(F.collect_list(F.when(F.col("family_id") == h, F.col("concept")))).alias(h) for h in ("ring", "rod", "gear", "plate")])
    some = lambda h, ord_, name, members: F.when(F.size(h) > 0, F.struct(F.lit(ord_).alias("ord"), F.lit(name).alias("family_label"), members.alias("members")))
    given = F.array_compact(F.array(
        some("ring", 0, "Ring", F.col("ring")), some("rod", 1, "fine", F.concat("rod", F.array(F.lit(" old rod ")))), some("rod", 2, "late", F.concat("rod", "gear")), some("gear", 3, "general terms", F.col("gear")), some("plate", 4, "", F.col("plate")),
    ))
    f = D.validate_family_candidates(own.select("doc_id", F.inline(given)), n, catalog(spark, d), ("new gear",))
    return f.select("doc_id", "ord", "family_label", joined("members"), joined("reasons"), "accepted")


O = "WITH occ AS (SELECT o_custkey AS doc_id, l_orderkey AS chunk_index, p_name, p_type FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"  # noqa: E741
N = "WITH RECURSIVE n AS (SELECT DISTINCT o_custkey AS doc_id, p_name AS concept, split_part(p_name, ' ', 2) AS f FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey), e AS (SELECT doc_id, f, concept AS parent, b || ' ' || f AS child FROM n JOIN (VALUES ('red', 'blue'), ('blue', 'cold'), ('cold', 'blue'), ('hot', 'old'), ('blue', 'old')) AS v(a, b) ON a = split_part(concept, ' ', 1))"
FR = O + """, m AS (SELECT doc_id, p_name, split_part(p_name, ' ', 1) AS a, list_sort(list(DISTINCT p_type)) AS t, list_sort(list(DISTINCT chunk_index)) AS chunks FROM occ GROUP BY ALL),
c AS (SELECT doc_id, max(CASE p_name WHEN 'red ring' THEN t END) AS rr, max(CASE p_name WHEN 'hot ring' THEN t END) AS hr, max(CASE p_name WHEN 'old ring' THEN t END) AS orr, max(CASE p_name WHEN 'blue gear' THEN t END) AS bg,
  max(CASE p_name WHEN 'red ring' THEN chunks END) AS rrc, max(CASE p_name WHEN 'hot ring' THEN chunks END) AS hrc, max(CASE p_name WHEN 'old ring' THEN chunks END) AS orc, max(CASE p_name WHEN 'blue gear' THEN chunks END) AS bgc,
  max(CASE p_name WHEN 'cold rod' THEN chunks END) AS crc, max(CASE p_name WHEN 'new rod' THEN chunks END) AS nrc FROM m GROUP BY 1),
g AS (SELECT *, list_filter(list_concat(list_transform(coalesce(rr, []), lambda x: [x, 'take the red ring']), list_transform(coalesce(hr, []), lambda x: [x, 'take the hot ring']), list_transform(coalesce(orr, []), lambda x: [x, 'take the old ring'])), lambda x: x[1] <> 'ECONOMY') AS rings,
  list_concat(list_transform(coalesce(bg, []), lambda x: [x, 'take the blue gear']), [['it is old', 'keep the blue gear']]) AS gears FROM c)"""
PR = OCC + """, v AS (SELECT doc_id, p_name AS concept, p_name || ': of ' || p_brand AS v, p_type || ' ' || p_name AS o, (chunk_index, pos) AS place FROM occ),
r AS (SELECT doc_id, concept, v, min(place) AS fst FROM v GROUP BY ALL), q AS (SELECT doc_id, concept, o, min(place) AS fst FROM v GROUP BY ALL),
t AS (SELECT doc_id, concept, string_agg(o, '|' ORDER BY fst) AS x, string_agg('Output: ' || o, '|' ORDER BY fst) AS o, count(*) AS n FROM q GROUP BY ALL)"""
SQL = {
    "checked_families": N.replace(" RECURSIVE", "")
    + """, m AS (SELECT doc_id, coalesce(list(concept ORDER BY concept) FILTER (f = 'ring'), []) AS ring, coalesce(list(concept ORDER BY concept) FILTER (f = 'rod'), []) AS rod, coalesce(list(concept ORDER BY concept) FILTER (f = 'gear'), []) AS gear, coalesce(list(concept ORDER BY concept) FILTER (f = 'plate'), []) AS plate FROM n GROUP BY 1),
a AS (SELECT *, list_contains(rod, 'old rod') AND len(rod) >= 3 AS fine, CASE WHEN list_contains(gear, 'new gear') THEN 'contains_protected_base_concepts' END AS guard FROM m), b AS (SELECT *, CASE WHEN fine THEN gear ELSE rod || gear END AS late FROM a), c AS (SELECT *, NOT fine AND guard IS NULL AND len(late) >= 3 AND len(rod) > 0 AS took FROM b)
SELECT doc_id, 0 AS ord, 'Ring' AS family_label, array_to_string(ring, '|') AS members, concat_ws('|', 'possible_merge_with_existing_family', CASE WHEN len(ring) < 3 THEN 'family_too_small' END) AS reasons, false AS accepted FROM c WHERE len(ring) > 0
UNION ALL SELECT doc_id, 1, 'fine', array_to_string(rod, '|'), concat_ws('|', CASE WHEN NOT list_contains(rod, 'old rod') THEN 'contains_unknown_members' END, CASE WHEN len(rod) < 3 THEN 'family_too_small' END), fine FROM c WHERE len(rod) > 0
UNION ALL SELECT doc_id, 2, 'late', array_to_string(late, '|'), concat_ws('|', guard, CASE WHEN fine THEN 'member_collision_across_candidates' END, CASE WHEN len(late) < 3 THEN 'family_too_small' END, CASE WHEN len(late) = 0 THEN 'no_coverage_gain' END), took FROM c WHERE len(rod) > 0
UNION ALL SELECT doc_id, 3, 'general terms', array_to_string(CASE WHEN took THEN [] ELSE gear END, '|'), concat_ws('|', 'label_too_generic', guard, CASE WHEN took THEN 'member_collision_across_candidates' END, CASE WHEN took OR len(gear) < 3 THEN 'family_too_small' END, CASE WHEN took THEN 'no_coverage_gain' END), false FROM c WHERE len(gear) > 0
UNION ALL SELECT doc_id, 4, '', '', 'missing_family_label', false FROM c WHERE len(plate) > 0""",
    "localized_frames": FR + " SELECT doc_id, 'Barras' AS label, 'Elegir' AS goal, CASE WHEN crc IS NOT NULL THEN 'Asigna the barra fría' ELSE '' END AS author_methods, CASE WHEN crc IS NOT NULL THEN 'deja barra fría' ELSE '' END AS author_overrides, CASE WHEN nrc IS NOT NULL THEN 'señala la barra nueva' ELSE '' END AS outputs FROM g WHERE crc IS NOT NULL OR nrc IS NOT NULL UNION ALL SELECT doc_id, 'Rings', 'Pick', '', '', '' FROM g WHERE len(rings) > 0 OR orr IS NOT NULL UNION ALL SELECT doc_id, 'Gears', 'Pick', '', '', '' FROM g WHERE bg IS NOT NULL",
    "families_of_concepts": N.replace(" RECURSIVE", "") + " SELECT doc_id, f AS family_id, string_agg(concept, '|' ORDER BY concept) AS members FROM (SELECT doc_id, f, concept FROM n WHERE split_part(concept, ' ', 1) IN ('red', 'hot', 'old') UNION ALL SELECT doc_id, 'aged', concept FROM n WHERE concept LIKE 'old %') GROUP BY ALL",
    "frame_of_concepts": N.replace(" RECURSIVE", "") + " SELECT doc_id, concept, CASE concept WHEN 'hot ring' THEN 'first' ELSE 'second' END AS frame_id FROM n WHERE concept IN ('red ring', 'hot ring', 'old gear')",
    "relation_lists": N.replace(" RECURSIVE", "") + ", x AS (SELECT doc_id, concept, unnest([{'b': 'related_to', 'c': 'red ' || f || CASE WHEN concept = 'new ' || f THEN '|to: ' || concept || '; type: Requires' ELSE '' END || '|as told of old|type: contrast'}, {'b': 'contrasts_with', 'c': 'old ' || f}, {'b': 'depends_on', 'c': CASE WHEN concept <> 'new ' || f THEN 'new ' || f END}, {'b': 'used_in', 'c': 'hot ' || f}]) AS u FROM n) SELECT doc_id, concept, u.b AS bucket, u.c AS counterparts FROM x WHERE u.c IS NOT NULL",
    "family_tree": N + ", i AS (SELECT e.* FROM e WHERE (doc_id, child) IN (SELECT doc_id, concept FROM n)), roots AS (SELECT n.* FROM n WHERE (doc_id, concept) NOT IN (SELECT doc_id, child FROM i)), t AS (SELECT doc_id, f, [concept] AS path, 1 AS depth, true AS o FROM (SELECT * FROM roots UNION ALL SELECT * FROM n WHERE (doc_id, f) NOT IN (SELECT doc_id, f FROM roots)) UNION ALL SELECT t.doc_id, t.f, list_append(path, child), depth + 1, NOT list_contains(path, child) FROM t JOIN i ON i.doc_id = t.doc_id AND i.parent = path[len(path)] AND i.f = t.f WHERE o) SELECT doc_id, f AS family_id, array_to_string(path, '>') AS path, depth FROM t",
    "family_tree_nodes": N
    + """, i AS (SELECT DISTINCT doc_id, f, parent, child FROM e WHERE parent <> child AND (doc_id, child) IN (SELECT doc_id, concept FROM n)), reach AS (SELECT doc_id, parent AS a, child AS b FROM i UNION SELECT reach.doc_id, a, child FROM reach JOIN i ON i.doc_id = reach.doc_id AND i.parent = b),
cyc AS (SELECT doc_id, a AS c FROM reach WHERE a = b), bad AS (SELECT doc_id, c FROM cyc UNION SELECT reach.doc_id, b FROM reach JOIN cyc ON cyc.doc_id = reach.doc_id AND c = a),
t AS (SELECT doc_id, concept, 1 AS depth FROM n WHERE (doc_id, concept) NOT IN (SELECT doc_id, child FROM i) UNION ALL SELECT t.doc_id, child, depth + 1 FROM t JOIN i ON i.doc_id = t.doc_id AND i.parent = concept WHERE (t.doc_id, child) NOT IN (SELECT doc_id, c FROM bad)),
roots AS (SELECT doc_id, f, concept FROM n WHERE (doc_id, concept) NOT IN (SELECT doc_id, child FROM i))
SELECT n.doc_id, n.f AS family_id, n.concept, (n.doc_id, n.concept) IN (SELECT doc_id, concept FROM roots) OR (n.doc_id, n.f) NOT IN (SELECT doc_id, f FROM roots) AS is_root, coalesce(k.n, 0) AS n_children, CAST(w.depth AS BIGINT) AS depth, w.ways
FROM n LEFT JOIN (SELECT doc_id, parent, count(*) AS n FROM i GROUP BY ALL) AS k ON k.doc_id = n.doc_id AND k.parent = n.concept LEFT JOIN (SELECT doc_id, concept, count(*) AS ways, max(depth) AS depth FROM t GROUP BY ALL) AS w ON w.doc_id = n.doc_id AND w.concept = n.concept""",
    "breadcrumb_paths": N + ", up AS (SELECT doc_id, child, min(parent) AS p FROM e GROUP BY ALL), t AS (SELECT DISTINCT doc_id, child AS concept, [child] AS path, child AS top FROM e UNION ALL SELECT t.doc_id, concept, list_prepend(p, path), p FROM t JOIN up ON up.doc_id = t.doc_id AND up.child = top WHERE NOT list_contains(path, p)) SELECT doc_id, concept, array_to_string(max_by(path, len(path)), '>') AS path FROM t GROUP BY ALL",
    "evidence_texts": O + "SELECT DISTINCT doc_id, p_name AS concept, chunk_index AS chunk, CASE WHEN chunk_index % 2 = 0 THEN min(p_type) OVER (PARTITION BY doc_id, chunk_index) ELSE 'Chunk summary unavailable.' END AS text FROM occ",
    "structural_parents": O + "SELECT doc_id, 'red ring' AS parent, chunk_index AS chunk, string_agg(p_name, '|' ORDER BY p_name) AS children FROM (SELECT DISTINCT doc_id, chunk_index, p_name FROM occ WHERE p_name IN ('red ring', 'hot ring', 'old ring')) WHERE doc_id IN (SELECT doc_id FROM occ WHERE p_name = 'red ring') GROUP BY ALL HAVING count(*) >= 2",
    "procedural_items": PR + "SELECT doc_id, concept, string_agg('If ' || v || '=>keep it.', '|' ORDER BY fst) AS rules, t.x AS outputs, string_agg(CAST(fst[1] AS VARCHAR) || '=If ' || v, '|' ORDER BY fst) AS evidence FROM r JOIN t USING (doc_id, concept) GROUP BY ALL",
    "final_procedures": PR + """SELECT doc_id, concept, CASE WHEN count(*) > 1 THEN string_agg(CAST(k AS VARCHAR) || '. If ' || v || ', then keep it', '|' ORDER BY k) ELSE '' END AS steps,
  CASE WHEN count(*) > 1 THEN string_agg(CAST(k AS VARCHAR) || '. If ' || v || ', then keep it', '|' ORDER BY k) || '|' ELSE '' END || string_agg('If ' || v || ', then keep it.', '|' ORDER BY k) || '|' || t.o AS procedures FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, concept ORDER BY fst) AS k FROM r) AS y JOIN t USING (doc_id, concept) GROUP BY doc_id, concept, t.o""",
    "audited_procedures": PR + "SELECT doc_id, concept, string_agg('If ' || v || '=>keep it.', '|' ORDER BY fst) AS rules, count(*) + t.n AS n_evidence FROM r JOIN t USING (doc_id, concept) GROUP BY doc_id, concept, t.n",
    "procedure_frames": FR + """ SELECT doc_id, 'rings' AS frame_id, 'selection' AS frame_type, 'Rings' AS label, concat_ws('|', CASE WHEN rr IS NOT NULL THEN 'red ring' END, CASE WHEN hr IS NOT NULL THEN 'hot ring' END) AS anchor_concepts, CASE WHEN orr IS NOT NULL THEN 'old ring' ELSE '' END AS supporting_concepts,
  array_to_string(list_transform(rings, lambda x: x[1] || '=>' || x[2]), '|') AS rules, array_to_string(list_transform(list_filter(rings, lambda x: x[2] = 'take the hot ring'), lambda x: x[1] || '=>' || x[2]), '|') AS fallback_rules,
  CASE WHEN len(rings) > 1 THEN array_to_string(list_transform(list_sort(rings)[1:4], lambda x: 'If ' || x[1] || ', then ' || x[2]), '|') WHEN orr IS NOT NULL THEN 'look up' ELSE '' END AS steps, '' AS preconditions, '' AS author_methods, '' AS author_overrides, '' AS methodological_notes, '' AS outputs,
  concat_ws('|', CASE WHEN rr IS NULL THEN 'red ring' END, CASE WHEN rr IS NOT NULL THEN 'kin of red ring' END, CASE WHEN hr IS NOT NULL THEN 'kin of hot ring' END, CASE WHEN orr IS NOT NULL THEN 'kin of old ring' END) AS related_concepts, array_to_string(every, '|') AS source_chunks
  FROM (SELECT *, list_concat(list_concat(coalesce(rrc, []), list_filter(coalesce(hrc, []), lambda x: NOT list_contains(coalesce(rrc, []), x))), list_filter(coalesce(orc, []), lambda x: NOT list_contains(coalesce(rrc, []), x) AND NOT list_contains(coalesce(hrc, []), x))) AS every FROM g) WHERE len(rings) > 0 OR orr IS NOT NULL
UNION ALL SELECT doc_id, 'gears', 'evaluation', 'Gears', 'blue gear', '', array_to_string(list_transform(gears, lambda x: x[1] || '=>' || x[2]), '|'), '', array_to_string(list_transform(list_sort(list_transform(gears, lambda x: [lower(x[1]), x[1], x[2]]))[1:3], lambda x: 'If ' || x[2] || ', then ' || x[3]), '|'), 'it is whole|new|in good order always', '', '', '', '', 'red ring|kin of blue gear', array_to_string(bgc, '|') FROM g WHERE bg IS NOT NULL
UNION ALL SELECT doc_id, 'rods', 'selection', 'Rods', CASE WHEN crc IS NOT NULL THEN 'cold rod' ELSE '' END, CASE WHEN nrc IS NOT NULL THEN 'new rod' ELSE '' END, CASE WHEN crc IS NOT NULL THEN b || chr(39) || 's method is followed=>select the cold rod' ELSE '' END, '', '', '', CASE WHEN crc IS NOT NULL THEN 'Assigns the cold rod' ELSE '' END, CASE WHEN crc IS NOT NULL THEN 'leave cold rod' ELSE '' END, CASE WHEN crc IS NOT NULL THEN 'whole set of cold rod' ELSE '' END,
  CASE WHEN nrc IS NOT NULL THEN 'note the new rod.' ELSE '' END, concat_ws('|', 'red ring', CASE WHEN crc IS NOT NULL THEN 'kin of cold rod' END, CASE WHEN nrc IS NOT NULL THEN 'kin of new rod' END), array_to_string(list_concat(coalesce(crc, []), list_filter(coalesce(nrc, []), lambda x: NOT list_contains(coalesce(crc, []), x))), '|')
  FROM g LEFT JOIN (SELECT o_custkey AS doc_id, min(p_brand) AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE p_name = 'cold rod' GROUP BY 1) USING (doc_id) WHERE crc IS NOT NULL OR nrc IS NOT NULL""",
    "automatic_frames": FR + """, k AS (SELECT *, CASE a WHEN 'new' THEN 'analysis' WHEN 'large' THEN 'timing' WHEN 'small' THEN 'evaluation' ELSE 'selection' END AS kind FROM m WHERE p_name NOT LIKE '% ring' AND a <> 'cold')
SELECT doc_id, 'auto_' || replace(p_name, ' ', '_') AS frame_id, kind AS frame_type, upper(a[1]) || a[2:] || ' ' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS label,
  CASE kind WHEN 'selection' THEN 'Identify the procedure of ' WHEN 'evaluation' THEN 'Evaluate the condition of ' WHEN 'timing' THEN 'Apply the timing of ' ELSE 'Analyse the procedure of ' END || p_name || '.' AS goal,
  CASE WHEN kind IN ('selection', 'evaluation') AND len(t) > 1 THEN array_to_string(list_transform(t[1:CASE kind WHEN 'selection' THEN 4 ELSE 3 END], lambda x, i: CAST(i AS VARCHAR) || '. If ' || x || ', then take the ' || p_name || CASE WHEN a = 'small' THEN ', strong' ELSE '' END), '|') WHEN a = 'old' THEN '1. look up' ELSE '' END AS steps,
  CASE WHEN a = 'new' THEN 'note the ' || p_name || '.' ELSE '' END AS outputs FROM k""",
    "discovered_families": O + ", h AS (SELECT doc_id, list(DISTINCT replace(p_name, ' ring', '')) AS w FROM occ WHERE p_name LIKE '% ring' GROUP BY 1), a AS (SELECT *, [x FOR x IN ['red', 'blue', 'old', 'odd'] IF list_contains(w, x)] AS one FROM h), b AS (SELECT *, CASE WHEN len(one) >= 3 THEN one ELSE [] END AS t1, [x FOR x IN ['hot', 'red', 'blue', 'cold'] IF list_contains(w, x)] AS two FROM a), c AS (SELECT *, [x FOR x IN two IF NOT list_contains(t1, x)] AS two2 FROM b), e AS (SELECT *, CASE WHEN len(two2) >= 3 THEN t1 || two2 ELSE t1 END AS t2 FROM c), g AS (SELECT *, [x FOR x IN ['small', 'large', 'red', 'new'] IF list_contains(w, x) AND NOT list_contains(t2, x)] AS three FROM e) SELECT doc_id, family_label, array_to_string([x || ' ring' FOR x IN m], '|') AS members FROM (SELECT doc_id, 'plain' AS family_label, one AS m FROM g UNION ALL SELECT doc_id, 'warm', two2 FROM g UNION ALL SELECT doc_id, 'size', three FROM g) WHERE len(m) >= 3",
}
QUERIES = {f.__name__: f for f in (localized_frames, families_of_concepts, frame_of_concepts, relation_lists, family_tree, family_tree_nodes, breadcrumb_paths, evidence_texts, structural_parents, procedural_items, final_procedures, audited_procedures, procedure_frames, automatic_frames, discovered_families, checked_families)}

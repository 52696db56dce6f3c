"""Related concepts, trees and breadcrumbs against plain versions, on small tables and on hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from foliospark.operators import explorer as E


def plain_related(terms, up, families, blocks, limit):
    """{concept: its closest (other, direct, blocks, terms)}, from all pairs."""
    names = {n for rows in (terms, families, blocks) for n, _ in rows} | {n for e in up for n in e}
    of = lambda rows: {n: {k for m, k in rows if m == n} for n in names}
    t, f, b, parents = of(terms), of(families), of(blocks), of([(c, p) for p, c in up])
    out = {}
    for a in names:
        rows = []
        for o in names - {a}:
            direct = 5 if o in parents[a] else 4 if a in parents[o] else 3 if parents[a] & parents[o] else 2 if f[a] & f[o] else 0
            score = (direct, len(b[a] & b[o]), len(t[a] & t[o]))
            if any(score):
                rows.append((*(-x for x in score), o))
        if rows:
            out[a] = [(o, -d, -n, -m) for d, n, m, o in sorted(rows)[:limit]]
    return out


def related(spark, terms, up, families, blocks, limit, shuffle=True):
    table = lambda rows, schema: spark.createDataFrame([(1, *r) for r in rows], "doc_id int, " + schema)
    own = table(terms, "concept string, term string").groupBy("doc_id", "concept").agg(F.collect_set("term").alias("terminology"))
    return E.related_concepts(own, table(up, "parent string, child string"), table(families, "concept string, family_id string"), table([(b, n) for n, b in blocks], "block_index int, concept string"), limit)


@pytest.mark.parametrize("seed", range(4))
def test_related_concepts_equal_all_pairs(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(E, "signal_terms", lambda concepts, scope: concepts.select(*scope, "concept", F.explode("terminology").alias("term")))
    names = [f"n{i:02}" for i in range(40)]
    some = lambda keys, n: sorted({(rng.choice(names), k) for k in rng.choices(keys, k=n)})
    hot = [k for k in names if rng.random() < 0.7]
    terms = some([f"t{i}" for i in range(9)], 40) + [(n, "all") for n in names] + [(n, "most") for n in hot]
    blocks = some(range(12), 50) + [(n, 99) for n in hot[: 10 * seed]] + [(n, 98) for n in names[: 12 * seed]]
    families = some("xyz", 8) + [(n, "big") for n in names[10 : 10 + 9 * seed]]
    up = sorted({(rng.choice(names[:6]), rng.choice(names[6:])) for _ in range(8)} | ({("n00", n) for n in names[20:36]} if seed > 1 else set()))
    got = {}
    for r in related(spark, terms, up, families, blocks, 3).collect():
        got.setdefault(r["concept"], []).append((r["rank"], r["other"], r["direct"], r["cooccurrence"], r["terminology"]))
    assert {c: [x[1:] for x in sorted(v)] for c, v in got.items()} == plain_related(terms, up, families, blocks, 3)


def test_a_term_in_all_concepts_makes_few_pairs(spark, monkeypatch):
    monkeypatch.setattr(E, "signal_terms", lambda concepts, scope: concepts.select(*scope, "concept", F.explode("terminology").alias("term")))
    n = 3000
    rows = spark.range(n).select(F.lit(1).alias("doc_id"), F.format_string("c%05d", "id").alias("concept"), F.array(F.lit("all"), F.concat(F.lit("t"), (F.col("id") % 500).cast("string"))).alias("terminology"))
    none = spark.createDataFrame([], "doc_id int, parent string, child string")
    families = rows.select("doc_id", "concept", F.lit("one").alias("family_id"))
    blocks = rows.select("doc_id", F.expr("substring(concept, 5, 2)").alias("block_index"), "concept")
    lists = E.posting_lists(rows, none, families, blocks, ["doc_id"])
    scored, more = E.related_candidates(lists, none.select("doc_id", F.col("parent").alias("concept"), F.col("child").alias("other"), F.lit(5).alias("direct")), 10, ["doc_id"])
    # 33 of the first names of three lists, a term's 6 and a block's 30 concepts; all pairs would be 3000 a concept
    assert scored.count() + more.count() < 80 * n


def test_breadcrumbs_go_up_any_way(spark):
    rng = random.Random(1)
    edges = [(rng.choice("abcdefgh"), rng.choice("abcdefgh")) for _ in range(12)] + [(f"c{i:03}", f"c{i + 1:03}") for i in range(100)]
    edges = [(p, c) for p, c in edges if p != c]
    up = {}
    for p, c in edges:
        up[c] = min(up.get(c, p), p)
    want = {}
    for c in up:
        way = [c]
        while way[0] in up and up[way[0]] not in way:
            way.insert(0, up[way[0]])
        want[c] = way
    got = {r["concept"]: r["path"] for r in E.breadcrumbs(spark.createDataFrame([(1, *e) for e in edges], "doc_id int, parent string, child string")).collect()}
    assert got == want


def test_a_ladder_of_joined_levels_is_counted(spark):
    rungs = 12
    edges = [(1, f"{a}{i:02}", f"{b}{i + 1:02}") for i in range(rungs) for a in "lr" for b in "lr"] + [(1, "x", "y"), (1, "y", "x"), (1, "y", "z")]
    members = [(1, "f", n) for n in sorted({n for _, *e in edges for n in e})]
    tables = spark.createDataFrame(edges, "doc_id int, parent string, child string"), spark.createDataFrame(members, "doc_id int, family_id string, concept string")
    got = {r["concept"]: (r["is_root"], r["n_children"], r["depth"], r["ways"] and int(r["ways"])) for r in E.family_tree(*tables).collect()}
    assert got["l12"] == (False, 0, 13, 2**12) and got["r00"] == (True, 2, 1, 1) and got["x"] == (False, 1, None, None) and got["z"] == (False, 0, None, None)
    below = E.family_tree_paths(*tables, starts=spark.createDataFrame([(1, "f", "l10")], "doc_id int, family_id string, concept string"))
    assert sorted(r["path"] for r in below.collect()) == sorted([["l10"], *[["l10", f"{a}11"] for a in "lr"], *[["l10", f"{a}11", f"{b}12"] for a in "lr" for b in "lr"]])


def test_pages_of_a_hot_key_are_its_list(spark):
    from foliospark.functions.pages import numbered, pages

    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 11).cast("string"))).alias("k"), (F.col("id") * 7919 % 3001).alias("o"), F.col("id"))
    made = pages(rows, ["k"], ["o"], F.col("id"), 64).collect()
    got, want = {}, {}
    for r in sorted(made, key=lambda r: r["page"]):
        assert len(r["rows"]) <= 64 and r["first"] == 64 * r["page"] == len(got.get(r["k"], []))
        got.setdefault(r["k"], []).extend(r["rows"])
    for r in sorted(rows.collect(), key=lambda r: r["o"]):
        want.setdefault(r["k"], []).append(r["id"])
    assert got == want
    # two thirds of the rows are numbered in more than one task
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert numbered(rows, ["k"], ["o"]).where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_required_literals_are_in_what_a_pattern_finds(spark):
    import re

    from foliospark.functions.trigrams import required_literals
    from foliospark.operators.families import rule_hits

    patterns = ["^red ring$", "(hot|cold) rod", "^(new|large) ", "rin+g", "ab?c red", "red (ring|rod)?", "a|ring", "(?i)RED", "[a-z]ed", r"\bgear\b", "((hot|old) )?ring", "x{0,2}red", "r.d", "", r"ring\s?rod", "old ring|rod", "(red ring)*", "(ring){1,2}", "gear(s|ing)?$"]
    names = [f"{a} {b}" for a in ("red", "hot", "old", "new", "large", "xred") for b in ("ring", "rod", "gear", "gears", "rinng", "ringrod")]
    told = {r["pattern"]: r["l"] for r in spark.createDataFrame([(p,) for p in patterns], "pattern string").select("pattern", required_literals(F.col("pattern")).alias("l")).collect()}
    for p in patterns:
        for n in names:
            assert told[p] is None or not re.search(p, n) or any(x in n for x in told[p]), (p, n, told[p])
    assert told["^red ring$"] == ["red ring"] and told["^(new|large) "] == ["new", "large"] and told["a|ring"] is None and told["((hot|old) )?ring"] == ["ring"]
    table = spark.createDataFrame([(n, n) for n in names], "concept string, _s string")
    rules = spark.createDataFrame([(p, f"f{i}") for i, p in enumerate(patterns)], "pattern string, family_id string")
    assert sorted(tuple(r) for r in rule_hits(table, rules, ["concept"]).collect()) == sorted((n, f"f{i}") for i, p in enumerate(patterns) for n in names if re.search(p, n))


def test_blocks_in_bins(spark):
    rng = random.Random(5)
    blocks = [(d, i, a, a + rng.choice((0, 3, 16, 70))) for d in (1, 2) for i, a in enumerate(rng.choices(range(-40, 200), k=30))] + [(1, 90, 50, 40), (2, 91, None, 7)]
    concepts = [(d, f"c{i} x", sorted(set(rng.choices(range(-40, 260), k=rng.choice((1, 5, 40)))))) for d in (1, 2) for i in range(12)]
    b = spark.createDataFrame([(*r, f"of the C{r[1]} X" if r[1] < 12 else "") for r in blocks], "doc_id int, block_index int, start_chunk long, end_chunk long, text string")
    c = spark.createDataFrame(concepts, "doc_id int, concept string, source_chunks array<long>")
    want = {(d, n, i) for d, i, lo, hi in blocks if lo is not None for e, n, cs in concepts if d == e and any(min(lo, hi) <= x <= max(lo, hi) for x in cs)}
    got = E.blocks_for_concepts(b, c)
    named = {(d, n, i) for d, i, _, _ in blocks for e, n, _ in concepts if d == e and i < 12 and n == f"c{i} x"}
    assert {tuple(r) for r in got.collect()} == want | named
    rows = E.enrich_blocks(b, c).collect()
    assert len(rows) == len(blocks) and {(r["doc_id"], x, r["block_index"]) for r in rows for x in r["concepts"]} == want
    # a side that has grown since it was read isn't broadcast by the size of its file
    for df in (got, E.enrich_blocks(b, c)):
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()

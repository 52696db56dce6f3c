"""Rules that depend on the rows before, in set form, against plain scans of random documents."""

import random

import pytest
from pyspark.sql import functions as F

from foliospark.functions.pointers import on_chain
from foliospark.operators import chunking as K
from foliospark.operators import structure as S

HEADINGS = "doc_id long, index int, text string, start_char int, end_char int, page long, score double, pattern string, type string, confidence double"


def plain_promotion(rows):
    rows = [dict(r) for r in rows]
    out = []
    for i, r in enumerate(rows):
        if r["pattern"] == "title_case_short" and r["type"] is None and len(r["text"]) > 1:
            near = [rows[j] for j in (i - 2, i - 1, i + 1, i + 2) if 0 <= j < len(rows) and rows[j]["type"] in S.SUPPORTING]
            near = [o for o in near if r["page"] is None or o["page"] is None or abs(r["page"] - o["page"]) <= 2]
            if near:
                r["type"], r["confidence"] = "section", 0.52 if len(near) == 1 else 0.6
        out.append((r["index"], r["type"], r["confidence"]))
    return out


@pytest.mark.parametrize("block", [1, 3, 256])
def test_promotion_equals_a_scan(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rng = random.Random(block)
    docs = {}
    for d in range(30):
        page = 0
        docs[d] = []
        for i in range(rng.randint(1, 40)):
            page += rng.choice([0, 0, 1, 3])
            docs[d].append({"index": i, "text": rng.choice(["Some Words Here", "X", "More Title"]), "page": rng.choice([page, page, None]), "pattern": rng.choice(["title_case_short"] * 4 + ["roman_numeral"]), "type": rng.choice([None] * 5 + ["section", "chapter", "index", "unknown"]), "confidence": None})
    rows = [(d, r["index"], r["text"], r["index"] * 10, r["index"] * 10 + 5, r["page"], 0.6, r["pattern"], r["type"], None) for d, rs in docs.items() for r in rs]
    rng.shuffle(rows)
    got = {}
    for r in S.promote_by_context(spark.createDataFrame(rows, HEADINGS)).orderBy("doc_id", "index").collect():
        got.setdefault(r["doc_id"], []).append((r["index"], r["type"], r["confidence"]))
    assert got == {d: plain_promotion(rs) for d, rs in docs.items()}


def plain_cleaning(rows):
    joined = []
    for r in (dict(r) for r in rows):
        r["lone"], r["entry"] = r["label"] in ("A", "B") and r["type"] == "unknown", r["label"] == "alpha, 12" and r["type"] == "unknown"
        if r["lone"] and joined and joined[-1]["type"] == "unknown":
            joined[-1]["end"], joined[-1]["last"] = r["end"], r["last"]
        else:
            joined.append(r)
    kept = []
    for r in joined:
        if kept and kept[-1]["lone"] and r["entry"]:
            lone = kept.pop()
            r["start"], r["first"] = lone["start"], r["first"] if lone["first"] is None else lone["first"]
        kept.append(r)
    some = lambda *xs: next((x for x in xs if x is not None), None)
    for i, r in enumerate(kept):
        before, after = kept[i - 1]["last"] if i else None, kept[i + 1]["first"] if i + 1 < len(kept) else None
        r["first"] = some(r["first"], before, after)
        r["last"] = some(r["last"], after, r["first"], before)
        if r["first"] is not None and r["last"] is not None:
            r["last"] = max(r["last"], r["first"])
    return [(i, r["label"], r["start"], r["end"], r["first"], r["last"]) for i, r in enumerate(kept)]


def test_cleaning_equals_a_scan(spark):
    rng = random.Random(3)
    docs = {d: [{"label": rng.choice(["A", "B", "alpha, 12", "Body"]), "type": rng.choice(["unknown"] * 3 + ["chapter"]), "start": 10 * i, "end": 10 * i + 10, "first": rng.choice([None, None, i + rng.randint(0, 3)]), "last": rng.choice([None, None, i + rng.randint(-1, 4)])} for i in range(rng.randint(1, 12))] for d in range(200)}
    rows = [(d, i, "x", r["label"], r["type"], r["start"], r["end"], 0.0, r["first"], r["last"]) for d, rs in docs.items() for i, r in enumerate(rs)]
    got = {}
    for r in S.clean_sections(spark.createDataFrame(rows, "doc_id long, section_index int, id string, label string, type string, start_char int, end_char int, confidence double, start_page long, end_page long")).orderBy("doc_id", "section_index").collect():
        assert r["id"] == f"section_{r['start_char']}"
        got.setdefault(r["doc_id"], []).append((r["section_index"], r["label"], r["start_char"], r["end_char"], r["start_page"], r["end_page"]))
    assert got == {d: plain_cleaning(rs) for d, rs in docs.items()}


def plain_packs(atoms, target, least):
    """The number of each atom's chunk: greedy, then small chunks take the next one, once."""
    strong = lambda a, b: a["section"] != b["section"] and (a["type"] in K.STRONG or b["type"] in K.STRONG)
    packs = []
    for i, r in enumerate(atoms):
        if packs and not strong(atoms[i - 1], r):
            size, have = r["end"] - atoms[packs[-1][0]]["start"], atoms[i - 1]["end"] - atoms[packs[-1][0]]["start"]
            if size <= target or (size <= int(target * 1.5) and (have < least or (r["weak"] and r["end"] - r["start"] < least))):
                packs[-1].append(i)
                continue
        packs.append([i])
    out, i = [], 0
    while i < len(packs):
        now = packs[i]
        if i + 1 < len(packs) and atoms[now[-1]]["end"] - atoms[now[0]]["start"] < least and not strong(atoms[now[-1]], atoms[packs[i + 1][0]]) and atoms[packs[i + 1][-1]]["end"] - atoms[now[0]]["start"] <= int(target * 1.5):
            now, i = now + packs[i + 1], i + 1
        out.append(now)
        i += 1
    return {a: k for k, members in enumerate(out) for a in members}


@pytest.mark.parametrize(("target", "least"), [(100, 30), (60, 60), (40, 5), (300, 100)])
def test_packs_equal_a_scan(spark, target, least):
    rng = random.Random(target)
    docs, rows = {}, []
    for d in range(60):
        at, section, docs[d] = 0, 0, []
        for _ in range(rng.randint(1, 40)):
            section += rng.random() < 0.6
            at += rng.choice([0, 0, 0, 4])
            size = rng.choice([1, 5, 10, 28, 31, 60, 99, 100, 140])
            kind = "chapter" if section % 5 == 4 else "section"
            docs[d].append({"section": section, "type": kind, "start": at, "end": at + size, "weak": kind != "chapter" and rng.random() < 0.7})
            at += size
        rows += [(d, f"s{r['section']}", r["type"], r["start"], r["end"], r["weak"]) for r in docs[d]]
    rng.shuffle(rows)
    got = {}
    for r in K.pack_atoms(spark.createDataFrame(rows, "doc_id long, section_id string, section_type string, start_char int, end_char int, is_weak boolean"), target, least).orderBy("doc_id", "start_char").collect():
        got.setdefault(r["doc_id"], []).append(r["pack"])
    assert got == {d: [n for _, n in sorted(plain_packs(rs, target, least).items())] for d, rs in docs.items()}


def test_chains(spark):
    edges = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("at"), F.when(F.col("id") < 900, F.col("id") + 6).alias("to"))
    starts = spark.createDataFrame([(0, 4), (1, 999)], "k long, at long")
    assert sorted(tuple(r) for r in on_chain(edges, starts, ["k"]).collect()) == [(0, x) for x in range(4, 905, 6)] + [(1, 999)]


def test_zones_are_made_once_a_page(spark):
    from foliospark.operators import pages as P

    rows = [(1, i, f"Book\nline {i}\nmore\n{i}\nlast words") for i in range(8)] + [(2, 0, "")]
    raw = spark.createDataFrame(rows, "doc_id int, page_index int, raw_text string")
    units = P.page_units(P.remove_running_lines(P.clean_page_text(raw).repartition(2), spark.createDataFrame([(1, "book", "top", 8)], "doc_id int, key string, place string, pages int")))
    # the lines of a page are found outside the test of a line
    text = P.remove_running_lines(spark.createDataFrame([(1, "a")], "doc_id int, clean_text string").repartition(2), spark.createDataFrame([(1, "book", "top", 8)], "doc_id int, key string, place string, pages int"))
    assert text.where("clean_text <> ''").select("doc_id")._jdf.queryExecution().optimizedPlan().toString().count("split(") == 2
    got = sorted(tuple(r) for r in units.collect())
    assert [r[:3] for r in got][:2] == [(1, 0, 0), (1, 1, got[0][3] + 2)] and len(got) == 8

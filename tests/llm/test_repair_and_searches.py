"""Operators 11 to 13 against plain versions, on odd rows and on groups that are split."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import conversation_repair as C
from foliospark.llm import hard_negatives as H
from foliospark.llm import topk as K
from foliospark.llm import tree_search as T

ROWS = "conv_id long, turn long, role string, text string"


def plain_repair(rows):
    """(blank, duplicate, truncated, illegal, cost, audit, sha) by trying, row by row, all that may be done, with whole audits kept."""
    seen, faults = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    given = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def inserts(found):
        for _ in range(3):
            for state, (cost, audit, lines) in list(found.items()):
                role = given[state]
                new = (cost + 3, audit + "I", (*lines, f"{role}:"))
                found[role[0]] = min(found.get(role[0], new), new)
        return found

    found = {"": (0, "", ())}
    for (role, text), fault in zip(rows, faults):
        # inserts are tried before the row only, so audits of one length of rows are compared
        ways = [(s, v) for s, v in found.items()]
        for s, (cost, audit, lines) in list(ways):
            at, c, a, ls = s, cost, audit, lines
            for _ in range(2):
                r = given[at]
                at, c, a, ls = r[0], c + 3, a + "I", (*ls, f"{r}:")
                ways.append((at, (c, a, ls)))
        after = {}
        for s, (cost, audit, lines) in ways:
            offers = [(s, (cost + 4, audit + "D", lines))]
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                if role[:1] in follows[s]:
                    offers.append((follows[s][role[:1]], (cost + more, audit + "K", (*lines, f"{role}:{text}"))))
                offers.append((given[s][0], (cost + more + 3, audit + "R", (*lines, f"{given[s]}:{text}"))))
            for t, v in offers:
                after[t] = min(after.get(t, v), v)
        found = after
    ends = inserts(dict(found))
    cost, audit, lines = min(ends[s] for s in ("", "a") if s in ends)
    initials = [r[:1] for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return (*(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def told(df):
    return {r["conv_id"]: tuple(r[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}


def random_turns(rng, n):
    return [(rng.choice(["user", "assistant", "system", "tool", "", "umpire"]), rng.choice(["", " \n", "Yes.", "No", "Why?", f"t{rng.random()}.", f"t{rng.random()}"])) for _ in range(n)]


def test_repairs_equal_plain_search(spark):
    rng = random.Random(5)
    given = {k: random_turns(rng, rng.randint(1, 9)) for k in range(150)}
    given[500] = random_turns(rng, 400)  # one conversation in several ranges
    rows = [(k, t, role, text) for k, turns in given.items() for t, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    got = told(C.reports(spark.createDataFrame(rows, ROWS)))
    assert got == {k: plain_repair(v) for k, v in given.items()}


def test_the_long_conversation_was_split(spark):
    rows = spark.createDataFrame([(1, t, "user", f"{t}.") for t in range(400)], ROWS)
    _, edits = C.repair(rows)
    assert edits.select("seg").distinct().count() > 1
    assert told(C.reports(rows))[1] == plain_repair([("user", f"{t}.") for t in range(400)])


def test_repaired_rows_have_the_form(spark):
    rng = random.Random(6)
    given = spark.createDataFrame([(k, t, role, text) for k in range(40) for t, (role, text) in enumerate(random_turns(rng, 7))], ROWS)
    rows, edits = C.repair(given.withColumns({"id": F.lit("x"), "kind": F.lit(1), "seg": F.lit(2)}))
    out = {}
    for r in sorted(C.repaired(rows, edits).where("edit <> 'D'").collect(), key=lambda r: (r["conv_id"], r["at"], r["nth"])):
        out.setdefault(r["conv_id"], []).append(r)
    for turns in out.values():
        initials = "".join(r["role"][0] for r in turns)
        assert initials.removeprefix("s") == "ua" * (len(initials.removeprefix("s")) // 2)
        assert all(r["text"] == "" for r in turns if r["edit"] == "I")


def test_odd_conversations(spark):
    rows = [(None, None, None, None), (None, 2, "user", "Hi."), (1, None, "assistant", "First."), (1, 5, "user", "Q?"), (1, 5, "user", "Q?"), (1, 9, "assistant", "A."), (2, 0, "system", "s")]
    df = spark.createDataFrame(rows, ROWS)
    got = {r["conv_id"]: r for r in C.reports(df).collect()}
    assert told(C.reports(df)) == {None: plain_repair([(" ", " "), ("user", "Hi.")]), 1: plain_repair([("assistant", "First."), ("user", "Q?"), ("user", "Q?"), ("assistant", "A.")]), 2: plain_repair([("system", "s")])}
    assert (got[None]["gaps"], got[1]["gaps"], got[2]["gaps"]) == (0, 3, 0)
    assert C.reports(df.where("false")).collect() == []


VECTORS = "vec_id long, embedding array<double>, label int"


def vectors(spark, seed=3, n=300, dims=6):
    """Rows in groups, with equal vectors, repeated ids, and rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    rows = [(i, [float(x) for x in centres[i % 8] + rng.normal(size=dims) * 0.4], int(rng.integers(4))) for i in range(n)]
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(30)]  # equal vectors
    rows += [(50, [-1.0, 0.5] + [0.0] * (dims - 2), 1), (100, rows[7][1], 2), (None, rows[1][1], 1), (2000, [0.0] * dims, 1), (2001, None, 1), (2002, [1.0, None], 1), (2003, [float("nan")] * dims, 1), (2004, [float("inf")] * dims, 0), (2005, rows[2][1], None), (2100, rows[3][1][:3], 2)]
    return rows


def whole(rows, dims=6):
    """(vec_id, label, vector) of the rows that take part."""
    ok = [r for r in rows if r[0] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    return [(i, lab, np.array([*v, *[0.0] * (dims - len(v))])) for i, v, lab in ok]


def plain_negatives(rows, share=80):
    rows = [(i, lab, [int(x) for x in np.floor(v * 256)]) for i, lab, v in whole(rows) if lab is not None]
    out = []
    for a, (i, lab, v) in enumerate(rows):
        if i % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), j, m) for b, (j, m, w) in enumerate(rows) if b != a]
        for s, j, _ in sorted(x for x in scored if x[2] == lab)[:5]:
            fit = sorted(x[:2] for x in scored if x[2] != lab and share * -s <= 100 * -x[0] <= 100 * -s)[:5]
            out += [(i, j, n, m, -s, -t) for n, (t, m) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize(("block", "anchors", "scale"), [(16384, 2048, 1.0), (40, 2, 1.0), (64, 3, 1e12)])
def test_hard_negatives_equal_plain_search(spark, monkeypatch, block, anchors, scale):
    monkeypatch.setattr(H, "TILE", 16)
    rows = [(i, v and [x if x is None else x * scale for x in v], lab) for i, v, lab in vectors(spark)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({"row": F.lit(0), "grp": F.lit("x"), "v": F.lit(1)})
    got = sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % 100 == 0, block=block, anchors=anchors).collect())
    want = plain_negatives(rows)
    if scale > 1:
        most = (1 << 63) - 1
        want = [r for r in want if abs(r[4]) < most]
        got = [r for r in got if abs(r[4]) < most]
    assert got == want and (want or scale > 1)


def plans_of(monkeypatch, module, name):
    """The plans of the rows that module.name gets, as they come."""
    seen, own = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or own(df))
    return seen


def test_copies_of_queries_never_meet_on_the_driver(spark, monkeypatch):
    rows = [r for r in vectors(spark) if r[0] is not None]
    plans = plans_of(monkeypatch, K, "short_batches")
    found = K.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 5 == 0, 3)
    copied = [p for p in plans if "Generate explode(" in p]
    assert found.count() > 100 and len(copied) == 1 and "BroadcastExchange" not in copied[0]


def test_copies_of_anchors_never_meet_on_the_driver(spark, monkeypatch):
    rows = vectors(spark)
    plans = plans_of(monkeypatch, H, "short_batches")
    found = H.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 5 == 0)
    # the copies are made last, above joins of one copy
    copied = [p for p in plans if "Generate explode(" in p]
    assert found.count() > 100 and len(copied) == 2 and all(p.index("SortMergeJoin") < p.index("Generate explode(") and "BroadcastExchange" not in p[: p.index("Generate explode(")] for p in copied)


def test_the_sample_is_the_first_rows_by_hash(spark):
    rows = spark.range(0, 500, 1, 7).select((F.col("id") % 90).alias("vec_id"), F.col("id").alias("row"), F.array(F.col("id").cast("double")).alias("v"))
    want = [r["v"] for r in rows.orderBy(F.xxhash64("vec_id", "row"), "row").limit(40).collect()]
    assert H.sampled(rows, 40) == want and len(H.sampled(rows, 600)) == 500 and H.sampled(rows.limit(0), 40) == []


def test_score_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = np.floor(rng.normal(size=(20, 5)) * 256), np.floor(rng.normal(size=(60, 5)) * 256)
    b[:5], b[5] = a[:5], 0
    directions = H.unit_rows(rng.normal(size=(4, 5)))[0]
    (ta, na), (tb, nb) = H.angles_to(a, directions), H.angles_to(b, directions)
    low, high = H.score_bounds(ta, na, tb, tb, nb, nb)
    assert ((low <= a @ b.T) & (a @ b.T <= high)).all() and (high - low < 2 * na[:, None] * nb + 1).all()


def test_empty_tables_have_no_neighbours(spark):
    df = spark.createDataFrame([], VECTORS)
    assert H.mine(df, F.col("vec_id") % 100 == 0).collect() == []
    assert T.search(df, F.col("vec_id") % 50 == 0)[0].collect() == []
    none = spark.createDataFrame([(3, [1.0, 2.0], 1)], VECTORS)
    assert H.mine(none, F.col("vec_id") % 100 == 0).collect() == []
    assert T.search(none, F.col("vec_id") % 50 == 0)[0].collect() == []


def plain_nearest(rows, k=5):
    rows = [(i, v) for i, _, v in whole(rows) if v.any()]
    out = {}
    for a, (i, v) in enumerate(rows):
        if i % 50 == 0:
            scored = [(-float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))), j, b) for b, (j, w) in enumerate(rows) if b != a]
            out.setdefault(i, []).append([(j, -s) for s, j, _ in sorted(scored)[:k]])
    return out


def test_tree_search_with_all_leaves_is_exact(spark):
    rows = vectors(spark)
    df = spark.createDataFrame(rows, VECTORS).withColumn("row", F.lit(0))
    found, visits, leaves = T.search(df, F.col("vec_id") % 50 == 0, leaf=20, target=1.0, block=16)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_row"], r["rank"])):
        got.setdefault((r["query_id"], r["query_row"]), []).append((r["vec_id"], r["score"]))
    want = plain_nearest(rows)
    assert leaves > 4 and visits <= leaves
    for (i, _), near in got.items():
        assert any([n for n, _ in near] == [n for n, _ in w] and np.allclose([s for _, s in near], [s for _, s in w], atol=1e-12) for w in want[i])
    assert len(got) == sum(map(len, want.values()))


def test_tree_search_reaches_the_recall_it_was_calibrated_for(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    rows = [(i, [float(x) for x in centres[i % 30] + rng.normal(size=16) * 0.5], 0) for i in range(3000)]
    found, visits, leaves = T.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0, leaf=60)
    want = plain_nearest(rows)
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    share = sum(len(got[i] & {j for j, _ in near[0]}) for i, near in want.items()) / (5 * len(want))
    assert share >= 0.9 and visits < leaves / 2


def test_best_bins_visit_every_leaf_nearest_first():
    rng = np.random.default_rng(4)
    x = T.unit_rows(rng.normal(size=(2000, 8)))
    tree = T.grow(x, 1.0, leaf=100)
    assert set(T.leaves_of(tree, x)) == set(range(tree.n_leaves))
    for q, leaf in zip(x[:50], T.leaves_of(tree, x[:50])):
        order = T.best_bins(tree, q, tree.n_leaves)
        assert sorted(order) == list(range(tree.n_leaves)) and T.best_bins(tree, q, 3) == order[:3]
        assert leaf in order[:1]


def test_columns_of_any_name_stay_and_repeated_items_count(spark):
    from foliospark.llm import decontaminate, line_dedup

    run = "\n".join(f"line number {i} of a run that is long enough to count" for i in range(5))
    rows = [(1, "keep1", 7, run), (2, "keep2", 8, f"other\n{run}")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, _doc string, _deleted int, text string")).orderBy("doc_id").collect()
    assert [(r["_doc"], r["_deleted"]) for r in got] == [("keep1", 7), ("keep2", 8)] and got[0]["text"] == run and got[1]["text"] == "other"
    item = "an item of the benchmark that is long enough to be looked for"
    tests = spark.createDataFrame([(k, item) for k in (1, 2, 2)] + [(3, "no one has this sentence in any text at all")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {item} y"), (2, "z")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, tests).collect()) == [(1, 1), (1, 2), (1, 2)]

"""Top-k, toxicity and the pipeline against plain versions."""

import importlib.util
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import toxicity as T
from foliospark.llm import topk

SF = "/root/testdata/sf0.001"


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [(int(i), rng.normal(size=16).round(2).tolist()) for i in range(400)]
    vectors += [(400, vectors[7][1]), (401, vectors[7][1]), (50, vectors[3][1]), (410, None), (420, [None] + [0.5] * 15), (430, [float("nan")] * 16), (440, [float("inf")] * 16), (None, [1.0] * 16), (450, [1e15] * 16), (460, []), (470, [2.0])]
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in vectors], "vec_id long, embedding array<double>, rank int, score string")
    got = topk.top_k(table, F.col("vec_id") % 10 == 0).collect()
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for i, (q, v) in enumerate(whole):
        if q % 10 == 0:
            others = sorted((-sum(a * b for a, b in zip(v, w)), c) for j, (c, w) in enumerate(whole) if j != i)[:5]
            want |= {(q, r, c, max(-topk.LONGEST, min(topk.LONGEST, -s))) for r, (s, c) in enumerate(others, 1)}
    have = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got}
    # among scores held at the limit (all of 450's) the order isn't told
    assert {x for x in have if x[0] != 450} == {x for x in want if x[0] != 450} and sum(x[0] == 450 for x in have) == 5
    assert topk.top_k(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_cells_bound_every_score():
    rng = np.random.default_rng(2)
    for scale in (160, 3, 10**14):
        x, q = (np.floor(rng.normal(size=(n, 12)) * scale) for n in (200, 30))
        low, high = np.minimum(x.min(0), 0), np.maximum(x.max(0), 0)
        step = np.maximum((high - low) / topk.CELLS, 1e-9)
        near, slack = topk.bounds(q, topk.cells_of(x, low, step), step)
        # the exact scores in the same units, without what all vectors share
        unit = np.abs(q).max(1, keepdims=True) * step.max()
        exact = (q @ (x - low - step / 2).T) / unit
        assert (np.abs(near - exact) <= slack[:, None]).all()
        assert slack.max() < 12


def test_top_k_counts_repeated_rows_and_ids(spark):
    rows = [(7, [1.0, 2.0]), (7, [1.0, 2.0]), (0, [3.0, 1.0]), (0, [-1.0, 4.0]), (8, [2.0, 2.0]), (9, [0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(table, F.col("vec_id") == 0, 3).collect()
    whole = [[int(256 * x) for x in v] for _, v in rows]
    want = []
    for q in (2, 3):
        found = sorted((-sum(a * b for a, b in zip(whole[q], v)), rows[i][0]) for i, v in enumerate(whole) if i != q)[:3]
        want += [(0, r, c, -s) for r, (s, c) in enumerate(found, 1)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)


def test_top_k_reads_few_exact_vectors(spark):
    rng = np.random.default_rng(3)
    table = spark.createDataFrame([(i, rng.normal(size=24).tolist()) for i in range(3000)], "vec_id long, embedding array<double>")
    found, read = topk.search(table, F.col("vec_id") % 100 == 0, block=500)
    assert found.count() == 150 and read.count() < 30 * 40


def toxic_sample(seed, n):
    rng = random.Random(seed)
    bag = ["".join(rng.choice(["ta", "ro", "mi", "ne", "lu", "so"]) for _ in range(rng.randrange(1, 5))) for _ in range(300)]
    rows = []
    for i in range(n):
        words = [rng.choice(bag) for _ in range(rng.randrange(1, 150))]
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["zork", "bligh", "vexq" + rng.choice(bag)])
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity_learns_and_scores_whole_texts(spark):
    rows = toxic_sample(3, 1200)
    table = spark.createDataFrame([(i, t, y, "score") for i, t, y in rows], "doc_id long, text string, toxic int, predicted string")
    net = T.fit(table, table.where("doc_id % 3 <> 0"))
    odd = [(-1, None), (-2, ""), (-3, "12 !!"), (None, "taro mine"), (-4, "taro mine " * 30_000 + "zork"), (-4, "taro mine " * 30_000 + "zork")]
    more = spark.createDataFrame([(i, t, None, "x") for i, t in odd], table.schema)
    got = T.score(table.unionByName(more), net).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in got}
    held = [(by[i], y) for i, _, y in rows if i % 3 == 0]
    assert np.mean([r["predicted"] == y for r, y in held]) > 0.97
    assert all(by[i]["score"] == 0 and by[i]["predicted"] == 0 and by[i]["n_windows"] == 0 for i in (-1, -2, -3))
    assert by[-4]["predicted"] == 1 and by[-4]["n_windows"] > 1000
    assert {r["score"] for r in T.score(table, T.fit(table, table.where("toxic = 0"))).collect()} == {0.0}
    assert T.score(table.limit(0), net).count() == 0 and T.fit(table, table.limit(0)) is None


@pytest.mark.parametrize(("sf", "recall", "wrong"), [("sf0.01", 0.75, 2), ("sf0.1", 0.85, 8)])
def test_toxicity_finds_held_out_labels(spark, sf, recall, wrong):
    # at sf0.01 4 of 18 toxic held-out documents hold none of the words or endings that make the others toxic
    folder = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = T.op2_toxicity(spark, folder)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert set(rows) == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for i, r in rows.items())
    held = [(rows[r["doc_id"]]["predicted"], r["toxic"]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if rows[r["doc_id"]]["held_out"]]
    assert np.mean([p for p, y in held if y == 1]) >= recall
    assert sum(p for p, y in held if y == 0) <= wrong


def test_toxicity_gradients():
    rng = np.random.default_rng(4)
    net = T.Network(1)
    net.dense = {k: v.astype("f8") for k, v in net.dense.items()}
    p = rng.normal(size=(9, 6 * T.UNITS))
    index = np.full((3, T.WINDOW), -1)
    index[0, :20], index[1], index[2, :1] = rng.integers(0, 9, 20), rng.integers(0, 9, T.WINDOW), 4
    weights = np.array([0.3, -1.0, 2.0])
    loss = lambda: float(net.logits(p, index) @ weights)
    trace = {}
    net.logits(p, index, trace)
    grads, d_p = net.gradients(weights, trace)
    for name in ("u_fore", "u_back", "a", "v", "o", "bias"):
        value = net.dense[name]
        at = tuple(rng.integers(0, n) for n in value.shape)
        old = value[at]
        value[at] = old + 1e-3
        up = loss()
        value[at] = old - 1e-3
        down = loss()
        value[at] = old
        assert grads[name][at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-3), name
    old = p[4, 3]
    p[4, 3] = old + 1e-3
    up = loss()
    p[4, 3] = old - 1e-3
    down = loss()
    p[4, 3] = old
    assert d_p[index.T == 4][:, 3].sum() == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-3)


def test_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 80, 81, 500):
        ids = np.arange(n)
        found = T.windows(ids)
        assert set(found[found >= 0].tolist()) == set(range(n))
        assert len(found) == len(T.window_starts(n))


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline here")
def test_pipeline_equals_its_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert 0 < len(rows) <= docs.count() and len({r["doc_id"] for r in rows}) == len(rows)
        docs = spark.createDataFrame(rows, docs.schema)
    want = {r["doc_id"]: r["ids"] for r in P.STAGES[-1][1](spark, docs, SF).collect()}
    assert {r["doc_id"]: r["ids"] for r in P.run(spark, SF).collect()} == want
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline here")
def test_stages_on_odd_rows(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    odd = [first, first, first.asDict() | {"doc_id": None}, first.asDict() | {"doc_id": 10**9}, first.asDict() | {"doc_id": 10**9 + 1, "text": None}, first.asDict() | {"doc_id": 10**9 + 2, "text": ""}, first.asDict() | {"doc_id": 10**9 + 3, "text": None, "lang": None}]
    rows = [tuple(r[c] for c in docs.columns) for r in odd]
    names = ("_doc", "_hash", "_copy", "node", "component", "rejected", "lang_pred", "score", "ids", "item_id")
    every = docs.unionByName(spark.createDataFrame(rows, docs.schema)).withColumns({n: docs["doc_id"] for n in names})
    kept = {}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, every, SF)
        assert out.columns == every.columns, name
        assert out.where("NOT (doc_id <=> _doc)").count() == 0, name
        kept[name] = [r["doc_id"] for r in out.collect()]
    odd_ids = {name: sorted((-1 if i is None else i) for i in ids if i is None or i >= 10**9 or i == first["doc_id"]) for name, ids in kept.items()}
    same, nulls = first["doc_id"], [10**9 + 1, 10**9 + 2, 10**9 + 3]
    assert odd_ids["language_id"] == sorted([-1, same, same, same, 10**9]), odd_ids
    assert odd_ids["line_dedup"] == sorted([-1, same, same, same, 10**9, *nulls])
    assert {-1, same} <= set(odd_ids["near_dedup"]) and odd_ids["near_dedup"].count(same) == 1 and 10**9 not in odd_ids["near_dedup"]
    assert set(nulls) <= set(odd_ids["decontaminate"])
    assert P.STAGES[-1][1](spark, every, SF).count() == every.count()

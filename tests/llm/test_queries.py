"""The registered queries on the smallest tables: columns, folds, whole tables, and SQL where there is some."""

import glob
import hashlib
import os
import zlib

import duckdb
import pytest

from foliospark.llm import queries

SF = "/root/testdata/sf0.001"
QUERIES, SQL = queries.queries(), queries.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    names = sorted(columns)
    assert sorted(df.columns) == names
    at = [columns.index(n) for n in names]
    assert sorted(str([r[n] for n in names]) for r in df.collect()) == sorted(str([r[i] for i in at]) for r in cursor.fetchall())


def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_op1_counts_every_token(spark):
    from foliospark.llm.bpe import encoder

    got = {}
    for r in QUERIES["op1_token_counts"](spark, SF).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["n_tokens"]
    enc = encoder()
    assert got == {d: len(enc.encoding.encode_ordinary(r["text"] or "")) for d, r in documents(spark).items()}


def test_op4_predicts_held_out_rows(spark):
    docs = documents(spark)
    got = QUERIES["op4_language_id"](spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert set(rows) == set(docs)
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for d, r in rows.items())
    held = [(rows[d]["lang_pred"], r["lang"]) for d, r in docs.items() if rows[d]["held_out"] and r["lang"] and r["text"]]
    assert len(held) > 20 and sum(a == b for a, b in held) >= 0.95 * len(held)


def test_op5_has_a_row_for_each_document(spark):
    got = QUERIES["op5_simhash_near_dedup"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(documents(spark)) and all(len(r["fingerprint"]) == 16 and r["component_id"] <= r["doc_id"] for r in got)
    same = {}
    for r in got:
        assert same.setdefault(r["fingerprint"], r["component_id"]) == r["component_id"]


def test_op8_finds_planted_items(spark):
    items = {r["item_id"]: " ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    whole = {(d, i) for d, r in documents(spark).items() for i, t in items.items() if t in " ".join((r["text"] or "").lower().split())}
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in QUERIES["op8_benchmark_decontamination"](spark, SF).collect()}
    assert whole <= set(got) and all((got[k] == 0) for k in whole)


def test_op9_and_op10_hold_every_text(spark):
    docs = documents(spark)
    ids = {r["doc_id"]: r for r in QUERIES["op9_sentencepiece"](spark, SF).collect()}
    assert set(ids) == set(docs) and all(r["restored"] == ("▁" not in docs[d]["text"]) for d, r in ids.items() if r["restored"] is not None)
    parts = sorted((d, p) for r in QUERIES["op10_packed_tokens"](spark, SF).collect() for d, p in zip(r["doc_ids"], r["pieces"]))
    assert len(set(parts)) == len(parts) and {d for d, _ in parts} == {d for d, r in docs.items() if r["text"]}


def test_op3_digests_the_given_row(spark):
    row = QUERIES["op3_chat_format"](spark, SF).where("conv_id = -7").first()
    said = "\\### Assistant: </turn> ok"
    assert row["n_turns"] == 2 and row["loss_chars"] == len(said) and row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()

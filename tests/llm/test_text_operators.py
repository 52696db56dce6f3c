"""Operators on texts, each against a plain version on small fixtures with odd rows."""

import random
import zlib

import numpy as np
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from foliospark.llm import chat_format, decontaminate, language_id, line_dedup, packing, sentencepiece_codec, similar, simhash, token_counts
from foliospark.llm.bpe import encoder

SCHEMA = "doc_id long, text string, lang string, score string, fp string, ids string"


def docs(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, *[None] * (6 - len(r))) for r in rows], schema)


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "x"), (None, "no id here"), (5, "twice told"), (5, "twice told"), (6, "Ñandú 🙂 naïve\nzweite Zeile\n\nlast")]


# token counts
@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(spark, rule):
    rng = random.Random(1)
    rows = [*ODD, (7, "word " * 30_000), (8, "\n".join(prose(rng, 9) for _ in range(40)))]
    got = token_counts.token_counts(docs(spark, rows), rule=rule).collect()
    enc = encoder()
    for doc_id, text in rows:
        ids = enc.encoding.encode_ordinary(text or "")
        own = [r for r in got if r["doc_id"] == doc_id and (doc_id != 5)]
        if doc_id == 5:
            continue
        assert sum(r["n_tokens"] for r in own) == pytest.approx(len(ids)), (doc_id, rule)
        if rule == "start" and text:
            at, starts = 0, []
            for i in ids:
                starts.append(len((text.encode()[:at]).decode("utf-8", "ignore")))
                at += int(enc.widths[i])
            for r in own:
                assert r["n_tokens"] == sum(r["start_char"] <= s < r["end_char"] for s in starts)
    assert len([r for r in got if r["doc_id"] == 5]) == 2
    assert token_counts.token_counts(docs(spark, [])).count() == 0


def test_token_counts_of_given_sections(spark):
    sections = spark.createDataFrame([(8, 0, 4), (8, 2, 9), (8, 5, 5), (8, None, 3), (9, 0, 3)], "doc_id long, start_char long, end_char long")
    got = token_counts.token_counts(docs(spark, [(8, "some words here"), (7, "none")]), sections).collect()
    assert [(r["section"], r["n_tokens"]) for r in got] == [(0, 1), (1, 1), (2, 0)]


def test_encoder_equals_whole_encoding():
    enc = encoder()
    for text in ("plain words only", "a  b", " lead", "tail ", "tab\t here", "line\nbreak and more", "it's 12 o'clock!!", "x" * 5000, "é ü z"):
        assert enc.ids(text).tolist() == enc.encoding.encode_ordinary(text)
    assert isinstance(enc.encoding, tiktoken.Encoding)


# SimHash
def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates(spark):
    rng = random.Random(2)
    base = [prose(rng, 80) for _ in range(12)]
    rows = list(ODD)
    for i, t in enumerate(base):
        rows += [(100 + 10 * i + j, " ".join(w if rng.random() > 0.01 * j else "changed" for w in t.split())) for j in range(6)]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    fps = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    want = sorted(((-1 if d is None else d), f"{fps[i]:016x}", least.get(root(i), -1)) for i, (d, _) in enumerate(rows))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["fingerprint"], -1 if r["component_id"] is None else r["component_id"]) for r in got) == want
    kept = simhash.drop_near_duplicates(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({x for _, _, x in want if x >= 0})
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize(("segments", "crowd"), [(2, 32), (2, 1), (3, 32), (4, 32), (4, 0), (7, 3)])
def test_links_connect_all_pairs_within_two_bits(spark, segments, crowd):
    rng = random.Random(16)
    prints = {rng.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1, 1 << 63, 1}
    for base in list(prints)[:40]:
        for _ in range(6):  # near ones, in chains
            base ^= 1 << rng.randrange(64)
            base ^= 1 << rng.randrange(64)
            prints.add(base)
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.near_links(table, segments, crowd).collect()]
    assert all(bin(a ^ b).count("1") <= 2 for a, b in links)

    def groups(pairs):
        parent = {p: p for p in prints}

        def root(p):
            while parent[p] != p:
                p = parent[p]
            return p

        for a, b in pairs:
            parent[root(a)] = root(b)
        return {frozenset(p for p in prints if root(p) == r) for r in set(map(root, prints))}

    every = [(a, b) for a in prints for b in prints if a < b and bin(a ^ b).count("1") <= 2]
    assert groups(links) == groups(every)


def test_texts_that_share_an_id_stay(spark):
    rng = random.Random(14)
    one, two = prose(rng, 60), prose(rng, 60)
    kept = simhash.drop_near_duplicates(docs(spark, [(7, one), (7, two), (8, two), (7, two)])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(7, one), (7, two)])


def plans_of(monkeypatch, module):
    """The plans of what a module writes, as they come."""
    seen, own = [], module.cut
    monkeypatch.setattr(module, "cut", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or own(df))
    return seen


def test_balls_of_fingerprints_never_meet_on_the_driver(spark, monkeypatch):
    plans = plans_of(monkeypatch, simhash)
    table = simhash.cut(spark.createDataFrame([(1 << k,) for k in range(60)], "fp long"))
    simhash.near_links(table).count()
    # the join of what is exploded on both sides
    met = [p for p in plans if p.count("Generate") >= 2 and "bit_count" in p]
    assert len(met) == 1 and met[0].index("SortMergeJoin") < met[0].index("Generate")


# near copies by similarity
def test_bands_of_texts_never_meet_on_the_driver(spark, monkeypatch):
    rng = random.Random(9)
    base = prose(rng, 80).split()
    rows = [(i, " ".join(base[: 80 - i % 12])) for i in range(60)] + [(100 + i, prose(rng, 30)) for i in range(20)]
    plans = plans_of(monkeypatch, similar)
    assert similar.drop_similar(docs(spark, rows)).count() >= 21
    met = [p for p in plans if "Generate posexplode" in p]
    assert met and all("SortMergeJoin" in p[: p.index("Generate posexplode")] and "BroadcastExchange" not in p for p in met)


def test_lines_and_ranks_never_meet_on_the_driver(spark, monkeypatch):
    lines = [f"{w} one two three four five six" for w in WORDS]
    plans = plans_of(monkeypatch, line_dedup)
    left = line_dedup.dedup_lines(docs(spark, [(1, "\n".join(lines)), (2, "\n".join(["x", *lines])), (3, "y")])).orderBy("doc_id").collect()
    assert [r["text"] for r in left] == ["\n".join(lines), "x", "y"]
    assert sum("SortMergeJoin" in p for p in plans) >= 4 and not any("BroadcastExchange" in p for p in plans)


def test_similar_texts_go(spark, tmp_path):
    rng = random.Random(12)
    rows = [r for r in ODD if r[1] and r[1].strip()] + [(20, "two words"), (21, "Two  WORDS"), (22, "other words")]
    for i in range(10):
        base = prose(rng, 400).split()
        rows.append((100 * (i + 1), " ".join(base)))
        for j in range(1, 7):  # a chain of edits: copies of copies are further from the first
            for at in rng.sample(range(400), 2 * j):
                base[at] = f"edit{rng.randrange(10**6)}"
            rows.append((100 * (i + 1) + j, " ".join(base)))

    def grams(t):
        w = t.lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}

    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    only_similar = 0
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                only_similar += bin(plain_fingerprint(rows[i][1]) ^ plain_fingerprint(rows[j][1])).count("1") > 2
                parent[max(root(i), root(j))] = min(root(i), root(j))
    assert only_similar > 10
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    want = sorted(least.values())
    table = docs(spark, rows)
    from corpus_pipeline import near_dedup

    for kept in (similar.drop_similar(table), near_dedup(spark, table, str(tmp_path))):
        assert kept.columns == table.columns
        got = [r["doc_id"] for r in kept.collect()]
        assert sorted(d for d in got if d is not None) == want and got.count(None) == 1
    assert similar.drop_similar(docs(spark, [])).count() == 0
    one_id = similar.drop_similar(docs(spark, [(7, prose(rng, 60)), (7, prose(rng, 60)), (8, None), (9, "")])).collect()
    assert sorted(r["doc_id"] for r in one_id) == [7, 7, 8]


def test_blocks_give_the_links_that_join_components():
    rng = random.Random(1)
    for _ in range(60):
        base = [set(rng.sample(range(300), 60)) for _ in range(3)]
        rows = []
        for i in range(20):
            own = set(rng.choice(base)) if rng.random() > 0.05 else set()
            for _ in range(rng.randrange(0, 14) if own else 0):
                own.discard(rng.choice(sorted(own)))
                own.add(rng.randrange(300, 400))
            rows.append({"node": i, "component": rng.randrange(8) if rng.random() < 0.5 else 100 + i, "shingles": np.array(sorted(own), "<u8").tobytes()})
        sets = [np.frombuffer(r["shingles"], "<u8") for r in rows]
        every = [(i, j) for i in range(20) for j in range(i) if similar.jaccard(sets[i], sets[j]) >= 0.8]

        def joined(pairs, rows=rows):
            parent = {r["component"]: r["component"] for r in rows}

            def root(c):
                while parent[c] != c:
                    c = parent[c]
                return c

            for a, b in pairs:
                parent[root(rows[a]["component"])] = root(rows[b]["component"])
            return {frozenset(c for c in parent if root(c) == r) for r in set(map(root, parent))}

        assert joined(similar.joining_pairs(rows, rows, 0.8, 64)) == joined(every)
        assert joined(similar.joining_pairs(rows[:9], rows[9:], 0.8)) == joined([(i, j) for i, j in every if (i < 9) != (j < 9)])


# line dedup
def plain_later_copies(rows, least):
    lines = {}
    order = sorted({(line_dedup.NO_ID if d is None else d, t) for d, t in rows if t is not None})
    seq = {k: [(n, x.strip(" ")) for n, x in enumerate(k[1].split("\n")) if x.strip(" ")] for k in order}
    seen, gone = {}, {k: set() for k in order}
    for k in order:
        for s in range(len(seq[k])):
            words = 0
            for e in range(s, len(seq[k])):
                words += seq[k][e][1].count(" ") + 1
                if words >= least:
                    run = tuple(x for _, x in seq[k][s : e + 1])
                    if run in seen:
                        gone[k].update(n for n, _ in seq[k][s : e + 1])
                    else:
                        seen[run] = (k, s)
    lines.update({k: "\n".join(x for n, x in enumerate(k[1].split("\n")) if n not in gone[k]) for k in order})
    return lines


def test_line_dedup(spark):
    rng = random.Random(3)
    pool = [prose(rng, rng.randrange(1, 9)) for _ in range(14)]
    rows = [*ODD, (7, "a b c\n" * 200)]
    for i in range(10, 60):
        rows.append((i, "\n".join(rng.choice(pool) if rng.random() < 0.9 else "" for _ in range(rng.randrange(0, 18)))))
    shared = "\n".join(pool[:6])
    rows += [(i, prose(rng, 5) + "\n" + shared + "\n" + prose(rng, 4)) for i in range(60, 66)]
    got = line_dedup.dedup_lines(docs(spark, rows), 12).collect()
    want = plain_later_copies(rows, 12)
    assert len(got) == len(rows)
    pairs = sorted((line_dedup.NO_ID if r["doc_id"] is None else r["doc_id"], r["text"]) for r in got if r["text"] is not None)
    assert pairs == sorted((line_dedup.NO_ID if d is None else d, want[(line_dedup.NO_ID if d is None else d, t)]) for d, t in rows if t is not None)
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_line_dedup_is_native(spark):
    plan = line_dedup.dedup_lines(docs(spark, ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# decontamination
def best_substring(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def best_suffix(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def test_rows_are_told_apart_by_text(spark):
    item = "the quick brown fox jumps over the lazy dog"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    table = spark.createDataFrame([(5, "clean text of its own", 1, "x", 1), (5, f"so {item} went", 2, "y", 2), (None, item, 3, "z", 3)], "doc_id long, text string, _found int, _kept string, _hash int")
    assert [r["_found"] for r in decontaminate.drop_contaminated(table, bench).collect()] == [1]
    assert sorted(r["_found"] for r in simhash.drop_near_duplicates(table).collect()) == [1, 2, 3]
    assert sorted(r["_found"] for r in similar.drop_similar(table).collect()) == [1, 2, 3]


def test_decontamination(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randrange(6, 30))) for i in range(12)] + [(50, None), (51, ""), (52, "short one"), (0, "again " + prose(rng, 8))]
    rows = list(ODD)
    for i in range(100, 160):
        text = list(rng.choice(items[:12])[1])
        for _ in range(rng.randrange(0, 16)):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice(["", "Q", text[at] + "z"])
        rows.append((i, prose(rng, 20) + "\n " + "".join(text).upper() + " " + prose(rng, 10)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(docs(spark, rows), bench, pass_chars=400)
    want = {}
    for d, t in rows:
        for i, x in items:
            if x and len(decontaminate.plain(x)) >= 20:
                p = decontaminate.plain(x)
                if (e := best_substring(p, decontaminate.plain(t))) <= int(0.1 * len(p) + 1e-9):
                    want[(d, i, len(p))] = e
    assert len(want) > 20
    rows_got, text_of, item_of = got.collect(), dict(rows), {(i, len(decontaminate.plain(x))): decontaminate.plain(x) for i, x in items if x}
    assert {(r["doc_id"], r["item_id"]) for r in rows_got} == {(d, i) for d, i, _ in want}
    best = {}
    for (d, i, n), e in want.items():
        best.setdefault((d, i), []).append((e, item_of[i, n]))
    for r in rows_got:
        text, found = text_of[r["doc_id"]], best[r["doc_id"], r["item_id"]]
        # the stretch that ends there is within these edits of the item
        assert any(e <= r["edits"] <= int(0.1 * len(x) + 1e-9) and best_suffix(x, decontaminate.plain(text[: r["end_char"]])) <= r["edits"] for e, x in found)
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(docs(spark, rows), bench).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _, _ in want}
    assert decontaminate.contaminated(docs(spark, []), bench).count() == 0
    assert decontaminate.contaminated(docs(spark, rows), bench.limit(0)).count() == 0


def test_short_items_match_as_whole_words(spark):
    bench = spark.createDataFrame([(1, "Blue whale"), (2, " 42 "), (3, ""), (4, None), (5, "(e = mc)")], "item_id long, text string")
    rows = [(1, "It is a blue\n WHALE."), (2, "blue whales"), (3, "blue whale"), (4, "blue wale"), (5, "142 and 423"), (6, "so 42, then 42"), (7, "with (E = mc)!"), (8, None), (9, "")]
    got = decontaminate.contaminated(docs(spark, rows), bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in got) == [(1, 1, 0), (3, 1, 0), (6, 2, 0), (7, 5, 0)]


def test_edit_end_is_the_least_distance():
    rng = random.Random(5)
    for _ in range(300):
        p = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 80)))
        t = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 90)))
        got = decontaminate.edit_end(decontaminate.bits(p), len(p), t, len(p))
        assert (got[0] if got else len(p)) == best_substring(p, t)


# SentencePiece
def test_sentencepiece_round_trip_and_best_score(spark):
    rows = [*ODD, (7, "a  b   c "), (8, "long" * 4000), (9, "日本語 テキスト \U0001f600 ▁ok"), (10, "The quick brown fox jumps. <s> </s> <0x41>")]
    got = sentencepiece_codec.encode(docs(spark, rows)).collect()
    codec = sentencepiece_codec.codec()
    assert len(got) == len(rows)
    text_of = dict(rows)
    for r in got:  # ▁ in a text decodes to a space, so such a text isn't restored
        assert r["restored"] == (None if text_of[r["doc_id"]] is None else "▁" not in text_of[r["doc_id"]]) and (r["ids"] is None) == (r["restored"] is None)
    back = {r["doc_id"]: r["text"] for r in sentencepiece_codec.decode(sentencepiece_codec.encode(docs(spark, rows))).collect()}
    assert back[10] == rows[-1][1] and back[1] is None and back[2] == ""
    value = {p: codec.scores[i] for i, p in enumerate(codec.pieces) if i not in codec.byte_ids.values() and i > 2}
    for stretch in ("▁jumps", "▁unbelievable", "▁Ñandú", "▁x🙂y", "▁▁▁in", "▁aaaaaaaab"):
        best = [0.0] + [-1e18] * len(stretch)
        for e in range(1, len(stretch) + 1):
            for s in range(e):
                piece = stretch[s:e]
                v = value.get(piece, codec.lost if len(piece) == 1 else None)
                if v is not None:
                    best[e] = max(best[e], best[s] + v)
        score, ids = codec.best(stretch)
        assert score == pytest.approx(best[-1])
        assert b"".join(codec.raw[i] for i in ids).decode() == stretch.replace("▁", " ")
    assert sentencepiece_codec.encode(docs(spark, [])).count() == 0


def test_sentencepiece_scores_reach_the_library(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    codec = sentencepiece_codec.codec()
    for text in ("The quick brown fox", "Quelle heure est-il", "unreasonable effectiveness"):
        ours, theirs = codec.encode(text).tolist(), model.encode(text)
        assert model.decode(ours) == text
        assert sum(codec.scores[i] for i in ours) >= sum(codec.scores[i] for i in theirs)


def test_sentencepiece_ids_are_the_library_s(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in rows] + [(-1, "a  b   c "), (-2, " lead"), (-3, "a" * 5000), (-4, "日本語 テキスト \U0001f600"), (-5, "\tq\n\nz ①x"), (-6, "▁▁ x ▁"), (-7, "xyzzy" * 900)]
    rng = random.Random(15)
    rows += [(-100 - i, "".join(rng.choice("abcdeinrst  ") for _ in range(200))) for i in range(50)]
    got = {r["doc_id"]: r["ids"] for r in sentencepiece_codec.encode(docs(spark, rows)).collect()}
    for d, t in rows:
        assert got[d] == (None if t is None else model.encode(t)), d


# packing
def test_packing_is_lossless_and_best_fit(spark):
    rng = random.Random(6)
    rows = [*ODD, (7, prose(rng, 900))] + [(i, prose(rng, rng.randrange(1, 60))) for i in range(10, 80)]
    length = 64
    got = packing.pack(docs(spark, rows), length, shard_chars=4000).collect()
    parts, enc = {}, encoder()
    for r in got:
        ids, at, cu = np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2"), r["cu_seqlens"]
        assert len(ids) == length == len(at) and cu[0] == 0 and cu[-1] == r["n_tokens"] <= length
        assert (ids[cu[-1] :] == 50256).all()
        for k, (a, b) in enumerate(zip(cu, cu[1:])):
            assert at[a:b].tolist() == list(range(b - a))
            parts.setdefault((r["doc_ids"][k], r["pieces"][k]), []).append(ids[a:b].tolist())
    for d, t in rows:
        want = enc.ids(t or "").tolist()
        have = [x for k in range(len(want) // length + 1) for x in (parts.get((d, k)) or [[]])[0]]
        assert have == want
    assert len(parts[(5, 0)]) == 2
    assert packing.pack(docs(spark, [])).count() == 0


def test_repeated_rows_are_packed_in_several_shards(spark):
    rows = [(9, "one text that is repeated many times")] * 4000
    got = packing.pack(docs(spark, rows).repartition(3), 64, shard_chars=20_000).collect()
    shards = {}
    for r in got:
        shards[r["shard"]] = shards.get(r["shard"], 0) + len(r["doc_ids"])
    assert sum(shards.values()) == 4000 and len(shards) == 8 and max(shards.values()) < 1000
    named = packing.pack(docs(spark, [(1, "a b"), (2, "c")]).withColumn("doc_id", F.concat(F.lit("doc "), "doc_id"))).collect()
    assert sorted(d for r in named for d in r["doc_ids"]) == ["doc 1", "doc 2"]


def test_best_fit_equals_a_plain_search():
    rng = random.Random(7)
    for _ in range(200):
        length = rng.randrange(1, 40)
        sizes = sorted((rng.randrange(1, length + 1) for _ in range(60)), reverse=True)
        rooms = []
        for size, row in zip(sizes, packing.best_fit(sizes, length)):
            fits = [x for x in rooms if x >= size]
            if row == len(rooms):
                assert not fits
                rooms.append(length - size)
            else:
                assert rooms[row] == min(fits)
                rooms[row] -= size


# language ID
def test_language_id(spark):
    rng = random.Random(8)
    bags = {"aa": "kala mika tavo rilu sepo".split(), "bb": "schtum grolz pfandt wrix klotz".split(), "cc": "ouille eauxeur gnoir triste oiseau".split()}
    rows = [(i, " ".join(rng.choice(bags[lang]) for _ in range(30)), lang) for i in range(150) for lang in [sorted(bags)[i % 3]]]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "12 34 ²½ ① !!", "cc"), (None, "kala mika", "aa"), (903, "tavo rilu sepo kala", None), (904, "漢字仮名交文 漢字仮名交文", None), (905, "kala " * 20_000, "aa"), (906, "kala mika", "aa"), (906, "kala mika", "aa")]
    table = docs(spark, rows)
    model = language_id.fit(language_id.learnable(table), sample_per_lang=30)
    got = language_id.predict(table, model, ("lang",)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 150 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert held and all(r["lang_pred"] == r["lang"] and not r["rejected"] and 0 < r["score"] <= 1 for r in held)
    by = {r["doc_id"]: r for r in got}
    for d in (900, 901, 902):
        assert by[d]["lang_pred"] == "und" and by[d]["score"] == 0 and by[d]["rejected"]
    assert by[903]["lang_pred"] == "aa" and by[904]["rejected"] and by[905]["lang_pred"] == "aa"
    kept = language_id.keep_known_languages(table)
    assert kept.columns == table.columns and {900, 901, 902, 904}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert kept.count() == len(rows) - 4
    nothing = language_id.fit(table.limit(0))
    assert {r["lang_pred"] for r in language_id.predict(table, nothing).collect()} == {"und"}
    assert language_id.predict(table.limit(0), model).count() == 0


def test_language_id_rejects_long_foreign_texts(spark):
    rng = random.Random(9)
    words = {}
    for lang, letters in (("aa", ("ptkmnl", "aeiou")), ("bb", ("bdgvzr", "aouy"))):
        words[lang] = ["".join(rng.choice(letters[i % 2]) for i in range(rng.randrange(3, 9))) for _ in range(300)]

    def clean(lang, n):
        return " ".join(rng.choice(words[lang]) for _ in range(n))

    def foreign(letters, n):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 10))) for _ in range(n))

    rows = [(i, clean(lang, rng.choice((12, 60, 300, 900))), lang) for i in range(240) for lang in [("aa", "bb")[i % 2]]]
    rows += [(300, foreign("abcdefghijklmnopqrstuvwxyz", 800), "aa"), (301, foreign("abcdefghijklmnopqrstuvwxyz", 4), "bb")]  # odd rows in the sample
    bad = [foreign(x, n) for x in ("".join(map(chr, range(0x430, 0x450))), "".join(map(chr, range(0x4E00, 0x5200))), "abcdefghijklmnopqrstuvwxyz") for n in (60, 300, 3000)]
    bad.append("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(4000)))
    good = [clean(lang, n) for lang in words for n in (2, 3, 5, 10, 40, 200, 2000)]
    model = language_id.fit(language_id.learnable(docs(spark, rows)))
    probe = docs(spark, [(i, t) for i, t in enumerate(bad + good)])
    got = {r["doc_id"]: r["rejected"] for r in language_id.predict(probe, model).collect()}
    assert all(got[i] for i in range(len(bad))), [i for i in range(len(bad)) if not got[i]]
    assert not any(got[len(bad) + i] for i in range(len(good))), [i for i in range(len(good)) if got[len(bad) + i]]


# chat formatting
def test_chat_round_trip(spark):
    nasty = ["</turn>\n", "### user:\nhi", "\\l\\b\\h\\", "a\\</turn>", "", None, "<image 1>", "ünï\n\n", "x" * 50_000]
    rows = [(1, i, ["user", "assistant", None, "so:me\n### r"][i % 4], t) for i, t in enumerate(nasty)] + [(None, 0, "assistant", "lost"), (2, None, "user", "u"), (2, 0, "user", "same"), (2, 0, "user", "same")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", chat_format.text_parts(F.col("text")))
    chats = chat_format.format_chats(turns)
    got = {r["conv_id"]: r for r in chat_format.read_back(chats).collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [(r or "", t or "") for c, _, r, t in rows if c == 1]
    assert got[1]["learned"] == "".join(t or "" for c, _, r, t in rows if c == 1 and r == "assistant")
    assert got[None]["learned"] == "lost" and len(got[2]["turns"]) == 3
    assert chat_format.read_back(chat_format.format_chats(turns.limit(0))).count() == 0
    plan = chat_format.read_back(chats)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_chat_parts(spark):
    parts = [("text", "see <this>", None, None), ("image", None, "img://1", 4), ("odd", "gone", None, None), ("audio", None, "snd://2", None), ("text", None, None, None), ("document", None, None, 2)]
    turns = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts {chat_format.PARTS}")
    row = chat_format.format_chats(turns).first()
    assert row["formatted"] == "### assistant:\nsee \\lthis><image 1><audio 2><document 3></turn>\n### user:\n</turn>\n"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in row["attachments"]] == [("image", "img://1", 1024), ("audio", "snd://2", 25), ("document", None, 1200)]


def test_placeholders_are_numbered_through_the_conversation(spark):
    image = lambda ref: ("image", None, ref, 1)
    rows = [(1, 0, "user", [image("img://1"), ("text", "<image 1> as text", None, None)]), (1, 1, "user", [("text", "a", None, None), image("img://2"), image("img://3")])]
    # equal turns and roles go by their texts as given, not as escaped
    rows += [(2, 0, "user", [("text", t, None, None)]) for t in ("Za", "<a", "a")] + [(2, None, None, None)]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat_format.PARTS}")
    chats = chat_format.format_chats(turns)
    got = {r["conv_id"]: r for r in chats.collect()}
    assert [(a["turn"], a["number"], a["ref"]) for a in got[1]["attachments"]] == [(0, 1, "img://1"), (1, 2, "img://2"), (1, 3, "img://3")]
    back = {r["conv_id"]: r for r in chat_format.read_back(chats).collect()}
    parts = [[(p["kind"], p["text"] if p["kind"] == "text" else p["number"]) for p in t["parts"]] for t in back[1]["turns"]]
    assert parts == [[("image", 1), ("text", "<image 1> as text")], [("text", "a"), ("image", 2), ("image", 3)]]
    assert [t["text"] for t in back[2]["turns"]] == ["", "<a", "Za", "a"]

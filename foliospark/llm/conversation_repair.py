r"""Conversation structure repair: the cheapest edits that give a conversation's role initials the form (s?(ua)+)?.

A row is kept (0), given the role that must come next, user or assistant (3), or deleted (4); a row without text
may be inserted (3). A row's first fault counts: blank, duplicate (role and text seen earlier) or truncated (its
last character isn't one of .!?). Blank and duplicate rows must go; a truncated one that stays costs 3 more. Of
equally cheap repairs the one whose audit, the letters K, R, D and I in order, is least in ASCII counts.

Method (Hirschberg): after each row a repair is in one of four states: nothing yet, after s, after u, after a. For
the middle of a run of rows, the forward vector holds the least cost of each state from the run's start, and the
order of the four least audits; the backward vector holds the cost from each state to the run's end. Of the states
where both meet at the least sum, the one with the least audit is the crossing, and both halves are solved alike.
Only four numbers a level are held, no table of rows by states. Audits of states can be ordered without being
kept: an audit that takes m rows ends with the mth row's letter, so none is the beginning of another.

On Spark: short rows (no texts) are put in order by ranges of about SEGMENT rows, which split a long conversation.
A run that touches an end of its range gives four forward vectors, one a state it may begin in; at most two
runs a range do, so all fit the driver, where crossings at range ends are found by the same method over these
vectors. Then all ranges are solved alone. Texts meet their edits by row id. A digest of a conversation is a chain:
its pieces pass through one task, in order, one at a time.

Cases: nulls in role or text count as one space; a null turn comes first; a null conversation is one of its own;
rows of one turn come in order of role, of the text's first characters, then of its digest; a role whose first
character isn't s, u or a is never kept; repeated rows are duplicates of the first; an empty table gives no rows;
extra columns, of any name, are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, short_batches, table

#: States: nothing yet, after s, after u, after a; the state that a role leads to, and the role that is given next.
STATES = range(4)
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
GIVEN = ("user", "user", "assistant", "user")
AFTER = tuple(NEXT[q, GIVEN[q][0]] for q in STATES)
RESPELL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows inserted at the end to make a state final.
ENDING = ("", "II", "I", "")
#: A state that costs more than another by this is on no cheapest repair: a deletion and an insertion (7) lead from the other to all that it leads to.
BEYOND = 7
FAULTS = ("", "truncated", "duplicate", "blank")
#: Rows of a range.
SEGMENT = 100_000

Vector = tuple[tuple[int | None, ...], tuple[int, ...]]
#: What a row does: its initial (s, u, a or neither) times 4, and its fault.
Item = int | tuple[Vector, ...]


def edges(kind: int) -> list[tuple[int, int, int, str]]:
    """(state, next state, cost, letters) of a row: inserts before it, and what becomes of it."""
    initial, fault = "sua-"[kind // 4], kind % 4
    best: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(a: int, b: int, cost: int, letters: str) -> None:
        best[a, b] = min(best.get((a, b), (cost, letters)), (cost, letters))

    for q in STATES:
        at, cost, letters = q, 0, ""
        for _ in range(3):
            offer(q, at, cost + DELETE, letters + "D")
            if fault < 2:
                if (at, initial) in NEXT:
                    offer(q, NEXT[at, initial], cost + fault * TRUNCATED, letters + "K")
                offer(q, AFTER[at], cost + fault * TRUNCATED + RESPELL, letters + "R")
            at, cost, letters = AFTER[at], cost + INSERT, letters + "I"
    return [(a, b, c, w) for (a, b), (c, w) in best.items()]


EDGES = [edges(k) for k in range(16)]
LETTERS = [{(a, b): w for a, b, _, w in e} for e in EDGES]
COSTS = [{(a, b): c for a, b, c, _ in e} for e in EDGES]
_forward: dict[tuple[Vector, int], tuple[Vector, int]] = {}
_backward: dict[tuple[tuple[int | None, ...], int], tuple[tuple[int | None, ...], int]] = {}


def unit(q: int) -> Vector:
    return tuple(0 if p == q else None for p in STATES), (0, 0, 0, 0)


def settled(found: dict[int, tuple[int, object]]) -> tuple[Vector, int]:
    """(vector less its least cost, that cost) of {state: (cost, key that orders audits)}."""
    least = min(c for c, _ in found.values())
    left = {q: v for q, v in found.items() if v[0] - least <= BEYOND}
    order = sorted(left, key=lambda q: left[q][1])
    return (tuple(left[q][0] - least if q in left else None for q in STATES), tuple(order.index(q) if q in left else 0 for q in STATES)), least


def forward(vector: Vector, item: Item) -> tuple[Vector, int]:
    """The vector after an item, and what was taken off its costs."""
    if isinstance(item, int) and (vector, item) in _forward:
        return _forward[vector, item]
    costs, ranks = vector
    if isinstance(item, int):
        steps = EDGES[item]
    else:
        steps = [(a, b, item[a][0][b], item[a][1][b]) for a in STATES for b in STATES if item[a][0][b] is not None]
    found: dict[int, tuple[int, object]] = {}
    for a, b, c, key in steps:
        if costs[a] is not None:
            new = (costs[a] + c, (ranks[a], key))
            found[b] = min(found.get(b, new), new)
    out = settled(found)
    if isinstance(item, int):
        _forward[vector, item] = out
    return out


def backward(costs: tuple[int | None, ...], item: Item) -> tuple[tuple[int | None, ...], int]:
    """Costs from each state before an item, and what was taken off."""
    if isinstance(item, int) and (costs, item) in _backward:
        return _backward[costs, item]
    steps = [(a, b, c) for a, b, c, _ in EDGES[item]] if isinstance(item, int) else [(a, b, item[a][0][b]) for a in STATES for b in STATES if item[a][0][b] is not None]
    found = [min((c + costs[b] for x, b, c in steps if x == a and costs[b] is not None), default=None) for a in STATES]
    least = min(c for c in found if c is not None)
    out = tuple(None if c is None else c - least for c in found), least
    if isinstance(item, int):
        _backward[costs, item] = out
    return out


def through(items: Sequence[Item], start: Vector) -> Vector:
    """The forward vector after all items. What an item of vectors took off is the same for all that it begins in."""
    for item in items:
        start = forward(start, item)[0]
    return start


def transfer(kinds: Sequence[int]) -> tuple[Vector, ...]:
    """Four forward vectors, one for each state that a run of rows begins in, on one scale of costs."""
    out = []
    for q in STATES:
        vector, total = unit(q), 0
        for kind in kinds:
            vector, off = forward(vector, kind)
            total += off
        out.append((tuple(None if c is None else c + total for c in vector[0]), vector[1]))
    return tuple(out)


def final_state(vector: Vector) -> int:
    """The state in which the cheapest repair ends its last row."""
    costs, ranks = vector
    return min((costs[q] + INSERT * len(ENDING[q]), ranks[q], q) for q in STATES if costs[q] is not None)[2]


def crossings(items: Sequence[Item], first: int, last: int) -> list[int]:
    """The state after each item of the audit-least cheapest way from state first to state last."""
    out = [last] * len(items)
    todo = [(0, len(items), first, last)]
    while todo:
        low, high, a, b = todo.pop()
        if high - low < 2:
            continue
        mid = (low + high) // 2
        costs, ranks = through(items[low:mid], unit(a))
        back = unit(b)[0]
        for i in range(high - 1, mid - 1, -1):
            back = backward(back, items[i])[0]
        out[mid - 1] = q = min((costs[q] + back[q], ranks[q], q) for q in STATES if costs[q] is not None and back[q] is not None)[2]
        todo += [(low, mid, a, q), (mid, high, q, b)]
    return out


def short_rows(rows: DataFrame) -> DataFrame:
    """id, conv_id, turn, role, head, digest, kind of rows (id, conv_id, turn, role, text without nulls)."""
    digest = F.sha2("text", 256)
    said = rows.select("id", "conv_id", "turn", "role", F.substring("text", 1, 64).alias("head"), digest.alias("digest"), (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("open"))
    firsts = said.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn", "id")).alias("f")).select(F.col("f.id").alias("id"), F.lit(True).alias("first"))
    told = said.join(firsts, "id", "left")
    fault = F.when(F.col("blank"), 3).when(F.col("first").isNull(), 2).when(F.col("open"), 1).otherwise(0)
    initial = F.instr(F.lit("sua"), F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("-"))
    return told.select("id", "conv_id", "turn", "role", "head", "digest", (F.when(initial == 0, 3).otherwise(initial - 1) * 4 + fault).cast("int").alias("kind"))


def in_order(rows: DataFrame) -> DataFrame:
    """id, conv_id, turn, kind, at (place in the order of all rows), seg (its range) of short rows."""
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // SEGMENT))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("digest"), F.col("id")]
    put = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return cut(put.select("id", "conv_id", "turn", "kind", "at", F.shiftright("at", 33).alias("seg")))


def runs(rows: pa.Table) -> tuple[pa.Table, list[tuple[int, int]]]:
    """A range's rows in order, and (start, end) of each conversation's run."""
    rows = rows.sort_by("at").combine_chunks()
    conv = rows["conv_id"]
    if len(conv) < 2:
        return rows, [(0, len(conv))] if len(conv) else []
    one, two = conv.slice(0, len(conv) - 1), conv.slice(1)
    same = pc.or_(pc.fill_null(pc.equal(one, two), False), pc.and_(pc.is_null(one), pc.is_null(two)))
    starts = [0, *(np.nonzero(~same.to_numpy())[0] + 1).tolist()]
    return rows, list(zip(starts, [*starts[1:], len(conv)]))


def solved(rows: DataFrame) -> DataFrame:
    """id, conv_id, turn, at, seg, fault, illegal, cost, parts (edit, role) of rows in order."""
    vectors = "seg long, nth int, conv_id {}, costs array<int>, ranks array<int>, last int".format(rows.schema["conv_id"].dataType.simpleString())

    def ends(group: pa.Table) -> pa.Table:
        group, found = runs(group)
        kinds = group["kind"].to_pylist()
        out = []
        for nth in sorted({0, len(found) - 1}):
            a, b = found[nth]
            t = transfer(kinds[a:b])
            out.append({"seg": group["seg"][0].as_py(), "nth": nth, "conv_id": group["conv_id"][a].as_py(), "costs": [c for v in t for c in v[0]], "ranks": [r for v in t for r in v[1]], "last": kinds[b - 1] // 4})
        return pa.Table.from_pylist(out, pa.schema([("seg", pa.int64()), ("nth", pa.int32()), ("conv_id", group.schema.field("conv_id").type), ("costs", pa.list_(pa.int32())), ("ranks", pa.list_(pa.int32())), ("last", pa.int32())]))

    # at most two rows a range
    met = sorted(rows.select("conv_id", "at", "kind", "seg").groupBy("seg").applyInArrow(ends, vectors).collect(), key=lambda r: (r["seg"], r["nth"]))
    chains: list[list] = []
    for r in met:
        if chains and chains[-1][-1]["conv_id"] == r["conv_id"] and chains[-1][-1]["seg"] != r["seg"]:
            chains[-1].append(r)
        else:
            chains.append([r])
    crossed: dict[tuple[int, int], tuple[int, int, int, bool]] = {}
    for chain in (c for c in chains if len(c) > 1):
        items = [tuple((tuple(r["costs"][q * 4 : q * 4 + 4]), tuple(r["ranks"][q * 4 : q * 4 + 4])) for q in STATES) for r in chain]
        states = [0, *crossings(items, 0, final_state(through(items, unit(0))))]
        for i, r in enumerate(chain):
            crossed[r["seg"], r["nth"]] = (states[i], states[i + 1], chain[i - 1]["last"] if i else -1, i + 1 == len(chain))

    legal = {(0, 1), (1, 2), (2, 1)}
    part = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string())]))

    def each(group: pa.Table) -> pa.Table:
        group, found = runs(group)
        kinds, seg = group["kind"].to_pylist(), group["seg"][0].as_py()
        illegal, costs, parts = [], [], []
        for nth, (a, b) in enumerate(found):
            own = kinds[a:b]
            state, last, before, is_end = crossed.get((seg, nth)) or (0, final_state(through(own, unit(0))), -1, True)
            for i, after in enumerate(crossings(own, state, last)):
                kind = own[i]
                illegal.append(before >= 0 and (before, kind // 4) not in legal)
                before = kind // 4
                cost, done = COSTS[kind][state, after], []
                for letter in LETTERS[kind][state, after]:
                    done.append({"edit": letter, "role": GIVEN[state] if letter in "IR" else None})
                    if letter in "IR":
                        state = AFTER[state]
                if is_end and i + 1 == len(own):
                    cost, state = cost + INSERT * len(ENDING[after]), after
                    for letter in ENDING[after]:
                        done.append({"edit": letter, "role": GIVEN[state]})
                        state = AFTER[state]
                state = after
                costs.append(cost)
                parts.append(done)
        out = [group[c] for c in ("id", "conv_id", "turn", "at", "seg")]
        return pa.table([*out, pa.array([FAULTS[k % 4] for k in kinds], pa.string()), pa.array(illegal, pa.bool_()), pa.array(costs, pa.int64()), pa.array(parts, part)], ["id", "conv_id", "turn", "at", "seg", "fault", "illegal", "cost", "parts"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.groupBy("seg").applyInArrow(each, f"id long, conv_id {kind['conv_id']}, turn {kind['turn']}, at long, seg long, fault string, illegal boolean, cost long, parts array<struct<edit:string,role:string>>")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: id, conv_id, turn, role, text without nulls; edits: id, conv_id, turn, at, seg, fault, illegal, cost, parts).

    A row's parts say in order what is inserted before it (I), what becomes of it (K, R, D), and, for the last row, what is inserted after it; role is that of a
    row inserted or given another role. illegal: the row's initial may not follow that of the row before.
    """
    space = F.lit(" ")
    rows = cut(conversations.select(F.monotonically_increasing_id().alias("id"), "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")))
    return rows, cut(solved(in_order(short_rows(rows))))


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, at, nth, edit, role, text: the rows of repaired conversations in order of (at, nth), the deleted ones (D) among them."""
    both = edits.join(rows.select("id", F.col("role").alias("own"), "text"), "id").select("conv_id", "at", "own", "text", F.posexplode("parts").alias("nth", "p"))
    return both.select("conv_id", "at", "nth", "p.edit", F.coalesce("p.role", "own").alias("role"), F.when(F.col("p.edit") == "I", "").otherwise(F.col("text")).alias("text"))


def digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, audit, repaired_sha256 (of role:text, joined by newlines) of each conversation."""
    line = F.transform(F.filter("parts", lambda p: p["edit"] != "D"), lambda p: F.concat(F.coalesce(p["role"], F.col("role")), F.lit(":"), F.when(p["edit"] == "I", "").otherwise(F.col("text"))))
    own = edits.join(rows.select("id", "role", "text"), "id").select("conv_id", "seg", F.struct("at", F.array_join(F.transform("parts", lambda p: p["edit"]), "").alias("audit"), line.alias("lines")).alias("r"))
    sorted_ = F.sort_array(F.collect_list("r"))
    pieces = own.groupBy("conv_id", "seg").agg(sorted_.alias("r")).select("conv_id", "seg", F.array_join(F.transform("r", lambda x: x["audit"]), "").alias("audit"), F.flatten(F.transform("r", lambda x: x["lines"])).alias("lines"))
    texts = pieces.select("conv_id", "seg", "audit", (F.size("lines") > 0).alias("some"), F.array_join("lines", "\n").alias("text"))
    kind = texts.schema["conv_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begun, audit, chain, some = None, False, [], hashlib.sha256(), False

        def done(conv: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], conv), pa.array(["".join(audit)]), pa.array([chain.hexdigest()])], ["conv_id", "audit", "repaired_sha256"])

        for b in batches:
            conv = b.schema.field("conv_id").type
            for r in b.to_pylist():
                if begun and r["conv_id"] != now:
                    yield done(conv)
                    audit, chain, some = [], hashlib.sha256(), False
                now, begun = r["conv_id"], True
                audit.append(r["audit"])
                if r["some"]:
                    chain.update((("\n" if some else "") + r["text"]).encode())
                    some = True
        if begun:
            yield done(conv)

    return short_batches(texts.repartition("conv_id").sortWithinPartitions("conv_id", "seg")).mapInArrow(each, f"conv_id {kind}, audit string, repaired_sha256 string")


def reports(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row a conversation that has rows."""
    rows, edits = repair(conversations)
    turn = F.col("turn").cast("long")
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0).cast("long"))
    counts = edits.groupBy("conv_id").agg(gaps.alias("gaps"), *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")], F.count_if("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    return counts.join(digests(rows, edits).withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with known faults: by crc32 of `conv_id:turn` modulo 20, a row is dropped (0), loses its text (1) or its .!? (2), is repeated (3) or becomes the user's (4)."""
    space = F.lit(" ")
    filled = lambda c: F.coalesce(F.col(c).cast("string"), space)
    lot = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), lot.alias("lot")).where("lot <> 0")
    text = F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("lot") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("lot") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("_n")).drop("_n")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = reports(damaged(given)).withColumnRenamed("conv_id", "_c")
    full = given.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    return full.na.fill(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).na.fill({"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()})


def _steps(b: int) -> str:
    """SQL: the least (cost, audit, text) of state b after a row o, from v's states before it."""
    out = []
    for q in STATES:
        at, letters, text = q, "", ""
        for i in range(3):
            now = lambda cost, letter, line: f"{{'c': v.s[{q + 1}].c + {INSERT * i} + {cost}, 'a': v.s[{q + 1}].a || '{letters}{letter}', 't': v.s[{q + 1}].t || '{text}'{line}}}"  # noqa: B023, E731
            if at == b:
                out.append(now(str(DELETE), "D", ""))
            for (a, initial), after in NEXT.items():
                if (a, after) == (at, b):
                    out.append(f"CASE WHEN o.fault < 2 AND o.role[1] = '{initial}' THEN {now(f'o.fault * {TRUNCATED}', 'K', ' || chr(10) || o.role || chr(58) || o.text')} END")
            if AFTER[at] == b:
                out.append(f"CASE WHEN o.fault < 2 THEN {now(f'o.fault * {TRUNCATED} + {RESPELL}', 'R', f' || chr(10) || {chr(39)}{GIVEN[at]}:{chr(39)} || o.text')} END")
            letters, text, at = letters + "I", text + f"' || chr(10) || '{GIVEN[at]}:", AFTER[at]
    return f"list_min([{', '.join(out)}])"


OP12_SQL = rf"""
WITH RECURSIVE tb AS (SELECT list(v ORDER BY i) AS tb FROM (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i))),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, [CAST(ascii(x) AS BIGINT) FOR x IN string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')] AS key FROM conversations),
l AS (SELECT k.*, xor(4294967295, list_reduce(list_prepend(4294967295, key), lambda c, b: xor(c >> 8, tb[(xor(c, b) & 255) + 1]))) % 20 AS lot FROM k, tb),
d AS (SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role, CASE lot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN lot = 3 THEN 2 ELSE 1 END)) AS nth FROM l WHERE lot <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(text, 1, 64), sha256(text), nth) AS i FROM d),
o AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 3 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 1 ELSE 0 END AS fault,
  coalesce(lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au'), false) AS illegal FROM n),
v AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, [{{'c': 0, 'a': '', 't': ''}}, NULL, NULL, NULL] AS s FROM (SELECT DISTINCT conv_id FROM o)
  UNION ALL SELECT v.conv_id, v.i + 1, [{", ".join(_steps(b) for b in STATES)}] FROM v JOIN o ON o.conv_id IS NOT DISTINCT FROM v.conv_id AND o.i = v.i + 1),
e AS (SELECT conv_id, list_min([s[1], {{'c': s[2].c + 6, 'a': s[2].a || 'II', 't': s[2].t || chr(10) || 'user:' || chr(10) || 'assistant:'}}, {{'c': s[3].c + 3, 'a': s[3].a || 'I', 't': s[3].t || chr(10) || 'assistant:'}}, s[4]]) AS r FROM v
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 3) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 1) AS truncated, count(*) FILTER (illegal) AS illegal FROM o GROUP BY conv_id)
SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(r.c, 0) AS BIGINT) AS cost,
  coalesce(r.a, '') AS audit, sha256(coalesce(r.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS g LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM g.conv_id
"""

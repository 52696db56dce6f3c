"""Benchmark passages in documents, within an edit distance: exact hits of pieces, verified bit-parallel.

An item of m characters may differ by k = floor(error_rate * m) edits. Cut into k + 1 pieces, one of them
must occur unchanged. From that piece upward, a stretch of t pieces on the way to the whole item must occur
with under t edits, and the first that doesn't ends the search for that hit. Text and items are compared in
lower case with single spaces.

Cases: null or empty texts and items match nothing; items of under min_chars characters (after the spaces)
match only unchanged and as whole words, as they'd be found by chance with edits; an item found several times in a document is one row, for its
first place found; repeated rows of either table give repeated rows; an empty table gives no rows. Only
doc_id, text and item_id, text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, short_batches, table

ERROR_RATE = 0.1
MIN_CHARS = 20
#: Characters of items that one pass over the documents looks for; more items take more passes.
PASS_CHARS = 4_000_000


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def edit_end(masks: dict[str, int], m: int, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best stretch of text for a pattern of m characters, if within `most` edits: Myers' bit vectors.

    masks: for each character, a bit for each place of it in the pattern.
    """
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, distance, best = full, 0, m, None
    for end, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        x = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (~(x | plus) & full), plus & x
        if up & high:
            distance += 1
        elif down & high:
            distance -= 1
        if distance <= most and (best is None or distance < best[0]):
            best = (distance, end)
        up, down = (up << 1) & full, (down << 1) & full  # a match may begin anywhere
        v = eq | minus
        plus, minus = down | (~(v | up) & full), up & v
    return best


def bits(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def cuts(m: int, k: int) -> list[int]:
    return [i * m // (k + 1) for i in range(k + 2)]


def upward(pieces: int, leaf: int) -> list[tuple[int, int]]:
    """The stretches of pieces that hold the leaf, by halving: from its smallest above it to all."""
    low, high, path = 0, pieces, []
    while high - low > 1:
        path.append((low, high))
        middle = (low + high) // 2
        low, high = (low, middle) if leaf < middle else (middle, high)
    return path[::-1]


def whole_words(text: str, start: int, end: int) -> bool:
    """Neither end of the stretch is within a word."""
    return not any(0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum() for at in (start, end))


class Matcher:
    """Finds items in texts; built in each task from the items' texts."""

    def __init__(self, items: list[str], error_rate: float, min_chars: int = MIN_CHARS) -> None:
        self.items, self.min_chars = items, min_chars
        self.budget = [int(error_rate * len(x) + 1e-9) if len(x) >= min_chars else 0 for x in items]
        self.places = [cuts(len(x), k) for x, k in zip(items, self.budget)]
        found: dict[str, list[tuple[int, int]]] = {}
        for i, at in enumerate(self.places):
            for leaf in range(len(at) - 1):
                found.setdefault(items[i][at[leaf] : at[leaf + 1]], []).append((i, leaf))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()
        self.masks = lru_cache(50_000)(lambda i, a, b: bits(items[i][a:b]))

    def verify(self, text: str, start: int, i: int, leaf: int) -> tuple[int, int] | None:
        """(edits, end in text) of item i around its piece `leaf`, which begins at start."""
        if len(self.items[i]) < self.min_chars and not whole_words(text, start, start + len(self.items[i])):
            return None
        at, k = self.places[i], self.budget[i]
        offset, found = at[leaf], (0, start + at[leaf + 1] - at[leaf])
        for low, high in upward(k + 1, leaf):
            a, b, most = at[low], at[high], high - low - 1
            begin = max(0, start - (offset - a) - most)
            best = edit_end(self.masks(i, a, b), b - a, text[begin : start + (b - offset) + most], most)
            if best is None:
                return None
            found = (best[0], begin + best[1])
        return found

    def matches(self, text: str) -> dict[int, tuple[int, int]]:
        found: dict[int, tuple[int, int]] = {}
        for last, (size, owners) in self.automaton.iter(text) if text and self.items else ():
            for i, leaf in owners:
                if i not in found and (hit := self.verify(text, last + 1 - size, i, leaf)):
                    found[i] = hit
        return found


def contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS, pass_chars: int = PASS_CHARS) -> DataFrame:
    """doc_id, item_id, edits, end_char (in the document's text): each item in each document; an item given several times counts as often.

    The items are split by hash into passes of about pass_chars characters, so that no task holds more,
    whatever the benchmark's size; each pass reads the documents once.
    """
    items = benchmark.where(F.length("text") > 0).select("item_id", F.xxhash64("text").alias("item"), "text")
    # a text that several items have is looked for once
    tests = items.select("item", "text").distinct()
    total = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = -(-total // pass_chars) or 1
    texts = short_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    if passes == 1:
        found = found_by(texts, tests, error_rate, min_chars)
    else:
        # one pass at a time: its items leave the driver before the next ones come
        parts = (tests.where(F.pmod("item", F.lit(passes)) == n) for n in range(passes))
        found = reduce(DataFrame.unionByName, [cut(found_by(texts, part, error_rate, min_chars)) for part in parts])
    return found.join(items.select("item_id", "item"), "item").select("doc_id", "item_id", "edits", "end_char")


def found_by(texts: DataFrame, tests: DataFrame, error_rate: float, min_chars: int) -> DataFrame:
    """doc_id, item, edits, end_char of the texts (item, text) of one pass."""
    rows = [(r["item"], t) for r in tests.collect() if (t := plain(r["text"]))]
    schema = pa.schema([("doc_id", pa.int64()), ("item", pa.int64()), ("edits", pa.int32()), ("end_char", pa.int64())])
    shared = texts.sparkSession.sparkContext.broadcast(rows)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        matcher = Matcher([t for _, t in items], error_rate, min_chars)
        for b in batches:
            got = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                hits = matcher.matches(plain(text))
                ends = places_in(text, [end for _, end in hits.values()]) if hits else {}
                got += [(doc, items[i][0], e, ends[end]) for i, (e, end) in hits.items()]
            yield pa.RecordBatch.from_pydict({c: [g[j] for g in got] for j, c in enumerate(schema.names)}, schema)

    return texts.mapInArrow(each, "doc_id long, item long, edits int, end_char long")


def places_in(text: str, ends: list[int]) -> dict[int, int]:
    """Where stretches of plain(text) that end at `ends` end in the text itself."""
    out: dict[int, int] = {}
    todo, at, upto = sorted(set(ends), reverse=True), 0, 0
    for word in text.split():
        begin = text.index(word, at)
        at, width = begin + len(word), len(word.lower())
        while todo and todo[-1] <= upto + width + 1:
            end = todo.pop()
            # a letter's lower case may be longer than the letter
            size = next((n for n in range(len(word) + 1) if len(word[:n].lower()) >= end - upto), len(word) + 1)
            out[end] = begin + size
        upto += width + 1
    return out


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """docs without the rows whose text holds an item, whatever their ids; columns may have any name."""
    inner = [f"_c{i}" for i in range(len(docs.columns))]
    named = docs.toDF(*inner).withColumn("_hash", F.xxhash64(inner[docs.columns.index("text")]))
    # rows are told apart by their texts: a text holds an item or not
    texts = named.select(F.col("_hash").alias("doc_id"), F.col(inner[docs.columns.index("text")]).alias("text"))
    found = contaminated(texts, benchmark, error_rate).select(F.col("doc_id").alias("_found")).distinct()
    return named.join(found, F.col("_hash") == F.col("_found"), "left_anti").select(*inner).toDF(*docs.columns)

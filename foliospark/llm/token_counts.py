"""Token counts of sections: a document is encoded once, and its tokens' spans are attributed to sections.

A token's span is the characters whose bytes it holds (a character cut between tokens is in each of them).
A token that crosses a boundary is allocated by one of these rules: `start`, `middle`, `end` give it to the
sections that hold its first, middle (of two, the first) or last character; `split` gives each section the
share of its characters. Sections are half-open character intervals, sorted and joined to the spans by
binary search. Tokens outside all sections count for none; where sections overlap, each counts its own.

Cases: null or empty text has one section [0, 0) with no token; sections that are null, or end before they
start, count none; sections of documents that aren't there are left out, documents without sections give no
row (except by lines); repeated rows of documents each give their rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import VOCABULARY, encoder
from .common import short_batches, table

RULES = ("start", "middle", "end", "split")


def spans(data: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) character of each token, from the text's bytes and the tokens' lengths in bytes."""
    ends = np.cumsum(widths)
    starts = ends - widths
    if not len(data) or data.max() < 128:
        return starts, ends
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    return char[starts], char[ends - 1] + 1


def attribute(first: np.ndarray, end: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section [starts, ends)."""
    if rule == "split":
        edges = np.concatenate([[0], end]).astype("f8")
        upto = lambda x: np.interp(x, *dedupe(first, edges))
        return np.maximum(upto(ends) - upto(starts), 0)
    anchor = {"start": first, "end": end - 1, "middle": (first + end - 1) // 2}[rule]
    return np.maximum(np.searchsorted(anchor, ends) - np.searchsorted(anchor, starts), 0).astype("f8")


def dedupe(first: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(character, tokens before it): a running count that is linear within a token; tokens that share a character share its width."""
    places, counts = np.unique(edges, return_index=True)
    return places, np.concatenate([counts[1:], [len(edges)]]) - 1.0


def lines(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sections of a text by lines, each with its newline."""
    lead = (data & 0xC0) != 0x80
    n = int(lead.sum())
    cut = np.cumsum(lead)[data == 10]
    starts = np.concatenate([[0], cut[cut < n]])
    return starts, np.concatenate([starts[1:], [n]])


def token_counts(docs: DataFrame, sections: DataFrame | None = None, rule: str = "start", path: str = VOCABULARY) -> DataFrame:
    """doc_id, section (from 0, in order), start_char, end_char, n_tokens (double for `split`).

    sections: doc_id, start_char, end_char; without it, the lines of the text with their newlines, which
    cover it, so that a document's counts add up to its tokens.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind, count = dict(docs.dtypes)["doc_id"], "double" if rule == "split" else "long"
    texts, by_lines = docs.select("doc_id", "text"), sections is None
    if sections is not None:
        some = sections.where("start_char IS NOT NULL AND end_char IS NOT NULL AND doc_id IS NOT NULL")
        own = some.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(F.col("start_char").cast("long").alias("s"), F.col("end_char").cast("long").alias("e")))).alias("_s"))
        texts = texts.join(own, "doc_id").select("doc_id", "text", F.col("_s.s").alias("s"), F.col("_s.e").alias("e"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            row, number, starts, ends, counts = [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                data = np.frombuffer((text or "").encode("utf-8", "replace"), "u1")
                first, end = spans(data, enc.widths[enc.ids(text or "")])
                s, e = lines(data) if by_lines else (np.array(b.column(j)[i].as_py(), "i8") for j in (2, 3))
                row.append(np.full(len(s), i))
                number.append(np.arange(len(s)))
                starts.append(s)
                ends.append(e)
                counts.append(attribute(first, end, s, e, rule))
            parts = [np.concatenate(x) if x else np.zeros(0, "i8") for x in (row, number, starts, ends, counts)]
            out = [b.column(0).take(pa.array(parts[0])), pa.array(parts[1].astype("i4")), *(pa.array(p.astype("i8")) for p in parts[2:4]), pa.array(parts[4].astype("f8" if rule == "split" else "i8"))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "section", "start_char", "end_char", "n_tokens"])

    return short_batches(texts).mapInArrow(each, f"doc_id {kind}, section int, start_char long, end_char long, n_tokens {count}")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))

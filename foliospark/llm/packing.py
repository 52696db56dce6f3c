"""Token ids packed into rows of fixed length, best fit first in decreasing order.

Documents are encoded whole; those over the row's length are split into full rows and a rest, without
loss. Pieces are spread by hash over shards of about SHARD_CHARS characters; equal pieces of repeated rows are
numbered, and spread by their numbers too; in a shard the longest piece goes first, each
into the row with the least room that still holds it. Room is searched in a segment tree over the numbers
of free tokens: the smallest number that is enough and has a row. A row's output is its ids (with padding),
cumulative lengths of its segments, positions that begin anew at each segment, and its segments' origins.

Cases: null and empty texts have no piece and are in no row; equal lengths go by doc_id, then piece;
repeated rows are packed each; a null doc_id is packed as the others; an empty table gives no rows. Only
doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import VOCABULARY, encoder
from .common import short_batches, table

LENGTH = 2048
#: Characters of texts to a shard, on average.
SHARD_CHARS = 8_000_000


class Rooms:
    """A segment tree over room sizes 0..length: which sizes have an open row."""

    def __init__(self, length: int) -> None:
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def change(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self.change(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) of the smallest room of at least `least`: up to the first subtree on the right that has one, and down to its left."""
        at = least + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        row = self.rows[room].pop()
        self.change(room, -1)
        return room, row


def best_fit(sizes: list[int], length: int) -> list[int]:
    """The row of each piece; sizes are in decreasing order."""
    rooms, out, rows = Rooms(length), [], 0
    for size in sizes:
        if size == length or (found := rooms.take(size)) is None:
            found = length, rows
            rows += 1
        out.append(found[1])
        if found[0] > size:
            rooms.put(found[0] - size, found[1])
    return out


def pieces(docs: DataFrame, length: int, shards: int, path: str = VOCABULARY) -> DataFrame:
    """shard, doc_id, piece, n, ids (bytes of uint32): texts' ids in pieces of up to `length`."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        met: dict[int, int] = {}
        for b in batches:
            row, piece, size, ids, key = [], [], [], [], []
            for i, (doc, text) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                all_ids = enc.ids(text or "")
                # the how manyth row of this task with this id and text: equal rows may be told apart in any order
                name = xxhash.xxh64_intdigest(all_ids.tobytes(), crc32(str(doc).encode()))
                nth = met[name] = met.get(name, -1) + 1
                for k, at in enumerate(range(0, len(all_ids), length)):
                    part = all_ids[at : at + length]
                    row.append(i)
                    piece.append(k)
                    size.append(len(part))
                    ids.append((part.astype("<u2") if enc.size <= 1 << 16 else part.astype("<u4")).tobytes())
                    key.append((name + nth * 0x9E3779B97F4A7C15 + k) & 0x7FFFFFFFFFFFFFFF)
            out = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(size, pa.int32()), pa.array(ids, pa.binary()), pa.array(key, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "n", "ids", "key"])

    cut = short_batches(docs.select("doc_id", "text")).mapInArrow(each, f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, n int, ids binary, key long")
    return cut.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")).drop("key")


PACKED = "shard int, row int, ids binary, cu_seqlens array<int>, position_ids binary, doc_ids array<{}>, pieces array<int>, n_tokens int"


def pack(docs: DataFrame, length: int = LENGTH, pad: int = 50256, shard_chars: int = SHARD_CHARS, path: str = VOCABULARY) -> DataFrame:
    """shard, row, ids (length little-endian numbers: uint16, or uint32 for larger vocabularies), cu_seqlens (from 0), position_ids (uint16 or uint32 likewise), doc_ids and pieces of the segments, n_tokens."""
    shards = -(-(docs.agg(F.sum(F.length("text"))).first()[0] or 0) // shard_chars) or 1

    def each(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "doc_id", "piece"], ascending=[False, True, True], na_position="first")
        wide = "<u2" if len(pdf["ids"].iloc[0]) == 2 * pdf["n"].iloc[0] else "<u4"
        width = np.dtype(wide).itemsize
        own = np.array(best_fit(pdf["n"].tolist(), length))
        order = np.argsort(own, kind="stable")
        sizes, ids, piece = (pdf[c].to_numpy()[order] for c in ("n", "ids", "piece"))
        doc_ids = [None if pd.isna(d) else whole(d) for d in pdf["doc_id"].to_numpy()[order]]
        counting, padding = np.arange(length).astype(wide).tobytes(), np.full(length, pad, wide).tobytes()
        starts = np.flatnonzero(np.diff(own[order], prepend=-1)).tolist()
        out = []
        for row, (a, b) in enumerate(zip(starts, [*starts[1:], len(own)])):
            ends = np.cumsum(sizes[a:b]).tolist()
            rest = width * (length - ends[-1])
            positions = b"".join([counting[: width * n] for n in sizes[a:b].tolist()]) + bytes(rest)
            out.append((row, b"".join(ids[a:b]) + padding[:rest], [0, *ends], positions, doc_ids[a:b], piece[a:b].tolist(), ends[-1]))
        made = pd.DataFrame(out, columns=["row", "ids", "cu_seqlens", "position_ids", "doc_ids", "pieces", "n_tokens"])
        made.insert(0, "shard", pdf["shard"].iloc[0])
        return made

    kind = dict(docs.dtypes)["doc_id"]
    whole = str if kind == "string" else int
    return pieces(docs, length, shards, path).groupBy("shard").applyInPandas(each, PACKED.format(kind))


def op10_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))

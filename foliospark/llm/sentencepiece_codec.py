"""SentencePiece ids of texts and back: an Aho-Corasick automaton over the pieces drives a Viterbi pass.

A text is its characters with spaces as ▁ and one ▁ before it. Characters are read once; at each position the
automaton's output links give the pieces that end there, and each relaxes the best score of that position.

- A unigram model's scores are log probabilities: of all ways to cut the text the ids are those with the
  highest sum; of equal ones, at each position, that with the longest last piece.
- A model made by merging has ranks for scores: pairs of pieces are merged, the best rank first, so a sum of
  ranks alone isn't what it maximises. A cut is the merged one exactly if each two neighbours would also be left
  as they are if merged alone: merges within a stretch don't depend on what follows it. So the same pass takes agreement
  as its test of what may be relaxed: a piece relaxes the best score of a position if its sum is higher and it agrees with the last piece
  before it. The ids are the library's. Whether two pieces agree is found from the order in which their characters merge, and remembered.

A character without a piece becomes the byte pieces of its UTF-8 form, at a score below any piece's.

No piece holds ▁ after another character (this is checked when a model is read), so each stretch of ▁ and
what follows it is cut on its own, and stretches seen before come from a bounded memory.

Cases: null text gives null ids; an empty text no ids; control pieces' strings in a text are ordinary text;
each row, repeated or not, is encoded; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import REMEMBERED, Remembered
from .common import short_batches, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
STRETCH = re.compile(f"{SPACE}+[^{SPACE}]*")


class Codec:
    """Pieces of a model file, and their automaton."""

    def __init__(self, path: str = MODEL) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids, self.unknown = {}, model.unk_id()
        self.scores = [0.0] * size
        self.automaton, self.single = ahocorasick.Automaton(), set()
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError(f"piece {i} holds {SPACE} after another character")
                self.scores[i] = model.get_score(i)
                self.automaton.add_word(piece, (len(piece), self.scores[i], i))
                if len(piece) == 1:
                    self.single.add(piece)
        self.automaton.make_automaton()
        self.lost = min(self.scores) - 10
        # what an id decodes to: a byte, or text
        self.raw = [b""] * size
        for i, piece in enumerate(self.pieces):
            self.raw[i] = piece.replace(SPACE, " ").encode()
        for byte, i in self.byte_ids.items():
            self.raw[i] = bytes([byte])
        self.stretches = Remembered(self.ids_of)
        self.words = Remembered(lambda w: self.ids_of(SPACE + w))
        self.number = {p: i for i, p in enumerate(self.pieces) if self.raw[i] == p.replace(SPACE, " ").encode() and p}
        # ranks are the whole numbers 0, -1, -2...: a model made by merging
        normal = [self.scores[i] for i in self.number.values() if i not in self.byte_ids.values() and self.scores[i]]
        self.merging = bool(normal) and all(x == int(x) and x < 0 for x in normal)
        self.rank = {p: -self.scores[i] for p, i in self.number.items()} if self.merging else {}
        self.agreeing: dict[tuple[int, int], bool] = {}
        self.spines: dict[int, tuple[list, list] | None] = {}

    def ends_of(self, piece: int) -> tuple[list, list] | None:
        """(what begins, what ends the piece while it is merged from its characters, each with the rank of the merge that consumes it); None if merging doesn't give the piece."""
        if (found := self.spines.get(piece, False)) is False:
            parts, first, last = list(self.pieces[piece]), [], []
            while len(parts) > 1:
                ranks = [(self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank]
                if not ranks:
                    break
                rank, at = min(ranks)
                if at == 0:
                    first.append((parts[0], rank))
                if at == len(parts) - 2:
                    last.append((parts[-1], rank))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            whole = (self.pieces[piece], float("inf"))
            found = self.spines[piece] = ([*first, whole], [*last, whole]) if len(parts) == 1 else None
        return found

    def agree(self, one: int, two: int) -> bool:
        """Whether merging the characters of two pieces together leaves these two; of the second alone after none (-1).

        A piece's rank is behind those of its parts, so merges go in the order of ranks, and a merge over the
        boundary happens if its rank comes before those that consume its two sides (of equal ones the left one first).
        """
        if (found := self.agreeing.get((one, two))) is None:
            if len(self.agreeing) >= 4 * REMEMBERED:  # as bounded as the words
                self.agreeing.clear()
            left, right = self.ends_of(one) if one >= 0 else ([], []), self.ends_of(two)
            found = left is not None and right is not None
            if found:
                rank, last = self.rank, float("inf")
                found = not any((r := rank.get(x + y, last)) < gone and r <= taken and r < last for x, gone in left[1] for y, taken in right[0])
            self.agreeing[one, two] = found
        return found

    def best(self, stretch: str, merged: bool = False) -> tuple[float, list[int]]:
        """The highest sum of scores and its ids; with merged, of the cuts whose pieces agree, each with the one before it."""
        n, agreeing, agree = len(stretch), self.agreeing, self.agree
        score = [0.0] + [float("-inf")] * n
        # the last piece of each position's best cut, and its length: -1 for none, or for a character without a piece
        last, size_of = [-1] * (n + 1), [1] * (n + 1)
        known = self.single.issuperset(stretch)
        upto = 0
        for at, (size, value, i) in self.automaton.iter(stretch):
            end = at + 1
            if not known:
                upto = self.relax_unknown(stretch, score, last, size_of, upto, at)
            begin = end - size
            if (s := score[begin] + value) > score[end] and (not merged or (ok := agreeing.get((last[begin], i))) or (ok is None and agree(last[begin], i))):
                score[end], last[end], size_of[end] = s, i, size
        if not known:
            self.relax_unknown(stretch, score, last, size_of, upto, n)
        ids: list[int] = []
        at = n
        while at:
            if (i := last[at]) >= 0:
                ids.append(i)
            else:
                ids.extend(self.byte_ids.get(b, self.unknown) for b in reversed(stretch[at - 1].encode("utf-8", "replace")))
            at -= size_of[at]
        return score[n], ids[::-1]

    def relax_unknown(self, stretch: str, score: list, last: list, size_of: list, upto: int, end: int) -> int:
        """Characters without a piece that end up to `end` relax their positions by the lost score."""
        for at in range(upto + 1, end + 1):
            if stretch[at - 1] not in self.single and (s := score[at - 1] + self.lost) > score[at]:
                score[at], last[at], size_of[at] = s, -1, 1
        return max(upto, end)

    def ids_of(self, stretch: str) -> bytes:
        return np.array(self.best(stretch, self.merging)[1], "<i4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "i4")
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return np.frombuffer(b"".join(map(self.stretches.__getitem__, STRETCH.findall(SPACE + text.replace(" ", SPACE)))), "<i4")
        return np.frombuffer(b"".join(map(self.words.__getitem__, text.split(" "))), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


@lru_cache(2)
def codec(path: str = MODEL) -> Codec:
    return Codec(path)


def lists(parts: list[np.ndarray | None]) -> pa.ListArray:
    """An Arrow list of int32 for each part."""
    ends = np.cumsum([0, *(0 if p is None else len(p) for p in parts)]).astype("i4")
    values = np.concatenate([p for p in parts if p is not None] or [np.zeros(0, "i4")])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()), mask=pa.array([p is None for p in parts], pa.bool_()))


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, ids, n_tokens, restored: whether decoding the ids gives the text back (not if it holds ▁, which decodes to a space)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            texts = b.column(1).to_pylist()
            ids = [None if t is None else c.encode(t) for t in texts]
            same = [None if t is None else c.decode(i) == t for t, i in zip(texts, ids)]
            counts = pa.array([None if i is None else len(i) for i in ids], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), lists(ids), counts, pa.array(same, pa.bool_())], ["doc_id", "ids", "n_tokens", "restored"])

    kind = dict(docs.dtypes)["doc_id"]
    return short_batches(docs.select("doc_id", "text")).mapInArrow(each, f"doc_id {kind}, ids array<int>, n_tokens int, restored boolean")


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, text of a table with doc_id, ids; null ids give null text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            texts = [None if i is None else c.decode(np.array(i, "i4")) for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = dict(encoded.dtypes)["doc_id"]
    return short_batches(encoded.select("doc_id", "ids")).mapInArrow(each, f"doc_id {kind}, text string")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))

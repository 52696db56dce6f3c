"""Token ids of whole texts by a byte-level vocabulary in rank form, with a bounded memory of words seen."""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import tiktoken

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary splits text before merging; a fixed value that belongs to the file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words that a worker remembers before it forgets all.
REMEMBERED = 400_000
#: White space but for the space and the newline.
OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


class Remembered(dict):
    """What `make` gives for a word; kept for short words, up to REMEMBERED."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        found = self.make(word)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


class Encoder:
    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
        self.size = max(ranks.values()) + 1
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.widths = np.zeros(self.size, "i8")
        for word, rank in ranks.items():
            self.widths[rank] = len(word)
        # a word after a space, or with the newline that it begins with
        self.memory = Remembered(lambda w: self.plain(w if w[:1] == "\n" else " " + w).tobytes())

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), "u4")

    def ids(self, text: str) -> np.ndarray:
        """Ids of the whole text as uint32, the same as encoding it at once.

        A space before a character that isn't white space begins a new piece of the pattern, and a newline
        between such characters is a piece of its own, so a text without other spaces is encoded word by word.
        """
        if not text:
            return np.zeros(0, "u4")
        if text[0] in " \n" or text[-1] in " \n" or any(two in text for two in ("  ", "\n\n", " \n", "\n ")) or any(c in text for c in OTHER_SPACES):
            return self.plain(text)
        first, *words = text.replace("\n", " \n").split(" ")
        return np.frombuffer(self.plain(first).tobytes() + b"".join(map(self.memory.__getitem__, words)), "u4")


@lru_cache(2)
def encoder(path: str = VOCABULARY) -> Encoder:
    return Encoder(path)

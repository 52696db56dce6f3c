"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is its words in lower case (runs of letters), read in overlapping windows of WINDOW words; the last window ends with the text. A word's input is a learned vector of the word and pooled (mean and maximum)
vectors of its character n-grams. A window's states are pooled by attention to one logit; a document's
logit is that of its highest window, so its score covers the whole text.

The words and n-grams with vectors are those of the sample whose log-odds between the classes are farthest
from 0; all others share a vector of zeros. A vector's first component is its log-odds, the others are learned.
The sample is split by hash into PARTS, and while the network learns, the log-odds in a document's input come
from the other parts, so that no document shows its own label. Which windows of a document stand for its
label is found in turns: the highest window of each, by the log-odds first and then by the network trained so
far; the highest windows of clean documents, and some more, are learned as clean. One part isn't learned from
but by its log-odds: on its documents the logits' scale and shift are fitted, which make them probabilities.

Cases: null text and text without words score 0; rows without a doc_id or label are never learned from;
without learned rows of both classes every score is 0; a document labelled more than once is learned as
often; repeated rows each get a row. Only doc_id, text and toxic are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, short_batches, table

WORD = re.compile(r"[^\W\d_]+")
WINDOW, STRIDE = 48, 32
#: Words and n-grams with vectors of their own, the vectors' widths, units of a direction and of the attention.
ROWS, WORD_DIM, GRAM_DIM, UNITS, ATTENTION = 1 << 15, 4, 4, 8, 8
GRAMS = (3, 4, 5)
THRESHOLD = 0.7
#: Documents, in the proportion of the classes, that log-odds count besides those seen.
SMOOTH = 4.0
#: Parts of the sample; a turn takes at least so many steps; documents that halve the rate of a rare feature.
PARTS, STEPS, RARE = 4, 24, 8
#: Words whose projected inputs a worker remembers before it forgets all.
REMEMBERED = 200_000


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code of each word, start of each word's n-grams, codes of the n-grams: their bytes)."""
    raw = [f"<{w}>".encode() for w in words]
    data = np.frombuffer(b"".join(raw), "u1").astype("u8")
    sizes = np.array([len(x) for x in raw])
    word = np.repeat(np.arange(len(raw)), sizes)
    starts = np.cumsum(sizes) - sizes
    power = np.full(sizes.max(), 1099511628211, "u8")
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    whole = np.add.reduceat((data + 1) * power[np.arange(len(data)) - starts[word]], starts)
    owners, grams, code = [], [], data
    for n in range(2, max(GRAMS) + 1):
        code = code[:-1] | data[n - 1 :] << np.uint64(8 * (n - 1))
        if n in GRAMS:
            inside = word[: len(code)] == word[n - 1 :]
            owners.append(word[: len(code)][inside])
            grams.append(code[inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return whole, np.searchsorted(owner[order], np.arange(len(words))), np.concatenate(grams)[order]


def window_starts(n: int) -> np.ndarray:
    """Where the windows of n words begin: all words are in one, the last ends with the text."""
    return np.append(np.arange(0, max(0, n - WINDOW), STRIDE), max(0, n - WINDOW)) if n else np.zeros(0, "i8")


def windows(ids: np.ndarray) -> np.ndarray:
    """(windows, WINDOW) of word numbers; -1 after the end of short texts."""
    at = window_starts(len(ids))[:, None] + np.arange(WINDOW)
    return np.where(at < len(ids), ids[np.minimum(at, max(0, len(ids) - 1))], -1) if len(ids) else np.zeros((0, WINDOW), "i8")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def gru(inputs: Callable[[int], np.ndarray], u: np.ndarray, mask: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States (time, windows, units) from the projected inputs of each time; trace keeps what gru_back() needs."""
    h = np.zeros((mask.shape[1], UNITS), "f4")
    out = np.empty(mask.shape[:2] + (UNITS,), "f4")
    partial = (mask == 0).any(axis=(1, 2))
    for t in range(len(out)):
        p, hu = inputs(t), h @ u
        gates = np.tanh(0.5 * (p[:, : 2 * UNITS] + hu[:, : 2 * UNITS]))
        gates *= 0.5
        gates += 0.5
        z, r = gates[:, :UNITS], gates[:, UNITS:]
        c = np.tanh(p[:, 2 * UNITS :] + r * hu[:, 2 * UNITS :])
        if trace is not None:
            trace.append((h, z, r, c, hu[:, 2 * UNITS :]))
        h = h + z * (c - h)
        if partial[t]:
            h *= mask[t]
        out[t] = h
    return out


def gru_back(d_out: np.ndarray, u: np.ndarray, mask: np.ndarray, trace: list) -> tuple[np.ndarray, np.ndarray]:
    """(gradient of the projected inputs, gradient of u)."""
    d_p = np.empty(d_out.shape[:2] + (3 * UNITS,), "f4")
    d_u, d_next = np.zeros_like(u), np.zeros(d_out.shape[1:], "f4")
    for t in range(len(d_out) - 1, -1, -1):
        h, z, r, c, hc = trace[t]
        d = (d_out[t] + d_next) * mask[t]
        d_c = d * z * (1 - c * c)
        d_z = d * (c - h) * z * (1 - z)
        d_r = d_c * hc * r * (1 - r)
        d_p[t] = np.concatenate([d_z, d_r, d_c], 1)
        d_h = np.concatenate([d_z, d_r, d_c * r], 1)
        d_u += h.T @ d_h
        d_next = d * (1 - z) + d_h @ u.T
    return d_p, d_u


class Network:
    """The parameters: vectors of words and n-grams, projections, recurrences, attention, output."""

    def __init__(self, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        width = WORD_DIM + 2 * GRAM_DIM
        small = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype("f4")
        self.codes = {"word": np.zeros(0, "u8"), "gram": np.zeros(0, "u8")}
        self.tables = {"word": np.zeros((1, WORD_DIM), "f4"), "gram": np.zeros((1, 2 * GRAM_DIM), "f4")}
        self.dense = {
            "w": small(width, 6 * UNITS), "b": np.zeros(6 * UNITS, "f4"), "u_fore": small(UNITS, 3 * UNITS), "u_back": small(UNITS, 3 * UNITS),
            "a": small(2 * UNITS, ATTENTION), "v": small(ATTENTION), "o": small(2 * UNITS), "bias": np.zeros(1, "f4"),
        }
        self.scale, self.shift = 1.0, 0.0

    def rows(self, name: str, codes: np.ndarray) -> np.ndarray:
        """The rows of codes in a table; 0 for those without their own."""
        known = self.codes[name]
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1) if len(known) else np.zeros(len(codes), "i8")
        return np.where(known[at] == codes, at + 1, 0) if len(known) else at

    def inputs(self, rows: np.ndarray, starts: np.ndarray, grams: np.ndarray, odds: dict | None = None) -> np.ndarray:
        """Input vectors of words, from the rows of their features; odds: other log-odds for these words and n-grams."""
        g, counts = self.tables["gram"][grams], np.diff(np.append(starts, len(grams)))[:, None]
        w = self.tables["word"][rows]
        if odds is not None:
            w[:, 0], g[:, 0], g[:, GRAM_DIM] = odds["word"], odds["gram"], odds["gram"]
        return np.hstack([w, np.add.reduceat(g[:, :GRAM_DIM], starts) / counts, np.maximum.reduceat(g[:, GRAM_DIM:], starts)])

    def logits(self, p: np.ndarray, index: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """A logit for each window; p: projected inputs of words, index: (windows, WINDOW) of its rows, -1 for none."""
        d, at = self.dense, index.T
        mask = (at >= 0).astype("f4")[:, :, None]
        fore, back = ([], []) if trace is not None else (None, None)
        ahead, behind = p[:, : 3 * UNITS], p[:, 3 * UNITS :]
        h1 = gru(lambda t: ahead[at[t]], d["u_fore"], mask, fore)
        h2 = gru(lambda t: behind[at[-1 - t]], d["u_back"], mask[::-1], back)[::-1]
        h = np.concatenate([h1, h2], 2)
        k = np.tanh(h @ d["a"])
        e = np.where(mask[:, :, 0] > 0, k @ d["v"], -1e9)
        e = np.exp(e - e.max(0))
        alpha = e / e.sum(0)
        pooled = np.einsum("tn,tnh->nh", alpha, h)
        if trace is not None:
            trace |= {"mask": mask, "fore": fore, "back": back, "h": h, "k": k, "alpha": alpha, "pooled": pooled}
        return pooled @ d["o"] + d["bias"]

    def gradients(self, d_logit: np.ndarray, trace: dict) -> tuple[dict, np.ndarray]:
        """(gradients of the dense parameters but w and b, gradient of the projected inputs (time, windows))."""
        d, h, k, alpha = self.dense, trace["h"], trace["k"], trace["alpha"]
        g = {"o": trace["pooled"].T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * d["o"]
        d_alpha = np.einsum("tnh,nh->tn", h, d_pooled)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(0))
        d_k = d_e[:, :, None] * d["v"] * (1 - k * k)
        g["v"] = np.einsum("tn,tna->a", d_e, k)
        g["a"] = np.einsum("tnh,tna->ha", h, d_k)
        d_h = alpha[:, :, None] * d_pooled + d_k @ d["a"].T
        d1, g["u_fore"] = gru_back(d_h[:, :, :UNITS], d["u_fore"], trace["mask"], trace["fore"])
        d2, g["u_back"] = gru_back(d_h[::-1, :, UNITS:], d["u_back"], trace["mask"][::-1], trace["back"])
        return g, np.concatenate([d1, d2[::-1]], 2)


class Trainer:
    """Fits a Network to labelled texts (a bounded sample, in memory), each in one of PARTS parts."""

    def __init__(self, texts: list[str], labels: list[int], parts: np.ndarray, seed: int = 5) -> None:
        self.net, self.rng = Network(seed), np.random.default_rng(seed)
        number: dict[str, int] = {}
        docs = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], "i8") for t in texts]
        held = [i for i, d in enumerate(docs) if len(d)]
        self.y, self.part = np.array([labels[i] for i in held], "f4"), np.asarray(parts)[held]
        names = list(number)
        some = [features(names[at : at + 20_000]) for at in range(0, len(names), 20_000)]
        before = np.cumsum([0, *(len(g) for _, _, g in some)])
        starts = np.concatenate([s + n for (_, s, _), n in zip(some, before)])
        codes, rows = {}, {}
        codes["word"], rows["word"] = np.unique(np.concatenate([w for w, _, _ in some]), return_inverse=True)
        codes["gram"], rows["gram"] = np.unique(np.concatenate([g for _, _, g in some]), return_inverse=True)
        del some
        self.starts, self.ends = starts, np.append(starts[1:], len(rows["gram"]))
        self.rows, self.grams = rows["word"], rows["gram"].astype("i4")
        self.log_odds([docs[i] for i in held], codes)
        # a kind is a word in a part: its log-odds are those of the other parts
        kinds, inverse = np.unique(np.concatenate([docs[i] * PARTS + p for i, p in zip(held, self.part)]), return_inverse=True)
        self.word, self.of_part = kinds // PARTS, kinds % PARTS
        ends = np.cumsum([len(docs[i]) for i in held])
        own = np.split(inverse, ends[:-1])
        self.index = np.vstack([windows(d).astype("i4") for d in own])
        self.owner = np.repeat(np.arange(len(own)), [len(window_starts(len(d))) for d in own])
        self.squares = {k: np.full(v.shape, 1e-6, "f4") for k, v in (self.net.tables | self.net.dense).items()}

    def grams_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, rows) of the n-grams of some words."""
        sizes = self.ends[words] - self.starts[words]
        starts = np.cumsum(sizes) - sizes
        return starts, self.grams[np.arange(sizes.sum()) - np.repeat(starts - self.starts[words], sizes)]

    def log_odds(self, docs: list[np.ndarray], codes: dict[str, np.ndarray]) -> None:
        """The rows with vectors, their log-odds from all parts and from all but each; rows and grams become rows of these."""
        counts = {name: np.zeros((PARTS, 2, len(c)), "f4") for name, c in codes.items()}
        for d, part, y in zip(docs, self.part, self.y.astype(int)):
            seen = np.unique(d)
            counts["word"][part, y, np.unique(self.rows[seen])] += 1
            counts["gram"][part, y, np.unique(self.grams_of(seen)[1])] += 1
        n = np.array([[((self.y == y) & (self.part == part)).sum() for y in (0, 1)] for part in range(PARTS)])

        def odds(seen: np.ndarray, of: np.ndarray) -> np.ndarray:
            share = np.log(seen / np.maximum(of, 1)[:, None] * of.sum() + SMOOTH)
            return (share[1] - share[0]) / 4

        self.odds, self.rates = {}, {}
        for name, seen in counts.items():
            every = odds(seen.sum(0), n.sum(0))
            kept = np.sort(np.argsort(-np.abs(every), kind="stable")[:ROWS])
            self.net.codes[name] = codes[name][kept]
            table = np.zeros((len(kept) + 1, self.net.tables[name].shape[1]), "f4")
            for j in (0,) if name == "word" else (0, GRAM_DIM):
                table[1:, j] = every[kept]
            self.net.tables[name] = table
            self.odds[name] = np.zeros((PARTS, len(kept) + 1), "f4")
            for part in range(PARTS):
                self.odds[name][part, 1:] = odds(seen.sum(0)[:, kept] - seen[part][:, kept], n.sum(0) - n[part])
            many = np.append(0, seen.sum((0, 1))[kept])
            self.rates[name] = (many / (many + RARE)).astype("f4")[:, None]
        self.rows = self.net.rows("word", codes["word"])[self.rows]
        self.grams = self.net.rows("gram", codes["gram"])[self.grams]

    def inputs_of(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(input vectors, starts of n-grams, rows of n-grams) of some kinds."""
        words, parts = self.word[kinds], self.of_part[kinds]
        starts, grams = self.grams_of(words)
        sizes = np.diff(np.append(starts, len(grams)))
        odds = {"word": self.odds["word"][parts, self.rows[words]], "gram": self.odds["gram"][np.repeat(parts, sizes), grams]}
        return self.net.inputs(self.rows[words], starts, grams, odds), starts, grams

    def all_inputs(self) -> np.ndarray:
        every = np.arange(len(self.word))
        return np.concatenate([self.inputs_of(every[at : at + 50_000])[0] for at in range(0, len(every), 50_000)])

    def highest(self, scores: np.ndarray) -> np.ndarray:
        """The window of each document with the highest score."""
        order = np.lexsort((np.arange(len(scores)), -scores, self.owner))
        return order[np.searchsorted(self.owner[order], np.arange(len(self.y)))]

    def scores(self) -> np.ndarray:
        p = self.all_inputs() @ self.net.dense["w"] + self.net.dense["b"]
        return np.concatenate([self.net.logits(p, self.index[at : at + 512]) for at in range(0, len(self.index), 512)])

    def step(self, batch: np.ndarray, rate: float) -> None:
        net, y = self.net, self.y[self.owner[batch]]
        used, at = np.unique(self.index[batch], return_inverse=True)
        at = at.reshape(len(batch), WINDOW) - (used[0] < 0)
        used = used[used >= 0]
        x, starts, grams = self.inputs_of(used)
        trace: dict = {}
        logit = net.logits(x @ net.dense["w"] + net.dense["b"], at, trace)
        g, d_p = net.gradients(((sigmoid(logit) - y) / len(batch)).astype("f4"), trace)
        flat, d_flat = at.T.ravel(), d_p.reshape(-1, 6 * UNITS)
        order = np.argsort(flat, kind="stable")
        order = order[np.searchsorted(flat[order], 0) :]
        d_words = np.add.reduceat(d_flat[order], np.searchsorted(flat[order], np.arange(len(used))))
        g["w"], g["b"] = x.T @ d_words, d_words.sum(0)
        d_x = d_words @ net.dense["w"].T
        owner = np.repeat(np.arange(len(used)), np.diff(np.append(starts, len(grams))))
        vectors = net.tables["gram"][grams]
        counts = np.bincount(owner)[:, None]
        d_mean = (d_x[:, WORD_DIM : WORD_DIM + GRAM_DIM] / counts)[owner]
        d_most = d_x[:, WORD_DIM + GRAM_DIM :][owner] * (vectors[:, GRAM_DIM:] == x[:, WORD_DIM + GRAM_DIM :][owner])
        for name, value in net.dense.items():
            self.squares[name] = self.squares[name] * 0.98 + 0.02 * g[name] ** 2
            value -= (0.1 * rate * g[name] / np.sqrt(self.squares[name])).astype("f4")
        for name, rows, d in (("word", self.rows[self.word[used]], d_x[:, :WORD_DIM]), ("gram", grams, np.hstack([d_mean, d_most]))):
            touched, to = np.unique(rows, return_inverse=True)
            d = np.stack([np.bincount(to, d[:, j], len(touched)) for j in range(d.shape[1])], 1)
            d[touched == 0] = 0
            d[:, [0] if name == "word" else [0, GRAM_DIM]] = 0
            self.squares[name][touched] += (d**2).astype("f4")
            net.tables[name][touched] -= self.rates[name][touched] * (0.02 * rate * d / np.sqrt(self.squares[name][touched])).astype("f4")

    def fit(self, turns: int = 4, epochs: int = 2, batch: int = 96) -> Network:
        x = self.all_inputs()
        of_word = np.maximum(x[:, 0], x[:, WORD_DIM + GRAM_DIM])
        scores = np.where(self.index >= 0, of_word[self.index], -99).max(1)
        # the last part is for calibration, if the others have both classes
        apart = self.part == PARTS - 1
        if len(set(self.y[~apart])) < 2 or len(set(self.y[apart])) < 2:
            apart = np.zeros(len(self.y), bool)
        n = int((~apart).sum())
        top = self.highest(scores)
        for turn in range(turns):
            clean = np.flatnonzero((self.y[self.owner] == 0) & ~apart[self.owner])
            hard = clean[np.argsort(-scores[clean], kind="stable")[: n // 2]]
            other = self.rng.choice(clean, min(len(clean), n // 2), replace=False) if len(clean) else clean
            picked = np.concatenate([top[~apart], hard, other])
            # both classes weigh about a third or more
            toxic = picked[self.y[self.owner[picked]] == 1]
            again = max(0, (len(picked) - len(toxic)) // (2 * max(1, len(toxic))) - 1)
            picked = np.concatenate([picked, *[toxic] * again])
            size = min(batch, max(32, len(picked) // 16))
            for _ in range(max(epochs, -(-STEPS * size // len(picked)))):
                self.rng.shuffle(picked)
                for at in range(0, len(picked), size):
                    self.step(picked[at : at + size], 0.1 if turn < turns - 1 else 0.03)
            scores = self.scores()
            top = self.highest(scores)
        some = apart if apart.any() else ~apart
        self.net.scale, self.net.shift = calibrated(scores[top][some], self.y[some])
        return self.net


def calibrated(z: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Scale and shift that make logits z probabilities of y: a logistic fit to targets that keep off 0 and 1 by the classes' sizes."""
    mean, spread = z.mean(), max(float(z.std()), 1e-6)
    x, w = np.stack([(z - mean) / spread, np.ones_like(z)], 1).astype("f8"), np.array([1.0, 0.0])
    n = np.array([(y == 0).sum(), (y == 1).sum()])
    target = np.where(y == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    for _ in range(rounds):
        # the logistic curve is never steeper than a quarter, so these steps can't overshoot
        w = w - np.linalg.solve(0.25 * x.T @ x + 1e-3 * np.eye(2), x.T @ (sigmoid(x @ w) - target))
    return max(float(w[0]), 0.05) / spread, float(w[1] - w[0] * mean / spread)


class Scorer:
    """Scores texts in a task; inputs of words seen before are remembered, already projected."""

    def __init__(self, net: Network) -> None:
        self.net, self.memory = net, {}
        self.projected = np.zeros((1024, 6 * UNITS), "f4")

    def ids(self, docs: list[list[str]]) -> list[np.ndarray]:
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        memory = self.memory
        new = list(dict.fromkeys(w for d in docs for w in d if w not in memory))
        for at in range(0, len(new), 50_000):
            some = new[at : at + 50_000]
            words, starts, grams = features(some)
            p = self.net.inputs(self.net.rows("word", words), starts, self.net.rows("gram", grams)) @ self.net.dense["w"] + self.net.dense["b"]
            first = len(memory)
            if first + len(some) > len(self.projected):
                self.projected = np.vstack([self.projected[:first], np.zeros((first + 2 * len(some), 6 * UNITS), "f4")])
            self.projected[first : first + len(some)] = p
            memory.update(zip(some, range(first, first + len(some))))
        return [np.fromiter((memory[w] for w in d), "i8", len(d)) for d in docs]

    def top_logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(logit of the highest window, NaN without words; number of windows; first word of that window) of each text."""
        docs = self.ids([words_of(t) for t in texts])
        counts = np.array([len(window_starts(len(d))) for d in docs], "i4")
        index = np.vstack([np.zeros((0, WINDOW), "i8"), *map(windows, docs)]).astype("i8")
        z = np.concatenate([np.zeros(0, "f4"), *(self.net.logits(self.projected, index[at : at + 512]) for at in range(0, len(index), 512))])
        logit, top = np.full(len(texts), np.nan), np.zeros(len(texts), "i4")
        ends = np.cumsum(counts)
        for i in np.flatnonzero(counts):
            own = z[ends[i] - counts[i] : ends[i]]
            best = int(own.argmax())
            logit[i], top[i] = own[best], window_starts(len(docs[i]))[best]
        return logit, counts, top

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, number of windows, first word of the highest window) of each text."""
        logit, counts, top = self.top_logits(texts)
        return np.where(counts > 0, sigmoid(self.net.scale * np.nan_to_num(logit) + self.net.shift), 0.0), counts, top


def fit(docs: DataFrame, labels: DataFrame, sample: int = 2000, chars: int = 40_000_000, longest: int = 400_000, seed: int = 3) -> Network | None:
    """A Network from about `sample` rows of each class of labels (doc_id, toxic), chosen by hash of their ids.

    The sample is what comes to the driver, so it is bounded: fewer are chosen if the texts of the chosen
    ids have over `chars` characters together, and none of over `longest`. The chosen ids are so few by
    this bound that they are broadcast to the texts of docs (doc_id, text).
    """
    rows = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", "toxic")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None

    def texts(share: float) -> DataFrame:
        rate = F.when(F.col("toxic") == 1, F.lit(share * min(1.0, sample / sizes[1]))).otherwise(F.lit(share * min(1.0, sample / sizes[0])))
        chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) <= rate * (1 << 30))
        return docs.where(F.length("text") <= longest).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    got = texts(1.0).agg(F.sum(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("n")).first()
    share = min(1.0, chars / max(1, got["chars"] or 0), 3 * sample / max(1, got["n"]))
    some = sorted((r["doc_id"], r["text"], r["toxic"]) for r in texts(share).collect())
    if len({y for _, t, y in some if words_of(t)}) < 2:
        return None
    parts = np.array([crc32(f"part {i}".encode()) % PARTS for i, _, _ in some])
    return Trainer([t for _, t, _ in some], [y for _, _, y in some], parts).fit()


def score(docs: DataFrame, net: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted, n_windows, top_window (index of its first word)."""
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(net)  # its size doesn't depend on the tables'
    ready: list[Scorer] = []

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value is not None and not ready:
            ready.append(Scorer(shared.value))
        for b in batches:
            n = b.num_rows
            s, count, top = ready[0].score(b.column(1).to_pylist()) if ready else (np.zeros(n), np.zeros(n, "i4"), np.zeros(n, "i4"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= threshold).astype("i4")), pa.array(count), pa.array(top)], ["doc_id", "score", "predicted", "n_windows", "top_window"])

    return short_batches(docs.select("doc_id", "text")).mapInArrow(each, f"doc_id {kind}, score double, predicted int, n_windows int, top_window int")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold("doc_id", 3) != 1)
    found = score(docs, fit(docs, labels))
    return found.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted", "n_windows", "top_window")

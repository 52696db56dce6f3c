"""Language identification: nearest of several centroids a language, over TF-IDF vectors of character n-grams.

Cases: null text, or text without a letter, is `und` with score 0 and rejected; a row without lang or
doc_id is never learned from; nothing to learn from makes every row `und`; equal cosines go to the first
language in alphabetical order; repeated rows each count and each get a row. Only doc_id, text and lang
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, short_batches, table

LETTER = regex.compile(r"\p{L}")
ORDERS = (2, 3, 4)
#: Thresholds are learned for texts that fill so many columns (a power of two), and lie on lines between.
LEVELS = np.arange(0, 16.5, 0.5)
#: A model's centroids of so many languages fit into every task; more are an error.
MOST_LANGS = 1000
#: ASCII bytes that aren't letters become spaces; bytes of other characters stay.
PLAIN = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def gram_counts(texts: list[str | None], dims: int, block: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
    """(index of the first text, counts): n-grams of bytes, hashed to dims columns, a row for each whole text."""
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    plain = [b" " + b" ".join((t or "").lower().encode("utf-8", "replace").translate(PLAIN).split()) + b" " for t in texts]
    at = 0
    while at < len(plain):
        to, size = at, 0
        while to < len(plain) and (to == at or size + len(plain[to]) <= block and to - at < 256):
            size += len(plain[to])
            to += 1
        data = np.frombuffer(b"".join(plain[at:to]), "u1").astype("u4")
        row = np.repeat(np.arange(to - at), [len(x) for x in plain[at:to]])
        counts = np.zeros((to - at) * dims, "f4")
        code = data
        for n in range(2, max(ORDERS) + 1):
            code = code[:-1] | data[n - 1 :] << np.uint32(8 * (n - 1))
            if n in ORDERS:
                inside = row[: len(code)] == row[n - 1 :]
                column = (code * np.uint32(2654435761) + np.uint32(n * 40503 * 65537 % 2**32)) * np.uint32(2246822519) >> shift
                counts += np.bincount((row[: len(code)] * dims + column)[inside], minlength=len(counts))
        yield at, counts.reshape(-1, dims)
        at = to


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def document_frequencies(docs: DataFrame, dims: int) -> DataFrame:
    """(bucket, n): documents of all of docs that hold an n-gram hashed to bucket; bucket -1 counts the documents."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims, "i8"), 0
        for b in batches:
            for _, counts in gram_counts(b.column(0).to_pylist(), dims):
                total += (counts > 0).sum(0)
                n += len(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, dims, dtype="i4")), pa.array(np.concatenate([[n], total]).astype("i8"))], ["bucket", "n"])

    return short_batches(docs.select("text")).mapInArrow(each, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k centroids of unit length: the farthest rows first, then means of the rows nearest by cosine."""
    centres = x[:1]
    while len(centres) < min(k, len(x)):
        centres = np.vstack([centres, x[(x @ centres.T).max(1).argmin()]])
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        means = np.array([x[own == i].mean(0) if (own == i).any() else c for i, c in enumerate(centres)])
        centres = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    return centres.astype("f4")


def typical_clusters(x: np.ndarray, k: int, share: float, tries: int = 20) -> np.ndarray:
    """Centroids of x, found again without the rows of clusters that hold `share` of all rows or less, so that odd rows get none."""
    inside = x
    for _ in range(tries):
        centres = cluster(inside, k)
        own = (inside @ centres.T).argmax(1)
        few = np.bincount(own, minlength=len(centres))[own] <= share * len(x)
        if few.all() or not few.any():
            break
        inside = inside[~few]
    return centres


def stretches(text: str) -> list[str]:
    """The text, and pieces of it of 4, 8, 16... characters from places spread over it."""
    sizes = [4 << i for i in range(len(text).bit_length()) if 4 << i < len(text)]
    return [text] + [text[at : at + n] for i, n in enumerate(sizes) for at in [(len(text) - n) * (7 * i % 11) // 11]]


def floors(grams: np.ndarray, cosines: np.ndarray, quantile: float, enough: float) -> np.ndarray:
    """The low quantile of in-language cosines at each of LEVELS, of texts within half an octave; by line where fewer than enough are there."""
    level = np.log2(np.maximum(grams, 1))
    near = [cosines[abs(level - x) <= 0.5] for x in LEVELS]
    known = [i for i, x in enumerate(near) if len(x) > enough] or [i for i, x in enumerate(near) if len(x)]
    return np.interp(LEVELS, LEVELS[known], [np.quantile(near[i], quantile) for i in known])


def fit(learn: DataFrame, dims: int = 4096, centroids: int = 4, sample_per_lang: int = 800, seed: int = 7, slack: float = 0.75, quantile: float = 0.02) -> dict:
    """The model, from the text and lang of learn.

    Document frequencies cover all of learn. The centroids are clustered from about sample_per_lang rows of
    each language, chosen by hash. A language's threshold depends on how many columns a text fills, as cosines
    grow with it: slack times the low quantile of the cosines of such texts, from its sample and pieces of it.
    """
    learn = learn.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    named = [(r["lang"], min(1.0, sample_per_lang / r["n"])) for r in sizes.limit(MOST_LANGS + 1).collect()]
    if len(named) > MOST_LANGS:
        raise ValueError(f"over {MOST_LANGS} languages: a model of so many wouldn't fit into every task")
    rates = learn.sparkSession.createDataFrame(named, "lang string, rate double")
    found = {r["bucket"]: r["n"] for r in document_frequencies(learn, dims).collect()}
    if not found.get(-1):
        return {"langs": [], "dims": dims}
    idf = np.log((1 + found[-1]) / (1 + np.array([found[i] for i in range(dims)]))).astype("f4") + 1
    rated = learn.select("lang", "doc_id", "text").join(F.broadcast(rates), "lang")
    chosen = rated.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) <= F.col("rate") * (1 << 30)).drop("rate")

    def each(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"])
        x = np.vstack([weighted(c, idf) for _, c in gram_counts(pdf["text"].tolist(), dims)])
        centres = typical_clusters(x, centroids, quantile)
        parts = [p for t in pdf["text"] for p in stretches(t) if LETTER.search(p)]
        found = [((c > 0).sum(1), (weighted(c, idf) @ centres.T).max(1)) for _, c in gram_counts(parts, dims)]
        least = slack * floors(np.concatenate([n for n, _ in found]), np.concatenate([c for _, c in found]), quantile, 0.05 * len(x))
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "centres": [centres.tobytes()], "least": [least.astype("f8").tobytes()]})

    fitted = chosen.groupBy("lang").applyInPandas(each, "lang string, centres binary, least binary").orderBy("lang").collect()
    centres = [np.frombuffer(r["centres"], "f4").reshape(-1, dims) for r in fitted]
    return {"langs": [r["lang"] for r in fitted], "dims": dims, "idf": idf, "centres": np.vstack(centres), "owner": np.repeat(np.arange(len(fitted)), [len(c) for c in centres]), "least": np.array([np.frombuffer(r["least"], "f8") for r in fitted])}


def predict(docs: DataFrame, model: dict, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, *extra, lang_pred, score (cosine of the nearest centroid), rejected (und, or farther than the language's threshold for such a text)."""
    langs = model["langs"]
    kinds = dict(docs.dtypes)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).to_pylist()
            lettered = np.array([bool(t and LETTER.search(t)) for t in texts], bool) & bool(langs)
            best, score, least = np.zeros(len(texts), "i8"), np.zeros(len(texts)), np.zeros(len(texts))
            for at, counts in gram_counts(texts, model["dims"]) if langs else ():
                cos = weighted(counts, model["idf"]) @ model["centres"].T
                near = cos.argmax(1)
                own, level = model["owner"][near], np.log2(np.maximum((counts > 0).sum(1), 1))
                best[at : at + len(near)], score[at : at + len(near)] = own, cos.max(1)
                least[at : at + len(near)] = [np.interp(x, LEVELS, model["least"][i]) for i, x in zip(own, level)]
            score = np.where(lettered, np.clip(score, 0, 1), 0.0)
            rejected = ~lettered | (score < least)
            names = [langs[i] if ok else "und" for i, ok in zip(best, lettered)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(names, pa.string()), pa.array(score), pa.array(rejected)], [*b.schema.names[1:], "lang_pred", "score", "rejected"])

    columns = ["doc_id", *extra]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    return short_batches(docs.select("text", *columns)).mapInArrow(each, f"{schema}, lang_pred string, score double, rejected boolean")


def learnable(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: crc32 of doc_id modulo 4 isn't 2."""
    return docs.select("doc_id", "text", "lang").where(fold("doc_id", 4) != 2)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict(docs, fit(learnable(docs)))
    return found.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def keep_known_languages(docs: DataFrame) -> DataFrame:
    """docs without the documents that the classifier rejects."""
    model = fit(learnable(docs))
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    tagged = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    found = predict(tagged, model, tuple(names.values()))
    return found.where("NOT rejected").select(*[F.col(n).alias(c) for c, n in names.items()])

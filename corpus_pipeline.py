"""A corpus pipeline: each stage takes all that its predecessor kept, and its decisions take effect.

A stage (spark, docs, sf_dir) returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.

Cases, in every stage: other columns are kept (but for tokenize, which returns its own), whatever their names and nulls; very long texts are read whole; an
empty table gives an empty one of the same columns. doc_id is a number, or a text of one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import shared_dir, table
from foliospark.llm.decontaminate import drop_contaminated
from foliospark.llm.language_id import keep_known_languages
from foliospark.llm.line_dedup import dedup_lines
from foliospark.llm.sentencepiece_codec import encode
from foliospark.llm.similar import drop_similar


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: those without a letter, null and empty texts among them, and those too far from all languages. Equal texts go or stay together; rows without an id as others."""
    return keep_known_languages(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; n_chars follows the text. No row goes: a text that loses all lines is empty, null stays null. Of equal runs the one of the smallest doc_id stays (null first), then of the text's hash; rows with the same id and text are one document."""
    out = dedup_lines(docs, deleted=None)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8 or more) stays: that with the smallest doc_id, then the smallest hash of its text, once if it is repeated. Null, empty and wordless texts are copies of each other. Rows without an id stay, as none can be named."""
    return drop_similar(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, all rows of such a text whatever their ids; null and empty texts stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of what is left, a row for each, repeated or not; null text has null ids, an empty one none."""
    return encode(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("tokenize", tokenize)]

#: Vectors, fingerprints and edit distances aren't in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Excerpts of front matter within a budget of characters, and the outline that a reply gives."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.scans import Rows, scan_groups
from foliospark.functions.textnorm import squeeze

TOC, INTRO, PREFACE = r"\b(contents|table of contents|indice|índice)\b", r"\b(introduction|introducci[oó]n)\b", r"\b(preface|foreword|prologue|pr[oó]logo|prefacio)\b"


def front_matter_input(docs: DataFrame, sections: DataFrame, headings: DataFrame, max_sections: int = 6, max_chars: int = 12_000, initial_chars: int = 4_000) -> DataFrame:
    """doc_id, strategy, has_toc, has_introduction, has_preface, excerpts (source_kind, label, text).

    Front-matter sections among the first 2 * max_sections, then sections around headings (of the first
    3 * max_sections) that name contents, introduction or preface, else the beginning of the text. The budget
    is used up in this order; excerpts are cut to it before they are gathered.
    """
    early = sections.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id").orderBy("start_char", "end_char"))).where(F.col("_n") <= 2 * max_sections)
    first = headings.withColumn("_h", F.row_number().over(Window.partitionBy("doc_id").orderBy("index"))).where((F.col("_h") <= 3 * max_sections) & F.lower("text").rlike(f"{TOC}|{INTRO}|{PREFACE}"))
    by_type = early.where("type = 'front_matter'").select("doc_id", F.lit(0).alias("kind"), F.col("_n").alias("n"), "label", "start_char", "end_char")
    inside = early.select("doc_id", F.col("start_char").alias("_a"), F.col("end_char").alias("_b"))
    by_heading = first.join(inside, "doc_id").where("start_char >= _a AND start_char < _b").select("doc_id", F.lit(1).alias("kind"), F.col("_h").alias("n"), F.col("text").alias("label"), F.col("_a").alias("start_char"), F.col("_b").alias("end_char"))
    start = docs.select("doc_id", F.lit(2).alias("kind"), F.lit(1).alias("n"), F.lit("initial_excerpt").alias("label"), F.lit(0).alias("start_char"), F.least(F.length("text"), F.lit(min(initial_chars, max_chars))).alias("end_char"))
    spans = by_type.unionByName(by_heading).unionByName(start)
    text = squeeze(F.substring(F.col("text"), F.col("start_char") + 1, F.col("end_char") - F.col("start_char")))
    ready = spans.join(docs.select("doc_id", "text"), "doc_id").withColumn("text", F.substring(text, 1, max_chars)).where("text <> ''")

    def scan(rows: Rows) -> Rows:
        left, used, out, kinds = max_chars, set(), [], []
        for r in sorted(rows, key=lambda r: (r["kind"], r["n"])):
            span = (r["start_char"], r["end_char"])
            if r["kind"] == 2 and out or span in used or len(out) >= max_sections:
                continue
            clipped = r["text"][:left].strip()
            if clipped:
                kinds.append(("document_map", "early_headings", "initial_excerpt")[r["kind"]])
                out.append({"source_kind": kinds[-1], "label": r["label"].strip() or "unknown", "text": clipped})
                used.add(span)
                left -= len(clipped)
        return [{"doc_id": rows[0]["doc_id"], "strategy": kinds[0] if len(set(kinds)) == 1 else "mixed", "excerpts": out}] if out else []

    kind = dict(docs.dtypes)["doc_id"]
    made = scan_groups(ready, ["doc_id"], scan, f"doc_id {kind}, strategy string, excerpts array<struct<source_kind:string,label:string,text:string>>")
    has = lambda p: F.exists("excerpts", lambda e: F.lower(e["label"]).rlike(p))
    return made.select("doc_id", "strategy", has(TOC).alias("has_toc"), has(INTRO).alias("has_introduction"), has(PREFACE).alias("has_preface"), "excerpts")

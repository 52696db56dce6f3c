"""Extractability of chunks: signals of text and section labels, the chunk's type, and the decision.

Chunks are rows with text and section_refs (array of struct with label and type). All is column
expressions on one row: no shuffle, no Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.textnorm import any_of, squeeze, strip

#: The types in order, and those without doctrine.
KINDS = ("doctrinal_text", "glossary", "bibliography", "exercises", "captions_tables_charts", "front_matter", "back_matter")
NON_DOCTRINAL = KINDS[1:]
WORD = r"[\p{L}\p{N}_]+"
OCR = r"[\^£®§¤¢¥©°¬¶]+"
REFS = "array<struct<label:string,type:string>>"
#: What speaks for each kind, in order. (text or labels, weight, words that one of is held), (find, weight, pattern in the text), (find_low, the same in small letters),
#: (share, most, signal, factor), (at_least or at_most, weight, signal, limit).
EVIDENCE = {
    "doctrinal_text": (("at_least", 0.35, "word_count", 100), ("at_most", 0.25, "line_short_ratio", 0.45), ("at_most", 0.15, "citation_locator_density", 0.06), ("at_most", 0.10, "section_ref_noise_ratio", 0.40), ("at_most", 0.15, "ocr_noise_ratio", 0.003)),
    "glossary": (("text", 0.40, ("glossary", "definitions", "terms")), ("share", 0.45, "glossary_line_density", 2.5), ("find", 0.20, r"(^|[^\p{L}\p{N}_])[A-Za-z][A-Za-z\s]{1,30}\s*:\s+.{8,}")),
    "bibliography": (("text", 0.45, ("bibliography", "sources", "references", "works cited", "index")), ("share", 0.35, "citation_locator_density", 4.0), ("share", 0.20, "footnote_density", 2.0), ("labels", 0.25, ("bibliography", "references", "sources"))),
    "exercises": (("text", 0.45, ("exercise", "step", "practice", "assignment")), ("share", 0.35, "list_line_density", 2.0), ("find_low", 0.20, r"(^|[^\p{L}\p{N}_])step\s+[\p{L}\p{N}_]+")),
    "captions_tables_charts": (("share", 0.35, "line_short_ratio", 0.8), ("share", 0.25, "symbol_ratio", 1.8), ("share", 0.20, "digit_ratio", 1.6), ("text", 0.30, ("chart", "figure", "table"))),
    "front_matter": (("text", 0.55, ("copyright", "isbn", "contents", "preface", "by ")), ("labels", 0.30, ("front_matter", "contents", "preface"))),
    "back_matter": (("text", 0.45, ("appendix", "glossary", "bibliography", "index", "sources")), ("labels", 0.35, ("bibliography", "index", "back_matter", "glossary"))),
}
#: What a text holds in which such a pattern is found; quick to look for.
HELD = {"find": r":\s+.{8,}", "find_low": "step"}
#: Defaults of the decision's limits.
HARD_OCR, HARD_FOOTNOTE, HARD_SHORT, REF_NOISE, CONFLICT = 0.008, 0.30, 0.75, 0.55, 0.72


def noisy_label(label: Column) -> Column:
    text = squeeze(label)
    index = text.rlike(r"^.+(?:\s|,)[0-9]+(?:[-–][0-9]+)?(?:\s*,\s*[0-9]+(?:[-–][0-9]+)?)*\.?$")
    return (text == "") | text.rlike(r"^[^\p{L}\p{N}]{1,6}$") | text.rlike(OCR) | F.lower(text).isin("unknown", "section") | index | ((F.length(text) <= 3) & ~text.rlike(r"\p{L}"))


def chunk_signals(chunks: DataFrame) -> DataFrame:
    """chunks with a struct column signals."""
    t = F.coalesce(F.col("text"), F.lit(""))
    refs = F.coalesce(F.col("section_refs").cast(REFS), F.array().cast(REFS))
    count = lambda p: F.regexp_count(t, F.lit(p))
    per = lambda a, b: a / F.greatest(F.lit(1), b)
    # of characters that are as frequent as letters the others are deleted in runs and lengths compared: a match each would be a string each
    without = lambda text, chars: F.regexp_replace(text, chars, "")
    chunks = chunks.withColumn("_plain", without(t, "[A-Za-z]+")).withColumn("_odd", without(F.col("_plain"), r"[\s\u0085   -     　\u001C-\u001F]+"))
    n, plain, odd = F.length(t), F.length("_plain"), F.length("_odd")
    letters, digits, spaces = n - plain, F.length(without(F.col("_odd"), r"\P{Nd}+")), plain - odd
    lines = F.filter(F.transform(F.split(t, "\n"), strip), lambda x: x != "")
    n_lines, n_refs, words = F.size(lines), F.size(refs), count(WORD)
    # the first characters come first, as they are cheaper to see than what may not stand before
    cites = r"(?=[A-Z0-9pvcs])(?:(?<![\p{L}\p{N}_])(?:p|pp|vol|ch|sec)\.?\s*[0-9]+|(?<![\p{L}\p{N}_])[0-9]{1,4}(?:[-–][0-9]{1,4})?(?![\p{L}\p{N}_])|[A-Z][a-z]+,\s*[0-9]{4})"
    return chunks.withColumn("signals", F.struct(
        n.alias("text_len"), words.alias("word_count"), n_lines.alias("line_count"),
        per(F.size(F.filter(lines, lambda x: F.length(x) <= 40)), n_lines).alias("line_short_ratio"), per(digits, n).alias("digit_ratio"),
        per(F.greatest(F.lit(0), n - letters - digits - spaces), n).alias("symbol_ratio"), per(letters, n).alias("letter_ratio"),
        per(count(r"(?m)^\s*[0-9]{1,3}[\)\.]?\s+[^\n]{3,180}$"), n_lines).alias("footnote_density"), per(count(cites), words).alias("citation_locator_density"), per(count(OCR), n).alias("ocr_noise_ratio"),
        per(F.size(F.filter(refs, lambda r: F.size(F.filter(F.split(squeeze(r["label"]), " "), lambda w: w != "")) <= 6)), n_refs).alias("heading_body_ratio"),
        per(F.size(F.filter(refs, lambda r: noisy_label(F.coalesce(r["label"], F.lit(""))))), n_refs).alias("section_ref_noise_ratio"),
        per(F.size(F.filter(refs, lambda r: r["type"] == "unknown")), n_refs).alias("unknown_ref_ratio"),
        per(count(r"(?m)^\s*[A-Za-z][^:\n]{1,40}:\s+.{8,}$"), n_lines).alias("glossary_line_density"), per(count(r"(?m)^\s*(?:[-*•]|[0-9]+[\)\.])\s+.{3,}$"), n_lines).alias("list_line_density"),
        (strip(t) == "").alias("is_blank"),
    )).drop("_plain", "_odd")


def type_scores(checked: DataFrame) -> DataFrame:
    """checked with a struct column scores, a number from 0 to 1 for each kind."""
    text = F.coalesce("text", F.lit(""))
    labels = F.array_join(F.transform(F.coalesce(F.col("section_refs").cast(REFS), F.array().cast(REFS)), lambda r: r["label"]), " ")
    s = F.col("signals")
    if_ = lambda when, x: F.when(when, F.lit(x)).otherwise(F.lit(0.0))
    says = {
        "text": lambda w, words: if_(any_of(F.lower(text), words), w), "labels": lambda w, words: if_(any_of(F.lower(labels), words), w),
        "find": lambda w, pattern: if_(text.rlike(HELD["find"]) & text.rlike(pattern), w), "find_low": lambda w, pattern: if_(F.contains(F.lower(text), F.lit(HELD["find_low"])) & F.lower(text).rlike(pattern), w),
        "share": lambda most, name, by: F.least(F.lit(most), s[name] * by), "at_least": lambda w, name, limit: if_(s[name] >= limit, w), "at_most": lambda w, name, limit: if_(s[name] <= limit, w),
    }
    made = {kind: reduce(lambda a, b: a + b, [says[how](*rest) for how, *rest in EVIDENCE[kind]]) for kind in KINDS}
    return checked.withColumn("scores", F.struct(*[F.least(F.lit(1.0), made[k]).alias(k) for k in KINDS]))


def classify_chunk_type(scored: DataFrame) -> DataFrame:
    """scored with chunk_type, type_score, mixed_reason, conflict_score, dominant_signals; equal scores keep the kinds' order."""
    ranked = F.array_sort(F.array(*[F.struct((-F.col(f"scores.{k}")).alias("neg"), F.lit(i).alias("ord"), F.lit(k).alias("kind")) for i, k in enumerate(KINDS)]))
    first, second = F.get(F.col("_r"), F.lit(0)), F.get(F.col("_r"), F.lit(1))
    a, b = -first["neg"], -second["neg"]
    doctrine = (first["kind"] == "doctrinal_text") != (second["kind"] == "doctrinal_text")
    mixed = (a >= 0.50) & (b >= 0.50) & (F.abs(a - b) <= 0.15) & doctrine
    text = lambda x, v: F.concat(x["kind"], F.lit(":"), F.format_string("%.2f", F.rint(v * 100) / 100))
    conflict = F.when(mixed, b).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), b / F.greatest(F.lit(0.01), a))))
    return scored.withColumn("_r", ranked).withColumns({
        "chunk_type": F.when(mixed, F.lit("mixed")).otherwise(first["kind"]), "type_score": a, "mixed_reason": F.when(mixed, F.concat_ws("+", first["kind"], second["kind"])), "conflict_score": conflict,
        "dominant_signals": F.when(mixed, F.array(first["kind"], second["kind"])).otherwise(F.array(text(first, a), text(second, b))),
    }).drop("_r")


def precheck(chunks: DataFrame) -> DataFrame:
    """chunks with signals, type, decision (skip, extract_degraded, extract), reason_codes and confidence_profile."""
    c = classify_chunk_type(type_scores(chunk_signals(chunks)))
    s, kind = F.col("signals"), F.col("chunk_type")
    plain = kind.isin(*NON_DOCTRINAL)
    reasons = F.array_compact(F.array(*[F.when(when, F.lit(name) if isinstance(name, str) else name) for when, name in (
        (s["is_blank"], "blank_text"), (s["word_count"] < 18, "very_short"), (s["ocr_noise_ratio"] >= 0.006, "high_ocr_noise"), (s["footnote_density"] >= 0.35, "footnote_dense"),
        (s["section_ref_noise_ratio"] >= 0.75, "section_refs_noisy"), (s["symbol_ratio"] >= 0.24, "high_symbol_ratio"), (plain, F.concat(F.lit("non_doctrinal_type:"), kind)),
        (kind == "mixed", "mixed_incompatible_types"), (F.col("conflict_score") >= 0.75, "high_type_conflict"),
    )]))
    hard = s["is_blank"] | (s["word_count"] < 10) | (s["ocr_noise_ratio"] >= HARD_OCR) | ((s["footnote_density"] >= HARD_FOOTNOTE) & (s["line_short_ratio"] >= HARD_SHORT))
    weak = plain | (kind == "mixed") | (F.col("conflict_score") >= CONFLICT) | (s["section_ref_noise_ratio"] >= REF_NOISE)
    profile = F.when(hard, "contaminated").when(weak, "low").when((F.col("type_score") >= 0.70) & (s["section_ref_noise_ratio"] <= 0.35), "high").when(F.col("type_score") >= 0.55, "medium").otherwise("low")
    return c.withColumns({"decision": F.when(hard, "skip").when(weak, "extract_degraded").otherwise("extract"), "reason_codes": reasons, "confidence_profile": profile})

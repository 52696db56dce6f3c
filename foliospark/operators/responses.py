"""Replies of a language model, parsed strictly; errors are data, never exceptions.

A reply is one string a row. Each parser is one Arrow pass over short strings, and gives the record, whether
it could be read, and why not.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A record's arrays of text, and its arrays of objects with their keys (text!, number, text, list).
VERSIONS = ("2.0.0", "1.0.0")
TEXTS = ("concepts", "definitions", "technical_rules", "procedures", "terminology", "relationships", "examples", "ambiguities")
OBJECTS = {
    "procedure_steps": {"id": "text", "order": "number", "text": "text!"},
    "decision_rules": {"condition": "text!", "outcome": "text!", "related_steps": "list"},
    "preconditions": {"text": "text!", "scope": "text", "related_steps": "list"},
    "exceptions": {"text": "text!", "scope": "text", "related_steps": "list"},
    "author_variants": {"author": "text!", "kind": "text!", "text": "text!", "related_steps": "list"},
    "procedure_outputs": {"text": "text!"},
}
REF = {"label": "text!", "type": "text!", "start_char": "number", "end_char": "number"}
KIND = {"text": "string", "text!": "string", "number": "int", "list": "array<string>"}
ARGUMENT_FIELDS = ("theses", "claims", "evidence", "methods", "authors_or_schools", "key_terms", "debates", "limitations")


def ddl(keys: dict[str, str]) -> str:
    return "array<struct<" + ",".join(f"{k}:{KIND[v]}" for k, v in keys.items()) + ">>"


class Wrong(ValueError):
    """A reply that breaks the schema."""


def need(ok: bool, what: str) -> None:
    if not ok:
        raise Wrong(what)


def balanced(text: str) -> str | None:
    """The first object in braces, strings respected."""
    start = text.find("{")
    depth, quoted, at = 0, False, start
    while 0 <= at < len(text):
        c = text[at]
        if quoted:
            at += c == "\\"
            quoted = c != '"'
        elif c == '"':
            quoted = True
        else:
            depth += (c == "{") - (c == "}")
            if not depth:
                return text[start : at + 1]
        at += 1
    return None


def bridged(field: str, item: dict) -> str | None:
    """An object where a text is due, as text: by the field's usual keys, else its texts in order of key."""
    v = {k: x.strip() for k, x in item.items() if isinstance(x, str)}
    if field == "definitions":
        return ": ".join(x for x in (v.get("term"), v.get("definition")) if x) or None
    if field == "examples":
        if v.get("case") and v.get("description"):
            return f"{v['case']}: {v['description']}"
        for k in ("example", "text", "scenario", "description", "case"):
            if v.get(k):
                return v[k]
    if field == "relationships":
        if "source" in v and "target" in v:
            arrow = f"{v['source']} -> {v['target']}"
            return f"{arrow} ({v['relation']})" if v.get("relation") else f"{arrow}: {v['description']}" if v.get("description") else arrow
        if v.get("description"):
            return v["description"]
    full = [(k, v[k]) for k in sorted(v) if v[k]]
    return full[0][1] if len(full) == 1 else "; ".join(f"{k}: {x}" for k, x in full) or None


def text_list(record: dict, field: str) -> list[str]:
    value = record.get(field, [])
    need(isinstance(value, list), f"{field} must be an array")
    out = []
    for i, x in enumerate(value):
        text = x.strip() if isinstance(x, str) else bridged(field, x) if isinstance(x, dict) else None
        need(text is not None, f"{field}[{i}] must be a string")
        if text:
            out.append(text)
    return out


def steps_list(value: object, where: str) -> list[str]:
    need(value is None or isinstance(value, list), f"{where}.related_steps must be an array")
    out = []
    for i, x in enumerate(value or []):
        text = x.strip() if isinstance(x, str) else str(int(x)) if isinstance(x, float) and x.is_integer() else str(x) if isinstance(x, (int, float)) else ""
        need(bool(text), f"{where}.related_steps[{i}] must be a string")
        out.append(text)
    return out


def object_list(record: dict, field: str, keys: dict[str, str], exact: bool = False) -> list[dict]:
    value = record.get(field, [])
    need(isinstance(value, list), f"{field} must be an array")
    out = []
    for i, x in enumerate(value):
        where = f"{field}[{i}]"
        need(isinstance(x, dict), f"{where} must be an object")
        need(not exact or x.keys() == keys.keys(), f"{where} invalid keys")
        made: dict = {}
        for k, kind in keys.items():
            got = x.get(k)
            if kind == "list":
                made[k] = steps_list(got, where)
            elif kind == "number":
                need(isinstance(got, int), f"{where}.{k} must be int")
                made[k] = int(got)
            else:
                need(isinstance(got, str) or (kind == "text" and got is None), f"{where}.{k} must be a string")
                made[k] = (got or "").strip()
        out.append(made)
    return out


def chunk_knowledge(reply: str | None) -> dict:
    try:
        record = json.loads(reply or "")
    except ValueError as e:
        raise Wrong(f"invalid JSON: {e}") from None
    need(isinstance(record, dict), "payload must be an object")
    extra = sorted(record.keys() - {"schema_version", "chunk_id", "source_fingerprint", "section_refs", *TEXTS, *OBJECTS})
    need(not extra, f"unexpected keys: {extra}")
    need(record.get("schema_version") in VERSIONS, "schema_version is unknown")
    for k in ("chunk_id", "source_fingerprint"):
        need(isinstance(record.get(k), str), f"{k} must be a string")
    head = {k: record[k].strip() for k in ("chunk_id", "source_fingerprint")}
    return head | {"section_refs": object_list(record, "section_refs", REF, True)} | {f: text_list(record, f) for f in TEXTS} | {f: object_list(record, f, k) for f, k in OBJECTS.items()}


def argument_chunk(reply: str | None) -> dict:
    need(bool((reply or "").strip()), "llm_empty")
    found = balanced(re.sub(r"^```\w*\s*|\s*```$", "", reply.strip()))
    try:
        record = json.loads(found or "")
    except ValueError:
        raise Wrong("parse_fallback") from None
    ok = isinstance(record, dict) and not record.keys() - {"schema_version", "chunk_id", "source_fingerprint", "section_refs", *ARGUMENT_FIELDS}
    values = [record.get(f, []) for f in ARGUMENT_FIELDS] if ok else []
    need(ok and all(isinstance(v, list) and all(isinstance(x, str) for x in v) for v in values), "invalid_payload")
    return {f: [t for x in record.get(f, []) if (t := " ".join(x.split()))] for f in ARGUMENT_FIELDS}


def family_discovery(reply: str | None) -> dict:
    raw = re.sub(r'"(?:[^"\\]|\\.)*"', lambda m: re.sub(r"[\x00-\x1f]", lambda c: f"\\u{ord(c[0]):04x}", m[0]), reply or "", flags=re.S)
    try:
        record = json.loads(balanced(raw) or "")
    except ValueError as e:
        raise Wrong(f"invalid JSON: {e}") from None
    families = record.get("families") if isinstance(record, dict) else None
    need(isinstance(families, list), "families must be an array")
    out = []
    for i, x in enumerate(families):
        need(isinstance(x, dict) and isinstance(x.get("family_label"), str) and isinstance(x.get("members"), list), f"families[{i}] is incomplete")
        out.append({"family_label": x["family_label"].strip(), "members": [m.strip() for m in x["members"] if isinstance(m, str) and m.strip()], "rationale": str(x.get("rationale") or "").strip()})
    return {"families": out}


def parsed(replies: DataFrame, parse: Callable[[str | None], dict], empty: dict, schema: str, key: str, column: str) -> DataFrame:
    kind = StructType.fromDDL(f"{key} {dict(replies.dtypes)[key]}, {schema}, ok boolean, error string")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(kind)
        for b in batches:
            rows = []
            for reply in b.column(1).to_pylist():
                try:
                    rows.append(empty | parse(reply) | {"ok": True, "error": None})
                except Wrong as e:
                    rows.append(empty | {"ok": False, "error": str(e)})
            made = {f.name: b.column(0) if f.name == key else pa.array([r[f.name] for r in rows], f.type) for f in target}
            yield pa.RecordBatch.from_pydict(made, target)

    return replies.select(F.col(key), F.col(column)).mapInArrow(each, kind)


def parse_chunk_knowledge(replies: DataFrame, key: str = "chunk_id_in", column: str = "response") -> DataFrame:
    """key, the record's columns (empty if it can't be read), ok, error."""
    empty = {"chunk_id": None, "source_fingerprint": None, "section_refs": []} | {f: [] for f in (*TEXTS, *OBJECTS)}
    schema = f"chunk_id string, source_fingerprint string, section_refs {ddl(REF)}, " + ", ".join(f"{f} array<string>" for f in TEXTS) + ", " + ", ".join(f"{f} {ddl(k)}" for f, k in OBJECTS.items())
    return parsed(replies, chunk_knowledge, empty, schema, key, column)


def parse_argument_chunks(replies: DataFrame, key: str = "chunk_id_in", column: str = "response") -> DataFrame:
    """key, the eight arrays, ok, and error: llm_empty, parse_fallback or invalid_payload."""
    return parsed(replies, argument_chunk, {f: [] for f in ARGUMENT_FIELDS}, ", ".join(f"{f} array<string>" for f in ARGUMENT_FIELDS), key, column)


def parse_family_discovery(replies: DataFrame, key: str = "doc_id", column: str = "response") -> DataFrame:
    """key, families (family_label, members, rationale), ok, error."""
    return parsed(replies, family_discovery, {"families": []}, "families array<struct<family_label:string,members:array<string>,rationale:string>>", key, column)


def build_prompts(chunks: DataFrame, template: str, name: str = "prompt") -> DataFrame:
    """chunks with a prompt: each {{column}} of the template as the row's value, arrays and structs as JSON."""
    kinds = dict(chunks.dtypes)
    parts = []
    for i, piece in enumerate(re.split(r"\{\{(\w+)\}\}", template)):
        if not i % 2:
            parts.append(F.lit(piece))
        else:
            parts.append(F.coalesce(F.to_json(piece) if kinds[piece].startswith(("array", "struct", "map")) else F.col(piece).cast("string"), F.lit("")))
    return chunks.withColumn(name, F.concat(*parts))


#: The lists of a front-matter outline and their keys.
OUTLINE = {
    "family_candidates": {"name": "text!", "aliases": "list", "evidence": "list", "confidence": "share", "status": ("candidate", "accepted", "rejected")},
    "core_concepts_expected": {"name": "text!", "evidence": "list", "priority": ("medium", "high", "low")},
    "provisional_taxonomy": {"parent": "text!", "child": "text!", "relation_type": "text!", "confidence": "share"},
    "normalization_hints": {"canonical": "text!", "variants": "list"},
}
OUTLINE_VERSION = "1.0.0"


def outline(reply: str | None) -> dict:
    need(bool((reply or "").strip()), "Empty LLM output")
    try:
        record = json.loads(balanced(reply) or "")
    except ValueError as e:
        raise Wrong(f"invalid JSON: {e}") from None
    need(isinstance(record, dict), "Root JSON value must be an object")
    extra = sorted(record.keys() - {"schema_version", "book_title", "source", "confidence_notes", *OUTLINE})
    need(not extra, f"unexpected keys: {extra}")
    need(record.get("schema_version", OUTLINE_VERSION) == OUTLINE_VERSION, "schema_version is unknown")
    made: dict = {"confidence_notes": text_list(record, "confidence_notes")}
    for field, keys in OUTLINE.items():
        rows = record.get(field, [])
        need(isinstance(rows, list) and all(isinstance(x, dict) for x in rows), f"{field} must be an array of objects")
        made[field] = []
        for i, x in enumerate(rows):
            row: dict = {}
            for k, kind in keys.items():
                v = x.get(k)
                if kind == "list":
                    row[k] = text_list(x, k)
                elif kind == "share":
                    row[k] = min(1.0, max(0.0, float(v))) if isinstance(v, (int, float)) and not isinstance(v, bool) else 0.0
                elif isinstance(kind, tuple):
                    row[k] = v if v in kind else kind[0]
                else:
                    need(isinstance(v, str) and bool(v.strip()), f"{field}[{i}].{k} must be a string")
                    row[k] = v.strip()
            made[field].append(row)
    return made


def parse_front_matter(replies: DataFrame, key: str = "doc_id", column: str = "response") -> DataFrame:
    """key, the outline's lists, confidence_notes (with the error, if it can't be read), ok, error."""
    kinds = {"text!": "string", "list": "array<string>", "share": "double"}
    lists = ", ".join(f"{f} array<struct<{','.join(f'{k}:{kinds.get(v, 'string') if isinstance(v, str) else 'string'}' for k, v in keys.items())}>>" for f, keys in OUTLINE.items())
    found = parsed(replies, outline, {f: [] for f in OUTLINE} | {"confidence_notes": []}, f"{lists}, confidence_notes array<string>", key, column)
    note = F.array(F.concat(F.lit("parse_fallback: "), F.col("error")))
    return found.withColumn("confidence_notes", F.when(F.col("ok"), F.col("confidence_notes")).otherwise(note))

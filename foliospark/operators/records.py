"""Knowledge records of chunks: normalisation, rules derived from text, filtering, clamping and decisions.

A record is a row with eight arrays of text and six of structs. All rules are column expressions on one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.textnorm import let, squeeze

TEXTS = ("concepts", "definitions", "technical_rules", "procedures", "terminology", "relationships", "examples", "ambiguities")
STRUCTS = {
    "procedure_steps": "array<struct<id:string,order:int,text:string>>",
    "decision_rules": "array<struct<condition:string,outcome:string,related_steps:array<string>>>",
    "preconditions": "array<struct<text:string,scope:string,related_steps:array<string>>>",
    "exceptions": "array<struct<text:string,scope:string,related_steps:array<string>>>",
    "author_variants": "array<struct<author:string,kind:string,text:string,related_steps:array<string>>>",
    "procedure_outputs": "array<struct<text:string>>",
}
class Vocabulary(NamedTuple):
    """The words and patterns of a domain's records, as a rule table; patterns are regular expressions."""

    #: Items of a book's own matters, of modern writers, and of the tradition; what makes a definition operational.
    editorial: str
    modern: str
    traditional: str
    operational: str
    operational_definition: str
    #: Phrases of definitions that tell little.
    generic: Sequence[str]
    #: A text reads as a procedure by its beginning or a phrase; its head is taken off, it is split, and parts that begin with an action are steps.
    linear_lead: str
    linear_phrases: str
    linear_heads: Sequence[str]
    linear_split: str
    actions: str


#: The vocabulary that applies where none is given.
VOCABULARY = Vocabulary(
    editorial=r"(?i)\b(copyright|all rights reserved|permission|reproduc|license|isbn|publisher|quoted|citation style)\b",
    modern=r"(?i)\b(modern|contemporary|psycholog|reinterpret|today|current|twentieth century|siglo xx|moderno|moderna)\b",
    traditional=r"(?i)\b(house|houses|planet|ascendant|midheaven|dignity|sect|triplicity|horoskopos|domicile|angular|cadent|succedent|casa|casas|ascendente|mediocielo|secta)\b",
    operational=r"(?i)\b(if|when|si|cuando|then|therefore|indicates|indica|applies|aplica|depends|depende|strength|fuerza|weak|debil|manifest|manifiesta|effect|efecto)\b",
    operational_definition=r"(?i)\b(if|when|si|cuando|then|indicates|indica|applies|aplica|depends|depende|strength|fuerza|weak|debil|manifest|manifiesta|effect|efecto)\b",
    generic=("is a", "is an", "means", "refers to", "es un", "es una", "significa"),
    linear_lead=r"(?i)^(?:to use|to calculate|to determine|to assign|profections?\s*:|assigning\s+the|using\s+the)\s+",
    linear_phrases="identify the time lord|interpret the matters|activate each zodiac|profected sign",
    linear_heads=(r"(?i)^(?:to use|to calculate|to determine|to assign)\s+[^:]+:\s*", r"(?i)^(?:profections?|progressions?|primary directions?)\s*:\s*"),
    linear_split=r"(?i);|\.\s+|,\s+(?=(?:and\s+)?(?:identify|determine|interpret|activate|assign|emphasize|advance|move|evaluate|apply)\b)",
    actions=r"(?i)^(activate|identify|determine|interpret|assign|emphasize|move|advance|evaluate|apply) ",
)
#: The form of a decision in a text, and words of doubt.
RULE = r"(?i)^(?:if|si)\s+(.+?)(?:,\s*)?(?:then|entonces)\s+(.+)$"
AMBIGUITY = "debate|dispute|uncertain|ambigu|variant|however|conflict|some authors|others"


def texts(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def structs(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast(STRUCTS[name])).cast(STRUCTS[name])


def first_by(items: Column, key: Callable[[Column], Column]) -> Column:
    """The items whose key wasn't seen before; items and keys are made once."""
    first = lambda xs, keys: F.filter(xs, lambda x, i: F.array_position(keys, F.get(keys, i)) == i + 1)
    return let(items, lambda xs: let(F.transform(xs, key), lambda keys: first(xs, keys)))


def dedupe_conservative(items: Column) -> Column:
    """Squeezed texts, the same but for case once, none empty."""
    return first_by(F.filter(F.transform(items, squeeze), lambda x: x != ""), F.lower)


def step_text(text: Column) -> Column:
    """Without a number or `step n` before it, and without stops around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(squeeze(text), r"(?i)^(?:step|paso)\s*[0-9]+[:.)-]?\s*", ""), r"^[0-9]+[:.)-]?\s*", ""), F.lit(" .;:"))


def step_id(order: Column, text: Column) -> Column:
    slug = F.substring(F.trim(F.regexp_replace(F.lower(step_text(text)), "[^a-z0-9]+", "-"), F.lit("-")), 1, 48)
    return F.concat(F.lit("step-"), F.format_string("%03d", order), F.lit("-"), let(slug, lambda s: F.when(s == "", "step").otherwise(s)))


def rule_of(item: Column) -> Column:
    """struct(condition, outcome, related_steps) of a text `if …, then …`, or `if …, …`; null for others.

    From the second form leading characters of `then ` and `entonces ` are taken off one by one.
    """
    return let(squeeze(item), rule_of_squeezed)


def rule_of_squeezed(t: Column) -> Column:
    none = F.array().cast("array<string>")
    full = F.regexp_extract(t, RULE, 2) != ""
    after = F.trim(F.ltrim(F.ltrim(F.trim(F.regexp_extract(t, r"^[^,]*,(.*)$", 1)), F.lit("then ")), F.lit("entonces ")))
    made = lambda c, o: F.struct(squeeze(c).alias("condition"), F.rtrim(squeeze(o), F.lit(".")).alias("outcome"), none.alias("related_steps"))
    before = F.regexp_replace(F.substring_index(t, ",", 1), r"(?i)^(if|si)\s+", "")
    return F.when(full, made(F.regexp_extract(t, RULE, 1), F.regexp_extract(t, RULE, 2))).when(t.rlike("(?i)^(if|si) ") & F.contains(t, F.lit(",")) & (after != ""), made(before, after))


def derive_decision_rules(records: DataFrame) -> DataFrame:
    """Technical rules of the form of a decision move to decision_rules."""
    derived = F.array_compact(F.transform("_rules", rule_of))
    both = F.filter(F.concat(structs("decision_rules"), "_new"), lambda r: (squeeze(r["condition"]) != "") & (squeeze(r["outcome"]) != ""))
    clean = F.transform(both, lambda r: F.struct(squeeze(r["condition"]).alias("condition"), squeeze(r["outcome"]).alias("outcome"), F.array_distinct(F.filter(F.coalesce(r["related_steps"], F.array().cast("array<string>")), lambda s: s != "")).alias("related_steps")))
    once = first_by(clean, lambda r: F.struct(F.lower(r["condition"]), F.lower(r["outcome"]), r["related_steps"]))
    out = records.withColumn("_rules", dedupe_conservative(texts("technical_rules"))).withColumn("_new", derived)
    return out.withColumns({"decision_rules": once, "technical_rules": F.filter("_rules", lambda t: rule_of(t).isNull())}).drop("_rules", "_new")


def promote_linear_steps(records: DataFrame, words: Vocabulary = VOCABULARY) -> DataFrame:
    """Where there are no steps, texts that read as a procedure give theirs: two actions or more in a text."""
    head = lambda t: reduce(lambda x, pattern: F.regexp_replace(x, pattern, ""), words.linear_heads, F.rtrim(squeeze(t), F.lit(".")))
    parts = lambda t: F.filter(F.transform(F.split(head(t), words.linear_split), lambda p: F.regexp_replace(step_text(p), r"(?i)^and\s+", "")), lambda p: p.rlike(words.actions))
    linear = lambda t: let(squeeze(t), lambda s: s.rlike(words.linear_lead) | F.lower(s).rlike(words.linear_phrases))
    found = F.flatten(F.filter(F.transform(F.filter(F.concat(texts("procedures"), texts("technical_rules")), linear), parts), lambda p: F.size(p) > 1))
    steps = F.transform(found, lambda t, i: F.struct(step_id(i + 1, t).alias("id"), (i + 1).alias("order"), t.alias("text")))
    return records.withColumn("procedure_steps", F.when(F.size(structs("procedure_steps")) == 0, steps).otherwise(structs("procedure_steps")))


def dedupe_struct_fields(records: DataFrame, authors: dict[str, str] | None = None) -> DataFrame:
    """The six arrays of structs, squeezed, complete, each item once; steps by order. authors: small letters → name."""
    known = F.create_map(*[F.lit(x) for pair in authors.items() for x in pair]) if authors else None
    none = F.array().cast("array<string>")
    related = lambda r: F.array_distinct(F.filter(F.coalesce(r["related_steps"], none), lambda s: s != "")).alias("related_steps")

    def author(a: Column) -> Column:
        name = F.trim(squeeze(a), F.lit(" .;:"))
        plain = F.when(F.lower(name) == name, F.initcap(name)).otherwise(name)
        return F.coalesce(known[F.lower(name)], plain) if known is not None else plain

    steps = F.filter(F.transform(structs("procedure_steps"), lambda s: F.struct(s["order"].alias("order"), F.coalesce(s["id"], F.lit("")).alias("id"), step_text(s["text"]).alias("text"))), lambda s: s["text"] != "")
    steps = first_by(F.array_sort(steps), lambda s: F.struct(s["order"], F.lower(s["text"])))
    conditions = lambda name: first_by(F.filter(F.transform(structs(name), lambda r: F.struct(squeeze(r["text"]).alias("text"), squeeze(F.coalesce(r["scope"], F.lit(""))).alias("scope"), related(r))), lambda r: r["text"] != ""), lambda r: F.struct(F.lower(r["text"]), F.lower(r["scope"]), r["related_steps"]))
    variants = F.filter(F.transform(structs("author_variants"), lambda r: F.struct(author(r["author"]).alias("author"), F.lower(squeeze(r["kind"])).alias("kind"), squeeze(r["text"]).alias("text"), related(r))), lambda r: (r["author"] != "") & (r["kind"] != "") & (r["text"] != ""))
    outputs = F.filter(F.transform(structs("procedure_outputs"), lambda r: F.struct(squeeze(r["text"]).alias("text"))), lambda r: r["text"] != "")
    return records.withColumns({
        "procedure_steps": F.transform(steps, lambda s: F.struct(F.when(F.trim(s["id"]) == "", step_id(s["order"], s["text"])).otherwise(F.trim(s["id"])).alias("id"), s["order"].alias("order"), s["text"].alias("text"))),
        "preconditions": conditions("preconditions"), "exceptions": conditions("exceptions"),
        "author_variants": first_by(variants, lambda r: F.struct(F.lower(r["author"]), r["kind"], F.lower(r["text"]), r["related_steps"])), "procedure_outputs": first_by(outputs, lambda r: F.lower(r["text"])),
    })


def derive_procedures(records: DataFrame) -> DataFrame:
    """procedures written from the structures; texts given there before are replaced."""
    scope = lambda r: F.when(F.coalesce(r["scope"], F.lit("")) == "", "").otherwise(F.concat(F.lit(" ("), r["scope"], F.lit(")")))
    lines = F.concat(
        F.transform(F.array_sort(F.transform(structs("procedure_steps"), lambda s: F.struct(s["order"].alias("order"), s["id"].alias("id"), s["text"].alias("text")))), lambda s: F.concat(s["order"].cast("string"), F.lit(". "), s["text"])),
        F.transform(structs("decision_rules"), lambda r: F.concat(F.lit("If "), r["condition"], F.lit(", then "), r["outcome"], F.lit("."))),
        F.transform(structs("preconditions"), lambda r: F.concat(F.lit("Precondition"), scope(r), F.lit(": "), r["text"])), F.transform(structs("exceptions"), lambda r: F.concat(F.lit("Exception"), scope(r), F.lit(": "), r["text"])),
        F.transform(structs("author_variants"), lambda r: F.concat(r["author"], F.lit(" ["), r["kind"], F.lit("]: "), r["text"])), F.transform(structs("procedure_outputs"), lambda r: F.concat(F.lit("Output: "), r["text"])),
    )
    return records.withColumn("procedures", dedupe_conservative(lines))


def normalize_records(records: DataFrame, authors: dict[str, str] | None = None, words: Vocabulary = VOCABULARY) -> DataFrame:
    """All of the above, in order."""
    clean = records.withColumns({c: dedupe_conservative(texts(c)) for c in ("terminology", "concepts")})
    return derive_procedures(dedupe_struct_fields(promote_linear_steps(derive_decision_rules(clean), words), authors))


def is_generic_definition(text: Column, words: Vocabulary = VOCABULARY) -> Column:
    t = squeeze(text)
    count = lambda x: F.size(F.filter(F.split(x, " "), lambda w: w != ""))
    means = F.exists(F.array(*map(F.lit, words.generic)), lambda g: F.contains(F.lower(t), g))
    short = F.contains(t, F.lit(":")) & (count(F.trim(F.regexp_extract(t, r"^[^:]*:(.*)$", 1))) <= 5)
    return (t == "") | (~t.rlike(words.operational) & ((count(t) <= 5) | short | means))


def semantic_filter(records: DataFrame, editorial: bool = True, generic: bool = True, modern: bool = True, words: Vocabulary = VOCABULARY) -> DataFrame:
    """records without editorial items, generic definitions and modern items, with actions; modern items go to ambiguities, and stay too if traditional."""
    out, actions = records, []
    if editorial:
        for c in ("technical_rules", "procedures"):
            actions.append(F.when(F.exists(texts(c), lambda t: t.rlike(words.editorial)), f"clear_editorial_{c}"))
            out = out.withColumn(f"_{c}", F.filter(texts(c), lambda t: ~t.rlike(words.editorial)))
    if generic:
        actions.append(F.when(F.exists(texts("definitions"), lambda t: is_generic_definition(t, words)), "drop_generic_definitions"))
        out = out.withColumn("_definitions", F.filter(texts("definitions"), lambda t: ~is_generic_definition(t, words)))
    marked = out.withColumn("actions", F.array_compact(F.array(*actions)) if actions else F.array().cast("array<string>"))
    for c in ("technical_rules", "procedures", "definitions"):
        if f"_{c}" in marked.columns:
            marked = marked.withColumn(c, F.col(f"_{c}")).drop(f"_{c}")
    moved = F.array().cast("array<string>")
    if modern:
        fields = ("concepts", "definitions", "technical_rules", "procedures", "relationships")
        is_modern, both = (lambda t: t.rlike(words.modern)), (lambda t: t.rlike(words.modern) & t.rlike(words.traditional))
        moved = F.flatten(F.array(*[F.filter(texts(c), is_modern) for c in fields]))
        more = F.flatten(F.array(*[F.transform(F.filter(texts(c), is_modern), both_or(c, both)) for c in fields]))
        tail = F.when(F.size(moved) > 0, F.array(F.lit("relocate_modern_to_ambiguities"))).otherwise(F.array().cast("array<string>"))
        marked = marked.withColumns({"_moved": moved, "actions": F.array_distinct(F.concat("actions", more, tail))}).withColumns({c: F.filter(texts(c), lambda t: ~is_modern(t) | both(t)) for c in fields})
        moved = F.col("_moved")
    return marked.withColumn("ambiguities", dedupe_conservative(F.concat(texts("ambiguities"), moved))).drop("_moved")


def both_or(field: str, both: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda t: F.when(both(t), "mark_modern_embedded_preserved_core").otherwise(f"relocate_modern_{field}")


def is_operational_definition(text: Column, words: Vocabulary = VOCABULARY) -> Column:
    return squeeze(text).rlike(words.operational_definition)


def support_signals(records: DataFrame, min_definitions: int = 2, near_empty: int = 2, dominant_terms: int = 6, dominant_ratio: float = 2.0, words: Vocabulary = VOCABULARY) -> DataFrame:
    """records with counts and flags: support (strong, minimal, none), near_empty, terminology_dominant."""
    n = {c: F.size(texts(c)) for c in TEXTS}
    operations = (n["technical_rules"] + n["procedures"] + F.size(structs("procedure_steps")) + F.size(structs("decision_rules"))) > 0
    definitions = F.size(F.filter(texts("definitions"), lambda t: is_operational_definition(t, words)))
    items = sum(n.values(), F.lit(0)) + sum((F.size(structs(c)) for c in STRUCTS), F.lit(0))
    small = (items == 0) | ((items <= near_empty) & ~operations & (definitions == 0) & (n["concepts"] <= 1) & (n["terminology"] <= 1))
    dominant = (n["terminology"] >= dominant_terms) & ~operations & (definitions == 0) & (n["terminology"] / F.greatest(F.lit(1), n["concepts"] + n["definitions"]) >= dominant_ratio)
    support = F.when(operations, "strong").when((definitions >= min_definitions) & (n["concepts"] > 0), "minimal").otherwise("none")
    return records.withColumns({"support": support, "near_empty": small, "terminology_dominant": dominant, "operational_definitions": definitions, "semantic_items": items})


def decision_policy(records: DataFrame, min_definitions: int = 2, **limits: object) -> DataFrame:
    """records (with precheck_decision and chunk_type) with decision, support_level and decision_reasons."""
    r = support_signals(records, min_definitions, **limits)
    none = (F.size(texts("technical_rules")) == 0) & (F.size(texts("procedures")) == 0)
    d = F.col("operational_definitions")
    heavy, glossary = (F.size(texts("concepts")) > 0) & none & (d == 0), (F.size(texts("definitions")) > 0) & none & (d == 0)
    few = (d > 0) & (d < min_definitions) & none
    bad = heavy | glossary | F.col("terminology_dominant") | few
    skip, small, degraded = F.col("precheck_decision") == "skip", F.col("near_empty"), F.col("precheck_decision") == "extract_degraded"
    doctrine, supported = F.col("chunk_type") == "doctrinal_text", F.col("support") != "none"
    decision = F.when(skip, "skip").when(small & doctrine, "extract_degraded").when(small, "skip").when(supported & ~bad, "extract").otherwise("extract_degraded")
    lacks = (small & doctrine) | (~small & (few | F.when(degraded, ~supported).otherwise(~(supported & ~bad))))
    reasons = F.array_compact(F.array(
        F.when(F.col("support") == "strong", "strong_doctrinal_support").when(F.col("support") == "minimal", "minimal_doctrinal_support"), F.when(skip | small, "semantic_payload_empty_or_near_empty"),
        F.when(~skip & ~small & heavy, "concept_heavy_no_operations"), F.when(~skip & ~small & glossary, "glossary_like_semantics"), F.when(~skip & ~small & F.col("terminology_dominant"), "terminology_dominant_no_operations"),
        F.when(~skip & lacks, "insufficient_operational_support"),
    ))
    return r.withColumns({"decision": decision, "support_level": F.when(skip | small, "none").otherwise(F.col("support")), "decision_reasons": reasons})


def post_extraction_clamp(records: DataFrame) -> DataFrame:
    """records (with confidence_profile, decision, chunk_type, chunk_text) cut to what their confidence allows, with clamp_actions."""
    profile, decision = F.col("confidence_profile"), F.col("decision")
    free = (profile == "high") & (decision == "extract") & (F.col("chunk_type") == "doctrinal_text")
    low, dirty, medium = (profile == "low") | (decision == "extract_degraded"), (profile == "contaminated") | (decision == "skip"), profile == "medium"
    text = F.coalesce("chunk_text", F.lit(""))
    terms = (F.size(F.filter(F.split(text, "\n"), lambda x: F.contains(x, F.lit(":")))) >= 2) | F.lower(text).rlike("term|glossary|definition")
    doubt = F.lower(text).rlike(AMBIGUITY)
    limits: dict[str, list[tuple[Column, int | Column]]] = {c: [(medium, 8)] for c in ("concepts", "definitions", "technical_rules", "procedures", "relationships")}
    limits |= {"terminology": [(medium, 12)], "examples": [(medium, 6)], "ambiguities": []}
    for c in ("definitions", "technical_rules", "procedures", "relationships"):
        limits[c] += [(low, 0), (dirty, 0)]
    limits["concepts"] += [(low, 4), (dirty, 0)]
    limits["examples"] += [(low, 2), (dirty, 0)]
    limits["terminology"] += [(low & terms, 5), (dirty & terms, 3), ((low | dirty) & ~terms, 0)]
    limits["ambiguities"] += [((low | dirty) & ~doubt, 0), (dirty & doubt, 2)]
    out, actions = records, []
    for c, cuts in limits.items():
        most = F.least(F.lit(1 << 30), *[F.when(when & ~free, F.lit(k)).otherwise(F.lit(1 << 30)) for when, k in cuts])
        actions.append(F.when(F.size(texts(c)) > most, F.when(most == 0, f"clear_{c}").otherwise(F.concat(F.lit(f"cap_{c}_"), most.cast("string")))))
        out = out.withColumn(f"_{c}", F.slice(texts(c), 1, most))
    done = out.withColumn("clamp_actions", F.array_compact(F.array(*actions)))
    return done.withColumns({c: F.col(f"_{c}") for c in limits}).drop(*[f"_{c}" for c in limits])


#: Headers of a record's text in order.
HEADERS = {"concepts": "CONCEPTS", "definitions": "DEFINITIONS", "technical_rules": "TECHNICAL RULES", "procedures": "PROCEDURES", "terminology": "TERMINOLOGY", "relationships": "RELATIONSHIPS", "examples": "EXAMPLES", "ambiguities": "AMBIGUITIES"}


def render_knowledge_text(records: DataFrame, headers: dict[str, str] = HEADERS) -> DataFrame:
    """records with text: a header and a list for each field that has items."""
    parts = F.array_compact(F.array(*[F.when(F.size(texts(c)) > 0, F.concat(F.lit(h), F.array_join(F.transform(texts(c), lambda x: F.concat(F.lit("\n- "), x)), ""))) for c, h in headers.items()]))
    return records.withColumn("rendered", F.array_join(parts, "\n\n"))


#: What an audit row says of a record, and what it says if a column isn't there.
AUDIT = {
    "chunk_index": None, "chunk_id": None, "chunk_type": "doctrinal_text", "type_score": 0.0, "signals": None, "precheck_decision": "extract", "decision": "extract", "decision_reasons": (), "support_level": "none",
    "weak_support": False, "confidence_profile": "medium", "reason_codes": (), "dominant_signals": None, "mixed_reason": None, "semantic_filter_actions": (), "clamp_actions": (),
}


def knowledge_audit(records: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The audit row of each record: scope and the columns of AUDIT, then the number of items of each list."""
    none = F.array().cast("array<string>")

    def one(name: str, missing: object) -> Column:
        other = none if missing == () else F.lit(missing)
        return (F.coalesce(F.col(name), other) if missing is not None else F.col(name)).alias(name) if name in records.columns else (other.cast("string") if missing is None else other).alias(name)

    return records.select(*scope, *[one(c, v) for c, v in AUDIT.items()], *[F.size(F.coalesce(F.col(c), none)).alias(f"n_{c}") for c in TEXTS if c in records.columns])

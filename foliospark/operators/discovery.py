"""Families proposed for concepts without one: by rules, and the checks that proposals pass.

Rules and proposals are taken in order, and one accepted earlier keeps its members; a document's few proposals
are scanned together, after joins have told all that doesn't depend on the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions.scans import Rows, scan_groups
from foliospark.functions.textnorm import squeeze

MIN_SIZE = 3
#: Labels and words that name no family.
GENERIC_LABELS = ("thing", "things", "concept", "concepts", "category", "categories", "relation", "relations", "condition", "conditions", "group", "groups")
GENERIC_WORDS = ("concept", "concepts", "property", "properties", "term", "terms", "related", "misc", "miscellaneous", "general")


def surface_label(text):
    return squeeze(F.replace(F.lower(text), F.lit("-"), F.lit(" ")))


def discover_families(unassigned: DataFrame, rules: DataFrame, min_size: int = MIN_SIZE) -> DataFrame:
    """doc_id, rule_order, family_label, members, rationale of rules (rule_order, family_label, members, rationale) that find min_size concepts or more which no earlier rule took.

    unassigned: doc_id, concept.
    """
    wanted = rules.select("rule_order", "family_label", "rationale", F.posexplode("members").alias("pos", "concept"))
    found = unassigned.select("doc_id", "concept").distinct().join(wanted, "concept").groupBy("doc_id", "rule_order", "family_label", "rationale").agg(F.sort_array(F.collect_list(F.struct("pos", "concept"))).alias("m"))
    ready = found.select("doc_id", "rule_order", "family_label", F.transform("m", lambda x: x["concept"]).alias("members"), "rationale")

    def scan(rows: Rows) -> Rows:
        taken: set[str] = set()
        out = []
        for r in sorted(rows, key=lambda r: r["rule_order"]):
            free = [m for m in r["members"] if m not in taken]
            if len(free) >= min_size:
                taken.update(free)
                out.append(r | {"members": free})
        return out

    return scan_groups(ready, ["doc_id"], scan, ready.schema)


def validate_family_candidates(candidates: DataFrame, unassigned: DataFrame, catalog: DataFrame, protected: tuple[str, ...] = (), min_size: int = MIN_SIZE, small_allowed: tuple[str, ...] = ()) -> DataFrame:
    """candidates (doc_id, ord, family_label, members) with members that stay, accepted and reasons.

    Reasons in order: generic label, a label of the catalog, unknown or protected members, members of a
    candidate accepted before, too few, none.
    """
    label = F.trim(F.coalesce("family_label", F.lit("")))
    one = candidates.select("doc_id", "ord", label.alias("family_label"), F.array_distinct(F.filter(F.transform("members", lambda m: F.trim(m)), lambda m: m != "")).alias("members"))
    known = unassigned.groupBy("doc_id").agg(F.collect_set("concept").alias("_known"))
    names = catalog.select(F.explode(F.concat(F.array("label"), "aliases")).alias("x")).select(surface_label(F.col("x")).alias("_name")).distinct().withColumn("_taken", F.lit(True))
    own = surface_label(F.col("family_label"))
    words = F.split(own, " ")
    generic = own.isin(*GENERIC_LABELS) | F.arrays_overlap(words, F.array(*map(F.lit, GENERIC_WORDS)))
    none = F.array().cast("array<string>")
    told = one.withColumn("_name", own).join(names, "_name", "left").join(known, "doc_id", "left").withColumn("_all", F.coalesce("_known", none))
    kept = F.filter("members", lambda m: F.array_contains("_all", m))
    guarded = F.exists(kept, lambda m: surface_label(m).isin(*protected)) if protected else F.lit(False)
    reasons = F.array_compact(F.array(
        F.when(F.col("family_label") == "", "missing_family_label"), F.when(generic, "label_too_generic"), F.when(F.col("_taken"), "possible_merge_with_existing_family"), F.when(F.size(kept) < F.size("members"), "contains_unknown_members"), F.when(guarded, "contains_protected_base_concepts"),
    ))
    ready = told.select("doc_id", "ord", "family_label", kept.alias("members"), reasons.alias("reasons"), F.col("_name").isin(*small_allowed).alias("small") if small_allowed else F.lit(False).alias("small"), F.lit(False).alias("accepted"))

    def scan(rows: Rows) -> Rows:
        taken: set[str] = set()
        for r in sorted(rows, key=lambda r: r["ord"]):
            free = [m for m in r["members"] if m not in taken]
            if r["reasons"][:1] == ["missing_family_label"]:
                r["members"], r["reasons"] = [], ["missing_family_label"]
                continue
            r["reasons"] += ["member_collision_across_candidates"] * (len(free) < len(r["members"]))
            r["reasons"] += ["family_too_small"] * (len(free) < min_size and not r["small"]) + ["no_coverage_gain"] * (not free)
            r["members"], r["accepted"] = free, not r["reasons"]
            taken.update(free if r["accepted"] else ())
        return rows

    return scan_groups(ready, ["doc_id"], scan, ready.schema).drop("small")

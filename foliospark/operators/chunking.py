"""Chunks of a text: overlapping windows, or pieces of sections packed to a target size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.lineage import cut
from foliospark.functions.pointers import on_chain
from foliospark.functions.spans import within_texts
from foliospark.functions.textnorm import strip

STRONG = ("chapter", "appendix", "bibliography", "index")
TAIL = 300


def overlap_spans(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the windows of a stripped text, cut after the last marker of a window's last 300 characters."""
    spans, start, n = [], 0, len(text)
    if n <= size:
        return [(0, n)] if n else []
    while start < n:
        limit = min(start + size, n)
        low = max(start, limit - TAIL)
        # the latest marker wins; each is compared with the place after the one before
        cut = -1
        for marker in (". ", "\n", " "):
            at = text.rfind(marker, low, limit) - low
            if at > cut:
                cut = at + len(marker)
        end = low + cut if cut > 0 else limit
        if limit == n and end < n and (end - overlap <= start or n - end <= overlap):
            end = n
        spans.append((start, end))
        if end >= n:
            break
        start = min(max(end - overlap, 0, start + 1), n)
    return spans


def chunk_overlap(docs: DataFrame, size: int = 1800, overlap: int = 200) -> DataFrame:
    """doc_id, chunk_index (from 1), start_char, end_char (in the stripped text), text of each window.

    A window's start depends on the cut before, so a text's spans are found in one pass over its row.
    """
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("size must be over 0, overlap from 0 to less than size")

    @F.pandas_udf("array<struct<start_char:int,end_char:int>>")
    def spans(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"start_char": a, "end_char": b} for a, b in overlap_spans(t or "", size, overlap)])

    one = docs.select("doc_id", strip(F.coalesce("text", F.lit(""))).alias("_t"))
    cut = one.withColumn("_s", spans("_t")).select("doc_id", "_t", F.posexplode("_s").alias("_n", "_s"))
    piece = strip(F.substring(F.col("_t"), F.col("_s.start_char") + 1, F.col("_s.end_char") - F.col("_s.start_char")))
    return cut.select("doc_id", (F.col("_n") + 1).alias("chunk_index"), "_s.start_char", "_s.end_char", piece.alias("text")).where("text <> ''")


def split_span(text: str, target: int, least: int, window: int) -> list[tuple[int, int]]:
    """(start, end) parts of a long section, cut backward at a paragraph, sentence or space; a short last part joins the one before."""
    parts, start, n = [], 0, len(text)
    while start < n:
        end = n
        if n - start > target:
            limit = start + target
            low = max(start, limit - window)
            paragraph, sentence, space = text.rfind("\n\n", low, limit), max(text.rfind(m, low, limit) for m in (". ", "? ", "! ")), text.rfind(" ", low, limit)
            end = paragraph + 2 if paragraph >= 0 else sentence + 2 if sentence >= 0 else space + 1 if space >= 0 else limit
        parts.append((start, end))
        start = end
    if len(parts) > 1 and parts[-1][1] - parts[-1][0] < least and parts[-1][1] - parts[-2][0] <= target:
        parts[-2:] = [(parts[-2][0], parts[-1][1])]
    return parts


def section_atoms(docs: DataFrame, sections: DataFrame, target: int = 14000, least: int = 3000, window: int = 450, excluded: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, section_id, section_index, section_type, start_page, end_page, is_weak, n_parts, start_char, end_char: sections cut to the target size.

    Blank sections and excluded types are left out; a section is weak if its neighbours may take it.
    """
    kept = sections.where(~F.coalesce(F.col("type").isin(*excluded), F.lit(False))) if excluded else sections
    spans = kept.select(
        "doc_id", "start_char", "end_char", F.col("id").alias("section_id"), "section_index", F.col("type").alias("section_type"), F.col("start_page").cast("long").alias("start_page"), F.col("end_page").cast("long").alias("end_page"),
    )

    def atoms(text: str, rows: list[tuple]) -> Iterator[tuple]:
        before = None
        for k, (start, end, kind) in enumerate(rows):
            piece = text[start:end]
            if piece.strip():
                weak = kind not in STRONG and (kind != "unknown" or (end - start <= least and before != "chapter"))
                parts, before = split_span(piece, target, least, window), kind
                yield from ((k, weak, len(parts), start + a, start + b) for a, b in parts if piece[a:b].strip())

    full = within_texts(spans, docs, ("start_char", "end_char", "section_type"), atoms, "is_weak boolean, n_parts int, _a int, _b int")
    return full.select("doc_id", "section_id", "section_index", "section_type", "start_page", "end_page", "is_weak", "n_parts", F.col("_a").alias("start_char"), F.col("_b").alias("end_char"))


def places_up_to(atoms: DataFrame, reach: Sequence[int]) -> DataFrame:
    """doc_id, at, and for each i the number of atoms that end within reach[i] characters of atom at's start (n_i), and the end of the last one (end_i).

    Ends and limits of a document are put in one order, and each limit takes the running count of ends.
    """
    limits = F.array(*[F.struct(F.lit(i).alias("i"), (F.col("start_char") + r).alias("pos")) for i, r in enumerate(reach)])
    asked = atoms.select("doc_id", "at", F.inline(limits)).select("doc_id", "pos", F.lit(1).alias("kind"), "at", "i")
    ends = atoms.select("doc_id", F.col("end_char").alias("pos"), F.lit(0).alias("kind"), F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("i"))
    order = Window.partitionBy("doc_id").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    counted = ends.unionByName(asked).select("doc_id", "at", "i", F.count_if(F.col("kind") == 0).over(order).cast("int").alias("n"), F.max(F.when(F.col("kind") == 0, F.col("pos"))).over(order).alias("end"))
    return counted.where("i IS NOT NULL").groupBy("doc_id", "at").agg(*[F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}_{i}") for i in range(len(reach)) for c in ("n", "end")])


def pack_successors(atoms: DataFrame, target: int, least: int) -> DataFrame:
    """doc_id, at, to: where the chunk that begins with atom `at` ends and the next one begins; null after the last.

    atoms: at (place in the document), start_char, end_char, is_weak, wall (a strong section begins or ended before it).
    """
    order = Window.partitionBy("doc_id").orderBy("at")
    after, on = order.rowsBetween(1, Window.unboundedFollowing), order.rowsBetween(0, Window.unboundedFollowing)
    firm = F.when(~(F.col("is_weak") & (F.col("end_char") - F.col("start_char") < least)), F.col("at"))
    told = atoms.withColumns({"_wall": F.min(F.when(F.col("wall"), F.col("at"))).over(after), "_firm": F.min(firm).over(on), "_firm_after": F.min(firm).over(after)})
    near = told.join(places_up_to(atoms, (target, int(target * 1.5))).hint("merge"), ["doc_id", "at"])
    over = F.greatest("n_0", F.col("at") + 1)
    have = F.when(F.col("n_0") > F.col("at"), F.col("end_0")).otherwise(F.col("end_char")) - F.col("start_char")
    near = near.select("doc_id", "at", "_wall", F.greatest("n_1", F.col("at") + 1).alias("_most"), over.alias("_over"), (have < least).alias("_small"))
    # beyond the target only small weak atoms join; the first of all may, if the chunk is small
    rest = told.select("doc_id", F.col("at").alias("_over"), "_firm", "_firm_after")
    met = near.join(rest.hint("merge"), ["doc_id", "_over"], "left")
    last = atoms.groupBy("doc_id").agg(F.max("at").alias("_last"))
    to = F.least("_wall", "_most", F.when(F.col("_small"), F.col("_firm_after")).otherwise(F.col("_firm")))
    return met.join(last.hint("merge"), "doc_id").select("doc_id", "at", F.when(to <= F.col("_last"), to).alias("to"))


def pack_atoms(atoms: DataFrame, target: int = 14000, least: int = 3000) -> DataFrame:
    """atoms with pack, the number of the chunk that takes each.

    Atoms join while they fit the target, or, to avoid small chunks, 1.5 times it; never over the edge of
    a strong section. Where a chunk ends depends on its first atom only, so each atom gets a successor, and the
    chunks of a document are what the chain from its first atom comes by (pointer doubling). Then a small chunk may take the next one,
    once: in a run of chunks that may, every second does.
    """
    if least > target:
        raise ValueError("least must not be over target")
    doc = Window.partitionBy("doc_id")
    place = doc.orderBy("start_char", "end_char")
    is_strong = lambda a, kind_a, b, kind_b: (a != b) & (kind_a.isin(*STRONG) | kind_b.isin(*STRONG))
    wall = is_strong(F.lag("section_id").over(place), F.lag("section_type").over(place), F.col("section_id"), F.col("section_type"))
    placed = cut(atoms.withColumns({"at": F.row_number().over(place) - 1, "wall": F.coalesce(wall, F.lit(False))}))
    edges = pack_successors(placed.select("doc_id", "at", "start_char", "end_char", "is_weak", "wall"), target, least)
    firsts = on_chain(edges, placed.where("at = 0").select("doc_id", "at"), ["doc_id"]).withColumn("_first", F.lit(1))
    numbered = cut(placed.join(firsts.hint("merge"), ["doc_id", "at"], "left").withColumn("_pack", F.sum(F.coalesce("_first", F.lit(0))).over(doc.orderBy("at")).cast("int") - 1).drop("_first"))

    packs = numbered.groupBy("doc_id", "_pack").agg(F.min("start_char").alias("_a"), F.max("end_char").alias("_b"), F.min_by("wall", "at").alias("_edge"))
    order = doc.orderBy("_pack")
    may = (F.col("_b") - F.col("_a") < least) & ~F.lead("_edge").over(order) & (F.lead("_b").over(order) - F.col("_a") <= int(target * 1.5))
    packs = packs.withColumn("_may", F.coalesce(may, F.lit(False)))
    run = F.coalesce(F.max(F.when(~F.col("_may"), F.col("_pack"))).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(-1))
    packs = packs.withColumn("_takes", F.col("_may") & ((F.col("_pack") - run) % 2 == 1))
    own = ~F.coalesce(F.lag("_takes").over(order), F.lit(False))
    final = packs.withColumn("_own", own.cast("int")).select("doc_id", "_pack", (F.sum("_own").over(order) - 1).cast("int").alias("pack"))
    return numbered.join(final.hint("merge"), ["doc_id", "_pack"]).select(*atoms.columns, "pack")


def chunk_records(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, chunk_index (from 0), chunk_id, section_id, section_index, start_char, end_char, start_page, end_page, text."""
    at = F.struct("start_char", "end_char")
    ends = packed.groupBy("doc_id", "pack").agg(
        F.min_by("section_id", at).alias("_a"), F.max_by("section_id", at).alias("_b"), F.min_by("section_index", at).alias("section_index"),
        F.min("start_char").alias("start_char"), F.max("end_char").alias("end_char"), F.min_by("start_page", at).alias("start_page"), F.max_by("end_page", at).alias("end_page"),
    )

    def texts(text: str, rows: list[tuple]) -> Iterator[tuple]:
        full = ((k, piece) for k, (start, end) in enumerate(rows) if (piece := text[start:end].strip()))
        return ((k, number, piece) for number, (k, piece) in enumerate(full))

    full = within_texts(ends.drop("pack"), docs, ("start_char", "end_char"), texts, "chunk_index int, text string")
    named = full.withColumn("section_id", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.concat_ws("__", "_a", "_b")))
    return named.withColumn("chunk_id", F.concat_ws("_", F.lit("chunk"), "chunk_index", "start_char", "end_char")).select("doc_id", "chunk_index", "chunk_id", "section_id", "section_index", "start_char", "end_char", "start_page", "end_page", "text")


def chunk_stats(chunks: DataFrame, packed: DataFrame, target: int = 14000) -> DataFrame:
    """One row a document: counts of chunks, sections, weak sections taken in, and averages."""
    per = packed.groupBy("doc_id", "pack").agg(F.count_distinct("section_id").alias("_n"), F.count_distinct(F.when(F.col("is_weak"), F.col("section_id"))).alias("_w"))
    taken = per.groupBy("doc_id").agg(F.sum(F.when(F.col("_n") > 1, F.col("_w")).otherwise(0)).alias("weak_sections_absorbed"))
    atoms = packed.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("_atoms"), F.count_distinct("section_id").alias("sections_consumed"), F.count_distinct(F.when(F.col("n_parts") > 1, F.col("section_id"))).alias("sections_split"),
        F.count_distinct(F.when(F.col("is_weak"), F.col("section_id"))).alias("weak_sections_total"),
    )
    sizes = chunks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total_chunks"), F.avg(F.col("end_char") - F.col("start_char")).alias("avg_chunk_size"))
    ratio = F.when(F.col("weak_sections_total") > 0, F.col("weak_sections_absorbed") / F.col("weak_sections_total")).otherwise(0.0)
    both = sizes.join(atoms.hint("merge"), "doc_id").join(taken.hint("merge"), "doc_id").withColumns({"avg_sections_per_chunk": F.col("_atoms") / F.col("total_chunks"), "weak_sections_absorbed_ratio": ratio, "hard_max_chunk_size": F.lit(int(target * 1.5))})
    return both.drop("_atoms")


def is_noisy_ref(label: Column, kind: Column) -> Column:
    """Section labels that tell nothing of a chunk: empty, index, punctuation, very short, or unknown back matter."""
    text = F.regexp_replace(strip(label), r"\s+", " ")
    short = (F.size(F.split(text, " ")) <= 2) & kind.isin("unknown", "section") & (F.length(text) <= 8)
    back = F.lower(text).rlike("bibliography|references|sources") & (kind == "unknown")
    return (text == "") | (kind == "index") | text.rlike(r"^[^\p{L}\p{N}]{1,8}$") | short | back


#: Characters of a bin of offsets.
BIN = 8192


def chunk_section_refs(chunks: DataFrame, sections: DataFrame) -> DataFrame:
    """doc_id, chunk_index, section_refs: the sections that overlap each chunk and aren't noise, else its own one.

    Chunks and sections meet in bins of offsets, by equality; of the bins that two share only the first counts, so no document's chunks are all compared
    with all its sections.
    """
    key = ["doc_id", "chunk_index"]
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / BIN), F.floor((F.col(b) - 1) / BIN)))
    told = sections.where(~is_noisy_ref(F.col("label"), F.col("type"))).select("doc_id", F.struct("start_char", "end_char", "label", "type").alias("_r"), F.col("section_index").alias("_i"))
    spans = told.select("doc_id", "_r", F.col("_r.start_char").alias("_x"), F.col("_r.end_char").alias("_y")).where("_y > _x").withColumn("_bin", bins("_x", "_y"))
    keys = chunks.select(*key, "section_index", F.col("start_char").alias("_a"), F.col("end_char").alias("_b"))
    met = keys.where("_b > _a").withColumn("_bin", bins("_a", "_b")).join(spans, ["doc_id", "_bin"])
    met = met.where((F.greatest("_x", "_a") < F.least("_y", "_b")) & (F.col("_bin") == F.floor(F.greatest("_x", "_a") / BIN)))
    own = keys.join(told, (keys["doc_id"] == told["doc_id"]) & (keys["section_index"] == told["_i"])).select(keys["doc_id"], "chunk_index", F.lit(True).alias("_own"), "_r")
    found = met.select(*key, F.lit(False).alias("_own"), "_r").unionByName(own).groupBy(*key).agg(*[F.sort_array(F.collect_list(F.when(F.col("_own") == o, F.col("_r")))).alias(c) for c, o in (("_m", False), ("_o", True))])
    refs = F.when(F.size("_m") > 0, F.col("_m")).otherwise(F.col("_o"))
    out = keys.select(*key).join(found.select(*key, refs.alias("section_refs")), key, "left")
    return out.withColumn("section_refs", F.coalesce("section_refs", F.array().cast(out.schema["section_refs"].dataType)))


def index_like(label: Column) -> Column:
    text = strip(label)
    refs = text.rlike(r"(?:\s|,)[0-9]+(?:[-–][0-9]+)?(?:\s*,\s*[0-9]+(?:[-–][0-9]+)?)*\.?$") & (F.contains(text, F.lit(",")) | (F.size(F.split(text, r"\s+")) <= 6))
    return text.rlike("^[A-Z]$") | text.rlike(r"\.{3,}\s*[0-9]+\s*$") | refs | F.contains(F.lower(text), F.lit("contents"))


def structure_quality(sections: DataFrame, stats: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, the ratios of a map, and reason: the first that makes it unfit for structural chunks, or null."""
    kind = F.col("type")
    share = lambda when: F.avg(when.cast("double"))
    one = sections.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("sections_generated"), share(kind == "unknown").alias("unknown_ratio"), share(kind.isin("chapter", "section", "appendix", "front_matter")).alias("chunk_useful_type_ratio"), share(index_like(F.col("label"))).alias("index_like_ratio")
    )
    both = one.join(stats.select("doc_id", "heading_candidates", "classified_headings").hint("merge"), "doc_id").join(docs.select("doc_id", F.length("text").alias("_n")).hint("merge"), "doc_id")
    density = F.col("sections_generated") / F.greatest(F.lit(1.0), F.col("_n") / 10000.0)
    classified = F.col("classified_headings") / F.greatest(F.lit(1), F.col("heading_candidates"))
    soft = (density > 12.0).cast("int") + (F.col("chunk_useful_type_ratio") < 0.20).cast("int") + (classified < 0.10).cast("int")
    reason = F.when(F.col("unknown_ratio") > 0.85, "semantic_gate_unknown_ratio").when(F.col("index_like_ratio") > 0.20, "semantic_gate_index_like_ratio").when(soft >= 2, "semantic_gate_secondary_metrics")
    return both.select("doc_id", "sections_generated", "unknown_ratio", "chunk_useful_type_ratio", "index_like_ratio", density.alias("section_density"), classified.alias("classified_heading_ratio"), reason.alias("reason"))


def choose_chunking(quality: DataFrame, structural: DataFrame, windows: DataFrame, least: int = 3000, problems: DataFrame | None = None) -> DataFrame:
    """doc_id, mode (structural or legacy), reason: which chunks of a document to use, and why not the structural ones.

    problems (doc_id): documents whose map isn't sound.
    """
    small = F.greatest(F.lit(400), F.lit(least // 2))
    s = structural.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_s"), F.avg((F.length("text") < small).cast("double")).alias("_small"))
    w = windows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_w"))
    both = quality.join(s.hint("merge"), "doc_id", "left").join(w.hint("merge"), "doc_id", "left").na.fill(0, ["_s", "_w", "_small"]).withColumn("_bad", F.lit(False))
    if problems is not None:
        both = both.drop("_bad").join(problems.select("doc_id").distinct().withColumn("_bad", F.lit(True)).hint("merge"), "doc_id", "left")
    reason = (
        F.when(F.col("_bad"), "structural_map_invalid").when(F.col("sections_generated") <= 1, "structural_map_insufficient_sections").when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("_s") > 1.75 * F.greatest("_w", F.lit(1)), "postcheck_chunk_count").when(F.col("_small") > 0.35, "postcheck_small_chunk_ratio")
    )
    return both.select("doc_id", F.when(reason.isNull(), "structural").otherwise("legacy").alias("mode"), reason.alias("reason"))


def chosen_chunks(choice: DataFrame, structural: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, mode, chunk_index (from 1), chunk_id, section_id, start_char, end_char, text: the chunks that choose_chunking() chose; documents it doesn't name have windows.

    Structural chunks keep their ids, windows are `legacy_chunk_<n>`.
    """
    mode = F.coalesce("mode", F.lit("legacy"))
    first = structural.join(choice.where("mode = 'structural'").select("doc_id").hint("merge"), "doc_id", "left_semi")
    first = first.select("doc_id", F.lit("structural").alias("mode"), (F.col("chunk_index") + 1).alias("chunk_index"), "chunk_id", "section_id", "start_char", "end_char", "text")
    other = windows.join(choice.select("doc_id", "mode").hint("merge"), "doc_id", "left").where(mode == "legacy")
    other = other.select("doc_id", F.lit("legacy").alias("mode"), "chunk_index", F.concat(F.lit("legacy_chunk_"), F.col("chunk_index").cast("string")).alias("chunk_id"), F.lit(None).cast("string").alias("section_id"), "start_char", "end_char", "text")
    return first.unionByName(other)


def is_garbage_label(label: Column) -> Column:
    text = strip(label)
    return (text == "") | index_like(text) | text.rlike(r"[\^£®§¤¢¥©]")

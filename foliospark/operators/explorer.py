"""Serving tables over concepts: indexes, blocks, hierarchy, related concepts, search."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from foliospark.functions.lineage import cut, small_batches
from foliospark.functions.textnorm import let, squeeze
from foliospark.functions.trigrams import rarest_piece, with_pieces
from foliospark.operators.families import maybe_broadcast


def symmetric_hierarchy(edges: DataFrame, concepts: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, parent, child: edges given from either side, between known concepts, once."""
    out = edges.select(*scope, "parent", "child").distinct()
    for side in ("parent", "child"):
        out = out.join(concepts.select(*scope, F.col("concept").alias(side)), [*scope, side], "left_semi")
    return out


def chunk_to_concepts(concepts: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, chunk, concepts in order of name."""
    rows = concepts.select(*scope, "concept", F.explode("source_chunks").alias("chunk"))
    return rows.groupBy(*scope, "chunk").agg(F.sort_array(F.collect_set("concept")).alias("concepts"))


#: Chunks of a bin, in which ranges of chunks and chunks meet.
BIN = 16


def block_concepts(blocks: DataFrame, concepts: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, block_index, concept: the concepts of the chunks from a block's start to its end.

    Ranges and chunks meet in bins of chunks, by equality; a range of n chunks is about n / BIN + 1 rows. Neither side is broadcast: Spark takes a side
    for as small as its file, whatever the bins and lists add to it.
    """
    bin_of = lambda c: F.floor(F.col(c) / BIN)
    ends = [f("start_chunk", "end_chunk") for f in (F.least, F.greatest)]
    known = blocks.where("start_chunk IS NOT NULL AND end_chunk IS NOT NULL").select(*scope, "block_index", ends[0].alias("_low"), ends[1].alias("_high"))
    ranges = known.withColumn("_bin", F.explode(F.sequence(bin_of("_low"), bin_of("_high"))))
    rows = concepts.select(*scope, "concept", F.explode("source_chunks").alias("chunk")).withColumn("_bin", bin_of("chunk"))
    met = ranges.hint("merge").join(rows, [*scope, "_bin"]).where("chunk BETWEEN _low AND _high")
    return met.select(*scope, "block_index", "concept").distinct()


def enrich_blocks(blocks: DataFrame, concepts: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    own = block_concepts(blocks, concepts, scope).groupBy(*scope, "block_index").agg(F.sort_array(F.collect_set("concept")).alias("concepts"))
    return blocks.join(own.hint("merge"), [*scope, "block_index"], "left").withColumn("concepts", F.coalesce("concepts", F.array().cast("array<string>")))


def family_list(members: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, family_id, label, n, rank: families by size, then label."""
    sized = members.select(*scope, "family_id", "label", F.size("members").alias("n"))
    return sized.withColumn("rank", F.row_number().over(Window.partitionBy(*scope).orderBy(F.desc("n"), "label")))


def breadcrumbs(edges: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, concept, path: from each child up by its first parent in order of name, until none or a cycle, however far.

    Pointer jumping: each round puts the way up from the top of a concept's way behind it, so ways double, and rounds are as many as the logarithm of the
    longest one. In a cycle all that follows the first repeat is a repeat.
    """
    first = edges.groupBy(*scope, F.col("child").alias("concept")).agg(F.min("parent").alias("_next"))
    now = cut(first.withColumn("_up", F.array("concept")))
    done = []
    while not now.isEmpty():
        tops = now.unionByName(reduce(DataFrame.unionByName, done)) if done else now
        rest = tops.select(*scope, F.col("concept").alias("_next"), F.col("_up").alias("_more"), F.col("_next").alias("_then"))
        whole = F.concat("_up", F.coalesce("_more", F.array("_next")))
        met = now.join(rest, [*scope, "_next"], "left").withColumns({"_whole": whole, "_way": F.array_distinct(whole)})
        # a way ends at a concept that has no parent, or where it repeats itself
        met = cut(met.withColumn("_next", F.when(F.size("_way") == F.size("_whole"), F.col("_then"))).select(*scope, "concept", "_next", F.col("_way").alias("_up")))
        done.append(met.where("_next IS NULL"))
        now = met.where("_next IS NOT NULL")
    every = reduce(DataFrame.unionByName, done) if done else now
    return every.select(*scope, "concept", F.reverse("_up").alias("path"))


def signal_terms(concepts: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, concept, term: name, aliases and terms in small letters, also without punctuation and without a final s."""
    text = lambda v: squeeze(F.lower(v))
    bare = lambda t: F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}_\s]", ""))
    cut = lambda t: F.when(F.endswith(t, F.lit("s")) & (F.length(t) > 3), F.substring(t, F.lit(1), F.length(t) - 1))

    def forms(v: Column) -> Column:
        t = text(v)
        return F.filter(F.array(t, bare(t), cut(t), cut(bare(t))), lambda x: x.isNotNull() & (x != ""))

    none = F.array().cast("array<string>")
    aliases = F.coalesce(F.col("aliases"), none) if "aliases" in concepts.columns else none
    values = F.concat(F.array("concept"), aliases, F.coalesce("terminology", none))
    return concepts.select(*scope, "concept", F.explode(F.array_distinct(F.flatten(F.transform(values, forms)))).alias("term"))


#: What two concepts can share, in lists of concepts by key: a term, a block, a family, a parent. The last two are direct links of that strength.
TERM, BLOCK, FAMILY, PARENT = 0, 1, 2, 3


def posting_lists(concepts: DataFrame, up: DataFrame, families: DataFrame, in_blocks: DataFrame, scope: Sequence[str]) -> DataFrame:
    """scope, kind, key, concept: the concepts of each term, block, family and parent, once."""
    row = lambda df, kind, key: df.select(*scope, F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), "concept")
    parts = (row(signal_terms(concepts, scope), TERM, "term"), row(in_blocks, BLOCK, "block_index"), row(families, FAMILY, "family_id"), row(up.withColumnRenamed("child", "concept"), PARENT, "parent"))
    return reduce(DataFrame.unionByName, parts).distinct()


def pair_scores(pairs: DataFrame, edges: DataFrame, lists: DataFrame, scope: Sequence[str]) -> DataFrame:
    """scope, concept, other, direct, cooccurrence, terminology of given pairs.

    Of each pair the concept that is in fewer lists is spelled out, and its lists are looked up for the other one by equality.
    """
    pair = [*scope, "concept", "other"]
    counts = lists.groupBy(*scope, "concept").agg(F.count(F.lit(1)).alias("_n"))
    sized = pairs.join(counts, [*scope, "concept"], "left").join(counts.withColumnsRenamed({"concept": "other", "_n": "_m"}), [*scope, "other"], "left")
    own = F.col("_n") <= F.col("_m")
    ends = sized.where("_n IS NOT NULL AND _m IS NOT NULL").select(*pair, F.when(own, F.col("concept")).otherwise(F.col("other")).alias("_few"), F.when(own, F.col("other")).otherwise(F.col("concept")).alias("_many"))
    few, many = (lists.withColumnRenamed("concept", c) for c in ("_few", "_many"))
    met = ends.join(few, [*scope, "_few"]).join(many, [*scope, "_many", "kind", "key"]).select(*pair, "kind")
    direct = edges.select(*pair, F.col("direct").alias("kind")).join(pairs, pair, "left_semi")
    found = met.unionByName(direct).unionByName(pairs.select(*pair, F.lit(None).cast("int").alias("kind")))
    strength = F.coalesce(F.max(F.when(F.col("kind") >= FAMILY, F.col("kind"))), F.lit(0))
    return found.groupBy(*pair).agg(strength.alias("direct"), F.count_if(F.col("kind") == BLOCK).alias("cooccurrence"), F.count_if(F.col("kind") == TERM).alias("terminology"))


def lists_to_read(open_lists: DataFrame, last: DataFrame, scope: Sequence[str]) -> DataFrame:
    """The lists (scope, concept, kind, key) that a concept has to read to its end, so that no concept that it hasn't met can be among its closest.

    open_lists: the lists longer than their first names, with size and the last of these (end); last: the score and name of each concept's last
    candidate so far. A concept that isn't met yet is in lists left open only, behind their first names. With T, C and W the last candidate's direct
    link, blocks and terms, it can't come before that one if
    1. no list of direct links of strength T is left open; or fewer than C blocks are; or
    2. C blocks and fewer than W terms are left open; or C blocks and W terms, and the last candidate's name isn't behind the first names of all
       lists that such a concept must be in.
    Stronger links than T are never open, as a list with more than its first names has candidates enough. Of these ways the one with the fewest rows to read is
    taken; the longest lists are left open.
    """
    key = [*scope, "concept"]
    nth = F.row_number().over(Window.partitionBy(*key, "kind").orderBy(F.desc("size"), "key"))
    met = open_lists.withColumn("_r", nth).join(last.select(*key, F.col("direct").alias("_t"), F.col("cooccurrence").alias("_c"), F.col("terminology").alias("_w"), F.col("other").alias("_name")), key)
    t, c, w = F.col("_t"), F.col("_c"), F.col("_w")
    link, block, term = (F.col("kind") == t) & (t >= FAMILY), F.col("kind") == BLOCK, F.col("kind") == TERM
    ways = (link, block & (F.col("_r") >= c), (block & (F.col("_r") > c)) | (term & (F.col("_r") >= w)), (block & (F.col("_r") > c)) | (term & (F.col("_r") > w)))
    rows = [F.coalesce(F.sum(F.when(way, F.col("size"))), F.lit(0)) for way in ways]
    behind = F.greatest(F.max(F.when((block & (F.col("_r") <= c)) | (term & (F.col("_r") <= w)), F.col("end"))), F.min(F.when(link, F.col("end"))))
    first = lambda name: F.first(name)  # noqa: E731  the same for all rows of a concept
    allowed = (first("_t") > 0, first("_c") > 0, first("_w") > 0, first("_name") <= behind)
    cost = met.groupBy(*key).agg(*[F.when(ok, n).alias(f"_{i}") for i, (ok, n) in enumerate(zip(allowed, rows))])
    least = F.least(*[F.col(f"_{i}") for i in range(len(ways))])
    chosen = F.coalesce(*[F.when(F.col(f"_{i}") == least, i) for i in range(len(ways))])
    read = reduce(lambda so_far, i: F.when(F.col("_way") == i, ways[i]).otherwise(so_far), range(len(ways)), F.lit(False))
    return met.join(cost.select(*key, chosen.alias("_way")), key).where(read).select(*key, "kind", "key")


def related_candidates(lists: DataFrame, edges: DataFrame, limit: int, scope: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(scores of the pairs met first, further pairs): together they hold the `limit` closest of each concept.

    Parents and children are met, and the first limit + 1 names of each list. Then only such lists are read to their end as
    may hide a closer concept (lists_to_read); a list that many concepts are in is mostly not.
    """
    pair, of = [*scope, "concept", "other"], [*scope, "kind", "key"]
    order = Window.partitionBy(*of).orderBy("concept")
    firsts = lists.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= limit + 1).groupBy(*of).agg(F.sort_array(F.collect_list("concept")).alias("names"))
    heads = lists.groupBy(*of).agg(F.count(F.lit(1)).alias("size")).join(firsts, of)
    begun = cut(lists.join(heads, of))
    met = cut(begun.select(*scope, "concept", F.explode("names").alias("other")).where("concept <> other").unionByName(edges.select(*pair)).distinct())
    scored = cut(pair_scores(met, edges, lists, scope))
    last = scored.withColumn("rank", F.row_number().over(closest(scope))).where(F.col("rank") == limit)
    open_ = begun.where(F.col("size") > limit + 1).select(*scope, "concept", "kind", "key", "size", F.element_at("names", -1).alias("end"))
    read = lists_to_read(open_, last, scope).join(lists.withColumnRenamed("concept", "other"), of).where("concept <> other")
    return scored, cut(read.select(*pair).distinct().join(met, pair, "left_anti"))


def closest(scope: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*scope, "concept").orderBy(F.desc("direct"), F.desc("cooccurrence"), F.desc("terminology"), "other")


#: Scopes of up to so many rows of lists are ranked in a row of their own; larger ones by related_candidates.
SMALL_SCOPE = 2048


def ranked_in_scope(names: np.ndarray, kinds: np.ndarray, keys: np.ndarray, others: np.ndarray, limit: int) -> tuple[np.ndarray, ...]:
    """concept, other, direct, blocks, terms, rank of one scope's closest pairs, from its lists (name, kind, key) and, where kind is above PARENT, its links to `others`; all whole numbers, names in order."""
    known, at = np.unique(np.concatenate([names, others[kinds > PARENT]]), return_inverse=True)
    at, n = at[: len(names)], len(known)
    shared = []
    for kind in (TERM, BLOCK, FAMILY, PARENT):
        mine = kinds == kind
        columns, column = np.unique(keys[mine], return_inverse=True)
        holds = np.zeros((n, len(columns)), np.float32)
        holds[at[mine], column] = 1
        shared.append((holds @ holds.T).astype(np.int64))
    terms, blocks, family, parent = shared
    direct = np.where(parent > 0, PARENT, np.where(family > 0, FAMILY, 0))
    links = kinds > PARENT
    np.maximum.at(direct, (at[links], np.searchsorted(known, others[links])), kinds[links])
    score = (direct * (blocks.max(initial=0) + 1) + blocks) * (terms.max(initial=0) + 1) + terms
    np.fill_diagonal(score, 0)
    first = np.argsort(-score, axis=1, kind="stable")[:, :limit]
    a, rank = np.nonzero(np.take_along_axis(score, first, 1))
    b = first[a, rank]
    return known[a], known[b], direct[a, b], blocks[a, b], terms[a, b], rank + 1


def related_in_scopes(lists: DataFrame, edges: DataFrame, limit: int, scope: Sequence[str]) -> DataFrame:
    """related_concepts of small scopes: a scope's lists and links are gathered in one row, and its pairs are counted as products of its matrices; no pair is shuffled."""
    links = edges.select(*scope, F.col("direct").alias("kind"), F.lit("").alias("key"), "concept", "other")
    rows = lists.select(*scope, "kind", "key", "concept", F.lit(None).cast("string").alias("other")).unionByName(links)
    packed = rows.groupBy(*scope).agg(F.collect_list(F.struct("kind", "key", "concept", "other")).alias("_rows"))
    kind = StructType([*packed.select(*scope).schema, *StructType.fromDDL("concept string, other string, direct int, cooccurrence long, terminology long, rank int")])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(kind)
        for b in batches:
            column = b.column(b.schema.get_field_index("_rows"))
            kinds, key, concept, other = column.flatten().flatten()
            # names as places in the order of all of the batch
            every = pa.concat_arrays([concept, other]).dictionary_encode()
            words = every.dictionary.to_pylist()
            order = sorted(range(len(words)), key=words.__getitem__)
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            codes = np.append(place, -1)[every.indices.fill_null(len(words)).to_numpy(zero_copy_only=False)]
            names, others = codes[: len(concept)], codes[len(concept) :]
            keys, kinds = key.dictionary_encode().indices.to_numpy(), kinds.to_numpy()
            ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
            made = [ranked_in_scope(names[i:j], kinds[i:j], keys[i:j], others[i:j], limit) for i, j in zip(ends, ends[1:])]
            own, sorted_words = np.repeat(np.arange(len(made)), [len(m[0]) for m in made]), pa.array([words[i] for i in order], pa.string())
            parts = [np.concatenate(x) if made else np.empty(0, np.int64) for x in zip(*made)]
            columns = [b.column(b.schema.get_field_index(c)).take(pa.array(own)) for c in scope]
            columns += [sorted_words.take(pa.array(p)) for p in parts[:2]] + [pa.array(p) for p in parts[2:]]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target)], schema=target)

    return small_batches(packed).mapInArrow(each, kind)


def related_concepts(concepts: DataFrame, hierarchy: DataFrame, families: DataFrame, in_blocks: DataFrame, limit: int = 10, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, concept, other, direct, cooccurrence, terminology, rank: the closest concepts of each.

    direct is the best of: parent 5, child or related 4, sibling 3, same family 2. Blocks and terms count those
    shared. Ranked by direct, blocks, terms, name. Scopes of few rows are ranked in a row each (related_in_scopes); in
    larger ones pairs that can't be among the closest aren't formed (related_candidates).
    hierarchy: parent, child; families: concept, family_id; in_blocks: block_index, concept.
    """
    up = hierarchy.where("parent <> child").select(*scope, "parent", "child").distinct()
    tie = lambda a, b, score: up.select(*scope, F.col(a).alias("concept"), F.col(b).alias("other"), F.lit(score).alias("direct"))
    edges = cut(tie("child", "parent", 5).unionByName(tie("parent", "child", 4)).groupBy(*scope, "concept", "other").agg(F.max("direct").alias("direct")))
    lists = cut(posting_lists(concepts, up, families, in_blocks, scope))
    full = lists.dropna(subset=[*scope, "key", "concept"])
    large = cut(full.groupBy(*scope).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > SMALL_SCOPE).select(*scope)) if scope else None
    columns = [*scope, "concept", "other", "direct", "cooccurrence", "terminology", "rank"]
    if scope and large.isEmpty():
        return related_in_scopes(full, edges.dropna(subset=[*scope]), limit, scope).select(columns)
    few = maybe_broadcast(large) if scope else None
    in_large = lambda df, how: df.join(few, [*scope], how) if scope else df
    long, ties = in_large(lists, "left_semi"), in_large(edges, "left_semi")
    scored, more = related_candidates(long, ties, limit, scope)
    scores = scored.unionByName(pair_scores(more, ties, long, scope))
    ranked = scores.withColumn("rank", F.row_number().over(closest(scope))).where(F.col("rank") <= limit).select(columns)
    if not scope:
        return ranked
    small = related_in_scopes(in_large(full, "left_anti"), in_large(edges.dropna(subset=[*scope]), "left_anti"), limit, scope)
    return ranked.unionByName(small.select(columns))


#: The form of a relation's text, and what its type says of the bucket; the first that fits counts.
RELATION = r"(?i)^(?:details:\s*)?(?:from:\s*([^;]+);\s*)?(?:to:\s*([^;]+);\s*)?(?:type:\s*([^;]+))?"
BUCKETS = (("contrasts_with", ("contrast", "oppos")), ("depends_on", ("depend", "criteria", "require")), ("used_in", ("use", "application", "assignment")))


def parsed_relation(text: Column, concept: Column) -> Column:
    """struct(bucket, counterpart) of a relation's text; its parts are taken out once."""
    part = lambda n: squeeze(F.lower(F.regexp_extract(text, RELATION, n)))
    parts = F.struct(part(1).alias("source"), part(2).alias("target"), F.trim(F.lower(F.regexp_extract(text, RELATION, 3))).alias("kind"))

    def told(p: Column) -> Column:
        source, target, bucket = p["source"], p["target"], F.lit("related_to")
        other = F.when((source == concept) & (target != ""), target).when(target == concept, source).when(target != "", target).otherwise(source)
        for name, words in reversed(BUCKETS):
            bucket = F.when(reduce(lambda found, w: found | F.contains(p["kind"], F.lit(w)), words, F.lit(False)), name).otherwise(bucket)
        return let(other, lambda o: F.struct(F.when(o != "", bucket).otherwise("related_to").alias("bucket"), F.when(o != "", o).otherwise(text).alias("counterpart")))

    return let(parts, told)


def parse_relations(relations: DataFrame) -> DataFrame:
    """relations (…, concept, text) with bucket and counterpart.

    A text begins with `from: x; to: y; type: z`, each of which may be missing. The counterpart is the one
    that isn't the concept; with neither, or in any other text, the text itself is what it is related to.
    """
    told = relations.withColumn("_p", parsed_relation(F.col("text"), F.col("concept")))
    return told.withColumns({"bucket": F.col("_p.bucket"), "counterpart": F.col("_p.counterpart")}).drop("_p")


def given_relations(concepts: DataFrame) -> Column:
    none = F.array().cast("array<string>")
    return F.filter(F.coalesce(F.col("related_concepts"), none) if "related_concepts" in concepts.columns else none, lambda x: x != "")


def relation_buckets(concepts: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, concept, bucket, counterparts: related_concepts of the record, then its relationships by bucket, each once in order.

    A concept of one row has all of its relations in it, so its buckets are made there; only those of several rows are shuffled.
    """
    key = [*scope, "concept"]
    several = cut(concepts.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*key))
    if several.isEmpty():
        return buckets_in_row(concepts, scope)
    few = maybe_broadcast(several).alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key]
    return buckets_in_row(concepts.alias("l").join(few, same, "left_anti"), scope).unionByName(buckets_over_rows(concepts.alias("l").join(few, same, "left_semi"), scope))


def buckets_in_row(concepts: DataFrame, scope: Sequence[str]) -> DataFrame:
    """relation_buckets of concepts of one row each."""
    known = F.transform(given_relations(concepts), lambda x: F.struct(F.lit("related_to").alias("bucket"), x.alias("counterpart")))
    said = F.transform(F.coalesce(F.col("relationships"), F.array().cast("array<string>")), lambda t: parsed_relation(t, F.col("concept")))
    of = lambda items, b: F.array_distinct(F.transform(F.filter(items, lambda x: x["bucket"] == b), lambda x: x["counterpart"]))
    full = lambda items: F.filter(F.array(*[F.struct(F.lit(b).alias("bucket"), of(items, b).alias("counterparts")) for b in ("related_to", *[b for b, _ in BUCKETS])]), lambda x: F.size(x["counterparts"]) > 0)
    return concepts.select(*scope, "concept", F.inline(let(F.concat(known, said), full)))


def buckets_over_rows(concepts: DataFrame, scope: Sequence[str]) -> DataFrame:
    known = concepts.select(*scope, "concept", F.posexplode(given_relations(concepts)).alias("at", "counterpart")).select(*scope, "concept", F.lit("related_to").alias("bucket"), F.lit(0).alias("of"), "at", "counterpart")
    said = parse_relations(concepts.select(*scope, "concept", F.posexplode("relationships").alias("at", "text"))).select(*scope, "concept", "bucket", F.lit(1).alias("of"), "at", "counterpart")
    key = [*scope, "concept", "bucket"]
    once = known.unionByName(said).groupBy(*key, "counterpart").agg(F.min(F.struct("of", "at")).alias("p"))
    own = once.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("p", "counterpart"))).alias("c"))
    return own.select(*key, F.transform("c", lambda x: x["counterpart"]).alias("counterparts"))


def search(concepts: DataFrame, families: DataFrame, queries: DataFrame, limit: int = 25) -> DataFrame:
    """query, kind, name, rank: concepts, then families, whose names hold the query, in order of name.

    Any number of queries: names meet those whose rarest trigram (or whole query, if it is shorter) they have,
    by equality, and the whole query is looked for in what meets.
    """
    asked = queries.select("query", squeeze(F.lower("query")).alias("_q")).where("_q <> ''").distinct()
    names = concepts.select(F.lit(0).alias("_k"), F.col("concept").alias("name")).unionByName(families.select(F.lit(1).alias("_k"), F.col("label").alias("name"))).distinct()
    parts = cut(with_pieces(names.withColumn("_low", F.lower("name")), "_low", (1, 2, 3)))
    hits = parts.join(rarest_piece(asked, "_q", parts), "_p").where(F.contains("_low", F.col("_q")))
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("_k", "name"))).where(F.col("rank") <= limit)
    return ranked.select("query", F.when(F.col("_k") == 0, "concept").otherwise("family").alias("kind"), "name", "rank")


def overview(concepts: DataFrame, families: DataFrame, blocks: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope and its numbers of concepts, families, blocks and chunks with a concept."""
    c = concepts.groupBy(*scope).agg(F.count(F.lit(1)).alias("concepts"))
    n = concepts.select(*scope, F.explode("source_chunks").alias("x")).groupBy(*scope).agg(F.count_distinct("x").alias("chunks"))
    f = families.groupBy(*scope).agg(F.count_distinct("family_id").alias("families"))
    b = blocks.groupBy(*scope).agg(F.count_distinct("block_index").alias("blocks"))
    return c.join(n, [*scope], "left").join(f, [*scope], "left").join(b, [*scope], "left").na.fill(0)


def family_map(families: DataFrame, concepts: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, family_id, members: from the family table (family_id, members) and from the concepts' own lists (families), in order of name."""
    given = families.select(*scope, "family_id", F.explode("members").alias("concept"))
    own = concepts.select(*scope, F.explode("families").alias("family_id"), "concept")
    return given.unionByName(own.select(given.columns)).groupBy(*scope, "family_id").agg(F.sort_array(F.collect_set("concept")).alias("members"))


def frame_index(frames: DataFrame, concepts: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, concept, frame_id: the last frame (by ord) that names a known concept as member."""
    rows = frames.select(*scope, "ord", "frame_id", F.explode("members").alias("concept")).join(concepts.select(*scope, "concept"), [*scope, "concept"], "left_semi")
    return rows.groupBy(*scope, "concept").agg(F.max_by("frame_id", "ord").alias("frame_id"))


def family_links(edges: DataFrame, members: DataFrame, scope: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(each family's concepts; parent, child links inside it; its roots: concepts without a parent in it, or all if none is); each is made once."""
    fam = [*scope, "family_id"]
    own = cut(members.select(*fam, "concept").distinct())
    inside = cut(own.withColumnRenamed("concept", "parent").join(edges, [*scope, "parent"]).join(own.withColumnRenamed("concept", "child"), [*fam, "child"], "left_semi").where("parent <> child").select(*fam, "parent", "child").distinct())
    below = inside.select(*fam, F.col("child").alias("concept")).distinct()
    roots = cut(own.join(below, [*fam, "concept"], "left_anti"))
    rootless = own.join(roots.select(*fam).distinct(), fam, "left_anti")
    return own, inside, roots.unionByName(rootless)


def family_tree(edges: DataFrame, members: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, family_id, concept, is_root, n_children, depth, ways: the tree as a table, one row a concept of a family.

    ways counts the ways down from the roots, depth is the longest one; both are null on or behind a cycle. Counts go down a level
    at a time, and a concept hands them on once all its parents have, so the work grows with the links, not with the ways. family_tree_paths spells out the
    ways that are asked for.
    """
    fam = [*scope, "family_id"]
    node = [*fam, "concept"]
    own, inside, roots = family_links(edges, members, scope)
    waits = inside.groupBy(*fam, F.col("child").alias("concept")).agg(F.count(F.lit(1)).alias("_waits"))
    # a root of a family without any lies on or behind a cycle
    now = cut(roots.join(waits, node, "left_anti").select(*node, F.lit(1).cast("decimal(38,0)").alias("ways"), F.lit(1).alias("depth")))
    counted, part = [], None
    while not now.isEmpty():
        counted.append(now)
        given = now.withColumnRenamed("concept", "parent").join(inside, [*fam, "parent"]).select(*fam, F.col("child").alias("concept"), "ways", (F.col("depth") + 1).alias("depth"), F.lit(1).cast("long").alias("_got"))
        every = part.unionByName(given) if part is not None else given
        summed = every.groupBy(*node).agg(F.sum("ways").cast("decimal(38,0)").alias("ways"), F.max("depth").alias("depth"), F.sum("_got").alias("_got"))
        met = cut(summed.join(waits, node))
        now, part = met.where("_got = _waits").select(*node, "ways", "depth"), met.where("_got < _waits").select(*node, "ways", "depth", "_got")
    one = own.select(*node).join(roots.withColumn("is_root", F.lit(True)), node, "left")
    kids = inside.groupBy(*fam, F.col("parent").alias("concept")).agg(F.count(F.lit(1)).alias("n_children"))
    none = inside.select(*fam, F.col("child").alias("concept"), F.lit(None).cast("decimal(38,0)").alias("ways"), F.lit(None).cast("int").alias("depth")).limit(0)
    known = reduce(DataFrame.unionByName, counted, none)
    return one.join(kids, node, "left").join(known, node, "left").select(*node, F.coalesce("is_root", F.lit(False)).alias("is_root"), F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "depth", "ways")


def family_tree_paths(edges: DataFrame, members: DataFrame, scope: Sequence[str] = ("doc_id",), starts: DataFrame | None = None) -> DataFrame:
    """scope, family_id, path, depth: every way down from the roots of a family, or from given concepts (starts: scope, family_id, concept), level by level.

    A concept that is on its path already ends it as a leaf. Ways can be very many where lines join (family_tree counts them).
    edges: parent, child; members: family_id, concept.
    """
    fam = [*scope, "family_id"]
    _, inside, roots = family_links(edges, members, scope)
    begin = roots if starts is None else starts.select(*fam, "concept").distinct()
    now = cut(begin.select(*fam, F.array("concept").alias("path"), F.lit(1).alias("depth"), F.lit(True).alias("_open")))
    levels = [now]
    for depth in count(2):  # a path holds a concept once, so it ends
        down = now.where("_open").withColumn("parent", F.element_at("path", -1)).join(inside, [*fam, "parent"])
        now = cut(down.select(*fam, F.concat("path", F.array("child")).alias("path"), F.lit(depth).alias("depth"), (~F.array_contains("path", F.col("child"))).alias("_open")))
        if now.isEmpty():
            break
        levels.append(now)
    return reduce(DataFrame.unionByName, levels).drop("_open")


def evidence_chunks(concepts: DataFrame, chunks: DataFrame, scope: Sequence[str] = ("doc_id",), missing: str = "Chunk summary unavailable.") -> DataFrame:
    """scope, concept, chunk, text of each source chunk, or a placeholder."""
    rows = concepts.select(*scope, "concept", F.explode("source_chunks").alias("chunk"))
    return rows.join(chunks.select(*scope, "chunk", "text"), [*scope, "chunk"], "left").withColumn("text", F.coalesce("text", F.lit(missing))).select(*scope, "concept", "chunk", "text")


def concept_pages(concepts: DataFrame, related: DataFrame, assigned: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, concept, definition (the first), variants (the others), n_terms, n_chunks, families, related (by rank), relations by bucket (related_to, contrasts_with, depends_on, used_in), n_direct.

    n_direct counts families, parents and children (parent_concepts, child_concepts if there) and all relations.
    """
    key = [*scope, "concept"]
    near = related.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "other"))), lambda x: x["other"]).alias("related"))
    fams = assigned.groupBy(*key).agg(F.sort_array(F.collect_set("family_id")).alias("families"))
    names = ("related_to", *[b for b, _ in BUCKETS])
    buckets = relation_buckets(concepts, scope).groupBy(*key).agg(*[F.first(F.when(F.col("bucket") == b, F.col("counterparts")), ignorenulls=True).alias(b) for b in names])
    none = F.array().cast("array<string>")
    lists = lambda c: F.coalesce(F.col(c), none) if c in concepts.columns else none
    one = concepts.select(
        *key, F.get("definitions", F.lit(0)).alias("definition"), F.slice("definitions", 2, F.greatest(F.size("definitions"), F.lit(1))).alias("variants"),
        F.size("terminology").alias("n_terms"), F.size("source_chunks").alias("n_chunks"), (F.size(lists("parent_concepts")) + F.size(lists("child_concepts"))).alias("_n"),
    )
    full = one.join(fams, key, "left").join(near, key, "left").join(buckets, key, "left").withColumns({c: F.coalesce(c, none) for c in ("families", "related", *names)})
    return full.withColumn("n_direct", F.col("_n") + F.size("families") + sum((F.size(b) for b in names), F.lit(0))).drop("_n")


def default_book(books: DataFrame) -> DataFrame:
    """The title with the highest volume number, of equal ones the last by name."""
    volume = F.coalesce(F.nullif(F.regexp_extract("title", r"(?i)vol(?:ume|\.)?\s*([0-9]+)", 1), F.lit("")).cast("int"), F.lit(-1))
    return books.agg(F.max_by("title", F.struct(volume, "title")).alias("title"))


def blocks_for_concepts(blocks: DataFrame, concepts: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, concept, block_index: blocks of a concept's chunks, or whose text names it (its runs of words are joined by equality)."""
    from foliospark.functions.textnorm import surface
    from foliospark.operators.families import ngrams

    names = concepts.select(*scope, "concept", surface(F.col("concept")).alias("_g")).where("_g <> ''")
    longest = names.agg(F.max(F.size(F.split("_g", " ")))).first()[0] or 1
    said = blocks.select(*scope, "block_index", F.explode(ngrams(surface(F.col("text")), 1, longest)).alias("_g"))
    named = names.join(said.hint("merge"), [*scope, "_g"]).select(*scope, "concept", "block_index")
    return block_concepts(blocks, concepts, scope).select(*scope, "concept", "block_index").unionByName(named).distinct()


def merge_concept_maps(concepts: DataFrame, ontology: DataFrame, lists: Sequence[str], scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """scope, concept, display_name, node_kind and the lists of both tables: those of concepts first, each value once.

    The display name is the first that isn't empty; a node_kind other than `concept` from either side counts.
    """
    key = [*scope, "concept"]
    none = F.array().cast("array<string>")
    part = lambda df, n: df.select(*[squeeze(F.lower(c)).alias(c) if c == "concept" else F.col(c) for c in key], F.lit(n).alias("_src"), F.nullif(F.trim("display_name"), F.lit("")).alias("display_name"), "node_kind", *[F.coalesce(F.col(c), none).alias(c) for c in lists])
    rows = part(concepts, 0).unionByName(part(ontology, 1)).where("concept <> ''")
    ordered = lambda c: F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_src", F.col(c).alias("v")))), lambda x: x["v"]))).alias(c)
    name = F.min_by("display_name", F.when(F.col("display_name").isNotNull(), F.col("_src")))
    kind = F.max(F.when(F.col("node_kind") != "concept", F.col("node_kind")))
    return rows.groupBy(*key).agg(F.coalesce(name, F.first("concept")).alias("display_name"), F.coalesce(kind, F.lit("concept")).alias("node_kind"), *[ordered(c) for c in lists])

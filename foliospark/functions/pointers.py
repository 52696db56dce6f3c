"""Pointer doubling: what a chain of successors reaches, in as many rounds as the logarithm of its length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions.lineage import cut


def on_chain(edges: DataFrame, starts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, at: the places that the chains from `starts` (keys, at) come by.

    edges (keys, at, to): each place's only successor, if it has one. After a round each place points twice as far, and the places
    found have doubled; all meet by equality on (keys, at), so a long chain is spread over tasks. They are shuffled: as files of few short columns they look far
    smaller than they are in memory. Chains mustn't have cycles.
    """
    at = [*keys, "at"]
    jumps = cut(edges.where("to IS NOT NULL").select(*at, "to"))
    found = cut(starts.select(*at))
    while not jumps.isEmpty():
        found = cut(found.unionByName(found.join(jumps.hint("merge"), at).select(*keys, F.col("to").alias("at"))))
        jumps = cut(jumps.join(jumps.select(*keys, F.col("at").alias("to"), F.col("to").alias("_far")).hint("merge"), [*keys, "to"]).select(*at, F.col("_far").alias("to")))
    return found

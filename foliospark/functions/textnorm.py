"""Column helpers for text: white space, surfaces, title case, counting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that the rules squeeze, Unicode's spaces included.
SPACES = r"[\s\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\u001C-\u001F]+"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"


#: The same characters, for trimming without a pattern.
SPACE_CHARS = " \t\n\x0b\f\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, (*range(0x2000, 0x200B), *range(0x1C, 0x20))))


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.trim(text, F.lit(SPACE_CHARS))


def squeeze(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def surface(text: Column) -> Column:
    """Lower case, only a-z, 0-9 and single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def holds(text: Column, phrase: Column) -> Column:
    """Whether a surface holds a surface phrase as whole words."""
    return (phrase != "") & F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), phrase, F.lit(" ")))


def is_title_case(text: Column) -> Column:
    """No word begins with a small letter, none has a capital after a letter."""
    return ~text.rlike(r"(^|[^\p{L}])\p{Ll}") & ~text.rlike(r"\p{L}\p{Lu}")


def any_of(text: Column, words: tuple[str, ...]) -> Column:
    """Whether text contains one of some strings."""
    found = F.lit(False)
    for w in words:
        found = found | F.contains(text, F.lit(w))
    return found


def ordered_distinct(items: Column) -> Column:
    """An array of (order…, value) structs as its distinct values, each at its first place."""
    return F.array_distinct(F.transform(F.array_sort(items), lambda x: x["value"]))


def first_of_each(items: Column, kind: str, key: Callable[[Column], Column]) -> Column:
    """The items (of type `kind`) whose key, a text, hasn't come before, in order: one fold, so that items and keys are made once."""
    keyed = F.transform(items, lambda x: F.struct(key(x).alias("k"), x.alias("x")))
    fold = lambda kept, s: F.when(F.exists(kept, lambda o: o["k"] == s["k"]), kept).otherwise(F.array_append(kept, s))
    return F.aggregate(keyed, F.array().cast(f"array<struct<k:string,x:{kind}>>"), fold, lambda kept: F.transform(kept, lambda s: s["x"]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value made once however often the body reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sums_in_row(sizes: Column, block: int = 64) -> Column:
    """For each element of an array of whole numbers the sum of those before it: inside blocks, then over the blocks' totals."""
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    blocks = lambda xs: F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int")), lambda b: total(F.slice(xs, b * block + 1, F.lit(block))))
    begun = lambda xs: F.aggregate(blocks(xs), F.array(F.lit(0).cast("long")), lambda a, t: F.array_append(a, F.element_at(a, -1) + t))
    block_of = lambda i: F.floor(i / block).cast("int")
    return let(sizes, lambda xs: let(begun(xs), lambda b: F.transform(xs, lambda x, i: F.get(b, block_of(i)) + total(F.slice(xs, block_of(i) * block + 1, i % block)))))


def lines_of(text: Column, kept: Callable[[Column], Column]) -> Column:
    """The lines of a text where kept(line) holds: line_no and start_char (from 0), raw; offsets count code points and are found in the row."""
    lines = F.split(text, "\n")
    rows = lambda xs, starts: F.transform(xs, lambda x, i: F.struct(i.alias("line_no"), F.get(starts, i).cast("int").alias("start_char"), x.alias("raw")))
    return F.filter(let(lines, lambda xs: let(sums_in_row(F.transform(xs, lambda x: (F.length(x) + 1).cast("long"))), lambda starts: rows(xs, starts))), lambda r: kept(r["raw"]))

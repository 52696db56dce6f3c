"""Places inside a text, found in the text's own row."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from foliospark.functions.lineage import small_batches

#: Rows of an Arrow batch that is made of texts.
ROWS = 1 << 15


def taken(columns: Sequence[pa.Array], found: Iterable[tuple], target: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of the rows of `columns` that the first numbers of `found` name, with the rest of found beside."""
    found = iter(found)
    while rows := list(islice(found, ROWS)):
        at, *made = zip(*rows)
        own = [c.take(pa.array(at)).cast(f.type) for c, f in zip(columns, target)]
        yield pa.RecordBatch.from_arrays([*own, *[pa.array(c, f.type) for c, f in zip(made, list(target)[len(own) :])]], schema=target)


def within_texts(spans: DataFrame, docs: DataFrame, seen: Sequence[str], find: Callable[[str, list[tuple]], Iterable[tuple]], made: str) -> DataFrame:
    """The spans (doc_id, start_char, end_char, more) that find() names, with the columns `made` of each.

    find(text, rows) gives (number of a row, made...); rows are one text's spans in order of place, as tuples of the columns `seen`. A text is
    shuffled once, beside its short rows, and cut without being gone through from its start.
    """
    columns = ["start_char", "end_char", *[c for c in spans.columns if c not in ("doc_id", "start_char", "end_char")]]
    gathered = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("_rows"))
    both = gathered.hint("merge").join(docs.select("doc_id", "text"), "doc_id").where("text <> ''").select("doc_id", "text", "_rows")
    kind = StructType([*[StructField(c, spans.schema[c].dataType) for c in ("doc_id", *columns)], *StructType.fromDDL(made).fields])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(kind)
        for b in batches:
            ids, texts, lists = b.columns
            begun = [0, *lists.value_lengths().to_numpy(zero_copy_only=False).cumsum().tolist()]
            parts = lists.flatten().flatten()
            owners = pa.array([i for i in range(len(ids)) for _ in range(begun[i + 1] - begun[i])], pa.int64())
            rows = list(zip(*[parts[columns.index(c)].to_pylist() for c in seen]))
            found = ((begun[i] + k, *rest) for i in range(len(ids)) for k, *rest in find(texts[i].as_py(), rows[begun[i] : begun[i + 1]]))
            yield from taken([ids.take(owners), *parts], found, target)

    return small_batches(both).mapInArrow(each, kind)

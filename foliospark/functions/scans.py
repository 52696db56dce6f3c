"""Sequential rules over the rows of one group, many groups to a batch.

Rows of a group (a document's headings, sections or pieces) are gathered into one array, and a function from
a list of dicts to a list of dicts runs over each array of an Arrow batch. A group is one document's short
rows, never its text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from foliospark.functions.lineage import small_batches

Rows = list[dict]


def scan_groups(rows: DataFrame, keys: Sequence[str], scan: Callable[[Rows], Rows], schema: StructType | str) -> DataFrame:
    """The rows that scan() makes of each group's; the group's order is scan's to set."""
    packed = rows.groupBy(*keys).agg(F.collect_list(F.struct(*rows.columns)).alias("_rows")).select("_rows")
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(kind)
        for b in batches:
            out = [r for group in b.column(0).to_pylist() for r in scan(group)]
            yield pa.RecordBatch.from_pydict({f.name: pa.array([r[f.name] for r in out], f.type) for f in target}, target)

    return small_batches(packed).mapInArrow(each, kind)

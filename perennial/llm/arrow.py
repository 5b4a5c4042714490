"""Run a function over Arrow batches and append what it returns as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A slice handed to a function holds about this many bytes, or one row if that is larger.
SLICE_BYTES = 16 << 20


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``limit`` bytes each."""
    if batch.num_rows == 0:
        return
    rows = max(1, int(batch.num_rows * limit / max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def strings(column: pa.Array) -> list[str | None]:
    return column.to_pylist()


def append(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], list],
    fields: list[T.StructField],
    drop: tuple[str, ...] = (),
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """``df`` without ``drop`` and with new columns, one value per row, computed from slices of its batches.

    Columns of ``df`` that bear a new column's name, in any case, are replaced.
    """
    names = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in names and f.name not in drop]
    schema = T.StructType(kept + fields)
    keep = [f.name for f in kept]
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, limit):
                added = function(batch)
                columns = [batch.column(batch.schema.get_field_index(n)) for n in keep]
                columns += [
                    a if isinstance(a, pa.Array) else pa.array(a, type=arrow.field(len(keep) + i).type)
                    for i, a in enumerate(added)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=keep + [f.name for f in fields])

    return df.mapInArrow(run, schema)


def flat_map(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], dict | None],
    schema: T.StructType,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Rows made from slices of batches: ``function`` returns columns by name, or None for no rows."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, limit):
                made = function(batch)
                if made is None:
                    continue
                columns = [
                    made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], type=f.type)
                    for f in arrow
                ]
                yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return df.mapInArrow(run, schema)

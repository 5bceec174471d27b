"""Row-wise Python steps over Arrow batches, in small slices so that memory stays bounded."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

SLICE_ROWS = 256


def map_slices(df: DataFrame, make: Callable[[], Callable[[dict[str, pa.Array]], dict[str, list | pa.Array]]], schema: str,
               slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``mapInArrow`` by columns: ``make()`` runs once a task and returns the function that turns the
    columns of a slice (name -> Arrow array) into the result's columns (lists or Arrow arrays)."""
    struct = _parse_datatype_string(schema)
    assert isinstance(struct, StructType)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                out = step({n: part.column(i) for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


def list_column(values: np.ndarray, sizes: list[int]) -> pa.Array:
    """A list<int32> column of consecutive runs of ``values``."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def runs(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a list column as arrays, without a copy; null is empty."""
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]

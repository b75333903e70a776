"""Arrow batch plumbing for the few operators that are not expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Rows handed to a kernel at once; bounds the Python memory of a task.
SLICE_ROWS = 2000


def map_columns(df: DataFrame, kernel: Callable[..., dict], schema: str, setup: Callable | None = None) -> DataFrame:
    """Runs ``kernel(columns, state)`` over slices of ``df``.

    ``columns`` maps a column name to a Python list; the result maps each column of ``schema`` to a list or array,
    all of one length (not necessarily the input's). ``setup()`` runs once a task and gives ``state``.
    Empty input gives no rows.
    """
    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    arrow = to_arrow_schema(parsed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        ready = False
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                if not ready:
                    state, ready = (setup() if setup else None), True
                out = kernel({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}, state)
                arrays = [pa.array(out[f.name], type=f.type) for f in arrow]
                if len(arrays[0]):
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, parsed)

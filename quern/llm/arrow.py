"""Helpers for operators that must leave the JVM: Arrow batches in, Arrow batches out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def map_rows(df: DataFrame, schema: str, start: Callable[[], Callable[..., Iterator[tuple]]]) -> DataFrame:
    """Each row's columns go, as Python values, to the function that `start` returns once per task; it yields output rows.

    Output leaves in batches of at most 20,000 rows, so a row with many results does not swell memory.
    """
    kind = _parse_datatype_string(schema)
    assert isinstance(kind, StructType)
    arrow = to_arrow_schema(kind)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        out: list[tuple] = []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(len(names))]
            for values in zip(*columns):
                out.extend(function(*values))
                if len(out) >= 20_000:
                    yield _batch(out, arrow)
                    out = []
            if out:
                yield _batch(out, arrow)
                out = []

    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema)

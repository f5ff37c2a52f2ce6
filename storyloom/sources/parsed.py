"""Rows that a Python parser finds in texts, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Texts that are parsed at a time.
SLICE = 100


def column(values: list, kind: pa.DataType) -> pa.Array:
    """An Arrow array of the values; lists of dictionaries go field by field, which takes a fraction of the time."""
    if not (pa.types.is_list(kind) and pa.types.is_struct(kind.value_type)) or any(v is None for v in values):
        return pa.array(values, kind)
    fields = [kind.value_type.field(i) for i in range(kind.value_type.num_fields)]
    flat = pa.StructArray.from_arrays([pa.array([x[f.name] for v in values for x in v], f.type) for f in fields], fields=fields)
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, values))], pa.int32()), flat).cast(kind)


def exploded(rows: DataFrame, text: str, parse: Callable[[str], Iterable[tuple]], fields: str) -> DataFrame:
    """The other columns with ``fields``, a row for each tuple that ``parse`` makes of the text; texts without any give none."""
    kinds = StructType.fromDDL(fields)
    own = rows.drop(text)
    keep = own.columns

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = [(i, x) for i, t in enumerate(part.column(text).to_pylist()) if t for x in parse(t)]
                where = pa.array([i for i, _ in found], pa.int64())
                columns = [part.column(c).take(where) for c in keep]
                columns += [column([x[k] for _, x in found], to_arrow_type(f.dataType)) for k, f in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *kinds.names])

    return rows.select(*keep, text).mapInArrow(run, StructType([*own.schema, *kinds]))

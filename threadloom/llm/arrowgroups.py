"""Groups of rows inside a partition that is sorted by a key, for mapInArrow kernels over many small groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Yields each run of equal keys as a table; holds one run and one batch at a time."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        new = np.zeros(table.num_rows, dtype=bool)
        for k in keys:
            v = table.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1])
    if rest is not None:
        yield rest


def fixed_width(column: pa.ChunkedArray, width: int, dtype) -> np.ndarray:
    """A list column, all of one length and without nulls, as a matrix."""
    values = column.combine_chunks()
    values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)

"""Arrow-batch helpers: numpy on fixed-length arrays inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from alula.schema import DOUBLES


def matrix(column: pa.Array) -> np.ndarray:
    """Equal-length list column as a (rows, length) float matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if not len(column):
        return flat.reshape(0, 0)
    sizes = column.value_lengths()
    if sizes.null_count or len(flat) % len(column) or pc.min_max(sizes)["min"] != pc.min_max(sizes)["max"]:
        raise ValueError("shape mismatch: configurations have different landmark counts")
    return flat.reshape(len(column), -1)


def shape_matrix(batch: pa.RecordBatch, x: str, y: str) -> np.ndarray:
    """Rows x1, y1, x2, y2, ..."""
    a, b = matrix(batch.column(x)), matrix(batch.column(y))
    return np.stack([a, b], axis=2).reshape(len(a), 2 * a.shape[1])


def complex_shapes(batch: pa.RecordBatch, x: str, y: str) -> np.ndarray:
    """Shapes as complex rows x + iy."""
    return matrix(batch.column(x)) + 1j * matrix(batch.column(y))


def list_column(values: np.ndarray) -> pa.Array:
    """(rows, length) matrix as a list column."""
    rows, width = values.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values, dtype=np.float64).ravel()))


def exploded_points(df: DataFrame, keys: Sequence[str], x: str = "ax", y: str = "ay") -> DataFrame:
    """One row per landmark: keys, i, px, py.

    The outer form keeps the optimizer from adding a size filter that would
    evaluate the arrays a second time."""
    points = df.select(*keys, F.posexplode_outer(F.arrays_zip(F.col(x).alias("px"), F.col(y).alias("py"))).alias("i", "pt"))
    return points.select(*keys, "i", "pt.px", "pt.py")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The names wanted, lengthened until no column of the frame has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def append_arrow(
    df: DataFrame,
    fields: Sequence[T.StructField],
    kernel: Callable[[pa.RecordBatch], Sequence[pa.Array]],
    drop: Sequence[str] = (),
) -> DataFrame:
    """The frame's own columns plus columns computed batch by batch.

    Columns in ``drop`` feed the kernel but are not sent back."""
    kept = [f for f in df.schema.fields if f.name not in drop]
    names = [f.name for f in (*kept, *fields)]
    positions = [df.columns.index(f.name) for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                carried = [batch.column(i) for i in positions]
                yield pa.RecordBatch.from_arrays([*carried, *kernel(batch)], names=names)

    return df.mapInArrow(run, T.StructType([*kept, *fields]))


def summed_vectors(
    df: DataFrame, keys: Sequence[str], kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]
) -> DataFrame:
    """Keyed vector sums: one partial row per key and input partition, then a
    hash aggregate over (key, position).

    ``kernel`` folds a whole partition and yields (key values..., count, vector).
    The result has columns keys, ``pos``, ``n`` and ``total``: one row per entry,
    so long vectors and many keys spread over the shuffle partitions."""
    key_fields = [df.schema[k] for k in keys]
    schema = T.StructType([*key_fields, T.StructField("n", T.LongType()), T.StructField("v", DOUBLES)])
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(kernel(batches))
        if rows:
            columns = [pa.array(values, type=field.type) for values, field in zip(zip(*rows), arrow_schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema)

    partial = df.mapInArrow(run, schema)
    exploded = partial.select(*keys, "n", F.posexplode_outer("v").alias("pos", "value"))
    return exploded.groupBy(*keys, "pos").agg(F.sum("n").alias("n"), F.sum("value").alias("total"))


def gathered(sums: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Unkeyed sums on the driver: ``width`` numbers whatever the data size."""
    out = np.zeros(width)
    count = 0
    for row in sums.collect():
        out[row["pos"]] = row["total"]
        count = row["n"]
    return count, out

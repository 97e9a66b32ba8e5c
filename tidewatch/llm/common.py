"""Tables at rest between steps, and text columns as arrays for vectorised work."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import work_dir

#: Texts handled together by one vectorised step. A longer text is a step of its own.
CHUNK_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rest(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage, so a lost executor costs one step, and gives the optimizer the
    table's true size. The folder stays until the session ends.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark, name)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of a string column, each of about ``limit`` bytes."""
    if len(column) == 0:
        return
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = offsets_of(column)[1:] - offsets_of(column)[0]
    start = 0
    while start < len(column):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield column.slice(start, stop - start)
        start = stop


def offsets_of(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    width = np.dtype(kind).itemsize
    raw = column.buffers()[1]
    view = np.frombuffer(raw, kind, len(column) + 1, column.offset * width)
    return view.astype(np.int64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column without nulls as its UTF-8 bytes and the texts' borders."""
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    borders = offsets_of(column)
    data = column.buffers()[2]
    if data is None or borders[-1] == borders[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    view = np.frombuffer(data, np.uint8)[borders[0] : borders[-1]]
    return view, borders - borders[0]


def text_udf(function: Callable[[pa.Array], pa.Array], kind: str, load: Callable | None = None):
    """A column function over texts, called with slices of bounded size.

    Only the text goes to Python; all other columns stay where they are. A null
    text arrives as the empty text. ``load`` builds what a worker needs once.
    """
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        args = (load(),) if load else ()
        for column in columns:
            filled = column.fill_null("")
            parts = [function(part, *args) for part in chunks(filled)]
            yield pa.concat_arrays(parts) if parts else function(filled, *args)

    # Not to be copied into each filter over its result.
    return F.arrow_udf(run, kind).asNondeterministic()


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    borders = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(values, kind))


def segments(counts: np.ndarray) -> np.ndarray:
    """The owner of each element where owner ``i`` has ``counts[i]`` of them."""
    return np.repeat(np.arange(len(counts)), counts)


def segment_sums(
    matrix: np.ndarray, ids: np.ndarray, begin: np.ndarray, counts: np.ndarray
) -> np.ndarray:
    """Sums of ``matrix[ids]`` over short runs: the k-th of every run at once."""
    total = matrix[ids[begin]]
    for k in range(1, int(counts.max(initial=0))):
        longer = np.flatnonzero(counts > k)
        total[longer] += matrix[ids[begin[longer] + k]]
    return total


def hash_unit(*columns: Column) -> Column:
    """A number in [0, 1) that depends on nothing but the given values."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))

"""Helpers shared by the operators on text: tables, scratch folders, and texts of Arrow batches as byte arrays."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: Text bytes that one numpy pass works on; the arrays it makes take about a hundred times as much.
SLICE_BYTES = 1 << 20


#: Largest Arrow batch handed to Python workers, whatever a session asks for: texts vary in length, so rows bound nothing.
BATCH_BYTES = "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; operators on it get batches of bounded size."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the folder that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, folder: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` and read it back: its lineage ends in files that outlive executors."""
    df.write.mode("overwrite").parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of :func:`scratch` through Spark's own file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of steps whose frames are gone: it waits for the driver's collector."""
    gc.collect()
    spark._jvm.System.gc()


@dataclass
class Texts:
    """Some neighbouring rows of one string column: their UTF-8 bytes in a row, and where each row begins and ends."""

    first: int  # row number in the batch
    data: np.ndarray  # uint8
    at: np.ndarray  # int64, one more than rows
    null: np.ndarray  # bool

    def __len__(self) -> int:
        return len(self.null)

    def row(self, i: int) -> bytes:
        return self.data[self.at[i]:self.at[i + 1]].tobytes()


def texts(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """A batch's string column in slices of about ``most`` bytes, without copying; a null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    null = np.asarray(column.is_null())
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, side="right")) - 1)
        yield Texts(lo, data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], null[lo:hi])
        lo = hi


#: Words of digits, letters and everything beyond ASCII, on lower-cased bytes.
WORD_BYTES = np.array([chr(b).isalnum() and b < 128 or b >= 128 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def word_bounds(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true in ``inside``; a run ends where a row does."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(which: str, base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^n modulo 2^64, kept for the next slice."""
    have = _powers.get(which)
    if have is None or len(have) <= n:
        grown = np.full(max(n + 1, 2 * SLICE_BYTES), base, dtype=np.uint64)
        grown[0] = 1
        have = _powers[which] = np.multiply.accumulate(grown)
    return have


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, equal for equal bytes wherever they stand."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, n)[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power("down", _INVERSE, n)[starts])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def arrow(schema, **columns) -> pa.RecordBatch:
    """A batch of ``columns`` in the types and order of an Arrow schema."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema], schema=schema)


def first_by_hash(rows: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` rows with the smallest hash of ``column``: a fixed sample, and the same for any partitioning.

    On a table of far more rows only those below a hash that about 4 k rows undercut are sorted, unless they are too few
    (as when ids repeat); the rows returned are the same either way.
    """
    h = F.xxhash64(column)
    n = rows.count()
    if n > 16 * k:
        near = rows.filter(h < -(2**63) + 2**64 * 4 * k // n)
        if near.count() >= k:
            rows = near
    return rows.orderBy(h, column).limit(k)

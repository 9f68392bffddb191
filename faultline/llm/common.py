"""What the training-data operators share: Arrow stages with bounded batches, stored tables, ids."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.session import new_table_path, ship_package

BATCH_ROWS = 1000
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``most`` bytes, one row at least."""
    if not batch.num_rows:
        return
    step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def arrow_stage(df: DataFrame, make: Callable[[], Callable], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` whose function is built once per task and sees slices of bounded size.

    ``make()`` returns ``step(slice)``, which yields record batches; an optional
    attribute ``step.end`` yields the last ones. Rows per transferred batch are
    bounded too, so a worker never holds many long texts.
    """
    spark = df.sparkSession
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in slices(batch):
                yield from step(part)
        yield from getattr(step, "end", lambda: ())()
        del step
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give the memory of a finished task back, as workers stay for later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: one computation, no long lineage."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def summed(keys: Sequence[np.ndarray], counts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, of many sorted lists, with their summed counts."""
    every, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]][: len(every)])
    return every[first], np.add.reduceat(n[order], first) if len(first) else n

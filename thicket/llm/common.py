"""What the operators of this folder share: scratch tables, Arrow streaming, vectorised word hashes."""

from __future__ import annotations

import atexit
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Rows and bytes after which a Python stage hands its output to Spark.
FLUSH_ROWS, FLUSH_BYTES = 2_000, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`; where that is unset and all run in one process, a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="thicket-")
        atexit.register(shutil.rmtree, found.removeprefix("file://"), ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def save(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/thicket-{uuid.uuid4().hex}"
    df.write.parquet(path)
    saved = spark.read.schema(df.schema).parquet(path)
    saved._scratch_path = path
    return saved


def drop_saved(df: DataFrame) -> None:
    """Delete the files behind a table from `save` that nothing will read again."""
    spark = df.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def unused(name: str, columns: Iterable[str]) -> str:
    """`name`, or the like, that is none of the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """While jobs run in here, Spark reads and hands on at most so many rows at once: for wide rows. The session's own settings come back."""
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, rows)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def give_back() -> None:
    """Free memory back to the system; where the C library has no such call, nothing happens."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def map_rows(df: DataFrame, make: Callable[[], Callable[..., Iterable[tuple]]], schema: str) -> DataFrame:
    """Stream `df` through Python row by row: `make()` runs once a task, its result maps one row's values to output rows.

    Output leaves in small batches, so memory is bounded by one input batch and one row's output.
    """
    out_type = StructType.fromDDL(schema)
    out_schema = arrow_schema(out_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            cols = list(zip(*held, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, out_schema, strict=True)], schema=out_schema)

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for out in each(*row):
                        held.append(out)
                        size += sum(len(x) * (1 if isinstance(x, (str, bytes)) else 8) for x in out if hasattr(x, "__len__"))
                        if len(held) >= FLUSH_ROWS or size >= FLUSH_BYTES:
                            yield flush()
                            held, size = [], 0
        if held:
            yield flush()

    return df.mapInArrow(run, out_type)


def rebuild_rows(df: DataFrame, make: Callable[[], Callable[..., tuple | None]], text_col: str = "text", beside: str | None = None) -> DataFrame:
    """Stream whole rows: `make()` gives a function from the text to the new text in a tuple, or to None where the row goes.

    All other columns pass through untouched, whatever their names. beside: a last column that the function takes too, and that goes.
    """
    where = df.columns.index(text_col)
    given = [where, len(df.columns) - 1] if beside else [where]
    n_out = len(df.columns) - bool(beside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                new = [each(*r) for r in zip(*(part.column(i).to_pylist() for i in given), strict=True)]
                cols = list(part.columns)[:n_out]
                cols[where] = pa.array([t[0] if t is not None else None for t in new], type=cols[where].type)
                yield pa.RecordBatch.from_arrays(cols, schema=pa.schema(list(part.schema)[:n_out])).filter(pa.array([t is not None for t in new]))

    return df.mapInArrow(run, StructType(df.schema.fields[:n_out]))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word (SipHash with a fixed key: the same on every machine)."""
    if not words:
        return np.empty(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of `n` consecutive words."""
    out = np.full(len(hashes) - n + 1, n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : len(hashes) - n + 1 + j])
    return out

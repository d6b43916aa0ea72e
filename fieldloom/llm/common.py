"""Shared pieces: scratch tables, Arrow text access and skew-safe joins."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key with at least 1/HOT_KEYS of the rows is hot, so there are at most HOT_KEYS hot keys.
HOT_KEYS = 1000
#: Text bytes that an Arrow function handles at once.
SLICE_BYTES = 4 << 20


#: Hadoop has no native library here, so on a local folder each new file and folder costs a ``chmod`` process of
#: the executor's JVM, and so would each checksum file.  Parquet pages have checksums of their own, which readers
#: pass over unless told to look.
_NO_CHECKSUM_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
_PAGE_CHECKSUMS = {"parquet.page.verify-checksum.enabled": "true"}


@functools.cache
def _own_root() -> str:
    root = tempfile.mkdtemp(prefix="fieldloom-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Where that is unset, a local session gets a temporary folder; on a cluster, whose executors could
    not see it, this is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_root()


@contextlib.contextmanager
def setting(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (dots written as ``__``) that hold inside the block only."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class Scratch:
    """Parquet tables of one call in the shared folder, which cut the lineage and outlive any executor.

    Leaving the block deletes them all but the results, which readers may still need: those go with the
    session.
    """

    #: Rows and bytes of an Arrow batch, so that long texts fit a Python worker.
    ROWS, BYTES = 2000, 4 << 20

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{scratch_root(spark)}/fieldloom/{name}-{uuid.uuid4().hex}"
        self.tables: set[str] = set()

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop(*self.tables)

    def _path(self, name: str) -> tuple[Any, Any]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _settings(self) -> contextlib.AbstractContextManager[None]:
        rows = min(self.ROWS, int(self.spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        # Once the table stands, nothing reads the shuffle files behind it again.
        return setting(self.spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true", spark__sql__execution__arrow__maxRecordsPerBatch=str(rows), spark__sql__execution__arrow__maxBytesPerBatch=str(self.BYTES))

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.add(name)
        with self._settings():
            df.write.options(**_NO_CHECKSUM_FILES).parquet(f"{self.root}/{name}")
        return self._read(df.schema, name)

    def _read(self, schema: T.StructType, name: str) -> DataFrame:
        return self.spark.read.schema(schema).options(**_PAGE_CHECKSUMS).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            fs, path = self._path(name)
            fs.delete(path, True)
            self.tables.discard(name)

    def result(self, df: DataFrame, name: str = "result") -> DataFrame:
        """Write ``df`` as a table that stays until the session's JVM ends."""
        return self._kept(self.write(df, name), name)

    def _kept(self, out: DataFrame, name: str) -> DataFrame:
        self.tables.discard(name)
        fs, path = self._path(name)
        fs.deleteOnExit(path)
        return out


#: An Arrow function of ``mapInArrow`` and the schema of its rows.
Mapped = tuple[Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], str]


class WorkerScratch(Scratch):
    """Scratch whose files the Python workers write where the shared folder is a local path.

    Hadoop's local file system starts a ``chmod`` for every file and folder that an executor's JVM makes.
    Until such a child runs its own program it shares the JVM's memory, which then counts twice.
    Elsewhere, and for types that Arrow and Spark store differently, Spark writes the table.
    """

    def write(self, df: DataFrame, name: str, then: Mapped | None = None) -> DataFrame:
        """With ``then``, the table of df.mapInArrow(*then); its rows need not go back to the JVM."""
        done = df.mapInArrow(*then) if then else df
        fs, path = self._path(name)
        if fs.getUri().getScheme() != "file" or not _stored_alike(done.schema):
            return super().write(done, name)
        self.tables.add(name)
        folder = fs.makeQualified(path).toUri().getPath()
        parts = f"{folder}/_parts"  # readers pass over names with an underscore
        os.makedirs(folder)
        os.mkdir(parts)
        run, names = then[0] if then else None, done.columns
        with self._settings():
            # Only attempts that succeed give a name; files of others stay behind.
            for row in df.mapInArrow(lambda batches: write_part(run(batches) if run else batches, names, parts), "part string").collect():
                os.rename(f"{parts}/{row.part}", f"{folder}/{row.part}")
        shutil.rmtree(parts, ignore_errors=True)
        return self._read(done.schema, name)

    def result(self, df: DataFrame, name: str = "result", then: Mapped | None = None) -> DataFrame:
        return self._kept(self.write(df, name, then), name)


def _stored_alike(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_stored_alike(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _stored_alike(kind.elementType)
    return kind in (T.BinaryType(), T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType())


def write_part(batches: Iterator[pa.RecordBatch], names: list[str], folder: str, group: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Write the batches as one Parquet file with row groups of about ``group`` bytes; gives its name if there are rows."""
    part = f"part-{uuid.uuid4().hex}.parquet"
    held: list[pa.RecordBatch] = []
    with contextlib.ExitStack() as stack:
        writer, size = None, 0

        def flush() -> None:
            nonlocal writer, size
            table = pa.Table.from_batches(held).rename_columns(names)
            if writer is None:
                writer = stack.enter_context(pq.ParquetWriter(f"{folder}/{part}", table.schema, compression="snappy", write_page_checksum=True))
            writer.write_table(table)
            held.clear()
            size = 0

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
                if size >= group:
                    flush()
        if held:
            flush()
    give_back()
    if writer is not None:
        yield pa.RecordBatch.from_pydict({"part": [part]})


def give_back() -> None:
    """Return freed memory to the system: Spark keeps a Python worker, and what it holds, for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def fresh(columns: list[str], *names: str) -> list[str]:
    """``names``, each lengthened until no column has it (Spark ignores case)."""
    held = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def row_key(*cols: str) -> Column:
    """A 128-bit key of the row's values (null differs from any text)."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in cols]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; nulls are empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches so that each slice has at most ``limit`` text bytes, or one row."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        start, n = 0, batch.num_rows
        while start < n:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(n, max(stop, start + 1))
            yield batch.slice(start, stop - start), data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
            start = stop


def binary_array(values: np.ndarray, width: int) -> pa.Array:
    """Fixed-width rows of a uint8 matrix as a binary Arrow column."""
    n = len(values)
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


@functools.cache
def _poly(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers and inverse powers of an odd base modulo 2**64, and a random value per byte."""
    base = 0x9E3779B97F4A7C15 | 1
    inverse = pow(base, -1, 1 << 64)
    up, down = (np.empty(size + 1, np.uint64) for _ in range(2))
    for out, b in ((up, base), (down, inverse)):
        out[0] = 1
        filled = 1
        while filled <= size:
            take = min(filled, size + 1 - filled)
            out[filled : filled + take] = out[:take] * np.uint64(pow(b, filled, 1 << 64))
            filled += take
    table = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return up, down, table


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads differences over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: int = 1 << 18) -> np.ndarray:
    """64-bit hashes of the spans of ``data`` (starts in order), from prefix sums over chunks of it."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, base + chunk)))
        part = data[base : int(ends[i:j].max())]
        up, down, table = _poly(1 << max(16, len(part).bit_length()))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(table[part] * up[: len(part)], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


def rolling_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all spans of ``width`` bytes, equal to :func:`span_hashes` of them."""
    up, down, table = _poly(1 << max(16, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=sums[1:])
    count = max(0, len(data) - width + 1)
    return mix((sums[width:] - sums[:-width])[:count] * down[:count] + np.uint64(width)) if count else np.zeros(0, np.uint64)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document index) of runs outside ASCII white space; none crosses a document."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    gap = np.empty(len(data) + 2, bool)
    gap[0] = gap[-1] = True
    gap[1:-1] = _SPACE[data]
    first = gap[:-2] & ~gap[1:-1]
    last = gap[2:] & ~gap[1:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    inner = edges[edges > 0]
    first[inner] = ~gap[inner + 1]
    last[inner - 1] = ~gap[inner]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def skew_safe_join(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``facts``, which has one row per key; hot keys cannot swamp a task.

    ``facts[weight]`` counts the rows of a key in ``rows`` and ``total`` their sum, so at most
    ``HOT_KEYS`` keys reach ``total / HOT_KEYS``: those are broadcast, a bound that holds at any
    size.  All other keys go through a shuffled join in which rows of hot keys carry a salt that
    spreads them and matches nothing.  ``how``: "inner" or "left".
    """
    values = [c for c in facts.columns if c not in keys]
    least = max(total / HOT_KEYS, 64)
    h, c, salt = fresh([*rows.columns, *facts.columns], "__hot", "__cold", "__salt")
    hot = facts.where(F.col(weight) >= least).select(*keys, F.struct(*values).alias(h))
    # The salt 0 is computed: the optimiser would take a literal out of the join's keys.
    zero = F.pmod(F.col(weight), F.lit(1)).cast("int")
    cold = facts.where(F.col(weight) < least).select(*keys, zero.alias(salt), F.struct(*values).alias(c))
    out = rows.join(F.broadcast(hot), keys, "left")  # at most HOT_KEYS rows
    spread = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in keys] or keys), F.lit(1 << 20)).cast("int") + 1
    out = out.withColumn(salt, F.when(F.col(h).isNotNull(), spread).otherwise(F.lit(0)))
    out = out.join(cold, [*keys, salt], "left")
    if how == "inner":
        out = out.where(F.col(h).isNotNull() | F.col(c).isNotNull())
    picked = [F.coalesce(F.col(f"{h}.{v}"), F.col(f"{c}.{v}")).alias(v) for v in values]
    return out.select(*rows.columns, *picked)

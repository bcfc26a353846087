"""Helpers shared by the corpus operators: reading tables, shared storage, checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: A table is broadcast only when its counted rows are at most this many, and their summed bytes as well.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names, which all machines share."""
    return f"{ensure_checkpoint_dir(spark)}/dimloom-llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df to shared storage and read it back: lineage ends there, a lost executor costs no recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(column: Column, kind: T.DataType) -> Column:
    """Bytes of a value, of what texts and arrays hold in it as well."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
        size = F.aggregate(column, F.lit(0).cast("long"), lambda n, x: n + width(x, kind.elementType))
    elif isinstance(kind, T.ArrayType):
        size = F.size(column) * 8
    elif isinstance(kind, T.StructType):
        size = sum((width(column[f.name], f.dataType) for f in kind.fields), F.lit(0))
    else:
        size = F.lit(0)
    return F.coalesce(size.cast("long"), F.lit(0).cast("long")) + F.lit(8)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """df, marked for broadcast if one aggregation shows at most `rows` rows of `most` bytes together; as it is otherwise. df should be cheap to count."""
    size = sum((width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0))
    got = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size")).first()
    return F.broadcast(df) if got["n"] <= rows and got["size"] <= most else df


def partitions(df: DataFrame, at_least: int = 1) -> int:
    """The session's shuffle partitions, for explicit repartitioning."""
    return max(at_least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def text_bytes(value: str | None) -> bytes:
    """UTF-8 bytes; null is empty, a lone surrogate (not valid text) becomes '?'."""
    return b"" if value is None else value.encode("utf-8", "replace")


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with at most `most` characters of `column` each (one row at least)."""
    col = batch.column(batch.schema.get_field_index(column))
    lengths = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def parts_of(text: str, most: int = 1 << 20) -> list[str]:
    """A whole text in parts of about `most` characters that end at a space."""
    out, at = [], 0
    while len(text) - at > most:
        end = text.find(" ", at + most)
        if end < 0:
            break
        out.append(text[at:end])
        at = end
    return [*out, text[at:]]


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_R = np.uint64(0x9E3779B97F4A7C15 | 1)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the polynomial's base and of its inverse, kept between calls up to two million."""
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS
    made = []
    for base in (_R, np.uint64(pow(int(_R), -1, 1 << 64))):
        p = np.full(max(n, 1 << 18), base)
        p[0] = 1
        made.append(np.multiply.accumulate(p))
    if n <= 1 << 21:
        _POWERS[:] = made
    return made


def word_hashes(data: np.ndarray, is_space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, first and last byte (exclusive) of every word in a byte array; is_space marks separators by byte value.

    A word's hash is a polynomial of its bytes modulo 2**64 mixed with its length, from prefix sums over the whole array.
    """
    n = len(data)
    if not n:
        e = np.empty(0, np.int64)
        return e.astype(np.uint64), e, e
    sep = is_space[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], sep, [True])).view(np.int8)))
    first, last = edge[0::2], edge[1::2]
    power, back = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    h = (total[last] - total[first]) * back[first]
    return mix64(h + (last - first).astype(np.uint64) * _M2), first, last


def run_hashes(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the runs of `size` words at the given starts, from prefix sums over the whole sequence."""
    power, back = _powers(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=total[1:])
    return mix64((total[starts + size] - total[starts]) * back[starts] + np.full(len(starts), size, np.uint64) * _M2)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the k-word shingles of a word-hash sequence; a shorter sequence is one shingle, an empty one none."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    out = np.full(n - k + 1, np.uint64(k))
    for j in range(k):
        out = out * _M1 + words[j : n - k + 1 + j]
        out ^= out >> np.uint64(29)
    return mix64(out)


_READY: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let tasks import this package: where the workers can't already, Spark's file server hands them a zip of it."""
    sc = spark.sparkContext
    if sc.applicationId in _READY:
        return
    name = __name__.split(".")[0]

    def importable(_: object) -> bool:
        import importlib.util

        return importlib.util.find_spec(name) is not None

    if not sc.parallelize([0], 1).map(importable).first():
        import os
        import shutil
        import tempfile

        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), name), "zip", root, name))
    _READY.add(sc.applicationId)

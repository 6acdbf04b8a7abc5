"""Helpers shared by the corpus operators: table reads, stored intermediates, byte packing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from staylens.session import work_dir

# Rows per Arrow batch handed to Python: texts may be long, so batches stay small.
ARROW_ROWS = 1000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet`` by Spark's reader (works for any file system Spark knows)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read and not a recomputation,
    and fixes values (row numbers, block ids) that a recomputation might change.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_fold(doc_id: str, mod: int):
    """crc32 of the id as text, modulo ``mod`` (null id: null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def xx(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data, 42)


def xx_array(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xx, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Invertible 64-bit finaliser: spreads the bits of combined hashes."""
    x = x.astype(np.uint64, copy=True)
    for shift, mult in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(mult)
    x ^= x >> np.uint64(33)
    return x


def pack(a: np.ndarray) -> bytes:
    """Compressed bytes of an array, its byte planes side by side (small numbers shrink well)."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=3).compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(dtype.itemsize, -1).T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """As ``pack`` for ascending uint64 keys: differences take fewer bytes."""
    return pack(np.diff(keys, prepend=np.uint64(0)) if len(keys) else keys)


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)

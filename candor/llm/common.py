"""Helpers shared by the operators: reliable lineage cuts and byte-level text hashing in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.session import ensure_checkpoint_dir

# Bytes (or code points) of text handled at once inside a task; a longer text is handled alone.
CHUNK = 1 << 20
FILES_PER_SLOT = 6
# Freed batches go back to the system; the default pool of a worker keeps them.
pa.set_memory_pool(pa.system_memory_pool())
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLD = 0x9E3779B97F4A7C15
_BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2^64
_U64 = (1 << 64) - 1


def cut(df: DataFrame, narrow: bool = False) -> DataFrame:
    """Materialise ``df`` in the session's checkpoint folder, which all executors share.

    A ``narrow`` table (keys, edges) is written by at most ``FILES_PER_SLOT`` tasks a slot, not as a file for each shuffle partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if narrow:
        df = df.coalesce(FILES_PER_SLOT * df.sparkSession.sparkContext.defaultParallelism)
    return df.checkpoint(eager=True)


# Rows of two longs: about 40 MB as a hashed relation.
MAX_BROADCAST_KEYS = 1_000_000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def join_keys(big: DataFrame, keys: DataFrame, on: list[str], how: str = "inner", limit: int | None = None) -> DataFrame:
    """Join with a materialised table of keys: broadcast while it has at most ``limit`` rows, else shuffled."""
    few = keys.count() <= (MAX_BROADCAST_KEYS if limit is None else limit)
    return big.join(F.broadcast(keys) if few else keys, on, how)


@contextmanager
def arrow_rows(spark: SparkSession, n: int):
    """At most ``n`` rows in an Arrow batch, for jobs run inside whose rows are large."""
    before = spark.conf.get(_ARROW_ROWS)
    spark.conf.set(_ARROW_ROWS, str(n))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, before)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit constants."""
    k = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(_GOLD)
    return mix(k) | np.uint64(1)


class Powers:
    """``base^i`` and ``base^-i`` modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK + 1)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                p = np.full(size, base, dtype=np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=np.uint64))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def span_hashes(symbol_hash: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``[start, end)`` spans over a sequence of symbol hashes (polynomial, then mixed).

    Equal spans have equal hashes wherever they stand.
    """
    n = len(symbol_hash)
    up, down = POWERS.get(n + 1)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(symbol_hash * up[:n], out=prefix[1:], dtype=np.uint64)
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes, ``n + 1`` byte offsets and a validity mask of an Arrow string column; NULL counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    valid = np.asarray(col.is_valid())
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0], valid


def row_chunks(sizes: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose sizes sum to about ``limit``; a larger row is a range of its own."""
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield lo, hi
        lo = hi

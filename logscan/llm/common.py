"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logscan.session import fresh_dir

# Rows per Arrow batch: bounds a Python worker's memory for rows of very long
# texts (500 texts of 100 KB are 50 MB).
ARROW_ROWS = 500
SLICE_BYTES = 1 << 18  # of text whose words a worker holds at a time: some 50 bytes of arrays each
POSITIVE = (1 << 62) - 1  # hashes are cut to 62 bits so that sums and ranges never overflow


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on (memory only, never results)."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Intermediate tables of one run, in the shared checkpoint folder.

    A written table cuts lineage: later stages and retried tasks reread it,
    so a lost executor never repeats the work before it and every reader
    sees the same rows.
    """

    def __init__(self, spark: SparkSession, kind: str):
        self.spark = tune(spark)
        self.root = fresh_dir(spark, kind)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that no returned DataFrame reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


def positive_hash(*cols) -> Column:
    """A 62-bit non-negative hash of the columns (nulls included)."""
    return F.xxhash64(*cols).bitwiseAND(F.lit(POSITIVE))


def row_hash(df: DataFrame) -> Column:
    """Hash of every column of a row: the last tie-break between rows that
    share all sort keys, so that only rows equal in every column are
    interchangeable."""
    return F.xxhash64(*[F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map" in f.dataType.simpleString()
                        else F.col(f"`{f.name}`") for f in df.schema.fields])


def without(df: DataFrame, names) -> list[str]:
    """Columns of ``df`` except those named like an output column (any case)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


# ------------------------------------------------------------ worker memory
@functools.cache
def _trim():
    """The C library's call that gives freed pages back, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda keep: 0)


def release_memory() -> None:
    """Freed memory goes back to the system.  Python workers live on between
    tasks, and their allocators would keep the most that any task needed."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


@functools.cache
def reuse_memory() -> None:
    """Freed arrays stay with the process for the next ones, not page by page
    with the system: the C library's thresholds are set to the values that its
    own rule ends at."""
    option = getattr(ctypes.CDLL(None), "mallopt", lambda name, value: 0)
    option(-3, 32 << 20)  # M_MMAP_THRESHOLD
    option(-1, 64 << 20)  # M_TRIM_THRESHOLD


def released(run):
    """``run`` over the batches of a partition; its memory is released at the end."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return whole


# ---------------------------------------------------------------- text bytes
ASCII_SPACE = bytes([0x20, *range(0x09, 0x0E)])


def _byte_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = _byte_table(20240131)
_RADIX = np.uint64(0xD1342543DE82EF95)  # odd, so it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(int(_RADIX), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _RADIX), ("down", _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (xor-shift and multiply)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of a slice of texts: arrays of hash, text number, start and end
    byte, in text order; ``data`` holds the lower-cased bytes."""

    __slots__ = ("data", "hash", "doc", "start", "end", "n_docs")

    def __init__(self, data, hashes, doc, start, end, n_docs):
        self.data, self.hash, self.doc, self.start, self.end, self.n_docs = data, hashes, doc, start, end, n_docs

    def bounds(self) -> np.ndarray:
        """Word offsets of the texts: text d has words [bounds[d], bounds[d + 1])."""
        return np.searchsorted(self.doc, np.arange(self.n_docs + 1))


def word_class(separators: bytes) -> np.ndarray:
    """Boolean table of the bytes that belong to words."""
    t = np.ones(256, dtype=bool)
    t[list(separators)] = False
    return t


SPACE_WORDS = word_class(ASCII_SPACE)


def text_slices(arr: pa.Array, slice_bytes: int = SLICE_BYTES):
    """(first row, bytes, text offsets) for runs of rows of about
    ``slice_bytes``; a null text counts as an empty one."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    arr = arr.cast(pa.large_binary())
    if len(arr) == 0:
        return
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], dtype=np.uint8) if offsets[-1] else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(arr):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + slice_bytes, side="right")) - 1)
        lo, hi = int(offsets[first]), int(offsets[last])
        yield first, data[lo:hi], offsets[first:last + 1] - lo
        first = last


def hashed_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Lower-case A-Z, cut words and hash each one, vectorised over all bytes.

    The hash of a word is a polynomial over random 64-bit byte codes, taken
    as a difference of prefix sums (shifted back to position 0) and mixed.
    """
    n_docs = len(offsets) - 1
    data = _LOWER[data]
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = is_word[data]
    starts = inside[:-1].copy()
    starts[1:] &= ~inside[:-2]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    starts[cuts] = inside[cuts]  # a word never runs across two texts
    start = np.flatnonzero(starts)
    ends = inside[:-1] & ~inside[1:]
    before = cuts[cuts > 0] - 1
    ends[before] = inside[before]
    end = np.flatnonzero(ends) + 1
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, hashes, doc, start, end, n_docs)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes."""
    out = np.zeros(max(0, len(hashes) - n + 1), dtype=np.uint64)
    for i in range(n):
        out = mix(out * _RADIX + hashes[i:i + len(out)])
    return out

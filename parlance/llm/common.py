"""Shared pieces of the text operators: Arrow text buffers, vectorised word hashing,
fixed-size membership bitmaps and intermediate tables in the shared folder.

Hashes are 64 bits and depend only on the bytes, so a task that is run again after the
loss of an executor gives the same rows.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.session import ensure_checkpoint_dir, ship_package

#: Bytes of text handled by one numpy pass; one longer text is handled alone, whole.
CHUNK_BYTES = 1 << 20


# ---- Spark side -------------------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stash(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back: cuts the
    lineage in storage that all executors share. The files go when the application ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    out = spark.read.schema(df.schema).parquet(path)
    out._stashed_at = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a ``stash`` that no later step reads."""
    spark = df.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path(df._stashed_at)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow``; when a task ends, its worker, which Spark keeps for later tasks, gives the
    memory that it has freed back to the machine."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            _give_back()

    return df.mapInArrow(run, schema)


def _give_back() -> None:
    for p in (_BYTE_POW, _WORD_POW):
        p.forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


# ---- Arrow text -------------------------------------------------------------------------

def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its offsets (length n + 1); null reads as empty."""
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset:col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes together; a longer row comes alone."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


# ---- hashing ----------------------------------------------------------------------------

_MASK = (1 << 64) - 1
_P, _Q = 0x9E3779B97F4A7C15 | 5, 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values(fold: bool) -> np.ndarray:
    b = np.arange(256, dtype=np.uint64)
    if fold:
        b[65:91] += np.uint64(32)
    return mix((b + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


_VALUES = {fold: _byte_values(fold) for fold in (False, True)}


class _Powers:
    """Powers of an odd base modulo 2^64 and their inverses, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inv = base, pow(base, -1, 1 << 64)
        self.forget()

    def forget(self) -> None:
        """Some 40 MB in a worker once chunks of ``CHUNK_BYTES`` were hashed, made anew in milliseconds."""
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            kept = n <= CHUNK_BYTES + 1  # those of one longer text are not kept beyond it
            size = min(1 << (n - 1).bit_length(), CHUNK_BYTES + 1) if kept else n

            def grow(have: np.ndarray, base: int) -> np.ndarray:
                while len(have) < size:
                    more = have[:size - len(have)]
                    have = np.concatenate([have, more * np.uint64(pow(base, len(have), 1 << 64))])
                return have
            up, down = grow(self.up, self.base), grow(self.down, self.inv)
            if not kept:
                return up, down
            self.up, self.down = up, down
        return self.up, self.down


_BYTE_POW, _WORD_POW = _Powers(_P), _Powers(_Q)


def _range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """Hash of every range [start, end) of ``values``; equal ranges hash alike wherever they lie."""
    n = len(values)
    up, down = powers.get(n + 1)
    c = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=c[1:])
    h = (c[ends] - c[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


#: Separators of `[^\x20\x09-\x0D]+` words.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True


class Words:
    """Runs of bytes outside ``sep`` in every text of a buffer, with a hash each (made when asked for).

    ``starts``/``ends`` are byte positions in the buffer, ``first`` (length n + 1) the index
    of each text's first word. ``fold`` hashes A-Z like a-z.
    """

    def __init__(self, buf: np.ndarray, offs: np.ndarray, sep: np.ndarray = SPACE, fold: bool = False):
        n = len(buf)
        inside = ~sep[buf]
        before = np.zeros(n + 1, bool)
        before[1:] = inside
        bounds = offs[(offs > 0) & (offs < n)]
        after = np.zeros(n + 1, bool)
        after[:n] = inside
        left = before.copy()
        left[bounds] = False
        right = after.copy()
        right[bounds] = False
        self.starts = np.flatnonzero(after & ~left)
        self.ends = np.flatnonzero(before & ~right)
        self.first = np.searchsorted(self.starts, offs)
        self._buf, self._fold = buf, fold

    @cached_property
    def _values(self) -> np.ndarray:
        return _VALUES[self._fold][self._buf]

    @cached_property
    def hash(self) -> np.ndarray:
        return _range_hash(self._values, self.starts, self.ends, _BYTE_POW)

    def gram_starts(self, k: int) -> np.ndarray:
        """Indexes of the words that begin a k-word window inside their own text."""
        n = len(self.starts)
        ok = np.ones(n, bool)
        for a, b in zip(self.first[:-1], self.first[1:], strict=True):
            ok[max(a, b - k + 1):b] = False
        return np.flatnonzero(ok)

    def prefix_hash(self, n: int) -> np.ndarray:
        """Hash of each word's first ``n`` bytes."""
        return _range_hash(self._values, self.starts, np.minimum(self.ends, self.starts + n), _BYTE_POW)

    def range_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the word sequences [start, end) (word indexes)."""
        return _range_hash(self.hash, starts, ends, _WORD_POW)


# ---- fixed-size membership bitmap -------------------------------------------------------

#: Largest bitmap that is broadcast: 2^27 bits = 16 MB. Beyond it only the share of false
#: positives grows, never a result: every use is followed by an exact join.
MAX_BITS_LOG2 = 27
_PIECE = 1 << 16  # bytes of the bitmap in one shuffled row


def bitmap(df: DataFrame, col: str, rows: int) -> np.ndarray:
    """Bitmap of the long column ``col``: two bits a value, about 16 bits for each of ``rows``
    values, 2^27 at most. Tasks send the pieces they touched; the driver gets the final
    bitmap only, whose size is bounded whatever the input's."""
    log2 = min(MAX_BITS_LOG2, max(16, int(np.ceil(np.log2(max(1, rows) * 16)))))
    size = 1 << (log2 - 3)
    step = min(_PIECE, size)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, np.uint8)
        for b in batches:
            set_bits(bits, b.column(0).drop_null().to_numpy(zero_copy_only=False))
        for i in np.flatnonzero(bits.reshape(-1, step).any(axis=1)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(i)], pa.int32()), pa.array([bits[i * step:(i + 1) * step].tobytes()])], ["i", "b"])

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.frombuffer(x, np.uint8)
                have[i] = have[i] | x if i in have else x
        for i, x in have.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([x.tobytes()])], ["i", "b"])

    pieces = map_arrow(df.select(F.col(col).cast("long")), part, "i int, b binary")
    merged = map_arrow(pieces.repartition(max(1, min(64, size // step)), "i"), union, "i int, b binary")
    out = np.zeros(size, np.uint8)
    for r in merged.collect():
        out[r["i"] * step:r["i"] * step + step] = np.frombuffer(r["b"], np.uint8)
    return out


def _positions(size: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(values.astype(np.int64).view(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    m = np.uint64(size * 8 - 1)
    return (h & m).astype(np.int64), ((h >> np.uint64(32)) & m).astype(np.int64)


def set_bits(bits: np.ndarray, values: np.ndarray) -> None:
    for p in _positions(len(bits), values):
        np.bitwise_or.at(bits, p >> 3, (1 << (p & 7)).astype(np.uint8))


def has_bits(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    a, b = _positions(len(bits), values)
    return ((bits[a >> 3] >> (a & 7)) & (bits[b >> 3] >> (b & 7)) & 1).astype(bool)


# ---- classifier sample and logistic fit -------------------------------------------------

def fold_of(col: str, mod: int):
    """crc32 of the id as text, modulo ``mod`` (the contract's folds); a null id is fold of ''."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % F.lit(mod)

"""Operator 3, byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1: a minimal perfect hash over the vocabulary (hash and displace: one displacement per
bucket, one slot per token, no empty slot) resolves whole pre-tokens that are tokens; the
stored bytes are compared, so a foreign piece never passes. Tier 2: other pieces are merged
by rank with a heap over linked bytes. Decoding looks the ids up in the vocabulary and joins
the bytes.

Edge cases: a null text encodes like an empty one (no ids, empty bytes); null ids decode to
empty bytes; an unknown id raises; repeated rows give repeated rows; an empty table gives an
empty result. Other columns are passed through or not read, so they never clash.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import chunks, map_arrow, mix, text_buffer
from parlance.llm.pieces import Memo, class_table, pieces

#: Pieces in each of the memo's two generations, about 50 MB a worker together.
MEMO_PIECES = 1 << 17
#: Bytes of text encoded at a time: its pieces are Python strings, some 50 bytes of memory a byte of text.
ENCODE_BYTES = 1 << 18
#: Mean keys per bucket of the perfect hash.
BUCKET_LOAD = 2


def read_ranks(data: bytes) -> list[bytes]:
    """Token bytes by id from the content of a rank file (base64 token, id)."""
    pairs = sorted((int(i), base64.b64decode(t)) for t, i in (x.split() for x in data.splitlines() if x.strip()))
    if [i for i, _ in pairs] != list(range(len(pairs))):
        raise ValueError("token ids must run from 0 without gaps")
    return [t for _, t in pairs]


def _hash(keys: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)


class PerfectHash:
    """Minimal perfect hash of distinct byte strings: ``slot`` is a bijection onto 0..n-1."""

    def __init__(self, keys: list[bytes]):
        h = _hash(keys)
        if len(np.unique(h)) != len(keys):
            raise ValueError("keys must be distinct")
        n = self.n = len(keys)
        self.buckets = max(1, n // BUCKET_LOAD)
        self.shift = np.zeros(self.buckets, np.int64)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        taken = np.zeros(n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            k = sizes[b]
            if k < 2:
                break
            own = h[order[begin[b]:begin[b] + k]]
            first, found = 1, False
            while not found:
                d = np.arange(first, first + 64, dtype=np.uint64)
                s = self._place(own[None, :], d[:, None])
                good = ~taken[s].any(axis=1)
                good &= (np.diff(np.sort(s, axis=1), axis=1) > 0).all(axis=1)
                if good.any():
                    i = int(np.argmax(good))
                    self.shift[b] = int(d[i])
                    taken[s[i]] = True
                    found = True
                first += 64
        free = iter(np.flatnonzero(~taken))
        for b in np.flatnonzero(sizes == 1):  # a lone key takes a free slot: stored as -1 - slot
            self.shift[b] = -1 - int(next(free))
        self.key_of = np.empty(n, np.int64)
        self.key_of[self._slots(h)] = np.arange(n)

    def _place(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        return (mix(h + d * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    def _slots(self, h: np.ndarray) -> np.ndarray:
        d = self.shift[(h % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(d < 0, -1 - d, self._place(h, np.maximum(d, 0).astype(np.uint64)))

    def candidates(self, keys: list[bytes]) -> np.ndarray:
        """The one key index each string could have; the caller compares the bytes."""
        return self.key_of[self._slots(_hash(keys))]


class Codec:
    """Encoder and decoder over a vocabulary."""

    def __init__(self, vocab: list[bytes], perfect: PerfectHash, classes: np.ndarray):
        self.vocab, self.perfect, self.classes = vocab, perfect, classes
        self.rank = {t: i for i, t in enumerate(vocab)}
        self.memo = Memo(lambda p: self._learn([p])[0], limit=MEMO_PIECES)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece that is no token: heap over linked bytes, lowest rank first."""
        n = len(piece)
        rank = self.rank.get
        end = list(range(1, n + 1))  # a live part starts at i and ends at end[i], the next one's start
        before = list(range(-1, n - 1))
        bits = (n + 1).bit_length()
        low = (1 << bits) - 1
        heap = [(r << bits | i) << bits | i + 2 for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i, stop = top >> bits & low, top & low
            j = end[i]
            if not 0 <= j < n or end[j] != stop:  # a part that was merged away ends at -1
                continue
            end[i], end[j] = stop, -1
            if stop < n:
                before[stop] = i
                if (r := rank(piece[i:end[stop]])) is not None:
                    heappush(heap, (r << bits | i) << bits | end[stop])
            h = before[i]
            if h >= 0 and (r := rank(piece[h:stop])) is not None:
                heappush(heap, (r << bits | h) << bits | stop)
        out, i = [], 0
        while i < n:
            out.append(self.rank[piece[i:end[i]]])
            i = end[i]
        return out

    def _learn(self, new: list[bytes]) -> list[bytes]:
        """Ids (int32 bytes) of pieces: the perfect hash first, the merges for the misses."""
        return [pack("i", i) if self.vocab[i] == p else np.array(self.merge(p), np.int32).tobytes()
                for p, i in zip(new, self.perfect.candidates(new).tolist(), strict=True)]

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of a buffer."""
        cut, first = pieces(buf, offs, self.classes)
        memo = self.memo
        new = [p for p in set(cut) if p not in memo and p not in memo.old]
        long = {}
        if new:
            for p, ids in zip(new, self._learn(new), strict=True):
                if len(p) > memo.longest:
                    long[p] = ids
                else:
                    memo.keep(p, ids)
        get = memo.__getitem__ if not long else (lambda p: long[p] if p in long else memo[p])
        first = first.tolist()
        return [np.frombuffer(b"".join(map(get, cut[a:b])), np.int32) for a, b in zip(first[:-1], first[1:], strict=True)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))


@contextmanager
def _codec(shared) -> Iterator[Codec]:
    """A codec for one task: nothing of it, nor of the pieces it has learnt, stays in the worker."""
    codec = Codec(*shared.value)
    try:
        yield codec
    finally:
        codec.memo.forget()


@lru_cache(maxsize=2)
def _tables(ranks: bytes) -> tuple[list[bytes], PerfectHash, np.ndarray]:
    vocab = read_ranks(ranks)
    return vocab, PerfectHash(vocab), class_table()


def _ship(df: DataFrame, ranks: bytes):
    """Vocabulary, perfect hash and class table: about 3 MB, bounded by the rank file."""
    return df.sparkSession.sparkContext.broadcast(_tables(ranks))


def encode(docs: DataFrame, ranks: bytes, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, ids array<int>) of every row; ``ranks`` is the content of the rank file. With ``decoded``
    the ids are decoded in the same pass, to the column ``decoded`` binary."""
    shared = _ship(docs, ranks)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(shared) as codec:
            for b in batches:
                raw, offs = text_buffer(b.column(1))
                for lo, hi in chunks(offs, ENCODE_BYTES):
                    rows = codec.encode(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
                    cols = [b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))]
                    if decoded:
                        cols.append(pa.array([codec.decode(ids.tolist()) for ids in rows], pa.binary()))
                    yield pa.RecordBatch.from_arrays(cols, ["id", "ids", "decoded"][:len(cols)])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return map_arrow(src, run, f"id {id_type}, ids array<int>" + ", decoded binary" * decoded).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks: bytes, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds ``out_col`` binary: the bytes of the ids of each row; all other columns stay."""
    shared = _ship(encoded, ranks)
    k = encoded.columns.index(ids_col)
    names = [*encoded.columns, out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(shared) as codec:
            for b in batches:
                out = [codec.decode(ids.values.to_numpy().tolist()) if ids.is_valid else b"" for ids in b.column(k)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return map_arrow(encoded, run, f"{fields}, `{out_col}` binary")


def digests(decoded: DataFrame, id_col: str = "doc_id", extra: tuple | list = ()) -> DataFrame:
    """The query's columns from the operator's ids and bytes."""
    return decoded.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *extra)

"""Operator 11, SimHash near-duplicates by bit-sliced comparison.

A text's fingerprint has bit b set if more than half of its 3-word shingles (repeats included)
have it set in their XXH64. Two fingerprints are linked at ``RADIUS`` or fewer differing bits.

1. Equal fingerprints are one class; only classes are compared, so a large group of copies costs
   one row.
2. The 64 bits are four blocks. Linked fingerprints differ in two bits at most and so agree on two
   blocks at least: each class is sent to the six buckets of its pairs of blocks. A bucket of more
   than ``SPLIT`` classes is cut finer in the same way: of the 32 bits left, four blocks of eight,
   two of which agree. Then 48 bits are fixed, so such a bucket has 65,536 classes at most. Nothing
   is left out: the linked pairs of a bucket meet in a finer one.
3. In a task, the classes of many buckets lie side by side as lanes: one bit plane for each bit,
   64 lanes a word. The lanes are compared with those ``t`` places further on, for every t up to
   the largest bucket less one: planes are combined by exclusive or, and a carry-save counter
   (a ones and a twos plane and one for "beyond") adds them up for all lanes at once. After every
   eight planes the words whose lanes are all beyond the radius, or in different buckets, are
   abandoned.
4. Each bucket gives a star for each of its connected parts (linear in its size), and the
   components of all stars are the result. No link between different fingerprints is lost.

Edge cases: a null or wordless text has fingerprint zero and is linked like any other; a text of one
or two words has one shingle, the whole sequence; a row with a null id is linked like others but
names no component (a component of such rows only has a null name); repeated rows give repeated
rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import chunks, map_arrow, stash, text_buffer
from parlance.llm.graph import components

GRAM = 3
SEED = 42
RADIUS = 2
#: Classes of a bucket beyond which it is cut finer.
SPLIT = 4096
#: Rows that a task compares at a time, besides the rest of the last bucket.
LANES = 1 << 16
_STEP = 8  # planes between two looks at what is still within the radius


def _shingle_hashes(text: bytes) -> np.ndarray:
    words = text.lower().split()  # of bytes: folds A-Z only, splits at \x20 and \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(GRAM, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[:len(starts) - k].tolist(), ends[k:].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, len(words) - k)


def fingerprints_of(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Fingerprint of each text of a buffer."""
    rows = [_shingle_hashes(raw[a:b].tobytes()) for a, b in zip(offs[:-1], offs[1:], strict=True)]
    sizes = np.array([len(r) for r in rows], np.int64)
    out = np.zeros(len(rows), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        bits = np.unpackbits(np.concatenate(rows).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begin = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
        ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
        major = (2 * ones > sizes[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the 64-bit fingerprint of every row, as a long."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = text_buffer(b.column(1))
            for lo, hi in chunks(offs):
                fp = fingerprints_of(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(fp.view(np.int64))], ["id", "fp"])

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), run, f"id {id_type}, fp long")


# ---- bit-sliced comparison --------------------------------------------------------------

def _planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of 64-bit values: row b holds bit b of every value, 64 lanes a word; two words of
    zeros follow, so that lanes beyond the end can be read."""
    n = len(values)
    words = -(-n // 64) + 2
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little").T
    lanes = np.zeros((64, words * 64), np.uint8)
    lanes[:, :n] = bits
    return np.packbits(lanes, axis=1, bitorder="little").view("<u8")


def _lanes(mask: np.ndarray, words: int) -> np.ndarray:
    full = np.zeros(words * 64, np.uint8)
    full[:len(mask)] = mask
    return np.packbits(full, bitorder="little").view("<u8")


def near_pairs(group: np.ndarray, values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b), a < b, of one group (equal neighbours in ``group``) whose values differ in
    ``radius`` bits at most; ``radius`` up to 3, the range of the counter."""
    if not 0 <= radius <= 3:
        raise ValueError("the counter tells distances up to 3")
    n = len(values)
    change = np.flatnonzero(group[1:] != group[:-1]) + 1 if n else np.zeros(0, np.int64)
    end = np.repeat(np.append(change, n), np.diff(np.concatenate([[0], change, [n]])))
    after = end - np.arange(n) - 1  # lanes further on in the same group
    planes = _planes(values)
    # planes on which neighbours differ more often abandon lanes sooner; the order changes no result
    order = np.argsort([-int(np.bitwise_count(p ^ (p >> np.uint64(1))).sum()) for p in planes], kind="stable")
    planes = planes[order]
    left, right = [], []
    for t in range(1, int(after.max(initial=0)) + 1):
        far, off = divmod(t, 64)
        live = after >= t
        at = np.unique(np.flatnonzero(live) >> 6)
        alive = _lanes(live, planes.shape[1])[at]
        one, two, beyond = (np.zeros(len(at), np.uint64) for _ in range(3))
        for k in range(0, 64, _STEP):
            part = planes[k:k + _STEP]
            moved = part[:, np.minimum(at + far, planes.shape[1] - 1)]
            if off:
                moved = (moved >> np.uint64(off)) | (part[:, np.minimum(at + far + 1, planes.shape[1] - 1)] << np.uint64(64 - off))
            for x in part[:, at] ^ moved:
                carry = one & x
                one = one ^ x
                beyond = beyond | (two & carry)
                two = two ^ carry
            over = beyond | ((two if radius == 1 else two & one) if radius in (1, 2) else (one | two) if radius == 0 else np.uint64(0))
            within = alive & ~over
            stay = within != 0
            if not stay.any():
                at = at[:0]
                break
            if not stay.all():
                at, alive, one, two, beyond = at[stay], alive[stay], one[stay], two[stay], beyond[stay]
                within = within[stay]
        if len(at):
            hit = np.unpackbits(within.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            w, lane = np.nonzero(hit)
            a = at[w] * 64 + lane
            left.append(a)
            right.append(a + t)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows is connected with by the pairs."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def stars(buckets: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): stars over the linked values of each bucket of (key, fp). A task holds ``LANES`` rows
    and one bucket; buckets are bounded by what their key fixes."""
    def compare(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        a, b = near_pairs(key, fp.view(np.uint64), radius)
        low = _smallest(len(fp), a, b)
        other = np.flatnonzero(low != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[other]), pa.array(fp[low[other]])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, held = [], [], 0
        for b in batches:
            keys.append(b.column(0).to_numpy())
            fps.append(b.column(1).to_numpy())
            held += len(b)
            if held >= LANES:
                key, fp = np.concatenate(keys), np.concatenate(fps)
                cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
                if cut:
                    yield compare(key[:cut], fp[:cut])
                keys, fps, held = [key[cut:]], [fp[cut:]], len(key) - cut
        if held:
            yield compare(np.concatenate(keys), np.concatenate(fps))

    rows = buckets.repartition("key").sortWithinPartitions("key", "fp").select("key", "fp")
    return map_arrow(rows, run, "u long, v long")


def _bits(col, at: int, n: int):
    return F.shiftrightunsigned(col, at).bitwiseAND(F.lit((1 << n) - 1))


_PAIRS = [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]


def _coarse(fp):
    """The six keys of 32 bits: number of the pair, then its two blocks."""
    return F.array(*[
        F.lit(c << 32).bitwiseOR(F.shiftleft(_bits(fp, 16 * i, 16), 16)).bitwiseOR(_bits(fp, 16 * j, 16)) for c, (i, j) in enumerate(_PAIRS)])


def _fine(fp, key):
    """The six keys below a coarse one, which add two of the four 8-bit blocks left."""
    out = F.lit(None).cast("array<long>")
    for c, pair in enumerate(_PAIRS):
        k, m = (x for x in range(4) if x not in pair)
        blocks = [_bits(fp, 16 * k, 8), _bits(fp, 16 * k + 8, 8), _bits(fp, 16 * m, 8), _bits(fp, 16 * m + 8, 8)]
        keys = F.array(*[F.shiftleft(key, 20).bitwiseOR(F.lit(d + 1 << 16)).bitwiseOR(F.shiftleft(blocks[i], 8)).bitwiseOR(blocks[j])
                         for d, (i, j) in enumerate(_PAIRS)])
        out = F.when(F.shiftrightunsigned(key, 32) == c, keys).otherwise(out)
    return out


def buckets(classes: DataFrame, split: int = SPLIT) -> DataFrame:
    """(key, fp): every class in the buckets in which it can meet a linked one. Buckets of one class
    are dropped; those of more than ``split`` are cut finer."""
    keyed = classes.select("fp", F.explode(_coarse(F.col("fp"))).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    met = keyed.join(sizes, "key")
    return met.select("fp", F.explode(
        F.when(F.col("m") <= split, F.array(F.shiftleft("key", 20))).otherwise(_fine(F.col("fp"), F.col("key")))).alias("key"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split: int = SPLIT) -> DataFrame:
    """(id, fingerprint, component_id) of every row: 16 lowercase hex digits, and the smallest id that
    is reachable by links."""
    signed = stash(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = stash(signed.groupBy("fp").agg(F.min("id").alias("low")), "classes")
    linked = components(stars(buckets(classes, split)))
    named = stash(classes.join(linked.withColumnRenamed("k", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("c", "fp").alias("c")), "named")
    low = stash(named.groupBy("c").agg(F.min("low").alias("component_id")), "lowest")
    names = stash(named.join(low, "c").select("fp", "component_id"), "components")
    return signed.join(names, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

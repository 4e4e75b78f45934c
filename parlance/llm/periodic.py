"""Operator 13, periodic run detection with an enhanced suffix array.

A run is a maximal stretch of words with smallest period q (words q apart are equal). Each run
of two periods or more ends in one branching square: the last 2q words of it, whose next word,
if any, breaks the period. All branching squares of a text are found without a suffix tree:

1. Suffix array by prefix doubling (only suffixes that are still tied are sorted again), its
   inverse, and the LCP array from the irreducible values in text order.
2. LCP intervals: for every LCP value the nearest smaller ones to both sides. The boundaries of
   one interval cut it into children.
3. Each suffix i of a child that is not the largest one of its interval (of depth d) is tested:
   is the suffix at i + d or at i - d in the interval, by the inverse suffix array? If it is,
   and the words after the two halves differ, a branching square of period d is there. Taking
   the smaller children only bounds the tests by n log n.
4. A square is rotated to the left while the period holds, which gives the run. Squares with
   one right end are taken by period, and those that a shorter period explains are dropped, so
   every run comes once, with its smallest period.

All texts of a chunk are handled together in numpy, as one array in which suffixes of different
texts never compare as equal. Words are told apart by 64-bit hashes. Nothing is shuffled; a task
holds a chunk of about 1 MB of text, or one longer text, whole.

Edge cases: null, empty and wordless texts have no words, no runs and an empty collapsed text;
repeated rows give repeated rows; an empty table gives an empty result; a null id passes
through; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import Words, chunks, map_arrow, text_buffer

#: A run has at least so many words and so many periods.
MIN_LENGTH = 6
MIN_PERIODS = 4
#: Words compared at a time in the steps that follow equal words.
_CELLS = 1 << 21


def _agreeing(sym: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, way: int = 1) -> np.ndarray:
    """Number of equal symbols from positions ``a`` and ``b`` on (``way`` -1: backwards), at most ``room``."""
    out = np.zeros(len(a), np.int64)
    live, width = np.flatnonzero(room > 0), 4
    while len(live):
        width = max(1, min(width, _CELLS // len(live)))
        step = np.arange(width)
        at = out[live]
        inside = step < (room[live] - at)[:, None]
        step = way * np.minimum(step, (room[live] - at - 1)[:, None])
        same = (sym[(a[live] + way * at)[:, None] + step] == sym[(b[live] + way * at)[:, None] + step]) & inside
        whole = same.all(axis=1)
        out[live] += np.where(whole, width, np.argmin(same, axis=1))
        live = live[whole]
        live = live[out[live] < room[live]]
        width = min(2 * width, 512)
    return out


def suffix_array(sym: np.ndarray, text: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of each text in order (text after text) and the inverse. ``text`` is each word's
    text, ascending, ``stop`` where that text ends."""
    n = len(sym)
    key = text * (int(sym.max()) + 1) + sym
    sa = np.argsort(key, kind="stable")
    where = np.arange(n)
    rank = np.empty(n, np.int64)
    found, width = key[sa], 1
    spots = where
    while True:
        head = np.ones(len(spots), bool)
        head[1:] = found[1:] != found[:-1]
        rank[sa[spots]] = spots[np.maximum.accumulate(np.where(head, where[:len(spots)], 0))]
        alone = head.copy()
        alone[:-1] &= head[1:]
        spots = spots[~alone]  # ties of the first ``width`` words
        if not len(spots):
            return sa, rank
        suffix = sa[spots]
        after = suffix + width
        order = rank[suffix] * (n + 1) + np.where(after < stop[suffix], rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(order, kind="stable")
        sa[spots] = suffix[by]
        found = order[by]
        width *= 2


def lcp_array(sym: np.ndarray, sa: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Common words of each suffix with the one before it in the array (0 for a text's first)."""
    n = len(sym)
    before = np.full(n, -1, np.int64)
    tied = start[sa[1:]] == start[sa[:-1]]
    before[sa[1:][tied]] = sa[:-1][tied]
    here = np.arange(n)
    # a value follows from the one at the word before, less one, if the words to the left agree
    follows = (before > start) & (here > start)
    follows[follows] = sym[here[follows] - 1] == sym[before[follows] - 1]
    free = np.flatnonzero(~follows & (before >= 0))
    value = np.zeros(n, np.int64)
    value[free] = _agreeing(sym, free, before[free], stop[free] - np.maximum(free, before[free]))
    source = np.maximum.accumulate(np.where(follows, 0, here))
    return (value[source] - (here - source))[sa]


def _smaller(lcp: np.ndarray, at: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For each position of ``at``: the nearest position to the left with a smaller value, and the
    nearest to the right (or the length), by steps of falling powers of two."""
    n = len(lcp)
    low = [lcp.astype(np.int32)]
    while 2 << (len(low) - 1) <= min(reach, n):
        half = 1 << (len(low) - 1)
        low.append(np.minimum(low[-1][:-half], low[-1][half:]))
    value = low[0][at]
    left, right = at.copy(), at + 1
    for k in range(len(low) - 1, -1, -1):
        size, least = 1 << k, low[k]
        ok = left >= size
        ok[ok] = least[left[ok] - size] >= value[ok]
        left[ok] -= size
        ok = right + size <= n
        ok[ok] = least[right[ok]] >= value[ok]
        right[ok] += size
    return left - 1, right


def branching_squares(sym: np.ndarray, text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end, period) of every branching square, by end, then period."""
    sa, rank = suffix_array(sym, text, stop)
    lcp = lcp_array(sym, sa, start, stop)
    cut = np.flatnonzero(lcp)  # boundaries inside LCP intervals of depth 1 and more
    if not len(cut):
        return cut, cut
    lo, hi = _smaller(lcp, cut, int((stop - start).max()))
    depth = lcp[cut]
    by = np.lexsort((cut, depth, lo))
    cut, lo, hi, depth = cut[by], lo[by], hi[by], depth[by]
    first = np.ones(len(cut), bool)
    first[1:] = (lo[1:] != lo[:-1]) | (depth[1:] != depth[:-1])
    last = np.append(first[1:], True)
    own = np.cumsum(first) - 1
    # children: from each boundary to the next one of its interval, and before the first
    follow = np.where(last, hi, np.append(cut[1:], 0))
    c_lo = np.concatenate([lo[first], cut])
    c_hi = np.concatenate([cut[first], follow])
    c_of = np.concatenate([own[first], own])
    size = c_hi - c_lo
    big = np.lexsort((-size, c_of))
    lead = np.ones(len(big), bool)
    lead[1:] = c_of[big][1:] != c_of[big][:-1]
    small = big[~lead]  # all children but the largest of each interval
    lo, hi, depth = lo[first], hi[first], depth[first]
    ends, periods = [], []
    for a in _portions(size[small]):
        part = small[a]
        n = size[part]
        idx = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(c_lo[part], n)
        own = np.repeat(c_of[part], n)
        i, d = sa[idx], depth[own]
        for j, ok, e in ((i + d, i + d < stop[i], i + 2 * d), (i - d, i - d >= start[i], i + d)):
            j, d_, e, own_, i_ = j[ok], d[ok], e[ok], own[ok], i[ok]
            there = (rank[j] >= lo[own_]) & (rank[j] < hi[own_])
            d_, e, i_ = d_[there], e[there], i_[there]
            ends_here = e == stop[i_]
            breaks = ends_here | (sym[np.minimum(e, len(sym) - 1)] != sym[e - d_])
            ends.append(e[breaks])
            periods.append(d_[breaks])
    end, period = np.concatenate(ends), np.concatenate(periods)
    by = np.lexsort((period, end))
    end, period = end[by], period[by]
    new = np.ones(len(end), bool)
    new[1:] = (end[1:] != end[:-1]) | (period[1:] != period[:-1])
    return end[new], period[new]


def _portions(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of about ``_CELLS`` elements together."""
    done = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + _CELLS, "right")))
        yield slice(a, b)
        a = b


def runs(sym: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """(start, length, period) of every run, by start, then period, as rows; positions in the whole
    array. ``first`` holds the texts' first words and the length of the array."""
    n = len(sym)
    if n == 0:
        return np.zeros((0, 3), np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start, stop = first[:-1][text], first[1:][text]
    end, period = branching_squares(sym, text, start, stop)
    out = []
    while len(end):
        head = np.ones(len(end), bool)
        head[1:] = end[1:] != end[:-1]
        e, p = end[head], period[head]
        begin = e - 2 * p
        begin -= _agreeing(sym, begin - 1, begin + p - 1, begin - start[e - 1], -1)
        out.append(np.stack([begin, e - begin, p], axis=1))
        of = np.cumsum(head) - 1
        rest = ~head & ~((period % p[of] == 0) & (end - 2 * period >= begin[of]))
        end, period = end[rest], period[rest]
    found = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
    found = found[found[:, 1] >= np.maximum(min_length, min_periods * found[:, 2])]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
           min_periods: int = MIN_PERIODS) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row: the runs by start, then period, as word numbers,
    and the words left, joined by one blank, when of every run only the first period stays."""
    if min_periods < 2:
        raise ValueError("a run has two periods at least")
    id_type = docs.schema[id_col].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = text_buffer(b.column(1))
            for lo, hi in chunks(offs):
                words = Words(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                first = words.first
                sym = pa.array(words.hash).dictionary_encode().indices.to_numpy().astype(np.int64)
                found = runs(sym, first, min_length, min_periods)
                gone = np.zeros(len(sym) + 1, np.int64)
                np.add.at(gone, found[:, 0] + found[:, 2], 1)
                np.add.at(gone, found[:, 0] + found[:, 1], -1)
                keep = np.cumsum(gone[:-1]) == 0
                cut = np.searchsorted(found[:, 0], first)
                left = []
                for d in range(hi - lo):
                    parts = raw[offs[lo + d]:offs[lo + d + 1]].tobytes().split()
                    if cut[d] < cut[d + 1]:
                        parts = compress(parts, keep[first[d]:first[d + 1]].tolist())
                    left.append(b" ".join(parts))
                found[:, 0] -= np.repeat(first[:-1], np.diff(cut))
                rows = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in found.T], fields=list(run_type))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(np.diff(first)),
                     pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), rows),
                     pa.array(left, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "collapsed"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    fields = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_arrow(src, run, f"id {id_type}, {fields}").withColumnRenamed("id", id_col)


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The query's columns from the operator's runs and texts."""
    longest = F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.sign(b["length"] - a["length"])).when(
        a["start"] != b["start"], F.sign(a["start"] - b["start"])).otherwise(F.sign(a["period"] - b["period"])).cast("int"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("top", F.when(F.size("runs") > 0, longest[0])).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"),
        F.col("top.length").alias("length"), F.col("top.period").alias("period"),
        F.floor(F.expr("top.length * 1000 div top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The query's input: (id, text), where the texts of ids with crc32 % 10 = 0 repeat a stretch of
    their own words to the end; a null id counts as an empty one."""
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    words = F.array_remove(F.split(text_col, "[\\x20\\x09-\\x0D]+"), "")
    rows = docs.select(F.col(id_col), F.col(text_col), h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    rows = rows.withColumns({"g": F.expr("h div 10"), "n": F.size("w")})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    block = F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int"))
    again = F.concat(F.slice("w", 1, F.col("a")), F.slice(F.flatten(block), 1, F.col("n") - F.col("a")))
    return rows.select(id_col, F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col(text_col)).alias(text_col))

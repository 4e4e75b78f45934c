"""WIN1: greedy packing of time-ordered caption segments into fixed-length slices.

The packing is a sequential state machine per entry (each decision depends on where
the previous slice ended), so it is not a relational expression. It runs as a
streaming ``mapInArrow`` over data that Spark has hash-partitioned by entry and
sorted by (entry, segment order): a task walks its entries in order and holds only
the segments of the slice being built, never a whole entry. A single huge entry
therefore costs one task's time but bounded memory.

Rules (per entry, ``L`` = slice length, ``thr`` = per-segment quality threshold):
  R1 a head segment longer than L or of zero length is skipped; the next slice starts
     at the next segment's start (or the loop ends);
  R2 a slice opens at ``seek`` and covers up to ``min(seek + L, duration)``;
  R3 a segment whose (duration-clipped) end fits is added, times slice-relative;
  R4 a segment that does not fit while the slice is still empty leaves it empty and
     the next slice starts at that segment's start;
  R5 otherwise the segment is added open (start only) and the next slice starts at the
     previous segment's end;
  R6 if the pooled median word score of the closed segments is below ``thr``, the slice
     is emptied and packing restarts at the first later closed segment that passes on
     its own, else after the last closed one.
Empty slices are emitted (they reset the previous-transcript chain downstream).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parlance.operators.rejects import without_bad_entries


class Seg(NamedTuple):
    start: float
    end: float
    text: str
    scores: list  # word probabilities, possibly empty


def median(xs: list) -> float:
    """Median with the middle pair averaged; 0.0 for no values (AGG4)."""
    if not xs:
        return 0.0
    s = sorted(xs)
    n = len(s)
    return float(s[n // 2]) if n % 2 else (s[n // 2 - 1] + s[n // 2]) / 2.0


class NeedMore(Exception):
    """A decision needs a segment that has not arrived yet (streaming use)."""


class _Window:
    """Lookahead buffer over a segment iterator, addressable by absolute index.

    With ``final=False`` asking past the available segments raises ``NeedMore`` instead
    of reporting the end of the entry."""

    def __init__(self, it: Iterable[Seg], base: int = 0, final: bool = True):
        self._it = iter(it)
        self._buf: list[Seg] = []
        self._base = base
        self._done = False
        self._final = final

    def get(self, i: int) -> Seg | None:
        while not self._done and i >= self._base + len(self._buf):
            try:
                self._buf.append(next(self._it))
            except StopIteration:
                self._done = True
        k = i - self._base
        if 0 <= k < len(self._buf):
            return self._buf[k]
        if not self._final and k >= 0:
            raise NeedMore
        return None

    def release_before(self, i: int) -> None:
        k = i - self._base
        if k > 0:
            del self._buf[:k]
            self._base = i

    def pending(self) -> tuple[int, list[Seg]]:
        """(absolute index of the first kept segment, kept segments) after draining."""
        while not self._done:
            try:
                self._buf.append(next(self._it))
            except StopIteration:
                self._done = True
        return self._base, list(self._buf)


def _step(win: _Window, duration: float, L: float, threshold: float, nxt: float, i: int):
    """One iteration of the packing loop from ``(nxt, i)``: returns
    ``(slice or None, nxt, i)``; None when the head segment was skipped (R1)."""
    seek = nxt
    win.release_before(i)
    head = win.get(i)
    if head is not None and (head.end - head.start > L or head.end == head.start):  # R1
        after = win.get(i + 1)
        if after is not None:
            return None, after.start, i + 1
        return None, duration, i
    out: list[dict] = []  # R2
    closed: list[int] = []
    nxt = seek + L
    cut = min(nxt, duration)
    while True:
        s = win.get(i)
        if s is None or not (s.start < cut):
            break
        e = min(s.end, duration)
        if e <= cut:  # R3
            out.append({"start": max(0.0, s.start - seek), "end": min(L, e - seek),
                        "text": s.text, "word_scores": list(s.scores)})
            closed.append(i)
            i += 1
            continue
        if not out:  # R4
            nxt = s.start
        else:  # R5
            out.append({"start": max(0.0, s.start - seek)})
            nxt = win.get(i - 1).end
        break
    if closed:  # R6
        pooled = [x for k in closed for x in win.get(k).scores]
        if median(pooled) < threshold:
            restart = None
            for k in closed[1:]:
                if median(win.get(k).scores) >= threshold:
                    restart = k
                    break
            if restart is not None:
                nxt = win.get(restart).start
                i = restart
            else:
                after = closed[-1] + 1
                s = win.get(after)
                if s is not None:
                    nxt = s.start
                    i = after
                else:
                    nxt = duration
            out = []
    return (seek, out), nxt, i


def slice_segments(segments: Iterable[Seg], duration: float, slice_length: float = 30,
                   threshold: float = 0.0) -> Iterator[tuple[float, list[dict]]]:
    """Yield ``(seek, segments)`` per slice; slice segments are dicts with
    ``start`` and, when closed, ``end``, ``text`` and ``word_scores``."""
    win = _Window(segments)
    nxt, i = 0.0, 0
    steps = 0
    while nxt < duration:
        steps += 1
        if steps > 10_000_000:
            raise RuntimeError("slicer made no progress")
        sl, nxt, i = _step(win, duration, float(slice_length), threshold, nxt, i)
        if sl is not None:
            yield sl


def resume_slices(base: int, buffered: list[Seg], duration: float, slice_length: float, threshold: float,
                  nxt: float, i: int, final: bool):
    """Advance the packing over buffered segments ``base, base+1, ...`` from ``(nxt, i)``.

    Stops before any step whose decisions need a segment that has not arrived (unless
    ``final``). Returns ``(slices, nxt, i, finished, kept_base, kept_segments)``."""
    win = _Window(iter(buffered), base=base, final=final)
    out = []
    while nxt < duration:
        try:
            sl, n2, i2 = _step(win, duration, float(slice_length), threshold, nxt, i)
        except NeedMore:
            b, kept = win.pending()
            keep_from = max(b, min(i, b + len(kept)))
            return out, nxt, i, False, keep_from, kept[keep_from - b:]
        nxt, i = n2, i2
        if sl is not None:
            out.append(sl)
    return out, nxt, i, True, i, []


class _Rows:
    """Cursor over (entry_id, start, end, text, scores, duration) rows sorted by entry."""

    def __init__(self, it):
        self._it = it
        self.cur = next(it, None)

    def take_entry(self, key):
        while self.cur is not None and self.cur[0] == key:
            row = self.cur
            self.cur = next(self._it, None)
            yield Seg(float(row[1]), float(row[2]), row[3] or "", list(row[4] or []))

    def skip_entry(self, key):
        while self.cur is not None and self.cur[0] == key:
            self.cur = next(self._it, None)


SLICE_SEGMENT = T.StructType([
    T.StructField("start", T.DoubleType()),
    T.StructField("end", T.DoubleType()),
    T.StructField("text", T.StringType()),
    T.StructField("word_scores", T.ArrayType(T.DoubleType())),
])


def slice_schema(key_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("entry_id", key_type, False),
        T.StructField("slice_idx", T.IntegerType(), False),
        T.StructField("seek", T.DoubleType(), False),
        T.StructField("segments", T.ArrayType(SLICE_SEGMENT), False),
    ])


def generate_slices(segments: DataFrame, slice_length: float = 30, threshold: float = 0.0,
                    num_partitions: int | None = None) -> DataFrame:
    """Long-form segments ``(entry_id, seg_idx, start, end, text, word_scores,
    audio_duration)`` -> one row per slice ``(entry_id, slice_idx, seek, segments)``.

    Segments are taken in ``seg_idx`` order (file order), as the reference does not sort
    them by time. An entry with a segment that has no start, end or duration gives no slice
    (FLT10, ``operators.rejects`` lists it); the other entries are not touched by it.
    """
    spark = segments.sparkSession
    p = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key_type = segments.schema["entry_id"].dataType
    schema = slice_schema(key_type)
    arrow_schema = pa.schema([
        pa.field("entry_id", pa.int64() if isinstance(key_type, T.LongType) else pa.string(), False),
        pa.field("slice_idx", pa.int32(), False),
        pa.field("seek", pa.float64(), False),
        pa.field("segments", pa.list_(pa.struct([
            pa.field("start", pa.float64()), pa.field("end", pa.float64()),
            pa.field("text", pa.string()), pa.field("word_scores", pa.list_(pa.float64()))])), False),
    ])
    if not isinstance(key_type, (T.LongType, T.StringType)):
        raise TypeError("entry_id must be BIGINT or STRING")
    L, thr = float(slice_length), float(threshold)

    def rows(batches):
        for b in batches:
            cols = b.to_pydict()
            yield from zip(cols["entry_id"], cols["start"], cols["end"], cols["text"],
                           cols["word_scores"], cols["audio_duration"])

    def run(batches):
        out = {"entry_id": [], "slice_idx": [], "seek": [], "segments": []}

        def flush():
            tbl = pa.RecordBatch.from_pydict(out, schema=arrow_schema)
            for v in out.values():
                v.clear()
            return tbl

        src = _Rows(rows(batches))
        while src.cur is not None:
            key, dur = src.cur[0], src.cur[5]
            for k, (seek, segs) in enumerate(slice_segments(src.take_entry(key), float(dur), L, thr)):
                out["entry_id"].append(key)
                out["slice_idx"].append(k)
                out["seek"].append(float(seek))
                out["segments"].append([{"start": s["start"], "end": s.get("end"), "text": s.get("text"),
                                         "word_scores": s.get("word_scores", [])} for s in segs])
                if len(out["seek"]) >= 1000:
                    yield flush()
            src.skip_entry(key)  # segments past the audio end are never reached
        if out["seek"]:
            yield flush()

    together = segments.select("entry_id", "seg_idx", "start", "end", "text", "word_scores",
                               "audio_duration").repartition(p, "entry_id")
    ordered = without_bad_entries(together).sortWithinPartitions("entry_id", "seg_idx")
    return ordered.mapInArrow(run, schema)

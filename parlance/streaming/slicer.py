"""STR4: the slicer over segments arriving as a stream, with state per entry.

State: the packing position ``(nxt, i)``, the next slice index, the entry's duration, the
segments from index ``i`` on that have arrived in order but are not yet consumed, a reorder
buffer for segments that came before one they follow, and the next expected ``seg_idx``. Each
micro-batch takes over what is next in order and advances the packing as far as the arrived
segments allow; a slice whose decisions depend on a segment still to come waits.

- A segment that was taken over already, or waits, is a repeat and is ignored.
- The entry ends when its last segment (``is_last``) and all before it are there, when packing
  passes the audio's end, or when the event-time watermark passes one minute after its newest
  segment; then what waits is taken in order, gaps or not.
- An ended entry keeps a finished mark, without segments, until the watermark has passed that
  minute: segments that still come (beyond the audio's end, repeated) start nothing anew. Rows
  later than the watermark are dropped by Spark.
- An entry with a segment that cannot be sliced (``operators.rejects``) ends at it: slices that were
  emitted before stay, no more follow.

Output rows equal the batch slicer's (``operators.slicing.generate_slices``) for the segments of
an entry that arrive within the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from parlance.operators.slicing import Seg, resume_slices, slice_schema

_SEG = T.StructType([
    T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()),
    T.StructField("text", T.StringType()), T.StructField("scores", T.ArrayType(T.DoubleType()))])
STATE = T.StructType([
    T.StructField("nxt", T.DoubleType()), T.StructField("i", T.LongType()),
    T.StructField("next_idx", T.IntegerType()), T.StructField("duration", T.DoubleType()),
    T.StructField("base", T.LongType()), T.StructField("segs", T.ArrayType(_SEG)),
    T.StructField("expected", T.LongType()), T.StructField("last_seq", T.LongType()),
    T.StructField("max_ts", T.TimestampType()), T.StructField("done", T.BooleanType()),
    T.StructField("ahead_seq", T.ArrayType(T.LongType())), T.StructField("ahead", T.ArrayType(_SEG)),
])
_IDLE_MS = 60_000


def _seg(start, end, text, scores) -> Seg:
    return Seg(start, end, text if text is not None else "", [] if scores is None else [float(x) for x in scores])


def _number(x) -> float | None:
    return None if x is None or pd.isna(x) else float(x)


class _Entry:
    """The state of one entry between micro-batches."""

    def __init__(self, state: GroupState):
        self.nxt, self.i, self.next_idx, self.dur, self.base, self.segs = 0.0, 0, 0, None, 0, []
        self.expected, self.last_seq, self.max_ts, self.done, self.ahead = 0, -1, None, False, {}
        if state.exists:
            (self.nxt, self.i, self.next_idx, self.dur, self.base, segs, self.expected, self.last_seq, self.max_ts, self.done,
             seqs, ahead) = state.get
            self.segs = [_seg(*x) for x in segs]
            self.ahead = {int(k): _seg(*x) for k, x in zip(seqs, ahead, strict=True)}

    def take(self, pdf: pd.DataFrame) -> None:
        newest = pd.to_datetime(pdf["ts"]).max()
        self.max_ts = newest if self.max_ts is None else max(pd.Timestamp(self.max_ts), newest)
        if self.done:
            return
        if self.dur is None:
            self.dur = _number(pdf["audio_duration"].iloc[0])
        last = pdf["is_last"].fillna(False).astype(bool)
        if last.any():
            self.last_seq = int(pdf.loc[last, "seg_idx"].max())
        for r in pdf.itertuples(index=False):
            k = int(r.seg_idx)
            if k >= self.expected and k not in self.ahead:
                self.ahead[k] = _seg(_number(r.start), _number(r.end), r.text, r.word_scores)
        while self.expected in self.ahead:
            self.segs.append(self.ahead.pop(self.expected))
            self.expected += 1

    def advance(self, slice_length: float, threshold: float, timed_out: bool) -> list:
        if self.done:
            return []
        if timed_out:  # nothing more comes: gaps stay open
            self.segs += [self.ahead.pop(k) for k in sorted(self.ahead)]
        final = timed_out or (self.last_seq >= 0 and self.expected > self.last_seq)
        if self.dur is None or any(s.start is None or s.end is None for s in self.segs):
            self.finish()
            return []
        out, self.nxt, self.i, ended, self.base, self.segs = resume_slices(
            self.base, self.segs, self.dur, slice_length, threshold, self.nxt, self.i, final)
        if ended or final:
            self.finish()
        return out

    def finish(self) -> None:
        self.done, self.segs, self.ahead = True, [], {}

    def keep(self, state: GroupState) -> None:
        order = sorted(self.ahead)
        state.update((self.nxt, self.i, self.next_idx, self.dur, self.base, [tuple(s) for s in self.segs], self.expected, self.last_seq,
                      pd.Timestamp(self.max_ts).to_pydatetime(), self.done, order, [tuple(self.ahead[k]) for k in order]))
        mark = int(pd.Timestamp(self.max_ts).timestamp() * 1000) + _IDLE_MS
        state.setTimeoutTimestamp(max(mark, state.getCurrentWatermarkMs() + 1))


def _make_fn(slice_length: float, threshold: float):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        entry, timed_out = _Entry(state), state.hasTimedOut
        if not timed_out:
            for pdf in pdfs:
                entry.take(pdf)
        slices = entry.advance(slice_length, threshold, timed_out)
        if slices:
            yield pd.DataFrame({
                "entry_id": [key[0]] * len(slices),
                "slice_idx": list(range(entry.next_idx, entry.next_idx + len(slices))),
                "seek": [float(sk) for sk, _ in slices],
                "segments": [[{"start": s["start"], "end": s.get("end"), "text": s.get("text"),
                               "word_scores": s.get("word_scores", [])} for s in out] for _, out in slices],
            })
            entry.next_idx += len(slices)
        if timed_out:
            state.remove()
        else:
            entry.keep(state)
    return fn


def stream_slices(segments: DataFrame, slice_length: float = 30, threshold: float = 0.0,
                  watermark: str = "1 minute") -> DataFrame:
    """``(entry_id BIGINT, seg_idx, ts, start, end, text, word_scores, audio_duration,
    is_last)`` -> slices ``(entry_id, slice_idx, seek, segments)`` as they complete."""
    src = segments.withWatermark("ts", watermark) if segments.isStreaming else segments
    cols = ["entry_id", "seg_idx", "ts", "start", "end", "text", "word_scores", "audio_duration", "is_last"]
    return (src.select(*cols).groupBy("entry_id")
               .applyInPandasWithState(_make_fn(float(slice_length), float(threshold)), slice_schema(T.LongType()),
                                       STATE, "append", GroupStateTimeout.EventTimeTimeout))

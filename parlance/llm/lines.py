"""Operator 7, line dedup: winnowing over line hashes.

Two units repeat, and each is handled by the same steps:

- physical lines: a run of ``min_lines`` lines or more with ``min_line_words`` words or more, white
  space apart (one line, and two words, by default);
- passages, which start and end inside physical lines as often as at their ends: every word begins
  a "line" of ``GRAM`` words, and a run has ``min_words`` words or more and goes on across line
  breaks.

A run is a repeat if the same run occurred before: earlier in the same document, or in a document
with a smaller id. Later repeated runs are deleted, the first occurrence stays.

1. Winnowing: in every window of a unit's consecutive hashes (as many as the shortest run has) the
   minimum is selected, the rightmost on ties. Each shortest run is one window, so equal runs have
   the same selected fingerprint: none is missed.
2. Fingerprints are counted across the corpus; the repeated ones go into a fixed-size bitmap.
3. The positions around a repeated fingerprint, both ways, are the shortest runs whose minimum it
   is. They are joined with the other positions by the hash of the whole run: each but the first
   one is a match, and matches that overlap or touch make up the longer run. A task marks the
   repeats among its own positions first, so a very frequent run costs a row a task.

Exact copies of a whole text are found by the text's hash first, and only the first copy
takes part, so a large group of copies costs one row per copy.

Deleting a run leaves a line break where white space around it had one, a blank otherwise,
and nothing at the ends of the text.

Edge cases: null and empty texts stay as they are; a line of fewer than ``min_line_words`` words
stays unless it is in a repeated passage; documents are ordered by id (null first), then by text
hash; rows equal in id and text are one document and are all treated like it; an empty table gives
an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import Words, bitmap, chunks, has_bits, map_arrow, mix, stash, text_buffer

#: Words hashed together, and the words of a passage that counts as repeated.
GRAM = 20
MIN_WORDS = 50
#: Physical lines of a run that counts as repeated, and the words that it has at least.
MIN_LINES = 1
MIN_LINE_WORDS = 2
#: Runs that a task holds to find the first of each among its own before they are shuffled.
HOLD_RUNS = 100_000
#: Rows of a batch that are filtered, and so copied, at a time.
SLICE_ROWS = 1000


@dataclass(frozen=True)
class Least:
    """The shortest runs that count: words of a passage, lines and words of a run of lines."""

    words: int = MIN_WORDS
    lines: int = MIN_LINES
    line_words: int = MIN_LINE_WORDS


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions selected: the minima of all windows."""
    return np.unique(minima(grams, window))


def minima(grams: np.ndarray, window: int) -> np.ndarray:
    """Position of the minimum of every window of consecutive hashes (rightmost on ties)."""
    n = len(grams)
    if n < window:
        return np.zeros(0, np.int64)
    best = np.arange(n)
    have = 1
    while have < window:  # the minimum of a window from those of two shorter ones
        step = min(have, window - have)
        a, b = best[:len(best) - step], best[step:]
        best = np.where(grams[b] <= grams[a], b, a)
        have += step
    return best


class _Windows:
    """Hashes of all k-word windows of a chunk, cut by text (computed once per chunk)."""

    def __init__(self, words: Words, k: int):
        at = words.gram_starts(k)
        self.hash = words.range_hash(at, at + k) if len(at) else np.zeros(0, np.uint64)
        self.first = np.searchsorted(at, words.first)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, len(b), SLICE_ROWS):
            yield b.slice(lo, SLICE_ROWS)


def _skip(batch: pa.RecordBatch, x: int, copies: np.ndarray, kept: np.ndarray) -> pa.RecordBatch:
    """The rows that are not copies: in the first bitmap, and not among its false positives."""
    v = batch.column(x).to_numpy(zero_copy_only=False)
    return batch.filter(pa.array(~(has_bits(copies, v) & ~has_bits(kept, v))))


def _line_starts(buf: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of each physical line that has words, and of each text's first such
    line (length n + 1)."""
    of = np.searchsorted(np.flatnonzero(buf == 10), words.starts)
    begins = np.ones(len(of), bool)
    begins[1:] = of[1:] != of[:-1]
    begins[words.first[:-1][np.diff(words.first) > 0]] = True
    at = np.flatnonzero(begins)
    return at, np.searchsorted(at, words.first)


def _line_runs(at: np.ndarray, n_words: int, least: Least) -> tuple[np.ndarray, np.ndarray]:
    """(first word, end) of the shortest runs of one text's lines, which begin at the words ``at``;
    runs with too few words are left out."""
    ends = np.append(at, n_words)[least.lines:]
    begin = at[:len(ends)]
    long = ends - begin >= least.line_words
    return begin[long], ends[long]


class _Units:
    """The shortest runs of all texts of a chunk: of passages (``best``: the gram that is the fingerprint
    of each) and of lines (``begin`` to ``end``: their words, ``line_f``: their fingerprints)."""

    _LINE, _LINES = np.uint64(0x6C696E65), np.uint64(0x6C696E6573)

    def __init__(self, buf: np.ndarray, offs: np.ndarray, least: Least):
        self.least = least
        self.words = words = Words(buf, offs)
        self.grams = _Windows(words, GRAM)
        self.best = self._inside(self.grams.hash, self.grams.first, least.words - GRAM + 1)
        at, first = _line_starts(buf, words)
        end = np.append(at, len(words.starts))[1:]
        line = mix(words.range_hash(at, end) + self._LINE) if len(at) else np.zeros(0, np.uint64)
        chosen = self._inside(line, first, least.lines)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        lead = np.flatnonzero(text[:len(text) - least.lines + 1] == text[least.lines - 1:])  # first lines of the runs
        begin, end = at[lead], end[lead + least.lines - 1]
        long = end - begin >= least.line_words
        self.begin, self.end, self.line_f, self.line_text = begin[long], end[long], line[chosen[long]], text[lead[long]]

    @staticmethod
    def _inside(hashes: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
        """The minimum's position for each window that lies in one text."""
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        return minima(hashes, window)[text[:max(0, len(text) - window + 1)] == text[window - 1:]]

    def fingerprints(self) -> np.ndarray:
        return np.concatenate([self.grams.hash[np.unique(self.best)], self.line_f])

    def runs(self, repeated) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, run hash, first word of the text, words) of the runs whose fingerprint is repeated."""
        wide = _Windows(self.words, self.least.words)
        known = np.zeros(len(self.grams.hash), bool)
        p = np.unique(self.best)
        known[p] = repeated(self.grams.hash[p])
        hit = np.flatnonzero(known[self.best])
        text = np.searchsorted(wide.first, hit, "right") - 1
        ok = repeated(self.line_f)
        begin, end, of = self.begin[ok], self.end[ok], self.line_text[ok]
        lines = mix(self.words.range_hash(begin, end) + self._LINES) if len(begin) else np.zeros(0, np.uint64)
        return (np.concatenate([text, of]), np.concatenate([wide.hash[hit], lines]),
                np.concatenate([hit - wide.first[text], begin - self.words.first[of]]),
                np.concatenate([np.full(len(hit), self.least.words), end - begin]))


def _fingerprints(texts: DataFrame, masks, least: Least) -> DataFrame:
    """(f): the selected hashes of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            b = _skip(b, 1, *masks.value)
            raw, offs = text_buffer(b.column(0))
            for lo, hi in chunks(offs):
                flat = _Units(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], least).fingerprints()
                if len(flat):
                    yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], ["f"])

    return map_arrow(texts.select("t", "x"), run, "f long")


def _first_of_run(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The held runs: the first of each hash, and the others merged and marked ``later``. Rows equal in id and text
    give the same runs; one of each is left, as none of them comes before the others."""
    t = pa.Table.from_batches(parts).combine_chunks()
    t = t.take(pc.sort_indices(t, [(c, "ascending") for c in ("run", "id", "h", "at")], null_placement="at_start"))
    ids = pc.dictionary_encode(t["id"], null_encoding="encode").combine_chunks().indices.to_numpy()
    same = np.zeros(len(t), bool)
    same[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in (ids, *(t[n].to_numpy() for n in ("run", "h", "at")))])
    t = t.filter(pa.array(~same))
    run = t["run"].to_numpy()
    later = np.zeros(len(run), bool)
    later[1:] = run[1:] == run[:-1]
    return pa.concat_tables([_stretches(t.filter(pa.array(later)), ids[~same][later]),
                             t.filter(pa.array(~later)).append_column("later", pa.array(np.zeros(int((~later).sum()), bool)))]
                            ).combine_chunks().to_batches()[0]


def _stretches(t: pa.Table, ids: np.ndarray) -> pa.Table:
    """The later runs, those that overlap or touch in a document as one (the hash is its first one's)."""
    h, at, n = (t[c].to_numpy() for c in ("h", "at", "n"))
    by = np.lexsort((at, h, ids))
    ids, h, at, end = ids[by], h[by], at[by].astype(np.int64), (at + n)[by].astype(np.int64)
    head = np.ones(len(by), bool)
    head[1:] = (ids[1:] != ids[:-1]) | (h[1:] != h[:-1])
    doc = np.cumsum(head)
    reach = np.maximum.accumulate(end + doc * (1 << 32)) - doc * (1 << 32) if len(by) else end
    head[1:] |= at[1:] > reach[:-1]
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(by)) - 1 if len(by) else first
    return t.take(pa.array(by[first])).set_column(t.schema.get_field_index("n"), "n", pa.array((reach[last] - at[first]).astype(np.int32))
                                                  ).append_column("later", pa.array(np.ones(len(first), bool)))


def _runs(texts: DataFrame, masks, repeated, least: Least, id_type: str) -> DataFrame:
    """(id, h, run, at, n, later): the shortest runs with a repeated fingerprint, of n words from word
    ``at`` on; ``later`` if the task itself has an earlier one, so that few rows of a very
    frequent run are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = repeated.value
        held, n_held = [], 0
        for b in _slices(batches):
            b = _skip(b, 3, *masks.value)
            raw, offs = text_buffer(b.column(1))
            for lo, hi in chunks(offs):
                units = _Units(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], least)
                text, run, at, n = units.runs(lambda f: has_bits(bits, f.view(np.int64)))
                if len(text):
                    rows = pa.array(text + lo)
                    held.append(pa.RecordBatch.from_arrays(
                        [b.column(0).take(rows), b.column(2).take(rows), pa.array(run.view(np.int64)),
                         pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], ["id", "h", "run", "at", "n"]))
                    n_held += len(rows)
                if n_held >= HOLD_RUNS:
                    yield _first_of_run(held)
                    held, n_held = [], 0
        if held:
            yield _first_of_run(held)

    return map_arrow(texts.select("id", "t", "h", "x"), run, f"id {id_type}, h long, run long, at int, n int, later boolean")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: Least = Least()) -> DataFrame:
    """(id, h, copy, spans): for each document with something to delete (h: its text's hash), whether
    the whole text is a copy, and the later repeated shortest runs (at: first word, n: words)."""
    if least.words < GRAM or least.lines < 1:
        raise ValueError(f"a passage has {GRAM} words at least, a run of lines one line")
    sc = docs.sparkSession.sparkContext
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t IS NOT NULL").select(
        "id", "t", F.xxhash64("t").alias("h")).withColumn("x", F.xxhash64("id", "h"))
    keys = stash(texts.select("id", "h", "x", F.xxhash64(F.lit(7), "t").alias("h2")), "texts")
    first = stash(keys.groupBy("h", "h2").agg(F.min(F.struct(F.col("id").isNotNull().alias("named"), "id")).alias("first"),
                                              F.count("*").alias("m")).where("m > 1"), "first")
    marked = stash(keys.join(first, ["h", "h2"], "left").select(
        "id", "h", "x", (F.col("m").isNotNull() & ~F.col("id").eqNullSafe(F.col("first.id"))).alias("copy")), "marked")
    copies = stash(marked.where("copy").select("id", "h", "x").distinct(), "copies")
    found = bitmap(copies, "x", copies.count())
    bits = sc.broadcast(found)

    def wrongly_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(has_bits(bits.value, b.column(0).to_numpy(zero_copy_only=False))))

    kept = stash(map_arrow(marked.where("NOT copy").select("x"), wrongly_found, "x long"), "kept")
    masks = sc.broadcast((found, bitmap(kept, "x", kept.count())))
    marks = stash(_fingerprints(texts, masks, least).groupBy("f").agg(F.count("*").alias("m")).where("m > 1").select("f"),
                  "fingerprints")
    repeated = sc.broadcast(bitmap(marks, "f", marks.count()))
    runs = stash(_runs(texts, masks, repeated, least, id_type), "runs")
    # rank and not row_number: equal rows are one document
    by_run = Window.partitionBy("run").orderBy(F.col("id").asc_nulls_first(), "h", "at")
    later = runs.where("NOT later").withColumn("place", F.rank().over(by_run)).where("place > 1")
    span = F.struct("at", "n")
    spans = (later.select("id", "h", "at", "n").unionByName(runs.where("later").select("id", "h", "at", "n"))
             .groupBy("id", "h").agg(F.collect_set(span).alias("spans")))
    return (spans.select("id", "h", F.lit(False).alias("copy"), "spans").unionByName(
        copies.select("id", "h", F.lit(True).alias("copy"), F.array().cast("array<struct<at:int,n:int>>").alias("spans")))
        .groupBy("id", "h").agg(F.max("copy").alias("copy"), F.flatten(F.collect_list("spans")).alias("spans")))


def _delete(raw: np.ndarray, offs: np.ndarray, words: Words, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts of a buffer without the words marked ``gone``: bytes, offsets, and the number of
    stretches deleted from each."""
    rows = len(offs) - 1
    of = np.repeat(np.arange(rows), np.diff(words.first))
    begins, ends = gone.copy(), gone.copy()
    begins[1:] &= ~gone[:-1] | (of[1:] != of[:-1])
    ends[:-1] &= ~gone[1:] | (of[1:] != of[:-1])
    a, b = np.flatnonzero(begins), np.flatnonzero(ends)
    row = of[a]
    inner_left, inner_right = a > words.first[row], b + 1 < words.first[row + 1]
    left = np.where(inner_left, words.ends[a - 1], offs[row])
    right = np.where(inner_right, words.starts[np.minimum(b + 1, len(of) - 1)], offs[row + 1])
    breaks = np.concatenate([[0], np.cumsum(raw == 10)])
    broken = breaks[words.starts[a]] - breaks[left] + breaks[right] - breaks[words.ends[b]] > 0
    joint = inner_left & inner_right  # one white space stays between what is left on both sides
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, left + joint, 1)
    np.add.at(edge, right, -1)
    keep = np.cumsum(edge[:-1]) == 0
    out = raw.copy()
    out[left[joint]] = np.where(broken[joint], 10, 32)
    kept = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], kept[offs], np.bincount(row, minlength=rows)


def cut(texts: pa.Array, copy: np.ndarray, spans: pa.ListArray | None, least: Least) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(texts without their later repeated runs, words, words deleted, stretches deleted)."""
    raw, offs = text_buffer(texts)
    words = Words(raw, offs)
    first, n = words.first, len(words.starts)
    edge = np.zeros(n + 1, np.int64)
    if spans is not None and len(flat := spans.flatten()):
        row = np.repeat(np.arange(len(texts)), np.diff(spans.offsets.to_numpy()))
        at = first[row] + flat.field("at").to_numpy()
        np.add.at(edge, at, 1)
        np.add.at(edge, at + flat.field("n").to_numpy(), -1)
    if copy.any():
        lines, first_line = _line_starts(raw, words)
        for d in np.flatnonzero(copy):
            if first[d + 1] - first[d] >= least.words:
                begin, end = first[d:d + 1], first[d + 1:d + 2]
            else:
                begin, end = _line_runs(lines[first_line[d]:first_line[d + 1]], first[d + 1], least)
            np.add.at(edge, begin, 1)
            np.add.at(edge, end, -1)
    gone = np.cumsum(edge[:-1]) > 0
    done = np.concatenate([[0], np.cumsum(gone)])
    removed = done[first[1:]] - done[first[:-1]]
    if not len(removed) or not removed.any():
        return texts, np.diff(first), removed, np.zeros(len(texts), np.int64)
    data, at, stretches = _delete(raw, offs, words, gone)
    new = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))
    return pc.if_else(texts.is_null(), pa.scalar(None, pa.string()), new.cast(pa.string())), np.diff(first), removed, stretches


COUNTS = "n_words long, n_removed long, n_runs long"


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
          least: Least = Least(), counts: bool = False) -> DataFrame:
    """``docs`` with the later repeated runs deleted from the texts: the same rows and columns, and
    the columns of ``COUNTS`` with ``counts``. ``chars_col``, where it exists, is set to the
    new length of the texts that changed."""
    found = stash(repeats(docs, id_col, text_col, least), "repeats")
    names = docs.columns
    at = names.index(text_col)
    chars = names.index(chars_col) if chars_col in names else None
    src = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                      F.xxhash64(F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`"))).alias("x"))
    # only the texts that something may be deleted from are shuffled to meet their runs
    mark = found.select(F.xxhash64("id", "h").alias("x"))
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(mark, "x", found.count()))

    k = len(names)
    plain = names + (["n_words", "n_removed", "n_runs"] if counts else [])
    fields = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)]
    if counts:
        fields += [f"c{k + i} long" for i in range(3)]

    def result(b: pa.RecordBatch, known: bool) -> Iterator[pa.RecordBatch]:
        _, offs = text_buffer(b.column(at))
        for lo, hi in chunks(offs):
            part = b.slice(lo, hi - lo)
            cols = list(part.columns[:k])
            if known or counts:
                copy = pc.fill_null(part.column(k), False).to_numpy(zero_copy_only=False) if known else np.zeros(len(part), bool)
                spans = part.column(k + 1) if known else None
                text, words, removed, stretches = cut(cols[at], copy, spans, least)
                changed = pa.array(removed > 0)
                cols[at] = pc.if_else(changed, text, cols[at])
                if chars is not None:
                    cols[chars] = pc.if_else(changed, pc.utf8_length(cols[at]).cast(cols[chars].type), cols[chars])
                if counts:
                    cols += [pa.array(c.astype(np.int64)) for c in (words, removed, stretches)]
            yield pa.RecordBatch.from_arrays(cols, names=[f"c{i}" for i in range(len(cols))])

    def marked(b: pa.RecordBatch) -> np.ndarray:
        return has_bits(bits.value, b.column(k).to_numpy(zero_copy_only=False))

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            b = b.filter(pa.array(marked(b)))
            yield pa.RecordBatch.from_arrays(b.columns[:k], names=[f"c{i}" for i in range(k)])

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            yield from result(b.filter(pa.array(~marked(b))), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from result(b, True)

    # one Python worker a task: the rows that nothing is deleted from get their result in the
    # pass that finds them
    key, text = f"c{names.index(id_col)}", f"c{at}"
    with_runs = map_arrow(src, touched, ", ".join(fields[:k])).join(
        found, F.col(key).eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("h")), "left").drop("id", "h")
    return map_arrow(with_runs, run, ", ".join(fields)).unionByName(
        map_arrow(src, untouched, ", ".join(fields))).toDF(*plain)

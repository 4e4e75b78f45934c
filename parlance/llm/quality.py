"""Operator 6, quality rules: fixed base rules and a calibrated hashed n-gram classifier.

Base figures of a text (words `[^\\x20\\x09-\\x0D]+`): word_chars, n_symbols, n_dup_lines,
n_repeat_words, all counted in Arrow batches with 64-bit hashes of words and lines. The
verdict is a logistic regression on hashed word 1/2-grams and character (code point) 3/4-grams
(shares within the text), trained on a bounded sample of labelled rows, calibrated by Platt scaling on rows
that the fit has not seen, and compared with a fixed threshold.

Edge cases: null and empty texts have no words and fail the base rules; one-class or missing
labels leave the base rules as the only verdict (probability 1); repeated rows give repeated
rows, and an id that has several texts teaches with one of them; null labels are not used; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import NEWLINE, Words, chunks, fold_of, map_arrow, text_buffer
from parlance.llm.linear import Rows, fit_logistic, fit_platt, sigmoid
from parlance.llm.pieces import code_points

DIMS = 1 << 17
#: Labelled rows used for the fit and the calibration (a quarter), at most.
SAMPLE_ROWS = 2000
#: Features that one sampled text teaches with, at most: those with the largest shares.
SAMPLE_FEATURES = 1 << 14
MIN_PROBABILITY = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
GRAM = 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point


def _sum_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(values)])
    return c[first[1:]] - c[first[:-1]]


def base_figures(buf: np.ndarray, offs: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    n = len(offs) - 1
    lead = np.concatenate([[0], np.cumsum(_LEAD[buf])])
    chars = _sum_by_text(lead[words.ends] - lead[words.starts], words.first)
    symbols = _sum_by_text(_SYMBOL[buf], offs)
    # lines with a word; the hash covers the whole line
    lines = Words(buf, offs, NEWLINE)
    before = np.searchsorted(words.starts, lines.starts)
    has_word = np.searchsorted(words.starts, lines.ends) > before
    dup = np.zeros(n, np.int64)
    repeat = np.zeros(n, np.int64)
    at = words.gram_starts(GRAM)
    grams = words.range_hash(at, at + GRAM) if len(at) else np.zeros(0, np.uint64)
    gram_first = np.searchsorted(at, words.first)
    for d in range(n):
        a, b = lines.first[d], lines.first[d + 1]
        own = lines.hash[a:b][has_word[a:b]]
        dup[d] = len(own) - len(np.unique(own))
        a, b = gram_first[d], gram_first[d + 1]
        if b - a > 1:
            own = grams[a:b]
            order = np.argsort(own, kind="stable")
            same = own[order[1:]] == own[order[:-1]]
            if same.any():
                twice = np.zeros(b - a, bool)
                twice[order[1:][same]] = True
                twice[order[:-1][same]] = True
                edge = np.zeros(b - a + GRAM, np.int64)
                p = np.flatnonzero(twice)
                edge[p] += 1
                edge[p + GRAM] -= 1
                repeat[d] = int((np.cumsum(edge) > 0).sum())
    return {"n_words": np.diff(words.first), "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup,
            "n_repeat_words": repeat}


def _features(buf: np.ndarray, offs: np.ndarray, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature by position, first position of each text, at its n + 1) for every kind of n-gram.
    Feature 0 is the bias."""
    space = np.uint64(DIMS - 1)

    def bucket(h: np.ndarray) -> np.ndarray:
        return (h % space).astype(np.int64) + 1

    yield bucket(words.hash), words.first
    at = words.gram_starts(2)
    yield bucket(words.range_hash(at, at + 2) if len(at) else np.zeros(0, np.uint64)), np.searchsorted(at, words.first)
    lead = np.flatnonzero(_LEAD[buf])
    wide, first = code_points(buf, lead).astype(np.uint64), np.searchsorted(lead, offs)
    for n in (3, 4):
        m = max(0, len(wide) - n + 1)
        h = np.full(m, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x100000001B3) + wide[i:i + m]
        h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)
        yield bucket(h), first  # positions that reach into the next text are cut off by _bounds


_OVERLAP = (0, 0, 2, 3)  # positions at a text's end that reach into the next text


def _bounds(first: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions [a, b) of each text; none where the text is shorter than the n-gram."""
    a = first[:-1]
    return a, np.maximum(a, first[1:] - _OVERLAP[kind])


def sparse(buf: np.ndarray, offs: np.ndarray, words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse rows of the texts: each kind's features as shares of that kind's positions."""
    rows = [[np.zeros(1, np.int64)] for _ in range(len(offs) - 1)]
    vals = [[np.ones(1)] for _ in range(len(offs) - 1)]
    for kind, (feat, first) in enumerate(_features(buf, offs, words)):
        for d, (a, b) in enumerate(zip(*_bounds(first, kind), strict=True)):
            if b > a:
                u, c = np.unique(feat[a:b], return_counts=True)
                rows[d].append(u)
                vals[d].append(SCALE * c / (b - a))
    return [(np.concatenate(i), np.concatenate(v)) for i, v in zip(rows, vals, strict=True)]


#: Shares are small numbers; scaled, the optimiser's steps suit them.
SCALE = 10.0


def _largest(i: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(i) <= SAMPLE_FEATURES:
        return i, v
    keep = np.sort(np.lexsort((i, -v))[:SAMPLE_FEATURES])
    return i[keep], v[keep]


def dense_scores(buf: np.ndarray, offs: np.ndarray, words: Words, w: np.ndarray) -> np.ndarray:
    out = np.full(len(offs) - 1, w[0])
    for kind, (feat, first) in enumerate(_features(buf, offs, words)):
        c = np.concatenate([[0.0], np.cumsum(w[feat])])
        a, b = _bounds(first, kind)
        a, b = np.minimum(a, len(feat)), np.minimum(b, len(feat))  # the last text may be shorter than the n-gram
        out += np.where(b > a, SCALE * (c[b] - c[a]) / np.maximum(1, b - a), 0.0)
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> dict | None:
    """Model (weights, Platt a and b) from at most ``sample_rows`` labelled rows: those whose id
    hashes lowest. None without rows of both classes."""
    ids = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y"))
           .orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    # the sample is bounded by sample_rows, whatever the tables' sizes
    src = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
           .where("t IS NOT NULL").join(F.broadcast(ids), "id")
           .groupBy("id", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t"))  # one row of each id
           .select("t", "y", (fold_of("id", 4) == 0).alias("c")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = text_buffer(b.column(0))
            for lo, hi in chunks(offs):
                buf, own = raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                rows = [_largest(i, v) for i, v in sparse(buf, own, Words(buf, own))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo),
                     pa.array([i.astype(np.int32).tobytes() for i, _ in rows], pa.binary()),
                     pa.array([v.astype(np.float32).tobytes() for _, v in rows], pa.binary())], ["y", "c", "i", "v"])

    got = sorted((tuple(r) for r in map_arrow(src, run, "y int, c boolean, i binary, v binary").collect()),
                 key=lambda r: (r[1], r[0], bytes(r[2]), bytes(r[3])))
    fit, cal = [r for r in got if not r[1]], [r for r in got if r[1]]

    def unpack(rs: list) -> tuple[Rows, np.ndarray]:
        return (Rows([(np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.float32)) for r in rs], DIMS),
                np.array([r[0] for r in rs], float))

    if len({r[0] for r in fit}) < 2:
        return None
    x, y = unpack(fit)
    w = fit_logistic(x, y)
    a, b = 1.0, 0.0
    if len({r[0] for r in cal}) == 2:
        xc, yc = unpack(cal)
        a, b = fit_platt(xc.scores(w), yc)
    return {"w": w.astype(np.float32), "a": a, "b": b}


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text",
          min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """(id, base figures, base_failed, kept, probability) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            raw, offs = text_buffer(b.column(1))
            for lo, hi in chunks(offs):
                buf, own = raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                words = Words(buf, own)
                base = base_figures(buf, own, words)
                p = np.ones(hi - lo) if m is None else sigmoid(
                    m["a"] * dense_scores(buf, own, words, m["w"].astype(np.float64)) + m["b"])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), *[pa.array(base[n].astype(np.int64)) for n in names],
                     pa.array(p, pa.float64())], ["id", *names, "probability"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    out = map_arrow(src, run, f"id {id_type}, {', '.join(n + ' long' for n in names)}, probability double")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return out.select(F.col("id").alias(id_col), *names, failed.alias("base_failed"),
                      (~failed & (F.col("probability") >= min_probability)).alias("kept"), "probability")

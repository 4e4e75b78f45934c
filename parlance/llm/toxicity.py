"""Operator 9, toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts drawn without a look at their labels are the
unlabelled ones; the class prior is the toxic share of the labelled rows. Both samples come
from outside the held-out fold. A linear model on the hashed words and word
beginnings of a text (present or not) is fitted in numpy under the class-prior-corrected,
non-negative risk estimator.
Words are runs of ASCII letters, digits and non-ASCII bytes, A-Z folded.

Edge cases: null and empty texts score by the bias alone; without positives or unlabelled
texts every score is 0; a row may be labelled twice (toxic if any label says so); an id that has
several texts teaches with one of them; null labels and ids are not learned from; repeated rows give repeated rows; other columns pass through
``reject`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import Words, chunks, fold_of, map_arrow, mix, text_buffer
from parlance.llm.linear import Rows, fit_nnpu, sigmoid

DIMS = 1 << 18
#: Rows of each sample, at most; and the features that one of its texts teaches with, at most: those
#: of the smallest buckets.
POSITIVES, UNLABELLED = 3000, 6000
SAMPLE_FEATURES = 1 << 13
THRESHOLD = 0.5
#: A feature counts if the samples' shares differ by so many standard errors, in so many positives.
MIN_Z, MIN_POSITIVES = 4.0, 3
L2 = 3e-4
#: Bytes of a word's beginning that make a feature beside the whole word.
STEM_BYTES = 5
FOLDS = 5

_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def features(buf: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct word buckets of each text, after the bias feature 0."""
    words = Words(buf, offs, _NOT_WORD, fold=True)

    def bucket(h: np.ndarray) -> np.ndarray:
        return (h % np.uint64(DIMS - 1)).astype(np.int32) + 1

    whole, stem = bucket(words.hash), bucket(mix(words.prefix_hash(STEM_BYTES)))
    zero = np.zeros(1, np.int32)
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        yield np.concatenate([zero, np.unique(np.concatenate([whole[a:b], stem[a:b]]))])


def _sample(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> list[np.ndarray]:
    """Features of the texts of a bounded id list (the caller has limited it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = text_buffer(b.column(0))
            for lo, hi in chunks(offs):
                got = features(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                yield pa.RecordBatch.from_arrays([pa.array([x[:SAMPLE_FEATURES].tobytes() for x in got], pa.binary())], ["i"])

    src = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
           .where("t IS NOT NULL").join(F.broadcast(ids), "id")
           .groupBy("id").agg(F.min_by("t", F.xxhash64("t")).alias("t")).select("t"))  # one row of each id
    return [np.frombuffer(r, np.int32) for r in sorted(bytes(r["i"]) for r in map_arrow(src, run, "i binary").collect())]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> np.ndarray | None:
    """Weights by feature; None without positives or unlabelled texts."""
    learn = F.col("id").isNotNull() & (fold_of("id", FOLDS) != 0)
    lab = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(learn & F.col("y").isin(0, 1))
           .groupBy("id").agg(F.max("y").alias("y")))
    by_hash = (F.xxhash64("id"), F.col("id"))
    n, n_pos = lab.agg(F.count("*"), F.sum("y")).first()
    if not n or not n_pos:
        return None
    pos = _sample(docs, lab.where("y = 1").select("id").orderBy(*by_hash).limit(positives), id_col, text_col)
    any_ids = docs.select(F.col(id_col).alias("id")).where(learn).distinct()
    unl = _sample(docs, any_ids.orderBy(*by_hash).limit(unlabelled), id_col, text_col)
    if not pos or not unl:
        return None

    scale = contrast(pos, unl)

    def rows(xs: list[np.ndarray]) -> Rows:
        kept = [x[scale[x] != 0] for x in xs]
        return Rows([(x, scale[x]) for x in kept], DIMS)

    return (fit_nnpu(rows(pos), rows(unl), min(0.95, n_pos / n), l2=L2) * scale).astype(np.float32)


def contrast(pos: list[np.ndarray], unl: list[np.ndarray]) -> np.ndarray:
    """Scale of each feature: the log ratio of its document shares in the two samples, 0 where
    the shares differ by less than ``MIN_Z`` standard errors; the bias has 1."""
    dp, du = (np.bincount(np.concatenate(xs), minlength=DIMS).astype(float) for xs in (pos, unl))
    n_p, n_u = len(pos), len(unl)
    share = (dp + du + 0.5) / (n_p + n_u + 1)
    z = (dp / n_p - du / n_u) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n_p + 1 / n_u))
    scale = np.log((dp + 0.5) / (n_p + 1)) - np.log((du + 0.5) / (n_u + 1))
    scale[(np.abs(z) < MIN_Z) | (dp < MIN_POSITIVES)] = 0
    scale[0] = 1
    return scale


def scores(col: pa.Array, w: np.ndarray | None) -> np.ndarray:
    out = np.zeros(len(col))
    if w is None:
        return out
    raw, offs = text_buffer(col)
    for lo, hi in chunks(offs):
        got = features(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
        out[lo:hi] = sigmoid(np.array([w[x].sum(dtype=np.float64) for x in got]))
    return out


def score(docs: DataFrame, w: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text",
          extra: dict[str, Column] | None = None) -> DataFrame:
    """(id, extra columns, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(w)
    extra = extra or {}
    extra_names = list(extra)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), *[c.alias(n) for n, c in extra.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = scores(b.column(1), shared.value)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *b.columns[2:], pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                names=["id", *extra_names, "score", "predicted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "t")
    return map_arrow(src, run, f"{fields}, score double, predicted int").withColumnRenamed("id", id_col)


def reject(docs: DataFrame, w: np.ndarray | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as given, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(w)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(scores(b.column(at), shared.value) < THRESHOLD))

    return map_arrow(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))

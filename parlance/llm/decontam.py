"""Operator 4, benchmark decontamination with a generalised suffix automaton.

The normalised items are split into shards of about ``SHARD_WORDS`` words; a task turns each shard
into one generalised suffix automaton over word ids and writes it to the shared folder. An item of more
than ``PIECE_WORDS`` words is dealt out in pieces that overlap by a window less one word, so every window
lies whole in a piece. One automaton at a time, of bounded size, is broadcast; at most
``SHARDS_A_PASS`` meet in a task, then the finds so far are written and the next ones take over.
Every document's words stream through the automaton, which
tracks the longest match ending at each word. A match of at least ``window`` words marks the
last ``window`` words as hit; an item shorter than the window counts when it is matched
whole. A document word that no item has sends the automaton back to its root, so stretches
of known words shorter than the shortest window are skipped without a walk.

Normalisation: A-Z are lower-cased; words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`.

Edge cases: a null text has no words and is never contaminated; a null, empty or wordless
item has no window; repeated item ids count once, repeated rows give repeated rows; with an
empty benchmark nothing is hit; only the id and text columns are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import map_arrow, release, stash

#: Words of one shard's items, about; more items make more shards, never a larger automaton.
SHARD_WORDS = 200_000
#: Words of one piece of an item (or a window, if that is longer).
PIECE_WORDS = 10_000
#: Automata that one task holds at most.
SHARDS_A_PASS = 4

_WORD = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_CLEAN = bytes(b if b in _WORD else 0x20 for b in _FOLD)


def words(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


class Automaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        seqs = []
        for item, ws in items:
            seq = [self.ids.setdefault(w, len(self.ids)) for w in ws]
            if seq:
                seqs.append((item, seq))
                last = 0
                for c in seq:
                    last = self._extend(last, c)
        self.shortest = min([window, *(len(s) for _, s in seqs)])
        # the state that holds the window-long suffix of a longer match
        self.top = [0] * len(self.len)
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            p = self.link[v]
            self.top[v] = v if self.len[p] < window else self.top[p]
        # items that hold the window-long string of a state; whole short items by state
        self.holders: dict[int, set[int]] = {}
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for item, seq in seqs:
            v = n = 0
            for c in seq:
                v, n = self.next[v][c], n + 1  # the item's own prefix, so no transition is missing
                if n >= window:
                    self.holders.setdefault(self.top[v], set()).add(item)
            if n < window:
                self.whole.setdefault(v, []).append((n, item))
        # next state up the suffix links (itself included) at which a short item ends
        self.mark = [-1] * len(self.len)
        for v in sorted(range(len(self.len)), key=self.len.__getitem__):
            self.mark[v] = v if v in self.whole else self.mark[self.link[v]] if v else -1

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        k = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = k
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = k
            p = self.link[p]
        return k

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # another item has this prefix
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, q, c)
        cur = self._state(self.len[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._clone(p, q, c)
        return cur

    def hits(self, seq: list[int], items: set[int]) -> list[tuple[int, int]]:
        """Word ranges hit in a stretch of known word ids; adds the items to ``items``."""
        out: list[tuple[int, int]] = []
        nxt, link, size, window = self.next, self.link, self.len, self.window
        v = n = 0
        for i, c in enumerate(seq):
            while v and c not in nxt[v]:
                v = link[v]
                n = size[v]
            to = nxt[v].get(c)
            if to is None:
                continue
            v, n = to, n + 1
            long = 0
            if n >= window:
                long = window
                items |= self.holders[self.top[v]]
            m = self.mark[v]
            while m >= 0:
                for k, item in self.whole.get(m, ()):
                    if k <= n:
                        items.add(item)
                        long = max(long, k)
                m = self.mark[link[m]] if m else -1
            if long:
                if out and out[-1][1] >= i + 1 - long:
                    out[-1] = (min(out[-1][0], i + 1 - long), i + 1)
                    while len(out) > 1 and out[-2][1] >= out[-1][0]:
                        b = out.pop()
                        out[-1] = (min(out[-1][0], b[0]), b[1])
                else:
                    out.append((i + 1 - long, i + 1))
        return out


def _pieces(bench: DataFrame, item_col: str, text_col: str, window: int, piece_words: int) -> DataFrame:
    """(item, words, n): the words of each distinct item, space-joined, in overlapping pieces."""
    items = (bench.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("t"))
             .where("item IS NOT NULL AND t IS NOT NULL").distinct())
    size = max(piece_words, window)
    hop = size - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ws = words(t.as_buffer().to_pybytes())
                parts = [ws[i:i + size] for i in range(0, max(len(ws) - window, 0) + 1, hop)] if ws else []
                if parts:
                    yield pa.RecordBatch.from_pydict({
                        "item": pa.array([item] * len(parts), pa.string()),
                        "words": pa.array([b" ".join(p) for p in parts], pa.binary()),
                        "n": pa.array([len(p) for p in parts], pa.int64())})

    return map_arrow(items, run, "item string, words binary, n bigint")


class _Built:
    """A pickled automaton: shipped as it is and made whole again where a task unpickles it."""

    def __init__(self, raw: bytes):
        self.raw = raw

    def __reduce__(self):
        return pickle.loads, (self.raw,)


def _automata(pieces: DataFrame, window: int, shard_words: int) -> DataFrame:
    """(shard, auto): one pickled automaton per shard, built in tasks."""
    n = int((pieces.agg(F.sum("n")).first()[0] or 0) // shard_words) + 1

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        items = sorted((i, bytes(w).split()) for i, w in zip(pdf["item"], pdf["words"], strict=True))
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1].to_numpy(), "auto": [pickle.dumps(Automaton(items, window))]})

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(n)).cast("int"))
    return stash(dealt.groupBy("shard").applyInPandas(build, "shard int, auto binary"), "automata")


RESULT = "struct<n_words:bigint,spans:array<struct<a:int,b:int>>,items:array<string>>"
_SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
_ARROW = pa.struct([("n_words", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string()))])


def _union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _find(auto: Automaton, text: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
    ws = words(text)
    spans: list[tuple[int, int]] = []
    items: set[int] = set()
    if auto.ids and len(ws) >= auto.shortest:
        get = auto.ids.get
        ids = np.array([get(w, -1) for w in ws], np.int64)
        cut = np.flatnonzero(ids < 0)
        a = np.concatenate([[0], cut + 1])
        e = np.concatenate([cut, [len(ids)]])
        for k in np.flatnonzero(e - a >= auto.shortest):
            base = int(a[k])
            spans += [(base + x, base + y) for x, y in auto.hits(ids[a[k]:e[k]].tolist(), items)]
    return len(ws), spans, items


def annotate(docs: DataFrame, bench: DataFrame, window: int = 13, text_col: str = "text", out_col: str = "hits",
             item_id_col: str = "item_id", item_text_col: str = "text", shard_words: int = SHARD_WORDS,
             piece_words: int = PIECE_WORDS) -> DataFrame:
    """Adds ``out_col``: struct(n_words; spans, the disjoint ascending word ranges that lie in
    an occurrence of a window; items, the ids of items with such windows). The documents are not
    shuffled: they stream through one step per shard, which unites its finds with the earlier ones."""
    sc = docs.sparkSession.sparkContext
    at = docs.columns.index(text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = docs.withColumn(out_col, F.lit(None).cast(RESULT))
    built = _automata(_pieces(bench, item_id_col, item_text_col, window, piece_words), window, shard_words)
    shards = sorted(r["shard"] for r in built.select("shard").collect())  # a number per shard
    kept, held = None, []
    for k, shard in enumerate(shards or [None]):
        if k and k % SHARDS_A_PASS == 0:
            done, kept = kept, stash(out, "hits")
            out = kept
            for x in held:
                x.unpersist()
            held.clear()
            if done is not None:
                release(done)
        raw = (bytes(built.where(F.col("shard") == shard).first()["auto"]) if shard is not None
               else pickle.dumps(Automaton([], window)))
        shared = sc.broadcast(_Built(raw))
        held.append(shared)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            auto = shared.value
            for b in batches:
                rows = []
                for t, old in zip(b.column(at), b.column(b.num_columns - 1).to_pylist(), strict=True):
                    t = t.as_buffer()
                    n, spans, found = _find(auto, t.to_pybytes() if t is not None else b"")
                    if old:
                        spans = _union(spans + [(x["a"], x["b"]) for x in old["spans"]])
                        found |= set(old["items"])
                    rows.append({"n_words": n, "spans": [{"a": x, "b": y} for x, y in spans],
                                 "items": sorted(found)})
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(rows, _ARROW)], names=b.schema.names)

        out = map_arrow(out, run, f"{fields}, `{out_col}` {RESULT}")
    return out


def _n_hit(col: str):
    return F.aggregate(F.col(f"{col}.spans"), F.lit(0).cast("long"),
                       lambda acc, x: acc + (x["b"] - x["a"]).cast("long"))


def contaminated(col: str = "hits", share: int = 20):
    """n_hit > 0 and share * n_hit >= n_words (the contract's rule at 20)."""
    n = _n_hit(col)
    return (n > 0) & (n * share >= F.col(f"{col}.n_words"))


def report(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The contract's columns for every document."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    names = F.array_join(F.array_sort("hits.items"), ",")
    return annotate(src, bench, text_col="t", **kw).select(
        F.col("id").alias(id_col), F.col("hits.n_words").alias("n_words"), _n_hit("hits").alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"), contaminated("hits").alias("contaminated"))


def decontaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text", min_span: int | None = None,
                  share: int = 20, **kw) -> DataFrame:
    """Documents whose hit words reach the coverage limit go (``contaminated``). With
    ``min_span``, spans of at least so many words are also cut out of the documents that stay
    (with the separators up to the next word). Columns as given."""
    out = "hits"
    while out in docs.columns:
        out += "_"
    kept = annotate(docs, bench, text_col=text_col, out_col=out, **kw).where(~contaminated(out, share))
    if min_span is not None:
        at, names = docs.columns.index(text_col), docs.columns

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = [_cut(t, [(x["a"], x["b"]) for x in h["spans"] if x["b"] - x["a"] >= min_span])
                         for t, h in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True)]
                cols = list(b.columns[:-1])
                cols[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(cols, names=names)

        return map_arrow(kept, cut, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
    return kept.drop(out)


def _cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    if not text or not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    spaced = b" " + raw.translate(_CLEAN)
    is_space = np.frombuffer(spaced, np.uint8) == 0x20
    starts = np.append(np.flatnonzero(is_space[:-1] & ~is_space[1:]), len(raw))
    parts, last = [], 0
    for a, b in spans:
        parts.append(raw[last:starts[a]])
        last = starts[b]
    return b"".join([*parts, raw[last:]]).decode("utf-8", "surrogatepass")

"""Operator 10, personal data: base patterns and information-theoretic sanitisation.

Base spans are found by fixed patterns per kind. The method adds terms that give protected
entities away. A term is a run of ASCII letters and non-ASCII bytes, A-Z folded, outside base
spans; an entity is the value of a base span. Over the whole corpus are counted: how often a
term lies within ``REACH`` words of an entity, in how many different contexts, how often the
term occurs at all, and how many words there are. A term discloses an entity if

- P(entity | term) = near(term, entity) / occurrences(term) is at least ``MIN_SHARE``,
- that also holds with one more occurrence away from the entity, counted over different
  contexts (copies of one passage are one context) and smoothed by P(entity); this weighs
  rare terms, those met in ``MIN_CONTEXTS`` contexts or more need not pass it, and
- the pointwise information log2(P(entity | term) / P(entity)) is at least ``MIN_BITS``.

So a term met once with an entity discloses it if it occurs nowhere else.

Such terms are spans of the kind ``term`` wherever they occur. ``sanitise`` generalises spans:
each is replaced by its kind's mark.

Edge cases: a null text is empty and has no spans; a null id stays null; repeated rows count
as one context and give repeated rows; an empty table gives an empty result; only the id and
text columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import Words, bitmap, chunks, has_bits, map_arrow, stash, text_buffer

REACH = 5
MIN_CONTEXTS = 3
MIN_SHARE = 0.5
MIN_BITS = 4.0

KINDS = ("email", "ip", "card", "phone", "term")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never starts inside a run of digits: the run's first digit would have matched before,
# so the look-behind changes nothing but keeps long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_NOT_TERM = np.ones(256, bool)
_NOT_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, p = 0, text.find("@")
    while p >= 0:
        s = p
        while s > last and text[s - 1] in _LOCAL:
            s -= 1
        if s < p and (m := _DOMAIN.match(text, p + 1)):
            yield s, m.end()
            last = m.end()
        p = text.find("@", max(p + 1, last))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in code points, sorted."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _entity(text: str, span: tuple[int, int, int]) -> int:
    s, kind, e = span
    value = text[s:e].lower() if kind < 2 else re.sub(r"[^0-9]", "", text[s:e])
    return xxhash.xxh3_64_intdigest(f"{kind}:{value}") - (1 << 63)


class _Doc:
    """One text with base spans: its terms outside them, in bytes and code points."""

    def __init__(self, text: str, raw: np.ndarray, spans: list[tuple[int, int, int]]):
        self.lead = np.flatnonzero((raw & 0xC0) != 0x80) if len(raw) > len(text) else None
        raw = raw.copy()
        self.byte_spans = [(self.byte(s, len(raw)), self.byte(e, len(raw))) for s, _, e in spans]
        for a, b in self.byte_spans:
            raw[a:b] = 0x20
        self.words = Words(raw, np.array([0, len(raw)]), _NOT_TERM, fold=True)

    def byte(self, p: int, n: int) -> int:
        return p if self.lead is None else int(self.lead[p]) if p < len(self.lead) else n


def _near(docs: DataFrame, reach: int) -> DataFrame:
    """(h, e, c): a term within ``reach`` words of an entity, in a context (hash of its words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hs, es, cs = [], [], []
            for t in b.column(0).to_pylist():
                spans = base_spans(t)
                if not spans:
                    continue
                raw = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
                doc = _Doc(t, raw, spans)
                for span, (a, z) in zip(spans, doc.byte_spans, strict=True):
                    i = int(np.searchsorted(doc.words.starts, a))
                    j = int(np.searchsorted(doc.words.starts, z))
                    around = np.concatenate([doc.words.hash[max(0, i - reach):i], doc.words.hash[j:j + reach]])
                    if len(around):
                        hs.append(around.view(np.int64))
                        es += [_entity(t, span)] * len(around)
                        cs += [xxhash.xxh3_64_intdigest(around.tobytes()) - (1 << 63)] * len(around)
            if hs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hs)), pa.array(es, pa.int64()), pa.array(cs, pa.int64())], ["h", "e", "c"])

    return map_arrow(docs.select("t").where("t IS NOT NULL"), run, "h long, e long, c long")


def _occurrences(docs: DataFrame, wanted) -> DataFrame:
    """(h, n): occurrences of the terms in the bitmap, summed per batch; h null: all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for b in batches:
            raw, offs = text_buffer(b.column(0))
            for lo, hi in chunks(offs):
                words = Words(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], _NOT_TERM, fold=True)
                h = words.hash.view(np.int64)
                u, n = np.unique(h[has_bits(bits, h)], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*u.tolist(), None], pa.int64()), pa.array([*n.tolist(), len(h)], pa.int64())], ["h", "n"])

    return map_arrow(docs.select("t"), run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def disclosing_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH,
                     min_contexts: int = MIN_CONTEXTS, min_share: float = MIN_SHARE,
                     min_bits: float = MIN_BITS) -> DataFrame:
    """(h, share, bits): the terms that exceed the disclosure thresholds for some entity."""
    src = docs.select(F.col(text_col).alias("t"))
    met = (_near(src, reach).groupBy("h", "e", "c").agg(F.count("*").alias("k"))
           .groupBy("h", "e").agg(F.sum("k").alias("near"), F.count("*").alias("contexts")))
    met = stash(met, "near")
    entity = met.groupBy("e").agg(F.sum("near").alias("around"))
    terms = met.select("h").distinct()
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(terms, "h", terms.count()))
    occ = stash(_occurrences(src, wanted), "occurrences")
    words = occ.where("h IS NULL").agg(F.sum("n")).first()[0] or 0
    share = F.col("near") / F.col("n")
    prior = F.col("around") / F.lit(words)
    smoothed = (F.col("contexts") + prior) / (F.col("contexts") / F.least(share, F.lit(1.0)) + 1)
    known = met.join(occ.where("h IS NOT NULL"), "h").where(share >= min_share).join(entity, "e").where(
        (F.col("contexts") >= min_contexts) | (smoothed >= min_share)).select(
        "h", F.least(share, F.lit(1.0)).alias("share"), F.log2(share / prior).alias("bits"))
    return (known.where(F.col("bits") >= min_bits)
            .groupBy("h").agg(F.max("share").alias("share"), F.max("bits").alias("bits")))


_SPAN = "array<struct<start:int,kind:int,end:int>>"
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_HIT_ARROW = pa.list_(pa.struct([("h", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))


def _scan(src: DataFrame, wanted, id_type: str) -> DataFrame:
    """(id, x, base, hits): base spans, and the words whose hash is in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for b in batches:
            raw, offs = text_buffer(b.column(1))
            texts = b.column(1).to_pylist()
            bases, hits = [], []
            for lo, hi in chunks(offs):
                words = Words(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], _NOT_TERM, fold=True)
                found = has_bits(bits, words.hash.view(np.int64))
                some = np.concatenate([[0], np.cumsum(found)])
                for d in range(lo, hi):
                    t = texts[d] or ""
                    spans = base_spans(t)
                    bases.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                    own: list[dict] = []
                    a, z = words.first[d - lo], words.first[d - lo + 1]
                    if some[z] > some[a]:
                        doc = _Doc(t, raw[offs[d]:offs[d + 1]], spans)
                        at = np.flatnonzero(has_bits(bits, doc.words.hash.view(np.int64)))
                        s, e = doc.words.starts[at], doc.words.ends[at]
                        if doc.lead is not None:
                            s, e = np.searchsorted(doc.lead, s), np.searchsorted(doc.lead, e)
                        own = [{"h": h, "start": x, "end": y} for h, x, y in
                               zip(doc.words.hash[at].view(np.int64).tolist(), s.tolist(), e.tolist(), strict=True)]
                    hits.append(own)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(bases, _SPAN_ARROW), pa.array(hits, _HIT_ARROW)],
                ["id", "x", "base", "hits"])

    return map_arrow(src, run, f"id {id_type}, x long, base {_SPAN}, hits array<struct<h:bigint,start:int,end:int>>")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """(id, x, base, terms) of every row: base spans and term spans, sorted structs of start,
    kind number and end; x is the row's key (hash of id and text)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    terms = stash(disclosing_terms(docs, id_col, text_col, **thresholds), "disclosing")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(terms, "h", terms.count()))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.xxhash64(id_col, text_col).alias("x"))
    rows = stash(_scan(src, wanted, id_type), "spans")
    exact = (rows.where(F.size("hits") > 0).select("x", F.explode("hits").alias("w"))
             .select("x", "w.*").join(terms.select("h"), "h")
             .groupBy("x").agg(F.array_sort(F.collect_set(F.struct(
                 "start", F.lit(KINDS.index("term")).alias("kind"), "end"))).alias("terms")))
    return rows.join(exact, "x", "left").select(
        F.col("id").alias(id_col), "x", "base", F.coalesce("terms", F.array().cast(_SPAN)).alias("terms"))


def _as_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The contract's columns for every document."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(k) for k in range(4)]
    return find(docs, id_col=id_col, **kw).select(
        id_col, *counts, F.sha2(_as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _as_text(F.array_sort(F.concat("base", "terms"))).alias("spans"), F.size("terms").cast("long").alias("n_term"))


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """Spans (start, kind, end) replaced by the mark of their kind; overlapping spans become one."""
    if not text or not spans:
        return text
    parts, last = [], 0
    for s, k, e in sorted(spans):
        if s >= last:
            parts += [text[last:s], f"<{KINDS[k].upper()}>"]
        last = max(last, e)
    return "".join([*parts, text[last:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """``docs`` with every span replaced by its kind's mark in the text; the same columns."""
    names = docs.columns
    found = find(docs, id_col, text_col, **thresholds).select(
        F.col("x"), F.concat("base", "terms").alias("spans")).dropDuplicates(["x"])
    own = [F.col(f"d.`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    joined = docs.alias("d").join(found.alias("f"), F.xxhash64(f"d.{id_col}", f"d.{text_col}") == F.col("f.x"), "left").select(
        *own, "f.spans")
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(b.columns[:-1])
            cols[at] = pa.array([redact(t, [(s["start"], s["kind"], s["end"]) for s in spans or ()])
                                 for t, spans in zip(cols[at].to_pylist(), b.column(len(names)).to_pylist(), strict=True)],
                                pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=[f"c{i}" for i in range(len(cols))])

    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    return map_arrow(joined, run, fields).toDF(*names)

"""Operator 1, token counts: heap-and-linked-list byte-pair merging.

A text is cut at the added-token strings of the tokenizer file (each counts as one token,
the library's default), the rest by the file's byte-level pattern. In every piece the
adjacent pair of the lowest merge rank (leftmost on ties) is popped from a heap and merged
in a linked list; the count is the number of initial symbols less the number of merges.
No ids are built.

Edge cases: a null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated
rows give repeated rows; an empty table gives an empty result; only the id and text columns
are read, so other columns never clash. One very long piece costs n log n.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import chunks, map_arrow, text_buffer
from parlance.llm.pieces import Memo, class_table, pieces


class Merges:
    """Merge table of a byte-level BPE tokenizer file (the ``tokenizers`` JSON layout)."""

    def __init__(self, spec: dict):
        model = spec["model"]
        ids = {t: i for i, t in enumerate(model["vocab"])}
        self.byte_id = [ids[c] for c in byte_alphabet()]
        self.rank: dict[int, int] = {}  # by left id << 20 | right id
        self.merged: list[int] = []
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[ids[a] << 20 | ids[b]] = rank
            self.merged.append(ids[a + b])

    def count(self, piece: bytes) -> int:
        """Tokens of one piece: its bytes less the merges."""
        sym = [self.byte_id[b] for b in piece]
        n = len(sym)
        rank, merged = self.rank.get, self.merged
        bits = n.bit_length()
        low = (1 << bits) - 1
        heap = [r << bits | i for i in range(n - 1) if (r := rank(sym[i] << 20 | sym[i + 1])) is not None]
        if not heap:
            return n
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merges = 0
        while heap:
            top = heappop(heap)
            i = top & low
            j = after[i]
            # a merged-away symbol is -1; a pair that has changed has another rank, or none
            if j >= n or sym[i] < 0 or rank(sym[i] << 20 | sym[j]) != top >> bits:
                continue
            merges += 1
            new = sym[i] = merged[top >> bits]
            sym[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(new << 20 | sym[k])) is not None:
                    heappush(heap, r << bits | i)
            h = before[i]
            if h >= 0 and (r := rank(sym[h] << 20 | new)) is not None:
                heappush(heap, r << bits | h)
        return n - merges


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: bytes that
    print as themselves keep their code point, the others are numbered from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = (chr(256 + i) for i in range(256))
    return [chr(b) if b in keep else next(extra) for b in range(256)]


@lru_cache(maxsize=2)
def _memo(spec_json: str) -> Memo:
    """Per Python worker, so later tasks find the pieces of earlier ones."""
    return Memo(Merges(json.loads(spec_json)).count)


def _without_added(col: pa.Array, added: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Stretches between added-token strings, the row of each, and the strings found by row."""
    found = np.zeros(len(col), np.int64)
    if not added or not any(pc.any(pc.match_substring(col, a)).as_py() for a in added):
        return col, np.arange(len(col)), found
    cut = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))).split
    parts, rows = [], []
    for i, t in enumerate(col.to_pylist()):
        own = cut(t) if t else [t]
        found[i] = len(own) - 1
        parts += own
        rows += [i] * len(own)
    return pa.array(parts, pa.large_string()), np.array(rows), found


def count_tokens(docs: DataFrame, spec_json: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; ``spec_json`` is the content of the
    tokenizer file, read by the caller, so executors need no path."""
    shared = docs.sparkSession.sparkContext.broadcast((spec_json, class_table(spec_json)))
    added = [t["content"] for t in json.loads(spec_json).get("added_tokens", [])]
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, classes = shared.value
        get = _memo(spec).__getitem__
        for b in batches:
            col, rows, out = _without_added(b.column(1), added)
            raw, offs = text_buffer(col)
            for lo, hi in chunks(offs):
                cut, first = pieces(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], classes)
                sums = np.concatenate([[0], np.cumsum(np.fromiter(map(get, cut), np.int64, len(cut)))])
                np.add.at(out, rows[lo:hi], sums[first[1:]] - sums[first[:-1]])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(out)], ["id", "n_bytes", "n_tokens"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"),
                      F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n"))
    return map_arrow(src, run, f"id {id_type}, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

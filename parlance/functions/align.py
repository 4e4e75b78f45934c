"""Word alignment (TXT10): substitutions, deletions, insertions and hits per text pair.

Rule: minimum edit cost (S + D + I), and among minimum-cost alignments the one with
the most hits. One integer carries both: ``cost * B - hits`` is minimised with
substitution and indel weight ``B`` and match weight ``-1``. With N reference words,
M hypothesis words, cost C and hits H:

    D = C + H - M,  I = C + H - N,  S = N + M - 2H - C

The DP runs in Python workers on Arrow batches. Common prefix and suffix words are
matched first (always part of some optimal alignment under these weights). Pairs of
similar length are aligned together inside Ukkonen's diagonal band, widened until it
provably holds the optimum; a numpy step is one antidiagonal of the band for the whole
group. A batch's texts are split into words a few at a time: only their codes are kept.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALIGN_TYPE = T.StructType([
    T.StructField("n_ref", T.LongType()),
    T.StructField("n_hyp", T.LongType()),
    T.StructField("substitutions", T.LongType()),
    T.StructField("deletions", T.LongType()),
    T.StructField("insertions", T.LongType()),
    T.StructField("hits", T.LongType()),
])


def _trim_common(a: list, b: list) -> tuple[int, list, list]:
    """Strip the common prefix and suffix; return (matched count, rest of a, rest of b)."""
    p = 0
    n = min(len(a), len(b))
    while p < n and a[p] == b[p]:
        p += 1
    s = 0
    while s < n - p and a[len(a) - 1 - s] == b[len(b) - 1 - s]:
        s += 1
    return p + s, a[p:len(a) - s], b[p:len(b) - s]


def _prepared(ref: list[str], hyp: list[str]):
    """Trim common ends, put the shorter side outer, code the words: one word of both sides alike from 2
    on, the others as 0 (outer) and 1 (inner), which match nothing."""
    fixed, a, b = _trim_common(ref, hyp)
    if not a or not b:
        return fixed, None, None, 0
    if len(a) > len(b):
        a, b = b, a
    codes = {w: c for c, w in enumerate(set(a).intersection(b), start=2)}
    ai = np.fromiter(map(codes.get, a, repeat(0)), np.uint32, len(a))
    bi = np.fromiter(map(codes.get, b, repeat(1)), np.uint32, len(b))
    return fixed, ai, bi, len(codes) + 2


def _fewest_edits(ai: np.ndarray, bi: np.ndarray, n_codes: int) -> int:
    """A lower bound of the cost: words of the longer side that cannot be matched, whatever the order."""
    both = np.minimum(np.bincount(ai, minlength=n_codes)[2:], np.bincount(bi, minlength=n_codes)[2:])
    return len(bi) - int(both.sum())


def _aligned(pairs: list[tuple[np.ndarray, np.ndarray]], n_codes: int, k: int) -> list[tuple[int, int]]:
    """(cost, indels) of the best alignment of every pair inside its diagonals [-k, (m - n) + k], n <= m.

    One numpy step is an antidiagonal t = i + j of all pairs, so no cell of a step depends on another.
    Cells lie by (diagonal, pair), those of even t in ``even``, of odd t in ``odd``, and hold
    ``S * (b + 1) + F * (2 * b + 1)``: S substitutions and 2 F indels (one more where t is odd; an
    indel counts when it ends on an even t). With cost C that is ``(C - t % 2) * (b + 1) - F``: the least
    cost, then the most indels, hence the most hits, as b is at least half of any cost. Words are coded
    in steps of a power of two above b + 1, so ``min(x ^ y, b + 1)`` is 0 for a match, else b + 1.
    Pairs should have similar lengths; a padded cell is never read by a pair's own last cell.
    """
    P = len(pairs)
    n, m = max(len(a) for a, _ in pairs), max(len(b) for _, b in pairs)
    b = m // 2 + 1
    step, edit = (b + 1).bit_length(), 2 * b + 1
    most = max((b + 1) * (m + 4) + edit, (n_codes << step) + (1 << step))
    dt = np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64
    lo = -min(k, n)
    lo -= lo % 2  # even, at or below
    hi = min(max(len(b) - len(a) for a, b in pairs) + k, m)
    half = (hi - lo + 1) // 2  # even: lo .. lo + 2 half; odd: one less, between
    A = np.zeros((n, P), dt)  # from the last word to the first
    B = np.full((m, P), 1 << step, dt)
    last: dict[int, list[tuple[int, int]]] = {}
    for r, (x, y) in enumerate(pairs):
        A[n - len(x):, r] = (x.astype(dt) << dt(step))[::-1]
        B[:len(y), r] = y.astype(dt) << dt(step)
        last.setdefault(len(x) + len(y), []).append((r, len(y) - len(x)))
    far = np.iinfo(dt).max - edit - 1
    even = np.empty((half + 1, P), dt)
    odd = np.full((half + 2, P), far, dt)  # a border to each side
    even[:] = (np.abs(lo + 2 * np.arange(half + 1)) // 2 * edit).astype(dt)[:, None]
    odd[1:-1] = (np.abs(lo + 1 + 2 * np.arange(half)) // 2 * edit).astype(dt)[:, None]
    x, near = np.empty((half + 1, P), dt), np.empty((half + 1, P), dt)
    miss, edit = np.full((half + 1, P), b + 1, dt), dt(edit)  # numpy takes far longer for the least of an array and a number
    out: list[tuple[int, int]] = [(0, 0)] * P
    views: list[tuple] = [(0, 0), (0, 0)]  # of even and odd steps; in the middle part they stay the same
    for t in range(2, max(last) + 1):
        side = t % 2
        base = lo + side
        q0 = max(0, (max(t - 2 * n, 2 - t) - base + 1) // 2)
        q1 = min(half + 1 - side, (min(t - 2, 2 * m - t) - base) // 2 + 1)
        if q0 < q1:
            if views[side][:2] != (q0, q1):
                views[side] = (q0, q1, x[:q1 - q0], near[:q1 - q0], miss[:q1 - q0]) + (
                    (odd[q0 + 1:q1 + 1], even[q0:q1], even[q0 + 1:q1 + 1]) if side else (even[q0:q1], odd[q0:q1], odd[q0 + 1:q1 + 1]))
            _, _, g, h, most, cells, before, after = views[side]
            u, v = n - (t - base) // 2 + q0, (t + base) // 2 - 1 + q0
            np.bitwise_xor(A[u:u + q1 - q0], B[v:v + q1 - q0], out=g)
            np.minimum(g, most, out=g)
            np.add(g, cells, out=g)
            np.minimum(before, after, out=h)
            if not side:
                np.add(h, edit, out=h)
            np.minimum(g, h, out=cells)
        for r, d in last.get(t, ()):
            z = int(odd[(d - base) // 2 + 1, r] if side else even[(d - base) // 2, r])
            c = -(-z // (b + 1))
            out[r] = c + side, 2 * (c * (b + 1) - z) + side
    return out


#: Cells of one numpy step, and the words of the pairs that are aligned together: some ten MB
#: each, whatever the texts and their number. Pairs are filled up to the longest of their group by
#: FILL at most, and by OVERHEAD cells a step, which cost less than a step of another group.
STEP_CELLS, GROUP_WORDS, FILL, OVERHEAD = 24_000, 2_000_000, 1.3, 5_000


def _groups(todo: list[tuple]) -> Iterable[tuple[int, list[tuple]]]:
    """(k, pairs) of pairs to be aligned together, longest first: a pair joins the group before it unless
    too many cells would have to be filled up."""
    todo.sort(key=lambda p: (-len(p[4]), p[0], p[1]))
    group: list[tuple] = []
    for p in todo:
        n, m = len(p[4]), len(p[5])
        if group:
            size, k2, m2, more2 = len(group) + 1, max(k, p[0]), max(m_max, m), max(more, m - n)
            steps, cells, mine = n_max + m2, size * (k2 + more2 // 2 + 1), (n + m) * (p[0] + (m - n) // 2 + 1)
            if (steps * (cells - OVERHEAD) <= FILL * (own + mine) and cells <= STEP_CELLS and size * m2 <= GROUP_WORDS):
                group.append(p)
                k, m_max, more, own = k2, m2, more2, own + mine
                continue
            yield k, group
        group, k, n_max, m_max, more, own = [p], p[0], n, m, m - n, (n + m) * (p[0] + (m - n) // 2 + 1)
    if group:
        yield k, group


def _solved(todo: list[tuple]) -> Iterable[tuple[int, int, int]]:
    """(pair, cost, hits) of prepared pairs.

    Ukkonen's band: an alignment that leaves diagonals [-k, (m - n) + k] has at least
    (m - n) + 2k + 2 indels, so a banded optimum of cost <= (m - n) + 2k + 1 is the global one
    (cost dominates the hit tie-break); otherwise k doubles.
    """
    while todo:
        again = []
        for k, group in _groups(todo):
            found = _aligned([(p[4], p[5]) for p in group], max(p[3] for p in group), k)
            for (_, at, fixed, n_codes, ai, bi), (cost, indels) in zip(group, found):
                n, m = len(ai), len(bi)
                if cost <= (m - n) + 2 * k + 1 or k >= n:
                    yield at, cost, (n + m - 2 * cost + indels) // 2 + fixed
                else:
                    again.append((min(2 * k, n), at, fixed, n_codes, ai, bi))
        todo = again


def cost_and_hits_many(pairs: Iterable[tuple[list[str], list[str]]]) -> list[tuple[int, int]]:
    """``cost_and_hits`` for many pairs, which may come from a generator: of the pairs that wait for
    others of their length only the coded words are kept, ``GROUP_WORDS`` of a side at most."""
    res: list[tuple[int, int] | None] = []
    todo, words = [], 0
    for at, (r, h) in enumerate(pairs):
        fixed, ai, bi, n_codes = _prepared(r, h)
        res.append((max(len(r), len(h)) - fixed, fixed) if ai is None else None)
        if ai is None:
            continue
        # the first k allows half as many edits again as the words without a partner need
        k = 4 + max(0, _fewest_edits(ai, bi, n_codes) * 3 // 2 - (len(bi) - len(ai))) // 2
        todo.append((min(k, len(ai)), at, fixed, n_codes, ai, bi))
        words += len(bi)
        if words >= GROUP_WORDS:
            for i, *found in _solved(todo):
                res[i] = tuple(found)
            todo, words = [], 0
    for i, *found in _solved(todo):
        res[i] = tuple(found)
    return res  # type: ignore[return-value]


def cost_and_hits(ref: list[str], hyp: list[str]) -> tuple[int, int]:
    """Minimum edit cost and, at that cost, maximum hits (exact)."""
    return cost_and_hits_many([(ref, hyp)])[0]


def align_words(ref: list[str], hyp: list[str]) -> tuple[int, int, int, int, int, int]:
    """(N, M, S, D, I, H) for two word lists."""
    n, m = len(ref), len(hyp)
    c, h = cost_and_hits(ref, hyp)
    return n, m, n + m - 2 * h - c, c + h - m, c + h - n, h


def _words(t) -> list[str]:
    return [] if t is None else t.split()


def _counts(pairs: Iterable[tuple[list[str], list[str]]]) -> tuple[list, list, list, list]:
    """Words of both sides, cost and hits of every pair."""
    n, m = [], []

    def counted():
        for r, h in pairs:
            n.append(len(r))
            m.append(len(h))
            yield r, h
    found = cost_and_hits_many(counted())
    return n, m, [c for c, _ in found], [h for _, h in found]


def align_many(pairs: Iterable[tuple[list[str], list[str]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(N, M, S, D, I, H) for many word-list pairs."""
    return [(n, m, n + m - 2 * h - c, c + h - m, c + h - n, h) for n, m, c, h in zip(*_counts(pairs))]


#: Rows whose texts are Python strings at a time.
SLICE = 128


@F.arrow_udf(ALIGN_TYPE)
def _align_udf(ref: pa.Array, hyp: pa.Array) -> pa.Array:
    def pairs():
        for lo in range(0, len(ref), SLICE):
            for r, h in zip(ref.slice(lo, SLICE).to_pylist(), hyp.slice(lo, SLICE).to_pylist()):
                yield _words(r), _words(h)
    n, m, c, hits = (np.array(x, np.int64) for x in _counts(pairs()))
    cols = [n, m, n + m - 2 * hits - c, c + hits - m, c + hits - n, hits]
    return pa.StructArray.from_arrays([pa.array(x) for x in cols], fields=[pa.field(f.name, pa.int64()) for f in ALIGN_TYPE])


def align(ref_norm: Column, hyp_norm: Column) -> Column:
    """Struct of word counts for a normalised reference/hypothesis pair (null -> "")."""
    return _align_udf(F.coalesce(ref_norm, F.lit("")), F.coalesce(hyp_norm, F.lit("")))


def wer(s: Column, d: Column, i: Column, h: Column) -> Column:
    """(S + D + I) / (H + S + D); null when the reference is empty."""
    n = h + s + d
    return F.when(n > 0, (s + d + i).cast("double") / n)


def wil(s: Column, d: Column, i: Column, h: Column) -> Column:
    """1 - (H / (H + S + D)) * (H / (H + S + I)); 1 for an empty prediction, null when the
    reference is empty."""
    n = h + s + d
    m = h + s + i
    both = F.when(m > 0, (h.cast("double") / n) * (h.cast("double") / m)).otherwise(F.lit(0.0))
    return F.when(n > 0, F.lit(1.0) - both)

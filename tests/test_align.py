"""Word alignment against a brute-force DP, and the whole-text WER queries against a
pure-Python evaluation of the same pairs (the check used instead of a SQL oracle)."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parlance.functions.align import align_words, cost_and_hits, cost_and_hits_many
from parlance.functions import text as TX
from parlance.plans.catalog import QUERIES
from parlance.plans import fixtures as FX

SF = "/root/testdata/sf0.001"


def brute(r, h):
    B = 1 << 32
    prev = [j * B for j in range(len(h) + 1)]
    for i in range(1, len(r) + 1):
        cur = [i * B] + [0] * len(h)
        for j in range(1, len(h) + 1):
            cur[j] = min(prev[j] + B, cur[j - 1] + B, prev[j - 1] + (-1 if r[i - 1] == h[j - 1] else B))
        prev = cur
    v = prev[-1]
    c = -(-v // B)
    return c, c * B - v


words = st.lists(st.sampled_from(list("abcde")), max_size=14)


@settings(max_examples=400, deadline=None)
@given(words, words)
def test_alignment_matches_brute_force(r, h):
    assert cost_and_hits(r, h) == brute(r, h)
    n, m, s, d, i, hits = align_words(r, h)
    assert s + d + hits == n and s + i + hits == m and min(s, d, i, hits) >= 0
    assert (s + d + i == 0) == (r == h)


def test_pairs_of_any_length_together():
    """Many pairs at once: bands of several widths, padded groups, 16 and 32 bits, bands to be widened."""
    rng = random.Random(11)
    pairs = []
    for n, kinds in [(0, 3), (1, 2), (3, 2), (30, 3), (60, 40), (200, 4), (420, 300)] * 4:
        r = [str(rng.randrange(kinds)) for _ in range(n)]
        kept = [w for w in r if rng.random() < 0.8 for _ in range(rng.choice([1, 1, 2]))]
        pairs += [(r, kept), (kept, r), (r, r[::-1]), (r, r[n // 2:] + r[:n // 2]), (r, []), ([], r)]
    assert cost_and_hits_many(pairs) == [brute(r, h) for r, h in pairs]


def test_words_of_waiting_pairs_are_not_kept():
    """The pairs may come one by one; only a few lists of words live at a time."""
    live = [0, 0]

    class Words(list):
        def __init__(self, words):
            super().__init__(words)
            live[0] += 1
            live[1] = max(live)

        def __del__(self):
            live[0] -= 1
    got = cost_and_hits_many((Words("a b c d".split()), Words(["a", str(i), "d"])) for i in range(500))
    assert got == [(2, 2)] * 500 and live[1] <= 8


def test_tie_rule_prefers_hits():
    # 'a b' -> 'b a' costs 2 either way; the rule takes D=1, I=1, H=1
    assert align_words(["a", "b"], ["b", "a"]) == (2, 2, 0, 1, 1, 1)


def test_long_texts():
    rng = random.Random(7)
    ref = [str(rng.randint(0, 50)) for _ in range(400)]
    hyp = [w for k, w in enumerate(ref) if k % 7 != 3]
    hyp[10:10] = ["x", "y"]
    assert cost_and_hits(ref, hyp) == brute(ref, hyp)


def _python_corpus(rows):
    import unicodedata, re
    tot = {}
    for lang, r, h in rows:
        c = tot.setdefault(lang, [0, 0, 0, 0])
        _, _, s, d, i, hh = align_words(r.split(), h.split())
        for k, v in enumerate((s, d, i, hh)):
            c[k] += v
    return tot


def test_corpus_wer_by_lang_against_python(spark):
    got = {r["lang"]: r for r in QUERIES["corpus_wer_by_lang"](spark, SF).collect()}
    pairs = FX.doc_pairs(spark, SF)
    normed = pairs.select("lang", TX.hebrew_normalize(F.col("reference_text")).alias("r"),
                          TX.hebrew_normalize(F.col("predicted_text")).alias("h")).collect()
    want = _python_corpus([(x["lang"], x["r"], x["h"]) for x in normed])
    assert set(got) == set(want)
    for lang, (s, d, i, h) in want.items():
        g = got[lang]
        assert (g["substitutions"], g["deletions"], g["insertions"], g["hits"]) == (s, d, i, h)
        assert abs(g["wer"] - round((s + d + i) / (h + s + d), 6)) < 1e-9

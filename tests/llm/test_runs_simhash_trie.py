"""Periodic runs, SimHash and the prefix trie against brute force, on whole small tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from parlance.llm import periodic, simhash, trie
from parlance.llm.common import table
from parlance.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ---- periodic runs ----------------------------------------------------------------------

def all_runs(s, min_length=6, min_periods=4):
    out = {}
    for q in range(1, len(s) // min_periods + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_periods * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted((i, n, q) for (i, n), q in out.items())


def test_runs_are_all_maximal_repetitions():
    rng = random.Random(1)
    for _ in range(200):
        texts = []
        for _ in range(rng.randint(1, 5)):
            k, n = rng.choice([1, 2, 3, 8]), rng.choice([0, 1, 5, 20, 60])
            t = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < .5:
                a, p = rng.randrange(n), 1 + rng.randrange(6)
                t = t[:a] + [t[a + (i - a) % min(p, n - a)] for i in range(a, n)]
            texts.append(t)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        sym = np.array([x for t in texts for x in t], np.int64)
        for least in ((6, 4), (2, 2)):
            got = periodic.runs(sym, first, *least).tolist()
            assert got == [[i + int(first[d]), n, q] for d, t in enumerate(texts) for i, n, q in all_runs(t, *least)]


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id if doc_id is not None else "").encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected_runs(doc_id, text):
    words = planted(doc_id, SPACED.findall(text or ""))
    found = all_runs(words)
    keep = [not any(s + q <= i < s + n for s, n, q in found) for i in range(len(words))]
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(w for w, k in zip(words, keep, strict=True) if k)))


def test_runs_query_is_the_brute_force(spark):
    rows = [r for r in table(spark, SF, "documents").select("doc_id", "text").collect() if len(r["text"] or "") < 9000]
    long = [r for r in table(spark, SF, "documents").select("doc_id", "text").collect() if len(r["text"] or "") >= 9000]
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(rows) + len(long)
    for r in rows:
        assert got[r["doc_id"]] == expected_runs(*r)


def test_runs_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a " * 5), (5, "a " * 6), (5, "a " * 6), (None, "x y " * 9), (7, "p\tq\n" * 30_000)]
    df = spark.createDataFrame([(*r, "id", 3) for r in rows], "doc_id long, text string, id string, runs int")
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.detect(df).collect()), key=str)
    want = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 5, [], "a a a a a"), (5, 6, [(0, 6, 1)], "a"), (5, 6, [(0, 6, 1)], "a"),
            (None, 18, [(0, 18, 2)], "x y"), (7, 60_000, [(0, 60_000, 2)], "p q")]
    assert got == sorted(want, key=str)
    assert periodic.report(periodic.detect(periodic.with_planted_runs(df.limit(0)))).collect() == []
    assert len(periodic.report(periodic.detect(periodic.with_planted_runs(df))).collect()) == len(rows)


# ---- simhash ----------------------------------------------------------------------------

def fingerprint(text):
    words = SPACED.findall((text or "").translate(FOLD))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def expected_components(rows):
    fps = [fingerprint(t) for _, t in rows]
    classes = sorted(set(fps))
    root = {f: f for f in classes}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(classes):
        for b in classes[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    low = defaultdict(list)
    for (i, _), f in zip(rows, fps, strict=True):
        low[find(f)] += [i] if i is not None else []
    return sorted(((i, f"{f:016x}", min(low[find(f)], default=None)) for (i, _), f in zip(rows, fps, strict=True)), key=str)


def test_simhash_query_is_the_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op11_simhash"](spark, SF).collect()), key=str)
    assert got == expected_components(rows)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_pairs(radius):
    rng = np.random.default_rng(3)
    for _ in range(15):
        n = int(rng.integers(0, 300))
        v = rng.integers(0, 2**63, 5).astype(np.uint64)[rng.integers(0, 5, n)]
        for _ in range(4):
            v = v ^ np.where(rng.random(n) < .6, np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), np.uint64(0))
        g = np.sort(rng.integers(0, 4, n))
        a, b = simhash.near_pairs(g, v, radius)
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if g[i] == g[j] and (int(v[i]) ^ int(v[j])).bit_count() <= radius}
        assert len(a) == len(want) and set(zip(a.tolist(), b.tolist(), strict=True)) == want


@pytest.mark.parametrize("split", [4096, 3])
def test_no_link_is_lost_in_coarse_or_fine_buckets(spark, split):
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for _ in range(3):
        fps |= {f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))) for f in list(fps)}
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    linked = {r["k"]: r["c"] for r in simhash.components(simhash.stars(simhash.buckets(df, split))).collect()}
    root = {f: f for f in fps}
    for _ in fps:  # smallest reachable, by repeated relaxation
        new = {f: min(root[g] for g in fps if (f ^ g).bit_count() <= 2) for f in fps}
        if new == root:
            break
        root = new
    parts = defaultdict(set)
    for f in fps:
        s = f - (1 << 64) if f >> 63 else f
        parts[linked.get(s, s)].add(f)
    want = defaultdict(set)
    for f in fps:
        want[root[f]].add(f)
    assert sorted(map(sorted, parts.values())) == sorted(map(sorted, want.values()))


def test_simhash_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "one"), (3, "one"), (4, "One Two"), (None, "one two"), (None, "alone here now"), (6, "w " * 90_000)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, fp int, low string")
    got = sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str)
    assert got == expected_components(rows)
    none = simhash.near_duplicates(df.limit(0))
    assert none.collect() == [] and none.columns == ["doc_id", "fingerprint", "component_id"]


# ---- prefix trie ------------------------------------------------------------------------

def expected_trie(rows, heads=True):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append((t is not None, t or 0, r or "", x or ""))
    conv = {c: [x[2:] for x in sorted(v, key=lambda a: a[:2])] for c, v in conv.items()}
    new = {c: conv.get(c - c % 100, [])[:h] + own[h:] if heads else own
           for c, own in conv.items() for h in [zlib.crc32(str(c).encode()) % 6]}
    nodes, kids, total = defaultdict(list), defaultdict(list), {}
    for c, p in new.items():
        for d in range(len(p) + 1):
            nodes[tuple(p[:d])].append(c)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    for p in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[p]) - 1) * len(p[-1][1]) if p else 0
        total[p] = (sum(total[k][0] for k in kids[p]) if kids[p] else 1, own + sum(total[k][1] for k in kids[p]))
    return sorted(((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids[p]), *total[p],
                    sha(",".join(map(str, sorted(c for c in m if len(new[c]) == len(p)))))) for p, m in nodes.items()), key=str)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_trie_query_is_the_brute_force(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, QUERIES["op12_prefix_trie"](spark, sf).collect()), key=str)
    assert got == expected_trie(rows)


@pytest.mark.parametrize("shards,piece", [(1, 1 << 16), (3, 40), (40, 40)])
def test_trie_with_hot_prefixes_and_copies(spark, shards, piece):
    rng = random.Random(5)
    rows = []
    for c in range(500):
        path = ["a", "b"] if rng.random() < .3 else [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        rows += [(c, i if i else None, "u", x * rng.choice([1, 1, 1, 3])) for i, x in enumerate(path)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, trie.prefix_trie(trie.paths(df), shards, piece).collect()), key=str)
    assert got == expected_trie(rows, heads=False)


def test_trie_edge_cases(spark):
    rows = [(1, 0, None, None), (1, None, "u", "x"), (2, 0, "", ""), (None, 1, "u", "lost"), (3, 1, "u", "y" * 100_000), (3, 2, "u", "é😀"),
            (5, 1, "u", "z"), (5, 1, "u", "z"), (6, 1, "u", "z"), (7, 0, "u:", "z"), (8, 0, "u", ":z")]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], "conv_id long, turn long, role string, text string, path string, shard int")
    got = sorted(map(tuple, trie.prefix_trie(trie.paths(df)).collect()), key=str)
    assert got == expected_trie(rows, heads=False)
    planted = sorted(map(tuple, trie.prefix_trie(trie.with_planted_heads(trie.paths(df))).collect()), key=str)
    assert planted == expected_trie(rows)  # heads of a conversation 0 that is not there: some have no turns left
    assert trie.prefix_trie(trie.paths(df.limit(0))).collect() == []

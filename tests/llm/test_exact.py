"""The operators against the tokenizer libraries and brute force, on whole small tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from parlance.llm import bpe, decontam, jaccard, lines, pii, pieces, quality, tokens
from parlance.llm.common import Words, bitmap, has_bits, table, text_buffer
from parlance.llm.queries import QUERIES, tokenizer_file

SF = "/root/testdata/sf0.001"
RANKS = tokenizer_file("byte_bpe_50k.tiktoken")
SPEC = tokenizer_file("byte_bpe_50k.json").decode()
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}


def odd_texts(n=3000):
    rng = random.Random(7)
    parts = ["'s", "'re", "'", "''", " ", "  ", "\n", "\t", "\xa0", "a", "B", "sure", "ll", "é", "1", "٣", "!", "%%", "中", "😀",
             "࢏", "𖺠", "\x1c", "\x85", "​", "ñ", "<|endoftext|>", "aaaaaaa" * 20]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(n)]


def test_token_counts_are_the_library_s(spark, texts):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_str(SPEC)
    rows = [*texts.items(), *((10**6 + i, t) for i, t in enumerate(odd_texts()))]
    got = {r[0]: r for r in tokens.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), SPEC).collect()}
    for (i, t), e in zip(rows, tk.encode_batch([t for _, t in rows], add_special_tokens=False), strict=True):
        n = len(e.ids)
        assert tuple(got[i])[1:] == (len(t.encode()), n, n > 512), repr(t)


def test_codec_is_the_library_s(spark, texts):
    import tiktoken
    vocab = bpe.read_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=pieces.PATTERN, mergeable_ranks={t: i for i, t in enumerate(vocab)}, special_tokens={})
    rows = [*texts.items(), *((10**6 + i, t) for i, t in enumerate(odd_texts()))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in bpe.digests(bpe.decode(bpe.encode(df, RANKS), RANKS)).collect()}
    for i, t in rows:
        ids = enc.encode_ordinary(t)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_perfect_hash_is_a_bijection():
    keys = [str(i).encode() for i in range(5000)]
    h = bpe.PerfectHash(keys)
    assert sorted(h.key_of) == list(range(5000))
    assert h.candidates(keys).tolist() == list(range(5000))


def _op4_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(FOLD))


@pytest.mark.parametrize("shard_words", [200_000, 60])
def test_decontamination(spark, shard_words):
    rng = random.Random(3)
    word = [f"w{i}" for i in range(6)]
    items = [(i, " ".join(rng.choice(word) for _ in range(rng.choice([0, 1, 3, 12, 13, 20])))) for i in range(12)]
    docs = []
    for d in range(60):
        t = [rng.choice(word + ["zz"]) for _ in range(rng.randint(0, 60))]
        if d % 2:
            own = items[rng.randrange(12)][1].split()
            t[5:5] = own
        docs.append((d, " ".join(t)))
    out = decontam.report(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"), shard_words=shard_words).collect()
    windows = defaultdict(set)
    for i, t in items:
        w = _op4_words(t)
        n = min(13, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[p:p + n])].add(i)
    for r in out:
        w = _op4_words(docs[r["doc_id"]][1])
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if (k := tuple(w[p:p + n])) in windows:
                    hit |= set(range(p, p + n))
                    found |= windows[k]
        ids = ",".join(sorted(map(str, found)))
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (len(w), len(hit), len(found))
        assert r["items_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))


def test_long_items_are_dealt_out_in_overlapping_pieces(spark):
    """The same rows from one automaton over whole items and from many over pieces of 20 words."""
    rng = random.Random(5)
    items = [(f"i{k}", " ".join(f"v{rng.randrange(40)}" for _ in range(n))) for k, n in enumerate((0, 5, 13, 20, 21, 33, 500))]
    long = items[-1][1].split()
    docs = [(d, " ".join(["zz"] * 3 + long[d * 7:d * 7 + rng.choice([12, 13, 14, 40])] + ["zz"] + items[1][1].split())) for d in range(60)]
    docs = spark.createDataFrame([*docs, (60, None), (61, "")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    whole = decontam.report(docs, bench).collect()
    cut = decontam.report(docs, bench, shard_words=100, piece_words=20).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, cut))
    assert sum(r["n_items"] == 2 for r in whole) >= 30


def test_spans_are_cut_out(spark):
    item = " ".join(f"q{i}" for i in range(13))
    docs = spark.createDataFrame([(1, "é A b. " + " ".join(f"x{i}" for i in range(300)) + f" ({item.upper()}), end")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = decontam.decontaminate(docs, bench, min_span=13).collect()
    assert out[0]["text"] == docs.collect()[0]["text"].split("(")[0] + "(end"


def test_quality_base_figures(spark, texts):
    rows = [*texts.items(), (-1, "a b c d e a b c d e\nx\n \n x\nx"), (-2, "a a a a a a"), (-3, "#$ é|<\n\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.score(df, None).collect()}
    for i, t in rows:
        w = SPACED.findall(t)
        grams = Counter(tuple(w[p:p + 5]) for p in range(len(w) - 4))
        rep = {p + k for p in range(len(w) - 4) if grams[tuple(w[p:p + 5])] > 1 for k in range(5)}
        seen = [x for x in t.split("\n") if SPACED.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(seen) - len(set(seen)), len(rep))
        assert tuple(got[i])[1:6] == want
        assert got[i]["base_failed"] == (len(w) < 10 or 100 * len(rep) > 20 * len(w))


def brute_lines(rows, least=50, lines=1, line_words=2):
    seen, seen_lines, out = set(), set(), {}
    for d, t in sorted(rows):
        w = SPACED.findall(t)
        gone = [False] * len(w)
        at, starts = 0, []
        for line in t.split("\n"):
            n = len(SPACED.findall(line))
            starts += [at] if n else []
            at += n
        starts.append(at)
        for a, b in zip(starts, starts[lines:]):
            if b - a >= line_words:
                k = tuple(w[a:b])
                if k in seen_lines:
                    gone[a:b] = [True] * (b - a)
                seen_lines.add(k)
        for p in range(len(w) - least + 1):
            k = tuple(w[p:p + least])
            if k in seen:
                gone[p:p + least] = [True] * least
            seen.add(k)
        out[d] = [x for x, g in zip(w, gone, strict=True) if not g]
    return out


@pytest.mark.parametrize("n_lines", [1, 2])
def test_line_dedup(spark, texts, n_lines):
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(57))
    rows = list(texts.items())
    for d in range(40):
        t = " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randint(0, 90)))
        rows.append((10**6 + d, (t[:200] + (" " if d % 2 else "\n") + passage + "\n" + t[200:]) if d % 3 else t))
    rows += [(2 * 10**6, "the " * 400), (2 * 10**6 + 1, rows[-1][1])]
    footer = " ".join(f"f{i}" for i in range(10))
    rows += [(3 * 10**6 + d, f"own line {d}\n  {footer}\nyes\n" + "said twice\n" * (d % 3)) for d in range(4)]
    rows += [(4 * 10**6, "one line three times\n" * 3), (4 * 10**6 + 1, "short text"), (4 * 10**6 + 2, " short  text\n")]
    least = lines.Least(lines=n_lines)
    out = {r["doc_id"]: r for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string"), counts=True, least=least).collect()}
    want = brute_lines(rows, lines=n_lines)
    for d, t in rows:
        assert SPACED.findall(out[d]["text"]) == want[d]
        if out[d]["n_removed"] == 0:
            assert out[d]["text"] == t
    assert sum(passage in out[d]["text"] for d, _ in rows) == 1
    if n_lines == 1:
        assert sum(footer in out[d]["text"] for d, _ in rows) == 1
        assert out[4 * 10**6]["text"] == "one line three times" and out[4 * 10**6 + 2]["text"] == ""


@pytest.mark.parametrize("parts", [1, 2])
def test_line_dedup_keeps_rows_equal_in_id_and_text(spark, parts):
    own, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, own), (None, other), (1, own), (None, other), (2, f"x {own} y"), (3, f"{other} z")]
    df = spark.createDataFrame([], "doc_id long, text string")
    for k in range(parts):  # in two partitions the equal rows are apart
        df = df.unionByName(spark.createDataFrame(rows[2 * k:] if k else rows[:6 if parts == 1 else 2], df.schema).coalesce(1))
    out = sorted((repr(r["doc_id"]), r["text"]) for r in lines.dedup(df).collect())
    assert out == sorted([("1", own)] * 2 + [("None", other)] * 2 + [("2", "x y"), ("3", "z")])


def test_winnowing_guarantee():
    rng = np.random.default_rng(5)
    g = rng.integers(0, 9, 400).astype(np.uint64)
    picked = set(lines.winnow(g, 31).tolist())
    for p in range(400 - 31 + 1):
        low = g[p:p + 31].min()
        assert max(i for i in range(p, p + 31) if g[i] == low) in picked


def brute_components(rows):
    sets = {}
    for d, t in rows:
        w = SPACED.findall(t.translate(FOLD))
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = defaultdict(list)
    for d in sets:
        for g in sets[d]:
            where[g].append(d)
    for d in sets:
        for e, o in Counter(e for g in sets[d] for e in where[g] if e < d).items():
            if 100 * o >= 80 * len(sets[d] | sets[e]):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def test_jaccard_join(spark, texts):
    rng = random.Random(2)
    base = [f"b{i}" for i in range(120)]
    rows = list(texts.items())
    for d in range(150):  # edited copies of copies, some too far from their origin
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        if d % 10 == 9:
            base = w
        rows.append((10**6 + d, " ".join(w)))
    got = {r[0]: (r[1], r[2]) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def _valid(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        n = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return 12 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in n) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def test_base_spans(texts):
    rng = random.Random(9)
    parts = ["a.b@c.de", "@", "x@y", "x@y.z@w.v.u", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (487) 555-7209", "+", "-", " ", ".", "é", "12", "+49 30 1", "%", "001.002.003.004", "4242424242424242 7"]
    for t in [*texts.values(), *("".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000))]:
        want = sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(BASE) for m in re.finditer(p, t) if _valid(kind, m.group()))
        assert pii.base_spans(t) == want, t


def test_disclosing_terms(spark):
    rng = random.Random(4)
    w = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.choice('klmnop')}{rng.choice('rstuv')}" for _ in range(n))
    rows = [(i, f"{w(30)} Zorblax {w(1)} writes from jo@mail.example.com {w(20)}") for i in range(5)]
    rows += [(5, f"{w(10)} zorblax {w(10)}"), *((10 + i, w(60)) for i in range(60))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.report(df).collect()}
    t = rows[5][1]
    assert f"term:{t.index('zorblax')}:{t.index('zorblax') + 7}" in got[5]["spans"].split(",")
    assert all(got[i]["n_email"] == 1 and got[i]["n_term"] >= 1 for i in range(5))
    assert all(got[10 + i]["n_term"] == 0 for i in range(60))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert "jo@" not in clean[0] and "<EMAIL>" in clean[0] and "zorblax" not in clean[5]


def test_disclosing_terms_of_rare_entities(spark):
    rows = [(0, "the report of the day by Quixmire of the office jo@mail.example.com for the day"),
            *((i, "once the plan by Vandorf of the team al@mail.example.org ends the day") for i in (1, 2, 3)),
            (4, "the note by Torgate of the team ed@mail.example.net ends the day"), (5, "torgate of the office " * 2),
            *((10 + i, "once the report of the plan and the note by the office for the team ends the day") for i in range(60))]
    got = {r["doc_id"]: r for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, term in ((0, "Quixmire"), (1, "Vandorf"), (2, "Vandorf"), (3, "Vandorf")):
        at = rows[d][1].index(term)
        assert f"term:{at}:{at + len(term)}" in got[d]["spans"].split(",") and got[d]["n_term"] == 1
    assert all(got[d]["n_term"] == 0 for d, _ in rows[4:])


def test_word_hashes_and_bitmap(spark):
    raw, offs = text_buffer(pa.array(["a b", None, "A b", "", "b a"]))
    w = Words(raw, offs, fold=True)
    h = w.hash.tolist()
    assert w.first.tolist() == [0, 2, 2, 4, 4, 6] and h[0] == h[2] == h[5] and h[1] == h[3] == h[4] and h[0] != h[1]
    bits = bitmap(spark.range(0, 4000, 2).withColumnRenamed("id", "x"), "x", 2000)
    assert has_bits(bits, np.arange(0, 4000, 2)).all() and has_bits(bits, np.arange(1, 4000, 2)).mean() < 0.05


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op5_language_id", "op12_prefix_trie")])
def test_queries_return_a_row_for_each_of_their_table(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    n = table(spark, SF, "documents").count() if name != "op2_chat_format" else table(spark, SF, "conversations").select("conv_id").distinct().count() + 1
    assert len(rows) == n

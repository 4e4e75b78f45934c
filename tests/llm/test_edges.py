"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest

from parlance.llm import bpe, chat, decontam, jaccard, langid, lines, pii, quality, tokens, toxicity
from parlance.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, n_chars long, id string, t string, h long, x long, ids string, hits int, n_words int"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
TEXTS = [None, "", " \n\t ", "a", "one two three four five", "one two three four five", "!!! ???", "9" * 3000, LONG, LONG,
         "é ß 中文 😀 <|endoftext|> </s>[INST]", "Ab aB\n\nab"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, len(t) if t else 0, "i", "t", 1, 2, "z", 3, 4) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, "one two", None, None, None, None, None, None, None, None), (None, None) + (None,) * 8]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "one two three"), (1, "one two three"), (2, None), (3, ""), (None, "a"), (4, "?!")],
                                 "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 1), (8, 1, 0)],
                                 "doc_id long, quality int, toxic int")


SPEC = tokenizer_file("byte_bpe_50k.json").decode()
RANKS = tokenizer_file("byte_bpe_50k.tiktoken")
OPERATORS = {
    "tokens": lambda d, b, s: tokens.count_tokens(d, SPEC),
    "bpe": lambda d, b, s: bpe.digests(bpe.decode(bpe.encode(d, RANKS), RANKS)),
    "decontam": lambda d, b, s: decontam.report(d, b),
    "langid": lambda d, b, s: langid.predict(d, langid.dictionaries(d, lang_col="id")),
    "quality": lambda d, b, s: quality.score(d, quality.train(d, s)),
    "lines": lambda d, b, s: lines.dedup(d),
    "jaccard": lambda d, b, s: jaccard.join(d),
    "toxicity": lambda d, b, s: toxicity.score(d, toxicity.train(d, s)),
    "pii": lambda d, b, s: pii.report(d),
    "sanitise": lambda d, b, s: pii.sanitise(d),
    "reject": lambda d, b, s: toxicity.reject(d, None),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_comes_back_and_empty_tables_stay_empty(docs, empty, bench, labels, name):
    out = OPERATORS[name](docs, bench, labels)
    rows = out.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in docs.collect())
    none = OPERATORS[name](empty, bench.limit(0), labels.limit(0))
    assert none.collect() == [] and none.dtypes == out.dtypes


def test_filters_keep_the_columns(docs, bench):
    out = decontam.decontaminate(docs, bench)
    assert out.schema.simpleString() == docs.schema.simpleString()
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in out.collect()}
    assert gone == {4, 5}  # 3 of their 5 words are an item


def test_defined_values(docs, bench):
    hits = {r["doc_id"]: r for r in decontam.report(docs, bench).collect()}
    assert hits[0]["n_words"] == 0 and not hits[0]["contaminated"]
    sets = {r["doc_id"]: r for r in jaccard.join(docs).collect() if r["doc_id"] is not None}
    assert sets[0]["n_shingles"] == sets[1]["n_shingles"] == sets[2]["n_shingles"] == 0
    assert sets[3]["n_shingles"] == 1 and sets[5]["component_id"] == 4 and sets[9]["component_id"] == 8
    clean = {r["doc_id"]: r for r in lines.dedup(docs).collect()}
    assert clean[0]["text"] is None and clean[1]["text"] == "" and clean[4]["text"] == TEXTS[4] and clean[5]["text"] == ""
    assert clean[8]["text"] == LONG and clean[9]["text"] == "" and clean[9]["n_chars"] == 0
    lang = {r["doc_id"]: r for r in langid.predict(docs, [("en", b"one two three"), ("de", b"eins zwei drei")]).collect()}
    assert lang[0]["lang_pred"] == lang[6]["lang_pred"] == lang[7]["lang_pred"] == "und" and lang[4]["lang_pred"] == "en"


def test_chats(spark):
    rows = [(1, 2, "user", None), (1, 1, "assistant", "a [SEP] b"), (1, 1, "assistant", "a [SEP] b"), (1, 3, "user", "</s>[INST] x [/INST]"),
            (1, None, "system", "\\e\\l <<SYS>>"), (1, 4, None, "[ROLE] q\n[/ROLE]"), (1, 5, "to\nol", "<s>"), (None, 1, "user", "u")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in df.transform(chat.format_chats).select(
        "conv_id", "segments", chat.parse(chat.F.col("formatted")).alias("turns")).collect()}
    turns = [(t["role"], t["text"]) for t in out[1]["turns"]]
    order = sorted(rows[:7], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    assert turns == [(r[2] or "", r[3] or "") for r in order]
    assert [s["text"] for s in out[1]["segments"] if s["loss"]] == ["a \\bSEP] b"] * 2
    assert chat.report(df.limit(0)).collect() == []


def test_every_learned_language_has_a_dictionary(spark):
    rows = [(f"l{i}", f"short text {k} of l{i}") for i in range(10) for k in range(5)]
    rows += [(f"l{i}", f"long text of l{i} " * 600) for i in range(10)]
    dicts = dict(langid.dictionaries(spark.createDataFrame(rows, "lang string, text string"), dict_bytes=100))
    assert len(dicts) == 10 and all(len(d) >= 99 for d in dicts.values())

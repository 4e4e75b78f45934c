"""Label sequences for decoder training (TXT11, ARR1-ARR9, FLT4, AGG10).

The model-bundled subword tokenizer is out of scope; it is re-aimed as a word
dictionary that Spark builds from the data (distinct words, distributed positions) and
joins back, plus time markers ``<|x.xx|>`` mapped arithmetically. Ids:

    words            0 .. V-1              (V < 2^30 - 6)
    special tokens   TS_BEGIN-6 .. TS_BEGIN-1
    time markers     TS_BEGIN + round(t / 0.02),  t in [0, 30]

Everything after tokenisation is array expressions on one row: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.operators.ranks import with_position

# --- fixed layout of the re-aimed token space ----------------------------------------------
TS_BEGIN = 1 << 30
NO_TIMESTAMPS = TS_BEGIN - 1
START_OF_PREV = TS_BEGIN - 2
TRANSCRIBE = TS_BEGIN - 3
LANGUAGE = TS_BEGIN - 4
START_OF_TRANSCRIPT = TS_BEGIN - 5
END_OF_TEXT = TS_BEGIN - 6
PAD = END_OF_TEXT
TIME_PRECISION = 0.02
MAX_TIMESTAMP_TOKENS = 1501          # markers for 0.00 .. 30.00 s
MAX_TARGET_POSITIONS = 448           # decoder label limit
PREV_MAX = MAX_TARGET_POSITIONS // 2  # previous-text budget cap (224)
PREFIX_WITH_TS = [START_OF_TRANSCRIPT, LANGUAGE, TRANSCRIBE]
PREFIX_NO_TS = [START_OF_TRANSCRIPT, LANGUAGE, TRANSCRIBE, NO_TIMESTAMPS]
IGNORE = -100
# marker or word token inside a transcript
TOKEN_PATTERN = r"<\|[0-9]+\.[0-9]+\|>|[^\s<]+|<"
# ----------------------------------------------------------------------------------------------

_MAX_TIME = (MAX_TIMESTAMP_TOKENS - 1) * TIME_PRECISION


def split_tokens(text: Column) -> Column:
    """Marker and word strings of a transcript, in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN_PATTERN), 0)


def marker_id(tok: Column) -> Column:
    """Id of a ``<|x.xx|>`` token, null for words."""
    t = F.regexp_extract(tok, r"^<\|([0-9]+\.[0-9]+)\|>$", 1)
    return F.when(F.length(t) > 0, (F.lit(TS_BEGIN) + F.rint(t.cast("double") / TIME_PRECISION)).cast("int"))


def time_token(seconds: Column) -> Column:
    """Marker id for a time; null (error) above the last marker time."""
    return F.when(seconds <= _MAX_TIME, (F.lit(TS_BEGIN) + F.rint(seconds / TIME_PRECISION)).cast("int"))


def build_vocabulary(texts: DataFrame, text_col: str) -> DataFrame:
    """Distinct word tokens -> dense ids (0-based, byte order), computed without a
    single-task window."""
    words = (texts.select(F.explode(split_tokens(F.col(text_col))).alias("token"))
                  .filter(~F.col("token").rlike(r"^<\|[0-9]+\.[0-9]+\|>$"))
                  .distinct())
    return with_position(words, ["token"], name="token_id").withColumn("token_id", F.col("token_id").cast("int"))


def tokenize(df: DataFrame, key_cols: list[str], text_col: str, vocab: DataFrame, out_col: str) -> DataFrame:
    """TXT11: ``text_col`` -> ``out_col`` ARRAY<INT> (see ``tokenize_columns``)."""
    return tokenize_columns(df, key_cols, {out_col: text_col}, vocab)


def tokenize_columns(df: DataFrame, key_cols: list[str], columns: dict[str, str], vocab: DataFrame) -> DataFrame:
    """TXT11 for several text columns at once: one explode of all tokens tagged by
    column, one dictionary join, one ordered regroup per (row key, column) and one join
    back, whatever the number of columns. ``columns`` maps output -> text column."""
    outs = list(columns)
    def tag(k):
        return lambda t, i: F.struct(F.lit(k).alias("_c"), i.alias("_p"), t.alias("token"))
    tagged = F.flatten(F.array(*[F.transform(split_tokens(F.col(src)), tag(k))
                                 for k, src in enumerate(columns.values())]))
    toks = df.select(*key_cols, F.explode(tagged).alias("_t")).select(*key_cols, "_t._c", "_t._p", "_t.token")
    # markers are in no dictionary; spread by row, so that a frequent one is no hot join key
    spread = F.concat("token", F.lit("#"), F.pmod(F.xxhash64(*key_cols), F.lit(4096)).cast("string"))
    toks = toks.withColumn("_m", marker_id(F.col("token")))
    ids = (toks.withColumn("token", F.when(F.col("_m").isNotNull(), spread).otherwise(F.col("token")))
               .join(vocab, "token", "left")
               .withColumn("_id", F.coalesce("_m", "token_id")))
    grouped = (ids.groupBy(*key_cols)
                  .agg(*[F.array_sort(F.collect_list(F.when(F.col("_c") == k, F.struct("_p", "_id")))).alias(f"_s{k}")
                         for k in range(len(outs))])
                  .select(*key_cols, *[F.transform(f"_s{k}", lambda s: s["_id"]).alias(o) for k, o in enumerate(outs)]))
    out = df.join(grouped, key_cols, "left")
    for o in outs:
        out = out.withColumn(o, F.coalesce(F.col(o), F.array().cast("array<int>")))
    return out


def strip_markers(ids: Column) -> Column:
    """ARR1: drop time-marker ids."""
    return F.filter(ids, lambda x: x < TS_BEGIN)


def strippable(ids: Column) -> Column:
    """ARR2: markers may be stripped unless the text ends in two markers (open segment)."""
    return (F.size(ids) < 2) | (F.element_at(ids, -2) < TS_BEGIN)


def tail(ids: Column, k: Column) -> Column:
    """ARR3: Python ``ids[-k:]`` (k = 0 keeps all, negative k drops the first |k|)."""
    n = F.size(ids)
    start = (F.when(k > 0, F.greatest(n - k + 1, F.lit(1)))
              .when(k == 0, F.lit(1))
              .otherwise(-k + 1))
    return F.slice(ids, start.cast("int"), F.greatest(n, F.lit(1)))


def const_ids(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


def assemble_labels(ids: Column, prev_ids: Column, has_ts: Column, has_prev: Column,
                    train_ts: Column, cond_prev: Column, inject_synthetic: bool = False,
                    shift: Column | None = None, duration: Column | None = None) -> Column:
    """ARR1-ARR5 (A.9; TXT12 is moot for word ids). Returns the label array, or null when a synthetic marker
    would exceed the last marker time (the reference's failing row)."""
    has_ts = F.coalesce(has_ts, F.lit(False))
    has_prev = F.coalesce(has_prev, F.lit(False))
    use_prev = has_prev & cond_prev
    ids1 = F.when(has_ts & ~train_ts & strippable(ids), strip_markers(ids)).otherwise(ids)
    p = F.when(~train_ts & has_ts, strip_markers(prev_ids)).otherwise(prev_ids)
    k = F.least(F.lit(MAX_TARGET_POSITIONS) - F.size(ids1) - 5, F.lit(PREV_MAX))
    prev_part = F.when(use_prev, F.concat(const_ids([START_OF_PREV]), tail(p, k))).otherwise(F.array().cast("array<int>"))
    if inject_synthetic:
        s = shift if shift is not None else F.lit(0.0)
        inject = train_ts & ~has_ts & (F.size(prev_part) == 0)
        first, last = time_token(s), time_token(s + duration)
        wrapped = F.concat(F.array(first), ids1, F.array(last))
        ids2 = F.when(inject, wrapped).otherwise(ids1)
        ts_now = has_ts | inject
        bad = inject & (first.isNull() | last.isNull())
    else:
        ids2, ts_now, bad = ids1, has_ts, F.lit(False)
    prefix = F.when(ts_now & train_ts, const_ids(PREFIX_WITH_TS)).otherwise(const_ids(PREFIX_NO_TS))
    labels = F.concat(prev_part, prefix, ids2, const_ids([END_OF_TEXT]))
    return F.when(~bad, labels)


# ---- padding compression (ARR6/ARR7) ------------------------------------------------------------

def compress_padding(features: Column, mask: Column) -> Column:
    """ARR6: if the third-last mask value is 0, keep frames before (first zero + 1),
    one pad frame and the pad count; else keep all. Returns STRUCT<input_features,
    pad_value, pad_amount>."""
    n = F.size(mask)
    first_zero = F.array_position(mask, 0).cast("int")  # 1-based; frames kept = first_zero
    compress = (n >= 3) & (F.element_at(mask, -3) == 0)
    kept = F.when(compress, F.slice(features, 1, first_zero)).otherwise(features)
    pad_value = F.when(compress, F.element_at(features, first_zero + 1)).otherwise(F.array().cast("array<float>"))
    pad_amount = F.when(compress, F.size(features) - first_zero).otherwise(F.lit(0))
    return F.struct(kept.alias("input_features"), pad_value.alias("pad_value"), pad_amount.alias("pad_amount"))


def expand_padding(features: Column, pad_value: Column, pad_amount: Column) -> Column:
    """ARR7: append ``pad_amount`` copies of ``pad_value``."""
    return F.when(pad_amount > 0, F.concat(features, F.array_repeat(pad_value, pad_amount))).otherwise(features)


# ---- batching (AGG10, ARR8, ARR9) ---------------------------------------------------------------

def assign_batches(df: DataFrame, order_cols: list[str], batch_size: int) -> DataFrame:
    """Deterministic batches of ``batch_size`` consecutive rows in ``order_cols`` order."""
    return (with_position(df, order_cols, name="_bp")
            .withColumn("batch_id", F.floor(F.col("_bp") / batch_size).cast("bigint")).drop("_bp"))


def collate(df: DataFrame, labels_col: str = "labels") -> DataFrame:
    """ARR8: pad labels to the longest in the batch (AGG10), decoder input = all but
    the last, target = all but the first with padding -> -100, and the prompt up to
    and including the start-of-transcript token -> -100 when it is not the first."""
    w = Window.partitionBy("batch_id")  # a batch is a bounded group
    longest = F.max(F.size(labels_col)).over(w)
    x = df.withColumn("_len", F.size(labels_col)).withColumn("_max", longest)
    padded = F.concat(F.col(labels_col), F.array_repeat(F.lit(PAD), F.col("_max") - F.col("_len")))
    mask = F.concat(F.array_repeat(F.lit(1), F.col("_len")), F.array_repeat(F.lit(0), F.col("_max") - F.col("_len")))
    x = x.withColumn("_pad", padded).withColumn("_mask", mask)
    dec = F.slice("_pad", 1, F.col("_max") - 1)
    tgt = F.slice("_pad", 2, F.col("_max") - 1)
    tmask = F.slice("_mask", 2, F.col("_max") - 1)
    tgt = F.zip_with(tgt, tmask, lambda v, m: F.when(m == 1, v).otherwise(F.lit(IGNORE)))
    x = x.withColumn("decoder_input_ids", dec).withColumn("_tgt", tgt)
    b = F.coalesce(F.array_position(F.col("_tgt"), START_OF_TRANSCRIPT).cast("int") - 1, F.lit(0))
    b = F.when(b < 0, F.lit(0)).otherwise(b)  # 0-based index of the start token, 0 if absent
    cut = F.when(b > 0, b + 1).otherwise(F.lit(0))
    target = F.transform(F.col("_tgt"), lambda v, i: F.when(i < cut, F.lit(IGNORE)).otherwise(v))
    return x.withColumn("target_ids", target).drop("_len", "_max", "_pad", "_mask", "_tgt")


def restore_pad(ids: Column, pad: int = PAD) -> Column:
    """ARR9: -100 -> pad id before decoding."""
    return F.transform(ids, lambda v: F.when(v == IGNORE, F.lit(pad)).otherwise(v))

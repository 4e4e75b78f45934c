"""Weight-set and sample-array queries over ``embeddings`` (F5 and signal fixtures)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.functions import signal as SG
from parlance.operators import merging as MG
from parlance.operators import vectors as VC
from parlance.operators.ranks import with_position
from parlance.plans.catalog import register
from parlance.sources.tables import table

N_CKPT = 10


def weight_sets(spark, sf_dir):
    """F5, overlay: checkpoint = vec_id % 10, key = vec_id div 10 + 1, values = embedding: every vector is in
    one checkpoint, and no position has to be numbered."""
    return table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % N_CKPT).cast("int").alias("checkpoint"), (F.expr(f"vec_id div {N_CKPT}") + 1).alias("key"),
        F.col("embedding").alias("values"))


def weight_sets_by_label(spark, sf_dir):
    """Checkpoints of unequal size: checkpoint = label, key = 1-based row number by vec_id inside the
    label."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    ws = with_position(e, ["vec_id"], partition_cols=["label"], name="key")
    return ws.select(F.col("label").alias("checkpoint"), (F.col("key") + 1).alias("key"), F.col("embedding").alias("values"))


SQL_WS = f"""
ws AS (SELECT vec_id % {N_CKPT} AS checkpoint, vec_id // {N_CKPT} + 1 AS key, embedding FROM embeddings)"""


@register("checkpoint_key_coverage", """
WITH ws0 AS (SELECT label AS checkpoint, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS key FROM embeddings)
SELECT checkpoint, CAST(count(DISTINCT key) AS BIGINT) AS n_keys,
       CAST((SELECT count(DISTINCT key) FROM ws0) - count(DISTINCT key) AS BIGINT) AS n_missing
FROM ws0 GROUP BY checkpoint
""")
def checkpoint_key_coverage(spark, sf_dir):
    """JOIN3 over all rows (checkpoints differ in size, so some keys are missing)."""
    return VC.key_coverage(weight_sets_by_label(spark, sf_dir))


def numbered_weight_sets(spark, sf_dir):
    """Checkpoint = label (any other or no label: brought to 0..9), key = 1-based row number by vec_id
    inside the checkpoint: every vector takes part, and the larger checkpoints hold more keys."""
    e = table(spark, sf_dir, "embeddings").select(
        F.pmod(F.coalesce("label", F.lit(0)), F.lit(N_CKPT)).cast("int").alias("checkpoint"), "vec_id", F.col("embedding").alias("values"))
    ws = with_position(e, ["vec_id", "values"], partition_cols=["checkpoint"], name="key")
    return ws.select("checkpoint", (F.col("key") + 1).alias("key"), "values")


def _avg_sql(weight_expr: str) -> str:
    return f"""
WITH ws0 AS (SELECT (coalesce(label, 0) % {N_CKPT} + {N_CKPT}) % {N_CKPT} AS checkpoint, vec_id, embedding FROM embeddings),
ws AS (SELECT checkpoint, embedding, row_number() OVER (PARTITION BY checkpoint ORDER BY vec_id NULLS FIRST, embedding NULLS FIRST) AS key
       FROM ws0),
l AS (SELECT key, checkpoint, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM ws)
SELECT key, CAST(pos AS BIGINT) AS pos,
       round(CAST(CAST(coalesce(sum(CAST(v AS DOUBLE) * ({weight_expr})), 0)
                       / CASE WHEN count(*) < {N_CKPT} THEN sum({weight_expr}) ELSE 1 END AS FLOAT) AS DOUBLE), 6) AS value
FROM l GROUP BY key, pos
"""


def _avg_rows(avg):
    return avg.select(F.col("key").cast("bigint").alias("key"), F.col("pos").cast("bigint").alias("pos"),
                      F.round(F.col("value").cast("double"), 6).alias("value"))


@register("checkpoint_average_equal", _avg_sql(f"{1.0 / N_CKPT!r}::DOUBLE"))
def checkpoint_average_equal(spark, sf_dir):
    """AGG9 with default equal weights, over every vector."""
    return _avg_rows(VC.average(numbered_weight_sets(spark, sf_dir), list(range(N_CKPT)), partial=True))


@register("checkpoint_average_weighted", _avg_sql("CAST(checkpoint + 1 AS DOUBLE) / 55"))
def checkpoint_average_weighted(spark, sf_dir):
    """AGG9 with weights (c + 1) / 55, which sum to 1, over every vector."""
    w = [(c + 1) / 55 for c in range(N_CKPT)]
    return _avg_rows(VC.average(numbered_weight_sets(spark, sf_dir), list(range(N_CKPT)), w, partial=True))


@register("checkpoint_overlay", f"""
WITH {SQL_WS}
SELECT CAST(t.checkpoint AS BIGINT) AS checkpoint, CAST(t.key AS BIGINT) AS key, s.embedding IS NOT NULL AS overwritten,
       round(list_sum(list_transform(coalesce(s.embedding, t.embedding), lambda v: CAST(v AS DOUBLE))), 6) AS total
FROM ws t LEFT JOIN ws s ON t.key % 2 = 0 AND s.key = t.key + 1 AND s.checkpoint = (t.checkpoint + 1) % {N_CKPT}
""")
def checkpoint_overlay(spark, sf_dir):
    """JOIN4: each checkpoint takes the next one's vector at key + 1 for its even keys, where that
    one has it."""
    ws = weight_sets(spark, sf_dir)
    keyed = ws.select(F.struct("checkpoint", "key").alias("key"), "values")
    nxt = F.struct(((F.col("checkpoint") + 1) % N_CKPT).alias("checkpoint"), (F.col("key") + 1).alias("key"))
    wanted = ws.filter(F.col("key") % 2 == 0).select(F.struct("checkpoint", "key").alias("target_key"), nxt.alias("source_key"))
    mapping = wanted.join(keyed.select(F.col("key").alias("source_key")), "source_key", "left_semi")
    out = VC.overlay(keyed, keyed, mapping)
    total = F.aggregate(F.transform("values", lambda v: v.cast("double")), F.lit(0.0), lambda a, v: a + v)
    return out.select(F.col("key.checkpoint").cast("bigint").alias("checkpoint"), F.col("key.key").cast("bigint").alias("key"),
                      "overwritten", F.round(total, 6).alias("total"))


RATE = 1000
_FADE_N = int(RATE * SG.FADE_SECONDS)


def _sql_fade() -> str:
    d = float(max(_FADE_N - 1, 1))
    x = f"(CAST(j AS DOUBLE) / {d!r}::DOUBLE)"
    a = f"({x} * (1 - {x}))"
    b = f"({a} * (1 + {SG.EQUAL_ENERGY_K!r}::DOUBLE * {a}))"
    return f"list_transform(range({_FADE_N}), lambda j: ({b} + {x}) * ({b} + {x}))"


@register("signal_transforms", f"""
WITH s AS (
  SELECT vec_id, embedding AS x,
         CAST(round_even(CAST(vec_id % 7 AS DOUBLE) * 0.0125::DOUBLE * {float(RATE)!r}::DOUBLE, 0) AS INTEGER) AS n
  FROM embeddings),
t AS (
  SELECT *, list_concat(list_transform(range(n), lambda i: 0.0::DOUBLE), list_transform(x, lambda v: CAST(v AS DOUBLE))) AS sh,
         {_sql_fade()} AS fade,
         list_transform(x, lambda v: CAST(trunc(CAST(v AS DOUBLE) * 32767) AS SMALLINT)) AS pcm
  FROM s)
SELECT vec_id,
  round(CAST(len(x) AS DOUBLE) / {float(RATE)!r}, 6) AS duration,
  CAST(len(sh) AS BIGINT) AS n_shifted,
  round(list_sum(list_transform(sh, lambda v, i: CASE WHEN i - 1 >= n AND i - 1 < n + {_FADE_N}
                                                  THEN v * fade[i - 1 - n + 1] ELSE v END)), 6) AS faded_sum,
  CAST(list_sum(list_transform(pcm, lambda v: CAST(v AS BIGINT))) AS BIGINT) AS pcm_sum,
  round(list_sum(list_transform(pcm, lambda v: CAST(v AS DOUBLE) / 32768.0)), 6) AS decoded_sum,
  CAST(ceil(len(x) / 10.0) AS BIGINT) AS n_chunks,
  CAST(len(x) - 10 * (ceil(len(x) / 10.0) - 1) AS BIGINT) AS last_chunk_len,
  round(list_sum(list_transform(x[17:48], lambda v: CAST(v AS DOUBLE))), 6) AS window_sum,
  md5(base64(encode(array_to_string(pcm, ',')))) AS payload_md5
FROM t
""")
def signal_transforms(spark, sf_dir):
    """ARR10-ARR13, JSN2, MTH1, WIN7 on embeddings read as 1 kHz sample arrays."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("x"))
    seconds = (F.col("vec_id") % 7).cast("double") * 0.0125

    def total(arr):
        return F.aggregate(F.transform(arr, lambda v: v.cast("double")), F.lit(0.0), lambda a, v: a + v)
    pcm = SG.encode_int16(F.col("x"))
    ch = SG.chunks(F.col("x"), 10)
    return e.select(
        "vec_id",
        F.round(SG.duration_seconds(F.col("x"), RATE), 6).alias("duration"),
        F.size(SG.shift_forward(F.col("x"), seconds, RATE)).cast("bigint").alias("n_shifted"),
        F.round(total(SG.shift_forward(F.col("x"), seconds, RATE)), 6).alias("faded_sum"),
        F.aggregate(pcm, F.lit(0).cast("bigint"), lambda a, v: a + v.cast("bigint")).alias("pcm_sum"),
        F.round(total(SG.decode_int16(pcm)), 6).alias("decoded_sum"),
        F.size(ch).cast("bigint").alias("n_chunks"),
        F.size(F.element_at(ch, -1)).cast("bigint").alias("last_chunk_len"),
        F.round(total(MG.sample_range(F.col("x"), F.lit(0.016), 0.032, RATE)), 6).alias("window_sum"),
        F.md5(SG.base64_payload(F.array_join(F.transform(pcm, lambda v: v.cast("string")), ",").cast("binary")))
         .alias("payload_md5"))


# ARR6 + ARR7: trailing-padding compression of frame arrays and its expansion
@register("padding_compression", """
WITH f AS (
  SELECT vec_id,
         list_transform(embedding, lambda x: [CAST(x AS DOUBLE), CAST(x AS DOUBLE) * 2]) AS feats,
         list_transform(range(1, len(embedding) + 1), lambda i: CASE WHEN i <= vec_id % 64 + 1 THEN 1 ELSE 0 END) AS mask
  FROM embeddings),
c AS (
  SELECT vec_id, feats, len(mask) >= 3 AND mask[-3] = 0 AS comp, list_position(mask, 0) AS fz FROM f)
SELECT vec_id,
  CAST(CASE WHEN comp THEN fz ELSE len(feats) END AS BIGINT) AS n_kept,
  CAST(CASE WHEN comp THEN len(feats) - fz ELSE 0 END AS BIGINT) AS pad_amount,
  round(CASE WHEN comp THEN list_sum(feats[fz + 1]) ELSE 0 END, 6) AS pad_value_sum,
  CAST(len(feats) AS BIGINT) AS expanded_len
FROM c
""")
def padding_compression(spark, sf_dir):
    from parlance.operators import labels as LB
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    feats = F.transform("embedding", lambda x: F.array(x.cast("double"), x.cast("double") * 2))
    mask = F.transform(F.sequence(F.lit(1), F.size("embedding")),
                       lambda i: F.when(i <= (F.col("vec_id") % 64) + 1, 1).otherwise(0))
    c = e.select("vec_id", LB.compress_padding(feats, mask).alias("c"))
    total = F.aggregate(F.coalesce(F.col("c.pad_value"), F.array().cast("array<double>")), F.lit(0.0), lambda a, v: a + v)
    expanded = LB.expand_padding(F.col("c.input_features"), F.col("c.pad_value"), F.col("c.pad_amount"))
    return c.select("vec_id", F.size("c.input_features").cast("bigint").alias("n_kept"),
                    F.col("c.pad_amount").cast("bigint").alias("pad_amount"),
                    F.round(total, 6).alias("pad_value_sum"), F.size(expanded).cast("bigint").alias("expanded_len"))

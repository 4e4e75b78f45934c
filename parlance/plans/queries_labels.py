"""Training-set preparation queries: tokenisation, label assembly, limit, batching."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.functions.random import sql_uniform, uniform
from parlance.operators import labels as LB
from parlance.operators import merging as MG
from parlance.operators.filters import legal_label_length
from parlance.plans import fixtures as FX
from parlance.plans.catalog import register
from parlance.plans.queries_build import SQL_EXAMPLES, SQL_F1, SQL_FIXED_HOP, SQL_MERGE

KEYS = ["entry_id", "slice_idx"]



def prepared_examples(spark, sf_dir):
    """F1 examples (fixed hop) with timestamps declared on even entries only."""
    ex = MG.build_examples(FX.fixed_hop_slices(spark, sf_dir))
    return ex.select(*KEYS, "transcript", "has_prev", "prev_transcript",
                     (F.col("entry_id") % 2 == 0).alias("has_timestamps"))


def labelled(spark, sf_dir, p_ts: float = 0.5, p_prev: float = 0.5):
    ex = prepared_examples(spark, sf_dir)
    vocab = LB.build_vocabulary(ex, "transcript")
    t = LB.tokenize_columns(ex, KEYS, {"ids": "transcript", "prev_ids": "prev_transcript"}, vocab)
    train_ts = uniform(998, F.col("entry_id"), F.col("slice_idx"), F.lit("train_ts")) < p_ts
    cond_prev = uniform(998, F.col("entry_id"), F.col("slice_idx"), F.lit("cond_prev")) < p_prev
    lab = LB.assemble_labels(F.col("ids"), F.col("prev_ids"), F.col("has_timestamps"), F.col("has_prev"),
                             train_ts, cond_prev)
    return legal_label_length(t.withColumn("labels", lab).filter(F.col("labels").isNotNull()))


def _ids_text(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


TSB = LB.TS_BEGIN
_TOKEN_SQL = """CASE WHEN regexp_full_match(tok, '<\\|[0-9]+\\.[0-9]+\\|>')
  THEN CAST({tsb} + round_even(CAST(regexp_extract(tok, '([0-9]+\\.[0-9]+)', 1) AS DOUBLE) / 0.02::DOUBLE, 0) AS INTEGER)
  ELSE v.id END""".format(tsb=TSB)

SQL_LABELS = f"""
exs AS (
  SELECT entry_id, slice_idx, transcript, has_prev,
         CASE WHEN has_prev THEN prev_t ELSE '' END AS prev_transcript, entry_id % 2 = 0 AS has_ts
  FROM chain WHERE entry_max > 0 AND nseg > 0),
toks AS (
  SELECT *, regexp_extract_all(transcript, '{LB.TOKEN_PATTERN}') AS t,
            regexp_extract_all(prev_transcript, '{LB.TOKEN_PATTERN}') AS pt
  FROM exs),
vocab AS (
  SELECT tok, CAST(dense_rank() OVER (ORDER BY tok) - 1 AS INTEGER) AS id
  FROM (SELECT DISTINCT unnest(t) AS tok FROM toks)
  WHERE NOT regexp_full_match(tok, '<\\|[0-9]+\\.[0-9]+\\|>')),
tk AS (SELECT entry_id, slice_idx, unnest(t) AS tok, generate_subscripts(t, 1) AS pos FROM toks),
tid AS (SELECT entry_id, slice_idx, list({_TOKEN_SQL} ORDER BY pos) AS ids
        FROM tk LEFT JOIN vocab v USING (tok) GROUP BY entry_id, slice_idx),
ptk AS (SELECT entry_id, slice_idx, unnest(pt) AS tok, generate_subscripts(pt, 1) AS pos FROM toks),
pid AS (SELECT entry_id, slice_idx, list({_TOKEN_SQL} ORDER BY pos) AS pids
        FROM ptk LEFT JOIN vocab v USING (tok) GROUP BY entry_id, slice_idx),
j AS (
  SELECT x.entry_id, x.slice_idx, x.has_ts, x.has_prev,
         coalesce(tid.ids, []::INTEGER[]) AS ids, coalesce(pid.pids, []::INTEGER[]) AS pids,
         {sql_uniform(998, 'x.entry_id', 'x.slice_idx', "'train_ts'")} < 0.5::DOUBLE AS train_ts,
         {sql_uniform(998, 'x.entry_id', 'x.slice_idx', "'cond_prev'")} < 0.5::DOUBLE AS cond_prev
  FROM toks x LEFT JOIN tid USING (entry_id, slice_idx) LEFT JOIN pid USING (entry_id, slice_idx)),
l1 AS (
  SELECT *,
    CASE WHEN has_ts AND NOT train_ts AND (len(ids) < 2 OR ids[-2] < {TSB})
         THEN list_filter(ids, lambda x: x < {TSB}) ELSE ids END AS ids1,
    CASE WHEN NOT train_ts AND has_ts THEN list_filter(pids, lambda x: x < {TSB}) ELSE pids END AS p
  FROM j),
l2 AS (SELECT *, least(448 - len(ids1) - 5, 224) AS k FROM l1),
l3 AS (
  SELECT *,
    CASE WHEN has_prev AND cond_prev
         THEN list_concat([{LB.START_OF_PREV}]::INTEGER[],
                          list_slice(p, CASE WHEN k > 0 THEN greatest(len(p) - k + 1, 1) WHEN k = 0 THEN 1 ELSE -k + 1 END,
                                     len(p)))
         ELSE []::INTEGER[] END AS prev_part
  FROM l2),
lab AS (
  SELECT entry_id, slice_idx,
    list_concat(prev_part,
                CASE WHEN has_ts AND train_ts THEN {LB.PREFIX_WITH_TS}::INTEGER[] ELSE {LB.PREFIX_NO_TS}::INTEGER[] END,
                ids1, [{LB.END_OF_TEXT}]::INTEGER[]) AS labels
  FROM l3),
legal AS (SELECT * FROM lab WHERE len(labels) <= 448)"""


# TXT11 + ARR1-ARR5 + LIM5 + FLT4 over the prepared examples
@register("labels_fixed_hop", f"""
WITH {SQL_F1}, {SQL_FIXED_HOP}, {SQL_MERGE}, {SQL_EXAMPLES}, {SQL_LABELS}
SELECT entry_id, CAST(slice_idx AS BIGINT) AS slice_idx, CAST(len(labels) AS BIGINT) AS n_labels,
       md5(array_to_string(labels, ',')) AS labels_md5
FROM legal
""")
def labels_fixed_hop(spark, sf_dir):
    lab = labelled(spark, sf_dir)
    return lab.select("entry_id", F.col("slice_idx").cast("bigint").alias("slice_idx"),
                      F.size("labels").cast("bigint").alias("n_labels"), F.md5(_ids_text(F.col("labels"))).alias("labels_md5"))


# AGG10 + ARR8 + ARR9: batches of 8 in (entry, slice) order
@register("collated_batches", f"""
WITH {SQL_F1}, {SQL_FIXED_HOP}, {SQL_MERGE}, {SQL_EXAMPLES}, {SQL_LABELS},
b AS (SELECT *, (row_number() OVER (ORDER BY entry_id, slice_idx) - 1) // 8 AS batch_id FROM legal),
p AS (SELECT *, max(len(labels)) OVER (PARTITION BY batch_id) AS mx FROM b),
q AS (SELECT *, list_concat(labels, list_transform(range(mx - len(labels)), lambda i: {LB.PAD})) AS pad,
             list_concat(list_transform(range(len(labels)), lambda i: 1), list_transform(range(mx - len(labels)), lambda i: 0)) AS msk
      FROM p),
r AS (SELECT *, pad[1:mx - 1] AS dec,
             list_transform(list_zip(pad[2:mx], msk[2:mx]), lambda z: CASE WHEN z[2] = 1 THEN z[1] ELSE -100 END) AS tg
      FROM q),
s AS (SELECT *, coalesce(list_position(tg, {LB.START_OF_TRANSCRIPT}) - 1, 0) AS bi FROM r)
SELECT CAST(batch_id AS BIGINT) AS batch_id, entry_id, CAST(slice_idx AS BIGINT) AS slice_idx,
       md5(array_to_string(dec, ',')) AS decoder_md5,
       md5(array_to_string(list_transform(tg, lambda v, i: CASE WHEN bi > 0 AND i - 1 < bi + 1 THEN -100 ELSE v END), ',')) AS target_md5,
       md5(array_to_string(list_transform(list_transform(tg, lambda v, i: CASE WHEN bi > 0 AND i - 1 < bi + 1 THEN -100 ELSE v END),
                                          lambda v: CASE WHEN v = -100 THEN {LB.PAD} ELSE v END), ',')) AS restored_md5
FROM s
""")
def collated_batches(spark, sf_dir):
    lab = labelled(spark, sf_dir)
    b = LB.collate(LB.assign_batches(lab, KEYS, 8))
    return b.select("batch_id", "entry_id", F.col("slice_idx").cast("bigint").alias("slice_idx"),
                    F.md5(_ids_text(F.col("decoder_input_ids"))).alias("decoder_md5"),
                    F.md5(_ids_text(F.col("target_ids"))).alias("target_md5"),
                    F.md5(_ids_text(LB.restore_pad(F.col("target_ids")))).alias("restored_md5"))

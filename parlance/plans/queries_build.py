"""Dataset-build queries: slicing, gap merge, transcripts, quality, previous text."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.operators import merging as MG
from parlance.operators import rejects as RJ
from parlance.operators.slicing import generate_slices
from parlance.plans import fixtures as FX
from parlance.plans.catalog import register, sql_words

# ---- F1 segments and fixed-hop slices in SQL ----------------------------------------------
SQL_F1 = f"""
seg0 AS (
  SELECT conv_id AS entry_id, turn AS seg_idx, text,
         CAST(length(text) % 40 AS DOUBLE) AS d,
         CAST((length(text) * 7) % 8 AS DOUBLE) * 0.25 AS gap,
         list_transform({sql_words('text')},
                        lambda x, k: CAST((length(x) * 37 + (k - 1) * 11) % 100 AS DOUBLE) / 100) AS word_scores
  FROM conversations),
seg1 AS (
  SELECT *, coalesce(sum(d + gap) OVER (PARTITION BY entry_id ORDER BY seg_idx
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM seg0),
seg AS (
  SELECT entry_id, seg_idx, text, word_scores, start, start + d AS "end",
         max(start + d) OVER (PARTITION BY entry_id) + CAST(entry_id % 5 AS DOUBLE) AS audio_duration
  FROM seg1)"""

SQL_FIXED_HOP = """
hop AS (SELECT *, CAST(floor(start / 30) AS BIGINT) AS slice_idx FROM seg),
grp AS (
  SELECT entry_id, slice_idx,
    list(CASE WHEN "end" - slice_idx * 30 <= 30
              THEN {'start': start - slice_idx * 30, 'end': "end" - slice_idx * 30, 'text': text, 'word_scores': word_scores}
              ELSE {'start': start - slice_idx * 30, 'end': NULL::DOUBLE, 'text': NULL::VARCHAR, 'word_scores': NULL::DOUBLE[]}
         END ORDER BY seg_idx) AS segments
  FROM hop GROUP BY entry_id, slice_idx),
frame AS (
  SELECT entry_id, unnest(range(0, CAST(ceil(max(audio_duration) / 30) AS BIGINT))) AS slice_idx
  FROM seg GROUP BY entry_id),
slices AS (
  SELECT f.entry_id, f.slice_idx, CAST(f.slice_idx AS DOUBLE) * 30 AS seek,
         coalesce(g.segments, []) AS segments
  FROM frame f LEFT JOIN grp g USING (entry_id, slice_idx))"""

SQL_MERGE = """
heads AS (
  SELECT *, list_filter(range(1, len(segments) + 1), lambda k: NOT coalesce(
      k > 1 AND segments[k]."end" IS NOT NULL AND segments[k].text IS NOT NULL
      AND segments[k].start - segments[k - 1]."end" < 0.3::DOUBLE, false)) AS hd
  FROM slices),
merged AS (
  SELECT entry_id, slice_idx, seek,
    CASE WHEN len(segments) <= 1 THEN segments ELSE
      list_transform(hd, lambda p, j: {
        'start': segments[p].start,
        'end': segments[coalesce(hd[j + 1] - 1, len(segments))]."end",
        'text': CASE WHEN coalesce(hd[j + 1] - 1, len(segments)) = p THEN segments[p].text
                     ELSE array_to_string(list_transform(segments[p:coalesce(hd[j + 1] - 1, len(segments))],
                                                         lambda s: s.text), '') END,
        'word_scores': segments[p].word_scores}) END AS segments
  FROM heads)"""

SQL_TOKEN = "CASE WHEN {x} >= 0 AND {x} <= 30 THEN '<|' || printf('%.2f', 0.02 * round_even({x} / 0.02, 0)) || '|>' END"

SQL_EXAMPLES = f"""
parts AS (
  SELECT *, len(segments) AS nseg,
    list_transform(segments, lambda s: CASE WHEN s.text IS NULL THEN {SQL_TOKEN.format(x='s.start')}
        ELSE {SQL_TOKEN.format(x='s.start')} || s.text || {SQL_TOKEN.format(x='s."end"')} END) AS pt,
    list_sort(flatten(list_transform(segments, lambda s: coalesce(s.word_scores, []::DOUBLE[])))) AS sc
  FROM merged),
ex AS (
  SELECT entry_id, slice_idx, seek, nseg,
    CASE WHEN nseg = 0 THEN '' WHEN list_bool_and(list_transform(pt, lambda x: x IS NOT NULL)) THEN array_to_string(pt, '') END AS transcript,
    CASE WHEN len(sc) = 0 THEN 0.0
         WHEN len(sc) % 2 = 1 THEN sc[len(sc) // 2 + 1]
         ELSE (sc[len(sc) // 2] + sc[len(sc) // 2 + 1]) / 2 END AS quality
  FROM parts),
chain AS (
  SELECT *, max(nseg) OVER (PARTITION BY entry_id) AS entry_max,
    coalesce(lag(nseg) OVER (PARTITION BY entry_id ORDER BY slice_idx) > 0, false) AS has_prev,
    lag(transcript) OVER (PARTITION BY entry_id ORDER BY slice_idx) AS prev_t
  FROM ex)"""


# WIN1 as a recursion over (seek, next segment): one row a step, segments as a list per entry.
def _sql_median(scores: str) -> str:
    n, v = f"len({scores})", f"list_sort({scores})"
    return (f"(CASE WHEN {n} = 0 THEN 0.0::DOUBLE WHEN {n} % 2 = 1 THEN {v}[{n} // 2 + 1] "
            f"ELSE ({v}[{n} // 2] + {v}[{n} // 2 + 1]) / 2 END)")


SQL_GREEDY = f"""
ent AS (
  SELECT entry_id, any_value(audio_duration) AS dur,
         list({{'s': start, 'e': "end", 't': coalesce(text, ''), 'w': word_scores}} ORDER BY seg_idx) AS g
  FROM seg GROUP BY entry_id),
walk AS (
  SELECT entry_id, 0 AS step, 0::DOUBLE AS nxt, 0::BIGINT AS i, 0::DOUBLE AS seek, 0::BIGINT AS a, 0::BIGINT AS b,
         false AS opened, false AS emitted
  FROM ent
  UNION ALL
  SELECT entry_id, step + 1,
    CASE WHEN skip THEN CASE WHEN i + 1 < n THEN g[i + 2].s ELSE dur END
         WHEN low THEN CASE WHEN again IS NOT NULL THEN g[again + 1].s WHEN j < n THEN g[j + 1].s ELSE dur END
         WHEN crosses THEN CASE WHEN j = i THEN g[j + 1].s ELSE g[j].e END
         ELSE nxt + 30 END,
    CASE WHEN skip THEN CASE WHEN i + 1 < n THEN i + 1 ELSE i END WHEN low THEN coalesce(again, j) ELSE j END,
    nxt, i, CASE WHEN low THEN i ELSE j END, crosses AND j > i AND NOT low, NOT skip
  FROM (
    SELECT *, j < n AND g[j + 1].s < cut AS crosses,
      j > i AND {_sql_median("flatten(list_transform(g[i + 1:j], lambda x: x.w))")} < 0.5 AS low,
      list_filter(range(i + 1, j), lambda t: {_sql_median("g[t + 1].w")} >= 0.5)[1] AS again
    FROM (
      SELECT *, coalesce(list_filter(range(i, n), lambda t: NOT (g[t + 1].s < cut AND least(g[t + 1].e, dur) <= cut))[1], n) AS j
      FROM (
        SELECT w.entry_id, w.step, w.nxt, w.i, e.dur, e.g, len(e.g) AS n, least(w.nxt + 30, e.dur) AS cut,
          w.i < len(e.g) AND (e.g[w.i + 1].e - e.g[w.i + 1].s > 30 OR e.g[w.i + 1].e = e.g[w.i + 1].s) AS skip
        FROM walk w JOIN ent e USING (entry_id) WHERE w.nxt < e.dur)))),
slices AS (
  SELECT entry_id, row_number() OVER (PARTITION BY entry_id ORDER BY step) - 1 AS slice_idx, seek,
    list_transform(range(a, b + CAST(opened AS INTEGER)), lambda t:
      CASE WHEN t < b THEN {{'start': greatest(0, g[t + 1].s - seek), 'end': least(30, least(g[t + 1].e, dur) - seek),
                            'text': g[t + 1].t, 'word_scores': g[t + 1].w}}
           ELSE {{'start': greatest(0, g[t + 1].s - seek), 'end': NULL::DOUBLE, 'text': NULL::VARCHAR,
                 'word_scores': []::DOUBLE[]}} END) AS segments
  FROM walk JOIN ent USING (entry_id) WHERE emitted)"""

SQL_EXAMPLE_DIGEST = """
SELECT entry_id, CAST(slice_idx AS BIGINT) AS slice_idx, round(CAST(CAST(seek AS FLOAT) AS DOUBLE), 6) AS seek,
       md5(transcript) AS transcript_md5, has_prev,
       md5(CASE WHEN has_prev THEN prev_t ELSE '' END) AS prev_md5,
       round(CAST(CAST(quality AS FLOAT) AS DOUBLE), 6) AS quality_score
FROM chain WHERE entry_max > 0 AND nseg > 0
"""

def _example_digest(df):
    return df.select(
        "entry_id", F.col("slice_idx").cast("bigint").alias("slice_idx"),
        F.round(F.col("metadata.seek").cast("double"), 6).alias("seek"),
        F.md5("transcript").alias("transcript_md5"), "has_prev", F.md5("prev_transcript").alias("prev_md5"),
        F.round(F.col("metadata.quality_score").cast("double"), 6).alias("quality_score"))


# WIN2 + WIN3 + WIN4 + WIN6 + AGG4-AGG6 + TXT7 + FLT9 + PRJ1 on prepared slices
@register("examples_fixed_hop", f"WITH {SQL_F1}, {SQL_FIXED_HOP}, {SQL_MERGE}, {SQL_EXAMPLES} {SQL_EXAMPLE_DIGEST}")
def examples_fixed_hop(spark, sf_dir):
    return _example_digest(MG.build_examples(FX.fixed_hop_slices(spark, sf_dir)))


# WIN2 alone: merged segment layout per prepared slice
@register("gap_merge_fixed_hop", f"""
WITH {SQL_F1}, {SQL_FIXED_HOP}, {SQL_MERGE}
SELECT entry_id, CAST(slice_idx AS BIGINT) AS slice_idx, CAST(len(segments) AS BIGINT) AS n_segments,
       round(coalesce(list_sum(list_transform(segments, lambda s: s."end" - s.start)), 0), 6) AS closed_span,
       md5(coalesce(array_to_string(list_transform(segments, lambda s: coalesce(s.text, '<open>')), '|'), '')) AS text_md5
FROM merged
""")
def gap_merge_fixed_hop(spark, sf_dir):
    s = FX.fixed_hop_slices(spark, sf_dir).withColumn("segments", MG.merge_gaps(F.col("segments")))
    span = F.aggregate(F.transform("segments", lambda x: x["end"] - x["start"]), F.lit(None).cast("double"),
                       lambda acc, v: F.when(v.isNull(), acc).otherwise(F.coalesce(acc, F.lit(0.0)) + v))
    return s.select("entry_id", F.col("slice_idx").cast("bigint").alias("slice_idx"),
                    F.size("segments").cast("bigint").alias("n_segments"),
                    F.round(F.coalesce(span, F.lit(0.0)), 6).alias("closed_span"),
                    F.md5(F.array_join(F.transform("segments", lambda x: F.coalesce(x["text"], F.lit("<open>"))), "|"))
                     .alias("text_md5"))


# FLT10: bad entries and slices with a reason. Some segments lack their start; slices are 40 s long,
# so a marker can lie beyond the last time token (30 s).
_WIDE_HOP = SQL_FIXED_HOP.replace("30", "40")


@register("rejected_segments_conversations", f"""
WITH {SQL_F1.replace("seg AS (", "seg_all AS (")},
broken AS (SELECT *, (length(text) * 13 + seg_idx) % 61 = 7 AS bad FROM seg_all),
seg AS (SELECT * FROM broken WHERE entry_id NOT IN (SELECT entry_id FROM broken WHERE bad)),
{_WIDE_HOP}, {SQL_MERGE}, {SQL_EXAMPLES}
SELECT 'entry' AS level, entry_id, NULL::INTEGER AS slice_idx, 'segment without a start' AS reason, CAST(count(*) AS BIGINT) AS n
FROM broken WHERE bad GROUP BY entry_id
UNION ALL
SELECT 'slice', entry_id, CAST(slice_idx AS INTEGER), 'timestamp token out of range', 1::BIGINT
FROM ex WHERE nseg > 0 AND transcript IS NULL
""")
def rejected_segments_conversations(spark, sf_dir):
    seg = FX.broken_segment_rows(spark, sf_dir)
    good = RJ.without_bad_entries(seg)
    slices = FX.fixed_hop_slices(spark, sf_dir, 40, good)
    return RJ.entry_rejects(seg).unionByName(RJ.slice_rejects(slices)).select(*RJ.COLUMNS)


# WIN1 greedy slicer over F1 (threshold 0.5)
@register("greedy_slices", f"""
WITH RECURSIVE {SQL_F1}, {SQL_GREEDY}
SELECT entry_id, slice_idx, round(seek, 6) AS seek, CAST(len(segments) AS BIGINT) AS n_segments,
  md5('[' || array_to_string(list_transform(segments, lambda s: '{{"start":' || CAST(s.start AS VARCHAR)
      || coalesce(',"end":' || CAST(s."end" AS VARCHAR), '') || coalesce(',"text":' || CAST(to_json(s.text) AS VARCHAR), '')
      || ',"word_scores":[' || array_to_string(list_transform(s.word_scores, lambda x: CAST(x AS VARCHAR)), ',') || ']}}'),
    ',') || ']') AS segments_md5
FROM slices
""")
def greedy_slices(spark, sf_dir):
    s = generate_slices(FX.segment_rows(spark, sf_dir), slice_length=30, threshold=0.5)
    return s.select("entry_id", F.col("slice_idx").cast("bigint").alias("slice_idx"), F.round("seek", 6).alias("seek"),
                    F.size("segments").cast("bigint").alias("n_segments"),
                    F.md5(F.to_json("segments")).alias("segments_md5"))


# Pipeline 3.1 over F1: slicer -> merge -> transcripts -> previous -> examples
@register("dataset_examples",
          f"WITH RECURSIVE {SQL_F1}, {SQL_GREEDY}, {SQL_MERGE}, {SQL_EXAMPLES} {SQL_EXAMPLE_DIGEST}")
def dataset_examples(spark, sf_dir):
    slices = generate_slices(FX.segment_rows(spark, sf_dir), slice_length=30, threshold=0.5)
    return _example_digest(MG.build_examples(slices))

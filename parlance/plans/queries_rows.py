"""Row predicates and projections over ``events``: exclusion by metadata, quality and length gates,
provenance, resumed work."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.operators import filters as FL
from parlance.operators import scoring as SC
from parlance.plans import fixtures as FX
from parlance.plans.catalog import register
from parlance.sources.sinks import pending
from parlance.sources.tables import table

_EXCLUDE = ["k:eq:69", "k:eq:7", "k.deeper:eq:1", "absent:eq:None", "k:eq:8:9"]


# FLT1 + FLT2 + JSN1: any filter that matches the text of the value excludes the row
@register("metadata_exclusion_events", """
SELECT event_id, json_extract_string(props, '$.k') AS k FROM events
WHERE coalesce(json_extract_string(props, '$.k'), '') NOT IN ('69', '7')
""")
def metadata_exclusion_events(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "props")
    return FL.exclude_by_metadata(e, "props", _EXCLUDE).select("event_id", FL.python_str_value(F.col("props"), "k").alias("k"))


# FLT3: rows without a score are never dropped, a threshold of 0 drops nothing
@register("quality_gate_events", """
WITH s AS (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN value END AS score FROM events)
SELECT event_id, score IS NULL AS unscored, 1 AS threshold_used FROM s WHERE score IS NULL OR score >= 20
UNION ALL SELECT event_id, score IS NULL, 0 FROM s
""")
def quality_gate_events(spark, sf_dir):
    s = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("score"))
    def gated(threshold, used):
        return FL.quality_gate(s, F.col("score"), threshold).select(
            "event_id", F.col("score").isNull().alias("unscored"), F.lit(used).alias("threshold_used"))
    return gated(20.0, 1).unionByName(gated(0.0, 0))


# FLT7 + PRJ3 + PRJ4: short recordings get an empty prediction without a scorer
@register("evaluation_inputs_events", """
SELECT event_id, value < 12.5 AS short, CASE WHEN value < 12.5 THEN '' ELSE event_type END AS predicted_text,
       CASE WHEN value < 12.5 THEN 0.0 ELSE CAST(event_id % 97 AS DOUBLE) / 10 END AS transcription_time,
       event_type AS metadata_event_type, 'm' AS model, 'events' AS dataset, 'all' AS split, 'none' AS engine
FROM events
""")
def evaluation_inputs_events(spark, sf_dir):
    e = FX.latency_rows(spark, sf_dir).select("event_id", "event_type", "audio_duration", "transcription_time",
                                              F.col("event_type").alias("predicted_text"))
    to_score, short = SC.short_input_gate(e, "audio_duration", 12.5)
    rows = to_score.withColumn("short", F.lit(False)).unionByName(short.withColumn("short", F.lit(True)))
    named = SC.metadata_passthrough(e.select("event_type", "predicted_text"), "predicted_text")
    return rows.select("event_id", "short", "predicted_text", "transcription_time", *named,
                       *SC.provenance("m", "events", "all", "none"))


# JOIN5: what an earlier, interrupted run has finished is left out
@register("pending_events", """
SELECT event_id, event_type FROM events WHERE event_id % 4 <> 1 AND NOT (event_id % 10 = 3 AND event_type = 'click')
""")
def pending_events(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    done = e.where("event_id % 4 = 1 OR (event_id % 10 = 3 AND event_type = 'click')")
    return pending(e, done.unionByName(done), ["event_id"])

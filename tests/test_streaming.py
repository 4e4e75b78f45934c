"""Streaming operators: incremental execution (several micro-batches) equals the batch
meaning. Inputs are whole sf0.001 tables written as several parquet files."""

import tempfile

from pyspark.sql import functions as F

from parlance.plans import fixtures as FX
from parlance.sources.tables import table
from parlance.streaming import operators as ST

SF = "/root/testdata/sf0.001"


def _as_files(df, order_col, parts=4):
    d = tempfile.mkdtemp(prefix="parlance-stream-")
    df.repartitionByRange(parts, order_col).sortWithinPartitions(order_col).write.mode("overwrite").parquet(d)
    return d


def _ordered_files(df, order_col, parts=4):
    """Sequential appends in ``order_col`` order, so file order equals time order."""
    from pyspark.sql import Window
    d = tempfile.mkdtemp(prefix="parlance-stream-")
    b = df.withColumn("_b", F.ntile(parts).over(Window.orderBy(order_col)))
    for i in range(1, parts + 1):
        b.filter(F.col("_b") == i).drop("_b").coalesce(1).write.mode("append").parquet(d)
    return d


def _run(spark, sdf, mode, name):
    ck = tempfile.mkdtemp(prefix="parlance-ckpt-")
    q = (sdf.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ck).start())
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_final_results_stream_equals_batch(spark):
    src = FX.chunk_stream(spark, SF)
    d = _as_files(src, "ts")
    s = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).parquet(d)
    got = _run(spark, ST.keep_final(s).select("stream_id", "seq"), "append", "str3")
    want = ST.keep_final(src).select("stream_id", "seq")
    assert sorted(got.collect()) == sorted(want.collect())


def test_session_assembly_stream_equals_batch(spark):
    src = FX.chunk_stream(spark, SF)
    d = _as_files(src, "ts")
    s = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).parquet(d)
    # files are replayed in arbitrary order: a watermark wider than the data keeps every row on time
    got = _run(spark, ST.assemble_sessions(s, watermark="3650 days"), "append", "str1")
    want = ST.assemble_sessions_batch(src)
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.count() > 0


def test_fixed_chunks_stream_equals_batch(spark):
    ev = table(spark, SF, "events")
    d = _as_files(ev, "ts")
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(d)
    got = _run(spark, ST.fixed_chunks(s, "ts", 15.0, watermark="3650 days"), "update", "str2")
    last = got.groupBy("chunk").agg(F.max("n").alias("n"))
    want = ST.fixed_chunks(ev, "ts", 15.0).select("chunk", "n")
    assert sorted(last.collect()) == sorted(want.collect())


def test_gap_sessions_stream_closed_sessions(spark):
    ev = table(spark, SF, "events").select("user_id", "ts", "value")
    d = _ordered_files(ev, "ts")
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(d)
    got = _run(spark, ST.gap_sessions(s, "user_id", "ts", "value", 60.0, watermark="0 seconds"), "append", "str5")
    want = {(r["user_id"], r["first_start"]): (r["n_items"], r["last_end"])
            for r in ST.gap_sessions(ev, "user_id", "ts", "value", 60.0).collect()}
    rows = got.collect()
    assert rows, "sessions closed by the watermark are emitted"
    for r in rows:  # every emitted (closed) session is exactly a batch session
        assert want[(r["user_id"], r["first_start"])] == (r["n_items"], r["last_end"])


def test_running_metrics_final_state(spark):
    from parlance.operators.scoring import score_pairs
    pairs = FX.conversation_pairs(spark, SF)
    scored = score_pairs(pairs).select("role", "substitutions", "deletions", "insertions", "hits")
    d = tempfile.mkdtemp(prefix="parlance-scored-")
    scored.repartition(3).write.mode("overwrite").parquet(d)
    s = spark.readStream.schema(scored.schema).option("maxFilesPerTrigger", 1).parquet(d)
    got = _run(spark, ST.running_metrics(s, ["role"]), "complete", "str6")
    want = ST.running_metrics(spark.read.parquet(d), ["role"])
    assert sorted(got.collect()) == sorted(want.collect())


def test_session_repeated_chunks_count_once(spark):
    """Every chunk is sent twice, the second time after its stream may have ended; one chunk changes its text."""
    src = FX.chunk_stream(spark, SF).select("stream_id", "seq", "ts", "text", "is_last")
    again = src.withColumn("text", F.when(F.col("seq") == 0, F.concat(F.lit("~"), "text")).otherwise(F.col("text")))
    d = tempfile.mkdtemp(prefix="parlance-stream-")
    for part in (src, again):
        part.coalesce(1).write.mode("append").parquet(d)
    s = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).parquet(d)
    got = _run(spark, ST.assemble_sessions(s, watermark="3650 days"), "append", "str1_twice").collect()
    want = ST.assemble_sessions_batch(src).collect()
    assert len({r["stream_id"] for r in got}) == len(got) == len(want) > 0
    assert {(r["stream_id"], r["n_chunks"]) for r in got} == {(r["stream_id"], r["n_chunks"]) for r in want}
    assert sorted(ST.assemble_sessions_batch(src.unionByName(src)).collect()) == sorted(want)


def test_progress_survives_replayed_batches(spark):
    """STR6: results written by foreachBatch; a batch that is run again changes nothing."""
    from parlance.operators.scoring import score_pairs
    from parlance.sources import sinks as SK
    cols = ["id", "role", "substitutions", "deletions", "insertions", "hits"]
    scored = score_pairs(FX.conversation_pairs(spark, SF).withColumn("id", F.concat_ws("-", "conv_id", "turn"))).select(*cols)
    d, out = tempfile.mkdtemp(prefix="parlance-scored-"), tempfile.mkdtemp(prefix="parlance-progress-") + "/rows"
    scored.repartition(3).write.mode("overwrite").parquet(d)
    write, seen = SK.batch_writer(out), []

    def twice(df, batch):
        write(df, batch)
        write(df, batch)
        seen.append(batch)
    q = (spark.readStream.schema(scored.schema).option("maxFilesPerTrigger", 1).parquet(d).writeStream.foreachBatch(twice)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="parlance-ckpt-")).start())
    q.processAllAvailable()
    q.stop()
    assert len(seen) == 3
    rows = SK.latest(spark, out, ["id"])
    want = sorted(ST.running_metrics(spark.read.parquet(d), ["role"]).collect())
    assert rows.count() == spark.read.parquet(d).count()
    assert sorted(ST.running_metrics(rows, ["role"]).collect()) == want
    # a later batch that holds a key again replaces its row
    SK.write_batch(rows.drop("batch").limit(5).withColumn("hits", F.lit(-1).cast("bigint")), out, 9)
    newer = SK.latest(spark, out, ["id"])
    assert newer.where("hits = -1 AND batch = 9").count() == 5 and newer.count() == rows.count()
    assert SK.latest(spark, out + "-none", ["id"]) is None

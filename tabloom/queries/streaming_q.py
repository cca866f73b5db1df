"""Streaming."""

from pyspark.sql import functions as F

from tabloom.queries.registry import Tables, query
from tabloom.session import shared_dir
from tabloom.streaming import dedupe_stream, drain


@query("r1_dedupe_stream", "select distinct user_id from events where ts >= timestamp '2024-01-10'")
def r1(t: Tables):
    feed = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    path = shared_dir(t.spark, "stream-out")
    drain(dedupe_stream(feed, "user_id", "ts", "60 days", "2024-01-10").select("user_id"), path)
    return t.spark.read.parquet(path)


@query("r1_dedupe_stream_by_event", "select event_id, event_type from events where ts >= timestamp '2024-01-10'")
def r1_events(t: Tables):
    # every event arrives twice; one copy of each must be kept
    feed = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    twice = feed.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    path = shared_dir(t.spark, "stream-out")
    drain(dedupe_stream(twice, "event_id", "ts", "60 days", "2024-01-10").select("event_id", "event_type"), path)
    return t.spark.read.parquet(path)

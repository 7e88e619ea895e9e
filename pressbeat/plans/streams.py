"""Event-time streaming statistics over a topic replayed from the access log."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pressbeat.operators import rollup
from pressbeat.plans.base import query
from pressbeat.sources import events as source
from pressbeat.storage import estimated_bytes, scratch_path
from pressbeat.streaming import events as stream_events
from pressbeat.streaming import keyed, live, sinks, state, windows
from pressbeat.tables import Tables

FILES = 4
_TOPICS: dict[tuple[str, str], tuple[str, str]] = {}


def topic(t):
    """(path, end time) of the replayed topic; written once per session and data directory."""
    known = (t.spark.sparkContext.applicationId, t.sf_dir)
    if known not in _TOPICS:
        path = source.publish(source.to_event_records(t.logs), scratch_path(t.spark, "topic"))
        newest = t.logs.agg(F.date_format(F.max("event_time") + F.expr("interval 3 days"), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
        source.publish_end(t.spark, path, newest)
        _TOPICS[known] = (path, newest)
    return _TOPICS[known]


def stream(t):
    """Watermarked events of the topic."""
    path, end = topic(t)
    return stream_events.timed(stream_events.parse_events(source.read_events(t.spark, path, files_per_trigger=FILES)), end)


def stream_query(name, sql=None, *logical, stored="events", rocks=False):
    """Register a query that runs a stream, with state partitions sized to the table it replays; ``rocks`` where keys never leave the state, or timers do it."""

    def register(fn):
        def run(t):
            # records of text take a few times the room of the stored columns
            return fn(Tables(sinks.stream_session(t.spark, 4 * estimated_bytes(t.raw(stored)), rocks), t.sf_dir))

        return query(name, sql, *logical)(run)

    return register


def window_sql(size, keys, where="TRUE", measures="count(*) AS n"):
    start = f"time_bucket(INTERVAL {size}, event_time)"
    return f"SELECT {start} AS window_start, {start} + INTERVAL {size} AS window_end, {keys}, {measures} FROM logs WHERE {where} GROUP BY ALL"


@query("event_records", """
SELECT CASE WHEN action <> 'search' THEN post_id::VARCHAR END AS key, CAST(count(*) AS BIGINT) AS n, min('evt_' || log_id) AS first_id, max(event_time) AS latest
FROM logs GROUP BY 1""", "logs")
def _(t):
    records = source.to_event_records(t.logs)
    return records.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.get_json_object("value", "$.eventId")).alias("first_id"),
        F.max(F.get_json_object("value", "$.timestamp").cast("timestamp_ntz")).alias("latest"),
    )


@stream_query("stream_source_count", "SELECT count(*) AS n, count(CASE WHEN action <> 'search' THEN 1 END) AS keyed FROM logs", "logs")
def _(t):
    path, _end = topic(t)
    records = source.read_events(t.spark, path, files_per_trigger=FILES)
    kept = records.filter(~F.contains(F.col("value"), F.lit(source.END_ACTION)))
    return sinks.run_append(kept).agg(F.count(F.lit(1)).alias("n"), F.count("key").alias("keyed"))


@stream_query("stream_parse", """
SELECT CASE action WHEN 'search' THEN 'quarantine' ELSE action END AS kind, count(*) AS n, count(user_id) AS users, max(event_time) FILTER (action <> 'search') AS latest
FROM logs GROUP BY 1""", "logs")
def _(t):
    nested = source.to_event_records(t.logs.filter("action IN ('view', 'comment')"))
    flat = source.to_event_records(t.logs.filter("action IN ('like', 'share')"), "flat")
    broken = source.to_event_records(t.logs.filter("action = 'search'"))
    cut_off = broken.withColumn("value", F.expr("left(value, length(value) - 30)"))
    path = source.publish(nested.union(flat).union(cut_off), scratch_path(t.spark, "mixed-topic"), slices=2, files=FILES)
    parsed = stream_events.parse_events(source.read_events(t.spark, path, files_per_trigger=FILES))
    kept = sinks.run_append(parsed)
    good = stream_events.valid(kept).groupBy(F.col("action").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.count("user_id").alias("users"), F.max("event_time").cast("timestamp_ntz").alias("latest")
    )
    bad = stream_events.quarantine(kept).groupBy(F.lit("quarantine").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.nullif(F.regexp_extract("value", '"userId":"([0-9]+)"', 1), F.lit(""))).alias("users"),
        F.max(F.lit(None).cast("timestamp_ntz")).alias("latest"),
    )
    return good.union(bad)


@stream_query("stream_tumble_type", window_sql("5 MINUTES", "action"), "logs")
def _(t):
    return sinks.run_append(windows.tumbling(stream(t), "5 minutes", ["action"]))


@stream_query("stream_tumble_post", window_sql("5 MINUTES", "post_id", "action = 'view'"), "logs")
def _(t):
    return sinks.run_append(windows.tumbling(stream(t).filter("action = 'view'"), "5 minutes", ["post_id"]))


@stream_query("stream_tumble_post_1m", window_sql("1 MINUTE", "post_id", "action = 'view'"), "logs")
def _(t):
    return sinks.run_append(windows.tumbling(stream(t).filter("action = 'view'"), "1 minute", ["post_id"]))


@stream_query("stream_tumble_keyword", window_sql("5 MINUTES", "'kw' || post_id AS keyword", "action = 'search'"), "logs")
def _(t):
    return sinks.run_append(windows.tumbling(stream(t).filter("action = 'search'"), "5 minutes", ["keyword"]))


PIVOT = window_sql(
    "1 MINUTE", "post_id", "action <> 'search'",
    "count(*) FILTER (action = 'view') AS views, count(*) FILTER (action = 'comment') AS comments, count(*) FILTER (action = 'like') AS likes")


@stream_query("stream_tumble_pivot", PIVOT, "logs")
def _(t):
    return sinks.run_append(windows.post_pivot(stream(t)))


@stream_query("stream_upsert_sink", PIVOT, "logs")
def _(t):
    return sinks.run_upsert(windows.post_pivot(stream(t)), ["post_id", "window_start"])


@stream_query("stream_hop", """
SELECT b - INTERVAL (i) MINUTES AS window_start, b - INTERVAL (i) MINUTES + INTERVAL 5 MINUTES AS window_end, action, count(*) AS n
FROM (SELECT action, time_bucket(INTERVAL 1 MINUTE, event_time) AS b FROM logs), (SELECT unnest(range(5)) AS i) GROUP BY ALL""", "logs")
def _(t):
    return sinks.run_append(windows.hopping(stream(t), "5 minutes", "1 minute", ["action"]))


@stream_query("stream_session", """
SELECT min(event_time) AS window_start, max(event_time) + INTERVAL 30 MINUTES AS window_end, user_id, count(*) AS n FROM (
 SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY event_time, log_id ROWS UNBOUNDED PRECEDING) AS session FROM (
  SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, log_id) <= INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS fresh
  FROM logs WHERE user_id IS NOT NULL))
GROUP BY user_id, session""", "logs")
def _(t):
    signed_in = stream(t).filter("user_id IS NOT NULL").withColumn("user_id", F.col("user_id").cast("bigint"))
    # merge each task's rows of a session before the shuffle, so a very active user stays small; the session is this query's own
    t.spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return sinks.run_append(windows.sessions(signed_in, "30 minutes", ["user_id"]))


@stream_query("stream_state_ttl", """
SELECT post_id, count(*) AS n, max(event_time) + INTERVAL 1 HOUR AS expires FROM (
 SELECT *, sum(fresh) OVER (PARTITION BY post_id ORDER BY event_time, log_id ROWS UNBOUNDED PRECEDING) AS life FROM (
  SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY post_id ORDER BY event_time, log_id) <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS fresh
  FROM logs WHERE action = 'view'))
GROUP BY post_id, life""", "logs", rocks=True)
def _(t):
    return sinks.run_append(state.expiring_counts(stream(t).filter("action = 'view'"), "post_id", 3600))


@stream_query("stream_cumulate", """
SELECT day AS window_start, hour + INTERVAL (i) HOURS AS window_end, action, CAST(sum(n) AS BIGINT) AS n FROM (
 SELECT date_trunc('day', event_time)::TIMESTAMP AS day, date_trunc('hour', event_time)::TIMESTAMP AS hour, action, count(*) AS n FROM logs GROUP BY ALL),
 (SELECT unnest(range(1, 25)) AS i)
WHERE hour + INTERVAL (i) HOURS <= day + INTERVAL 24 HOURS GROUP BY ALL""", "logs")
def _(t):
    return sinks.run_append(windows.cumulating(stream(t), "1 hour", "24 hours", 24, ["action"]))


@stream_query("stream_type_counts", "SELECT action, count(*) AS n FROM logs GROUP BY action", "logs", rocks=True)
def _(t):
    return sinks.run_upsert(windows.counts_by(stream(t), "action"), ["action"])


@stream_query("stream_post_counts", "SELECT post_id, count(*) AS n FROM logs WHERE action = 'view' GROUP BY post_id", "logs", rocks=True)
def _(t):
    return sinks.run_upsert(windows.counts_by(stream(t).filter("action = 'view'"), "post_id"), ["post_id"])


@stream_query("stream_keyword_counts", "SELECT 'kw' || post_id AS keyword, count(*) AS n FROM logs WHERE action = 'search' GROUP BY 1", "logs", rocks=True)
def _(t):
    return sinks.run_upsert(windows.counts_by(stream(t).filter("action = 'search'"), "keyword"), ["keyword"])


@stream_query("stream_reduce_max", """
SELECT post_id, max(duration) AS longest, min(duration) AS shortest, round(sum(duration), 4) AS total FROM logs WHERE action <> 'search' GROUP BY post_id""", "logs", rocks=True)
def _(t):
    return sinks.run_upsert(windows.longest_by(stream(t).filter("post_id IS NOT NULL"), "post_id"), ["post_id"])


@stream_query("stream_flatmap", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ')) AS word FROM documents) WHERE word <> '' GROUP BY word""", stored="documents", rocks=True)
def _(t):
    texts = t.spark.readStream.schema("text string").parquet(f"{t.sf_dir}/documents.parquet{'' if t.is_folder('documents') else '*'}")
    words = texts.select(F.explode(F.split(F.trim(F.regexp_replace(F.lower("text"), r"\s+", " ")), " ")).alias("word")).filter("word <> ''")
    return sinks.run_upsert(windows.counts_by(words, "word"), ["word"])


@stream_query("stream_union", "SELECT action, count(*) AS n FROM logs WHERE action IN ('view', 'like') GROUP BY action", "logs", rocks=True)
def _(t):
    views, likes = (stream(t).filter(F.col("action") == action).select("action", "event_time") for action in ("view", "like"))
    return sinks.run_upsert(windows.counts_by(views.union(likes), "action"), ["action"])


@stream_query("stream_dedup", window_sql("1 DAY", "action", "action <> 'search'"), "logs")
def _(t):
    events = stream(t).filter("action <> 'search'").select("event_id", "action", "event_time")
    # every record delivered twice, as an at-least-once reader may do
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return sinks.run_append(windows.tumbling(windows.once(twice, "event_id"), "1 day", ["action"]))


@stream_query("stream_top5", "SELECT post_id, count(*) AS n FROM logs WHERE action = 'view' GROUP BY post_id ORDER BY n DESC, post_id LIMIT 5", "logs", rocks=True)
def _(t):
    counts = windows.counts_by(stream(t).filter("action = 'view'"), "post_id")
    return sinks.run_complete(counts.orderBy(F.desc("n"), "post_id").limit(5))


@stream_query("stream_sql_view", """
SELECT post_id, count(*) AS n, max(event_time) AS latest FROM logs WHERE action = 'view' GROUP BY post_id HAVING count(*) > 15""", "logs", rocks=True)
def _(t):
    view = f"live_{uuid.uuid4().hex}"
    stream(t).createOrReplaceTempView(view)
    t.spark.sql(f"SELECT post_id, event_time FROM {view} WHERE action = 'view'").createOrReplaceTempView(f"{view}_views")
    live = t.spark.sql(f"SELECT post_id, count(*) AS n, max(event_time) AS latest FROM {view}_views GROUP BY post_id")
    latest = sinks.run_upsert(live, ["post_id"]).filter("n > 15")
    return latest.withColumn("latest", F.col("latest").cast("timestamp_ntz"))


@stream_query("stream_uv", "SELECT action, count(DISTINCT user_id) AS uv, max(event_time) AS latest FROM logs WHERE user_id IS NOT NULL GROUP BY action", "logs", rocks=True)
def _(t):
    pairs = sinks.run_upsert(windows.visitors(stream(t), "action"), ["action", "user_id"])
    return pairs.groupBy("action").agg(F.count(F.lit(1)).alias("uv"), F.max("latest").cast("timestamp_ntz").alias("latest"))


@stream_query("stream_hot_tier", """
SELECT post_id, count(*) AS n, CASE WHEN count(*) >= 25 THEN 'hot' WHEN count(*) >= 18 THEN 'warm' ELSE 'normal' END AS level FROM logs WHERE action = 'view' GROUP BY post_id""", "logs", rocks=True)
def _(t):
    return sinks.run_upsert(windows.hot_tiers(stream(t), 25, 18), ["post_id"])


@stream_query("stream_heat", """
SELECT post_id, CAST(sum(CASE action WHEN 'view' THEN 1 WHEN 'like' THEN 5 WHEN 'comment' THEN 10 WHEN 'share' THEN 8 END) AS BIGINT) AS heat FROM logs WHERE action <> 'search' GROUP BY post_id""", "logs", rocks=True)
def _(t):
    return sinks.run_upsert(windows.heat(stream(t).filter("post_id IS NOT NULL")), ["post_id"])


@stream_query("stream_rollup", """
SELECT post_id, event_date, count(*) FILTER (action = 'view') AS views, count(*) FILTER (action = 'comment') AS comments,
 count(*) FILTER (action = 'like') AS likes, count(*) FILTER (action = 'share') AS shares FROM logs WHERE action <> 'search' GROUP BY ALL""", "logs")
def _(t):
    facts = stream(t).filter("post_id IS NOT NULL").withColumn("event_date", F.to_date("event_time"))
    return sinks.run_rollup(facts, rollup.post_rollup, rollup.POST_KEYS)


@stream_query("stream_resume", "SELECT action, count(*) AS n FROM logs GROUP BY action", "logs", rocks=True)
def _(t):
    """A run over the first part of the topic, then a second one from its checkpoint over the rest."""
    path, checkpoint, out = (scratch_path(t.spark, label) for label in ("topic", "checkpoint", "resumed"))
    middle = F.lit("2024-01-16").cast("date")
    counts = None
    for part in (t.logs.filter(F.col("event_date") < middle), t.logs.filter(F.col("event_date") >= middle)):
        source.publish(source.to_event_records(part), path, slices=1, files=FILES)
        parsed = stream_events.parse_events(source.read_events(t.spark, path, files_per_trigger=FILES))
        counts = windows.counts_by(stream_events.timed(parsed), "action")
        sinks.upsert(counts, ["action"], out, checkpoint, every=None)
    return keyed.read_keyed(t.spark, counts.schema, out)


LATE_BEFORE, STEPS, REMEMBERED = "2024-01-11", 24, 5
#: Rows of the log for each file of a step: some 25 MB of records.
FILE_ROWS = 100_000


@stream_query("stream_late_audit", f"""
SELECT CAST(count(*) FILTER (event_date >= DATE '{LATE_BEFORE}') AS BIGINT) AS kept, CAST(count(*) FILTER (event_date < DATE '{LATE_BEFORE}') AS BIGINT) AS late,
 CAST(count(DISTINCT (date_trunc('hour', event_time), action)) FILTER (event_date < DATE '{LATE_BEFORE}') AS BIGINT) AS late_combinations,
 count(*) + 1 AS records, CAST({STEPS + 2} AS BIGINT) AS batches FROM logs""", "logs")
def _(t):
    """Rows kept and lost when the first days of the log arrive last, after many small batches of the others.

    A row is late against the watermark of the batch before the last one. The totals come from a listener, and so cover many times the batches
    that the query itself is set to remember. A batch is as many files as its size asks for, so no part of the log is written or read by one task.
    """
    early = F.col("event_date") < F.lit(LATE_BEFORE).cast("date")
    each = max(1, t.raw("events").count() // (STEPS * FILE_ROWS))
    path = source.publish_in_order(source.to_event_records(t.logs.filter(~early)), scratch_path(t.spark, "late-topic"), STEPS, each)
    source.publish(source.to_event_records(t.logs.filter(early)), path, slices=1, files=each)
    _known, end = topic(t)
    source.publish_end(t.spark, path, end)
    parsed = stream_events.parse_events(source.read_events(t.spark, path, files_per_trigger=each))
    hourly = windows.tumbling(stream_events.timed(parsed, end), "1 hour", ["action"])
    out = scratch_path(t.spark, "late")
    # the state is a few counts an hour; what costs is opening each of its partitions in each batch
    t.spark.conf.set("spark.sql.shuffle.partitions", "2")
    t.spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(REMEMBERED))
    with live.audited(t.spark) as audit:
        totals = audit.final(sinks.append_to_parquet(hourly, out, scratch_path(t.spark, "checkpoint")))
    kept = t.spark.read.schema(hourly.schema).parquet(out).agg(F.sum("n").alias("kept"))
    total = t.logs.agg(F.count(F.lit(1))).scalar()
    seen = {"late_combinations": totals.late_rows, "records": totals.rows, "batches": totals.batches}
    return kept.select("kept", (total - F.col("kept")).alias("late"), *(F.lit(v).cast("bigint").alias(k) for k, v in seen.items()))


@stream_query("trend_stream_twin", "SELECT event_date, count(*) AS pv FROM logs GROUP BY event_date", "logs")
def _(t):
    """The daily trend from closed day windows of the stream."""
    days = sinks.run_append(windows.tumbling(stream(t), "1 day", []))
    return days.select(F.col("window_start").cast("date").alias("event_date"), F.col("n").alias("pv"))

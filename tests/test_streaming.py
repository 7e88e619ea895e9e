"""Streams: golden events, output modes, lateness, redelivery, restart."""

import datetime as dt
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pressbeat.sources import events as source
from pressbeat.streaming import events as stream_events
from pressbeat.streaming import keyed, sinks, state, windows

# The worked sample events this library has to agree with, as they are.
SAMPLE = [
    '{"type":"view","postId":1,"userId":"alice","timestamp":1713200000000}',
    '{"type":"view","postId":2,"userId":"bob","timestamp":1713200001000}',
    '{"type":"comment","postId":1,"userId":"charlie","timestamp":1713200002000}',
    '{"type":"view","postId":1,"userId":"david","timestamp":1713200003000}',
    '{"type":"like","postId":2,"userId":"alice","timestamp":1713200004000}',
    '{"type":"view","postId":3,"userId":"eve","timestamp":1713200005000}',
]
UPSERTS = [
    '{"type":"view","postId":1,"userId":"alice","event_time":"2024-04-15 10:00:00"}',
    '{"type":"view","postId":1,"userId":"bob","event_time":"2024-04-15 10:00:01"}',
    '{"type":"comment","postId":1,"userId":"charlie","event_time":"2024-04-15 10:00:02"}',
]


def write(spark, path, values):
    spark.createDataFrame([(None, v) for v in values], source.RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def stream(spark, path, end=None, **options):
    return stream_events.timed(stream_events.parse_events(source.read_events(spark, str(path), **options)), end)


def pairs(df):
    return {r[0]: r[1] for r in df.collect()}


def test_running_counts(spark, tmp_path):
    write(spark, tmp_path / "t", SAMPLE)
    assert pairs(sinks.run_upsert(windows.counts_by(stream(spark, tmp_path / "t"), "action"), ["action"])) == {"view": 4, "comment": 1, "like": 1}
    views = stream(spark, tmp_path / "t").filter("action = 'view'")
    assert pairs(sinks.run_upsert(windows.counts_by(views, "post_id"), ["post_id"])) == {1: 2, 2: 1, 3: 1}


def test_upserted_window(spark, tmp_path):
    write(spark, tmp_path / "t", UPSERTS)
    row = sinks.run_upsert(windows.post_pivot(stream(spark, tmp_path / "t")), ["post_id", "window_start"]).first()
    assert (row["post_id"], row["views"], row["comments"], row["likes"]) == (1, 2, 1, 0)
    assert (row["window_start"], row["window_end"]) == (dt.datetime(2024, 4, 15, 10, 0), dt.datetime(2024, 4, 15, 10, 1))


def test_longest_duration(spark, tmp_path):
    values = [f'{{"type":"view","postId":{p},"duration":{d},"event_time":"2024-04-15 10:00:0{i}"}}' for i, (p, d) in enumerate([(1, 30), (2, 45), (1, 60), (2, 20)])]
    write(spark, tmp_path / "t", values)
    got = sinks.run_upsert(windows.longest_by(stream(spark, tmp_path / "t"), "post_id"), ["post_id"])
    assert {r["post_id"]: r["longest"] for r in got.collect()} == {1: 60.0, 2: 45.0}


def test_both_shapes_and_quarantine(spark):
    records = [
        (None, '{"eventType":"view","timestamp":"2024-04-15T10:00:00.5","data":{"postId":7,"userId":"1"}}'), (None, UPSERTS[0]),
        (None, '{"postId":3,"event_time":"2024-04-15 10:00:00"}'), (None, "not json"), (None, '{"type":"view","event_time":"yesterday"}'),
    ]
    parsed = stream_events.parse_events(spark.createDataFrame(records, source.RECORD_SCHEMA))
    good = {(r["action"], r["post_id"]) for r in stream_events.valid(parsed).collect()}
    assert good == {("view", 7), ("view", 1), ("unknown", 3)}
    assert stream_events.quarantine(parsed).count() == 2


def test_append_holds_back_open_windows_until_the_end_record(spark, tmp_path):
    write(spark, tmp_path / "t", UPSERTS + ['{"type":"view","postId":2,"event_time":"2024-04-15 10:05:00"}'])
    open_tail = sinks.run_append(windows.tumbling(stream(spark, tmp_path / "t"), "1 minute", ["post_id"]))
    assert {r["post_id"] for r in open_tail.collect()} == {1}
    source.publish_end(spark, str(tmp_path / "t"), "2024-04-16T00:00:00")
    flushed = sinks.run_append(windows.tumbling(stream(spark, tmp_path / "t", "2024-04-16T00:00:00").filter("post_id > 0"), "1 minute", ["post_id"]))
    assert {r["post_id"]: r["n"] for r in flushed.collect()} == {1: 3, 2: 1}


def test_late_rows_are_dropped(spark, tmp_path):
    path = tmp_path / "t"
    # rows are late against the watermark of the batch before the last one
    write(spark, path, ['{"type":"view","postId":1,"event_time":"2024-04-15 12:00:00"}'])
    write(spark, path, ['{"type":"view","postId":1,"event_time":"2024-04-15 12:00:02"}'])
    write(spark, path, ['{"type":"view","postId":1,"event_time":"2024-04-15 10:00:00"}', '{"type":"view","postId":1,"event_time":"2024-04-15 12:00:01"}'])
    source.publish_end(spark, str(path), "2024-04-16T00:00:00")
    done = sinks.run_append(windows.tumbling(stream(spark, path, "2024-04-16T00:00:00", files_per_trigger=1), "1 minute", ["post_id"]))
    assert [(r["window_start"].hour, r["n"]) for r in done.collect()] == [(12, 3)]


def test_redelivered_events_count_once(spark, tmp_path):
    path, one = tmp_path / "t", '{"eventId":"e%d","eventType":"view","timestamp":"2024-04-15T10:00:0%d","data":{"postId":1}}'
    write(spark, path, [one % (i, i) for i in (1, 2, 2, 2, 3)])
    write(spark, path, [one % (i, i) for i in (3, 1, 4)])
    source.publish_end(spark, str(path), "2024-04-18T00:00:00")
    events = stream(spark, path, "2024-04-18T00:00:00", files_per_trigger=1)
    done = sinks.run_append(windows.tumbling(windows.once(events, "event_id"), "1 day", ["post_id"]))
    assert [r["n"] for r in done.collect()] == [4]


def test_sessions_merge_at_exactly_the_gap(spark, tmp_path):
    times = ["10:00:00", "10:30:00", "11:00:01"]
    write(spark, tmp_path / "t", [f'{{"type":"view","postId":1,"userId":"u","event_time":"2024-04-15 {t}"}}' for t in times])
    source.publish_end(spark, str(tmp_path / "t"), "2024-04-16T00:00:00")
    done = sinks.run_append(windows.sessions(stream(spark, tmp_path / "t", "2024-04-16T00:00:00"), "30 minutes", ["user_id"]))
    assert sorted(r["n"] for r in done.collect()) == [1, 2]


def rocks(spark, **settings):
    return sinks.stream_session(spark, 0, **settings)


def test_expired_state_starts_afresh(spark, tmp_path):
    """Lives of a key end an hour after its last event, whatever the order of arrival; a late file joins two lives to one."""
    path, own = tmp_path / "t", rocks(spark)
    for minute in ("10:00", "10:20", "12:00", "11:10", "14:00"):
        write(spark, path, [f'{{"type":"view","postId":1,"userId":"u","event_time":"2024-04-15 {minute}:00"}}'])
    write(spark, path, ['{"type":"view","postId":1,"userId":"v","event_time":"2024-04-15 14:00:01"}'])
    source.publish_end(spark, str(path), "2024-04-16T00:00:00")
    events = stream_events.timed(stream_events.parse_events(source.read_events(own, str(path), files_per_trigger=1)), "2024-04-16T00:00:00", delay="3 hours")
    done = sinks.run_append(state.expiring_counts(events, "user_id", 3600))
    assert sorted((r["user_id"], r["n"], r["expires"].hour) for r in done.filter("user_id IS NOT NULL").collect()) == [("u", 1, 15), ("u", 4, 13), ("v", 1, 15)]


def test_state_ends_while_the_source_is_idle(spark, tmp_path):
    own = rocks(spark)
    write(spark, tmp_path / "t", UPSERTS)
    counts = state.expiring_counts(stream(own, tmp_path / "t"), "post_id", 2, by_event_time=False)
    query = sinks.append_to_parquet(counts, str(tmp_path / "out"), str(tmp_path / "checkpoint"), every="500 milliseconds")
    try:
        end, rows = time.time() + 60, []
        while time.time() < end and not rows:  # a query with timers on the clock always has a batch to come
            time.sleep(1)
            rows = spark.read.schema(counts.schema).parquet(str(tmp_path / "out")).collect() if any((tmp_path / "out").glob("*.parquet")) else []
        assert [(r["post_id"], r["n"]) for r in rows] == [(1, 3)]
    finally:
        query.stop()


def test_live_upserts_resume(spark, tmp_path):
    """A live query over two triggers, stopped, and a second one from its checkpoint."""
    own, path, out, checkpoint = rocks(spark), tmp_path / "t", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    counts = windows.counts_by(stream(own, path), "action") if path.mkdir() is None else None

    def live(*files):
        query = sinks.upsert(counts, ["action"], out, checkpoint, every="200 milliseconds")
        try:
            for values in files:
                write(spark, path, values)
                query.processAllAvailable()
        finally:
            query.stop()
        return pairs(keyed.read_keyed(spark, counts.schema, out))

    assert live(SAMPLE[:2], SAMPLE[2:4]) == {"view": 3, "comment": 1}
    assert live(SAMPLE[4:]) == {"view": 4, "comment": 1, "like": 1}
    assert sinks.EVERY == "30 seconds"


def test_keyed_tables_hold_one_row_a_key(spark, tmp_path):
    """Ten batches of overlapping keys, null ones too: one row a key in storage, replaced folders gone, a repeated batch without effect."""
    path, want = str(tmp_path / "table"), {}
    kind = "k int, v int"
    for batch in range(10):
        rows = [(None if k % 7 == 0 else k, batch * 100 + k) for k in range(batch, batch + 12)]
        rows = list({k: (k, v) for k, v in rows}.values())
        for _ in range(2 if batch in (3, 9) else 1):
            keyed.merge_batch(spark.createDataFrame(rows, kind), batch, path, ["k"], buckets=4)
        want.update(rows)
        assert pairs(keyed.read_keyed(spark, spark.createDataFrame([], kind).schema, path)) == want
    assert spark.read.parquet(path).count() == len(want)
    # a write that did not finish is not read
    (tmp_path / "table" / "_batch=10" / "_bucket=0").mkdir(parents=True)
    assert pairs(keyed.read_keyed(spark, spark.createDataFrame([], kind).schema, path)) == want
    keyed.merge_batch(spark.createDataFrame([], kind), 11, path, ["k"], buckets=4)
    assert pairs(keyed.read_keyed(spark, spark.createDataFrame([], kind).schema, path)) == want


def test_summed_tables(spark, tmp_path):
    path, kind = str(tmp_path / "table"), "k string, n bigint, m double"
    for batch in range(4):
        keyed.merge_batch(spark.createDataFrame([("a", 1, 0.5), (f"b{batch}", 2, 1.0), (None, 1, 1.0)], kind), batch, path, ["k"], keyed.summed, buckets=2)
    table = {r["k"]: (r["n"], r["m"]) for r in keyed.read_keyed(spark, spark.createDataFrame([], kind).schema, path).collect()}
    assert table == {"a": (4, 2.0), None: (4, 4.0), **{f"b{i}": (2, 1.0) for i in range(4)}}


def test_streams_leave_the_session_alone(spark):
    before = spark.conf.getAll
    own = sinks.stream_session(spark, 1 << 40)
    assert "RocksDB" in own.conf.get("spark.sql.streaming.stateStore.providerClass") and own.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.getAll == before


def test_events_for_kafka(spark, tables, tmp_path):
    """The sink's options and rows; the connector itself is not installed here."""
    records = source.to_event_records(tables.logs)
    rows = source.kafka_rows(records, "blog")
    assert rows.dtypes == [("topic", "string"), ("key", "binary"), ("value", "binary")]
    odd = rows.filter("(key IS NULL) <> (get_json_object(decode(value, 'UTF-8'), '$.eventType') = 'search')")
    assert odd.isEmpty() and rows.filter("key IS NULL").count() == tables.logs.filter("action = 'search'").count() > 0
    assert source.kafka_options("a:1,b:1", "blog", **{"kafka.linger.ms": "20"}) == {
        "kafka.bootstrap.servers": "a:1,b:1", "kafka.acks": "all", "kafka.enable.idempotence": "true", "topic": "blog", "kafka.linger.ms": "20"}
    with pytest.raises(ValueError):
        source.kafka_options("")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        source.write_events(records, "blog", "kafka", "localhost:1")
    source.write_events(records, str(tmp_path / "topic"))
    assert spark.read.parquet(str(tmp_path / "topic")).exceptAll(records.select("key", "value")).isEmpty()
    source.write_events(source.read_events(spark, str(tmp_path / "topic")), str(tmp_path / "copy"), checkpoint=str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "copy")).count() == records.count()


def test_retried_batch_replaces_its_output(spark, tmp_path):
    write(spark, tmp_path / "t", SAMPLE)
    out = str(tmp_path / "out")
    for run in ("a", "b"):
        counts = windows.counts_by(stream(spark, tmp_path / "t"), "action")
        sinks.run_batches(counts, "update", out, str(tmp_path / f"checkpoint-{run}"))
    assert sinks.batches(spark, counts.schema, out).count() == 3


def test_batch_and_stream_agree(spark, tables, tmp_path):
    path = source.publish(source.to_event_records(tables.logs), str(tmp_path / "t"), slices=2, files=2)
    records = spark.read.parquet(path)
    batch = windows.hopping(stream_events.valid(stream_events.parse_events(records)), "10 minutes", "5 minutes", ["action"])
    source.publish_end(spark, path, "2030-01-01T00:00:00")
    streamed = sinks.run_append(windows.hopping(stream(spark, path, "2030-01-01T00:00:00", files_per_trigger=2), "10 minutes", "5 minutes", ["action"]))
    assert batch.exceptAll(streamed).isEmpty() and streamed.exceptAll(batch).isEmpty()


def test_unknown_sources_are_refused(spark, tables):
    with pytest.raises(ValueError):
        source.read_events(spark, "x", fmt="carrier pigeon")
    with pytest.raises(ValueError):
        source.to_event_records(tables.logs, "round")


def test_searches_carry_no_key(spark, tables):
    keys = source.to_event_records(tables.logs).select("key", F.get_json_object("value", "$.eventType").alias("kind"))
    assert keys.filter("(key IS NULL) <> (kind = 'search')").isEmpty()


def test_console(spark, tmp_path):
    write(spark, tmp_path / "t", SAMPLE)
    sinks.run_console(windows.counts_by(stream(spark, tmp_path / "t"), "action"))


def test_late_audit_takes_several_files_a_batch(spark, tmp_path, monkeypatch):
    from pressbeat.plans import streams
    from pressbeat.plans.base import QUERIES

    # some of of the later rows have one time, so that there are fewer files than asked for
    rows = [(i, f"2024-01-{1 + i % 10:02d} 00:{i % 60:02d}:00", "view") for i in range(100)]
    rows += [(1000 + i, "2024-01-20 00:00:00" if i < 80 else f"2024-01-{12 + i % 17:02d} 01:00:{i % 60:02d}", "click") for i in range(240)]
    events = spark.createDataFrame(rows, "event_id bigint, ts string, event_type string").selectExpr(
        "event_id", "CAST(ts AS timestamp_ntz) AS ts", "1L AS user_id", "event_type", "1.0D AS value", """'{"k": 1}' AS props""")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    published, taken = streams.source.publish_in_order, []
    monkeypatch.setattr(streams, "FILE_ROWS", 25)
    monkeypatch.setattr(streams, "STEPS", 4)
    monkeypatch.setattr(streams.source, "publish_in_order", lambda *a: (taken.append(a[2:]), published(*a))[1])
    found = QUERIES["stream_late_audit"](spark, str(tmp_path)).first()
    assert taken == [(4, 3)]
    assert (found.kept, found.late, found.late_combinations, found.records) == (240, 100, 10, 341)

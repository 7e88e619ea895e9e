"""Versioned tables, search and the shape of physical plans."""

import math
import re

import pytest
from table_paths import SF_DIR
from pyspark.sql import functions as F

from __spark_entry__ import queries
from pressbeat.operators import joins, ordered, ranking, search, traffic
from pressbeat.operators.lake import VersionedTable, expired
from pressbeat.sources import files
from pressbeat.storage import persisted

ROWS = [(1, "a", 4812, 31, "2025-01-06"), (5, "b", 2455, 14, "2025-03-22"), (10, "c", 1290, 66, "2025-06-09"), (11, "d", 77, 3, "2025-09-27")]


@pytest.fixture()
def lake(spark, tmp_path):
    month = F.date_format("publish_date", "yyyy-MM")
    table = VersionedTable(spark, str(tmp_path / "lake"), ["post_id"], ("month", month), fixed=["publish_date"])
    rows = spark.createDataFrame(ROWS, "post_id int, title string, views int, likes int, d string").withColumn("publish_date", F.to_date("d")).drop("d")
    table.create(rows.schema, "2026-01-01 00:00:00")
    table.append(rows.filter("post_id <= 10"), "2026-01-02 00:00:00")
    table.append(rows.filter("post_id > 10"), "2026-01-03 00:00:00")
    return table


def source(spark, rows):
    return spark.createDataFrame(rows, "post_id int, views int, likes int")



def merge(lake, spark, rows, at):
    sets = {"views": F.col("source.views"), "likes": F.col("source.likes")}
    return lake.merge(source(spark, rows), sets, {**sets, "title": F.lit("new"), "publish_date": F.lit("2026-02-01").cast("date")}, at)


def state(df):
    return {r["post_id"]: (r["views"], r["likes"]) for r in df.collect()}


def test_merge_updates_and_inserts(spark, lake):
    version = merge(lake, spark, [(1, 900, 40), (5, 500, 20), (10, 1300, 70), (99, 7, 1)], "2026-01-04 00:00:00")
    assert state(lake.read()) == {1: (900, 40), 5: (500, 20), 10: (1300, 70), 11: (77, 3), 99: (7, 1)}
    assert state(lake.read(2)) == {r[0]: (r[2], r[3]) for r in ROWS}
    assert state(lake.read(lake.version_at("2026-01-02 10:00:00"))) == {r[0]: (r[2], r[3]) for r in ROWS[:3]}
    changes = {r["post_id"]: r["change"] for r in lake.diff(2, version).collect()}
    assert changes == {1: "changed", 5: "changed", 10: "changed", 99: "added"}
    again = merge(lake, spark, [(1, 900, 40)], "2026-01-05 00:00:00")
    assert lake.diff(version, again).isEmpty()


def test_merge_broadcasts_the_source_keys(spark, lake, monkeypatch):
    plans = []
    commit = lake._commit
    monkeypatch.setattr(lake, "_commit", lambda rows, *rest: (plans.append(plan_of(rows)), commit(rows, *rest))[1])
    merge(lake, spark, [(1, 900, 40)], "2026-01-04 00:00:00")
    assert re.search(r"BroadcastHashJoin \[post_id#\d+\], \[post_id#\d+\], LeftSemi", plans[0])


def test_merge_rejects_repeated_source_keys(spark, lake):
    with pytest.raises(ValueError, match="same key"):
        merge(lake, spark, [(1, 1, 1), (1, 2, 2)], "2026-01-04 00:00:00")


def test_partition_columns_may_not_change(lake):
    with pytest.raises(ValueError, match="publish_date"):
        lake.update_where(F.lit(True), {"publish_date": F.current_date()}, "2026-01-04 00:00:00")


def test_unfinished_commits_are_invisible_and_replaced(spark, lake):
    stray = spark.createDataFrame([(77, "x", 1, 1, "insert")], "post_id int, title string, views int, likes int, _change string")
    stray.write.parquet(f"{lake.data_path}/snapshot_id=3/month=2025-01")
    assert 77 not in state(lake.read())
    merge(lake, spark, [(1, 5, 5)], "2026-01-04 00:00:00")
    assert 77 not in state(lake.read()) and state(lake.read())[1] == (5, 5)


def test_added_columns_updates_and_compaction(spark, lake):
    lake.add_column("minutes", "int", "2026-01-04 00:00:00", after="title")
    assert lake.read().columns == ["post_id", "title", "minutes", "views", "likes", "publish_date"]
    lake.update_where(F.col("views") > 2000, {"minutes": F.col("views") / 1000}, "2026-01-05 00:00:00")
    lake.update_where(F.col("post_id") == 1, {"minutes": F.lit(0)}, "2026-01-06 00:00:00")
    expected = {1: 0, 5: 2, 10: None, 11: None}
    assert {r["post_id"]: r["minutes"] for r in lake.read().collect()} == expected
    lake.compact("2026-01-07 00:00:00")
    assert {r["post_id"]: r["minutes"] for r in lake.read().collect()} == expected
    assert lake.read(1).columns == ["post_id", "title", "views", "likes", "publish_date"]
    assert sorted(r["snapshot_id"] for r in expired(lake.snapshots(), "2026-01-06 00:00:00", 3).collect()) == [0, 1, 2, 3]


def test_partition_pruning_reaches_the_scan(lake):
    plan = lake.read(partitions=["2025-01"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month", plan)


# ---- search

DOCS = [(1, "Kafka streams. The lake, the data lake!"), (2, "data warehouse and lake data"), (3, "数据湖架构 Spark性能"), (4, ""), (5, "DATA lake data lake"), (6, "database lakes")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, body string")


def test_tokens_split_scripts_and_pair_han(docs):
    got = {r["id"]: r["t"] for r in docs.select("id", search.tokens("body").alias("t")).collect()}
    assert got[3] == ["数据", "据湖", "湖架", "架构", "spark", "性能"]
    assert got[1] == ["kafka", "streams", "the", "lake", "the", "data", "lake"] and got[4] == []
    assert search.query_terms("数据湖 Spark") == ["数据", "据湖", "spark"]


def test_phrases_from_text_and_index_agree(spark, docs, tmp_path):
    expected = {1: 1, 5: 2}
    assert {r["id"]: r["hits"] for r in search.phrase(docs, "id", "body", "data lake").collect()} == expected
    search.write_index(search.build_postings(docs, "id", "body"), "id", str(tmp_path / "index"))
    index = search.read_index(spark, str(tmp_path / "index"), ["data", "lake"])
    assert {r["id"]: r["hits"] for r in search.phrase_in_index(index, "id", "data lake").collect()} == expected
    assert {r["id"] for r in search.phrase(docs, "id", "body", "数据湖").collect()} == {3}


def test_bm25_equals_a_direct_calculation(docs):
    words = {i: [w for w in re.split(r"\W+", text.lower()) if w] for i, text in DOCS if i != 3}
    words[3] = ["数据", "据湖", "湖架", "架构", "spark", "性能"]
    held = [w for w in words.values() if w]
    mean, n = sum(map(len, held)) / len(held), len(held)
    expected = {}
    for i, w in words.items():
        score = 0.0
        for term in ("data", "kafka"):
            df, tf = sum(term in other for other in held), w.count(term)
            score += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
        if score:
            expected[i] = score
    got = {r["id"]: r["score"] for r in search.match(docs, "id", "body", "data Kafka").collect()}
    assert got == pytest.approx(expected)
    with pytest.raises(ValueError):
        search.match(docs, "id", "body", " ... ")


def test_highlight_marks_whole_words(docs):
    got = {r["id"]: r["fragments"] for r in search.highlight(docs, "id", "body", "lake", size=10, number=2).collect()}
    assert set(got) == {1, 2, 5}
    assert got[1] == [" The <em>lake</em>, the", "data <em>lake</em>!"]
    assert got[5] == ["DATA <em>lake</em> data", " <em>lake</em>"]


# ---- plans


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


STREAM_OR_WRITE = ("stream_", "job_", "lake_", "trend_stream")


@pytest.mark.parametrize("name", sorted(n for n in queries() if not n.startswith(STREAM_OR_WRITE)))
def test_no_query_compares_all_pairs(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = plan_of(queries()["src_parquet_pruned"](spark, SF_DIR))
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_shipdate" in plan
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", plan)


def test_top_k_is_not_a_full_sort(spark, tables):
    assert "TakeOrderedAndProject" in plan_of(ranking.top_n(tables.posts, 5, F.desc("views"), "post_id"))
    grouped = ranking.top_n_per_group(tables.posts, ["category"], 3, F.desc("views"), "post_id")
    assert plan_of(grouped).count("WindowGroupLimit") == 2


def test_logs_are_reduced_before_the_join(spark, tables):
    plan = plan_of(traffic.hot_posts(tables.logs, tables.articles))
    assert plan.index("Join") < plan.index("HashAggregate")


def test_blocks_split_a_large_group(spark):
    rows = spark.range(10_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"))
    blocks = ordered.ordered_blocks(rows, ["id"], ["g"], blocks=9)
    sizes = {r["_block"]: r["count"] for r in blocks.filter("g = 'hot'").groupBy("_block").count().collect()}
    assert len(sizes) >= 3 and max(sizes.values()) < 2500


def test_written_stages_use_the_named_checkpoint_folder(spark, tables):
    root = spark.conf.get("spark.checkpoint.dir")
    assert all(root in f for f in ordered.row_index(tables.posts.select("post_id"), ["post_id"]).inputFiles())


def test_hot_keys_are_split_from_the_shuffle(spark):
    facts = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 1000 != 1, F.col("id")).alias("k"))
    names = spark.range(20_000).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name")).filter("k <> 5")
    facts = facts.withColumn("k", F.col("k").cast("int"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plain = facts.join(names, "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not joins.fits_broadcast(names)
        split = joins.dimension_join(facts, names, "k")
        plan = plan_of(split)
        assert "BroadcastHashJoin" in plan and ("SortMergeJoin" in plan or "ShuffledHashJoin" in plan)
        assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert joins.fits_broadcast(spark.range(10)) and joins.threshold_bytes("10MB") == joins.threshold_bytes("10485760b") == 10485760


def test_persisted_rows_are_released(spark):
    df = spark.range(100)
    with persisted(df, "DISK_ONLY") as kept:
        assert kept.count() == 100 and kept.storageLevel.useDisk
    assert not df.storageLevel.useDisk
    with pytest.raises(ValueError):
        with persisted(df, "PAPER"):
            pass


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert files.SAVE_MODES[0] == "append"


def test_index_blocks_follow_the_postings_and_not_the_stored_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_BYTES", 64 * 1024)
    path = str(tmp_path / "docs")
    words = [" ".join(f"w{k}" for k in range(500))] * 100  # one text in the file's dictionary, 50,000 postings in memory
    spark.createDataFrame([(i, text) for i, text in enumerate(words)], "doc_id bigint, text string").coalesce(1).write.parquet(path)
    search.write_index(search.build_postings(spark.read.parquet(path), "doc_id", "text"), "doc_id", str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    sizes = [r["count"] for r in index.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 50_000 and len(sizes) > 40 and max(sizes) < 5_000
    assert {(r.doc_id, r.hits) for r in search.phrase_in_index(index, "doc_id", "w7 w8").collect()} == {(i, 1) for i in range(100)}


def test_lake_differences_shuffle_each_stored_row_once(spark, lake):
    lake.update_where(F.col("post_id") <= 5, {"likes": F.col("likes") + 1}, "2026-01-04 00:00:00")
    version = merge(lake, spark, [(1, 900, 40), (99, 7, 1)], "2026-01-05 00:00:00")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        changes = lake.diff(2, version)
        found = {r["post_id"]: (r["change"], r["old_row"] and r["old_row"]["likes"], r["new_row"]["likes"]) for r in changes.collect()}
        plan = changes._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    likes = {r[0]: r[3] for r in ROWS}
    assert found == {k: ("changed", n, 40 if k == 1 else n + 1) for k, n in likes.items() if k <= 5} | {99: ("added", None, 1)}
    shuffles = [line for line in plan.splitlines() if "- Exchange hashpartitioning" in line]
    assert len(shuffles) == 2  # the stored rows and the keys of the commits; all else reads these again

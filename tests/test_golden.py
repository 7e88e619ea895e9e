"""Small hand-checked cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pressbeat import jobs
from pressbeat.operators import clean, frame, joins, quality, ranking, rollup, stats, traffic
from pressbeat.sources import catalog, export, files

POSTS = [
    (1, "Pruning roses", "mira", 410, 7), (2, "Rose soil", "mira", 1230, 18), (3, "Compost basics", "mira", 3650, 91), (4, "Winter hedges", "otto", 640, 12),
    (5, "Compost heat", "otto", 2075, 33), (6, "Bee hotels", "otto", 150, 2), (7, "Dry beds", "pia", 2990, 77), (8, "Rose hips", "pia", 505, 9),
    (9, None, "rolf", None, 4), (10, "Pond care", "rolf", 5120, 140),
]


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(POSTS, "id int, title string, author string, views int, likes int")


def test_rollup_subtotals(posts):
    kind = F.when(F.col("title").like("%Rose%"), "rose").when(F.col("title").like("%Compost%"), "compost").otherwise("other")
    rows = posts.withColumn("kind", kind).rollup("author", "kind").agg(F.sum("views").alias("v")).collect()
    got = {(r["author"], r["kind"]): r["v"] for r in rows}
    assert got[(None, None)] == 16770
    assert [got[(a, None)] for a in ("mira", "otto", "pia", "rolf")] == [5290, 2865, 3495, 5120]
    assert (got[("otto", "compost")], got[("otto", "other")], got[("pia", "rose")]) == (2075, 790, 505)
    cube = posts.withColumn("kind", kind).cube("author", "kind").agg(F.sum("views").alias("v")).collect()
    assert set(map(tuple, rows)) <= set(map(tuple, cube))


def test_clean_posts_keeps_the_valid_rows(spark):
    raw = [
        (1, "  Rose soil  ", "mira", 1640, 18, " rose, Garden Soil ,bed ", "2023-03-04"), (2, "Dry beds", " pia", 2990, 77, " beds,dry ", "2023-05-19"),
        (3, "Compost heat", "otto", None, 33, "compost", "2023-06-02"), (4, "Pond care", "rolf", 505, None, None, "2023-09-23"),
        (5, None, "rolf", None, 4, "pond", "2023-09-30"), (6, "Bee hotels", "otto", -3, 2, "bees", "no-date"), (7, "", "uwe", 640, 12, "", "2023-10-11"),
        (8, "Leaf mould", "otto", -41, 6, "", "2023-11-05"),
    ]
    df = spark.createDataFrame(raw, "id int, title string, author string, views int, likes int, tags string, publish_date string")
    got = {r["id"]: r for r in clean.clean_posts(df).collect()}
    assert sorted(got) == [1, 2, 3, 4, 8]
    assert (got[1]["title"], got[1]["tags"], got[1]["tag_count"], got[1]["engagement"]) == ("Rose soil", "rose,gardensoil,bed", 3, 1730)
    assert (got[2]["author"], got[3]["views"], got[4]["likes"], got[4]["tag_count"], got[8]["views"]) == ("pia", 0, 0, 0, 0)
    assert (got[2]["popularity"], got[3]["popularity"], got[1]["popularity"]) == ("normal", "cold", "normal")
    assert (got[1]["publish_date"], got[1]["year"], got[1]["month"]) == (dt.date(2023, 3, 4), 2023, 3)


def test_clean_logs_rejects_bad_times(spark):
    rows = [("u1", 1, " VIEW ", "2024-04-15 10:00:00"), ("u1", 1, "like", "2024-04-15T25:00"), (None, 1, "view", "2024-04-15 10:00:00")]
    got = clean.clean_access_logs(spark.createDataFrame(rows, "user_id string, post_id int, action string, timestamp string")).collect()
    assert [(r["action"], r["event_hour"]) for r in got] == [("view", 10)]


def test_leaderboard(spark):
    scores = spark.createDataFrame([("1001", 107), ("1002", 200), ("1003", 160), ("1004", 80), ("1005", 50)], "post string, heat int")
    assert [r["post"] for r in ranking.leaderboard(scores, "post", "heat", 3).orderBy("place").collect()] == ["1002", "1003", "1001"]
    assert {r["post"]: r["rank"] for r in ranking.leaderboard_ranks(scores, "post", "heat").collect()}["1001"] == 3
    assert tuple(ranking.leaderboard_summary(scores, "heat", 80, 160).first()) == (5, 3, 4)
    left = frame.non_members(scores, spark.createDataFrame([("1005",)], "post string"), ["post"])
    assert left.count() == 4


def test_follower_sets(spark):
    a, b = (spark.createDataFrame([(i,) for i in ids], "id int") for ids in ([2001, 2002, 2003, 2003], [2002, 2003, 2004]))
    assert sorted(r["id"] for r in frame.intersect(a, b).collect()) == [2002, 2003]
    assert [r["id"] for r in frame.subtract(a, b).collect()] == [2001]
    assert frame.union_distinct(a, b).count() == 4 and frame.union_all(a, b).count() == 7


def test_replace_latest_and_rollup_identity(spark):
    rows = spark.createDataFrame([("d1", 1, 10), ("d1", 3, 30), ("d1", 2, 20), ("d2", 1, 5)], "day string, version int, pv int")
    assert sorted(map(tuple, rollup.replace_latest(rows, ["day"], "version").collect())) == [("d1", 3, 30), ("d2", 1, 5)]
    old = rows.select("day", F.col("pv").cast("bigint").alias("pv"))
    merged = rollup.rollup_merge(old, old, ["day"])
    assert sorted(map(tuple, merged.collect())) == [("d1", 120), ("d2", 10)]


def test_contains_join_equals_brute_force(spark):
    texts = [(1, "spark,sql"), (2, "hadoop"), (3, ""), (4, "sqlspark spark"), (5, None)]
    needles = ["spark", "sql", "o", "", "zz", "hadoopx", "k s", "sqlspark spark", "park," * 30]
    left, right = spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame([(n,) for n in needles], "needle string")
    expected = {(i, n) for i, text in texts for n in needles if n and text and n in text}
    inner = joins.contains_join(left, "text", right, "needle", "id").collect()
    assert {(r["id"], r["needle"]) for r in inner} == expected and len(inner) == len(expected)
    outer = joins.contains_join(left, "text", right, "needle", "id", "left").collect()
    missing = {(i, None) for i, _ in texts if i not in {e[0] for e in expected}}
    assert {(r["id"], r["needle"]) for r in outer} == expected | missing and len(outer) == len(expected | missing)
    assert joins.contains_join(left, "text", right.limit(0), "needle", "id").isEmpty()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = joins.contains_join(left, "text", right, "needle", "id").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(tuple, merged)) == sorted(map(tuple, inner))


def test_grid_is_dense_and_bounded(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "r string, c int")
    assert sorted(map(tuple, frame.grid(df, "r", "c").collect())) == [(r, c) for r in "ab" for c in (1, 2, 3)]
    with pytest.raises(Exception, match="more than 2 distinct"):
        frame.grid(df, "r", "c", limit=2).collect()


def test_small_inputs_use_all_cores_and_large_ones_stay(spark, monkeypatch):
    from pressbeat import storage

    small = spark.range(10).coalesce(1)
    assert storage.use_all_cores(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(storage, "SPREAD_BYTES_PER_CORE", 0)
    assert storage.use_all_cores(small) is small


def test_reduce_counts_skips_malformed_lines(spark):
    lines = spark.createDataFrame([("a\t2",), ("a\t3",), ("b\tx",), ("c",), ("d\t1.5",), ("e\t 4 ",)], "value string")
    assert sorted(map(tuple, stats.reduce_counts(lines).collect())) == [("a", 5), ("e", 4)]


def test_corrupt_rows_are_quarantined(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,title,views\n1,ok,5\n2,bad,many\n3,also,7,extra\n")
    read = files.read_csv(spark, str(tmp_path / "in.csv"), "id int, title string, views int")
    good, bad = files.split_corrupt(read)
    assert [r["id"] for r in good.collect()] == [r["id"] for r in good.select("id").collect()] == [1] and good.count() == 1
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["2,bad,many", "3,also,7,extra"] and bad.select("id").count() == 2


def test_header_names_do_not_matter(spark, tmp_path):
    (tmp_path / "in.csv").write_text('post_id,visits,tags\n1,5,"a,b,c"\n')
    row = files.read_csv(spark, str(tmp_path / "in.csv"), "id int, views int, tags string", corrupt_column=None).first()
    assert (row["id"], row["views"], row["tags"]) == (1, 5, "a,b,c")


def test_multiline_json_array(spark, tmp_path):
    (tmp_path / "in.json").write_text('[{"id": "1", "tags": ["a", "b"]},\n {"id": "2", "tags": []}]')
    assert files.read_json(spark, str(tmp_path / "in.json"), "id string, tags array<string>", multiline=True).count() == 2


def test_single_file_refuses_large_results(spark, tmp_path):
    with pytest.raises(ValueError):
        files.write_single_file(spark.range(11), str(tmp_path / "one"), max_rows=10)
    files.write_single_file(spark.range(10), str(tmp_path / "one"), max_rows=10)
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1


def test_overwriting_one_partition_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([(1, "a"), (2, "b")], [(3, "b")]):
        files.load_partitioned(spark.createDataFrame(rows, "id int, k string"), path, {"part": F.col("k")})
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 3]


def test_bulk_audit_counts(spark):
    response = '{"items":[{"index":{"_id":"1","status":201}},{"index":{"_id":"2","status":400,"error":{"type":"t","reason":"r"}}}]}'
    audit = {r["status"]: (r["succeeded"], r["failed"]) for r in export.bulk_audit(spark.createDataFrame([(response,)], "value string")).collect()}
    assert audit == {201: (1, 0), 400: (0, 1)}


def test_quality_report(spark, posts):
    checks = quality.union_checks(
        quality.row_count_check(posts, "rows", 5), quality.null_ratio_check(posts, "nulls", ["title"], 0.05),
        quality.band_check(posts, "band", F.lit(85.0) + F.count(F.lit(1)) * 0),
    )
    assert tuple(quality.report(checks).first()) == (1, 1, 1, 2)


def test_small_operators(spark, posts):
    clipped = posts.select("id", frame.clip(F.col("views"), 1000, 3000).alias("v")).collect()
    assert {r["id"]: r["v"] for r in clipped}[9] is None and {r["id"]: r["v"] for r in clipped}[3] == 3000
    cut = posts.select(stats.cut(F.col("views"), [0, 1000, 3000], ["low", "mid"]).alias("b")).groupBy("b").count().collect()
    assert dict(map(tuple, cut)) == {"low": 4, "mid": 3, None: 3}
    sampled = frame.sample_rows(posts, 4, "id", 1).collect()
    assert len(sampled) == 4 and sampled == frame.sample_rows(posts.repartition(3), 4, "id", 1).collect()
    mapped = frame.map_values(posts, "author", {"mira": "A"}, "m").groupBy("m").count().collect()
    assert dict(map(tuple, mapped)) == {"A": 3, None: 7}
    large = {f"x{i}": str(i) for i in range(1001)} | {"mira": "A"}
    assert frame.map_values(posts, "author", large, "m").filter("m = 'A'").count() == 3
    profile = catalog.profile_schema(posts).collect()
    assert [(r["rows"], r["column"], r["type"]) for r in profile][0] == (10, "id", "int")


def test_melt_and_pivot_are_inverse(spark, posts):
    long = frame.melt(posts.dropna(), ["id"], ["views", "likes"])
    back = long.groupBy("id").pivot("variable", ["views", "likes"]).agg(F.first("value"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, posts.dropna().select("id", "views", "likes").collect()))


def test_silent_users_and_growth(spark):
    users = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2024, 1, 1))], "user_id int, username string, register_date date")
    logs = spark.createDataFrame([(1, dt.date(2024, 1, 3)), (1, dt.date(2024, 1, 9))], "user_id int, event_date date")
    got = {r["user_id"]: (r["days_to_first"], r["days_to_last"], r["operations"], r["level"]) for r in traffic.new_user_activity(users, logs).collect()}
    assert got == {1: (2, 8, 2, "low"), 2: (None, None, 0, "silent")}
    months = spark.createDataFrame([("2024-01", 100), ("2024-02", 150), ("2024-03", 0), ("2024-04", 9)], "month string, v bigint")
    assert [r["v_growth"] for r in traffic.growth(months, "month", ["v"]).orderBy("month").collect()] == [None, 50.0, -100.0, None]


def test_post_reports(spark, tmp_path):
    rows = [(1, " A ", "ann", "c", "x, y", 10, 1, 0, "2024-01-02", "published"), (2, "Bees", "ann", "c", "x", 4000, 2, 0, "2024-02-02", "draft")]
    paths = jobs.post_reports(spark.createDataFrame(rows, jobs.RAW_POSTS), str(tmp_path))
    assert spark.read.parquet(paths["posts"]).count() == 2 and spark.read.json(paths["months"]).count() == 2
    author = spark.read.option("header", True).option("inferSchema", True).csv(paths["authors"]).first()
    assert (author["n_posts"], author["all_views"], author["mean_views"], author["mean_title_length"], author["n_hot"]) == (2, 4010, 2005.0, 2.5, 1)


def test_pivots_keep_every_row(spark):
    """Values beyond those with columns of their own, and missing ones, are in a column for the rest."""
    rows = [("a", f"v{i % 9}" if i % 10 else None, i) for i in range(200)] + [("b", "v1", 7), ("b", None, 5), ("c", "zz", 1)]
    df = spark.createDataFrame(rows, "r string, c string, m int")
    found = {r["r"]: r.asDict() for r in stats.pivot_sum(df, "r", "c", "m", most=4).collect()}
    assert len(found["a"]) == 6 and "rest" in found["a"]
    for key in "abc":
        assert sum(v for k, v in found[key].items() if k != "r") == sum(m for r, _, m in rows if r == key)
    total = next(r for r in stats.crosstab_margins(df, "r", "c", most=3).collect() if r["r"] == "All").asDict()
    assert total["All"] == sum(v for k, v in total.items() if k not in ("r", "All")) == sum(c is not None for _, c, _ in rows)
    flags = frame.one_hot(df, "c", "is", most=2).collect()
    assert all(sum(v for k, v in r.asDict().items() if k.startswith("is_")) == 1 for r in flags) and len(flags) == len(rows)


def test_sketches_merge_and_overlap(spark):
    rows = [("a", i % 300) for i in range(900)] + [("b", i) for i in range(200, 500)] + [("b", None)]
    logs = spark.createDataFrame(rows, "device string, user_id bigint").withColumn("day", F.col("user_id") % 5)
    merged = rollup.sketch_requery(rollup.sketch_rollup(logs, ["day", "device"]), ["device"])
    found = {r["device"]: r for r in merged.collect()}
    assert (found["a"]["uv"], found["b"]["uv"], found["a"]["pv"]) == (300, 300, 900)
    left, right = merged.filter("device = 'a'").select(F.col("visitors").alias("x")), merged.filter("device = 'b'").select(F.col("visitors").alias("y"))
    both = left.join(right).select(*(c.alias(n) for n, c in rollup.sketch_overlap(F.col("x"), F.col("y")).items())).first()
    assert tuple(both) == (100, 200, 200)
    many = spark.range(200_000).select(F.lit("a").alias("device"), F.col("id").alias("user_id"))
    uv = rollup.sketch_requery(rollup.sketch_rollup(many, ["device"], 10), ["device"], 10).first()["uv"]
    assert uv != 200_000 and abs(uv - 200_000) < 3 * 200_000 / 2**5


def test_catalog_partitions(spark, tmp_path):
    catalog.create_database(spark, "blog_test")
    spark.sql(f"CREATE TABLE blog_test.p (id INT, m STRING) USING parquet PARTITIONED BY (m) LOCATION '{tmp_path}/p'")
    catalog.add_partition(spark, "blog_test.p", {"m": "2024-01"})
    assert [r[0] for r in catalog.show_partitions(spark, "blog_test.p").collect()] == ["m=2024-01"]
    assert "id" in [r[0] for r in catalog.describe(spark, "blog_test.p").collect()]
    assert catalog.show_tables(spark).columns
    catalog.drop_database(spark, "blog_test")

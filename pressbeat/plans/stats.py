"""Aggregations, windows, bins, top-k and leaderboards."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pressbeat.functions.aggregates import row_count
from pressbeat.functions.udfs import mean_udf
from pressbeat.operators import ordered, ranking
from pressbeat.operators import stats as ops
from pressbeat.operators import traffic
from pressbeat.plans.base import query
from pressbeat.storage import scratch_path

STATUSES = ["published", "archived", "draft"]


@query("group_multi_agg", """
SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, round(avg(l_extendedprice), 4) AS avg_price, max(l_discount) AS max_discount,
 min(l_shipdate::DATE) AS first_ship, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag""")
def _(t):
    return t.raw("lineitem").groupBy("l_returnflag").agg(
        row_count().alias("n"), F.sum("l_quantity").alias("sum_qty"), F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
        F.max("l_discount").alias("max_discount"), F.min(F.col("l_shipdate").cast("date")).alias("first_ship"), F.count_distinct("l_suppkey").alias("suppliers"),
    )


def grouping_query(kind):
    return f"""
SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) * 2 + grouping(l_linestatus) AS BIGINT) AS level, count(*) AS n,
 CAST(sum(l_quantity) AS DOUBLE) AS sum_qty FROM lineitem GROUP BY {kind} (l_returnflag, l_linestatus)"""


def grouped_sums(grouped):
    return grouped.agg(F.grouping_id().alias("level"), row_count().alias("n"), F.sum("l_quantity").alias("sum_qty"))


@query("agg_rollup", grouping_query("ROLLUP"))
def _(t):
    return grouped_sums(t.raw("lineitem").rollup("l_returnflag", "l_linestatus"))


@query("agg_cube", grouping_query("CUBE"))
def _(t):
    return grouped_sums(t.raw("lineitem").cube("l_returnflag", "l_linestatus"))


@query("stats_scalar", """
SELECT CAST(sum(views) AS BIGINT) AS sum, round(avg(views), 9) AS mean, max(views) AS max, min(views) AS min, round(stddev_samp(views), 6) AS std,
 (SELECT post_id FROM posts ORDER BY views DESC, post_id LIMIT 1) AS argmax, (SELECT post_id FROM posts ORDER BY views, post_id LIMIT 1) AS argmin,
 round(corr(views, likes), 9) AS corr, median(views)::DOUBLE AS median FROM posts""", "posts")
def _(t):
    return ops.scalar_stats(t.posts, "views", "post_id", "likes")


@query("pivot_sum", "SELECT category, " + ", ".join(
    f"coalesce(CAST(sum(views) FILTER (status = '{s}') AS BIGINT), 0) AS {s}" for s in STATUSES) + ", 0::BIGINT AS rest FROM posts GROUP BY category", "posts")
def _(t):
    return ops.pivot_sum(t.posts, "category", "status", "views")


@query("crosstab_margins", "SELECT coalesce(category, 'All') AS category, " + ", ".join(
    f"count(*) FILTER (status = '{s}') AS {s}" for s in STATUSES) + """, 0::BIGINT AS rest, count(*) AS "All" FROM posts GROUP BY ROLLUP (category)""", "posts")
def _(t):
    return ops.crosstab_margins(t.posts, "category", "status")


@query("value_counts", "SELECT action, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(action) FROM logs), 9) AS share FROM logs WHERE action IS NOT NULL GROUP BY action", "logs")
def _(t):
    return ops.value_counts(t.logs, "action")


@query("unique_values", "SELECT count(DISTINCT author) AS authors, count(DISTINCT category) AS categories, count(DISTINCT status) AS statuses FROM posts", "posts")
def _(t):
    return t.posts.agg(*[F.count_distinct(c).alias(n) for c, n in (("author", "authors"), ("category", "categories"), ("status", "statuses"))])


@query("group_transform", """
SELECT post_id, round(avg(views) OVER (PARTITION BY category), 6) AS group_mean, round(views - avg(views) OVER (PARTITION BY category), 6) AS difference FROM posts""", "posts")
def _(t):
    done = ops.group_transform(t.posts.select("post_id", "category", "views"), "category", "views")
    return done.select("post_id", F.round("group_mean", 6).alias("group_mean"), F.round("difference", 6).alias("difference"))


WORDS = "(SELECT unnest(string_split_regex(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) AS word FROM documents)"


@query("word_count", f"SELECT word, count(*) AS n FROM {WORDS} WHERE word <> '' GROUP BY word")
def _(t):
    return ops.word_count(t.docs, "text")


@query("word_count_top", f"SELECT word, count(*) AS n FROM {WORDS} WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 20")
def _(t):
    return ranking.top_n(ops.word_count(t.docs, "text"), 20, F.desc("n"), "word")


@query("word_count_reduce", "SELECT author AS word, CAST(sum(views) AS BIGINT) AS n FROM posts WHERE status IN ('published', 'archived') GROUP BY author", "posts")
def _(t):
    path = scratch_path(t.spark, "pairs")
    line = F.when(F.col("status") == "draft", F.concat("author", F.lit("\tmany"))).otherwise(F.concat_ws("\t", "author", F.col("views").cast("string")))
    broken = t.posts.filter(F.col("likes") == 0).select(F.lit("no tab here").alias("value"))
    t.posts.select(line.alias("value")).union(broken).write.text(path)
    return ops.reduce_counts(t.spark.read.text(path))


@query("resample_week", """
WITH w AS (SELECT CAST(publish_date + CAST(7 - isodow(publish_date) AS INTEGER) AS DATE) AS week_end, count(*) AS posts, CAST(sum(views) AS BIGINT) AS sum_views,
  round(avg(views), 9) AS avg_views FROM posts GROUP BY 1)
SELECT CAST(d.week_end AS DATE) AS week_end, posts, sum_views, avg_views
FROM (SELECT unnest(generate_series((SELECT min(week_end) FROM w)::TIMESTAMP, (SELECT max(week_end) FROM w)::TIMESTAMP, INTERVAL 7 DAYS)) AS week_end) d
LEFT JOIN w ON w.week_end = d.week_end""", "posts")
def _(t):
    measures = {"posts": row_count(), "sum_views": F.sum("views"), "avg_views": F.round(F.avg("views"), 9)}
    return ops.resample_week(t.posts, "publish_date", measures)


@query("date_histogram", """
WITH m AS (SELECT date_trunc('month', publish_date)::DATE AS month, count(*) AS docs FROM posts WHERE status = 'draft' GROUP BY 1)
SELECT strftime(d.month, '%Y-%m') AS month, coalesce(docs, 0) AS docs
FROM (SELECT unnest(generate_series((SELECT min(month) FROM m)::TIMESTAMP, (SELECT max(month) FROM m)::TIMESTAMP, INTERVAL 1 MONTH)) AS month) d
LEFT JOIN m ON m.month = d.month""", "posts")
def _(t):
    return ops.date_histogram(t.posts.filter("status = 'draft'"), "publish_date")


@query("terms_agg", """
SELECT author, count(*) AS doc_count, CAST(sum(views) AS BIGINT) AS total_views, round(avg(likes), 9) AS avg_likes, count(title) AS post_count
FROM posts GROUP BY author ORDER BY doc_count DESC, author LIMIT 10""", "posts")
def _(t):
    nested = {"total_views": F.sum("views"), "avg_likes": F.round(F.avg("likes"), 9), "post_count": F.count("title")}
    return ops.terms_agg(t.posts, "author", 10, nested)


# ---- windows


@query("win_rank", """
SELECT post_id, rank() OVER (ORDER BY views DESC) AS rank, dense_rank() OVER (ORDER BY views DESC) AS dense_rank,
 rank() OVER (PARTITION BY category ORDER BY views DESC) AS category_rank FROM posts""", "posts")
def _(t):
    ranked = ordered.rank_by(t.posts.select("post_id", "category", "views"), "views", descending=True).drop("rank_avg")
    within = ordered.rank_by(t.posts.select("post_id", "category", "views"), "views", ["category"], descending=True)
    return ranked.select("post_id", "rank", "dense_rank").join(within.select("post_id", F.col("rank").alias("category_rank")), "post_id")


@query("win_rank_avg", """
SELECT post_id, rank() OVER (ORDER BY likes) AS rank_min, rank() OVER (ORDER BY likes) + (count(*) OVER (PARTITION BY likes) - 1) / 2.0::DOUBLE AS rank_avg FROM posts""", "posts")
def _(t):
    ranked = ordered.rank_by(t.posts.select("post_id", "likes"), "likes")
    return ranked.select("post_id", F.col("rank").alias("rank_min"), "rank_avg")


@query("win_city_rank", """
SELECT post_id, city, views, CAST(row_number() OVER (PARTITION BY post_id ORDER BY views DESC, city) AS INTEGER) AS city_rank
FROM (SELECT post_id, city, count(*) FILTER (action = 'view') AS views FROM logs l JOIN users u ON l.user_id = u.user_id GROUP BY ALL)""", "logs", "users")
def _(t):
    per_user = t.logs.filter("user_id IS NOT NULL").groupBy("post_id", "user_id").agg(traffic.action_count("view").alias("n"))
    views = traffic.with_city(per_user, t.users).groupBy("post_id", "city").agg(F.sum("n").alias("views"))
    # one row per post and city, so a post's window spans at most the number of cities
    return views.withColumn("city_rank", F.row_number().over(Window.partitionBy("post_id").orderBy(F.desc("views"), "city")))


@query("win_shift_diff", """
SELECT log_id, lag(duration) OVER w AS previous, lead(duration) OVER w AS following, round(duration - lag(duration) OVER w, 6) AS diff,
 round(duration / nullif(lag(duration) OVER w, 0) - 1, 6) AS pct FROM logs WINDOW w AS (PARTITION BY device ORDER BY event_time, log_id)""", "logs")
def _(t):
    def columns(w):
        before = F.lag("duration").over(w)
        return {
            "previous": before, "following": F.lead("duration").over(w), "diff": F.round(F.col("duration") - before, 6),
            "pct": F.round(F.try_divide(F.col("duration"), before) - 1, 6),
        }

    df = t.logs.select("log_id", "device", "event_time", "duration")
    return ordered.bounded_frame(df, columns, ["event_time", "log_id"], ["device"], before=1, after=1).drop("device", "event_time", "duration")


@query("win_cumulative", """
SELECT post_id, CAST(sum(views) OVER w AS BIGINT) AS running_views, max(views) OVER w AS best_so_far
FROM posts WINDOW w AS (ORDER BY publish_date, post_id ROWS UNBOUNDED PRECEDING)""", "posts")
def _(t):
    df = t.posts.select("post_id", "publish_date", "views")
    done = ordered.running(df, {"running_views": ("sum", "views"), "best_so_far": ("max", "views")}, ["publish_date", "post_id"])
    return done.drop("publish_date", "views")


@query("win_rolling", """
SELECT event_date, action, CASE WHEN count(*) OVER w3 = 3 THEN round(avg(n) OVER w3, 9) END AS mean3, CAST(sum(n) OVER w7 AS BIGINT) AS sum7
FROM (SELECT event_date, action, count(*) AS n FROM logs GROUP BY ALL)
WINDOW w3 AS (PARTITION BY action ORDER BY event_date ROWS 2 PRECEDING), w7 AS (PARTITION BY action ORDER BY event_date ROWS 6 PRECEDING)""", "logs")
def _(t):
    daily = t.logs.groupBy("event_date", "action").agg(row_count().alias("n"))
    window = Window.partitionBy("action").orderBy("event_date")
    three, seven = window.rowsBetween(-2, 0), window.rowsBetween(-6, 0)
    full = F.count("n").over(three) == 3
    return daily.select("event_date", "action", F.when(full, F.round(F.avg("n").over(three), 9)).alias("mean3"), F.sum("n").over(seven).alias("sum7"))


@query("win_rolling_rows", """
SELECT log_id, round(sum(duration) OVER w, 4) AS sum7, CASE WHEN count(*) OVER w = 7 THEN round(avg(duration) OVER w, 4) END AS mean7
FROM logs WINDOW w AS (ORDER BY event_time, log_id ROWS 6 PRECEDING)""", "logs")
def _(t):
    def columns(w):
        seven = w.rowsBetween(-6, 0)
        return {"sum7": F.round(F.sum("duration").over(seven), 4), "mean7": F.when(F.count("duration").over(seven) == 7, F.round(F.avg("duration").over(seven), 4))}

    df = t.logs.select("log_id", "event_time", "duration")
    return ordered.bounded_frame(df, columns, ["event_time", "log_id"], before=6).drop("event_time", "duration")



@query("bin_qcut", f"""
SELECT post_id, CAST((views > e[1])::INT + (views > e[2])::INT + (views > e[3])::INT AS INTEGER) AS bin
FROM posts, (SELECT quantile_cont(views, [0.25, 0.5, 0.75]) AS e FROM (SELECT views::DOUBLE AS views FROM posts))""", "posts")
def _(t):
    return ops.qcut(t.posts.select("post_id", "views"), "views", 4).drop("views")


@query("bin_cut", """
SELECT post_id, CASE WHEN views > 0 AND views <= 1000 THEN 'low' WHEN views > 1000 AND views <= 3000 THEN 'mid' WHEN views > 3000 AND views <= 5000 THEN 'high' END AS bin FROM posts""", "posts")
def _(t):
    return t.posts.select("post_id", ops.cut(F.col("views"), [0, 1000, 3000, 5000], ["low", "mid", "high"]).alias("bin"))


@query("topn_per_group", """
SELECT category, post_id, views, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY views DESC, post_id) AS place FROM posts) WHERE place <= 3""", "posts")
def _(t):
    return ranking.top_n_per_group(t.posts.select("category", "post_id", "views"), ["category"], 3, F.desc("views"), "post_id")


@query("udf_window_avg", """
SELECT event_date, action, round(avg(n) OVER (PARTITION BY action ORDER BY event_date ROWS 2 PRECEDING), 9) AS moving
FROM (SELECT event_date, action, count(*) AS n FROM logs GROUP BY ALL)""", "logs")
def _(t):
    daily = t.logs.groupBy("event_date", "action").agg(row_count().cast("double").alias("n"))
    frame = Window.partitionBy("action").orderBy("event_date").rowsBetween(-2, 0)
    return daily.select("event_date", "action", F.round(mean_udf()("n").over(frame), 9).alias("moving"))


# ---- order, top-k, pages


@query("sort_multi", """
SELECT post_id, category, views, rank() OVER (ORDER BY category, views DESC, post_id) AS place FROM posts""", "posts")
def _(t):
    # the position makes the order itself visible to the comparison, which ignores row order
    df = t.posts.select("post_id", "category", "views").withColumn("down", -F.col("views"))
    placed = ordered.row_index(df, ["category", "down", "post_id"], name="place").drop("down")
    return placed.orderBy("category", F.desc("views"), "post_id")


@query("sort_within", "SELECT category, views, post_id FROM posts", "posts")
def _(t):
    df = t.posts.select("category", "views", "post_id")
    return df.repartition("category", F.pmod("post_id", F.lit(16))).sortWithinPartitions("category", F.desc("views"))


@query("topn_views", "SELECT post_id, title, author, views FROM posts ORDER BY views DESC, post_id LIMIT 10", "posts")
def _(t):
    return ranking.top_n(t.posts.select("post_id", "title", "author", "views"), 10, F.desc("views"), "post_id")


@query("topn_engagement", "SELECT post_id, author, views + likes * 5 + comments * 10 AS engagement FROM posts ORDER BY engagement DESC, post_id LIMIT 10", "posts")
def _(t):
    scored = t.posts.select("post_id", "author", (F.col("views") + F.col("likes") * 5 + F.col("comments") * 10).alias("engagement"))
    return ranking.top_n(scored, 10, F.desc("engagement"), "post_id")


@query("topn_smallest", "SELECT post_id, views FROM posts ORDER BY views, post_id LIMIT 10", "posts")
def _(t):
    return ranking.top_n(t.posts.select("post_id", "views"), 10, "views", "post_id")


@query("page_offset", "SELECT post_id, title, author, publish_date FROM posts ORDER BY publish_date DESC, post_id LIMIT 5 OFFSET 10", "posts")
def _(t):
    return ranking.page(t.posts.select("post_id", "title", "author", "publish_date"), 10, 5, F.desc("publish_date"), "post_id")


@query("page_keyset", "SELECT post_id, title FROM posts WHERE post_id < (SELECT max(post_id) FROM posts) - 100 ORDER BY post_id DESC LIMIT 5", "posts")
def _(t):
    last = t.posts.agg(F.max("post_id")).scalar() - 100
    return t.posts.select("post_id", "title").filter(F.col("post_id") < last).orderBy(F.desc("post_id")).limit(5)


@query("sort_composite", "SELECT post_id, title, likes, views FROM posts ORDER BY likes DESC, views DESC, post_id LIMIT 5", "posts")
def _(t):
    return ranking.top_n(t.posts.select("post_id", "title", "likes", "views"), 5, F.desc("likes"), F.desc("views"), "post_id")


@query("head_tail", """
SELECT 'head' AS part, post_id FROM (SELECT post_id FROM posts ORDER BY post_id LIMIT 3)
UNION ALL SELECT 'slice', post_id FROM (SELECT post_id FROM posts ORDER BY post_id LIMIT 5 OFFSET 5)
UNION ALL SELECT 'tail', post_id FROM (SELECT post_id FROM posts ORDER BY post_id DESC LIMIT 3)""", "posts")
def _(t):
    ids = t.posts.select("post_id")
    parts = {"head": ranking.top_n(ids, 3, "post_id"), "slice": ranking.page(ids, 5, 5, "post_id"), "tail": ranking.top_n(ids, 3, F.desc("post_id"))}
    named = [df.select(F.lit(part).alias("part"), "post_id") for part, df in parts.items()]
    return named[0].union(named[1]).union(named[2])


SCORES = "(SELECT post_id, sum(CASE action WHEN 'view' THEN 1 WHEN 'like' THEN 5 WHEN 'comment' THEN 10 WHEN 'share' THEN 8 ELSE 1 END)::BIGINT AS heat FROM logs GROUP BY post_id)"


@query("leaderboard", f"SELECT post_id, heat, CAST(row_number() OVER (ORDER BY heat DESC, post_id) AS INTEGER) AS place FROM {SCORES} ORDER BY heat DESC, post_id LIMIT 10", "logs")
def _(t):
    return ranking.leaderboard(traffic.heat_scores(t.logs), "post_id", "heat", 10)


@query("leaderboard_rank", f"SELECT post_id, heat, rank() OVER (ORDER BY heat DESC) AS rank FROM {SCORES}", "logs")
def _(t):
    return ranking.leaderboard_ranks(traffic.heat_scores(t.logs), "post_id", "heat")


@query("leaderboard_range", f"""
SELECT count(*) AS members, count(*) FILTER (heat BETWEEN 450 AND 500) AS in_range, count(*) FILTER (heat >= 450) AS at_least FROM {SCORES}""", "logs")
def _(t):
    return ranking.leaderboard_summary(traffic.heat_scores(t.logs), "heat", 450, 500)


@query("latest_n", """
SELECT post_id, string_agg(log_id, ',' ORDER BY place) AS latest FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY event_time DESC, log_id DESC) AS place FROM logs) WHERE place <= 5 GROUP BY post_id""", "logs")
def _(t):
    newest = ranking.latest_n(t.logs.select("post_id", "log_id", "event_time"), "post_id", "log_id", 5, F.desc("event_time"), F.desc("log_id"))
    return newest.withColumn("latest", F.array_join(F.transform("latest", lambda i: i.cast("string")), ","))

"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressbeat.functions import udfs
from pressbeat.functions.aggregates import row_count
from pressbeat.operators import traffic
from pressbeat.operators.frame import small_set
from pressbeat.plans.base import query


@query("fn_string_case", """
SELECT post_id, trim('  ' || title || ' ') AS trimmed, ltrim('  ' || title) AS left_trimmed, rtrim(title || ' ') AS right_trimmed,
 trim(',' || title || ',', ',') AS comma_trimmed, upper(title) AS up, lower(category) AS low,
 upper(title[1]) || substr(string_split(title, ' ')[1], 2) || ' ' || upper(string_split(title, ' ')[2][1]) || substr(string_split(title, ' ')[2], 2) AS capital FROM articles""", "articles")
def _(t):
    space, comma = F.lit("  "), F.lit(",")
    return t.articles.select(
        "post_id", F.trim(F.concat(space, "title", F.lit(" "))).alias("trimmed"), F.ltrim(F.concat(space, "title")).alias("left_trimmed"),
        F.rtrim(F.concat("title", F.lit(" "))).alias("right_trimmed"), F.trim(F.concat(comma, "title", comma), comma).alias("comma_trimmed"),
        F.upper("title").alias("up"), F.lower("category").alias("low"), F.initcap("title").alias("capital"),
    )


@query("fn_string_slice", "SELECT post_id, substr(title, 2, 3) AS middle, right(title, 4) AS ending, left(title, 3) AS beginning FROM articles", "articles")
def _(t):
    return t.articles.select(
        "post_id", F.substring("title", 2, 3).alias("middle"), F.right(F.col("title"), F.lit(4)).alias("ending"), F.left(F.col("title"), F.lit(3)).alias("beginning")
    )


@query("fn_string_shape", """
SELECT post_id, CAST(length(title) AS INTEGER) AS len, reverse(title) AS reversed, repeat(category, 2) AS twice, lpad(post_id::VARCHAR, 8, '0') AS padded, rpad(category, 12, '.') AS dotted FROM articles""", "articles")
def _(t):
    return t.articles.select(
        "post_id", F.length("title").alias("len"), F.reverse("title").alias("reversed"), F.repeat("category", 2).alias("twice"),
        F.lpad(F.col("post_id").cast("string"), 8, "0").alias("padded"), F.rpad("category", 12, ".").alias("dotted"),
    )


@query("fn_string_concat", """
SELECT status, (SELECT string_agg(DISTINCT category, ',' ORDER BY category) FROM posts) AS categories, count(DISTINCT author || ': ' || title) AS names,
 max(concat_ws('-', category, status, likes)) AS last_joined FROM posts GROUP BY status""", "posts")
def _(t):
    # the values of a column in one string: distinct ones, of which there may only be a stated number
    joined = F.array_join(F.sort_array(small_set(t.posts, F.col("category"), 1000)), ",")
    names = t.posts.groupBy("status").agg(
        F.count_distinct(F.concat("author", F.lit(": "), "title")).alias("names"), F.max(F.concat_ws("-", "category", "status", "likes")).alias("last_joined")
    )
    return names.withColumn("categories", joined)


@query("fn_string_split", "SELECT post_id, len(string_split(title, ' '))::INTEGER AS parts, string_split(title, ' ')[2] AS second, replace(title, 'ring', 'band') AS replaced FROM articles", "articles")
def _(t):
    return t.articles.select("post_id", F.size(F.split("title", " ")).alias("parts"), F.get(F.split("title", " "), F.lit(1)).alias("second"), F.replace(F.col("title"), F.lit("ring"), F.lit("band")).alias("replaced"))


@query("fn_regex", """
SELECT post_id, nullif(regexp_extract(author, '#([0-9]+)', 1), '') AS brand_no, regexp_replace(title, '[aeiou]', '*', 'g') AS masked, nullif(regexp_extract(title, '^(blue|red)', 1), '') AS colour FROM articles""", "articles")
def _(t):
    empty = F.lit("")
    return t.articles.select(
        "post_id", F.nullif(F.regexp_extract("author", "#([0-9]+)", 1), empty).alias("brand_no"), F.regexp_replace("title", "[aeiou]", "*").alias("masked"),
        F.nullif(F.regexp_extract("title", "^(blue|red)", 1), empty).alias("colour"),
    )


@query("fn_date_parts", """
SELECT post_id, year(publish_date)::INT AS y, month(publish_date)::INT AS m, day(publish_date)::INT AS d, quarter(publish_date)::INT AS q, isodow(publish_date)::INT AS dow,
 left(dayname(publish_date), 3) AS dname, publish_date = last_day(publish_date) AS month_end, dayofyear(publish_date)::INT AS doy FROM posts""", "posts")
def _(t):
    c = "publish_date"
    return t.posts.select(
        "post_id", F.year(c).alias("y"), F.month(c).alias("m"), F.dayofmonth(c).alias("d"), F.quarter(c).alias("q"), (F.weekday(c) + 1).alias("dow"),
        F.dayname(c).alias("dname"), (F.col(c) == F.last_day(c)).alias("month_end"), F.dayofyear(c).alias("doy"),
    )


@query("fn_date_format", """
SELECT post_id, strftime(publish_date, '%Y/%m/%d') AS slashed, strftime(publish_date, '%Y-%m') AS month, publish_date AS parsed, CAST(NULL AS DATE) AS unparsed FROM posts""", "posts")
def _(t):
    slashed = F.date_format("publish_date", "yyyy/MM/dd")
    return t.posts.select(
        "post_id", slashed.alias("slashed"), F.date_format("publish_date", "yyyy-MM").alias("month"), F.try_to_date(slashed, "yyyy/MM/dd").alias("parsed"),
        F.try_to_date(slashed, "yyyy-MM-dd").alias("unparsed"),
    )


@query("fn_date_arith", """
SELECT post_id, date_diff('day', publish_date, (SELECT max(publish_date) FROM posts))::INT AS age_days, (publish_date + INTERVAL 30 DAYS)::DATE AS due,
 (publish_date - INTERVAL 2 MONTHS)::DATE AS earlier, publish_date::TIMESTAMP + INTERVAL 90 MINUTES AS later FROM posts""", "posts")
def _(t):
    newest = t.posts.agg(F.max("publish_date")).scalar()
    return t.posts.select(
        "post_id", F.datediff(newest, "publish_date").alias("age_days"), F.date_add("publish_date", 30).alias("due"),
        F.add_months("publish_date", -2).alias("earlier"), (F.col("publish_date").cast("timestamp_ntz") + F.expr("interval 90 minutes")).alias("later"),
    )


@query("fn_date_range", """
SELECT day::DATE AS day, coalesce(n, 0) AS n, (day = date_trunc('month', day)) AS month_start FROM
 (SELECT unnest(generate_series((SELECT min(publish_date) FROM posts)::TIMESTAMP, (SELECT max(publish_date) FROM posts)::TIMESTAMP, INTERVAL 1 DAY)) AS day) d
 LEFT JOIN (SELECT publish_date, count(*) AS n FROM posts WHERE status = 'draft' GROUP BY 1) p ON p.publish_date = d.day""", "posts")
def _(t):
    days = t.posts.agg(F.min("publish_date").alias("lo"), F.max("publish_date").alias("hi")).select(F.explode(F.sequence("lo", "hi")).alias("day"))
    drafts = t.posts.filter("status = 'draft'").groupBy(F.col("publish_date").alias("day")).agg(row_count().alias("n"))
    return days.join(drafts, "day", "left").select("day", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), (F.col("day") == F.trunc("day", "MM")).alias("month_start"))


@query("fn_hour_range", """
SELECT slot, coalesce(n, 0) AS n FROM
 (SELECT unnest(generate_series(date_trunc('day', (SELECT min(event_time) FROM logs)), (SELECT max(event_time) FROM logs), INTERVAL 2 HOURS)) AS slot) s
 LEFT JOIN (SELECT time_bucket(INTERVAL 2 HOURS, event_time) AS b, count(*) AS n FROM logs GROUP BY 1) l ON l.b = s.slot""", "logs")
def _(t):
    ends = t.logs.agg(F.date_trunc("day", F.min("event_time")).alias("lo"), F.max("event_time").alias("hi"))
    slots = ends.select(F.explode(F.expr("sequence(lo, hi, interval 2 hours)")).alias("slot"))
    counts = t.logs.groupBy(F.window("event_time", "2 hours").alias("w")).agg(row_count().alias("n")).select(F.col("w.start").alias("slot"), "n")
    return slots.join(counts, "slot", "left").select(F.col("slot").cast("timestamp_ntz").alias("slot"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


@query("fn_math", """
SELECT post_id, round(views / 7.0::DOUBLE, 6) AS rounded, (views // 7) AS whole, views % 7 AS rest, greatest(views, likes, comments) AS most, least(views, likes, comments) AS fewest,
 abs(likes - comments) AS gap FROM posts""", "posts")
def _(t):
    return t.posts.select(
        "post_id", F.round(F.col("views") / 7, 6).alias("rounded"), F.floor(F.col("views") / 7).alias("whole"), (F.col("views") % 7).alias("rest"),
        F.greatest("views", "likes", "comments").alias("most"), F.least("views", "likes", "comments").alias("fewest"), F.abs(F.col("likes") - F.col("comments")).alias("gap"),
    )


@query("fn_array", """
SELECT post_id, len(a)::INT AS n, a[1] AS first_tag, a[9] AS ninth, array_to_string(list_sort(list_distinct(a)), ',') AS kinds, array_to_string(a, '|') AS joined, list_contains(a, 'ring') AS is_ring
FROM (SELECT post_id, list_concat(string_split(title, ' '), [lower(category), string_split(title, ' ')[1]]) AS a FROM articles)""", "articles")
def _(t):
    words = F.split("title", " ")
    tags = F.flatten(F.array(words, F.array(F.lower("category"), F.get(words, F.lit(0)))))
    return t.articles.select("post_id", tags.alias("a")).select(
        "post_id", F.size("a").alias("n"), F.get("a", F.lit(0)).alias("first_tag"), F.get("a", F.lit(8)).alias("ninth"),
        F.array_join(F.array_sort(F.array_distinct("a")), ",").alias("kinds"), F.array_join("a", "|").alias("joined"), F.array_contains("a", "ring").alias("is_ring"),
    )


@query("fn_map", "SELECT post_id, views AS from_map, CAST(NULL AS BIGINT) AS absent, 3::INT AS n FROM posts", "posts")
def _(t):
    counters = F.create_map(*[x for c in ("views", "likes", "comments") for x in (F.lit(c), F.col(c))])
    return t.posts.select("post_id", counters.alias("m")).select(
        "post_id", F.element_at("m", "views").alias("from_map"), F.try_element_at("m", F.lit("shares")).alias("absent"), F.size("m").alias("n")
    )


@query("fn_json", """
SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k, 'unknown' AS missing, '{"id":' || event_id || ',"type":"' || event_type || '"}' AS doc FROM events""")
def _(t):
    parsed = F.from_json("props", "struct<k: int, kind: string>")
    return t.raw("events").withColumn("p", parsed).select(
        "event_id", F.col("p.k").alias("k"), F.coalesce("p.kind", F.lit("unknown")).alias("missing"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("doc"),
    )


# ---- user-defined functions


@query("udf_scalar", """
SELECT CASE WHEN views >= 3000 THEN 'hot' WHEN views >= 1500 THEN 'normal' ELSE 'cold' END AS level,
 CASE WHEN views >= 3000 THEN 'hot' WHEN views >= 1500 THEN 'normal' ELSE 'cold' END AS sql_level, count(*) AS n FROM posts GROUP BY ALL""", "posts")
def _(t):
    udfs.register_level(t.spark)
    leveled = t.posts.select(udfs.level_udf()("views").alias("level"), F.call_function("popularity_level", F.col("views")).alias("sql_level"))
    return leveled.groupBy("level", "sql_level").agg(row_count().alias("n"))


TAGS = "list_filter(list_transform(string_split(lower(tags), ','), lambda x: trim(x)), lambda x: x <> '')"


@query("udf_array", f"SELECT post_id, array_to_string({TAGS}, ',') AS tags, array_to_string({TAGS}, ',') AS builtin_tags FROM articles", "articles")
def _(t):
    builtin = F.filter(F.transform(F.split(F.lower("tags"), ","), lambda tag: F.trim(tag)), lambda tag: tag != "")
    return t.articles.select("post_id", F.array_join(udfs.tags_udf()("tags"), ",").alias("tags"), F.array_join(builtin, ",").alias("builtin_tags"))


@query("udf_pandas_scalar", "SELECT post_id, views + likes * 5 AS score FROM posts", "posts")
def _(t):
    return t.posts.select("post_id", udfs.engagement_udf()("views", "likes").alias("score"))


@query("udf_grouped_map", """
SELECT event_date, action, round(n - avg(n) OVER (PARTITION BY action), 9) AS centred FROM (SELECT event_date, action, count(*) AS n FROM logs GROUP BY ALL)""", "logs")
def _(t):
    daily = t.logs.groupBy("event_date", "action").agg(row_count().alias("n"))
    return udfs.centre_groups(daily, "action", "n").select("event_date", "action", F.round("centred", 9).alias("centred"))


@query("udf_map_rows", "SELECT post_id, trim(unnest(string_split(tags, ','))) AS tag FROM articles", "articles")
def _(t):
    return udfs.map_rows(t.articles)


@query("udf_rowwise", """
SELECT post_id, CASE WHEN views > 2000 AND likes > 100 THEN 'star' WHEN views > 2000 THEN 'read' ELSE 'quiet' END AS label FROM posts""", "posts")
def _(t):
    busy = F.col("views") > 2000
    return t.posts.select("post_id", F.when(busy & (F.col("likes") > 100), "star").when(busy, "read").otherwise("quiet").alias("label"))


@query("udf_broadcast", """
SELECT CASE action WHEN 'view' THEN 'read' WHEN 'like' THEN 'react' WHEN 'comment' THEN 'react' END AS kind, count(*) AS n FROM logs GROUP BY 1""", "logs")
def _(t):
    lookup = udfs.lookup_udf(t.spark, {"view": "read", "like": "react", "comment": "react"})
    return t.logs.select(lookup("action").alias("kind")).groupBy("kind").agg(row_count().alias("n"))


@query("engagement_by_level", """
SELECT CASE WHEN views >= 3000 THEN 'hot' WHEN views >= 1500 THEN 'normal' ELSE 'cold' END AS level, CAST(sum(likes) AS BIGINT) AS likes FROM posts GROUP BY 1""", "posts")
def _(t):
    level = traffic.tier(F.col("views"), [(3000, "hot"), (1500, "normal")], "cold")
    return t.posts.groupBy(level.alias("level")).agg(F.sum("likes").alias("likes"))

"""Traffic reports: page views, visitors, hot posts, funnels, trends, tags, authors."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressbeat.operators import traffic as ops
from pressbeat.plans.base import query


@query("daily_pv_by_action", """
SELECT event_date, action, count(*) AS pv FROM logs WHERE action IN ('view','comment','like') GROUP BY ALL""", "logs")
def _(t):
    return ops.daily_pv_by_action(t.logs)


@query("daily_uv", """
SELECT event_date, count(DISTINCT user_id) AS uv,
       count(DISTINCT CASE WHEN user_id IS NULL THEN ip END) AS anonymous
FROM logs WHERE action = 'view' GROUP BY event_date""", "logs")
def _(t):
    return ops.daily_uv(t.logs)


@query("daily_pv_uv", """
SELECT event_date, count(*) AS pv, count(DISTINCT user_id) AS uv, count(DISTINCT ip) AS ips,
       round(count(*)::DOUBLE / nullif(count(DISTINCT user_id), 0), 9) AS views_per_user
FROM logs WHERE action = 'view' GROUP BY event_date""", "logs")
def _(t):
    return ops.daily_pv_uv(t.logs)


@query("daily_trend", """
SELECT event_date, count(*) AS pv, count(DISTINCT user_id) AS uv,
       count(*) FILTER (action = 'comment') AS comments, count(*) FILTER (action = 'like') AS likes,
       count(*) FILTER (action = 'share') AS shares
FROM logs GROUP BY event_date""", "logs")
def _(t):
    return ops.daily_trend(t.logs)


@query("filt_last7d", """
SELECT count(*) AS total_pv, count(DISTINCT user_id) AS total_uv, count(DISTINCT event_date) AS active_days
FROM logs WHERE event_time >= (SELECT max(event_time) FROM logs) - INTERVAL 7 DAYS""", "logs")
def _(t):
    return ops.period_totals(ops.last_days(t.logs, 7))


@query("hot_posts_last7d", """
SELECT post_id, count(*) FILTER (action = 'view') AS views, count(*) FILTER (action = 'comment') AS comments,
       count(*) FILTER (action = 'like') AS likes
FROM logs WHERE event_time >= (SELECT max(event_time) FROM logs) - INTERVAL 7 DAYS
GROUP BY post_id ORDER BY views DESC, post_id LIMIT 5""", "logs")
def _(t):
    counts = ops.post_actions(ops.last_days(t.logs, 7)).select("post_id", "views", "comments", "likes")
    return counts.orderBy(F.desc("views"), "post_id").limit(5)


@query("dau", """
SELECT event_date, count(DISTINCT user_id) AS dau, count(*) AS actions, count(DISTINCT post_id) AS posts,
       round(avg(duration), 9) AS avg_duration
FROM logs WHERE action = 'view' GROUP BY event_date""", "logs")
def _(t):
    return ops.dau(t.logs)


@query("user_activity", """
SELECT user_id, count(*) AS operations, count(DISTINCT post_id) AS posts,
       count(DISTINCT CASE WHEN action = 'view' THEN post_id END) AS viewed_posts,
       count(DISTINCT CASE WHEN action = 'like' THEN post_id END) AS liked_posts,
       count(DISTINCT CASE WHEN action = 'comment' THEN post_id END) AS commented_posts,
       round(avg(duration), 9) AS avg_duration, count(DISTINCT event_date) AS active_days
FROM logs GROUP BY user_id""", "logs")
def _(t):
    return ops.user_activity(t.logs)


@query("hot_posts", """
SELECT l.post_id, count(*) AS log_views, count(DISTINCT user_id) AS visitors, round(avg(duration), 9) AS avg_duration,
       title, author, category
FROM logs l JOIN articles a ON l.post_id = a.post_id WHERE action = 'view'
GROUP BY ALL ORDER BY log_views DESC, l.post_id LIMIT 10""", "logs", "articles")
def _(t):
    return ops.hot_posts(t.logs, t.articles.withColumn("post_id", F.col("post_id").cast("int")))


@query("hot_posts_daily", """
SELECT event_date, title, author, count(*) AS day_views
FROM logs l JOIN articles a ON l.post_id = a.post_id WHERE action = 'view' GROUP BY ALL""", "logs", "articles")
def _(t):
    return ops.hot_posts_daily(t.logs, t.articles)


@query("interaction_rate", """
SELECT CAST(l.post_id AS INTEGER) AS post_id, count(*) FILTER (action = 'like') AS likes, count(*) FILTER (action = 'comment') AS comments,
       count(*) FILTER (action = 'view') AS views,
       round(count(*) FILTER (action IN ('like','comment')) * 100.0::DOUBLE / count(*) FILTER (action = 'view'), 9) AS rate,
       title, category
FROM logs l JOIN articles a ON l.post_id = a.post_id
GROUP BY l.post_id, title, category HAVING views > 0 ORDER BY rate DESC, l.post_id LIMIT 10""", "logs", "articles")
def _(t):
    return ops.interaction_rate(t.logs, t.articles)


@query("action_share", """
SELECT action, count(*) AS cnt, round(count(*) * 100::DOUBLE / sum(count(*)) OVER (), 9) AS pct FROM logs GROUP BY action""", "logs")
def _(t):
    return ops.share_of_total(t.logs, ["action"])


@query("user_action_share", """
SELECT user_id, action, count(*) AS cnt,
       round(count(*) * 100::DOUBLE / sum(count(*)) OVER (PARTITION BY user_id), 9) AS pct
FROM logs GROUP BY user_id, action""", "logs")
def _(t):
    return ops.share_of_total(t.logs, ["user_id", "action"], ["user_id"])


@query("share_subquery", """
SELECT device, count(*) AS cnt, round(count(*) * 100::DOUBLE / (SELECT count(*) FROM logs), 9) AS pct
FROM logs GROUP BY device""", "logs")
def _(t):
    return ops.share_by_subquery(t.logs, "device")


@query("funnel", """
SELECT *, round(like_users * 100::DOUBLE / view_users, 9) AS like_rate,
       round(comment_users * 100::DOUBLE / view_users, 9) AS comment_rate,
       round(share_users * 100::DOUBLE / view_users, 9) AS share_rate
FROM (SELECT count(DISTINCT CASE WHEN action = 'view' THEN user_id END) AS view_users,
             count(DISTINCT CASE WHEN action = 'like' THEN user_id END) AS like_users,
             count(DISTINCT CASE WHEN action = 'comment' THEN user_id END) AS comment_users,
             count(DISTINCT CASE WHEN action = 'share' THEN user_id END) AS share_users,
             count(DISTINCT user_id) AS users FROM logs)""", "logs")
def _(t):
    return ops.funnel(t.logs)


@query("new_user_activity", """
SELECT u.user_id, username, register_date,
       CAST(date_diff('day', register_date, min(event_date)) AS INTEGER) AS days_to_first,
       CAST(date_diff('day', register_date, max(event_date)) AS INTEGER) AS days_to_last,
       count(log_id) AS operations,
       CASE WHEN count(log_id) >= 10 THEN 'high' WHEN count(log_id) >= 5 THEN 'medium'
            WHEN count(log_id) >= 1 THEN 'low' ELSE 'silent' END AS level
FROM users u LEFT JOIN logs l ON u.user_id = l.user_id GROUP BY u.user_id, username, register_date""", "logs", "users")
def _(t):
    return ops.new_user_activity(t.users, t.logs)


@query("category_stats", """
SELECT category, count(*) AS posts, round(avg(views), 9) AS avg_views, round(avg(likes), 9) AS avg_likes,
       CAST(sum(views) AS BIGINT) AS sum_views, CAST(sum(likes) AS BIGINT) AS sum_likes, max(views) AS max_views
FROM posts GROUP BY category""", "posts")
def _(t):
    return ops.category_stats(t.posts)


@query("category_interactions", """
SELECT category, count(DISTINCT a.post_id) AS posts, count(*) FILTER (action = 'view') AS views,
       count(*) FILTER (action = 'like') AS likes, count(*) FILTER (action = 'comment') AS comments
FROM articles a LEFT JOIN logs l ON a.post_id = l.post_id GROUP BY category""", "logs", "articles")
def _(t):
    return ops.category_interactions(t.articles, t.logs)


@query("author_stats", """
SELECT author, count(*) AS posts, CAST(sum(views) AS BIGINT) AS sum_views, round(avg(views), 9) AS avg_views,
       max(views) AS max_views, CAST(sum(likes) AS BIGINT) AS sum_likes, count(DISTINCT category) AS categories,
       CASE WHEN sum(views) >= 8000 THEN 'head' WHEN sum(views) >= 3000 THEN 'middle' ELSE 'new' END AS level
FROM posts GROUP BY author""", "posts")
def _(t):
    return ops.author_stats(t.posts)


@query("tier_author", """
SELECT level, count(*) AS authors, CAST(sum(total) AS BIGINT) AS sum_views
FROM (SELECT author, sum(views) AS total,
             CASE WHEN sum(views) >= 8000 THEN 'head' WHEN sum(views) >= 3000 THEN 'middle' ELSE 'new' END AS level
      FROM posts GROUP BY author) GROUP BY level""", "posts")
def _(t):
    totals = t.posts.groupBy("author").agg(F.sum("views").alias("total"))
    levels = totals.withColumn("level", ops.tier(F.col("total"), [(8000, "head"), (3000, "middle")], "new"))
    return levels.groupBy("level").agg(F.count(F.lit(1)).alias("authors"), F.sum("total").alias("sum_views"))


@query("tier_popularity", """
SELECT CASE WHEN views >= 3000 THEN 'hot' WHEN views >= 1500 THEN 'normal' ELSE 'cold' END AS popularity,
       CASE WHEN views >= 3000 THEN 'hot' WHEN views >= 1000 THEN 'normal' ELSE 'cold' END AS popularity_wide,
       count(*) AS posts FROM posts GROUP BY ALL""", "posts")
def _(t):
    views = F.col("views")
    return t.posts.groupBy(
        ops.tier(views, [(3000, "hot"), (1500, "normal")], "cold").alias("popularity"),
        ops.tier(views, [(3000, "hot"), (1000, "normal")], "cold").alias("popularity_wide"),
    ).agg(F.count(F.lit(1)).alias("posts"))


TAGGED = "(SELECT *, trim(unnest(string_split(lower(tags), ','))) AS tag FROM articles)"


@query("tag_stats", f"""
SELECT tag, count(*) AS uses, CAST(sum(views) AS BIGINT) AS sum_views, round(avg(views), 9) AS avg_views
FROM {TAGGED} WHERE tag <> '' GROUP BY tag""", "articles")
def _(t):
    return ops.tag_stats(t.articles)


@query("tag_titles", f"SELECT DISTINCT tag, title FROM {TAGGED} WHERE tag <> ''", "articles")
def _(t):
    return ops.tag_titles(t.articles)


@query("tag_diversity", f"""
SELECT author, count(DISTINCT tag) AS distinct_tags, count(*) AS tag_uses FROM {TAGGED} WHERE tag <> '' GROUP BY author""", "articles")
def _(t):
    return ops.tag_diversity(t.articles)


@query("user_interest_tags", f"""
SELECT username, tag, count(*) AS views
FROM logs l JOIN {TAGGED} p ON l.post_id = p.post_id JOIN users u ON l.user_id = u.user_id
WHERE action = 'view' AND tag <> '' GROUP BY username, tag""", "logs", "articles", "users")
def _(t):
    return ops.user_interest_tags(t.logs, t.articles, t.users)


@query("monthly_trend", """
SELECT strftime(publish_date, '%Y-%m') AS month, count(*) AS posts, CAST(sum(views) AS BIGINT) AS sum_views,
       round(avg(views), 9) AS avg_views, CAST(sum(likes) AS BIGINT) AS sum_likes
FROM posts GROUP BY 1""", "posts")
def _(t):
    return ops.monthly_trend(t.posts)


@query("monthly_growth", """
SELECT month, posts, sum_views,
       round((sum_views - lag(sum_views) OVER w) * 100::DOUBLE / nullif(lag(sum_views) OVER w, 0), 9) AS sum_views_growth,
       round((posts - lag(posts) OVER w) * 100::DOUBLE / nullif(lag(posts) OVER w, 0), 9) AS posts_growth
FROM (SELECT strftime(publish_date, '%Y-%m') AS month, count(*) AS posts, CAST(sum(views) AS BIGINT) AS sum_views
      FROM posts GROUP BY 1) WINDOW w AS (ORDER BY month)""", "posts")
def _(t):
    months = ops.monthly_trend(t.posts).select("month", "posts", "sum_views")
    return ops.growth(months, "month", ["sum_views", "posts"])


@query("daily_growth_zero", """
SELECT event_date, pv, lag(pv, 1, 0) OVER (ORDER BY event_date) AS prev_pv,
       CASE WHEN lag(pv, 1, 0) OVER (ORDER BY event_date) > 0
            THEN round((pv - lag(pv, 1, 0) OVER (ORDER BY event_date)) * 100::DOUBLE / lag(pv, 1, 0) OVER (ORDER BY event_date), 9)
            ELSE 0::DOUBLE END AS growth
FROM (SELECT event_date, count(*) AS pv FROM logs GROUP BY event_date)""", "logs")
def _(t):
    return ops.daily_growth_zero(t.logs)


@query("monthly_new_users", """
SELECT CAST(month(register_date) AS INTEGER) AS month, count(*) AS new_users, count(DISTINCT city) AS cities FROM users GROUP BY 1""", "users")
def _(t):
    return ops.monthly_new_users(t.users)


@query("hourly", """
SELECT CAST(hour(event_time) AS INTEGER) AS hour, count(*) AS pv, count(DISTINCT user_id) AS uv FROM logs GROUP BY 1""", "logs")
def _(t):
    return ops.hourly(t.logs)


@query("weekday", """
SELECT CAST(isodow(event_date) AS INTEGER) AS weekday, count(*) AS pv, count(DISTINCT user_id) AS uv FROM logs GROUP BY 1""", "logs")
def _(t):
    return ops.weekday(t.logs)


@query("hour_by_action", """
SELECT CAST(hour(event_time) AS INTEGER) AS hour, action, count(*) AS pv FROM logs GROUP BY ALL""", "logs")
def _(t):
    return ops.hour_by(t.logs, "action")


@query("hour_by_device", """
SELECT CAST(hour(event_time) AS INTEGER) AS hour, device, count(*) AS pv FROM logs GROUP BY ALL""", "logs")
def _(t):
    return ops.hour_by(t.logs, "device")


@query("dim_city", """
SELECT city, count(*) AS pv, count(DISTINCT l.user_id) AS uv,
       round(count(*) * 100::DOUBLE / sum(count(*)) OVER (), 9) AS pv_pct
FROM logs l JOIN users u ON l.user_id = u.user_id GROUP BY city""", "logs", "users")
def _(t):
    return ops.city_traffic(t.logs, t.users)


@query("device_actions", """
SELECT device, count(*) FILTER (action = 'view') AS views, count(*) FILTER (action = 'comment') AS comments,
       count(*) FILTER (action = 'like') AS likes, count(*) FILTER (action = 'share') AS shares
FROM logs GROUP BY device""", "logs")
def _(t):
    return ops.dimension_actions(t.logs, "device")


@query("active_users", """
SELECT user_id, count(*) AS total_actions, count(*) FILTER (action = 'view') AS views,
       count(*) FILTER (action = 'comment') AS comments, count(*) FILTER (action = 'like') AS likes,
       min(event_date) AS first_visit, max(event_date) AS last_visit
FROM logs WHERE user_id IS NOT NULL GROUP BY user_id ORDER BY total_actions DESC, user_id LIMIT 10""", "logs")
def _(t):
    return ops.active_users(t.logs)


@query("action_stats", """
SELECT action, count(*) AS cnt, count(DISTINCT user_id) AS users, count(DISTINCT post_id) AS posts FROM logs GROUP BY action""", "logs")
def _(t):
    return ops.action_stats(t.logs)


OVERVIEW = """
SELECT event_date, count(*) FILTER (action = 'view') AS views, count(*) FILTER (action = 'like') AS likes,
       count(*) FILTER (action = 'comment') AS comments, count(*) FILTER (action = 'search') AS searches,
       count(DISTINCT user_id) AS users, count(DISTINCT post_id) AS posts, count(DISTINCT ip) AS ips
FROM logs GROUP BY event_date"""


@query("daily_overview", OVERVIEW, "logs")
def _(t):
    return ops.daily_overview(t.logs)


@query("heat_score", """
SELECT post_id, CAST(sum(CASE action WHEN 'view' THEN 1 WHEN 'like' THEN 5 WHEN 'comment' THEN 10 WHEN 'share' THEN 8 ELSE 1 END) AS BIGINT) AS heat
FROM logs GROUP BY post_id""", "logs")
def _(t):
    return ops.heat_scores(t.logs)


@query("unique_likers", """
SELECT post_id, count(DISTINCT user_id) AS likers FROM logs WHERE action = 'like' AND user_id IS NOT NULL GROUP BY post_id""", "logs")
def _(t):
    likes = t.logs.filter((F.col("action") == "like") & F.col("user_id").isNotNull())
    return likes.select("post_id", "user_id").distinct().groupBy("post_id").agg(F.count(F.lit(1)).alias("likers"))

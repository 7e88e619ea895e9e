"""Blog-traffic reports over the access log, posts and users.

Logs are reduced by their keys before they meet another table, so a post or user that holds a large
part of the log costs one partial row per map task, not a skewed join. A log row is unique by
``log_id``, hence counting rows replaces counting distinct log ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INTERACTIONS = ("like", "comment")
# Heat per action.
HEAT_WEIGHTS = {"view": 1, "like": 5, "comment": 10, "share": 8}


def percent(part: Column, whole: Column) -> Column:
    """part/whole in percent; NULL when the whole is zero or NULL."""
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def action_count(action: str) -> Column:
    return F.count_if(F.col("action") == action)


def tier(value: Column, cuts: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first (highest) cut the value reaches."""
    result = None
    for floor, label in cuts:
        result = F.when(value >= floor, label) if result is None else result.when(value >= floor, label)
    return F.lit(otherwise) if result is None else result.otherwise(otherwise)


def daily_pv_by_action(logs: DataFrame, actions=("view", "comment", "like")) -> DataFrame:
    return logs.filter(F.col("action").isin(*actions)).groupBy("event_date", "action").agg(F.count(F.lit(1)).alias("pv"))


def daily_uv(logs: DataFrame) -> DataFrame:
    """Signed-in visitors and, apart from them, anonymous addresses."""
    return (
        logs.filter(F.col("action") == "view")
        .groupBy("event_date")
        .agg(
            F.count_distinct("user_id").alias("uv"),
            F.count_distinct(F.when(F.col("user_id").isNull(), F.col("ip"))).alias("anonymous"),
        )
    )


def daily_pv_uv(logs: DataFrame) -> DataFrame:
    report = (
        logs.filter(F.col("action") == "view")
        .groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("pv"),
            F.count_distinct("user_id").alias("uv"),
            F.count_distinct("ip").alias("ips"),
        )
    )
    return report.withColumn("views_per_user", F.round(F.try_divide(F.col("pv").cast("double"), F.col("uv").cast("double")), 9))


def daily_trend(logs: DataFrame) -> DataFrame:
    return logs.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("pv"),
        F.count_distinct("user_id").alias("uv"),
        action_count("comment").alias("comments"),
        action_count("like").alias("likes"),
        action_count("share").alias("shares"),
    )


def last_days(logs: DataFrame, days: int, as_of: Column | None = None) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of`` (by default the newest event)."""
    end = as_of if as_of is not None else logs.agg(F.max("event_time").alias("end")).scalar()
    return logs.filter(F.col("event_time") >= end - F.make_dt_interval(days=F.lit(days)))


def period_totals(logs: DataFrame) -> DataFrame:
    return logs.agg(
        F.count(F.lit(1)).alias("total_pv"),
        F.count_distinct("user_id").alias("total_uv"),
        F.count_distinct("event_date").alias("active_days"),
    )


def dau(logs: DataFrame) -> DataFrame:
    return (
        logs.filter(F.col("action") == "view")
        .groupBy("event_date")
        .agg(
            F.count_distinct("user_id").alias("dau"),
            F.count(F.lit(1)).alias("actions"),
            F.count_distinct("post_id").alias("posts"),
            F.round(F.avg("duration"), 9).alias("avg_duration"),
        )
    )


def user_activity(logs: DataFrame) -> DataFrame:
    """Operations, distinct posts, active days and posts per interaction of each user."""

    def posts_with(action):
        return F.count_if(F.col(f"n_{action}") > 0)

    # grain (user, post) carries every per-post figure, grain (user, day) the active days
    by_post = logs.groupBy("user_id", "post_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("duration").alias("duration"),
        *[action_count(a).alias(f"n_{a}") for a in ("view", "like", "comment")],
    )
    per_user = by_post.groupBy("user_id").agg(
        F.sum("n").alias("operations"),
        F.count("post_id").alias("posts"),
        posts_with("view").alias("viewed_posts"),
        posts_with("like").alias("liked_posts"),
        posts_with("comment").alias("commented_posts"),
        F.round(F.sum("duration") / F.sum("n"), 9).alias("avg_duration"),
    )
    days = logs.groupBy("user_id").agg(F.count_distinct("event_date").alias("active_days")).withColumnRenamed("user_id", "day_user")
    return per_user.join(days, F.col("user_id").eqNullSafe(F.col("day_user"))).drop("day_user")


def hot_posts(logs: DataFrame, posts: DataFrame, n: int = 10) -> DataFrame:
    """Most viewed posts with visitors and mean duration."""
    views = (
        logs.filter(F.col("action") == "view")
        .groupBy("post_id")
        .agg(
            F.count(F.lit(1)).alias("log_views"),
            F.count_distinct("user_id").alias("visitors"),
            F.round(F.avg("duration"), 9).alias("avg_duration"),
        )
    )
    return views.join(posts.select("post_id", "title", "author", "category"), "post_id").orderBy(F.desc("log_views"), "post_id").limit(n)


def post_actions(logs: DataFrame) -> DataFrame:
    return logs.groupBy("post_id").agg(
        action_count("view").alias("views"),
        action_count("comment").alias("comments"),
        action_count("like").alias("likes"),
        action_count("share").alias("shares"),
        F.count(F.lit(1)).alias("total_actions"),
    )


def hot_posts_daily(logs: DataFrame, posts: DataFrame) -> DataFrame:
    daily = logs.filter(F.col("action") == "view").groupBy("event_date", "post_id").agg(F.count(F.lit(1)).alias("day_views"))
    named = daily.join(posts.select("post_id", "title", "author"), "post_id")
    return named.groupBy("event_date", "title", "author").agg(F.sum("day_views").alias("day_views"))


def interaction_rate(logs: DataFrame, posts: DataFrame, n: int = 10) -> DataFrame:
    """Likes and comments per view, for posts that were viewed."""
    counts = post_actions(logs).select("post_id", "likes", "comments", "views").filter("views > 0")
    rated = counts.withColumn("rate", F.round(percent(F.col("likes") + F.col("comments"), F.col("views")), 9))
    return rated.join(posts.select("post_id", "title", "category"), "post_id").orderBy(F.desc("rate"), "post_id").limit(n)


def share_of_total(df: DataFrame, keys: list[str], within: list[str] | None = None) -> DataFrame:
    """Row count per key and its percentage of the total (or of the total within ``within``)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    # the grand total is a scalar over the counts, so no window gathers all of them
    total = F.sum("cnt").over(Window.partitionBy(*within)) if within else counts.agg(F.sum("cnt")).scalar()
    return counts.withColumn("pct", F.round(percent(F.col("cnt"), total), 9))


def share_by_subquery(df: DataFrame, key: str) -> DataFrame:
    """Like :func:`share_of_total`, with the total as an uncorrelated scalar subquery."""
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.withColumn("pct", F.round(percent(F.col("cnt"), total), 9))


def funnel(logs: DataFrame, steps=("view", "like", "comment", "share")) -> DataFrame:
    """Users who reached each step and their rate against the first step, in one pass.

    One flag per user and step replaces a distinct count per step.
    """
    per_user = logs.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        *[F.max(F.col("action") == step).alias(step) for step in steps]
    )
    totals = per_user.agg(*[F.count_if(F.col(step)).alias(f"{step}_users") for step in steps], F.count(F.lit(1)).alias("users"))
    first = F.col(f"{steps[0]}_users")
    return totals.withColumns({f"{step}_rate": F.round(percent(F.col(f"{step}_users"), first), 9) for step in steps[1:]})


def new_user_activity(users: DataFrame, logs: DataFrame) -> DataFrame:
    """Days from registration to the first and last action, operation count and level, silent users included."""
    seen = logs.groupBy("user_id").agg(
        F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"), F.count(F.lit(1)).alias("n")
    )
    joined = users.select("user_id", "username", "register_date").join(seen, "user_id", "left")
    operations = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    return joined.select(
        "user_id", "username", "register_date",
        F.datediff("first_date", "register_date").alias("days_to_first"),
        F.datediff("last_date", "register_date").alias("days_to_last"),
        operations.alias("operations"),
        tier(operations, [(10, "high"), (5, "medium"), (1, "low")], "silent").alias("level"),
    )


def category_stats(posts: DataFrame) -> DataFrame:
    return posts.groupBy("category").agg(
        F.count(F.lit(1)).alias("posts"),
        F.round(F.avg("views"), 9).alias("avg_views"),
        F.round(F.avg("likes"), 9).alias("avg_likes"),
        F.sum("views").alias("sum_views"),
        F.sum("likes").alias("sum_likes"),
        F.max("views").alias("max_views"),
    )


def category_interactions(posts: DataFrame, logs: DataFrame) -> DataFrame:
    counts = post_actions(logs).select("post_id", "views", "likes", "comments")
    joined = posts.select("post_id", "category").join(counts, "post_id", "left")
    zero = F.lit(0).cast("bigint")
    return joined.groupBy("category").agg(
        F.count_distinct("post_id").alias("posts"),
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("views", "likes", "comments")],
    )


def author_stats(posts: DataFrame) -> DataFrame:
    stats = posts.groupBy("author").agg(
        F.count(F.lit(1)).alias("posts"),
        F.sum("views").alias("sum_views"),
        F.round(F.avg("views"), 9).alias("avg_views"),
        F.max("views").alias("max_views"),
        F.sum("likes").alias("sum_likes"),
        F.count_distinct("category").alias("categories"),
    )
    return stats.withColumn("level", tier(F.col("sum_views"), [(8000, "head"), (3000, "middle")], "new"))


def with_tags(posts: DataFrame) -> DataFrame:
    """One row per post and tag; tags are lower-cased and trimmed, empty ones dropped."""
    tagged = posts.withColumn("tag", F.explode(F.split(F.lower("tags"), ",")))
    return tagged.withColumn("tag", F.trim("tag")).filter(F.col("tag") != "")


def tag_stats(posts: DataFrame) -> DataFrame:
    return with_tags(posts.select("post_id", "tags", "views")).groupBy("tag").agg(
        F.count(F.lit(1)).alias("uses"),
        F.sum("views").alias("sum_views"),
        F.round(F.avg("views"), 9).alias("avg_views"),
    )


def tag_titles(posts: DataFrame) -> DataFrame:
    """The titles under each tag, as rows: a popular tag's titles never meet in one list."""
    return with_tags(posts.select("title", "tags")).select("tag", "title").distinct()


def tag_diversity(posts: DataFrame) -> DataFrame:
    return with_tags(posts.select("author", "tags")).groupBy("author").agg(
        F.count_distinct("tag").alias("distinct_tags"), F.count(F.lit(1)).alias("tag_uses")
    )


def user_interest_tags(logs: DataFrame, posts: DataFrame, users: DataFrame) -> DataFrame:
    """Posts viewed per user and tag: logs x posts x users, tags exploded after the logs are reduced."""
    views = logs.filter((F.col("action") == "view") & F.col("user_id").isNotNull()).groupBy("user_id", "post_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    tagged = with_tags(posts.select("post_id", "tags")).select("post_id", "tag")
    per_tag = views.join(tagged, "post_id").groupBy("user_id", "tag").agg(F.sum("n").alias("views"))
    return per_tag.join(users.select("user_id", "username"), "user_id").select("username", "tag", "views")


def month_of(column: str) -> Column:
    return F.date_format(column, "yyyy-MM")


def monthly_trend(posts: DataFrame) -> DataFrame:
    return posts.groupBy(month_of("publish_date").alias("month")).agg(
        F.count(F.lit(1)).alias("posts"),
        F.sum("views").alias("sum_views"),
        F.round(F.avg("views"), 9).alias("avg_views"),
        F.sum("likes").alias("sum_likes"),
    )


def growth(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """Change in percent against the previous period; NULL without a previous value.

    ``df`` holds one row per period, so the window spans a calendar's worth of rows.
    """
    window = Window.orderBy(order)
    return df.withColumns(
        {f"{c}_growth": F.round(percent(F.col(c) - F.lag(c).over(window), F.lag(c).over(window)), 9) for c in columns}
    )


def daily_growth_zero(logs: DataFrame) -> DataFrame:
    """Daily page views against the day before; the first day counts zero before it and zero growth."""
    daily = logs.groupBy("event_date").agg(F.count(F.lit(1)).alias("pv"))
    previous = F.lag("pv", 1, 0).over(Window.orderBy("event_date"))
    with_previous = daily.withColumn("prev_pv", previous)
    rate = F.when(F.col("prev_pv") > 0, F.round(percent(F.col("pv") - F.col("prev_pv"), F.col("prev_pv")), 9))
    return with_previous.withColumn("growth", rate.otherwise(F.lit(0.0)))


def monthly_new_users(users: DataFrame) -> DataFrame:
    return users.groupBy(F.month("register_date").alias("month")).agg(
        F.count(F.lit(1)).alias("new_users"), F.count_distinct("city").alias("cities")
    )


def hourly(logs: DataFrame) -> DataFrame:
    return logs.groupBy(F.hour("event_time").alias("hour")).agg(
        F.count(F.lit(1)).alias("pv"), F.count_distinct("user_id").alias("uv")
    )


def weekday(logs: DataFrame) -> DataFrame:
    """1 is Monday, 7 is Sunday."""
    return logs.groupBy((F.weekday("event_date") + 1).alias("weekday")).agg(
        F.count(F.lit(1)).alias("pv"), F.count_distinct("user_id").alias("uv")
    )


def hour_by(logs: DataFrame, dimension: str) -> DataFrame:
    return logs.groupBy(F.hour("event_time").alias("hour"), dimension).agg(F.count(F.lit(1)).alias("pv"))


def with_city(logs: DataFrame, users: DataFrame) -> DataFrame:
    return logs.join(users.select("user_id", "city"), "user_id")


def city_traffic(logs: DataFrame, users: DataFrame) -> DataFrame:
    """Page views, visitors and share per city; one row per user is all that meets the user table."""
    per_user = logs.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    cities = with_city(per_user, users).groupBy("city").agg(F.sum("n").alias("pv"), F.count(F.lit(1)).alias("uv"))
    return cities.withColumn("pv_pct", F.round(percent(F.col("pv"), cities.agg(F.sum("pv")).scalar()), 9))


def dimension_actions(logs: DataFrame, dimension: str) -> DataFrame:
    return logs.groupBy(dimension).agg(*[action_count(a).alias(f"{a}s") for a in ("view", "comment", "like", "share")])


def active_users(logs: DataFrame, n: int = 10) -> DataFrame:
    stats = logs.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_actions"),
        action_count("view").alias("views"),
        action_count("comment").alias("comments"),
        action_count("like").alias("likes"),
        F.min("event_date").alias("first_visit"),
        F.max("event_date").alias("last_visit"),
    )
    return stats.orderBy(F.desc("total_actions"), "user_id").limit(n)


def action_stats(logs: DataFrame) -> DataFrame:
    return logs.groupBy("action").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("post_id").alias("posts"),
    )


def daily_overview(logs: DataFrame) -> DataFrame:
    return logs.groupBy("event_date").agg(
        action_count("view").alias("views"),
        action_count("like").alias("likes"),
        action_count("comment").alias("comments"),
        action_count("search").alias("searches"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("post_id").alias("posts"),
        F.count_distinct("ip").alias("ips"),
    )


def heat_scores(logs: DataFrame, weights: dict[str, int] = HEAT_WEIGHTS) -> DataFrame:
    """Weighted heat per post; an action without a weight counts one."""
    weight = F.lit(1)
    for action, value in weights.items():
        weight = F.when(F.col("action") == action, value).otherwise(weight)
    return logs.groupBy("post_id").agg(F.sum(weight).alias("heat"))

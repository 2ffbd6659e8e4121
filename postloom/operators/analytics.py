"""Counts, shares and rankings over the ``posts`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.session import scratch_path

DELETED = "[deleted]"


def on_platform(posts: DataFrame, platform: str | None) -> DataFrame:
    """Only one platform; no filter when none is given."""
    return posts.filter(F.col("platform") == F.lit(platform)) if platform else posts


def top(df: DataFrame, by: str, limit: int, *ties: str) -> DataFrame:
    """The ``limit`` largest rows; ties are broken by the given columns."""
    return df.orderBy(F.desc_nulls_last(by), *[F.asc_nulls_last(t) for t in ties]).limit(limit)


def _count() -> Column:
    return F.count(F.lit(1)).alias("count")


def _share(decimals: int, half_even: bool = False) -> Column:
    """Percentage of the grand total.

    The window has one row per label or platform, a handful, so the single task
    it runs in does not grow with the data.
    """
    total = F.sum("count").over(Window.partitionBy())
    if half_even:
        return F.bround(F.col("count") / F.greatest(total, F.lit(1)) * 100, decimals)
    return F.round(F.col("count") * F.lit(100.0).cast("double") / total, decimals)


def total_posts(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count(F.lit(1)).alias("total_posts"))


def date_range(posts: DataFrame) -> DataFrame:
    """Oldest and newest post time; no row when no post has one."""
    known = posts.filter(F.col("timestamp").isNotNull())
    span = known.agg(F.min("timestamp").alias("oldest"), F.max("timestamp").alias("newest"))
    return span.filter(F.col("oldest").isNotNull())


def total_and_range(posts: DataFrame) -> DataFrame:
    """Total and date range in one scan."""
    return posts.agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.min("timestamp").alias("oldest"),
        F.max("timestamp").alias("newest"),
    )


def by_platform(posts: DataFrame) -> DataFrame:
    """Posts per platform with the share of all posts, most first."""
    counts = posts.groupBy("platform").agg(_count())
    return counts.withColumn("share", _share(1, half_even=True)).orderBy(
        F.desc("count"), "platform"
    )


def by_sentiment(posts: DataFrame) -> DataFrame:
    labelled = posts.filter(F.col("sentiment_label").isNotNull())
    return labelled.groupBy("sentiment_label").agg(_count())


def _distribution(posts: DataFrame, label: str, platform: str | None) -> DataFrame:
    labelled = on_platform(posts, platform).filter(F.col(label).isNotNull())
    counts = labelled.groupBy(label).agg(_count())
    return counts.withColumn("percentage", _share(2)).orderBy(F.desc("count"), label)


def sentiment_distribution(posts: DataFrame, platform: str | None = None) -> DataFrame:
    """Posts per sentiment with the percentage of the labelled posts."""
    return _distribution(posts, "sentiment_label", platform)


def engagement_distribution(posts: DataFrame, platform: str | None = None) -> DataFrame:
    """Posts per engagement level with the percentage of the labelled posts."""
    return _distribution(posts, "engagement_level", platform)


def top_authors(posts: DataFrame, limit: int = 10) -> DataFrame:
    """Most active authors; deleted accounts do not count."""
    author = F.col("author")
    known = posts.filter(author.isNotNull() & (author != DELETED))
    return top(known.groupBy("author").agg(_count()), "count", limit, "author")


def author_average_likes(posts: DataFrame, platform: str, limit: int = 10) -> DataFrame:
    """Authors of one platform by number of posts, with their average likes."""
    grouped = on_platform(posts, platform).groupBy("author")
    stats = grouped.agg(
        F.count(F.lit(1)).alias("post_count"), F.avg("likes").alias("avg_likes")
    )
    return top(stats, "post_count", limit, "author")


def tags_of(posts: DataFrame) -> DataFrame:
    """One row per hashtag of every post."""
    tagged = posts.filter(F.col("hashtags").isNotNull() & (F.col("hashtags") != ""))
    tags = tagged.select(F.explode(F.split("hashtags", ",")).alias("hashtag"))
    return tags.select(F.trim("hashtag").alias("hashtag")).filter(F.col("hashtag") != "")


def top_hashtags(posts: DataFrame, limit: int = 20) -> DataFrame:
    """Most used hashtags."""
    tags = tags_of(posts)
    return top(tags.groupBy("hashtag").agg(_count()), "count", limit, "hashtag")


def stats_bundle(posts: DataFrame) -> DataFrame:
    """Total, date range and counts per platform and per sentiment in one scan.

    ``section`` says which grouping a row belongs to; ``name`` is its label.
    """
    grouped = posts.groupingSets(
        [["platform"], ["sentiment_label"], []], "platform", "sentiment_label"
    ).agg(
        F.grouping_id().alias("_grouping"),
        _count(),
        F.min("timestamp").alias("oldest"),
        F.max("timestamp").alias("newest"),
    )
    section = (
        F.when(F.col("_grouping") == 1, "by_platform")
        .when(F.col("_grouping") == 2, "by_sentiment")
        .otherwise("total")
    )
    rows = grouped.select(
        section.alias("section"),
        F.coalesce("platform", "sentiment_label").alias("name"),
        "count",
        "oldest",
        "newest",
    )
    return rows.filter((F.col("section") != "by_sentiment") | F.col("name").isNotNull())


def stats(posts: DataFrame) -> dict[str, DataFrame]:
    """All table statistics, each as a DataFrame."""
    return {"counts": stats_bundle(posts), "top_authors": top_authors(posts)}


def _overview(posts: DataFrame) -> DataFrame:
    """Counts and time span per platform, sentiment, engagement level and author, and in all."""
    names = ["platform", "sentiment_label", "engagement_level", "author"]
    grouped = posts.groupingSets([*[[n] for n in names], []], *names).agg(
        F.grouping_id().alias("_grouping"), _count(), F.min("timestamp").alias("oldest"), F.max("timestamp").alias("newest")
    )
    # One bit per column that a row is not grouped by, the first column highest.
    every = (1 << len(names)) - 1
    section = F.lit("total")
    for i, name in enumerate(names):
        section = F.when(F.col("_grouping") == every - (1 << (len(names) - 1 - i)), name).otherwise(section)
    return grouped.select(section.alias("section"), F.coalesce(*names).alias("name"), "count", "oldest", "newest")


def dashboard(posts: DataFrame) -> dict[str, DataFrame]:
    """The relations of the analytics overview.

    The input is read twice: once for all counts, whose result is stored, and once for hashtags.
    """
    path = scratch_path(posts.sparkSession, "dashboard")
    _overview(posts).write.parquet(path)
    counts = posts.sparkSession.read.parquet(path)

    def section(name: str) -> DataFrame:
        return counts.filter(F.col("section") == name).select(F.col("name").alias(name), "count")

    def shares(name: str) -> DataFrame:
        known = section(name).filter(F.col(name).isNotNull())
        return known.withColumn("percentage", _share(2)).orderBy(F.desc("count"), name)

    total = counts.filter(F.col("section") == "total")
    platforms = section("platform").withColumn("share", _share(1, half_even=True))
    authors = section("author").filter(F.col("author").isNotNull() & (F.col("author") != DELETED))
    return {
        "overview": total.select(F.col("count").alias("total_posts"), "oldest", "newest"),
        "by_platform": platforms.orderBy(F.desc("count"), "platform"),
        "sentiment": shares("sentiment_label"),
        "engagement": shares("engagement_level"),
        "top_hashtags": top_hashtags(posts, 10),
        "top_authors": top(authors, "count", 5, "author"),
    }

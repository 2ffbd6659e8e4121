"""Platform payloads derived from the driver's tables, as JSON text parsed back.

Every event becomes one captured page, photo post or tweet, and every document
one video detail response, so the payloads grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postloom import schema
from postloom.plans.inputs import posts_raw, spread, table

s = F.lit


def _parsed(df: DataFrame, payload: Column, payload_schema: StructType) -> DataFrame:
    """The payload written as JSON text and read with its declared schema."""
    text = df.select(F.to_json(payload).alias("json"))
    return text.select(F.from_json("json", payload_schema).alias("p")).select("p.*")


def _str(column: Column) -> Column:
    return column.cast("string")


def reddit_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two children per page: a post with everything, and a bare one that errors left without id."""
    n = F.col("seq")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", epoch, F.col("scraped_at")).cast("double")
    full = F.struct(
        F.concat(s("r"), _str(n)).alias("id"),
        F.concat(F.col("event_type"), s(" &amp;  “seen”")).alias("title"),
        F.col("post_text").alias("selftext"),
        F.when(n % 3 == 0, F.concat(s("https://thumb.example/"), _str(n), s(".jpg")))
        .when(n % 3 == 1, "self")
        .alias("thumbnail"),
        F.when(n % 2 == 0, F.col("hashtags")).alias("link_flair_text"),
        F.col("author").alias("author"),
        F.col("event_type").alias("subreddit"),
        F.concat(s("/r/x/"), _str(n)).alias("permalink"),
        F.when(n % 11 == 0, 0.0).otherwise(seconds).alias("created_utc"),
        (n * 7919 % 20000).alias("score"),
        F.when(n % 13 != 0, n % 700).alias("num_comments"),
        ((n % 100) / 100).alias("upvote_ratio"),
        F.when(
            n % 4 == 0,
            F.struct(
                F.array(
                    F.struct(
                        F.struct(
                            F.concat(s("https://prev.example/"), _str(n), s("?a=1&amp;b=2")).alias("url")
                        ).alias("source")
                    )
                ).alias("images")
            ),
        ).alias("preview"),
    )
    bare = F.struct(
        F.when(F.col("event_type") == "error", "").otherwise(F.concat(s("c"), _str(n))).alias("id"),
        F.col("event_type").alias("title"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in _child_fields()[2:]],
    )
    payload = F.struct(
        n.alias("page_no"),
        F.struct(
            s("next").alias("after"),
            F.array(F.struct(full.alias("data")), F.struct(bare.alias("data"))).alias("children"),
        ).alias("data"),
    )
    return _parsed(posts_raw(spark, sf_dir), payload, schema.REDDIT_LISTING)


def _child_fields():
    children = schema.REDDIT_LISTING["data"].dataType["children"].dataType
    return children.elementType["data"].dataType.fields


def youtube_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search page per event: views and clicks are videos, other events channels."""
    events = table(spark, sf_dir, "events")
    is_video = F.col("event_type").isin("view", "click")
    item = F.struct(
        F.struct(
            F.when(is_video, "youtube#video").otherwise("youtube#channel").alias("kind"),
            F.concat(s("v"), _str(F.col("user_id"))).alias("videoId"),
        ).alias("id")
    )
    payload = F.struct(
        F.col("event_id").alias("page_no"),
        s("next").alias("nextPageToken"),
        F.array(item).alias("items"),
    )
    return _parsed(events, payload, schema.YOUTUBE_SEARCH)


def youtube_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail response per document; every eleventh has no items."""
    documents = spread(table(spark, sf_dir, "documents"))
    d = F.col("doc_id")
    url = lambda name: F.struct(F.concat(s(f"https://{name}.example/"), _str(d)).alias("url"))
    item = F.struct(
        F.struct(
            F.concat(s("On “"), F.col("source"), s("”")).alias("title"),
            F.concat(F.col("text"), s(" #Video #"), F.col("lang"), s(" end")).alias("description"),
            F.concat(s(" channel  "), F.col("source")).alias("channelTitle"),
            F.col("source").alias("channelId"),
            s("2024-01-05T10:00:00Z").alias("publishedAt"),
            F.struct(
                F.when(d % 2 == 0, url("maxres")).alias("maxres"),
                F.when(d % 3 == 0, url("medium")).alias("medium"),
                F.when(d % 3 == 0, url("standard")).alias("standard"),
                F.when(d % 5 != 0, url("default")).alias("default"),
            ).alias("thumbnails"),
        ).alias("snippet"),
        F.when(
            d % 7 != 0,
            F.struct(
                _str(d * 31).alias("likeCount"),
                _str(d % 50).alias("commentCount"),
                _str(d + 3000000000).alias("viewCount"),
            ),
        ).alias("statistics"),
        F.struct(s("PT4M13S").alias("duration")).alias("contentDetails"),
    )
    payload = F.struct(
        F.concat(s("v"), _str(d)).alias("video_id"),
        F.filter(F.array(item), lambda _: d % 11 != 0).alias("items"),
    )
    return _parsed(documents, payload, schema.YOUTUBE_DETAILS)


def instagram_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capture per event; pairs of events show the same post address."""
    n = F.col("seq")
    payload = F.struct(
        n.alias("page_no"),
        s(0).alias("pos"),
        F.when(n % 3 == 0, F.concat(s("https://photos.example/p/ID"), _str(F.floor(n / 6)), s("/x")))
        .when(n % 3 == 1, "https://photos.example/explore/")
        .alias("page_url"),
        F.when(n % 4 == 0, F.concat(s("https://img.example/a/12_"), _str(n), s("_n.jpg?x=1")))
        .when(n % 4 != 3, F.concat(s("https://img.example/raw/"), _str(F.floor(n / 10))))
        .alias("image_src"),
        F.concat(s(" "), F.col("author")).alias("author_text"),
        F.array(s("short"), F.col("post_text")).alias("caption_candidates"),
        F.when(n % 2 == 0, F.col("timestamp")).alias("time_datetime"),
        F.when(n % 5 == 0, s("3 days ago")).alias("time_text"),
        F.array(s("Liked by you"), F.concat(F.format_number(n * 7919 % 20000, 0), s(" Likes"))).alias(
            "likes_texts"
        ),
        F.when(n % 8 != 0, F.array(F.concat(s("View all "), _str(n % 700), s(" comments")))).alias(
            "comments_texts"
        ),
    )
    return _parsed(posts_raw(spark, sf_dir), payload, schema.INSTAGRAM_CAPTURE)


def tweet_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capture per event; some tweets appear twice, some have no status id."""
    n = F.col("seq")
    status = _str(F.when(n % 10 == 9, n - 1).otherwise(n))
    payload = F.struct(
        n.alias("page_no"),
        s(0).alias("pos"),
        F.col("post_text").alias("text"),
        F.concat(s("/"), F.col("author"), s("/")).alias("author_href"),
        F.when(
            n % 3 == 0,
            F.array(s("/a/status/photo"), F.concat(s("/b/status/"), status, s("/analytics"))),
        )
        .when(n % 3 == 1, F.array(s("/a/photo"), F.concat(s("https://twitter.com/b/status/"), status)))
        .otherwise(F.array(s("/a/photo"), s("/c/status/none")))
        .alias("status_hrefs"),
        F.when(n % 2 == 0, F.col("timestamp")).alias("time_datetime"),
        F.col("metric_text").alias("like_text"),
        F.concat(_str(n % 90), s(".5k")).alias("retweet_text"),
        F.when(n % 4 != 0, F.col("comments")).alias("reply_text"),
        F.when(n % 3 != 0, F.col("image_url")).alias("media_src"),
    )
    return _parsed(posts_raw(spark, sf_dir), payload, schema.TWEET_CAPTURE)

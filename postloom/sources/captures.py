"""Captured platform payloads mapped to raw posts.

Each platform has a reader for captured JSON files and a mapper from the payload
DataFrame to raw posts, so payloads from any other source can be mapped too.
``page_no`` and ``pos`` keep the capture order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions import parse, text
from postloom.operators.collapse import first_rows
from postloom.operators.indexing import with_row_index
from postloom.operators.skew import join_spread
from postloom.schema import (
    CAPTURE_ORDER,
    INSTAGRAM_CAPTURE,
    RAW_POSTS,
    REDDIT_LISTING,
    TWEET_CAPTURE,
    YOUTUBE_DETAILS,
    YOUTUBE_SEARCH,
)
from postloom.sources import lane

def capture_order(page_no: str = "page_no", pos: str = "pos", source: int = 0) -> Column:
    """Place of a captured post, compared by page, then position; see CAPTURE_ORDER."""
    parts = [F.col(page_no), F.col(pos), F.lit(source)]
    place = F.struct(*[c.cast(f.dataType).alias(f.name) for c, f in zip(parts, CAPTURE_ORDER)])
    return F.when(F.col(page_no).isNotNull() & F.col(pos).isNotNull(), place)


def _payloads(spark: SparkSession, path: str, schema, bad_lines: str = "raise") -> DataFrame:
    """Captured JSON, one payload per line.

    A line that cannot be read raises, or with ``bad_lines="refuse"`` is left out here and
    returned by :func:`refused_lines`. Payloads as delivered carry no ``page_no``. They are numbered
    by file path, so each of their files must hold one payload.
    """
    if bad_lines not in ("raise", "refuse"):
        raise ValueError(f"bad_lines is raise or refuse, not {bad_lines!r}")
    if bad_lines == "refuse":
        read = lane.good(lane.read_lines(spark, path, schema, keep=["file"])).withColumnRenamed("file", "_path")
    else:
        read = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
        read = read.withColumn("_path", F.col("_metadata.file_path"))
    names = schema.fieldNames()
    if "page_no" not in names:
        return read.select(*names)
    files = read.filter("page_no IS NULL").select(F.col("_path").alias("_file"))
    if not files.limit(1).count():
        return read.select(*names)
    twice = F.raise_error(F.lit("a file without page_no holds several payloads")).cast("bigint")
    counted = files.groupBy("_file").agg(F.count(F.lit(1)).alias("_payloads"))
    numbered = with_row_index(counted, [F.asc("_file")], "_number")
    number = F.when(F.col("_payloads") == 1, F.col("_number")).otherwise(twice)
    found = numbered.select("_file", number.alias("_number"))
    joined = read.join(found, F.col("_path") == F.col("_file"), "left")
    return joined.withColumn("page_no", F.coalesce("page_no", "_number")).select(*names)


def _iso(as_of: Column | None) -> Column:
    return parse.iso_text(parse.now() if as_of is None else as_of)


def _raw(df: DataFrame, platform: str, as_of: Column | None, **columns: Column) -> DataFrame:
    """Select the raw-post columns in schema order; absent ones are NULL."""
    known = {
        "platform": F.lit(platform),
        "scraped_at": _iso(as_of),
        "seq": capture_order(),
        **columns,
    }
    kinds = {f.name: f.dataType for f in RAW_POSTS} | {"seq": CAPTURE_ORDER}
    return df.select(*[known.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()])


def first_captured(posts: DataFrame, limit: int | None = None) -> DataFrame:
    """The first ``limit`` posts in capture order; all of them without a limit."""
    return posts if limit is None else posts.orderBy("seq").limit(limit)


def _or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def reddit_posts(pages: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Posts of captured listing or search pages; a post without id is dropped."""
    children = pages.select("page_no", F.posexplode("data.children").alias("pos", "child"))
    post = children.select("page_no", "pos", "child.data.*").filter(_or_empty("id") != "")
    parts = post.withColumns(
        {
            "_title": text.clean_reddit("title"),
            "_body": text.clean_reddit("selftext"),
            "_preview": F.replace(
                F.get(F.col("preview.images"), F.lit(0))["source"]["url"], F.lit("&amp;"), F.lit("&")
            ),
        }
    )
    title_and_body = F.regexp_replace(
        F.concat_ws("\n\n", "_title", "_body"), "^\n\n", ""
    )
    return _raw(
        parts,
        "reddit",
        as_of,
        post_id=F.col("id"),
        post_text=F.when(F.col("_body") != "", title_and_body).otherwise(F.col("_title")),
        hashtags=_or_empty("link_flair_text"),
        timestamp=parse.epoch_text("created_utc"),
        image_url=F.coalesce(
            F.nullif(F.col("_preview"), F.lit("")),
            F.when(F.col("thumbnail").startswith("http"), F.col("thumbnail")),
            F.lit(""),
        ),
        likes=F.coalesce("score", F.lit(0)),
        comments=F.coalesce("num_comments", F.lit(0)),
        author=F.coalesce("author", F.lit("[deleted]")),
        subreddit=_or_empty("subreddit"),
        url=F.concat(F.lit("https://reddit.com"), _or_empty("permalink")),
        upvote_ratio=F.coalesce("upvote_ratio", F.lit(0.0)),
    )


def youtube_hits(pages: DataFrame) -> DataFrame:
    """Video ids of captured search pages in result order; other kinds are dropped."""
    items = pages.select("page_no", F.posexplode("items").alias("pos", "item"))
    return items.filter(F.col("item.id.kind") == "youtube#video").select(
        "page_no", "pos", F.col("item.id.videoId").alias("video_id")
    )


def youtube_details(responses: DataFrame) -> DataFrame:
    """First item of every detail response; one row per video id."""
    found = responses.select("video_id", F.get("items", F.lit(0)).alias("item"))
    found = found.filter(F.col("item").isNotNull())
    # A video captured twice has the same details apart from its counters.
    order = F.coalesce(F.col("item.statistics.viewCount").try_cast("bigint"), F.lit(-1))
    ranked = found.withColumn("_order", F.struct(order, F.xxhash64("item")))
    return ranked.groupBy("video_id").agg(F.max_by("item", "_order").alias("item"))


def join_details(hits: DataFrame, details: DataFrame) -> DataFrame:
    """Search hits with their details; a hit without details is dropped.

    ``details`` has one row per id. A video may be hit very often, so hot ids are
    spread over the tasks.
    """
    return join_spread(hits, details, "video_id", ["page_no", "pos"])


def youtube_posts(
    pages: DataFrame, responses: DataFrame, as_of: Column | None = None
) -> DataFrame:
    joined = join_details(youtube_hits(pages), youtube_details(responses))
    snippet = F.col("item.snippet")
    thumbnails = snippet["thumbnails"]
    sizes = ["maxres", "high", "medium", "standard", "default"]
    # The first size that is present wins, even when its address is missing.
    chosen = F.coalesce(*[F.when(thumbnails[s].isNotNull(), F.struct(thumbnails[s]["url"])) for s in sizes])
    parts = joined.withColumns(
        {
            "_title": text.clean_plain(snippet["title"]),
            "_description": text.clean_plain(snippet["description"]),
            "_image": F.coalesce(chosen["url"], F.lit("")),
        }
    )

    def field(*path: str) -> Column:
        return F.coalesce(F.col(".".join(["item", *path])), F.lit(""))

    return _raw(
        parts,
        "youtube",
        as_of,
        post_id=F.col("video_id"),
        post_text=F.concat_ws("\n\n", "_title", text.remove_hashtags("_description")),
        hashtags=F.array_join(text.hashtags("_description"), ","),
        timestamp=field("snippet", "publishedAt"),
        image_url=F.col("_image"),
        likes=field("statistics", "likeCount"),
        comments=field("statistics", "commentCount"),
        author=text.clean_plain(snippet["channelTitle"]),
        view_count=field("statistics", "viewCount"),
        duration=field("contentDetails", "duration"),
        channel_id=field("snippet", "channelId"),
        url=F.concat(F.lit("https://www.youtube.com/watch?v="), F.col("video_id")),
    )


def instagram_posts(captures: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Captured photo posts; a post captured twice keeps its first capture."""
    usable = captures.filter(F.col("image_src").isNotNull())
    captions = F.filter("caption_candidates", lambda c: F.length(c) > 5)
    parts = usable.withColumn("_caption", text.clean_plain(F.get(captions, F.lit(0))))
    posts = _raw(
        parts,
        "instagram",
        as_of,
        post_id=parse.instagram_post_id("page_url", "image_src"),
        post_text=text.remove_hashtags("_caption"),
        hashtags=F.array_join(text.hashtags("_caption"), ","),
        timestamp=F.coalesce(
            F.nullif(F.col("time_datetime"), F.lit("")),
            F.nullif(F.col("time_text"), F.lit("")),
            _iso(as_of),
        ),
        image_url=F.col("image_src"),
        likes=parse.first_likes("likes_texts"),
        comments=parse.first_comments("comments_texts"),
        author=text.clean_plain("author_text"),
    )
    return first_rows(posts, ["post_id"], whole=True)


def tweet_posts(captures: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Captured tweets; a tweet captured twice keeps its first capture."""
    parts = captures.withColumn("_text", text.clean_plain("text"))
    posts = _raw(
        parts,
        "twitter",
        as_of,
        post_id=parse.tweet_post_id("status_hrefs", "_text"),
        post_text=text.remove_hashtags("_text"),
        hashtags=F.array_join(text.hashtags("_text"), ","),
        timestamp=_or_empty("time_datetime"),
        image_url=_or_empty("media_src"),
        likes=parse.metric_text("like_text"),
        comments=parse.metric_text("reply_text"),
        retweet_count=parse.metric_text("retweet_text"),
        author=parse.author_from_href("author_href"),
        url=parse.tweet_url("status_hrefs"),
    )
    return first_rows(posts, ["post_id"], whole=True)


def read_reddit(spark: SparkSession, path: str, as_of: Column | None = None, bad_lines: str = "raise") -> DataFrame:
    """Captured listing pages, or search pages, of one subreddit or query."""
    return reddit_posts(_payloads(spark, path, REDDIT_LISTING, bad_lines), as_of)


def read_youtube(spark: SparkSession, path: str, as_of: Column | None = None, bad_lines: str = "raise") -> DataFrame:
    """Captured search pages below ``search`` and detail responses below ``details``."""
    pages = _payloads(spark, f"{path}/search", YOUTUBE_SEARCH, bad_lines)
    responses = _payloads(spark, f"{path}/details", YOUTUBE_DETAILS, bad_lines)
    return youtube_posts(pages, responses, as_of)


def read_instagram(spark: SparkSession, path: str, as_of: Column | None = None, bad_lines: str = "raise") -> DataFrame:
    return instagram_posts(_payloads(spark, path, INSTAGRAM_CAPTURE, bad_lines), as_of)


def read_tweets(spark: SparkSession, path: str, as_of: Column | None = None, bad_lines: str = "raise") -> DataFrame:
    return tweet_posts(_payloads(spark, path, TWEET_CAPTURE, bad_lines), as_of)


READERS = {
    "reddit": read_reddit,
    "youtube": read_youtube,
    "instagram": read_instagram,
    "twitter": read_tweets,
}
# Payloads of each platform, by folder below its path.
PAYLOADS = {
    "reddit": {"": REDDIT_LISTING},
    "youtube": {"/search": YOUTUBE_SEARCH, "/details": YOUTUBE_DETAILS},
    "instagram": {"": INSTAGRAM_CAPTURE},
    "twitter": {"": TWEET_CAPTURE},
}


def _known(platform: str) -> str:
    if platform not in READERS:
        raise ValueError(f"unknown platform {platform!r}; known: {', '.join(READERS)}")
    return platform


def read_posts(
    spark: SparkSession,
    platform: str,
    path: str,
    limit: int | None = None,
    as_of: Column | None = None,
    bad_lines: str = "raise",
) -> DataFrame:
    """Raw posts of one platform's capture folder, in capture order up to a limit."""
    return first_captured(READERS[_known(platform)](spark, path, as_of, bad_lines), limit)


def refused_lines(spark: SparkSession, platform: str, path: str) -> DataFrame:
    """Lines of a capture folder that ``bad_lines="refuse"`` leaves out: (file, line, reason)."""
    parts = [lane.refused(lane.read_lines(spark, path + folder, schema)) for folder, schema in PAYLOADS[_known(platform)].items()]
    return reduce(DataFrame.unionByName, parts)


def read_all(spark: SparkSession, folders: dict[str, str], **options) -> DataFrame:
    """Union of several captures; ``seq`` is unique and orders by page, position and folder.

    A folder is named by its platform, or by anything after ``platform:`` when a platform has
    several, as in ``{"reddit:hot": ..., "reddit:new": ...}``.
    """
    result = None
    for i, (name, path) in enumerate(folders.items()):
        posts = read_posts(spark, name.partition(":")[0], path, **options)
        frame = posts.withColumn("seq", F.col("seq").withField("source", F.lit(i)))
        result = frame if result is None else result.unionByName(frame)
    return result

"""Schemas: captured payloads, raw posts and the stored ``posts`` table."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ["post_id", "platform"]

# One row per captured post, before transformation. Counters and the post time
# stay text because the platforms deliver them as text.
RAW_POSTS = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("post_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("post_text", T.StringType()),
        T.StructField("hashtags", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("likes", T.StringType()),
        T.StructField("comments", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("scraped_at", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("upvote_ratio", T.DoubleType()),
        T.StructField("retweet_count", T.StringType()),
        T.StructField("view_count", T.StringType()),
        T.StructField("duration", T.StringType()),
        T.StructField("channel_id", T.StringType()),
    ]
)

# Place of a captured post: page, position in the page, and which of several sources. Captured
# posts carry it as ``seq``; raw posts from elsewhere have a plain number there.
CAPTURE_ORDER = T.StructType(
    [
        T.StructField("page", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("source", T.IntegerType()),
    ]
)
# Place of a post over all loads.
ARRIVAL = T.StructType([T.StructField("load", T.LongType()), *CAPTURE_ORDER.fields])

# The stored table. ``id`` is unique and increases with the first arrival of a post, like an
# auto-increment key.
POSTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("post_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("post_text", T.StringType()),
        T.StructField("hashtags", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("likes", T.LongType()),
        T.StructField("comments", T.LongType()),
        T.StructField("author", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("scraped_at", T.TimestampNTZType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("upvote_ratio", T.FloatType()),
        T.StructField("retweet_count", T.LongType()),
        T.StructField("view_count", T.LongType()),
        T.StructField("duration", T.StringType()),
        T.StructField("channel_id", T.StringType()),
        T.StructField("sentiment_label", T.StringType()),
        T.StructField("engagement_level", T.StringType()),
        T.StructField("processed_at", T.TimestampNTZType()),
    ]
)

# On a key conflict only these columns take the later capture's values.
MUTABLE = ["likes", "comments", "scraped_at"]
STATIC = [f.name for f in POSTS if f.name not in [*KEY, *MUTABLE, "id"]]

# Physical table schema: POSTS plus the places of a post's first and latest capture.
STORED = T.StructType(
    [*POSTS.fields, T.StructField("first_at", ARRIVAL), T.StructField("last_at", ARRIVAL)]
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_S, _L, _D, _I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()
_URL = _struct(url=_S)

REDDIT_LISTING = _struct(
    page_no=_L,
    data=_struct(
        after=_S,
        children=T.ArrayType(
            _struct(
                data=_struct(
                    id=_S,
                    title=_S,
                    selftext=_S,
                    thumbnail=_S,
                    link_flair_text=_S,
                    author=_S,
                    subreddit=_S,
                    permalink=_S,
                    created_utc=_D,
                    score=_L,
                    num_comments=_L,
                    upvote_ratio=_D,
                    preview=_struct(images=T.ArrayType(_struct(source=_URL))),
                )
            )
        ),
    ),
)

YOUTUBE_SEARCH = _struct(
    page_no=_L,
    nextPageToken=_S,
    items=T.ArrayType(_struct(id=_struct(kind=_S, videoId=_S))),
)

YOUTUBE_DETAILS = _struct(
    video_id=_S,
    items=T.ArrayType(
        _struct(
            snippet=_struct(
                title=_S,
                description=_S,
                channelTitle=_S,
                channelId=_S,
                publishedAt=_S,
                thumbnails=_struct(
                    maxres=_URL, high=_URL, medium=_URL, standard=_URL, default=_URL
                ),
            ),
            statistics=_struct(likeCount=_S, commentCount=_S, viewCount=_S),
            contentDetails=_struct(duration=_S),
        )
    ),
)

INSTAGRAM_CAPTURE = _struct(
    page_no=_L,
    pos=_I,
    page_url=_S,
    image_src=_S,
    author_text=_S,
    caption_candidates=T.ArrayType(_S),
    time_datetime=_S,
    time_text=_S,
    likes_texts=T.ArrayType(_S),
    comments_texts=T.ArrayType(_S),
)

TWEET_CAPTURE = _struct(
    page_no=_L,
    pos=_I,
    text=_S,
    author_href=_S,
    status_hrefs=T.ArrayType(_S),
    time_datetime=_S,
    like_text=_S,
    retweet_text=_S,
    reply_text=_S,
    media_src=_S,
)

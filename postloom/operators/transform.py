"""Row-wise transformation of raw posts, the labels, and its counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions import labels, parse, text
from postloom.schema import KEY, RAW_POSTS

COUNTERS = ["likes", "comments", "retweet_count", "view_count"]
REASON = "reject_reason"


def _as_timestamp(df: DataFrame, name: str) -> Column:
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.StringType):
        return parse.parse_timestamp(name)
    if isinstance(data_type, T.TimestampType):
        return parse.utc(F.col(name))
    return F.col(name).cast("timestamp_ntz")


def _capture_time(df: DataFrame, as_of: Column | None) -> Column:
    """Capture time; a text that is no time becomes the present, a missing one stays NULL."""
    time = _as_timestamp(df, "scraped_at")
    if not isinstance(df.schema["scraped_at"].dataType, T.StringType):
        return time
    present = parse.now() if as_of is None else as_of
    return F.coalesce(time, F.when(F.col("scraped_at") != "", present))


def _complete(df: DataFrame) -> DataFrame:
    """Add the raw columns this capture does not have; keep every other column."""
    missing = {
        f.name: F.lit(None).cast(f.dataType)
        for f in RAW_POSTS
        if f.name not in df.columns and f.name != "seq"
    }
    return df.withColumns(missing) if missing else df


def with_reasons(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """All rows with a post id, transformed; failed rows carry a reject reason."""
    raw = _complete(raw).filter(F.coalesce(F.col("post_id"), F.lit("")) != "")
    timestamp = _as_timestamp(raw, "timestamp")
    scraped_at = _capture_time(raw, as_of)
    cleaned = raw.withColumns(
        {
            # The two counts look at the text as captured, the word count at the cleaned text.
            "mention_count": text.mention_count("post_text"),
            "url_count": text.url_count("post_text"),
            "post_text": text.clean_post("post_text"),
            "hashtags": text.normalize_hashtags("hashtags"),
            "timestamp": timestamp,
            "scraped_at": scraped_at,
            "has_media": F.coalesce(F.col("image_url"), F.lit("")) != "",
            **{name: parse.safe_int(name) for name in COUNTERS},
        }
    )
    overflow = F.greatest(*[F.col(name).isNull().cast("int") for name in COUNTERS]) == 1
    return cleaned.withColumns(
        {
            "word_count": text.word_count("post_text"),
            "sentiment_label": labels.sentiment_words("post_text"),
            "engagement_level": labels.engagement_etl(),
            REASON: F.when(overflow, "counter out of range"),
        }
    )


def transform_posts(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Clean, normalise and label raw posts. Columns not known here pass through.

    Rows without a post id are dropped; rows with a counter that does not fit are
    left out here and returned by :func:`rejected_posts`.
    """
    return with_reasons(raw, as_of).filter(F.col(REASON).isNull()).drop(REASON)


def rejected_posts(raw: DataFrame) -> DataFrame:
    """Rows that have a post id but could not be transformed, with the reason."""
    return with_reasons(raw).filter(F.col(REASON).isNotNull())


def refused_posts(raw: DataFrame) -> DataFrame:
    """Captured rows that a load leaves out, as they were captured, with the reason."""
    missing = [(F.coalesce(F.col(name), F.lit("")) == "") for name in KEY]
    overflow = [parse.safe_int(name).isNull() for name in COUNTERS]
    reason = F.when(missing[0] | missing[1], "post id or platform is missing")
    for wrong in overflow:
        reason = reason.when(wrong, "counter out of range")
    return _complete(raw).withColumn(REASON, reason).filter(F.col(REASON).isNotNull())


def transform_stats(raw: DataFrame) -> DataFrame:
    """One row of counters for a batch: processed, errors and the sentiment counts."""
    ok = F.col(REASON).isNull()
    sentiment = F.col("sentiment_label")
    return with_reasons(raw).agg(
        F.count_if(ok).alias("processed"),
        F.count_if(~ok).alias("errors"),
        *[F.count_if(ok & (sentiment == s)).alias(s) for s in ("positive", "negative", "neutral")],
    )


def label_posts(posts: DataFrame, scheme: str = "substring") -> DataFrame:
    """Add or replace the two labels using one of the two label schemes."""
    schemes = {
        "substring": (labels.sentiment_substrings, labels.engagement_labeler),
        "words": (labels.sentiment_words, labels.engagement_etl),
    }
    sentiment, engagement = schemes[scheme]
    likes, comments = parse.safe_int("likes"), parse.safe_int("comments")
    return posts.withColumns(
        {
            "sentiment_label": sentiment("post_text"),
            "engagement_level": engagement(likes, comments),
        }
    )

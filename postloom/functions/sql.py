"""The cleaning, parsing and label functions for use inside SQL.

Each becomes a temporary SQL function of the session whose body is the SQL form of the Column
expression, so SQL and DataFrame callers run the same expression: Catalyst inlines it, nothing
leaves the JVM, and pruning and pushdown see through it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from postloom.functions import labels, parse, text

# Parameters of each function, and the expression over them.
_TEXT = {"text": "string"}
FUNCTIONS: dict[str, tuple[dict[str, str], Callable[..., Column]]] = {
    "clean_post": (_TEXT, text.clean_post),
    "clean_plain": (_TEXT, text.clean_plain),
    "clean_reddit": (_TEXT, text.clean_reddit),
    "extract_hashtags": (_TEXT, text.hashtags),
    "remove_hashtags": (_TEXT, text.remove_hashtags),
    "extract_mentions": (_TEXT, text.mentions),
    "mention_count": (_TEXT, text.mention_count),
    "remove_urls": (_TEXT, text.remove_urls),
    "has_urls": (_TEXT, text.has_urls),
    "url_count": (_TEXT, text.url_count),
    "emoji_runs": (_TEXT, text.emoji_runs),
    "remove_emoji": (_TEXT, text.remove_emoji),
    "word_count": ({"cleaned": "string"}, text.word_count),
    "normalize_hashtags": ({"tags": "string"}, text.normalize_hashtags),
    "prepare_for_sentiment": (_TEXT, text.prepare_for_sentiment),
    "sentiment_words": (_TEXT, labels.sentiment_words),
    "sentiment_substrings": (_TEXT, labels.sentiment_substrings),
    "engagement_etl": ({"likes": "bigint", "comments": "bigint", "platform": "string"}, labels.engagement_etl),
    "engagement_labeler": ({"likes": "bigint", "comments": "bigint", "platform": "string"}, labels.engagement_labeler),
    "safe_int": ({"value": "string"}, parse.safe_int),
    "metric_text": ({"value": "string"}, parse.metric_text),
    "likes_text": (_TEXT, parse.likes_text),
    "comments_text": (_TEXT, parse.comments_text),
    "instagram_post_id": ({"page_url": "string", "image_url": "string"}, parse.instagram_post_id),
    "author_from_href": ({"href": "string"}, parse.author_from_href),
    "parse_timestamp": ({"value": "string"}, parse.parse_timestamp),
    "epoch_text": ({"seconds": "double"}, parse.epoch_text),
    "image_extension": ({"image_url": "string"}, parse.image_extension),
    "thumbnail_name": ({"post_id": "string", "image_url": "string"}, parse.thumbnail_name),
}
# Functions over arrays call the others per element.
_STATUS_ID = "regexp_extract(h, '/status/([0-9]+)', 1)"
_STATUS_LINKS = "filter(coalesce(hrefs, array()), h -> contains(h, '/status/'))"


_FIRST = {"first_likes": parse.likes_text, "first_comments": parse.comments_text}
NAMES = (*FUNCTIONS, *_FIRST, "tweet_post_id", "tweet_url")


def _body(spark: SparkSession, parameters: dict[str, str], make: Callable[..., Column]) -> tuple[str, str]:
    """SQL text and type of an expression over columns named like the parameters."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in parameters.items())
    frame = spark.createDataFrame([], schema).select(make(*[F.col(p) for p in parameters]).alias("out"))
    named = frame._jdf.queryExecution().analyzed().expressions().head()
    return named.child().sql(), frame.schema["out"].dataType.simpleString()


def _bodies(spark: SparkSession, name: str) -> tuple[dict[str, str], str, str]:
    """Parameters, type and body of a function."""
    if name in FUNCTIONS:
        parameters, make = FUNCTIONS[name]
        body, kind = _body(spark, parameters, make)
        return parameters, kind, body
    if name in _FIRST:
        body, _ = _body(spark, {"c": "string"}, _FIRST[name])
        found = f"filter(transform(candidates, c -> {body}), c -> c <> '')"
        return {"candidates": "array<string>"}, "string", f"coalesce(get({found}, 0), '')"
    if name == "tweet_post_id":
        ids = f"filter(transform({_STATUS_LINKS}, h -> {_STATUS_ID}), i -> i <> '')"
        return {"hrefs": "array<string>"} | _TEXT, "string", f"coalesce(get({ids}, 0), substring(md5(text), 1, 16))"
    numeric = f"get(filter({_STATUS_LINKS}, h -> {_STATUS_ID} <> ''), 0)"
    href = f"coalesce({numeric}, try_element_at({_STATUS_LINKS}, -1), '')"
    return {"hrefs": "array<string>"}, "string", f"if(startswith({href}, '/'), concat('https://twitter.com', {href}), {href})"


def register(spark: SparkSession, *names: str) -> list[str]:
    """Make the named functions, or all, known to the session; returns their names."""
    names = names or NAMES
    for name in names:
        parameters, kind, body = _bodies(spark, name)
        given = ", ".join(f"`{p}` {k}" for p, k in parameters.items())
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS {kind} RETURN {body}")
    return list(names)


def register_used(spark: SparkSession, sql: str) -> list[str]:
    """Make the functions known that a statement calls and the session does not know yet."""
    called = {word.lower() for word in re.findall(r"(\w+)\s*\(", sql)}
    missing = [n for n in NAMES if n in called and not spark.catalog.functionExists(n)]
    return register(spark, *missing) if missing else []

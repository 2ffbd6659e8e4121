"""Sentiment and engagement labels as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions import lexicon as lx
from postloom.functions.text import _text, emoji_runs, is_ascii


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _strings(values: list[str]) -> Column:
    """Constant array; folded into one literal when the query is optimized."""
    return F.split(F.lit("|".join(values)), r"\|")


def _by_sign(score: Column) -> Column:
    """Label from the sign of a score; the score is evaluated once."""
    labels = _strings(["negative", "neutral", "positive"])
    return F.element_at(labels, (F.signum(score) + 2).cast("int"))


def _items(values: list[str]) -> str:
    """Pattern for the items of a ``|``-joined list that equal one of the values."""
    return f"(?<![^|])(?:{'|'.join(values)})(?![^|])"


def sentiment_words(text: Column | str) -> Column:
    """Distinct lexicon words plus every emoji run that is exactly one listed emoji.

    No word is in both lists, so of the distinct hits those that are not positive
    are negative. Hits and emoji runs are used twice but extracted once.
    """
    text = _text(text)
    words = F.regexp_extract_all(F.lower(text), F.lit(lx.WORD + "+"), F.lit(0))
    hits = F.array_intersect(words, _strings(lx.POSITIVE_WORDS + lx.NEGATIVE_WORDS))
    runs = F.when(is_ascii(text), "").otherwise(F.array_join(emoji_runs(text), "|"))
    return _by_sign(
        F.size(F.array_intersect(hits, _strings(lx.POSITIVE_WORDS))) * 2
        - F.size(hits)
        + F.regexp_count(runs, F.lit(_items(lx.POSITIVE_EMOJI)))
        - F.regexp_count(runs, F.lit(_items(lx.NEGATIVE_EMOJI)))
    )


def sentiment_substrings(text: Column | str) -> Column:
    """Each listed substring found anywhere in the lower-cased text counts once."""
    lowered = F.lower(_text(text))

    def found(indicators: list[str]) -> Column:
        return reduce(add, [F.contains(lowered, F.lit(i)).cast("int") for i in indicators])

    return _by_sign(found(lx.POSITIVE_INDICATORS) - found(lx.NEGATIVE_INDICATORS))


def _engagement(
    likes: Column | str,
    comments: Column | str,
    platform: Column | str,
    thresholds: dict[str, tuple[int, int, int]],
    weight: int,
) -> Column:
    def count(c: Column | str) -> Column:
        # As doubles the sum cannot overflow; it is exact far beyond every threshold.
        return F.coalesce(_col(c).cast("double"), F.lit(0.0))

    score = count(likes) + count(comments) * weight

    def level(limits: tuple[int, int, int]) -> Column:
        medium, high, viral = limits
        return (
            F.when(score >= viral, "viral")
            .when(score >= high, "high")
            .when(score >= medium, "medium")
            .otherwise("low")
        )

    result = None
    for name, limits in thresholds.items():
        if limits != thresholds["twitter"]:
            is_name = _col(platform) == name
            result = F.when(is_name, level(limits)) if result is None else result.when(
                is_name, level(limits)
            )
    return result.otherwise(level(thresholds["twitter"]))


def engagement_etl(
    likes: Column | str = "likes",
    comments: Column | str = "comments",
    platform: Column | str = "platform",
) -> Column:
    """Level of likes + 3 * comments against the platform's thresholds."""
    return _engagement(likes, comments, platform, lx.ETL_THRESHOLDS, lx.ETL_COMMENT_WEIGHT)


def engagement_labeler(
    likes: Column | str = "likes",
    comments: Column | str = "comments",
    platform: Column | str = "platform",
) -> Column:
    """Level of likes + 2 * comments against the second set of thresholds."""
    return _engagement(
        likes, comments, platform, lx.LABELER_THRESHOLDS, lx.LABELER_COMMENT_WEIGHT
    )

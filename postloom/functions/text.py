"""Text cleaning and entity extraction as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions import lexicon as lx

URL_MARKERS = ["http", "www."]


def _text(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def replace_all(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Apply literal replacements in the given order."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def has_any(text: Column, *markers: str) -> Column:
    """Whether a literal occurs; a cheap test before a regular expression."""
    return reduce(or_, [F.contains(text, F.lit(m)) for m in markers])


def _none() -> Column:
    return F.array().cast("array<string>")


def _without(text: Column, pattern: str, *markers: str) -> Column:
    """Remove a pattern from texts that hold one of the literals it needs."""
    return F.when(has_any(text, *markers), F.regexp_replace(text, pattern, "")).otherwise(text)


def collapse_spaces(text: Column) -> Column:
    """Turn every whitespace run into one space and trim both ends."""
    # Single plain spaces are left alone, and one range rules out the printable ASCII characters,
    # also those behind a single space, before the whitespace classes are tried.
    run = f"(?! ?[!-~])(?: ?{lx.RARE_SPACE}|  ){lx.SPACE}*"
    return F.trim(F.regexp_replace(text, run, " "))


def strip_spaces(text: Column) -> Column:
    """Remove whitespace from both ends only."""
    return F.btrim(text, F.lit(lx.SPACE_CHARACTERS))


def _decoded(text: Column, entities: list[tuple[str, str]]) -> Column:
    if not entities:
        return text
    return F.when(has_any(text, "&"), replace_all(text, entities)).otherwise(text)


def _plain_characters(
    text: Column, entities: list[tuple[str, str]], characters: list[tuple[str, str]]
) -> Column:
    """Decode entities, then replace typographic characters."""
    decoded = _decoded(text, entities)
    # Decoding adds no typographic characters, so a text without any needs no second pass.
    # To look for all of them takes less time than one replacement that finds nothing.
    typographic = ~is_ascii(text) & has_any(text, *[old for old, _ in characters])
    return F.when(typographic, replace_all(decoded, characters)).otherwise(decoded)


def _cleaned(
    text: Column, entities: list[tuple[str, str]], characters: list[tuple[str, str]]
) -> Column:
    return collapse_spaces(_plain_characters(text, entities, characters))


def clean_post(text: Column | str) -> Column:
    """Cleaning used when posts are loaded: entities, typography, whitespace."""
    characters = [*lx.QUOTES_AND_DASHES, *lx.ZERO_WIDTH, *lx.NO_BREAK_SPACE]
    return _cleaned(_text(text), lx.ENTITIES, characters)


def clean_plain(text: Column | str) -> Column:
    """Typography and whitespace only. Used for captured video, photo and tweet text."""
    return _cleaned(_text(text), [], [*lx.QUOTES_AND_DASHES, *lx.ZERO_WIDTH])


def clean_reddit(text: Column | str) -> Column:
    """Four entities, typography and whitespace; zero-width characters stay."""
    return _cleaned(_text(text), lx.REDDIT_ENTITIES, lx.QUOTES_AND_DASHES)


def hashtags(text: Column | str) -> Column:
    """Array of tags without the leading ``#``."""
    text = _text(text)
    return F.when(has_any(text, "#"), F.regexp_extract_all(text, F.lit(lx.HASHTAG), F.lit(1))).otherwise(_none())


def remove_hashtags(text: Column | str) -> Column:
    return collapse_spaces(_without(_text(text), lx.HASHTAG_TAIL, "#"))


def mentions(text: Column | str) -> Column:
    """Array of mentions with the leading ``@``; also finds them inside e-mail addresses."""
    text = _text(text)
    return F.when(has_any(text, "@"), F.regexp_extract_all(text, F.lit(lx.MENTION), F.lit(0))).otherwise(_none())


def mention_count(text: Column | str) -> Column:
    text = _text(text)
    return F.when(has_any(text, "@"), F.regexp_count(text, F.lit(lx.MENTION))).otherwise(0)


def remove_urls(text: Column | str) -> Column:
    return strip_spaces(_without(_text(text), lx.URL, *URL_MARKERS))


def has_urls(text: Column | str) -> Column:
    text = _text(text)
    return has_any(text, *URL_MARKERS) & F.rlike(text, F.lit(lx.URL))


def url_count(text: Column | str) -> Column:
    text = _text(text)
    return F.when(has_any(text, *URL_MARKERS), F.regexp_count(text, F.lit(lx.URL))).otherwise(0)


def emoji_runs(text: Column | str) -> Column:
    """Array of maximal emoji runs. The range also covers CJK and Hangul."""
    text = _text(text)
    return F.when(is_ascii(text), _none()).otherwise(F.regexp_extract_all(text, F.lit(lx.EMOJI_RUN), F.lit(0)))


def emoji_run_count(text: Column | str) -> Column:
    text = _text(text)
    return F.when(is_ascii(text), 0).otherwise(F.regexp_count(text, F.lit(lx.EMOJI_RUN)))


def remove_emoji(text: Column | str) -> Column:
    text = _text(text)
    return F.when(is_ascii(text), text).otherwise(F.regexp_replace(text, lx.EMOJI_RUN, ""))


def word_count(cleaned: Column | str) -> Column:
    """Number of whitespace-separated words of an already cleaned text."""
    text = _text(cleaned)
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def normalize_hashtags(tags: Column | str) -> Column:
    """Comma-joined tags: stripped, lower-cased, at least two characters."""
    edges = f"^{lx.SPACE}+|{lx.SPACE}*(,){lx.SPACE}*|{lx.SPACE}+$"
    stripped = F.regexp_replace(F.lower(_text(tags)), edges, "$1")
    # With a comma before every tag, a tag of at most one character goes with its comma.
    kept = F.regexp_replace(F.concat(F.lit(","), stripped), ",[^,]?(?=,|$)", "")
    return F.regexp_replace(kept, "^,", "")


def prepare_for_sentiment(text: Column | str, include_emojis: bool = True) -> Column:
    """Struct of the text ready for modelling and what was found in it."""
    raw = _text(text)
    # None of the patterns depends on how much whitespace there is, so collapsing it
    # once at the end gives what collapsing after every step would.
    cleaned = _plain_characters(raw, [], [*lx.QUOTES_AND_DASHES, *lx.ZERO_WIDTH])
    cleaned = _without(_without(cleaned, lx.URL, *URL_MARKERS), lx.HASHTAG_TAIL, "#")
    if not include_emojis:
        cleaned = remove_emoji(cleaned)
    cleaned = _without(cleaned, lx.MENTION, "@")
    return F.struct(
        collapse_spaces(cleaned).alias("cleaned_text"),
        hashtags(raw).alias("hashtags"),
        mentions(raw).alias("mentions"),
        has_urls(raw).alias("has_urls"),
        emoji_run_count(raw).alias("emoji_count"),
    )

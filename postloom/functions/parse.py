"""Counters, ids, timestamps and file names parsed from captured text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions import lexicon as lx
from postloom.functions.text import strip_spaces

# Text forms accepted by the parsers.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER = r"^[+-]?[0-9]+$"
INFINITE = r"^[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])$"
# Parts of one digit are read only where hours, minutes and seconds are all given.
TIMESTAMP = (
    r"^(?=[0-9]{4}-[0-9]{2}-[0-9]{2}(?:\z|[Tt ][0-9]{2}:[0-9]{2})|[^:]*:[0-9]{1,2}:[0-9])"
    r"([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})"
    r"(?:[Tt ]([0-9]{1,2}:[0-9]{1,2}(?::[0-9]{1,2}(?:\.[0-9]{1,6})?)?)[0-9]*"
    r"([Zz]|[+-](?:[01][0-9]|2[0-3]):?[0-5][0-9])?)?\z"
)
COUNT = "([0-9]+(?:,[0-9]+)*)"
LIKES = f"{COUNT}{lx.SPACE}*(?:like|likes)"
COMMENTS = [
    f"{COUNT}{lx.SPACE}*comments",
    f"{COUNT}{lx.SPACE}*comment",
    f"view all{lx.SPACE}*{COUNT}{lx.SPACE}*comments",
]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _digits(text: Column) -> Column:
    """Numeric text without surrounding whitespace and digit separators."""
    edges_and_separators = f"^{lx.SPACE}+|{lx.SPACE}+$|(?<=[0-9])_(?=[0-9])"
    return F.regexp_replace(text, edges_and_separators, "")


def _number(text: Column, pattern: str) -> Column:
    """Double of a text that has the given form, else NULL."""
    return F.regexp_extract(text, pattern, 0).try_cast("double")


def safe_int(value: Column | str) -> Column:
    """Whole part of a count given as text; bad or missing text counts as 0.

    A count too large for a bigint, infinity included, gives NULL so that the
    caller can reject the row. The text is used once: queries that filter on the
    result repeat the whole expression.
    """
    text = _digits(F.replace(_col(value).cast("string"), F.lit(","), F.lit("")))
    number = _number(text, f"{NUMBER}|{INFINITE}")
    return F.coalesce(number, F.lit(0.0)).try_cast("bigint")


def metric_text(value: Column | str) -> Column:
    """Counts such as ``1.2K``, ``3M`` or ``1,234``; anything else is 0."""
    text = F.upper(strip_spaces(F.coalesce(_col(value), F.lit(""))))

    def scaled(suffix: str, factor: int) -> Column:
        number = _number(_digits(F.replace(text, F.lit(suffix), F.lit(""))), NUMBER)
        return (number * factor).try_cast("bigint")

    whole = _digits(F.replace(text, F.lit(","), F.lit("")))
    parsed = (
        F.when(F.contains(text, F.lit("K")), scaled("K", 1000))
        .when(F.contains(text, F.lit("M")), scaled("M", 1000000))
        .otherwise(F.regexp_extract(whole, INTEGER, 0).try_cast("bigint"))
    )
    return F.coalesce(parsed, F.lit(0).cast("bigint"))


def _plain_count(text: Column, pattern: str) -> Column:
    return F.replace(F.regexp_extract(F.lower(text), pattern, 1), F.lit(","), F.lit(""))


def _first_found(candidates: Column, extract) -> Column:
    """First non-empty extraction over an array of candidate texts, else ''."""
    found = F.filter(F.transform(candidates, extract), lambda c: c != "")
    return F.coalesce(F.get(found, F.lit(0)), F.lit(""))


def likes_text(text: Column | str) -> Column:
    """Digits of ``1,234 likes``, commas removed; '' when there are none."""
    return F.coalesce(_plain_count(_col(text), LIKES), F.lit(""))


def comments_text(text: Column | str) -> Column:
    """Digits of ``View all 56 comments`` and similar; '' when there are none."""
    return F.coalesce(
        *[_blank_to_null(_plain_count(_col(text), p)) for p in COMMENTS], F.lit("")
    )


def first_likes(candidates: Column | str) -> Column:
    return _first_found(_col(candidates), likes_text)


def first_comments(candidates: Column | str) -> Column:
    return _first_found(_col(candidates), comments_text)


def short_hash(text: Column) -> Column:
    """First 16 hex digits of the MD5 of the UTF-8 text."""
    return F.substring(F.md5(text), 1, 16)


def instagram_post_id(page_url: Column | str, image_url: Column | str) -> Column:
    """Id from the ``/p/<id>/`` address, else an image file name with ``_``, else a hash."""
    image = _col(image_url)
    from_url = F.regexp_extract(F.coalesce(_col(page_url), F.lit("")), "/p/([^/]*)", 1)
    file_name = F.regexp_extract(image, r"([^/?]*)(?:\?[^/]*)?$", 1)
    return F.coalesce(
        _blank_to_null(from_url),
        F.when(F.contains(file_name, F.lit("_")), file_name),
        short_hash(image),
    )


def tweet_status_id(href: Column) -> Column:
    return F.regexp_extract(href, "/status/([0-9]+)", 1)


def _status_links(hrefs: Column | str) -> Column:
    return F.filter(
        F.coalesce(_col(hrefs), F.array().cast("array<string>")),
        lambda h: F.contains(h, F.lit("/status/")),
    )


def tweet_post_id(hrefs: Column | str, text: Column | str) -> Column:
    """First numeric status id among the links, else a hash of the text."""
    ids = F.filter(F.transform(_status_links(hrefs), tweet_status_id), lambda i: i != "")
    return F.coalesce(F.get(ids, F.lit(0)), short_hash(_col(text)))


def tweet_url(hrefs: Column | str) -> Column:
    """The link that gave the id, else the last status link; made absolute."""
    links = _status_links(hrefs)
    numeric = F.filter(links, lambda h: tweet_status_id(h) != "")
    href = F.coalesce(F.get(numeric, F.lit(0)), F.try_element_at(links, F.lit(-1)), F.lit(""))
    return F.when(href.startswith("/"), F.concat(F.lit("https://twitter.com"), href)).otherwise(
        href
    )


def author_from_href(href: Column | str) -> Column:
    """Last path segment of a profile link."""
    path = F.regexp_replace(F.coalesce(_col(href), F.lit("")), "^/+|/+$", "")
    return F.regexp_extract(path, "[^/]*$", 0)


def parse_timestamp(value: Column | str) -> Column:
    """Zone-less timestamp from ISO-like text; a numeric offset is converted to UTC.

    The date and time are parsed without a zone and the offset is subtracted, so
    the result does not depend on the session time zone. Other text gives NULL.
    """
    text = _col(value)
    date = F.regexp_extract(text, TIMESTAMP, 1)
    time = F.regexp_extract(text, TIMESTAMP, 2)
    zone = F.regexp_extract(text, TIMESTAMP, 3)
    naive = F.when(
        date != "", F.concat_ws(" ", date, F.when(time != "", time).otherwise("00:00"))
    ).try_cast("timestamp_ntz")
    signed = zone.rlike("^[+-]")
    sign = F.when(F.startswith(zone, F.lit("-")), -1).otherwise(1)
    hours = sign * F.substring(zone, 2, 2).try_cast("int")
    minutes = sign * F.right(zone, F.lit(2)).try_cast("int")
    return F.when(signed, naive - F.make_dt_interval(F.lit(0), hours, minutes)).otherwise(naive)


def utc(moment: Column) -> Column:
    """Zone-less UTC time of a TIMESTAMP, whatever the session time zone is."""
    local = moment.cast("timestamp").cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


def now() -> Column:
    return utc(F.current_timestamp())


def iso_text(moment: Column) -> Column:
    """ISO text of a zone-less timestamp."""
    return F.replace(moment.cast("string"), F.lit(" "), F.lit("T"))


def epoch_text(seconds: Column | str) -> Column:
    """ISO text (UTC) of epoch seconds; absent or 0 gives ''."""
    seconds = _col(seconds)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    whole = F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )
    text = iso_text(epoch + whole)
    return F.when(F.coalesce(seconds, F.lit(0.0)) != 0, text).otherwise("")


def image_extension(image_url: Column | str) -> Column:
    """Known extension of the last path segment, else jpg."""
    segment = F.regexp_extract(F.split_part(_col(image_url), F.lit("?"), F.lit(1)), "[^/]*$", 0)
    extension = F.lower(F.regexp_extract(segment, r"\.([^.]*)$", 1))
    return F.when(extension.isin(lx.IMAGE_EXTENSIONS), extension).otherwise("jpg")


def thumbnail_name(post_id: Column | str, image_url: Column | str) -> Column:
    """File name: the id reduced to letters, digits, ``_`` and ``-``, plus the extension."""
    safe_id = F.regexp_replace(_col(post_id), r"[^\p{L}\p{N}_-]", "")
    return F.concat(safe_id, F.lit("."), image_extension(image_url))

"""Literal input and expected output for every text, parsing and label function."""

from datetime import datetime

import pytest

from postloom.functions import labels, lexicon, parse, text


@pytest.mark.parametrize(
    "given, expected",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("a  b\t\nc ", "a b c"),
        ("a &amp; b", "a & b"),
        ("&amp;lt;", "<"),
        ("&lt;b&gt; &quot;x&quot; &#39;y&#39;", "<b> \"x\" 'y'"),
        ("a&#x200B;b", "ab"),
        ("‘a’ “b” – —", "'a' \"b\" - --"),
        ("a​b﻿c", "abc"),
        ("a b　c d", "a b c d"),
        ("a\x1cb\x85c d", "a b c d"),
        ("a ​ b", "a b"),
        ("&nbsp;", "&nbsp;"),
        ("  a \n", "a"),
    ],
)
def test_clean_post(values, given, expected):
    assert values(text.clean_post, [given]) == [expected]


def test_other_cleaners(values):
    given = ["a &amp; “b”​  c ™", None]
    assert values(text.clean_plain, given) == ['a &amp; "b" c ™', ""]
    assert values(text.clean_reddit, given) == ['a & "b"​ c ™', ""]
    assert values(text.clean_reddit, ["&quot;&#39;&#x200B;&lt;"]) == ["&quot;&#39;<"]


def test_hashtags(values):
    given = ["#One two #zwei_3, #日本語! a#b # c", "", None, "##x #é1"]
    assert values(text.hashtags, given) == [["One", "zwei_3", "日本語", "b"], [], [], ["x", "é1"]]
    assert values(text.remove_hashtags, given) == ["two , ! a# c", "", "", "#"]


def test_mentions_urls(values):
    assert values(text.mentions, ["@a b@c.d @Ünï_1", None]) == [["@a", "@c", "@Ünï_1"], []]
    assert values(text.mention_count, ["@a b@c.d @Ünï_1", None, "@ "]) == [3, 0, 0]
    urls = ["see https://x.y/z?q#f and www.a.b", "HTTP://x", None, "http://", " a http://b c "]
    assert values(text.url_count, urls) == [2, 0, 0, 0, 1]
    assert values(text.has_urls, urls) == [True, False, False, False, True]
    assert values(text.remove_urls, urls) == ["see  and", "HTTP://x", "", "http://", "a  c"]


def test_emoji_runs(values):
    given = ["hi 😊😊 x 日本😊 🤮 ❤️", "plain", None]
    assert values(text.emoji_runs, given) == [["😊😊", "日本😊", "❤️"], [], []]
    assert values(text.emoji_run_count, given) == [3, 0, 0]
    assert values(text.remove_emoji, given) == ["hi  x  🤮 ", "plain", ""]


def test_word_count(values):
    assert values(text.word_count, ["", "a", "a b c", None]) == [0, 1, 3, 0]


def test_normalize_hashtags(values):
    given = ["Spark, Data ,x,,SQL", "x", "x,ab", "ab,x", " , a , Bc\t", "", None, "x,y,z", "日本,語", "a b, c d"]
    assert values(text.normalize_hashtags, given) == [
        "spark,data,sql", "", "ab", "ab", "bc", "", "", "", "日本", "a b,c d",
    ]


def test_prepare_for_sentiment(values):
    given = ["Go “now” #Tag @me https://x.y 😊 ok", None]
    row, empty = values(text.prepare_for_sentiment, given)
    assert row.asDict() == {
        "cleaned_text": 'Go "now" 😊 ok',
        "hashtags": ["Tag"],
        "mentions": ["@me"],
        "has_urls": True,
        "emoji_count": 1,
    }
    assert empty.asDict() == {
        "cleaned_text": "", "hashtags": [], "mentions": [], "has_urls": False, "emoji_count": 0,
    }
    without = values(lambda c: text.prepare_for_sentiment(c, include_emojis=False), given)
    assert without[0]["cleaned_text"] == 'Go "now" ok'


@pytest.mark.parametrize(
    "given, expected",
    [
        (None, 0), ("", 0), ("5", 5), ("1,234", 1234), ("12.7", 12), ("-3.9", -3), ("abc", 0),
        ("12d", 0), ("1e3", 1000), ("1_000", 1000), ("1__0", 0), (" 7 ", 7), (" 7", 7),
        (".5", 0), ("5.", 5), ("+4", 4), ("nan", 0), ("inf", None), ("-Infinity", None),
        ("1e400", None), ("9e18", 9 * 10**18), ("1e19", None), ("0x10", 0), ("true", 0),
    ],
)
def test_safe_int(values, given, expected):
    assert values(parse.safe_int, [given]) == [expected]


def test_safe_int_of_numbers(values):
    assert values(parse.safe_int, [3, None, -8], "bigint") == [3, 0, -8]
    assert values(parse.safe_int, [3.9, -0.5], "double") == [3, 0]


@pytest.mark.parametrize(
    "given, expected",
    [
        (None, 0), ("", 0), ("1.2K", 1200), ("3m", 3000000), ("1,234", 1234), ("n/a", 0),
        ("12.5", 0), (" 15 ", 15), ("1,2K", 0), ("2.5B", 0), ("-4", -4), ("K", 0), ("1_0", 10),
    ],
)
def test_metric_text(values, given, expected):
    assert values(parse.metric_text, [given]) == [expected]


def test_likes_and_comments_text(values):
    likes = ["1,234 likes", "Liked by a and 56 others", "7 LIKE", "likes 9", None, "1,2,345like"]
    assert values(parse.likes_text, likes) == ["1234", "", "7", "", "", "12345"]
    comments = ["View all 56 comments", "1 comment", "1,000 Comments 2 comment", "none", None]
    assert values(parse.comments_text, comments) == ["56", "1", "1000", "", ""]
    several = [["x", "3 likes", "4 likes"], [], None]
    assert values(parse.first_likes, several, "array<string>") == ["3", "", ""]


def test_instagram_post_id(spark):
    rows = [
        ("https://i.example/p/ABC_1/?x", "https://c/1_2.jpg"),
        ("https://i.example/explore/", "https://c/12_34_n.jpg?a=b"),
        ("https://i.example/p//x", "https://c/raw.jpg"),
        (None, "https://c/a_b/raw?q=_"),
        (None, "https://c/raw?next=/x_y"),
    ]
    df = spark.createDataFrame(rows, "page string, image string")
    ids = [r[0] for r in df.select(parse.instagram_post_id("page", "image")).collect()]
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()[:16]
    assert ids == ["ABC_1", "12_34_n.jpg", md5(rows[2][1]), md5(rows[3][1]), "x_y"]


def test_tweet_links(spark):
    rows = [
        (["/a/photo", "/a/status/photo", "/b/status/12/x", "/c/status/13"], "t"),
        (["https://twitter.com/a/status/99"], "t"),
        (["/a/status/x", "/b/status/y"], "größe #x"),
        ([], ""),
        (None, "t"),
    ]
    df = spark.createDataFrame(rows, "hrefs array<string>, text string")
    got = df.select(parse.tweet_post_id("hrefs", "text"), parse.tweet_url("hrefs")).collect()
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()[:16]
    assert [tuple(r) for r in got] == [
        ("12", "https://twitter.com/b/status/12/x"),
        ("99", "https://twitter.com/a/status/99"),
        (md5("größe #x"), "https://twitter.com/b/status/y"),
        (md5(""), ""),
        (md5("t"), ""),
    ]


def test_author_from_href(values):
    assert values(parse.author_from_href, ["/user", "/a/b/", "https://x/u", "", None]) == [
        "user", "b", "u", "", "",
    ]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
        ("2024-01-02T03:04:05.25Z", "2024-01-02 03:04:05.250000"),
        ("2024-01-02T03:04:05+05:30", "2024-01-01 21:34:05"),
        ("2024-01-02T03:04:05-0800", "2024-01-02 11:04:05"),
        ("2024-01-02T03:04:05.5-00:30", "2024-01-02 03:34:05.500000"),
        ("2024-01-02 03:04:05", "2024-01-02 03:04:05"),
        ("2024-1-2 3:4:5", "2024-01-02 03:04:05"),
        ("2024-01-02T03:04:05.250", "2024-01-02 03:04:05.250000"),
        ("2024-01-02", "2024-01-02 00:00:00"),
        ("yesterday", None),
        ("2024", None),
        ("2024-13-01T00:00:00", None),
        ("2024-01-02T25:00:00", None),
        ("", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_timestamp(spark, values, given, expected, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        (got,) = values(parse.parse_timestamp, [given])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == (datetime.fromisoformat(expected) if expected else None)


def test_epoch_text(values):
    given = [0.0, None, 1700000000.0, 1700000000.5]
    assert values(parse.epoch_text, given, "double") == [
        "", "", "2023-11-14T22:13:20", "2023-11-14T22:13:20.5",
    ]


def test_thumbnail_name(spark):
    rows = [
        ("a/b:c_1-é", "https://h/x.PNG?w=1"),
        ("p1", "https://h/x.tar.webp"),
        ("p1", "https://h.com/raw"),
        ("p1", "https://h/x.svg"),
        ("p1", "https://h/x.?y.png"),
    ]
    df = spark.createDataFrame(rows, "id string, url string")
    names = [r[0] for r in df.select(parse.thumbnail_name("id", "url")).collect()]
    assert names == ["abc_1-é.png", "p1.webp", "p1.jpg", "p1.jpg", "p1.jpg"]


@pytest.mark.parametrize(
    "given, expected",
    [
        (None, "neutral"), ("", "neutral"), ("LOVE it", "positive"), ("love love bad", "neutral"),
        ("good bad awful", "negative"), ("lovely", "neutral"), ("well-loved", "positive"),
        ("good_bad", "neutral"), ("😊", "positive"), ("😊😊", "neutral"), ("😊 😊 bad", "positive"),
        ("❤️", "positive"), ("🤮", "neutral"), ("日本😊", "neutral"), ("😡", "negative"),
        ("bad😊", "neutral"), ("great 😭 😡", "negative"),
    ],
)
def test_sentiment_words(values, given, expected):
    assert values(labels.sentiment_words, [given]) == [expected]


@pytest.mark.parametrize(
    "given, expected",
    [
        (None, "neutral"), ("lovely", "positive"), ("badger", "negative"), ("🤮", "negative"),
        ("😊😊 sadly", "neutral"), ("GOODBYE", "positive"), ("thanks", "positive"),
    ],
)
def test_sentiment_substrings(values, given, expected):
    assert values(labels.sentiment_substrings, [given]) == [expected]


def test_engagement(spark):
    rows = [
        ("instagram", 499, 0), ("instagram", 500, 0), ("instagram", 4997, 1), ("youtube", 99999, 0),
        ("youtube", 0, 33334), ("reddit", 97, 1), ("reddit", 1000, 0), ("other", 100, 0),
        (None, 10000, 0), ("twitter", None, None), ("twitter", 2**62, 2**62),
    ]
    df = spark.createDataFrame(rows, "platform string, likes long, comments long")
    got = df.select(labels.engagement_etl(), labels.engagement_labeler()).collect()
    assert [r[0] for r in got] == [
        "low", "medium", "high", "high", "viral", "medium", "high", "medium", "viral", "low", "viral",
    ]
    assert [r[1] for r in got] == [
        "medium", "medium", "high", "high", "high", "low", "high", "medium", "viral", "low", "viral",
    ]


def test_lexicons_are_disjoint():
    # The score counts every hit that is not positive as negative.
    assert not set(lexicon.POSITIVE_WORDS) & set(lexicon.NEGATIVE_WORDS)
    assert len(set(lexicon.POSITIVE_WORDS)) == 31 and len(set(lexicon.NEGATIVE_WORDS)) == 35


def test_times_that_are_not_iso_give_null(values):
    bad = ["2024-1-5", "2024-01-05T9:5", "2024-01-05T09:05:00+99:99", "2024-01-05\n", "2024-01-05T09:05:00+05:75"]
    assert values(parse.parse_timestamp, bad) == [None] * 5
    good = values(parse.parse_timestamp, ["2024-1-5 9:5:7", "2024-01-05", "2024-01-05T09:05", "2024-01-05T09:05:00-02:30"])
    assert [str(g) for g in good] == ["2024-01-05 09:05:07", "2024-01-05 00:00:00", "2024-01-05 09:05:00", "2024-01-05 11:35:00"]


def test_texts_without_typography_are_not_replaced(spark):
    """Texts are looked through for typography first, and whitespace classes are not tried on a single space."""
    cleaned = text.clean_post("post_text")._jc.toString()
    assert "contains(coalesce(post_text, ''), '\u2019')" in cleaned and "(?! ?[!-~])" in cleaned


def test_cleaning_of_mixed_whitespace_and_typography(values):
    given = ["a  b", " a \t b\n", "a\u3000\u00a0b", "日本 x", "é \u2014 é", "a \u2028 \u0085b", "\u200b", "a \u200b b", "&amp;#x200B; ", " ", "!\x1c!", "a &lt;\u2019 b"]
    expected = ["a b", "a b", "a b", "日本 x", "é -- é", "a b", "", "a b", "", "", "! !", "a <' b"]
    assert values(text.clean_post, given) == expected

"""Captured payload files through the readers."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from postloom.sources.captures import READERS, read_all, read_posts


@pytest.fixture
def as_of(spark):
    return F.lit("2024-02-01 12:30:00").cast("timestamp_ntz")


def write(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")


def rows_by_id(df):
    return {r["post_id"]: r.asDict() for r in df.collect()}


def child(**fields):
    return {"data": fields}


def test_reddit(spark, tmp_path, as_of):
    first = [
        child(
            id="a1", title="Title “x” &amp; y", selftext="body\n\n text", thumbnail="https://t/1.jpg",
            preview={"images": [{"source": {"url": "https://p/1?a=1&amp;b=2"}}]},
            link_flair_text="News", created_utc=1700000000.0, score=5, num_comments=2,
            author="bob", subreddit="sub", permalink="/r/sub/1", upvote_ratio=0.9,
        ),
        child(id="", title="dropped"),
        child(id="a2", title="only title", thumbnail="self", created_utc=0),
    ]
    second = [child(id="a3", selftext="only body", thumbnail="https://t/3.jpg", preview={"images": []})]
    write(tmp_path / "r" / "pages.json", [
        {"page_no": 0, "data": {"after": "t3", "children": first}},
        {"page_no": 1, "data": {"children": second}},
        {"page_no": 2, "data": {"children": []}},
    ])
    posts = read_posts(spark, "reddit", str(tmp_path / "r"), as_of=as_of)
    got = rows_by_id(posts)
    assert set(got) == {"a1", "a2", "a3"}
    a1 = got["a1"]
    assert a1["post_text"] == 'Title "x" & y\n\nbody text'
    assert a1["image_url"] == "https://p/1?a=1&b=2"
    assert (a1["hashtags"], a1["timestamp"]) == ("News", "2023-11-14T22:13:20")
    assert (a1["likes"], a1["comments"], a1["upvote_ratio"]) == ("5", "2", 0.9)
    assert (a1["url"], a1["author"]) == ("https://reddit.com/r/sub/1", "bob")
    assert a1["scraped_at"] == "2024-02-01T12:30:00"
    a2 = got["a2"]
    assert (a2["post_text"], a2["image_url"], a2["timestamp"]) == ("only title", "", "")
    assert (a2["author"], a2["likes"], a2["url"]) == ("[deleted]", "0", "https://reddit.com")
    assert (got["a3"]["post_text"], got["a3"]["image_url"]) == ("only body", "https://t/3.jpg")
    limited = read_posts(spark, "reddit", str(tmp_path / "r"), limit=2, as_of=as_of)
    assert [r["post_id"] for r in limited.orderBy("seq").collect()] == ["a1", "a2"]


def thumbnails(*sizes):
    return {s: {"url": f"https://{s}"} for s in sizes}


def detail(title, thumbs, **statistics):
    snippet = {
        "title": title, "description": "watch #this now  #that", "channelTitle": " Ch  One ",
        "channelId": "c1", "publishedAt": "2024-01-05T10:00:00Z", "thumbnails": thumbs,
    }
    return {"snippet": snippet, "statistics": statistics, "contentDetails": {"duration": "PT1M"}}


def test_youtube(spark, tmp_path, as_of):
    hit = lambda v, kind="youtube#video": {"id": {"kind": kind, "videoId": v}}
    write(tmp_path / "y" / "search" / "p.json", [
        {"page_no": 0, "nextPageToken": "n", "items": [hit("v1"), hit("x", "youtube#channel"), hit("gone")]},
        {"page_no": 1, "items": [hit("v2"), hit("empty")]},
    ])
    no_statistics = detail("Two", thumbnails("default"))
    del no_statistics["statistics"]
    write(tmp_path / "y" / "details" / "d.json", [
        {"video_id": "v1", "items": [detail("One", thumbnails("standard", "medium"), likeCount="7", viewCount="3000000000")]},
        {"video_id": "v2", "items": [no_statistics]},
        {"video_id": "empty", "items": []},
    ])
    got = rows_by_id(read_posts(spark, "youtube", str(tmp_path / "y"), as_of=as_of))
    assert set(got) == {"v1", "v2"}
    v1 = got["v1"]
    assert v1["post_text"] == "One\n\nwatch now"
    assert (v1["hashtags"], v1["image_url"]) == ("this,that", "https://medium")
    assert (v1["likes"], v1["comments"], v1["view_count"]) == ("7", "", "3000000000")
    assert (v1["author"], v1["duration"], v1["channel_id"]) == ("Ch One", "PT1M", "c1")
    assert v1["url"] == "https://www.youtube.com/watch?v=v1"
    assert (got["v2"]["likes"], got["v2"]["image_url"]) == ("", "https://default")


def test_instagram(spark, tmp_path, as_of):
    base = {"page_no": 0, "author_text": " me ", "likes_texts": ["by x", "1,234 likes"],
            "comments_texts": ["View all 56 comments"], "image_src": "https://c/raw.jpg"}
    write(tmp_path / "i" / "c.json", [
        {**base, "pos": 0, "page_url": "https://i/p/ID1/", "caption_candidates": ["hi", "A “long” #One caption"],
         "time_datetime": "2024-01-05T10:00:00.000Z"},
        {**base, "pos": 1, "page_url": "https://i/p/ID1/", "caption_candidates": ["a later capture"]},
        {**base, "pos": 2, "image_src": "https://c/12_3.jpg?x", "time_text": "3 days ago"},
        {**base, "pos": 3, "likes_texts": [], "comments_texts": None},
        {"page_no": 0, "pos": 4, "page_url": "https://i/p/NOIMAGE/"},
    ])
    got = rows_by_id(read_posts(spark, "instagram", str(tmp_path / "i"), as_of=as_of))
    hashed = hashlib.md5(b"https://c/raw.jpg").hexdigest()[:16]
    assert set(got) == {"ID1", "12_3.jpg", hashed}
    one = got["ID1"]
    assert (one["post_text"], one["hashtags"]) == ('A "long" caption', "One")
    assert (one["likes"], one["comments"], one["author"]) == ("1234", "56", "me")
    assert one["timestamp"] == "2024-01-05T10:00:00.000Z"
    assert got["12_3.jpg"]["timestamp"] == "3 days ago"
    assert got[hashed]["timestamp"] == "2024-02-01T12:30:00"
    assert (got[hashed]["likes"], got[hashed]["comments"], got[hashed]["url"]) == ("", "", None)


def test_tweets(spark, tmp_path, as_of):
    write(tmp_path / "t" / "c.json", [
        {"page_no": 0, "pos": 0, "text": "Hello #World  “q”", "author_href": "/bob",
         "status_hrefs": ["/bob/status/77/photo"], "time_datetime": "2024-01-05T10:00:00.000Z",
         "like_text": "1.2K", "retweet_text": "3M", "reply_text": "12", "media_src": "https://m/1"},
        {"page_no": 1, "pos": 0, "text": "again", "status_hrefs": ["https://twitter.com/bob/status/77"]},
        {"page_no": 1, "pos": 1, "text": "no #link", "status_hrefs": []},
    ])
    got = rows_by_id(read_posts(spark, "twitter", str(tmp_path / "t"), as_of=as_of))
    hashed = hashlib.md5(b"no #link").hexdigest()[:16]
    assert set(got) == {"77", hashed}
    first = got["77"]
    assert (first["post_text"], first["hashtags"]) == ('Hello "q"', "World")
    assert (first["likes"], first["retweet_count"], first["comments"]) == ("1200", "3000000", "12")
    assert (first["url"], first["author"]) == ("https://twitter.com/bob/status/77/photo", "bob")
    assert (got[hashed]["post_text"], got[hashed]["url"], got[hashed]["likes"]) == ("no", "", "0")


def test_read_all_and_unknown(spark, tmp_path, as_of):
    write(tmp_path / "t" / "c.json", [{"page_no": 0, "pos": 0, "text": "a", "status_hrefs": []}])
    write(tmp_path / "r" / "p.json", [{"page_no": 0, "data": {"children": [child(id="x", title="t")]}}])
    posts = read_all(spark, {"twitter": str(tmp_path / "t"), "reddit": str(tmp_path / "r")}, as_of=as_of)
    assert sorted(r["platform"] for r in posts.collect()) == ["reddit", "twitter"]
    assert set(READERS) == {"reddit", "youtube", "instagram", "twitter"}
    with pytest.raises(ValueError):
        read_posts(spark, "other", str(tmp_path))


def test_captures_reach_the_table(spark, tmp_path, as_of):
    from postloom.operators.table import PostsTable
    from postloom.operators.run import run_load

    write(tmp_path / "r" / "p.json", [
        {"page_no": 0, "data": {"children": [child(id="x", title="I love it", score=20000, created_utc=1700000000)]}},
    ])
    table = PostsTable(spark, str(tmp_path / "table"))
    metrics = run_load(read_posts(spark, "reddit", str(tmp_path / "r"), as_of=as_of), table, as_of)
    assert (metrics["input_count"], metrics["transformed_count"], metrics["loaded_count"]) == (1, 1, 1)
    assert metrics["sentiment"] == {"positive": 1, "negative": 0, "neutral": 0}
    (row,) = table.posts().collect()
    assert (row["likes"], row["engagement_level"], row["sentiment_label"]) == (20000, "viral", "positive")
    assert row["timestamp"] == datetime(2023, 11, 14, 22, 13, 20)
    assert row["scraped_at"] == row["processed_at"] == datetime(2024, 2, 1, 12, 30)


def test_payloads_as_delivered(spark, tmp_path):
    from postloom.sources.captures import read_all, read_reddit

    folder = tmp_path / "listing"
    folder.mkdir()
    listed = lambda *ids: json.dumps({"data": {"children": [{"data": {"id": i, "title": i}} for i in ids]}})
    (folder / "b.json").write_text(listed("c"))
    (folder / "a.json").write_text(listed("a", "b"))
    rows = sorted((r["seq"], r["post_id"]) for r in read_reddit(spark, str(folder)).collect())
    assert [r[1] for r in rows] == ["a", "b", "c"] and len({r[0] for r in rows}) == 3
    both = read_all(spark, {"reddit": str(folder), "twitter": _tweets(tmp_path)})
    ids = [r["seq"] for r in both.collect()]
    assert len(ids) == len(set(ids)) == 4
    (folder / "c.json").write_text(listed("d") + "\n" + listed("e"))
    with pytest.raises(Exception, match="several payloads"):
        read_reddit(spark, str(folder)).collect()
    (folder / "c.json").write_text('{"data": {"children": [')
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        read_reddit(spark, str(folder)).collect()


def _tweets(tmp_path):
    path = tmp_path / "tweets"
    path.mkdir()
    (path / "t.json").write_text(json.dumps({"page_no": 0, "pos": 0, "text": "hi", "status_hrefs": ["/bob/status/1"]}))
    return str(path)


def test_order_of_twelve_folders_and_far_pages(spark, tmp_path):
    """Pages beyond 2**24 in twelve folders keep page, position and folder order, also for a limit."""
    far = 1 << 40
    folders = {}
    for i in range(12):
        rows = [{"page_no": far + 3 - k, "pos": 1 << 21, "text": f"t{i}-{k}", "status_hrefs": [f"/b/status/{i}{k}"]} for k in range(3)]
        write(tmp_path / str(i) / "c.json", rows)
        folders[f"twitter:{i}"] = str(tmp_path / str(i))
    posts = read_all(spark, folders)
    got = [(r["seq"]["page"], r["seq"]["pos"], r["seq"]["source"], r["post_id"]) for r in posts.orderBy("seq").collect()]
    assert got == sorted(got) and len({g[:3] for g in got}) == 36
    assert got[0] == (far + 1, 1 << 21, 0, "02") and got[11] == (far + 1, 1 << 21, 11, "112")
    first = read_posts(spark, "twitter", folders["twitter:5"], limit=2)
    assert sorted(r["post_id"] for r in first.collect()) == ["51", "52"]


def test_bad_lines_are_left_out_or_raise(spark, tmp_path):
    from postloom.sources.captures import refused_lines

    folder = tmp_path / "t"
    folder.mkdir()
    good_line = json.dumps({"page_no": 0, "pos": 0, "text": "hi", "status_hrefs": ["/bob/status/1"]})
    lines = [good_line, '{"page_no": 1, "pos"', "", '{"page_no": "x", "pos": 2}', "  [1]", "7", '"{}"']
    (folder / "a.json").write_text("\n".join(lines))
    path = str(folder)
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        read_posts(spark, "twitter", path).collect()
    assert [r["post_id"] for r in read_posts(spark, "twitter", path, bad_lines="refuse").collect()] == ["1"]
    refused = {r["line"]: r["reason"] for r in refused_lines(spark, "twitter", path).collect()}
    assert refused == {
        lines[1]: "not JSON", lines[3]: "a field does not fit its type", "  [1]": "not a JSON object",
        "7": "not a JSON object", '"{}"': "not a JSON object",
    }
    assert all(r["file"].endswith("a.json") for r in refused_lines(spark, "twitter", path).collect())
    with pytest.raises(ValueError):
        read_posts(spark, "twitter", path, bad_lines="ignore")
    # Payloads without a page number are numbered by file in this lane as well.
    (folder / "b.json").write_text(json.dumps({"pos": 0, "text": "b", "status_hrefs": ["/bob/status/2"]}))
    both = read_posts(spark, "twitter", path, bad_lines="refuse")
    assert sorted((r["post_id"], r["seq"]["page"]) for r in both.collect()) == [("1", 0), ("2", 0)]

"""Listings, search, preview, SQL, analytics bundles."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from postloom.operators import analytics, listing
from postloom.schema import POSTS
from conftest import rows_read


@pytest.fixture(scope="module")
def posts(spark):
    data = [
        (1, "a", "reddit", "Hello World", 5, "bob", "positive", "low", "x, y"),
        (2, "b", "reddit", "100% sure_thing", None, None, None, "low", ""),
        (3, "c", "twitter", r"back\slash hello", 9, "[deleted]", "negative", "high", None),
        (4, "d", "twitter", "t" * 40, 9, "a_very_long_author", "positive", "low", "x,,y"),
        (5, "e", "youtube", None, 1, "", "neutral", None, "x"),
    ]
    names = ["id", "post_id", "platform", "post_text", "likes", "author", "sentiment_label", "engagement_level", "hashtags"]
    filled = [tuple(dict(zip(names, row)).get(f.name) for f in POSTS) for row in data]
    return spark.createDataFrame(filled, POSTS).cache()


def ids(df):
    return "".join(r["post_id"] for r in df.collect())


def test_get_posts(posts):
    assert ids(listing.get_posts(posts, order_by="likes DESC")) == "cdaeb"
    assert ids(listing.get_posts(posts, order_by="likes ASC")) == "eacdb"
    assert ids(listing.get_posts(posts, order_by="platform, likes desc")) == "abcde"
    assert ids(listing.get_posts(posts, "twitter", order_by="likes")) == "cd"
    assert ids(listing.get_posts(posts, "", limit=2, offset=1, order_by="likes DESC")) == "da"
    for bad in ("nothing", "likes SIDEWAYS", "likes; DROP"):
        with pytest.raises(ValueError):
            listing.get_posts(posts, order_by=bad)


def test_deep_page_equals_top_k(posts):
    def pages(top_k_rows):
        return [
            ids(listing.get_posts(posts, platform, 2, offset, order_by, top_k_rows))
            for platform in (None, "reddit")
            for order_by in ("likes DESC", "platform, likes", "post_id DESC")
            for offset in range(6)
        ]

    assert pages(0) == pages(1000)


def test_search(posts):
    assert ids(listing.search(posts, "hello")) == "ca"
    assert ids(listing.search(posts, "HELLO", limit=1)) == "c"
    assert ids(listing.search(posts, "k\\s")) == "c"
    assert ids(listing.search(posts, "e_thing")) == "b"
    assert ids(listing.search(posts, "1%g")) == "b"
    assert ids(listing.search(posts, "'; --")) == ""


def test_preview(posts):
    rows = listing.preview(listing.get_posts(posts, order_by="likes DESC"), 3).collect()
    assert [r["row"] for r in rows] == [1, 2, 3]
    assert rows[1]["content"] == "t" * 35 + "..." and rows[1]["author"] == "a_very_long_"
    ordered = listing.get_posts(posts, order_by="likes DESC")
    assert [r["more"] for r in listing.preview_more(ordered, 3).collect()] == ["+2 more"]
    assert listing.preview_more(ordered, 5).collect() == []


def test_sql(spark, posts):
    sql = "SELECT post_id FROM posts WHERE platform = ? AND likes > ?"
    assert ids(listing.query(spark, posts, sql, ["reddit", 1])) == "a"
    assert listing.query(spark, posts, "SELECT count(*) FROM posts").collect()[0][0] == 5
    with pytest.raises(AnalysisException):
        listing.query(spark, posts, "SELECT nothing FROM posts")


def test_sql_leaves_the_session_alone(spark, posts):
    spark.range(3).createOrReplaceTempView("posts")
    try:
        found = listing.query(spark, posts, "WITH few AS (SELECT * FROM posts WHERE likes > 1) SELECT count(*) AS n FROM few")
        assert spark.table("posts").count() == 3
        assert found.collect()[0]["n"] == 3
        with pytest.raises(AnalysisException):
            listing.query(spark, posts, "SELECT nothing FROM posts")
        assert spark.table("posts").count() == 3
    finally:
        spark.catalog.dropTempView("posts")
    listing.query(spark, posts, "SELECT 1 FROM posts")
    assert not spark.catalog.tableExists("posts")


def test_functions_in_sql(spark):
    """Every function gives in SQL what its expression gives, for odd values too."""
    from postloom.functions import labels, parse, sql, text

    values = [
        None, "", "a  &amp;lt; “b” #Tag1 @me", "love 😊 awful", "1,234", "1.2K", "inf", "12.7", "2024-01-02T03:04:05+05:30", "https://x/a.PNG?b",
        "it's \\ \"q\" %d \n line", "/p/ID1/", "View all 56 comments, 7 likes", " Tag , x,,Zwei ", "日本😊", "/bob/status/12",
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").withColumns(
        {"n": (F.col("i") * 997).cast("bigint"), "d": F.col("i") * 1.5, "a": F.array("v", F.lit("9 likes")), "p": F.lit("reddit")}
    )
    columns = {"bigint": "n", "double": "d", "string": "v"}
    assert sorted(sql.register(spark)) == sorted(sql.NAMES)
    for name, (parameters, make) in sql.FUNCTIONS.items():
        given = ["p" if p == "platform" else columns[k] for p, k in parameters.items()]
        both = df.selectExpr("*", f"{name}({', '.join(given)}) AS called").withColumn("made", make(*[F.col(g) for g in given]))
        assert both.filter("NOT (called <=> made)").count() == 0, name
    arrays = {
        "first_likes(a)": parse.first_likes("a"), "first_comments(a)": parse.first_comments("a"),
        "tweet_post_id(a, v)": parse.tweet_post_id("a", "v"), "tweet_url(a)": parse.tweet_url("a"),
    }
    for call, made in arrays.items():
        assert df.selectExpr("*", f"{call} AS called").withColumn("made", made).filter("NOT (called <=> made)").count() == 0, call
    assert text.clean_post and labels.sentiment_words
    assert sql.register_used(spark, "SELECT Clean_Post(x), lower(y) FROM posts") == []


def test_a_chain_of_pages_is_the_sorted_table(spark, tmp_path):
    """100 pages by key, over ties and NULLs, each reading no more than the row groups behind it."""
    data = spark.range(2000).selectExpr(
        "id", "if(id % 50 = 0, null, concat('p', id % 700)) AS post_id", "concat('x', id % 3) AS platform",
        "if(id % 40 = 0, null, id * 7919 % 300) AS likes", "'t' AS post_text",
    )
    for order, size in (("likes DESC", 20), ("likes ASC", 250), ("platform, likes DESC", 250)):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files of so few rows
        try:
            path = listing.write_in_order(data, str(tmp_path / order.replace(" ", "-")), order)
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        posts = spark.read.parquet(path)
        expected = [r["id"] for r in listing.get_posts(posts, limit=2000, order_by=order).collect()]
        found, last = [], None
        for number in range(2000 // size + 1):
            page = listing.posts_after(posts, last, limit=size, order_by=order)
            rows = page.collect()
            if number == 2000 // size - 1 and order.startswith("likes"):
                assert rows_read(page) < 2000 * 0.6
            found += [r["id"] for r in rows]
            last = rows[-1] if rows else last
        assert found == expected
    assert listing.posts_after(posts, last, limit=20, order_by=order).collect() == []
    one = listing.posts_after(posts, {"likes": 5, "platform": "x1", "post_id": None, "id": 0}, "x1", 3, "likes DESC").collect()
    assert len(one) == 3 and all(r["platform"] == "x1" and r["likes"] <= 5 for r in one)
    with pytest.raises(ValueError):
        listing.posts_after(posts.drop("id"), None)


def test_a_page_does_not_read_whole_rows_to_break_ties(spark, tmp_path):
    """The deep page sorts and stores keys alone; a top-k hashes no text where there is an id."""
    path = str(tmp_path / "p")
    spark.range(100).selectExpr("id", "string(id) AS post_id", "'x' AS platform", "id % 5 AS likes", "repeat('t', 50) AS post_text").write.parquet(path)
    posts = spark.read.parquet(path)
    assert "xxhash64" not in listing.top_posts_by_likes(posts, 5)._jdf.queryExecution().executedPlan().toString()
    deep = listing.get_posts(posts, limit=10, offset=50, order_by="likes DESC", top_k_rows=1)
    assert deep.collect() == listing.get_posts(posts, limit=10, offset=50, order_by="likes DESC").collect()


def test_analytics(posts):
    assert [tuple(r) for r in analytics.by_platform(posts).collect()] == [
        ("reddit", 2, 40.0), ("twitter", 2, 40.0), ("youtube", 1, 20.0),
    ]
    assert [tuple(r) for r in analytics.sentiment_distribution(posts).collect()] == [
        ("positive", 2, 50.0), ("negative", 1, 25.0), ("neutral", 1, 25.0),
    ]
    assert [tuple(r) for r in analytics.sentiment_distribution(posts, "twitter").collect()] == [
        ("negative", 1, 50.0), ("positive", 1, 50.0),
    ]
    assert [tuple(r) for r in analytics.engagement_distribution(posts).collect()] == [
        ("low", 3, 75.0), ("high", 1, 25.0),
    ]
    assert [tuple(r) for r in analytics.top_authors(posts).collect()] == [
        ("", 1), ("a_very_long_author", 1), ("bob", 1),
    ]
    assert [tuple(r) for r in analytics.top_hashtags(posts).collect()] == [("x", 3), ("y", 2)]
    assert analytics.date_range(posts).collect() == []
    assert analytics.total_posts(posts).collect()[0][0] == 5


def test_bundles(posts):
    bundle = analytics.stats(posts)
    rows = {(r["section"], r["name"]): r["count"] for r in bundle["counts"].collect()}
    assert rows == {
        ("total", None): 5, ("by_platform", "reddit"): 2, ("by_platform", "twitter"): 2,
        ("by_platform", "youtube"): 1, ("by_sentiment", "positive"): 2,
        ("by_sentiment", "negative"): 1, ("by_sentiment", "neutral"): 1,
    }
    board = analytics.dashboard(posts)
    assert {name: df.count() for name, df in board.items()} == {
        "overview": 1, "by_platform": 3, "sentiment": 3, "engagement": 2, "top_hashtags": 2, "top_authors": 3,
    }


def test_most_frequent_of_very_many(spark):
    """A million distinct tags: exact, shuffling candidates only, in one round if the bound allows."""
    from postloom.operators import frequent

    posts = spark.range(0, 1_400_000, 1, 8).selectExpr(
        "if(id < 1000000, concat('t', id), concat('h', (id * id) % 997 % 31)) AS hashtags",
        "if(id % 5 = 0, null, if(id % 7 = 0, '[deleted]', concat('a', id % 9))) AS author",
    )
    expected = analytics.top_hashtags(posts, 12).collect()
    found = frequent.top_hashtags(posts, 12)
    assert found.collect() == expected
    assert "counted-" in str(found.inputFiles())  # the sketch decided
    assert frequent.top_authors(posts, 4).collect() == analytics.top_authors(posts, 4).collect()
    # A sketch that is too small, and ties between very many, need further rounds or the grouping.
    assert frequent.top_hashtags(posts, 12, tracked=16).collect() == expected
    assert frequent.top_hashtags(posts, 40, tracked=1024).collect() == analytics.top_hashtags(posts, 40).collect()
    assert frequent.top_hashtags(posts.limit(0), 3).collect() == []


def test_the_recount_shuffles_candidates_only(spark, tmp_path):
    from postloom.operators import frequent

    path = str(tmp_path / "items")
    spark.range(100_000).selectExpr("if(id % 2 = 0, 'hot', concat('t', id)) AS hashtag").write.parquet(path)
    items = spark.read.parquet(path)
    candidates = frequent._candidates(items, "hashtag", 64).collect()
    assert [r["hashtag"] for r in candidates] == ["hot"] and candidates[0]["rows"] == 100_000


def test_the_dashboard_reads_its_input_twice(spark, posts, tmp_path):
    path = str(tmp_path / "posts")
    posts.write.parquet(path)
    board = analytics.dashboard(spark.read.parquet(path))
    stored = [n for n, df in board.items() if path in str(df.inputFiles())]
    assert stored == ["top_hashtags"]
    assert {n: sorted(map(tuple, df.collect()), key=repr) for n, df in board.items()} == {
        "overview": [(5, None, None)],
        "by_platform": [("reddit", 2, 40.0), ("twitter", 2, 40.0), ("youtube", 1, 20.0)],
        "sentiment": [("negative", 1, 25.0), ("neutral", 1, 25.0), ("positive", 2, 50.0)],
        "engagement": [("high", 1, 25.0), ("low", 3, 75.0)],
        "top_hashtags": [("x", 3), ("y", 2)],
        "top_authors": [("", 1), ("a_very_long_author", 1), ("bob", 1)],
    }


def test_pages_of_rows_without_or_with_repeated_keys(spark):
    data = [(1, None, "x"), (2, "p", "x"), (3, "p", "x"), (4, "p", "x"), (5, None, None), (6, "q", "x")]
    posts = spark.createDataFrame(data, "id long, post_id string, platform string").withColumn("likes", F.lit(1))
    page = lambda offset, rows: [r["id"] for r in listing.get_posts(posts, None, 2, offset, "likes DESC", rows).collect()]
    assert [page(o, 0) for o in (0, 2, 4)] == [page(o, 100) for o in (0, 2, 4)]
    assert sorted(sum((page(o, 0) for o in (0, 2, 4)), [])) == [1, 2, 3, 4, 5, 6]

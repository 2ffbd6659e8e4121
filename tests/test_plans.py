"""What the physical plans contain. test_oracles.py checks every plan for Python and cross joins."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from postloom.operators import analytics, load
from postloom.operators.table import PostsTable
from postloom.operators.transform import transform_posts
from postloom.plans import inputs, payloads
from postloom.operators.skew import join_spread
from postloom.sources import captures

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, sf_dir, tmp_path_factory):
    stored = PostsTable(spark, str(tmp_path_factory.mktemp("plans") / "posts"))
    stored.load(transform_posts(inputs.captured(spark, sf_dir)))
    return stored


@pytest.mark.parametrize("name", ["get_posts_page", "top_posts_by_likes", "search_posts", "top_authors",
                                  "author_avg_likes", "top_hashtags", "capture_limit"])
def test_top_k(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan(entry.queries()[name](spark, sf_dir))


def test_pushdown(table):
    posts = table.posts()
    pruned = plan(analytics.sentiment_distribution(posts, "reddit"))
    assert "EqualTo(platform,reddit)" in pruned and "IsNotNull(sentiment_label)" in pruned
    assert "ReadSchema: struct<platform:string,sentiment_label:string>" in pruned
    authors = plan(analytics.author_average_likes(posts, "reddit"))
    assert "ReadSchema: struct<platform:string,likes:bigint,author:string>" in authors


def test_one_scan_for_all_counts(table):
    assert plan(analytics.stats_bundle(table.posts())).count("FileScan") == 1


def test_unread_columns_are_not_merged(spark, sf_dir):
    """Counting per platform neither cleans texts nor carries them through the collapse."""
    text = plan(analytics.by_platform(inputs.posts(spark, sf_dir)))
    assert "min_by" not in text and "SortAggregate" not in text
    assert "text" not in text.split("documents.parquet")[-1]


def test_hot_key_is_combined_before_the_shuffle(spark, sf_dir):
    """Half the rows share one key: at most one row per map task reaches the merge."""
    raw = inputs.captured(spark, sf_dir).withColumn(
        "post_id", F.when(F.col("seq") % 2 == 0, "hot").otherwise(F.col("post_id"))
    ).withColumn("platform", F.lit("reddit"))
    batch = load.to_batch(transform_posts(raw), 0)
    text = plan(batch)
    assert text.count("partial_min_by(post_text") == 1
    row = batch.filter("post_id = 'hot'").collect()
    assert len(row) == 1 and row[0]["first_at"]["page"] == 0 and row[0]["last_at"]["page"] == 998


def test_first_occurrence_join_spreads_a_hot_key(spark, sf_dir):
    """Rows of one key are joined back on key and sequence number, not on the key alone."""
    raw = inputs.captured(spark, sf_dir).select("seq", "post_id", "platform")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(load.validate_load(raw, raw.select("post_id", "platform")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" not in text
    assert "SortMergeJoin [post_id" in text and "seq" in text.split("SortMergeJoin")[1][:60]


def test_hot_video_is_spread(spark):
    """Rows of a hot key reach the join under many salts and are all kept."""
    hits = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), (F.col("id") % 3000).cast("string")))
        .alias("video_id"),
        F.col("id").alias("page_no"), F.lit(0).alias("pos"),
    )
    details = hits.select("video_id").distinct().withColumn("title", F.concat(F.lit("t-"), "video_id"))
    details = details.filter("video_id <> 'v1'")
    joined = join_spread(hits, details, "video_id", ["page_no", "pos"], hot_rows=100)
    plain = hits.join(details, "video_id")
    assert sorted(joined.collect()) == sorted(plain.select(*joined.columns).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(join_spread(hits, details, "video_id", ["page_no", "pos"], hot_rows=100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [video_id" in text and "_salt" in text.split("SortMergeJoin")[1][:40]


def test_collapse_after_the_detail_join_combines_first(spark, sf_dir):
    pages, responses = payloads.youtube_pages(spark, sf_dir), payloads.youtube_responses(spark, sf_dir)
    batch = load.to_batch(transform_posts(captures.youtube_posts(pages, responses)), 0)
    assert "partial_min_by" in plan(batch)

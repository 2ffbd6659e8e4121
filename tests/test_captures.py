"""Registered queries that write captures, over small tables of their own."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from postloom.operators.table import PostsTable
from postloom.operators.transform import transform_posts
from postloom.plans import queries


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    n = F.col("id")
    kinds = F.element_at(F.split(F.lit("signup|view|error|purchase|click"), r"\|"), (n % 5 + 1).cast("int"))
    events = spark.range(120).select(
        n.alias("event_id"), F.lit("2024-01-05 10:00:00").cast("timestamp_ntz").alias("ts"), (n % 9).alias("user_id"), kinds.alias("event_type")
    )
    events.write.parquet(f"{folder}/events.parquet")
    spark.range(12).select(n.alias("doc_id"), F.concat(F.lit("text "), n).alias("text")).write.parquet(f"{folder}/documents.parquet")
    return folder


def written(query, spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_path", lambda _spark, name: f"{tmp_path}/{name}-{len(glob.glob(f'{tmp_path}/*'))}")
    queries.QUERIES[query](spark, tables).collect()
    return [f for kind in ("json", "txt") for f in glob.glob(f"{tmp_path}/**/*.{kind}*", recursive=True)]


@pytest.mark.parametrize("query", ["read_reddit_files", "read_instagram_files", "read_tweet_files", "many_pages", "mixed_load", "streaming_latest_capture", "row_error_lane"])
def test_captures_are_kept_compressed(spark, tables, tmp_path, monkeypatch, query):
    files = written(query, spark, tables, tmp_path, monkeypatch)
    assert files and all(f.endswith(".gz") for f in files)


def test_streamed_posts_have_ids(spark, tables):
    found = {(r["post_id"], r["platform"]): r["id"] for r in queries.QUERIES["streaming_load"](spark, tables).collect()}
    first = {}
    for n in range(120):
        if n % 97 and n % 101:
            key = f"p{n - 1 if n % 10 == 9 else n}", ["reddit", "twitter", "youtube", "instagram", "mastodon"][n // 10 % 5]
            first.setdefault(key, n)
    assert found == first


def test_stored_files_are_zstd(spark, tmp_path):
    raw = spark.createDataFrame([(1, "p1", "reddit", "a text")], "seq long, post_id string, platform string, post_text string")
    table = PostsTable(spark, str(tmp_path / "posts"), buckets=2)
    for _ in range(2):
        table.load(transform_posts(raw))
    (file,) = glob.glob(f"{table.path}/posts/*/*.parquet")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"

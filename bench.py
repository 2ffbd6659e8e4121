"""Headline timings; prints one JSON line.

Loads the derived posts into a stored table once, then times the transformation,
the loads and, over the stored table, the listings and analytics.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from postloom.operators import analytics, export, listing  # noqa: E402
from postloom.operators.table import PostsTable  # noqa: E402
from postloom.operators.transform import transform_posts  # noqa: E402
from postloom.plans import inputs  # noqa: E402
from postloom.plans.queries import QUERIES  # noqa: E402
from postloom.session import local_session, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
DERIVED = [
    "clean_text", "sentiment_lexicon", "sentiment_substring", "prepare_for_sentiment",
    "thumbnail_manifest", "load_validation", "upsert_posts", "dedup_keep_first",
    "author_avg_likes", "reddit_listing", "youtube_search", "tweet_capture",
]


def drain(df) -> None:
    """Compute every row without moving any to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS)
    seconds: dict[str, float] = {}

    def timed(name, run):
        started = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - started, 3)

    raw = inputs.captured(spark, SF_DIR)
    rows = raw.select("seq").count()
    as_of = F.lit("2024-02-01").cast("timestamp_ntz")
    table = PostsTable(spark, scratch_path(spark, "bench"))
    later = raw.filter(F.col("likes") == "1,234")

    timed("transform", lambda: drain(transform_posts(raw)))
    timed("load_append", lambda: table.load(transform_posts(raw), as_of=as_of))
    posts = table.posts()
    timed("table_get_posts", lambda: drain(listing.get_posts(posts, "twitter", 1000)))
    timed("table_top_posts", lambda: drain(listing.top_posts_by_likes(posts, 100)))
    timed("table_search", lambda: drain(listing.search(posts, "great", 100)))
    timed("table_stats", lambda: drain(analytics.stats_bundle(posts)))
    timed("table_top_authors", lambda: drain(analytics.top_authors(posts)))
    timed("table_sentiment", lambda: drain(analytics.sentiment_distribution(posts)))
    timed("table_hashtags", lambda: drain(analytics.top_hashtags(posts)))
    timed("table_author_likes", lambda: drain(analytics.author_average_likes(posts, "reddit")))
    timed("export_parquet", lambda: export.export_parquet(posts, scratch_path(spark, "parquet")))
    timed("export_csv", lambda: export.export_csv(posts, scratch_path(spark, "csv")))
    timed("load_second_batch", lambda: table.load(transform_posts(later), as_of=as_of))
    timed("read_table", lambda: drain(table.posts()))
    for name in DERIVED:
        timed(name, lambda: drain(QUERIES[name](spark, SF_DIR)))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "posts": rows,
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()

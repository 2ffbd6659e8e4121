"""Batch job: one platform's captured folder appended to the CSV log.

    spark-submit postloom/jobs/collect_posts.py --platform reddit \
        --subreddit datascience --limit 100 --captures /captures --output /logs/metadata
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from postloom.operators.export import append_csv_log
from postloom.sources.captures import READERS, read_posts

SORTS = ["hot", "new", "top", "rising"]


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Append captured posts to a CSV log")
    parser.add_argument("--platform", choices=list(READERS), required=True)
    parser.add_argument("--target", help="search term or hashtag that was captured")
    parser.add_argument("--subreddit", help="for reddit: subreddit whose listing was captured")
    parser.add_argument("--sort", choices=SORTS, default="hot", help="order of that listing")
    parser.add_argument("--limit", type=int, default=50, help="most posts to take")
    parser.add_argument("--captures", default="captures", help="root folder of the captures")
    parser.add_argument("--output", default="metadata", help="folder of the CSV log")
    args = parser.parse_args(argv)
    if args.platform == "reddit" and not (args.target or args.subreddit):
        parser.error("reddit requires --target or --subreddit")
    if args.platform != "reddit" and not args.target:
        parser.error(f"{args.platform} requires --target")
    return args


def capture_folder(args: argparse.Namespace) -> str:
    """Listings lie at <captures>/reddit/r/<subreddit>/<sort>, searches at <captures>/<platform>/<target>."""
    root = f"{args.captures}/{args.platform}"
    if args.platform == "reddit" and args.subreddit:
        return f"{root}/r/{args.subreddit}/{args.sort}"
    return f"{root}/{args.target}"


def collect(spark: SparkSession, args: argparse.Namespace) -> int:
    """Append the posts and return how many there were."""
    posts = read_posts(spark, args.platform, capture_folder(args), args.limit)
    # The limit bounds the rows; keep them so that counting does not read the capture again.
    posts = posts.persist()
    try:
        total = posts.count()
        if total:
            append_csv_log(posts, args.output)
    finally:
        posts.unpersist()
    return total


def main() -> None:
    args = parse_args()
    spark = SparkSession.builder.appName("collect-posts").getOrCreate()
    total = collect(spark, args)
    print(f"platform {args.platform}, source {capture_folder(args)}, {total} posts")


if __name__ == "__main__":
    main()

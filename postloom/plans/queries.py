"""The registered queries: each takes the session and a folder of driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions import labels, parse, text
from postloom.jobs import collect_posts
from postloom.operators import analytics, export, frequent, indexing, listing, load, transform
from postloom.operators.collapse import keep_first
from postloom.operators.run import run_load
from postloom.operators.table import PostsTable, load_with_validation
from postloom.plans import inputs, payloads
from postloom.schema import POSTS, RAW_POSTS, YOUTUBE_DETAILS, YOUTUBE_SEARCH
from postloom.session import scratch_path
from postloom.sources import captures, files, lane
from postloom.streaming import stream

Query = Callable[[SparkSession, str], DataFrame]
# A fixed capture time keeps results repeatable.
AS_OF = "2024-02-01 00:00:00"
POST_COLUMNS = [f.name for f in POSTS if f.name != "processed_at"]
SEARCHED = ["great", "%gre_t%spark", "😊", "BROKEN", "\\", "of"]
NO_ID = [c for c in POST_COLUMNS if c != "id"]
# Captures are kept compressed. Such a file is one task's, so streams that take few files at a time read plain ones.
PACKED = {"compression": "gzip"}


def place() -> list[Column]:
    """Page and position of a captured post."""
    return [F.col("seq.page").alias("page_no"), F.col("seq.pos").alias("pos")]


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def _over_texts(**columns: Callable[[str], Column]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = [make("text").alias(name) for name, make in columns.items()]
        return inputs.texts(spark, sf_dir).select("src", "key", "part", *made)

    return run


def _over_raw(*keep: str, **columns: Callable[[], Column]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = [make().alias(name) for name, make in columns.items()]
        return inputs.posts_raw(spark, sf_dir).select("seq", *keep, *made)

    return run


def _over_posts(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(inputs.posts(spark, sf_dir))


def _joined(column: Column) -> Column:
    return F.array_join(column, "|")


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = inputs.texts(spark, sf_dir).select(
        "src", "key", "part",
        text.prepare_for_sentiment("text").alias("p"),
        text.prepare_for_sentiment("text", include_emojis=False)["cleaned_text"].alias("no_emoji_text"),
    )
    return both.select(
        "src", "key", "part", "no_emoji_text", "p.cleaned_text", "p.has_urls", "p.emoji_count",
        _joined(F.col("p.hashtags")).alias("hashtags"),
        _joined(F.col("p.mentions")).alias("mentions"),
    )


def _likes_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.posts_raw(spark, sf_dir)
    likes = F.concat(F.coalesce("likes", F.lit("no")), F.lit("  Likes"))
    comments = F.concat(F.lit("View all "), F.col("comments"), F.lit(" comments"))
    return raw.select(
        "seq",
        parse.likes_text(likes).alias("likes"),
        parse.comments_text(comments).alias("comments"),
        parse.comments_text("post_text").alias("comments_in_text"),
    )


def _capture_ids(kind: str) -> Query:
    def instagram(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = payloads.instagram_captures(spark, sf_dir)
        return rows.select("page_no", parse.instagram_post_id("page_url", "image_src").alias("post_id"))

    def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = payloads.tweet_captures(spark, sf_dir)
        return rows.select(
            "page_no",
            parse.tweet_post_id("status_hrefs", text.clean_plain("text")).alias("post_id"),
            parse.tweet_url("status_hrefs").alias("url"),
            parse.author_from_href("author_href").alias("author"),
        )

    return {"instagram": instagram, "tweets": tweets}[kind]


def _thumbnails(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.posts_raw(spark, sf_dir)
    name = parse.thumbnail_name("post_id", "image_url")
    existing = raw.filter(F.col("event_type") == "view").select(name.alias("file_name"))
    return export.thumbnail_manifest(raw, existing)


def _transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = transform.transform_posts(inputs.captured(spark, sf_dir))
    return done.select(*inputs.RAW_COLUMNS, "retweet_count", "view_count", "word_count",
                       "has_media", "mention_count", "url_count", "sentiment_label",
                       "engagement_level")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transform.label_posts(inputs.captured(spark, sf_dir), "substring")
    return rows.select("seq", "sentiment_label", "engagement_level")


def _batch(raw: DataFrame, number: int) -> DataFrame:
    return load.to_batch(transform.transform_posts(raw), number, as_of())


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads merged, with the place of each post's first capture."""
    earlier, later = inputs.earlier_and_later(spark, sf_dir)
    merged = load.upsert(_batch(earlier, 0), _batch(later, 1))
    first = [F.col("first_at.load").alias("first_load"), F.col("first_at.page").alias("first_seq")]
    return merged.select(*NO_ID, *first)


def _upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters by capture time, and engagement recomputed from them."""
    earlier, later = inputs.earlier_and_later(spark, sf_dir)
    target = load.to_batch(transform.transform_posts(later), 0, as_of(), latest_by="scraped_at")
    batch = load.to_batch(transform.transform_posts(earlier), 1, as_of(), latest_by="scraped_at")
    merged = load.relabel_engagement(load.upsert(target, batch, latest_by="scraped_at"))
    return merged.select("post_id", "platform", "likes", "comments", "scraped_at", "engagement_level")


def _loaded(spark: SparkSession, *batches: DataFrame, latest_by: str | None = None) -> PostsTable:
    """A new stored table after loading raw batches one after the other."""
    table = PostsTable(spark, scratch_path(spark, "posts"))
    for raw in batches:
        table.load(transform.transform_posts(raw), latest_by=latest_by, as_of=as_of())
    return table


def _table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two loads through a stored table, with its ids."""
    return _loaded(spark, *inputs.earlier_and_later(spark, sf_dir)).posts().select(*POST_COLUMNS)


def _bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads through a stored table; the third repeats every row of both others."""
    earlier, later = inputs.earlier_and_later(spark, sf_dir)
    table = _loaded(spark, earlier, later, inputs.captured(spark, sf_dir))
    return table.posts().select(*POST_COLUMNS)


def _validated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table after a plain load and a validated one, which only adds new posts."""
    earlier, _ = inputs.earlier_and_later(spark, sf_dir)
    table = _loaded(spark, earlier)
    load_with_validation(transform.transform_posts(inputs.captured(spark, sf_dir)), table, as_of())
    return table.posts().select(*POST_COLUMNS)


def _collect_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job, run twice over a captured listing: the log holds the posts of both runs."""
    root = scratch_path(spark, "job")
    payloads.reddit_pages(spark, sf_dir).write.json(f"{root}/captures/reddit/r/all/new")
    args = ["--platform", "reddit", "--subreddit", "all", "--sort", "new", "--captures", f"{root}/captures", "--output", f"{root}/log"]
    for limit in ("70", "30"):
        collect_posts.collect(spark, collect_posts.parse_args([*args, "--limit", limit]))
    log = export.read_csv_log(spark, f"{root}/log")
    return log.groupBy("post_id", "author").agg(F.count(F.lit(1)).alias("times"))


def _many_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three capture folders with page numbers beyond any packing, dispatched, united and loaded."""
    path = scratch_path(spark, "captures")
    far = lambda pages: pages.withColumn("page_no", F.col("page_no") * (1 << 40))
    pages = payloads.reddit_pages(spark, sf_dir)
    far(pages).write.json(f"{path}/hot", **PACKED)
    far(pages.filter("page_no % 3 = 0")).write.json(f"{path}/new", **PACKED)
    far(payloads.tweet_captures(spark, sf_dir)).write.json(f"{path}/tweets", **PACKED)
    folders = {"reddit:hot": f"{path}/hot", "twitter": f"{path}/tweets", "reddit:new": f"{path}/new"}
    table = _loaded(spark, captures.read_all(spark, folders, as_of=as_of()))
    first = [F.col(f"first_at.{f}").alias(f"first_{f}") for f in ("page", "pos", "source")]
    last = F.col("last_at.source").alias("last_source")
    return table.stored().select("id", "post_id", "platform", "likes", *first, last)


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier, _ = inputs.earlier_and_later(spark, sf_dir)
    raw = inputs.captured(spark, sf_dir).select("seq", "post_id", "platform")
    return load.validate_load(raw, _batch(earlier, 0))


def _duplicate_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct loaded and new posts of the later load, by platform."""
    earlier, later = inputs.earlier_and_later(spark, sf_dir)
    target, batch = _batch(earlier, 0), _batch(later, 1)
    known = load.known_posts(batch, target).select("platform", F.lit("known").alias("kind"))
    new = load.unknown_posts(batch, target).select("platform", F.lit("new").alias("kind"))
    both = known.unionByName(new).groupBy("platform", "kind")
    return both.agg(F.count(F.lit(1)).alias("posts"))


def _surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.captured(spark, sf_dir).select("seq", "post_id", "platform")
    return indexing.assign_ids(raw, start=1000)


def _dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.captured(spark, sf_dir)
    return keep_first(raw.filter(F.coalesce("post_id", F.lit("")) != ""), ["post_id"])


def _union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts, turns and pages in one relation; columns a source lacks are NULL."""
    posts = inputs.captured(spark, sf_dir).select("post_id", "platform", "author", "likes")
    turns = inputs.table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
        .alias("post_id"),
        F.col("role").alias("author"),
    )
    pages = inputs.table(spark, sf_dir, "pages").select(
        F.concat(F.lit("w"), F.col("page_id").cast("string")).alias("post_id"), "url"
    )
    return export.union_by_name(posts, turns, pages)


def _detail_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = captures.youtube_hits(payloads.youtube_pages(spark, sf_dir))
    details = captures.youtube_details(payloads.youtube_responses(spark, sf_dir))
    return captures.join_details(hits, details).select(
        "page_no", "pos", "video_id", F.col("item.snippet.channelId").alias("channel_id")
    )


def _reddit(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = captures.reddit_posts(payloads.reddit_pages(spark, sf_dir), as_of())
    return posts.select(
        *place(), "post_id", "platform", "post_text", "hashtags", "timestamp", "image_url", "likes",
        "comments", "author", "url", "scraped_at", "subreddit", "upvote_ratio",
    )


def _reddit_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = captures.reddit_posts(payloads.reddit_pages(spark, sf_dir), as_of())
    return captures.first_captured(posts, 50).select(*place(), "post_id", "author")


def _youtube(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = captures.youtube_posts(
        payloads.youtube_pages(spark, sf_dir), payloads.youtube_responses(spark, sf_dir), as_of()
    )
    return posts.select(
        *place(), "post_id", "platform", "post_text", "hashtags", "timestamp", "image_url", "likes",
        "comments", "author", "url", "view_count", "duration", "channel_id",
    )


def _instagram(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = captures.instagram_posts(payloads.instagram_captures(spark, sf_dir), as_of())
    return posts.select(
        *place(), "post_id", "platform", "post_text", "hashtags", "timestamp", "image_url", "likes",
        "comments", "author",
    )


def _tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = captures.tweet_posts(payloads.tweet_captures(spark, sf_dir), as_of())
    return posts.select(
        *place(), "post_id", "platform", "post_text", "hashtags", "timestamp", "image_url", "likes",
        "comments", "author", "url", "retweet_count",
    )


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = export.export_csv(inputs.posts(spark, sf_dir), scratch_path(spark, "export_csv"))
    return files.read_csv_posts(spark, path).select(*POST_COLUMNS)


def _parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export_parquet")
    export.export_parquet(inputs.posts(spark, sf_dir), path)
    return files.read_parquet_posts(spark, path).select(*POST_COLUMNS)


def _csv_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All posts appended to one log, the tweets apart with their extra column."""
    path = scratch_path(spark, "log")
    raw = inputs.captured(spark, sf_dir)
    is_tweet = F.col("platform") == "twitter"
    # lz4 takes no more time than the plain text does, gzip twice as much.
    export.append_csv_log(raw.filter(~is_tweet), path, compression="lz4")
    export.append_csv_log(raw.filter(is_tweet).withColumn("retweet_count", F.lit("7")), path, compression="lz4")
    return export.read_csv_log(spark, path).select(
        "post_id", "platform", "post_text", "hashtags", "likes", "author", "url", "retweet_count"
    )


def _arriving(spark: SparkSession, sf_dir: str) -> str:
    """All raw posts as a folder of JSON files."""
    return _as_json(inputs.captured(spark, sf_dir), scratch_path(spark, "arriving"))


def _as_json(raw: DataFrame, path: str, **options: str) -> str:
    """Raw posts written as a capture would be, with times as text."""
    full = raw.select(
        *[
            (F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RAW_POSTS
        ]
    )
    full.write.json(path, **options)
    return path


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming load in several micro-batches, over rows that carry one order."""
    table = PostsTable(spark, scratch_path(spark, "streamed"))
    source = stream.read_stream(spark, _arriving(spark, sf_dir), max_files=2)
    run = stream.stream_load(source, table, scratch_path(spark, "offsets"), load_no=0, as_of=as_of())
    run.awaitTermination()
    # The rows carry one order, so the place of a post's first capture is its id in any micro-batches.
    return table.stored().withColumn("id", F.col("first_at.page")).select(*POST_COLUMNS)


def _streamed(spark: SparkSession, raw: DataFrame, table: PostsTable, **options) -> None:
    """All of a raw batch through a stream of its own."""
    path = _as_json(raw, scratch_path(spark, "arriving"), **PACKED)
    source = stream.read_stream(spark, path, max_files=100_000)
    stream.stream_load(source, table, scratch_path(spark, "offsets"), as_of=as_of(), **options).awaitTermination()


def _mixed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table loaded by a batch, then by two streams with their own checkpoints."""
    earlier, later = inputs.earlier_and_later(spark, sf_dir)
    table = _loaded(spark, earlier)
    for _ in range(2):
        _streamed(spark, later, table)
    return table.posts().select(*POST_COLUMNS)


def _stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of all micro-batches, summed."""
    table, metrics = PostsTable(spark, scratch_path(spark, "streamed")), scratch_path(spark, "metrics")
    source = stream.read_stream(spark, _arriving(spark, sf_dir), max_files=3)
    run = stream.stream_load(source, table, scratch_path(spark, "offsets"), as_of=as_of(), metrics=metrics)
    run.awaitTermination()
    counters = ["input_count", "transformed_count", "loaded_count", "errors", "positive", "negative", "neutral"]
    return stream.stream_metrics(spark, metrics).agg(*[F.sum(c).alias(c) for c in counters])


def _stream_latest_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams whose captures arrive late; counters follow the capture time."""
    earlier, later = inputs.earlier_and_later(spark, sf_dir)
    table = PostsTable(spark, scratch_path(spark, "late"))
    for raw in (later, earlier):
        _streamed(spark, raw, table, latest_by="scraped_at")
    merged = load.relabel_engagement(table.posts())
    return merged.select("post_id", "platform", "likes", "comments", "scraped_at", "engagement_level")


def _broken_lines(spark: SparkSession, sf_dir: str, **options: str) -> str:
    """Raw posts as JSON lines, some cut off, some with a text as number, some no objects."""
    raw = inputs.captured(spark, sf_dir)
    n = F.col("seq").cast("string")
    whole = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) if c == "scraped_at" else F.col(c) for c in raw.columns]))
    line = (
        F.when(F.col("seq") % 17 == 0, F.concat(F.lit('{"seq": '), n, F.lit(', "post_id": "p')))
        .when(F.col("seq") % 19 == 0, F.concat(F.lit('{"seq": "x'), n, F.lit('", "platform": "reddit"}')))
        .when(F.col("seq") % 23 == 0, F.concat(F.lit("["), n, F.lit("]")))
        .otherwise(whole)
    )
    path = scratch_path(spark, "broken")
    raw.select(line.alias("value")).write.text(path, **options)
    return path


def _both_lanes(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Loaded posts and refused lines in one relation."""
    posts = rows.select(F.lit("post").alias("lane"), F.col("post_id").alias("value"), F.col("platform").alias("detail"), F.lit(True).alias("has_file"))
    return posts.unionByName(
        lines.select(F.lit("line").alias("lane"), F.col("line").alias("value"), F.col("reason").alias("detail"), F.col("file").isNotNull().alias("has_file"))
    )


def _bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of the readable lines and the lines that were refused."""
    rows = files.read_raw_json(spark, _broken_lines(spark, sf_dir, **PACKED), bad_lines="refuse")
    table = _loaded(spark, lane.good(rows))
    return _both_lanes(table.posts(), lane.refused(rows))


def _stream_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stream."""
    table, rejects = PostsTable(spark, scratch_path(spark, "streamed")), scratch_path(spark, "rejects")
    source = stream.read_stream(spark, _broken_lines(spark, sf_dir), max_files=3, bad_lines="refuse")
    run = stream.stream_load(source, table, scratch_path(spark, "offsets"), as_of=as_of(), rejects=rejects)
    run.awaitTermination()
    lines = spark.read.parquet(rejects).filter("line IS NOT NULL").withColumnRenamed("reject_reason", "reason")
    return _both_lanes(table.posts(), lines)


def _one_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export as a single CSV file, read back."""
    path = scratch_path(spark, "one") + ".csv"
    export.export_csv(inputs.posts(spark, sf_dir), path, single_file=True)
    return files.read_csv_posts(spark, path).select(*POST_COLUMNS)


def _keyed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pages by key over a table in that order, each behind the last row of the one before."""
    order = "likes DESC"
    path = listing.write_in_order(inputs.posts(spark, sf_dir), scratch_path(spark, "ordered"), order)
    posts = files.read_parquet_posts(spark, path)
    pages, last = [], None
    for number in range(3):
        page = listing.posts_after(posts, last, limit=40, order_by=order).select(F.lit(number).alias("page"), *POST_COLUMNS)
        pages.append(page)
        last = page.orderBy("likes", F.desc("platform"), F.desc("post_id"), F.desc("id")).first()
    return export.union_by_name(*pages)


def _indexed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches over two indexed loads: a plain term, one with wildcards, a short one."""
    table = PostsTable(spark, scratch_path(spark, "indexed"), text_index=True)
    for raw in inputs.earlier_and_later(spark, sf_dir):
        table.load(transform.transform_posts(raw), as_of=as_of())
    found = [table.matching(t).select(F.lit(t).alias("term"), "post_id", "platform", "likes") for t in SEARCHED]
    return export.union_by_name(*found)


def _kept_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics kept over three loads with many repeated keys."""
    earlier, later = inputs.earlier_and_later(spark, sf_dir)
    kept = _loaded(spark, earlier, later, inputs.captured(spark, sf_dir)).statistics()
    authors = kept["top_authors"].select(F.lit("top_author").alias("section"), F.col("author").alias("name"), "count")
    return export.union_by_name(kept["counts"], authors)


def _sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning, parsing and label functions called inside SQL."""
    sql = """
        SELECT seq, clean_post(post_text) AS cleaned, array_join(extract_hashtags(post_text), '|') AS tags,
               safe_int(likes) AS likes, metric_text(metric_text) AS metric, parse_timestamp(timestamp) AS parsed,
               normalize_hashtags(hashtags) AS normal_tags,
               engagement_etl(safe_int(likes), safe_int(comments), platform) AS level,
               sentiment_words(clean_post(post_text)) AS sentiment
        FROM posts WHERE length(remove_urls(post_text)) >= ?
    """
    return listing.query(spark, inputs.posts_raw(spark, sf_dir), sql, [0])


def _import_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export whose columns come in another order and partly not at all."""
    path = scratch_path(spark, "import_csv")
    posts = inputs.posts(spark, sf_dir)
    shuffled = posts.select(*reversed([c for c in posts.columns if c not in ("processed_at", "duration", "channel_id")]))
    export.export_csv(shuffled, path)
    return files.read_csv_posts(spark, path).select(*POST_COLUMNS)


def _captured_files(reader, make, *columns: str) -> Query:
    """Payloads written as files and read back by the platform's reader."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "captures")
        for name, payload in make(spark, sf_dir).items():
            payload.write.json(f"{path}/{name}", **PACKED)
        folder = path if len(list(make(spark, sf_dir))) > 1 else f"{path}/pages"
        return reader(spark, folder, as_of()).select(*place(), *columns)

    return run


RAW_COLUMNS = ["post_id", "platform", "post_text", "hashtags", "timestamp", "image_url", "likes", "comments", "author"]


def _sql_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors who post on two platforms."""
    sql = """
        SELECT a.author, a.posts AS here, b.posts AS there
        FROM (SELECT author, count(*) AS posts FROM posts WHERE platform = ? GROUP BY author) AS a
        JOIN (SELECT author, count(*) AS posts FROM posts WHERE platform = ? GROUP BY author) AS b
          ON a.author = b.author
    """
    return listing.query(spark, inputs.posts(spark, sf_dir), sql, ["reddit", "youtube"])


def _dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of every part of the dashboard, one relation."""
    parts = analytics.dashboard(inputs.posts(spark, sf_dir))
    names = {"by_platform": "platform", "sentiment": "sentiment_label", "engagement": "engagement_level", "top_hashtags": "hashtag", "top_authors": "author"}
    rows = [parts["overview"].select(F.lit("overview").alias("section"), F.lit(None).cast("string").alias("name"), F.col("total_posts").alias("count"))]
    rows += [parts[p].select(F.lit(p).alias("section"), F.col(c).alias("name"), "count") for p, c in names.items()]
    return export.union_by_name(*rows)


def _export_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and likes per platform in each file of a double export."""
    paths = export.export(inputs.posts(spark, sf_dir), scratch_path(spark, "both"), "both", datetime(2024, 2, 1))
    read = {"csv": files.read_csv_posts, "parquet": files.read_parquet_posts}
    parts = [read[p.rpartition(".")[2]](spark, p).withColumn("kind", F.lit(p.rpartition(".")[2])) for p in paths]
    return export.union_by_name(*parts).groupBy("kind", "platform").agg(F.count(F.lit(1)).alias("posts"), F.sum("likes").alias("likes"))


def _first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts left per platform when repeats are dropped from the stream."""
    source = stream.read_stream(spark, _arriving(spark, sf_dir), max_files=2)
    path = scratch_path(spark, "first_seen")
    run = (
        stream.first_seen(source.filter(F.coalesce("post_id", F.lit("")) != ""))
        .writeStream.option("checkpointLocation", scratch_path(spark, "offsets"))
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.parquet(path).groupBy("platform").agg(F.count(F.lit(1)).alias("posts"))


def _stream_detail_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail join over two streams, caught up."""
    path, out = scratch_path(spark, "captures"), scratch_path(spark, "joined")
    payloads.youtube_pages(spark, sf_dir).write.json(f"{path}/search")
    payloads.youtube_responses(spark, sf_dir).write.json(f"{path}/details")
    pages = stream.stream_payloads(spark, f"{path}/search", YOUTUBE_SEARCH, max_files=4)
    responses = stream.stream_payloads(spark, f"{path}/details", YOUTUBE_DETAILS, max_files=3)
    joined = stream.join_details(pages, responses, salts=2)
    run = (
        joined.writeStream.option("checkpointLocation", scratch_path(spark, "offsets"))
        .option("path", out).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    found = spark.read.schema(joined.schema).parquet(out)
    return found.select("page_no", "pos", "video_id", F.col("item.snippet.channelId").alias("channel_id"))


def _load_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts a batch load reports."""
    table = PostsTable(spark, scratch_path(spark, "run"))
    metrics = run_load(inputs.captured(spark, sf_dir), table, as_of())
    counts = {k: metrics[k] for k in ("input_count", "transformed_count", "loaded_count", "errors")}
    row = {**counts, **metrics["sentiment"]}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} long" for k in row))


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of failed events get an unusable counter."""
    raw = inputs.posts_raw(spark, sf_dir)
    broken = raw.withColumn(
        "likes", F.when(F.col("event_type") == "error", "inf").otherwise(F.col("likes"))
    )
    return transform.rejected_posts(broken).select("seq", "post_id", "reject_reason")


def _sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = """
        SELECT author, COUNT(*) AS post_count, AVG(likes) AS avg_likes
        FROM posts
        WHERE platform = ?
        GROUP BY author
        HAVING COUNT(*) > ?
        ORDER BY post_count DESC
    """
    return listing.query(spark, inputs.posts(spark, sf_dir), sql, ["reddit", 1])


def _preview(posts: DataFrame) -> DataFrame:
    return listing.preview(listing.get_posts(posts, limit=100))


def _preview_more(posts: DataFrame) -> DataFrame:
    return listing.preview_more(listing.get_posts(posts, limit=100))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors of one platform by number of posts, with their average likes."""
    return analytics.author_average_likes(inputs.posts(spark, sf_dir), "reddit")


QUERIES: dict[str, Query] = {
    # text and parsing
    "clean_text": _over_texts(cleaned=text.clean_post),
    "text_processor_clean": _over_texts(cleaned=text.clean_plain),
    "reddit_clean": _over_texts(cleaned=text.clean_reddit),
    "hashtag_extract": _over_texts(
        tags=lambda c: _joined(text.hashtags(c)), tag_count=lambda c: F.size(text.hashtags(c))
    ),
    "hashtag_remove": _over_texts(cleaned=text.remove_hashtags),
    "mention_extract": _over_texts(
        mentions=lambda c: _joined(text.mentions(c)), mention_count=text.mention_count
    ),
    "url_remove_count": _over_texts(
        without_urls=text.remove_urls, has_urls=text.has_urls, url_count=text.url_count
    ),
    "emoji_runs": _over_texts(
        runs=lambda c: _joined(text.emoji_runs(c)),
        run_count=text.emoji_run_count,
        without_emoji=text.remove_emoji,
    ),
    "word_count": _over_texts(words=lambda c: text.word_count(text.clean_post(c))),
    "prepare_for_sentiment": _prepared,
    "normalize_hashtags": _over_raw(tags=lambda: text.normalize_hashtags("hashtags")),
    "safe_int": _over_raw(
        likes=lambda: parse.safe_int("likes"),
        comments=lambda: parse.safe_int("comments"),
        from_metric=lambda: parse.safe_int("metric_text"),
    ),
    "metric_text": _over_raw(
        metric=lambda: parse.metric_text("metric_text"), likes=lambda: parse.metric_text("likes")
    ),
    "likes_comments_text": _likes_comments,
    "instagram_post_id": _capture_ids("instagram"),
    "tweet_post_id": _capture_ids("tweets"),
    "normalize_timestamp": _over_raw(parsed=lambda: parse.parse_timestamp("timestamp")),
    "thumbnail_manifest": _thumbnails,
    # labels and transformation
    "sentiment_lexicon": _over_texts(
        label=lambda c: labels.sentiment_words(text.clean_post(c))
    ),
    "sentiment_substring": _over_texts(label=labels.sentiment_substrings),
    "engagement_etl": _over_raw(
        "platform",
        level=lambda: labels.engagement_etl(parse.safe_int("likes"), parse.safe_int("comments")),
    ),
    "engagement_labeler": _over_raw(
        "platform",
        level=lambda: labels.engagement_labeler(parse.safe_int("likes"), parse.safe_int("comments")),
    ),
    "transform_posts": _transformed,
    "transform_stats": lambda spark, sf_dir: transform.transform_stats(
        inputs.captured(spark, sf_dir)
    ),
    "rejected_posts": _rejected,
    "label_posts": _labelled,
    # loading
    "upsert_posts": _upsert,
    "upsert_latest_capture": _upsert_latest,
    "table_load": _table_load,
    "bucketed_upsert": _bucketed_upsert,
    "validated_load": _validated_load,
    "many_pages": _many_pages,
    "collect_job": _collect_job,
    "row_error_lane": _bad_lines,
    "load_run": _load_run,
    "load_validation": _validated,
    "load_stats": lambda spark, sf_dir: load.load_stats(_validated(spark, sf_dir)),
    "duplicate_check": _duplicate_check,
    "surrogate_ids": _surrogate_ids,
    "dedup_keep_first": _dedup,
    # listings
    "get_posts_page": _over_posts(
        lambda p: listing.get_posts(p, "twitter", limit=100, offset=50).select(*POST_COLUMNS)
    ),
    "get_posts_deep_page": _over_posts(
        lambda p: listing.get_posts(
            p, limit=100, offset=500, order_by="likes DESC", top_k_rows=100
        ).select(*POST_COLUMNS)
    ),
    "top_posts_by_likes": _over_posts(
        lambda p: listing.top_posts_by_likes(p, 50).select(*POST_COLUMNS)
    ),
    "search_posts": _over_posts(
        lambda p: listing.search(p, "great", 50).select("post_id", "platform", "likes", "author")
    ),
    "search_matches": _over_posts(
        lambda p: listing.matching(p, "l_ve%gre").select("post_id", "platform", "likes")
    ),
    "keyed_pages": _keyed_pages,
    "indexed_search": _indexed_search,
    "result_preview": _over_posts(_preview),
    "result_preview_more": _over_posts(_preview_more),
    "sql_passthrough": _sql,
    "sql_join": _sql_join,
    "sql_functions": _sql_functions,
    # analytics
    "stats_total_range": _over_posts(analytics.total_and_range),
    "stats_date_range": _over_posts(analytics.date_range),
    "stats_by_platform": _over_posts(analytics.by_platform),
    "stats_by_sentiment": _over_posts(analytics.by_sentiment),
    "stats_bundle": _over_posts(analytics.stats_bundle),
    "top_authors": _over_posts(analytics.top_authors),
    "author_avg_likes": flagship,
    "sentiment_distribution": _over_posts(analytics.sentiment_distribution),
    "platform_sentiment_distribution": _over_posts(
        lambda p: analytics.sentiment_distribution(p, "youtube")
    ),
    "engagement_distribution": _over_posts(analytics.engagement_distribution),
    "top_hashtags": _over_posts(analytics.top_hashtags),
    "frequent_hashtags": _over_posts(frequent.top_hashtags),
    "frequent_authors": _over_posts(frequent.top_authors),
    "dashboard": _dashboard,
    "kept_statistics": _kept_statistics,
    # sources
    "read_reddit_files": _captured_files(
        captures.read_reddit, lambda s, d: {"pages": payloads.reddit_pages(s, d)}, *RAW_COLUMNS, "url", "scraped_at", "subreddit", "upvote_ratio"
    ),
    "read_youtube_files": _captured_files(
        captures.read_youtube,
        lambda s, d: {"search": payloads.youtube_pages(s, d), "details": payloads.youtube_responses(s, d)},
        *RAW_COLUMNS, "url", "view_count", "duration", "channel_id",
    ),
    "read_instagram_files": _captured_files(
        captures.read_instagram, lambda s, d: {"pages": payloads.instagram_captures(s, d)}, *RAW_COLUMNS
    ),
    "read_tweet_files": _captured_files(
        captures.read_tweets, lambda s, d: {"pages": payloads.tweet_captures(s, d)}, *RAW_COLUMNS, "url", "retweet_count"
    ),
    "union_by_name": _union,
    "search_detail_join": _detail_join,
    "reddit_listing": _reddit,
    "capture_limit": _reddit_limit,
    "youtube_search": _youtube,
    "instagram_capture": _instagram,
    "tweet_capture": _tweets,
    # sinks and streaming
    "export_csv_roundtrip": _csv_roundtrip,
    "export_parquet_roundtrip": _parquet_roundtrip,
    "export_both": _export_both,
    "export_one_file": _one_file,
    "import_csv": _import_csv,
    "csv_log_append": _csv_log,
    "streaming_load": _stream,
    "mixed_load": _mixed_load,
    "streaming_metrics": _stream_metrics,
    "streaming_latest_capture": _stream_latest_capture,
    "streaming_error_lane": _stream_bad_lines,
    "streaming_detail_join": _stream_detail_join,
    "streaming_first_seen": _first_seen,
}

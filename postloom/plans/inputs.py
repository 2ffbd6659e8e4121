"""Social-post relations derived from the driver's tables.

The driver's texts hold hardly any of the patterns the operators handle, so each
event becomes a post: it takes a whole document as its text and adds patterns by
event number. All events and all documents are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.operators import load
from postloom.operators.transform import transform_posts


SMALL_BYTES = 1 << 28
SMALL_PARTS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal out an input of a few small files; whatever is larger stays as it is read."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(SMALL_PARTS) if size <= SMALL_BYTES else df


def _pick(number: Column, *choices: Column) -> Column:
    """Choice by the last case of a number; the final choice takes the rest."""
    result = F.when(number == 0, choices[0])
    for i, choice in enumerate(choices[1:-1], start=1):
        result = result.when(number == i, choice)
    return result.otherwise(choices[-1])


def posts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    total = documents.agg(F.count(F.lit(1))).scalar()
    n, u, ts, t = F.col("event_id"), F.col("user_id"), F.col("ts"), F.col("text")
    null = F.lit(None).cast("string")
    s = F.lit
    date, time = F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss")
    text = lambda tail: F.concat(t, s(tail))
    number = lambda c: c.cast("string")
    return (
        events.withColumn("doc_id", n % total)
        .join(spread(documents), "doc_id")
        .select(
            n.alias("seq"),
            F.when(n % 97 == 0, null)
            .when(n % 101 == 0, "")
            .otherwise(F.concat(s("p"), number(F.when(n % 10 == 9, n - 1).otherwise(n))))
            .alias("post_id"),
            _pick(
                F.floor(n / 10) % 5,
                s("reddit"), s("twitter"), s("youtube"), s("instagram"), s("mastodon"),
            ).alias("platform"),
            _pick(
                n % 9,
                text(" I LOVE this, great #Great #spark @user7 https://x.example/a?b=1#frag"),
                text(" awful &amp;lt; broken &quot;scam&quot;"),
                text(" nice 😊 and 🔥"),
                text(" 😡 😭"),
                text(" “quoted” — text bad"),
                text(" 😊😊 日本😊 ❤️ 🤮"),
                s(""),
                null,
                t,
            ).alias("post_text"),
            _pick(
                n % 5,
                s("Spark, Data ,x,,SQL"),
                F.concat(s("Tag"), number(u % 17)),
                s(""),
                null,
                F.concat(s("news,Tag"), number(u % 5)),
            ).alias("hashtags"),
            _pick(
                n % 6,
                F.concat(date, s("T"), time, s("Z")),
                F.concat(date, s("T"), time, s("+05:30")),
                F.concat(date, s(" "), time),
                F.concat(date, s("T"), time, s(".250")),
                s("yesterday"),
                null,
            ).alias("timestamp"),
            _pick(
                n % 3,
                F.concat(s("https://img.example/"), number(n), s(".PNG?w=1")),
                F.concat(s("https://img.example/raw/"), number(n)),
                s(""),
            ).alias("image_url"),
            _pick(
                n % 7,
                s("1,234"), s("12.7"), s(""), null, s("abc"), number(n * 7919 % 20000),
            ).alias("likes"),
            number(n * 104729 % 700).alias("comments"),
            F.when(u % 31 == 0, null)
            .when(F.col("event_type") == "error", "[deleted]")
            .otherwise(F.concat(s("user"), number(u)))
            .alias("author"),
            ts.alias("scraped_at"),
            _pick(n % 4, s("1.2K"), s("3M"), s("1,234"), s("n/a")).alias("metric_text"),
            F.col("event_type"),
        )
    )


RAW_COLUMNS = [
    "seq", "post_id", "platform", "post_text", "hashtags", "timestamp", "image_url",
    "likes", "comments", "author", "scraped_at",
]


def captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts with only the columns a capture has."""
    return posts_raw(spark, sf_dir).select(*RAW_COLUMNS)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``posts`` table after loading every raw post as one batch.

    The arrival number is unique here, so it serves as the id.
    """
    batch = load.to_batch(transform_posts(captured(spark, sf_dir)))
    return load.as_posts(batch.withColumn("id", F.col("first_at.page")))


def earlier_and_later(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two overlapping loads: signups and purchases first, then all but signups."""
    raw = posts_raw(spark, sf_dir)
    earlier = raw.filter(F.col("event_type").isin("signup", "purchase"))
    later = raw.filter(F.col("event_type") != "signup")
    return earlier.select(*RAW_COLUMNS), later.select(*RAW_COLUMNS)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of the tables: derived posts, conversation turns and pages, whole."""
    from_posts = posts_raw(spark, sf_dir).select(
        F.lit("post").alias("src"), F.col("seq").alias("key"), F.lit(0).cast("bigint").alias("part"),
        F.col("post_text").alias("text"),
    )
    turns = spread(table(spark, sf_dir, "conversations")).select(
        F.lit("turn").alias("src"), F.col("conv_id").alias("key"), F.col("turn").alias("part"), "text"
    )
    pages = spread(table(spark, sf_dir, "pages")).select(
        F.lit("page").alias("src"), F.col("page_id").alias("key"),
        F.lit(0).cast("bigint").alias("part"), F.col("html").alias("text"),
    )
    return from_posts.unionByName(turns).unionByName(pages)

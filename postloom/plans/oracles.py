"""DuckDB SQL for the registered queries, over the same tables.

Written from the meaning of each query, independently of the Spark expressions.
"""

from __future__ import annotations

from postloom.plans import oracle_values as lx
from postloom.plans.queries import AS_OF, NO_ID, POST_COLUMNS, SEARCHED


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values: list[str]) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def replaced(expr: str, pairs: list[tuple[str, str]]) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, {lit(old)}, {lit(new)})"
    return expr


def collapsed(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{lx.SPACE}+', ' ', 'g'))"


def stripped(expr: str) -> str:
    return f"regexp_replace({expr}, '^{lx.SPACE}+|{lx.SPACE}+$', '', 'g')"


def or_empty(expr: str) -> str:
    return f"coalesce({expr}, '')"


TYPOGRAPHY = lx.QUOTES_AND_DASHES
POST_PAIRS = [*lx.ENTITIES, *TYPOGRAPHY, *lx.ZERO_WIDTH, *lx.NO_BREAK_SPACE]


def clean_post(expr: str) -> str:
    return collapsed(replaced(or_empty(expr), POST_PAIRS))


def clean_plain(expr: str) -> str:
    return collapsed(replaced(or_empty(expr), [*TYPOGRAPHY, *lx.ZERO_WIDTH]))


def clean_reddit(expr: str) -> str:
    return collapsed(replaced(or_empty(expr), [*lx.REDDIT_ENTITIES, *TYPOGRAPHY]))


def tags(expr: str) -> str:
    return f"regexp_extract_all({or_empty(expr)}, '{lx.HASHTAG}', 1)"


def without_tags(expr: str) -> str:
    return collapsed(f"regexp_replace({or_empty(expr)}, '{lx.HASHTAG_TAIL}', '', 'g')")


def found(expr: str, pattern: str) -> str:
    return f"regexp_extract_all({or_empty(expr)}, '{pattern}')"


def joined(array: str, by: str = "|") -> str:
    return f"coalesce(array_to_string({array}, '{by}'), '')"


def size(array: str) -> str:
    return f"CAST(len({array}) AS INTEGER)"


def without_urls(expr: str) -> str:
    return stripped(f"regexp_replace({or_empty(expr)}, '{lx.URL}', '', 'g')")


def words(cleaned: str) -> str:
    return f"CASE WHEN {cleaned} = '' THEN 0 ELSE len(string_split({cleaned}, ' ')) END::INTEGER"


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def safe_int(expr: str) -> str:
    plain = f"replace({expr}, ',', '')"
    return (
        f"CASE WHEN regexp_matches({plain}, '{NUMBER}') "
        f"THEN CAST(trunc(CAST({plain} AS DOUBLE)) AS BIGINT) ELSE 0 END"
    )


def metric(expr: str) -> str:
    up = f"upper(trim({or_empty(expr)}))"

    def scaled(suffix: str, factor: int) -> str:
        number = f"replace({up}, '{suffix}', '')"
        return (
            f"CASE WHEN regexp_matches({number}, '{NUMBER}') "
            f"THEN CAST(trunc(CAST({number} AS DOUBLE) * {factor}) AS BIGINT) ELSE 0 END"
        )

    whole = f"replace({up}, ',', '')"
    return (
        f"CASE WHEN contains({up}, 'K') THEN {scaled('K', 1000)} "
        f"WHEN contains({up}, 'M') THEN {scaled('M', 1000000)} "
        f"WHEN regexp_matches({whole}, '^[+-]?[0-9]+$') THEN CAST({whole} AS BIGINT) ELSE 0 END"
    )


def parsed_time(expr: str) -> str:
    offset = "[+-][0-9]{2}:[0-9]{2}$"
    naive = f"TRY_CAST(regexp_replace({expr}, '{offset}', '') AS TIMESTAMP)"
    zone = f"regexp_extract({expr}, '{offset}')"
    minutes = f"(CAST(substr({zone}, 2, 2) AS INTEGER) * 60 + CAST(substr({zone}, 5, 2) AS INTEGER))"
    sign = f"CASE WHEN {zone} LIKE '-%' THEN -1 ELSE 1 END"
    return f"CASE WHEN {zone} <> '' THEN {naive} - to_minutes({sign} * {minutes}) ELSE {naive} END"


def norm_tags(expr: str) -> str:
    parts = f"list_transform(string_split({or_empty(expr)}, ','), lambda t: lower({stripped('t')}))"
    return joined(f"list_filter({parts}, lambda t: length(t) > 1)", ",")


def sign_label(score: str) -> str:
    return f"CASE WHEN {score} > 0 THEN 'positive' WHEN {score} < 0 THEN 'negative' ELSE 'neutral' END"


def word_sentiment(cleaned: str) -> str:
    def hits(values: list[str], emoji: list[str]) -> str:
        found_words = f"list_distinct(regexp_extract_all(lower({cleaned}), '{lx.WORD}+'))"
        runs = f"regexp_extract_all({cleaned}, '{lx.EMOJI_RUN}')"
        return (
            f"(len(list_filter({found_words}, lambda w: list_contains({in_list(values)}, w)))"
            f" + len(list_filter({runs}, lambda r: list_contains({in_list(emoji)}, r))))"
        )

    good = hits(lx.POSITIVE_WORDS, lx.POSITIVE_EMOJI)
    bad = hits(lx.NEGATIVE_WORDS, lx.NEGATIVE_EMOJI)
    return f"CASE WHEN {good} > {bad} THEN 'positive' WHEN {bad} > {good} THEN 'negative' ELSE 'neutral' END"


def substring_sentiment(expr: str) -> str:
    def hits(values: list[str]) -> str:
        return f"len(list_filter({in_list(values)}, lambda i: contains(lower({or_empty(expr)}), i)))"

    good, bad = hits(lx.POSITIVE_INDICATORS), hits(lx.NEGATIVE_INDICATORS)
    return f"CASE WHEN {good} > {bad} THEN 'positive' WHEN {bad} > {good} THEN 'negative' ELSE 'neutral' END"


def engagement(likes: str, comments: str, thresholds: dict, weight: int) -> str:
    score = f"({likes} + {comments} * {weight})"

    def level(limits: tuple[int, int, int]) -> str:
        medium, high, viral = limits
        return (
            f"CASE WHEN {score} >= {viral} THEN 'viral' WHEN {score} >= {high} THEN 'high' "
            f"WHEN {score} >= {medium} THEN 'medium' ELSE 'low' END"
        )

    cases = " ".join(f"WHEN '{name}' THEN {level(limits)}" for name, limits in thresholds.items())
    return f"CASE platform {cases} ELSE {level(thresholds['twitter'])} END"


POSTS_RAW = """
posts_raw AS (
    SELECT n AS seq,
        CASE WHEN n % 97 = 0 THEN NULL WHEN n % 101 = 0 THEN ''
             ELSE 'p' || CASE WHEN n % 10 = 9 THEN n - 1 ELSE n END END AS post_id,
        CASE (n // 10) % 5 WHEN 0 THEN 'reddit' WHEN 1 THEN 'twitter' WHEN 2 THEN 'youtube'
             WHEN 3 THEN 'instagram' ELSE 'mastodon' END AS platform,
        CASE n % 9
            WHEN 0 THEN t || ' I LOVE this, great #Great #spark @user7 https://x.example/a?b=1#frag'
            WHEN 1 THEN t || ' awful &amp;lt; broken &quot;scam&quot;'
            WHEN 2 THEN t || ' nice 😊 and 🔥'
            WHEN 3 THEN t || ' 😡 😭'
            WHEN 4 THEN t || ' “quoted” — text bad'
            WHEN 5 THEN t || ' 😊😊 日本😊 ❤️ 🤮'
            WHEN 6 THEN '' WHEN 7 THEN NULL ELSE t END AS post_text,
        CASE n % 5 WHEN 0 THEN 'Spark, Data ,x,,SQL' WHEN 1 THEN 'Tag' || (u % 17) WHEN 2 THEN ''
             WHEN 3 THEN NULL ELSE 'news,Tag' || (u % 5) END AS hashtags,
        CASE n % 6 WHEN 0 THEN d || 'T' || h || 'Z' WHEN 1 THEN d || 'T' || h || '+05:30'
             WHEN 2 THEN d || ' ' || h WHEN 3 THEN d || 'T' || h || '.250'
             WHEN 4 THEN 'yesterday' ELSE NULL END AS timestamp,
        CASE n % 3 WHEN 0 THEN 'https://img.example/' || n || '.PNG?w=1'
             WHEN 1 THEN 'https://img.example/raw/' || n ELSE '' END AS image_url,
        CASE n % 7 WHEN 0 THEN '1,234' WHEN 1 THEN '12.7' WHEN 2 THEN '' WHEN 3 THEN NULL
             WHEN 4 THEN 'abc' ELSE CAST(n * 7919 % 20000 AS VARCHAR) END AS likes,
        CAST(n * 104729 % 700 AS VARCHAR) AS comments,
        CASE WHEN u % 31 = 0 THEN NULL WHEN event_type = 'error' THEN '[deleted]'
             ELSE 'user' || u END AS author,
        ts AS scraped_at,
        CASE n % 4 WHEN 0 THEN '1.2K' WHEN 1 THEN '3M' WHEN 2 THEN '1,234' ELSE 'n/a' END
            AS metric_text,
        event_type
    FROM (
        SELECT e.event_id AS n, e.user_id AS u, e.ts, e.event_type, doc.text AS t,
            strftime(e.ts, '%Y-%m-%d') AS d, strftime(e.ts, '%H:%M:%S') AS h
        FROM events e
        JOIN documents doc ON doc.doc_id = e.event_id % (SELECT count(*) FROM documents)
    )
)"""

TEXTS = f"""{POSTS_RAW},
texts AS (
    SELECT 'post' AS src, seq AS key, 0::BIGINT AS part, post_text AS text FROM posts_raw
    UNION ALL SELECT 'turn', conv_id, turn, text FROM conversations
    UNION ALL SELECT 'page', page_id, 0::BIGINT, html FROM pages
)"""

TRANSFORMED = f"""{POSTS_RAW},
cleaned AS (
    SELECT * REPLACE (
        {clean_post('post_text')} AS post_text,
        {norm_tags('hashtags')} AS hashtags,
        {safe_int('likes')} AS likes,
        {safe_int('comments')} AS comments,
        {parsed_time('timestamp')} AS timestamp),
        post_text AS raw_text
    FROM posts_raw WHERE coalesce(post_id, '') <> ''
),
transformed AS (
    SELECT * EXCLUDE (raw_text),
        0::BIGINT AS retweet_count, 0::BIGINT AS view_count,
        {words('post_text')} AS word_count,
        coalesce(image_url, '') <> '' AS has_media,
        {size(found('raw_text', lx.MENTION))} AS mention_count,
        {size(found('raw_text', lx.URL))} AS url_count,
        {word_sentiment('post_text')} AS sentiment_label,
        {engagement('likes', 'comments', lx.ETL_THRESHOLDS, lx.ETL_COMMENT_WEIGHT)} AS engagement_level
    FROM cleaned
)"""

# Columns of a capture that the stored table fixes at the first load.
_FIXED = ["post_text", "hashtags", "timestamp", "image_url", "author", "sentiment_label", "engagement_level"]


def loaded(name: str, where: str, batch: int, latest: str = "seq") -> str:
    """A stored batch: fixed columns of the first row per key, counters of the latest."""
    first = ", ".join(f"arg_min({{v: {c}}}, seq).v AS {c}" for c in _FIXED)
    last = ", ".join(f"arg_max({{v: {c}}}, {latest}).v AS {c}" for c in ["likes", "comments", "scraped_at"])
    return f"""{name} AS (
    SELECT min(seq) AS id, post_id, platform, {first}, {last},
        NULL::VARCHAR AS url, NULL::VARCHAR AS subreddit, 0::FLOAT AS upvote_ratio,
        0::BIGINT AS retweet_count, 0::BIGINT AS view_count,
        NULL::VARCHAR AS duration, NULL::VARCHAR AS channel_id,
        {batch} AS batch_no
    FROM transformed WHERE {where} GROUP BY post_id, platform
)"""


POSTS = f"""{TRANSFORMED},
{loaded('posts', 'true', 0)}"""

EARLIER = "event_type IN ('signup', 'purchase')"
LATER = "event_type <> 'signup'"
TWO_LOADS = f"""{TRANSFORMED},
{loaded('target', EARLIER, 0)},
{loaded('batch', LATER, 1)}"""

COLUMNS = ", ".join(POST_COLUMNS)


def over_texts(**columns: str) -> str:
    made = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return f"WITH {TEXTS} SELECT src, key, part, {made} FROM texts"


def over_raw(*keep: str, **columns: str) -> str:
    made = ", ".join([*keep, *[f"{expr} AS {name}" for name, expr in columns.items()]])
    return f"WITH {POSTS_RAW} SELECT seq, {made} FROM posts_raw"


def over_posts(sql: str) -> str:
    return f"WITH {POSTS} {sql}"


def prepared(emoji: bool) -> str:
    cleaned = without_tags(without_urls(clean_plain("text")))
    if not emoji:
        cleaned = f"regexp_replace({cleaned}, '{lx.EMOJI_RUN}', '', 'g')"
    return collapsed(f"regexp_replace({cleaned}, '{lx.MENTION}', '', 'g')")


def digits(expr: str, pattern: str) -> str:
    return f"replace(regexp_extract(lower({expr}), '{pattern}', 1), ',', '')"


_COUNT = "([0-9]+(?:,[0-9]+)*)"
LIKES = f"{_COUNT}{lx.SPACE}*(?:like|likes)"


def comment_digits(expr: str) -> str:
    plural, single = f"{_COUNT}{lx.SPACE}*comments", f"{_COUNT}{lx.SPACE}*comment"
    return f"coalesce(nullif({digits(expr, plural)}, ''), nullif({digits(expr, single)}, ''), '')"


INSTAGRAM_ROWS = f"""{POSTS_RAW},
shots AS (
    SELECT *, CASE seq % 3 WHEN 0 THEN 'ID' || (seq // 6) END AS shown_id,
        CASE seq % 4 WHEN 0 THEN 'https://img.example/a/12_' || seq || '_n.jpg?x=1'
             WHEN 3 THEN NULL ELSE 'https://img.example/raw/' || (seq // 10) END AS image_src
    FROM posts_raw
),
shot_ids AS (
    SELECT *, coalesce(shown_id, CASE WHEN seq % 4 = 0 THEN '12_' || seq || '_n.jpg' END,
        substr(md5(image_src), 1, 16)) AS shot_id FROM shots
)"""

TWEET_ROWS = f"""{POSTS_RAW},
tweet_texts AS (
    SELECT *, {clean_plain('post_text')} AS cleaned,
        CASE WHEN seq % 10 = 9 THEN seq - 1 ELSE seq END AS status FROM posts_raw
),
tweets AS (
    SELECT *, CASE WHEN seq % 3 < 2 THEN CAST(status AS VARCHAR)
            ELSE substr(md5(cleaned), 1, 16) END AS tweet_id,
        CASE seq % 3 WHEN 0 THEN 'https://twitter.com/b/status/' || status || '/analytics'
            WHEN 1 THEN 'https://twitter.com/b/status/' || status
            ELSE 'https://twitter.com/c/status/none' END AS tweet_url,
        coalesce(author, '') AS tweet_author
    FROM tweet_texts
)"""

TITLE = "event_type || ' & \"seen\"'"


def wanted_thumbnail(expr: str = "image_url") -> str:
    return f"""CASE WHEN {expr} LIKE '%.PNG?%' THEN post_id || '.png' ELSE post_id || '.jpg' END"""


def merged() -> str:
    """Target and batch joined on the key, the side picked by presence of its id."""
    cols = []
    for c in NO_ID:
        if c in ("post_id", "platform"):
            cols.append(f"coalesce(t.{c}, b.{c}) AS {c}")
        elif c in ("likes", "comments", "scraped_at"):
            cols.append(f"CASE WHEN b.id IS NOT NULL THEN b.{c} ELSE t.{c} END AS {c}")
        else:
            cols.append(f"CASE WHEN t.id IS NOT NULL THEN t.{c} ELSE b.{c} END AS {c}")
    cols += ["CASE WHEN t.id IS NOT NULL THEN 0 ELSE 1 END::BIGINT AS first_load", "coalesce(t.id, b.id) AS first_seq"]
    return (
        f"SELECT {', '.join(cols)} FROM target t FULL JOIN batch b "
        "ON t.post_id = b.post_id AND t.platform = b.platform"
    )


def after_loads(*wheres: str) -> str:
    """Posts after several loads: ids in the order of first arrival, load by load."""
    parts = " UNION ALL ".join(f"SELECT *, {i} AS load FROM transformed WHERE {w}" for i, w in enumerate(wheres))
    first = ", ".join(f"arg_min({{v: {c}}}, load * 1000000000000 + seq).v AS {c}" for c in _FIXED)
    last = ", ".join(f"arg_max({{v: {c}}}, load * 1000000000000 + seq).v AS {c}" for c in ["likes", "comments", "scraped_at"])
    return f"""{TRANSFORMED}, loads AS ({parts}),
        posts AS (
            SELECT row_number() OVER (ORDER BY min(load * 1000000000000 + seq)) AS id, post_id, platform, {first}, {last},
                NULL::VARCHAR AS url, NULL::VARCHAR AS subreddit, 0::FLOAT AS upvote_ratio,
                0::BIGINT AS retweet_count, 0::BIGINT AS view_count, NULL::VARCHAR AS duration, NULL::VARCHAR AS channel_id
            FROM loads GROUP BY post_id, platform
        )"""


VALIDATED = f"""{TWO_LOADS},
numbered AS (
    SELECT seq, post_id, platform, coalesce(post_id, '') <> '' AND coalesce(platform, '') <> '' AS valid,
        row_number() OVER (PARTITION BY post_id, platform ORDER BY seq) AS occurrence
    FROM posts_raw
),
validated AS (
    SELECT seq, post_id, platform,
        CASE WHEN NOT valid THEN 'error' WHEN occurrence > 1 OR EXISTS (
            SELECT 1 FROM target t WHERE t.post_id = n.post_id AND t.platform = n.platform
        ) THEN 'duplicate' ELSE 'success' END AS status,
        CASE WHEN NOT valid THEN 'post id or platform is missing' END AS error
    FROM numbered n
)"""

LIST_ORDER = "ORDER BY {} DESC NULLS LAST, platform, post_id"
NEWEST_100 = f"SELECT * FROM posts {LIST_ORDER.format('scraped_at')} LIMIT 100"


def distribution(label: str, where: str = "true") -> str:
    return over_posts(
        f"""SELECT {label}, count(*) AS count,
            round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage
        FROM posts WHERE {label} IS NOT NULL AND {where} GROUP BY {label}"""
    )


ORACLES: dict[str, str] = {
    "clean_text": over_texts(cleaned=clean_post("text")),
    "text_processor_clean": over_texts(cleaned=clean_plain("text")),
    "reddit_clean": over_texts(cleaned=clean_reddit("text")),
    "hashtag_extract": over_texts(tags=joined(tags("text")), tag_count=size(tags("text"))),
    "hashtag_remove": over_texts(cleaned=without_tags("text")),
    "mention_extract": over_texts(
        mentions=joined(found("text", lx.MENTION)), mention_count=size(found("text", lx.MENTION))
    ),
    "url_remove_count": over_texts(
        without_urls=without_urls("text"),
        has_urls=f"regexp_matches({or_empty('text')}, '{lx.URL}')",
        url_count=size(found("text", lx.URL)),
    ),
    "emoji_runs": over_texts(
        runs=joined(found("text", lx.EMOJI_RUN)),
        run_count=size(found("text", lx.EMOJI_RUN)),
        without_emoji=f"regexp_replace({or_empty('text')}, '{lx.EMOJI_RUN}', '', 'g')",
    ),
    "word_count": over_texts(words=words(clean_post("text"))),
    "prepare_for_sentiment": over_texts(
        no_emoji_text=prepared(False),
        cleaned_text=prepared(True),
        has_urls=f"regexp_matches({or_empty('text')}, '{lx.URL}')",
        emoji_count=size(found("text", lx.EMOJI_RUN)),
        hashtags=joined(tags("text")),
        mentions=joined(found("text", lx.MENTION)),
    ),
    "normalize_hashtags": over_raw(tags=norm_tags("hashtags")),
    "safe_int": over_raw(
        likes=safe_int("likes"), comments=safe_int("comments"), from_metric=safe_int("metric_text")
    ),
    "metric_text": over_raw(metric=metric("metric_text"), likes=metric("likes")),
    "likes_comments_text": over_raw(
        likes=digits("(coalesce(likes, 'no') || '  Likes')", LIKES),
        comments="comments",
        comments_in_text=comment_digits(or_empty("post_text")),
    ),
    "instagram_post_id": f"WITH {INSTAGRAM_ROWS} SELECT seq AS page_no, shot_id AS post_id FROM shot_ids",
    "tweet_post_id": f"""WITH {TWEET_ROWS}
        SELECT seq AS page_no, tweet_id AS post_id, tweet_url AS url, tweet_author AS author
        FROM tweets""",
    "normalize_timestamp": over_raw(parsed=parsed_time("timestamp")),
    "thumbnail_manifest": f"""WITH {POSTS_RAW},
        named AS (
            SELECT *, {wanted_thumbnail()} AS file_name FROM posts_raw
            WHERE coalesce(post_id, '') <> ''
        )
        SELECT file_name, arg_min(post_id, seq) AS post_id, arg_min(image_url, seq) AS image_url
        FROM named WHERE image_url <> '' AND file_name NOT IN (
            SELECT file_name FROM named WHERE event_type = 'view'
        ) GROUP BY file_name""",
    "sentiment_lexicon": over_texts(label=word_sentiment(clean_post("text"))),
    "sentiment_substring": over_texts(label=substring_sentiment("text")),
    "engagement_etl": over_raw(
        "platform",
        level=engagement(
            f"({safe_int('likes')})", f"({safe_int('comments')})", lx.ETL_THRESHOLDS, 3
        ),
    ),
    "engagement_labeler": over_raw(
        "platform",
        level=engagement(
            f"({safe_int('likes')})", f"({safe_int('comments')})", lx.LABELER_THRESHOLDS, 2
        ),
    ),
    "transform_posts": f"WITH {TRANSFORMED} SELECT * EXCLUDE (metric_text, event_type) FROM transformed",
    "transform_stats": f"""WITH {TRANSFORMED}
        SELECT count(*) AS processed, 0::BIGINT AS errors,
            count(*) FILTER (sentiment_label = 'positive') AS positive,
            count(*) FILTER (sentiment_label = 'negative') AS negative,
            count(*) FILTER (sentiment_label = 'neutral') AS neutral FROM transformed""",
    "rejected_posts": f"""WITH {POSTS_RAW}
        SELECT seq, post_id, 'counter out of range' AS reject_reason FROM posts_raw
        WHERE event_type = 'error' AND coalesce(post_id, '') <> ''""",
    "load_run": f"""WITH {TRANSFORMED}
        SELECT (SELECT count(*) FROM posts_raw) AS input_count, count(*) AS transformed_count,
            count(*) AS loaded_count, 0::BIGINT AS errors,
            count(*) FILTER (sentiment_label = 'positive') AS positive,
            count(*) FILTER (sentiment_label = 'negative') AS negative,
            count(*) FILTER (sentiment_label = 'neutral') AS neutral FROM transformed""",
    "label_posts": f"""WITH {POSTS_RAW}
        SELECT seq, {substring_sentiment('post_text')} AS sentiment_label,
            {engagement(f"({safe_int('likes')})", f"({safe_int('comments')})", lx.LABELER_THRESHOLDS, 2)}
                AS engagement_level FROM posts_raw""",
    "upsert_posts": f"WITH {TWO_LOADS} {merged()}",
    "table_load": f"WITH {after_loads(EARLIER, LATER)} SELECT {COLUMNS} FROM posts",
    "bucketed_upsert": f"WITH {after_loads(EARLIER, LATER, 'true')} SELECT {COLUMNS} FROM posts",
    # Only posts that the first load does not have, each by its first row.
    "validated_load": f"""WITH {after_loads(EARLIER, f"""(post_id, platform) NOT IN (
            SELECT (post_id, platform) FROM transformed WHERE {EARLIER})
        AND seq = (SELECT min(f.seq) FROM transformed f WHERE f.post_id = transformed.post_id AND f.platform = transformed.platform)""")}
        SELECT {COLUMNS} FROM posts""",
    "many_pages": f"""WITH {TWEET_ROWS},
        captured AS (
            SELECT 'r' || seq AS post_id, 'reddit' AS platform, seq * 7919 % 20000 AS likes, seq, 0 AS pos, 0 AS source FROM posts_raw
            UNION ALL SELECT 'c' || seq, 'reddit', 0, seq, 1, 0 FROM posts_raw WHERE event_type <> 'error'
            UNION ALL SELECT 'r' || seq, 'reddit', seq * 7919 % 20000, seq, 0, 2 FROM posts_raw WHERE seq % 3 = 0
            UNION ALL SELECT 'c' || seq, 'reddit', 0, seq, 1, 2 FROM posts_raw WHERE event_type <> 'error' AND seq % 3 = 0
            UNION ALL SELECT * FROM (
                SELECT tweet_id, 'twitter', {metric('metric_text')}, seq, 0, 1
                FROM tweets QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY tweets.seq) = 1)
        ),
        keyed AS (
            SELECT post_id, platform, min([seq, pos, source]) AS first, max([seq, pos, source]) AS last,
                arg_max(likes, [seq, pos, source]) AS likes FROM captured GROUP BY post_id, platform
        )
        SELECT row_number() OVER (ORDER BY first) AS id, post_id, platform, CAST(likes AS BIGINT) AS likes,
            CAST(first[1] * {1 << 40} AS BIGINT) AS first_page, CAST(first[2] AS BIGINT) AS first_pos,
            CAST(first[3] AS INTEGER) AS first_source, CAST(last[3] AS INTEGER) AS last_source
        FROM keyed""",
    "row_error_lane": f"""WITH {POSTS_RAW}
        SELECT DISTINCT 'post' AS lane, post_id AS value, platform AS detail, true AS has_file FROM posts_raw
        WHERE coalesce(post_id, '') <> '' AND seq % 17 <> 0 AND seq % 19 <> 0 AND seq % 23 <> 0
        UNION ALL SELECT 'line', '{{"seq": ' || seq || ', "post_id": "p', 'not JSON', true FROM posts_raw WHERE seq % 17 = 0
        UNION ALL SELECT 'line', '{{"seq": "x' || seq || '", "platform": "reddit"}}', 'a field does not fit its type', true
            FROM posts_raw WHERE seq % 19 = 0 AND seq % 17 <> 0
        UNION ALL SELECT 'line', '[' || seq || ']', 'not a JSON object', true
            FROM posts_raw WHERE seq % 23 = 0 AND seq % 17 <> 0 AND seq % 19 <> 0""",
    "upsert_latest_capture": f"""WITH {TRANSFORMED}, last AS (
            SELECT *, row_number() OVER (PARTITION BY post_id, platform
                ORDER BY scraped_at DESC, CASE WHEN {EARLIER} THEN 1 ELSE 0 END DESC, seq DESC) AS rn
            FROM transformed
        )
        SELECT post_id, platform, likes, comments, scraped_at,
            {engagement('likes', 'comments', lx.ETL_THRESHOLDS, 3)} AS engagement_level
        FROM last WHERE rn = 1""",
    "load_validation": f"WITH {VALIDATED} SELECT * FROM validated",
    "load_stats": f"""WITH {VALIDATED}
        SELECT count(*) FILTER (status = 'success') AS loaded,
            count(*) FILTER (status = 'duplicate') AS duplicates,
            count(*) FILTER (status = 'error') AS errors FROM validated""",
    "duplicate_check": f"""WITH {TWO_LOADS}
        SELECT b.platform, CASE WHEN t.id IS NULL THEN 'new' ELSE 'known' END AS kind,
            count(*) AS posts
        FROM batch b LEFT JOIN target t ON t.post_id = b.post_id AND t.platform = b.platform
        GROUP BY ALL""",
    "surrogate_ids": f"""WITH {POSTS_RAW}
        SELECT seq, post_id, platform, 1000 + row_number() OVER (ORDER BY seq) AS id
        FROM posts_raw""",
    "dedup_keep_first": f"""WITH {POSTS_RAW}
        SELECT * EXCLUDE (metric_text, event_type) FROM posts_raw WHERE coalesce(post_id, '') <> ''
        QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY seq) = 1""",
    "get_posts_page": over_posts(
        f"""SELECT {COLUMNS} FROM posts WHERE platform = 'twitter'
        {LIST_ORDER.format('scraped_at')} LIMIT 100 OFFSET 50"""
    ),
    "get_posts_deep_page": over_posts(
        f"SELECT {COLUMNS} FROM posts {LIST_ORDER.format('likes')} LIMIT 100 OFFSET 500"
    ),
    "top_posts_by_likes": over_posts(
        f"SELECT {COLUMNS} FROM posts {LIST_ORDER.format('likes')} LIMIT 50"
    ),
    "search_posts": over_posts(
        f"""SELECT post_id, platform, likes, author FROM posts WHERE post_text ILIKE '%great%'
        {LIST_ORDER.format('likes')} LIMIT 50"""
    ),
    "search_matches": over_posts(
        "SELECT post_id, platform, likes FROM posts WHERE post_text ILIKE '%l_ve%gre%'"
    ),
    "result_preview": over_posts(
        f"""SELECT row_number() OVER ({LIST_ORDER.format('scraped_at')}) AS row, platform,
            substr(coalesce(author, 'None'), 1, 12) AS author,
            substr(post_text, 1, 35) || CASE WHEN length(post_text) > 35 THEN '...' ELSE '' END
                AS content,
            CAST(likes AS VARCHAR) AS likes, sentiment_label AS sentiment
        FROM posts {LIST_ORDER.format('scraped_at')} LIMIT 20"""
    ),
    "result_preview_more": over_posts(
        f"""SELECT '+' || (count(*) - 20) || ' more' AS more FROM ({NEWEST_100})
        HAVING count(*) > 20"""
    ),
    "sql_passthrough": over_posts(
        """SELECT author, count(*) AS post_count, avg(likes) AS avg_likes FROM posts
        WHERE platform = 'reddit' GROUP BY author HAVING count(*) > 1"""
    ),
    "stats_total_range": over_posts(
        """SELECT count(*) AS total_posts, min(timestamp) AS oldest, max(timestamp) AS newest
        FROM posts"""
    ),
    "stats_date_range": over_posts(
        """SELECT min(timestamp) AS oldest, max(timestamp) AS newest FROM posts
        WHERE timestamp IS NOT NULL HAVING count(*) > 0"""
    ),
    "stats_by_platform": over_posts(
        """SELECT platform, count(*) AS count,
            round_even(count(*) / sum(count(*)) OVER () * 100, 1) AS share
        FROM posts GROUP BY platform"""
    ),
    "stats_by_sentiment": over_posts(
        """SELECT sentiment_label, count(*) AS count FROM posts
        WHERE sentiment_label IS NOT NULL GROUP BY sentiment_label"""
    ),
    "stats_bundle": over_posts(
        """SELECT 'total' AS section, NULL AS name, count(*) AS count,
            min(timestamp) AS oldest, max(timestamp) AS newest FROM posts
        UNION ALL SELECT 'by_platform', platform, count(*), min(timestamp), max(timestamp)
            FROM posts GROUP BY platform
        UNION ALL SELECT 'by_sentiment', sentiment_label, count(*), min(timestamp), max(timestamp)
            FROM posts WHERE sentiment_label IS NOT NULL GROUP BY sentiment_label"""
    ),
    "top_authors": over_posts(
        """SELECT author, count(*) AS count FROM posts
        WHERE author IS NOT NULL AND author <> '[deleted]'
        GROUP BY author ORDER BY count DESC, author LIMIT 10"""
    ),
    "author_avg_likes": over_posts(
        """SELECT author, count(*) AS post_count, avg(likes) AS avg_likes FROM posts
        WHERE platform = 'reddit' GROUP BY author
        ORDER BY post_count DESC, author NULLS LAST LIMIT 10"""
    ),
    "sentiment_distribution": distribution("sentiment_label"),
    "platform_sentiment_distribution": distribution("sentiment_label", "platform = 'youtube'"),
    "engagement_distribution": distribution("engagement_level"),
    "top_hashtags": over_posts(
        """SELECT trim(tag) AS hashtag, count(*) AS count
        FROM (SELECT unnest(string_split(hashtags, ',')) AS tag FROM posts
              WHERE hashtags IS NOT NULL AND hashtags <> '')
        WHERE trim(tag) <> '' GROUP BY trim(tag) ORDER BY count DESC, hashtag LIMIT 20"""
    ),
    "union_by_name": f"""WITH {POSTS_RAW}
        SELECT post_id, platform, author, likes, NULL::VARCHAR AS url FROM posts_raw
        UNION ALL SELECT 'c' || conv_id || '-' || turn, NULL, role, NULL, NULL FROM conversations
        UNION ALL SELECT 'w' || page_id, NULL, NULL, NULL, url FROM pages""",
    "search_detail_join": """SELECT e.event_id AS page_no, 0 AS pos, 'v' || e.user_id AS video_id,
            d.source AS channel_id
        FROM events e JOIN documents d ON d.doc_id = e.user_id
        WHERE e.event_type IN ('view', 'click') AND d.doc_id % 11 <> 0""",
    "reddit_listing": f"""WITH {POSTS_RAW},
        bodies AS (SELECT *, {clean_reddit('post_text')} AS body FROM posts_raw)
        SELECT seq AS page_no, 0::BIGINT AS pos, 'r' || seq AS post_id, 'reddit' AS platform,
            CASE WHEN body = '' THEN {TITLE} ELSE {TITLE} || chr(10) || chr(10) || body END AS post_text,
            CASE WHEN seq % 2 = 0 THEN coalesce(hashtags, '') ELSE '' END AS hashtags,
            CASE WHEN seq % 11 = 0 THEN '' ELSE strftime(scraped_at, '%Y-%m-%dT%H:%M:%S') END
                AS timestamp,
            CASE WHEN seq % 4 = 0 THEN 'https://prev.example/' || seq || '?a=1&b=2'
                 WHEN seq % 3 = 0 THEN 'https://thumb.example/' || seq || '.jpg' ELSE '' END AS image_url,
            CAST(seq * 7919 % 20000 AS VARCHAR) AS likes,
            CASE WHEN seq % 13 = 0 THEN '0' ELSE CAST(seq % 700 AS VARCHAR) END AS comments,
            coalesce(author, '[deleted]') AS author,
            'https://reddit.com/r/x/' || seq AS url, {lit(AS_OF.replace(' ', 'T'))} AS scraped_at,
            event_type AS subreddit, (seq % 100) / 100 AS upvote_ratio
        FROM bodies
        UNION ALL
        SELECT seq, 1::BIGINT, 'c' || seq, 'reddit', event_type, '', '', '', '0', '0', '[deleted]',
            'https://reddit.com', {lit(AS_OF.replace(' ', 'T'))}, '', 0
        FROM posts_raw WHERE event_type <> 'error'""",
    "capture_limit": f"""WITH {POSTS_RAW}
        SELECT * FROM (
            SELECT seq AS page_no, 0::BIGINT AS pos, 'r' || seq AS post_id, coalesce(author, '[deleted]') AS author
            FROM posts_raw
            UNION ALL SELECT seq, 1::BIGINT, 'c' || seq, '[deleted]' FROM posts_raw
            WHERE event_type <> 'error'
        ) ORDER BY page_no, pos LIMIT 50""",
    "youtube_search": f"""WITH described AS (
            SELECT *, {clean_plain("text || ' #Video #' || lang || ' end'")} AS description
            FROM documents WHERE doc_id % 11 <> 0
        )
        SELECT e.event_id AS page_no, 0::BIGINT AS pos, 'v' || d.doc_id AS post_id, 'youtube' AS platform,
            'On "' || d.source || '"' || chr(10) || chr(10) || {without_tags('description')} AS post_text,
            {joined(tags('description'), ',')} AS hashtags, '2024-01-05T10:00:00Z' AS timestamp,
            CASE WHEN doc_id % 2 = 0 THEN 'https://maxres.example/' || doc_id
                 WHEN doc_id % 3 = 0 THEN 'https://medium.example/' || doc_id
                 WHEN doc_id % 5 <> 0 THEN 'https://default.example/' || doc_id ELSE '' END AS image_url,
            CASE WHEN doc_id % 7 <> 0 THEN CAST(doc_id * 31 AS VARCHAR) ELSE '' END AS likes,
            CASE WHEN doc_id % 7 <> 0 THEN CAST(doc_id % 50 AS VARCHAR) ELSE '' END AS comments,
            'channel ' || d.source AS author, 'https://www.youtube.com/watch?v=v' || doc_id AS url,
            CASE WHEN doc_id % 7 <> 0 THEN CAST(doc_id + 3000000000 AS VARCHAR) ELSE '' END AS view_count,
            'PT4M13S' AS duration, d.source AS channel_id
        FROM events e JOIN described d ON d.doc_id = e.user_id
        WHERE e.event_type IN ('view', 'click')""",
    "instagram_capture": f"""WITH {INSTAGRAM_ROWS},
        captioned AS (
            SELECT *, {clean_plain("CASE WHEN length(post_text) > 5 THEN post_text END")} AS caption
            FROM shot_ids WHERE image_src IS NOT NULL
        )
        SELECT seq AS page_no, 0::BIGINT AS pos, shot_id AS post_id, 'instagram' AS platform,
            {without_tags('caption')} AS post_text, {joined(tags('caption'), ',')} AS hashtags,
            coalesce(CASE WHEN seq % 2 = 0 THEN timestamp END,
                CASE WHEN seq % 5 = 0 THEN '3 days ago' END, {lit(AS_OF.replace(' ', 'T'))}) AS timestamp,
            image_src AS image_url, CAST(seq * 7919 % 20000 AS VARCHAR) AS likes,
            CASE WHEN seq % 8 <> 0 THEN CAST(seq % 700 AS VARCHAR) ELSE '' END AS comments,
            coalesce(author, '') AS author
        FROM captioned QUALIFY row_number() OVER (PARTITION BY shot_id ORDER BY captioned.seq) = 1""",
    "tweet_capture": f"""WITH {TWEET_ROWS}
        SELECT seq AS page_no, 0::BIGINT AS pos, tweet_id AS post_id, 'twitter' AS platform,
            {without_tags('cleaned')} AS post_text, {joined(tags('cleaned'), ',')} AS hashtags,
            CASE WHEN seq % 2 = 0 THEN coalesce(timestamp, '') ELSE '' END AS timestamp,
            CASE WHEN seq % 3 <> 0 THEN image_url ELSE '' END AS image_url,
            CAST({metric('metric_text')} AS VARCHAR) AS likes,
            CASE WHEN seq % 4 <> 0 THEN comments ELSE '0' END AS comments,
            tweet_author AS author, tweet_url AS url,
            CAST(CAST(trunc((seq % 90 + 0.5) * 1000) AS BIGINT) AS VARCHAR) AS retweet_count
        FROM tweets QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY tweets.seq) = 1""",
    "export_csv_roundtrip": over_posts(f"SELECT {COLUMNS} FROM posts"),
    "export_parquet_roundtrip": over_posts(f"SELECT {COLUMNS} FROM posts"),
    "csv_log_append": f"""WITH {POSTS_RAW}
        SELECT post_id, platform, post_text, hashtags, likes, author, NULL::VARCHAR AS url,
            CASE WHEN platform = 'twitter' THEN '7' END AS retweet_count
        FROM posts_raw""",
    "streaming_first_seen": f"""WITH {POSTS_RAW}
        SELECT platform, count(DISTINCT post_id) AS posts FROM posts_raw
        WHERE coalesce(post_id, '') <> '' GROUP BY platform""",
    "streaming_load": over_posts(f"SELECT {COLUMNS} FROM posts"),
}
# The same relations by other ways: through files, several writers, and the whole dashboard.
ORACLES |= {
    "mixed_load": ORACLES["table_load"],
    "collect_job": f"""WITH {POSTS_RAW},
        listed AS (
            SELECT seq AS page_no, 0 AS pos, 'r' || seq AS post_id, coalesce(author, '[deleted]') AS author FROM posts_raw
            UNION ALL SELECT seq, 1, 'c' || seq, '[deleted]' FROM posts_raw WHERE event_type <> 'error'
        ),
        numbered AS (SELECT *, row_number() OVER (ORDER BY page_no, pos) AS place FROM listed)
        SELECT post_id, author, CAST(CASE WHEN place <= 30 THEN 2 ELSE 1 END AS BIGINT) AS times FROM numbered WHERE place <= 70""",
    "streaming_metrics": ORACLES["load_run"],
    "streaming_detail_join": ORACLES["search_detail_join"],
    "frequent_hashtags": ORACLES["top_hashtags"],
    "frequent_authors": ORACLES["top_authors"],
    "streaming_latest_capture": ORACLES["upsert_latest_capture"],
    "streaming_error_lane": ORACLES["row_error_lane"],
    "import_csv": ORACLES["export_csv_roundtrip"],
    "read_reddit_files": ORACLES["reddit_listing"],
    "read_youtube_files": ORACLES["youtube_search"],
    "read_instagram_files": ORACLES["instagram_capture"],
    "read_tweet_files": ORACLES["tweet_capture"],
    "sql_join": over_posts(
        """SELECT author, count(*) FILTER (platform = 'reddit') AS here,
            count(*) FILTER (platform = 'youtube') AS there
        FROM posts WHERE author IS NOT NULL GROUP BY author HAVING here > 0 AND there > 0"""
    ),
    "export_both": over_posts(
        """SELECT kind, platform, count(*) AS posts, CAST(sum(likes) AS BIGINT) AS likes
        FROM posts, (VALUES ('csv'), ('parquet')) AS k(kind) GROUP BY kind, platform"""
    ),
    "dashboard": over_posts(
        """SELECT 'overview' AS section, NULL AS name, count(*) AS count FROM posts
        UNION ALL SELECT 'by_platform', platform, count(*) FROM posts GROUP BY platform
        UNION ALL SELECT 'sentiment', sentiment_label, count(*) FROM posts
            WHERE sentiment_label IS NOT NULL GROUP BY sentiment_label
        UNION ALL SELECT 'engagement', engagement_level, count(*) FROM posts
            WHERE engagement_level IS NOT NULL GROUP BY engagement_level
        UNION ALL SELECT * FROM (
            SELECT 'top_hashtags', trim(tag) AS tag, count(*) AS n
            FROM (SELECT unnest(string_split(hashtags, ',')) AS tag FROM posts WHERE hashtags <> '')
            WHERE trim(tag) <> '' GROUP BY trim(tag) ORDER BY n DESC, tag LIMIT 10)
        UNION ALL SELECT * FROM (
            SELECT 'top_authors', author, count(*) AS n FROM posts
            WHERE author IS NOT NULL AND author <> '[deleted]' GROUP BY author ORDER BY n DESC, author LIMIT 5)"""
    ),
    "export_one_file": ORACLES["export_csv_roundtrip"],
    "keyed_pages": over_posts(
        f"""SELECT CAST((row_number() OVER ({LIST_ORDER.format('likes')}, id) - 1) // 40 AS INTEGER) AS page, {COLUMNS}
        FROM posts QUALIFY page < 3"""
    ),
    "indexed_search": f"""WITH {after_loads(EARLIER, LATER)}
        SELECT term, post_id, platform, likes FROM posts, (VALUES {', '.join(f'({lit(t)})' for t in SEARCHED)}) AS s(term)
        WHERE post_text ILIKE '%' || term || '%'""",
    "kept_statistics": f"""WITH {after_loads(EARLIER, LATER, 'true')}
        {ORACLES['stats_bundle'].split(POSTS)[1]}
        UNION ALL SELECT 'top_author', author, count, NULL, NULL FROM (
            SELECT author, count(*) AS count FROM posts WHERE author IS NOT NULL AND author <> '[deleted]'
            GROUP BY author ORDER BY count DESC, author LIMIT 10)""",
    "sql_functions": f"""WITH {POSTS_RAW}
        SELECT seq, {clean_post('post_text')} AS cleaned, {joined(tags('post_text'))} AS tags, {safe_int('likes')} AS likes,
            {metric('metric_text')} AS metric, {parsed_time('timestamp')} AS parsed, {norm_tags('hashtags')} AS normal_tags,
            {engagement(f"({safe_int('likes')})", f"({safe_int('comments')})", lx.ETL_THRESHOLDS, 3)} AS level,
            {word_sentiment(clean_post('post_text'))} AS sentiment
        FROM posts_raw""",
}

"""Paged listings, search, previews and free SQL over ``posts``."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from postloom.functions import sql as sql_functions
from postloom.operators.analytics import on_platform
from postloom.operators.indexing import with_row_index
from postloom.schema import KEY

# Up to this many rows a page comes from a top-k; beyond it the rows kept per task
# would grow with the offset, so the same page is cut from a numbered global sort.
TOP_K_ROWS = 100_000
_VIEW = "posts"
_view_lock = threading.Lock()


def _order_items(posts: DataFrame, order_by: str) -> list[tuple[str, bool]]:
    """Column and descending flag of each item of ``"column [ASC|DESC], ..."``."""
    items = []
    for item in order_by.split(","):
        name, direction = (item.split() + ["ASC"])[:2]
        if name not in posts.columns or direction.upper() not in ("ASC", "DESC"):
            raise ValueError(f"cannot order by {item.strip()!r}")
        items.append((name, direction.upper() == "DESC"))
    return items


def parse_order(posts: DataFrame, order_by: str) -> list[Column]:
    """Sort columns of ``"column [ASC|DESC], ..."``; NULLs sort last either way."""
    return [(F.desc_nulls_last if down else F.asc_nulls_last)(name) for name, down in _order_items(posts, order_by)]


def _ties(posts: DataFrame) -> list[str]:
    """Columns that end every order; ``id`` is unique where there is one."""
    return [*reversed(KEY), *(["id"] if "id" in posts.columns else [])]


def get_posts(
    posts: DataFrame,
    platform: str | None = None,
    limit: int = 100,
    offset: int = 0,
    order_by: str = "scraped_at DESC",
    top_k_rows: int = TOP_K_ROWS,
) -> DataFrame:
    """One page of posts.

    Ties are broken by platform, post id and ``id``, which must be unique; where there is no
    ``id``, by a hash of the row. A row so has one place, the same for every offset. A deep page is
    cut from numbered sort keys, and only its own rows are fetched whole.
    """
    rows = on_platform(posts, platform)
    has_id = "id" in rows.columns
    order = [*parse_order(posts, order_by), *[F.asc(t) for t in _ties(rows)]]
    if not has_id:
        order.append(F.asc(F.xxhash64(*rows.columns)))
    if offset + limit <= top_k_rows:
        return rows.orderBy(*order).offset(offset).limit(limit)
    names = [name for name, _ in _order_items(posts, order_by)]
    keys = rows.select(*dict.fromkeys([*names, *_ties(rows)])) if has_id else rows
    numbered = with_row_index(keys, order, "_index")
    page = numbered.filter(F.col("_index").between(offset, offset + limit - 1))
    if has_id:
        page = rows.join(page.select("id", "_index"), "id")
    return page.orderBy("_index").select(*rows.columns)


def _behind(name: str, down: bool, nulls_first: bool, value) -> Column:
    """Rows that a column alone puts behind a value."""
    column = F.col(name)
    if value is None:
        return column.isNotNull() if nulls_first else F.lit(False)
    further = column < F.lit(value) if down else column > F.lit(value)
    return further if nulls_first else further | column.isNull()


def posts_after(
    posts: DataFrame,
    after: Row | dict | None = None,
    platform: str | None = None,
    limit: int = 100,
    order_by: str = "scraped_at DESC",
) -> DataFrame:
    """The page behind a row, in the order of :func:`get_posts`; the first page without one.

    ``after`` is the last row of the page before, or its sort columns, platform, post id and id. A page
    costs the same wherever it is: no row before it is sorted. The condition on the leading
    sort column stands alone, so it reaches the scan, and a table written by
    :func:`write_in_order` skips the row groups before the page.
    """
    rows = on_platform(posts, platform)
    items = [(name, down, False) for name, down in _order_items(posts, order_by)]
    items += [(name, False, True) for name in _ties(rows)]
    if "id" not in rows.columns:
        raise ValueError("pages by key need the unique id")
    order = [*parse_order(posts, order_by), *[F.asc(t) for t in _ties(rows)]]
    if after is not None:
        values = after.asDict() if isinstance(after, Row) else after
        behind, same = F.lit(False), F.lit(True)
        for name, down, nulls_first in items:
            behind = behind | (same & _behind(name, down, nulls_first, values[name]))
            same = same & F.col(name).eqNullSafe(F.lit(values[name]))
        lead, down, _ = items[0]
        if values[lead] is None:
            reached = F.col(lead).isNull()
        else:
            reached = (F.col(lead) <= F.lit(values[lead]) if down else F.col(lead) >= F.lit(values[lead])) | F.col(lead).isNull()
        rows = rows.filter(reached & behind)
    return rows.orderBy(*order).limit(limit)


def write_in_order(posts: DataFrame, path: str, order_by: str) -> str:
    """Posts as Parquet in sort order, so that row groups hold narrow ranges of the leading column."""
    order = [*parse_order(posts, order_by), *[F.asc(t) for t in _ties(posts)]]
    posts.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    return path


def top_posts_by_likes(posts: DataFrame, limit: int = 20) -> DataFrame:
    return get_posts(posts, limit=limit, order_by="likes DESC")


def matching(posts: DataFrame, term: str) -> DataFrame:
    """Posts whose text contains the term, ignoring case.

    ``%`` and ``_`` in the term are wildcards; a backslash is an ordinary character.
    """
    parts = [p for p in term.split("%") if p]
    if len(parts) <= 1 and "_" not in term:
        pattern = "%" + "".join(parts).replace("\\", "\\\\") + "%"
        return posts.filter(F.col("post_text").ilike(pattern))
    return posts.filter(F.rlike(F.lower("post_text"), _in_order(parts)))


def _in_order(parts: list[str]) -> Column:
    """Pattern for lower-cased texts that hold the parts one behind the other; ``_`` is any character.

    The leftmost place of a part leaves the most for those behind it, so none is ever tried again:
    the time grows with the length of the text, where LIKE's own search goes back for every wildcard.
    """
    pattern = [F.lit(r"(?s)\A")]
    for part in parts:
        pattern.append(F.lit("(?>.*?"))
        for number, literal in enumerate(part.split("_")):
            # Lower-cased, a literal cannot hold the mark that ends the quotation.
            pattern += [F.lit("." if number else ""), F.lit(r"\Q"), F.lower(F.lit(literal)), F.lit(r"\E")]
        pattern.append(F.lit(")"))
    return F.concat(*pattern)


def search(posts: DataFrame, term: str, limit: int = 100) -> DataFrame:
    """Matching posts, most liked first."""
    return top_posts_by_likes(matching(posts, term), limit)


def query(spark: SparkSession, posts: DataFrame, sql: str, params: list | None = None) -> DataFrame:
    """Any SQL over a view named ``posts``, with positional ``?`` parameters.

    The cleaning, parsing and label functions of :mod:`postloom.functions.sql` can be called. The name is bound to these posts while the statement is analysed and then given back: a view
    that the session has under it stays what it was.
    """
    with _view_lock:
        sql_functions.register_used(spark, sql)
        known = any(t.isTemporary and t.name == _VIEW for t in spark.catalog.listTables())
        before = spark.table(_VIEW) if known else None
        posts.createOrReplaceTempView(_VIEW)
        try:
            return spark.sql(sql, args=params or [])
        finally:
            if before is None:
                spark.catalog.dropTempView(_VIEW)
            else:
                before.createOrReplaceTempView(_VIEW)


def preview(rows: DataFrame, limit: int = 20) -> DataFrame:
    """Display columns of the first rows of an ordered result, numbered from 1."""
    content = F.coalesce("post_text", F.lit("None"))
    shown = rows.limit(limit).select(
        F.coalesce("platform", F.lit("None")).alias("platform"),
        F.substring(F.coalesce("author", F.lit("None")), 1, 12).alias("author"),
        F.concat(
            F.substring(content, 1, 35), F.when(F.length(content) > 35, "...").otherwise("")
        ).alias("content"),
        F.col("likes").cast("string").alias("likes"),
        F.coalesce("sentiment_label", F.lit("")).alias("sentiment"),
    )
    # A limit leaves one partition, so these numbers are 0, 1, 2, ...
    return shown.select((F.monotonically_increasing_id() + 1).alias("row"), "*")


def preview_more(rows: DataFrame, limit: int = 20) -> DataFrame:
    """The line below a preview: how many rows are not shown, or nothing."""
    counted = rows.agg((F.count(F.lit(1)) - limit).alias("more"))
    return counted.filter(F.col("more") > 0).select(
        F.concat(F.lit("+"), F.col("more").cast("string"), F.lit(" more")).alias("more")
    )

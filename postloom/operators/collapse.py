"""Keep one row per key without sending a whole group to one task."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collapse(
    df: DataFrame,
    keys: list[str],
    first: list[str],
    last: list[str] | None = None,
    order: str = "seq",
    last_order: str | None = None,
    greatest: list[str] | None = None,
    whole: bool = False,
) -> DataFrame:
    """One row per key: ``first`` columns of its earliest row, ``last`` of its latest, the ``greatest`` of others.

    The aggregates combine on the map side, so a key that holds a large part of
    the rows sends one row per map task. One aggregate per column lets the
    optimizer drop those nobody reads. ``order`` must be unique within a key.

    ``whole``: all columns are read. Then the first columns are one aggregate and the last ones another, so a
    row that is sorted and shuffled carries its order twice and not with every column.
    """
    if whole:
        firsts, lasts = [c for c in first if c not in keys], last or []
        merged = df.groupBy(*keys).agg(
            *([F.min_by(F.struct(*firsts), order).alias("_first")] if firsts else []),
            *([F.max_by(F.struct(*lasts), last_order or order).alias("_last")] if lasts else []),
            *[F.max(c).alias(c) for c in greatest or []],
        )
        fields = [F.col(f"{side}.{c}").alias(c) for side, names in (("_first", firsts), ("_last", lasts)) for c in names]
        return merged.select(*keys, *fields, *(greatest or []))
    return df.groupBy(*keys).agg(
        *[F.min_by(c, order).alias(c) for c in first if c not in keys],
        *[F.max_by(c, last_order or order).alias(c) for c in last or []],
        *[F.max(c).alias(c) for c in greatest or []],
    )


def first_rows(df: DataFrame, keys: list[str], order: str = "seq", whole: bool = False) -> DataFrame:
    """The earliest row of every key in one pass over the input, for rows that take long to compute."""
    return collapse(df, keys, df.columns, order=order, whole=whole).select(*df.columns)


def _some_null(names: list[str]) -> Column:
    return reduce(or_, [F.col(name).isNull() for name in names])


def keep_first(df: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """The earliest row of every key, with all its columns.

    The first place of every key is found from keys and order alone and matched back by hash, so
    whole rows are sorted only behind the shuffle and those of a repeated key stay spread over
    the tasks. The input is read twice; see :func:`first_rows` for one that is expensive.
    """
    firsts = df.groupBy(*keys).agg(F.min(order).alias(order))
    found = df.join(firsts.hint("shuffle_hash"), [*keys, order])
    # Rows that share key and place are together already: nothing more is shuffled.
    kept = collapse(found, [*keys, order], df.columns, order=order).select(*df.columns)
    # Equality finds no NULL. Keys with a NULL are one group each, a key without any place keeps no row's values.
    unkeyed = first_rows(df.filter(_some_null(keys)), keys, order)
    unplaced = firsts.filter(~_some_null(keys) & F.col(order).isNull())
    absent = [(F.col(f.name) if f.name in keys else F.lit(None).cast(f.dataType)).alias(f.name) for f in df.schema]
    return kept.unionByName(unkeyed).unionByName(unplaced.select(*absent))

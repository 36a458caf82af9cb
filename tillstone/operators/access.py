"""Read access to published tables: predicates, projections, pages, counts, previews and the served encoding.

These return Columns and DataFrames for the caller to compose; Catalyst pushes them into the scan.
"""

from __future__ import annotations

import operator
import re
from bisect import bisect_right
from collections.abc import Sequence
from datetime import date, datetime
from itertools import accumulate
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPARISONS = {
    "eq": operator.eq,
    "ne": operator.ne,
    "gt": operator.gt,
    "ge": operator.ge,
    "lt": operator.lt,
    "le": operator.le,
}
PAGE_SIZE = 20_000
GATHERED = 100_000  # rows up to the end of a page that may meet in one task
RANGES, SAMPLED = 64, 16  # ranges that rows are counted by, and sampled rows per range
PREVIEW_MAX = 2_000


class InvalidRequest(ValueError):
    """The request names a column, operator or direction that does not exist."""


def column(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        raise InvalidRequest(f"unknown column: {name}")
    return F.col(f"`{name}`")


def filter_compare(left: Column, op: str, value: Any) -> Column:
    """``left op value``.  NULL compares with eq and ne only, as IS [NOT] NULL; ne otherwise drops NULL rows."""
    if op not in COMPARISONS:
        raise InvalidRequest(f"unknown comparison: {op}")
    if value is None:
        if op not in ("eq", "ne"):
            raise InvalidRequest("null compares with eq and ne only")
        return left.isNull() if op == "eq" else left.isNotNull()
    return COMPARISONS[op](left, value if isinstance(value, Column) else F.lit(value))


def filter_text(left: Column, how: str, value: str | Column | None) -> Column:
    """contains, startswith, endswith: case ignored, wildcards in the value active, a NULL value acts as ''."""
    text = value if isinstance(value, Column) else F.lit(value).cast("string")
    text = F.coalesce(text, F.lit(""))
    shapes = {"contains": ("%", "%"), "startswith": ("", "%"), "endswith": ("%", "")}
    if how not in shapes:
        raise InvalidRequest(f"unknown text test: {how}")
    before, after = shapes[how]
    pattern = F.concat(F.lit(before), text, F.lit(after))
    return F.call_function("ilike", left, pattern)


def transform_text(c: Column, how: str) -> Column:
    functions = {"tolower": F.lower, "toupper": F.upper, "trim": F.trim}
    if how not in functions:
        raise InvalidRequest(f"unknown text function: {how}")
    return functions[how](c)


def date_part(c: Column, part: str) -> Column:
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth, "date": F.to_date}
    if part not in parts:
        raise InvalidRequest(f"unknown date part: {part}")
    return parts[part](c)


def date_literal(text: str) -> Column:
    """A date, or a date-time whose offset is dropped without converting: stored times are local."""
    try:
        if re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
            return F.lit(date.fromisoformat(text))
        moment = datetime.fromisoformat(text).replace(tzinfo=None)
    except ValueError as problem:
        raise InvalidRequest(f"not a date: {text}") from problem
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Projection with checked names; ``id`` goes first if it was not asked for, since paging needs it."""
    wanted = list(names) if "id" in names else ["id", *names]
    return df.select(*[column(df, n) for n in wanted])


def page_by_offset(
    df: DataFrame,
    order: Sequence[tuple[str, str]] = (),
    top: int | None = None,
    skip: int = 0,
    page_size: int = PAGE_SIZE,
    gathered: int = GATHERED,
) -> DataFrame:
    """Rows ``skip`` … of an ordered result, at any depth.  NULLs sort as in the served database; ``id`` settles ties.

    A page that ends within the first ``gathered`` rows is a top-n.  For one further on, the rows are counted by ranges of the order, and only the range
    that holds the page is read and sorted: see ``_range_of_page``.
    """
    if skip < 0:
        raise InvalidRequest("skip must not be negative")
    wanted = []
    for name, direction in order:
        if direction.lower() not in ("asc", "desc"):
            raise InvalidRequest(f"unknown direction: {direction}")
        column(df, name)
        wanted.append((name, direction.lower() == "asc"))
    wanted.append(("id", True))
    limit = page_size if top is None else min(top, page_size)
    if skip + limit > gathered:
        df, skip = _range_of_page(df, wanted, skip, limit, gathered)
    return df.orderBy(*[_sorted(*key) for key in wanted]).offset(skip).limit(limit)


def _sorted(name: str, ascending: bool) -> Column:
    c = F.col(f"`{name}`")
    return c.asc_nulls_last() if ascending else c.desc_nulls_first()


def _before(order: Sequence[tuple[str, bool]], border: Sequence[Any], df: DataFrame) -> Column:
    """Whether a row comes before the border row, NULLs in their places."""
    found = F.lit(False)
    for (name, ascending), value in reversed(list(zip(order, border, strict=True))):
        c = F.col(f"`{name}`")
        if value is None:
            less, same = (c.isNotNull() if ascending else F.lit(False)), c.isNull()
        else:
            at = F.lit(value).cast(df.schema[name].dataType)
            less = F.coalesce(c < at, F.lit(False)) if ascending else F.coalesce(c > at, F.lit(True))
            same = c.eqNullSafe(at)
        found = less | (same & found)
    return found


def _range(order: Sequence[tuple[str, bool]], borders: Sequence, df: DataFrame, first: int = 0) -> Column:
    """The number of borders that a row does not come before, by halving."""
    if not borders:
        return F.lit(first)
    middle = len(borders) // 2
    return F.when(_before(order, borders[middle], df), _range(order, borders[:middle], df, first)).otherwise(
        _range(order, borders[middle + 1 :], df, first + middle + 1)
    )


def _range_of_page(
    df: DataFrame, order: Sequence[tuple[str, bool]], skip: int, limit: int, gathered: int = GATHERED
) -> tuple[DataFrame, int]:
    """The part of ``df`` that holds the page, and how many of its rows come before the page.

    Borders are taken from a sample of the rows; they bear on the sizes of the ranges, not on the result.  Rows are counted by
    range with map-side combine, and the ranges of the page make the part to go on with, until what stands before the
    page in it is small.  Each round reads the order's columns of the part; the driver gets the sample and ``RANGES`` counts.
    """
    # Times go to the driver and back as text, so that no clock's zone comes between.
    kept = [F.col(f"`{n}`").cast("string") if isinstance(df.schema[n].dataType, T.DatetimeType) else F.col(f"`{n}`") for n, _ in order]
    part, rows, tries = df, df.count(), 0
    while skip + limit > gathered and tries < 5:
        if skip >= rows:
            return df.limit(0), 0
        sample = part.sample(min(1.0, SAMPLED * RANGES / rows), seed=tries)
        drawn = [tuple(r) for r in sample.orderBy(*[_sorted(*key) for key in order]).select(*kept).collect()]
        borders = list(dict.fromkeys(drawn[SAMPLED::SAMPLED]))
        counted = part.groupBy(_range(order, borders, df).alias("range")).count().collect()
        sizes = dict.fromkeys(range(len(borders) + 1), 0) | {r["range"]: r["count"] for r in counted}
        ends = list(accumulate(sizes[i] for i in range(len(borders) + 1)))
        first = bisect_right(ends, skip)
        last = min(bisect_right(ends, skip + limit - 1), len(borders))
        held = ends[last] - (ends[first - 1] if first else 0)
        if held == rows:  # nothing is cut off: other borders; never any, if most of the ids were the same
            tries += 1
            continue
        if first:
            part = part.where(~_before(order, borders[first - 1], df))
        if last < len(borders):
            part = part.where(_before(order, borders[last], df))
        skip, rows = skip - (ends[first - 1] if first else 0), held
    return part, skip


def page_by_key(df: DataFrame, after: Any = None, top: int | None = None, page_size: int = PAGE_SIZE) -> DataFrame:
    """The page of rows following ``after`` in ``id`` order: a top-n per task, never a full sort."""
    limit = page_size if top is None else min(top, page_size)
    rest = df if after is None else df.where(F.col("id") > F.lit(after))
    return rest.orderBy(F.col("id").asc()).limit(limit)


def next_token(last_id: Any, rows: int, top: int | None = None, page_size: int = PAGE_SIZE) -> Any:
    """Where the next page starts, or None when the page was short or ``top`` is reached."""
    limit = page_size if top is None else min(top, page_size)
    more_wanted = top is None or top > rows
    return last_id if rows > 0 and rows == limit and more_wanted else None


def filtered_count(df: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Rows matching the filter alone; the position of the page plays no part."""
    matching = df if predicate is None else df.where(predicate)
    return matching.agg(F.count(F.lit(1)).alias("count"))


def bounded_preview(df: DataFrame, limit: int = 200, order: Sequence[str] = ("id",)) -> DataFrame:
    """At most ``limit`` rows (1 … 2000) in ``order``, each with ``truncated`` = more rows exist.

    One row beyond the limit is read to know.  The window runs over those few rows only.
    """
    limit = max(1, min(int(limit), PREVIEW_MAX))
    head = df.orderBy(*order).limit(limit + 1)
    everything = Window.partitionBy(F.lit(1))
    return (
        head.withColumn("_row", F.row_number().over(everything.orderBy(*order)))
        .withColumn("truncated", F.count(F.lit(1)).over(everything) > limit)
        .where(F.col("_row") <= limit)
        .drop("_row")
    )


def _served(field: T.StructField) -> Column:
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.DecimalType):
        c = c.cast("double")
    elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    elif isinstance(kind, T.DateType):
        c = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(kind, T.DayTimeIntervalType):
        seconds = F.unix_seconds(F.lit("1970-01-01T00:00:00Z").cast("timestamp") + c)
        pieces = (F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60)
        c = F.format_string("%02d:%02d:%02d", *pieces)
    elif isinstance(kind, T.BinaryType):
        c = F.lower(F.hex(c))
    return c.alias(field.name)


def wire_format(df: DataFrame) -> DataFrame:
    """Served encoding: decimals as doubles, dates and date-times as ISO text ('Z', local time), bytes as hex."""
    return df.select(*[_served(f) for f in df.schema.fields])


def wire_json(df: DataFrame) -> DataFrame:
    """One JSON document per row in the served encoding, NULL fields kept."""
    return wire_format(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))

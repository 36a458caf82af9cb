"""Landing: copies of source tables, raw response pages, and the checks that what landed is complete."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.functions.columns import WHITESPACE

FETCH_SIZE = 2000  # rows per round trip of a JDBC copy


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    fetch_size: int = FETCH_SIZE,
) -> dict[str, str]:
    """Reader options for a table copy.  ``split`` = (column, lower, upper, parts) reads it in parallel.

    A query takes part in a split read as a derived table, because the two options exclude each other.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size)}
    if split is None:
        options.update({"dbtable": table} if table else {"query": query})
        return options
    name, lower, upper, parts = split
    options["dbtable"] = table or f"({query}) source"
    options.update(
        partitionColumn=name, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts)
    )
    return options


def jdbc_copy(spark: SparkSession, **options) -> DataFrame:
    """A source table as delivered over JDBC, with names and texts normalised."""
    return normalize_text(spark.read.format("jdbc").options(**jdbc_options(**options)).load())


def normalize_text(df: DataFrame) -> DataFrame:
    """Names trimmed and lower-cased; texts without trailing white space and NUL characters; NULL stays."""

    def clean(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.VarcharType, T.CharType)):
            c = F.replace(F.rtrim(c, F.lit(WHITESPACE)), F.lit("\x00"), F.lit(""))
        return c.alias(field.name.strip().lower())

    return df.select(*[clean(f) for f in df.schema.fields])


_KEPT = (T.BooleanType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def widen_schema(df: DataFrame) -> DataFrame:
    """Copy with every integer as bigint, every float as double, exact and time types kept, the rest as text."""

    def widened(field: T.StructField) -> Column:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            c = c.cast("double")
        elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c)
        elif not isinstance(kind, _KEPT):
            c = c.cast("string")
        return c.alias(field.name.lower())

    return df.select(*[widened(f) for f in df.schema.fields])


def source_projection(
    df: DataFrame, drop: Sequence[str] = (), add: Mapping[str, Column] | None = None
) -> DataFrame:
    """Read a table without its heavy columns and with computed ones; the scan reads only what is left."""
    return df.withColumns(dict(add or {})).drop(*drop)


# -- raw pages -------------------------------------------------------------------------------------------------

PAGE_SCHEMA = "run string, endpoint string, parameters string, extracted_at timestamp_ntz, payload string"


def land_pages(pages: DataFrame, location: str) -> None:
    """Append raw responses as they came, one directory per endpoint."""
    pages.write.mode("append").partitionBy("endpoint").parquet(location)


def explode_pages(pages: DataFrame, list_key: str, item_schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """Items of the list under ``list_key`` in each page's payload.

    A page without the list (another shape, or cut short) fails the task that meets it: it holds rows that would
    otherwise be missing without a trace.  An empty list gives none.
    """
    kind = f"array<{item_schema}>"
    listed = F.from_json(F.get_json_object("payload", f"$.{list_key}"), kind, {"mode": "FAILFAST"})
    message = F.concat(F.lit(f"page without the list '{list_key}': "), F.coalesce(F.substring("payload", 1, 200), F.lit("null")))
    items = F.coalesce(listed, F.raise_error(message).cast(kind))
    return pages.select(*keep, F.explode(items).alias("item")).select(*keep, "item.*")


def first_list(payload: Column) -> Column:
    """JSON text of a response's list: the response itself if it is one, else its first field that is one.

    NULL means a whole object without a list. A response that is missing, cut short or neither list nor object fails the
    task that meets it.
    """
    strict = {"mode": "FAILFAST"}
    fields = F.map_entries(F.from_json(payload, "map<string,string>", strict))
    lists = F.filter(fields, lambda f: F.ltrim(f["value"]).startswith("["))
    whole = F.from_json(payload, "array<string>", strict)  # parsed only to see that it is whole
    return (
        F.when(payload.isNull(), F.raise_error(F.lit("response without a payload")))
        .when(F.ltrim(payload).startswith("["), F.when(F.size(whole) >= 0, payload))
        .otherwise(F.get(lists, 0)["value"])
    )


def balance_pairs(pages: DataFrame, first: str = "stock", second: str = "item") -> DataFrame:
    """The two ids of each balance line.  The payload is a list, or an object with ``results``.

    A payload that is missing, cut short or of another shape, and a line lacking either id, mean that the format changed: the
    job fails rather than landing half a balance.
    """
    line, strict = f"array<struct<{first}:bigint, {second}:bigint>>", {"mode": "FAILFAST"}
    listed = F.when(F.ltrim("payload").startswith("["), F.from_json("payload", line, strict)).otherwise(
        F.from_json("payload", f"results {line}", strict)["results"]
    )
    shown = F.coalesce(F.substring("payload", 1, 200), F.lit("null"))
    lines = F.coalesce(listed, F.raise_error(F.concat(F.lit("balance in an unexpected format: "), shown)).cast(line))
    both = F.col(f"line.{first}").isNotNull() & F.col(f"line.{second}").isNotNull()

    def checked(name: str) -> Column:
        return F.when(both, F.col(f"line.{name}")).otherwise(
            F.raise_error(F.lit("balance line in an unexpected format")).cast("bigint")
        )

    rest = [c for c in pages.columns if c != "payload"]
    return pages.select(*rest, F.explode(lines).alias("line")).select(
        *rest, checked(first).alias(first), checked(second).alias(second)
    )


def ids_done(extracted: DataFrame, parameter: str, error_key: str, *keep: str) -> DataFrame:
    """``id``: what each response was asked for, of those without an error; repeats allowed."""
    return (
        extracted.where(F.get_json_object("payload", f"$.{error_key}").isNull())
        .select(*keep, F.get_json_object("parameters", f"$.{parameter}").alias("id"))
        .where("id is not null")
    )


def ids_not_done(entities: DataFrame, entity_id: str, mutable: Column, done: DataFrame) -> DataFrame:
    """Ids whose detail must be read again: still able to change, or not among ``done`` (a column ``id``).

    Spark filters the larger side by a Bloom filter of the other before it shuffles where that pays.
    """
    found = done.select(F.col("id").alias("_done")).distinct()
    seen = entities.join(found, F.col(entity_id).cast("string") == F.col("_done"), "left")
    return seen.where(F.coalesce(mutable, F.lit(False)) | F.col("_done").isNull()).select(entity_id)


def ids_to_refresh(
    entities: DataFrame, entity_id: str, mutable: Column, extracted: DataFrame, parameter: str, error_key: str
) -> DataFrame:
    """The same from all responses ever extracted; ``pages.refresh_ledger`` keeps what this parses anew each time."""
    return ids_not_done(entities, entity_id, mutable, ids_done(extracted, parameter, error_key))


# -- completeness ----------------------------------------------------------------------------------------------


class IncompleteRead(RuntimeError):
    """What landed is not what the source announced."""


def require_complete(mismatches: DataFrame, what: str, shown: int = 20) -> None:
    """Stop the load if one of the checks below found a mismatch.  Brings ``shown`` of its rows to the driver."""
    found = mismatches.limit(shown).collect()
    if found:
        raise IncompleteRead(f"{what}: " + "; ".join(str(row.asDict()) for row in found))


def completeness_by_window(landed: DataFrame, announced: DataFrame, window: Sequence[str]) -> DataFrame:
    """Windows whose landed row count differs from the announced ``total`` (no total announced: not checked)."""
    counted = landed.groupBy(*window).agg(F.count(F.lit(1)).alias("landed"))
    compared = announced.where(F.col("total").isNotNull()).join(counted, list(window), "left")
    return compared.select(
        *window, F.coalesce("landed", F.lit(0)).alias("landed"), F.col("total").cast("bigint").alias("announced")
    ).where("landed <> announced")


def completeness_by_ids(items: DataFrame, item_id: str, pages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct ids against the sum of the totals announced on page 1 of each filter; one row if they differ."""
    group = list(by)
    # Ids are made distinct first, so counting them is a plain count with map-side combine for any group size.
    distinct = items.select(*group, item_id).distinct().groupBy(*group).agg(F.count(item_id).alias("distinct_ids"))
    totals = (
        pages.where(F.col("page") == 1).groupBy(*group).agg(F.sum("total").cast("bigint").alias("announced"))
    )
    if not group:
        distinct, totals, group = distinct.withColumn("_all", F.lit(1)), totals.withColumn("_all", F.lit(1)), ["_all"]
    compared = totals.join(distinct, group, "left").select(
        *group, F.coalesce("distinct_ids", F.lit(0)).alias("distinct_ids"), "announced"
    )
    return compared.where("distinct_ids <> announced").drop("_all")

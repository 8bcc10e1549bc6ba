"""JDBC tables, read in parallel and with the predicate in the database."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    """Where a table lives. ``options`` holds user, password, driver and the like."""

    url: str
    table: str
    options: dict[str, str] = field(default_factory=dict)


def scan_options(
    src: JdbcTable,
    *,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 4,
    predicate: str | None = None,
    columns: list[str] | None = None,
) -> dict[str, str]:
    """Reader options. With ``column`` the scan is split into ranges between the *real* bounds of
    the window, so that recent rows spread over all partitions."""
    select = ", ".join(columns) if columns else "*"
    where = f" WHERE {predicate}" if predicate else ""
    opts = {**src.options, "url": src.url, "dbtable": f"(SELECT {select} FROM {src.table}{where}) src"}
    if column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned scan needs both bounds")
        opts |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return opts


def window_scan(
    spark: SparkSession, src: JdbcTable, time_column: str, start_ms: int, end_ms: int,
    partitions: int = 4, columns: list[str] | None = None,
) -> DataFrame:
    """Rows with ``start_ms < time_column < end_ms``, split into time ranges."""
    opts = scan_options(
        src, column=time_column, lower=start_ms, upper=end_ms, partitions=partitions, columns=columns,
        predicate=f"{time_column} > {start_ms} AND {time_column} < {end_ms}",
    )
    return spark.read.format("jdbc").options(**opts).load()


def table_scan(
    spark: SparkSession, src: JdbcTable, columns: list[str] | None = None, predicate: str | None = None
) -> DataFrame:
    """A table read by one task: only for dictionaries and other small tables."""
    return spark.read.format("jdbc").options(**scan_options(src, columns=columns, predicate=predicate)).load()


def append(df: DataFrame, dst: JdbcTable, partitions: int = 4) -> None:
    """Insert rows from ``partitions`` parallel connections."""
    df.write.format("jdbc").options(
        **dst.options, url=dst.url, dbtable=dst.table, numPartitions=str(partitions)
    ).mode("append").save()


def truncate_insert(df: DataFrame, dst: JdbcTable, partitions: int = 4) -> None:
    """Replace the rows of a table and keep its definition."""
    df.write.format("jdbc").options(
        **dst.options, url=dst.url, dbtable=dst.table, numPartitions=str(partitions), truncate="true"
    ).mode("overwrite").save()

"""Selections and dictionaries over the news, event, stock and board tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.functions.periods import span

# Listed-stock codes and board codes.
LISTED_EXCHANGES = ("001002", "001003")
SECURITY_TYPE = "101"
CURRENCY = "CNY"
DELISTED = "2"
SECTION_BOARD = "1105"
INDUSTRY_BOARD = "1109"
NO_NEWS = "no"


def look_back(df: DataFrame, time: str, as_of: Column, hours: int, bounded: bool = True) -> DataFrame:
    """Rows inside the open interval ``(as_of - hours, as_of)``; without ``bounded`` only the lower end."""
    recent = df.where(F.col(time) > as_of - span(hours=hours))
    return recent.where(F.col(time) < as_of) if bounded else recent


def events_since(events: DataFrame, start: Column, days: int = 3, time: str = "start_time") -> DataFrame:
    """Events from ``days`` before ``start`` on."""
    return events.where(F.col(time) >= start - span(days=days))


def valid_events(events: DataFrame) -> DataFrame:
    """Valid events that name at least one news item; null-safe."""
    return events.where((F.col("is_valid") == 1) & (F.coalesce(F.size("related_news"), F.lit(0)) > 0))


def plain_type(news: DataFrame, column: str = "type") -> DataFrame:
    """News of type 0; a null type is none."""
    return news.where(F.col(column) == 0)


def tagged_news(news: DataFrame, lists: tuple[str, ...] = ("industry", "section", "stock")) -> DataFrame:
    """News with at least one non-empty property list; null-safe."""
    return news.where(reduce(lambda a, b: a | b, [F.coalesce(F.size(c), F.lit(0)) > 0 for c in lists]))


def listed_stocks(codes: DataFrame) -> DataFrame:
    """``stock`` of listed, valid ordinary shares."""
    return codes.where(
        F.col("exchange").isin(*LISTED_EXCHANGES)
        & (F.col("setype") == SECURITY_TYPE)
        & (F.col("cur") == CURRENCY)
        & (F.col("isvalid") == 1)
        & (F.col("liststatus") != DELISTED)
    ).select(F.col("symbol").alias("stock"))


def news_of_events(news: DataFrame, events: DataFrame) -> DataFrame:
    """News that at least one event names."""
    ids = events.select(F.explode("related_news").alias("news_id"))
    return news.join(ids, "news_id", "left_semi")


def null_to_empty(df: DataFrame) -> DataFrame:
    return df.na.fill("")


def category_dictionary(board: DataFrame) -> DataFrame:
    """``category, name``: every symbol, and the section and industry names of their boards."""
    kind = (
        F.when(F.col("boardcode") == SECTION_BOARD, "section")
        .when(F.col("boardcode") == INDUSTRY_BOARD, "industry")
    )
    # One scan and one shuffle for all three categories.
    entries = F.array(
        F.struct(F.lit("stock").alias("category"), F.col("symbol").cast("string").alias("name")),
        F.struct(kind.alias("category"), F.col("keyname").cast("string").alias("name")),
    )
    return board.select(F.inline(entries)).where(F.col("category").isNotNull()).distinct()


def merge_dictionary(additions: DataFrame, existing: DataFrame, line: str = "value") -> DataFrame:
    """``word``: existing words and the space-separated words of the added lines, without repeats."""
    new = additions.select(F.explode(F.split(F.trim(F.col(line)), " ")).alias("word"))
    return new.unionByName(existing.select("word")).distinct()

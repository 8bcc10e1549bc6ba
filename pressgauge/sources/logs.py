"""Text logs and dictionaries as typed DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.functions import periods
from pressgauge.functions.text import decode_escapes, strip_bom

# Search-log layout.
SEARCH_FIELDS = 8
SEARCH_USER_FIELD = 1
SEARCH_QUERY_FIELD = 7
NO_QUERY = "NoDef"


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Columns ``value, file_name, path`` of one or many files, globs or folders in a single scan."""
    many = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(many).select(
        "value", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("path")
    )


def spread(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """The rows hashed by ``keys`` to ``parts`` tasks, for work that is heavy per row on files that cannot be split;
    None leaves the scan as it is."""
    return df if parts is None else df.repartition(parts, *keys)


def present(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the paths that exist: an hour without a log has no folder."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    places = [(p, fs.Path(p)) for p in paths]
    return [p for p, place in places if place.getFileSystem(conf).exists(place)]


def _fields(line: Column, sep: str) -> Column:
    """Split and drop trailing empty fields, so that the field count means what it says."""
    return F.split(F.rtrim(line, F.lit(sep)), sep)


def parse_search_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """``user_id, query`` of lines with exactly eight tab fields and a defined, decodable query."""
    fields = _fields(F.col(line), "\t")
    return (
        lines.where(F.size(fields) == SEARCH_FIELDS)
        .select(
            F.get(fields, F.lit(SEARCH_USER_FIELD)).alias("user_id"),
            F.get(fields, F.lit(SEARCH_QUERY_FIELD)).alias("query"),
        )
        .where(F.col("query") != NO_QUERY)
        # Unfolded from a list, so that the filter on the result does not decode a second time.
        .select("user_id", F.explode_outer(F.array(decode_escapes(F.col("query")))).alias("query"))
        .where(F.col("query").isNotNull())
    )


def parse_visit_log(lines: DataFrame, line: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``slot, url, cnt`` (and the ``keep`` columns) of lines ``slot,url<TAB>count``.

    A line with another number of commas or tabs, or a count that is no integer, is dropped; so a
    url with a comma never gets through.
    """
    by_comma = _fields(F.col(line), ",")
    by_tab = _fields(F.get(by_comma, F.lit(1)), "\t")
    return (
        lines.where((F.size(by_comma) == 2) & (F.size(by_tab) == 2))
        .select(
            *keep,
            F.get(by_comma, F.lit(0)).alias("slot"),
            F.get(by_tab, F.lit(0)).alias("url"),
            F.get(by_tab, F.lit(1)).try_cast("bigint").alias("cnt"),
        )
        .where(F.col("cnt").isNotNull())
    )


def parse_day_visits(lines: DataFrame, line: str = "value") -> DataFrame:
    """``hour, url, cnt`` of a day file, whose slot is ``yyyy-MM-dd-HH``."""
    return (
        parse_visit_log(lines, line)
        .withColumn("hour", periods.parse_period_key(F.col("slot"), periods.LOG_HOUR_KEY))
        .where(F.col("hour").isNotNull())
        .select("hour", "url", "cnt")
    )


def parse_hour_visits(lines: DataFrame, line: str = "value", file_name: str = "file_name") -> DataFrame:
    """``hour, url, cnt`` of hour files, whose *name* is the hour in epoch milliseconds."""
    hour_ms = F.col(file_name).try_cast("bigint")
    return (
        parse_visit_log(lines, line, keep=[file_name])
        .where(hour_ms.isNotNull())
        .select(periods.from_millis(hour_ms).alias("hour"), "url", "cnt")
    )


def sum_visits(visits: DataFrame, *keys: str) -> DataFrame:
    """Visits per url (and any further key), repeated lines summed."""
    return visits.groupBy(*keys, "url").agg(F.sum("cnt").alias("cnt"))


def slice_hours(visits: DataFrame, start: Column, end: Column) -> DataFrame:
    """Visits of ``[start, end)``; the first hour is included."""
    return visits.where((F.col("hour") >= start) & (F.col("hour") < end))


def without_periods(visits: DataFrame, missing_days: Sequence[str]) -> DataFrame:
    """Leave out days known to have no usable log; dictionary completion turns them into zeros."""
    days = list(missing_days)
    return visits.where(~periods.period_key(F.col("hour")).isin(days)) if days else visits


def parse_tuple_text(lines: DataFrame, line: str = "value") -> DataFrame:
    """``entity, value`` of text lines ``(entity,value)``."""
    bare = F.split(F.translate(F.col(line), "()", ""), ",")
    return lines.select(
        F.get(bare, F.lit(0)).alias("entity"), F.get(bare, F.lit(1)).try_cast("double").alias("value")
    ).where(F.col("value").isNotNull())


def format_tuple_text(df: DataFrame, entity: str = "entity", value: str = "value") -> DataFrame:
    """The text form that :func:`parse_tuple_text` reads."""
    return df.select(F.concat(F.lit("("), F.col(entity), F.lit(","), F.col(value), F.lit(")")).alias("value"))


def parse_entity_dictionary(lines: DataFrame, line: str = "value") -> DataFrame:
    """``category, name`` of lines ``category<TAB>name``."""
    parts = F.split(strip_bom(F.col(line)), "\t")
    return lines.where(F.size(parts) == 2).select(
        F.get(parts, F.lit(0)).alias("category"), F.get(parts, F.lit(1)).alias("name")
    )


def parse_word_list(lines: DataFrame, line: str = "value") -> DataFrame:
    """``word`` of one-word-per-line files, byte-order mark and blanks removed."""
    word = F.trim(strip_bom(F.col(line)))
    return lines.select(word.alias("word")).where(F.col("word") != "")


def parse_tagged_word_list(lines: DataFrame, line: str = "value") -> DataFrame:
    """``word, tag`` of lines ``word/tag``."""
    parts = F.split(strip_bom(F.col(line)), "/")
    return lines.where(F.size(parts) == 2).select(
        F.get(parts, F.lit(0)).alias("word"), F.get(parts, F.lit(1)).alias("tag")
    )


def read_labelled_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``category, text`` of a folder with one file per category, named after it."""
    return read_lines(spark, path).select(
        F.url_decode(F.col("file_name")).alias("category"), F.col("value").alias("text")
    )


def parse_labelled_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """``category, text`` of lines ``category,text``; lines with more or fewer parts are dropped."""
    parts = _fields(F.col(line), ",")
    return lines.where(F.size(parts) == 2).select(
        F.get(parts, F.lit(0)).alias("category"), F.get(parts, F.lit(1)).alias("text")
    )

"""Registered queries: each operator applied to the given tables, with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> dict[str, tuple[Query, str | None]]:
    from pressgauge.queries import events, graphs, relations, search, sentiment, sources, stocks, streams, training

    merged: dict[str, tuple[Query, str | None]] = {}
    for module in (stocks, events, sources, relations, search, graphs, sentiment, training, streams):
        merged.update(module.QUERIES)
    return merged

"""Relation jobs: live refresh, dated history, daily snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.operators import records, relation
from pressgauge.sources import tables


def live_relations(news: DataFrame, events: DataFrame, top: int = 15) -> DataFrame:
    """Current relations of every entity, lists as comma-joined text."""
    tagged = relation.tags(records.tagged_news(news), records.valid_events(events))
    return relation.joined_lists(relation.related(tagged, top))


def refresh_events(relations: DataFrame, path: str) -> None:
    """Replace the event relation table."""
    tables.replace(relations.where(F.col("kind") == "event").drop("kind"), path)


def refresh_named(current: DataFrame, relations: DataFrame, kind: str) -> DataFrame:
    """The named table with the lists of names that have new relations; other rows stay."""
    changes = relations.where(F.col("kind") == kind).drop("kind", "event_id")
    return tables.keyed_update(current, changes, ["name"])


def relation_history(news: DataFrame, events: DataFrame, dictionary: DataFrame, top: int = 15) -> DataFrame:
    """Relations completed with every dictionary name."""
    tagged = relation.tags(records.tagged_news(news), records.valid_events(events))
    return relation.joined_lists(relation.complete_history(relation.related(tagged, top), dictionary))


def snapshot(current: DataFrame, path: str, date: str) -> None:
    """Append the current relation table under its date, nulls as empty text."""
    tables.append_stamped(records.null_to_empty(current), path, date=date)

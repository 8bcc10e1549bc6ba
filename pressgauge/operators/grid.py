"""Complete series: every entity in every period."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.session import shuffle_tasks


def complete_series(
    sparse: DataFrame, entities: DataFrame, keys: list[str], period: str, periods: Column, empty: dict[str, Column],
    shown: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``keys, period`` and the measures for each entity and each of ``periods``, ``empty`` where ``sparse``
    has none. Entities outside ``entities`` and periods outside ``periods`` vanish. ``shown`` is how a period
    is given in the result, computed once per period and not per row.

    The grid of entities and periods can be far larger than both inputs, so it is never shuffled: the
    measures of an entity, one row per period, meet it as one list, and the periods without a row are
    added behind the last shuffle, as their places in ``periods``: a row costs an entry of two lists and a
    lookup by place. ``sparse`` has at most one row per entity, period and measure.
    """
    places = F.array_distinct(periods)
    # As long as the argument, whatever the data.
    wanted = F.broadcast(sparse.sparkSession.range(1).select(F.posexplode(places).alias("_at", period)))
    inside = sparse.join(wanted, period)
    merged = inside.repartition(shuffle_tasks(sparse.sparkSession), *keys).groupBy(*keys, "_at").agg(
        *[F.coalesce(F.max(m), zero).alias(m) for m, zero in empty.items()]
    )
    lists = merged.groupBy(*keys).agg(F.collect_list(F.struct("_at", *empty)).alias("_known"))
    full = entities.select(*keys).distinct().join(lists, keys, "left")

    n = F.array_size(places)
    known = F.coalesce(F.col("_known")["_at"], F.array().cast("array<int>"))
    blank = F.array_except(F.slice(F.sequence(F.lit(0), n), F.lit(1), n), known)
    # The known ones come first, so that an entry's number is that of its measures.
    cells = full.select(*keys, "_known", F.posexplode(F.concat(known, blank)).alias("_nth", "_at"))
    named = F.broadcast(wanted.select("_at", (shown(F.col(period)) if shown else F.col(period)).alias(period)))
    measures = [F.coalesce(F.get("_known", F.col("_nth"))[m], zero).alias(m) for m, zero in empty.items()]
    return cells.join(named, "_at").select(*keys, period, *measures)

"""Keep one row per key, always by a total order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline import constants as C


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """First row per key by ``order``, ties broken by every other column.

    The rank filter lets Spark cut each map task down to one row per key
    before the shuffle, so a key holding a third of all rows sends one row per
    task and not its whole group.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    by = list(order) + rest or [F.col(keys[0])]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def prefer_source(
    df: DataFrame,
    key: str = "match_id",
    source: str = "source",
    priority: Mapping[str, int] = C.SOURCE_PRIORITY,
) -> DataFrame:
    """One row per key, from the source with the lowest priority number."""
    rank = F.coalesce(*[F.when(F.col(source) == s, F.lit(p)) for s, p in priority.items()],
                      F.lit(len(priority)))
    return keep_first(df, [key], [rank])

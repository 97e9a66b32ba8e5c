"""Finding keys too large for one task, and joining around them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The most keys that are broadcast. If more are heavy, all of them are joined by shuffle.
MAX_BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class HeavyKeys:
    """The keys above a row limit, marked for broadcast if they are few enough."""

    keys: DataFrame
    total_rows: int
    few: bool = True


def heavy_keys(df: DataFrame, key: str, rows_per_task: int | None) -> HeavyKeys | None:
    """The keys with more than ``rows_per_task`` rows; None if there are none.

    Counted with map-side combine over the key column alone. At most
    ``MAX_BROADCAST_KEYS`` keys reach the driver; more stay a table. A limit of
    None skips the count.
    """
    if rows_per_task is None:
        return None
    found = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > rows_per_task)
    )
    rows = found.limit(MAX_BROADCAST_KEYS + 1).collect()
    if not rows:
        return None
    if len(rows) > MAX_BROADCAST_KEYS:
        total = found.agg(F.sum("rows")).first()[0]
        return HeavyKeys(found.select(key), total, few=False)
    keys = df.sparkSession.createDataFrame(rows, found.schema).select(key)
    return HeavyKeys(F.broadcast(keys), sum(row["rows"] for row in rows))


def left_join_on_key(
    facts: DataFrame, lookup: DataFrame, key: str, heavy: HeavyKeys | None
) -> DataFrame:
    """``facts ⟕ lookup`` on ``key`` where ``lookup`` has one row per key.

    Rows of heavy keys never meet in one task: they are joined where they lie
    with the (bounded) part of ``lookup`` that concerns them.
    """
    if heavy is None:
        return facts.join(lookup, key, "left")
    light_part = facts.join(heavy.keys, key, "left_anti").join(lookup, key, "left")
    heavy_lookup = lookup.join(heavy.keys, key, "left_semi")
    if heavy.few:
        heavy_lookup = F.broadcast(heavy_lookup)
    heavy_part = facts.join(heavy.keys, key, "left_semi").join(heavy_lookup, key, "left")
    return light_part.unionByName(heavy_part)

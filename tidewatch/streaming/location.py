"""The previous location of each row of a stream.

The state store holds where each user was last seen, users in groups. Per
micro-batch it hands out a *seed* for each known user in it. Everything else is
done on the batch with the operators of the batch engine, so users with very
many rows are split over tasks here as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tidewatch.config import RuleConfig
from tidewatch.operators.history import PREVIOUS_LOCATION, add_history, heavy_users
from tidewatch.operators.skew import left_join_on_key
from tidewatch.streaming.last_seen import FIELDS, LAST_SEEN, STATE, LastSeenGroup, newest_per_user, sightings, tracker

#: Users without a time to live are kept in so many groups; fixed for the life of a checkpoint.
USER_GROUPS = 4096


def _in_groups(seen: DataFrame, groups: int = USER_GROUPS) -> DataFrame:
    group = F.pmod(F.xxhash64("user_id"), F.lit(groups)).cast("int")
    return seen.withColumn("_group", group)


def _group_states(known: DataFrame, groups: int = USER_GROUPS) -> DataFrame:
    """Rows of users known from before as the state has them: a row per group, a list per column."""
    columns = ("user_id", *FIELDS)
    rows = F.collect_list(F.struct(*columns)).alias("_rows")
    states = _in_groups(sightings(known), groups).groupBy("_group").agg(rows)
    return states.select("_group", *(F.col(f"_rows.{c}").alias(f"{c}s") for c in columns))


def with_seeds(
    checked: DataFrame, ttl_seconds: int | None = None, known: DataFrame | None = None
) -> DataFrame:
    """The rows of a stream, plus one ``is_seed`` row per user seen before.

    ``checked`` carries ``reject_reason``; rejected rows do not touch the state.
    Only the ordering fields and coordinates travel through Python. Users
    unseen for ``ttl_seconds`` (by the clock) are forgotten; None keeps them for ever.
    ``known`` has the last row of users seen before the stream's first batch (see
    ``sources.tables.last_rows``); such users are not forgotten.
    """
    if known is not None and ttl_seconds is not None:
        raise ValueError("users known from before are kept; state_ttl_seconds must be None")
    sound = sightings(checked.filter(F.col("reject_reason").isNull()))
    newest = sound.mapInPandas(newest_per_user, sound.schema)
    if ttl_seconds is None:
        # Chunks of many users are hardly fewer rows than they were, so they are reduced once more where they meet.
        met = _in_groups(newest).repartition("_group")
        seeds = met.mapInPandas(newest_per_user, met.schema).groupBy("_group").transformWithState(
            LastSeenGroup(resumed=known is not None),
            LAST_SEEN,
            outputMode="Append",
            timeMode="None",
            initialState=None if known is None else _group_states(known).groupBy("_group"),
        )
    else:
        seeds = newest.groupBy("user_id").applyInPandasWithState(
            tracker(ttl_seconds),
            outputStructType=LAST_SEEN,
            stateStructType=STATE,
            outputMode="append",
            timeoutConf=GroupStateTimeout.ProcessingTimeTimeout,
        )
    seeds = seeds.withColumn("event_time", F.timestamp_micros("event_us")).drop("event_us")
    return checked.withColumn("is_seed", F.lit(False)).unionByName(
        seeds.withColumn("is_seed", F.lit(True)), allowMissingColumns=True
    )


def locate(batch: DataFrame, config: RuleConfig) -> DataFrame:
    """Rows and seeds of one micro-batch to rows with their previous location.

    Adds ``prev_lat, prev_lon, out_of_order``. A row older than its user's seed
    has lost its true predecessor: it is marked, and gets no previous location.
    """
    seeds = batch.filter("is_seed").select(
        "user_id",
        F.col("event_time").alias("_seed_time"),
        F.col("transaction_id").alias("_seed_id"),
        F.col("latitude").alias("_seed_lat"),
        F.col("longitude").alias("_seed_lon"),
    )
    rows = batch.filter(~F.col("is_seed")).drop("is_seed")
    sound = rows.filter(F.col("reject_reason").isNull())
    heavy = heavy_users(sound, config)
    late = F.struct("event_time", "transaction_id") < F.struct("_seed_time", "_seed_id")
    seeded = left_join_on_key(sound, seeds, "user_id", heavy).withColumn(
        "out_of_order", F.col("_seed_time").isNotNull() & late
    )
    # All late rows of a user lie before all others, so none stands between two of these: the rows
    # take one pass, and the first of the others, after a late row or none, follows on the seed.
    located = add_history(
        seeded,
        config,
        heavy,
        previous={**PREVIOUS_LOCATION, "_prev_time": "event_time", "_prev_id": "transaction_id"},
    )
    after_late = F.struct("_prev_time", "_prev_id") < F.struct("_seed_time", "_seed_id")
    first = F.col("_prev_id").isNull() | (F.col("_seed_time").isNotNull() & after_late)

    def place(seed: str, previous: str) -> Column:
        return F.when(~F.col("out_of_order"), F.when(first, F.col(seed)).otherwise(F.col(previous)))

    located = located.withColumns(
        {"prev_lat": place("_seed_lat", "prev_lat"), "prev_lon": place("_seed_lon", "prev_lon")}
    ).drop("_prev_time", "_prev_id")
    unlocated = rows.filter(F.col("reject_reason").isNotNull()).withColumn(
        "out_of_order", F.lit(False)
    )
    return located.drop("_seed_time", "_seed_id", "_seed_lat", "_seed_lon").unionByName(
        unlocated, allowMissingColumns=True
    )

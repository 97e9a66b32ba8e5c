"""What happened around a transaction: the user's previous row, recent counts.

Both need each user's rows in time order, which a window over ``user_id`` gives
with one shuffle and one sort. A user with a large share of all rows would make
that one task's work, so such users take a second path:

1. Their rows are cut into *cells*: one per time pane, and several where a pane
   alone is too large (cut points come from a sample of the order keys).
2. Each cell is summarised with map-side combine: row count and last row.
3. Over the summaries, each cell learns the last row before it and the window
   counts of its pane.
4. That context re-enters as one header row per cell, sorted first, so a window
   over the cell sees the neighbours it would see in the user's whole history.

No rows are joined to rows; only cell summaries cross cell borders.

Rows without a user are nobody's history: they get none, and are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import RuleConfig
from tidewatch.operators.skew import HeavyKeys, heavy_keys

# Row order within a user. Coordinates only separate copies of one transaction.
ORDER = ("event_time", "transaction_id", "latitude", "longitude")
# Copies that differ in any other column can still be cut apart.
SPLIT_ORDER = (*ORDER, "_row_hash")

# Names for the previous row's columns, which may be any of ORDER.
PREVIOUS_LOCATION = {"prev_lat": "latitude", "prev_lon": "longitude"}

SAMPLES_PER_CUT = 8
CUTS_PER_LOOKUP = 256  # length of the lists searched per row, in two steps
MAX_CUTS = 100_000  # bound on the broadcast of cut points
PANE_SECONDS = 3600  # pane length where no window counts ask for one

_CELL = ("user_id", "_pane", "_segment")
_USER = ("user_id", "_lone")


def heavy_users(df: DataFrame, config: RuleConfig) -> HeavyKeys | None:
    return heavy_keys(df, "user_id", config.segment_rows)


def add_history(
    df: DataFrame,
    config: RuleConfig,
    heavy: HeavyKeys | None,
    *,
    previous: Mapping[str, str] | None = None,
    counts: bool = False,
) -> DataFrame:
    """Add columns of the user's previous row and/or ``rapid_count``.

    ``previous`` maps new names to columns of the previous row; they are NULL
    for a user's first row. ``rapid_count`` is the largest count among the
    sliding windows (epoch-aligned, half-open) that contain the row. The users
    in ``heavy`` are split over tasks.
    """
    previous = previous or {}
    seconds = config.rapid_slide_seconds if counts else PANE_SECONDS
    lone = F.when(F.col("user_id").isNull(), F.xxhash64("event_time", "transaction_id"))
    paned = df.withColumn("_pane", pane(seconds)).withColumn("_lone", lone)
    if heavy is None:
        return _whole_users(paned, config, previous, counts).drop("_pane")
    light = paned.join(heavy.keys, "user_id", "left_anti")
    theirs = paned.drop("_lone").join(heavy.keys, "user_id")
    split = _split_users(theirs, heavy, config, previous, counts)
    return _whole_users(light, config, previous, counts).unionByName(split).drop("_pane")


def pane(seconds: int) -> Column:
    """Start of the epoch-aligned pane a row lies in, in microseconds."""
    micros = F.unix_micros(F.col("event_time").cast("timestamp"))
    return micros - F.pmod(micros, F.lit(seconds * 1_000_000))


def _window_counts(config: RuleConfig, rows: Column) -> Column:
    """Largest of the window totals around a pane; NULL for a row without a time.

    A window is ``k`` consecutive panes, so a pane lies in ``k`` windows: those
    reaching ``back`` panes before it and ``k - 1 - back`` after it.
    """
    slide = config.rapid_slide_seconds * 1_000_000
    panes = config.rapid_window_seconds // config.rapid_slide_seconds
    user = Window.partitionBy(*_USER).orderBy("_pane")
    totals = [
        rows.over(user.rangeBetween(-back * slide, (panes - 1 - back) * slide))
        for back in range(panes)
    ]
    largest = F.greatest(*totals) if panes > 1 else totals[0]
    return F.when(F.col("_pane").isNotNull(), largest)


def _whole_users(
    df: DataFrame, config: RuleConfig, previous: Mapping[str, str], counts: bool
) -> DataFrame:
    # The pane leads the order (it is a coarser event_time), so the sort made
    # for lag() also serves the counts: one exchange, one sort for both.
    if previous:
        user = Window.partitionBy(*_USER).orderBy(*(["_pane"] if counts else []), *ORDER)
        named = F.col("user_id").isNotNull()
        df = df.withColumns(
            {name: F.when(named, F.lag(c).over(user)) for name, c in previous.items()}
        )
    if counts:
        counted = _window_counts(config, F.count("*"))
        df = df.withColumn("rapid_count", F.when(F.col("user_id").isNotNull(), counted))
    return df.drop("_lone")


def _split_users(
    df: DataFrame,
    heavy: HeavyKeys,
    config: RuleConfig,
    previous: Mapping[str, str],
    counts: bool,
) -> DataFrame:
    rows = _with_segments(df, max(config.segment_rows, heavy.total_rows // MAX_CUTS))
    cells = rows.groupBy(*_CELL).agg(
        F.count("*").alias("_rows"), F.max(F.struct(*ORDER)).alias("_last")
    )
    # One row per cell: the panes a user was active in, plus one per cut.
    earlier = Window.partitionBy("user_id").orderBy("_pane", "_segment")
    headers = cells.withColumn("_before", F.lag("_last").over(earlier))
    if counts:
        counted = headers.withColumn("_lone", F.lit(None).cast("long"))
        headers = counted.withColumn("rapid_count", _window_counts(config, F.sum("_rows")))
    headers = headers.select(
        *_CELL,
        "_before.*",
        *(["rapid_count"] if counts else []),
        F.lit(False).alias("_is_row"),
    )

    within = Window.partitionBy(*_CELL).orderBy("_is_row", *SPLIT_ORDER)
    added = {name: F.lag(c).over(within) for name, c in previous.items()}
    if counts:
        added["rapid_count"] = F.first("rapid_count").over(within)
    return (
        rows.withColumn("_is_row", F.lit(True))
        .unionByName(headers, allowMissingColumns=True)
        .withColumns(added)
        .filter("_is_row")
        .drop("_is_row", "_segment", "_row_hash")
    )


def _with_segments(df: DataFrame, segment_rows: int) -> DataFrame:
    """Add ``_segment``: the position of a row's order key among its pane's cuts.

    The sample below only decides where to cut; every row is kept, and any cut
    gives the same results. Sampling distinct keys keeps copies of one row from
    swelling it.
    """
    df = df.withColumn("_row_hash", F.xxhash64(*df.columns))
    stride = max(1, segment_rows // SAMPLES_PER_CUT)
    sample = (
        df.select("user_id", "_pane", *SPLIT_ORDER)
        .filter(F.pmod("_row_hash", F.lit(stride)) == 0)
        .distinct()
    )
    in_pane = Window.partitionBy("user_id", "_pane").orderBy(*SPLIT_ORDER)
    cuts = (
        sample.withColumn("_nth", F.row_number().over(in_pane))
        .filter(F.col("_nth") % SAMPLES_PER_CUT == 0)
        .withColumn("_nth", (F.col("_nth") / SAMPLES_PER_CUT).cast("int"))
        .withColumn("_coarse", F.floor(F.col("_nth") / CUTS_PER_LOOKUP))
        .withColumn("_cut", F.struct(*SPLIT_ORDER))
    )
    leads = F.col("_nth") % CUTS_PER_LOOKUP == 0
    rows = _count_cuts(df, cuts.filter(leads).drop("_coarse"), ["user_id", "_pane"], "_coarse")
    rows = _count_cuts(rows, cuts.filter(~leads), ["user_id", "_pane", "_coarse"], "_fine")
    segment = F.col("_coarse") * CUTS_PER_LOOKUP + F.col("_fine")
    return rows.withColumn("_segment", segment).drop("_coarse", "_fine")


def _count_cuts(df: DataFrame, cuts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add ``name``: how many of the cuts listed for the row's keys are at or before it."""
    lists = cuts.groupBy(*keys).agg(F.collect_list("_cut").alias("_cuts"))
    passed = F.size(F.filter("_cuts", lambda cut: cut <= F.struct(*SPLIT_ORDER)))
    return (
        df.join(F.broadcast(lists), keys, "left")
        .withColumn(name, F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(passed).cast("long"))
        .drop("_cuts")
    )

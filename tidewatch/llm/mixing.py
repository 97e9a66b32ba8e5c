"""Mix sources to target weights by repeating documents.

Tokens are counted per source (combined before the shuffle, so one source may
hold most rows). Targets are water-filled: each source gets its weight's share
of the whole, at most ``max_repeat`` times what it has, and what is cut off goes
to the others by weight. A source's rate is target / size; each document is
taken floor(rate) times, and once more if a number in [0, 1), drawn by hash from
its id and text, is below the fraction. The hash is seeded per source: of ``TRIES``
seeds, each source has the one whose draws come nearest its target, which matters
where documents are few and unequal. No random state: reruns and retries agree.

Null or empty texts have size 0 and add nothing. A null source is a source.
An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import hash_unit, rest

WORD = r"[^\x20\x09-\x0D]+"
#: Seeds that each source chooses from: one sum each, combined before the shuffle.
TRIES = 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_sizes(docs: DataFrame, size: Column) -> DataFrame:
    """Rows: source, source_size."""
    return docs.groupBy("source").agg(F.coalesce(F.sum(size), F.lit(0)).alias("source_size"))


def ranked(sources: DataFrame) -> DataFrame:
    """Add ``position`` from 0, by code point with null last, in parallel.

    The order is dealt by range; only the number of rows per partition, one
    figure each, passes through the driver.
    """
    ordered = rest(
        sources.repartitionByRange(F.col("source").isNull(), "source")
        .sortWithinPartitions(F.col("source").isNull(), "source")
        .withColumn("_id", F.monotonically_increasing_id()),
        "mix_order",
    )
    part = F.shiftright("_id", 33)
    counts = sorted(tuple(r) for r in ordered.groupBy(part.alias("p")).count().collect())
    offset, pairs = 0, []
    for p, n in counts:
        pairs += [F.lit(p), F.lit(offset)]
        offset += n
    before = F.create_map(*pairs)[part] if pairs else F.lit(0)
    position = before + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumn("position", position.cast("long")).drop("_id")


def rotating_weights(position: Column) -> Column:
    """Weights 1, 2, 3, repeating."""
    return (position % 3 + 1).cast("double")


def targets(sources: DataFrame, weight: Callable[[Column], Column], max_repeat: float) -> DataFrame:
    """Add weight and target to sources, largest targets cut and reshared.

    Each round is one aggregate to a single row. A round that cuts no further
    source ends the loop; the level only rises, so there are few rounds.
    """
    weighted = ranked(sources).withColumn("weight", weight(F.col("position")))
    weighted = weighted.withColumn("_cap", F.col("source_size") * F.lit(float(max_repeat)))
    level, cut = 0.0, -1
    while True:
        full = F.col("_cap") <= F.col("weight") * F.lit(level)
        row = weighted.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(full, F.col("_cap"))).alias("used"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if row["n"] == cut or not row["open"]:
            break
        cut = row["n"]
        level = (float(row["total"]) - float(row["used"] or 0.0)) / row["open"]
    share = F.least(F.col("_cap"), F.col("weight") * F.lit(level))
    return weighted.withColumn("target", share).drop("_cap")


def _document() -> Column:
    return F.xxhash64("doc_id", "text", "source")


def _extra(fraction: Column, rows: Column, seed: Column, document: Column) -> Column:
    """How many copies beyond floor(rate) the rows of one document get together."""
    wanted = fraction * rows
    return F.floor(wanted) + (hash_unit(seed, document) < wanted - F.floor(wanted)).cast("long")


def _fraction(rate: Column) -> Column:
    return rate - F.floor(rate)


def repeated(sized: DataFrame) -> DataFrame:
    """Rows _document, rows: the documents that stand there more than once."""
    counts = sized.groupBy("_document").agg(F.count("*").alias("rows"))
    return counts.where(F.col("rows") > 1)


def with_seeds(sources: DataFrame, sized: DataFrame, again: DataFrame, seed: int) -> DataFrame:
    """Add ``seed`` to sources: the one whose draws come nearest the target."""
    rows = sized.withColumnRenamed("source", "_of").join(
        again.withColumnRenamed("_document", "_again"), F.col("_document") == F.col("_again"), "left"
    )
    joined = rows.join(sources, F.col("_of").eqNullSafe(F.col("_source")))
    number = F.coalesce("rows", F.lit(1))
    # Each of a document's rows brings its share of what they get together.
    sums = [
        F.sum(_extra(_fraction(F.col("rate")), number, F.lit(s), F.col("_document")) * F.col("_size") / number)
        for s in range(seed, seed + TRIES)
    ]
    drawn = joined.groupBy("_source", "source_size", "target", "rate").agg(
        F.array(*[F.coalesce(s, F.lit(0.0)) for s in sums]).alias("drawn")
    )
    extra = F.col("target") - F.floor("rate") * F.col("source_size")
    # Whole words: sums of shares may differ in the last digit from run to run.
    misses = F.transform(
        "drawn", lambda s, k: F.struct(F.abs(F.round(s, 3) - extra), (k + seed).alias("seed"))
    )
    return drawn.withColumn("seed", F.array_min(misses)["seed"]).drop("drawn")


def numbered(docs: DataFrame, again: DataFrame) -> DataFrame:
    """The rows of repeated documents with ``_number`` from 1 among the rows of each.

    Rows are numbered within their partition, and partitions follow each other; so no task
    sees all rows of a document. The rows rest first: what is numbered stays as it is.
    """
    theirs = docs.withColumn("_document", _document()).join(again, "_document")
    placed = theirs.withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}
    )
    resting = rest(placed, "mix_repeated")
    counts = resting.groupBy("_document", "_part").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_document").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "_document", "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    own = Window.partitionBy("_document", "_part").orderBy("_at")
    placed = resting.withColumn("_own", F.row_number().over(own)).join(before, ["_document", "_part"])
    return placed.withColumn("_number", F.col("_before") + F.col("_own"))


def plan(
    docs: DataFrame,
    weight: Callable[[Column], Column] = rotating_weights,
    max_repeat: float = 3.0,
    seed: int = 7,
) -> DataFrame:
    """``docs`` and a struct ``_mix``: size, source_size, target and copies.

    A column of ``docs`` that is named ``_mix`` goes; others of any name stay.
    """
    own = [c for c in docs.columns if c != "_mix"]
    # The table's columns travel in one struct, so that none clashes with a working column.
    size = word_count(F.col("text"))
    sized = rest(docs.select("source", _document().alias("_document"), size.alias("_size")), "mix_sizes")
    sources = targets(source_sizes(sized, F.col("_size")), weight, max_repeat)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    named = sources.select(
        F.col("source").alias("_source"), "source_size", "target", rate.alias("rate")
    )
    again = rest(repeated(sized), "mix_again")
    rates = rest(with_seeds(rest(named, "mix_rates"), sized, again, seed), "mix_seeds")

    packed = docs.select(F.struct(*[docs[c] for c in own]).alias("_row"), "doc_id", "text", "source")
    once = packed.withColumn("_document", _document())
    if again.isEmpty():
        rows = once.withColumns({"rows": F.lit(1).cast("long"), "_number": F.lit(1).cast("long")})
    else:
        once = once.join(again, "_document", "left_anti")
        rows = once.withColumns({"rows": F.lit(1).cast("long"), "_number": F.lit(1).cast("long")})
        rows = rows.unionByName(numbered(packed, again).select(*rows.columns))
    extra = _extra(_fraction(rates["rate"]), F.col("rows"), rates["seed"], F.col("_document"))
    copies = F.floor(rates["rate"]).cast("long") + (F.col("_number") <= extra).cast("long")
    mix = F.struct(
        size.alias("size"), rates["source_size"], rates["target"], copies.alias("copies")
    )
    # The rates' true size is known here: small, they are broadcast; large, Spark
    # shuffles, and splits a source that fills a partition.
    joined = rows.join(rates, rows["source"].eqNullSafe(rates["_source"]), "left")
    return joined.select("_row", mix.alias("_mix")).select("_row.*", "_mix")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each as often as it is taken, with ``copy`` from 1.

    A column of ``docs`` that is named ``copy`` goes.
    """
    planned = plan(docs.drop("copy"), **options)
    taken = planned.where(F.col("_mix.copies") > 0)
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_mix.copies")))).drop("_mix")

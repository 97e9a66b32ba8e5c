"""The logs of a stream's checkpoint as tables: what each batch read, and whether it was committed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PLACE = "array<struct<topic:string,partition:int,offset:long>>"
LOG_SCHEMA = (
    "batch_id long, trigger_time timestamp, watermark timestamp, source int, topic string, "
    "partition int, offset long, committed boolean"
)


def _files(spark: SparkSession, folder: str) -> DataFrame | None:
    """``batch_id, value`` of a log's files; other files than those of batches are passed over."""
    try:
        read = spark.read.text(folder, wholetext=True)
        named = read.select(F.col("_metadata.file_name").alias("name"), "value")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    batch = F.expr("try_cast(name as long)").alias("batch_id")
    return named.filter(F.col("name").rlike("^[0-9]+$")).select(batch, "value")


def _places(line: Column) -> Column:
    """A source's line as places: of a broker by topic and partition, else one.

    A line in no known form is one place without an offset.
    """

    def one(offset: Column) -> Column:
        none = F.lit(None)
        return F.array(F.struct(none.alias("topic"), none.alias("partition"), offset.alias("offset"))).cast(PLACE)

    number = line.try_cast("long")
    file_log = F.get_json_object(line, "$.logOffset").try_cast("long")
    topics = F.map_entries(F.from_json(line, "map<string,map<string,long>>"))

    def of_topic(topic: Column) -> Column:
        partitions = F.map_entries(topic["value"])
        return F.transform(
            partitions,
            lambda p: F.struct(
                topic["key"].alias("topic"),
                p["key"].try_cast("int").alias("partition"),
                p["value"].alias("offset"),
            ),
        )

    broker = F.flatten(F.transform(topics, of_topic)).cast(PLACE)
    return F.coalesce(
        F.when(number.isNotNull(), one(number)),
        F.when(file_log.isNotNull(), one(file_log)),
        broker,
        one(F.lit(None).cast("long")),
    )


def offset_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per batch, source, topic and partition of a checkpoint: up to where it read, and if it was committed.

    Sources are numbered from 0. One that had nothing to read yet has no row in a batch. Files are
    not divided by topic and partition: these are NULL. A checkpoint that is not there has no rows.
    """
    offsets, commits = (_files(spark, f"{checkpoint}/{log}") for log in ("offsets", "commits"))
    if offsets is None:
        return spark.createDataFrame([], LOG_SCHEMA)
    lines = F.split(F.rtrim(F.regexp_replace("value", r"[\r\n]+$", "")), r"\r?\n")
    head = lines.getItem(1)  # behind the version

    def millis(field: str) -> Column:
        return F.timestamp_millis(F.get_json_object(head, f"$.{field}").try_cast("long"))

    sources = F.slice(lines, F.lit(3), F.greatest(F.size(lines) - 2, F.lit(0)))
    each = offsets.select(
        "batch_id",
        millis("batchTimestampMs").alias("trigger_time"),
        millis("batchWatermarkMs").alias("watermark"),
        F.posexplode(sources).alias("source", "line"),
    ).filter("line != '-'")
    placed = each.withColumn("place", F.explode(_places(F.col("line")))).select(
        "batch_id", "trigger_time", "watermark", "source", "place.*"
    )
    if commits is None:
        return placed.withColumn("committed", F.lit(False))
    done = commits.select("batch_id", F.lit(True).alias("committed"))
    return placed.join(done, "batch_id", "left").na.fill(False, ["committed"])

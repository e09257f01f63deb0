"""Topics as streams and tables.

With ``servers`` a topic is read from Kafka (its connector must be on the
classpath). With ``path`` it is a folder of JSON lines that has the same
columns, one sub-folder per topic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TOPIC_SCHEMA
from ..session import file_system, path_exists

# Fixed value: how many records the head of a topic shows.
HEAD_RECORDS = 51
# Records of a file of the stand-in, where a stream bounds its batches by records.
FILE_RECORDS = 500
STARTS = "topic string, partition int, next long"
MESSAGE_COLUMNS = ("topic", "key", "value", "partition", "offset", "timestamp")


def kafka_options(servers: str, topics: Sequence[str], start: str = "latest", max_offsets: int | None = None,
                  min_partitions: int | None = None, **extra: str) -> dict[str, str]:
    """Reader options. ``min_partitions`` splits large topic partitions over several tasks."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": start}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return {**options, **extra}


def _as_messages(df: DataFrame) -> DataFrame:
    return df.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}).select(
        *MESSAGE_COLUMNS
    )


def end_offsets(messages: DataFrame) -> DataFrame:
    """Per topic and partition the offset after the last message."""
    return messages.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next"))


def _start_of(spark: SparkSession, topics: Sequence[str], path: str, starts: str) -> DataFrame:
    """Where a stream that starts at the latest messages begins: what the topic held when it was first asked, kept in ``starts``.

    The offsets are written once, so that a stream that is started again does not lose what came while it stood still.
    """
    if not path_exists(spark, f"{starts}/_SUCCESS"):
        held = topic_batch(spark, topics, path=path) if path_exists(spark, path) else spark.createDataFrame([], TOPIC_SCHEMA)
        end_offsets(held).write.mode("overwrite").parquet(starts)
    return spark.read.schema(STARTS).parquet(starts)


def topic_parts(spark: SparkSession, topic: str, path: str) -> list[str]:
    """The folders of a topic's partitions in a stand-in that was written by partition; one that appears later is not among them."""
    files, at = file_system(spark, f"{path}/topic={topic}")
    return sorted(found.getPath().toString() for found in files.listStatus(at) if found.isDirectory()) if files.exists(at) else []


def topic_stream(spark: SparkSession, topics: Sequence[str], servers: str | None = None, path: str | None = None,
                 start: str | None = None, max_per_trigger: int | None = None, starts: str | None = None, part: str | None = None, **extra: str) -> DataFrame:
    """Unbounded messages.

    ``part`` is one of ``topic_parts``: the stream then reads this partition alone, so that several streams share a topic.

    ``start`` is ``latest`` or ``earliest``: where a stream without a checkpoint begins, by default ``latest`` in Kafka and
    ``earliest`` in the stand-in. ``latest`` in the stand-in needs ``starts``, a folder of its own in which the offsets of
    the first start are kept; partitions that appear later are read from their first message.
    ``max_per_trigger`` bounds the records of a micro-batch; in the stand-in a file is read whole, so its producer must write files
    of ``FILE_RECORDS`` at most, and a batch takes as many files as fit the bound (one at least).
    """
    if servers:
        options = kafka_options(servers, topics, start or "latest", max_per_trigger, **extra)
        return _as_messages(spark.readStream.format("kafka").options(**options).load())
    if not path:
        raise ValueError("give the servers of the topic or the path of its stand-in")
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if max_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max(1, max_per_trigger // FILE_RECORDS))
    # Only for a pattern does a file stream keep the given base path, below which folders name columns; this one fits the folder alone.
    files = reader.option("basePath", path).json(f"{part[:-1]}[{part[-1]}]") if part else reader.json(path)
    messages = _as_messages(files.where(F.col("topic").isin(*topics)))
    if start in (None, "earliest"):
        return messages
    if start != "latest":
        raise ValueError("a stream starts at latest or earliest")
    if not starts:
        raise ValueError("give a folder for the offsets of the first start")
    begin = _start_of(spark, topics, path, starts).select("topic", "partition", "next")
    return messages.join(begin, ["topic", "partition"], "left").where(F.coalesce(F.col("offset") >= F.col("next"), F.lit(True))).select(*MESSAGE_COLUMNS)


def topic_batch(spark: SparkSession, topics: Sequence[str], servers: str | None = None, path: str | None = None,
                **extra: str) -> DataFrame:
    """All messages a topic holds now, from the earliest."""
    if servers:
        options = kafka_options(servers, topics, "earliest", **{"endingOffsets": "latest", **extra})
        return _as_messages(spark.read.format("kafka").options(**options).load())
    if not path:
        raise ValueError("give the servers of the topic or the path of its stand-in")
    return _as_messages(spark.read.schema(TOPIC_SCHEMA).json(path).where(F.col("topic").isin(*topics)))


def topic_head(messages: DataFrame, records: int = HEAD_RECORDS) -> DataFrame:
    """The earliest records, one printed line each."""
    first = messages.orderBy("partition", "offset").limit(records)
    # Fixed value: the printed line.
    return first.select(
        "partition",
        "offset",
        F.format_string(
            "topic=%s, partition=%s, offset=%d, customer=%s, country=%s",
            F.col("topic"), F.col("partition").cast("string"), F.col("offset"), F.col("key"), F.col("value"),
        ).alias("line"),
    )

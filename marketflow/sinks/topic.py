"""Messages to topics, the target named per row in ``topic``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def write_topic(messages: DataFrame, servers: str | None = None, path: str | None = None, file_records: int | None = None,
                by_partition: bool = False) -> None:
    """Append messages.

    ``file_records`` bounds the files of the stand-in, for streams that bound their batches by records. ``by_partition`` gives each
    partition of a topic a folder, for streams that read one partition each.
    """
    if servers:
        messages.select("topic", "key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    else:
        writer = messages.write.mode("append").partitionBy("topic", *(["partition"] if by_partition else []))
        (writer.option("maxRecordsPerFile", file_records) if file_records else writer).json(path)


def topic_writer(messages: DataFrame, checkpoint: str, servers: str | None = None, path: str | None = None) -> DataStreamWriter:
    """A writer ready to start. Into Kafka a record may repeat after a failure; the file stand-in is exactly-once."""
    writer = messages.writeStream.option("checkpointLocation", checkpoint)
    if servers:
        return writer.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.format("json").option("path", path).partitionBy("topic")

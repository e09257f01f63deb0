"""Starting streams."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Trigger intervals of the jobs.
BATCH_INTERVAL = "5 seconds"
ROLL_INTERVAL = "1 minute"


def start(writer: DataStreamWriter, interval: str = BATCH_INTERVAL) -> StreamingQuery:
    """Run for good, one micro-batch per interval."""
    return writer.trigger(processingTime=interval).start()


def roll(writer: DataStreamWriter) -> StreamingQuery:
    """Run for good with the interval of rolling files: each batch closes the files it writes."""
    return start(writer, ROLL_INTERVAL)


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process what the source holds now and stop; the same checkpoint continues later."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def drain_all(writers: Iterable[DataStreamWriter]) -> list[StreamingQuery]:
    """The same for several streams side by side; the first error is raised once all have ended."""
    queries, errors = [writer.trigger(availableNow=True).start() for writer in writers], []
    for query in queries:
        try:
            query.awaitTermination()
        except Exception as error:
            errors.append(error)
    if errors:
        raise errors[0]
    return queries


def into_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partitions: tuple[str, ...] = (),
               **options: str) -> DataStreamWriter:
    """Append to files, each row exactly once."""
    writer = stream.writeStream.format(fmt).outputMode("append").options(**options)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return writer.partitionBy(*partitions) if partitions else writer


def into_batches(stream: DataFrame, write, checkpoint: str) -> DataStreamWriter:
    """Give each micro-batch to ``write(batch, batch_id)``."""
    return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)


def into_console(stream: DataFrame, checkpoint: str | None = None, rows: int = 20) -> DataStreamWriter:
    writer = stream.writeStream.format("console").outputMode("append").option("numRows", rows).option("truncate", "false")
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer

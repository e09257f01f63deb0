"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.session import configure, let_workers_import, scratch

# Rows and bytes of an Arrow batch sent to Python: long texts stay within a worker's memory.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the library's settings and the batch bounds to the session, and let Python workers find the package."""
    configure(spark)
    let_workers_import(spark)
    for key, value in BATCH_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def give_back() -> None:
    """Let the driver's Python return freed memory to the system: Arrow's pool, and the allocator's where it can (glibc)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: later steps never compute them again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staying(docs: DataFrame, rows: DataFrame, settle: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``docs`` that stay, by ``rows`` (doc_id, kept), one for each of them. ``settle`` picks from the rows of ids that have several.

    The ids whose only row goes, and those with several rows, are stored: Spark then knows their size, and while it is below the broadcast
    threshold of the session no row of ``docs`` is shuffled. Beyond it both sides are shuffled by id.
    """
    each = rows.groupBy("doc_id").agg((F.count(F.lit(1)) > 1).alias("several"), F.max("kept").alias("kept"))
    marks = stored(each.where("several or not kept").select("doc_id", "several"), "marks")
    alone = docs.join(marks, marks["doc_id"].eqNullSafe(docs["doc_id"]), "left_anti")
    several = marks.where("several")
    if several.isEmpty():
        return alone
    return alone.unionByName(settle(docs.join(several, several["doc_id"].eqNullSafe(docs["doc_id"]), "left_semi")))


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % by


def shuffle_parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def split_words(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts with A-Z lower-cased.

    Gives the number of each word in a list of distinct words, that list, and where each text's words begin, with the end at
    last. Null is empty. Other letters are left as they are.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    coded = lists.flatten().dictionary_encode()
    index, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    offsets = np.asarray(lists.offsets, dtype=np.int64) - lists.offsets[0].as_py()
    if "" in distinct:  # white space at either end
        full = index != distinct.index("")
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        index = index[full]
    return index, distinct, offsets


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs; 0 for an empty one."""
    out = np.zeros(len(offsets) - 1, values.dtype)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(values, offsets[full])
    return out

"""Token ids in wavelet matrices, one file per shard.

Documents are put in ascending order of their id by a range shuffle and encoded; consecutive documents form a shard of bounded
size. A shard's ids become a wavelet matrix: one bit-plane per bit of the largest id, highest first, each a stable partition
of the one above. Every plane keeps the number of ones before each block, so that access, counting and occurrence lookup
work on the packed bits. A shard is one byte string (header, document table, planes) in a row of its own Parquet file; no
file depends on another, and a lost task writes its shards again.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketflow.llm.common import prepare, shuffle_parts
from marketflow.llm.tokens import encoded, encoder

MAGIC = b"WVM1"
HEAD = struct.Struct("<4sBxxxQQ")  # mark, planes, ids, documents
BLOCK = 64  # bytes of a plane between two samples of its rank
SHARD_IDS = 1 << 20
SLICE_BYTES = 1 << 22  # text encoded at once: the more, the fewer times a frequent piece is looked up


def build(ids: np.ndarray, doc_ids: np.ndarray, has_id: np.ndarray, ends: np.ndarray) -> bytes:
    """The file of a shard. ``ends`` is where each document's ids end; ``has_id`` is 0 for a null id."""
    planes = max(1, int(ids.max(initial=0)).bit_length())
    values = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    parts = [HEAD.pack(MAGIC, planes, len(values), len(doc_ids)), doc_ids.astype("<i8").tobytes(), ends.astype("<i8").tobytes(),
             has_id.astype("u1").tobytes()]
    below = np.empty_like(values)
    for shift in range(planes - 1, -1, -1):
        bits = (values & values.dtype.type(1 << shift)) != 0
        packed = np.packbits(bits, bitorder="little")
        ones = np.add.reduceat(np.bitwise_count(packed).astype(np.int64), np.arange(0, len(packed), BLOCK)) if len(packed) else []
        rank = np.concatenate([[0], np.cumsum(ones)]).astype("<u4")
        parts += [rank.tobytes(), packed.tobytes()]
        zeros = len(values) - np.count_nonzero(bits)
        np.compress(~bits, values, out=below[:zeros])
        np.compress(bits, values, out=below[zeros:])
        values, below = below, values
    return b"".join(parts)


class Shard:
    """Reads a shard's file without unpacking more than it is asked for."""

    def __init__(self, data: bytes):
        mark, self.planes, self.n, docs = HEAD.unpack_from(data)
        if mark != MAGIC:
            raise ValueError("not a shard of this format")
        at = HEAD.size
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        self.ends = np.frombuffer(data, "<i8", docs, at + 8 * docs)
        self.has_id = np.frombuffer(data, "u1", docs, at + 16 * docs).astype(bool)
        at += 17 * docs
        size = (self.n + 7) // 8
        samples = (size + BLOCK - 1) // BLOCK + 1
        self.rank, self.bits, self.zeros = [], [], []
        for _ in range(self.planes):
            self.rank.append(np.frombuffer(data, "<u4", samples, at))
            self.bits.append(np.frombuffer(data, "u1", size, at + 4 * samples))
            self.zeros.append(self.n - int(self.rank[-1][-1]))
            at += 4 * samples + size

    def _ones(self, plane: int, i: int) -> int:
        """Ones before position ``i``."""
        block, byte = i // 8 // BLOCK * BLOCK, i // 8
        count = int(self.rank[plane][byte // BLOCK]) + int(np.bitwise_count(self.bits[plane][block:byte]).sum())
        return count + (int(self.bits[plane][byte]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else count

    def _select(self, plane: int, k: int, bit: int) -> int:
        """Where the ``k``-th (from 0) such bit stands."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            ones = self._ones(plane, middle + 1)
            if (ones if bit else middle + 1 - ones) > k:
                high = middle
            else:
                low = middle + 1
        return low

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        value = 0
        for plane in range(self.planes):
            bit = self.bits[plane][i // 8] >> i % 8 & 1
            ones = self._ones(plane, i)
            value, i = value << 1 | int(bit), self.zeros[plane] + ones if bit else i - ones
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        for plane in range(self.planes):
            a, b = self._ones(plane, start), self._ones(plane, end)
            start, end = (self.zeros[plane] + a, self.zeros[plane] + b) if token >> (self.planes - 1 - plane) & 1 else (start - a, end - b)
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often the id stands in ``[start, end)``."""
        if token >> self.planes:
            return 0
        a, b = self._range(token, start, self.n if end is None else end)
        return b - a

    def locate(self, token: int, k: int) -> int:
        """Where the ``k``-th (from 0) occurrence of the id stands; -1 if there is none."""
        if token >> self.planes:
            return -1
        a, b = self._range(token, 0, self.n)
        i = a + k
        if i >= b:
            return -1
        for plane in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - plane) & 1
            i = self._select(plane, i - self.zeros[plane] if bit else i, bit)
        return i

    def ids(self) -> np.ndarray:
        """All ids: the partitions undone from the lowest plane up."""
        values = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        for plane in range(self.planes - 1, -1, -1):
            bits = np.unpackbits(self.bits[plane], count=self.n, bitorder="little").astype(bool)
            above, zeros = np.empty_like(values), self.zeros[plane]
            above[np.flatnonzero(~bits)] = values[:zeros]
            above[np.flatnonzero(bits)] = values[zeros:] | values.dtype.type(1 << (self.planes - 1 - plane))
            values = above
        return values


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shard_ids: int = SHARD_IDS) -> None:
    """Encode every whole ``text`` (null is empty), append ``end_id`` and write shards below ``path`` in ascending ``doc_id`` order.

    Null ids come first; rows of one id stand in the order of their texts, repeated rows are kept. A document is never split, so
    that one longer than ``shard_ids`` makes a larger shard of its own. Other columns are not read. An empty table gives no shard.
    """
    spark = prepare(docs.sparkSession)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        names, kinds, ids, ends, held = [], [], [], [], 0

        def out() -> pa.RecordBatch:
            data = build(np.concatenate(ids), np.array(names), np.array(kinds), np.array(ends))
            return pa.RecordBatch.from_pydict({"part": [part], "shard": [number], "n_ids": [held], "data": [data]}, schema=schema)

        schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_ids", pa.int64()), ("data", pa.binary())])
        part = 0
        for batch in batches:
            keys, order = batch.column(0).to_pylist(), batch.column(2)
            part = order[0].as_py() if len(order) else part
            for start, found, offsets in encoded(batch.column(1), encoder(tokenizer), SLICE_BYTES):
                for i in range(len(offsets) - 1):
                    size = int(offsets[i + 1] - offsets[i]) + 1
                    if held and held + size > shard_ids:
                        yield out()
                        names, kinds, ids, ends, held, number = [], [], [], [], 0, number + 1
                    key = keys[start + i]
                    names.append(key or 0)
                    kinds.append(key is not None)
                    ids += [found[offsets[i] : offsets[i + 1]], np.array([end_id], np.uint32)]
                    held += size
                    ends.append(held)
        if held:
            yield out()

    ranged = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
              .repartitionByRange(shuffle_parts(spark), "doc_id").sortWithinPartitions("doc_id", "text")
              .withColumn("part", F.spark_partition_id()))
    (ranged.mapInArrow(shards, "part int, shard int, n_ids long, data binary")
     .write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files below ``path``: doc_id, start, n_tokens and the crc32 of its ids as unsigned 32-bit numbers."""
    files = spark.read.schema("part int, shard int, n_ids long, data binary").parquet(path)
    # Where a shard begins: the ids of earlier parts, and of earlier shards of its part. Both tables hold a row per part or shard.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("all")).withColumn(
        "before", F.sum("all").over(Window.orderBy("part")) - F.col("all")).select("part", "before")
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begins = files.select("part", "shard", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inner")).join(parts, "part").select(
        "part", "shard", (F.col("before") + F.col("inner")).alias("begin"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column(2)[i].as_py())
                ids, starts = shard.ids().astype("<u4"), np.concatenate([[0], shard.ends])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(shard.ends), batch.column(0)[i].as_py()), pa.int32()),
                    pa.array(np.full(len(shard.ends), batch.column(1)[i].as_py()), pa.int32()),
                    pa.array(shard.doc_ids, pa.int64(), mask=~shard.has_id), pa.array(starts[:-1]), pa.array(np.diff(starts)),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1], starts[1:])], pa.int64()),
                ], names=["part", "shard", "doc_id", "inner", "n_tokens", "ids_crc32"])

    found = files.select("part", "shard", "data").mapInArrow(
        documents, "part int, shard int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return found.join(begins, ["part", "shard"]).select("doc_id", (F.col("begin") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")

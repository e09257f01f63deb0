"""Exact duplicates by recipes of content-defined chunks.

A text is lower-cased (A-Z) and cut where a rolling hash of the last 16 bytes has a fixed pattern, so that equal passages give equal
chunks wherever they stand. Every distinct chunk is moved once, to verify that its identifier stands for these bytes alone; an
identifier of several chunks is split by a number. Texts are then compared by their ordered lists of identifiers, which
are about a hundredth of their size: no text is moved whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import prepare, staying, stored

LEAST, MASK, MOST = 256, (1 << 10) - 1, 8192  # bytes of a chunk: least, mean as a power of two less one, most
ID_BYTES = 16
# A fixed pseudo-random number for every byte.
GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little") for b in range(256)], np.uint64)
_SPAN = 1 << 20  # bytes hashed at once


def chunks(data: bytes) -> list[bytes]:
    """The chunks of a text, in order; none of an empty one."""
    if len(data) <= LEAST:
        return [data] if data else []
    cuts = []
    for start in range(0, len(data), _SPAN):
        begin = max(0, start - 15)
        h = GEAR[np.frombuffer(data, np.uint8, min(len(data), start + _SPAN) - begin, begin)]
        for shift in (1, 2, 4, 8):  # the sum over the last 16 bytes, each shifted by its distance
            h[shift:] += h[:-shift].copy() << np.uint64(shift)
        found = np.flatnonzero((h >> np.uint64(20)) & np.uint64(MASK) == 0) + begin + 1
        cuts += found[found > start].tolist()
    out, last = [], 0
    for cut in (*cuts, len(data)):
        while cut - last > MOST:
            out.append(data[last : last + MOST])
            last += MOST
        if cut - last >= LEAST or cut == len(data) and cut > last:
            out.append(data[last:cut])
            last = cut
    return out


def _lowered(text: str | None) -> bytes:
    return (text or "").encode().lower()


def _id(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def recipes(docs: DataFrame, id_bytes: int = ID_BYTES) -> DataFrame:
    """``docs`` with ``text_sha256`` of the lower-cased text and ``recipe``, its chunks' identifiers one after the other.

    Columns of these names are replaced. A null text is empty and has an empty recipe.
    """
    prepare(docs.sparkSession)

    @F.arrow_udf("struct<sha: string, ids: binary>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data = [_lowered(t) for t in texts.to_pylist()]
            yield pa.StructArray.from_arrays([
                pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string()),
                pa.array([b"".join(_id(c, id_bytes) for c in chunks(d)) for d in data], pa.binary())], ["sha", "ids"])

    return (docs.withColumn("_read", read(F.col("text"))).withColumn("text_sha256", F.col("_read.sha"))
            .withColumn("recipe", F.col("_read.ids")).drop("_read"))


def clashes(docs: DataFrame, id_bytes: int = ID_BYTES) -> DataFrame:
    """Chunks whose identifier also stands for other bytes, as (id, chunk, number). Empty unless the hash collides.

    Chunks are made distinct in their task before they are moved, so that a passage that many texts share moves once per task.
    """
    prepare(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                found = {c for t in batch.column(0).slice(start, 64).to_pylist() for c in chunks(_lowered(t))}
                if found:
                    found = sorted(found)
                    yield pa.RecordBatch.from_arrays([pa.array([_id(c, id_bytes) for c in found], pa.binary()), pa.array(found, pa.binary())], ["id", "chunk"])

    distinct = docs.select("text").mapInArrow(cut, "id binary, chunk binary").groupBy("id", "chunk").count().drop("count")
    several = distinct.groupBy("id").count().where("count > 1").select("id")
    numbered = distinct.join(several, "id", "left_semi")
    return numbered.withColumn("number", F.row_number().over(Window.partitionBy("id").orderBy("chunk")))


def verified(docs: DataFrame, id_bytes: int = ID_BYTES) -> DataFrame:
    """Recipes in which every identifier stands for one chunk: ``docs`` with ``text_sha256`` and ``recipe``.

    Only where ``clashes`` finds any is a recipe changed: the numbers of the clashing chunks, in order, are appended to it.
    """
    listed = recipes(docs, id_bytes)
    found = clashes(docs, id_bytes)
    if found.isEmpty():
        return listed
    by_id = {bytes(r["id"]) for r in found.select("id").distinct().limit(10_001).collect()}
    if len(by_id) > 10_000:
        raise ValueError("more than 10,000 identifiers clash: use longer identifiers")
    numbers = {(bytes(r["id"]), bytes(r["chunk"])): r["number"] for r in found.collect()}

    @F.arrow_udf("binary")
    def extended(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            out = []
            for text in batch.to_pylist():
                parts = chunks(_lowered(text))
                ids = [_id(c, id_bytes) for c in parts]
                out.append(b"".join(i + numbers.get((i, c), 0).to_bytes(4, "little") for i, c in zip(ids, parts)))
            yield pa.array(out, pa.binary())

    return listed.withColumn("recipe", extended(F.col("text")))


def groups(docs: DataFrame, id_bytes: int = ID_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts (null is empty) form a group, its largest doc_id stays; null ids count as smallest. Of repeated rows of the id that stays one
    is kept. Extra columns are left out. Counting per group combines in every task before the shuffle, so that a large group sends a row per task.
    """
    each = (verified(docs, id_bytes).groupBy("recipe", "doc_id").agg(F.count(F.lit(1)).alias("_copies"), F.first("text_sha256").alias("text_sha256")))
    whole = each.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.sum("_copies").alias("group_size"))
    joined = each.join(whole, "recipe").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns and no other."""
    rows = stored(groups(docs).select("doc_id", "kept", "text_sha256"), "exact")

    def settle(several: DataFrame) -> DataFrame:
        keep = rows.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
        read = recipes(several.select("text", F.struct(*several.columns).alias("_row")))
        listed = read.select("_row.*", F.col("text_sha256").alias("_sha256"))
        one = listed.join(keep, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_sha") == F.col("_sha256")), "left_semi")
        return one.dropDuplicates(["doc_id", "_sha256"]).select(*several.columns)

    return staying(docs, rows, settle)

"""Near-duplicates by SimHash fingerprints and meet-in-the-middle balls.

Two fingerprints within 3 bits of one another have a value between them: one is within 1 bit of it and the other within 2. Every
fingerprint emits all values of its ball, the shuffle brings equal values together, and such a value is a hub: all that lie within
1 bit of it are within 2 of one another, and all that lie within 2 bits are within 3 of each of those. Members of a hub are linked to its
smallest member, so that a group of any size gives as many links as members and no pairs.

The full balls hold 2,081 values. Two steps keep them few without losing a link. First, one of three blocks of the 64 bits holds a
differing bit; without that block at most 2 bits differ, and both balls of 1 bit (44 values for each of the three blocks)
meet: a fingerprint that meets no other there has no link and goes no further. Second, distance 3 joins an even with an odd
number of set bits, and two of the three bits lie in the same half: only even fingerprints emit values at 2 bits, in one half.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import prepare, stored
from marketflow.llm.graph import components

SEED = 42
BLOCKS = ((0, 21), (21, 42), (42, 64))


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; of the whole sequence where it is shorter, none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, "<u8")
    joined, ends = memoryview(b" ".join(words)), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) < shingle:
        pairs = [(0, int(ends[-1]))]
    else:
        pairs = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The majority of each bit over the XXH64 hashes of all word shingles; 0 without words."""
    hashes = shingle_hashes(text, shingle)
    count = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in range(64) if 2 * count[i] > len(hashes))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` with ``fp``, the fingerprint of the whole text as a signed 64-bit number."""
    prepare(docs.sparkSession)

    @F.arrow_udf("long")
    def value(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(np.array([fingerprint(t.as_py(), shingle) for t in texts], "<u8").view("<i8"))

    return docs.withColumn("fp", value(F.col("text")))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _flips(low: int = 0, high: int = 64) -> list[int]:
    return [1 << i for i in range(low, high)]


def _longs(values: list[int]) -> Column:
    return F.array(*(F.lit(_signed(v)).cast("long") for v in values))


def _near_blocks(fp: Column) -> Column:
    """Values within 1 bit outside each block; the block itself holds its number, so that blocks don't mix."""
    parts = []
    for number, (low, high) in enumerate(BLOCKS):
        block = sum(_flips(low, high))
        flips = [0] + [f for f in _flips() if not f & block]
        base = fp.bitwiseAND(F.lit(_signed(~block & (1 << 64) - 1)).cast("long")).bitwiseXOR(F.lit(_signed((number + 1) << low)).cast("long"))
        parts.append(F.transform(_longs(flips), base.bitwiseXOR))
    return F.concat(*parts)


def _two_flips() -> list[int]:
    halves = [_flips(0, 32), _flips(32, 64)]
    return [half[i] | half[j] for half in halves for i in range(32) for j in range(i)]


def links(fps: DataFrame) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of distinct ``fp`` within 3 bits."""
    same = Window.partitionBy("value")  # one shuffle of the values; a window's rows spill, they are never held in memory
    met = fps.select("fp", F.explode(_near_blocks(F.col("fp"))).alias("value")).withColumn("_n", F.count(F.lit(1)).over(same))
    close = stored(met.where("_n > 1").select("fp").distinct(), "close")
    near = F.transform(_longs([0, *_flips()]), lambda f: F.struct(F.col("fp").bitwiseXOR(f).alias("value"), F.lit(True).alias("near")))
    far = F.transform(_longs(_two_flips()), lambda f: F.struct(F.col("fp").bitwiseXOR(f).alias("value"), F.lit(False).alias("near")))
    balls = close.select("fp", F.inline(near)).unionAll(close.where(F.bit_count("fp") % 2 == 0).select("fp", F.inline(far)))
    hubs = balls.withColumns({"_n": F.count(F.lit(1)).over(same), "_near": F.max("near").over(same), "v": F.min("fp").over(same)})
    return hubs.where("_n > 1 AND _near AND fp != v").select(F.col("fp").alias("u"), "v").distinct()


def _rooted(nodes: DataFrame) -> DataFrame:
    """``nodes``, a row per ``fp``, with the ``root`` of all that links reach."""
    roots = components(links(nodes.select("fp"))).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def first_rows(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(_none, _id, _sha) of the row that stays of each group of ``near_groups``; ``docs`` has doc_id, text and _sha, a digest of the text.

    It is the row with the smallest doc_id, null ids last, of several the one with the smallest digest.
    """
    first = F.struct(F.col("doc_id").isNull().alias("_none"), F.col("doc_id").alias("_id"), "_sha")
    slim = fingerprints(docs.select("doc_id", "text", "_sha"), shingle)
    nodes = stored(slim.groupBy("fp").agg(F.min(first).alias("_first")), "nodes")
    return _rooted(nodes).groupBy("root").agg(F.min("_first").alias("_first")).select("_first.*")


def near_groups(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id and every column but the text.

    Fingerprints within 3 bits are linked, and so is all that links reach. ``component_id`` is the smallest doc_id reached, null where all
    ids are null. Texts without words share fingerprint 0. Equal fingerprints are one node, however many rows have them.
    Columns named fp, fingerprint or component_id are replaced.
    """
    own = [c for c in docs.columns if c.lower() not in ("fp", "fingerprint", "component_id")]
    slim = stored(fingerprints(docs.select(*own), shingle).drop("text"), "fingerprints")
    rooted = _rooted(slim.groupBy("fp").agg(F.min("doc_id").alias("_least")))
    least = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    labels = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return slim.join(labels, "fp").withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0"))).drop("fp")

"""Near-duplicates from a similarity of 0.8 on, by prefixes of the sets of shingles.

All shingles have one order, the rare before the frequent. Two sets that share four fifths of their union have a shingle in common among the
first fifth of either: every text emits these, and texts meet at them. No pair of that similarity is lost, whatever the length. What meets
is bounded by the sizes of the sets and by the parities of their shingles, then verified by the sets themselves.

No pairs within a group are made, as links only add up to groups. Of the smallest texts at the shingles where it is, a text is first
compared with the one nearest by parities; then, where no links join them yet, with all of these. Then, in rounds, each group is compared
with the nearest one by a single pair, until less than half of them join. At last all that meet at a shingle and are still in different groups are
compared, so that the groups are those of all pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import prepare, staying, stored
from marketflow.llm.graph import components
from marketflow.llm.simhash import first_rows, shingle_hashes

SHINGLE, SIMILARITY = 5, 0.8
LONGS = 16  # longs of parities of a set
BLOCK = 1024  # members of a shingle that one task compares with all others there
BUCKET_BITS, PART = 18, 1024  # buckets by which shingles are counted, to order them; buckets of a row while they are summed


def distinct_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The set of a text's shingles, in ascending order."""
    return np.unique(shingle_hashes(text, shingle))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def frequencies(docs: DataFrame, shingle: int = SHINGLE) -> bytes:
    """A byte per bucket that rises with the number of texts' shingles in it. It sets the order of shingles; any order gives the same groups."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            hashes = [distinct_hashes(t.as_py(), shingle) for t in batch.column(0)]
            if hashes:
                total += np.bincount(_bucket(np.concatenate(hashes)), minlength=len(total))
        parts = [part.tobytes() for part in total.reshape(-1, PART)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of a part. Its rows come in one run, as they are sorted by part."""
        at, total = None, np.zeros(PART, np.int64)

        def done() -> pa.RecordBatch:
            level = np.minimum(8 * np.log2(1 + total), 255).astype(np.uint8)
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["part", "levels"])

        for batch in batches:
            for part, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if part != at:
                    if at is not None:
                        yield done()
                    at, total = part, np.zeros(PART, np.int64)
                total = total + np.frombuffer(counts, np.int64)
        if at is not None:
            yield done()

    parts = docs.select("text").mapInArrow(count, "part int, counts binary").repartition("part").sortWithinPartitions("part")
    return b"".join(r["levels"] for r in sorted(parts.mapInArrow(add, "part int, levels binary").collect(), key=lambda r: r["part"]))


def prefix(hashes: np.ndarray, levels: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a set, by level and hash: a set at least so similar has one of its own first ones among them."""
    least = math.ceil(similarity * len(hashes) - 1e-9)  # shingles that it shares at least
    return hashes[np.argsort(levels[_bucket(hashes)], kind="stable")[: len(hashes) - least + 1]]


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether the number of hashes is odd, for each of their last bits' values: two sets differ in as many shingles at least as in parities."""
    odd = np.bincount((hashes & np.uint64(64 * LONGS - 1)).astype(np.int64), minlength=64 * LONGS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def sketched(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with _set, a 128-bit digest of the set of shingles, _size, their number, _prefix and _parities."""
    often = frequencies(docs, shingle)

    @F.arrow_udf("struct<set: binary, size: long, prefix: array<long>, parities: array<long>>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        levels = np.frombuffer(often, np.uint8)
        for texts in batches:
            sets = [distinct_hashes(t.as_py(), shingle) for t in texts]
            yield pa.StructArray.from_arrays([
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([prefix(s, levels, similarity).view("<i8") for s in sets], pa.list_(pa.int64())),
                pa.array([parities(s) for s in sets], pa.list_(pa.int64()))], ["set", "size", "prefix", "parities"])

    names = ("set", "size", "prefix", "parities")
    return docs.withColumn("_read", read(F.col("text"))).withColumns({f"_{n}": F.col(f"_read.{n}") for n in names}).drop("_read")


def meetings(nodes: DataFrame, similarity: float) -> DataFrame:
    """(value, node, at, size, n, least) of every shingle at whose value at least two nodes meet: its place in the node's order, how many meet, and
    the smallest one's node, at and size. Values where only two meet are left out if these cannot be so similar by ``fits``."""
    same = Window.partitionBy("value")  # rows of a value spill, they are never held in memory
    values = nodes.select("node", F.col("_size").alias("size"), F.posexplode("_prefix").alias("at", "value"))
    own = F.struct("node", "at", "size")
    met = values.withColumns({"n": F.count(F.lit(1)).over(same), "least": F.min(own).over(same), "most": F.max(own).over(same)})
    pair = fits(F.col("least.at"), F.col("least.size"), F.col("most.at"), F.col("most.size"), similarity)
    return met.where((F.col("n") > 2) | (F.col("n") == 2) & pair).select("value", "node", "at", "size", "n", "least")


def rooted(met: DataFrame, links: DataFrame) -> DataFrame:
    """``met`` with the root of each node's group so far."""
    return met.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))


def crossing(met: DataFrame, links: DataFrame, similarity: float) -> DataFrame:
    """(u, v) of nodes and the smallest one of a value where they meet, if no links join them yet and they may be so similar by ``fits``."""
    first = F.min(F.struct("node", "root", "at", "size")).over(Window.partitionBy("value"))
    other = rooted(met, links).withColumn("first", first).where("root != first.root")
    other = other.where(fits(F.col("at"), F.col("size"), F.col("first.at"), F.col("first.size"), similarity))
    return other.select(F.greatest("node", "first.node").alias("u"), F.least("node", "first.node").alias("v")).distinct()


def parted(nodes: DataFrame, n: str) -> DataFrame:
    """What ``apart`` and ``verified`` need of a node, each name with ``n`` at its end."""
    return nodes.select(F.col("node").alias(n), F.col("_size").alias(f"size_{n}"), F.col("_parities").alias(f"p{n}"), F.col("_first._sha").alias(f"s{n}"))


def apart() -> Column:
    """In how many shingles the sets of u and v differ at least."""
    return sum(F.bit_count(F.get("pu", F.lit(i)).bitwiseXOR(F.get("pv", F.lit(i)))) for i in range(LONGS))


def may_differ(similarity: float, size_u: Column | None = None, size_v: Column | None = None) -> Column:
    """In how many shingles sets of the sizes of u and v may differ."""
    both = (F.col("size_u") if size_u is None else size_u) + (F.col("size_v") if size_v is None else size_v)
    return F.lit((1 - similarity) / (1 + similarity)) * both + F.lit(1e-6)


def fits(at_u: Column, size_u: Column, at_v: Column, size_v: Column, similarity: float) -> Column:
    """Whether two sets may be so similar, if the shingle at these places is the first that they share.

    Then neither shares any before it. A pair that is so similar holds this at the first shingle of both.
    """
    shared = F.least(size_u - at_u, size_v - at_v)  # at most
    return size_u + size_v - 2 * shared <= may_differ(similarity, size_u, size_v)


def near(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """``pairs`` (u, v) whose sizes and parities allow the similarity, with the digests of their texts and the number of differing parities."""
    both = pairs.join(parted(nodes, "u"), "u").join(parted(nodes, "v"), "v").withColumn("apart", apart())
    sizes = F.abs(F.col("size_u") - F.col("size_v")) <= may_differ(similarity)
    return both.where(sizes & (F.col("apart") <= may_differ(similarity))).select("u", "v", "su", "sv", "apart")


def unjoined(met: DataFrame, links: DataFrame) -> DataFrame:
    """``met`` with roots, where no links join all nodes of a value yet."""
    same = Window.partitionBy("value")
    ends = {"low": F.min("root").over(same), "high": F.max("root").over(same)}
    return rooted(met, links).withColumns(ends).where("low != high").select("value", "node", "at", "n", "root")


def candidates(apart_yet: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """``near`` pairs of all nodes that meet at a value and have different roots, with the roots; a pair comes from each value where it ``fits``.

    Half of each pair is dealt to blocks, so that a frequent value is compared by many tasks.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    sides = []
    for n, block in (("u", F.pmod(F.xxhash64("node"), blocks)), ("v", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))):
        side = apart_yet.select("value", F.col("node").alias(n), F.col("at").alias(f"at_{n}"), F.col("root").alias(f"root_{n}"), block.alias("block"))
        sides.append(side.join(parted(nodes, n), n))
    likely = fits(F.col("at_u"), F.col("size_u"), F.col("at_v"), F.col("size_v"), similarity)
    apart_roots = (F.col("u") > F.col("v")) & (F.col("root_u") != F.col("root_v"))
    pairs = sides[0].join(sides[1], ["value", "block"]).where(apart_roots & likely).withColumn("apart", apart()).where(F.col("apart") <= may_differ(similarity))
    return pairs.select("u", "v", "su", "sv", "root_u", "root_v", "apart")


def nearest(pairs: DataFrame) -> DataFrame:
    """Of ``candidates`` the pair nearest by parities for each root, towards a smaller one: no more pairs than roots."""
    best = pairs.groupBy(F.greatest("root_u", "root_v").alias("root")).agg(F.min(F.struct("apart", "u", "v", "su", "sv")).alias("to"))
    return best.select("to.u", "to.v", "to.su", "to.sv")


def verified(pairs: DataFrame, docs: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """The (u, v) of ``near`` pairs whose sets of shingles are at least so similar. ``docs`` has _sha and text."""

    @F.arrow_udf("boolean")
    def alike(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hashes = lru_cache(8)(lambda text: distinct_hashes(text, shingle))  # one text is compared with many
        for left, right in batches:
            out = []
            for a, b in zip(left, right):
                a, b = hashes(a.as_py() or ""), hashes(b.as_py() or "")
                both = len(np.intersect1d(a, b, assume_unique=True))
                out.append(both >= similarity * (len(a) + len(b) - both))
            yield pa.array(out, pa.bool_())

    close = stored(pairs, "close")
    # Stored, as Spark then knows its size: if it is small, the texts are filtered where they lie.
    wanted = stored(close.select(F.explode(F.array("su", "sv")).alias("_sha")).distinct(), "wanted")
    texts = stored(docs.join(wanted, "_sha", "left_semi").select("_sha", "text").dropDuplicates(["_sha"]), "texts")
    a, b = (texts.select(F.col("_sha").alias(f"s{n}"), F.col("text").alias(f"t{n}")) for n in "uv")
    return close.join(a, "su").join(b, "sv").where(alike("tu", "tv")).select("u", "v")


def groups(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """(_none, _id, _sha) of the row that stays of each group; ``docs`` has doc_id, text and _sha, a digest of the text.

    Texts with the same set of shingles are one node, however many rows have them. Texts without words are one group.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), F.col("doc_id").alias("_id"), "_sha")).alias("_first")
    own = ("_size", "_prefix", "_parities")
    each = sketched(docs, similarity, shingle).groupBy("_set").agg(first, *(F.first(c).alias(c) for c in own))
    # Numbers are given once, when the nodes are written.
    nodes = stored(each.select(F.monotonically_increasing_id().alias("node"), "_first", *own), "nodes")
    met = stored(meetings(nodes, similarity), "met")
    texts = docs.select("_sha", "text")
    likely = met.where(F.col("node") != F.col("least.node")).where(fits(F.col("at"), F.col("size"), F.col("least.at"), F.col("least.size"), similarity))
    own = near(likely.select(F.col("node").alias("u"), F.col("least.node").alias("v")).distinct(), nodes, similarity)
    closest = own.groupBy("u").agg(F.min(F.struct("apart", "v", "su", "sv")).alias("to")).select("u", "to.*")
    links = stored(verified(closest, texts, similarity, shingle), "links")
    links = stored(links.unionAll(verified(near(crossing(met, links, similarity), nodes, similarity), texts, similarity, shingle)), "links")
    found = True
    while True:  # a round joins each root that finds one to a smaller root; the last, when few do so, compares all that is left
        apart_yet = stored(unjoined(met, links), "apart")
        if apart_yet.isEmpty():
            break
        pairs = candidates(apart_yet, nodes, similarity)
        pairs = stored(nearest(pairs), "pairs") if found else pairs.select("u", "v", "su", "sv").distinct()
        new = stored(verified(pairs, texts, similarity, shingle), "new")
        links = stored(links.unionAll(new), "links")
        if not found:
            break
        found = 2 * new.count() > pairs.count()
    roots = components(links)
    return (nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("_first").alias("_first"))
            .select("_first.*"))


def digest() -> Column:
    """The digest of a row's text by which ``settled`` tells rows of one id apart."""
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def settled(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (doc_id, digest) is not in ``kept`` (_id, _sha), which is stored; of repeated rows one stays."""
    stays = kept.select(F.col("_id").alias("kept_id"), F.lit(True).alias("stays")).distinct()
    rows = docs.select("doc_id").join(stays, F.col("kept_id").eqNullSafe(F.col("doc_id")), "left")

    def settle(several: DataFrame) -> DataFrame:
        marked = several.withColumn("_sha256", digest())
        same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_sha") == F.col("_sha256"))
        return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_sha256"]).select(*several.columns)

    return staying(docs, rows.select("doc_id", F.coalesce("stays", F.lit(False)).alias("kept")), settle)


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group: the one with its smallest doc_id, of several the one with the smallest text hash.

    A null text is empty, null ids come last, of repeated rows one stays; all columns are kept and no other is added. An empty table gives
    an empty result.
    """
    prepare(docs.sparkSession)
    kept = groups(docs.select("doc_id", "text", digest().alias("_sha")), similarity, shingle)
    return settled(docs, stored(kept.select("_id", "_sha"), "kept"))


def deduplicated_by_fingerprint(docs: DataFrame) -> DataFrame:
    """The same with the groups of ``simhash.near_groups``: all that links of fingerprints within 3 bits reach."""
    prepare(docs.sparkSession)
    kept = first_rows(docs.select("doc_id", "text", digest().alias("_sha")))
    return settled(docs, stored(kept.select("_id", "_sha"), "kept"))

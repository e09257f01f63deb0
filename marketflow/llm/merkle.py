"""A Merkle manifest of a data set, with proofs by octopus multiproof.

Every row is a leaf, every language a tree of arity two over its leaves in order of doc_id, and the subroots of the languages are the
leaves of one more tree. A node is the digest of its children; the last node of a level may have a single child.

Leaves are dealt to partitions of ``2**STEP`` consecutive places. A partition knows all nodes over its own leaves alone; what else its
proofs need are siblings further up. It names those coordinates once for all its leaves (the octopus: sibling coordinates that
no own leaf derives), they are fetched by one join with the stored nodes, and the partition then derives the interiors its leaves share
and expands the proof of each leaf in place. No tree, language or level is ever gathered: a group has ``2**STEP`` rows at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import prepare, stored

STEP = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "tree long, level int, idx long, digest string"


def leaf_digest(fields: Iterable[Column]) -> Column:
    """Digest of a row: each field as ``-`` if null, else its length in UTF-8 bytes, a colon and its value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def combine(digests: Iterable[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    return max(0, leaves - 1).bit_length()


def width(leaves: int, level: int) -> int:
    """Nodes of a level of a tree."""
    return (leaves - 1 >> level) + 1


def raise_level(nodes: dict[int, str]) -> dict[int, str]:
    """The parents of some nodes of a level, whose children are all among them."""
    return {i: combine(nodes[c] for c in (2 * i, 2 * i + 1) if c in nodes) for i in sorted({i >> 1 for i in nodes})}


def octopus(places: Iterable[int], leaves: int) -> list[tuple[int, int]]:
    """(level, idx) of every node that proofs of these leaves need and that the leaves themselves do not derive."""
    own, missing = set(places), []
    for level in range(height(leaves)):
        end = width(leaves, level)
        missing += [(level, i ^ 1) for i in sorted(own) if i ^ 1 not in own and i ^ 1 < end]
        own = {i >> 1 for i in own}
    return missing


def expand(digests: dict[int, str], leaves: int, fetched: dict[tuple[int, int], str]) -> dict[int, list[str]]:
    """The siblings of each leaf from the lowest level on: interiors are derived once, the rest is ``fetched``."""
    levels, own = [], dict(digests)
    for level in range(height(leaves)):
        around = {**own, **{i ^ 1: fetched[level, i ^ 1] for i in own if (level, i ^ 1) in fetched}}
        levels.append(around)
        own = raise_level(around)
    return {place: [nodes[s] for level, nodes in enumerate(levels) if (s := place >> level ^ 1) in nodes] for place in digests}


def fold(digest: str, place: int, leaves: int, siblings: Iterable[str]) -> str:
    """The root that a leaf and its siblings give."""
    rest = iter(siblings)
    for level in range(height(leaves)):
        i = place >> level
        if i ^ 1 >= width(leaves, level):
            digest = combine([digest])
        else:
            other = next(rest)
            digest = combine([other, digest] if i & 1 else [digest, other])
    return digest


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with ``place``, their number from 0 in the given order. Equal rows are told apart by the last column of the order.

    Rows are ranged over the partitions and sorted there; a place is the number within the partition plus the sizes of those before it.
    Only a count per partition meets in one task.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    ranged = stored(ranged.withColumn("_part", F.shiftright("_row", 33)), "placed")
    sizes = ranged.groupBy("_part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_start"))
    return ranged.join(starts, "_part").withColumn("place", F.col("_start") + (F.col("_row") - F.shiftleft("_part", 33))).drop("_row", "_part", "_start")


def _first_pass(keys: tuple, group: pa.Table, step: int) -> pa.Table:
    """Of a leaf partition: the node that covers it, and what its proofs miss (digest null)."""
    places, digests, leaves = (group.column(c).to_pylist() for c in ("place", "digest", "leaves"))
    nodes, level = dict(zip(places, digests)), 0
    while level < min(step, height(leaves[0])):
        nodes, level = raise_level(nodes), level + 1
    tree, chunk = (k.as_py() for k in keys)
    rows = [(tree, chunk, level, i, d) for i, d in nodes.items()]
    rows += [(tree, chunk, up, i, None) for up, i in octopus(places, leaves[0])]
    return pa.table(list(map(list, zip(*rows))), schema=pa.schema([("tree", pa.int64()), ("chunk", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string())]))


def _upper_pass(keys: tuple, group: pa.Table, step: int) -> pa.Table:
    """All nodes above up to ``2**step`` neighbours of one level."""
    nodes = dict(zip(group.column("idx").to_pylist(), group.column("digest").to_pylist()))
    level, top, tree, rows = group.column("level")[0].as_py(), height(group.column("leaves")[0].as_py()), keys[0].as_py(), []
    for up in range(level + 1, min(level + step, top) + 1):
        nodes = raise_level(nodes)
        rows += [(tree, up, i, d) for i, d in nodes.items()]
    schema = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string())])
    return pa.table(list(map(list, zip(*rows))) or [[]] * 4, schema=schema)


@dataclass
class Forest:
    """Trees over ``leaves`` (tree, place, digest, leaves: their number in the tree, and other columns), by stored tables.

    ``nodes`` holds every node from the level of the leaf partitions on, ``missing`` the coordinates each leaf partition must fetch.
    """

    leaves: DataFrame
    nodes: DataFrame
    missing: DataFrame
    step: int

    def roots(self) -> DataFrame:
        """tree, digest of its root, and its number of leaves."""
        tops = self.nodes.groupBy("tree").agg(F.max_by("digest", "level").alias("root"))
        return tops.join(self.leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("leaves")), "tree")

    def siblings(self) -> DataFrame:
        """The leaves with ``siblings``, the digests of each leaf's proof from the lowest level on."""
        fetched = self.missing.join(self.nodes, ["tree", "level", "idx"]).select("tree", "chunk", "level", "idx", "digest")
        columns = self.leaves.columns
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in self.leaves.schema), "siblings array<string>"])

        def answer(own: pa.Table, given: pa.Table) -> pa.Table:
            places = own.column("place").to_pylist()
            known = {(level, i): d for level, i, d in zip(*(given.column(c).to_pylist() for c in ("level", "idx", "digest")))}
            proofs = expand(dict(zip(places, own.column("digest").to_pylist())), own.column("leaves")[0].as_py(), known) if places else {}
            return own.select(columns).append_column("siblings", pa.array([proofs[p] for p in places], pa.list_(pa.string())))

        dealt = self.leaves.withColumn("chunk", F.shiftright("place", self.step))
        return dealt.groupBy("tree", "chunk").cogroup(fetched.groupBy("tree", "chunk")).applyInArrow(answer, schema)


def grow(leaves: DataFrame, step: int = STEP) -> Forest:
    """Trees over ``leaves``: tree and place (long), digest, and leaves, the number of leaves of the tree.

    Each pass raises every tree by ``step`` levels, ``2**step`` neighbours at a time.
    """
    numbered = leaves.select("tree", "place", "digest", "leaves", F.shiftright("place", step).alias("chunk"))
    first = stored(numbered.groupBy("tree", "chunk").applyInArrow(lambda keys, group: _first_pass(keys, group, step), "tree long, chunk long, level int, idx long, digest string"), "first")
    missing = first.where("digest IS NULL").drop("digest")
    nodes = last = first.where("digest IS NOT NULL").drop("chunk")
    sizes = leaves.groupBy("tree").agg(F.first("leaves").alias("leaves"))
    most, level = sizes.agg(F.max("leaves")).first()[0] or 1, step
    while level < height(most):
        below = last.where(F.col("level") == level).join(sizes, "tree").withColumn("chunk", F.shiftright("idx", step))
        last = stored(below.groupBy("tree", "chunk").applyInArrow(lambda keys, group: _upper_pass(keys, group, step), NODES), "nodes")
        nodes, level = nodes.unionByName(last), level + step
    return Forest(leaves, nodes, missing, step)


@dataclass
class Manifest:
    """``rows``: every row's doc_id, leaf, tree and place; ``trees``: a row per language with its subroot, the root and the proof between."""

    rows: Forest
    trees: DataFrame


def manifest(docs: DataFrame, extra: dict[str, Column] | None = None, step: int = STEP) -> Manifest:
    """Grow the trees of all rows. ``extra`` are further columns to keep beside each leaf; texts are digested where they lie."""
    prepare(docs.sparkSession)
    leaf = leaf_digest(F.col(c) for c in FIELDS)
    short = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), leaf.alias("digest"), *(c.alias(n) for n, c in (extra or {}).items()))
    short = placed(stored(short.withColumn("_tie", F.monotonically_increasing_id()), "leaves"), "lang", "doc_id", "digest", "_tie").drop("_tie")
    langs = stored(short.groupBy("lang").agg(F.min("place").alias("tree"), F.count(F.lit(1)).alias("leaves")), "langs")
    own = short.join(langs.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang"))).drop("lang", "_lang")
    rows = grow(stored(own.withColumn("place", F.col("place") - F.col("tree")), "ordered"), step)
    subroots = rows.roots().select(F.col("tree").alias("_tree"), F.col("root").alias("digest"), F.col("leaves").alias("_leaves"))
    many = langs.agg(F.count(F.lit(1)).alias("n")).scalar()
    top = grow(stored(placed(subroots, "_tree").select(F.lit(0).cast("long").alias("tree"), "place", "digest", many.alias("leaves"), "_tree", "_leaves"), "subroots"), step)
    found = top.siblings().join(top.roots().select("tree", "root"), "tree")
    trees = found.select(F.col("_tree").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("place").alias("top_place"), F.col("leaves").alias("top_leaves"), F.col("siblings").alias("above"))
    return Manifest(rows, stored(trees, "trees"))


def _check(batches, columns: list[str]):
    """Siblings become one digest, and each leaf (or what stands for it) is folded to a root."""
    for batch in batches:
        rows = [batch.column(c).to_pylist() for c in ("given", "place", "leaves", "siblings", "top_place", "top_leaves", "above")]
        proofs, folded = [], []
        for given, place, leaves, siblings, top_place, top_leaves, above in zip(*rows):
            proofs.append(combine([*siblings, *above]))
            folded.append(fold(fold(given, place, leaves, siblings), top_place, top_leaves, above))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(proofs, pa.string()), pa.array(folded, pa.string())], names=[*columns, "proof_sha256", "folded_root"])


def proofs(docs: DataFrame, tampered: Column | None = None, step: int = STEP) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: every row's proof, made and checked.

    Where ``tampered`` holds, the leaf that is folded has one more in n_chars; all else is of the rows as they are. Null ids come first
    and count as ids; rows with equal ids lie in the order of their digests, and equal rows give equal leaves. A null language
    is a tree of its own, before the others. A null n_chars stays null when tampered with. Other columns take no part. A single row is its
    own root, with an empty proof; an empty table gives no row.
    """
    spark = prepare(docs.sparkSession)
    changed = leaf_digest(F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in FIELDS)
    given = F.when(tampered, changed) if tampered is not None else F.lit(None).cast("string")
    whole = manifest(docs, {"given": given}, step)
    rows = whole.rows.siblings().join(whole.trees, "tree").withColumn("given", F.coalesce("given", "digest"))
    kept = ["doc_id", "digest", "subroot", "root"]
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, digest string, subroot string, root string, proof_sha256 string, folded_root string"
    checked = rows.mapInArrow(lambda batches: _check(batches, kept), schema)
    return checked.withColumnRenamed("digest", "leaf").withColumn("verified", F.col("folded_root") == F.col("root"))

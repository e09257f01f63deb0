"""Nearest neighbours by a hash-prefix forest.

The rows are dealt to blocks by a hash of their id. A block has a forest: for each tree a sorted array of long hash strings, whose bits are
the sides of random hyperplanes through the block's mean. A query descends every tree to its longest matching prefix, and ascends
all trees together, a bit at a time, until the rows that share a prefix make the wanted share of the block; the last bit is taken
tree by tree. Those candidates are compared exactly, and the best of all blocks are the answer.

The share, not a number, is fixed: where vectors have no clusters, as here, a neighbour shares few bits more than any other row.
Blocks and not buckets hold the rows, so that no prefix, however common, gathers them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import prepare

TREES, BITS = 96, 24
SHARE, LEAST = 0.45, 2048  # candidates per block: share of its rows, and at least so many
BLOCK_ROWS = 1 << 14


class Forest:
    """Sorted arrays of hash strings over the rows of ``x``."""

    def __init__(self, x: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 11):
        self.x, self.bits, self.mean = x, bits, x.mean(0)
        draw = np.random.default_rng(seed)
        self.planes = draw.standard_normal((trees, x.shape[1], bits))
        hashes = [self._hash(x, t) for t in range(trees)]
        self.order = [np.argsort(h, kind="stable").astype(np.int32) for h in hashes]
        self.sorted = [h[o] for h, o in zip(hashes, self.order)]

    def _hash(self, x: np.ndarray, tree: int) -> np.ndarray:
        return ((x - self.mean) @ self.planes[tree] > 0) @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))

    def candidates(self, queries: np.ndarray, wanted: int) -> list[np.ndarray]:
        """Row numbers for each query: at least ``wanted``, all if there are no more."""
        n, trees = len(self.x), len(self.order)
        if n <= wanted:
            return [np.arange(n)] * len(queries)
        low = np.empty((self.bits + 1, trees, len(queries)), np.int64)
        high = np.empty_like(low)
        for t in range(trees):
            own = self._hash(queries, t)
            for level in range(self.bits + 1):
                first = own >> (self.bits - level) << (self.bits - level)
                low[level, t] = np.searchsorted(self.sorted[t], first, "left")
                high[level, t] = np.searchsorted(self.sorted[t], first + (1 << (self.bits - level)), "left")
        found = []
        sizes = (high - low).sum(1)
        for q in range(len(queries)):
            seen = np.zeros(n, bool)
            level = int(np.flatnonzero(sizes[:, q] >= min(wanted, sizes[0, q]))[-1])  # a longer prefix cannot hold enough
            while True:
                for t in range(trees):
                    seen[self.order[t][low[level, t, q] : high[level, t, q]]] = True
                    if t % 8 == 7 and np.count_nonzero(seen) >= wanted:
                        break
                if np.count_nonzero(seen) >= wanted or level == 0:
                    break
                level -= 1
            found.append(np.flatnonzero(seen))
        return found


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("v").chunks] or [np.empty(0)]).reshape(-1, dim)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part, repeated rows once."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .where(F.exists("v", lambda x: x != 0)).distinct())


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, share: float = SHARE, least: int = LEAST, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found by Euclidean distance, ties to the smaller vec_id.

    Both tables have vec_id and embedding. Null ids, null or zero vectors and vectors with null or non-finite components take
    no part; a query never finds rows of its own id; vectors of another length than the query's are no candidates. Repeated rows count
    once. Other columns are left out. A query without candidates, and an empty table, give no row.
    """
    spark = prepare(vectors.sparkSession)
    rows = usable(vectors).withColumn("dim", F.size("v"))
    blocks = max(1, -(-rows.count() // block_rows))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    asked = usable(queries).withColumn("dim", F.size("v")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(data: pa.Table, wanted: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not data.num_rows or not wanted.num_rows:
            return schema.empty_table()
        dim = data.column("dim")[0].as_py()
        x, q = _matrix(data, dim), _matrix(wanted, dim)
        ids, asking = data.column("vec_id").to_numpy(), wanted.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        x, ids = np.ascontiguousarray(x[order]), ids[order]
        forest = Forest(x)
        out = []
        for start in range(0, len(q), 64):
            part = q[start : start + 64]
            for i, near in enumerate(forest.candidates(part, max(least, int(share * len(x))))):
                near = near[ids[near] != asking[start + i]]
                gap = x[near] - part[i]
                score = np.sqrt(np.einsum("ij,ij->i", gap, gap))
                best = np.argsort(score, kind="stable")
                best = best[: k] if len(best) <= k else best[score[best] <= score[best[k - 1]]][: k]
                out.append((np.full(len(best), asking[start + i]), ids[near][best], score[best]))
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=schema)

    found = dealt.groupBy("block", "dim").cogroup(asked.groupBy("block", "dim")).applyInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

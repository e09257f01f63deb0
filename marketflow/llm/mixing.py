"""Mixing of sources by temperature, in SQL functions alone.

A source's share of all tokens is raised to an exponent between 0 (equal weights) and 1 (its natural share). The exponent is
bisected: the largest one that reaches a target entropy, or, if that repeats a source too often, the smallest that keeps within the limit.
Rows are dealt to blocks by a hash of their id. A source's budget buys whole passes over its blocks and, for the rest, the
blocks of that pass's permutation, in turn, that still fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import prepare, stored

WORD = r"[^\x20\x09-\x0D]+"
BLOCKS = 512  # per source
LEVELS, STEP = 24, 4  # bisections, and how many of them one job decides
ENTROPY, PASSES = 0.9, 2.0
PART = "struct<used: bigint, blocks: array<bigint>>"  # tokens and blocks taken for the part pass


def dealt(docs: DataFrame, seed: int, blocks: int) -> DataFrame:
    """``docs`` with _source, _block and n_tokens (words). Null sources are one source; null ids share a block."""
    number = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("long")
    return docs.withColumns({
        "_source": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")), "_block": number % blocks,
        "n_tokens": F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")})


def _bisected(totals: DataFrame, holds, rise: bool) -> float:
    """Bisect an exponent between 0 and 1. ``holds(alpha)`` gives an aggregate that is true up to (``rise``: from) some exponent on."""
    low, high = 0.0, 1.0
    for _ in range(LEVELS // STEP):
        tries = [low + (high - low) * k / 2**STEP for k in range(1, 2**STEP)]
        answers = dict(zip(tries, totals.agg(*(holds(F.lit(a)).alias(f"a{i}") for i, a in enumerate(tries))).first()))
        for _ in range(STEP):
            middle = (low + high) / 2
            low, high = (low, middle) if bool(answers[middle]) == rise else (middle, high)
    return high if rise else low


def exponent(totals: DataFrame, entropy: float = ENTROPY, passes: float = PASSES) -> float:
    """The exponent for ``totals`` (tokens of each source, a row each). One source or none: 1."""
    known = totals.where("tokens > 0")
    count, most = known.agg(F.count(F.lit(1)), F.max("tokens")).first()
    if count < 2:
        return 1.0
    # Shares of the largest source, which cancel in the weights and keep the powers in range.
    share = F.col("tokens") / F.lit(float(most))

    def entropy_of(a: Column) -> Column:
        power = F.pow(share, a)
        return F.log(F.sum(power)) - a * F.sum(power * F.log(share)) / F.sum(power)

    even = _bisected(known, lambda a: entropy_of(a) >= F.lit(entropy) * F.log(F.lit(float(count))), False)
    within = _bisected(known, lambda a: F.max(F.pow(share, a - 1)) <= F.lit(passes), True)
    return max(even, within)


def mixture(docs: DataFrame, entropy: float = ENTROPY, passes: float = PASSES, budget: int | None = None, seed: int = 7, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with n_tokens, weight (of its source), block, pass and place (of the block within the pass): a row per pass that has it.

    ``budget`` is in tokens; without one the most abundant source makes exactly one pass and no document is left out. Sources are few
    (a row each is sorted at once), their rows are not: they are counted per block before the shuffle. A source
    without tokens makes one pass. Repeated rows are mixed as separate rows. Columns of the new names are replaced.
    """
    prepare(docs.sparkSession)
    own = [c for c in docs.columns if c.lower() not in ("n_tokens", "weight", "block", "pass", "place")]
    rows = dealt(docs.select(*own), seed, blocks)
    cells = stored(rows.groupBy("_source", "_block").agg(F.sum("n_tokens").alias("tokens")), "cells")
    totals = cells.groupBy("_source").agg(F.sum("tokens").alias("tokens"))
    alpha = exponent(totals, entropy, passes)
    most = float(totals.agg(F.max("tokens")).first()[0] or 1)
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(max(most, 1.0)), F.lit(alpha))).otherwise(F.lit(0.0))
    normal = totals.withColumn("_power", power)
    whole = float(normal.agg(F.sum("_power")).first()[0] or 1.0) or 1.0
    spend = F.col("_power") * F.lit(most) if budget is None else F.col("_power") / F.lit(whole) * F.lit(float(budget))
    turns = F.when(F.col("tokens") > 0, F.round(spend / F.col("tokens"), 9)).otherwise(F.lit(1.0))
    plan = normal.select("_source", (F.col("_power") / F.lit(whole)).alias("weight"), F.floor(turns).alias("_full"),
                         F.floor((turns - F.floor(turns)) * F.col("tokens")).alias("_rest"))
    last = F.col("_full") + 1

    def order(number: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), number.cast("string"), F.col("_source"), F.col("_block").cast("string")))

    # A source's blocks, as many as the parameter says, in the order of the part pass: each that still fits is taken, so that what is left of the
    # budget is less than any block that stays out.
    nothing = F.struct(F.lit(0), F.array()).cast(PART)
    line = cells.join(plan, "_source").groupBy("_source", "weight", "_full", "_rest").agg(
        F.array_sort(F.collect_list(F.struct(order(last).alias("order"), F.col("_block").alias("block"), "tokens"))).alias("_line"))
    part = F.aggregate("_line", nothing, lambda had, b: F.when(
        had["used"] + b["tokens"] <= F.col("_rest"), F.struct(had["used"] + b["tokens"], F.concat(had["blocks"], F.array(b["block"]))).cast(PART)
    ).otherwise(had), lambda had: had["blocks"])
    taken = (line.select("_source", "weight", "_full", part.alias("_part"), F.explode(F.col("_line.block")).alias("_block"))
             .withColumn("_copies", F.col("_full") + F.array_contains("_part", F.col("_block")).cast("long"))
             .where("_copies > 0").select("_source", "_block", "weight", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("pass")))
    placed = taken.withColumn("place", F.substring(order(F.col("pass")), 1, 8))
    return rows.join(placed, ["_source", "_block"]).select(*own, "n_tokens", "weight", F.col("_block").alias("block"), "pass", "place")

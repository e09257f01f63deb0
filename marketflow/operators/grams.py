"""Runs of two and three letters of indexed terms: which terms can match a pattern or lie near a word.

Every term is held with an end mark on either side. A term that contains a text contains all its runs of letters;
an edit changes few of them, so a term near a word shares most. The stored table has a row per run and block of
terms, ordered by run within a file: a query reads the rows of its own runs, counts runs per term, and tests only the
terms that share enough. A term of several fields is cut into runs once; terms of the same fields share blocks. Patterns without two letters in a row, and so many edits that no run need be shared,
leave nothing to look up: those test the whole vocabulary, but no text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import double_swaps, swaps

# Ends of a term; no token holds them.
START, END = "^", "$"
SIZES = (2, 3)
BLOCKS = "fields array<string>, size int, gram string, terms array<string>"
BLOCK_LETTERS = 1 << 20  # letters of a block of terms; a longer term is a block of its own


def _runs(fields: list[str], terms: list[str]) -> Iterator[pa.RecordBatch]:
    """A row per size and run of letters, with the terms that hold it."""
    sizes = np.fromiter(map(len, terms), np.int64, len(terms)) + 2
    codes = np.frombuffer("".join(f"{START}{t}{END}" for t in terms).encode("utf-32-le"), "<u4").astype(np.int64)
    of, left = np.repeat(np.arange(len(terms)), sizes), np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
    held = pa.array(terms, pa.string())
    for size in SIZES:
        begins = np.flatnonzero(left >= size)
        run = np.zeros(len(begins), np.int64)
        for i in range(size):
            run = run << 21 | codes[begins + i]
        distinct, number = np.unique(run, return_inverse=True)
        number, term = np.divmod(np.unique(number * len(terms) + of[begins]), len(terms))
        starts = np.searchsorted(number, np.arange(len(distinct) + 1))
        texts = ["".join(chr(code >> 21 * i & 0x1FFFFF) for i in reversed(range(size))) for code in distinct.tolist()]
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), held.take(pa.array(term)))
        yield pa.RecordBatch.from_arrays([pa.array([fields] * len(texts), pa.list_(pa.string())), pa.array(np.full(len(texts), size), pa.int32()),
                                          pa.array(texts, pa.string()), lists], names=["fields", "size", "gram", "terms"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, sizes = {}, {}
    for batch in batches:
        for fields, term in zip(*(c.to_pylist() for c in batch.columns)):
            fields = tuple(fields)
            held.setdefault(fields, []).append(term)
            sizes[fields] = sizes.get(fields, 0) + len(term)
            if sum(sizes.values()) >= BLOCK_LETTERS:
                for own, terms in held.items():
                    yield from _runs(list(own), terms)
                held, sizes = {}, {}
    for own, terms in held.items():
        yield from _runs(list(own), terms)


def gram_table(vocabulary: DataFrame) -> DataFrame:
    """A row per run of letters and block of terms of a vocabulary (field, term)."""
    named = vocabulary.where(F.length("term") > 0).groupBy("term").agg(F.array_sort(F.collect_set("field")).alias("fields"))
    return named.select("fields", "term").mapInArrow(_cut, BLOCKS)


def spread_grams(blocks: DataFrame) -> DataFrame:
    """A row per field, run of letters and term of a table of blocks."""
    each = blocks.select(F.explode("fields").alias("field"), "size", "gram", "terms").select("field", "size", "gram", F.explode("terms").alias("term"))
    return each.withColumn("letters", F.length("term"))


def runs_of(text: str, size: int) -> set[str]:
    return {text[i : i + size] for i in range(len(text) - size + 1)}


def contained_runs(pattern: str) -> set[str]:
    """Runs of letters that every term with ``*pattern*`` holds; the longest that each stretch between wildcards has."""
    needed: set[str] = set()
    for part in re.split(r"[*?]", pattern):
        size = min(len(part), max(SIZES))
        if size >= min(SIZES):
            needed |= runs_of(part, size)
    return needed


def with_all(grams: DataFrame, field: str, needed: Iterable[str]) -> DataFrame:
    """Terms that hold all the given runs."""
    needed = sorted(set(needed))
    rows = grams.where((F.col("field") == field) & F.col("gram").isin(needed))
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") == len(needed)).select("term")


def near_runs(value: str, edits: int) -> list[tuple[set[str], int]] | None:
    """Sets of pairs of letters, and how many of a set a term within so many edits shares; None if it may share none.

    An insertion, deletion or replacement changes two pairs of the marked word at most. A swap is undone first: a
    term is within plain edits of the word, or with one edit less of the word with a swap in it, and so on.
    """
    variants = [(value, edits)]
    if edits >= 1:
        variants += [(v, edits - 1) for v in swaps(value)]
    if edits >= 2:
        variants += [(v, edits - 2) for v in double_swaps(value)]
    wanted = []
    for text, rest in variants:
        own = runs_of(f"{START}{text}{END}", 2)
        if len(own) - 2 * rest < 1:
            return None
        wanted.append((own, len(own) - 2 * rest))
    return wanted


def sharing(grams: DataFrame, field: str, value: str, edits: int, wanted: list[tuple[set[str], int]]) -> DataFrame:
    """Terms of a fitting length that share enough pairs with the word or one of its swapped forms."""
    every = sorted(set().union(*(own for own, _ in wanted)))
    fitting = F.col("letters").between(len(value) - edits, len(value) + edits)
    rows = grams.where((F.col("field") == field) & (F.col("size") == 2) & F.col("gram").isin(every) & fitting)
    enough: list[Column] = [F.count_if(F.col("gram").isin(sorted(own))) >= least for own, least in wanted]
    return rows.groupBy("term").agg(reduce(or_, enough).alias("enough")).where("enough").select("term")

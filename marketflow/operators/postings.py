"""A stored index of a document table: postings, vocabulary, runs of letters and totals.

Written once, read by every query: a search reads the postings of its own terms
and no text. A task cuts its texts into tokens and counts them block by block, so that
the shuffle carries a row per term and block of documents, with the ids, lengths and counts
of these, and no row per occurrence. ``terms`` holds these blocks: each file is ordered by term, and the blocks
of a frequent term are dealt to several files; ``vocabulary`` holds the documents per term, ``grams`` the runs of
letters of each term, ``totals`` a row per field.

An id names a document. Rows that share an id and have as many tokens in a field count as one document there: the few
ids that repeat are counted by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import and_, or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import TOKEN, auto_edits, tokens
from ..session import let_workers_import
from . import grams as G
from .search import field_score, near_token, query_terms, query_tokens, token_like

# Terms that go into a query as literals; more are joined.
LITERAL_TERMS = 1000
BLOCK_BYTES = 1 << 24  # text of a block of documents; a longer text is a block of its own
SLICES = 16  # files among which the blocks of a term are dealt, at most
NO_TOKEN = f"[^{TOKEN[1:-2]}]+"


class Postings:
    """The index below ``path``; ``id_column`` names the id of its documents, ``id_type`` its type."""

    def __init__(self, spark: SparkSession, path: str, id_column: str, id_type: str = "long"):
        self.spark, self.path, self.id_column, self.id_type = spark, path, id_column, id_type

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    @property
    def blocks(self) -> DataFrame:
        """A row per field, term and block of documents."""
        return self._read("terms", f"field string, {_blocks_type(self.id_type, False)}")

    @property
    def terms(self) -> DataFrame:
        """A row per field, term and document."""
        each = self.blocks.select("field", "term", F.explode("postings").alias("p"))
        return each.select("field", "term", F.col("p.id").alias(self.id_column), F.col("p.length").alias("length"), F.col("p.tf").cast("long").alias("tf"))

    @property
    def vocabulary(self) -> DataFrame:
        return self._read("vocabulary", "field string, term string, documents long, occurrences long, leads long")

    @property
    def grams(self) -> DataFrame:
        return G.spread_grams(self._read("grams", G.BLOCKS))

    @property
    def places(self) -> DataFrame:
        blocks = self._read("places", f"field string, {_blocks_type(self.id_type, True)}")
        each = blocks.select("field", "term", F.explode("postings").alias("p"))
        return each.select("field", "term", F.col("p.id").alias(self.id_column), F.col("p.places").alias("places"))

    @property
    def totals(self) -> DataFrame:
        return self._read("totals", "field string, documents long, tokens long")


def _blocks_type(id_type: str, places: bool) -> str:
    held = f"id: {id_type}, " + ("places: array<int>" if places else "length: int, tf: int")
    return f"term string, documents long, occurrences long, leads long, postings array<struct<{held}>>"


def _parts(fields: Mapping[str, Column | Sequence[str]]) -> tuple[dict[str, Column], dict[str, list[str]]]:
    """The texts to cut into tokens, by name, and the names of each field."""
    texts, own = {}, {}
    for field, given in fields.items():
        if isinstance(given, Column):
            texts[f"_field_{field}"], own[field] = given, [f"_field_{field}"]
        else:
            texts |= {name: F.col(name) for name in given}
            own[field] = list(given)
    return texts, own


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.Array]]:
    """The columns of as many consecutive rows as have ``most`` bytes of text (all but the first column), one row at least."""
    held, size = [], 0
    for batch in batches:
        sizes = sum((pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[1:]), np.zeros(batch.num_rows, np.int64))
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = max(int(np.searchsorted(ends, before + most - size, "right")), start if held else start + 1)
            if end > start:
                held.append(batch.slice(start, end - start))
                size += int(ends[end - 1]) - before
            if end < batch.num_rows:
                yield [pa.concat_arrays(columns) for columns in zip(*(b.columns for b in held))]
                held, size = [], 0
            start = end
    if held:
        yield [pa.concat_arrays(columns) for columns in zip(*(b.columns for b in held))]


def _lists(values: pa.Array, starts: np.ndarray, end: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, end), pa.int32()), values)


def _counted(ids: pa.Array, index: np.ndarray, doc: np.ndarray, terms: pa.Array, places: bool) -> list[pa.Array]:
    """The columns of a block: term, documents, occurrences, leads, postings. ``index`` and ``doc`` are the term and row of each token,
    a row's tokens in order; other rows' may lie between them."""
    rows = max(1, len(ids))
    key = index.astype(np.int64) * rows + doc
    order = np.argsort(key, kind="stable") if places else None
    key_sorted = key[order] if places else np.sort(key)
    starts = np.flatnonzero(np.diff(key_sorted, prepend=-1))
    tf = np.diff(np.append(starts, len(key)))
    term, at = np.divmod(key_sorted[starts], rows)
    first = np.flatnonzero(np.diff(term, prepend=-1))  # postings of a term, from the first one on
    lengths = np.bincount(doc, minlength=rows)
    if places:
        by_row = np.argsort(doc, kind="stable")  # the place of a token among those of its row
        place = np.empty(len(doc), np.int32)
        place[by_row] = np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        held = pa.StructArray.from_arrays([ids.take(pa.array(at)), _lists(pa.array(place[order]), starts, len(key))], ["id", "places"])
    else:
        held = pa.StructArray.from_arrays([ids.take(pa.array(at)), pa.array(lengths[at], pa.int32()), pa.array(tf, pa.int32())], ["id", "length", "tf"])
    leading = np.full(rows, -1)
    leading[doc[::-1]] = index[::-1]  # of a row's tokens the first is set last
    leads = np.bincount(leading[leading >= 0], minlength=len(terms))
    named = term[first]
    return [terms.take(pa.array(named)), pa.array(np.diff(np.append(first, len(starts)))), pa.array(np.add.reduceat(tf, first) if len(first) else tf),
            pa.array(leads[named]), _lists(held, first, len(starts))]


def _known(text: Column) -> Column:
    """Characters that Java does not know are no letters to ``tokens``, though Arrow may know them. None of them is ASCII."""
    return F.when(F.length(text) < F.octet_length(text), F.regexp_replace(text, r"\p{Cn}", " ")).otherwise(text)


def _in_place(docs: DataFrame, fields: Mapping[str, Column | Sequence[str]], id_column: str, places: bool) -> DataFrame:
    """Blocks of documents, each of rows that lie together."""
    texts, own = _parts(fields)
    at = {name: i for i, name in enumerate(texts)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, *columns in _gathered(batches, BLOCK_BYTES):
            cut = [pc.ascii_split_whitespace(pc.replace_substring_regex(pc.fill_null(c.cast(pa.string()), ""), NO_TOKEN, " ")) for c in columns]
            flat = [c.flatten() for c in cut]
            coded = pa.concat_arrays(flat).dictionary_encode()
            index, ends = coded.indices.to_numpy(zero_copy_only=False), np.cumsum([0, *map(len, flat)])
            rows = [np.repeat(np.arange(len(ids)), np.diff(np.asarray(c.offsets))) for c in cut]
            empty = pc.equal(coded.dictionary, "")
            for field, names in own.items():
                of_terms = np.concatenate([index[ends[at[n]] : ends[at[n] + 1]] for n in names])
                of_rows = np.concatenate([rows[at[n]] for n in names])
                if pc.any(empty).as_py():  # white space at either end
                    full = ~empty.to_numpy(zero_copy_only=False)[of_terms]
                    of_terms, of_rows = of_terms[full], of_rows[full]
                made = _counted(ids, of_terms, of_rows, coded.dictionary, places)
                yield pa.RecordBatch.from_arrays([pa.repeat(field, len(made[0])), *made], names=["field", "term", "documents", "occurrences", "leads", "postings"])

    kind = docs.schema[id_column].dataType.simpleString()
    lowered = docs.select(F.col(id_column), *(_known(F.lower(F.coalesce(c.cast("string"), F.lit("")))).alias(n) for n, c in texts.items()))
    return lowered.mapInArrow(count, f"field string, {_blocks_type(kind, places)}")


def _by_shuffle(docs: DataFrame, fields: Mapping[str, Column | Sequence[str]], id_column: str, places: bool) -> DataFrame:
    """The same, a block per document, for ids that several rows have."""
    joined = {f: c if isinstance(c, Column) else F.concat_ws(" ", *c) for f, c in fields.items()}
    held = F.array(*(F.struct(F.lit(f).alias("field"), tokens(F.coalesce(c, F.lit(""))).alias("tokens")) for f, c in joined.items()))
    spread = docs.select(F.col(id_column).alias("id"), F.inline(held))
    placed = spread.select("id", "field", F.size("tokens").alias("length"), F.posexplode("tokens").alias("pos", "term"))
    tf = F.count(F.lit(1)).alias("occurrences")
    if places:
        each = placed.groupBy("field", "term", "id").agg(tf, F.array_sort(F.collect_list("pos")).alias("places"))
        posting = F.struct("id", "places")
    else:
        each = placed.groupBy("field", "term", "id", "length").agg(tf, F.bool_or(F.col("pos") == 0).cast("long").alias("leads"))
        posting = F.struct("id", "length", F.col("occurrences").cast("int").alias("tf"))
    leads = F.lit(0).cast("long").alias("leads") if places else F.col("leads")
    return each.select("field", "term", F.lit(1).cast("long").alias("documents"), "occurrences", leads, F.array(posting).alias("postings"))


def _write_blocks(docs: DataFrame, fields: Mapping[str, Column | Sequence[str]], path: str, id_column: str, places: bool) -> None:
    """Write the blocks of all documents, ordered by term within a file."""
    let_workers_import(docs.sparkSession)
    repeated = docs.groupBy(F.col(id_column).alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_id")
    if repeated.isEmpty():
        blocks = _in_place(docs, fields, id_column, places)
    else:
        # Stored, as Spark then knows its size.
        repeated.write.mode("overwrite").parquet(f"{path}_repeated")
        repeated = docs.sparkSession.read.schema(repeated.schema).parquet(f"{path}_repeated")
        same = F.col("_id").eqNullSafe(F.col(id_column))
        blocks = _in_place(docs.join(repeated, same, "left_anti"), fields, id_column, places).unionAll(
            _by_shuffle(docs.join(repeated, same, "left_semi"), fields, id_column, places))
    dealt = blocks.repartition("field", "term", F.pmod(F.xxhash64(F.col("postings")[0]["id"]), F.lit(SLICES)))
    dealt.sortWithinPartitions("field", "term").write.mode("overwrite").partitionBy("field").parquet(path)


def build_postings(docs: DataFrame, fields: Mapping[str, Column | Sequence[str]], path: str, id_column: str) -> Postings:
    """Write the index of the given fields: a column each, or the names of several, whose texts then count as joined by spaces.

    One pass over the texts, in which a text that several fields hold is cut into tokens once. Documents per field are counted at each
    document's first token.
    """
    _write_blocks(docs, fields, f"{path}/terms", id_column, False)
    index = Postings(docs.sparkSession, path, id_column, docs.schema[id_column].dataType.simpleString())
    per_term = index.blocks.groupBy("field", "term").agg(*(F.sum(c).alias(c) for c in ("documents", "occurrences", "leads")))
    per_term.repartitionByRange("field", "term").sortWithinPartitions("field", "term").write.mode("overwrite").parquet(f"{path}/vocabulary")
    runs = G.gram_table(index.vocabulary.select("field", "term"))
    dealt = runs.repartition("size", "gram", F.pmod(F.xxhash64(F.col("terms")[0]), F.lit(SLICES)))
    dealt.sortWithinPartitions("size", "gram").write.mode("overwrite").parquet(f"{path}/grams")
    totals = index.vocabulary.groupBy("field").agg(F.sum("leads").alias("documents"), F.sum("occurrences").alias("tokens"))
    totals.write.mode("overwrite").parquet(f"{path}/totals")
    return index


def build_places(docs: DataFrame, fields: Mapping[str, Column | Sequence[str]], index: Postings) -> Postings:
    """Write where each term stands in each document, in tokens from its start, beside an index; phrase search needs it."""
    _write_blocks(docs, fields, f"{index.path}/places", index.id_column, True)
    return index


def _moved(places: Column, by: int) -> Column:
    return F.transform(places, lambda place: place + F.lit(by))


def phrase(index: Postings, query: str, field: str) -> DataFrame:
    """Ids of the documents in which the tokens of the query follow one another, and how often they do.

    Only the rows of the query's own terms are read. A place counts if every term stands as far behind it as in the query.
    """
    terms = query_tokens(query)
    if not terms:
        return index.places.where(F.lit(False)).select(index.id_column, F.lit(0).alias("occurrences"))
    rows = index.places.where((F.col("field") == field) & F.col("term").isin(sorted(set(terms))))
    distinct = list(dict.fromkeys(terms))
    each = rows.groupBy(index.id_column).agg(*(F.first(F.when(F.col("term") == t, F.col("places")), ignorenulls=True).alias(f"_at_{i}") for i, t in enumerate(distinct)))
    begins = [_moved(F.col(f"_at_{distinct.index(t)}"), -i) for i, t in enumerate(terms)]
    common = reduce(F.array_intersect, begins)
    found = each.where(reduce(and_, (F.col(f"_at_{i}").isNotNull() for i in range(len(distinct)))))
    return found.select(index.id_column, F.size(common).alias("occurrences")).where("occurrences > 0")


def _statistics(index: Postings, fields: Sequence[str], terms: Sequence[str]) -> tuple[Column, Column]:
    """The totals, and the documents of each term, as one row each."""
    sums, counts = [], []
    for f in fields:
        here = F.col("field") == f
        sums += [F.max(F.when(here, F.col("documents"))).alias(f"n_{f}"), F.max(F.when(here, F.col("tokens"))).alias(f"total_{f}")]
        counts += [
            F.coalesce(F.max(F.when(here & (F.col("term") == t), F.col("documents"))), F.lit(0)).alias(f"df_{f}_{i}")
            for i, t in enumerate(terms)
        ]
    known = index.vocabulary.where(F.col("field").isin(list(fields)) & F.col("term").isin(list(terms)))
    return index.totals.agg(F.struct(*sums).alias("s")).scalar(), known.agg(F.struct(*counts).alias("s")).scalar()


def _counts(index: Postings, fields: Sequence[str], terms: Sequence[str]) -> DataFrame:
    """A row per document with any of the terms: occurrences ``_tf_f_i`` of each, and the length of fields that hold one."""
    found = index.terms.where(F.col("field").isin(list(fields)) & F.col("term").isin(list(terms)))
    columns = []
    for f in fields:
        here = F.col("field") == f
        columns.append(F.max(F.when(here, F.col("length"))).alias(f"_len_{f}"))
        columns += [
            F.coalesce(F.max(F.when(here & (F.col("term") == t), F.col("tf"))), F.lit(0)).alias(f"_tf_{f}_{i}")
            for i, t in enumerate(terms)
        ]
    return found.groupBy(index.id_column).agg(*columns)


def _scored(index: Postings, fields: Sequence[str], terms: Sequence[str], scoring: Sequence[int], kept: Column | None = None) -> DataFrame:
    rows = _counts(index, fields, terms).where(reduce(or_, (F.col(f"_tf_{f}_{i}") > 0 for f in fields for i in scoring)))
    if kept is not None:
        rows = rows.where(kept)
    totals, counts = _statistics(index, fields, terms)
    rows = rows.withColumn("_totals", totals).withColumn("_counts", counts)
    stats = lambda name: F.col("_counts" if name.startswith("df_") else "_totals")[name]
    best = [field_score(f, scoring, stats) for f in fields]
    return rows.select(index.id_column, F.round(F.greatest(*best) if len(best) > 1 else best[0], 6).alias("score"))


def match(index: Postings, query: str, fields: Sequence[str]) -> DataFrame:
    """Ids and scores of the documents with any token of the query in any field; the best field decides."""
    terms = query_terms(query)
    if not terms or not fields:
        return index.terms.where(F.lit(False)).select(index.id_column, F.lit(0.0).alias("score"))
    return _scored(index, fields, terms, range(len(terms)))


def term(index: Postings, field: str, value: str) -> DataFrame:
    """Ids and scores of the documents that hold exactly this token."""
    return _scored(index, [field], [value], [0])


def match_combined(index: Postings, field: str, must: Sequence[str] = (), should: Sequence[str] = (), must_not: Sequence[str] = ()) -> DataFrame:
    """Every ``must`` term is needed, no ``must_not`` term allowed, else one ``should`` term at least; the first two score.

    ``field`` may be one indexed over several columns joined by spaces.
    """
    terms = [t.lower() for t in (*must, *should, *must_not)]
    scoring = range(len(must) + len(should))
    if not scoring:
        raise ValueError("give at least one must or should term")
    needed = [F.col(f"_tf_{field}_{i}") > 0 for i in range(len(must))]
    banned = [F.col(f"_tf_{field}_{i}") == 0 for i in range(len(scoring), len(terms))]
    return _scored(index, [field], terms, scoring, reduce(and_, needed + banned) if needed or banned else None)


def _holding(index: Postings, field: str, terms: DataFrame) -> DataFrame:
    """Ids of the documents with any of the terms. A few terms are looked up as literals, more are joined to the blocks, before these are spread."""
    few = [row.term for row in terms.take(LITERAL_TERMS + 1)]
    blocks = index.blocks.where(F.col("field") == field).select("term", F.col("postings.id").alias("ids"))
    found = blocks.where(F.col("term").isin(few)) if len(few) <= LITERAL_TERMS else blocks.join(terms, "term", "left_semi")
    return found.select(F.explode("ids").alias(index.id_column)).distinct()


def wildcard_terms(index: Postings, field: str, content: str) -> DataFrame:
    """Terms that match ``*content*``, found by the runs of letters between its wildcards."""
    needed = G.contained_runs(content)
    likely = G.with_all(index.grams, field, needed) if needed else index.vocabulary.where(F.col("field") == field).select("term")
    return likely.where(token_like(F.col("term"), content))


def wildcard(index: Postings, field: str, content: str) -> DataFrame:
    """Ids of the documents with a token that matches ``*content*``; ``*`` and ``?`` inside keep their meaning."""
    return _holding(index, field, wildcard_terms(index, field, content))


def fuzzy_terms(index: Postings, field: str, value: str, edits: int | None = None) -> DataFrame:
    """Terms near ``value``, found by the pairs of letters they must share with it."""
    allowed = auto_edits(value) if edits is None else edits
    if allowed == 0:
        return index.vocabulary.where((F.col("field") == field) & (F.col("term") == value)).select("term")
    wanted = G.near_runs(value, allowed)
    if wanted is None:
        likely = index.vocabulary.where(F.col("field") == field).select("term")
    else:
        likely = G.sharing(index.grams, field, value, allowed, wanted)
    return likely.where(near_token(F.col("term"), value, allowed))


def fuzzy(index: Postings, field: str, value: str, edits: int | None = None) -> DataFrame:
    """Ids of the documents with a token near ``value``."""
    return _holding(index, field, fuzzy_terms(index, field, value, edits))


def with_documents(found: DataFrame, docs: DataFrame, id_column: str) -> DataFrame:
    """The documents of found ids, with the score if there is one."""
    return docs.join(found, id_column)

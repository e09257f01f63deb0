"""Full-text search over a table of documents.

Without an index: documents are tokenised where they lie and only reduced rows
move. The term statistics come back as one row, and a query is a list of tokens,
so it is matched with literals and no join. Every query reads all texts;
``postings`` answers the same queries from a stored index.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import auto_edits, tokens, within_edits
from .ranking import top_rows

# Scoring constants, highlight marks and default page sizes.
K1, B = 1.2, 0.75
PRE_TAG, POST_TAG = '<span style="color:red">', "</span>"
MATCH_SIZE, TERM_SIZE = 10, 20


def query_tokens(text: str) -> list[str]:
    """Tokens of a query in order."""
    return re.findall(r"[^\W_]+", text.lower())


def query_terms(text: str) -> list[str]:
    """Distinct tokens of a query in order."""
    return list(dict.fromkeys(query_tokens(text)))


def _occurrences(found: Column, term: str) -> Column:
    return F.size(F.filter(found, lambda t: t == F.lit(term)))


def _with_counts(docs: DataFrame, fields: dict[str, Column], terms: Sequence[str]) -> DataFrame:
    """Per field ``f``: token count ``_len_f`` and occurrences ``_tf_f_i`` of each term.

    Tokens are made in a generator, once per document, whatever reads the counts.
    """
    held = F.struct(*(tokens(F.coalesce(c, F.lit(""))).alias(f"_tok_{f}") for f, c in fields.items()))
    spread = docs.select("*", F.inline(F.array(held)))
    counts = {f"_len_{f}": F.size(f"_tok_{f}") for f in fields}
    for f in fields:
        for i, term in enumerate(terms):
            counts[f"_tf_{f}_{i}"] = _occurrences(F.col(f"_tok_{f}"), term)
    return spread.withColumns(counts).drop(*(f"_tok_{f}" for f in fields))


def _may_contain(fields: dict[str, Column], terms: Sequence[str]) -> Column:
    """Cheap test that lets documents without any term skip the tokeniser."""
    return reduce(or_, (F.contains(F.lower(c), F.lit(t)) for c in fields.values() for t in terms))


def _statistics(docs: DataFrame, fields: dict[str, Column], terms: Sequence[str]) -> Column:
    """One row: documents and tokens per field, documents per field and term."""
    counted = _with_counts(docs.select(*(c.alias(f) for f, c in fields.items())), {f: F.col(f) for f in fields}, terms)
    totals = []
    for f in fields:
        totals.append(F.count_if(F.col(f"_len_{f}") > 0).alias(f"n_{f}"))
        totals.append(F.sum(f"_len_{f}").alias(f"total_{f}"))
        totals += [F.count_if(F.col(f"_tf_{f}_{i}") > 0).alias(f"df_{f}_{i}") for i in range(len(terms))]
    return counted.agg(F.struct(*totals).alias("stats")).scalar()


def field_score(f: str, positions: Sequence[int], stats: Callable[[str], Column]) -> Column:
    """BM25 of the terms at ``positions`` in one field; ``stats`` gives a number by its name."""
    n = stats(f"n_{f}")
    average = stats(f"total_{f}") / n
    parts = []
    for i in positions:
        tf, df = F.col(f"_tf_{f}_{i}"), stats(f"df_{f}_{i}")
        idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
        norm = tf + K1 * (1 - B + B * F.col(f"_len_{f}") / average)
        parts.append(F.when(tf > 0, idf * (tf * (K1 + 1)) / norm).otherwise(0.0))
    return reduce(add, parts)


def _scored(docs: DataFrame, fields: dict[str, Column], terms: Sequence[str], scoring: Sequence[int]) -> DataFrame:
    likely = _with_counts(docs.where(_may_contain(fields, [terms[i] for i in scoring])), fields, terms)
    hits = reduce(or_, (F.col(f"_tf_{f}_{i}") > 0 for f in fields for i in scoring))
    scored = likely.where(hits).withColumn("_stats", _statistics(docs, fields, terms))
    best = [field_score(f, scoring, lambda name: F.col("_stats")[name]) for f in fields]
    return scored.withColumn("score", F.round(F.greatest(*best) if len(best) > 1 else best[0], 6))


def match(docs: DataFrame, query: str, fields: Sequence[str]) -> DataFrame:
    """Documents with any token of the query in any field, with ``score``.

    With several fields the best field decides.
    """
    terms = query_terms(query)
    if not terms or not fields:
        return docs.where(F.lit(False)).withColumn("score", F.lit(0.0))
    named = {f: F.col(f) for f in fields}
    return _scored(docs, named, terms, range(len(terms))).select(*docs.columns, "score")


def match_all_fields(docs: DataFrame, fields: Sequence[str], must: Sequence[str] = (), should: Sequence[str] = (),
                     must_not: Sequence[str] = ()) -> DataFrame:
    """Search over all fields as one text.

    Every ``must`` term is needed, no ``must_not`` term allowed; without ``must``
    at least one ``should`` term is needed. ``must`` and ``should`` terms score.
    """
    terms = [t.lower() for t in (*must, *should, *must_not)]
    scoring = range(len(must) + len(should))
    if not scoring:
        raise ValueError("give at least one must or should term")
    scored = _scored(docs, {"all": F.concat_ws(" ", *fields)}, terms, scoring)
    needed = [F.col(f"_tf_all_{i}") > 0 for i in range(len(must))]
    banned = [F.col(f"_tf_all_{i}") == 0 for i in range(len(scoring), len(terms))]
    kept = scored.where(reduce(and_, needed + banned)) if needed or banned else scored
    return kept.select(*docs.columns, "score")


def term(docs: DataFrame, field: str, value: str) -> DataFrame:
    """Documents that hold exactly this token; the value itself is not tokenised."""
    return _scored(docs, {field: F.col(field)}, [value], [0]).select(*docs.columns, "score")


def token_like(token: Column, content: str) -> Column:
    """True for a token that holds ``content``; ``*`` in it stands for any letters, ``?`` for one."""
    if not re.search(r"[*?]", content):
        return F.contains(token, F.lit(content))
    return token.rlike("".join({"*": ".*", "?": "."}.get(ch, re.escape(ch)) for ch in content))


def phrase(docs: DataFrame, field: str, query: str) -> DataFrame:
    """Documents in which the tokens of the query follow one another, with ``occurrences``."""
    terms, found = query_tokens(query), F.col("_tokens")
    starts = F.filter(F.sequence(F.lit(1), F.size(found) - len(terms) + 1), lambda i: F.slice(found, i, len(terms)) == F.array(*map(F.lit, terms)))
    spread = docs.select("*", F.inline(F.array(F.struct(tokens(F.coalesce(F.col(field), F.lit(""))).alias("_tokens")))))
    if not terms:
        return docs.where(F.lit(False)).withColumn("occurrences", F.lit(0))
    counted = spread.where(F.size(found) >= len(terms)).withColumn("occurrences", F.size(starts))
    return counted.where("occurrences > 0").select(*docs.columns, "occurrences")


def wildcard(docs: DataFrame, field: str, content: str) -> DataFrame:
    """Documents with a token that matches ``*content*``; ``*`` and ``?`` inside keep their meaning."""
    likely = docs if re.search(r"[*?]", content) else docs.where(F.contains(F.lower(field), F.lit(content)))
    return likely.where(F.exists(tokens(F.col(field)), lambda t: token_like(t, content)))


def fuzzy(docs: DataFrame, field: str, value: str, edits: int | None = None) -> DataFrame:
    """Documents with a token near ``value``; the edits allowed grow with its length."""
    allowed = auto_edits(value) if edits is None else edits
    return docs.where(F.exists(F.array_distinct(tokens(F.col(field))), lambda t: near_token(t, value, allowed)))


def near_token(token: Column, value: str, allowed: int) -> Column:
    return F.length(token).between(len(value) - allowed, len(value) + allowed) & within_edits(token, value, allowed)


def highlight(field: Column, terms: Sequence[str], pre: str = PRE_TAG, post: str = POST_TAG) -> Column:
    """The whole text with every matched token marked; NULL stays NULL."""
    words = "|".join(re.escape(t) for t in terms)
    pattern = rf"(?iu)(?<![\p{{L}}\p{{N}}])({words})(?![\p{{L}}\p{{N}}])"
    return F.regexp_replace(field, pattern, f"{pre}$1{post}") if words else field


def highlighted(hits: DataFrame, fields: Sequence[str], terms: Sequence[str]) -> DataFrame:
    """Hits whose fields are replaced by their marked text."""
    return hits.withColumns({f: highlight(F.col(f), terms) for f in fields})


def page(hits: DataFrame, id_column: str, size: int = MATCH_SIZE, start: int = 0) -> DataFrame:
    """One page, best score first (if scored), equal ones by id."""
    order = [F.desc("score")] if "score" in hits.columns else []
    return top_rows(hits, size, [*order, F.asc(id_column)], start)


def hit_count(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count(F.lit(1)).alias("hits"))

"""Search over the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import lines
from ..operators import postings as P
from ..operators import search as T
from ..session import configure, file_state, path_exists, scratch
from . import fixtures as X

QUERY = "Worthless license, und pour"
MUST, SHOULD, MUST_NOT = ("the", "of"), ("worthless", "license"), ("click",)
PHRASE, REPEATED = "The and Attion, to thanedble", "the the the"
TERM, PART, PATTERN, NEAR = "license", "thle", "ti?n*er", "lisence"


FIELDS = {"text": ["text"], "source": ["source"], "all": ["text", "lang", "source"]}
_built: dict[tuple, P.Postings] = {}


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.spread(X.load(configure(spark), sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def build_index(spark: SparkSession, sf_dir: str) -> P.Postings:
    """The stored index of the documents, with all columns as one field beside text and source."""
    return P.build_postings(_docs(spark, sf_dir), FIELDS, scratch(spark, "postings"), "doc_id")


def _index(spark: SparkSession, sf_dir: str) -> P.Postings:
    """The index of a folder, written at the first query of an application that asks for it, and again once the table's files have changed."""
    key = (spark.sparkContext.applicationId, sf_dir, file_state(spark, f"{sf_dir}/documents.parquet"))
    if key not in _built:
        _built[key] = build_index(configure(spark), sf_dir)
    return _built[key]


def _placed(found: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Found ids beside the short columns of their documents."""
    docs = X.load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return P.with_documents(found, docs, "doc_id")


def search_vocabulary(spark, sf_dir):
    """Documents and occurrences of every term of every indexed field."""
    return _index(spark, sf_dir).vocabulary.select("field", "term", "documents", "occurrences")


def search_match(spark, sf_dir):
    return _placed(T.page(P.match(_index(spark, sf_dir), QUERY, ["text"]), "doc_id"), spark, sf_dir)


def search_match_scores(spark, sf_dir):
    """Every match with its score."""
    return _placed(P.match(_index(spark, sf_dir), QUERY, ["text"]), spark, sf_dir)


def search_match_scan(spark, sf_dir):
    """The same without an index, from the texts."""
    return T.match(_docs(spark, sf_dir), QUERY, ["text"]).select("doc_id", "lang", "source", "score")


def search_multi_match(spark, sf_dir):
    found = P.match(_index(spark, sf_dir), QUERY + " src3 src11", ["text", "source"])
    return _placed(T.page(found, "doc_id", 20), spark, sf_dir)


def search_term(spark, sf_dir):
    return _placed(T.page(P.term(_index(spark, sf_dir), "text", TERM), "doc_id", T.TERM_SIZE), spark, sf_dir)


def search_wildcard(spark, sf_dir):
    return _placed(P.wildcard(_index(spark, sf_dir), "text", PART), spark, sf_dir)


def search_wildcard_pattern(spark, sf_dir):
    """Wildcards within the searched text."""
    return _placed(P.wildcard(_index(spark, sf_dir), "text", PATTERN), spark, sf_dir)


def search_wildcard_scan(spark, sf_dir):
    """The same as ``search_wildcard`` without an index, from the texts."""
    return T.wildcard(_docs(spark, sf_dir), "text", PART).select("doc_id", "lang", "source")


def search_fuzzy(spark, sf_dir):
    return _placed(P.fuzzy(_index(spark, sf_dir), "text", NEAR), spark, sf_dir)


def _places(spark: SparkSession, sf_dir: str) -> P.Postings:
    """The index of a folder with the places of its terms in the texts."""
    index = _index(spark, sf_dir)
    if not path_exists(spark, f"{index.path}/places/_SUCCESS"):
        P.build_places(_docs(spark, sf_dir), {"text": FIELDS["text"]}, index)
    return index


def search_phrase(spark, sf_dir):
    """Documents with a phrase, and how often each has it."""
    return _placed(P.phrase(_places(spark, sf_dir), PHRASE, "text"), spark, sf_dir)


def search_phrase_repeated(spark, sf_dir):
    """A phrase of one word three times: occurrences overlap."""
    return _placed(P.phrase(_places(spark, sf_dir), REPEATED, "text"), spark, sf_dir)


def search_match_all(spark, sf_dir):
    return T.page(_docs(spark, sf_dir), "doc_id")


def search_all_fields(spark, sf_dir):
    return _placed(P.match_combined(_index(spark, sf_dir), "all", MUST, SHOULD, MUST_NOT), spark, sf_dir)


def search_highlight(spark, sf_dir):
    """Every match with its whole text marked."""
    found = P.match(_index(spark, sf_dir), QUERY, ["text"])
    return T.highlighted(P.with_documents(found, _docs(spark, sf_dir), "doc_id"), ["text"], T.query_terms(QUERY)).select("doc_id", "text")


def search_paging(spark, sf_dir):
    """The third page of ten."""
    return _placed(T.page(P.match(_index(spark, sf_dir), QUERY, ["text"]), "doc_id", 10, 20), spark, sf_dir)


def search_hit_count(spark, sf_dir):
    return T.hit_count(P.match(_index(spark, sf_dir), QUERY, ["text"]))


def split_lines(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return docs.select("doc_id", F.posexplode(lines(F.col("text"))).alias("line_no", "line"))


# -- SQL ---------------------------------------------------------------------------------------------

_TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"


def _scored_sql(fields: dict[str, str], terms: list[str], scoring: range | None = None) -> str:
    """All documents with token counts and, per field, the BM25 score of the scoring terms."""
    scoring = range(len(terms)) if scoring is None else scoring
    toks = ", ".join(f"{_TOKENS.format(f'coalesce({e}, {chr(39)*2})')} AS tok_{f}" for f, e in fields.items())
    counts = ", ".join(
        f"len(tok_{f}) AS len_{f}, "
        + ", ".join(f"len(list_filter(tok_{f}, lambda t: t = '{t}')) AS tf_{f}_{i}" for i, t in enumerate(terms))
        for f in fields
    )
    stats = ", ".join(
        f"count(*) FILTER (len_{f} > 0) AS n_{f}, sum(len_{f}) AS total_{f}, "
        + ", ".join(f"count(*) FILTER (tf_{f}_{i} > 0) AS df_{f}_{i}" for i in range(len(terms)))
        for f in fields
    )
    scores = []
    for f in fields:
        parts = [
            f"""CASE WHEN tf_{f}_{i} > 0 THEN ln(1 + (n_{f} - df_{f}_{i} + 0.5::DOUBLE) / (df_{f}_{i} + 0.5::DOUBLE))
            * (tf_{f}_{i} * 2.2::DOUBLE) / (tf_{f}_{i} + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len_{f} / (total_{f}::DOUBLE / n_{f})))
            ELSE 0::DOUBLE END"""
            for i in scoring
        ]
        scores.append(" + ".join(parts))
    any_hit = " OR ".join(f"tf_{f}_{i} > 0" for f in fields for i in scoring)
    return f"""
      WITH tok AS MATERIALIZED (SELECT doc_id, text, lang, source, {toks} FROM documents),
           cnt AS MATERIALIZED (SELECT doc_id, text, lang, source, {counts} FROM tok),
           st AS (SELECT {stats} FROM cnt),
           hit AS (SELECT *, round(greatest({', '.join(scores)}), 6) AS score FROM cnt, st WHERE {any_hit})"""


def _phrase_sql(query: str) -> str:
    words = T.query_tokens(query)
    here = " AND ".join(f"tok[i + {k}] = '{w}'" for k, w in enumerate(words))
    return f"""SELECT doc_id, lang, source, CAST(n AS INT) AS occurrences FROM (
      SELECT doc_id, lang, source, len(list_filter(range(1, len(tok) + 1), lambda i: {here})) AS n
      FROM (SELECT *, {_TOKENS.format('text')} AS tok FROM documents)) WHERE n > 0"""


_TERMS = T.query_terms(QUERY)
_MATCH = _scored_sql({"text": "text"}, _TERMS)
_HITS = "SELECT doc_id, lang, source, score FROM hit"
_ORDER = "ORDER BY score DESC, doc_id"
_ALL_TERMS = [*MUST, *SHOULD, *MUST_NOT]
_WORDS = ", ".join(f"'{t}'" for t in _TERMS)

QUERIES = {
    "search_vocabulary": search_vocabulary,
    "search_match_scan": search_match_scan,
    "search_match": search_match,
    "search_match_scores": search_match_scores,
    "search_multi_match": search_multi_match,
    "search_term": search_term,
    "search_wildcard": search_wildcard,
    "search_wildcard_pattern": search_wildcard_pattern,
    "search_wildcard_scan": search_wildcard_scan,
    "search_fuzzy": search_fuzzy,
    "search_phrase": search_phrase,
    "search_phrase_repeated": search_phrase_repeated,
    "search_match_all": search_match_all,
    "search_all_fields": search_all_fields,
    "search_highlight": search_highlight,
    "search_paging": search_paging,
    "search_hit_count": search_hit_count,
    "split_lines": split_lines,
}

_FIELD_SQL = {"text": "text", "source": "source", "all": "concat_ws(' ', text, lang, source)"}

ORACLES = {
    "search_vocabulary": "SELECT field, term, count(*) AS documents, CAST(sum(tf) AS BIGINT) AS occurrences FROM ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS field, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TOKENS.format(e)}) AS term FROM documents) GROUP BY doc_id, term"
        for f, e in _FIELD_SQL.items()
    ) + ") GROUP BY field, term",
    "search_match_scan": f"{_MATCH} {_HITS}",
    "search_match": f"{_MATCH} {_HITS} {_ORDER} LIMIT 10",
    "search_match_scores": f"{_MATCH} {_HITS}",
    "search_multi_match": _scored_sql({"text": "text", "source": "source"}, [*_TERMS, "src3", "src11"]) + f" {_HITS} {_ORDER} LIMIT 20",
    "search_term": _scored_sql({"text": "text"}, [TERM]) + f" {_HITS} {_ORDER} LIMIT 20",
    "search_wildcard": f"""SELECT doc_id, lang, source FROM documents
      WHERE len(list_filter({_TOKENS.format('text')}, lambda t: contains(t, '{PART}'))) > 0""",
    "search_wildcard_scan": f"""SELECT doc_id, lang, source FROM documents
      WHERE len(list_filter({_TOKENS.format('text')}, lambda t: contains(t, '{PART}'))) > 0""",
    "search_wildcard_pattern": f"""SELECT doc_id, lang, source FROM documents
      WHERE len(list_filter({_TOKENS.format('text')}, lambda t: regexp_matches(t, '{PATTERN.replace('?', '.').replace('*', '.*')}'))) > 0""",
    "search_fuzzy": f"""SELECT doc_id, lang, source FROM documents
      WHERE len(list_filter({_TOKENS.format('text')}, lambda t: damerau_levenshtein(t, '{NEAR}') <= 2)) > 0""",
    "search_phrase": _phrase_sql(PHRASE),
    "search_phrase_repeated": _phrase_sql(REPEATED),
    "search_match_all": "SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id LIMIT 10",
    "search_all_fields": _scored_sql({"all": "concat_ws(' ', text, lang, source)"}, _ALL_TERMS, range(len(MUST) + len(SHOULD)))
    + f" {_HITS} WHERE " + " AND ".join([*(f"tf_all_{i} > 0" for i in range(len(MUST))), f"tf_all_{len(_ALL_TERMS) - 1} = 0"]),
    "search_highlight": f"""SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'),
        lambda w: CASE WHEN lower(w) IN ({_WORDS}) THEN '{T.PRE_TAG}' || w || '{T.POST_TAG}' ELSE w END), '') AS text
      FROM documents WHERE len(list_filter({_TOKENS.format('text')}, lambda t: t IN ({_WORDS}))) > 0""",
    "search_paging": f"{_MATCH} {_HITS} {_ORDER} LIMIT 10 OFFSET 20",
    "search_hit_count": f"{_MATCH} SELECT count(*) AS hits FROM hit",
    "split_lines": r"""SELECT doc_id, CAST(unnest(range(len(l))) AS INT) AS line_no, unnest(l) AS line
      FROM (SELECT doc_id, CASE WHEN text = '' THEN [] ELSE
              regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n') END AS l FROM documents)""",
}

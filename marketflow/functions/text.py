"""Tokens, lines and edit distance."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a token is a run of letters and digits, in lower case.
TOKEN = r"[\p{L}\p{N}]+"


def require_text(**arguments: str | None) -> None:
    """An error that names the arguments of a job that are missing or blank."""
    blank = [name for name, value in arguments.items() if value is None or not value.strip()]
    if blank:
        raise ValueError(f"blank arguments: {', '.join(blank)}")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"))


def lines(text: Column) -> Column:
    """Lines ended by ``\\r\\n``, ``\\r`` or ``\\n``; a line end at the end opens no further line."""
    ended = F.regexp_replace(text, r"(\r\n|\r|\n)\z", "")
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(ended, r"\r\n|\r|\n"))


def auto_edits(term: str) -> int:
    """Edits allowed for a term of this length."""
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


def swaps(term: str) -> set[str]:
    return {term[:i] + term[i + 1] + term[i] + term[i + 2 :] for i in range(len(term) - 1)}


def double_swaps(term: str) -> set[str]:
    """Two swaps that share no letter."""
    return {
        term[:i] + term[i + 1] + term[i] + rest
        for i in range(len(term) - 1)
        for rest in swaps(term[i + 2 :])
    }


def within_edits(token: Column, term: str, edits: int) -> Column:
    """True where ``token`` is at most ``edits`` (0 to 2) insertions, deletions,
    replacements or swaps of neighbours away from ``term``, no letter edited twice.

    Plain edit distance covers all but the swaps. With one edit allowed a swap
    uses it up, so the token is one of the swapped terms. With two, either both
    are swaps, or one swap stands at a known place and the texts before and
    after it differ by at most one plain edit in sum.
    """
    if edits == 0:
        return token == term
    if edits not in (1, 2):
        raise ValueError("edits must be 0, 1 or 2")
    near = F.levenshtein(token, F.lit(term), edits) >= 0
    swapped = swaps(term) if edits == 1 else swaps(term) | double_swaps(term)
    near = near | token.isin(*sorted(swapped)) if swapped else near
    if edits == 1:
        return near
    places = []
    for i in range(len(term) - 1):
        pair = term[i + 1] + term[i]
        for j in range(max(0, i - 1), i + 2):
            before = F.levenshtein(F.substring(token, 1, j), F.lit(term[:i]))
            after = F.levenshtein(F.substring(token, j + 3, 2**30), F.lit(term[i + 2 :]))
            places.append((F.substring(token, j + 1, 2) == pair) & (before + after <= 1))
    return reduce(or_, places, near)

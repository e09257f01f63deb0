"""Secrets in texts: fixed forms, and values in a credential's place that are hard to guess.

A value that stands where a credential would (``db_password: x``, ``Authorization: Bearer x``, ``scheme://user:x@host``) is cut into words, dates,
repeats, keyboard walks and brute-force spans so that the guesses an attacker needs for all of them are fewest: a dynamic
program over the places of the value adds up logarithms of guesses, and for each span the kind it is of. Values that take more than
``10**THRESHOLD`` guesses are secrets; ``changeme``, ``qwertyuiop`` or ``2024-01-01`` are not.

Words are those of the corpus: a word costs the logarithm of all words over its number. All texts are counted. Only distinct
values meet the word counts, as the distinct runs of letters that could be words in them, by a join; nothing of the vocabulary is broadcast.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import prepare, stored

# The base forms. A run of hexadecimal digits, and one of capitals and digits after AKIA, has an end of its own, so a
# least length can stand in the pattern.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
VALUE_CHARS = 6
KINDS = ("assign", "access", "hex", "guess")

# Where credentials stand: a name that ends in or begins with one of these (a line may be a hyphen or nothing), then a sign of assignment;
# a header of authorisation; the user part of an address.
NAMES = ("password", "passwd", "passphrase", "pass", "pwd", "pin", "secret", "token", "api_key", "access_key", "private_key", "encryption_key", "signing_key",
         "auth_key", "credential", "credentials", "creds")
CONTEXT = re.compile(rf"""(?<![a-z0-9])(?:{'|'.join(sorted(NAMES, key=len, reverse=True)).replace('_', '[_-]?')})(?:[_.-][a-z0-9]+){{0,3}}["']?\x20*(?:=>|:=|[:=])\x20*["']?([^\s"'`<>,;()\[\]{{}}]{{6,}})""", re.ASCII | re.IGNORECASE)
HEADER = re.compile(r"""authorization["']?\x20*[:=]\x20*["']?(?:bearer|basic|token)\x20+([A-Za-z0-9+/_.~=-]{6,})""", re.ASCII | re.IGNORECASE)
ADDRESS = re.compile(r"""://[^\s:/@]{1,256}:([^\s/@]{6,})@""", re.ASCII)
#: A text without any of these has no such place; cheap to look for.
SIGNS, ASSIGN_SIGNS = ("pass", "pwd", "pin", "secret", "token", "key", "cred", "authorization", "://"), ("password", "passwd", "secret", "token", "apikey", "api_key")

THRESHOLD = 10.0  # log10 of guesses
LETTERS = (3, 24)  # of a word
PERIODS = 16  # letters of a repeated unit, at most
KINDS_OF_SPAN = 5
YEARS, LAST_YEAR = 200, 2099
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")  # fixed values: rows of a keyboard, each half a key to the right
SHIFTED = ("~!@#$%^&*()_+", "QWERTYUIOP{}|", 'ASDFGHJKL:"', "ZXCVBNM<>?")
LEET = {"4": "a", "@": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"}


#: Where each character lies: along its row, and the row.
PLACES = {c: (i + (1 + row / 2 if row else 0), row) for rows in (ROWS, SHIFTED) for row, line in enumerate(rows) for i, c in enumerate(line)}
DATE = re.compile(r"(?=((?:19|20)\d\d)(?:([-/._]?)(0[1-9]|1[0-2])\2(0[1-9]|[12]\d|3[01]))?)|(?=(0[1-9]|[12]\d|3[01])([-/._]?)(0[1-9]|[12]\d|3[01])\6((?:19|20)\d\d|\d\d))", re.ASCII)


def plainer(value: str) -> str:
    """The value in lower case, with usual replacements of letters undone, character by character."""
    return "".join(LEET.get(c, c.lower() if len(c.lower()) == 1 else c) for c in value)


def possible_words(value: str) -> Iterator[str]:
    """Runs of letters within the value that could be words."""
    text = plainer(value)
    for run in re.finditer(r"[^\W\d_]+", text):
        a, b = run.span()
        for i in range(a, b - LETTERS[0] + 1):
            for j in range(i + LETTERS[0], min(b, i + LETTERS[1]) + 1):
                yield text[i:j]


def _alphabet(value: str) -> float:
    """log10 of the characters that one must try at each place: of all kinds that the value has."""
    kinds = ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10))
    size = sum(n for test, n in kinds if any(c.isascii() and test(c) for c in value))
    size += 33 if any(c.isascii() and not c.isalnum() for c in value) else 0
    return math.log10(size + (128 if not value.isascii() else 0))


def _walks(value: str) -> Iterator[tuple[int, int, float]]:
    """Spans of neighbouring keys: start, end, log10 of guesses (start key, and a direction wherever it changes)."""
    place = [PLACES.get(c) for c in value]
    start, turns, last = 0, 0, None
    for i in range(1, len(value) + 1):
        step = None
        if i < len(value) and place[i] and place[i - 1]:
            along, down = place[i][0] - place[i - 1][0], place[i][1] - place[i - 1][1]
            step = (along, down) if abs(along) <= 1 and abs(down) <= 1 and (down == 0) == (abs(along) == 1) else None
        if step is None:
            if i - start >= 3:
                yield start, i, math.log10(len(PLACES) / 2) + turns * math.log10(6) + math.log10(i - start) * (1 + turns)
            start, turns, last = i, 0, None
        elif step != last:
            turns, last = turns + 1, step


def _repeats(value: str) -> Iterator[tuple[int, int, int]]:
    """Spans that repeat what stands ``period`` places before: start of the repetition, end, period."""
    codes = np.array([ord(c) for c in value])
    for period in range(1, min(PERIODS, len(codes) - 1) + 1):
        same = np.concatenate([[False], codes[period:] == codes[:-period], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= max(2, period):
                yield int(a) + period, int(b) + period, period


def _dates(value: str) -> Iterator[tuple[int, int, float]]:
    for found in DATE.finditer(value):
        year, sign, month, _, day, other, _, late = found.groups()
        if day:
            length = len(day) * 2 + 2 * len(other) + len(late)
            yield found.start(), found.start() + length, math.log10(365 * YEARS) + (math.log10(4) if other else 0) + math.log10(2)
        elif year:
            yield found.start(), found.start() + 4, math.log10(YEARS)
            if month:
                yield found.start(), found.start() + 8 + 2 * len(sign), math.log10(365 * YEARS) + (math.log10(4) if sign else 0)


def known_spans(value: str, costs: Mapping[str, float]) -> Iterator[tuple[int, int, float, str]]:
    """(start, end, log10 of guesses, kind) of all that is not brute force.

    A repeat continues the unit before it, and costs its number of places and the unit's length alone. Replaced and capital letters cost a
    choice: one for usual capitals, else one for each letter changed, among those of the word.
    """
    text = plainer(value)
    for run in re.finditer(r"[^\W\d_]+", text) if costs else ():
        a, b = run.span()
        for i in range(a, b - LETTERS[0] + 1):
            for j in range(i + LETTERS[0], min(b, i + LETTERS[1]) + 1):
                if (cost := costs.get(text[i:j])) is not None:
                    own, plain = value[i:j], text[i:j]
                    if own != plain:
                        usual = own.lower() == plain and (own.isupper() or own[1:].islower())
                        cost += math.log10(2) if usual else math.log10(2) * sum(map(str.__ne__, own, plain)) + math.log10(j - i)
                    yield i, j, cost, "word"
    yield from ((i, j, cost, "walk") for i, j, cost in _walks(value))
    yield from ((i, j, cost, "date") for i, j, cost in _dates(value))
    yield from ((i, j, math.log10(j - i) + math.log10(period + 1), "repeat") for i, j, period in _repeats(value))


def segments(value: str, costs: Mapping[str, float]) -> tuple[float, list[tuple[int, int, str]]]:
    """log10 of the fewest guesses for a value, and its spans (start, end, kind). ``costs`` has log10 of guesses for words.

    A span costs its own guesses and the choice of its kind; consecutive brute-forced characters are one span.
    """
    n, choice, each = len(value), math.log10(KINDS_OF_SPAN), _alphabet(value) if value else 0.0
    ends = [[] for _ in range(n + 1)]
    for i, j, cost, kind in known_spans(value, costs):
        ends[j].append((i, cost, kind))
    # Fewest guesses up to each place: ending in a known span, or in a brute-forced one; and where that span starts.
    known, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
    known_from, brute_from = [(0, "")] * (n + 1), [0] * (n + 1)
    for j in range(1, n + 1):
        opened = known[j - 1] + choice
        brute[j], brute_from[j] = (opened + each, j - 1) if opened <= brute[j - 1] else (brute[j - 1] + each, brute_from[j - 1])
        for i, cost, kind in ends[j]:
            total = min(known[i], brute[i]) + cost + choice
            if total < known[j]:
                known[j], known_from[j] = total, (i, kind)
    spans, j, after_brute = [], n, False
    while j:
        by_brute = brute[j] < known[j] and not after_brute  # what a brute-forced span follows is a known one
        i, kind = (brute_from[j], "brute") if by_brute else known_from[j]
        spans.append((i, j, kind))
        j, after_brute = i, by_brute
    return min(known[n], brute[n]), spans[::-1]


SPAN = "struct<kind:string,start:int,end:int>"
VALUE = "struct<start:int,end:int,value:string>"


def _assignments(text: str) -> list[re.Match]:
    lower = text.lower()
    return [m for m in ASSIGN.finditer(text) if len(m[2]) >= VALUE_CHARS] if any(sign in lower for sign in ASSIGN_SIGNS) else []


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed forms, by start and then by kind."""
    found = [(m.start(), 0, m.end()) for m in _assignments(text)]
    found += [(m.start(), k, m.end()) for k, pattern in ((1, ACCESS), (2, HEX)) for m in pattern.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def credential_values(text: str) -> list[tuple[int, int, str]]:
    """(start, end, value) of what stands in a credential's place, each place once."""
    lower = text.lower()
    if not any(sign in lower for sign in SIGNS):
        return []
    found = {m.span(1) for pattern in (CONTEXT, HEADER, ADDRESS) for m in pattern.finditer(text)} | {m.span(2) for m in _assignments(text)}
    return [(a, b, text[a:b]) for a, b in sorted(found)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span, value = (pa.list_(pa.struct([(n, pa.string() if n in ("kind", "value") else pa.int32()) for n in names])) for names in (("kind", "start", "end"), ("start", "end", "value")))
    for batch in batches:
        base, values, digests, counts = [], [], [], [[], [], []]
        for text in batch.column("text").to_pylist():
            own = base_spans(text or "")
            base.append([dict(zip(("kind", "start", "end"), s)) for s in own])
            values.append([dict(zip(("start", "end", "value"), v)) for v in credential_values(text or "")])
            digests.append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in own).encode()).hexdigest())
            for kind, count in zip(KINDS, counts):
                count.append(sum(k == kind for k, _, _ in own))
        arrays = [batch.column("doc_id"), batch.column("row"), pa.array(base, span), pa.array(values, value), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "row", "base", "values", "n_assign", "n_access", "n_hex", "base_sha256"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column("value").to_pylist():
            words = sorted(set(possible_words(value)))
            for at in range(0, len(words), 100_000):
                part = words[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array([value] * len(part)), pa.array(part)], names=["value", "word"])


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs = [segments(v, {p["word"]: p["cost"] for p in words or []})[0] for v, words in zip(batch.column("value").to_pylist(), batch.column("words").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(costs, pa.float64())], names=["value", "guesses"])


def words_of(text: Column) -> Column:
    """Words as the costs count them: runs of letters in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"(\p{{L}}{{{LETTERS[0]},}})"))


def word_costs(texts: DataFrame) -> DataFrame:
    """word and cost, of every word that a value could hold: log10 of all words over the word's number elsewhere.

    One occurrence is left out, as it may be the credential's own: what stands nowhere else is no word.
    """
    counts = texts.select(F.explode(words_of(F.col("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "words")
    all_words = counts.agg(F.sum("n")).scalar()
    return counts.where((F.length("word") <= LETTERS[1]) & (F.col("n") > 1)).select("word", F.log10(all_words / (F.col("n") - 1)).alias("cost"))


def value_guesses(values: DataFrame, costs: DataFrame) -> DataFrame:
    """value and guesses (log10) of each distinct value."""
    distinct = values.select("value").distinct()
    pieces = distinct.mapInArrow(_pieces, "value string, word string")
    words = pieces.join(costs, "word").groupBy("value").agg(F.collect_list(F.struct("word", "cost")).alias("words"))
    return distinct.join(words, "value", "left").mapInArrow(_score, "value string, guesses double")


def secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind, start, end), values (start, end, guesses) of every row.

    ``spans`` has the fixed forms and, as kind ``guess``, each value of a credential that takes more than ``10**threshold`` guesses; by start,
    then kind. ``values`` has all values looked at. A null text is empty, without spans; an empty table gives no row. Null and
    repeated ids, and repeated rows, are rows of their own. Other columns take no part. Places count code points of the whole text.
    The runs of letters of one value meet in one task: about 22 strings a letter.
    """
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = stored(rows.mapInArrow(_scan, f"doc_id {kind}, row long, base array<{SPAN}>, values array<{VALUE}>, n_assign long, n_access long, n_hex long, base_sha256 string"), "scanned")
    places = found.select("row", F.inline("values"))
    guesses = stored(value_guesses(places, word_costs(docs.select("text"))), "guesses")
    judged = places.join(guesses, "value").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "guesses"))).alias("judged"))
    whole = found.select("doc_id", "row", "base", "n_assign", "n_access", "n_hex", "base_sha256").join(judged, "row", "left")
    none = F.array().cast("array<struct<start:int,end:int,guesses:double>>")
    values = F.coalesce("judged", none)
    hard = F.transform(F.filter(values, lambda v: v["guesses"] > threshold), lambda v: F.struct(v["start"].alias("start"), F.lit(KINDS.index("guess")).alias("at"), v["end"].alias("end"), F.lit("guess").alias("kind")))
    order = F.create_map(*(F.lit(x) for k in enumerate(KINDS) for x in k[::-1]))
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("at"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.transform(F.array_sort(F.concat(base, hard)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return whole.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans.alias("spans"), values.alias("values"))


def joined(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

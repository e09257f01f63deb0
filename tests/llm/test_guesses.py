"""Guess costs against all segmentations, secrets against plain patterns, and rows that break careless code."""

import hashlib
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from marketflow.llm import common, guesses, queries

SF_DIR = "/root/testdata/sf0.01"
COSTS = {"password": 2.0, "pass": 2.5, "word": 2.2, "dragon": 3.0, "the": 1.0, "he": 1.5, "one": 2.0, "qwe": 3.0}
HARD = "x9Qv7LtZ2mWp"
SCHEMA = "doc_id long, text string, row long, value string, spans string, kind string, base string, values string, start int"


def fewest(value, costs):
    """Over every way to cut the value into known spans and brute-forced ones."""
    spans, each, choice = list(guesses.known_spans(value, costs)), guesses._alphabet(value), math.log10(5)

    def rest(i, after_brute):
        if i == len(value):
            return 0.0
        ways = [cost + choice + rest(b, False) for a, b, cost, _ in spans if a == i]
        if not after_brute:
            ways += [(j - i) * each + choice + rest(j, True) for j in range(i + 1, len(value) + 1)]
        return min(ways, default=math.inf)

    return rest(0, False)


def test_segments_are_the_cheapest_of_all():
    draw = random.Random(1)
    parts = ["password", "Pa$$word", "the", "qwe", "zxc", "2019", "19-05-99", "aaa", "ab", "abab", "x", "9", "é", "7K", "123"]
    for _ in range(300):
        value = "".join(draw.choices(parts, k=draw.randrange(1, 4)))[:14]
        cost, spans = guesses.segments(value, COSTS)
        assert math.isclose(cost, fewest(value, COSTS), rel_tol=1e-12)
        assert "".join(value[a:b] for a, b, _ in spans) == value and all(b == c for (_, b, _), (c, _, _) in zip(spans, spans[1:]))
        assert not any(x[2] == y[2] == "brute" for x, y in zip(spans, spans[1:]))
    assert guesses.segments("", COSTS) == (0.0, [])


@pytest.mark.parametrize("value, kinds", [
    ("password", ["word"]), ("P@ssw0rd", ["word"]), ("qwertyuiop", ["walk"]), ("zaq12wsx", ["walk"]), ("2024-01-31", ["date"]), ("31.12.1999", ["date"]),
    ("aaaaaaaaaaaa", ["brute", "repeat"]), ("thethethethe", ["word", "repeat"]), ("dragon2001", ["word", "date"]), (HARD, ["brute"])])
def test_kinds_of_spans(value, kinds):
    cost, spans = guesses.segments(value, COSTS)
    assert [k for _, _, k in spans] == kinds and (cost > guesses.THRESHOLD) == (value == HARD)


def test_neighbouring_keys():
    ends = lambda value: [(a, b) for a, b, _ in guesses._walks(value)]
    assert ends("asdf") == [(0, 4)] and ends("qaz") == [(0, 3)] and ends("esz") == [(0, 3)] and ends("adg") == [] and ends("aas") == [] and ends("QWER1") == [(0, 4)]


def plain_base(text):
    """The contract's patterns as they are written."""
    text, out = text or "", []
    letters = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    names = "|".join(letters(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    patterns = ((0, rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6), (1, "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), (2, "[0-9a-f]+", lambda m: len(m[0]) >= 24))
    for kind, pattern, fits in patterns:
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if fits(m)]
    return [(guesses.KINDS[k], a, b) for a, k, b in sorted(out)]


def test_base_spans_are_those_of_the_patterns():
    draw = random.Random(2)
    parts = ["token", "Api_Key", "apikey", "passwd", "PASSWORD", "secret", "=", ":", " ", "  ", '"', "'", "abc", "AKIA", "AKIAA", "Z" * 15, "0" * 9, "deadbeef", "é", "\n", "ſecret", "toKen", "/", "x9"]
    for _ in range(4000):
        text = "".join(draw.choices(parts, k=draw.randrange(12)))
        assert guesses.base_spans(text) == plain_base(text)


def test_places_of_credentials():
    found = lambda text: [v for _, _, v in guesses.credential_values(text)]
    assert found("DB_PASSWORD_PROD = s3cr3t!x") == ["s3cr3t!x"] and found("pwd:=`no`") == [] and found("encryption-key => 'abcdef'") == ["abcdef"]
    assert found("Authorization: Bearer abc.def-ghi") == ["abc.def-ghi"] and found("amqp://user:pa55word@host/x") == ["pa55word"]
    assert found("the compass: northern") == [] and found("a bearer of documents, the key to it") == [] and found("My PassWord : «é»längeres") == ["«é»längeres"]


def test_long_texts_take_linear_time():
    started = time.perf_counter()
    for text in ("a." * 100_000, "token." * 40_000, "pass_" * 50_000, "://a:" * 50_000, "password=" + "x" * 200_000, "password=" * 30_000, "0" * 23 + " " * 10 + "f" * 300_000):
        guesses.base_spans(text), guesses.credential_values(text)
    guesses.segments("ab1" * 30_000, COSTS)
    assert time.perf_counter() - started < 30


def test_secrets_on_odd_rows(spark):
    easy = "pwd: welcome words welcome words"
    texts = [None, "", easy, f"pwd: {HARD}", f"é token = '{HARD}' and hex {'0a' * 12}", "AKIA" + "B" * 16, "w " * 100_000 + f"secret={HARD}", f"pass: {HARD} pass: {HARD}"]
    rows = [(i, t, 1, "v", "s", "k", "b", "x", 3) for i, t in enumerate(texts)] + [(3, texts[3], 1, "v", "s", "k", "b", "x", 3), (None, texts[5], None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = guesses.secrets(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        text = texts[5 if r.doc_id is None else r.doc_id] or ""
        base = plain_base(text)
        values = [(m.start(), m.end()) for m in re.finditer(HARD, text)]
        wanted = sorted([(a, guesses.KINDS.index(k), b) for k, a, b in base] + [(a, 3, b) for a, b in values])
        assert [tuple(s) for s in r.spans] == [(guesses.KINDS[k], a, b) for a, k, b in wanted]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, _, _ in base) for kind in guesses.KINDS[:3])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
    assert [len(r.values) for r in found if r.doc_id == 2] == [1]
    assert guesses.secrets(docs.limit(0)).count() == 0


def test_a_word_must_stand_elsewhere(spark):
    """The credential itself does not make its value a word; the same letters in other texts do."""
    one, two = "qvxjwkzhpfbmtc", "rlnghdqvxjwkz"
    rows = [(0, f"password: {one}"), (1, f"password: {two}")] + [(2 + i, f"some words and {two} again") for i in range(50)]
    found = {r.doc_id: r.spans for r in guesses.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [s.kind for s in found[0]] == ["assign", "guess"] and [s.kind for s in found[1]] == ["assign"]
    costs = {r.word: r.cost for r in guesses.word_costs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert one not in costs and math.isclose(costs[two], math.log10((4 + 50 * 5) / 50)) and math.isclose(costs["password"], math.log10(254))


def test_query_against_plain_code(spark):
    docs = common.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    words, counts = re.compile(r"[^\W\d_]{3,}"), {}
    for d in docs:
        for w in words.findall(d.text.lower()):
            counts[w] = counts.get(w, 0) + 1
    costs = {w: math.log10(sum(counts.values()) / (n - 1)) for w, n in counts.items() if 1 < n and len(w) <= 24}
    wanted = {}
    for d in docs:
        spans = [(a, guesses.KINDS.index(k), b) for k, a, b in plain_base(d.text)]
        spans += [(a, 3, b) for a, b, v in guesses.credential_values(d.text) if guesses.segments(v, costs)[0] > guesses.THRESHOLD]
        wanted[d.doc_id] = ",".join(f"{guesses.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
    found = queries.op11_guess_cost(spark, SF_DIR)
    assert found.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert {r.doc_id: r.spans for r in found.collect()} == wanted and any("guess" in s for s in wanted.values())

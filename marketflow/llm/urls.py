"""URL verdicts by rules, and by the words of the host where no rule fits.

A unigram model of words, counted over the pages' texts, splits the joined names of a host into words by Viterbi. A multinomial naive
Bayes model over the words of host and path says block or allow. It learns from all pages: a page whose words hold one of a given
list of seed words counts as block, the others as allow, so that words that go with the seeds count too.

All words and tokens count. The most frequent ones are known to every task, the rest are joined to the hosts and paths that have them.
"""

from __future__ import annotations

import math
import re
from collections import ChainMap
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import prepare, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Words that mark a host as unwanted, and others that may be part of its name.
SEEDS = ("ads", "adult", "bet", "bets", "betting", "casino", "gambling", "malware", "phishing", "pill", "pills", "poker", "porn", "sex", "spam", "viagra", "xxx")
PLAIN = ("blog", "cheap", "farm", "free", "news", "online", "shop", "store", "track", "web", "win")
LEXICON, FEATURES = 50_000, 100_000  # words and tokens that every task knows, the most frequent ones; others are joined
LONGEST = 24  # letters of a word


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == of) | host_.endswith("." + of)) & path_.startswith(start)
        name, verdict = F.when(fits, of + start).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


class Segmenter:
    """Splits a name into the most likely words."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        self.total = (sum(counts.values()) if total is None else total) + 1
        self.logs = {w: math.log(n / self.total) for w, n in counts.items()}
        self.unknown = -math.log(10 * self.total)
        self.split = lru_cache(50_000)(self._split)

    def with_rare(self, rare: dict[str, int]) -> Segmenter:
        """The same with further words."""
        if not rare:
            return self
        more = Segmenter({}, self.total - 1)
        more.logs = ChainMap({w: math.log(n / self.total) for w, n in rare.items()}, self.logs)
        return more

    def cost(self, word: str) -> float:
        """Log-probability; an unknown word is dearer by every letter."""
        return self.logs.get(word, self.unknown - 2.5 * len(word))

    def _split(self, name: str) -> tuple[str, ...]:
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            value, start = max((best[s] + self.cost(name[s:end]), s) for s in range(max(0, end - LONGEST), end))
            best.append(value)
            back.append(start)
        words, end = [], len(name)
        while end:
            words.append(name[back[end] : end])
            end = back[end]
        return tuple(words[::-1])


LETTERS = re.compile(r"[^\W\d_]+")  # of any script


def _names(host_: str, path_: str) -> tuple[list[str], list[str]]:
    return LETTERS.findall(host_.lower()), LETTERS.findall(path_.lower())


def tokens(segmenter: Segmenter, host_: str, path_: str) -> list[str]:
    """Words of all labels of the host, its last label once more as a token of its own kind, and the words of the path with a mark."""
    of_host, of_path = _names(host_, path_)
    last = host_.lower().rpartition(".")
    top = ["." + last[2]] if last[1] and last[2] else []
    return [w for name in of_host for w in segmenter.split(name)] + top + ["/" + w for name in of_path for w in segmenter.split(name)]


def _cut(counted: DataFrame, key: str, n: Column, most: int) -> tuple[list, DataFrame | None]:
    """The rows of the ``most`` frequent keys, and the others; None if there are none."""
    head = counted.withColumn("_n", n).orderBy(F.desc("_n"), key).limit(most + 1).collect()
    if len(head) <= most:
        return head, None
    first = head[most]
    return head[:most], counted.where((n < first["_n"]) | ((n == first["_n"]) & (F.col(key) >= first[key])))


def lexicon(pages: DataFrame, most: int = LEXICON) -> tuple[dict[str, int], int, DataFrame | None]:
    """The words of all pages' texts with their counts, the ``most`` frequent, and the seeds; the sum of all; (word, n) of the other words."""
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), "(?s)<[^>]*>", " "))
    words = pages.select(F.explode(F.regexp_extract_all(text, F.lit(r"\p{L}+"), 0)).alias("word")).where(F.length("word").between(2, LONGEST))
    counted = stored(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")
    head, rest = _cut(counted, "word", F.col("n"), most)
    given = [*SEEDS, *PLAIN]
    own = {r["word"]: r["n"] for r in counted.where(F.col("word").isin(given)).collect()}
    total = counted.agg(F.sum("n")).first()[0] or 0
    seed = max(10, total // 10_000)
    raised = {w: max(seed, own.get(w, 0)) for w in given}
    return {r["word"]: r["n"] for r in head} | raised, total + sum(n - own.get(w, 0) for w, n in raised.items()), rest and rest.where(~F.col("word").isin(given))


def with_rare(keys: DataFrame, counts: dict[str, int], rest: DataFrame | None) -> DataFrame:
    """``keys`` (host, path) with rare: the words of ``rest`` that are in their names."""
    if rest is None:
        return keys.withColumn("rare", F.lit(None).cast("map<string, bigint>"))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, p in zip(*(c.to_pylist() for c in batch.columns)):
                of_host, of_path = _names(h, p)
                found = {name[a:b] for name in (*of_host, *of_path) for a in range(len(name)) for b in range(a + 2, min(len(name), a + LONGEST) + 1)}
                found = [w for w in found if w not in counts]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([h] * len(found)), pa.array([p] * len(found)), pa.array(found)], ["host", "path", "word"])

    had = keys.select("host", "path").mapInArrow(parts, "host string, path string, word string").join(rest, "word")
    return keys.join(had.groupBy("host", "path").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("rare")), ["host", "path"], "left")


def labelled(keys: DataFrame, counts: dict[str, int], total: int, seeds=SEEDS) -> DataFrame:
    """host, path, n, tokens and label (1: a token is a seed word) of ``keys`` (host, path, n, rare)."""
    unwanted = frozenset(seeds)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(counts, total)
        for batch in batches:
            hosts, paths, _, rare = (c.to_pylist() for c in batch.columns)
            found = [tokens(segmenter.with_rare(dict(r or ())), h, p) for h, p, r in zip(hosts, paths, rare)]
            labels = [int(not unwanted.isdisjoint(w.lstrip("/.") for w in own)) for own in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.list_(pa.string())), pa.array(labels, pa.int32())], ["host", "path", "n", "tokens", "label"])

    return keys.select("host", "path", "n", "rare").mapInArrow(read, "host string, path string, n long, tokens array<string>, label int")


def scored(keys: DataFrame, seeds=SEEDS, most: int = FEATURES) -> DataFrame:
    """host, path and block_odds, the log-odds of block by all tokens, of ``labelled`` keys."""
    sums = [F.coalesce(F.sum(F.when(F.col("label") == k, F.col("n"))), F.lit(0)).alias(name) for k, name in ((1, "block"), (0, "allow"))]
    none = keys.agg(*sums).first()
    spread = keys.select("host", "path", "n", "label", F.explode("tokens").alias("token"))
    lone = keys.sparkSession.createDataFrame([(w,) for w in seeds], "token string")
    both = spread.groupBy("token").agg(*sums)
    unseen = lone.join(both, "token", "left_anti").select("token", F.lit(1).cast("long").alias("block"), F.lit(0).cast("long").alias("allow"))
    both = stored(both.unionByName(unseen), "features")  # a seed that no page has still counts
    all_block, all_allow = both.agg(F.sum("block") + F.count(F.lit(1)), F.sum("allow") + F.count(F.lit(1))).first()
    head, rest = _cut(both, "token", F.col("block") + F.col("allow"), most)
    prior = math.log(none["block"] + 1) - math.log(none["allow"] + 1)
    odds = {r["token"]: math.log((r["block"] + 1) / all_block) - math.log((r["allow"] + 1) / all_allow) for r in head}

    @F.arrow_udf("double")
    def of_head(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield pa.array([prior + sum(odds.get(t, 0.0) for t in own) for own in lists.to_pylist()], pa.float64())

    each = keys.select("host", "path", of_head("tokens").alias("block_odds"))
    if rest is None:
        return each
    odd = F.log((F.col("block") + 1) / F.lit(float(all_block))) - F.log((F.col("allow") + 1) / F.lit(float(all_allow)))
    # Exact sums: their order does not matter.
    of_rest = spread.join(rest.select("token", odd.cast("decimal(28,15)").alias("odd")), "token").groupBy("host", "path").agg(F.sum("odd").cast("double").alias("more"))
    return each.join(of_rest, ["host", "path"], "left").select("host", "path", (F.col("block_odds") + F.coalesce("more", F.lit(0.0))).alias("block_odds"))


def judged(pages: DataFrame, rules=RULES, words: int = LEXICON, features: int = FEATURES) -> DataFrame:
    """page_id, host, path, rule, verdict and block_odds (the model's log-odds) of every row.

    ``pages`` has page_id, url and html. A null url, or one without ``://``, has empty host and path; a page without any
    token is judged by the share of block alone. Repeated rows are judged each; other columns are left out. ``words`` and ``features`` say
    how many words and tokens every task knows; they do not change the result.
    """
    prepare(pages.sparkSession)
    plain = F.regexp_replace("path", "[0-9]+", "0")
    parsed = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    counts, total, rest = lexicon(pages, words)
    # Equal hosts and paths are counted before they are read.
    keys = stored(parsed.groupBy("host", plain.alias("path")).agg(F.count(F.lit(1)).alias("n")), "keys")
    known = scored(stored(labelled(with_rare(keys, counts, rest), counts, total), "tokens"), most=features)
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    by_model = F.when(F.col("block_odds") > 0, "block").otherwise("allow")
    judged_ = parsed.withColumn("_path", plain).join(known.withColumnRenamed("path", "_path"), ["host", "_path"])
    return judged_.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "block_odds")

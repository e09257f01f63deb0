"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded sample of labelled texts: one on ordinary words, one on the byte spans
that the words of toxic texts have and ordinary words lack. A text is read in windows (a word with its delimiters, long words in
overlapping pieces); a window compresses shorter under the dictionary it resembles. How much shorter is a small whole
number, whose log-likelihood ratio is calibrated on the sample; a text's score is a logistic function of the mean over its
windows and of their sum.

Each byte of a window is widened to two before compression: a window is only a few bytes long, and a sequence costs
about four, so that without it short matches would not pay and both lengths would be equal.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import give_back, remainder, split_words, sums

WINDOW, OVERLAP = 64, 8  # bytes of a window and of what neighbours share
FEW = 20  # rows of each label that are taken at any length
CLIP = 40  # differences of length beyond this count as this
GRAMS = (4, 5, 6, 7, 8)  # lengths of the spans tried for the toxic dictionary
# A fixed pseudo-random second byte for every byte.
WIDE = np.stack([np.arange(256), (np.arange(256) * 167 + 91) % 256 ^ 0x5A], axis=1).astype(np.uint8)


@dataclass(frozen=True)
class Model:
    """Two dictionaries, the log-likelihood ratio of each difference of lengths, and the logistic function."""

    toxic: bytes
    ordinary: bytes
    ratios: tuple[float, ...]
    weights: tuple[float, float, float]


def windows(word: bytes) -> list[bytes]:
    """The word, or its overlapping pieces where it is longer than a window."""
    if len(word) <= WINDOW:
        return [word]
    return [word[i : i + WINDOW] for i in range(0, len(word) - OVERLAP, WINDOW - OVERLAP)]


def _wide(part: bytes) -> bytes:
    return WIDE[np.frombuffer(part, np.uint8)].tobytes()


class Distance:
    """By how many bytes a window is shorter under the toxic than under the ordinary dictionary."""

    KEPT = 400_000  # windows remembered by a worker

    def __init__(self, toxic: bytes, ordinary: bytes):
        setting = zstandard.ZstdCompressionParameters(
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, window_log=12, hash_log=10, chain_log=10, search_log=4, min_match=5,
            target_length=32, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.sides = []
        for content in (ordinary, toxic):
            side = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            side.precompute_compress(compression_params=setting)
            self.sides.append(zstandard.ZstdCompressor(dict_data=side, compression_params=setting).compress)
        self.known: dict[bytes, int] = {}

    def of(self, word: str) -> int:
        """The largest difference of the word's windows."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.KEPT:
                self.known.clear()
            ordinary, toxic = self.sides
            wides = [_wide(b" " + part + b" ") for part in windows(word.encode())]
            found = self.known[word] = min(CLIP, max(-CLIP, max(len(ordinary(w)) - len(toxic(w)) for w in wides)))
        return found

    def features(self, texts: pa.Array, ratios: np.ndarray) -> np.ndarray:
        """Per text the mean and the sum of its words' log-likelihood ratios."""
        index, distinct, offsets = split_words(texts)
        per_word = np.array([ratios[self.of(w) + CLIP] if w else 0.0 for w in distinct] or [0.0])
        total, n = sums(per_word[index], offsets), np.diff(offsets)
        return np.column_stack([100 * total / (20 + n), np.clip(total, -30, 30) / 3])


def _spans(words: Counter, plain: Counter, n_toxic: int, n_ordinary: int, least: float) -> list[bytes]:
    """Byte spans that cover most words of toxic texts and hardly occur in ordinary ones, chosen greedily.

    ``words`` and ``plain`` count the texts of either kind that have a word.
    """
    least = max(3, least * n_toxic)

    def grams(word: str) -> set[bytes]:
        word = b" " + word.encode() + b" "
        return {word[i : i + n] for n in GRAMS for i in range(len(word) - n + 1)}

    count: Counter = Counter()
    for word, n in words.items():
        for gram in grams(word):
            count[gram] += n
    count = {gram: n for gram, n in count.items() if n >= least}
    other: Counter = Counter()
    for word, n in plain.items():
        for gram in grams(word):
            if gram in count:
                other[gram] += n
    pure = {g for g, n in count.items() if other[g] * n_toxic <= 0.03 * n * n_ordinary}
    having = defaultdict(list)
    for word in words:
        for gram in grams(word) & pure:
            having[gram].append(word)
    live, chosen = dict(words), []
    heap = [(-count[g], len(g), g) for g in having]
    heapq.heapify(heap)
    while heap:
        bound, _, gram = heapq.heappop(heap)
        now = sum(live.get(w, 0) for w in having[gram])
        if now < least:
            continue
        if now < -bound:
            heapq.heappush(heap, (-now, len(gram), gram))
            continue
        longer = (g for g in having if gram in g and sum(live.get(w, 0) for w in having[g]) >= 0.9 * now)
        chosen.append(max(longer, key=lambda g: (len(g), g)))
        for word in having[gram]:
            live.pop(word, None)
    return chosen


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, d=8, k=32, f=20, steps=1).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:] or bytes(8)


def fit(texts: list[str | None], labels: list[int], share: float | None = None, size: int = 1024, least: float = 0.03) -> Model:
    """Train both dictionaries, the ratios and the logistic function.

    ``share`` is the share of label 1 among all labelled rows (default: in the sample). ``least`` is how often, per toxic text, a
    span must be needed. Repeated texts count once. With a label missing from the sample every score is the share of label 1.
    """
    sides: tuple[dict, dict] = ({}, {})
    for text, label in zip(texts, labels):
        sides[int(label)].setdefault(text or "")
    ordinary, toxic = (pa.array(list(side), pa.string()) for side in sides)
    if share is None:
        share = len(toxic) / max(1, len(toxic) + len(ordinary))
    prior = float(np.log(max(share, 1e-3)) - np.log(max(1 - share, 1e-3)))
    if not len(toxic) or not len(ordinary):
        return Model(bytes(8), bytes(8), (0.0,) * (2 * CLIP + 1), (prior, 0.0, 0.0))
    (in_ordinary, plain, samples), (in_toxic, words, own) = _read(ordinary), _read(toxic)
    spans = _spans(words, plain, len(toxic), len(ordinary), least)
    content = b"".join(map(_wide, spans[::-1])) or _dictionary(own, size)
    trained = _dictionary(samples, size)
    distance = Distance(content, trained)
    seen = []
    for counts in (in_ordinary, in_toxic):
        bins = np.full(2 * CLIP + 1, 0.5)
        for word, n in counts.items():
            bins[distance.of(word) + CLIP] += n
        seen.append(np.log(bins / bins.sum()))
    ratios = seen[1] - seen[0]
    x = np.concatenate([distance.features(side, ratios) for side in (ordinary, toxic)])
    y = np.repeat([0.0, 1.0], [len(ordinary), len(toxic)])
    weight = np.where(y == 1, share / len(toxic), (1 - share) / len(ordinary)) * len(y)
    return Model(content, trained, tuple(ratios.tolist()), _logistic(x, y, weight))


def _read(texts: pa.Array) -> tuple[Counter, Counter, list[bytes]]:
    """How often each word occurs, in how many texts, and widened runs of eight words to train a dictionary on."""
    index, distinct, offsets = split_words(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    often, within = np.bincount(index, minlength=len(distinct)), np.zeros(len(distinct), np.int64)
    if len(index):
        within += np.bincount(np.unique(owner * len(distinct) + index) % len(distinct), minlength=len(distinct))
    names = [distinct[i] for i in index[:320_000]]
    samples = [_wide(" ".join(names[i : i + 8]).encode()) for i in range(0, len(names), 8)]
    return (Counter({w: int(n) for w, n in zip(distinct, often) if n}), Counter({w: int(n) for w, n in zip(distinct, within) if n}), samples)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(3), np.diag([1e-6, 0.05, 0.05])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (weight * (y - p)) - ridge @ w
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge + 1e-9 * np.eye(3), gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def score_texts(model: Model, texts: pa.Array, distance: Distance) -> np.ndarray:
    """Scores of texts, each read whole."""
    bias, *slopes = model.weights
    logit = bias + distance.features(texts, np.array(model.ratios)) @ np.array(slopes)
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int = 2000, max_chars: int = 12_000_000):
    """Texts and labels of at most ``per_label`` whole rows of each label and ``max_chars`` characters each, and the share of 1.

    Rows are taken in the order of a hash of their id; one that does not fit is left out and takes no room. The ``FEW`` shortest of the first
    ``per_label`` rows are taken at any length, so that no label is without rows. Ids with both labels, null ids and null labels are left out.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id")
             .agg(F.min("toxic").alias("_low"), F.max("toxic").alias("_label")).where("_low = _label").select("doc_id", "_label"))
    counts = {row["_label"]: row["count"] for row in known.groupBy("_label").count().collect()}
    sized = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.length("text").alias("_chars")).join(known, "doc_id")
    ids: list[int] = []
    for label in (0, 1):
        first = sized.where(F.col("_label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label).collect()
        always = set(sorted(range(len(first)), key=lambda i: first[i]["_chars"] or 0)[:FEW])
        room = max_chars - sum(first[i]["_chars"] or 0 for i in always)
        for i, row in enumerate(first):
            chars = row["_chars"] or 0
            if i in always or chars <= room:
                ids.append(row["doc_id"])
                room -= 0 if i in always else chars
    if not ids:
        return [], [], 0.0
    rows = docs.where(F.col("doc_id").isin(ids)).select("doc_id", "text").join(known, "doc_id").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    return [r["text"] for r in rows], [r["_label"] for r in rows], counts.get(1, 0) / max(1, sum(counts.values()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) from the whole ``text``.

    A null or empty text has no window and gets the logistic function's constant; columns of these names are replaced. Rows,
    repeated ones too, stay as they are; an empty table gives an empty result.
    """

    @F.arrow_udf("double")
    def value(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        distance = Distance(model.toxic, model.ordinary)
        for texts in batches:
            yield pa.array(score_texts(model, texts, distance))

    return docs.withColumn("score", value(F.col("text"))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, **bounds) -> Model:
    """A model from labelled rows whose crc32 remainder by ``folds`` is not 0."""
    learn = docs.where(remainder(F.col("doc_id"), folds) != 0)
    model = fit(*labelled_sample(learn, labels.where(remainder(F.col("doc_id"), folds) != 0), **bounds))
    give_back()  # the sample
    return model

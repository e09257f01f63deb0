"""Language-model scores by a hashed maximum-entropy model.

P(word | two words before) = P(class | context) * P(word | class). A frequent word is a class of its own, the others share classes by
a hash of their ending. The class model is log-linear over hashed features of the context: the class before (bigram), the
one before that (skip), both (trigram, hashed to a bounded table) and none (bias). Within a shared class, its frequent words and one slot for
the others are log-linear too, over the class before (bigram) and the one before that (skip). The words of that slot have their
smoothed relative frequency, with one unknown word per class, so that the probabilities of a context sum to 1.

Training reads every training text: words are counted, then contexts; the table of contexts, whose size is bounded by the number of classes, is
dealt to tasks. In each epoch all tasks find the gradient of their contexts under the broadcast weights at once; a shuffle adds the gradients
up by feature. Scoring looks up frequent words in a bounded broadcast table; the others are joined with the counts, a row per text and word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import prepare, shuffle_parts, split_words, stored, sums

END = "\n"  # the end of a text, which no word can be
OWN, ENDINGS = 96, 64  # classes of frequent words, and of endings
CLASSES = 1 + OWN + ENDINGS  # class 0 is the end
START = CLASSES  # what stands before the first word
TABLE = 1 << 14  # rows of the trigram features
HEAD = 1 << 16  # words in the broadcast table at most
WORDS = 1024  # words with features of their own within the shared classes
TASKS = 16  # of the table of contexts
EPOCHS = 10
SMOOTH = 0.1


def ending_class(word: str) -> int:
    return 1 + OWN + zlib.crc32(word[-2:].encode()) % ENDINGS


def class_of(word: str, own: dict[str, int]) -> int:
    return own[word] if word in own else ending_class(word)


def features(context: np.ndarray) -> np.ndarray:
    """Rows of the weights that are active in each context (class before times CLASSES + 1, plus the one before)."""
    before, last = np.divmod(context, CLASSES + 1)
    mixed = (context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)
    one = CLASSES + 1
    return np.column_stack([np.zeros_like(context), 1 + last, 1 + one + before, 1 + 2 * one + mixed.astype(np.int64) % TABLE])


FEATURES = 1 + 2 * (CLASSES + 1) + TABLE


def log_probabilities(weights: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Natural logarithms, a row per context."""
    logits = weights[features(context)].sum(1)
    logits -= logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


@dataclass(frozen=True)
class Inner:
    """Words within the shared classes: slots in a row, class by class, the last of a class for its other words."""

    slots: dict[str, int]
    starts: np.ndarray  # first slot of every shared class
    bias: np.ndarray  # logarithms of smoothed counts
    rest: np.ndarray  # smoothed count of the other words of every shared class, an unknown one included
    last: np.ndarray  # weights by class before and slot
    before: np.ndarray  # by the class before that

    def slots_of(self, words: list[str], classes: list[int]) -> np.ndarray:
        """The words' slots; -1 for a word that is its class."""
        others = (np.append(self.starts[1:], len(self.bias)) - 1).tolist()
        return np.array([-1 if c <= OWN else self.slots.get(w, others[c - 1 - OWN]) for w, c in zip(words, classes)], np.int64)

    def logits(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every slot in every context, and the logarithm of the sum over each shared class."""
        before, last = np.divmod(context, CLASSES + 1)
        logits = self.bias + self.last[last] + self.before[before]
        return logits, np.log(np.add.reduceat(np.exp(logits), self.starts, axis=1))


@dataclass(frozen=True)
class Model:
    """Weights of the class model, frequent words with their counts, and the sizes that counts are smoothed with."""

    weights: np.ndarray
    own: dict[str, int]
    head: dict[str, int]
    class_tokens: np.ndarray
    class_words: np.ndarray
    inner: Inner
    n: int
    v: int


def _sequences(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Words and an end per text: word numbers, distinct words, offsets."""
    index, distinct, offsets = split_words(texts)
    ends = offsets[1:] + np.arange(len(texts))
    out = np.full(len(index) + len(texts), len(distinct))
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = index
    return out, [*distinct, END], np.concatenate([[0], ends + 1])


def _contexts(classes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    last, before = np.full(len(classes), START), np.full(len(classes), START)
    last[1:], before[2:] = classes[:-1], classes[:-2]
    first = offsets[:-1][np.diff(offsets) > 0]
    last[first] = before[first] = START
    second = first + 1
    second = second[second < len(classes)]
    before[second] = START
    return before * (CLASSES + 1) + last


def word_counts(docs: DataFrame) -> DataFrame:
    """(token, n) over all texts, the end included; counted in every task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["token", "n"])

        for batch in batches:
            index, distinct, _ = _sequences(batch.column(0))
            for word, n in zip(distinct, np.bincount(index, minlength=len(distinct)).tolist()):
                if n:
                    held[word] = held.get(word, 0) + n
            if len(held) > 300_000:
                yield out()
                held = {}
        if held:
            yield out()

    return docs.select("text").mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def context_counts(docs: DataFrame, own: dict[str, int], inner: Inner) -> DataFrame:
    """(key, n) over all texts. The key is context * CLASSES + class, or below 0 a feature of a slot: -1 - ((1 or 0: skip or bigram) * (CLASSES + 1)
    + class before) * slots - slot."""
    slots = len(inner.bias)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, numbers, size = [], [], 0
        pairs = np.zeros(2 * (CLASSES + 1) * slots, np.int64)

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key, spot = np.unique(np.concatenate(keys), return_inverse=True)
            return key, np.bincount(spot, np.concatenate(numbers)).astype(np.int64)

        for batch in batches:
            index, distinct, offsets = _sequences(batch.column(0))
            if not len(index):
                continue
            of_words = [class_of(w, own) if w != END else 0 for w in distinct]
            classes, slot = np.array(of_words)[index], inner.slots_of(distinct, of_words)[index]
            contexts = _contexts(classes, offsets)
            key, n = np.unique(contexts * CLASSES + classes, return_counts=True)
            shared = slot >= 0
            skip, bigram = np.divmod(contexts[shared], CLASSES + 1)
            for feature in (bigram, skip + CLASSES + 1):
                pairs += np.bincount(feature * slots + slot[shared], minlength=len(pairs))
            keys.append(key)
            numbers.append(n)
            size += len(key)
            if size > 4_000_000:
                key, n = merged()
                keys, numbers, size = [key], [n], len(key) // 2
        if keys:
            key, n = merged()
            seen = np.flatnonzero(pairs)
            key, n = np.concatenate([-1 - seen, key]), np.concatenate([pairs[seen], n])
            for i in range(0, len(key), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(key[i : i + (1 << 16)]), pa.array(n[i : i + (1 << 16)])], ["key", "n"])

    return docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def feature_sums(cells: DataFrame, weights: np.ndarray | None, inner: Inner) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every feature and class over all contexts (context, class, n), and of every feature and slot, as expected under the weights.

    Without weights: the observed counts of features and classes alone.
    """
    shared = cells.sparkSession.sparkContext.broadcast((weights, inner))
    slots, schema = len(inner.bias), pa.schema([("row", pa.int64()), ("sums", pa.binary())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, words = shared.value
        sums_ = np.zeros((FEATURES, CLASSES))
        of_slots = np.zeros((2 * (CLASSES + 1), slots))
        sizes = np.diff(np.append(words.starts, slots))
        for batch in batches:
            context, cls, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            unique, spot = np.unique(context, return_inverse=True)
            seen = np.zeros((len(unique), CLASSES), np.float64)
            np.add.at(seen, (spot, cls), n)
            active = features(unique)
            counts = seen if w is None else np.exp(log_probabilities(w, unique)) * seen.sum(1, keepdims=True)
            for k in range(active.shape[1]):
                np.add.at(sums_, active[:, k], counts)
            if w is None:
                continue
            for i in range(0, len(unique), 256):
                some = unique[i : i + 256]
                logits, total = words.logits(some)
                expected = np.exp(logits - np.repeat(total, sizes, axis=1)) * np.repeat(seen[i : i + 256, 1 + OWN :], sizes, axis=1)
                skip, bigram = np.divmod(some, CLASSES + 1)
                for feature in (bigram, skip + CLASSES + 1):
                    np.add.at(of_slots, feature, expected)
        for first, values in ((0, sums_), (FEATURES, of_slots)):
            rows = np.flatnonzero(values.any(1))
            for i in range(0, len(rows), 512):
                some = rows[i : i + 512]
                yield pa.RecordBatch.from_arrays([pa.array(first + some), pa.array([values[r].astype(np.float32).tobytes() for r in some], pa.binary())], schema=schema)

    def added(rows: pa.Table) -> pa.Table:
        held: dict[int, np.ndarray] = {}
        for row, data in zip(rows.column("row").to_pylist(), rows.column("sums").to_pylist()):
            held[row] = held[row] + np.frombuffer(data, np.float32) if row in held else np.frombuffer(data, np.float32)
        return pa.table([pa.array(list(held), pa.int64()), pa.array([v.tobytes() for v in held.values()], pa.binary())], schema=schema)

    sums_, of_slots = np.zeros((FEATURES, CLASSES), np.float32), np.zeros((2 * (CLASSES + 1), slots), np.float32)
    found = cells.mapInArrow(part, "row long, sums binary")
    # Every row has a bounded size and comes once from each task.
    for r in found.groupBy((F.col("row") % TASKS).alias("deal")).applyInArrow(added, "row long, sums binary").collect():
        values = np.frombuffer(r["sums"], np.float32)
        if r["row"] < FEATURES:
            sums_[r["row"]] = values
        else:
            of_slots[r["row"] - FEATURES] = values
    shared.destroy()
    return sums_, of_slots


def slotted(head: dict[str, int], own: dict[str, int], tokens: np.ndarray, words: np.ndarray) -> Inner:
    """Slots of the WORDS most frequent words that share a class, without weights. ``tokens`` and ``words`` are counted by class."""
    ranked = sorted((w for w in head if w != END and w not in own), key=lambda w: (-head[w], w))[:WORDS]
    members: list[list[str]] = [[] for _ in range(ENDINGS)]
    for word in ranked:
        members[ending_class(word) - 1 - OWN].append(word)
    starts = np.cumsum([0, *(len(m) + 1 for m in members)])
    slots = {w: int(start) + i for start, m in zip(starts, members) for i, w in enumerate(m)}
    rest = np.array([tokens[c] - sum(head[w] for w in m) + SMOOTH * (words[c] - len(m) + 1) for c, m in enumerate(members, 1 + OWN)])
    bias = np.log(np.concatenate([[*(head[w] + SMOOTH for w in m), left] for m, left in zip(members, rest)]))
    weights = np.zeros((CLASSES + 1, len(bias)), np.float32)
    return Inner(slots, starts[:-1], bias, rest, weights, weights.copy())


def train(docs: DataFrame, epochs: int = EPOCHS) -> tuple[Model, DataFrame]:
    """A model of all texts of ``docs``, and the counts of its words. Without texts every class is equally likely."""
    spark = prepare(docs.sparkSession)
    counts = stored(word_counts(docs), "words")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # The head: all words above a count that leaves no more than HEAD of them.
    cut, room = None, HEAD
    for r in counts.groupBy(F.floor(F.log2("n") * 16).alias("bin")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).orderBy(F.desc("bin")).collect():
        room -= r["words"]
        if room < 0:
            break
        cut = r["least"]
    frequent = [] if cut is None else counts.where(F.col("n") >= cut).collect()
    head = {r["token"]: r["n"] for r in frequent}
    ranked = sorted((w for w in head if w != END), key=lambda w: (-head[w], w))[:OWN]
    own = {w: i + 1 for i, w in enumerate(ranked)}

    @F.arrow_udf("int")
    def class_(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for words in batches:
            yield pa.array([class_of(w, own) if w != END else 0 for w in words.to_pylist()], pa.int32())

    tokens, words = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy(class_("token").alias("class")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        tokens[r["class"]], words[r["class"]] = r["n"], r["words"]
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    weights[0] = np.log((tokens + SMOOTH) / (tokens.sum() + SMOOTH * CLASSES))
    inner = slotted(head, own, tokens, words)
    counted = stored(context_counts(docs, own, inner), "counts")
    # Contexts are dealt by the class that is skipped, so that most features are one task's. There are no more of them than pairs of classes.
    context = F.floor(F.col("key") / CLASSES)
    cells = stored(counted.where("key >= 0").select(context.alias("context"), (F.col("key") % CLASSES).alias("class"), "n")
                   .repartition(TASKS, F.floor(F.col("context") / (CLASSES + 1))).sortWithinPartitions("context"), "contexts")
    # A number for each slot in each class before and each skipped one.
    of_slots = np.zeros(2 * (CLASSES + 1) * len(inner.bias))
    pairs = counted.where("key < 0").toArrow()
    of_slots[-1 - pairs.column("key").to_numpy()] = pairs.column("n").to_numpy()
    seen_last, seen_before = of_slots.reshape(2, CLASSES + 1, -1)
    observed = feature_sums(cells, None, inner)[0]
    for _ in range(epochs if n else 0):
        expected, slot_mean = feature_sums(cells, weights, inner)
        # The gradient, scaled by what a feature has seen: four features are active at once, or two in the slots.
        weights += np.float32(0.6) * (observed - expected) / (observed + expected + np.float32(2.0))
        for w, seen, mean in zip((inner.last, inner.before), (seen_last, seen_before), np.split(slot_mean, 2)):
            w += (0.8 * (seen - mean) / (seen + mean + 2.0)).astype(np.float32)
    return Model(weights, own, head, tokens, words, inner, int(n), int(v)), counts


def scored(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """Per row of ``docs``: its columns but text, with n_tokens, n_known, train_tokens, base_score and score.

    A null text is empty and has its end alone. Repeated rows are scored each. Columns of these names are replaced.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    new = ("text", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    own = [c for c in docs.columns if c.lower() not in new]
    base_total = model.n + SMOOTH * (model.v + 1)
    # What a word that has no slot is a part of: its class, or the other words of a shared one.
    within = np.append((model.class_tokens + SMOOTH * (model.class_words + 1))[: 1 + OWN], model.inner.rest)
    kind = pa.list_(pa.struct([("token", pa.string()), ("times", pa.int64()), ("class", pa.int32())]))

    @F.arrow_udf("struct<n: long, known: long, base: double, score: double, tails: array<struct<token: string, times: long, class: int>>>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        ln10 = np.log(10)
        for texts in batches:
            index, distinct, offsets = _sequences(texts)
            rows = len(texts)
            classes = np.array([class_of(w, m.own) if w != END else 0 for w in distinct])
            found = np.array([m.head.get(w, 0) for w in distinct])
            in_head = found > 0
            # Without training texts nothing is in the head; words below the cut are joined later.
            base = np.where(in_head, np.log10((found + SMOOTH) / base_total), 0.0)
            has_slot = np.array([w in m.inner.slots for w in distinct])
            inner = np.where(in_head & ~has_slot, np.log10((found + SMOOTH) / within[classes]), 0.0)
            sequence, slot = classes[index], m.inner.slots_of(distinct, classes.tolist())[index]
            context, spot = np.unique(_contexts(sequence, offsets), return_inverse=True)
            outer = np.empty(len(index))
            by_context, ends = np.argsort(spot, kind="stable"), np.cumsum(np.bincount(spot, minlength=len(context)))
            for i in range(0, len(context), 512):
                some = context[i : i + 512]
                part = by_context[ends[i - 1] if i else 0 : ends[min(i + 512, len(context)) - 1]]
                row = spot[part] - i
                outer[part] = log_probabilities(m.weights, some)[row, sequence[part]] / ln10
                shares = slot[part] >= 0
                part, row = part[shares], row[shares]
                logits, total = m.inner.logits(some)
                outer[part] += (logits[row, slot[part]] - total[row, sequence[part] - 1 - OWN]) / ln10
            owner = np.repeat(np.arange(rows), np.diff(offsets))
            rare = ~in_head[index]
            key, times = np.unique(owner[rare] * len(distinct) + index[rare], return_counts=True)
            who, word = np.divmod(key, len(distinct))
            tails = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(who, np.arange(rows + 1)), pa.int32()),
                pa.StructArray.from_arrays([pa.array([distinct[w] for w in word], pa.string()), pa.array(times, pa.int64()), pa.array(classes[word], pa.int32())], ["token", "times", "class"]))
            yield pa.StructArray.from_arrays([
                pa.array(np.diff(offsets), pa.int64()), pa.array(sums(in_head[index].astype(np.int64), offsets), pa.int64()),
                pa.array(sums(base[index], offsets)), pa.array(sums(inner[index] + outer, offsets)), tails.cast(kind)], ["n", "known", "base", "score", "tails"])

    parts = stored(docs.select(*own, F.monotonically_increasing_id().alias("_row"), read("text").alias("_read")), "scores")
    tail = parts.select("_row", F.inline("_read.tails")).join(counts.withColumnRenamed("n", "_count"), "token", "left")
    count = F.coalesce("_count", F.lit(0)) + SMOOTH
    total = F.get(F.array(*(F.lit(float(x)) for x in within)), F.col("class"))
    rest = tail.groupBy("_row").agg(
        F.sum(F.when(F.col("_count") > 0, F.col("times")).otherwise(0)).alias("_more"),
        F.sum(F.col("times") * F.log10(count / F.lit(base_total))).alias("_base2"), F.sum(F.col("times") * F.log10(count / total)).alias("_score2"))
    more = F.coalesce("_more", F.lit(0))
    return parts.join(rest, "_row", "left").select(
        *own, F.col("_read.n").alias("n_tokens"), (F.col("_read.known") + more).alias("n_known"), F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("_read.base") + F.coalesce("_base2", F.lit(0.0))).alias("base_score"), (F.col("_read.score") + F.coalesce("_score2", F.lit(0.0))).alias("score"))

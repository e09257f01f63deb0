"""Each training-data operator against brute force, and on rows that break careless code."""

import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from marketflow.llm import chat, chunks, common, forest, graph, maxent, mixing, packing, queries, simhash, similar, tokens, toxicity, urls, wavelet

SF_DIR = "/root/testdata/sf0.001"
LONG = "lorem ipsum " * 20_000 + "x" * 70_000
TEXTS = [None, "", " \t ", "a", "The cat", "the CAT", "É cat", "one two three four five six", "one two three four five six", LONG, LONG.upper()]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, weight double, recipe string, fp long, n_tokens int"


@pytest.fixture
def odd(spark):
    """Null ids, sources and texts, empty and long texts, equal texts, a repeated row, columns with the operators' own names."""
    rows = [(i, t, "en", None if i % 3 else "s", 1, 0.5, 2.0, "r", 3, 4) for i, t in enumerate(TEXTS)]
    rows += [rows[3], (None, "the cat", None, "s", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _sorted(rows):
    return sorted(map(tuple, rows), key=repr)


def test_split_words_is_the_stated_split():
    texts = ["", None, " a", "a ", "A\tb\x0bC\x0c\r\nd", "É\u00a0x Ü", "  "]
    index, distinct, offsets = common.split_words(pa.array(texts))
    for text, a, b in zip(texts, offsets, offsets[1:]):
        assert [distinct[i].encode() for i in index[a:b]] == (text or "").encode().lower().split()


def test_pieces_give_the_ids_of_whole_texts():
    encoder, draw = tokens.Encoder(tokens.default_path()), random.Random(3)
    alphabet = ["a", "B", " ", " ", "  ", "\n", "\t", "é", "1", "'s", "<|endoftext|>", "!", "\x1c", "\x85", "漢", "\0", "word"]
    texts = ["".join(draw.choices(alphabet, k=draw.randrange(14))) for _ in range(3000)] + [None, LONG]
    ids, ends = encoder.encode(pa.array(texts))
    for text, a, b in zip(texts, ends, ends[1:]):
        assert ids[a:b].tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_toxicity_is_accurate_on_held_out_labels(spark):
    """Labelled rows that the model never saw, copies of texts it saw left out."""
    docs, labels = (common.table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    rows = queries.op1_compression_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").join(docs, "doc_id").select("text", "held_out", "predicted", "toxic").collect()
    seen = {r.text for r in rows if not r.held_out}
    new = {r.text: (r.predicted, r.toxic) for r in rows if r.held_out and r.text not in seen}
    assert sum(p == t for p, t in new.values()) / len(new) > 0.95
    toxic = [p for p, t in new.values() if t]
    assert sum(toxic) / len(toxic) > 0.7


def test_toxicity_on_odd_rows(spark, odd, none):
    model = toxicity.fit(["plain words here"] * 3 + ["other plain words", "vokzu vokzu vile", "vokzuta plain"], [0, 0, 0, 0, 1, 1])
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert toxicity.score(none, model).count() == 0
    nothing = toxicity.train(odd, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.score(odd, nothing).collect()} == {0}


def test_toxicity_sample_survives_long_texts(spark):
    """A text that does not fit takes no room; a label with long texts alone keeps some."""
    docs = spark.createDataFrame([(i, "w " * (500 if i in (3, 60) or i >= 80 else 5)) for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 80)) for i in range(100)], "doc_id long, toxic int")
    texts, truth, share = toxicity.labelled_sample(docs, labels, max_chars=800)
    assert truth.count(0) == 78 and truth.count(1) == 20 and math.isclose(share, 0.2)


def plain_score(model, seen, words):
    """The score of a text, word by word."""
    score, before, last = 0.0, maxent.START, maxent.START
    for word in (w.decode() for w in words):
        class_ = 0 if word == maxent.END else maxent.class_of(word, model.own)
        context = np.array([before * (maxent.CLASSES + 1) + last])
        logits = model.weights[maxent.features(context)[0]].sum(0, dtype=np.float64)
        score += logits[class_] - np.log(np.exp(logits).sum())
        count, inner, shared = seen[word.encode()] + 0.1, model.inner, class_ - 1 - maxent.OWN
        if shared < 0:
            score += np.log(count / (model.class_tokens[class_] + 0.1 * (model.class_words[class_] + 1)))
        else:
            own = range(inner.starts[shared], [*inner.starts, len(inner.bias)][shared + 1])
            values = {s: inner.bias[s] + inner.last[last, s] + inner.before[before, s] for s in own}
            slot = inner.slots.get(word, own[-1])
            score += values[slot] - np.log(sum(np.exp(v) for v in values.values())) + (0 if word in inner.slots else np.log(count / inner.rest[shared]))
        before, last = last, class_
    return score / math.log(10)


def test_maxent_base_score_and_normalisation(spark, odd, none):
    docs = odd.select("doc_id", "text", "score", "n_tokens")
    model, counts = maxent.train(docs, epochs=2)
    words = {t: [*(t or "").encode().lower().split(), b"\n"] for t in TEXTS}
    seen = collections.Counter(w for r in odd.collect() for w in ((r.text or "").encode().lower().split() + [b"\n"]))
    n, v = sum(seen.values()), len(seen)
    rows = maxent.scored(docs, model, counts).collect()
    assert len(rows) == 13
    for r in rows:
        if r.doc_id is not None:
            own = words[TEXTS[r.doc_id]]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), len(own), n)
            assert math.isclose(r.base_score, sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), rel_tol=1e-9)
            assert r.score < 0
    table = maxent.log_probabilities(model.weights, np.arange(0, 5000, 37))
    assert np.allclose(np.exp(table).sum(1), 1, atol=1e-5)
    # Within a class all words and one unknown make 1.
    inner = collections.defaultdict(float)
    for w, c in seen.items():
        inner[maxent.class_of(w.decode(), model.own) if w != b"\n" else 0] += c + 0.1
    assert all(math.isclose(inner[k] + 0.1, model.class_tokens[k] + 0.1 * (model.class_words[k] + 1)) for k in inner)
    # So do the slots of a class in any context; the rest is shared by the words without a slot and one unknown.
    logits, total = model.inner.logits(np.arange(0, 20_000, 371))
    assert np.allclose(np.add.reduceat(np.exp(logits), model.inner.starts, axis=1) / np.exp(total), 1)
    left = np.zeros(maxent.ENDINGS)
    for w, c in seen.items():
        if w != b"\n" and w.decode() not in model.own and w.decode() not in model.inner.slots:
            left[maxent.ending_class(w.decode()) - 1 - maxent.OWN] += c + 0.1
    assert np.allclose(left + 0.1, model.inner.rest)
    assert [r.score for r in rows if r.doc_id == 0][:1] == [pytest.approx(plain_score(model, seen, words[TEXTS[0]]))]
    empty, empty_counts = maxent.train(none)
    assert maxent.scored(none, empty, empty_counts).count() == 0 and maxent.scored(docs, empty, empty_counts).count() == 13


def test_maxent_scores_are_those_of_the_stated_model(spark):
    draw = random.Random(5)
    names = ["".join(draw.choices("abcdefgh", k=5)) for _ in range(2500)]
    rows = [(i, " ".join(names[int(2500 ** draw.random()) - 1] for _ in range(draw.randrange(60)))) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model, counts = maxent.train(docs, epochs=3)
    seen = collections.Counter(w for _, text in rows for w in [*text.encode().split(), b"\n"])
    assert len(seen) > maxent.OWN + maxent.WORDS + 100
    assert len(model.inner.slots) == maxent.WORDS and min(np.abs(model.inner.last).max(), np.abs(model.inner.before).max()) > 0.1
    logits, total = model.inner.logits(np.arange(0, 26_000, 371))
    assert np.allclose(np.add.reduceat(np.exp(logits), model.inner.starts, axis=1) / np.exp(total), 1)
    found = {r.doc_id: r.score for r in maxent.scored(docs, model, counts).collect()}
    for i, text in rows[:40]:
        assert math.isclose(found[i], plain_score(model, seen, [*text.encode().split(), b"\n"]), rel_tol=1e-5)


def test_maxent_beats_unigrams_on_held_out_texts(spark):
    p = queries.op2_maxent_scores(spark, "/root/testdata/sf0.01").where("held_out").selectExpr("sum(score) / sum(n_tokens) s", "sum(base_score) / sum(n_tokens) b").first()
    assert p.s > p.b + 0.2


def test_wavelet_access_count_locate():
    draw = np.random.default_rng(0)
    for n, most in ((0, 1), (1, 1), (700, 50_257), (3000, 3), (1000, 70_000)):
        ids = draw.integers(0, most, n).astype(np.uint32)
        shard = wavelet.Shard(wavelet.build(ids, np.array([1]), np.array([1]), np.array([n])))
        assert (shard.ids() == ids).all()
        for i in range(0, n, 97):
            assert shard.access(i) == ids[i]
        for token in {*ids[:4].tolist(), most + 3}:
            at = np.flatnonzero(ids == token)
            assert shard.count(token) == len(at) and shard.count(token, n // 4, n // 2) == ((at >= n // 4) & (at < n // 2)).sum()
            assert [shard.locate(token, k) for k in range(min(3, len(at)))] == at[:3].tolist() and shard.locate(token, len(at)) == -1


def test_wavelet_files_round_trip(spark, odd, none, tmp_path):
    wavelet.write_shards(odd, str(tmp_path / "a"), tokens.default_path(), shard_ids=50)
    rows = wavelet.read_shards(spark, str(tmp_path / "a")).orderBy("start").collect()
    encoder, start = tokens.Encoder(tokens.default_path()), 0
    given = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    for r, d in zip(rows, given, strict=True):
        ids = [*encoder.tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    wavelet.write_shards(none, str(tmp_path / "b"), tokens.default_path())
    assert wavelet.read_shards(spark, str(tmp_path / "b")).count() == 0


def test_joined_pieces_split_where_each_one_ends(monkeypatch):
    encoder = tokens.Encoder(tokens.default_path())
    pieces = [" a", " <|endoftext|>", " \u00e9\u6f22", " \0", *(f" word{i}!" for i in range(600)), " '", " 's"]
    single = encoder._singly(pieces)
    assert encoder._joined(pieces) == single
    encoder.bytes += 1  # as if the file were no byte-level one
    assert encoder._joined(pieces) == single


def test_packing_places_every_id_once(odd, none):
    rows = packing.packed(odd, tokens.default_path(), run=4).collect()
    sequences, docs = collections.defaultdict(list), collections.Counter()
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id] += r.length
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    encoder = tokens.Encoder(tokens.default_path())
    assert docs == collections.Counter({k: sum(len(encoder.tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd.collect() if r.doc_id == k) for k in docs})
    whole = {np.array([*encoder.tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for r in odd.collect()}
    for r in rows:
        assert any(len(ids) == 4 * r.doc_tokens and zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32 for ids in whole)
    assert packing.packed(none, tokens.default_path()).count() == 0


def test_pack_descends_to_the_cheapest_sequence_with_room():
    rows = packing.pack([5, 3, 9, 4], 8)
    assert sorted(rows) == [(0, 0, 5, 1, 0), (1, 0, 3, 2, 4), (2, 0, 8, 0, 0), (2, 8, 1, 1, 5), (3, 0, 4, 2, 0)] and packing.pack([]) == []


@pytest.mark.parametrize("id_bytes", [16, 1])
def test_chunk_groups(odd, none, id_bytes):
    """With one-byte identifiers nearly all clash, and groups stay right."""
    lower = lambda t: (t or "").encode().lower()
    given = [(r.doc_id, lower(r.text)) for r in odd.collect()]
    wanted = []
    for text in {t for _, t in given}:
        own = [d for d, t in given if t == text]
        keep, done = max((d for d in own if d is not None), default=None), False
        for d in own:
            wanted.append((d, keep, len(own), d == keep and not done, hashlib.sha256(text).hexdigest()))
            done |= d == keep
    assert _sorted(chunks.groups(odd, id_bytes).collect()) == _sorted(wanted)
    assert chunks.groups(none, id_bytes).count() == 0


def test_chunks_join_to_the_text_and_survive_a_shift():
    data = bytes(random.Random(1).choices(b"abcdefghij ", k=60_000))
    parts, moved = chunks.chunks(data), chunks.chunks(b"new head " + data)
    assert b"".join(parts) == data and len(set(parts) & set(moved)) > 0.8 * len(parts) and chunks.chunks(b"") == []


def test_deduplicated_keeps_one_row_each(odd, none):
    rows = chunks.deduplicated(odd)
    assert rows.columns == odd.columns and rows.count() == len({(t or "").encode().lower() for t in TEXTS}) and chunks.deduplicated(none).count() == 0


def _reached(values, radius=3):
    """Smallest index reached from each value by steps of at most ``radius`` bits."""
    least = list(range(len(values)))
    for _ in values:
        for i, a in enumerate(values):
            least[i] = min(least[j] for j, b in enumerate(values) if (a ^ b).bit_count() <= radius)
    return least


def test_ball_links_lose_none_and_add_none(spark):
    draw, values = random.Random(2), []
    for _ in range(12):
        base = draw.getrandbits(64)
        values.append(base)
        for bits in (1, 2, 3, 3, 3, 4, 5):
            values.append(base ^ sum(1 << b for b in draw.sample(range(64), bits)))
    values = sorted({*values, 0, (1 << 64) - 1, 7, 1 << 63}, key=simhash._signed)
    fps = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    roots = {r.node: r.root for r in graph.components(simhash.links(fps)).collect()}
    assert [roots.get(simhash._signed(v), simhash._signed(v)) for v in values] == [simhash._signed(values[i]) for i in _reached(values)]


def test_only_blocks_that_meet_go_on(spark):
    """Values far apart share no block value: the first step must hold them back."""
    fps = spark.createDataFrame([(simhash._signed(random.Random(i).getrandbits(64)),) for i in range(50)], "fp long")
    values = fps.select("fp", simhash.F.explode(simhash._near_blocks(simhash.F.col("fp"))).alias("value"))
    assert values.select("value").distinct().count() == values.count() == 50 * 131


def test_fingerprints_and_components(odd, none):
    def plain(text):
        words = (text or "").encode().lower().split()
        parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
        hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = simhash.near_groups(odd.select("doc_id", "text", "fp")).collect()
    assert len(rows) == 13
    for r in rows:
        if r.doc_id is not None:
            assert r.fingerprint == f"{plain(TEXTS[r.doc_id]):016x}"
    by_id = {r.doc_id: r.component_id for r in rows}
    assert by_id[0] == by_id[1] == by_id[2] == 0 and by_id[4] == by_id[5] == by_id[None] == 4 and by_id[8] == 7 and by_id[10] == 9
    assert simhash.near_groups(none).count() == 0 and similar.deduplicated(none).count() == 0
    assert similar.deduplicated(odd).columns == odd.columns and similar.deduplicated(odd).count() == len(set(by_id.values()))


def test_similar_groups_against_brute_force(spark):
    """All pairs from 0.8 on by comparison of sets: none is missed, none is added; one document of each group stays."""
    docs = common.table(spark, "/root/testdata/sf0.1", "documents")
    docs = docs.where("length(text) < 4000").dropDuplicates(["text"]).select("doc_id", "text")
    sets = {r.doc_id: set(similar.distinct_hashes(r.text).tolist()) for r in docs.collect()}
    having, pairs = collections.defaultdict(list), set()
    often = collections.Counter(h for own in sets.values() for h in own)
    for i, own in sorted(sets.items(), key=lambda x: len(x[1])):
        first = sorted(own, key=lambda h: (often[h], h))[: len(own) - math.ceil(0.8 * len(own)) + 1]
        for j in {j for h in first for j in having[h]}:
            if len(own & sets[j]) >= 0.8 * len(own | sets[j]):
                pairs.add((i, j))
        for h in first:
            having[h].append(i)
    edges = [(i, j, 0) for i, j in pairs]
    true = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long, x int")).collect()}
    kept = {r.doc_id for r in similar.deduplicated(docs).select("doc_id").collect()}
    gone = set(sets) - kept
    empty = sorted(i for i, own in sets.items() if not own)
    assert len(pairs) > 20 and gone == set(true) | set(empty[1:])


def test_rows_that_stay_are_not_shuffled(spark):
    """Ids of one row go or stay where they lie; several rows of an id, null ids too, are settled apart. Extra columns may have any name."""
    rows = [(i, f"t{i}", i) for i in range(50)] + [(7, "other", 0), (None, "a", 1), (None, "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, several long")
    states = spark.createDataFrame([(d, d is None or d % 5 > 0) for d, *_ in rows], "doc_id long, kept boolean")
    asked = []

    def settle(several):
        asked.extend(r.text for r in several.collect())
        return several.where("several = 1")

    kept = common.staying(docs, states, settle)
    assert sorted(asked) == ["a", "b", "other", "t7"] and kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == sorted(["a"] + [f"t{i}" for i in range(50) if i % 5 and i != 7])
    single = docs.where("doc_id < 7")
    plan = common.staying(single, states.where("doc_id < 7"), settle)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert common.staying(docs.limit(0), states.limit(0), settle).count() == 0


def test_similar_groups_link_chains_and_large_families(spark):
    """Members of a family of many versions are one group; texts that share half their words stay apart."""
    draw = random.Random(5)
    words = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    base, rows = words(200), []
    for i in range(120):
        own = list(base)
        own[draw.randrange(200)] = f"v{i}"
        rows.append((i, " ".join(own)))
    half = words(100)
    rows += [(1000 + i, " ".join(half + words(100))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in similar.deduplicated(docs).collect()) == [0, *range(1000, 1030)]


def test_similar_groups_find_short_texts(spark):
    """Texts of four and five shingles that share four are at 0.8: every one is found."""
    rows = []
    for i in range(80):
        text = " ".join(f"w{i}x{k}" for k in range(8))
        rows += [(2 * i, text), (2 * i + 1, f"{text} more{i}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in similar.deduplicated(docs).collect()) == list(range(0, 160, 2))


def test_similar_groups_are_those_of_all_pairs(spark):
    """In a family where most pairs are unlike, every group of the comparison of all pairs is found, and no other."""
    draw, rows = random.Random(11), []
    base = [f"w{k}" for k in range(200)]
    for i in range(500):
        own = list(base)
        for k in range(3 + draw.randrange(6)):
            own[draw.randrange(200)] = f"v{i}x{k}"
        rows.append((i, " ".join(own)))
    sets = [set(similar.distinct_hashes(text).tolist()) for _, text in rows]
    root = list(range(500))
    for i in range(500):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert 50 < len(set(root)) < 450
    assert sorted(r.doc_id for r in similar.deduplicated(docs).collect()) == sorted(set(root))


def test_mixture_keeps_every_row_and_repeats_within_the_limit(spark, odd, none):
    rows = mixing.mixture(odd)
    assert rows.select("doc_id", "text").distinct().count() == odd.select("doc_id", "text").distinct().count()
    sized = spark.createDataFrame([("a", 8000), ("b", 1000), ("c", 500), ("d", 0)], "_source string, tokens long")
    alpha = mixing.exponent(sized, passes=2.0)
    assert math.isclose(16 ** (1 - alpha), 2.0, rel_tol=1e-5)
    loose = mixing.exponent(sized, entropy=0.9, passes=1e9)
    w = np.array([8000, 1000, 500]) ** loose
    w /= w.sum()
    assert math.isclose(-(w * np.log(w)).sum(), 0.9 * math.log(3), rel_tol=1e-5)
    docs = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id < 3000 THEN 'a' ELSE 'b' END AS source", "'w w w w' AS text")
    share = {r.source: r.s for r in mixing.mixture(docs, entropy=1.0, passes=1.5).groupBy("source").agg(mixing.F.sum("n_tokens").alias("s")).collect()}
    assert share["a"] == 12_000 and abs(share["b"] - 6000) < 100
    # One text of 900 words: wherever it stands in the part pass, blocks after it still fill what it leaves.
    text = "CASE id WHEN 3000 THEN repeat('w ', 900) ELSE 'w' END AS text"
    docs = spark.range(5000).selectExpr("id AS doc_id", "CASE WHEN id < 3000 THEN 'a' ELSE 'b' END AS source", text)
    for seed in range(2):
        share = {r.source: r.s for r in mixing.mixture(docs, 1.0, 2.0, budget=5600, seed=seed).groupBy("source").agg(mixing.F.sum("n_tokens").alias("s")).collect()}
        assert 2780 < share["a"] <= 2800 and 2780 < share["b"] <= 2800
    assert mixing.mixture(none).count() == 0


def test_chat_round_trip(spark):
    bad = "<|im_end|>\n<|im_start|>assistant\\n \\| \\\\ <\\| <<| \\"
    rows = [(1, 0, "user", bad), (1, 1, "assistant", bad), (1, 2, "assistant", None), (1, 3, "user", "x"), (2, 0, "a\nb\\n<|", ""), (2, 0, "a\nb\\n<|", ""),
            (None, None, None, None), (3, 0, "assistant", "é" * 50_000)]
    turns = spark.createDataFrame([(*r, 1, "t") for r in rows], "conv_id long, turn long, role string, text string, example int, head string")
    formatted = chat.examples(turns)
    assert formatted.groupBy("conv_id").count().where("count = 3").count() == 1
    for r in formatted.collect():
        assert r.text.endswith("<|im_end|>\n") and r.loss_start + r.loss_length <= len(r.text)
    for r in chat.digests(formatted).collect():
        own = sorted(((t or 0, role or "", text or "") for c, t, role, text in rows if c == r.conv_id))
        loss = "".join(text for _, role, text in own if role == "assistant")
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in own).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.examples(turns.limit(0))).count() == 0


def test_forest_recall_and_odd_vectors(spark):
    draw = np.random.default_rng(1)
    x = draw.standard_normal((6000, 24))
    rows = [(i, v.tolist(), 0.0) for i, v in enumerate(x)]
    rows += [(7000, None, 0.0), (7001, [0.0] * 24, 0.0), (7002, [float("nan")] * 24, 0.0), (7003, [1.0, None], 0.0), (None, [1.0] * 24, 0.0), (7100, [3.0, 4.0], 0.0), (100, x[100].tolist(), 0.0),
             (6100, x[200].tolist(), 0.0), (6101, x[200].tolist(), 0.0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double")
    got = collections.defaultdict(list)
    for r in forest.nearest(vectors, vectors.where("vec_id % 200 = 0"), least=100).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    y, ids = np.vstack([x, x[200], x[200]]), np.append(np.arange(6000), [6100, 6101])
    hits = 0
    assert set(got) == {*range(0, 6000, 200)}
    for q, found in got.items():
        far = np.sqrt(((y - x[q]) ** 2).sum(1))
        best = [i for i in np.lexsort((ids, far)) if ids[i] != q][:10]
        hits += len({ids[i] for i in best} & {v for _, v, _ in found})
        assert [k for k, _, _ in found] == list(range(1, 11)) and all(math.isclose(s, far[np.flatnonzero(ids == v)[0]], abs_tol=1e-12) for _, v, s in found)
    assert hits / (10 * len(got)) >= 0.9 and [v for _, v, _ in got[200][:2]] == [6100, 6101]
    assert forest.nearest(vectors.limit(0), vectors).count() == 0


def test_urls(spark):
    split = urls.Segmenter({"casino": 50, "win": 40, "now": 40, "a": 30}).split
    assert split("casinowinnow") == ("casino", "win", "now") and split("") == ()
    given = [(1, "http://WWW.Example.com/en/1?x"), (2, "https://m.example.com/en/2"), (3, "http://a.net/es/q#t"), (4, "http://casinowin.example.org/p"), (5, None), (6, "no scheme"), (7, "x://h"),
             (8, "http://ab.com"), (9, "http://news.example.org/" + "a" * 20_000), (4, "http://casinowin.example.org/p"), (None, "http://notnet/es/")]
    pages = spark.createDataFrame([(i, u, "<p>casino win news</p>" * 3, "r") for i, u in given], "page_id long, url string, html string, rule string")
    rows = urls.judged(pages).collect()
    assert len(rows) == len(given)
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert found[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow") and found[2][2:] == ("example.com/en/", "block") and found[3][1:] == ("/es/q", "net/es/", "block")
    assert found[4][2:] == (None, "block") and found[5][:3] == ("", "", None) and found[6][:2] == ("", "") and found[7][:2] == ("h", "") and found[8][2] is None and found[9][3] == "allow" and found[None][2] is None
    assert urls.judged(pages.limit(0)).count() == 0


def test_urls_read_every_label_and_script(spark):
    """The last label of a host counts, as a word and as a token of its own kind; so do words of other scripts."""
    split = urls.Segmenter({"казино": 50, "shop": 40, "play": 9})
    assert urls.tokens(split, "play.xxx", "/Казино/7") == ["play", *split.split("xxx"), ".xxx", "/казино"] and urls.tokens(split, "shop", "") == ["shop"]
    assert urls.tokens(split, "казиноshop.bet.", "") == ["казино", "shop", *split.split("bet")]
    rows = [(i, f"http://{'play' if i % 2 else 'garden'}{i}.{'bet' if i % 2 else 'org'}/x", "<p>play garden org казино</p>") for i in range(60)]
    rows += [(100 + i, f"http://garden{i}.xxx/", "") for i in range(20)] + [(201, "http://garden.bet", ""), (202, "http://garden.org/", "")]
    found = {r.page_id: r.verdict for r in urls.judged(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [found[i] for i in (1, 2, 100, 201, 202)] == ["block", "allow", "block", "block", "allow"]


def test_urls_count_rare_words_and_tokens(spark):
    """A word beyond the 50,000 most frequent is still one; what every task knows does not change the odds."""
    code = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    frequent = " ".join(f"q{code(i)}" for i in range(51_000))
    pages = [(i, f"http://essex.example.org/{code(i)}/essex", "<p>es sex essex</p>" if i else f"<p>{frequent} {frequent}</p>" ) for i in range(20)]
    pages = [(i, u, h.replace("essex", "") if i != 1 else h) for i, u, h in pages]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    assert {r.verdict for r in urls.judged(table).collect()} == {"allow"}
    given = [(i, f"http://{a}{b}.example.org/{b}{c}/{i}", f"<p>{a} {b} {c} casino news</p>") for i, (a, b, c) in enumerate(
        (code(i * 7919 % 1000) + "t", code(i % 13) + "s", "casino" if i % 3 else "garden") for i in range(150))]
    table = spark.createDataFrame(given, "page_id long, url string, html string").repartition(3)
    whole, few = ({r.page_id: r for r in urls.judged(table, **most).collect()} for most in ({}, {"words": 5, "features": 5}))
    assert len(whole) == len(few) == 150 and len({r.verdict for r in whole.values()}) == 2
    assert all(few[i].verdict == r.verdict and math.isclose(few[i].block_odds, r.block_odds, abs_tol=1e-9) for i, r in whole.items())


def test_stages_keep_columns_and_drop_only_what_they_should(spark, odd, none):
    for docs in (odd.select("doc_id", "text", "lang", "source", "n_chars"), none.select("doc_id", "text", "lang", "source", "n_chars")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns and out.count() >= 0
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= docs.count()


def test_pipeline_keeps_clean_documents(spark):
    kept = {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id").distinct().collect()}
    docs = common.table(spark, SF_DIR, "documents").collect()
    assert kept and len(kept) > 0.6 * len({d.text for d in docs})


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    wanted = con.sql(queries.ORACLES[name])
    found = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(wanted.columns)
    assert _sorted(found.select(*wanted.columns).collect()) == _sorted(wanted.fetchall())


def test_near_dedup_of_the_pipeline_links_fingerprints(spark):
    """Most windows of two texts are the same three, so their fingerprints are equal, and their sets of shingles share little."""
    texts = ["a b c " * 300 + " ".join(f"{end}{i}" for i in range(10)) for end in "xy"] + ["something else altogether here"]
    assert simhash.fingerprint(texts[0]) == simhash.fingerprint(texts[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert similar.deduplicated(docs).count() == 3
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF_DIR).collect()) == [0, 2]


def test_rows_that_stay_by_fingerprint(odd, none):
    """One row of each component of op10, with all columns."""
    wanted = {r.component_id for r in simhash.near_groups(odd.select("doc_id", "text")).collect()}
    kept = similar.deduplicated_by_fingerprint(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == sorted(wanted)
    assert similar.deduplicated_by_fingerprint(none).count() == 0


def test_shards_do_not_depend_on_how_much_is_encoded_at_once(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"a piece  of text {i}\n" * (i % 7)) for i in range(60)], "doc_id long, text string").coalesce(2)
    found = []
    for size in (1, 1 << 22):
        monkeypatch.setattr(wavelet, "SLICE_BYTES", size)
        wavelet.write_shards(docs, str(tmp_path / str(size)), tokens.default_path())
        found.append(sorted(map(tuple, wavelet.read_shards(spark, str(tmp_path / str(size))).collect())))
    assert found[0] == found[1] and len(found[0]) == 60


def _held():
    """KB that this process holds."""
    with open("/proc/self/smaps_rollup") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("Pss_Anon"))


def test_driver_gives_back_the_sample_of_toxicity(spark, monkeypatch):
    """Of what the fit takes in the driver, small texts and Arrow arrays, less than a quarter is kept once there is a model."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    grown = []

    def fit(*sample):
        before = _held()
        kept = [bytes([i % 256]) * 3000 for i in range(20_000)]
        arrays = [pa.array(kept[:200], pa.binary()) for _ in range(100)]
        grown.append(_held() - before)
        del arrays, kept[::2]
        return kept[-1:]

    common.prepare(spark)
    toxicity.train(docs, labels)
    monkeypatch.setattr(toxicity, "fit", fit)
    before = _held()
    toxicity.train(docs, labels)
    assert grown[0] > 50_000 and _held() - before < grown[0] / 4


def test_workers_give_freed_memory_back(spark):
    """Of 13 MB of texts and 100 MB of Arrow arrays a worker keeps less than a quarter once they are freed."""

    def read(batches):
        for _ in batches:
            def held():
                with open("/proc/self/smaps_rollup") as f:
                    return next(int(line.split()[1]) for line in f if line.startswith("Pss_Anon"))

            pa.array([b""])  # what Arrow loads at first stays
            before = held()
            texts = [bytes([i]) * (64 << 10) for i in range(200)]
            arrays = [pa.array(texts[:40], pa.binary()) for _ in range(40)]
            most = held()
            del texts, arrays
            yield pa.RecordBatch.from_pydict({"pool": [pa.default_memory_pool().backend_name], "grown": [most - before], "left": [held() - before]})

    common.prepare(spark)
    row = spark.range(1, numPartitions=1).mapInArrow(read, "pool string, grown long, left long").first()
    assert row.pool == "system" and row.left < row.grown / 4


def test_texts_that_meet_but_cannot_be_similar_make_no_pairs(spark):
    """Two sets that meet at a shingle too far back, or of too unlike sizes, don't count as met; of three at a value all do."""
    rows = [(1, 10, [5, 6]), (2, 100, [5, 7]), (3, 10, [8, 9, 6]), (4, 10, [7, 8]), (5, 10, [8, 1])]
    nodes = spark.createDataFrame(rows, "node long, _size long, _prefix array<long>")
    met = similar.meetings(nodes, 0.8)
    assert sorted((r.value, r.node, r.at, r.size, r.n, r.least.node) for r in met.collect()) == [(8, 3, 0, 10, 3, 3), (8, 4, 1, 10, 3, 3), (8, 5, 0, 10, 3, 3)]
    assert similar.meetings(nodes, 0.6).where("value = 6").count() == 2
    links = spark.createDataFrame([], "u long, v long")
    assert sorted(map(tuple, similar.crossing(met, links, 0.8).collect())) == [(4, 3), (5, 3)]
    assert sorted(map(tuple, similar.crossing(met, links, 0.9).collect())) == [(5, 3)]

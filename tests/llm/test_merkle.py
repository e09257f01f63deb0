"""The Merkle manifest against a plain tree, and on rows that break careless code."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from marketflow.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place long, tree string, leaves int, digest string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    n = None if row.n_chars is None else row.n_chars + more
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, n, row.text)))


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def path(tree, place):
    return [level[place >> k ^ 1] for k, level in enumerate(tree[:-1]) if place >> k ^ 1 < len(level)]


def plain(rows, tampered):
    """Rows of (doc_id, leaf, subroot, root, proof, verified) by whole trees in memory."""
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row.lang, []).append(row)
    langs = sorted(by_lang, key=lambda l: (l is not None, (l or "").encode()))
    for own in by_lang.values():
        own.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
    trees = {lang: levels([leaf(r) for r in by_lang[lang]]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    return [(r.doc_id, leaf(r), trees[lang][-1][0], top[-1][0], digest(*path(trees[lang], i), *path(top, k)), r.doc_id not in tampered or r.n_chars is None)
            for k, lang in enumerate(langs) for i, r in enumerate(by_lang[lang])]


def found(docs, tampered, step):
    rows = merkle.proofs(docs, F.coalesce(F.col("doc_id").isin(*tampered), F.lit(False)), step).collect()
    assert all(r.verified == (r.folded_root == r.root) for r in rows)
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in rows]


@pytest.mark.parametrize("step", [1, 2, 10])
def test_proofs_are_those_of_whole_trees(spark, step):
    """One level, two and ten to a pass; null ids and languages, repeated rows, empty and long texts, columns with the operator's names."""
    draw = random.Random(step)
    rows = [(i, draw.choice([None, "", "é" * i, "word " * 30]), draw.choice([None, "en", "en", "en", "é", "Z"]), "s", draw.choice([None, i]), 1, "t", 2, "d") for i in range(60)]
    rows += [rows[3], rows[3], (None, "a", "en", None, 1, None, None, None, None), (None, "b", "en", None, 1, None, None, None, None), (7, "x" * 300_000, "one", "s", 3, 1, "t", 2, "d")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    key = lambda r: tuple(map(repr, r))
    assert sorted(found(docs, [3, 5, 7, 20], step), key=key) == sorted(plain(docs.collect(), {3, 5, 7, 20}), key=key)


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "t", None, None, 2, 0, "", 0, "")], SCHEMA)
    assert found(one, [9], 10) == [(1, *[leaf(one.first())] * 3, digest(), True)]
    assert merkle.proofs(one.limit(0)).count() == 0


def test_octopus_misses_as_little_as_possible():
    """For every set of leaves: what is fetched, and no less, gives every proof."""
    for n in range(1, 9):
        tree = levels([str(i) for i in range(n)])
        for size in range(1, n + 1):
            for places in itertools.combinations(range(n), size):
                needed = merkle.octopus(places, n)
                fetched = {(level, i): tree[level][i] for level, i in needed}
                proofs = merkle.expand({p: str(p) for p in places}, n, fetched)
                assert proofs == {p: path(tree, p) for p in places} and len(set(needed)) == len(needed)
                assert all(merkle.fold(str(p), p, n, proof) == tree[-1][0] for p, proof in proofs.items())
                derived = set(places)
                for level in range(merkle.height(n)):
                    assert not {i for k, i in needed if k == level} & derived
                    derived = {i >> 1 for i in derived}


def test_any_change_breaks_the_proof():
    tree = levels([str(i) for i in range(11)])
    for place in range(11):
        proof = path(tree, place)
        assert merkle.fold("changed", place, 11, proof) != tree[-1][0]
        for k in range(len(proof)):
            assert merkle.fold(str(place), place, 11, [*proof[:k], "no", *proof[k + 1 :]]) != tree[-1][0]


def test_places_follow_the_order_over_partitions(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    got = merkle.placed(rows, "k", "v").orderBy("place").collect()
    assert [(r.k, r.v) for r in got] == sorted((i % 3, i) for i in range(5000)) and [r.place for r in got] == list(range(5000))

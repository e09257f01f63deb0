"""Whitening against numpy's own eigenvectors, and on rows that break careless code."""

import collections
import math

import numpy as np
import pytest

from marketflow.llm import common, queries, spectra

SCHEMA = "vec_id long, embedding array<double>, n long, dim int, x string"
SF_DIR = "/root/testdata/sf0.001"


def vectors(kind, draw):
    if kind == "equal eigenvalues":
        return draw.integers(0, 2, (300, 6)) * 64
    if kind == "few dimensions":
        return np.floor(draw.standard_normal((300, 3)) @ draw.standard_normal((3, 24)) * 90).astype(int)
    if kind == "copies":
        return np.repeat(draw.integers(-90, 90, (5, 12)), 40, 0)
    if kind == "wide":
        return draw.integers(-(1 << 40), 1 << 40, (40, 4))
    return draw.integers(-300, 300, (400, 10) if kind == "plain" else (3, 40))


@pytest.mark.parametrize("kind", ["plain", "equal eigenvalues", "few dimensions", "copies", "fewer than dimensions", "wide"])
def test_updates_and_joins_keep_the_eigendecomposition(kind):
    x = vectors(kind, np.random.default_rng(4)).astype(np.int64) + spectra.SHIFT
    cut, dim = len(x) // 3, x.shape[1]
    whole = spectra.Spectrum.empty(dim).add(x)
    joined = spectra.Spectrum.empty(dim).add(x[:cut]).join(spectra.Spectrum.empty(dim).add(x[cut:]))
    off = x - x.mean(0)
    scatter = off.T @ off
    scale = np.abs(scatter).max()
    for found in (whole, joined):
        assert found.count == len(x) and found.sums == [sum(map(int, c)) for c in x.T]
        assert np.abs(found.vectors.T @ found.vectors - np.eye(dim)).max() < 1e-12
        assert np.abs(found.vectors * found.values @ found.vectors.T - scatter).max() < 1e-11 * scale
    nothing = spectra.Spectrum.empty(dim)
    assert nothing.join(whole) is whole and whole.join(nothing) is whole


def test_secular_roots_lie_between_the_poles():
    draw = np.random.default_rng(1)
    for k in (1, 2, 7, 40):
        for spread in (1.0, 1e-9, 1e9):
            d = np.cumsum(draw.random(k) ** 4 * spread + 1e-12)
            w = draw.random(k) ** 6 + 1e-13
            base, offset = spectra.secular(d, w)
            wanted = np.linalg.eigvalsh(np.diag(d) + np.sqrt(np.outer(w, w)))
            assert np.allclose(d[base] + offset, wanted, rtol=1e-12, atol=1e-13 * wanted.max())
            assert (d[base] + offset >= d).all() and (np.diff(d[base] + offset) >= 0).all()


def plain(rows, components=16):
    """{(vec_id, number of such rows): ...} by exact sums and numpy's eigenvectors."""
    x = {tuple(math.floor(64 * c) + 1_000_000 for c in v) for _, v in rows}
    n, sums = len(x), [sum(c) for c in zip(*x)]
    fit = np.array([[n * a - s for a, s in zip(row, sums)] for row in sorted(x)], dtype=object).astype(float) / n
    e, vectors = np.linalg.eigh(fit.T @ fit / n)
    e, vectors = e[::-1], vectors[:, ::-1]
    used = [k for k in range(min(components, len(e))) if e[k] > 1e-9 * e[0]]
    out = []
    for i, v in rows:
        off = [n * (math.floor(64 * c) + 1_000_000) - s for c, s in zip(v, sums)]
        white = np.array(off, dtype=object).astype(float) / n @ vectors[:, used] / np.sqrt(e[used])
        out.append((i, n, sum(d * d for d in off), np.abs(white), e[used] / e.sum()))
    return out


def compare(found, rows):
    got = collections.defaultdict(list)
    for r in found:
        got[r.vec_id, r.deviation].append(r)
    wanted = plain(rows)
    assert len(found) == sum(len(w[3]) for w in wanted)
    for i, n, deviation, white, explained in wanted:
        own = sorted(got[i, deviation], key=lambda r: r.component)
        own = own[:: len(own) // len(white)]  # equal rows
        assert [r.component for r in own] == list(range(1, len(white) + 1)) and {r.n for r in own} == {n}
        assert np.allclose(np.abs([r.whitened for r in own]), white, rtol=1e-8, atol=1e-8)
        assert np.allclose([r.explained for r in own], explained, rtol=1e-9)
    assert all(r.identity_error < 1e-9 for r in found) and len({r.identity_error for r in found}) <= 1


def test_whitened_against_plain_eigenvectors(spark):
    draw = np.random.default_rng(2)
    x = draw.standard_normal((900, 20)) * np.linspace(0.2, 3, 20)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000 + i, x[7].tolist()) for i in range(300)] + [(3, x[3].tolist()), (None, x[4].tolist())]
    odd = [(9000, None), (9001, [None] + [1.0] * 19), (9002, [float("nan")] * 20), (9003, [float("inf")] * 20), (9004, [])]
    table = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows + odd], SCHEMA).repartition(6)
    compare(spectra.whitened(table).collect(), rows)


def test_signs_are_the_same_for_all_rows(spark):
    draw = np.random.default_rng(3)
    x = draw.standard_normal((300, 5)) * [5, 4, 3, 2, 1]
    table = spark.createDataFrame([(i, v.tolist(), 1, 2, "x") for i, v in enumerate(x)], SCHEMA).repartition(4)
    white = np.zeros((300, 5))
    for r in spectra.whitened(table).collect():
        white[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(white.T @ white / 300 - np.eye(5)).max() < 1e-9


def test_whitened_of_odd_tables(spark):
    make = lambda *rows: spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)
    assert spectra.whitened(make().limit(0)).count() == 0
    assert spectra.whitened(make((1, None), (2, []))).count() == 0
    assert spectra.whitened(make((1, [1.0, 2.0]), (2, [1.0, 2.0]))).count() == 0
    mixed = spectra.whitened(make((1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [1.0]), (4, [9.0]))).collect()
    assert sorted((r.vec_id, r.component, r.n, round(abs(r.whitened), 9), r.explained) for r in mixed) == [(i, 1, 2, 1.0, 1.0) for i in (1, 2, 3, 4)]
    huge = spectra.whitened(make((1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 1.0]))).collect()
    assert {r.deviation for r in huge if r.vec_id != 3} == {None} and all(math.isfinite(r.whitened) for r in huge)


def test_query_against_plain_eigenvectors(spark):
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in common.table(spark, SF_DIR, "embeddings").collect()]
    found = queries.op12_rank_one_whitening(spark, SF_DIR)
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    compare(found.collect(), rows)

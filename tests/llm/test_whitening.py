"""Whitening against numpy on the whole fit list."""

import numpy as np
import pytest

from eventflow.llm import queries as Q
from eventflow.llm import whitening
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>"


def brute(vectors):
    """(n, deviations, eigenvalues, components, projections) by numpy's own solver."""
    x = np.floor(64 * np.asarray(vectors, float)).astype(object) + 1_000_000
    x = np.array([[int(v) for v in r] for r in x], dtype=object)
    fit = np.unique(x.astype(np.int64), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    deviation = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(r, s)) for r in x]
    centred = fit - s / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1], q[:, ::-1]
    return n, deviation, e, q, (x.astype(float) - s / n) @ q / np.sqrt(np.maximum(e, 1e-300))


def compare(rows, ids, vectors, many):
    n, deviation, e, q, white = brute(vectors)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert sorted(got) == sorted(set(ids))
    for i, d, w in zip(ids, deviation, white):
        assert sorted(got[i]) == list(range(1, many + 1))
        for c, rs in got[i].items():
            assert len(rs) == ids.count(i)
            for r in rs:
                assert (r.n, r.deviation) == (n, d)
                assert r.explained == pytest.approx(e[c - 1] / e.sum(), rel=1e-10)
                assert abs(r.whitened) == pytest.approx(abs(w[c - 1]), abs=1e-7)
                assert r.identity_error < 1e-9
    first = [got[i][1][0].whitened / w[0] for i, w in zip(ids, white) if abs(w[0]) > 1e-3]
    assert np.allclose(first, first[0])  # one sign for all rows


def test_query(spark):
    rows = Q.op12_embedding_whitening(spark, SF_SMALL).collect()
    src = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    compare(rows, [r.vec_id for r in src], [r.embedding for r in src], 16)


def test_repeats_count_once_and_low_rank(spark):
    rng = np.random.RandomState(3)
    base = rng.standard_normal((40, 3)).round(1)
    vectors = np.hstack([base, base[:, :1], np.full((40, 1), 0.5)])  # rank 3 of 5
    ids = list(range(40)) + [7, 7, 100]
    vectors = np.vstack([vectors, vectors[7], vectors[7], vectors[3]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], SCHEMA)
    compare(whitening.whiten(df).collect(), ids, vectors, 3)


def test_rows_left_out(spark):
    nan, inf = float("nan"), float("inf")
    ok = [(i, [float(i), float(i * i % 7)]) for i in range(9)]
    out = [(90, None), (91, []), (92, [None, 1.0]), (93, [nan, 1.0]), (94, [inf, 1.0]), (95, [1e200, 1.0]),
           (96, [1.0, 2.0, 3.0]), (None, [5.0, 5.0])]
    got = whitening.whiten(spark.createDataFrame(ok + out, SCHEMA)).collect()
    assert {r.vec_id for r in got} == {None, *range(9)} and {r.n for r in got} == {10}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                                                "identity_error"]


def test_exact_deviation_beyond_a_long():
    x = np.array([[1 << 40, 0], [5, 3]])
    n, s = 1 << 20, [1 << 22, 0]
    assert whitening._deviation(x, s, n).to_pylist() == [None, (5 * n - s[0]) ** 2 + (3 * n) ** 2]


@pytest.mark.parametrize("dim,rank,full", [(40, 40, 256), (40, 25, 256), (60, 60, 20), (60, 9, 20)])
def test_bidiagonalisation(monkeypatch, dim, rank, full):
    """Singular values and vectors of a matrix, with early stops and with what is left over."""
    monkeypatch.setattr(whitening, "FULL", full)
    rng = np.random.RandomState(dim + rank)
    x = rng.standard_normal((300, rank)) * np.linspace(5, 1, rank) @ np.linalg.qr(rng.standard_normal((dim, rank)))[0].T
    s, q = whitening.bidiagonalise(lambda v: (x @ v) @ x, dim, dim, 8)
    u, want, v = np.linalg.svd(x)
    assert s[:8] == pytest.approx(want[:8], rel=1e-12)
    assert np.abs(np.abs((q[:8] * v[:8]).sum(axis=1)) - 1).max() < 1e-10


@pytest.mark.parametrize("full", [256, 4])
def test_repeated_deviations_are_all_found(monkeypatch, full):
    monkeypatch.setattr(whitening, "FULL", full)
    x = np.vstack([np.eye(12), -np.eye(12)]) * np.array([3.0] * 5 + [2.0] * 4 + [1.0] * 3)
    s, q = whitening.bidiagonalise(lambda v: (x @ v) @ x, 12, 12, 4)
    assert s[:4] == pytest.approx([3 * 2 ** 0.5] * 4)
    assert np.abs(q[:4] @ q[:4].T - np.eye(4)).max() < 1e-12

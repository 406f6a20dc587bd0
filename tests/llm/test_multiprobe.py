"""Multiprobe search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.llm import multiprobe
from eventflow.llm import queries as Q
from tests.conftest import SF_CHECK

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, nearest=20, every=20):
    """(query, rank, vec_id, score) of every row whose id ``every`` divides."""
    ok = [(i, np.asarray(v, float)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i is None or i % every:
            continue
        near = sorted(((-math.fsum(q * v), j is None, j or 0) for b, (j, v) in enumerate(ok) if b != a and len(v) == len(q)))
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(near[:nearest])]
    return out


def recall(got, want):
    """The share of the true scores reached, rank by rank."""
    best = {}
    for q, r, v, s in got:
        best.setdefault(q, []).append(s)
    hit = sum(any(abs(s - x) < 1e-9 for x in best.get(q, ())) for q, _, _, s in want)
    return hit / len(want)


def run(spark, rows, every=20, **options):
    df = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v])
                                for i, v in rows], SCHEMA)
    return [tuple(r) for r in multiprobe.search(df, F.col("vec_id") % every == 0, **options).collect()]


def valid(got, rows):
    """Scores are the measure itself, and ranks follow score and id."""
    at = {}
    for q, r, v, s in got:
        at.setdefault(q, []).append((r, v, s))
    vec = {i: np.asarray(v, float) for i, v in rows}
    for q, found in at.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        assert len({v for _, v, _ in found}) == len(found) and q not in {v for _, v, _ in found}
        for _, v, s in found:
            assert s == pytest.approx(math.fsum(vec[q] * vec[v]), rel=1e-12, abs=1e-12)


def test_query(spark):
    got = [tuple(r) for r in Q.op11_nearest_neighbours(spark, SF_CHECK).collect()]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").collect()]
    want = brute(rows)
    assert len(got) == len(want) and recall(got, want) >= 0.9
    valid(got, rows)


@pytest.mark.parametrize("kind", ["random", "clusters", "norms", "cone"])
def test_recall(spark, monkeypatch, kind):
    """Many small buckets, tasks of a few rows, and queries dealt to copies."""
    monkeypatch.setattr(multiprobe, "PER_BUCKET", 16)
    monkeypatch.setattr(multiprobe, "PART_ROWS", 200)
    monkeypatch.setattr(multiprobe, "QUERIES_AT_ONCE", 40)
    monkeypatch.setattr(multiprobe, "SAMPLE", 64)
    rng = np.random.RandomState(5)
    x = rng.standard_normal((3000, 24))
    if kind == "clusters":
        x = rng.standard_normal((60, 24))[rng.randint(0, 60, 3000)] + 0.05 * x
    if kind == "norms":
        x *= np.exp(rng.standard_normal((3000, 1)) * 1.5)
    if kind == "cone":
        x = 5 + 0.3 * x
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = run(spark, rows), brute(rows)
    assert len(got) == len(want) and recall(got, want) >= 0.93
    valid(got, rows)


def test_ties_repeats_and_rows_left_out(spark):
    nan = float("nan")
    same = [(i, [1.0, 2.0]) for i in range(100, 0, -1)]
    rows = same + [(0, [1.0, 2.0]), (200, [3.0, 0.0]), (200, [3.0, 0.0]), (None, [9.0, 9.0]), (220, [0.0, 0.0]), (240, None),
                   (260, [nan, 1.0]), (280, [None, 1.0]), (300, []), (320, [1.0, 2.0, 3.0]), (340, [-1.0, 0.5, 0.0])]
    key = lambda t: (t[0], t[1], t[2] is None, t[2] or 0, t[3])
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("rows", [[], [(20, [1.0, 0.0])], [(1, [1.0, 0.0]), (2, None)]])
def test_nothing_to_find(spark, rows):
    assert run(spark, rows) == []


def test_probes_follow_the_estimated_success():
    """Chances fall in the order of visits, reach the wanted sum, and agree with a simulation."""
    rng = np.random.RandomState(1)
    places, spread = rng.uniform(0, 3, 5), 0.6
    slots = multiprobe.probes(places, spread, 0.9, None)
    assert len(np.unique(slots, axis=0)) == len(slots) and (slots[0] == np.floor(places)).sum() >= 3
    drawn = np.floor(places + spread * rng.standard_normal((200_000, 5))).astype(int)
    count = {}
    for row in map(tuple, drawn):
        count[row] = count.get(row, 0) + 1
    chance = [count.get(tuple(s), 0) / len(drawn) for s in slots]
    assert 0.89 < sum(chance) < 0.92
    assert all(a > b - 0.004 for a, b in zip(chance, chance[1:]))
    assert multiprobe.probes(places, spread, 0.9, 7).tolist() == slots[:7].tolist()

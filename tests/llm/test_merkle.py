"""The Merkle manifest against a plain tree in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from eventflow.llm import merkle
from eventflow.llm import queries as Q
from eventflow.plans.oracle_check import compare, duckdb_con
from tests.conftest import SF_SMALL
from tests.llm import tables as X


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves):
    """(root, paths): a path is a list of (before, after)."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for leaf, i in enumerate(at):
            run, slot = runs[i // 3], i % 3
            paths[leaf].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[leaf] = i // 3
        level = [h("".join(run)) for run in runs]
    return level[0], paths


def brute(rows):
    """rows of (id, source, leaf) -> sorted (id, leaf, subroot, root, path)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        done[s] = tree([r[2] for r in groups[s]])
    root, above = tree([done[s][0] for s in names]) if names else (None, [])
    return sorted(((r[0], r[2], done[s][0], root, path + above[i]) for i, s in enumerate(names)
                   for r, path in zip(groups[s], done[s][1])), key=repr)


def got(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string")
    return sorted(((r.doc_id, r.leaf, r.merkle.subroot, r.merkle.root, [tuple(p) for p in r.merkle.path])
                   for r in merkle.manifest(df).collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 7])
@pytest.mark.parametrize("sizes", [(1,), (10, 1, 3), (28, 9, 1, 5, 2)])
def test_trees(spark, monkeypatch, levels, sizes):
    """Small blocks make the tops of blocks climb through several rounds."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rng = random.Random(repr(sizes))
    rows = [(rng.randrange(50), f"s{g}" if g else None, h(f"{g},{i}")) for g, n in enumerate(sizes) for i in range(n)]
    rng.shuffle(rows)
    assert got(spark, rows) == brute(rows)


def test_ties_repeats_nulls_and_empty(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rows = [(1, "a", h("x"))] * 7 + [(1, "a", h("y")), (None, "a", h("z")), (None, None, h("z")), (2, "", h("e")),
            (3, "é", h("e")), (3, "z", h("e"))]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_clashing_names(spark):
    d = X.clashing(X.docs(spark)).withColumn("leaf", F.sha2(F.coalesce("text", F.lit("")), 256))
    d = d.withColumn("merkle", F.lit(1)).withColumn("_g", F.lit(2)).withColumn("_at", F.lit(3))
    out = merkle.manifest(d)
    assert out.columns == [*d.columns, "merkle_"]
    rows = out.select("doc_id", "_g", "_at", "merkle", "merkle_.*").collect()
    assert len(rows) == len(X.ROWS) and {(r._g, r._at, r.merkle) for r in rows} == {(2, 3, 1)}
    assert len({r.root for r in rows}) == 1


def test_query_by_hand(spark, tmp_path):
    """Leaf bytes, tampering by checksum and verification, on the awkward table."""
    rows = [*X.ROWS, (13, "a\nb", "en", "a", 1), (14, "a\nb", "en", "a", 1), (None, "c\nd", None, None, None)]
    got = sorted(((r.doc_id, r.leaf, r.root, r.verified) for r in Q.op13_merkle_manifest(
        spark, X.write(spark, tmp_path, rows)).collect()), key=repr)

    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return h("".join(map(part, (r[0], r[3], r[2], r[4], text))))

    root = brute([(r[0], r[3], leaf(r, r[1])) for r in rows])[0][3]
    hit = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and "\n" in (r[1] or "") for r in rows]
    assert any(hit) and not all(hit)
    assert got == sorted(((r[0], leaf(r, r[1]), root, not x) for r, x in zip(rows, hit)), key=repr)


def test_query_matches_sql(spark):
    got = Q.QUERIES["op13_merkle_manifest"](spark, SF_SMALL).toPandas()
    ok, msg = compare(got, duckdb_con(SF_SMALL).execute(Q.ORACLES["op13_merkle_manifest"]).df())
    assert ok, msg

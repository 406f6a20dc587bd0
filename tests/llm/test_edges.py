"""Every operator on the awkward table, with clashing columns, and on an empty one."""

import public_tokenizers
import pytest

from eventflow.llm import bpe, dartminhash, mixing, pii, pivots, quality, secrets, tokens, toxicity, warc
from tests.llm import tables as X

JSON, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{k}") for k in ("json", "tiktoken"))

KEEPERS = {
    "quality": lambda d, l: quality.judge(d, l),
    "mixing": lambda d, l: mixing.mix(d),
    "secrets": lambda d, l: secrets.scan(d),
    "tokens": lambda d, l: tokens.count_tokens(d.withColumn("n_tokens", d.doc_id), JSON).drop("n_tokens"),
    "bpe": lambda d, l: (lambda c: bpe.decode(c, RANKS, ids=c.columns[-1]))(bpe.encode(d, RANKS)),
    "toxicity": lambda d, l: toxicity.score(d, l),
    "sanitise": lambda d, l: pii.sanitise(d),
}


@pytest.mark.parametrize("name", KEEPERS)
def test_rows_and_columns_stay(spark, name):
    d = X.clashing(X.docs(spark))
    got = KEEPERS[name](d, X.labels(spark))
    assert got.columns[:len(d.columns)] == d.columns
    own = [c for c in d.columns if not (name == "sanitise" and c == "text")]
    def rows(df):
        return sorted(map(repr, df.select(*[f"`{c}`" for c in own]).collect()))
    assert rows(got) == rows(d)


@pytest.mark.parametrize("name", KEEPERS)
def test_empty_table(spark, name):
    got = KEEPERS[name](X.docs(spark, []), X.labels(spark, []))
    assert got.count() == 0


def test_labels_may_be_empty(spark):
    d = X.docs(spark)
    assert quality.judge(d, X.labels(spark, [])).where("verdict.kept and verdict.base_failed").count() == 0
    scores = {r.score for r in toxicity.score(d, X.labels(spark, [])).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_minhash_edges(spark):
    d = X.clashing(X.docs(spark))
    got = {(r.doc_id, r.class_id, r.kept) for r in dartminhash.classes(d).collect()}
    assert {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 5, True), (6, 6, True),
            (None, None, True), (10, 10, True)} <= got
    kept = dartminhash.deduplicate(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    assert dartminhash.classes(X.docs(spark, [])).count() == 0
    assert dartminhash.deduplicate(X.docs(spark, [])).count() == 0


def test_near_copies_with_null_or_shared_ids(spark):
    """One document stays of each class, whatever the ids."""
    rows = [(None, X.BASE, "en", "a", 1), (None, X.NEAR, "en", "a", 1), (None, X.BASE, "en", "a", 1)]
    assert dartminhash.deduplicate(X.docs(spark, rows)).count() == 1
    other = " ".join(f"z{i}" for i in range(60))
    rows = [(7, X.BASE, "en", "a", 1), (7, X.NEAR, "en", "a", 1), (7, other, "en", "a", 1), (3, other + " z60", "en", "a", 1)]
    got = dartminhash.classes(X.docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == [(3, 3), (7, 3), (7, 7), (7, 7)]
    assert sum(r.kept for r in got) == 2
    assert sorted(r.doc_id for r in dartminhash.deduplicate(X.docs(spark, rows)).collect()) == [3, 7]


def test_pivot_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (2, [1.0, 0.01], 0), (3, [1.0, 0.0], 1), (4, [0.0, 0.0], 0),
            (5, [nan, 1.0], 0), (6, [inf, 1.0], 0), (7, [None, 1.0], 0), (8, None, 0), (9, [1.0, 0.0], None),
            (10, [], 0), (11, [1.0, 0.0, 0.0], 0), (None, [2.0, 0.0], 0), (12, [-1.0, 0.0], 0), (13, [1e300, 1e298], 0)]
    got = pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in got.collect()))
    assert got == [(0, 4, 1, False), (1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False),
                   *[(i, 0, i, True) for i in range(3, 13)], (13, 4, 1, False)]
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert pivots.near_duplicates(empty).count() == 0


def test_warc_edges(spark):
    rows = [(3, "u", "a"), (1, "u\n", "a"), (2, None, "a"), (5, "x", None), (4, "x", ""), (None, "q", "a"),
            (1, "u", "a"), (6, "é", "ü" * 9_000_000)]
    pages = X.clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = warc.read_archives(warc.write_archives(pages)).collect()
    kinds = sorted((r.record_id.split(":")[2], r.record_type, (r.refers_to or "").split(":")[-1], r.payload_bytes)
                   for r in got)
    assert kinds == [("1", "response", "", 1), ("1", "response", "", 1), ("2", "revisit", "1", 1),
                     ("3", "revisit", "1", 1), ("4", "response", "", 0), ("5", "revisit", "4", 0),
                     ("6", "response", "", 18_000_000), ("null", "response", "", 1)]
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0
    assert warc.write_archives(pages, min_revisit_bytes=2).count() > 0

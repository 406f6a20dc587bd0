"""Sliding sums by differences against plain expansion."""

import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from eventflow.operators import windows as W


def rows(spark, n=400):
    rng = random.Random(6)
    data = [(i, rng.choice(("hot", "hot", "cold", None)), 1_700_000_000 + rng.choice((rng.randrange(40_000), 500_000 + rng.randrange(600))),
             rng.choice((None, rng.randrange(-5, 9)))) for i in range(n)]
    df = spark.createDataFrame(data, "i long, k string, s long, v long")
    return df.select("i", "k", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "v",
                     F.col("v").cast("decimal(10,2)").alias("d"), (F.col("v") * 0.1).alias("x"))


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("size,slide", [("1 hour", "10 minutes"), ("7 minutes", "1 minute"), ("1 hour", "1 hour"), ("10 minutes", "4 minutes")])
def test_equals_expansion(spark, keys, size, slide):
    df = rows(spark)
    got = W.sliding_agg(df, "ts", size, slide, keys, {"sv": "v", "sd": "d"}, "n")
    want = W.window_agg(df, "ts", size, keys, [F.count(F.lit(1)).alias("n"), F.sum("v").alias("sv"), F.sum("d").alias("sd")], slide)
    cols = ["window_start", "window_end", *keys, "n", "sv", "sd"]
    assert dict(got.dtypes) == {**dict(want.dtypes)} and got.columns == cols
    assert sorted(map(repr, got.select(*cols).collect())) == sorted(map(repr, want.select(*cols).collect()))


def test_doubles_are_added_from_copies(spark):
    df = rows(spark)
    got = W.sliding_agg(df, "ts", "1 hour", "10 minutes", ["k"], {"sx": "x"}, None)
    assert "_c" not in got._jdf.queryExecution().optimizedPlan().toString().split("Project")[0]
    want = {(r.k, r.window_end): r.sx for r in W.window_agg(df, "ts", "1 hour", ["k"], [F.sum("x").alias("sx")], "10 minutes").collect()}
    have = {(r.k, r.window_end): r.sx for r in got.collect()}
    assert have.keys() == want.keys()
    assert all((a is None) == (want[w] is None) and (a is None or abs(a - want[w]) < 1e-9) for w, a in have.items())


def test_two_rows_a_pane(spark, monkeypatch):
    """After the panes there are a gain and a loss of each, whatever the ratio of size to slide."""
    seen = {}
    plain = W._by_differences

    def spy(panes, *rest):
        seen["panes"] = panes.count()
        inner = []
        explode = F.explode
        monkeypatch.setattr(W.F, "explode", lambda c: inner.append(c) or explode(c))
        out = plain(panes, *rest)
        monkeypatch.setattr(W.F, "explode", explode)
        seen["rows"] = panes.select(explode(inner[0])).count()  # the first: gains and losses
        return out

    monkeypatch.setattr(W, "_by_differences", spy)
    df = rows(spark)
    W.sliding_agg(df, "ts", "1 hour", "1 minute", ["k"], {}, "n").collect()
    assert seen["panes"] == df.groupBy(F.window("ts", "1 minute").start, "k").count().count()
    changes = seen["rows"]
    assert changes == 2 * seen["panes"]


def texts(spark, n=300):
    """Texts at seconds before and after the epoch, some seconds often, some empty, with nulls in both columns."""
    rng = random.Random(9)
    data = [(rng.choice((None, -70, 0, 63, rng.randrange(-200, 200), 5000 + rng.randrange(9))),
             rng.choice((None, "", " ".join(rng.choices("a b cd e  é".split(" "), k=rng.randrange(1, 30))))))
            for _ in range(n)]
    df = spark.createDataFrame(data, "s long, text string")
    return df.select(F.timestamp_seconds("s").cast("timestamp_ntz").alias("at"), "text")


def words(rows, keep):
    return rows.select(*keep, F.explode(F.split("text", " ")).alias("word"))


@pytest.mark.parametrize("part_bytes", [8 << 20, 150, 1])  # no block heavy, some, all but those without text
@pytest.mark.parametrize("size,slide", [("5 seconds", "1 second"), ("1 minute", "20 seconds"), ("2 seconds", "1 second"), ("5 seconds", "2 seconds")])
def test_counts_of_rows_moved_before_they_are_expanded(spark, size, slide, part_bytes):
    df = texts(spark)
    got = W.sliding_counts_of(df, "at", size, slide, ["word"], words, F.octet_length("text"), "n", part_bytes)
    want = W.window_agg(words(df, ("at",)), "at", size, ["word"], [F.count(F.lit(1)).alias("n")], slide)
    cols = ["window_start", "window_end", "word", "n"]
    assert dict(got.dtypes) == dict(want.dtypes) and got.columns == cols
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*cols).collect()))


def test_counts_of_no_rows(spark):
    got = W.sliding_counts_of(texts(spark).limit(0), "at", "5 seconds", "1 second", ["word"], words, F.octet_length("text"))
    assert got.collect() == []


@pytest.fixture()
def static(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", old)


def test_sliding_word_count_moves_texts_once(static, tmp):
    """One exchange, of the texts; the words and their counts stay where they are made."""
    data = [(i, f"one two {i % 7}\nthree") for i in range(200)]
    static.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    plan = queries()["e5_sliding_word_count"](static, tmp)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "split(" not in plan[plan.index("Exchange"):]


def test_panes_move_before_gains_and_losses_are_made(static):
    plan = W.sliding_agg(rows(static), "ts", "1 hour", "10 minutes", ["k"], {"sv": "v"}, "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2
    assert plan.rindex("Generate") < plan.index("Exchange")

"""Co-partitioned ranking rounds."""

import random

import pytest
from pyspark.sql import functions as F

from eventflow.operators import graph as G
from eventflow.plans import graphs
from tests.conftest import SF_SMALL


def brute(n, links, rounds, eps):
    ranks = {i: 1.0 / n for i in range(n)}
    deg = {}
    for s, _ in links:
        deg[s] = deg.get(s, 0) + 1
    for _ in range(rounds):
        new = {}
        for s, d in links:
            if s in ranks:
                new[d] = new.get(d, 0.0) + ranks[s] / deg[s]
        new = {p: r * 0.85 + 0.15 / n for p, r in new.items()}
        moved = any(p in ranks and abs(new[p] - ranks[p]) > eps for p in new)
        ranks = new
        if not moved:
            break
    return ranks


@pytest.mark.parametrize("hot_links,eps", [(1_000_000, 0.0), (3, 0.0), (10, 1e-3)])
def test_ranks_with_hot_sources(spark, hot_links, eps):
    """Repeated links, sources above the limit salted, and an early stop."""
    rng = random.Random(3)
    links = [(rng.choice((0, 0, rng.randrange(40))), rng.randrange(40)) for _ in range(300)]
    edges = spark.createDataFrame(links, "src long, dst long")
    pages = spark.range(40).withColumnRenamed("id", "page_id")
    got = {r.page_id: r.rank for r in G.page_rank(pages, edges, 40, 6, eps, hot_links=hot_links).collect()}
    want = brute(40, links, 6, eps)
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-12 for p in want)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("eventflow_")]


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_round_has_one_exchange(spark, no_broadcast):
    edges = spark.range(5000).select((F.col("id") % 97).alias("src"), (F.col("id") * 31 % 101).alias("dst"))
    links, _ = G._links(edges, G.HOT_LINKS)
    store = G._Buckets(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    links = store.write(links.select("src", "dst", "n", "out_degree"), "src")[0]
    ranks = store.write(spark.range(101).select(F.col("id").alias("page_id"), F.lit(0.01).alias("rank")), "page_id")[0]
    plan = G._round(links, None, ranks, 101, 0.0, 0.85)._jdf.queryExecution().executedPlan().toString()
    store.close()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(dst" in plan, plan
    assert "explode" not in plan.lower()


def test_self_join_runs_once(spark, no_broadcast):
    """J5 and J6: the line items are joined once for the links and their degrees."""
    d = G.edges_with_degree(graphs.edges(spark, SF_SMALL))
    assert "lineitem" not in d._jdf.queryExecution().optimizedPlan().toString()
    assert all("lineitem" not in f for f in d.inputFiles())

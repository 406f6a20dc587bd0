"""Registered graph queries (O-S2, O-A4, O-J5, O-J6, O-E3).

Graph: parts are pages; a link goes from the part on one line item to the
part on the next line item of the same order (an equi-join on
(order, line number + 1): at most one partner per row, no pairs per order).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventflow.operators import graph as G
from eventflow.plans.common import table
from eventflow.plans.registry import register
from eventflow.sources import files as S

# The reference's ranking parameters.
MAX_ITERATIONS = 10
EPSILON = 1e-4
RANK_DIGITS = 10

_EDGES_SQL = """e AS (SELECT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b
        ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1),
deg AS (SELECT src, count(*) AS d FROM e GROUP BY src),
ed AS (SELECT e.src, e.dst, deg.d FROM e JOIN deg USING (src)),
n AS (SELECT count(*) AS n FROM part)"""


def edges(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    a, b = li.alias("a"), li.alias("b")
    return (a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey"))
                   & (F.col("b.l_linenumber") == F.col("a.l_linenumber") + 1))
             .select(F.col("a.l_partkey").alias("src"), F.col("b.l_partkey").alias("dst")))


def pages(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("page_id"))


@register("s2_sequence", """
SELECT range AS page_id FROM range((SELECT min(p_partkey) FROM part), (SELECT max(p_partkey) FROM part) + 1)""")
def s2_sequence(spark, sf):
    """O-S2: bounded number sequence over the page-id range (``spark.range``)."""
    b = table(spark, sf, "part").agg(F.min("p_partkey"), F.max("p_partkey")).first()
    return S.number_sequence(spark, int(b[0]), int(b[1]), "page_id")


MAX_LIST = 10_000


@register("a4_adjacency_lists", f"""WITH {_EDGES_SQL}
SELECT src, CAST((rn - 1) // {MAX_LIST} AS BIGINT) AS chunk,
       string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS targets
FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS rn FROM e)
GROUP BY src, chunk""")
def a4_adjacency_lists(spark, sf):
    """O-A4: group reduce to a sorted target list per source (duplicates
    kept), in chunks of at most 10,000 targets; the list is shown as text."""
    d = G.adjacency_lists(edges(spark, sf), max_list=MAX_LIST)
    return d.select("src", "chunk", F.array_join("targets", ",").alias("targets"))


@register("j5_spread_ranks", f"""WITH {_EDGES_SQL}
SELECT ed.dst AS page_id, round((1.0 / (SELECT n FROM n)) / ed.d, {RANK_DIGITS}) AS rank
FROM part JOIN ed ON part.p_partkey = ed.src""")
def j5_spread_ranks(spark, sf):
    """O-J5: equi-join of the initial ranks with out-links, one row per link."""
    n = table(spark, sf, "part").count()
    ranks = pages(spark, sf).withColumn("rank", F.lit(1.0 / n))
    d = G.spread_ranks(ranks, G.edges_with_degree(edges(spark, sf)))
    return d.select("page_id", F.round("rank", RANK_DIGITS).alias("rank"))


@register("j6_changed_ranks", f"""WITH {_EDGES_SQL},
r1 AS (SELECT ed.dst AS page_id, sum((1.0 / (SELECT n FROM n)) / ed.d) * 0.85 + 0.15 / (SELECT n FROM n) AS rank
       FROM part JOIN ed ON part.p_partkey = ed.src GROUP BY ed.dst)
SELECT page_id FROM r1 WHERE abs(rank - 1.0 / (SELECT n FROM n)) > {EPSILON}""")
def j6_changed_ranks(spark, sf):
    """O-J6: pages whose rank moved by more than epsilon in the first round."""
    n = table(spark, sf, "part").count()
    ranks = pages(spark, sf).withColumn("rank", F.lit(1.0 / n))
    new = G.rank_step(ranks, G.edges_with_degree(edges(spark, sf)), n)
    return G.changed_ranks(ranks, new, EPSILON)


@register("e3_page_rank", f"""WITH RECURSIVE {_EDGES_SQL},
pr(it, page_id, rank) AS (
  SELECT 0, p_partkey, 1.0 / (SELECT n FROM n) FROM part
  UNION ALL
  SELECT it + 1, ed.dst, sum(pr.rank / ed.d) * 0.85 + 0.15 / (SELECT n FROM n)
  FROM pr JOIN ed ON pr.page_id = ed.src WHERE it < {MAX_ITERATIONS} GROUP BY it, ed.dst)
SELECT page_id, round(rank, {RANK_DIGITS}) AS rank FROM pr WHERE it = {MAX_ITERATIONS}""")
def e3_page_rank(spark, sf):
    """O-E3: page ranking, 10 rounds (epsilon 0 here so that the oracle's
    fixed-round recursion applies; the epsilon stop is unit-tested)."""
    n = table(spark, sf, "part").count()
    r = G.page_rank(pages(spark, sf), edges(spark, sf), n, MAX_ITERATIONS, epsilon=0.0)
    return r.select("page_id", F.round("rank", RANK_DIGITS).alias("rank"))

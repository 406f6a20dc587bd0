"""Iterative graph ranking (O-E3) with its pieces O-A4, O-J5, O-J6.

Links are counted, given the out-degree of their source, and written once as a table bucketed and
sorted by source. The ranks of each round are written into the same buckets. A round then joins
bucket with bucket, without moving either side, and shuffles the contributions alone, combined by
target before they move; the comparison with the last ranks needs no exchange either. Links of sources
with more than ``HOT_LINKS`` of them stay outside the buckets, dealt out by a salt, and only the ranks of
those sources are repeated, once for each salt. No adjacency array is made per vertex. Lineage is cut by
the written ranks, in the session's checkpoint folder; the convergence probe is one small
action per round.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.operators.scan import scan
from eventflow.session import materialize, scratch_path

DAMPING = 0.85
HOT_LINKS = 1_000_000


def adjacency_lists(edges: DataFrame, src: str = "src", dst: str = "dst",
                    max_list: int = 10_000, bucket_width: int = 1 << 16) -> DataFrame:
    """O-A4: group reduce to the sorted target list of each source, duplicates
    kept, as (src, chunk, targets) rows of at most ``max_list`` targets: list rows of a
    documented width, so that no row or task has to hold an unbounded list.

    A target's position inside its source comes from the bucketed scan (buckets of
    target ids) over distinct links with their numbers, not from a per-source sort.
    Ranking does not need these lists; it uses ``edges_with_degree``."""
    # Equal links are counted first and take consecutive positions.
    e = edges.groupBy(src, dst).agg(F.count(F.lit(1)).alias("_n"))
    e = scan(e, [("_n", "sum", "_end")], [dst], F.floor(F.col(dst) / F.lit(bucket_width)), (src,))
    place = F.explode(F.sequence(F.col("_end") - F.col("_n"), F.col("_end") - 1))
    e = e.select(src, dst, place.alias("_pos"))
    chunk = F.floor(F.col("_pos") / F.lit(max_list)).cast("bigint")
    return (e.groupBy(src, chunk.alias("chunk"))
             .agg(F.array_sort(F.collect_list(dst)).alias("targets")))


def edges_with_degree(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """The links with the out-degree of their source. They are written once, so that what makes
    them runs once for the links and their degrees."""
    edges = materialize(edges.select(src, dst), keep_partitioning=False)
    deg = edges.groupBy(src).agg(F.count(F.lit(1)).alias("out_degree"))
    return edges.select(src, dst).join(deg, src)


def spread_ranks(ranks: DataFrame, edges_deg: DataFrame) -> DataFrame:
    """O-J5: equi join of ranks with out-links, one output per link:
    (target, rank / out_degree)."""
    return (ranks.join(edges_deg, ranks["page_id"] == edges_deg["src"])
                 .select(F.col("dst").alias("page_id"),
                         (F.col("rank") / F.col("out_degree")).alias("rank")))


def rank_step(ranks: DataFrame, edges_deg: DataFrame, n_pages: int,
              damping: float = DAMPING) -> DataFrame:
    contrib = spread_ranks(ranks, edges_deg)
    return (contrib.groupBy("page_id").agg(F.sum("rank").alias("rank"))
                   .select("page_id", (F.col("rank") * F.lit(damping)
                                       + F.lit((1 - damping) / n_pages)).alias("rank")))


def changed_ranks(old: DataFrame, new: DataFrame, epsilon: float) -> DataFrame:
    """O-J6: one row per page whose rank moved by more than ``epsilon``."""
    return (old.alias("o").join(new.alias("n"), "page_id")
               .filter(F.abs(F.col("o.rank") - F.col("n.rank")) > F.lit(epsilon))
               .select("page_id"))


class _Buckets:
    """Tables bucketed and sorted by one column, under names of their own, in the checkpoint
    folder. They leave the catalog with ``close``; the files stay for who reads them."""

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets, self.names = spark, buckets, []

    def write(self, df: DataFrame, column: str) -> tuple[DataFrame, str]:
        name, path = f"eventflow_{uuid.uuid4().hex}", scratch_path(self.spark, "buckets")
        self.names.append(name)
        (df.write.format("parquet").bucketBy(self.buckets, column).sortBy(column).option("path", path)
         .saveAsTable(name))
        return self.spark.table(name), path

    def close(self) -> None:
        for n in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {n}")
        self.names = []


def _links(edges: DataFrame, hot_links: int) -> tuple[DataFrame, DataFrame]:
    """(links with n and out_degree, sources with more than ``hot_links`` distinct links and the number
    of their salts); the edges are made once."""
    links = materialize(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")), keep_partitioning=False)
    deg = links.groupBy("src").agg(F.sum("n").alias("out_degree"), F.count(F.lit(1)).alias("_links"))
    links = links.join(deg, "src")
    hot = deg.where(F.col("_links") > hot_links).select(
        "src", F.ceil(F.col("_links") / F.lit(hot_links)).cast("int").alias("salts"))
    return links, materialize(hot, keep_partitioning=False)


def _round(links: DataFrame, hot: tuple | None, ranks: DataFrame, n_pages: int, epsilon: float,
           damping: float) -> DataFrame:
    """(page_id, rank, _moved) after a round; one exchange, of the contributions."""
    share = (F.col("rank") * F.col("n") / F.col("out_degree")).alias("rank")
    got = links.join(ranks.withColumnRenamed("page_id", "src"), "src").select("dst", share)
    if hot is not None:
        salted, sources = hot
        spread = sources.join(ranks.withColumnRenamed("page_id", "src"), "src").select(
            "src", "rank", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        got = got.unionByName(salted.join(spread, ["src", "salt"]).select("dst", share))
    new = got.groupBy(F.col("dst").alias("page_id")).agg(F.sum("rank").alias("rank"))
    new = new.select("page_id", (F.col("rank") * F.lit(damping) + F.lit((1 - damping) / n_pages)).alias("rank"))
    moved = F.coalesce(F.abs(F.col("rank") - F.col("_old")) > F.lit(epsilon), F.lit(False))
    return new.join(ranks.withColumnRenamed("rank", "_old"), "page_id", "left").select(
        "page_id", "rank", moved.alias("_moved"))


def page_rank(pages: DataFrame, edges: DataFrame, n_pages: int | None = None,
              max_iterations: int = 10, epsilon: float = 1e-4,
              damping: float = DAMPING, hot_links: int = HOT_LINKS) -> DataFrame:
    """Rank pages: initial 1/N, ``rank' = d * sum(in-contributions) + (1-d)/N``.

    Pages without inbound links drop out (no dangling redistribution). Stops
    after ``max_iterations`` or when no page moved by more than ``epsilon``.
    ``pages`` has a ``page_id`` column; ``edges`` has ``src``, ``dst``. As many buckets as
    the session has shuffle partitions, so that a round's result falls into them as it is.
    """
    spark = edges.sparkSession
    if n_pages is None:
        n_pages = pages.count()
    links, sources = _links(edges, hot_links)
    store = _Buckets(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        hot = None
        if not sources.isEmpty():
            salt = F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int")
            own = links.join(sources, "src").withColumn("salt", salt).select("src", "salt", "dst", "n", "out_degree")
            hot = materialize(own, keep_partitioning=False), sources
            links = links.join(sources, "src", "left_anti")
        links = store.write(links.select("src", "dst", "n", "out_degree"), "src")[0]
        ranks, path = store.write(pages.select("page_id", F.lit(1.0 / n_pages).alias("rank")), "page_id")
        for _ in range(max_iterations):
            step, path = store.write(_round(links, hot, ranks, n_pages, epsilon, damping), "page_id")
            ranks = step.select("page_id", "rank")
            if step.filter("_moved").isEmpty():
                break
        schema = ranks.schema
    finally:
        store.close()
    return spark.read.schema(schema).parquet(path)

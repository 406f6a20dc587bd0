"""Parquet table access and the stream bindings used throughout.

Binding of the reference's record types onto the ``events`` table:
``id -> user_id``, ``temperature -> value``, ``timestamp -> ts``,
``itemId -> props.k``, ``behavior == 'pv' -> event_type == 'view'``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def item_id(props: str = "props"):
    """``props`` is a JSON object ``{"k": n}``; ``k`` is the item id."""
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def out_of_order(ev: DataFrame, jitter_seconds: int = 25200) -> DataFrame:
    """Out-of-order replay: arrival order is ``event_id``, event time is
    ``ts2 = ts + pmod(event_id * 7919, jitter)`` seconds."""
    return ev.withColumn(
        "ts2", F.col("ts") + F.make_dt_interval(
            secs=F.pmod(F.col("event_id") * 7919, F.lit(jitter_seconds)).cast("decimal(18,6)")))


TEXT_PARTITIONS_CONF = "spark.eventflow.text.partitions"


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A text-bearing table (documents, conversations) for tokenizing, in the splits of
    its files. Where files are few and cannot be split (a single row group),
    ``spark.eventflow.text.partitions`` deals the rows out to that many tasks."""
    df = table(spark, sf_dir, name)
    n = spark.conf.get(TEXT_PARTITIONS_CONF, None)
    return df.repartition(int(n)) if n else df

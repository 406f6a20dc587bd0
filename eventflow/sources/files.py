"""File and connector sources (O-S2, O-S3, O-S4, O-S5, O-S9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def number_sequence(spark: SparkSession, start: int, end: int, col: str = "id") -> DataFrame:
    """O-S2: bounded sequence ``start..end`` (inclusive), generated in
    parallel by ``spark.range``."""
    return spark.range(start, end + 1).withColumnRenamed("id", col)


def text_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """O-S3: one row (``value``) per text line; splittable across tasks."""
    if streaming:
        return spark.readStream.text(path)
    return spark.read.text(path)


def delimited(spark: SparkSession, path: str, schema: str, sep: str = " ",
              fields: list | None = None) -> DataFrame:
    """O-S4: delimited file with a fixed schema (no inference) and field
    selection (column pruning happens in the scan)."""
    df = spark.read.schema(schema).option("sep", sep).csv(path)
    return df.select(*fields) if fields else df


def kafka_options(servers: str, topic: str, start: str = "earliest",
                  group_id: str | None = None, fail_on_data_loss: bool = True) -> dict:
    """O-S5: Kafka source options. ``start`` is ``earliest`` or ``latest``;
    ``group`` resumes from the query's own checkpointed offsets (the
    checkpointLocation plays the role of committed group offsets) and starts
    at ``earliest`` the first time."""
    if start not in ("earliest", "latest", "group"):
        raise ValueError(f"unknown start position: {start}")
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": "earliest" if start == "group" else start,
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def kafka_stream(spark: SparkSession, servers: str, topic: str, start: str = "earliest",
                 group_id: str | None = None) -> DataFrame:
    """O-S5: Kafka stream as (key, value string, timestamp). Needs the
    spark-sql-kafka connector on the classpath."""
    r = spark.readStream.format("kafka")
    for k, v in kafka_options(servers, topic, start, group_id).items():
        r = r.option(k, v)
    return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"),
                           "timestamp")


def jdbc_query(spark: SparkSession, url: str, query: str, properties: dict | None = None,
               partition: dict | None = None) -> DataFrame:
    """O-S9: read a JDBC query result. ``partition`` (column, lowerBound,
    upperBound, numPartitions) splits the read across tasks. Re-reading on an
    interval is done per micro-batch inside ``foreachBatch``."""
    r = spark.read.format("jdbc").option("url", url)
    if partition:
        r = r.option("dbtable", f"({query}) q")
        for k, v in partition.items():
            r = r.option(k, v)
    else:
        r = r.option("query", query)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()

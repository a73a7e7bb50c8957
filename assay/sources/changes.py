"""The change stream of the ERP database: one envelope per row change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

ENVELOPE = T.StructType(
    [
        T.StructField("capture_offset", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)


def stream_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The topic from its first message. Progress lives in the query's checkpoint.

    A message is known by (topic, partition, capture_offset). Needs the Kafka connector
    on the classpath.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", True)
        .load()
        .selectExpr("topic", "partition", "offset AS capture_offset", "CAST(value AS STRING) AS value")
    )


def stream_landed(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same stream read from landed Parquet envelopes."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)

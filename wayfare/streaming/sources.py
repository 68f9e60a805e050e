"""Message streams. Every source yields the columns topic, key, value, offset and ts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.constants import ORDER_TOPICS
from wayfare.functions.times import EPOCH
from wayfare.schemas import MESSAGE


def kafka_options(servers: str, topics: Sequence[str] = tuple(ORDER_TOPICS), starting: str = "earliest",
                  max_offsets: int | None = None) -> dict[str, str]:
    """Options of the Kafka source.

    The checkpoint resumes a query; ``starting`` only applies to its first run. Offsets that aged
    out are skipped rather than failing the query.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics),
               "startingOffsets": starting, "failOnDataLoss": "false"}
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_messages(spark: SparkSession, servers: str, topics: Sequence[str] = tuple(ORDER_TOPICS),
                   starting: str = "earliest", max_offsets: int | None = None) -> DataFrame:
    """Several topics in one stream. Needs the Kafka connector on the class path."""
    raw = (spark.readStream.format("kafka")
           .options(**kafka_options(servers, topics, starting, max_offsets)).load())
    return raw.select("topic", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"), "offset",
                      F.timestamp_add("MICROSECOND", F.unix_micros("timestamp"), F.expr(EPOCH)).alias("ts"))


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages dropped as Parquet files into a folder."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files arriving in a folder, as column ``value``."""
    return spark.readStream.format("text").load(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket, as column ``value``."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()

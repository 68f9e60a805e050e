"""Writers. Stored tables are Parquet laid out for the queries that read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.times import EPOCH, day_of
from wayfare.operators.spread import latest_per_key
from wayfare.schemas import TRACK


def replace_stations(table: DataFrame, path: str) -> None:
    """Replace the station table; it holds one row per order."""
    table.write.mode("overwrite").parquet(path)


def stored_track(points: DataFrame) -> DataFrame:
    """Track points as stored: seven text columns."""
    names = {"city_code": "CITYCODE", "driver_id": "DRIVERID", "order_id": "ORDERID",
             "epoch": "TIMESTAMP", "time": "TIME", "lng": "LNG", "lat": "LAT"}
    return points.select(*[F.col(c).cast("string").alias(n) for c, n in names.items()])


def write_tracks(points: DataFrame, path: str) -> None:
    """Append track points by city and day, each order's points together and in time order.

    Range partitioning cuts a long order between tasks like any other run of rows. Readers prune by
    partition, and by the file statistics of order and time.
    """
    order = ["city_code", "day", "order_id", "epoch", "offset"]
    (points.withColumn("day", day_of(F.col("time")))
     .repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("append").partitionBy("city_code", "day").parquet(path))


def save_track_table(points: DataFrame, name: str, buckets: int, path: str | None = None) -> None:
    """Append track points to a catalog table by day, each day in buckets of orders, sorted by order and time.

    A bucket is one file a day, so a query for one order opens one file of each day asked for, and joins by
    order do not shuffle the table. Choose ``buckets`` for the largest day at a file of a few hundred MB.
    """
    timed = points.withColumn("day", day_of(F.col("time")))
    writer = (timed.repartition(buckets, "order_id").sortWithinPartitions("day", "order_id", "epoch", "offset")
              .write.mode("append").partitionBy("day").bucketBy(buckets, "order_id").sortBy("order_id", "epoch"))
    (writer.option("path", path) if path else writer).saveAsTable(name)


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    """The track table; city and day stay text."""
    return spark.read.schema(TRACK).parquet(path)


def write_order_detail(detail: DataFrame, path: str) -> None:
    """Append order-detail rows, the latest per row key."""
    latest_per_key(detail, ["rowkey"], ["offset"]).write.mode("append").parquet(path)


def write_salted(rows: DataFrame, path: str) -> None:
    """Rows under salted keys, one folder per key range, sorted by key within files."""
    (rows.withColumn("bucket", F.substring("rowkey", 1, 4))
     .repartitionByRange("bucket", "rowkey").sortWithinPartitions("bucket", "rowkey")
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def append_snapshots(snapshots: DataFrame, path: str) -> None:
    """Append metric snapshots with the UTC time of their capture, one folder per day.

    Expiry is a filter on that time when reading; old days are dropped as whole folders.
    """
    captured = F.timestamp_add("MICROSECOND", F.unix_micros(F.current_timestamp()), F.expr(EPOCH))
    stamped = snapshots.withColumn("captured_at", captured)
    (stamped.withColumn("captured_day", F.col("captured_at").cast("date"))
     .write.mode("append").partitionBy("captured_day").parquet(path))

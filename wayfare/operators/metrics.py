"""Job and batch metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.constants import GAUGES, LISTENER_TTL_S, MONITOR_TTL_S, SLOW_BATCH_FACTOR
from wayfare.schemas import GAUGE_SNAPSHOT


def gauge_values(snapshots: DataFrame, app: str) -> DataFrame:
    """Named gauges of JSON snapshots as numbers; a gauge that is missing is null."""
    parsed = snapshots.withColumn("_gauges", F.from_json("value", GAUGE_SNAPSHOT)["gauges"])
    picked = [F.try_element_at("_gauges", F.lit(f"{app}.{path}"))["value"].alias(name)
              for name, path in GAUGES.items()]
    return parsed.select(*snapshots.drop("value").columns, *picked).withColumn(
        "processing_time", F.col("processing_end") - F.col("processing_start"))


def _task_ends(events: DataFrame) -> DataFrame:
    return events.where(F.col("Event") == "SparkListenerTaskEnd")


def _flat(parent: str, names: dict[str, str]) -> list[Column]:
    path = "".join(f".`{p}`" for p in parent.split("/"))[1:]
    return [F.col(f"{path}.`{source}`").alias(name) for name, source in names.items()]


def task_metrics(events: DataFrame) -> DataFrame:
    return _task_ends(events).select(F.col("Task Info.Task ID").alias("task_id"), *_flat("Task Metrics", {
        "deserialize_time": "Executor Deserialize Time",
        "deserialize_cpu_time": "Executor Deserialize CPU Time",
        "run_time": "Executor Run Time", "cpu_time": "Executor CPU Time",
        "result_size": "Result Size", "gc_time": "JVM GC Time",
        "result_serialization_time": "Result Serialization Time",
        "memory_spilled": "Memory Bytes Spilled", "disk_spilled": "Disk Bytes Spilled",
        "peak_memory": "Peak Execution Memory"}))


def shuffle_metrics(events: DataFrame) -> DataFrame:
    return _task_ends(events).select(
        F.col("Task Info.Task ID").alias("task_id"),
        *_flat("Task Metrics/Shuffle Read Metrics", {
            "remote_blocks": "Remote Blocks Fetched", "local_blocks": "Local Blocks Fetched",
            "remote_bytes": "Remote Bytes Read", "local_bytes": "Local Bytes Read",
            "fetch_wait": "Fetch Wait Time", "records_read": "Total Records Read"}),
        *_flat("Task Metrics/Shuffle Write Metrics", {
            "bytes_written": "Shuffle Bytes Written", "records_written": "Shuffle Records Written",
            "write_time": "Shuffle Write Time"}))


def io_metrics(events: DataFrame) -> DataFrame:
    return _task_ends(events).select(
        F.col("Task Info.Task ID").alias("task_id"),
        *_flat("Task Metrics/Input Metrics", {"bytes_read": "Bytes Read", "records_read": "Records Read"}),
        *_flat("Task Metrics/Output Metrics", {
            "bytes_written": "Bytes Written", "records_written": "Records Written"}))


def block_statuses(events: DataFrame) -> DataFrame:
    """A row for each block whose status a task changed."""
    blocks = _task_ends(events).select(F.col("Task Info.Task ID").alias("task_id"), F.inline("Task Metrics.Updated Blocks"))
    return blocks.select("task_id", F.col("Block ID").alias("block_id"), F.col("Status.Storage Level.Use Memory").alias("in_memory"),
                         F.col("Status.Storage Level.Use Disk").alias("on_disk"), F.col("Status.Memory Size").alias("memory_size"),
                         F.col("Status.Disk Size").alias("disk_size"))


def task_info(events: DataFrame) -> DataFrame:
    finished = F.col("Task Info.Finish Time") > 0
    return _task_ends(events).select(
        *_flat("Task Info", {"task_id": "Task ID", "host": "Host", "speculative": "Speculative",
                             "failed": "Failed", "killed": "Killed"}),
        (~F.coalesce(finished, F.lit(False))).alias("running"))


def failed_tasks(events: DataFrame) -> DataFrame:
    """Task ends with a failure or kill reason, and its message."""
    reason = F.col("Task End Reason")
    return (_task_ends(events)
            .where((reason["Reason"] != "Success") & (F.col("Stage Attempt ID") != -1))
            .select(F.col("Task Info.Task ID").alias("task_id"), reason["Reason"].alias("reason"),
                    F.coalesce(reason["Kill Reason"],
                               F.concat_ws(": ", reason["Class Name"],
                                           F.coalesce(reason["Description"], reason["Message"])))
                    .alias("message")))


def record_total(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("records"))


def batch_throughput(batches: DataFrame) -> DataFrame:
    """Records per millisecond of each batch; null for a batch that took no time."""
    cost = F.col("end_ms") - F.col("start_ms")
    return batches.select("batch_id", "records", cost.alias("cost_ms"),
                          (F.col("records") / F.nullif(cost, F.lit(0))).alias("per_ms"))


def slow_batches(batches: DataFrame, batch_seconds: int) -> DataFrame:
    """Batches delayed by more than six batch intervals."""
    return batches.where(F.col("total_delay_ms") > SLOW_BATCH_FACTOR * batch_seconds * 1000)


def retained(snapshots: DataFrame, as_of: Column, ttl_seconds: int = MONITOR_TTL_S,
             at: str = "captured_at") -> DataFrame:
    """Snapshots not yet expired. The bound is a constant, so it reaches the scan, and stored day folders are pruned."""
    oldest = F.timestamp_add("SECOND", F.lit(-ttl_seconds), as_of)
    if "captured_day" in snapshots.columns:
        day = F.col("captured_day").cast("date")
        snapshots = snapshots.where((day >= oldest.cast("date")) & (day <= as_of.cast("date")))
    return snapshots.where((F.col(at) > oldest) & (F.col(at) <= as_of))


def listener_records(records: DataFrame, as_of: Column, at: str = "captured_at") -> DataFrame:
    """Task, shuffle, I/O and task-info records not yet expired; they live for an hour, snapshots of gauges for a day."""
    return retained(records, as_of, LISTENER_TTL_S, at)


def batch_progress(progress: DataFrame) -> DataFrame:
    """Progress reports of a streaming query as a batch table, delays in milliseconds."""
    spent = F.col("durationMs")

    def took(name: str) -> Column:
        return F.coalesce(F.try_element_at(spent, F.lit(name)), F.lit(0))

    return progress.select(
        F.col("id").alias("query_id"), F.col("batchId").alias("batch_id"),
        F.col("timestamp").alias("started_at"), F.col("numInputRows").alias("records"),
        (took("latestOffset") + took("getBatch") + took("queryPlanning") + took("walCommit")
         ).alias("scheduling_delay_ms"),
        took("addBatch").alias("duration_ms"), took("triggerExecution").alias("total_delay_ms"))

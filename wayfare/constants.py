"""Fixed values the results depend on."""

# City codes.
CHENGDU = "510100"
XIAN = "610100"
HAIKOU = "460100"

# Order topics and the city each carries.
ORDER_TOPICS = {
    "hai_kou_order_topic": HAIKOU,
    "cheng_du_order_topic": CHENGDU,
    "xi_an_order_topic": XIAN,
}

# GPS topics; a GPS consumer may also be pointed at the Haikou order topic.
GPS_TOPICS = {
    "cheng_du_gps_topic_2": CHENGDU,
    "xi_an_gps_topic": XIAN,
    "hai_kou_order_topic": HAIKOU,
}

# Change-capture tables; orders are matched by prefix, the others by name.
ORDER_TABLE = "order_info"
USER_TABLE = "renter_info"
DRIVER_TABLE = "driver_info"
ALLIANCE_TABLE = "opt_alliance_business"
UNKNOWN_ROUTE = "#A"

SALT_BUCKETS = 9

# Virtual stations: a hexagon edge in metres (grid resolution 12) and the fewest orders of a hot cell.
HEX_EDGE_M = 9.4155
HEX_RESOLUTION = 12
METRES_PER_DEGREE = 111000.0
MIN_CELL_ORDERS = 10
SQUARE_EDGE_M = 100

# Retention of monitoring records and of listener records, in seconds.
MONITOR_TTL_S = 86400
LISTENER_TTL_S = 3600

# A batch is slow when its total delay exceeds this many batch intervals.
SLOW_BATCH_FACTOR = 6

# Positions of the fields in a Haikou order line.
ORDER_LINE_FIELDS = (
    "order_id", "product_id", "city_id", "district", "county", "order_time_type", "combo_type",
    "traffic_type", "passenger_count", "driver_product_id", "start_dest_distance", "arrive_day",
    "arrive_time", "departure_day", "departure_time", "pre_total_fee", "normal_time",
    "bubble_trace_id", "product_1level", "dest_lng", "dest_lat", "starting_lng", "starting_lat",
    "year", "month", "day",
)

# Fields of the change records, in stored order.
ORDER_FIELDS = (
    "pay_all", "pay_normal", "create_time", "open_lng", "open_lat", "begin_address_code",
    "charge_mileage", "city_name", "vehicle_license", "driver_id", "driver_name", "cancel", "state",
    "order_type", "work_flow", "close_gps_time", "cancel_time", "pay_time",
)
USER_FIELDS = ("create_time", "last_login_city", "last_logon_time", "city_name")
DRIVER_FIELDS = (
    "create_time", "register_city", "driver_name", "mobile", "driver_type", "cancel_count",
    "driver_management_id",
)
ALLIANCE_FIELDS = (
    "alliance_name", "organization_code", "alliance_role", "linkman", "contact_number",
    "create_user", "create_time", "update_user", "update_time", "state", "del_state",
)

# Gauges read from a metrics snapshot: output column -> path after the application id.
GAUGES = {
    "disk_used_mb": "driver.BlockManager.disk.diskSpaceUsed_MB",
    "max_mem_mb": "driver.BlockManager.memory.maxMem_MB",
    "mem_used_mb": "driver.BlockManager.memory.memUsed_MB",
    "remaining_mem_mb": "driver.BlockManager.memory.remainingMem_MB",
    "active_jobs": "driver.DAGScheduler.job.activeJobs",
    "all_jobs": "driver.DAGScheduler.job.allJobs",
    "failed_stages": "driver.DAGScheduler.stage.failedStages",
    "running_stages": "driver.DAGScheduler.stage.runningStages",
    "waiting_stages": "driver.DAGScheduler.stage.waitingStages",
    "processing_delay": "driver.query.StreamingMetrics.streaming.lastCompletedBatch_processingDelay",
    "processing_end": "driver.query.StreamingMetrics.streaming.lastCompletedBatch_processingEndTime",
    "processing_start": "driver.query.StreamingMetrics.streaming.lastCompletedBatch_processingStartTime",
    "last_batch_records": "driver.query.StreamingMetrics.streaming.lastReceivedBatch_records",
    "running_batches": "driver.query.StreamingMetrics.streaming.runningBatches",
    "completed_batches": "driver.query.StreamingMetrics.streaming.totalCompletedBatches",
    "processed_records": "driver.query.StreamingMetrics.streaming.totalProcessedRecords",
    "received_records": "driver.query.StreamingMetrics.streaming.totalReceivedRecords",
    "unprocessed_batches": "driver.query.StreamingMetrics.streaming.unprocessedBatches",
    "waiting_batches": "driver.query.StreamingMetrics.streaming.waitingBatches",
}

# Unsafe markup removed from HTML, applied in this order, ignoring case.
UNSAFE_HTML = (
    r"<[\s]*?(script|style)[^>]*?>[\s\S]*?<[\s]*?\/[\s]*?(script|style)[\s]*?>",
    r"on[^\s]+=\s*",
    r"href=javascript:",
    r"<[\s]*?(iframe|frameset)[^>]*?>[\s\S]*?<[\s]*?\/[\s]*?(iframe|frameset)[\s]*?>",
    r"<[\s]*?link[^>]*?/>",
)

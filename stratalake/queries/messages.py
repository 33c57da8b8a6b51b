"""The message stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import landing
from ..functions.timing import stamp_arrival, utc_instant, utc_wall_clock
from ..plans import messages
from ..scratch import fresh_dir, fresh_name
from ..sinks.tables import declare_view
from ..sources.files import read_evolving
from ..sources.streams import stream_table
from ..streaming.merged import run_merged
from ..streaming.runs import run_complete, run_once
from ..streaming.windows import pane_sketches, tumbling_distinct, windows_from_panes
from .registry import Registry

registry = Registry()

# Events of users that the reference view knows.
KNOWN = """
    WITH known AS (
      SELECT * FROM events
      WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
"""
MESSAGE_NAME = """
    CASE event_type WHEN 'error' THEN 'BYE' WHEN 'signup' THEN 'BYE_T'
                    ELSE upper(event_type) END"""


def _run(
    spark: SparkSession, stream: DataFrame, label: str, state_partitions: int | None = None
) -> DataFrame:
    out = fresh_dir(spark, label)
    run_once(stream, fresh_dir(spark, "checkpoint"), out, state_partitions=state_partitions)
    return spark.read.parquet(out)


def _cores(spark: SparkSession) -> int:
    """State partitions for windows: one per core of the cluster."""
    return spark.sparkContext.defaultParallelism


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_table(spark, landing.silver_messages(spark, sf_dir))


def _reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.reference_view(landing.reference_objects(spark, sf_dir), landing.SEGMENT)


def _bounds(window: str) -> list[Column]:
    return [
        utc_wall_clock(f"{window}.start").alias("window_start"),
        utc_wall_clock(f"{window}.end").alias("window_end"),
    ]


@registry.check(f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, epoch_us(ts) // 1000 AS publish_ms,
           CAST(user_id AS VARCHAR) AS subscriber_id, event_type AS device_model,
           {MESSAGE_NAME} AS message_name, CAST(user_id % 50 AS INTEGER) AS cell_area,
           round(value, 2) AS response_time, ts AS event_time,
           CAST(ts AS DATE) AS created, true AS others_null
    FROM events""")
def msg_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _run(spark, messages.decoded(landing.envelopes(spark, sf_dir)), "decoded")
    return stored.select(
        F.col("eventId").alias("event_id"),
        F.col("publishTimestampInMillis").alias("publish_ms"),
        "subscriber_id",
        F.col("userequipment_model_name").alias("device_model"),
        "message_name",
        "cell_area",
        F.round(F.col("controlplane_response_time_usec").cast("double"), 2).alias("response_time"),
        utc_wall_clock("cal_timestamp_time").alias("event_time"),
        F.col("create_ts").alias("created"),
        (
            F.col("rat_name").isNull()
            & F.col("cell_id").isNull()
            & F.col("create_updt_ts").isNull()
        ).alias("others_null"),
    )


def _every_field() -> list[tuple[str, str, str, str, str]]:
    """Name and type of each payload field, the JSON text it is sent as (in Spark's SQL), how
    the stored column is compared, and what DuckDB says it must be."""
    fields = []
    declared = [line.strip().rstrip(",") for line in messages.PAYLOAD_SCHEMA.split("\n")]
    for i, (name, kind) in enumerate(line.split() for line in declared if line):
        sent, read, expected = {
            "STRING": (f"concat(event_type, '-{i}')", name, f"event_type || '-{i}'"),
            "INT": (f"int(user_id * 64 + {i})", name, f"CAST(user_id * 64 + {i} AS INTEGER)"),
            "FLOAT": (
                f"float(user_id + {i} / 4)", f"double({name})", f"CAST(user_id + {i} / 4 AS DOUBLE)"
            ),
            "TIMESTAMP": ("concat(string(ts), 'Z')", name, "ts"),
            "DATE": (
                f"string(date_add(date(ts), {i}))", name, f"CAST(ts AS DATE) + {i}"
            ),
        }[kind]
        fields.append((name, kind, sent, read, expected))
    return fields


@registry.check(
    "SELECT event_id AS message_id, "
    + ", ".join(f"{expected} AS {name}" for name, _, _, _, expected in _every_field())
    + " FROM events"
)
def msg_all_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of a payload, each with a value of its own."""
    sent = ", ".join(f"{sent} AS {name}" for name, _, sent, _, _ in _every_field())
    envelopes = landing.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("messageId"),
        F.expr(f"encode(to_json(struct({sent})), 'UTF-8')").alias("payload"),
        F.lit(0).cast("bigint").alias("publishTimestampInMillis"),
    )
    compared = [
        utc_wall_clock(name).alias(name) if kind == "TIMESTAMP" else F.expr(read).alias(name)
        for name, kind, _, read, _ in _every_field()
    ]
    decoded = messages.decoded(envelopes)
    return decoded.select(F.col("eventId").cast("bigint").alias("message_id"), *compared)


@registry.check("SELECT CAST(event_id AS VARCHAR) AS event_id, true AS stamped FROM events")
def msg_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier = landing.event_envelopes(spark, sf_dir).withColumn(
        "eventTime", F.lit("2000-01-01").cast("timestamp")
    )
    return stamp_arrival(earlier).select(
        F.col("messageId").cast("string").alias("event_id"),
        (F.col("eventTime") > F.lit("2000-01-01").cast("timestamp")).alias("stamped"),
    )


@registry.check("""
    SELECT CAST(c_custkey AS VARCHAR) AS bus_object_id, c_mktsegment AS bus_object_typ_cd
    FROM customer WHERE c_mktsegment = 'BUILDING'""")
def reference_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = fresh_name("reference")
    declare_view(_reference(spark, sf_dir), view)
    return spark.sql(f"SELECT bus_object_id, bus_object_typ_cd FROM {view}")


@registry.check(
    KNOWN
    + f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS subscriber_id,
           {MESSAGE_NAME} AS message_name, ts AS event_time
    FROM known"""
)
def msg_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = messages.decoded(landing.envelopes(spark, sf_dir))
    stored = _run(spark, messages.silver(decoded, _reference(spark, sf_dir)), "silver")
    return stored.select(
        F.col("eventId").alias("event_id"),
        "subscriber_id",
        "message_name",
        utc_wall_clock("cal_timestamp_time").alias("event_time"),
    )


SLIDING = (
    KNOWN
    + """
    SELECT start AS window_start, start + INTERVAL 60 MINUTE AS window_end,
           count(DISTINCT event_type) AS count_dist_device_model
    FROM (SELECT time_bucket(INTERVAL 10 MINUTE, ts) - k * INTERVAL 10 MINUTE AS start, event_type
          FROM known CROSS JOIN range(6) AS slides(k))
    GROUP BY start"""
)


@registry.check(SLIDING)
def msg_sliding_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_name("device_models")
    run_complete(
        messages.device_models_so_far(_silver(spark, sf_dir)),
        fresh_dir(spark, "checkpoint"),
        fresh_dir(spark, name),
        name,
        state_partitions=_cores(spark),
    )
    return spark.table(name).select(*_bounds("window"), "count_dist_device_model")


@registry.check(SLIDING)
def msg_sliding_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_name("device_models")
    run_complete(
        pane_sketches(_silver(spark, sf_dir), messages.EVENT_TIME, "userequipment_model_name"),
        fresh_dir(spark, "checkpoint"),
        fresh_dir(spark, name),
        name,
        finish=lambda panes: windows_from_panes(panes, "count_dist_device_model"),
        state_partitions=_cores(spark),
    )
    return spark.table(name).select(*_bounds("window"), "count_dist_device_model")


@registry.check(SLIDING)
def msg_sliding_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows kept by key: two deliveries, each writing the days that it changed."""
    name, root = fresh_name("device_models"), fresh_dir(spark, "merged")
    arrivals, checkpoint = fresh_dir(spark, "arrivals"), fresh_dir(spark, "checkpoint")
    columns = [messages.EVENT_TIME, "userequipment_model_name"]
    silver = spark.table(landing.silver_messages(spark, sf_dir)).select(*columns)
    late = F.col("userequipment_model_name") == "error"
    for delivered in (~late, late):
        silver.where(delivered).write.mode("append").parquet(arrivals)
        run_merged(
            messages.device_models_so_far(
                spark.readStream.schema(silver.schema).parquet(arrivals), ordered=False
            ),
            checkpoint,
            root,
            name,
            ["day", "window"],
            ["day"],
            finish=lambda rows: rows.withColumn("day", F.col("window.start").cast("date")),
            state_partitions=_cores(spark),
        )
    return spark.table(name).select(*_bounds("window"), "count_dist_device_model")


# Windows that end after the watermark are still open when the stream stops.
CLOSED = "<= (SELECT max(ts) - INTERVAL 10 MINUTE FROM known)"


@registry.check(
    KNOWN
    + f"""
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
           time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
           count(DISTINCT user_id % 50) AS count_dist_cell_area
    FROM known
    GROUP BY 1, 2 HAVING window_end {CLOSED}"""
)
def msg_tumbling_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A small error keeps the counts exact for comparison with the SQL.
    stream = messages.cell_areas(_silver(spark, sf_dir), rsd=0.01)
    windows = _run(spark, stream, "cell-areas", _cores(spark))
    return windows.select(*_bounds("time"), "count_dist_cell_area")


@registry.check(
    KNOWN
    + f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, {MESSAGE_NAME} AS message_name,
           true AS stamped
    FROM known WHERE event_type IN ('error', 'signup')"""
)
def msg_terminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, messages.terminated(_silver(spark, sf_dir)), "terminated").select(
        F.col("eventId").alias("event_id"),
        "message_name",
        F.col("eventTime").isNotNull().alias("stamped"),
    )


# Errors are delivered in the second of two runs, along with everything from the
# 16th on. Errors whose window the first run has already closed are too late.
LATE_FROM = "2024-01-16 00:00:00"


@registry.check(f"""
    WITH staged AS (
      SELECT ts, event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS start,
             event_type <> 'error' AND ts < TIMESTAMP '{LATE_FROM}' AS first_run
      FROM events),
    closed AS (
      SELECT coalesce(max(ts) FILTER (first_run) - INTERVAL 10 MINUTE, TIMESTAMP '1970-01-01')
               AS by_first_run,
             max(ts) - INTERVAL 10 MINUTE AS by_end
      FROM staged)
    SELECT start AS window_start, start + INTERVAL 5 MINUTE AS window_end,
           count(DISTINCT event_type) AS event_types
    FROM staged CROSS JOIN closed
    WHERE (first_run OR start + INTERVAL 5 MINUTE > by_first_run)
      AND start + INTERVAL 5 MINUTE <= by_end
    GROUP BY start""")
def msg_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = landing.table(spark, sf_dir, "events").select("ts", "event_type")
    first_run = (F.col("event_type") != "error") & (
        F.col("ts") < F.lit(LATE_FROM).cast("timestamp_ntz")
    )
    arrivals = fresh_dir(spark, "arrivals")
    checkpoint, out = fresh_dir(spark, "checkpoint"), fresh_dir(spark, "windows")
    for delivered in (first_run, ~first_run):
        batch = events.where(delivered).select(utc_instant("ts").alias("at"), "event_type")
        batch.write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema("at timestamp, event_type string").parquet(arrivals)
        windows = tumbling_distinct(stream, "at", "event_type", "event_types")
        run_once(windows, checkpoint, out, state_partitions=_cores(spark))
    return spark.read.parquet(out).select(*_bounds("time"), "event_types")


SECOND_DELIVERY = "2024-01-21 00:00:00"


@registry.check(f"""
    SELECT run, count(*) AS new_rows
    FROM (SELECT CASE WHEN ts < TIMESTAMP '{SECOND_DELIVERY}' THEN 1 ELSE 3 END AS run FROM events)
    GROUP BY run""")
def incremental_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run, run again with nothing new, deliver more, run a third time."""
    events = landing.table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit(SECOND_DELIVERY).cast("timestamp_ntz")
    arrivals = fresh_dir(spark, "arrivals")
    checkpoint, out = fresh_dir(spark, "checkpoint"), fresh_dir(spark, "arrived")
    for run, delivered in enumerate((early, None, ~early), start=1):
        if delivered is not None:
            events.where(delivered).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(events.schema).parquet(arrivals)
        run_once(stream.withColumn("run", F.lit(run)), checkpoint, out)
    return spark.read.parquet(out).groupBy("run").agg(F.count(F.lit(1)).alias("new_rows"))


@registry.check(f"""
    SELECT event_id, event_type,
           CASE WHEN ts >= TIMESTAMP '{SECOND_DELIVERY}' THEN value END AS value
    FROM events""")
def evolve_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run of a stream has a column that the first had not."""
    events = landing.table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit(SECOND_DELIVERY).cast("timestamp_ntz")
    arrivals = fresh_dir(spark, "arrivals")
    checkpoint, out = fresh_dir(spark, "checkpoint"), fresh_dir(spark, "evolved")
    for delivered, columns in (
        (early, ["event_id", "event_type"]),
        (~early, ["event_id", "event_type", "value"]),
    ):
        batch = events.where(delivered).select(*columns)
        batch.write.mode("append").parquet(arrivals)
        run_once(spark.readStream.schema(batch.schema).parquet(arrivals), checkpoint, out)
    return read_evolving(spark, out)


@registry.check(f"""
    SELECT event_id, event_type,
           CASE WHEN ts >= TIMESTAMP '{SECOND_DELIVERY}' THEN value END AS value
    FROM events""")
def evolve_stream_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``evolve_stream`` into a table, which gets the column and is read by its name."""
    events = landing.table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit(SECOND_DELIVERY).cast("timestamp_ntz")
    arrivals, name = fresh_dir(spark, "arrivals"), fresh_name("evolved")
    checkpoint, out = fresh_dir(spark, "checkpoint"), fresh_dir(spark, name)
    for delivered, columns in (
        (early, ["event_id", "event_type"]),
        (~early, ["event_id", "event_type", "value"]),
    ):
        batch = events.where(delivered).select(*columns)
        batch.write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(batch.schema).parquet(arrivals)
        run_once(stream, checkpoint, out, name, comment="Events as they arrived")
    return spark.table(name)


# What the chain's silver layer lets through: objects known when the message came.
CHAIN = f"""
    WITH known AS (
      SELECT * FROM events
      WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
                        AND (c_custkey % 2 = 0 OR ts >= TIMESTAMP '{landing.CHAIN_SPLIT}')))
"""


def _layer(spark: SparkSession, sf_dir: str, layer: str) -> DataFrame:
    return spark.table(f"msg_{layer}_{landing.message_chain(spark, sf_dir)}")


@registry.check(
    CHAIN
    + f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS subscriber_id,
           {MESSAGE_NAME} AS message_name, ts AS event_time, true AS stamped
    FROM known WHERE event_type IN ('error', 'signup')"""
)
def msg_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy at the end of the chain, after two deliveries and a run for nothing new."""
    return _layer(spark, sf_dir, "published").select(
        F.col("eventId").alias("event_id"),
        "subscriber_id",
        "message_name",
        utc_wall_clock("cal_timestamp_time").alias("event_time"),
        F.col("eventTime").isNotNull().alias("stamped"),
    )


@registry.check(
    CHAIN
    + """
    SELECT 'bronze' AS layer, count(*) AS num_rows FROM events
    UNION ALL SELECT 'decoded', count(*) FROM events
    UNION ALL SELECT 'silver', count(*) FROM known
    UNION ALL SELECT 'terminated', count(*) FILTER (event_type IN ('error', 'signup')) FROM known
    UNION ALL SELECT 'published', count(*) FILTER (event_type IN ('error', 'signup')) FROM known"""
)
def msg_chain_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        _layer(spark, sf_dir, layer).agg(
            F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("num_rows")
        )
        for layer in ("bronze", "decoded", "silver", "terminated", "published")
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


@registry.check(
    CHAIN
    + f"""
    SELECT start AS window_start, start + INTERVAL 60 MINUTE AS window_end,
           count(DISTINCT event_type) AS count_dist_device_model
    FROM (SELECT time_bucket(INTERVAL 10 MINUTE, ts) - k * INTERVAL 10 MINUTE AS start, event_type
          FROM known CROSS JOIN range(6) AS slides(k))
    GROUP BY start HAVING window_end {CLOSED}"""
)
def msg_sliding_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that are over, from the chain's stream in append mode."""
    windows = _layer(spark, sf_dir, "device_models")
    return windows.select(*_bounds("window"), "count_dist_device_model")

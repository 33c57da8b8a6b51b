"""Queue messages: envelopes to decoded, known and summarised events.

bronze   envelopes as received
decoded  payload fields beside the message id and publish time
silver   messages whose subscriber is in the reference view
gold     distinct device models and cell areas per time window, ended sessions
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decode import parse_json
from ..functions.timing import stamp_arrival
from ..operators.flatten import promote_struct
from ..operators.lookups import keep_matching, matching_batch, snapshot
from ..sources.streams import stream_table
from ..streaming.declared import Declared, run_declared
from ..streaming.runs import run_once
from ..streaming.windows import closed_sliding_distinct, sliding_distinct, tumbling_distinct

# The fields of a message payload, in order.
PAYLOAD_SCHEMA = """
    subscriber_id STRING,
    userequipment_manufacturer_name STRING,
    userequipment_model_name STRING,
    application_protocol_type_code STRING,
    application_name STRING,
    application_group STRING,
    message_protocol_type_code STRING,
    message_name STRING,
    rat_name STRING,
    response_code STRING,
    response_description STRING,
    controlplane_transaction_status_name STRING,
    visited_plmn_name STRING,
    home_plmn_name STRING,
    cell_area INT,
    cell_id INT,
    cell_mcc INT,
    cell_mnc INT,
    cell_updated_flag INT,
    cell_region_name STRING,
    cell_subdivision_name STRING,
    cell_city_name STRING,
    celltype_name STRING,
    trackingarea_code INT,
    apn_name STRING,
    origin_host_diameter_name STRING,
    destination_host_diameter_name STRING,
    origin_realm_diameter_name STRING,
    destination_realm_diameter_name STRING,
    speech_indicator INT,
    csfb_indicator_name STRING,
    client_server_entry_type_name STRING,
    controlplane_response_time_usec FLOAT,
    cal_timestamp_time TIMESTAMP,
    device_name STRING,
    subscriber_msisdn STRING,
    subscriber_company_name STRING,
    subscriber_segment_name STRING,
    subscriber_plan_name STRING,
    userequipment_imeisv STRING,
    userequipment_sv STRING,
    userequipment_tac STRING,
    calling_address STRING,
    called_address STRING,
    controlplane_transaction_start_time DATE,
    controlplane_transaction_id DATE,
    cell_latitude STRING,
    cell_longitude STRING,
    create_ts DATE,
    create_user_id STRING,
    create_updt_ts DATE,
    create_updt_user_id STRING
"""
# Message names that end a session.
TERMINATING = ("BYE", "BYE_T")

# The event's own time. Windows over the arrival stamp (``eventTime``) would
# depend on when a run happens to read the message.
EVENT_TIME = "cal_timestamp_time"


def decoded(envelopes: DataFrame, schema: str = PAYLOAD_SCHEMA) -> DataFrame:
    """Payload fields, ``eventId``, ``publishTimestampInMillis`` and an arrival stamp."""
    messages = envelopes.select(
        parse_json("payload", schema).alias("json"),
        F.col("messageId").cast("string").alias("eventId"),
        "publishTimestampInMillis",
    )
    return stamp_arrival(promote_struct(messages, "json"))


def reference_view(objects: DataFrame, object_type: str) -> DataFrame:
    """The reference objects of one type."""
    return objects.where(F.col("bus_object_typ_cd") == object_type)


def silver(messages: DataFrame, reference: DataFrame) -> DataFrame:
    """Messages whose subscriber is a reference object, stamped again."""
    return keep_matching(stamp_arrival(messages), reference, "subscriber_id", "bus_object_id")


def device_models(messages: DataFrame, time: str = EVENT_TIME) -> DataFrame:
    """Distinct device models per hour, every ten minutes, once an hour is over."""
    return closed_sliding_distinct(
        messages, time, "userequipment_model_name", "count_dist_device_model"
    )


def device_models_so_far(
    messages: DataFrame, time: str = EVENT_TIME, ordered: bool = True
) -> DataFrame:
    """``device_models`` with open hours too; in order, for a complete result."""
    return sliding_distinct(
        messages, time, "userequipment_model_name", "count_dist_device_model", ordered=ordered
    )


def cell_areas(
    messages: DataFrame, time: str = EVENT_TIME, rsd: float | None = None
) -> DataFrame:
    """Distinct cell areas per five minutes, up to ten minutes late."""
    return tumbling_distinct(messages, time, "cell_area", "count_dist_cell_area", rsd=rsd)


def terminated(messages: DataFrame) -> DataFrame:
    """Messages that end a session, stamped again."""
    return stamp_arrival(messages.where(F.col("message_name").isin(*TERMINATING)))


#: The layers of a chain in the order in which they are run.
LAYERS = ("bronze", "decoded", "silver", "device_models", "cell_areas", "terminated", "published")


def run_chain(
    spark: SparkSession,
    envelopes: DataFrame,
    reference: Callable[[], DataFrame],
    root: str,
    suffix: str,
    state_partitions: int | None = None,
    broadcast_rows: int = 1_000_000,
) -> dict[str, str]:
    """Carry newly arrived messages through every layer; returns the tables' names.

    Each layer is a table with a checkpoint of its own under ``root`` and is read by the
    next as a stream, so a run moves what the last one has not, and one that broke off goes
    on where it stopped. Payloads are parsed once, from bronze to decoded. ``reference`` is
    asked again for every batch of silver, whose keys are stored and measured. Run one
    chain at a time.
    """
    names = {layer: f"msg_{layer}_{suffix}" for layer in LAYERS}

    def checkpoint(layer: str) -> str:
        return f"{root}/checkpoints/{layer}"

    def append(layer: str, stream: DataFrame, comment: str, state: int | None = None) -> None:
        table = names[layer]
        run_once(
            stream, checkpoint(layer), f"{root}/{table}", table,
            state_partitions=state, comment=comment,
        )

    def known(batch: DataFrame) -> DataFrame:
        keys = snapshot(reference(), "bus_object_id")
        rows = matching_batch(batch, keys, "subscriber_id", broadcast_rows=broadcast_rows)
        return stamp_arrival(rows)

    append("bronze", envelopes, "Messages as received")
    append("decoded", decoded(stream_table(spark, names["bronze"])), "Payload fields")
    silver_table = Declared(
        names["silver"], f"{root}/{names['silver']}", known, comment="Messages of known objects"
    )
    run_declared(
        stream_table(spark, names["decoded"]), checkpoint("silver"), [silver_table], f"{root}/log"
    )
    rows = stream_table(spark, names["silver"])
    append("device_models", device_models(rows), "Device models an hour", state_partitions)
    append("cell_areas", cell_areas(rows), "Cell areas per five minutes", state_partitions)
    append("terminated", terminated(rows), "Messages that end a session")
    append("published", stream_table(spark, names["terminated"]), "Ended sessions, for others")
    return names

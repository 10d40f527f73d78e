"""The readings topic, derived from the ``events`` table.

Mapping (one message per event): offset = event_id, broker time = ts, panel = user_id,
location = upper(event_type), measured power = value, temperature = props.k. Fields the
table cannot supply (latitude, voltage, units, ...) are simply absent from the payload, so
each sink layout's rule for an absent key (default or NULL) is exercised on every row.

``edge=True`` rewrites some payloads by a rule on ``props.k`` so decode paths see the cases
the sinks must handle (same rule in the SQL oracles):

====  ==========================================================
k=0   temperature is an explicit JSON null
k=1   the timestamp key is absent
k=2   value is not JSON (``bad``)            -> rejected row
k=3   value is JSON but not an object (``[1]``) -> rejected row
k=4   temperature is a quoted number (``"12.5"``) -> 12.5
k=5   temperature is text (``"abc"``)        -> rejected row
====  ==========================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliolake.functions.scalars import inverter_status
from heliolake.functions.text import panel_id
from heliolake.functions.timefn import timestamp_to_ns
from heliolake.sources.topic import as_topic
from heliolake.tables import table

TOPIC = "solar-data"
N_PARTITIONS = 8


def props_k(col: str = "props"):
    return F.get_json_object(F.col(col), "$.k").try_cast("int")


def reading_columns(ev: DataFrame) -> DataFrame:
    loc = F.upper(F.col("event_type"))
    return ev.select(
        "event_id", "ts", "user_id", props_k().alias("_k"),
        panel_id(loc, F.col("user_id")).alias("panel_id"),
        loc.alias("location_id"),
        F.col("event_type").alias("location_name"),
        F.col("value").alias("power_output"),
        F.lit("W").alias("unit_power"),
        inverter_status(F.col("value")).alias("inverter_status"),
        timestamp_to_ns(F.col("ts")).alias("timestamp"),
    )


_PAYLOAD = ["panel_id", "location_id", "location_name", "power_output", "unit_power", "temperature",
            "inverter_status", "timestamp"]


def readings_topic(spark: SparkSession, root: str, edge: bool = False) -> DataFrame:
    r = reading_columns(table(spark, root, "events"))
    k = F.col("_k")
    opts = {"ignoreNullFields": "false"}
    if not edge:
        r = r.withColumn("temperature", k.cast("double"))
        value = F.to_json(F.struct(*_PAYLOAD), opts)
    else:
        temp = (F.when(k == 0, F.lit(None).cast("string"))
                .when(k == 4, F.lit("12.5"))
                .when(k == 5, F.lit("abc")))
        # temperature stays numeric JSON except for the k=4/5 text cases
        r = r.withColumn("temperature", F.when(k.isin(0, 4, 5), F.lit(None).cast("double")).otherwise(k.cast("double")))
        r = r.withColumn("_temp_text", temp)
        full = F.to_json(F.struct(*[c if c != "temperature" else
                                    F.when(k.isin(4, 5), F.col("_temp_text").cast("variant"))
                                    .otherwise(F.col("temperature").cast("variant")).alias("temperature")
                                    for c in _PAYLOAD]), opts)
        no_ts = F.to_json(F.struct(*[c for c in _PAYLOAD if c != "timestamp"]), opts)
        value = (F.when(k == 1, no_ts).when(k == 2, F.lit("bad")).when(k == 3, F.lit("[1]"))
                 .otherwise(full))
    return as_topic(r, key=F.col("location_id"), value=value, topic=TOPIC,
                    partition=F.pmod(F.col("user_id"), F.lit(N_PARTITIONS)),
                    offset=F.col("event_id"), timestamp=F.col("ts"))

"""Events as they might arrive: in deliveries, some late, some more than once, some broken."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELIVERIES = 4


def deliveries(events: DataFrame, event_time: str = "ts") -> DataFrame:
    """``events`` with ``delivery`` (0 to 3): each quarter of the time span is delivered in turn.

    Ids that leave 3 of 10 arrive two deliveries late; multiples of 5 come again with the next delivery,
    and those that leave 1 of 20 twice in one. Every 13th value is missing, every 17th negative, and
    every 19th event has an unknown type.
    """
    at = F.unix_micros(F.col(event_time).cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    low, span = low or 0, max(1, (high or 0) - (low or 0) + 1)
    own = F.expr(f"cast({DELIVERIES} * (unix_micros(cast({event_time} as timestamp)) - {low}L) div {span}L as int)")
    last = F.lit(DELIVERIES - 1)
    first = F.when(F.expr("event_id % 10 = 3"), F.least(own + 2, last)).otherwise(own)
    none = F.array().cast("array<int>")
    times = F.concat(
        F.array(first),
        F.when(F.expr("event_id % 5 = 0"), F.array(F.least(own + 1, last))).otherwise(none),
        F.when(F.expr("event_id % 20 = 1"), F.array(first)).otherwise(none))
    return events.select(
        "event_id", F.col(event_time).cast("timestamp").alias(event_time), "user_id",
        F.expr("if(event_id % 19 = 0, 'unknown', event_type) as event_type"),
        F.expr("case when event_id % 13 = 0 then null when event_id % 17 = 0 then -value"
               " else value end as value"),
        F.explode(times).alias("delivery"))


def replay(arriving: DataFrame, folder: str, start: Callable[[DataFrame], object]) -> None:
    """Write one delivery after the other and let a stream that ``start`` starts take each.

    The stream ends after each delivery and goes on from its checkpoint with the next.
    """
    spark = arriving.sparkSession
    schema = arriving.drop("delivery").schema
    for number in range(DELIVERIES):
        arriving.filter(F.col("delivery") == number).drop("delivery").write.mode("append").parquet(
            f"{folder}/arrivals")
        start(spark.readStream.schema(schema).parquet(f"{folder}/arrivals")).awaitTermination()

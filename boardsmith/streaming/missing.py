"""C5 as a stream: ids asked for whose post did not arrive in time.

A left outer join of two streams, asked-for ids and arrived posts, on the id and on event time: a post counts when it arrives
from the moment it was asked for until ``within`` later.  Both sides have a watermark, so state is bounded: an id is told missing
once the watermarks have passed its last moment, and rows later than the watermark are dropped.  A post that arrives
twice matches twice and is not told; an id that is asked for twice is told for each time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_ids_stream(asked: DataFrame, arrived: DataFrame, within: str, delay: str, id_col: str = "id", asked_at: str = "asked_at",
                       post_col: str = "post_id", arrived_at: str = "arrived_at") -> DataFrame:
    """(id, asked_at) of the ids asked for (stream) without a post in time (stream)."""
    a = asked.select(F.col(id_col).alias("id"), F.col(asked_at).cast("timestamp").alias("asked_at")).withWatermark("asked_at", delay)
    p = arrived.select(F.col(post_col).alias("post_id"), F.col(arrived_at).cast("timestamp").alias("arrived_at")).withWatermark("arrived_at", delay)
    in_time = (F.col("id") == F.col("post_id")) & (F.col("arrived_at") >= F.col("asked_at")) & (F.col("arrived_at") <= F.col("asked_at") + F.expr(f"INTERVAL {within}"))
    return a.join(p, in_time, "leftOuter").where("post_id IS NULL").select("id", "asked_at")

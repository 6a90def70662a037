"""Flows from an endless packet stream: fixed windows or idle gaps instead of chunks of a fixed count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshlark.operators.flows import FLOW_KEY, decoded_packets, flow_measures, ip_packets


def timed_packets(packets: DataFrame, delay: str | None) -> DataFrame:
    """Decoded packets with event time ``ts``; ``delay`` sets the watermark of a stream.

    Only IP packets move the watermark. The filter stands first because Spark would move it there anyway.
    """
    stamped = ip_packets(packets).withColumn("ts", F.timestamp_micros(F.col("tv_sec") * 1_000_000 + F.col("tv_usec")))
    if delay is not None:
        stamped = stamped.withWatermark("ts", delay)
    return decoded_packets(stamped, "ts")


def windowed_flows(packets: DataFrame, window: str = "1 minute", delay: str | None = "1 minute") -> DataFrame:
    """Flows per event-time window: ``window_start, ...flow key, measures``. Batch with ``delay=None``.

    In append mode a window is written once the watermark has passed its end; packets later than that are lost.
    """
    flows = (timed_packets(packets, delay).groupBy(F.window("ts", window).alias("w"), *FLOW_KEY)
             .agg(*flow_measures()))
    return flows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *FLOW_KEY,
                        "flow_count", "total_bytes", "valid_from", "valid_to")


def session_flows(packets: DataFrame, gap: str = "5 minutes", delay: str | None = "1 minute") -> DataFrame:
    """Flows that end after an idle ``gap``: ``session_start, ...flow key, measures``.

    The ends are taken from the packets, not from the window column: Spark would push a later filter on the
    window below the merging of sessions and cut sessions apart.
    """
    begin, end = F.min("ts").alias("session_start"), (F.max("ts") + F.expr(f"INTERVAL {gap}")).alias("session_end")
    flows = (timed_packets(packets, delay).groupBy(F.session_window("ts", gap).alias("w"), *FLOW_KEY)
             .agg(begin, end, *flow_measures()))
    return flows.select("session_start", "session_end", *FLOW_KEY, "flow_count", "total_bytes", "valid_from",
                        "valid_to")

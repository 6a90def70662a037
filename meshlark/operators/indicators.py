"""Traffic indicators per source address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshlark.functions.scalars import half_even
from meshlark.operators.flowstats import total

c = F.col


def source_profile(flows: DataFrame) -> DataFrame:
    """Distinct targets and known service ports, packets, bytes and flows sent per source.

    One scan: Spark groups by (source, value) with partial aggregates before it groups by source, so a source
    that owns a third of all flows is spread over many tasks.
    """
    return flows.groupBy("src_ip").agg(
        F.count_distinct("dst_ip").alias("unique_dst_ips"), F.count_distinct("service_port").alias("unique_svc_ports"),
        total("flow_count").alias("packets_sent"), total("total_bytes").alias("bytes_sent"),
        F.count(F.lit(1)).alias("flows_out"))


def incoming_profile(flows: DataFrame) -> DataFrame:
    return flows.groupBy("dst_ip").agg(
        total("flow_count").alias("packets_received"), total("total_bytes").alias("bytes_received"),
        F.count(F.lit(1)).alias("flows_in"))


def send_receive_ratio(sent: Column, received: Column) -> Column:
    """Two decimals, infinite when nothing was received."""
    return F.when(received > 0, half_even(sent * 100.0 / received) / 100.0).otherwise(F.lit(float("inf")))


def address_profile(flows: DataFrame) -> DataFrame:
    """Sent and received traffic of every source with ``send_recv_ratio``; nothing received reads as 0."""
    received = incoming_profile(flows).withColumnRenamed("dst_ip", "src_ip")
    both = source_profile(flows).join(received, "src_ip", "left").fillna(
        0, ["packets_received", "bytes_received", "flows_in"])
    return both.withColumn("send_recv_ratio", send_receive_ratio(c("packets_sent"), c("packets_received")))


def _high(profile: DataFrame, column: str, least: int) -> DataFrame:
    """Rows at or above ``max(90th percentile, least)``.

    The percentile reads a histogram of the counts, which has far fewer rows than there are addresses; it
    enters the filter as a scalar subquery.
    """
    histogram = profile.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    limit = histogram.agg(F.percentile(column, F.lit(0.9), c("_n"))).scalar()
    return profile.where(c(column) >= F.greatest(limit, F.lit(float(least))))


def scanners(profile: DataFrame) -> DataFrame:
    """Sources with unusually many distinct targets, most first."""
    return _high(profile, "unique_dst_ips", 3).orderBy(c("unique_dst_ips").desc(), "src_ip")


def port_reconnaissance(profile: DataFrame) -> DataFrame:
    """Sources with unusually many distinct service ports, most first."""
    return _high(profile, "unique_svc_ports", 5).orderBy(c("unique_svc_ports").desc(), "src_ip")


def asymmetry(profile: DataFrame) -> DataFrame:
    """Sources with a finite send/receive ratio, highest first."""
    return profile.where(c("send_recv_ratio") < float("inf")).orderBy(c("send_recv_ratio").desc(), "src_ip")

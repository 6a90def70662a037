"""Flow analytics: volumes, rankings, time series and distributions over flow rows.

Input: ``edge_id, src_ip, dst_ip, protocol, service_port, service_name, flow_count, total_bytes, valid_from,
valid_to``, for example from ``extract_flows`` or ``packets_to_flows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshlark.functions.ports import with_service_name
from meshlark.functions.scalars import half_even
from meshlark.graph import check_at_least
from meshlark.plans.ordered import quantiles

c = F.col


def total(name: str) -> Column:
    """Sum without NULLs; 0 when nothing was summed."""
    return F.coalesce(F.sum(name), F.lit(0))


def _flows() -> Column:
    return F.count(F.lit(1)).alias("flows")


def enrich(flows: DataFrame) -> DataFrame:
    """Start and end as timestamps, duration in seconds, and missing service names filled from the port."""
    timed = flows.withColumns({
        "timestamp": F.timestamp_millis("valid_from"),
        "timestamp_end": F.timestamp_millis("valid_to"),
        "flow_duration_s": (c("valid_to") - c("valid_from")) / 1000.0,
    })
    return with_service_name(timed)


def validity(flows: DataFrame, edges: DataFrame) -> DataFrame:
    """Fill ``valid_from, valid_to`` from the edge table by edge id; an unknown edge gives NULL."""
    windows = edges.select("edge_id", "valid_from", "valid_to")
    return flows.drop("valid_from", "valid_to").join(windows, "edge_id", "left")


def capture_summary(flows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows ``metric, value``. The time span looks at start times only."""
    one = flows.agg(
        F.count(F.lit(1)).alias("f"), total("flow_count").alias("p"), F.count_distinct("protocol").alias("k"),
        half_even((F.max("valid_from") - F.min("valid_from")) / 100.0).alias("span"),
        total("total_bytes").alias("b"))
    ips = nodes.agg(F.count(F.lit(1)).cast("double").alias("value"))
    per_flow = F.coalesce(half_even(F.try_divide(c("p") * 10.0, c("f"))) / 10.0, F.lit(0.0))
    values = {
        "Total flows (edges)": c("f"), "Total packets (aggregated)": c("p"), "Protocols observed": c("k"),
        "Time span (seconds)": F.coalesce(c("span") / 10.0, F.lit(0.0)), "Total bytes captured": c("b"),
        "Avg packets per flow": per_flow,
    }
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value"))
                                for k, v in values.items()])).alias("x")
    return ips.select(F.lit("Unique IP addresses").alias("metric"), "value").unionByName(
        one.select(pairs).select("x.metric", "x.value"))


def protocol_counts(flows: DataFrame) -> DataFrame:
    return (flows.groupBy("protocol").agg(_flows(), total("flow_count").alias("packets"))
            .orderBy(c("packets").desc(), "protocol"))


def protocol_bytes(flows: DataFrame) -> DataFrame:
    summed = flows.groupBy("protocol").agg(
        total("total_bytes").alias("total_bytes"), total("flow_count").alias("total_pkts"),
        F.count(F.lit(1)).alias("flow_count"))
    average = half_even(F.try_divide(c("total_bytes").cast("double"), c("total_pkts").cast("double")))
    return (summed.select("protocol", "total_bytes", "total_pkts", average.alias("avg_pkt_size"), "flow_count")
            .orderBy(c("total_bytes").desc(), "protocol"))


def top_senders(flows: DataFrame, by: str = "packets", n: int = 20) -> DataFrame:
    """Sources with the most packets (``packets_sent``) or bytes (``total_bytes``)."""
    source, name = {"packets": ("flow_count", "packets_sent"), "bytes": ("total_bytes", "total_bytes")}[by]
    return (flows.groupBy("src_ip").agg(total(source).alias(name))
            .orderBy(c(name).desc(), "src_ip").limit(n))


def busiest_pairs(flows: DataFrame, n: int = 20) -> DataFrame:
    return (flows.groupBy("src_ip", "dst_ip")
            .agg(_flows(), total("flow_count").alias("packets"), total("total_bytes").alias("bytes"))
            .orderBy(c("packets").desc(), "src_ip", "dst_ip").limit(n))


def service_ports(flows: DataFrame, n: int | None = 20) -> DataFrame:
    """Known service ports by packets, with a ``port (name)`` label; ``n=None`` for all."""
    known = flows.where(c("service_port").isNotNull())
    label = F.when(c("service_name") != "", F.concat(c("service_port"), F.lit(" ("), c("service_name"), F.lit(")")))
    ranked = (known.groupBy("service_port", "service_name")
              .agg(_flows(), total("flow_count").alias("packets"), total("total_bytes").alias("bytes"))
              .withColumn("label", F.coalesce(label, c("service_port").cast("string")))
              .orderBy(c("packets").desc(), "service_port"))
    return ranked if n is None else ranked.limit(n)


def port_protocols(flows: DataFrame, ports: int = 15) -> DataFrame:
    """Packets per (protocol, service port) for the busiest ports, with ``log10(packets + 1)``."""
    busiest = service_ports(flows, ports).select("service_port").distinct()
    counted = (flows.where(c("service_port").isNotNull()).groupBy("protocol", "service_port")
               .agg(total("flow_count").alias("packets")))
    return (counted.join(F.broadcast(busiest), "service_port", "left_semi")
            .select("protocol", "service_port", "packets", F.log10(c("packets") + 1).alias("log_packets"))
            .orderBy(c("packets").desc(), "protocol", "service_port"))


def port_protocol_table(flows: DataFrame, protocols: list[str], ports: int = 15) -> DataFrame:
    """The same as a wide table, one column per protocol."""
    return port_protocols(flows, ports).groupBy("service_port").pivot("protocol", protocols).agg(F.first("packets"))


def start_second() -> Column:
    return F.floor(c("valid_from") / 1000).cast("long").alias("second")


def per_second(flows: DataFrame) -> DataFrame:
    """Packets, bytes and new flows per start second."""
    return (flows.where(c("valid_from").isNotNull()).groupBy(start_second())
            .agg(total("flow_count").alias("packets"), total("total_bytes").alias("bytes"), _flows()))


def per_second_by_protocol(flows: DataFrame) -> DataFrame:
    return (flows.where(c("valid_from").isNotNull()).groupBy(start_second(), "protocol")
            .agg(total("flow_count").alias("packets")))


def smoothed(series: DataFrame, value: str, reach: int, by: list[str] | None = None,
             at: str = "second", piece: int = 100_000) -> DataFrame:
    """Centred moving average ``smooth`` of ``value`` over ``reach`` seconds to either side.

    The time line is cut into pieces; rows near a cut are lent to the neighbouring piece, so every window lies
    in one piece and no task sees the whole line.
    """
    check_at_least("reach", reach, 0)
    by = by or []
    piece = max(piece, 2 * reach + 1)
    home = F.floor(c(at) / piece)
    low, high = F.floor((c(at) - reach) / piece), F.floor((c(at) + reach) / piece)
    lent = series.withColumn("_home", home).withColumn("_piece", F.explode(F.sequence(low, high)))
    around = Window.partitionBy(*by, "_piece").orderBy(at).rangeBetween(-reach, reach)
    return (lent.withColumn("smooth", F.avg(value).over(around)).where(c("_piece") == c("_home"))
            .drop("_piece", "_home"))


def log_histogram(rows: DataFrame, value: Column, bins: int = 50) -> DataFrame:
    """Counts of ``log10(value)`` in equal bins between least and greatest: ``bin`` (from 1), ``low, high, n``.

    The range comes from a scalar subquery, so the rows are scanned without a join.
    """
    check_at_least("bins", bins, 1)
    logs = rows.where(value > 0).select(F.log10(value.cast("double")).alias("v"))
    low = logs.agg(F.min("v")).scalar()
    width = (logs.agg(F.max("v")).scalar() - low) / bins
    place = F.when(width > 0, F.least(F.floor((c("v") - low) / width) + 1, F.lit(bins))).otherwise(1)
    counted = logs.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("bin", (low + (c("bin") - 1) * width).alias("low"), (low + c("bin") * width).alias("high"), "n")


def duration_histogram(flows: DataFrame, bins: int = 50) -> DataFrame:
    return log_histogram(flows, (c("valid_to") - c("valid_from")) / 1000.0, bins)


def size_histogram(flows: DataFrame, bins: int = 50) -> DataFrame:
    return log_histogram(flows, c("total_bytes"), bins)


def packet_count_histogram(flows: DataFrame, bins: int = 50) -> DataFrame:
    return log_histogram(flows, c("flow_count"), bins)


def average_packet_size(flows: DataFrame) -> DataFrame:
    """Add ``avg_pkt_size``: bytes per packet, NULL for a flow without packets."""
    size = F.when(c("flow_count") > 0, c("total_bytes") / c("flow_count"))
    return flows.withColumn("avg_pkt_size", size)


def size_by_protocol(flows: DataFrame, exact: bool = True) -> DataFrame:
    """Five-number summary of the average packet size per protocol."""
    sized = average_packet_size(flows).where("avg_pkt_size is not null").select("protocol", "avg_pkt_size")
    probs = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "highest": 1.0}
    if exact:
        return quantiles(sized, ["protocol"], "avg_pkt_size", probs)
    marks = F.percentile_approx("avg_pkt_size", list(probs.values()), 10_000)
    return sized.groupBy("protocol").agg(marks.alias("q")).select(
        "protocol", *[c("q")[i].alias(n) for i, n in enumerate(probs)])


def pair_protocol_totals(flows: DataFrame) -> DataFrame:
    """The network's edges: ``src, dst, protocol`` with weight (packets), bytes and number of flows.

    ``first_edge`` remembers the order of the rows, for flows that have an edge id.
    """
    first = [F.min("edge_id").alias("first_edge")] if "edge_id" in flows.columns else []
    return flows.groupBy(c("src_ip").alias("src"), c("dst_ip").alias("dst"), "protocol").agg(
        total("flow_count").alias("weight"), total("total_bytes").alias("total_bytes"),
        F.count(F.lit(1)).alias("num_flows"), *first)


def all_vertices(flows: DataFrame, nodes_ip: DataFrame) -> DataFrame:
    """Every address: sources, targets and nodes without edges."""
    ends = flows.select(F.explode(F.array("src_ip", "dst_ip")).alias("ip"))
    return ends.union(nodes_ip.select("ip")).where("ip is not null").distinct()

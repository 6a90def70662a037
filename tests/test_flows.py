import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meshlark.operators import flows, flowstats, indicators
from meshlark.operators.maintenance import get_or_create
from meshlark.plans.ordered import _in_order, dense_ids, lead_in_buckets, quantiles, running_totals
from meshlark.sources.tables import PACKET_SCHEMA

PACKETS = [
    ("IP", "a", "b", "TCP", "52000", "443", 100, 10, 1500),
    ("IP", "a", "b", "TCP", "52001", "443", None, 11, 999999),
    ("IP", "b", "a", "TCP", "443", "52000", 60, 12, 0),
    ("ARP", "a", "b", None, None, None, 42, 9, 0),
    (None, "a", "b", None, None, None, 42, 9, 0),
    ("IP", "a", "c", "", "x", "53", None, 20, 0),
    ("IP", "a", "c", None, "5000", "x", None, 21, 500),
]


def test_packets_to_flows(spark):
    packets = spark.createDataFrame(PACKETS, PACKET_SCHEMA)
    got = {(r.src_ip, r.dst_ip, r.protocol, r.service_port): tuple(r)[4:] for r in flows.packets_to_flows(packets).select(
        "src_ip", "dst_ip", "protocol", "service_port", "service_name", "flow_count", "total_bytes", "valid_from", "valid_to").collect()}
    assert got == {
        ("a", "b", "TCP", 443): ("HTTPS", 2, 100.0, 10001, 11999),
        ("b", "a", "TCP", 443): ("HTTPS", 1, 60.0, 12000, 12000),
        ("a", "c", "IP", None): (None, 2, 0.0, 20000, 21000),
    }


def test_flow_edges(spark):
    packets = spark.createDataFrame(PACKETS, PACKET_SCHEMA)
    registry = get_or_create(flows.packet_ips(packets), "ip")
    made = flows.packets_to_flows(packets)
    edges = flows.flows_to_edges(made, registry).orderBy("edge_id").collect()
    assert [(r.edge_id, r.src, r.dst) for r in edges] == [(0, 0, 1), (1, 0, 2), (2, 1, 0)]
    assert edges[1].properties == {"flow_count": "2", "total_bytes": "0.0"}
    assert edges[2].valid_from == edges[2].valid_to == 12000
    typed = flows.flows_to_edges(made, registry, typed=True)
    assert typed.where("properties.service_port = 443").count() == 2


def test_chunks(spark):
    rnd = random.Random(1)
    rows = [("IP" if rnd.random() < .9 else "ARP", f"s{rnd.randrange(6)}", f"t{rnd.randrange(4)}", "TCP", "1", "80", 10, i, 0)
            for i in range(237)]
    packets = spark.createDataFrame(rows, PACKET_SCHEMA).repartition(7)
    got = [tuple(r) for r in flows.chunk_totals(packets, ["tv_sec"], 50).orderBy("chunk_id").collect()]
    seen, total_flows, want = set(), 0, []
    for n, at in enumerate(range(0, 237, 50)):
        part = rows[at:at + 50]
        ip = [r for r in part if r[0] == "IP"]
        seen |= {x for r in ip for x in r[1:3]}
        made = len({(r[1], r[2]) for r in ip})
        total_flows += made
        want.append((n, len(part), len(ip), made, min(at + 50, 237), total_flows, len(seen)))
    assert got == want
    run = {r.metric: r.n for r in flows.run_totals(packets, ["tv_sec"], 50).collect()}
    assert run == {"packets": 237, "ip_packets": sum(r[0] == "IP" for r in rows), "flows": total_flows, "unique_ips": len(seen)}


def flow_rows(spark, rows):
    return spark.createDataFrame(rows, "src_ip string, dst_ip string, protocol string, service_port int, service_name string, "
                                       "flow_count long, total_bytes double, valid_from long, valid_to long")


def test_half_even_and_zero(spark):
    rows = flow_rows(spark, [("a", "b", "TCP", 80, None, 2, 5.0, 0, 0), ("a", "c", "UDP", 80, None, 0, 0.0, 50, 90)])
    got = {r.protocol: r.avg_pkt_size for r in flowstats.protocol_bytes(rows).collect()}
    assert got == {"TCP": 2.0, "UDP": None}
    assert {r.avg_pkt_size for r in flowstats.average_packet_size(rows).collect()} == {2.5, None}
    assert flowstats.duration_histogram(rows).collect()[0].bin == 1
    empty = {r.metric: r.value for r in flowstats.capture_summary(rows.where("false"), rows.where("false")).collect()}
    assert empty["Avg packets per flow"] == 0.0 and empty["Time span (seconds)"] == 0.0


def test_ratio(spark):
    rows = spark.createDataFrame([(1, 8), (3, 8), (5, 0), (575, 1000)], "s long, r long")
    got = [r[0] for r in rows.select(indicators.send_receive_ratio(F.col("s"), F.col("r"))).collect()]
    assert got == [0.12, 0.38, float("inf"), 0.57] or got == [0.12, 0.38, float("inf"), 0.58]


def test_indicators(spark):
    rows = [("hot", f"t{i % 40}", "TCP", i % 9, None, 1, 1.0, 0, 0) for i in range(400)]
    rows += [(f"s{i}", "hot", "TCP", None, None, 2, 1.0, 0, 0) for i in range(30)]
    profile = indicators.address_profile(flow_rows(spark, rows))
    hot = profile.where("src_ip = 'hot'").first()
    assert (hot.unique_dst_ips, hot.unique_svc_ports, hot.packets_sent, hot.flows_in, hot.packets_received) == (40, 9, 400, 30, 60)
    assert profile.where("src_ip = 's1'").first().send_recv_ratio == float("inf")
    assert [r.src_ip for r in indicators.scanners(profile).collect()] == ["hot"]
    assert [r.src_ip for r in indicators.port_reconnaissance(profile).collect()] == ["hot"]
    assert [r.src_ip for r in indicators.asymmetry(profile).collect()] == ["hot"]


def test_smoothed_pieces(spark):
    rnd = random.Random(2)
    rows = sorted({(rnd.randrange(500), "x") for _ in range(120)})
    frame = pd.DataFrame([(s, p, float(s % 17)) for s, p in rows], columns=["second", "p", "v"])
    want = {r.second: frame[(frame.second - r.second).abs() <= 7].v.mean() for r in frame.itertuples()}
    got = flowstats.smoothed(spark.createDataFrame(frame), "v", 7, ["p"], piece=20).collect()
    assert {r.second: round(r.smooth, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}


# ---- order helpers --------------------------------------------------------------------------------------


def hot_frame():
    rnd = random.Random(3)
    return pd.DataFrame([("hot" if i % 3 else f"g{i % 5}", i, rnd.randrange(50)) for i in range(300)], columns=["g", "t", "v"])


@pytest.mark.parametrize("hot", [False, True])
def test_lead_in_buckets(spark, hot, request):
    if hot:
        request.getfixturevalue("hot_keys")
    frame = hot_frame()
    rows = spark.createDataFrame(frame).repartition(6)
    got = lead_in_buckets(rows, ["g"], "t", 40, ["v"], ["t", "v"], "next")
    assert got.columns == ["g", "t", "v", "next"]
    want = frame.sort_values("t").groupby("g").t.shift(-1)
    assert {r.t: (r.next.t if r.next else None) for r in got.collect()} == {
        t: (None if pd.isna(x) else int(x)) for t, x in zip(frame.t, want)}


def test_dense_ids(spark):
    frame = hot_frame()
    rows = spark.createDataFrame(frame).repartition(6)
    got = dense_ids(rows, "id", 10, ["g", "t"]).orderBy("id").collect()
    assert [r.id for r in got] == list(range(10, 310))
    assert [(r.g, r.t) for r in got] == sorted(zip(frame.g, frame.t))
    assert dense_ids(rows.where("false"), "id").count() == 0


def test_dense_ids_spread_copies(spark):
    """A third of the rows are copies: no piece may hold them all."""
    rows = spark.range(3000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tiny pieces would be merged again
    try:
        placed = _in_order(rows, ["k"]).where("k = 0").groupBy("_piece").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(placed) > 1 and sum(r["count"] for r in placed) == 1000
    got = dense_ids(rows, "id", 0, ["k"]).orderBy("id").collect()
    assert [r.id for r in got] == list(range(3000)) and [r.k for r in got] == sorted(r.k for r in got)


@pytest.mark.parametrize("parts", [1, 7])
def test_running_totals(spark, parts):
    frame = hot_frame()
    frame.loc[frame.t % 10 == 0, "g"] = None
    rows = spark.createDataFrame(list(frame.itertuples(index=False, name=None)), "g string, t long, v long")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = running_totals(rows, ["g"], ["t"], {"s": F.col("v")}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = frame.assign(g=frame.g.fillna("-")).sort_values("t").groupby("g").v.cumsum()
    assert {r.t: r.s for r in got} == {int(frame.t[i]): int(x) for i, x in want.items()}


def test_quantiles(spark):
    frame = hot_frame()
    probs = {"q0": 0.0, "q25": .25, "q50": .5, "q9": .9, "q1": 1.0}
    got = quantiles(spark.createDataFrame(frame), ["g"], "v", probs).collect()
    for r in got:
        values = frame[frame.g == r.g].v.to_numpy()
        assert [r[n] for n in probs] == pytest.approx(np.quantile(values, list(probs.values())).tolist())

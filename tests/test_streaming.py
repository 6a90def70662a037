import random

from pyspark.sql import functions as F

from meshlark.operators import anomaly
from meshlark.sources.tables import PACKET_SCHEMA, stream_packets
from meshlark.streaming import alerts, flows, sinks

HOUR = 3_600_000


def packet_files(spark, folder, files=3, n=120):
    """Packets in time order, a later file holding later packets; one address owns a third."""
    rnd = random.Random(9)
    rows = [("IP" if i % 9 else "ARP", "hot" if i % 3 == 0 else f"s{rnd.randrange(5)}", f"t{rnd.randrange(4)}", "TCP",
             "50000", "443", 10, i * 30 + rnd.randrange(30), 0) for i in range(n)]
    for at in range(files):
        part = rows[at * n // files:(at + 1) * n // files]
        spark.createDataFrame(part, PACKET_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return rows


def test_windows_equal_batch(spark, tmp_path):
    folder = str(tmp_path / "packets")
    rows = packet_files(spark, folder)
    end = max(r[7] for r in rows) - 60
    stream = flows.windowed_flows(stream_packets(spark, folder, files_per_batch=1), "5 minutes", "1 minute")
    sinks.run_available(stream, str(tmp_path / "c"), path=str(tmp_path / "out"))
    batch = flows.windowed_flows(spark.createDataFrame(rows, PACKET_SCHEMA), "5 minutes", None)
    want = sorted(tuple(r) for r in batch.where(F.unix_seconds("window_end") <= end).collect())
    got = sorted(tuple(r) for r in spark.read.schema(batch.schema).parquet(str(tmp_path / "out")).collect())
    assert got == want and want


def test_sessions_equal_batch(spark, tmp_path):
    folder = str(tmp_path / "packets")
    rows = packet_files(spark, folder)
    end = max(r[7] for r in rows) - 60
    stream = flows.session_flows(stream_packets(spark, folder, files_per_batch=1), "3 minutes", "1 minute")
    sinks.run_available(stream, str(tmp_path / "c"), path=str(tmp_path / "out"))
    batch = flows.session_flows(spark.createDataFrame(rows, PACKET_SCHEMA), "3 minutes", None)
    want = sorted(tuple(r) for r in batch.where(F.unix_seconds("session_end") <= end).collect())
    got = sorted(tuple(r) for r in spark.read.schema(batch.schema).parquet(str(tmp_path / "out")).collect())
    assert got == want and want


def test_graph_sink_batches_and_replay(spark, tmp_path):
    folder, out = str(tmp_path / "packets"), str(tmp_path / "graph")
    rows = packet_files(spark, folder)
    sinks.run_available(stream_packets(spark, folder, files_per_batch=1), str(tmp_path / "c"), sinks.graph_sink(out))
    graph = sinks.read_sink(spark, out)
    ips = {x for r in rows if r[0] == "IP" for x in r[1:3]}
    known = {r.properties["ip"]: r.node_id for r in graph.nodes.collect()}
    assert set(known) == ips and sorted(known.values()) == list(range(len(ips)))
    assert graph.edges.count() == graph.edges.select("edge_id").distinct().count()
    total = graph.edges.agg(F.sum(F.col("properties")["flow_count"].cast("long"))).first()[0]
    assert total == sum(r[0] == "IP" for r in rows)
    before = sorted((r.edge_id, r.src, r.dst) for r in graph.edges.collect())
    again = sinks.graph_sink(out)
    for batch_id in (0, 2, 1):  # a restart may repeat batches
        part = spark.createDataFrame(sorted(rows, key=lambda r: r[7])[batch_id * 40:(batch_id + 1) * 40], PACKET_SCHEMA)
        again(part, batch_id)
    after = sinks.read_sink(spark, out)
    assert sorted((r.edge_id, r.src, r.dst) for r in after.edges.collect()) == before
    assert {r.properties["ip"]: r.node_id for r in after.nodes.collect()} == known


def test_alerts_equal_batch(spark, tmp_path):
    rnd = random.Random(11)
    rows = []
    for hour in range(40):
        for entity in range(4):
            n = rnd.randrange(3) if (hour + entity) % 11 else 12
            rows += [(entity, True, hour * HOUR + rnd.randrange(HOUR)) for _ in range(n)]
    schema = "entity_id long, is_node boolean, at_ms long"
    folder = str(tmp_path / "events")
    rows.sort(key=lambda r: r[2])
    for at in range(4):
        part = rows[at * len(rows) // 4:(at + 1) * len(rows) // 4]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    rule = anomaly.Baseline(bucket_ms=HOUR)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = str(tmp_path / "out")
    sinks.run_available(alerts.closed_buckets(stream, rule, "1 hour"), str(tmp_path / "c"), alerts.score_batches(out, rule))
    closed = (max(r[2] for r in rows) - HOUR) // HOUR
    scores = anomaly.anomaly_scores(anomaly.activity_profile(anomaly.bucket_counts(spark.createDataFrame(rows, schema), rule)), rule)
    want = {(r.entity_id, r.bucket, round(r.score, 9)) for r in scores.where("score >= threshold").collect() if r.bucket < closed}
    got = {(r.entity_id, r.bucket, round(r.score, 9)) for r in alerts.read_alerts(spark, out).collect()}
    assert got == want and want
    assert alerts.read_alerts(spark, str(tmp_path / "none")).count() == 0
    # The same with keyed state, over the same four batches.
    again = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    keyed = alerts.keyed_alerts(alerts.closed_buckets(again, rule, "1 hour"), rule)
    alerts.run_keyed(keyed, str(tmp_path / "k"), str(tmp_path / "keyed"))
    rows = spark.read.schema(alerts.ALERTS).parquet(str(tmp_path / "keyed")).collect()
    assert {(r.entity_id, r.bucket, round(r.score, 9)) for r in rows} == want


def test_registry_reads_no_earlier_batch(spark, tmp_path, monkeypatch):
    """Ids are dense over all batches; a batch looks at its own new addresses and one number."""
    folder, out = str(tmp_path / "packets"), str(tmp_path / "registry")
    rows = packet_files(spark, folder, files=5)
    reads = []
    plain = sinks.read_batches
    monkeypatch.setattr(sinks, "read_batches", lambda *a: reads.append(a[1:]) or plain(*a))
    stream = sinks.first_addresses(stream_packets(spark, folder, files_per_batch=1))
    sinks.run_available(stream, str(tmp_path / "c"), sinks.number_first_addresses(out))
    assert len(reads) <= 1  # the first batch only, which finds no mark
    known = {r.ip: r.node_id for r in sinks.read_registry(spark, out).collect()}
    ips = {x for r in rows if r[0] == "IP" for x in r[1:3]}
    assert set(known) == ips and sorted(known.values()) == list(range(len(ips)))
    new = [sorted(i for i in ips if i in {x for r in part if r[0] == "IP" for x in r[1:3]}) for part in [rows[:24]]][0]
    assert [known[i] for i in new] == list(range(len(new)))
    # A repeated batch gives the same ids again.
    second = plain(spark, f"{out}/ids", sinks.REGISTRY_SCHEMA, 1).select("ip")
    sinks.number_first_addresses(out)(second, 0)
    assert {r.ip: r.node_id for r in sinks.read_registry(spark, out).collect()} == known


def test_run_totals_are_observed(spark, tmp_path):
    from pyspark.sql.streaming import StreamingQueryListener

    folder = str(tmp_path / "packets")
    rows = packet_files(spark, folder)
    seen = []

    class Listen(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            found = event.progress.observedMetrics.get("totals")
            if found is not None:
                seen.append((found.packets, found.ip_packets))

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            pass

    listener = Listen()
    spark.streams.addListener(listener)
    try:
        counted = sinks.run_totals(stream_packets(spark, folder, files_per_batch=1))
        sinks.run_available(counted, str(tmp_path / "c"), lambda df, batch_id: df.write.format("noop").mode("overwrite").save())
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert sum(p for p, _ in seen) == len(rows) and sum(i for _, i in seen) == sum(r[0] == "IP" for r in rows)

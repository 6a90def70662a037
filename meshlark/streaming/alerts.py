"""Continuous anomaly alerts.

Spark counts activity per entity and bucket with partial counts before the shuffle, so a busy entity is no hot
task. Closed buckets are appended to a table and scored against the buckets before them. Only the part of the
table that a baseline can reach is read: buckets arrive in time order, so file statistics skip the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from meshlark.operators.anomaly import Baseline
from meshlark.plans.lineage import forget, store
from meshlark.streaming.sinks import read_batches, run_available, write_batch

COUNTS = T.StructType([
    T.StructField("entity_id", T.LongType()), T.StructField("is_node", T.BooleanType()),
    T.StructField("bucket", T.LongType()), T.StructField("activity", T.LongType())])
FIRSTS = T.StructType([
    T.StructField("entity_id", T.LongType()), T.StructField("is_node", T.BooleanType()),
    T.StructField("first_bucket", T.LongType())])
ENTITY = ["entity_id", "is_node"]


def closed_buckets(activity: DataFrame, rule: Baseline, delay: str) -> DataFrame:
    """Counts per entity and bucket of a stream ``entity_id, is_node, at_ms``; written once a bucket is closed."""
    timed = activity.withColumn("ts", F.timestamp_millis("at_ms")).withWatermark("ts", delay)
    counted = (timed.groupBy(F.window("ts", f"{rule.bucket_ms} milliseconds").alias("w"), *ENTITY)
               .agg(F.count(F.lit(1)).alias("activity")))
    bucket = F.floor(F.unix_millis("w.start") / rule.bucket_ms).cast("long")
    return counted.select(*ENTITY, bucket.alias("bucket"), "activity")


def score_batches(path: str, rule: Baseline = Baseline()) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: append closed buckets and write those that score at or above the threshold."""

    def each(counts: DataFrame, batch_id: int) -> None:
        spark = counts.sparkSession
        fresh = store(counts.select(*COUNTS.fieldNames()), least=F.min("bucket"))
        write_batch(fresh.df, batch_id, f"{path}/counts")
        known = read_batches(spark, f"{path}/firsts", FIRSTS, batch_id)
        starts = fresh.df.groupBy(*ENTITY).agg(F.min("bucket").alias("first_bucket"))
        write_batch(starts.join(known, ENTITY, "left_anti").select(*FIRSTS.fieldNames()), batch_id, f"{path}/firsts")
        if not fresh.rows:
            forget(fresh)
            return
        firsts = read_batches(spark, f"{path}/firsts", FIRSTS, batch_id + 1).join(
            starts.select(*ENTITY), ENTITY, "left_semi")
        past = (read_batches(spark, f"{path}/counts", COUNTS, batch_id)
                .where(F.col("bucket") >= fresh.measures["least"] - rule.width)
                .join(starts.select(*ENTITY), ENTITY, "left_semi"))
        rows = past.withColumn("fresh", F.lit(False)).unionByName(fresh.df.withColumn("fresh", F.lit(True)))
        write_batch(score_sparse(rows, firsts, rule).where("fresh and score >= threshold")
                    .select(*ENTITY, "bucket", "activity", "score"), batch_id, f"{path}/alerts")
        forget(fresh)

    return each


def score_sparse(rows: DataFrame, firsts: DataFrame, rule: Baseline) -> DataFrame:
    """Scores of non-empty buckets without filling the empty ones: they add nothing to the sums, and how many
    there are follows from the entity's first bucket.
    """
    before = Window.partitionBy(*ENTITY).orderBy("bucket").rangeBetween(-rule.width, -1)
    summed = (rows.withColumn("_s", F.coalesce(F.sum("activity").over(before), F.lit(0)))
              .withColumn("_q", F.coalesce(F.sum(F.col("activity") * F.col("activity")).over(before), F.lit(0)))
              .join(firsts, ENTITY))
    n = F.least(F.lit(rule.width), F.col("bucket") - F.col("first_bucket"))
    mean = F.try_divide(F.col("_s").cast("double"), n.cast("double"))
    spread = F.sqrt(F.greatest(F.try_divide(F.col("_q") - F.col("_s") * mean, (n - 1).cast("double")), F.lit(0.0)))
    score = (F.col("activity") - mean) / F.greatest(spread, F.lit(rule.floor))
    return summed.withColumn("score", F.when(n >= rule.least, score)).withColumn("threshold", F.lit(rule.threshold))


ALERTS = T.StructType([*COUNTS.fields, T.StructField("score", T.DoubleType())])


def read_alerts(spark, path: str) -> DataFrame:
    return read_batches(spark, f"{path}/alerts", ALERTS)


# ---- the same with what a baseline needs in keyed state ---------------------------------------------------

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Trailing(StatefulProcessor):
    """Of each entity its first bucket and the buckets that later baselines can still reach: at most ``width``."""

    def __init__(self, rule: Baseline):
        self.rule = rule

    def init(self, handle) -> None:
        self.trail = handle.getValueState("trail", "first_bucket long, buckets array<long>, counts array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        rule, found = self.rule, []
        first, buckets, counts = self.trail.get() if self.trail.exists() else (None, [], [])
        buckets, counts = list(buckets), list(counts)
        fresh = sorted((int(b), int(n)) for part in rows for b, n in zip(part["bucket"], part["activity"]))
        for bucket, activity in fresh:
            first = bucket if first is None else first
            reach = [n for b, n in zip(buckets, counts) if bucket - rule.width <= b < bucket]
            n, total, squares = min(rule.width, bucket - first), sum(reach), sum(x * x for x in reach)
            if n >= max(rule.least, 1):
                spread = ((n * squares - total * total) / (n * (n - 1))) ** 0.5 if n > 1 else 0.0
                score = (activity - total / n) / max(spread, rule.floor)
                if score >= rule.threshold:
                    found.append((key[0], key[1], bucket, activity, score))
            held = [(b, x) for b, x in zip(buckets, counts) if b > bucket - rule.width] + [(bucket, activity)]
            buckets, counts = [b for b, _ in held], [x for _, x in held]
        self.trail.update((first, buckets, counts))
        if found:
            yield pd.DataFrame(found, columns=ALERTS.fieldNames())

    def close(self) -> None:
        pass


def keyed_alerts(counts: DataFrame, rule: Baseline = Baseline()) -> DataFrame:
    """``entity_id, is_node, bucket, activity, score`` at or above the threshold, of a stream of ``closed_buckets``.

    The state store keeps one row of bounded size for each entity; a batch reads those of its own entities and no
    earlier batch. Needs the session's state store to be RocksDB (``ROCKS``); ``run_keyed`` sees to that.
    """
    return counts.groupBy(*ENTITY).transformWithStateInPandas(
        statefulProcessor=_Trailing(rule), outputStructType=ALERTS, outputMode="Append", timeMode="None")


def run_keyed(rows: DataFrame, checkpoint: str, path: str) -> None:
    """``sinks.run_available`` into Parquet files at ``path``, with RocksDB as the state store of this query."""
    conf, name = rows.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, ROCKS)
    try:
        run_available(rows, checkpoint, path=path)
    finally:
        conf.set(name, before)

"""Unusual activity of nodes or edges against their own trailing baseline.

An entity's activity is counted per time bucket. A bucket's score is ``(count - mean) / max(std, floor)`` over
the ``width`` buckets before it; fewer than ``least`` earlier buckets give no score (``no_data``). Empty buckets are never
made for that: they add nothing to the sums, and how many of them there are follows from the entity's first bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshlark.plans.topk import top_k


ENTITY = ["entity_id", "is_node"]
#: Buckets of a gap that are listed at a time.
STRETCH = 100_000


@dataclass(frozen=True)
class Baseline:
    bucket_ms: int = 3_600_000
    width: int = 7
    least: int = 3
    floor: float = 1.0
    threshold: float = 3.0


def node_activity(edges: DataFrame) -> DataFrame:
    """``entity_id, is_node, at_ms``: an edge with a start time counts once for each of its two ends."""
    timed = edges.where(F.col("valid_from").isNotNull())
    ends = F.explode(F.array_distinct(F.array("src", "dst")))
    return timed.select(ends.alias("entity_id"), F.lit(True).alias("is_node"), F.col("valid_from").alias("at_ms"))


def edge_activity(edges: DataFrame) -> DataFrame:
    """``entity_id, is_node, at_ms`` per edge id."""
    return edges.where(F.col("valid_from").isNotNull()).select(
        F.col("edge_id").alias("entity_id"), F.lit(False).alias("is_node"), F.col("valid_from").alias("at_ms"))


def bucket_counts(activity: DataFrame, rule: Baseline = Baseline()) -> DataFrame:
    """Non-empty buckets: ``entity_id, is_node, bucket, activity`` (bucket = its number since the epoch)."""
    return (activity.withColumn("bucket", _bucket_of(F.col("at_ms"), rule))
            .groupBy("entity_id", "is_node", "bucket").agg(F.count(F.lit(1)).alias("activity")))


def activity_profile(counts: DataFrame) -> DataFrame:
    """List the empty buckets between an entity's first and last bucket as 0: a calendar for display.

    Each non-empty bucket emits the gap up to the next one, in stretches that fit an array.
    """
    order = Window.partitionBy(*ENTITY).orderBy("bucket")
    until = F.coalesce(F.lead("bucket").over(order) - 1, F.col("bucket"))
    stretches = counts.withColumn("_until", until).withColumn(
        "_from", F.explode(F.sequence(F.col("bucket"), F.col("_until"), F.lit(STRETCH))))
    last = F.least(F.col("_until"), F.col("_from") + STRETCH - 1)
    filled = stretches.withColumn("_at", F.explode(F.sequence(F.col("_from"), last)))
    return filled.select(*ENTITY, F.col("_at").alias("bucket"),
                         F.when(F.col("_at") == F.col("bucket"), F.col("activity")).otherwise(0).alias("activity"))


def _scored(rows: DataFrame, n: Column, total: Column, squares: Column, rule: Baseline) -> DataFrame:
    """Add ``mean, std, score, threshold``: of ``n`` earlier buckets with these sums of counts and of their squares."""
    mean = F.try_divide(total, n.cast("double"))
    # Sums of whole numbers: no difference of nearly equal fractions.
    std = F.sqrt(F.greatest(F.try_divide(n * squares - total * total, (n * (n - 1)).cast("double")), F.lit(0.0)))
    ready = (n >= rule.least) & (n > 0)
    score = (F.col("activity") - mean) / F.greatest(std, F.lit(rule.floor))
    return rows.withColumns({
        "mean": F.when(ready, mean), "std": F.when(ready & (n > 1), std),
        "score": F.when(ready, score), "threshold": F.lit(rule.threshold)})


def anomaly_scores(counts: DataFrame, rule: Baseline = Baseline(), firsts: DataFrame | None = None) -> DataFrame:
    """The listed buckets with their baseline ``mean`` and ``std``, ``score`` and ``threshold``.

    ``counts`` need not list empty buckets; those it lists are scored too. ``firsts(entity_id, is_node, first_bucket)``
    says when each entity was first active, for counts that do not reach back to there.
    """
    before = Window.partitionBy(*ENTITY).orderBy("bucket").rangeBetween(-rule.width, -1)
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    size = F.col("activity").cast("double")
    framed = counts.withColumn("_s", zero(F.sum(size).over(before))).withColumn("_q", zero(F.sum(size * size).over(before)))
    if firsts is None:
        framed = framed.withColumn("first_bucket", F.min("bucket").over(Window.partitionBy(*ENTITY)))
    else:
        framed = framed.join(firsts, ENTITY)
    n = F.least(F.lit(rule.width), F.col("bucket") - F.col("first_bucket"))
    scored = _scored(framed, n, F.col("_s"), F.col("_q"), rule)
    return scored.select(*ENTITY, "bucket", "activity", "mean", "std", "score", "threshold")


def _wanted(activity: DataFrame, entities: DataFrame, is_node: bool) -> DataFrame:
    kept = activity.where(F.col("is_node") == is_node)
    return kept.join(entities.select("entity_id").distinct(), "entity_id", "left_semi")


def _bucket_of(at_ms: Column | int, rule: Baseline) -> Column:
    return F.floor((F.lit(at_ms) if isinstance(at_ms, int) else at_ms) / rule.bucket_ms)


def first_buckets(activity: DataFrame, rule: Baseline = Baseline()) -> DataFrame:
    """``entity_id, is_node, first_bucket``; one small aggregation over the activity, kept by callers that ask often."""
    return activity.groupBy(*ENTITY).agg(_bucket_of(F.min("at_ms"), rule).alias("first_bucket"))


def latest_scores(activity: DataFrame, rule: Baseline = Baseline(), as_of: int | None = None,
                  firsts: DataFrame | None = None) -> DataFrame:
    """``entity_id, is_node, bucket, activity, score, threshold`` of one bucket of each entity.

    Without ``as_of`` that is its last non-empty bucket; only the last ``width + 1`` non-empty ones are gathered. With
    ``as_of`` (epoch milliseconds) it is the bucket of that time for every entity first active by then, empty or not:
    later activity does not exist, and with ``firsts`` only ``width + 1`` buckets of the activity are read.
    """
    if as_of is not None:
        now = as_of // rule.bucket_ms
        until = activity.where(F.col("at_ms") < (now + 1) * rule.bucket_ms)
        firsts = (first_buckets(until, rule) if firsts is None else firsts).where(F.col("first_bucket") <= now)
        recent = bucket_counts(until.where(F.col("at_ms") >= (now - rule.width) * rule.bucket_ms), rule)
        ends = firsts.withColumn("bucket", F.lit(now).cast("long"))
    else:
        counts = bucket_counts(activity, rule)
        recent = top_k(counts, ENTITY, [F.col("bucket").desc()], rule.width + 1, "_rank").drop("_rank")
        firsts = first_buckets(activity, rule) if firsts is None else firsts
        ends = recent.groupBy(*ENTITY).agg(F.max("bucket").alias("bucket")).join(firsts, ENTITY)
    seen = recent.withColumnRenamed("bucket", "_at").join(ends.select(*ENTITY, "bucket"), ENTITY)
    size = F.col("activity").cast("double")
    earlier = (F.col("_at") < F.col("bucket")) & (F.col("_at") >= F.col("bucket") - rule.width)
    sums = seen.groupBy(*ENTITY).agg(
        F.sum(F.when(F.col("_at") == F.col("bucket"), F.col("activity"))).alias("activity"),
        F.sum(F.when(earlier, size)).alias("_s"), F.sum(F.when(earlier, size * size)).alias("_q"))
    whole = ends.join(sums, ENTITY, "left").fillna(0, ["activity", "_s", "_q"])
    n = F.least(F.lit(rule.width), F.col("bucket") - F.col("first_bucket"))
    return _scored(whole, n, F.col("_s"), F.col("_q"), rule).select(*ENTITY, "bucket", "activity", "score", "threshold")


def anomaly_stats(activity: DataFrame, entities: DataFrame, is_node: bool = True,
                  rule: Baseline = Baseline(), empty_buckets: bool = True) -> DataFrame:
    """Score history of the requested ``entities(entity_id)``: all buckets from the first to the last, or without
    ``empty_buckets`` only those with activity (for histories with gaps too long to list)."""
    counts = bucket_counts(_wanted(activity, entities, is_node), rule)
    return anomaly_scores(activity_profile(counts) if empty_buckets else counts, rule)


def anomaly_check(activity: DataFrame, entities: DataFrame, is_node: bool = True, rule: Baseline = Baseline(),
                  as_of: int | None = None, firsts: DataFrame | None = None) -> DataFrame:
    """State per requested entity: ``status`` is ``anomalous``, ``normal`` or ``no_data``; of its last active bucket, or
    as of a time (see ``latest_scores``)."""
    last = latest_scores(_wanted(activity, entities, is_node), rule, as_of, firsts).drop("is_node")
    status = (F.when(F.col("score").isNull(), "no_data")
              .when(F.col("score") >= rule.threshold, "anomalous").otherwise("normal"))
    return (entities.select("entity_id").distinct().join(last, "entity_id", "left")
            .select("entity_id", F.lit(is_node).alias("is_node"), "bucket", "score", status.alias("status")))


def anomaly_alerts(activity: DataFrame, rule: Baseline = Baseline(), as_of: int | None = None,
                   firsts: DataFrame | None = None) -> DataFrame:
    """All entities that score at or above the threshold in their last active bucket, or as of a time."""
    scores = latest_scores(activity, rule, as_of, firsts)
    return scores.where(F.col("score") >= rule.threshold).select(*ENTITY, "bucket", "score")

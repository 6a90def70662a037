"""Order-dependent columns without a global single-task window.

``lead`` over a huge group, running totals and dense row ids all need the neighbours of a row in some order.
A plain window would sort a whole group in one task. These helpers cut the order into pieces, do the work per
piece, and carry one small row per piece across.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshlark.plans import skew
from meshlark.plans.lineage import store


def _buckets(df: DataFrame, group: Sequence[str], at: str, width: int) -> DataFrame:
    """Add ``_bucket`` and, inside it, ``_part``: stretches of the order that no single task is too small for.

    A bucket of one group with more rows than a slice is cut into equal stretches of ``at``. At most
    ``MAX_HOT_KEYS`` buckets can be that full, so their list can be broadcast.
    """
    cut = df.withColumn("_bucket", F.floor(F.col(at) / width))
    total = cut.count()
    if total <= skew.MIN_SLICE_ROWS:
        return cut.withColumn("_part", F.lit(0).cast("long"))
    slice_rows = max(skew.MIN_SLICE_ROWS, -(-total // skew.MAX_HOT_KEYS))
    keys = [*group, "_bucket"]
    full = (cut.groupBy(*keys).count().where(F.col("count") > slice_rows)
            .select(*keys, F.ceil(F.col("count") / slice_rows).alias("_parts")))
    inside = F.col(at) - F.col("_bucket") * width
    return (cut.join(F.broadcast(full), keys, "left")
            .withColumn("_part", F.coalesce(F.floor(inside * F.col("_parts") / width), F.lit(0)))
            .drop("_parts"))


def lead_in_buckets(df: DataFrame, group: Sequence[str], at: str, width: int, ties: Sequence[str],
                    take: Sequence[str], into: str) -> DataFrame:
    """Add struct ``into``: columns ``take`` of the next row of the group, ordered by number ``at`` and ``ties``.

    The window runs per (group, bucket of ``at``); only the last row of a bucket needs the first row of the next
    non-empty bucket, found on one row per bucket.
    """
    cut = _buckets(df, group, at, width)
    keys, order = [*group, "_bucket", "_part"], [at, *ties]
    inside = Window.partitionBy(*keys).orderBy(*order)
    heads = cut.groupBy(*keys).agg(F.min_by(F.struct(*take), F.struct(*order)).alias("_head"))
    after = Window.partitionBy(*group).orderBy("_bucket", "_part")
    heads = heads.select(*keys, F.lead("_head").over(after).alias("_next_head"))
    return (
        cut.withColumn("_inside", F.lead(F.struct(*take)).over(inside))
        .join(heads, keys)
        .withColumn(into, F.coalesce("_inside", "_next_head"))
        .select(*df.columns, into)
    )


def _in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partition and sort by ``order``; store each row with its piece number and place in it.

    Rows with equal order columns are told apart by a hash of the row, and copies of a row by the partition they
    come from, so that many equal rows still spread over several pieces.
    """
    arranged = df
    if order:
        hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
        tagged = df.withColumns({"_hash": F.xxhash64(*hashed), "_from": F.spark_partition_id()})
        keys = [*order, "_hash", "_from"]
        arranged = tagged.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = arranged.select(
        *df.columns,
        F.spark_partition_id().alias("_piece"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_place"),
    )
    return store(placed).df


def dense_ids(df: DataFrame, name: str, start: int = 0, order: Sequence[str] = ()) -> DataFrame:
    """Number all rows ``start, start + 1, ...`` in ``order`` (or in input order) without gaps.

    Two passes: count rows per piece, then add each piece's offset. The offsets table has one row per piece.
    """
    placed = _in_order(df, order)
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_piece").count()
        .select("_piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    numbered = placed.join(F.broadcast(offsets), "_piece")
    return numbered.select((F.col("_place") + F.col("_offset") + start).alias(name), *df.columns)


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe match of group keys, because a key may be NULL (for example an unknown port)."""
    match = F.lit(True)
    for key in keys:
        match = match & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return match


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str],
                   totals: dict[str, Column]) -> DataFrame:
    """Inclusive running sums of ``totals`` per ``group`` along ``order``, for groups of any size.

    Rows are range-partitioned by (group, order); a window runs inside each piece. Only the first group of a
    piece can go on from earlier pieces, so at most one carry row per piece is sent to all tasks.
    """
    named = df.select("*", *[column.alias(f"_add_{name}") for name, column in totals.items()])
    placed = _in_order(named, [*group, *order])
    inside = Window.partitionBy("_piece", *group).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = placed.groupBy("_piece", *group).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_add_{n}").alias(f"_sum_{n}") for n in totals])
    carried = pieces.select(
        "_piece", *group, F.sum("_rows").over(before).alias("_earlier"),
        *[F.sum(f"_sum_{n}").over(before).alias(f"_carry_{n}") for n in totals]).where("_earlier > 0")
    local = placed.select(
        *df.columns, "_piece", *[F.sum(f"_add_{n}").over(inside).alias(f"_run_{n}") for n in totals])
    match = (F.col("l._piece") == F.col("r._piece")) & _same("l", "r", group)
    return local.alias("l").join(F.broadcast(carried.alias("r")), match, "left").select(
        *[F.col(f"l.{c}") for c in df.columns],
        *[(F.col(f"l._run_{n}") + F.coalesce(F.col(f"r._carry_{n}"), F.lit(0))).alias(n) for n in totals],
    )


def quantiles(df: DataFrame, group: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles (type 7) per group; no group is ever gathered in one task.

    Equal values are counted first. Running totals over the distinct values give every value its rank range;
    each requested rank picks at most two values, and the interpolation happens on those.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(counted, group, [value], {"_upto": F.col("_n")})
    # Written, so that Spark knows how small it is: one row per group.
    sizes = store(counted.groupBy(*group).agg(F.sum("_n").alias("_size"))).df
    rows = ranked.alias("l").join(sizes.alias("r"), _same("l", "r", group)).select(
        *[F.col(f"l.{c}") for c in (*group, value, "_n", "_upto")], F.col("r._size"))
    picks = []
    for name, p in probs.items():
        at = (F.col("_size") - 1) * F.lit(float(p))
        low = F.floor(at)
        first = F.col("_upto") - F.col("_n")
        holds = lambda rank: (rank >= first) & (rank < F.col("_upto"))
        picks += [
            F.max(F.when(holds(low), F.col(value))).alias(f"_{name}_low"),
            F.max(F.when(holds(F.ceil(at)), F.col(value))).alias(f"_{name}_high"),
            F.max(at - low).alias(f"_{name}_part"),
        ]
    found = rows.groupBy(*group).agg(*picks)
    return found.select(*group, *[
        (F.col(f"_{n}_low") + (F.col(f"_{n}_high") - F.col(f"_{n}_low")) * F.col(f"_{n}_part")).alias(n)
        for n in probs])

"""Mixing sources by temperature: token shares are raised to an exponent, found by bisection, and realised as whole
and partial permutations of blocks. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshlark.plans.lineage import store

#: The exponent is searched in steps of one millionth, so that the result does not hang on the last bit.
GRID = 1_000_000
#: Inner points that one aggregation tries.
POINTS = 31
#: Tokens of a block: what one task permutes.
BLOCK_TOKENS = 1_000_000
_ADDED = ("mix_epoch", "mix_block", "mix_key", "mix_tokens")


def word_count(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(r"[^\x09-\x0D ]+")).cast("long")


def _least_exponent(sources: DataFrame, largest: int, fits: Callable[[float, float, float, float], bool]) -> int:
    """Least grid point where ``fits(alpha, sum, log_sum, least_share)`` holds; it holds from some point on.

    ``sum`` adds ``(t / largest) ** alpha`` over the sources, ``log_sum`` the same times ``ln(t / largest)``.
    Every round is one aggregation of three numbers per inner point.
    """
    low, high = 0, GRID
    while low < high:
        points = sorted({low + (high - low) * k // (POINTS + 1) for k in range(POINTS + 1)})
        share = F.col("tokens") / F.lit(float(largest))
        found = sources.agg(*[e for i, p in enumerate(points) for e in (
            F.sum(F.pow(share, F.lit(p / GRID))).alias(f"z{i}"),
            F.sum(F.pow(share, F.lit(p / GRID)) * F.log(share)).alias(f"l{i}"))], F.min(share).alias("least")).first()
        good = [fits(p / GRID, found[f"z{i}"], found[f"l{i}"], found["least"]) for i, p in enumerate(points)]
        first = good.index(True) if True in good else len(points)
        low, high = (points[first - 1] + 1 if first else low), (points[first] if first < len(points) else high)
    return low


def temperature(sources: DataFrame, budget: int, most_repeats: float | None = 2.0, least_entropy: float | None = None
                ) -> tuple[float, float, int]:
    """Exponent, sum of powers and largest source for ``sources`` (column ``tokens``, all above 0).

    With ``most_repeats`` the least exponent (the flattest mix) at which no source is read more often than that,
    as far as the budget allows; with ``least_entropy``, a share of the logarithm of the number of sources, the
    largest exponent (the most natural mix) that reaches it.
    """
    total, largest, n = sources.agg(F.sum("tokens"), F.max("tokens"), F.count(F.lit(1))).first()
    if not n:
        return 1.0, 1.0, 1
    if least_entropy is not None:
        target = least_entropy * log(n)

        def beyond(a: float, z: float, l: float, _: float) -> bool:
            return log(z) - a * l / z < target  # entropy falls as the exponent grows

        point = _least_exponent(sources, largest, beyond)
        point = GRID if point == GRID and not beyond(1.0, *_sums(sources, largest, 1.0)) else max(0, point - 1)
    else:
        limit = max(most_repeats, budget / total)

        def within(a: float, z: float, _: float, least: float) -> bool:
            return budget * least ** (a - 1) / (z * largest) <= limit * (1 + 1e-12)

        point = _least_exponent(sources, largest, within)
    alpha = point / GRID
    return alpha, _sums(sources, largest, alpha)[0], largest


def _sums(sources: DataFrame, largest: int, alpha: float) -> tuple[float, float, float]:
    share = F.col("tokens") / F.lit(float(largest))
    power = F.pow(share, F.lit(alpha))
    return tuple(sources.agg(F.sum(power), F.sum(power * F.log(share)), F.min(share)).first())


def _key(seed: int, epoch: Column) -> Column:
    """Place of a document in the permutation of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def mix(docs: DataFrame, source: str = "source", budget_share: float = 1.0, most_repeats: float | None = 2.0,
        least_entropy: float | None = None, tokens: Column | None = None, block_tokens: int = BLOCK_TOKENS,
        seed: int = 0) -> DataFrame:
    """``docs`` as often as the mix reads each row, with ``mix_epoch`` (from 0), ``mix_block``, ``mix_key`` (the order
    within epoch and block) and ``mix_tokens``; columns of these names are replaced.

    The budget is ``budget_share`` of all tokens (words, unless ``tokens`` says otherwise), divided by weights
    proportional to a power of each source's tokens (``temperature``). A source is cut into blocks of about
    ``block_tokens`` by a hash of ``doc_id``; a block gets its part of the source's budget: whole permutations, and
    then the rows of one more permutation that still fit. So no source gets more than its budget, and each block less
    by one document at most.

    A null source is a source. Rows of a block without tokens are read once. Rows that repeat a ``doc_id`` stand
    at one place of the permutation and come or go together. An empty table stays empty.

    Text never moves: sources and blocks are summed by partial aggregation, and a window over short rows finds the
    key up to which a block's last permutation is read. Tables of sources and blocks are written and joined by size.
    """
    count = word_count() if tokens is None else tokens.cast("long")
    columns = [f"`{c}`" for c in docs.columns if c not in _ADDED]
    base = docs.withColumn("mix_tokens", F.coalesce(count, F.lit(0).cast("long"))).select(*columns, "mix_tokens")
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit(""))
    sources = store(base.groupBy(name.alias("_source")).agg(F.sum("mix_tokens").alias("tokens"))).df
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = int(total * budget_share)
    full = sources.where("tokens > 0")
    alpha, powers, largest = temperature(full, budget, most_repeats, least_entropy)
    weight = F.pow(F.col("tokens") / F.lit(float(largest)), F.lit(alpha)) / F.lit(float(powers))
    plan = store(sources.select(
        "_source", F.col("tokens").alias("_tokens"),
        F.when(F.col("tokens") > 0, F.floor(F.lit(float(budget)) * weight)).otherwise(0).cast("long").alias("_budget"),
        F.greatest(F.ceil(F.col("tokens") / block_tokens), F.lit(1)).cast("long").alias("_blocks"))).df
    place = F.conv(F.substring(_key(seed, F.lit("block")), 1, 8), 16, 10).cast("long")

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("_source", name).join(plan, "_source").withColumn("mix_block", place % F.col("_blocks"))

    narrow = placed(base.select("doc_id", f"`{source}`", "mix_tokens"))
    blocks = store(narrow.groupBy("_source", "mix_block").agg(
        F.sum("mix_tokens").alias("_held"), F.first("_tokens").alias("_tokens"), F.first("_budget").alias("_budget"))
        # In integers: a budget of all tokens gives each block exactly what it holds.
        .withColumn("_own", F.coalesce(F.expr("CAST(_budget AS DECIMAL(18,0)) * CAST(_held AS DECIMAL(18,0)) "
                                              "DIV nullif(CAST(_tokens AS DECIMAL(18,0)), 0)"), F.lit(0).cast("long")))
        .select("_source", "mix_block", F.when(F.col("_held") > 0, F.floor(F.try_divide("_own", "_held"))).otherwise(1).alias("_whole"),
                F.when(F.col("_held") > 0, F.expr("try_mod(_own, _held)")).otherwise(0).alias("_rest"))).df
    rows = narrow.join(blocks, ["_source", "mix_block"]).withColumn("_key", _key(seed, F.col("_whole")))
    upto = F.sum("mix_tokens").over(Window.partitionBy("_source", "mix_block").orderBy("_key").rangeBetween(
        Window.unboundedPreceding, Window.currentRow))
    last = store(rows.withColumn("_upto", upto).where("_upto <= _rest AND _rest > 0")
                 .groupBy("_source", "mix_block").agg(F.max("_key").alias("_last"))).df
    blocks = store(blocks.join(last, ["_source", "mix_block"], "left")).df
    read = placed(base).join(blocks, ["_source", "mix_block"])
    more = F.coalesce((_key(seed, F.col("_whole")) <= F.col("_last")).cast("long"), F.lit(0).cast("long"))
    read = read.withColumn("_times", F.col("_whole") + more).where("_times > 0")
    read = read.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)))
    return read.withColumn("mix_key", _key(seed, F.col("mix_epoch"))).select(*columns, *_ADDED)

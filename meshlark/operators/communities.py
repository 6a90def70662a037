"""Weighted modularity communities by parallel local moving and contraction."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshlark.graph import GraphError
from meshlark.plans.lineage import Stored, forget, store
from meshlark.plans.ordered import dense_ids
from meshlark.plans.skew import Split, laid_out

c = F.col


def louvain(edges: DataFrame, vertices: DataFrame, tolerance: float = 1e-4, max_rounds: int | None = None) -> DataFrame:
    """``id, community`` on undirected weighted edges, each stored once; communities are numbered from 1 by their least id.

    A level ends when no vertex gains by moving: more than ``tolerance`` of its own strength, as a share of the total
    weight, so that the rule does not depend on the size of the network. Its communities are the vertices of the next
    level, and the search ends with a level in which nothing moves. ``max_rounds`` raises if that takes longer.

    A round moves some of the vertices that gain, chosen by a hash, to their best neighboring community at once. All
    together would make neighbors swap places, so a round that does not raise modularity is taken back and half as
    many are chosen, down to the one that gains most, which alone must raise it: modularity rises with every round kept.
    Only vertices beside moved ones, and those that still gain, are rated anew; beyond that a round reads one row for each
    vertex. A level is done when rating all its vertices finds none that gains.
    """
    ids = store(vertices.select("id").distinct())
    if ids.rows < 3:
        raise GraphError("communities need at least 3 vertices")
    if tolerance <= 0:
        raise GraphError("tolerance must be above 0")
    ends = edges.where((c("src") != c("dst")) & (c("weight") > 0)).select(
        "src", "dst", c("weight").cast("double").alias("weight"))
    level = store(ends.unionByName(ends.select(c("dst").alias("src"), c("src").alias("dst"), "weight"))
                  .groupBy("src", "dst").agg(F.sum("weight").alias("weight")), total=F.sum("weight"))
    mapping = store(ids.df.select("id", c("id").alias("at"))).df
    two_m, left = level.measures["total"] or 0.0, _Rounds(max_rounds)
    while two_m > 0:
        found, moved = _local_moving(level, two_m, tolerance, left)
        if not moved:
            break
        names = found.select(c("node").alias("at"), "community")
        mapping = store(mapping.join(names, "at", "left").select("id", F.coalesce("community", "at").alias("at"))).df
        level = store(_contract(level.df, found))
    least = mapping.groupBy("at").agg(F.min("id").alias("least"))
    numbers = dense_ids(least, "community", 1, ["least"])
    return mapping.join(numbers, "at").select("id", "community")


@dataclass
class _Rounds:
    """Counts the rounds of all levels."""

    most: int | None
    done: int = 0

    def next(self) -> int:
        if self.done == self.most:
            raise GraphError(f"communities have not settled in {self.most} rounds")
        self.done += 1
        return self.done


def _contract(arcs: DataFrame, found: DataFrame) -> DataFrame:
    side = lambda name, to: found.select(c("node").alias(name), c("community").alias(to))
    return (arcs.join(side("src", "a"), "src").join(side("dst", "b"), "dst")
            .groupBy(c("a").alias("src"), c("b").alias("dst")).agg(F.sum("weight").alias("weight")))


@dataclass
class _State:
    """An assignment: ``node, community, strength, inner, target, gain, moved``, and its modularity.

    ``inner`` is a node's weight to its own community, ``gain`` what moving to ``target`` adds to it by its last rating.
    """

    nodes: Stored
    score: float

    @property
    def gainers(self) -> int:
        return self.nodes.measures["gainers"]

    @property
    def moved(self) -> int:
        return self.nodes.measures["moved"]


def _local_moving(level: Stored, two_m: float, tolerance: float, left: _Rounds) -> tuple[DataFrame, bool]:
    """Assignment ``node, community`` of one level in which no node gains, and whether any moved. A round is one job."""
    arcs = level.df
    between = laid_out(arcs.where(c("src") != c("dst")).select("src", "dst", "weight"), level.rows, "src", "dst")
    loops = arcs.where(c("src") == c("dst")).agg(F.coalesce(F.sum("weight"), F.lit(0.0))).first()[0]
    singles = store(arcs.groupBy(c("src").alias("node")).agg(F.sum("weight").alias("strength")).select(
        "node", c("node").alias("community"), "strength", F.lit(0.0).alias("inner"), F.lit(False).alias("moved"))).df

    def state(assigned: DataFrame, active: DataFrame | None) -> _State:
        totals = assigned.groupBy(c("community").alias("target")).agg(F.sum("strength").alias("total"))
        rated = _rated(between, assigned, active, totals, two_m, tolerance)
        nodes = (assigned.join(rated, "node", "left").join(totals.withColumnRenamed("target", "community"), "community")
                 .withColumn("inner", F.coalesce("link", "inner")))
        kept = store(nodes.select("node", "community", "strength", "inner", "target", "gain", "moved", "total"),
                     inner=F.sum("inner"), squares=F.sum(c("strength") * c("total")),
                     gainers=F.count_if(c("gain").isNotNull()), moved=F.count_if("moved"))
        inner, squares = kept.measures["inner"] or 0.0, kept.measures["squares"] or 0.0
        return _State(kept, (inner + loops) / two_m - squares / (two_m * two_m))

    now = state(singles, None)
    share, checked, moved_any = 0.5, True, False
    while True:
        if not now.gainers:
            if checked:
                return now.nodes.df.select("node", "community"), moved_any
            left.next()
            now, checked, share = state(_kept_columns(now.nodes.df, F.lit(False)), None), True, 0.5
            continue
        turn = left.next()
        gain = now.nodes.df.where("gain IS NOT NULL")
        alone = share * now.gainers < 2
        if alone:
            top = gain.groupBy().agg(F.max(F.struct("gain", "node")).alias("top")).select(c("top.node").alias("node"))
            after = now.nodes.df.join(F.broadcast(top.withColumn("leaves", F.lit(True))), "node", "left")
            leaves = F.coalesce("leaves", F.lit(False))
        else:
            after = now.nodes.df
            coin = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 20)) < int(share * (1 << 20))
            leaves = c("gain").isNotNull() & coin
        after = _kept_columns(after, leaves)
        touched = (between.joined(after.where("moved").select("node"), "node").select(c("dst").alias("node"))
                   .unionByName(gain.select("node")).distinct())
        then = state(after, touched)
        if then.moved and then.score > now.score:
            forget(now.nodes)
            now, checked, moved_any, share = then, False, True, min(0.5, 2 * share)
        elif alone:  # what it adds is below the last digit of the score
            return now.nodes.df.select("node", "community"), moved_any
        else:
            forget(then.nodes)
            share /= 2


def _kept_columns(nodes: DataFrame, leaves: Column) -> DataFrame:
    """The assignment after the moves of the nodes that leave."""
    return nodes.select("node", F.when(leaves, c("target")).otherwise(c("community")).alias("community"), "strength",
                        "inner", leaves.alias("moved"))


def _rated(between: Split, assigned: DataFrame, active: DataFrame | None, totals: DataFrame, two_m: float,
           tolerance: float) -> DataFrame:
    """``node, link, target, gain`` of the active nodes (all, if None): the weight to their own community, and where and
    how much they gain, if they do."""
    here = assigned.select("node", "community", "strength")
    arcs = between.df.select(c("src").alias("node"), "dst", "weight")
    if active is not None:
        here = here.join(active, "node", "left_semi")
        arcs = between.joined(active, "node").select("node", "dst", "weight")
    there = assigned.select(c("node").alias("dst"), c("community").alias("target"))
    # At least 0 to the own community; partial sums come before the shuffle.
    own = here.select("node", c("community").alias("target"), F.lit(0.0).alias("link"))
    toward = (arcs.join(there, "dst").select("node", "target", c("weight").alias("link"))
              .unionByName(own).groupBy("node", "target").agg(F.sum("link").alias("link")))
    is_own = c("target") == c("community")
    others = c("total") - F.when(is_own, c("strength")).otherwise(0.0)
    rated = (toward.join(here, "node").join(totals, "target")
             .withColumn("value", c("link") - c("strength") * others / two_m).withColumn("own", is_own))
    best = rated.groupBy("node", "strength").agg(
        F.max(F.when(c("own"), c("value"))).alias("stay"), F.max(F.when(c("own"), c("link"))).alias("link"),
        F.max(F.when(~c("own"), F.struct("value", "target"))).alias("go"))
    gains = _gains(c("go.value") - c("stay"), tolerance)
    return best.select("node", "link", F.when(gains, c("go.target")).alias("target"),
                       F.when(gains, c("go.value") - c("stay")).alias("gain"))


def _gains(more: Column, tolerance: float) -> Column:
    return F.coalesce(more > tolerance * c("strength"), F.lit(False))

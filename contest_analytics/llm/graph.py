"""Connected components over edge tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contest_analytics.session import Scope, cut_lineage, scratch_scope


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node of its component) for every end of an edge.

    ``edges`` has the columns ``a`` and ``b`` of one type; direction, repeats and loops do not matter,
    and edges with a null end are dropped. Each round contracts every node into the neighbour of
    least hash. Hashes put the nodes in random order, so a round leaves a fraction of them also on
    long paths and at large hubs. Rounds are written to the shared folder.
    """
    with scratch_scope(edges.sparkSession) as scope:
        return scope.keep(_contract(edges, scope))


def _contract(edges: DataFrame, scope: Scope) -> DataFrame:
    known = edges.where("a IS NOT NULL AND b IS NOT NULL")
    label = [F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n")).alias(c) for c in ("a", "b")]
    nodes = known.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    now = cut_lineage(known.where("a <> b").select(*label).distinct())
    reached = nodes.select("node", F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("n")).alias("at"))
    reached = cut_lineage(reached)
    while not now.isEmpty():
        both = now.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        least = both.select("col.*").groupBy("a").agg(F.least("a", F.min("b")).alias("to"))
        least = cut_lineage(least.select(F.col("a").alias("from"), "to"))
        moved = now.join(least, F.col("a") == F.col("from")).select(F.col("to").alias("a"), "b")
        moved = moved.join(least, F.col("b") == F.col("from")).select("a", F.col("to").alias("b"))
        further = reached.join(least, F.col("at") == F.col("from"), "left")
        old, reached = reached, cut_lineage(further.select("node", F.coalesce("to", "at").alias("at")))
        scope.drop(old)
        old, now = now, cut_lineage(moved.where("a <> b").distinct())
        scope.drop(old)
        scope.drop(least)
    ids = reached.groupBy("at").agg(F.min("node").alias("component"))
    return reached.join(ids, "at").select("node", "component")


Pairs = Callable[[DataFrame], DataFrame]
May = Callable[[Column, Column], Column]
Rest = Callable[[DataFrame, May], DataFrame]


def linked_components(keys: DataFrame, verify: Pairs, may: May, rounds: int = 2, rest: Rest | None = None) -> DataFrame:
    """``node`` and ``component`` of every node that a verified pair links to another.

    ``keys`` has ``key``, ``node``, ``weight`` and ``info``: two nodes may be linked only if they share
    a key and ``may`` holds for their infos. ``verify`` keeps those rows (a, b) of a table of distinct
    pairs that are links.

    Every such pair is verified unless its nodes are connected already, so no two components remain
    that a link would join. To leave few such pairs, the first rounds compare each node only with
    one leader: that of its keys' leaders (the members of greatest weight, then of greatest hash)
    with which it shares most keys. A group of n near copies then costs about n pairs. What is left after
    them is found by ``rest``, by default ``pairs_apart``.
    """
    with scratch_scope(keys.sparkSession) as scope:
        return scope.keep(_verified(keys, verify, may, rounds, rest or pairs_apart))


def pairs_apart(rows: DataFrame, may: May) -> DataFrame:
    """All pairs (a, b) of nodes of different components ``comp`` that share a key and may be linked.

    A key's largest component stands on one side only.
    """
    parts = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("largest"), F.count("*").alias("comps"))
    mixed = cut_lineage(mixed.where("comps > 1").select("key", F.col("largest.comp").alias("largest")))
    rest = rows.join(mixed, "key").where("comp <> largest")
    rest = rest.select(F.col("key").alias("k"), F.col("node").alias("x"), F.col("comp").alias("cx"), F.col("info").alias("ix"))
    others = rows.join(mixed, "key", "left_semi")
    others = others.select("key", F.col("node").alias("y"), F.col("comp").alias("cy"), F.col("info").alias("iy"))
    met = rest.join(
        others, (F.col("k") == F.col("key")) & (F.col("cx") != F.col("cy")) & may(F.col("ix"), F.col("iy"))
    )
    return met.select(*_ordered(F.col("x"), F.col("y"))).distinct()


def _ordered(one: Column, other: Column) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _verified(keys: DataFrame, verify: Pairs, may: May, rounds: int, rest: Rest) -> DataFrame:
    links: list[DataFrame] = []
    tested: list[DataFrame] = []
    keys = keys.select("key", "node", "weight", "info")

    def placed() -> DataFrame:
        if not links:
            return keys.withColumn("comp", F.col("node"))
        known = components(reduce(DataFrame.union, links)).withColumnRenamed("component", "comp")
        return keys.join(known, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    def settle(pairs: DataFrame) -> None:
        for old in tested:
            pairs = pairs.join(old, ["a", "b"], "left_anti")
        pairs = cut_lineage(pairs)
        tested.append(pairs)
        links.append(cut_lineage(verify(pairs).select("a", "b")))

    for turn in range(rounds):
        rows = placed()
        rank = F.col("weight") if turn == 0 else F.xxhash64("node", F.lit(turn)).cast("double")
        leaders = rows.groupBy("key").agg(F.max(F.struct(rank.alias("rank"), "node", "comp", "info")).alias("leader"))
        leaders = leaders.select(
            F.col("key").alias("k"), *(F.col(f"leader.{c}").alias(f"l{c}") for c in ("node", "comp", "info"))
        )
        apart = rows.join(
            leaders, (F.col("key") == F.col("k")) & (F.col("comp") != F.col("lcomp")) & may(F.col("info"), F.col("linfo"))
        )
        common = apart.groupBy("node", "lnode").agg(F.count("*").alias("n"))
        best = common.groupBy("node").agg(F.max(F.struct("n", "lnode")).alias("best"))
        settle(best.select(*_ordered(F.col("node"), F.col("best.lnode"))).distinct())

    settle(rest(cut_lineage(placed()), may))  # what is left: pairs of different components
    return components(reduce(DataFrame.union, links))

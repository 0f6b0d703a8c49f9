"""Canonical tables derived from the order/line-item test tables.

Measures are integers, so that averages are the same in every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contest_analytics.sources.layouts import ContestTables


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_orderdate").alias("start_time"),
        F.floor(F.col("o_totalprice") / 100).cast("int").alias("duration"),
        F.when(status == "F", True).when(status == "O", False).alias("side_a_win"),
        (F.col("o_custkey") % 60).cast("int").alias("score_a"),
        (F.col("o_orderkey") % 60).cast("int").alias("score_b"),
        (F.col("o_custkey") % 25).cast("int").alias("league_id"),
        (F.substring("o_orderpriority", 1, 1).cast("int") * 60).alias("first_claim_time"),
        F.year("o_orderdate").alias("yr"),
        F.month("o_orderdate").alias("mo"),
    )


def selections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        F.col("l_suppkey").alias("entity_id"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("side"),
        F.when(F.col("l_returnflag") != "R", 1).otherwise(0).alias("is_pick"),
    )


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        F.when(flag == "A", 1).otherwise(0).alias("first_claim"),
        F.floor(F.col("l_extendedprice") / 100).alias("gold_rate"),
        (F.col("l_partkey") % 1000).alias("xp_rate"),
        F.floor("l_extendedprice").alias("damage"),
        F.col("l_suppkey").alias("tower_damage"),
        F.floor("l_quantity").alias("kills"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("deaths"),
        F.when(flag != "N", F.floor(F.col("l_tax") * 100)).alias("assists"),
    )


def objectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    parts = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    hidden = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    return lines.join(parts, "l_partkey").select(
        F.col("l_orderkey").alias("match_id"),
        (F.col("l_linenumber") * 100).alias("time_s"),
        F.when(~hidden, F.col("p_type")).alias("kind"),
    )


def advantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    ahead = F.col("l_linestatus") == "F"

    def signed(name: str):
        return F.floor(F.when(ahead, F.col(name)).otherwise(-F.col(name)))

    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        (F.col("l_linenumber") + 3).alias("minute_no"),
        signed("l_extendedprice").alias("gold"),
        signed("l_quantity").alias("xp"),
    )


def clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        (F.col("l_linenumber") * 120).alias("start_s"),
        (F.col("l_partkey") % 7).alias("deaths"),
    )


def draft_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        (F.floor(F.col("l_discount") * 100) + 20).alias("time_taken"),
    )


def load(spark: SparkSession, sf_dir: str) -> ContestTables:
    series = advantage(spark, sf_dir)
    return ContestTables(
        matches=matches(spark, sf_dir),
        selections=selections(spark, sf_dir),
        participants=participants(spark, sf_dir),
        objectives=objectives(spark, sf_dir),
        gold_advantage=series.drop("xp"),
        xp_advantage=series.drop("gold"),
        clashes=clashes(spark, sf_dir),
        draft_turns=draft_turns(spark, sf_dir),
    )

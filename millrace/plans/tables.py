"""Driver tables in the shape the operators expect, and the same shapes as SQL.

Departures: one row per order line. Bars: prices per symbol on an hourly grid,
so a symbol has at most one bar per hour however many events it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures: origin, dest, day, carrier, HHMM time, outcome, distance and readings."""
    li = table(spark, sf_dir, "lineitem")
    hhmm = (F.col("l_partkey") % 24) * 100 + F.col("l_orderkey") % 60
    cancelled = (F.col("l_discount") >= 0.1).cast("int")
    return li.select(
        F.col("l_orderkey").alias("leg_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("origin"),
        (F.col("l_partkey") % 50).alias("dest"),
        F.to_date("l_shipdate").alias("day"),
        F.col("l_linestatus").alias("carrier"),
        hhmm.cast("int").alias("hhmm"),
        cancelled.alias("cancelled"),
        F.when(cancelled == 0, (F.col("l_returnflag") == "R").cast("int")).alias("late"),
        F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey") % 40).alias("tail"),
        F.col("l_quantity").alias("minutes"),
        F.col("l_extendedprice").alias("distance"),
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_quantity")).alias("wind"),
        F.when(F.col("l_orderkey") % 11 != 0, F.col("l_extendedprice") / 1000).alias("temp"),
        F.when(F.col("l_orderkey") % 3 != 0, F.col("l_returnflag")).alias("sky"),
    )


LEGS = """legs AS (
  SELECT l_orderkey AS leg_id, l_linenumber AS line, l_suppkey AS origin, l_partkey % 50 AS dest,
         CAST(l_shipdate AS DATE) AS day, l_linestatus AS carrier,
         CAST((l_partkey % 24) * 100 + l_orderkey % 60 AS INTEGER) AS hhmm,
         CASE WHEN l_discount >= 0.1 THEN 1 ELSE 0 END AS cancelled,
         CASE WHEN l_discount >= 0.1 THEN NULL WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS late,
         CASE WHEN l_partkey % 7 <> 0 THEN l_partkey % 40 END AS tail,
         l_quantity AS minutes, l_extendedprice AS distance,
         CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity END AS wind,
         CASE WHEN l_orderkey % 11 <> 0 THEN l_extendedprice / 1000 END AS temp,
         CASE WHEN l_orderkey % 3 <> 0 THEN l_returnflag END AS sky
  FROM lineitem)"""

# Total order of departures; rows equal in all of these are equal in every column used.
LEG_ORDER = ["day", "hhmm", "leg_id", "line", "dest", "minutes", "distance", "cancelled", "carrier", "late"]
LEG_ORDER_SQL = (
    "day, hhmm, leg_id, line, dest, minutes, distance, cancelled, carrier, late NULLS FIRST"
)


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars per symbol from events: open, high, low, close, volume, dividends."""
    ev = table(spark, sf_dir, "events")
    at = F.struct("ts", "event_id")
    price = F.col("value") + 100
    return (
        ev.groupBy((F.col("user_id") % 25).alias("symbol"), F.date_trunc("hour", "ts").alias("ts"))
        .agg(
            F.min_by(price, at).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, at).alias("close"),
            F.count(F.lit(1)).alias("volume"),
            F.sum(F.when(F.col("event_type") == "purchase", 0.5).otherwise(0.0)).alias("dividends"),
        )
    )


BARS = """bars AS (
  SELECT user_id % 25 AS symbol, date_trunc('hour', ts) AS ts,
         arg_min(value + 100, (ts, event_id)) AS open, max(value + 100) AS high,
         min(value + 100) AS low, arg_max(value + 100, (ts, event_id)) AS close,
         count(*) AS volume, sum(CASE WHEN event_type = 'purchase' THEN 0.5 ELSE 0 END)::DOUBLE AS dividends
  FROM events GROUP BY 1, 2)"""

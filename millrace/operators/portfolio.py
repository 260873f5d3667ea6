"""Weighted portfolios of price and dividend series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import maths
from millrace.operators.windows import next_return

# Portfolio weights by asset class.
SIXTY_FORTY = {"stock": 0.6, "bond": 0.4}
ALL_WEATHER = {"stock": 0.3, "long_bond": 0.4, "mid_bond": 0.15, "gold": 0.08, "commodities": 0.07}
PERIODS = 252


def weights(spark: SparkSession, books: dict[str, dict[str, float]], symbol_type: str = "string") -> DataFrame:
    """Rows (portfolio, symbol, weight)."""
    rows = [(p, s, float(w)) for p, book in books.items() for s, w in book.items()]
    return spark.createDataFrame(rows, f"portfolio string, symbol {symbol_type}, weight double")


def portfolio_series(prices: DataFrame, weight: DataFrame, symbol: str, date: str) -> DataFrame:
    """Weighted sums of prices and dividends per portfolio and date, for dates all members have.

    Weights apply to prices, not to rebalanced values.
    """
    members = weight.groupBy("portfolio").agg(F.count(F.lit(1)).alias("__m"))
    joined = prices.select(symbol, date, "close", "dividends").join(weight, symbol)
    sums = joined.groupBy("portfolio", date).agg(
        F.sum(F.col("weight") * F.col("close")).alias("price"),
        F.sum(F.col("weight") * F.col("dividends")).alias("paid"),
        F.count(F.lit(1)).alias("__n"),
    )
    return sums.join(members, "portfolio").filter("__n = __m").drop("__n", "__m")


def return_stats(series: DataFrame, date: str, periods: int = PERIODS) -> DataFrame:
    """Mean, population deviation, annualised Sharpe ratio and annualised deviation per portfolio."""
    returns = next_return(series, ["portfolio"], date, "price", "paid")
    root = F.sqrt(F.lit(float(periods)))
    return (
        returns.groupBy("portfolio")
        .agg(F.avg("ret").alias("mean"), F.stddev_pop("ret").alias("std"))
        .withColumn("sharpe", maths.share(root * F.col("mean"), F.col("std")))
        .withColumn("annual_std", root * F.col("std"))
    )


def final_value(series: DataFrame, date: str, stake: float = 1000.0) -> DataFrame:
    """Worth of the stake at the last date, with the dividends of all but the last date."""
    out = series.groupBy("portfolio").agg(
        F.min_by("price", date).alias("__p0"),
        F.max_by("price", date).alias("__p1"),
        (F.sum("paid") - F.max_by("paid", date)).alias("__d"),
    )
    value = F.lit(stake) / F.col("__p0") * (F.col("__p1") + F.col("__d"))
    return out.select("portfolio", value.alias("value"))


def series_stats(df: DataFrame, keys: list[str], ret: str, periods: int = PERIODS) -> DataFrame:
    """Mean, population deviation and annualised Sharpe ratio of a return column."""
    root = F.sqrt(F.lit(float(periods)))
    return (
        df.groupBy(*keys)
        .agg(F.avg(ret).alias("mean"), F.stddev_pop(ret).alias("std"))
        .withColumn("sharpe", maths.share(root * F.col("mean"), F.col("std")))
    )

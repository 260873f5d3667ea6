"""Exact ranks without a task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def bucket(*by: str | Column, n: int) -> Column:
    """One of ``n`` buckets by hash."""
    return F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")


def rank_within(rows: DataFrame, keys: list[str], by: str, order: list[str], name: str) -> DataFrame:
    """Gapless rank from 0 of each row within ``keys``, in the order of bucket ``by``, then ``order``.

    Rows are sorted only within (keys, bucket); a running total over the bucket
    counts, of which there are at most as many as buckets, gives each bucket's first rank.
    ``order`` has to tell rows apart, or rows that it does not tell apart have to be alike.
    """
    counts = rows.groupBy(*keys, by).agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*keys, by, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    numbered = rows.withColumn("__at", F.row_number().over(Window.partitionBy(*keys, by).orderBy(*order)))
    placed = numbered.join(before, [*keys, by])
    return placed.withColumn(name, F.col("__before") + F.col("__at") - 1).drop("__before", "__at")


def largest(rows: DataFrame, value: str, order: str, k: int, steps: int = 1024) -> Column:
    """A condition that holds for exactly the ``k`` rows with the largest ``value``, ties by smaller ``order``.

    ``value`` is a finite double and ``order`` a whole number that tells rows apart. Each
    pass counts rows in ``steps`` equal ranges and goes on in the range with the k-th row;
    the driver sees only those counts. ``rows`` should be staged.
    """
    low, high = rows.agg(F.min(value), F.max(value)).first()
    if k <= 0 or low is None:
        return F.lit(False)
    if k >= rows.count():
        return F.lit(True)
    above = 0
    while True:
        width = (high - low) / steps
        if not width > 0 or low + width == low:
            break
        part = rows.where((F.col(value) >= low) & (F.col(value) <= high))
        place = F.least(F.floor((F.col(value) - low) / width), F.lit(steps - 1)).alias("p")
        found = part.groupBy(place).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).collect()
        for p in sorted(found, key=lambda r: -r["p"]):
            if above + p["n"] >= k:
                break
            above += p["n"]
        low, high = p["low"], p["high"]
        if p["n"] == k - above:
            return F.col(value) >= low
    # all values in the last range are equal: the smallest orders win
    return (F.col(value) > low) | ((F.col(value) == low) & (F.col(order) <= _smallest(rows.where(F.col(value) == low), order, k - above)))


def _smallest(rows: DataFrame, order: str, k: int, steps: int = 1024) -> int:
    """The k-th smallest of whole numbers."""
    low, high = rows.agg(F.min(order), F.max(order)).first()
    while low < high:
        width = max(1, -(-(high - low + 1) // steps))
        place = F.floor((F.col(order) - low) / width).alias("p")
        found = rows.where(F.col(order).between(low, high)).groupBy(place).agg(F.count("*").alias("n"), F.min(order).alias("low"), F.max(order).alias("high")).collect()
        for p in sorted(found, key=lambda r: r["p"]):
            if p["n"] >= k:
                break
            k -= p["n"]
        low, high = p["low"], p["high"]
    return low

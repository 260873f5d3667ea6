"""Line dedup by site-relative frequency.

Per host, the pages that contain a line are divided by the host's pages; lines above a ratio
are boilerplate of that host and go from all of its pages. The ratio is ``RATIO`` for large hosts and stricter the
fewer pages there are to judge by: ``SMALL / sqrt(pages)``, which is half of 9 pages and more than all of 2.

Copies of a page must not make their own lines boilerplate. Pages of a host with the same
text count once. Copies with small differences are found by what the ratio says at first: pages that
mostly consist of lines above it vote together, one vote for those with the same longest such line, and the ratio is
taken again over the votes. Copies come down to few votes, as most left the longest line as it was, while a line
that is on pages of its own keeps their votes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage

RATIO = 0.05
SMALL = 1.5
MOST_SHARE = 0.5  # of a page's characters in lines above the ratio: it votes with its like


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    """Eight bytes of md5, which SQL has too."""
    return F.unhex(F.substring(F.md5(F.trim(line)), 1, 16))


def _above(pages: DataFrame, totals: DataFrame, ratio: float, small: float) -> DataFrame:
    """``host``, ``boiler``: the lines of each host with more pages than the ratio allows.

    ``pages``: a row per ``host``, ``line`` and page; ``totals``: ``host``, ``host_pages``. A host
    has at most (lines of an average page) / ``ratio`` such lines, whatever its size.
    """
    counts = pages.groupBy("host", "line").agg(F.count("*").alias("pages"))
    named = counts.join(totals.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
    most = F.greatest(F.lit(float(ratio)) * F.col("host_pages"), F.lit(float(small)) * F.sqrt("host_pages"))
    return stage(named.where(F.col("pages") > most).groupBy("host").agg(F.collect_set("line").alias("boiler")))


def _with_boiler(rows: DataFrame, host: str, boiler: DataFrame) -> DataFrame:
    named = boiler.select(F.col("host").alias("__host"), F.col("boiler").alias("__boiler"))
    out = rows.join(named, F.col(host).eqNullSafe(F.col("__host")), "left").drop("__host")
    return out.withColumn("__boiler", F.coalesce("__boiler", F.array().cast("array<binary>")))


def boilerplate(docs: DataFrame, host: str, ratio: float = RATIO, small: float = SMALL, most_share: float = MOST_SHARE) -> DataFrame:
    """``host`` and ``boiler``, the hashes of its boilerplate lines (trimmed of spaces; blank ones never are)."""
    text = F.col("text").cast("string")
    filled = F.filter(_lines(text), lambda x: F.length(F.trim(x)) > 0)
    sized = F.array_distinct(F.transform(filled, lambda x: F.struct(F.length(F.trim(x)).alias("size"), _key(x).alias("line"))))
    pages = docs.where(text.isNotNull()).select(F.col(host).alias("host"), F.unhex(F.md5(text)).alias("page"), sized.alias("lines"))
    pages = stage(pages.groupBy("host", "page").agg(F.first("lines").alias("lines")))
    once = pages.select("host", F.explode("lines.line").alias("line"))
    first = _above(once, pages.groupBy("host").agg(F.count("*").alias("host_pages")), ratio, small)
    known = _with_boiler(pages, "host", first)
    repeated = F.filter("lines", lambda x: F.array_contains("__boiler", x["line"]))
    size = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x["size"])
    together = size(F.col("__mine")) > F.lit(float(most_share)) * size(F.col("lines"))
    vote = F.when(together, F.struct(F.lit(1).alias("group"), F.array_max("__mine")["line"].alias("key"))).otherwise(F.struct(F.lit(0).alias("group"), F.col("page").alias("key")))
    votes = known.withColumn("__mine", repeated).select("host", vote.alias("vote"), F.col("__mine.line").alias("lines"))
    totals = votes.select("host", "vote").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    return _above(votes.select("host", "vote", F.explode("lines").alias("line")).distinct(), totals, ratio, small)


def drop_lines(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and counts of what was taken.

    Adds ``n_lines`` and ``n_dropped``. Lines end at \\n and are compared without spaces at their ends;
    blank lines always stay, and every boilerplate line goes, whatever is left of its page. Null texts stay null with
    no lines; a text without boilerplate stays as it is. Rows without a host form one host. Columns of ``docs`` with the names of added
    ones are replaced.
    """
    found = boilerplate(docs, host, **limits)
    docs = docs.drop("n_lines", "n_dropped")
    text = F.col("text").cast("string")
    every = _lines(text)
    stays = F.filter(every, lambda x: ~F.array_contains("__boiler", _key(x)) | (F.length(F.trim(x)) == 0))
    cut = _with_boiler(docs, host, found).withColumn("__every", every).withColumn("__stays", stays).withColumn("__text", F.array_join("__stays", "\n"))
    lost = F.size("__every") - F.size("__stays")
    return cut.select(
        *[F.when(text.isNull() | (lost == 0), F.col("text")).otherwise(F.col("__text")).alias("text") if c == "text" else F.col(c) for c in docs.columns],
        F.when(text.isNull(), 0).otherwise(F.size("__every")).cast("long").alias("n_lines"),
        lost.cast("long").alias("n_dropped"),
    )

"""Balanced label propagation: documents with equal texts move into common shards.

Documents start in shards by hash. In every round each group of linked documents
names the shards that already hold most of it, as many as it needs for its size;
its members elsewhere ask to move there. Requests are granted, largest groups
of requests first, as far as the shard's quota goes: its final number of documents and
a little slack; and documents that ask to go opposite ways between two shards change places,
so shards full of linked documents can still exchange them. At last
what is over the final number leaves, group by group, and with the documents without
links, which cut no edge wherever they are, fills every shard to its exact number.

Links are kept as (document, group) rows; pairs within a group are never formed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.ranks import bucket, rank_within
from millrace.session import stage

SHARDS = 40
ROUNDS = 10
SLACK = 0.1  # shards may be that much over their number while documents move
OVERHEAD = 16  # bytes that a document takes besides its text
BUCKETS = 1024


def _numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _loads(state: DataFrame, shards: int) -> list[int]:
    found = dict(state.groupBy("shard").count().collect())
    return [found.get(s, 0) for s in range(shards)]


def _requests(state: DataFrame, free: list[int], target: int) -> DataFrame:
    """``group``, ``shard``, ``to``, ``n``, ``gain``: where members outside a group's chosen shards ask to go.

    Of a group only its at most ``len(free)`` counts by shard are gathered.
    """
    cells = state.groupBy("group", "shard").agg(F.count("*").alias("n"))
    full = (F.element_at(_numbers(free), F.col("shard") + 1) <= 0).alias("full")
    first = cells.groupBy("shard").agg(F.max(F.struct("n", "group"))["group"].alias("first"))
    cells = cells.join(first, "shard").withColumn("behind", F.col("group") != F.col("first"))
    order = F.struct((-F.col("n")).alias("less"), full, F.xxhash64("group", "shard").alias("tie"), "shard", "n", "behind")
    settled = F.when(F.col("n") >= target, F.col("n"))  # what fills a shard stays there
    groups = cells.groupBy("group").agg(F.sort_array(F.collect_list(order)).alias("cells"), F.sum("n").alias("size"), F.count(settled).alias("kept"), F.coalesce(F.sum(settled), F.lit(0)).alias("there"))
    more = F.when(F.col("kept") > 0, 0).otherwise(1)
    wanted = F.col("kept") + F.greatest(F.ceil((F.col("size") - F.col("there")) / target), more)
    groups = groups.where(F.size("cells") > 1).withColumn("chosen", F.least(wanted, F.size("cells")).cast("int")).withColumn("kept", F.col("kept").cast("int"))
    groups = groups.where(F.col("chosen") > F.col("kept"))
    # two groups that need several shards don't both gather where both are large
    fields = ("behind", "less", "full", "tie", "shard", "n")
    cells = F.transform("cells", lambda c: F.struct(*[c[x].alias(x) for x in fields]))
    groups = groups.withColumn("cells", F.when(F.col("chosen") > 1, F.sort_array(cells)).otherwise(cells))
    spread = groups.select("group", "cells", "chosen", "kept", F.posexplode("cells").alias("at", "cell")).where("at >= chosen")
    room = F.col("chosen") - F.col("kept")
    to = F.element_at("cells", F.col("chosen") - (F.col("at") - F.col("chosen")) % room)  # the emptier chosen ones first
    return spread.select("group", F.col("cell.shard").alias("shard"), to["shard"].alias("to"), F.col("cell.n").alias("n"), to["n"].alias("gain"))


def _granted(requests: DataFrame, free: list[int]) -> DataFrame:
    """Requests within the quotas, and the share of their members that may go.

    As many as want to go from one shard to another as the other way round change places, which
    leaves both shards as full as they were; what is known of that is a count for every two shards.
    The quotas are for the rest. They are counted by rank of gain and hash first, so a quota is split over at most
    64 * BUCKETS counts for each shard, not over requests.
    """
    flow = requests.groupBy("shard", "to").agg(F.sum("n").alias("asked"))
    back = flow.select(F.col("shard").alias("to"), F.col("to").alias("shard"), F.col("asked").alias("back"))
    swaps = flow.join(back, ["shard", "to"], "left").select("shard", "to", (F.least("asked", F.coalesce("back", F.lit(0))) / F.col("asked")).alias("swapped"))
    rest = requests.join(swaps, ["shard", "to"]).withColumn("n", F.col("n") * (1 - F.col("swapped")))
    marked = rest.withColumn("level", F.floor(F.log2("gain")).cast("int")).withColumn("part", bucket("group", "shard", n=BUCKETS))
    counts = marked.groupBy("to", "level", "part").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("to").orderBy(F.desc("level"), "part").rowsBetween(Window.unboundedPreceding, -1)
    left = F.element_at(_numbers(free), F.col("to") + 1) - F.coalesce(F.sum("n").over(earlier), F.lit(0))
    fits = counts.withColumn("share", F.when(F.col("n") > 0, F.greatest(F.least(left / F.col("n"), F.lit(1.0)), F.lit(0.0))).otherwise(0.0))
    granted = marked.join(fits.select("to", "level", "part", "share"), ["to", "level", "part"])
    share = F.col("swapped") + (1 - F.col("swapped")) * F.col("share")
    return granted.select("group", "shard", "to", share.alias("share")).where("share > 0")


def propagate(state: DataFrame, targets: list[int], rounds: int = ROUNDS) -> DataFrame:
    """``state`` (``row``, ``group``, ``shard``) after up to ``rounds`` rounds of moves."""
    for k in range(rounds):
        loads = _loads(state, len(targets))
        free = [max(0, math.ceil(t * (1 + SLACK)) - n) for t, n in zip(targets, loads, strict=True)]
        moves = stage(_granted(_requests(state, free, max(1, min(targets))), free))
        if moves.isEmpty():
            break
        drawn = F.pmod(F.xxhash64("row", F.lit(k)), F.lit(1 << 30)) / float(1 << 30)
        moved = state.join(moves, ["group", "shard"], "left").withColumn("to", F.when(drawn < F.col("share"), F.col("to")))
        state = stage(moved.select("row", "group", F.coalesce("to", "shard").alias("shard")))
    return state


def _by_group() -> Column:
    """Buckets in which groups lie together; a large group has sixteen."""
    return bucket("group", n=BUCKETS) * 16 + bucket("row", n=16)


def _over(state: DataFrame, loads: list[int], targets: list[int]) -> DataFrame:
    """Rows of linked documents beyond their shard's number; groups stay together as far as it goes."""
    full = [s for s, (n, t) in enumerate(zip(loads, targets, strict=True)) if n > t]
    there = state.where(F.col("shard").isin(full)).withColumn("part", _by_group())
    ranked = rank_within(there, ["shard"], "part", ["group", "row"], "rank")
    return ranked.where(F.col("rank") >= F.element_at(_numbers(targets), F.col("shard") + 1)).select("row")


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Shard and place of every document under the law ``rows``: counts are at most one apart.

    ``docs``: ``doc_id``, ``text``; more columns are ignored. Documents with equal texts are
    linked (null texts are not; empty texts are). A row per row of ``docs``: ``doc_id``,
    ``size`` (UTF-8 bytes, 0 for null, plus 16), ``text_crc32`` (0 for null and empty),
    ``law``, ``shard``, ``slot`` (gapless from 0 in each shard), ``grown_shard`` (null: only
    the law ``key`` has it), ``group`` (hash of the text, null without links). Repeated rows
    are documents of their own. An empty table gives no rows; with fewer documents
    than shards some shards are empty.
    """
    text = F.col("text").cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("size")
    crc = F.coalesce(F.crc32(text), F.lit(0).cast("long")).alias("text_crc32")
    each = docs.select("doc_id", size, crc, F.unhex(F.md5(text)).alias("group"))
    # equal rows are told apart by number, so a row's name doesn't hang on where it lies
    repeats = each.groupBy("doc_id", "size", "text_crc32", "group").agg(F.count("*").alias("n"))
    numbered = repeats.select("doc_id", "size", "text_crc32", "group", F.explode(F.sequence(F.lit(1), "n")).alias("n"))
    named = F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.hex("group"), F.lit("-")), F.col("n").cast("string"))
    rows = stage(numbered.withColumn("row", F.unhex(F.md5(named))).drop("n"))
    total = rows.count()
    targets = [total // shards + (s < total % shards) for s in range(shards)]
    linked = rows.where("group is not null").groupBy("group").agg(F.count("*").alias("m")).where("m > 1").select("group")
    state = stage(rows.select("row", "group").join(linked, "group").withColumn("shard", bucket("row", n=shards)))
    state = propagate(state, targets, rounds)

    loads = _loads(state, shards)
    placed = state
    if any(n > t for n, t in zip(loads, targets, strict=True)):
        placed = stage(state.join(_over(state, loads, targets), "row", "left_anti"))
        loads = _loads(placed, shards)
    needs = [t - n for t, n in zip(targets, loads, strict=True)]
    ends = [sum(needs[: s + 1]) for s in range(shards)]
    known = rows.join(placed.select("row", "shard"), "row", "left").join(state.select("row", F.lit(True).alias("in_group")), "row", "left")
    known = stage(known.select("doc_id", "size", "text_crc32", "row", "shard", F.when(F.col("in_group"), F.col("group")).alias("group")))
    part = F.when(F.col("group").isNull(), -1 - bucket("row", n=4 * BUCKETS)).otherwise(_by_group())
    free = rank_within(known.where("shard is null").withColumn("part", part), [], "part", ["group", "row"], "rank")
    filled = free.withColumn("shard", F.size(F.filter(_numbers(ends), lambda e: e <= F.col("rank"))))
    columns = ["doc_id", "size", "text_crc32", "row", "shard", "group"]
    everyone = known.where("shard is not null").select(columns).union(filled.select(columns))
    ranked = rank_within(everyone.withColumn("part", bucket("row", n=BUCKETS)), ["shard"], "part", ["row"], "slot")
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.hex("group").alias("group"),
    )

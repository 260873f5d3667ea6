"""Searches along long series by a tree of block summaries.

The values of a key are cut into blocks of ``WIDTH``, blocks of blocks again, and so on. A
block is summed up by its highest and lowest value and, for each of a few ratios, by
whether a value inside it lies below that ratio of the highest one before it. Such summaries
combine in any grouping, so a level is built from the one below it. A search that starts anywhere goes
along the rest of its block, up while nothing there can hold what it looks for, and down into
the first block that does. It meets one block per level either way, however long the series
and whoever holds most of it: searches join the blocks they stand at, so neither a key nor a search is ever
gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.keyed import join_on
from millrace.operators.ordered import following, number_rows
from millrace.session import stage

WIDTH = 1024
SUMMARY = ["__high", "__low", "__falls"]
ROWS = 256  # searches whose blocks are laid side by side at once


@dataclass
class Blocks:
    """Blocks of several searches: a row each, padded with values that nothing looks for."""

    high: np.ndarray
    low: np.ndarray
    falls: np.ndarray  # bit i: a value inside lies below ratio i of the highest one before it

    @staticmethod
    def of(batch: pa.RecordBatch) -> Blocks:
        lengths = batch.column("__high").value_lengths().to_numpy()
        width = int(lengths.max(initial=1))
        there = np.arange(width) < lengths[:, None]

        def laid(name: str, fill: float, kind: type) -> np.ndarray:
            out = np.full(there.shape, fill, dtype=kind)
            out[there] = batch.column(name).flatten().to_numpy(zero_copy_only=False)
            return out

        return Blocks(laid("__high", -np.inf, float), laid("__low", np.inf, float), laid("__falls", 0, np.int64))

    def summary(self, ratios: Sequence[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Highest, lowest, and the bits of falls, of every block."""
        before = np.full(self.high.shape, -np.inf)
        before[:, 1:] = np.maximum.accumulate(self.high, axis=1)[:, :-1]
        bits = np.bitwise_or.reduce(self.falls, axis=1)
        for i, ratio in enumerate(ratios):
            bits |= (self.low < ratio * before).any(axis=1).astype(np.int64) << i
        return self.high.max(axis=1), self.low.min(axis=1), bits


class Ladder:
    """Levels of blocks of ``rows`` (``key``, ``order``, ``value``), staged.

    ``numbered`` has the rows with ``__at``, their place from 0 in their key. Level 0 has
    the values themselves and ``carry``, a long of each. Rows without a value or with NaN are left out.
    """

    def __init__(self, rows: DataFrame, key: str, order: str, value: str, ratios: Sequence[float] = (), width: int = WIDTH) -> None:
        self.key, self.width = key, width
        kept = rows.where(F.col(value).isNotNull() & ~F.isnan(value)).select(key, F.col(order).alias("__order"), F.col(value).cast("double").alias("__value"))
        placed = number_rows(kept, [key], ["__order", "__value"], "__at")
        self.numbered = stage(placed.withColumn("__at", F.col("__at") - 1))
        last = self.numbered.agg(F.max("__at")).first()[0] or 0
        x = F.struct("__at", "__value", "__order")
        bottom = self.numbered.groupBy(key, self._above("__at").alias("__node")).agg(F.array_sort(F.collect_list(x)).alias("x"))
        values, nothing = F.col("x.__value"), F.transform("x", lambda _: F.lit(0).cast("long"))
        self.levels = [stage(bottom.select(key, "__node", values.alias("__high"), values.alias("__low"), nothing.alias("__falls"), F.col("x.__order").alias("__carried")))]
        while last >= width:
            last //= width
            parts = self._summed(self.levels[-1], list(ratios))
            x = F.struct("__node", *SUMMARY)
            above = parts.groupBy(key, self._above("__node").alias("__up")).agg(F.array_sort(F.collect_list(x)).alias("x"))
            self.levels.append(stage(above.select(key, F.col("__up").alias("__node"), *[F.col(f"x.{c}").alias(c) for c in SUMMARY])))

    def _above(self, place: str) -> Column:
        return F.floor(F.col(place) / F.lit(self.width)).cast("long")

    def _summed(self, level: DataFrame, ratios: list[float]) -> DataFrame:
        key = self.key

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in _sliced(batch):
                    high, low, bits = Blocks.of(part).summary(ratios)
                    yield pa.RecordBatch.from_arrays([part.column(key), part.column("__node"), pa.array(high), pa.array(low), pa.array(bits)], names=[key, "__node", *SUMMARY])

        schema = T.StructType([level.schema[key], level.schema["__node"]] + [T.StructField(n, t) for n, t in zip(SUMMARY, (T.DoubleType(), T.DoubleType(), T.LongType()), strict=True)])
        return level.select(key, "__node", *SUMMARY).mapInArrow(add_up, schema)

    def search(self, searches: DataFrame, look: Callable[[Blocks, dict, bool], tuple], rounds: int = 1000) -> DataFrame:
        """Every search with ``__found``, the place where it ended (null: beyond the last value), and its ``__carry``.

        ``searches``: the key, ``__from`` (the place it starts at) and columns that ``look`` reads
        and sets. ``look(blocks, state, values)`` gets blocks and the searches' state, a dict of arrays with
        ``__child`` (where each goes on in its block), and returns two arrays: the child at which each
        search has to go down, or at level 0 ends, -1 where there is none; and whether it is done.
        """
        state_columns = [c for c in searches.columns if c not in (self.key, "__from")]
        start = searches.select(
            "*", F.lit(0).alias("__level"), self._above("__from").alias("__node"), (F.col("__from") % F.lit(self.width)).cast("long").alias("__child"),
            F.lit(None).cast("long").alias("__found"), F.lit(None).cast("long").alias("__carry"),
        )
        top = len(self.levels) - 1
        live, finished = stage(start), []
        sweep = [*range(top + 1), *range(top - 1, 0, -1)]
        for turn in range(rounds * len(sweep)):
            level = sweep[turn % len(sweep)]
            counts = dict(live.groupBy("__level").count().collect())
            if not any(n for at, n in counts.items() if at >= 0):
                break
            finished.append(live.where("__level < 0"))
            if not counts.get(level):
                live = live.where("__level >= 0")
                continue
            here = join_on(live.where(F.col("__level") == level), self.levels[level], [self.key, "__node"], "inner", null_safe=False)
            moved = here.mapInArrow(self._mover(look, level, top, live.schema, state_columns), live.schema)
            live = stage(moved.unionByName(live.where((F.col("__level") >= 0) & (F.col("__level") != level))))
        out = live
        for part in finished:
            out = out.unionByName(part)
        return out.where("__level < 0").drop("__level", "__node", "__child", "__from")

    def _mover(self, look: Callable, level: int, top: int, schema: T.StructType, state_columns: list[str]) -> Callable:
        width, names = self.width, schema.names

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in _sliced(batch):
                    blocks = Blocks.of(part)
                    state = {c: part.column(c).to_numpy(zero_copy_only=False).copy() for c in (*state_columns, "__child")}
                    at, done = look(blocks, state, level == 0)
                    node = part.column("__node").to_numpy()
                    down, up = (at >= 0) & ~done, (at < 0) & ~done
                    place = node * width + at
                    lost = up & (level == top)
                    state["__level"] = np.where(done | lost, -1, np.where(down, level - 1, level + 1))
                    state["__node"] = np.where(down, place, np.where(up, node // width, node))
                    state["__child"] = np.where(down, 0, np.where(up, node % width + 1, state["__child"]))
                    found = [int(p) if d else None for p, d in zip(place, done, strict=True)]
                    carry = [None] * len(found)
                    if level == 0:
                        kept = part.column("__carried")
                        carry = [kept[int(i)][int(a)].as_py() if d else None for i, (a, d) in enumerate(zip(at, done, strict=True))]
                    columns = []
                    for field in schema:
                        kind = part.schema.field(field.name).type
                        special = {"__found": found, "__carry": carry}
                        columns.append(pa.array(special[field.name], kind) if field.name in special else pa.array(state[field.name], kind, from_pandas=True) if field.name in state else part.column(field.name))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        return move


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def ahead(blocks: Blocks, child: np.ndarray) -> Blocks:
    """The blocks without what lies before each search."""
    past = np.arange(blocks.high.shape[1]) < child[:, None]
    return Blocks(np.where(past, -np.inf, blocks.high), np.where(past, np.inf, blocks.low), np.where(past, 0, blocks.falls))


def first(hits: np.ndarray) -> np.ndarray:
    """Place of the first hit of every row, -1 without one."""
    return np.where(hits.any(axis=1), hits.argmax(axis=1), -1)


def look_above(blocks: Blocks, state: dict, values: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ends at the first value above ``bound``."""
    at = first(ahead(blocks, state["__child"]).high > state["bound"][:, None])
    return at, (at >= 0) & values


def first_above(values: DataFrame, key: str, order: str, value: str, asked: DataFrame, width: int = WIDTH) -> DataFrame:
    """For each row of ``asked`` (``key``, ``after``, ``bound``, more) the first value above ``bound`` at or after ``after``.

    Adds ``found_order`` and ``found_value``; rows without one drop out. ``order`` and ``after`` are longs.
    Work is one block per level for each row asked, however many values lie between.
    """
    ladder = Ladder(values, key, order, value, width=width)
    named = stage(asked.withColumn("__id", F.monotonically_increasing_id()))
    marks = ladder.numbered.select(key, F.col("__order").alias("__t"), "__at")
    starts = _next_place(named.select(key, "after", "__id"), marks, key)
    searches = stage(join_on(named, starts, ["__id"], "inner").where("bound is not null").withColumn("bound", F.col("bound").cast("double")))
    found = ladder.search(searches.select(key, "__from", "bound", "__id"), look_above).where("__found is not null").select("__id", "__found", key)
    hit = join_on(found, ladder.numbered.withColumnRenamed("__at", "__found"), [key, "__found"], "inner", null_safe=False)
    hit = hit.select("__id", F.col("__order").alias("found_order"), F.col("__value").alias("found_value"))
    return join_on(searches.drop("__from"), hit, ["__id"], "inner").drop("__id")


def _next_place(asked: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """``__id``, ``__from``: the place of the first mark at or after ``after``."""
    nothing = F.lit(None).cast("long")
    both = marks.select(key, F.col("__t").alias("after"), F.lit(1).alias("__mark"), "__at", nothing.alias("__id")).unionByName(
        asked.select(key, "after", F.lit(0).alias("__mark"), nothing.alias("__at"), "__id")
    )
    known = both.where(F.col(key).isNotNull() & F.col("after").isNotNull())
    seen = following(known, [key], ["after", "__mark"], {"__from": ("min", F.col("__at"))})
    return seen.where("__id is not null and __from is not null").select("__id", "__from")

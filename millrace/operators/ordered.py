"""Ordered computations per key that never need one key in one task.

A window over a key that holds a third of all rows would sort that third in a
single task. Each function here first measures the largest key. Small keys use
a plain Spark window. Otherwise rows are range-partitioned on key and order,
staged, and worked on in pieces; a small table of per-piece totals carries the
state from piece to piece. Both ways give the same rows.

``order`` must identify rows within a key up to rows equal in every column.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.keyed import GATHERED, join_on, largest_group
from millrace.session import max_group_rows, stage, stage_dir

PIECE = "__piece"


def fits(df: DataFrame | str, keys: Sequence[str], limit: int) -> bool:
    """Whether every key is small enough for one task; known of rows that ``gather`` brought together."""
    return df is GATHERED or largest_group(df, keys) <= limit


def _pieces(df: DataFrame, keys: Sequence[str], order: Sequence, limit: int) -> DataFrame:
    """Range-partition on key and order; the staged column ``__piece`` grows along ``order``."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // limit))
    ranged = df.repartitionByRange(parts, *keys, *order).withColumn(PIECE, F.spark_partition_id())
    return stage(ranged)


def _carried(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence, name: str = "rn", limit: int | None = None, sizes: DataFrame | str | None = None
) -> DataFrame:
    """1-based row number per key."""
    limit = limit or max_group_rows(df.sparkSession)
    if fits(df if sizes is None else sizes, keys, limit):
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w).cast("long"))
    pieces = _pieces(df, keys, order, limit)
    local = F.row_number().over(Window.partitionBy(*keys, PIECE).orderBy(*order))
    before = (
        pieces.groupBy(*keys, PIECE)
        .count()
        .withColumn("__ord_before", F.coalesce(F.sum("count").over(_carried(keys)), F.lit(0)))
        .drop("count")
    )
    return (
        join_on(pieces.withColumn(name, local), before, [*keys, PIECE], "left")
        .withColumn(name, F.col(name) + F.col("__ord_before"))
        .drop("__ord_before", PIECE)
    )


def with_halo(
    df: DataFrame, keys: Sequence[str], order: Sequence, before: int, after: int, rows: int
) -> DataFrame:
    """Cut each key into blocks of ``rows`` rows, each with its neighbours' edge rows.

    Adds ``__rn`` (row number in the key), ``__block`` and ``__own`` (false on
    the copied edge rows). Growth is ``1 + (before + after) / rows``.
    """
    size = max(rows, before, after, 1)
    home = F.floor((F.col("__rn") - 1) / F.lit(size))
    pos = (F.col("__rn") - 1) % F.lit(size)
    targets = F.array(
        home,
        F.when(pos >= size - before, home + 1) if before else F.lit(None).cast("long"),
        F.when((pos < after) & (home > 0), home - 1) if after else F.lit(None).cast("long"),
    )
    return (
        number_rows(df, keys, order, "__rn")
        .withColumn("__home", home)
        .withColumn("__block", F.explode(F.filter(targets, lambda b: b.isNotNull())))
        .withColumn("__own", F.col("__home") == F.col("__block"))
        .drop("__home")
    )


def bounded(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    columns: dict[str, Callable[[WindowSpec], Column]],
    before: int,
    after: int = 0,
    limit: int | None = None,
    sizes: DataFrame | str | None = None,
) -> DataFrame:
    """Window columns that look at most ``before`` rows back and ``after`` ahead.

    Each entry maps a new column to a function of an ordered window, such as
    ``lambda w: F.avg("x").over(w.rowsBetween(-29, 0))``. ``sizes`` may name a
    cheaper frame with the same rows per key on which to measure the keys.
    """
    limit = limit or max_group_rows(df.sparkSession)
    if fits(df if sizes is None else sizes, keys, limit):
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({n: f(w) for n, f in columns.items()})
    blocks = with_halo(df, keys, order, before, after, limit)
    w = Window.partitionBy(*keys, "__block").orderBy("__rn")
    return (
        blocks.withColumns({n: f(w) for n, f in columns.items()})
        .filter("__own")
        .drop("__rn", "__block", "__own")
    )


def _last_value(col: Column, w: WindowSpec) -> Column:
    return F.last(col, ignorenulls=True).over(w)


def _first_value(col: Column, w: WindowSpec) -> Column:
    return F.first(col, ignorenulls=True).over(w)


# kind -> (over a window, total of a piece, totals of earlier pieces, join of carry and local)
_RUNNING = {
    "sum": (
        lambda c, w: F.sum(c).over(w),
        lambda c: F.sum(c),
        lambda c, w: F.sum(c).over(w),
        lambda carry, here: F.coalesce(carry + here, carry, here),
    ),
    "count": (
        lambda c, w: F.count(c).over(w),
        lambda c: F.count(c),
        lambda c, w: F.sum(c).over(w),
        lambda carry, here: F.coalesce(carry, F.lit(0)) + F.coalesce(here, F.lit(0)),
    ),
    "min": (
        lambda c, w: F.min(c).over(w),
        lambda c: F.min(c),
        lambda c, w: F.min(c).over(w),
        lambda carry, here: F.least(carry, here),
    ),
    "max": (
        lambda c, w: F.max(c).over(w),
        lambda c: F.max(c),
        lambda c, w: F.max(c).over(w),
        lambda carry, here: F.greatest(carry, here),
    ),
    "last": (
        _last_value,
        lambda c: F.max_by(c, F.when(c.isNotNull(), F.col("__ord_n"))),
        _last_value,
        lambda carry, here: F.coalesce(here, carry),
    ),
    "first": (
        _first_value,
        lambda c: F.min_by(c, F.when(c.isNotNull(), F.col("__ord_n"))),
        _first_value,
        lambda carry, here: F.coalesce(carry, here),
    ),
}


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    columns: dict[str, tuple[str, Column]],
    include_current: bool = True,
    limit: int | None = None,
    sizes: DataFrame | str | None = None,
) -> DataFrame:
    """Totals over all earlier rows of the key (and the current one).

    ``columns`` maps a new column to ``(kind, value)`` with kind one of sum,
    count, min, max, last, first; ``last`` and ``first`` skip nulls.
    """
    limit = limit or max_group_rows(df.sparkSession)
    end = 0 if include_current else -1
    if fits(df if sizes is None else sizes, keys, limit):
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
        return df.withColumns({n: _RUNNING[k][0](c, w) for n, (k, c) in columns.items()})

    inputs = {f"__ord_v_{n}": c for n, (_, c) in columns.items()}
    pieces = _pieces(df.withColumns(inputs), keys, order, limit)
    in_piece = Window.partitionBy(*keys, PIECE).orderBy(*order)
    pieces = pieces.withColumn("__ord_n", F.row_number().over(in_piece))
    w = Window.partitionBy(*keys, PIECE).orderBy("__ord_n").rowsBetween(Window.unboundedPreceding, end)
    local = pieces.withColumns({n: _RUNNING[k][0](F.col(f"__ord_v_{n}"), w) for n, (k, _) in columns.items()})
    totals = pieces.groupBy(*keys, PIECE).agg(
        *[_RUNNING[k][1](F.col(f"__ord_v_{n}")).alias(f"__ord_t_{n}") for n, (k, _) in columns.items()]
    )
    carry = totals.select(
        *keys,
        PIECE,
        *[_RUNNING[k][2](F.col(f"__ord_t_{n}"), _carried(keys)).alias(f"__ord_c_{n}") for n, (k, _) in columns.items()],
    )
    out = join_on(local, carry, [*keys, PIECE], "left")
    out = out.withColumns(
        {n: _RUNNING[k][3](F.col(f"__ord_c_{n}"), F.col(n)) for n, (k, _) in columns.items()}
    )
    return out.select(*df.columns, *columns)


def following(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, tuple[str, Column]],
    include_current: bool = True,
) -> DataFrame:
    """Like ``running`` over all later rows of the key."""
    return running(df, keys, [F.desc(c) for c in order], columns, include_current)


def _averaged(x: pd.Series, alpha: float) -> pd.Series:
    """Moving average of the values there are; a row without a value repeats the average before it."""
    return x.astype(float).ewm(alpha=alpha, adjust=False, ignore_na=True).mean()


def ewm(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, tuple[str, int]],
    limit: int | None = None,
    sizes: DataFrame | str | None = None,
) -> DataFrame:
    """Exponential moving averages: new column -> (source column, span).

    ``e[0] = x[0]`` and ``e[t] = a x[t] + (1 - a) e[t-1]`` with
    ``a = 2 / (span + 1)``. Null and NaN values are passed over: the average stays as
    it was, and is null before the first value. On split keys each piece is averaged
    from zero and the average entering it is added with its decay
    ``(1 - a) ** (values so far)``. Null order values come first.
    """
    limit = limit or max_group_rows(df.sparkSession)
    schema = T.StructType(
        df.schema.fields + [T.StructField(n, T.DoubleType()) for n in columns]
    )
    spans = {n: (src, 2.0 / (span + 1.0)) for n, (src, span) in columns.items()}
    names = list(order)

    if fits(df if sizes is None else sizes, keys, limit):

        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(names, kind="stable", na_position="first")
            for n, (src, a) in spans.items():
                pdf[n] = _averaged(pdf[src], a)
            return pdf

        return df.groupBy(*keys).applyInPandas(whole, schema)

    pieces = _pieces(df, keys, order, limit)
    inner = [T.StructField(PIECE, T.IntegerType()), T.StructField("__row", T.LongType())]
    for n in columns:
        inner += [T.StructField(f"__k_{n}", T.LongType()), T.StructField(f"__x_{n}", T.DoubleType())]
    local_schema = T.StructType(schema.fields + inner)

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(names, kind="stable", na_position="first")
        for n, (src, a) in spans.items():
            x = pdf[src].astype(float)
            pdf[n] = _averaged(pd.concat([pd.Series([0.0]), x], ignore_index=True), a).to_numpy()[1:]
            pdf[f"__k_{n}"] = x.notna().cumsum()
            pdf[f"__x_{n}"] = x.bfill().iloc[0]  # the piece's first value
        pdf["__row"] = np.arange(1, len(pdf) + 1)
        return pdf[[f.name for f in local_schema.fields]]

    parts = stage(pieces.groupBy(*keys, PIECE).applyInPandas(local, local_schema))
    ends = parts.groupBy(*keys, PIECE).agg(
        *[F.max_by(n, "__row").alias(f"__e_{n}") for n in columns],
        *[F.max(f"__k_{n}").alias(f"__k_{n}") for n in columns],
        *[F.max(f"__x_{n}").alias(f"__x_{n}") for n in columns],
    )
    carry_schema = T.StructType(
        [f for f in df.schema.fields if f.name in keys]
        + [T.StructField(PIECE, T.IntegerType())]
        + [T.StructField(f"__c_{n}", T.DoubleType()) for n in columns]
        + [T.StructField(f"__seen_{n}", T.BooleanType()) for n in columns]
    )

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:  # one row per piece of the key
        pdf = pdf.sort_values(PIECE)
        for n, (_, a) in spans.items():
            carried, seen, state = [], [], None
            for x0, end, many in zip(pdf[f"__x_{n}"], pdf[f"__e_{n}"], pdf[f"__k_{n}"]):
                seen.append(state is not None)
                if state is None and many:
                    state = x0
                carried.append(state)
                if many:
                    state = end + (1.0 - a) ** many * state
            pdf[f"__c_{n}"] = pd.Series(carried, index=pdf.index, dtype=float)
            pdf[f"__seen_{n}"] = seen
        return pdf[[f.name for f in carry_schema.fields]]

    carry = ends.groupBy(*keys).applyInPandas(chain, carry_schema)
    out = join_on(parts, carry, [*keys, PIECE], "left").withColumns(
        {
            n: F.when(
                F.col(f"__seen_{n}") | (F.col(f"__k_{n}") > 0),
                F.col(n) + F.pow(F.lit(1.0 - a), F.col(f"__k_{n}")) * F.col(f"__c_{n}"),
            )
            for n, (_, a) in spans.items()
        }
    )
    return out.select(*df.columns, *columns)


Step = Callable[[tuple, dict | None, pd.DataFrame], tuple[pd.DataFrame, dict]]


def fold(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: Step,
    schema: T.StructType,
    limit: int | None = None,
    sizes: DataFrame | str | None = None,
) -> DataFrame:
    """Sequential state machine per key.

    ``step(key, state, rows)`` gets rows in order and the state left by the
    earlier rows (``None`` at first; plain values that JSON can hold) and
    returns output rows and the new state. Keys run in parallel. A key over the
    limit is fed block by block, its state staged between blocks, so that a
    task only ever holds one block; ``rows['__last']`` marks the key's last row.
    Null order values come first.
    """
    limit = limit or max_group_rows(df.sparkSession)
    names, key_list = list(order), list(keys)
    cols = [f.name for f in schema.fields]

    if fits(df if sizes is None else sizes, keys, limit):

        def whole(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(names, kind="stable", na_position="first").reset_index(drop=True)
            pdf["__last"] = np.arange(len(pdf)) == len(pdf) - 1
            return step(key, None, pdf)[0][cols]

        return df.groupBy(*keys).applyInPandas(whole, schema)

    numbered = number_rows(df, keys, order, "__rn", limit)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    rows = stage(
        join_on(numbered, sizes, keys, "left")
        .withColumn("__last", F.col("__rn") == F.col("__size"))
        .withColumn("__block", F.floor((F.col("__rn") - 1) / F.lit(limit)).cast("int"))
        .drop("__size")
    )
    last_block = rows.agg(F.max("__block")).first()[0]
    state_schema = T.StructType(
        [f for f in df.schema.fields if f.name in keys] + [T.StructField("__state", T.StringType())]
    )
    # Output rows and the state row share one frame: the state row has only __state set.
    both = T.StructType(
        [T.StructField(f"__k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
        + [T.StructField("__state", T.StringType())]
        + schema.fields
    )

    def one_block(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = [f.name for f in both.fields]
        if not len(left):  # the key ended in an earlier block
            return pd.DataFrame(columns=names)
        state = json.loads(right["__state"].iloc[0]) if len(right) else None
        left = left.sort_values("__rn").drop(columns=["__rn", "__block"]).reset_index(drop=True)
        out, state = step(key, state, left)
        frame = out[cols].copy()
        frame["__state"] = None
        if not left["__last"].iloc[-1]:
            frame = pd.concat([frame, pd.DataFrame({"__state": [json.dumps(state)]})], ignore_index=True)
        for i, v in enumerate(key):
            frame[f"__k{i}"] = v
        return frame.reindex(columns=names)

    # Every block is written under one folder, which is read once at the end.
    spark = df.sparkSession
    folder = f"{stage_dir(spark).rstrip('/')}/fold-{uuid.uuid4().hex}"
    states = spark.createDataFrame([], state_schema)
    for b in range(last_block + 1):
        here = rows.filter(F.col("__block") == b)
        path = f"{folder}/__b={b}"
        here.groupBy(*key_list).cogroup(states.groupBy(*key_list)).applyInPandas(one_block, both).write.parquet(path)
        states = spark.read.schema(both).parquet(path).filter("__state is not null").select(
            *[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)], "__state"
        )
    return spark.read.schema(both).parquet(folder).filter("__state is null").select(*cols)

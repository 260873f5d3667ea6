"""Lagged, trailing, expanding and rank features that do not look ahead by accident."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import maths, times
from millrace.operators.keyed import GATHERED, attach, join_on
from millrace.operators.ordered import bounded, number_rows, running

_ROW_KINDS = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max, "stddev": F.stddev}


def previous_event(df: DataFrame, key: str, order: Sequence[str], cols: dict[str, str]) -> DataFrame:
    """Values of the key's previous row: new column -> source column.

    Rows without a key have no previous row; they bypass the window so that
    they do not pile up in one task.
    """
    keyed = bounded(
        df.filter(F.col(key).isNotNull()), [key], order, {n: (lambda c: lambda w: F.lag(c).over(w))(c) for n, c in cols.items()}, 1
    )
    keyless = df.filter(F.col(key).isNull()).withColumns(
        {n: F.lit(None).cast(df.schema[c].dataType) for n, c in cols.items()}
    )
    return keyed.unionByName(keyless)


def with_gap_and_path(
    df: DataFrame, key: str, origin: str, dest: str, prev_origin: str, prev_arrival: str, departs: str
) -> DataFrame:
    """Minutes since the previous arrival and the three-stop path."""
    path = F.concat_ws("->", F.col(prev_origin).cast("string"), F.col(origin).cast("string"), F.col(dest).cast("string"))
    return df.withColumns(
        {
            "minutes_between": times.minutes_between(F.col(prev_arrival), F.col(departs)),
            "path": F.when(F.col(key).isNotNull(), path),
        }
    )


def prefer_first_source(sources: Sequence[DataFrame], key: str) -> DataFrame:
    """One row per key; an earlier source wins over a later one."""
    stacked = None
    for i, df in enumerate(sources):
        one = df.withColumn("__priority", F.lit(i))
        stacked = one if stacked is None else stacked.unionByName(one)
    rest = [c for c in stacked.columns if c not in (key, "__priority")]
    best = F.min_by(F.struct(*rest), F.struct("__priority", *rest)) if rest else F.min("__priority")
    out = stacked.groupBy(key).agg(best.alias("__row"))
    return out.select(key, "__row.*") if rest else out.select(key)


def _row_frame(kind: str, col: str, dtype: T.DataType, lo: int, hi: int) -> Callable[[WindowSpec], Column]:
    """Aggregate over a row frame.

    Spark adds up a sliding frame anew for every row. Sums and counts of whole
    numbers are instead taken as the gap of two growing totals, which is exact
    and costs the same for any frame length.
    """
    whole = isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if kind not in ("sum", "count", "avg") or not (whole or kind == "count"):
        return lambda w: _ROW_KINDS[kind](col).over(w.rowsBetween(lo, hi))
    start = Window.unboundedPreceding

    def gap(agg: Callable, w: WindowSpec) -> Column:
        upto, before = agg(col).over(w.rowsBetween(start, hi)), agg(col).over(w.rowsBetween(start, lo - 1))
        return F.coalesce(upto, F.lit(0)) - F.coalesce(before, F.lit(0))

    def over(w: WindowSpec) -> Column:
        n = gap(F.count, w)
        if kind == "count":
            return n
        total = F.when(n > 0, gap(F.sum, w))  # null without values, as a plain sum
        return total if kind == "sum" else total / n

    return over


LONG_SPAN = 32  # frames from here on are put together from two halves


def _moments(col: str, w: WindowSpec) -> Column:
    """Count, mean and sum of squared deviations over a window."""
    n = F.count(col).over(w)
    return F.struct(n.alias("n"), F.avg(col).over(w).alias("mean"), (F.var_pop(col).over(w) * n).alias("dev"))


def _together(a: Column, b: Column) -> Column:
    """Moments of two sets of rows; nothing is ever subtracted from a total."""
    n = a["n"] + b["n"]
    gap = b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"),
        ((a["mean"] * a["n"] + b["mean"] * b["n"]) / n).alias("mean"),
        (a["dev"] + b["dev"] + gap * gap * a["n"] * b["n"] / n).alias("dev"),
    )
    return F.when(b.isNull() | (b["n"] == 0), a).when(a["n"] == 0, b).otherwise(both)


_OF_MOMENTS = {
    "avg": lambda m: F.when(m["n"] > 0, m["mean"]),
    "stddev": lambda m: F.when(m["n"] > 1, F.sqrt(m["dev"] / (m["n"] - 1))),
}


def _long_frames(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, tuple[str, Column]], span: int, sizes: DataFrame | str | None
) -> DataFrame:
    """Means and deviations of the last ``span`` rows and this one, at the cost of a short frame.

    Rows of a key are cut into segments as long as the frame. A frame is the end of one segment
    and the beginning of the next: growing moments from either side of a segment, each one pass, are put together.
    """
    width = span + 1
    values = {str(c): c for _, c in columns.values()}
    names = {text: f"__v{i}" for i, text in enumerate(values)}
    wide = df.withColumns({names[text]: c.cast("double") for text, c in values.items()})
    place = F.col("__nth") - 1
    cut = number_rows(wide, keys, order, "__nth", sizes=sizes).withColumn("__seg", F.floor(place / F.lit(width)))
    segment = Window.partitionBy(*keys, "__seg")
    grow = (Window.unboundedPreceding, 0)
    forth, back = segment.orderBy("__nth").rowsBetween(*grow), segment.orderBy(F.desc("__nth")).rowsBetween(*grow)
    sides = cut.withColumns({f"__a{v}": _moments(v, forth) for v in names.values()})
    sides = sides.withColumns({f"__b{v}": _moments(v, back) for v in names.values()})
    rest = {f"__c{v}": (lambda w, v=v: F.lag(f"__b{v}", span).over(w)) for v in names.values()}
    sides = bounded(sides, keys, ["__nth"], rest, span, sizes=sizes)
    begun = place % F.lit(width) < span  # a frame that is a whole segment has no other half
    full = {v: _together(F.col(f"__a{v}"), F.when(begun, F.col(f"__c{v}"))) for v in names.values()}
    out = sides.withColumns({f"__m{v}": m for v, m in full.items()})
    out = out.withColumns({n: _OF_MOMENTS[kind](F.col(f"__m{names[str(c)]}")) for n, (kind, c) in columns.items()})
    return out.select(*df.columns, *columns)


def trailing(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, tuple[str, Column]],
    span: int,
    include_current: bool = True,
    frame: str = "rows",
    day: str | None = None,
    sizes: DataFrame | str | None = None,
) -> DataFrame:
    """Aggregates over the last ``span`` rows or days.

    ``columns`` maps a new column to ``(kind, value)``, kind one of sum, avg,
    count (rows frames also min, max, stddev). With ``frame="rows"`` the frame is
    the current row and ``span`` rows before it. With ``frame="days"`` it is whole
    calendar days: values are summed per key and day first, and the window runs
    over that daily table, which the calendar bounds.
    """
    end = 0 if include_current else -1
    if frame == "rows":
        cols = {f"__v_{n}": c for n, (_, c) in columns.items()}
        wide = df.withColumns(cols)
        whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
        long = {
            n: c for n, c in columns.items()
            if span >= LONG_SPAN and include_current and (c[0] == "stddev" or (c[0] == "avg" and not isinstance(wide.schema[f"__v_{n}"].dataType, whole)))
        }
        if long:
            out = _long_frames(df, keys, order, long, span, sizes)
            rest = {n: c for n, c in columns.items() if n not in long}
            return (trailing(out, keys, order, rest, span, sizes=sizes) if rest else out).select(*df.columns, *columns)
        over = {
            n: _row_frame(kind, f"__v_{n}", wide.schema[f"__v_{n}"].dataType, -span, end)
            for n, (kind, _) in columns.items()
        }
        return bounded(wide, keys, order, over, span, sizes=sizes).drop(*cols)
    if frame != "days" or day is None:
        raise ValueError("frame is 'rows', or 'days' with a day column")
    daily = df.groupBy(*keys, day).agg(
        *[F.sum(c).alias(f"__s_{n}") for n, (_, c) in columns.items()],
        *[F.count(c).alias(f"__n_{n}") for n, (_, c) in columns.items()],
    )
    w = Window.partitionBy(*keys).orderBy("__day").rangeBetween(-span, end)
    total = {
        "sum": lambda n: F.sum(f"__s_{n}").over(w),
        "count": lambda n: F.coalesce(F.sum(f"__n_{n}").over(w), F.lit(0)),
        "avg": lambda n: F.sum(f"__s_{n}").over(w) / F.nullif(F.sum(f"__n_{n}").over(w).cast("double"), F.lit(0.0)),
    }
    per_day = daily.withColumn("__day", times.day_number(F.col(day))).select(
        *keys, day, *[total[k](n).alias(n) for n, (k, _) in columns.items()]
    )
    return join_on(df, per_day, [*keys, day], "left")


def expanding(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, tuple[str, Column]],
    include_current: bool = True,
    sizes: DataFrame | str | None = None,
) -> DataFrame:
    """Aggregates over all earlier rows: sum, count, min, max, last, first or avg."""
    parts: dict[str, tuple[str, Column]] = {}
    for n, (kind, c) in columns.items():
        if kind == "avg":
            parts[f"__s_{n}"], parts[f"__n_{n}"] = ("sum", c.cast("double")), ("count", c)
        else:
            parts[n] = (kind, c)
    out = running(df, keys, order, parts, include_current, sizes=sizes)
    means = {
        n: F.col(f"__s_{n}") / F.nullif(F.col(f"__n_{n}").cast("double"), F.lit(0.0))
        for n, (kind, _) in columns.items()
        if kind == "avg"
    }
    return out.withColumns(means).select(*df.columns, *columns) if means else out


def prior_rate(
    df: DataFrame, place: str, day: str, order: Sequence[str], outcome: str, name: str, mode: str = "row", fallback: float = 0.15,
    sizes: str | None = None,
) -> DataFrame:
    """Rate of the period before, falling back to the place's mean and a constant.

    ``mode="row"`` takes the daily rate of the row before, which mostly lies on
    the same day; ``mode="day"`` takes the last earlier day's rate.
    """
    daily = df.groupBy(place, day).agg(F.avg(outcome).alias("__rate"))
    if mode == "day":
        w = Window.partitionBy(place).orderBy(day)
        daily = daily.withColumn("__prior", F.lag("__rate").over(w)).drop("__rate")
        out = join_on(df, daily, [place, day], "left")
    elif mode == "row":
        near = sizes is GATHERED
        out = attach(df, [place, day], {"__rate": F.avg(outcome)}, sizes=sizes) if near else join_on(df, daily, [place, day], "left")
        lag = {"__prior": lambda w: F.lag("__rate").over(w)}
        out = bounded(out, [place], order, lag, 1, sizes=sizes if near else df.select(place))
    else:
        raise ValueError("mode is 'row' or 'day'")
    out = attach(out, [place], {"__mean": F.avg(outcome)}, source=df, sizes=sizes)
    return out.withColumn(name, F.coalesce("__prior", "__mean", F.lit(fallback))).select(*df.columns, name)


def same_day_so_far(
    df: DataFrame, place: str, day: str, order: Sequence[str], outcome: str, sizes: DataFrame | str | None = None
) -> DataFrame:
    """Rows and late rows strictly earlier on the same day and the smoothed share ``(d + 0.5) / (n + 1)``."""
    out = running(
        df, [place, day], order,
        {"prior_rows_today": ("count", F.lit(1)), "prior_late_today": ("sum", F.col(outcome))},
        include_current=False,
        sizes=sizes,
    )
    out = out.withColumn("prior_late_today", F.coalesce("prior_late_today", F.lit(0)))
    return out.withColumn(
        "prior_late_share", (F.col("prior_late_today") + F.lit(0.5)) / (F.col("prior_rows_today") + F.lit(1))
    )


def rolling_zscore(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], back: int = 168, sizes: DataFrame | str | None = None
) -> DataFrame:
    """Mean, deviation and z-score of each column over the last ``back`` rows and this one."""
    over = {}
    for c in cols:
        over[f"{c}_mean"] = ("avg", F.col(c))
        over[f"{c}_std"] = ("stddev", F.col(c))
    out = trailing(df, keys, order, over, back, sizes=sizes)
    return out.withColumns(
        {f"{c}_z": maths.share(F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_std")) for c in cols}
    )


def seasonal_zscore(
    df: DataFrame, keys: Sequence[str], col: str, name: str, source: DataFrame | None = None, sizes: str | None = None
) -> DataFrame:
    """z-score in the whole group, negatives and undefined values as 0."""
    out = attach(df, keys, {"__mean": F.avg(col), "__std": F.stddev(col)}, source=source, sizes=sizes)
    z = maths.share(F.col(col) - F.col("__mean"), F.col("__std"))
    return out.withColumn(name, F.when(z > 0, z).otherwise(F.lit(0.0))).drop("__mean", "__std")


def shrunk_rate(df: DataFrame, keys: Sequence[str], outcome: str, prior: Column, weight: int, name: str) -> DataFrame:
    """Group rate pulled towards ``prior`` as if ``weight`` more rows had it."""
    out = attach(df, keys, {"__s": F.sum(outcome), "__n": F.count(F.lit(1))})
    return out.withColumn(
        name, (F.col("__s") + F.lit(weight) * prior) / (F.col("__n") + F.lit(weight))
    ).drop("__s", "__n")


def layered_rate(df: DataFrame, layers: Sequence[Sequence[str]], outcome: str, last: Column, name: str) -> DataFrame:
    """First available group mean over several groupings, then ``last``."""
    out = df
    for i, keys in enumerate(layers):
        out = attach(out, keys, {f"__l{i}": F.avg(outcome)}, source=df)
    return out.withColumn(name, F.coalesce(*[F.col(f"__l{i}") for i in range(len(layers))], last)).select(
        *df.columns, name
    )


def volume_and_distance_weight(df: DataFrame, keys: Sequence[str], distance: str, name: str) -> DataFrame:
    """Share of all rows plus mean distance relative to the overall mean."""
    out = attach(df, keys, {"__n": F.count(F.lit(1)), "__d": F.avg(distance)})
    out = attach(out, [], {"__all_n": F.count(F.lit(1)), "__all_d": F.avg(distance)}, source=df)
    return out.withColumn(
        name, F.col("__n") / F.col("__all_n") + F.col("__d") / F.col("__all_d")
    ).select(*df.columns, name)


def percent_rank(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """Global percent rank without a global sort of rows.

    Tied rows share a rank, so it is enough to count rows per distinct order
    value, run totals over those counts and join the result back.
    """
    counts = df.groupBy(*order).agg(F.count(F.lit(1)).alias("__n"))
    before = running(counts, [], list(order), {"__before": ("sum", F.col("__n"))}, include_current=False)
    before = attach(before, [], {"__all": F.sum("__n")})
    rank = F.coalesce("__before", F.lit(0)) / F.nullif((F.col("__all") - 1).cast("double"), F.lit(0.0))
    ranks = before.select(*order, F.coalesce(rank, F.lit(0.0)).alias(name))
    return join_on(df, ranks, order, "left")


def rolling_folds(df: DataFrame, order: Sequence[str], cuts: Sequence[float] = (0.2, 0.4, 0.6, 0.8)) -> DataFrame:
    """Each row once per cut: ``train`` up to the cut by time rank, ``validation`` after it."""
    ranked = percent_rank(df, order, "__rank")
    return ranked.withColumn("cut", F.explode(F.array(*[F.lit(float(c)) for c in cuts]))).withColumn(
        "part", F.when(F.col("__rank") <= F.col("cut"), "train").otherwise("validation")
    ).drop("__rank")


def lag_metric(df: DataFrame, entity: str, period: str, cols: Sequence[str]) -> DataFrame:
    """Last period's value of each metric per entity, this period's where there is none.

    Expects one row per entity and period.
    """
    lags = {f"{c}_lag": (lambda c: lambda w: F.lag(c).over(w))(c) for c in cols}
    out = bounded(df, [entity], [period], lags, 1)
    return out.withColumns({f"{c}_lag": F.coalesce(f"{c}_lag", c) for c in cols})


def next_return(df: DataFrame, keys: Sequence[str], time: str, price: str, paid: str, name: str = "ret") -> DataFrame:
    """``(P[t+1] - P[t] + D[t]) / P[t]``; null on the last row."""
    out = bounded(df, keys, [time], {"__next": lambda w: F.lead(price).over(w)}, 0, 1)
    return out.withColumn(
        name, (F.col("__next") - F.col(price) + F.col(paid)) / F.col(price)
    ).drop("__next")


def pct_change(df: DataFrame, keys: Sequence[str], time: str, col: str, name: str = "change") -> DataFrame:
    out = bounded(df, keys, [time], {"__prev": lambda w: F.lag(col).over(w)}, 1)
    return out.withColumn(name, maths.share(F.col(col), F.col("__prev")) - 1).drop("__prev")


def local_minima(df: DataFrame, keys: Sequence[str], time: str, col: str, name: str = "is_min", strict: bool = False) -> DataFrame:
    """1 where the difference changes to a larger sign at the next row, never on the last row.

    This also fires on down-to-flat and flat-to-up steps; ``strict`` asks for
    down then up.
    """
    out = bounded(
        df, keys, [time],
        {
            "__prev": lambda w: F.lag(col).over(w),
            "__next": lambda w: F.lead(col).over(w),
        },
        1, 1,
    )
    after = F.signum(F.col("__next") - F.col(col))
    # The first row has no difference of its own and takes the sign of the next one.
    before = F.coalesce(F.signum(F.col(col) - F.col("__prev")), after)
    hit = ((before < 0) & (after > 0)) if strict else (after > before)
    return out.withColumn(name, F.when(hit, 1).otherwise(0)).drop("__prev", "__next")


def crossed(a: str, b: str, back: int = 0) -> Callable[[WindowSpec], Column]:
    """1 where ``a`` rose above ``b`` exactly ``back`` rows ago."""

    def over(w: WindowSpec) -> Column:
        at = lambda c, n: F.lag(c, n).over(w) if n else F.col(c)
        hit = (at(a, back + 1) <= at(b, back + 1)) & (at(a, back) > at(b, back))
        return F.when(hit, 1).otherwise(0)

    return over


def held_since_cross(a: str, b: str, bars: int = 3) -> Callable[[WindowSpec], Column]:
    """1 where ``a`` crossed above ``b`` ``bars`` rows ago and stayed above since."""
    up = F.when(F.col(a) > F.col(b), 1).otherwise(0)
    return lambda w: crossed(a, b, bars)(w) * F.min(up).over(w.rowsBetween(1 - bars, 0))


def crossover(df: DataFrame, keys: Sequence[str], time: str, a: str, b: str, name: str) -> DataFrame:
    """1 where ``a`` was at or under ``b`` on the row before and is above it now."""
    return bounded(df, keys, [time], {name: crossed(a, b)}, 1)


def confirmed_cross(df: DataFrame, keys: Sequence[str], time: str, a: str, b: str, name: str, bars: int = 3) -> DataFrame:
    """1 where ``a`` crossed above ``b`` ``bars`` rows ago and stayed above since."""
    return bounded(df, keys, [time], {name: held_since_cross(a, b, bars)}, bars + 1)


def within_next(df: DataFrame, keys: Sequence[str], time: str, flag: str, name: str, bars: int = 5) -> DataFrame:
    """1 where the flag holds now or within the next ``bars`` rows, and when that became known.

    Marks rows before their cause; use ``known_at`` to stay clear of look-ahead.
    """
    hit_time = F.when(F.col(flag) == 1, F.col(time))
    return bounded(
        df, keys, [time],
        {
            name: lambda w: F.max(flag).over(w.rowsBetween(0, bars)),
            "known_at": lambda w: F.min(hit_time).over(w.rowsBetween(0, bars)),
        },
        0, bars,
    )


def rising_edge(df: DataFrame, keys: Sequence[str], time: str, flag: str, name: str) -> DataFrame:
    """1 on the first row of a run of the flag; the key's first row never counts."""
    hit = lambda w: F.when((F.lag(flag).over(w) == 0) & (F.col(flag) == 1), 1).otherwise(0)
    return bounded(df, keys, [time], {name: hit}, 1)


def rolling_position(df: DataFrame, keys: Sequence[str], time: str, col: str, name: str, bars: int = 5, of: str = "max") -> DataFrame:
    """0-based position of the largest (or smallest) value in the last ``bars`` rows; first hit wins.

    Null until the window is full.
    """
    pick = F.array_max if of == "max" else F.array_min
    out = bounded(df, keys, [time], {"__w": lambda w: F.collect_list(col).over(w.rowsBetween(1 - bars, 0))}, bars - 1)
    at = F.array_position(F.col("__w"), pick("__w")) - 1
    return out.withColumn(name, F.when(F.size("__w") == bars, at).cast("int")).drop("__w")


def segments(df: DataFrame, keys: Sequence[str], time: str, value: str, size: int, name: str = "segment") -> DataFrame:
    """Values of the last ``size`` rows as an array on every row that has that many."""
    out = bounded(df, keys, [time], {name: lambda w: F.collect_list(value).over(w.rowsBetween(1 - size, 0))}, size - 1)
    return out.filter(F.size(name) == size)


def run_heads(df: DataFrame, keys: Sequence[str], order: Sequence[str], group: str, name: str = "is_head") -> DataFrame:
    """1 where the group differs from the row before."""
    out = bounded(
        df, keys, order, {"__prev": lambda w: F.lag(F.struct(group)).over(w)}, 1
    )
    return out.withColumn(
        name, F.when(F.col("__prev").isNull() | ~F.col("__prev")[group].eqNullSafe(F.col(group)), 1).otherwise(0)
    ).drop("__prev")


def merge_runs(
    df: DataFrame, keys: Sequence[str], order: str, group: str, start: Sequence[str], end: Sequence[str]
) -> DataFrame:
    """Merge neighbouring rows of one group: ``start`` columns of the first, ``end`` columns of the last."""
    heads = run_heads(df, keys, [order], group, "__head")
    runs = running(heads, keys, [order], {"run": ("sum", F.col("__head"))})
    return runs.groupBy(*keys, "run", group).agg(
        *[F.min_by(c, order).alias(c) for c in start],
        *[F.max_by(c, order).alias(c) for c in end],
        F.count(F.lit(1)).alias("merged"),
    )


def drawdown(df: DataFrame, keys: Sequence[str], time: str, col: str) -> DataFrame:
    """Per row the fall from the running peak."""
    out = running(df, keys, [time], {"peak": ("max", F.col(col))})
    return out.withColumn("drawdown", maths.share(F.col("peak") - F.col(col), F.col("peak")))


def drawdown_summary(df: DataFrame, keys: Sequence[str], time: str, col: str) -> DataFrame:
    """Fall of the last value from the overall peak, and the largest fall from a running peak."""
    out = drawdown(df, keys, time, col)
    return out.groupBy(*keys).agg(
        maths.share(F.max(col) - F.max_by(col, time), F.max(col)).alias("last_drawdown"),
        F.max("drawdown").alias("max_drawdown"),
    )

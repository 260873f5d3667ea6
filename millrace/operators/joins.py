"""Nearest-point, interval, as-of, lookup and membership joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.functions import maths
from millrace.operators.keyed import join_on, largest_group, salted_join, top_per_group
from millrace.operators.ordered import running
from millrace.session import stage

# Cells are refined until none holds more right-hand points than this.
_CELL_POINTS = 32
_SPHERE = 2.0  # the longest chord of the unit sphere


def _on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    la, lo = F.radians(F.col(lat)), F.radians(F.col(lon))
    return df.withColumns({"__x": F.cos(la) * F.cos(lo), "__y": F.cos(la) * F.sin(lo), "__z": F.sin(la)})


def _cell(h: float) -> dict[str, Column]:
    return {f"__c{a}": F.floor(F.col(f"__{a}") / F.lit(h)) for a in "xyz"}


_POSITION = ["__llat", "__llon"]
_CELL = ["__cx", "__cy", "__cz"]


def _within_bound(pairs: DataFrame, h: float, k: int) -> DataFrame:
    """Pairs of a left position and a cell that can hold one of its ``k`` nearest points.

    The bound is the largest distance to the nearest cells that together hold ``k`` points.
    """
    near = far = F.lit(0.0)
    for a in "xyz":
        low, x = F.col(f"__c{a}") * F.lit(h), F.col(f"__{a}")
        near = near + F.pow(F.greatest(low - x, x - low - h, F.lit(0.0)), 2)
        far = far + F.pow(F.greatest(F.abs(x - low), F.abs(x - low - h)), 2)
    ordered = Window.partitionBy(*_POSITION).orderBy("__far")
    every = Window.partitionBy(*_POSITION)
    marked = pairs.withColumn("__near", near).withColumn("__far", far).withColumn("__sum", F.sum("__n").over(ordered))
    bound = F.min(F.when(F.col("__sum") >= k, F.col("__far"))).over(every)
    kept = marked.withColumn("__bound", bound).where(F.col("__bound").isNull() | (F.col("__near") <= F.col("__bound") * (1 + 1e-9)))
    return kept.drop("__near", "__far", "__sum", "__bound")


def _descend(rest: DataFrame, points: DataFrame, k: int, fine: float) -> DataFrame:
    """Left positions with the points of all cells that can hold one of their ``k`` nearest.

    From the cells of the whole sphere down, a level at a time, each position keeps the
    cells within its bound, so a position far from every point meets few of them.
    """
    count = lambda h: points.withColumns(_cell(h)).groupBy(*_CELL).agg(F.count(F.lit(1)).alias("__n"))
    h = _SPHERE
    top = [F.struct(*[F.lit(v).alias(c) for c, v in r.asDict().items()]) for r in count(h).collect()]  # 27 cells at most
    found = rest.withColumn("__top", F.explode(F.array(*top))).select(*rest.columns, "__top.*")
    found = stage(_within_bound(found, h, k))
    while h > fine:
        h /= 4
        above = {f"__p{c}": F.floor(F.col(c) / 4) for c in _CELL}
        below = count(h).withColumns(above)
        parents = found.drop("__n").withColumnsRenamed({c: f"__p{c}" for c in _CELL})
        found = stage(_within_bound(parents.join(below, list(above)).drop(*above), h, k))
    there = points.withColumns(_cell(fine)).withColumnsRenamed({f"__{a}": f"__r{a}" for a in "xyz"})
    return found.drop("__n").join(there, _CELL)


def _nearest_of(pairs: DataFrame, k: int, radius: float, within: float | None = None) -> DataFrame:
    """The ``k`` nearest of the paired points of each left position, within a chord if given."""
    chord2 = sum((F.pow(F.col(f"__{a}") - F.col(f"__r{a}"), 2) for a in "xyz"), F.lit(0.0))
    if within is not None:
        pairs = pairs.filter(F.sqrt(chord2) <= within)
    away = maths.haversine_km(F.col("__llat"), F.col("__llon"), F.col("__rlat"), F.col("__rlon"), radius)
    pairs = pairs.select(*_POSITION, "__rid", away.alias("distance_km"))
    return top_per_group(pairs, _POSITION, [F.asc("distance_km"), F.asc("__rid")], k).select(*_POSITION, "__rid", "distance_km", "rank")


def nearest(
    left: DataFrame,
    right: DataFrame,
    left_key: tuple[str, str, str],
    right_key: tuple[str, str, str],
    k: int = 1,
    radius: float = maths.RADIUS_KM,
) -> DataFrame:
    """The ``k`` nearest right points of every left point with distance and rank.

    Both key tuples are ``(id, lat, lon)``. Points are put on a cubic grid over
    the unit sphere and joined to the 27 cells around them, which holds every
    point within one cell width. Left points without ``k`` hits inside that
    width go on to a grid four times as wide, and those without ``k`` hits there
    descend from the whole sphere, keeping cells within their best distance so far.
    So no position meets points that can't be among its nearest, other than those of a
    few cells, and the result is exact. Ties go to the smaller id.
    """
    lid, llat, llon = left_key
    rid, rlat, rlon = right_key
    lpos = left.select(llat, llon).filter(F.col(llat).isNotNull() & F.col(llon).isNotNull()).distinct()
    lpos = stage(_on_sphere(lpos, llat, llon).withColumnsRenamed({llat: "__llat", llon: "__llon"}))
    # Only the k smallest ids of one position can be among the k nearest.
    rpos = right.select(F.col(rid).alias("__rid"), F.col(rlat).alias("__rlat"), F.col(rlon).alias("__rlon"))
    rpos = rpos.filter(F.col("__rlat").isNotNull() & F.col("__rlon").isNotNull()).distinct()
    rpos = top_per_group(rpos, ["__rlat", "__rlon"], [F.asc("__rid")], k).drop("rank")
    rpos = stage(_on_sphere(rpos, "__rlat", "__rlon"))

    h = _SPHERE
    while h > 1e-6 and largest_group(rpos.withColumns(_cell(h)).select("__cx", "__cy", "__cz"), ["__cx", "__cy", "__cz"]) > _CELL_POINTS:
        h /= 4
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    fine, rest, found = h, lpos, None
    for width in (fine, 4 * fine):
        cells = rest.withColumns(_cell(width))
        for a in "xyz":
            cells = cells.withColumn("__s", F.explode(around)).withColumn(f"__c{a}", F.col(f"__c{a}") + F.col("__s"))
        there = rpos.withColumns(_cell(width)).withColumnsRenamed({f"__{a}": f"__r{a}" for a in "xyz"})
        best = stage(_nearest_of(cells.drop("__s").join(there, _CELL), k, radius, width))
        hits = best.join(best.filter(F.col("rank") == k).select(*_POSITION), _POSITION, "left_semi")
        found = hits if found is None else found.unionByName(hits)
        rest = stage(rest.join(hits.select(*_POSITION).distinct(), _POSITION, "left_anti"))
        if rest.isEmpty():
            break
    else:
        if not rpos.isEmpty():
            found = found.unionByName(stage(_nearest_of(_descend(rest, rpos, k, fine), k, radius)))
    ids = left.select(lid, F.col(llat).alias("__llat"), F.col(llon).alias("__llon"))
    out = ids.join(found, ["__llat", "__llon"])
    return out.select(lid, F.col("__rid").alias(rid), "distance_km", "rank")


def dimension_join(df: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Left join to a dimension; AQE broadcasts it if its measured size allows."""
    return join_on(df, dim, on, how, null_safe=False)


def _seconds(time: Column, kinds: set[T.DataType]) -> Column:
    """Whole seconds: of the clock for times without a zone, else of the epoch."""
    if kinds == {T.TimestampNTZType()}:
        clock = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
        return F.unix_date(F.to_date(time)).cast("long") * 86400 + clock
    return F.unix_seconds(time)


def interval_join(
    events: DataFrame,
    readings: DataFrame,
    keys: Sequence[str],
    event_time: str,
    reading_time: str,
    lo_hours: int = -4,
    hi_hours: int = -2,
    how: str = "left",
    bucket: str = "cover",
    pick: str | None = None,
    event_id: Sequence[str] = (),
) -> DataFrame:
    """Readings of the same key taken between ``event + lo`` and ``event + hi``.

    The range test becomes an equi join on time buckets. ``cover`` finds every
    reading in the interval: each reading is copied to the buckets of the events
    it can serve, so events keep one bucket and left rows stay single. Buckets are
    hours, or a quarter of a longer interval, so that a reading has six copies at
    most, however long the interval. ``start`` only looks into the hour that holds
    ``event + lo``. ``pick`` set to ``latest`` keeps one reading per ``event_id``;
    with ``cover`` that is the last one up to ``event + hi``, found by a scan in time
    order without copies, if it lies in the interval. Hot (key, bucket) groups are salted.
    """
    at = F.col(event_time)
    lo, hi = at + F.make_interval(hours=F.lit(lo_hours)), at + F.make_interval(hours=F.lit(hi_hours))
    taken = F.col(reading_time)
    if pick is not None and (pick != "latest" or not event_id):
        raise ValueError("pick is 'latest' and needs event_id")
    if pick and bucket == "cover":
        out = _last_before(events, readings, keys, hi, lo, reading_time, how)
        return _latest(out, events, readings, keys, reading_time, event_id)
    kinds = {df.select(c).schema[0].dataType for df, c in ((events, event_time), (readings, reading_time))}
    zoned = (lambda t: t) if kinds == {T.TimestampNTZType()} else lambda t: t.cast("timestamp")
    if bucket == "start":
        left = events.withColumn("__bucket", F.date_trunc("hour", lo))
        right = readings.withColumn("__bucket", F.date_trunc("hour", taken))
    elif bucket == "cover":
        width = max(1, -(-(hi_hours - lo_hours) // 4)) * 3600
        number = lambda t: F.floor(_seconds(t, kinds) / F.lit(width)).cast("long")
        first = number(zoned(taken) - F.make_interval(hours=F.lit(hi_hours)))
        last = number(zoned(taken) - F.make_interval(hours=F.lit(lo_hours)))
        left = events.withColumn("__bucket", number(zoned(at)))
        right = readings.withColumn("__bucket", F.explode(F.sequence(first, last)))
    else:
        raise ValueError("bucket is 'start' or 'cover'")
    # The bounds are worked out once per row, so that a pair costs two comparisons.
    left = left.withColumns({"__lo": lo, "__hi": hi})
    right = right.withColumn("__taken", zoned(taken))
    inside = F.col("__taken").between(F.col("__lo"), F.col("__hi"))
    out = salted_join(left, right, [*keys, "__bucket"], how, inside, None, keys).drop("__bucket", "__lo", "__hi", "__taken")
    return _latest(out, events, readings, keys, reading_time, event_id) if pick else out


def _last_before(
    events: DataFrame, readings: DataFrame, keys: Sequence[str], hi: Column, lo: Column, reading_time: str, how: str
) -> DataFrame:
    """Each event with the last reading of its key up to ``hi``, if that is not before ``lo``."""
    extra = [c for c in readings.columns if c not in keys]
    ends = events.withColumns({"__hi": hi, "__lo": lo})
    found = asof(ends, readings, keys, "__hi", reading_time, extra)
    inside = F.col(f"matched_{reading_time}") >= F.col("__lo")
    picked = [F.when(inside, F.col(f"matched_{c}")).alias(c) for c in extra]
    return found.filter(inside if how == "inner" else F.lit(True)).select(*events.columns, *picked)


def _latest(
    out: DataFrame, events: DataFrame, readings: DataFrame, keys: Sequence[str], reading_time: str, event_id: Sequence[str]
) -> DataFrame:
    """The newest paired reading of each event."""
    extra = [c for c in readings.columns if c not in keys]
    newest = F.max_by(F.struct(*extra), F.struct(reading_time, *[c for c in extra if c != reading_time]))
    rest = [c for c in events.columns if c not in event_id]
    return (
        out.groupBy(*event_id)
        .agg(F.first(F.struct(*rest)).alias("__e"), newest.alias("__r"))
        .select(*event_id, "__e.*", "__r.*")
    )


def full_counts(a: DataFrame, b: DataFrame, keys: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Full join of two count tables, a missing count as 0."""
    return a.join(b, list(keys), "full").na.fill(0, list(counts))


def shared_rows(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``a`` that occur in ``b`` on the given, or all shared, columns."""
    on = list(cols or [c for c in a.columns if c in b.columns])
    keys = b.select(*on).distinct()
    return a.join(keys, on, "left_semi")


def has_overlap(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None) -> bool:
    return not shared_rows(a, b, cols).isEmpty()


def unseen(df: DataFrame, seen: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``seen``; lets an interrupted job go on."""
    return df.join(seen.select(*on).distinct(), list(on), "left_anti")


def flag_members(df: DataFrame, members: DataFrame, key: str, name: str) -> DataFrame:
    """1 where the key is among ``members``, else 0; nothing is collected."""
    known = members.select(key).distinct().withColumn("__in", F.lit(1))
    return join_on(df, known, [key], "left").withColumn(name, F.coalesce("__in", F.lit(0))).drop("__in")


def pair_rows(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Pair two lists by an explicit row key."""
    return a.join(b, list(key))


def asof(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    direction: str = "backward",
) -> DataFrame:
    """Closest right row at or before (``backward``) or at or after (``forward``) each left row.

    Both sides are stacked and scanned once in time order; no pairs are formed,
    and hot keys are split by the scan. Equal times match; of several right rows
    at one time the one with the greatest values is taken. Right rows with a null key
    or time match nothing; left rows with one stay, unmatched.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction is 'backward' or 'forward'")
    right = right.dropna(subset=[*keys, right_time])
    rvals = [right_time, *[v for v in values if v != right_time]]
    lrest = [c for c in left.columns if c not in keys]
    l_type = left.select(F.struct(*lrest).alias("s")).schema["s"].dataType
    r_type = right.select(F.struct(*rvals).alias("s")).schema["s"].dataType
    stacked = left.select(
        *keys, F.col(left_time).alias("__t"), F.lit(1).alias("__side"),
        F.lit(None).cast(r_type).alias("__r"), F.struct(*lrest).alias("__l"),
    ).unionByName(
        right.select(
            *keys, F.col(right_time).alias("__t"), F.lit(0).alias("__side"),
            F.struct(*rvals).alias("__r"), F.lit(None).cast(l_type).alias("__l"),
        )
    )
    time = F.asc("__t") if direction == "backward" else F.desc("__t")
    order = [time, F.asc("__side"), F.asc("__r"), F.asc("__l")]
    found = running(stacked, keys, order, {"__m": ("last", F.col("__r"))})
    return found.filter("__side = 1").select(
        *keys, "__l.*", *[F.when(F.col("__t").isNotNull(), F.col(f"__m.{v}")).alias(f"matched_{v}") for v in rvals]
    )


def day_low(df: DataFrame, fine: DataFrame, key: str, time: str, value: str, name: str = "day_low") -> DataFrame:
    """Lowest fine-grained value of each row's calendar day."""
    lows = fine.groupBy(key, F.to_date(time).alias("__day")).agg(F.min(value).alias(name))
    return join_on(df.withColumn("__day", F.to_date(time)), lows, [key, "__day"], "left").drop("__day")

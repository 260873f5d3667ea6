"""Feature sets built from the window and keyed operators.

A set brings the rows of an origin together once; every finer grouping works on
them where they are. If an origin has too many rows for one task, a set reads its
input several times, once per grouping and each time only the columns it needs.
Over files that is cheap; an input that is costly to compute should then be staged
first, as ``all_profiles`` does between its sets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import conditions, maths, times
from millrace.operators.aggregates import flag_weights
from millrace.operators.joins import flag_members
from millrace.operators.keyed import GATHERED, attach, gather
from millrace.operators.quantiles import discrete_quantiles
from millrace.operators.roles import Roles
from millrace.operators.windows import (
    expanding,
    prior_rate,
    rolling_zscore,
    same_day_so_far,
    seasonal_zscore,
    trailing,
)
from millrace.session import stage

# Fallbacks used where no history exists.
RATE_FALLBACK = 0.15
CAPACITY_FALLBACK = 10.0
# Readings at or beyond these quantiles count as extreme.
EXTREME_QUANTILES = (0.05, 0.95)


def place_profile(
    df: DataFrame, roles: Roles, order: Sequence[str], carrier: str, frame: str = "rows", include_current: bool = True
) -> DataFrame:
    """Eight features of the origin and the route name."""
    return _place_profile(*gather(df, [roles.origin]), df, roles, order, carrier, frame, include_current)


def _place_profile(
    df: DataFrame, near: str | None, base: DataFrame, roles: Roles, order: Sequence[str], carrier: str,
    frame: str = "rows", include_current: bool = True,
) -> DataFrame:
    r = roles
    mine = F.col(r.carrier) == carrier
    rate = F.when(mine, F.col(r.outcome))
    sizes = near or base.select(r.origin, r.dest)
    out = attach(df, [r.origin, r.day], {"daily_operations": F.count(F.lit(1))}, sizes=near)
    kw = {"frame": frame, "day": r.day, "include_current": include_current, "sizes": sizes}
    out = trailing(
        out, [r.origin], order,
        {"volume_30": ("sum", F.col("daily_operations")), "__rate_30": ("avg", rate)}, 29, **kw,
    )
    out = trailing(
        out, [r.origin], order,
        {
            "__rate_365": ("avg", F.col(r.outcome)),
            "__mine_365": ("count", F.when(mine, 1)),
            "__all_365": ("count", F.lit(1)),
        },
        365, **kw,
    )
    out = expanding(
        out, [r.origin, r.dest], order,
        {"route_volume": ("count", F.lit(1)), "__route_rate": ("avg", rate)}, include_current, sizes=sizes,
    )
    out = out.withColumns(
        {
            "volume_30": F.coalesce("volume_30", F.lit(0)),
            "origin_rate": F.coalesce("__rate_365", F.lit(RATE_FALLBACK)),
            "carrier_share": F.coalesce(maths.share(F.col("__mine_365"), F.col("__all_365")), F.lit(0.0)),
            "carrier_rate_30": F.coalesce("__rate_30", F.lit(RATE_FALLBACK)),
            "carrier_route_rate": F.coalesce("__route_rate", F.lit(RATE_FALLBACK)),
            "route": F.concat_ws("-", F.col(r.origin).cast("string"), F.col(r.dest).cast("string")),
        }
    )
    out = out.withColumn("carrier_relative", maths.smoothed_ratio(F.col("carrier_route_rate"), F.col("origin_rate")))
    return out.drop("__rate_30", "__rate_365", "__mine_365", "__all_365", "__route_rate")


def clock_columns(df: DataFrame, roles: Roles) -> DataFrame:
    """Hour, quarter-hour bucket, part of day, weekend and season flags."""
    hhmm, day = F.col(roles.hhmm), F.col(roles.day)
    hour = F.floor(hhmm / F.lit(100)).cast("int")
    return df.withColumns(
        {
            "dep_hour": hour,
            "time_bucket": times.quarter_hour_bucket(hhmm),
            "day_part": conditions.day_part(hour),
            "weekday": times.monday_weekday(day),
            "is_weekend": conditions.is_weekend(times.monday_weekday(day)),
            "holiday_season": conditions.is_holiday_season(F.month(day)),
        }
    )


def time_profile(df: DataFrame, roles: Roles, order: Sequence[str], mode: str = "row") -> DataFrame:
    """Clock columns, prior-period rate, same-day history and congestion."""
    return _time_profile(*gather(df, [roles.origin]), df, roles, order, mode)


def _time_profile(
    df: DataFrame, near: str | None, source: DataFrame, roles: Roles, order: Sequence[str], mode: str = "row"
) -> DataFrame:
    r, base = roles, clock_columns(source, roles)
    out = prior_rate(clock_columns(df, roles), r.origin, r.day, order, r.outcome, "prior_rate", mode, RATE_FALLBACK, near)
    out = same_day_so_far(out, r.origin, r.day, order, r.outcome, sizes=near or base)
    if "daily_operations" not in out.columns:
        out = attach(out, [r.origin, r.day], {"daily_operations": F.count(F.lit(1))}, source=base, sizes=near)
    out = trailing(
        out, [r.origin, "weekday", "dep_hour"], order, {"__usual": ("avg", F.col("daily_operations"))}, 365,
        include_current=False, sizes=near or base.select(r.origin, "weekday", "dep_hour"),
    )
    if near is GATHERED:
        out = attach(out, [r.origin, r.day], {"__n": F.count(F.lit(1))}, sizes=near)
        out = attach(out, [r.origin], {"__place": F.avg("__n")}, sizes=near).drop("__n")
    else:
        # The mean over a place's rows weights each day by its rows, hence the squares.
        per_day = base.groupBy(r.origin, r.day).agg(F.count(F.lit(1)).cast("double").alias("__n"))
        mean = F.sum(F.col("__n") * F.col("__n")) / F.sum("__n")
        out = attach(out, [r.origin], {"__place": mean}, source=per_day)
    out = out.withColumn("usual_operations", F.coalesce("__usual", "__place", F.lit(CAPACITY_FALLBACK)))
    ratio = F.when(F.col("usual_operations") > 0, F.col("daily_operations") / F.col("usual_operations"))
    return out.withColumn("congestion", F.coalesce(ratio, F.lit(1.0))).drop("__usual", "__place")


def extreme_flags(
    df: DataFrame, high: Sequence[str], low: Sequence[str] = (), both: Sequence[str] = ()
) -> DataFrame:
    """Flags of readings beyond the outer quantiles."""
    return df.withColumns(_extreme(df, high, low, both))


def _extreme(
    df: DataFrame, high: Sequence[str], low: Sequence[str] = (), both: Sequence[str] = ()
) -> dict[str, Column]:
    wanted = {f"{c}_{k}": (c, p) for c in [*high, *low, *both] for k, p in enumerate(EXTREME_QUANTILES)}
    found = stage(discrete_quantiles(df, wanted)).select(F.struct(*wanted).alias("q")).scalar()
    limits = {c: [found[f"{c}_0"], found[f"{c}_1"]] for c in [*high, *low, *both]}
    flags = {f"extreme_{c}": F.col(c) >= limits[c][1] for c in high}
    flags |= {f"low_{c}": F.col(c) <= limits[c][0] for c in low}
    flags |= {f"extreme_{c}": (F.col(c) <= limits[c][0]) | (F.col(c) >= limits[c][1]) for c in both}
    return {n: conditions.flag(c) for n, c in flags.items()}


def combined_score(df: DataFrame, flags: Sequence[str], target: str, name: str) -> DataFrame:
    """Sum of flags weighted by how much each lifts the target rate."""
    return df.withColumn(name, _weighted(df, flags, target))


def _weighted(df: DataFrame, flags: Sequence[str], target: str) -> Column:
    weights = flag_weights(df, flags, target, RATE_FALLBACK).select(F.struct(*flags).alias("w")).scalar()
    total = F.lit(0.0)
    for f in flags:
        total = total + F.col(f) * weights[f]
    return total


def reading_profile(
    df: DataFrame,
    roles: Roles,
    order: Sequence[str],
    temperature: str,
    humidity: str,
    wind: str,
    precipitation: str,
    visibility: str,
) -> DataFrame:
    """Extreme flags and score, heat index, rolling z-scores, rapid change and seasonal anomaly."""
    found = _extreme(df, high=[precipitation, wind], low=[visibility], both=[temperature])
    flags = [f"extreme_{precipitation}", f"extreme_{wind}", f"extreme_{temperature}", f"low_{visibility}"]
    score = _weighted(df.withColumns(found), flags, roles.outcome)
    out, near = gather(df, [roles.origin])
    out = out.withColumns(found).withColumn("extreme_score", score)
    out = out.withColumn("heat_index", maths.heat_index(F.col(temperature), F.col(humidity)))
    out = rolling_zscore(out, [roles.origin], order, [temperature, wind], 168, sizes=near or df)
    rapid = (F.abs(f"{temperature}_z") > 3) | (F.abs(f"{wind}_z") > 3)
    out = out.withColumns({"rapid_change": conditions.flag(rapid), "__month": F.month(roles.day)})
    months = df.withColumn("__month", F.month(roles.day))
    out = seasonal_zscore(out, [roles.origin, "__month"], temperature, "seasonal_z", source=months, sizes=near)
    return out.drop("__month")


def carrier_profile(df: DataFrame, roles: Roles, order: Sequence[str], carrier: str) -> DataFrame:
    """Time-of-day, weekday, aircraft, hub, schedule, bucket and importance features.

    Needs the columns of ``clock_columns``.
    """
    return _carrier_profile(*gather(df, [roles.origin]), df, roles, order, carrier)


def _carrier_profile(
    df: DataFrame, near: str | None, base: DataFrame, roles: Roles, order: Sequence[str], carrier: str
) -> DataFrame:
    r = roles
    late, mine = F.col(r.outcome), F.col(r.carrier) == carrier
    overall = base.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.avg(r.distance).alias("d"),
        ).alias("o")
    ).scalar()
    rates = discrete_quantiles(base, {"median": (r.outcome, 0.5), "p30": (r.outcome, 0.3)})
    rates = rates.select(F.struct("median", "p30").alias("q")).scalar()
    median, p30 = rates["median"], rates["p30"]
    route = [r.origin, r.dest]
    out = expanding(
        df, [r.origin, "day_part"], order, {"__part_rate": ("avg", F.when(mine, late))},
        include_current=False, sizes=near or base.select(r.origin, "day_part"),
    )
    out = trailing(
        out, route, order, {"__usual_time": ("avg", F.col(r.duration))}, 365,
        include_current=False, sizes=near or base.select(*route),
    )
    out = attach(out, [r.origin], {"__place_rate": F.avg(late)}, source=base, sizes=near)
    out = attach(out, [*route, "weekday"], {"__dow_late": F.sum(late), "__dow_n": F.count(F.lit(1))}, source=base, sizes=near)
    out = attach(out, [r.tail], {"__tail_rate": F.avg(late)}, source=base)
    out = attach(
        out, route,
        {"__route_rate": F.avg(late), "__route_n": F.count(F.lit(1)), "__route_d": F.avg(r.distance)}, source=base, sizes=near,
    )
    out = attach(out, [r.origin, "time_bucket"], {"__bucket_rate": F.avg(late)}, source=base, sizes=near)
    volumes = base.filter(mine).groupBy(r.origin).agg(F.count(F.lit(1)).alias("__v"))
    cut = discrete_quantiles(volumes, {"c": ("__v", 0.85)}).scalar()
    if near is GATHERED:
        out = attach(out, [r.origin], {"__v": F.count(F.when(mine, 1))}, sizes=near)
        out = out.withColumn("is_hub", F.when((F.col("__v") > 0) & (F.col("__v") >= cut), 1).otherwise(0))
    else:
        out = flag_members(out, volumes.filter(F.col("__v") >= cut), r.origin, "is_hub")
    part_rate = F.coalesce("__part_rate", "__place_rate", median)
    out = out.withColumns(
        {
            "part_rate": part_rate,
            "weekday_rate": (F.col("__dow_late") + F.lit(3) * p30) / (F.col("__dow_n") + F.lit(3)),
            "aircraft_rate": F.coalesce("__tail_rate", "__route_rate", median),
            "schedule_ratio": F.coalesce(maths.share(F.col(r.duration), F.col("__usual_time")), F.lit(1.0)),
            "bucket_rate": F.coalesce(F.col("__bucket_rate"), part_rate),
            "route_importance": F.col("__route_n") / overall["n"] + F.col("__route_d") / overall["d"],
        }
    )
    added = ["part_rate", "weekday_rate", "aircraft_rate", "is_hub", "schedule_ratio", "bucket_rate", "route_importance"]
    return out.select(*df.columns, *added)


def all_profiles(df: DataFrame, roles: Roles, order: Sequence[str], carrier: str) -> DataFrame:
    """Place, time and carrier sets in order."""
    out, near = gather(df, [roles.origin])
    if near is GATHERED:
        out = _place_profile(out, near, df, roles, order, carrier)
        out = _time_profile(out, near, df, roles, order)
        return _carrier_profile(out, near, clock_columns(df, roles), roles, order, carrier)
    return (
        df.transform(place_profile, roles, order, carrier)
        .transform(stage)
        .transform(time_profile, roles, order)
        .transform(stage)
        .transform(carrier_profile, roles, order, carrier)
    )


def simple_place_features(df: DataFrame, roles: Roles) -> DataFrame:
    """Daily rows, rate, volume in thousands and rate band of the origin, plus clock texts."""
    r = roles
    out = attach(df, [r.origin, r.day], {"origin_day_rows": F.count(F.lit(1))})
    out = attach(out, [r.origin], {"origin_rate": F.avg(r.outcome), "origin_rows": F.count(F.lit(1))}, source=df)
    hour = F.floor(F.col(r.hhmm) / F.lit(100)).cast("int")
    quarter = F.floor(F.col(r.hhmm) % 100 / F.lit(15)) * 15
    text = lambda c: c.cast("string")
    return out.withColumns(
        {
            "origin_thousands": F.col("origin_rows") / F.lit(1000),
            "rate_band": conditions.rate_band(F.col("origin_rate")),
            "year_quarter": times.year_quarter(F.col(r.day)),
            "clock_bucket": F.concat(text(hour), F.lit(":"), text(quarter)),
            "day_hour": F.concat(text(times.monday_weekday(F.col(r.day))), F.lit("_"), text(hour)),
            "route": F.concat(text(F.col(r.origin)), F.lit("-"), text(F.col(r.dest))),
        }
    )


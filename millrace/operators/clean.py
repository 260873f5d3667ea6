"""Projection, typed coercion, recoding, filtering, splitting and imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import conditions, maths, times
from millrace.operators.aggregates import modes
from millrace.operators.keyed import GATHERED, attach, gather, join_on
from millrace.operators.ordered import bounded
from millrace.operators.quantiles import attach_quantiles, discrete_quantiles
from millrace.operators.roles import Roles
from millrace.session import stage

# Last-resort readings by word in the column name, tried in this order.
READING_DEFAULTS = (
    ("Temperature", 0.0),
    ("Direction", 0.0),
    ("Speed", 0.0),
    ("Precipitation", 0.0),
    ("Humidity", 50.0),
    ("Pressure", 1013.25),
    ("Visibility", 10.0),
)
CLEAR_SKY = "CLR"
UNKNOWN = "UNKNOWN"


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_listed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Without the listed columns; unknown names are ignored."""
    return df.drop(*cols)


def keep_listed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Only the listed columns that exist, in the listed order."""
    return df.select(*[c for c in cols if c in df.columns])


def coerce_schema(df: DataFrame, spec: dict[str, Sequence[str]]) -> DataFrame:
    """Cast column lists by type name; missing columns are skipped, bad values become null."""
    target = {c: kind for kind, cols in spec.items() for c in cols}
    return df.select(*[F.col(c).try_cast(target[c]).alias(c) if c in target else F.col(c) for c in df.columns])


def as_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Listed columns as text, so that two sources can be stacked."""
    return coerce_schema(df, {"string": cols})


def zero_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null and NaN as 0."""
    return df.withColumns({c: maths.number_or_zero(F.col(c)) for c in cols})


def recode_outcome(df: DataFrame, outcome: str, cancelled: str, fold: bool = False) -> DataFrame:
    """Missing outcome of cancelled rows as 2; ``fold`` then counts 2 as 1."""
    marked = conditions.mark_cancelled(F.col(outcome), F.col(cancelled))
    return df.withColumn(outcome, conditions.fold_mark(marked) if fold else marked)


def vector_columns(df: DataFrame, vector: str, size: int, prefix: str = "f") -> DataFrame:
    """One scalar column per element of an ML vector or array."""
    is_array = isinstance(df.schema[vector].dataType, T.ArrayType)
    arr = F.col(vector) if is_array else vector_to_array(vector)
    return df.select("*", *[arr[i].alias(f"{prefix}{i}") for i in range(size)])


def require(df: DataFrame, cols: Sequence[str], unless: Column | None = None) -> DataFrame:
    """Rows with every listed column set; ``unless`` lets other rows through."""
    if unless is None:
        return df.na.drop(subset=list(cols))
    every = F.lit(True)
    for c in cols:
        every = every & F.col(c).isNotNull()
    return df.filter(every | unless)


def split_by_year(df: DataFrame, date: str, train_to: int, valid_to: int) -> DataFrame:
    """Label rows train, validation or test by the last year of each part."""
    y = F.year(date)
    return df.withColumn(
        "split", F.when(y <= train_to, "train").when(y <= valid_to, "validation").otherwise("test")
    )


def split_by_season(df: DataFrame, date: str) -> DataFrame:
    """Fourth quarter as test, August and September as validation, the rest as train."""
    return df.withColumn(
        "split",
        F.when(F.quarter(date) == 4, "test").when(F.month(date).isin(8, 9), "validation").otherwise("train"),
    )


def fill_calendar(df: DataFrame, date: str, names: dict[str, str]) -> DataFrame:
    """Fill missing calendar columns from a date.

    ``names`` maps a column to year, quarter, month, day or weekday (Sunday 1).
    """
    part = {"year": F.year, "quarter": F.quarter, "month": F.month, "day": F.dayofmonth, "weekday": F.dayofweek}
    return df.withColumns({c: F.coalesce(F.col(c), part[kind](date)) for c, kind in names.items()})


def default_nulls(df: DataFrame, date: str | None = None) -> DataFrame:
    """Remaining nulls by column type, in one projection driven by the schema."""
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.simpleString(), F.col(f.name)
        if "int" in kind and not kind.startswith(("array", "struct", "map")):
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        elif kind == "double" or kind.startswith("decimal"):
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        elif kind == "string":
            c = F.coalesce(c, F.lit(UNKNOWN))
        elif kind in ("timestamp", "timestamp_ntz", "date") and date:
            c = F.coalesce(c, F.col(date).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def reading_default(col: str) -> float:
    return next((v for word, v in READING_DEFAULTS if word.lower() in col.lower()), 0.0)


def impute_readings(
    df: DataFrame, cols: Sequence[str], roles: Roles, order: Sequence[str]
) -> DataFrame:
    """Fill numeric readings from the past outwards.

    Own value, mean of the last 10 rows of the same place and day, mean of the
    last 20 rows of the place, median of place and month, overall median of the
    filled values, and a constant by column name. All columns share each window
    and each aggregate.
    """
    out, near = gather(df, [roles.origin])
    out = stage(_readings_near(out, near, df, cols, roles, order))  # the last median reads every row; do not run the windows twice
    return _readings_left(out, cols)


def _readings_near(
    df: DataFrame, near: str | None, source: DataFrame, cols: Sequence[str], roles: Roles, order: Sequence[str]
) -> DataFrame:
    """Readings filled from their day, place and month."""
    place, day = roles.origin, roles.day
    mean = lambda c, n: lambda w: F.avg(c).over(w.rowsBetween(-n, 0))
    sizes = near or source.select(place, day)
    out = bounded(df, [place, day], order, {f"__d_{c}": mean(c, 10) for c in cols}, 10, sizes=sizes)
    out = bounded(out, [place], order, {f"__p_{c}": mean(c, 20) for c in cols}, 20, sizes=sizes)
    out = out.withColumn("__month", F.month(day))
    wanted = {f"__m_{c}": (c, 0.5) for c in cols}
    if near is GATHERED:
        out = attach_quantiles(out, [place, "__month"], wanted, near)
    else:
        months = source.select(place, F.month(day).alias("__month"), *cols)
        out = join_on(out, discrete_quantiles(months, wanted, [place, "__month"]), [place, "__month"], "left")
    return out.withColumns(
        {c: F.coalesce(c, f"__d_{c}", f"__p_{c}", f"__m_{c}") for c in cols}
    ).select(*df.columns)


def _readings_left(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Readings still missing from the overall median, then a constant."""
    out = attach_quantiles(df, [], {f"__g_{c}": (c, 0.5) for c in cols})
    return out.withColumns(
        {c: F.coalesce(c, f"__g_{c}", F.lit(reading_default(c)).cast(df.schema[c].dataType)) for c in cols}
    ).select(*df.columns)


def impute_category(df: DataFrame, col: str, roles: Roles, order: Sequence[str], default: str = CLEAR_SKY) -> DataFrame:
    """Fill a category from the first value in the day's last 10 rows, the month, the overall mode."""
    out, near = gather(df, [roles.origin])
    return _category_left(stage(_category_near(out, near, df, col, roles, order)), col, default)


def _category_near(
    df: DataFrame, near: str | None, source: DataFrame, col: str, roles: Roles, order: Sequence[str]
) -> DataFrame:
    """A category filled from its day and month."""
    place, day = roles.origin, roles.day
    first = lambda w: F.first(col, ignorenulls=True).over(w.rowsBetween(-10, 0))
    out = bounded(df, [place, day], order, {"__d": first}, 10, sizes=near or source.select(place, day))
    out = out.withColumn("__month", F.month(day))
    in_order = F.when(F.col(col).isNotNull(), F.struct(*order))
    months = source.withColumn("__month", F.month(day))
    out = attach(out, [place, "__month"], {"__m": F.min_by(col, in_order)}, source=months, sizes=near)
    return out.withColumn(col, F.coalesce(col, "__d", "__m")).select(*df.columns)


def _category_left(df: DataFrame, col: str, default: str) -> DataFrame:
    """A category still missing from the overall mode, then a constant."""
    overall = modes(df, [], col).select(f"{col}_mode").scalar()
    return df.withColumn(col, F.coalesce(F.col(col), overall, F.lit(default)))


def impute_centred(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str], reach: int = 5) -> DataFrame:
    """Fill from the mean of the rows around, ``reach`` on each side."""
    around = lambda c: lambda w: F.avg(c).over(w.rowsBetween(-reach, reach))
    out = bounded(df, keys, order, {f"__a_{c}": around(c) for c in cols}, reach, reach, sizes=df.select(*keys))
    return out.withColumns({c: F.coalesce(c, f"__a_{c}") for c in cols}).select(*df.columns)


def fill_from_group(df: DataFrame, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Fill nulls from a group aggregate of the same column."""
    out = attach(df, keys, {f"__g_{c}": a for c, a in values.items()})
    return out.withColumns({c: F.coalesce(c, f"__g_{c}") for c in values}).select(*df.columns)


def fill_from_group_median(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Fill nulls from the exact median of the group."""
    out = attach_quantiles(df, keys, {f"__g_{c}": (c, 0.5) for c in cols})
    return out.withColumns({c: F.coalesce(c, f"__g_{c}") for c in cols}).select(*df.columns)


def fill_elapsed(df: DataFrame, elapsed: str, start: str, end: str) -> DataFrame:
    """Missing elapsed minutes from two HHMM times."""
    return df.withColumn(elapsed, F.coalesce(F.col(elapsed), times.elapsed_minutes(F.col(start), F.col(end))))


def fill_from_station(df: DataFrame, cols: Sequence[str], station: str, order: Sequence[str], default: str = UNKNOWN) -> DataFrame:
    """Missing texts from the first value of the station, then a constant."""
    first = {f"__s_{c}": F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))) for c in cols}
    out = attach(df, [station], first)
    return out.withColumns({c: F.coalesce(c, f"__s_{c}", F.lit(default)) for c in cols}).select(*df.columns)


def _fill_or_add(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Derived columns; those that the rows have already keep their values and are filled."""
    return df.withColumns({c: F.coalesce(F.col(c), v) if c in df.columns else v for c, v in values.items()})


def clean_pass(
    df: DataFrame,
    roles: Roles,
    order: Sequence[str],
    critical: Sequence[str],
    readings: Sequence[str],
    sky: str,
    calendar: dict[str, str] | None = None,
    text: Sequence[str] = (),
    arrival: str | None = None,
    elapsed: str | None = None,
    station: str | None = None,
    equipment: Sequence[str] = (),
) -> DataFrame:
    """Full cleaning: outcome, critical columns, elapsed time, calendar, readings, blocks, times, texts, leftovers.

    Rows without an outcome after recoding go, as do those without a ``critical`` column or the HHMM
    ``arrival``. ``elapsed`` minutes are filled from departure and arrival; ``equipment`` texts
    from the first value of their ``station``. Blocks and times that the rows have are filled, others added.
    """
    if elapsed and not arrival:
        raise ValueError("elapsed time needs the arrival")
    if equipment and not station:
        raise ValueError("equipment texts need their station")
    out = recode_outcome(df, roles.outcome, roles.cancelled)
    out = require(out, [*critical, roles.outcome, *([arrival] if arrival else [])])
    if elapsed:
        out = fill_elapsed(out, elapsed, roles.hhmm, arrival)
    out = fill_calendar(out, roles.day, calendar or {})
    rows, near = gather(out, [roles.origin])
    if near is GATHERED and not {*order, roles.day} & set(readings):
        # nothing the category looks at is a reading: both are filled in one pass and staged once
        rows = _readings_near(rows, near, out, readings, roles, order)
        out = stage(_category_near(rows, near, out, sky, roles, order))
        out = _category_left(_readings_left(out, readings), sky, CLEAR_SKY)
    else:
        out = impute_readings(out, readings, roles, order)
        out = impute_category(out, sky, roles, order)
    departs = times.at_clock(F.col(roles.day), F.col(roles.hhmm))
    blocks = {"dep_block": times.block_label(F.col(roles.hhmm))}
    if arrival:
        blocks["arr_block"] = times.block_label(F.col(arrival))
    clocks = {"departs_at": departs, "four_hours_before": times.shift_hours(departs, -4), "two_hours_before": times.shift_hours(departs, -2)}
    out = _fill_or_add(out, blocks | clocks)
    out = out.withColumns({c: F.coalesce(c, F.lit(UNKNOWN)) for c in text})
    if equipment:
        out = fill_from_station(out, equipment, station, order)
    return default_nulls(out, roles.day)


def simple_clean_pass(
    df: DataFrame,
    roles: Roles,
    order: Sequence[str],
    critical: Sequence[str],
    rolling: Sequence[str],
    by_month: Sequence[str],
    sky: str,
    distance: str,
    places: Sequence[str] = (),
) -> DataFrame:
    """Earlier cleaning: critical columns unless cancelled, centred means, medians, modes, outliers."""
    out = recode_outcome(df, roles.outcome, roles.cancelled)
    out = require(out, critical, unless=F.col(roles.cancelled) == 1)
    out = impute_centred(out, rolling, [roles.origin], order)
    out = out.withColumn("__month", F.month(roles.day))
    keys = [roles.origin, "__month"]
    out = fill_from_group_median(out, keys, by_month)
    sky_modes = modes(out, keys, sky)
    out = join_on(out, sky_modes, keys, "left").withColumn(sky, F.coalesce(sky, f"{sky}_mode"))
    out = out.drop(f"{sky}_mode", "__month")
    out = stage(out.withColumn(distance, conditions.negative_to_null(F.col(distance))))
    numeric = [distance, *rolling, *by_month]
    out = attach_quantiles(out, [], {f"__g_{c}": (c, 0.5) for c in numeric})
    out = out.withColumns({c: F.coalesce(c, f"__g_{c}") for c in numeric}).drop(*[f"__g_{c}" for c in numeric])
    overall = modes(out, [], sky).select(f"{sky}_mode").scalar()
    out = out.withColumn(sky, F.coalesce(F.col(sky), overall))
    return out.withColumns({c: F.coalesce(c, F.lit(UNKNOWN)) for c in places})

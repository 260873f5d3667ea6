"""Classifier and stream queries."""

import uuid

from pyspark.sql import functions as F

from millrace.functions import times
from millrace.operators import clean, ml, series
from millrace.operators.aggregates import class_weights
from millrace.plans.joining import _EVENT_SQL
from millrace.plans.registry import query
from millrace.plans.tables import bars, legs, table
from millrace.plans.trading import _CLASSIC, _SIGNALS
from millrace.session import stage, stage_dir
from millrace.streaming import bars as live

_ENCODED, _INDEXED, _NUMERIC = ["carrier", "sky"], ["dest"], ["wind", "temp", "distance"]
# The best trees and net of the survey.
_TREES, _DEPTH, _RATE = 115, 9, 0.2712
_LAYERS, _ITERATIONS = [448], 100


def _rows(spark, sf):
    df = legs(spark, sf).filter(F.col("late").isNotNull())
    df = df.withColumns({"sky": F.coalesce("sky", F.lit("UNKNOWN")), "dest": F.col("dest").cast("string"), "late": F.col("late").cast("double")})
    return class_weights(df, "late").select("day", "hhmm", "late", "weight", *_ENCODED, *_INDEXED, *_NUMERIC)


def _pipeline(numeric=None):
    return ml.feature_pipeline(_ENCODED, _INDEXED, numeric or _NUMERIC)


def _ready(spark, sf):
    """Encoded rows with their split label, staged because every fit reads them many times."""
    df = stage(ml.spread(clean.split_by_year(_rows(spark, sf), "day", 1999, 2000)))
    model = ml.fit_checked(_pipeline(), df.filter("split = 'train'"))
    return stage(model.transform(df).select("day", "hhmm", "split", "late", "weight", "features")), model


def _sets(df):
    return {s: df.filter(F.col("split") == s) for s in ("train", "validation", "test")}


@query("encoded_widths", "SELECT 'carrier' AS \"column\", count(DISTINCT l_linestatus) + 1 AS width FROM lineitem UNION ALL SELECT 'sky', count(DISTINCT l_returnflag) + 2 FROM lineitem")
def encoded_widths(spark, sf):
    widths = ml.encoded_widths(ml.fit_checked(_pipeline(), _rows(spark, sf)))
    return spark.createDataFrame(widths, "`column` string, width bigint")


@query("lr_metrics")
def lr_metrics(spark, sf):
    df, _ = _ready(spark, sf)
    return ml.split_scores(ml.logistic("late", "weight").fit(df.filter("split = 'train'")), _sets(df), "late")


@query("lr_coefficients")
def lr_coefficients(spark, sf):
    df, _ = _ready(spark, sf)
    return ml.coefficient_table(spark, ml.logistic("late", "weight", 0.001, 1.0).fit(df.filter("split = 'train'")))


@query("lr_loss_history")
def lr_loss_history(spark, sf):
    df, _ = _ready(spark, sf)
    return ml.loss_table(spark, ml.logistic("late", "weight", 0.001, 0.5).fit(df.filter("split = 'train'")))


@query("rolling_cv")
def rolling_cv(spark, sf):
    df, _ = _ready(spark, sf)
    return ml.rolling_validation(df, ["day", "hhmm"], "late", ml.regularisation_grid("late", "weight", 1.0))


@query("best_tree_parameters")
def best_tree_parameters(spark, sf):
    df, _ = _ready(spark, sf)
    build = lambda depth, rate: ml.boosted_trees("late", "weight", trees=_TREES, depth=depth, rate=rate)
    grid = ml.parameter_grid(build, {"depth": [5, _DEPTH], "rate": [0.2, _RATE]})
    return ml.best_candidate(ml.rolling_validation(df, ["day", "hhmm"], "late", grid))


@query("tree_importance")
def tree_importance(spark, sf):
    df, _ = _ready(spark, sf)
    return ml.importance_table(spark, ml.boosted_trees("late", "weight", trees=_TREES, depth=_DEPTH, rate=_RATE).fit(df.filter("split = 'train'")))


@query("perceptron_metrics")
def perceptron_metrics(spark, sf):
    df, _ = _ready(spark, sf)
    inputs = df.select("features").first()["features"].size
    model = ml.feed_forward("late", inputs, _LAYERS, iterations=_ITERATIONS).fit(df.filter("split = 'train'"))
    return ml.split_scores(model, _sets(df), "late")


@query("ablation_scores")
def ablation_scores(spark, sf):
    sets = _sets(stage(clean.split_by_year(_rows(spark, sf), "day", 1999, 2000)))
    runs = {"full": (_pipeline(), "weight"), "no weights": (_pipeline(), None), "distance only": (_pipeline(["distance"]), "weight")}
    return ml.ablation(sets, "train", "late", runs)


@query("flattened_vectors")
def flattened_vectors(spark, sf):
    df, _ = _ready(spark, sf)
    size = df.select("features").first()["features"].size
    return clean.vector_columns(df.select("late", "features"), "features", size).drop("features")


@query("flattened_embeddings", "SELECT vec_id, label, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(64)) + " FROM embeddings")
def flattened_embeddings(spark, sf):
    df = clean.vector_columns(table(spark, sf, "embeddings"), "embedding", 64).drop("embedding")
    return df.withColumns({f"f{i}": F.col(f"f{i}").cast("double") for i in range(64)})


# --- streams ------------------------------------------------------------------


_LATE = "45 days"  # the events span a month, and files may come in any order


def _event_stream(spark, sf):
    return live.stream_table(spark, sf, table(spark, sf, "events").schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_without_repeats", "SELECT event_id, user_id % 25 AS symbol, value FROM events")
def stream_without_repeats(spark, sf):
    # Each row arrives three times, as it would from overlapping batches.
    stream = _event_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    out = live.without_repeats(stream.withColumn("symbol", F.col("user_id") % 25), ["symbol", "event_id"], "ts", _LATE)
    return live.drain(out.select("event_id", "symbol", "value"))


@query(
    "stream_interval_join",
    f"""WITH {_EVENT_SQL} SELECT e.event_id, e.place, w.reading_id, w.value FROM e JOIN w ON e.place = w.place
    AND w.taken BETWEEN e.due - INTERVAL 24 HOUR AND e.due - INTERVAL 2 HOUR""",
)
def stream_interval_join(spark, sf):
    e = _event_stream(spark, sf).filter("event_type = 'purchase'").select(
        "event_id", F.col("user_id").alias("place"), times.shift_hours(F.col("ts"), 8).alias("due")
    )
    w = _event_stream(spark, sf).filter("event_type <> 'purchase'").select(
        F.col("event_id").alias("reading_id"), F.col("user_id").alias("place"), F.col("ts").alias("taken"), "value"
    )
    out = live.timed_join(e, w, "place", "due", "taken", _LATE, lo_hours=-24)
    return live.drain(out.select("event_id", "place", "reading_id", "value"))


@query(
    "stream_trailing_stops",
    f"""WITH {_CLASSIC}, {_SIGNALS},
    j AS (SELECT s.symbol, s.ts AS t0, s.close AS p0, b.ts, b.close,
      0.94 * greatest(s.close, coalesce(max(b.close) OVER (PARTITION BY s.symbol, s.ts ORDER BY b.ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s.close)) AS stop
      FROM s JOIN bars b ON b.symbol = s.symbol AND b.ts > s.ts)
    SELECT symbol, CAST(epoch(t0) AS BIGINT) AS entry_time, CAST(epoch(min(ts)) AS BIGINT) AS exit_time,
    round((arg_min(close, ts) - p0) / p0, 6) AS ret FROM j WHERE close < stop GROUP BY symbol, t0, p0""",
)
def stream_trailing_stops(spark, sf):
    indicators = series.macd(bars(spark, sf), "symbol", "ts", weighted=False)
    signals = series.minimum_signals(indicators, "symbol", "ts").select("symbol", "ts", F.lit(1).alias("is_entry"))
    rows = indicators.join(signals, ["symbol", "ts"], "left").select("symbol", "ts", "close", F.coalesce("is_entry", F.lit(0)).alias("is_entry"))
    folder = f"{stage_dir(spark)}/bars-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    live.clock_row(rows, "ts", _LATE).write.mode("append").parquet(folder)
    stream = live.stream_table(spark, folder, rows.schema, "*.parquet")
    out = live.drain(live.live_stops(stream, "symbol", "ts", _LATE, half_sell=False))
    return out.select("symbol", F.unix_timestamp("entry_time").alias("entry_time"), F.unix_timestamp("exit_time").alias("exit_time"), F.round("ret", 6).alias("ret"))

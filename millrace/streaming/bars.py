"""Streaming forms of the batch ingest, the trailing stop and the interval join.

Every form takes ``delay``, the most event time by which a row may come after later
ones. Rows that are later still are dropped, as a watermark has it; up to it
results do not depend on how rows are dealt over files and triggers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.operators.trading import open_trades, sell_along, trade_return
from millrace.session import stage_dir


def stream_table(spark: SparkSession, folder: str, schema: T.StructType, files: str, per_trigger: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream, a bounded number per trigger."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", files)
        .option("maxFilesPerTrigger", per_trigger)
        .parquet(folder)
    )


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over everything available now and return what it wrote."""
    spark = stream.sparkSession
    base = f"{stage_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    run = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/out")
    )
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def without_repeats(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Late, overlapping batches without repeated rows.

    A repeat is dropped when it comes at most ``delay`` of event time after the
    first copy, which bounds the state.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def timed_join(
    events: DataFrame,
    readings: DataFrame,
    key: str,
    event_time: str,
    reading_time: str,
    delay: str,
    lo_hours: int = -4,
    hi_hours: int = -2,
) -> DataFrame:
    """Readings between ``event + lo`` and ``event + hi`` as both streams arrive.

    The time bound and the watermarks let Spark drop state that can no longer match.
    """
    e = events.withWatermark(event_time, delay)
    r = readings.withWatermark(reading_time, delay).withColumnRenamed(key, "__r_key")
    bound = F.expr(
        f"{reading_time} BETWEEN {event_time} + INTERVAL '{lo_hours}' HOUR AND {event_time} + INTERVAL '{hi_hours}' HOUR"
    )
    return e.join(r, (F.col(key) == F.col("__r_key")) & bound, "inner").drop("__r_key")


def live_stops(stream: DataFrame, symbol: str, time: str, delay: str, half_sell: bool = True) -> DataFrame:
    """Exits of trailing-stop trades as bars arrive.

    Rows hold symbol, time, close and ``is_entry``. Bars wait in the state until the
    watermark has passed them and are then worked on in time order, so files may come in any
    order within ``delay``. The state is the waiting bars and open trades; a symbol with
    neither has none. Bars newer than the watermark stay waiting: a row without a symbol and
    with a later time moves it on (see ``clock_row``).
    """
    rows = stream.withWatermark(time, delay).select(
        symbol, time, F.unix_micros(F.col(time).cast("timestamp")).alias("__time"), F.col("close").cast("double").alias("close"), "is_entry"
    )
    out = T.StructType(
        [
            T.StructField("__key", rows.schema[symbol].dataType),
            T.StructField("__in", T.LongType()),
            T.StructField("entry_price", T.DoubleType()),
            T.StructField("__out", T.LongType()),
            T.StructField("exit_price", T.DoubleType()),
            T.StructField("ret", T.DoubleType()),
        ]
    )
    names = [f.name for f in out.fields]
    columns = ["__time", "close", "is_entry"]
    kept = ["at", "entry", "high", "tightened", "step", "booked"]

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if pd.isna(key[0]):  # a clock row
            return
        saved = json.loads(state.get[0]) if state.exists else {"live": {c: [] for c in kept}, "waiting": []}
        fresh = [] if state.hasTimedOut else [r for b in batches for r in b[columns].values.tolist() if not pd.isna(r[1])]
        waiting = sorted([*saved["waiting"], *fresh])
        passed = state.getCurrentWatermarkMs() * 1000
        due = [r for r in waiting if r[0] <= passed]
        waiting = waiting[len(due) :]
        trades = {c: np.array(v, dtype=np.int64 if c in ("at", "tightened") else float) for c, v in saved["live"].items()}
        if due:
            times, closes = np.array([r[0] for r in due], dtype=np.int64), np.array([r[1] for r in due], dtype=float)
            entered = np.flatnonzero([r[2] == 1 for r in due])
            fresh_trades = open_trades(closes[entered], entered + 1) | {"at": times[entered]}
            known = trades | {"__child": np.zeros(len(trades["at"]), np.int64), "price": np.full(len(trades["at"]), np.nan)}
            trades = {c: np.concatenate([known[c], fresh_trades[c]]) for c in fresh_trades}
            sold = sell_along(trades, closes, half_sell)
            done = sold >= 0
            now, halved = trade_return(trades["entry"], trades["price"], trades["booked"])
            result = {"__in": trades["at"], "entry_price": trades["entry"], "__out": times[sold], "exit_price": trades["price"], "ret": np.where(np.isnan(halved), now, halved)}
            yield pd.DataFrame({"__key": key[0], **{c: v[done] for c, v in result.items()}})[names]
            trades = {c: trades[c][~done] for c in kept}
        live = {c: v.tolist() for c, v in trades.items()}
        if waiting or live["at"]:
            state.update((json.dumps({"live": live, "waiting": waiting}),))
            if waiting:
                state.setTimeoutTimestamp(int(max(waiting[0][0] // 1000, passed // 1000 + 1)))
        elif state.exists:
            state.remove()

    closed = rows.groupBy(symbol).applyInPandasWithState(
        advance, out, T.StructType([T.StructField("kept", T.StringType())]), "append", GroupStateTimeout.EventTimeTimeout
    )
    return closed.select(
        F.col("__key").alias(symbol), F.timestamp_micros("__in").alias("entry_time"), "entry_price",
        F.timestamp_micros("__out").alias("exit_time"), "exit_price", "ret",
    )


def clock_row(bars: DataFrame, time: str, delay: str) -> DataFrame:
    """One row without a symbol that, once it has arrived, moves the watermark past every bar."""
    later = (F.max(time) + F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 HOUR")).alias(time)
    last = bars.agg(later)
    kinds = {f.name: f.dataType for f in bars.schema.fields}
    return last.select(*[F.col(time) if c == time else F.lit(None).cast(kinds[c]).alias(c) for c in bars.columns])

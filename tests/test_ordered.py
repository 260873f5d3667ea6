"""Split and plain paths of the ordered operators give the same rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import keyed, ordered, windows
from millrace.plans.tables import table

ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def events(spark):
    """A null key holds a third of the rows, three more keys the rest."""
    ev = table(spark, "/root/testdata/sf0.001", "events")
    key = F.when(F.col("event_id") % 3 != 0, F.col("user_id") % 3)
    return ev.select("event_id", "ts", "value", key.alias("k")).withColumn(
        "v", F.when(F.col("value") > 60, F.col("value"))
    ).persist()


def same(a, b, key="event_id"):
    a, b = a.toPandas(), b.toPandas()
    a = a.sort_values(key).reset_index(drop=True)
    b = b[a.columns].sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False)
    assert len(a)


def test_bounded(events):
    cols = {
        "prev": lambda w: F.lag("value").over(w),
        "mean": lambda w: F.avg("value").over(w.rowsBetween(-29, 2)),
        "ahead": lambda w: F.lead("event_id", 2).over(w),
    }
    same(ordered.bounded(events, ["k"], ORDER, cols, 29, 2), ordered.bounded(events, ["k"], ORDER, cols, 29, 2, limit=50))


@pytest.mark.parametrize("include", [True, False])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running(events, include, keys):
    cols = {k: (k, F.col("v")) for k in ("sum", "count", "min", "max", "last", "first")}
    plain = ordered.running(events, keys, ORDER, cols, include)
    same(plain, ordered.running(events, keys, ORDER, cols, include, limit=50))


def test_following_is_running_backwards(events):
    out = ordered.following(events, ["k"], ORDER, {"later": ("min", F.col("value"))}, include_current=False)
    pdf = events.toPandas()
    got = out.toPandas().set_index("event_id")["later"]
    for _, g in pdf.fillna({"k": -1}).groupby("k"):
        g = g.sort_values(ORDER)
        want = g["value"][::-1].cummin()[::-1].shift(-1)
        pd.testing.assert_series_equal(got.loc[g["event_id"]].reset_index(drop=True), want.reset_index(drop=True), check_names=False)


def test_number_rows(events):
    same(ordered.number_rows(events, ["k"], ORDER), ordered.number_rows(events, ["k"], ORDER, limit=50))


def test_running_keeps_callers_helper_columns(events):
    counts = events.groupBy("value").agg(F.count(F.lit(1)).alias("__n"))
    plain = ordered.running(counts, [], ["value"], {"upto": ("sum", F.col("__n"))})
    same(plain, ordered.running(counts, [], ["value"], {"upto": ("sum", F.col("__n"))}, limit=20), "value")


def test_ewm(events):
    cols = {"short": ("value", 5), "long": ("value", 34)}
    same(ordered.ewm(events, ["k"], ORDER, cols), ordered.ewm(events, ["k"], ORDER, cols, limit=50))


def test_ewm_known_values(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 3.0)], "k string, t int, x double")
    got = [r.e for r in ordered.ewm(df, ["k"], ["t"], {"e": ("x", 3)}).orderBy("t").collect()]
    assert got == [1.0, 1.5, 2.25]


def test_fold(events):
    schema = T.StructType([events.schema["event_id"], T.StructField("total", T.DoubleType()), T.StructField("end", T.BooleanType())])

    def step(key, state, rows):
        out = rows.assign(total=rows["value"].cumsum() + (state["total"] if state else 0.0), end=rows["__last"])
        return out, {"total": float(out["total"].iloc[-1])}

    same(ordered.fold(events, ["k"], ORDER, step, schema), ordered.fold(events, ["k"], ORDER, step, schema, limit=90))


@pytest.mark.parametrize("kind", ["sum", "avg", "count"])
@pytest.mark.parametrize("include", [True, False])
def test_whole_number_frames_equal_sliding_frames(events, kind, include):
    n = events.withColumn("n", F.when(F.col("value") > 40, F.col("value").cast("int")))
    whole = windows.trailing(n, ["k"], ORDER, {"x": (kind, F.col("n"))}, 7, include)
    sliding = windows.trailing(n, ["k"], ORDER, {"x": (kind, F.col("n").cast("double"))}, 7, include)
    same(whole.select("event_id", "x"), sliding.select("event_id", "x"))


def test_attach_matches_window(events):
    from pyspark.sql import Window

    got = keyed.attach(events, ["k"], {"m": F.max("value")})
    same(got, events.withColumn("m", F.max("value").over(Window.partitionBy("k"))))


def test_salted_join_equals_plain_join(spark):
    left = spark.range(600).select("id", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 5).alias("k"))
    right = spark.range(9).select((F.col("id") % 4).alias("k"), F.col("id").alias("r"))
    for how in ("inner", "left"):
        plain = keyed.salted_join(left, right, ["k"], how)
        salted = keyed.salted_join(left, right, ["k"], how, limit=50)
        rows = lambda d: sorted(map(tuple, d.select("id", "k", "r").collect()), key=repr)
        assert rows(plain) == rows(salted)


def test_deduplicate_keeps_first(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 9, "z")], "k int, o int, v string")
    assert sorted(map(tuple, keyed.deduplicate(df, ["k"], ["o"]).collect())) == [(1, 2, "b"), (2, 9, "z")]


def test_ewm_passes_over_missing_values_on_both_paths(spark):
    import random

    from millrace.operators.ordered import ewm

    rng = random.Random(1)
    rows = []
    for s in range(4):
        for t in range(50):
            missing = t < 3 * s or rng.random() < 0.15
            rows.append((f"s{s}", None if t == 0 else t, None if missing else float("nan") if rng.random() < 0.05 else rng.random()))
    rows += [("none", t, None) for t in range(20)]
    df = spark.createDataFrame(rows, "k string, t int, x double")
    whole, split = ({(r["k"], r["t"]): r["e"] for r in ewm(df, ["k"], ["t"], {"e": ("x", 5)}, limit=n).collect()} for n in (10**6, 7))
    assert whole.keys() == split.keys()
    for key, v in whole.items():
        assert (v is None) == (split[key] is None) and (v is None or abs(v - split[key]) < 1e-9)
    assert whole["none", 19] is None


def test_fold_puts_null_order_first_on_both_paths(spark):
    import pandas as pd
    from pyspark.sql import types as T

    from millrace.operators.ordered import fold

    rows = [("a", None if t == 5 else t) for t in range(30)]
    df = spark.createDataFrame(rows, "k string, t int")
    out = T.StructType([T.StructField("t", T.DoubleType()), T.StructField("at", T.LongType())])

    def step(key, state, pdf):
        start = state["n"] if state else 0
        found = pd.DataFrame({"t": pdf["t"].astype(float), "at": range(start, start + len(pdf))})
        return found, {"n": start + len(pdf)}

    whole, split = (sorted((tuple(r) for r in fold(df, ["k"], ["t"], step, out, limit=n).collect()), key=lambda r: r[1]) for n in (10**6, 7))
    assert whole == split and whole[0] == (None, 0)


def test_long_frames_against_plain_frames(spark):
    """Means and deviations over long frames, with missing values, short keys and a large offset."""
    rng = np.random.default_rng(6)
    rows = [("a", i, None if rng.random() < 0.1 else 1e9 + float(rng.normal())) for i in range(500)]
    rows += [("b", i, float(i % 7)) for i in range(45)] + [("c", 0, 5.0), ("d", 0, None), (None, 1, 2.0), (None, 2, 4.0)]
    rows += [("e", i, None if i < 60 else float(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, i int, x double").withColumn("whole", F.col("i") * 3)
    for limit in (None, "40"):
        if limit:
            spark.conf.set("spark.millrace.maxGroupRows", limit)
        for span in (40, 168):
            got = windows.trailing(df, ["k"], ["i"], {"m": ("avg", F.col("x")), "s": ("stddev", F.col("x")), "w": ("stddev", F.col("whole")), "n": ("count", F.col("x"))}, span)
            assert got.columns == [*df.columns, "m", "s", "w", "n"]
            for key, part in pd.DataFrame([tuple(r) for r in got.collect()], columns=got.columns).fillna({"k": "-"}).groupby("k"):
                part = part.sort_values("i")
                at = part["x"].astype(float).rolling(span + 1, min_periods=1)
                shifted = (part["x"].astype(float) - 1e9).rolling(span + 1, min_periods=1) if key == "a" else at
                np.testing.assert_allclose(part["m"].astype(float), at.mean(), rtol=1e-12, equal_nan=True)
                np.testing.assert_allclose(part["s"].astype(float), shifted.std(), rtol=1e-6, atol=1e-9, equal_nan=True)
                np.testing.assert_allclose(part["w"].astype(float), part["whole"].rolling(span + 1, min_periods=1).std(), rtol=1e-9, equal_nan=True)
                assert part["n"].tolist() == at.count().tolist()
        spark.conf.unset("spark.millrace.maxGroupRows")

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import conditions, maths, strings, times
from millrace.operators import clean, text, web


def one(spark, schema, row, *cols):
    return tuple(spark.createDataFrame([row], schema).select(*cols).first())


@pytest.mark.parametrize(
    "hhmm, want", [("5", "00:05"), ("45", "00:45"), ("545", "05:45"), ("1545", "15:45"), ("2400", None), (None, None)]
)
def test_clock_text(spark, hhmm, want):
    assert one(spark, "h string", (hhmm,), times.clock_text(F.col("h"))) == (want,)


def test_clock_time_is_that_of_its_text_without_parsing(spark):
    texts = ["5", "45", "545", "1545", "2359", "2400", "1260", "", "+5", "1 30", "130 ", "-5", "1e2", "12345", None]
    days = [dt.date(2024, 3, 10), dt.date(2024, 2, 29), dt.date(1, 1, 1), None]
    df = spark.createDataFrame([(d, h) for d in days for h in texts], "d date, h string").withColumn("at", times.at_clock(F.col("d"), F.col("h")))
    text = F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit(" "), times.clock_text(F.col("h")), F.lit(":00"))
    want = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    assert df.filter(~F.col("at").eqNullSafe(want)).isEmpty() and df.filter("at is not null").count() == 3 * 7
    assert "gettimestamp" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_elapsed_minutes(spark):
    a, b = F.col("a"), F.col("b")
    assert one(spark, "a int, b int", (650, 810), times.elapsed_minutes(a, b), times.elapsed_minutes(a, b, compat=True)) == (80, 120)
    assert one(spark, "a int, b int", (2350, 10), times.elapsed_minutes(a, b)) == (20,)


def test_labels(spark):
    assert one(spark, "h int", (935,), times.block_label(F.col("h")), times.quarter_hour_bucket(F.col("h"))) == ("0900-1059", "9_2")
    assert one(spark, "a double, b double", (3.0, 9.9), strings.range_label(F.col("a"), F.col("b"), "miles")) == ("3-9 miles",)


def test_bad_dates_are_null(spark):
    got = one(spark, "a string, b string", ("3/7/2022 12:00:00 AM", "x"), times.us_text_to_iso(F.col("a")), times.us_text_to_iso(F.col("b")))
    assert got == ("2022-03-07", None)


def test_utc_and_shifts(spark):
    row = (dt.datetime(2022, 1, 1, 12, 0),)
    t = F.col("t")
    got = one(spark, "t timestamp", row, F.hour(times.to_utc(t, F.lit("America/New_York"))), F.hour(times.shift_hours(t, -4)), F.minute(times.shift_minutes(t, F.lit(2.9))))
    assert got == (17, 8, 2)


def test_sentence_drop_and_joins(spark):
    assert one(spark, "t string", ("A. B! C? D. E f. G.",), strings.drop_sentences(F.col("t"))) == ("E f. G.",)
    row = ("a", None, "c")
    cols = ["x", "y", "z"]
    got = one(spark, "x string, y string, z string", row, strings.join_words(cols), strings.join_words(cols, "skip"))
    assert got == (None, "a c")


def test_generated_text_is_parsed(spark):
    df = spark.createDataFrame([("It rained.",)], "s string").withColumn("g", F.concat(strings.prompt("s"), F.lit("Then\nit stopped.<br>")))
    row = text.parse_generated(df, "g").first()
    assert (row.beginning, row.ending) == ("It rained.", " Thenit stopped.")


def test_links(spark):
    html = '<a href="/a">x</a><!-- <a href="/no"> --><a class=k href=\'/b\'>y</a><a href="/a">z</a><a href="/Special:x">s</a><a href="http://z">t</a><a name="n">u</a>'
    pages = spark.createDataFrame([(1, "https://h.org/p?q=1", html)], "page_id int, url string, html string")
    links = web.extract_links(pages)
    assert [r.href for r in links.orderBy("pos").collect()] == ["/a", "/b", "/a", "/Special:x", "http://z"]
    kept = web.matching_links(web.drop_service_links(links), "^/.+", ["page_id"]).orderBy("pos")
    assert [r.href for r in kept.collect()] == ["/a", "/b"]
    full = {r.href: r.url for r in web.absolute_links(links, pages).collect()}
    assert full["/a"] == "https://h.org/a" and full["http://z"] == "http://z"


def test_heading_paragraphs_with_missing_end_tag(spark):
    html = "<p><strong>Overview</strong> one<p>two</p><script>var a='<p><strong>Imports';</script><p><strong>Exports</strong> and <strong>Imports</strong></p>"
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    got = {(r.heading, r.text) for r in web.heading_paragraphs(pages).collect()}
    assert got == {("Overview", "Overview one"), ("Exports", "Exports and Imports"), ("Imports", "Exports and Imports")}


def test_page_clean_up(spark):
    html = '<head><link href="x.css"/></head><img alt="a" src="b"/>'
    row = web.clean_pages(spark.createDataFrame([(html,)], "html string")).first()
    assert "img" not in row.html and "link" not in row.html and row.html.count("charset") == 2


def test_codes(spark):
    df = spark.createDataFrame([("a HS Code: 12\nb HS Code: 12\n HS Code: 7",)], "t string")
    assert [r.code for r in text.label_codes(df, "t").collect()] == ["12"]


def test_conditions(spark):
    assert one(spark, "h int", (8,), conditions.day_part(F.col("h"))) == ("morning",)
    assert one(spark, "c int, l int", (1, None), conditions.status_label(F.col("c"), F.col("l"))) == ("Cancelled",)
    assert one(spark, "l int, c int", (None, 1), conditions.mark_cancelled(F.col("l"), F.col("c"))) == (2,)
    assert one(spark, "x double", (float("nan"),), maths.number_or_zero(F.col("x"))) == (0.0,)


def test_coercion_skips_missing_columns(spark):
    df = spark.createDataFrame([("9_2", "1.5", "2020-01-02")], "a string, b string, c string")
    out = clean.coerce_schema(df, {"double": ["a", "b", "nope"], "date": ["c"], "decimal(10,4)": []})
    assert tuple(out.first()) == (None, 1.5, dt.date(2020, 1, 2))


def test_default_nulls_by_type(spark):
    df = spark.createDataFrame([(None, None, None, dt.date(2020, 1, 2), None)], "i int, d double, s string, day date, t timestamp")
    row = clean.default_nulls(df, "day").first()
    assert tuple(row) == (0, 0.0, "UNKNOWN", dt.date(2020, 1, 2), dt.datetime(2020, 1, 2))

"""Every query with SQL agrees with DuckDB on whole tables; the others run and give rows."""

import pytest
from oracle_check import compare, duck

from millrace.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", list(ORACLES))
def test_agrees_with_sql(spark, con, sf, name):
    ok, note = compare(spark, con, name, QUERIES[name], ORACLES[name], sf)
    assert ok, note


@pytest.mark.parametrize(
    "name", ["full_cleaning_pass", "early_cleaning_pass", "time_profile", "reading_profile", "all_profiles"]
)
def test_passes_keep_every_row(spark, sf, name):
    from millrace.plans.tables import legs

    got = QUERIES[name](spark, sf)
    n = legs(spark, sf).count()
    assert got.count() == n if name != "early_cleaning_pass" else 0 < got.count() <= n


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["origin", "n", "hits", "pct"] and df.count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())


ORDERED = """trailing_rate trailing_sum_days expanding_count same_day_so_far rolling_zscore global_percent_rank macd classic_macd crosses
turning_points divergence_flags minimum_signals checked_signals zigzag_pivots zigzag_line split_pivots trailing_stops plain_trailing_stops
asof_backward asof_forward exact_quantiles portfolio_stats""".split()


@pytest.mark.parametrize("name", ORDERED)
def test_agrees_with_sql_on_split_keys(small_groups, con, sf, name):
    ok, note = compare(small_groups, con, name, QUERIES[name], ORACLES[name], sf)
    assert ok, note

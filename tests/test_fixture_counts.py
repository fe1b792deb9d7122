"""The documented non-trivial results at sf0.01 (FIXTURES.md, part B)."""

import pytest

from shoplens.plans import registry as R

SF = "/root/testdata/sf0.01"

EXPECTED = {
    "coupon_alert_windows": 17415,
    "coupon_alerts": 152,
    "coupon_alerts_throttled": 65,
    "sale_wide": 1450,
    "sale_wide_unbounded": 60000,
    "sale_search_total": None,  # checked below
    "age_terms_top": 56,
    "dau_dedup": 4006,
}


@pytest.mark.parametrize("name,n", [(k, v) for k, v in EXPECTED.items() if v is not None])
def test_counts(spark, name, n):
    assert R.QUERIES[name](spark, SF).count() == n


def test_search_and_bands(spark):
    assert R.QUERIES["sale_search_total"](spark, SF).first()["total"] == 8
    idx = R.sale_index(spark, SF)
    from pyspark.sql import functions as F
    day = idx.where(F.col("dt") == R.SEARCH_DATE)
    assert day.count() == 63
    users = R.td.user_info(spark, SF)
    from shoplens.operators.sales import age_years
    ages = users.select(age_years(F.col("birthday"), R.AS_OF).alias("a"))
    bands = ages.select(F.when(F.col("a") < 20, 0).when(F.col("a") < 30, 1).otherwise(2).alias("b")) \
        .groupBy("b").count().orderBy("b").collect()
    assert [r["count"] for r in bands] == [180, 263, 1057]
    assert ages.agg(F.min("a"), F.max("a")).first() == (10, 65)


def test_every_hour_has_orders(spark):
    hours = R.order_table(spark, SF).select("create_hour").distinct().count()
    assert hours == 24

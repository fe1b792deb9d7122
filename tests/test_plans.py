"""Plan shape checks for the scale properties the design relies on."""

import re

import pytest

from shoplens.plans import registry as R

SF = "/root/testdata/sf0.01"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(R.QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(R.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_keep_first_is_combined_map_side(spark):
    plan = _formatted(R.QUERIES["dau_dedup"](spark, SF))
    assert "partial_min" in plan          # partial aggregation before the exchange
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1


def test_alert_windows_are_written_out_last(spark):
    plan = _formatted(R.QUERIES["coupon_alerts"](spark, SF))
    tree = plan[:plan.index("\n\n")]
    # from the top: runs that alert are expanded, below that the sweep, the merged accounts and the panes' sums
    steps = re.findall(r"(Generate|Window|HashAggregate) \(", tree)
    assert steps[:2] == ["Generate", "Window"] and steps.count("Window") == 2
    assert "partial_sum" in plan and "count(distinct" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = _formatted(R.QUERIES["dau_hourly"](spark, SF))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    assert schemas and all("props" not in s and "value" not in s for s in schemas)


def test_page_and_terms_are_top_k(spark):
    assert "TakeOrderedAndProject" in _plan(R.search.page(R._hits(spark, SF), 3, 5))
    assert "TakeOrderedAndProject" in _plan(R.QUERIES["age_terms_top"](spark, SF))


def test_search_reads_postings_and_sums(spark):
    """The search plans no scan of the sales, and its two statistics once each."""
    df = R.QUERIES["sale_search_bm25"](spark, SF)
    assert len(set(re.findall(r"Subquery subquery#(\d+)", _plan(df)))) == 2
    assert {f.split("/index/")[1].split("/")[0] for f in df.inputFiles()} == {"postings"}


def test_alerts_read_the_events_once(spark):
    """The branches of the alert read the stored panes."""
    plan = _formatted(R.QUERIES["coupon_alerts"](spark, SF))
    assert "events.parquet" not in plan and "panes" in plan


@pytest.mark.parametrize("name", ["order_amount_for_date", "order_amount_empty_day", "kpi_panel_for_date", "kpi_panel_order_day",
                                  "hourly_compare_amount", "sale_search_total", "sale_gender_stats", "sale_age_stats",
                                  "sale_search_two_tokens"])
def test_one_day_order_queries_push_the_day_to_the_scan(spark, name):
    plan = _formatted(R.QUERIES[name](spark, SF))
    pushed = re.findall(r"PushedFilters: \[([^\n]*)\]", plan)
    assert any("GreaterThanOrEqual(o_orderdate," in p and "LessThan(o_orderdate," in p for p in pushed), pushed
    if "amount" in name:
        assert "customer" not in plan


def test_search_page_reads_the_stored_table(spark):
    """A page's few keys meet the stored table, read for their days; the sales are not joined anew."""
    df = R.QUERIES["sale_search_page"](spark, SF)
    plan = _formatted(df)
    assert plan.count("Scan parquet") == len(re.findall(r"\(\d+\) Scan parquet", plan)) + 1 and "SortMergeJoin" not in plan
    assert "PushedFilters: [In(dt" in plan or "PushedFilters: [IsNotNull(dt" in plan
    assert all("/table/" in f for f in df.inputFiles())


@pytest.mark.parametrize("name", ["dau_for_date", "hourly_compare_dau"])
def test_one_day_reports_push_a_time_range_to_the_scan(spark, name):
    plan = _formatted(R.QUERIES[name](spark, SF))
    pushed = re.findall(r"PushedFilters: \[([^\n]*)\]", plan)
    assert any("GreaterThanOrEqual(ts," in p and "LessThan(ts," in p for p in pushed), pushed


def test_full_pairing_has_no_full_outer_join(spark):
    assert "FullOuter" not in _plan(R.QUERIES["sale_pairs_full"](spark, SF))

"""Postings kept up by batches against a scan; pages of any depth."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from shoplens.operators import search
from shoplens.operators.paging import RankedPages
from shoplens.operators.postings import SearchIndex

ROW = "order_id string, order_detail_id string, dt string, sku_name string"


def test_index_equals_scan_after_corrections_and_replays(spark):
    rng = random.Random(6)
    words = ["red", "Blue", "widget", "手机", "小米", "box", "red red", ""]
    index = SearchIndex(spark, tempfile.mkdtemp(prefix="postings-"), fold_every=2)
    table = {}
    for n in range(5):
        rows = [(str(i), "1", f"2024-01-0{i % 3 + 1}", " ".join(rng.choices(words, k=rng.randrange(5)))) for i in rng.sample(range(40), 18)]
        rows += [("x", "1", "2024-01-01", None)]
        table.update({r[0]: r for r in rows})
        df = spark.createDataFrame(rows, ROW)
        index.update(df, n)
        if n == 3:
            index.update(df, n)     # run again
    whole = spark.createDataFrame(list(table.values()), ROW)
    for keyword in ("red", "red widget", "手机", "nothing", "", None):
        for date in (None, "2024-01-02"):
            want = search.bm25_score(search.search(whole, date, keyword), whole, keyword)
            got = index.search(keyword, date)
            assert {r.order_id: round(r.score, 9) for r in got.collect()} == {r.order_id: round(r.score, 9) for r in want.collect()}, (keyword, date)


def test_a_search_opens_the_parts_of_its_tokens(spark):
    index = SearchIndex(spark, tempfile.mkdtemp(prefix="parts-"), fold_every=1)
    for n in range(3):
        index.update(spark.createDataFrame([(f"{n}-{i}", "1", "2024-01-01", f"word{i} red") for i in range(60)], ROW), n)
    files = index.postings.read({1}).inputFiles()
    assert len(files) < len(index.postings.read().inputFiles()) / 5


@pytest.mark.parametrize("size", [1, 7, 50])
def test_any_page(spark, size):
    rows = spark.range(1000).select((F.col("id") % 13).alias("score"), F.col("id").cast("string").alias("order_id"), F.lit("1").alias("order_detail_id"))
    pages = RankedPages(rows, search.ranked(rows), tempfile.mkdtemp(prefix="pages-"), ranges=9)
    want = [tuple(r) for r in rows.orderBy(*search.ranked(rows)).collect()]
    for number in (1, 2, 1000 // size // 2, -(-1000 // size), 1000 // size + 2):
        page = pages.page(number, size)
        assert [tuple(r) for r in page.collect()] == want[(number - 1) * size:number * size]
        assert len({f.split("_range=")[1].split("/")[0] for f in page.inputFiles()}) <= 2
    with pytest.raises(ValueError):
        pages.page(0, 5)


def test_tokens_are_counted_without_a_shuffle(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a", "2024-01-01", "Red red bolt"), ("1", "b", "2024-01-01", None), ("2", "a", "2024-01-01", "")],
                                 "order_id string, order_detail_id string, dt string, sku_name string")
    found = SearchIndex(spark, str(tmp_path))._tokens(rows)
    assert sorted((r.token, r.order_id, r.order_detail_id, r.length, r.tf) for r in found.collect()) == [("bolt", "1", "a", 3, 1), ("red", "1", "a", 3, 2)]
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()

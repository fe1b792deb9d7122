"""The launcher: a file-topic DAU job and the three reports."""

import json
import tempfile

from pyspark.sql import functions as F

from shoplens.__main__ import main
from shoplens.plans import registry as R
from shoplens.sources import testdata as td

SF = "/root/testdata/sf0.001"


def test_jobs_and_reports(spark, capsys):
    """Every job through the launcher, from raw lines and a change feed to the reports."""
    base = tempfile.mkdtemp(prefix="cli-")
    topics = f"{base}/topics"

    def job(name, *more):
        args = ["job", name, "--source", "files", "--topics", topics, "--out", f"{base}/{name}", "--checkpoint", f"{base}/ckpt-{name}"]
        assert main([*args, "--once", *more], spark=spark) == 0

    def report(*args):
        capsys.readouterr()
        assert main(["report", *args], spark=spark) == 0
        return [json.loads(x) for x in capsys.readouterr().out.splitlines()]

    td.raw_logs(spark, SF).select("value").coalesce(1).write.text(f"{base}/raw")
    td.change_feed(spark, SF).coalesce(1).write.json(f"{base}/feed")
    td.user_info(spark, SF).write.parquet(f"{base}/users")
    job("collector", "--raw", f"{base}/raw")
    job("router", "--changes", f"{base}/feed")
    job("dau")
    job("orders")
    job("alerts", "--window", "6 hours", "--slide", "1 hour", "--accounts", "1")
    job("sales", "--users", f"{base}/users")
    from shoplens.streaming import jobs
    assert jobs.read_alerts(spark, f"{base}/alerts").columns  # stamped now, so all lines share a window
    assert jobs.read_sales(spark, f"{base}/sales").count() == td.order_detail(spark, SF).select("id").distinct().count()

    today = jobs.read_dau(spark, f"{base}/dau").first().log_date
    kpi = report("kpi", "--dau", f"{base}/dau", "--orders", f"{base}/orders", "--date", today)
    devices = spark.read.parquet(f"{SF}/events.parquet").select("user_id").distinct().count()
    assert {r["id"]: r["value"] for r in kpi}["dau"] == str(devices)
    assert len(report("hourly", "--id", "dau", "--dau", f"{base}/dau", "--date", today)) == 24

    amount = R.q_order_amount_hourly(spark, SF).where(F.col("create_date") == R.ORDER_DATE).agg(F.sum("order_amount")).first()[0]
    hours = report("hourly", "--id", "order_amount", "--orders", f"{base}/orders", "--date", R.ORDER_DATE)
    assert sum(float(h["today"]) for h in hours) == float(amount or 0)
    assert main(["compact", "orders", "--out", f"{base}/orders", "--to", f"{base}/order_table"], spark=spark) == 0
    assert report("hourly", "--id", "order_amount", "--orders", f"{base}/order_table", "--date", R.ORDER_DATE) == hours

    R.sale_index(spark, SF).write.partitionBy("dt").parquet(f"{base}/sale_table")
    day = R.sale_index(spark, SF).where("sku_name like '%red%'").first().dt
    (answer,) = report("search", "--sales", f"{base}/sale_table", "--date", day, "--keyword", "red", "--page", "1", "--size", "5")
    assert set(answer) == {"total", "stat", "detail"} and len(answer["stat"]) == 2
    assert answer["total"] == sum(o["value"] for o in answer["stat"][0]["options"]) >= len(answer["detail"]) > 0

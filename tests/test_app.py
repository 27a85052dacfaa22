"""The four jobs one after the other, on folders."""

import json

import pytest

from tests.test_orders import text
from tradewind.app import App
from tradewind.plans import log_split
from tradewind.schemas import record
from tradewind.sources import derived, topics
from tradewind.streaming import jobs

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("suffix, disorder", [("_1018", "2 days"), ("_x", None)])
def test_from_raw_topics_to_both_wide_tables(spark, tmp_path, suffix, disorder):
    app = App(spark, str(tmp_path), None, suffix, disorder)
    log = derived.raw_log(spark, SF)
    message = ("'log' AS topic", "0 AS partition", "bigint(0) AS offset", "value")
    topics.land(log.selectExpr(*message), app.folder("ODS_BASE_LOG" + suffix))
    row = {"id": 1, "user_id": 3, "province_id": 1, "create_time": text()}
    detail = {"id": 10, "order_id": 1, "sku_num": "2", "create_time": text(1)}
    user = {"id": 3, "gender": "F", "birthday": "1990-01-02"}
    changes = [json.dumps({"type": "insert", "table": t, "ts": 1, "data": d})
               for t, d in (("order_info", row), ("order_detail", detail), ("user_info", user))] + ["broken"]
    topics.land(spark.createDataFrame([("db", 0, i, v) for i, v in enumerate(changes)],
                                      record("topic partition:int offset:long value")), app.folder("ODS_BASE_DB" + suffix))
    for job in ("log-split", "change-routing", "dau", "orders"):
        app.run(job, available_now=True)

    dau = jobs.read_dau(spark, app.folder("dau_info"))
    pages = log_split.page_log(log_split.parse(log)).where("last_page_id IS NULL")
    assert dau.count() == pages.selectExpr("date_format(timestamp_millis(ts), 'yyyy-MM-dd') AS dt", "mid").distinct().count()
    assert dau.where("user_id = '3' AND user_gender = 'F'").count() == dau.where("user_id = '3'").count() > 0
    [wide] = jobs.read_orders(spark, app.folder("order_wide"), monthly=True).collect()
    assert (wide["detail_id"], wide["sku_num"], wide["user_gender"], wide["create_date"]) == (10, 2, "F", "2024-05-01")
    facts = spark.read.parquet(app.folder("fact-topics"))
    assert [r["value"] for r in facts.where(f"topic = 'DWD_DEAD_LETTER{suffix}'").collect()] == ["broken"]

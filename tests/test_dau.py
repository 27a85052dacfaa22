import datetime

import pytest
from pyspark.sql import functions as F

from tradewind.functions.time import age_years
from tradewind.plans import dau
from tradewind.schemas import DAU_INFO, PAGE_LOG

MIDNIGHT = 1704153600000  # 2024-01-02 00:00 UTC


def pages(spark, *rows):
    names = PAGE_LOG.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], PAGE_LOG)


def page(mid, ts, **more):
    return {"mid": mid, "ts": ts, "user_id": "1", "province_id": "1", "page_id": "home", **more}


def test_first_of_a_day_and_again_after_midnight(spark):
    got = dau.first_visits(pages(
        spark, page("a", MIDNIGHT - 1), page("a", MIDNIGHT - 500), page("a", MIDNIGHT), page("a", MIDNIGHT + 9),
        page("b", MIDNIGHT - 900, last_page_id="home")))
    assert sorted((r["dt"], r["mid"], r["ts"]) for r in got.collect()) == [
        ("2024-01-01", "a", MIDNIGHT - 500), ("2024-01-02", "a", MIDNIGHT)]


def test_ties_fall_to_the_other_columns(spark):
    tied = [page("a", MIDNIGHT, page_id=p, channel=c) for p, c in (("x", None), ("y", None), ("x", "c"))]
    for order in (tied, tied[::-1]):
        [row] = dau.first_visits(pages(spark, *order)).collect()
        assert (row["page_id"], row["channel"]) == ("x", None)


def test_devices_on_record_are_not_new(spark):
    visits = dau.first_visits(pages(spark, page("a", MIDNIGHT), page("b", MIDNIGHT), page("a", MIDNIGHT - 1)))
    seen = spark.createDataFrame([("2024-01-02", "a"), ("2024-01-02", "zz")], "dt string, mid string")
    got = sorted((r["dt"], r["mid"]) for r in dau.not_yet_seen(visits, seen).collect())
    assert got == [("2024-01-01", "a"), ("2024-01-02", "b")]


def test_missing_dimensions_keep_the_row(spark):
    visits = dau.first_visits(pages(spark, page("a", MIDNIGHT, user_id="404", province_id=None), page("b", MIDNIGHT)))
    users = spark.createDataFrame([(1, "F", datetime.date(1990, 1, 2))], "id long, gender string, birthday date")
    provinces = spark.createDataFrame([(1, "Here", "1", "010", "CN-1", "CN-A")], "id long, name string, "
                                      "region_id string, area_code string, iso_code string, iso_3166_2 string")
    got = dau.enrich(visits, users, provinces, datetime.date(2024, 1, 1))
    assert got.schema.fieldNames() == DAU_INFO.fieldNames()
    rows = {r["mid"]: r for r in got.collect()}
    assert rows["a"]["user_gender"] is None and rows["a"]["province_name"] is None
    assert (rows["b"]["user_age"], rows["b"]["province_3166_2"], rows["b"]["hr"]) == ("33", "CN-A", "00")


@pytest.mark.parametrize("born, on, age", [
    ("2004-02-29", "2025-02-28", 20), ("2004-02-29", "2025-03-01", 21), ("2004-02-29", "2024-02-29", 20),
    ("1990-06-30", "2024-06-30", 34), ("1990-07-01", "2024-06-30", 33), ("not a date", "2024-06-30", None)])
def test_age(spark, born, on, age):
    frame = spark.createDataFrame([(born,)], "born string")
    got = frame.select(age_years(F.col("born").try_cast("date"), F.lit(datetime.date.fromisoformat(on)))).first()[0]
    assert got == age

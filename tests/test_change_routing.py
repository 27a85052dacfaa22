import json

import pytest

from tradewind.plans import change_routing as cr


def _events(spark, *events):
    rows = [(e if isinstance(e, str) else json.dumps(e), i) for i, e in enumerate(events)]
    return cr.parse(spark.createDataFrame(rows, "value string, offset long"))


def _event(kind, table, row, ts=1):
    return {"type": kind, "table": table, "ts": ts, "data": row}


def test_types_map_to_letters_and_others_are_dropped(spark):
    kinds = ["insert", "bootstrap-insert", "update", "delete", "bootstrap-start", "bootstrap-complete", "DELETE"]
    events = _events(spark, "{broken", "", *[_event(k, "order_info", {"id": 1}) for k in kinds])
    assert sorted(r["op"] for r in cr.known(events).collect()) == ["D", "I", "I", "U"]
    assert sorted(r["value"] for r in cr.dead_letters(events).collect()) == ["", "{broken"]


def test_an_event_without_a_row_image_is_a_dead_letter(spark):
    events = _events(spark, {"type": "insert", "table": "order_info"}, {"type": "heartbeat", "table": "order_info"})
    assert cr.known(events).count() == 0 and cr.dead_letters(events).count() == 1


def test_routes_follow_the_lists(spark):
    events = _events(spark, _event("insert", "order_info", {"id": 5, "total_amount": 1.5, "note": None}),
                     _event("update", "user_info", {"id": "8", "gender": "M"}),
                     _event("insert", "cart_info", {"id": 2}))
    [fact] = cr.fact_route(events).collect()
    assert fact["topic"] == "DWD_ORDER_INFO_I_1018" and json.loads(fact["value"])["total_amount"] == 1.5
    [dim] = cr.dim_route(events).collect()
    assert (dim["dim_key"], json.loads(dim["data"])) == ("DIM:USER_INFO:8", {"id": "8", "gender": "M"})


def test_a_table_on_both_lists_goes_both_ways(spark):
    events = _events(spark, _event("insert", "user_info", {"id": 1}))
    control = spark.createDataFrame([("fact", "user_info"), ("dim", "user_info")], "role string, table_name string")
    facts, dims = cr.dynamic_routes(events, control)
    assert [r["topic"] for r in facts.collect()] == ["DWD_USER_INFO_I_1018"] and dims.count() == 1


def test_latest_image_wins_and_a_delete_keeps_or_drops_it(spark):
    events = _events(
        spark, _event("insert", "user_info", {"id": 1, "gender": "M"}, ts=5),
        _event("update", "user_info", {"id": 1, "gender": "F"}, ts=5),
        _event("update", "user_info", {"id": 1, "gender": "X"}, ts=4),
        _event("delete", "user_info", {"id": 2, "gender": "M"}, ts=1))
    dims = cr.dim_route(events)
    latest = {r["id"]: json.loads(r["data"])["gender"] for r in cr.dim_latest(dims).collect()}
    assert latest == {"1": "F", "2": "M"}
    assert [r["id"] for r in cr.dim_latest(dims, drop_deleted=True).collect()] == ["1"]


def test_a_list_too_long_to_read_is_refused(spark, monkeypatch):
    from tradewind.plans import change_routing as cr

    monkeypatch.setattr(cr, "MAX_LISTED", 1)
    control = spark.createDataFrame([("fact", "a"), ("fact", "b")], "role string, table_name string")
    events = spark.createDataFrame([("a",)], "`table` string")
    with pytest.raises(ValueError):
        cr.listed(events, control, "fact")

import json

from tradewind.plans import log_split

COMMON = {"mid": "m1", "uid": "7", "ar": "3", "is_new": 1}


def _rows(df):
    return [r.asDict() for r in df.collect()]


def _topics(df):
    counts = {}
    for row in log_split.split_messages(df, suffix="").collect():
        counts.setdefault(row["topic"], []).append(row["value"])
    return counts


def test_malformed_empty_and_incomplete_lines_are_kept_as_dead_letters(lines):
    bad = ["{not json", "", None, "[1]", '[{"common":{},"ts":1},{"common":{},"ts":2}]', '"text"',
           json.dumps({"ts": 1, "page": {"page_id": "p"}}), json.dumps({"common": COMMON, "page": {}}),
           json.dumps({"common": COMMON, "ts": "soon"}), json.dumps({"common": COMMON, "ts": 1, "page": 5})]
    parsed = log_split.parse(lines(*bad))
    assert log_split.dead_letters(parsed).count() == len(bad)
    assert set(_topics(parsed)) == {"DWD_DEAD_LETTER"}


def test_quoted_and_numeric_values_are_read_alike(lines):
    record = {"common": COMMON, "ts": "1700000000123", "page": {"page_id": 9, "item": True, "during_time": "12"}}
    [page] = _rows(log_split.page_log(log_split.parse(lines(json.dumps(record)))))
    assert (page["ts"], page["page_id"], page["page_item"], page["during_time"]) == (1700000000123, "9", "true", 12)
    assert (page["mid"], page["user_id"], page["province_id"], page["is_new"]) == ("m1", "7", "3", "1")
    assert page["last_page_id"] is None and page["brand"] is None


def test_empty_and_null_arrays_give_no_rows(lines):
    parsed = log_split.parse(lines(
        json.dumps({"common": COMMON, "ts": 1, "page": {"page_id": "p"}, "displays": [], "actions": None}),
        json.dumps({"common": COMMON, "ts": 1, "page": {"page_id": "p"}})))
    assert log_split.display_log(parsed).count() == log_split.action_log(parsed).count() == 0
    assert log_split.page_log(parsed).count() == 2


def test_displays_without_a_page_are_not_split(lines):
    parsed = log_split.parse(lines(json.dumps({"common": COMMON, "ts": 1, "displays": [{"item": "1"}]})))
    assert log_split.display_log(parsed).count() == 0
    assert log_split.split_messages(parsed).count() == 0


def test_page_and_start_in_one_record_give_both(lines):
    record = {"common": COMMON, "ts": 1, "page": {"page_id": "p"}, "start": {"entry": "icon", "loading_time": 5},
              "displays": [{"item": "1", "order": 2, "pos_id": 3}, {"item": "2"}],
              "actions": [{"action_id": "a", "ts": 11}]}
    parsed = log_split.parse(lines(json.dumps(record)))
    topics = _topics(parsed)
    assert {t: len(v) for t, v in topics.items()} == {
        "DWD_PAGE_LOG_TOPIC": 1, "DWD_PAGE_DISPLAY_TOPIC": 2, "DWD_PAGE_ACTION_TOPIC": 1, "DWD_START_LOG_TOPIC": 1}
    assert _rows(log_split.start_log(parsed))[0]["loading_time_ms"] == 5
    first = json.loads(topics["DWD_PAGE_DISPLAY_TOPIC"][0])
    assert (first["display_item"], first["display_order"], first["display_pos_id"]) == ("1", "2", "3")
    assert "brand" not in first and json.loads(topics["DWD_PAGE_ACTION_TOPIC"][0])["action_ts"] == 11


def test_error_goes_out_whole_and_alone(lines):
    value = json.dumps({"ts": 1, "err": {"code": 1}, "start": {"entry": "x"}, "page": {"page_id": "p"}})
    parsed = log_split.parse(lines(value, json.dumps({"common": COMMON, "ts": 1, "err": None, "start": {}})))
    assert [r["value"] for r in log_split.error_log(parsed).collect()] == [value]
    assert log_split.page_log(parsed).count() == 0
    assert log_split.start_log(parsed).count() == 1


def test_one_pass_equals_the_separate_outputs(spark):
    from tradewind.sources import derived

    parsed = log_split.parse(derived.raw_log(spark, "/root/testdata/sf0.001"))
    topics = {t: len(v) for t, v in _topics(parsed).items()}
    assert topics == {
        "DWD_PAGE_LOG_TOPIC": log_split.page_log(parsed).count(),
        "DWD_PAGE_DISPLAY_TOPIC": log_split.display_log(parsed).count(),
        "DWD_PAGE_ACTION_TOPIC": log_split.action_log(parsed).count(),
        "DWD_START_LOG_TOPIC": log_split.start_log(parsed).count(),
        "DWD_ERROR_LOG_TOPIC": log_split.error_log(parsed).count()}

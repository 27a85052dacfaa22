from pyspark.sql import functions as F

from tradewind.functions.text import highlight, matches_any
from tradewind.operators import documents as ops
from tradewind.operators.records import cast_to_mapping, project_by_name
from tradewind.schemas import DAU_INFO, DAU_MAPPING, DOC, ORDER_MAPPING, ORDER_WIDE


def docs(spark, *rows):
    return spark.createDataFrame([(i, n, s, [(a,) for a in actors]) for i, n, s, actors in rows], DOC)


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_put_twice_is_put_once(spark):
    target = docs(spark, ("1", "Old", 1.0, []))
    new = docs(spark, ("1", "New", 2.0, []), ("2", "More", 3.0, []))
    once = ops.bulk_upsert(target, new)
    twice = ops.bulk_upsert(once, new)
    assert {i: r["name"] for i, r in by_id(twice).items()} == {"1": "New", "2": "More"} and twice.count() == 2


def test_highest_version_of_an_id_wins(spark):
    target = docs(spark, ("1", "Old", 1.0, []))
    new = docs(spark, ("1", "B", 1.0, []), ("1", "A", 1.0, [])).withColumn("v", F.when(F.col("name") == "A", 2).otherwise(1))
    assert by_id(ops.bulk_upsert(target, new, "id", ["v"]))["1"]["name"] == "A"


def test_post_appends_under_a_new_id_each_time(spark):
    new = docs(spark, ("x", "Same", 1.0, [])).drop("id")
    twice = ops.append_generated_id(ops.append_generated_id(docs(spark), new), new)
    assert twice.count() == 2 and twice.select("id").distinct().count() == 2


def test_partial_update_delete_and_get(spark):
    target = docs(spark, ("1001", "Fast", 7.0, ["a"]), ("1002", "Magic", 8.0, []))
    patch = spark.createDataFrame([("1001", "Fast 1"), ("9", "none")], "id string, name string")
    updated = by_id(ops.update_by_id(target, patch))
    assert (updated["1001"]["name"], updated["1001"]["imdbScore"], len(updated)) == ("Fast 1", 7.0, 2)
    left = ops.delete_by_id(target, spark.createDataFrame([("1001",), ("1001",)], "id string"))
    assert set(by_id(left)) == {"1002"}
    assert ops.get_by_id(target, "1002").first()["name"] == "Magic"
    assert ops.get_by_id(target, "0").count() == 0


def test_update_by_query(spark):
    target = docs(spark, ("1", "Fast 1", 1.0, []), ("2", None, 1.0, []), ("3", "fast 1", 1.0, []))
    got = by_id(ops.update_by_query(target, F.col("name") == "Fast 1", {"name": F.lit("Fast 2")}))
    assert [got[i]["name"] for i in "123"] == ["Fast 2", None, "fast 1"]


def test_match_is_by_whole_term_in_any_case(spark):
    names = ["Operation Red Sea", "red", "the SEA-wolf", "Redder seas", "", None]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r["name"] for r in frame.where(matches_any(F.col("name"), "red sea")).collect()] == names[:3]
    marked = [r[0] for r in frame.select(highlight(F.col("name"), "red sea")).collect()]
    assert marked == ["Operation <em>Red</em> <em>Sea</em>", "<em>red</em>", "the <em>SEA</em>-wolf", "Redder seas", "", None]


def test_pages_and_totals(spark):
    target = docs(spark, *[(str(i), "n", float(i // 2), []) for i in range(7)])
    sort = [F.desc("imdbScore"), F.asc("id")]
    assert [r["id"] for r in ops.page_of(target, sort, 0, 1).collect()] == ["6"]
    second = ops.page_with_total(target, sort, 2, 2).collect()
    assert [(r["id"], r["total_hits"]) for r in second] == [("5", 7), ("2", 7)]


def test_terms_count_documents(spark):
    target = docs(spark, ("1", "n", 4.0, ["a", "a", "b"]), ("2", "n", 8.0, ["a"]), ("3", "n", 9.0, []))
    got = ops.terms_avg_topk(target, F.col("actorList.name"), "imdbScore", 10).collect()
    assert [tuple(r) for r in got] == [("a", 2, 6.0), ("b", 1, 4.0)]


def test_project_by_name_needs_name_and_type(spark):
    source = spark.createDataFrame([("m", 5, "7")], "mid string, during_time int, extra string")
    got = project_by_name(source, DAU_INFO)
    assert got.schema.fieldNames() == DAU_INFO.fieldNames()
    row = got.first()
    assert row["mid"] == "m" and row["during_time"] is None


def test_mappings_cast_to_the_declared_types(spark):
    dau = cast_to_mapping(spark.createDataFrame([], DAU_INFO), DAU_MAPPING)
    assert {f.name: f.dataType for f in dau.schema}["user_age"].simpleString() == "int"
    assert {f.name: f.dataType for f in dau.schema}["ts"].simpleString() == "timestamp"
    assert {"brand", "sourceType"} <= set(dau.columns)
    wide = cast_to_mapping(spark.createDataFrame([], ORDER_WIDE), ORDER_MAPPING)
    declared = {f.name: f.dataType for f in ORDER_MAPPING}
    assert {f.name: f.dataType for f in wide.schema} == declared

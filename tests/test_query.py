import pytest
from pyspark.sql import functions as F

from driftwell.operators import mutate
from driftwell.operators.catalog import Catalog, ForeignKey, declared_columns
from driftwell.operators.query import get_documents, nest_children, relation_join, run_spec, select_related, where_condition
from driftwell.operators.validate import parse_specs, validate_specs


@pytest.fixture(scope="module")
def catalog(spark):
    make = spark.createDataFrame
    return Catalog(
        {
            "student": make([(1, "Ann", 10), (2, "Bob", None), (3, None, 11)], "sid int, name string, dept int"),
            "dept": make([(10, "CS"), (11, "EE")], "did int, title string"),
            "takes": make([(1, 100), (1, 101), (2, 100)], "t_sid int, t_cid int"),
            "course": make([(100, 10), (101, 11), (102, 11)], "cid int, c_dept int"),
            "lonely": make([(1,)], "x int"),
        },
        {"student": ["sid"], "dept": ["did"], "course": ["cid"]},
        [ForeignKey("student", "dept", "dept", "did"), ForeignKey("takes", "t_sid", "student", "sid"),
         ForeignKey("takes", "t_cid", "course", "cid"), ForeignKey("course", "c_dept", "dept", "did")],
    )


def test_paths_prefer_junctions(catalog):
    # student-dept-course and student-takes-course are equally short
    assert [s[1] for s in catalog.path("student", "course")] == ["takes", "course"]
    assert catalog.path("student", "student") == [] and catalog.path("student", "lonely") is None


def test_left_joins_keep_unmatched_rows(catalog):
    rows = select_related(catalog, "student", ["sid", "dept.title", "course.cid"], sort=["sid", "course.cid"]).collect()
    assert [tuple(r) for r in rows] == [(1, "CS", 100), (1, "CS", 101), (2, None, 100), (3, "EE", None)]


def test_same_column_names_are_qualified(spark):
    c = Catalog({"a": spark.createDataFrame([(1, 2)], "id int, b_id int"), "b": spark.createDataFrame([(2, 9)], "id int, v int")}, {},
                [ForeignKey("a", "b_id", "b", "id")])
    assert select_related(c, "a", ["a.id", "b.id", "b.v"]).columns == ["a_id", "b_id", "v"]


def test_null_semantics_and_unknown_operator(catalog):
    s = catalog["student"]
    assert s.where(where_condition({"name": None})).count() == 0
    assert s.where(where_condition({"name": None}, document=True)).count() == 1
    assert s.where(where_condition({"name": {"$ne": "Ann"}})).count() == 1
    with pytest.raises(ValueError):
        where_condition({"name": {"$regex": "x"}})


def test_grouping(catalog):
    t = catalog["student"]
    rows = get_documents(t, ["dept", "COUNT(name)", "name"], group_by=["dept"], sort=["-dept"], first_by="sid").collect()
    assert [tuple(r) for r in rows] == [(11, 1, None), (10, 1, "Ann"), (None, 1, "Bob")]
    assert select_related(catalog, "student", ["COUNT(name) AS n"]).first().n == 2


def test_relation_join_both_ways(catalog):
    assert relation_join(catalog, "dept", "student").count() == 2 == relation_join(catalog, "student", "dept").count()
    assert relation_join(catalog, "student", "lonely") is None


def test_nested_pages_hold_every_child(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    children = spark.createDataFrame([(i, 1 if i % 3 else 2, f"v{i}") for i in range(50)], "c int, ref int, v string")
    pages = nest_children(parents, children, "p", "ref", "c", page_rows=4).collect()
    assert max(len(r.children) for r in pages) == 4
    got = {(r.p, c.c, c.v) for r in pages for c in r.children}
    assert got == {(1 if i % 3 else 2, i, f"v{i}") for i in range(50)}
    assert [(r.page, r.children) for r in pages if r.p == 3] == [(0, [])]


def test_specs(catalog):
    with pytest.raises(ValueError):
        run_spec(catalog, {"action": "drop", "entity": "student"})
    with pytest.raises(ValueError):
        run_spec(catalog, {"action": "get"})
    added = run_spec(catalog, {"action": "add", "entity": "dept", "data": [{"did": 12, "title": "ME"}, {"did": 13}]})
    assert added.count() == 4
    left = run_spec(catalog, {"action": "remove", "entity": "student", "where": {"dept": None}, "options": {"multi": False}}, document=True)
    assert sorted(r.sid for r in left.collect()) == [1, 3]
    assert run_spec(catalog, {"action": "remove", "entity": "student", "where": {"dept": None}}).count() == 3
    typed = run_spec(catalog, {"action": "add", "entity": "dept", "data": [{"did": 14, "n": 5, "tags": ["a"], "odd": {"x": 1.5}}]})
    kinds = dict(typed.dtypes)
    assert (kinds["n"], kinds["tags"], kinds["odd"]) == ("bigint", "array<string>", "struct<x:double>")


def test_validation_messages(spark):
    declared = declared_columns(spark.createDataFrame([('{"s": {"id": ["INT", "PRIMARY KEY"], "n": ["TEXT"]}}',)], "value string"))
    specs = [
        '{"action": "get", "entity": "nope"}', '{"action": "add", "entity": "s"}', '{"action": "add", "entity": "s", "data": {"n": 1, "kids": [{"a": 1}], "__x": 2, "q": 1}}',
        '{"action": "change", "entity": "s", "data": {"n": 1}}', '{"action": "remove", "entity": "s"}', '{"action": "get", "entity": "s", "fields": ["*", "n"], "where": {"id": {"$gt": 1}}}',
        '{"action": "add", "entity": "s", "data": [{"id": 1}, 5]}', '{"action": "add", "entity": "s", "data": "text"}',
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(specs)], "query_index int, raw string")
    got = sorted((r.query_index, r.error) for r in validate_specs(parse_specs(rows), declared).collect())
    assert got == [
        (0, "no table 'nope' is declared"), (1, "'add' carries no data"), (2, "record 0 lacks key column 'id'"),
        (2, "table 's' has no column 'q' (in record 0)"), (3, "'change' has no condition"), (4, "'remove' has no condition"),
        (6, "record 1 is not an object"), (7, "record 0 is not an object"),
    ]


def test_mutations(catalog):
    s = catalog["student"]
    with pytest.raises(ValueError):
        mutate.insert(s, None)
    assert mutate.insert(s, []).count() == 3
    with pytest.raises(ValueError):
        mutate.update(s, {"sid": 1}, {})
    with pytest.raises(ValueError):
        mutate.delete(s, {})
    changed = mutate.update(s, {"dept": {"$gte": 10}}, {"name": "Ann"})
    assert tuple(changed.counts.first()) == (2, 1)
    upsert = mutate.update(s, {"sid": 9}, {"name": "New"}, upsert=True)
    assert (upsert.state.count(), upsert.counts.first().upserted_count) == (4, 1)
    assert mutate.update(s, {"sid": 1}, {"name": "Z"}, upsert=True).state.count() == 3
    assert mutate.delete(s, {"sid": {"$in": [1, 7]}}).counts.first().deleted_count == 1
    states = mutate.cascade_delete(catalog, "student", {"sid": 1})
    assert states["takes"].count() == 1 and states["student"].count() == 2
    incoming = s.sparkSession.createDataFrame([(2, "B2"), (8, "H")], "sid int, name string")
    rows = {r.sid: (r.name, r.dept) for r in mutate.upsert_rows(s, incoming, ["sid"]).collect()}
    assert rows == {1: ("Ann", 10), 2: ("B2", None), 3: (None, 11), 8: ("H", None)}
    twice = s.sparkSession.createDataFrame([(2, "B2", 1), (2, "B3", 2)], "sid int, name string, at int")
    with pytest.raises(Exception, match="one key"):
        mutate.upsert_rows(s, twice.drop("at"), ["sid"]).collect()
    assert {r.sid: r.name for r in mutate.upsert_rows(s, twice, ["sid"], "at").collect()}[2] == "B3"
    gone = mutate.cascade_delete(catalog, "student", {"dept": None})
    assert gone["student"].count() == 2
    nested = s.sparkSession.range(1).select(
        F.lit(20).alias("did"), F.lit("Bio").alias("title"), F.array(F.struct(F.lit(200).alias("cid"))).alias("course"))
    made = mutate.nested_insert(catalog, "dept", nested, {"did": "c_dept"})
    assert made["course"].where("cid = 200 and c_dept = 20").count() == 1


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 as k", "cast(id as string) as s").write.parquet(str(tmp_path / "t"))
    c = Catalog({"t": spark.read.parquet(str(tmp_path / "t"))})
    plan = select_related(c, "t", ["id"], {"k": {"$gt": 3}})._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k,3)" in plan and "s:string" not in plan

import json
import random

import pytest
from pyspark.sql import functions as F

from driftwell.functions.payload import strict_json
from driftwell.operators import catalog, schema
from driftwell.operators import dependencies as dep
from driftwell.sources import sse
from driftwell.streaming.ingest import build_operations, learn_schema

KEYS = ["k1", "k2"]


def python_rules(records):
    """Dependencies and inclusions of one batch, pair by pair."""
    columns = sorted({c for r in records for c in r if c != "user"})
    fds, inds = set(), set()
    for key in KEYS:
        for col in columns:
            seen, fine = {}, True
            for r in records:
                if key in r and col in r and not isinstance(r[key], list) and not isinstance(r[col], list):
                    fine &= seen.setdefault(r[key], r[col]) == r[col]
            if col != key and seen and fine:
                fds.add((key, col))
    values = {c: set() for c in columns}
    lists = set()
    for r in records:
        for c, v in r.items():
            if c != "user":
                values[c] |= set(v) if isinstance(v, list) else {v}
                if isinstance(v, list):
                    lists.add(c)
    for a in columns:
        for b in KEYS:
            if a not in lists and a not in KEYS and b in values and values[a] and values[a] <= values[b]:
                inds.add((a, b))
    return fds, inds, lists


def make(seed):
    rng = random.Random(seed)
    out = []
    for i in range(60):
        r = {"user": f"u{i}", "k1": rng.randrange(8)}
        if rng.random() < 0.8:
            r["k2"] = rng.choice([[1, 2, 3], [4, "a"], 5, None]) if rng.random() < 0.5 else r["k1"] * 2
        r["det"] = r["k1"] % 3
        if rng.random() < 0.5:
            r["loose"] = rng.choice([1, 1.0, True, "1", None])
        if rng.random() < 0.3:
            r["ref"] = rng.randrange(4)
        if rng.random() < 0.3:
            r["text"] = str(r["k1"])
        out.append(r)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pairs_against_pair_by_pair(spark, seed):
    data = [make(seed), make(seed + 10)]
    rows = [(b, i, json.dumps(r)) for b, batch in enumerate(data) for i, r in enumerate(batch)]
    df = spark.createDataFrame(rows, "batch bigint, seq int, raw string").repartition(3).withColumn("record", strict_json(F.col("raw")))
    fds = {(r.batch, r.key, r.column) for r in dep.functional_dependencies(df, "batch", "record", KEYS, "user").collect()}
    inds = {(r.batch, r.column, r.references) for r in dep.inclusion_dependencies(df, "batch", "record", KEYS, "user").collect()}
    want = [python_rules(batch) for batch in data]
    assert fds == {(b, *p) for b, (f, _, _) in enumerate(want) for p in f}
    assert inds == {(b, *p) for b, (_, i, _) in enumerate(want) for p in i}
    assert {r.column for r in dep.list_columns(df, "record", "user").collect()} == want[0][2] | want[1][2]


def test_inclusions_of_empty_and_null_values(spark):
    """A column of empty lists refers to nothing and spoils only itself; a null is a value that a key may lack."""
    records = [{"k": 1, "a": 1, "b": [], "c": None, "d": 1}, {"k": 2, "a": 2, "b": [], "c": 2}, {"k": 2, "d": []}]
    rows = [(0, json.dumps(r)) for r in records] + [(1, json.dumps({"k": None, "c": None})), (2, json.dumps({}))]
    df = spark.createDataFrame(rows, "batch int, raw string").select("batch", strict_json(F.col("raw")).alias("record"))
    got = {tuple(r) for r in dep.inclusion_dependencies(df, "batch", "record", ["k"]).collect()}
    assert got == {(0, "a", "k"), (1, "c", "k")}


def test_junction_sample(spark):
    records = [
        {"boat_id": "b7", "hull": "oak", "harbour_id": ["north", "west"], "fleet": "red", "keeper": "k1"},
        {"boat_id": "b9", "hull": "elm", "harbour_id": ["north"], "fleet": "blue", "keeper": "k2"},
        {"boat_id": "b7", "hull": "oak", "harbour_id": ["south"], "fleet": "red", "keeper": "k1"},
    ]
    rows = [(i, "create", json.dumps(r)) for i, r in enumerate(records)]
    events = sse.normalise_pairs(spark.createDataFrame(rows, "seq bigint, event string, data string"))
    learned = learn_schema(events, ["boat_id", "harbour_id"], "keeper")
    j = learned.junctions.first()
    assert (j.table_name, j.owner, j.list_column) == ("boat_harbour", "boat_id", "harbour_id")
    log = build_operations(events, learned, "keeper").collect()
    kinds = sorted((r.table_name, r.type) for r in log)
    assert kinds == [("boat", "INSERT")] * 2 + [("boat", "UPDATE")] + [("boat_harbour", "INSERT")] * 4
    assert schema.junction_rows(events, "record", "boat_id", "harbour_id").count() == 4


def test_owner_is_the_larger_entity_then_the_first_name(spark):
    attrs = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", "y"), ("c", "z"), ("d", "w"), ("b", "w")], "key string, column string")
    got = {(r.column, r.key) for r in schema.column_owners(attrs).collect()}
    assert got == {("x", "a"), ("y", "a"), ("z", "c"), ("w", "b")}


def test_schema_changes(spark):
    old = spark.createDataFrame([("t", "a"), ("gone", "z")], "table_name string, column_name string")
    new = spark.createDataFrame([("t", "a"), ("t", "b"), ("u", "d"), ("u", "c")], "table_name string, column_name string")
    got = sorted((r.type, r.table_name, r.columns) for r in schema.schema_changes(old, new).collect())
    assert got == [("ALTER_TABLE", "t", ["b"]), ("CREATE", "u", ["c", "d"])]


def test_declared_schema(spark):
    text = json.dumps(
        {"student": {"id": ["VARCHAR(5)", "PRIMARY KEY"], "dept": ["VARCHAR(20)", "FK -> department(name)"]},
         "takes": {"sid": ["VARCHAR(5)", "FK -> student(nosuch)"], "cid": ["INT"], "table@constraints": ["PRIMARY KEY (sid, cid)"]},
         "table@constraints": {}, "department": {"name": ["VARCHAR(20)", "PRIMARY KEY"]}}
    )
    cols = catalog.declared_columns(spark.createDataFrame([(text,)], "value string"))
    keys = {(r.table_name, r.column_name) for r in cols.where("is_primary_key").collect()}
    assert keys == {("student", "id"), ("takes", "sid"), ("takes", "cid"), ("department", "name")}
    assert [(r.table_name, r.column_name) for r in catalog.broken_references(cols).collect()] == [("takes", "sid")]
    assert catalog.declared_exists(cols, "takes", "cid").first()[0] and not catalog.declared_exists(cols, "takes", "no").first()[0]


def numbered_windows(spark, seeds):
    """Records in windows of sixty, with values alone and shared in their window, some rows twice."""
    rows = [(b, json.dumps(r)) for b, seed in enumerate(seeds) for r in make(seed)]
    rows += rows[::7] + [(len(seeds), json.dumps({"user": "u", "k1": 1, "a": i})) for i in range(2)] + [(len(seeds) + 1, json.dumps({"k2": None, "a": []}))]
    return spark.createDataFrame(rows, "batch bigint, raw string").select("batch", strict_json(F.col("raw")).alias("record"))


def test_windows_give_what_all_pairs_give(spark):
    df = numbered_windows(spark, [11, 12, 13])
    shown = lambda found: sorted(map(tuple, found.collect()))
    for key in ("user", None):
        want = shown(dep.functional_dependencies(df, "batch", "record", KEYS, key))
        assert want and shown(dep.window_dependencies(df, "batch", "record", KEYS, key)) == want
        want = shown(dep.inclusion_dependencies(df, "batch", "record", KEYS, key))
        assert want and shown(dep.window_inclusions(df, "batch", "record", KEYS, key)) == want


def test_windows_are_sent_once(spark):
    """Records travel by window, and no pairs of their columns after them."""
    df = numbered_windows(spark, [14])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for found in (dep.window_dependencies(df, "batch", "record", KEYS, "user"), dep.window_inclusions(df, "batch", "record", KEYS, "user")):
            assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_schema_queries_number_records_once(spark, tmp_path, monkeypatch):
    """All miners of i9 and i11 read the same stored records."""
    from driftwell.plans import inference_plans as plans

    spark.range(1, 61).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("O").alias("o_orderstatus")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(7).select(F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.lit(1).alias("c_nationkey"), F.lit("m").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    calls, number = [], plans.dense_number
    monkeypatch.setattr(plans, "dense_number", lambda *a: calls.append(a) or number(*a))
    for name in ("i9_foreign_keys", "i11_schema_assembly"):
        calls.clear()
        found = plans.PLANS[name][0](spark, str(tmp_path))
        assert len(calls) == 1 and found.count() == found.distinct().count()


def test_values_of_a_window_are_hashed_after_repeats_are_known(spark):
    rng = random.Random(5)
    texts = []
    for i in range(300):
        r = {"k1": rng.randrange(40), "k2": i, "a": rng.randrange(3), "user": f"u{i}"}
        r["b"] = rng.choice([None, [1, 2], r["k1"] * 2, "x"])
        if rng.random() < 0.5:
            r["c"] = r["k1"] % 5
        texts.append((i // 50, json.dumps({k: r[k] for k in r if k == "a" or rng.random() < 0.9})))
    records = spark.createDataFrame([*texts, (None, '{"k1":1,"a":1}'), (7, "broken")], "batch bigint, raw string").withColumn("record", strict_json(F.col("raw")))
    for hidden in (None, "user"):
        found = dep.window_dependencies(records, "batch", "record", KEYS, hidden)
        whole = dep.functional_dependencies(records, "batch", "record", KEYS, hidden)
        assert found.count() > 10 and sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    assert not any("xxhash64" in line for line in lines[window:])


def test_described_records_are_mined_without_reading_them_again(spark, monkeypatch):
    """Records described once give all miners what the records themselves give, and no miner of i11 opens a VARIANT."""
    long = json.dumps({"k1": 1, "a": "x" * 60, "b": [[1], "y" * 60, 1.50, True], "c": {"d": 1}})
    df = numbered_windows(spark, [21, 22]).union(spark.createDataFrame([(9, long), (9, long), (9, "3"), (None, long)], "batch bigint, raw string").select("batch", strict_json(F.col("raw"))))
    shown = lambda found: sorted(map(str, found.collect()))
    for hidden in (None, "user"):
        once = dep.described(df, "record", hidden)
        for miner in (dep.window_dependencies, dep.window_inclusions, dep.inclusion_dependencies):
            want = shown(miner(df, "batch", "record", KEYS, hidden))
            assert want and shown(miner(once, "batch", "record", KEYS, hidden)) == want
        assert shown(dep.list_columns(once, "record", hidden)) == shown(dep.list_columns(df, "record", hidden))
    from driftwell.plans import inference_plans as plans

    stored, keep = [], plans.materialize
    monkeypatch.setattr(plans, "materialize", lambda rows: stored.append(rows) or keep(rows))
    found = plans.PLANS["i11_schema_assembly"][0](spark, "/root/testdata/sf0.001")
    plan = [rows._jdf.queryExecution().optimizedPlan().toString() for rows in (*stored[1:], found)]
    assert len(stored) == 2 and not any("variant" in text for text in plan)

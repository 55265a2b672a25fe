"""The second stage and the child tables as streams: any split into batches gives what one batch gives."""

import json
import random

import pytest
from pyspark.sql import functions as F

from driftwell.operators import dependencies as dep
from driftwell.operators import nesting
from driftwell.sinks.reports import load_state
from driftwell.sources import sse
from driftwell.sources.logs import read_operation_log
from driftwell.streaming import kept, second_stage
from driftwell.streaming.children import ChildTables
from driftwell.streaming.ingest import Ingest
from driftwell.streaming.second_stage import SecondStage

INIT = json.dumps({"user": {"global_key": "true"}, "k1": {"unique": "true"}, "k2": {"unique": "true"}})
OTHER = json.dumps({"user": {"global_key": "true"}, "k1": {"unique": "true"}, "ref": {"unique": "true"}})


def some_events(seed, n=90):
    """Records whose dependencies hold in some windows and not in others, lists, nulls, and other events between."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        r = {"user": f"u{i}", "k1": rng.randrange(6), "det": i // 17 % 3, "loose": rng.choice([1, 1.0, "1", None])}
        r["of"] = r["k1"] % 2 if rng.random() < 0.97 else 7
        if rng.random() < 0.6:
            r["k2"] = rng.choice([[1, 2, 3], r["k1"], None]) if i % 40 < 20 else r["k1"]
        if rng.random() < 0.4:
            r["ref"] = rng.randrange(4)
        event = rng.choice(["create"] * 6 + ["add", "change", "remove", "get"])
        if event == "get":
            r["COLUMNS"] = ["of", "nothing"]
        out.append((event, json.dumps(r) if rng.random() < 0.95 else "{broken"))
    return out


class Log:
    """Events dealt into batches, with a count of the reads of each batch."""

    def __init__(self, spark, events, cuts):
        rows = [(i + 1, e, d) for i, (e, d) in enumerate(events)]
        self.parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        self.reads = []

    def read(self, spark, batch_id):
        self.reads.append(batch_id)
        return sse.normalise_pairs(spark.createDataFrame(self.parts[batch_id], "seq bigint, event string, data string"))


@pytest.fixture
def small_windows(monkeypatch):
    monkeypatch.setattr(dep, "ENTITY_BATCH", 7)
    monkeypatch.setattr(dep, "RELATION_BATCH", 16)
    monkeypatch.setattr(second_stage, "SIZES", {second_stage.ATTRIBUTE: 7, second_stage.DETERMINES: 16, second_stage.INCLUDED: 16})


def facts_of(learned):
    frames = {
        "tables": learned.tables, "junctions": learned.junctions.select("table_name", "owner", "list_column"),
        "foreign": learned.foreign, "dependencies": learned.dependencies, "lists": learned.lists,
    }
    return {k: sorted(map(tuple, v.distinct().collect())) for k, v in frames.items()}


def test_any_split_learns_the_same(spark, tmp_path, small_windows):
    cuts = [13, 61]
    events = [("init", INIT), *some_events(3)]
    log, stage = Log(spark, events, cuts), SecondStage(str(tmp_path))
    for b in range(len(log.parts)):
        stage.step(spark, log.read, b)
    # no batch is read by another
    assert log.reads == list(range(len(log.parts)))
    whole = Log(spark, events, []).read(spark, 0)
    want = kept.learn_schema(whole, ["k1", "k2"], "user")
    assert facts_of(stage.learned(spark, len(cuts))) == facts_of(want)
    assert all(facts_of(want)[k] for k in ("tables", "dependencies", "lists"))

    # what a write, remove or get is does not depend on the columns known when it came
    batch = kept.build_operations(whole, want, "user").where("pk_id is not null")
    changes = whole.where("event = 'change'").select("seq")
    typed = spark.read.parquet(f"{tmp_path}/keys_seen/0/typed")
    shown = lambda df: sorted(map(tuple, df.join(changes, "seq", "left_anti").select("seq", "table_name", "type").collect()))
    assert shown(typed) == shown(batch) and len(shown(batch)) > 60
    numbers = [r.op_seq for r in spark.read.json(f"{tmp_path}/operations").select("op_seq").collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))

    # a batch run again changes nothing
    shot = lambda: (sorted(map(tuple, stage.facts(spark, 2).collect())), sorted(r.value for r in spark.read.text(f"{tmp_path}/operations").collect()))
    once = shot()
    stage.step(spark, log.read, 2)
    assert shot() == once


def test_batches_wait_for_their_keys(spark, tmp_path, small_windows):
    events = some_events(5, 50)
    # nothing is known in the first batch
    log, stage = Log(spark, [*events[:30], ("init", INIT), *events[30:]], [10]), SecondStage(str(tmp_path))
    for b in range(2):
        stage.step(spark, log.read, b)
    assert log.reads == [0, 1, 0, 1]
    whole = Log(spark, [*events[:30], ("init", INIT), *events[30:]], []).read(spark, 0)
    want = kept.learn_schema(whole, ["k1", "k2"], "user")
    assert facts_of(stage.learned(spark, 1)) == facts_of(want)
    assert read_operation_log(spark, f"{tmp_path}/operations", "user").count() == kept.build_operations(whole, want, "user").count()


def test_other_keys_are_learned_from_the_start(spark, tmp_path, small_windows):
    events = some_events(6, 60)
    all_events = [("init", INIT), *events[:35], ("init", OTHER), *events[35:]]
    log, stage = Log(spark, all_events, [30]), SecondStage(str(tmp_path))
    for b in range(2):
        stage.step(spark, log.read, b)
    whole = Log(spark, all_events, []).read(spark, 0)
    want = kept.learn_schema(whole, ["k1", "ref"], "user")
    assert facts_of(stage.learned(spark, 1)) == facts_of(want)
    # operations of the second batch know the keys of the first
    seqs = {r.seq: r.type for r in kept.build_operations(whole, want, "user").where("table_name = 'ref' and seq > 30").collect()}
    lines = [json.loads(r.value) for b in (1,) for r in spark.read.text(f"{tmp_path}/operations/batch_id={b}").collect()]
    assert sorted(x["type"] for x in lines if x["table_name"] == "ref") == sorted(seqs.values())


def test_schema_changes_of_batches(spark, tmp_path, small_windows):
    first = [("create", json.dumps({"user": "u", "k1": i % 3, "a": i % 3})) for i in range(20)]
    later = [("create", json.dumps({"user": "u", "k1": i % 3, "a": i % 3, "b": i % 3})) for i in range(20)]
    log, stage = Log(spark, [("init", INIT), *first, *later], [21]), SecondStage(str(tmp_path), log=False)
    for b in range(2):
        stage.step(spark, log.read, b)
    got = sorted((r.batch_id, r.type, r.table_name, r.columns) for r in stage.changes(spark).collect())
    assert got == [(0, "CREATE", "k1", ["a", "k1"]), (0, "CREATE", "k2", ["k2"]), (1, "ALTER_TABLE", "k1", ["b"])]


def nested(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        r = {"id": i, "a": rng.choice([1, 2.5, "x", True])}
        if rng.random() < 0.7:
            r["meta"] = {"t": rng.choice(["p", "q"]), "deep": {"k": i}} if rng.random() < 0.7 else {}
        if rng.random() < 0.5:
            r["items"] = [{"p": i}, [{"p": "s", "q": [1, 2]}, 3], {"p": None}]
        out.append(json.dumps(r))
    return out


def test_child_tables_over_batches(spark, tmp_path):
    texts = nested(1, 50)
    rows = [(i + 1, t) for i, t in enumerate(texts)]
    tables = ChildTables(str(tmp_path))
    frame = lambda part: spark.createDataFrame(part, "seq bigint, record_text string")
    for b, (lo, hi) in enumerate([(0, 3), (3, 4), (4, 50)]):
        tables.step(spark, frame(rows[lo:hi]), b)
        if b == 1:
            tables.step(spark, frame(rows[lo:hi]), b)
    whole = nesting.number_nodes(nesting.record_nodes(frame(rows), "seq", "record_text"))
    columns = ["table_name", "seq", "path", nesting.ROW_ID, "parent_table", "parent_id", "parent_key", "pos"]
    shown = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert shown(tables.rows(spark)) == shown(whole)

    catalog = {(r.table_name, r.column_name): r.type for r in nesting.registry(nesting.record_nodes(frame(rows), "seq", "record_text")).collect()}
    kept_types = {(r.table_name, r.field): r.final_type for r in tables.types(spark, 2).collect()}
    assert kept_types == {k: t for k, t in catalog.items() if t != "int auto" and not t.startswith("table ")}

    root = {r.id: r for r in tables.read(spark, "root", 2).collect()}
    meta = {r[nesting.ROW_ID]: r for r in tables.read(spark, "root_meta", 2).collect()}
    items = tables.read(spark, "root_items", 2).collect()
    for i, text in enumerate(texts):
        record, row = json.loads(text), root[i]
        assert row.a == str(record["a"])
        if "meta" in record:
            child = meta[row.meta]
            assert child.parent_id == row[nesting.ROW_ID] and child.t == record["meta"].get("t")
        own = sorted((x.pos, x.p) for x in items if x.parent_id == row[nesting.ROW_ID])
        assert own == (sorted([(0, str(i)), (0, "s"), (2, None)], key=str) and sorted(own)) if "items" in record else own == []
        assert len(own) == (3 if "items" in record else 0)


def test_ingest_with_both(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    job = Ingest(str(tmp_path / "out"), learn=True, children=True)
    init = f"event: init\ndata: {INIT}\n\n"
    for b in range(2):
        body = "".join(f'event: create\ndata: {{"user": "u", "k1": {i % 4}, "c": {i % 4 + 1}, "m": {{"x": {i}}}}}\n\n' for i in range(b * 10, b * 10 + 10 + b))
        (landing / f"{b}.txt").write_text((init if b == 0 else "") + body)
        job.start(spark, str(landing)).awaitTermination()
    tables = ChildTables(f"{job.base}/tables")
    assert sorted(r[nesting.ROW_ID] for r in tables.read(spark, "root_m", 1).collect()) == list(range(1, 22))
    operations = read_operation_log(spark, f"{job.base}/learned/operations", "user")
    assert {r.type: r.n for r in operations.groupBy("type").agg(F.count(F.lit(1)).alias("n")).collect()} == {"INSERT": 4, "UPDATE": 17}
    assert load_state(spark, f"{job.base}/learned/counter", 1).first().records == 21
    learned = job.second_stage.learned(spark, 1)
    assert ("k1", "c") in {(r.key, r.column) for r in learned.dependencies.collect()}


def test_records_are_numbered_once(spark, monkeypatch):
    """The miners read stored records; none numbers or joins them again."""
    events = spark.range(5).select(F.col("id").alias("seq"), F.lit("create").alias("event"), F.parse_json(F.lit('{"k": 1, "l": [1]}')).alias("record"))
    plans, lists = [], dep.list_columns

    def seen(records, *rest):
        plans.append(records._jdf.queryExecution().executedPlan().toString())
        return lists(records, *rest)

    monkeypatch.setattr(dep, "list_columns", seen)
    learned = kept.learn_schema(events, ["k"], None)
    assert plans and not any("Window" in p for p in plans)
    assert [r["column"] for r in learned.lists.collect()] == ["l"]


def test_partials_are_of_open_windows_only(spark, tmp_path, small_windows, monkeypatch):
    """A batch of many windows makes partials of its first and last ones."""
    seen, partials = [], dep.dependency_partials

    def counted(records, *rest):
        seen.append(records.select("batch").distinct().count())
        return partials(records, *rest)

    monkeypatch.setattr(dep, "dependency_partials", counted)
    log, stage = Log(spark, [("init", INIT), *some_events(8, 200)], [10]), SecondStage(str(tmp_path), log=False)
    for b in range(2):
        stage.step(spark, log.read, b)
    assert len(seen) == 4 and max(seen) <= 2
    want = kept.learn_schema(Log(spark, [("init", INIT), *some_events(8, 200)], []).read(spark, 0), ["k1", "k2"], "user")
    assert facts_of(stage.learned(spark, 1)) == facts_of(want)

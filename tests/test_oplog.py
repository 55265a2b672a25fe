import json
import random
import re

import pytest
from pyspark.sql import functions as F

from driftwell.operators import oplog
from driftwell.session import lookup_join
from driftwell.sources import sse
from driftwell.streaming.incremental import first_seen_step
from driftwell.streaming.state import KeptState

COLUMNS = ["id", "a", "b"]


def make_events(n=300, seed=5):
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        # one key has most of the events
        key = "k0" if rng.random() < 0.5 else f"k{rng.randrange(6)}"
        event = rng.choice(["create", "add", "change", "change", "remove", "get"])
        record = {"id": key, "user": f"u{seq % 3}"}
        if event in ("create", "add", "change"):
            for c in ("a", "b"):
                if rng.random() < 0.6:
                    record[c] = rng.choice([None, rng.randrange(50), "it's"])
        if event == "get" and rng.random() < 0.5:
            record["COLUMNS"] = ["b", "zz"]
        out.append((seq, event, record))
    return out


def replay(events):
    """Row by row: operations, state, and answers to gets."""
    ops, rows, answers = [], {}, {}
    for seq, event, rec in events:
        key = rec["id"]
        columns = [c for c in COLUMNS if c in rec]
        if event in ("create", "add"):
            ops.append((seq, "UPDATE" if key in rows else "INSERT", columns))
            rows.setdefault(key, {}).update({c: rec[c] for c in columns})
        elif event == "change":
            columns = [c for c in columns if c != "id"]
            if columns:
                ops.append((seq, "UPDATE", columns))
                if key in rows:
                    rows[key].update({c: rec[c] for c in columns})
        elif event == "remove":
            ops.append((seq, "DELETE", []))
            rows.pop(key, None)
        else:
            wanted = [c for c in rec["COLUMNS"] if c in COLUMNS] if rec.get("COLUMNS") else COLUMNS
            ops.append((seq, "SELECT", wanted))
            if key in rows:
                answers.update({(seq, c): rows[key].get(c) for c in wanted})
    return ops, rows, answers


@pytest.fixture(scope="module")
def log(spark):
    rows = [(s, e, json.dumps(r)) for s, e, r in make_events()]
    events = sse.normalise_pairs(spark.createDataFrame(rows, "seq bigint, event string, data string").repartition(5))
    tables = spark.createDataFrame([("item", "id", c) for c in COLUMNS], "table_name string, primary_key string, column_name string")
    from driftwell.session import materialize

    return materialize(oplog.operation_log(events, tables, global_key="user"))


def test_operations(log):
    want, _, _ = replay(make_events())
    got = sorted((r.seq, r.type, r.columns) for r in log.collect())
    assert got == sorted(want)
    assert all(r.actor == f"u{r.seq % 3}" for r in log.collect())


def test_state(log):
    _, rows, _ = replay(make_events())
    got = {}
    for r in oplog.current_state(log).collect():
        got.setdefault(json.loads(r.pk_id), {})[r.column] = json.loads(r.value)
    assert got == rows


def test_kept_state(spark, log, tmp_path):
    """State after six batches, one of them run again, equals that of the whole log; batches read no older run."""
    kept = KeptState(str(tmp_path))
    bounds = [-1, 20, 21, 90, 150, 200, 10**6]
    for b, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
        for _ in range(2 if b == 1 else 1):
            kept.step(spark, log.where((F.col("seq") > lo) & (F.col("seq") <= hi)), b)
    shown = lambda df: sorted(map(tuple, df.collect()))
    assert shown(kept.state(spark, 5)) == shown(oplog.current_state(log))
    assert shown(kept.state(spark, 2)) == shown(oplog.current_state(log.where("seq <= 90")))
    assert kept.runs.live(5) == [(1, 0), (0, 4), (0, 5)]


def test_answers(log):
    _, _, answers = replay(make_events())
    got = {(r.seq, r.column): None if r.value is None else json.loads(r.value) for r in oplog.answer_gets(log).collect()}
    assert got == answers


def test_answers_from_snapshots(spark, log, tmp_path):
    """Gets of six batches, answered from the state before each, are those of the whole log; folders not asked for stay shut."""
    kept, got = KeptState(str(tmp_path), buckets=8), []
    bounds = [-1, 20, 21, 90, 150, 200, 10**6]
    for b, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
        batch = log.where((F.col("seq") > lo) & (F.col("seq") <= hi))
        got += map(tuple, kept.answers(spark, batch, b).collect())
        kept.step(spark, batch, b)
        assert b == 0 or sorted(map(tuple, kept.answers(spark, batch, b).collect())) == sorted(g for g in got if lo < g[0] <= hi)
    assert sorted(got) == sorted(map(tuple, oplog.answer_gets(log).collect()))
    one = spark.createDataFrame([("item", json.dumps("k1"))], "table_name string, pk_id string")
    opened = kept.runs.read(spark, 5, one)
    planned = kept.runs.parts(spark, 5, one)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*bucket#", planned)) == planned.count("PartitionFilters") == 3
    assert {r.pk_id for r in opened.collect()} == {json.dumps("k1")}


def test_no_gets_no_answers(spark, log, tmp_path):
    kept = KeptState(str(tmp_path))
    batch = log.where("type <> 'SELECT'")
    kept.step(spark, batch, 0)
    assert kept.answers(spark, batch, 1).collect() == []


def test_statements_escape_quotes(log):
    texts = [r.sql for r in oplog.number_operations(log).orderBy("op_seq").collect()]
    assert len(texts) == log.count()
    assert any("'it''s'" in t for t in texts) and any("NULL" in t for t in texts)
    assert any(t.startswith("DELETE FROM item WHERE id = 'k") for t in texts)


def test_first_seen_over_batches_equals_the_log(spark, log):
    rows = spark.createDataFrame([("item", r["id"], s, e) for s, e, r in make_events()], "table_name string, pk_id string, seq bigint, event string")
    state, got = None, []
    for lo, hi in ((0, 100), (100, 150), (150, 300)):
        typed, touched = first_seen_step(state, rows.where((F.col("seq") >= lo) & (F.col("seq") < hi)))
        got += [(r.seq, r.type) for r in typed.collect() if r.event in ("create", "add")]
        tagged = touched.withColumn("batch_id", F.lit(hi))
        both = tagged if state is None else state.withColumn("batch_id", F.lit(lo)).unionByName(tagged)
        state = spark.createDataFrame(both.groupBy("table_name", "pk_id").agg(F.max_by("seen", "batch_id").alias("seen")).collect(), "table_name string, pk_id string, seen boolean")
    writes = {s for s, e, _ in make_events() if e in ("create", "add")}
    assert sorted(got) == sorted((r.seq, r.type) for r in log.collect() if r.seq in writes)


def test_rows_are_not_broadcast_to_their_definitions(spark):
    """An inner lookup broadcasts the side that is metadata, also where few rows look it up."""
    rows, small = spark.range(3).select(F.col("id").alias("k")), spark.range(100).select(F.col("id").alias("k"))
    found = lookup_join(rows, small, ["k"], "inner")
    assert sorted(r.k for r in found.collect()) == [0, 1, 2]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan


def test_log_lines_are_made_once_and_written_in_order(spark, tmp_path, monkeypatch):
    from driftwell.sinks import reports

    stored = []
    monkeypatch.setattr(reports, "materialize", lambda df, real=reports.materialize: stored.append(df.columns) or real(df))
    rows = [("INSERT", "t", ["a"], ["1"], None, "s", "u", i) for i in random.Random(3).sample(range(200), 200)]
    schema = "type string, table_name string, columns array<string>, values array<string>, where map<string,string>, sql string, actor string, op_seq bigint"
    reports.write_operation_log(spark.createDataFrame(rows, schema), str(tmp_path / "log"), batch_id=0)
    assert stored == [["op_seq", "value"]]
    lines = [json.loads(line)["op_seq"] for part in sorted((tmp_path / "log" / "batch_id=0").glob("part-*")) for line in part.read_text().splitlines()]
    assert lines == list(range(200))


def test_uneven_batches_read_their_own_operations_only(spark):
    """Batches lie in folders of their own, and gets are answered from values that were rendered once."""
    from driftwell.plans import oplog_plans as plans

    log = plans.log(spark, "/root/testdata/sf0.001")
    whole, batches = sorted(r.seq for r in log.collect()), plans.uneven_batches(log)
    last = whole[-1]
    ends = [-1, *[int(last * share) for share in (0.03, 0.3, 0.31, 0.8)], last]
    for batch, after, upto in zip(batches, ends, ends[1:], strict=False):
        assert sorted(r.seq for r in batch.collect()) == [s for s in whole if after < s <= upto]
        assert "PartitionFilters: [isnotnull(batch" in batch._jdf.queryExecution().executedPlan().toString()
    assert "to_json" not in oplog.answer_gets(batches[-1])._jdf.queryExecution().optimizedPlan().toString()

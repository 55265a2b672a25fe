import json
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from driftwell.functions.payload import strict_json
from driftwell.operators import profiling as pr
from driftwell.session import materialize
from driftwell.streaming.incremental import profile_step


def make(n=120):
    rng = random.Random(11)
    out = []
    for i in range(n):
        r = {"id": i, "name": rng.choice("abc"), "note": "x" * (rng.randrange(5) if i < 60 else rng.randrange(0, 400)), "tags": [1, 2], "obj": {"a": 1}}
        if rng.random() < 0.82:
            r["often"] = rng.choice([None, 1, 2]) if rng.random() < 0.1 else 3
        if rng.random() < 0.3:
            r["rare"] = "r"
        r["mix"] = i if i < 30 else "z"
        out.append(r)
    return out


def python_replay(records):
    """Record by record with running state; drift is known: ``mix`` turns to text at 30."""
    seen, present, lengths, last, log = {}, {}, {}, {}, []
    for no, r in enumerate(records, 1):
        for f, v in r.items():
            nested = isinstance(v, dict)
            if nested:
                dest = "mongodb"
            else:
                seen[f] = seen.get(f, 0) + 1
                present[f] = present.get(f, 0) + (v is not None)
                if isinstance(v, str):
                    lengths.setdefault(f, []).append(len(v))
                alters = 2 if f == "mix" and no > 30 else 1
                var = statistics.variance(lengths[f]) if len(lengths.get(f, [])) > 1 else 0.0
                if alters / seen[f] > 0.05:
                    dest = "mongodb"
                elif isinstance(v, str) and var > 2000:
                    dest = "mongodb"
                else:
                    dest = "sql" if present[f] / no >= 0.80 else "mongodb"
            log.append((f, no - 1, dest))
            last[f] = dest
    return log, last, seen, present, lengths


@pytest.fixture(scope="module")
def records(spark):
    rows = [(i, json.dumps(r)) for i, r in enumerate(make())]
    df = spark.createDataFrame(rows, "seq bigint, raw string").repartition(3)
    return materialize(df.select("seq", strict_json(F.col("raw")).alias("record")))


def test_replay_and_both_final_forms(records):
    log, last, *_ = python_replay(make())
    replay = pr.placement_replay(records, "seq", "record")
    assert sorted((r.field, r.seq, r.dest) for r in replay.collect()) == sorted(log)
    assert {r.field: r.dest for r in pr.last_decisions(replay, "seq").collect()} == last
    state = None
    for lo, hi in ((0, 37), (37, 40), (40, 200)):
        state = materialize(profile_step(state, records.where((F.col("seq") >= lo) & (F.col("seq") < hi)), "seq", "record"))
    assert {r.field: r.dest for r in pr.final_placement(state).collect()} == last


def test_profile(records):
    data = make()
    _, _, seen, present, lengths = python_replay(data)
    rows = {r.field: r for r in pr.profile_fields(records, "seq", "record").collect()}
    assert set(rows) == set(seen)
    for f, r in rows.items():
        values = {json.dumps(x[f]) for x in data if f in x and not isinstance(x[f], list)}
        assert (r.total_seen, r.present_count, r.unique_count, r.total_records) == (seen[f], present[f], len(values), len(data))
        var = statistics.variance(lengths[f]) if len(lengths.get(f, [])) > 1 else 0.0
        assert math.isclose(r.variance, round(var, 2), abs_tol=0.011)
    assert rows["id"].is_unique and not rows["name"].is_unique and rows["mix"].alter_count == 2


def test_split_rejoins_without_loss(spark, records):
    placement = spark.createDataFrame([("id", "sql"), ("name", "sql"), ("obj", "sql"), ("note", "mongodb")], "field string, dest string")
    for r in pr.split_payload(records, placement, "record").select("seq", F.to_json("relational").alias("a"), F.to_json("document").alias("b")).collect():
        assert json.loads(r.a) | json.loads(r.b) == make()[r.seq]
        assert set(json.loads(r.a)) == {"id", "name"}


def test_numbered_cells_are_not_broadcast(spark):
    """Cells and record numbers both grow with the records: neither goes through the driver."""
    raw = F.concat(F.lit('{"a":'), F.col("id").cast("string"), F.lit("}"))
    records = spark.range(60).select(F.col("id").alias("seq"), F.parse_json(raw).alias("record"))
    sums = pr.profile_sums(records, "seq", "record")
    sums.collect()
    assert "Broadcast" not in sums._jdf.queryExecution().executedPlan().toString()


def test_sums_of_distinct_records_join_no_cells(spark):
    """Where no two records share a number, only the last cell of each field is looked up."""
    rows = [(10 * i, json.dumps({"a": i, **({"b": "x" * (i % 5)} if i % 3 else {}), **({"c": {"d": 1}} if i < 40 else {}), "l": [i]})) for i in range(1, 90)]
    records = spark.createDataFrame(rows, "seq bigint, raw string").select("seq", strict_json(F.col("raw")).alias("record"))
    cells = pr.described_cells(records, "seq", "record")
    want = pr.profile_sums(records, "seq", "record", cells)
    got = pr.profile_sums(records, "seq", "record", cells, distinct=True).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "is_null" not in got.select("field", "at_last")._jdf.queryExecution().optimizedPlan().toString()
    assert pr.profile_sums(records.limit(0), "seq", "record", distinct=True).count() == 0

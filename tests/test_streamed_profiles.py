"""Distinct counts and placements over batches against those of the whole table."""

import json
import random

import pytest
from pyspark.sql import functions as F

from driftwell.functions.payload import strict_json
from driftwell.operators import profiling as pr
from driftwell.streaming import profiles
from driftwell.streaming.profiles import DistinctValues, PlacementLog
from driftwell.streaming.runs import FAN, Runs


def records_of(spark, seed, n=150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        r = {"id": i, "often": rng.choice([1, 1.0, "1", True, None, "x"]), "tags": ["a"]}
        if i > n // 2:
            r["late"] = f"v{i}"
        if rng.random() < 0.8:
            r["some"] = "y" * rng.choice([1, 2, 300])
        if i % 3:
            r["mix"] = i if rng.random() < 0.9 else "word"
        if rng.random() < 0.1:
            r["deep"] = rng.choice([{"a": 1}, 5])
        rows.append((i, json.dumps(r)))
    return spark.createDataFrame(rows, "seq bigint, raw string").select("seq", strict_json(F.col("raw")).alias("record"))


def split(records, cuts):
    return [records.where((F.col("seq") >= a) & (F.col("seq") < b)) for a, b in zip([0, *cuts], [*cuts, 10**6], strict=True)]


@pytest.mark.parametrize("cuts", [[40, 41], [10, 30, 70, 71]])
def test_distinct_values(spark, tmp_path, cuts):
    records = records_of(spark, 1)
    kept = DistinctValues(str(tmp_path))
    parts = split(records, cuts)
    for b, part in enumerate(parts):
        for _ in range(1 + (b == 1)):  # a batch run again changes nothing
            kept.step(spark, part, "seq", "record", b)
    got = {r.field: (r.total_seen, r.unique_count, r.is_unique) for r in kept.exact(spark, len(cuts)).collect()}
    want = {r.field: (r.total_seen, r.unique_count, r.is_unique) for r in pr.profile_fields(records, "seq", "record").collect()}
    assert got == want and want["id"][2] and not want["often"][2]
    early = kept.exact(spark, 1).where("field = 'id'").first()
    assert early.total_seen == cuts[1]
    for r in kept.estimated(spark, len(cuts)).collect():
        assert r.total_seen == want[r.field][0]
        assert abs(r.unique_estimate - want[r.field][1]) <= 5 * 1.04 / 2 ** (profiles.SKETCH_BITS / 2) * want[r.field][1]


def test_runs_hold_each_batch_once():
    kept = Runs("", "", None)
    for version in range(200):
        live = kept.live(version)
        batches = [b for level, number in live for b in range(number * FAN**level, (number + 1) * FAN**level)]
        assert batches == list(range(version + 1))
        assert max(sum(r[0] == level for r in live) for level, _ in live) < FAN


@pytest.mark.parametrize("cuts", [[1, 60]])
def test_demotions(spark, tmp_path, cuts):
    records = records_of(spark, 2)
    whole = pr.placement_replay(records, "seq", "record")
    want = sorted(map(tuple, pr.reclassified(whole, "seq").collect()))
    kept = PlacementLog(str(tmp_path))
    for b, part in enumerate(split(records, cuts)):
        kept.step(spark, part, "seq", "record", b)
    got = sorted(map(tuple, kept.changes(spark).drop("batch_id").collect()))
    assert got == want and len(want) > 2
    last = {r.field: r.dest for r in pr.last_decisions(whole, "seq").collect()}
    assert {r.field: r.dest for r in kept.placement(spark, len(cuts)).collect()} == last

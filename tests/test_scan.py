import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftwell.operators.clock import ingest_time
from driftwell.operators.scan import Running, dense_number, running_scan


@pytest.mark.parametrize("bits", [2, 5, 18])
def test_blocks_equal_plain_windows_with_a_hot_group(spark, bits):
    rng = random.Random(bits)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(9)}", i * 3 - 50, rng.choice([None, rng.randrange(100)])) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, seq bigint, v int").repartition(6)
    got = running_scan(
        df, ["g"], "seq",
        {
            "n": Running("count", F.col("v")), "s": Running("sum", F.col("v")), "hi": Running("max", F.col("v"), False),
            "lo": Running("min", F.col("v")), "before": Running("last", F.col("v"), False), "first": Running("first", F.col("v")),
        },
        block_bits=bits,
    )
    w = Window.partitionBy("g").orderBy("seq")
    upto, prior = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select(
        "g", "seq", "v", F.count("v").over(upto).alias("n"), F.sum("v").over(upto).alias("s"), F.max("v").over(prior).alias("hi"),
        F.min("v").over(upto).alias("lo"), F.last("v", True).over(prior).alias("before"), F.first("v", True).over(upto).alias("first"),
    )
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_dense_number_breaks_ties(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (0, "z"), (9, "c")], "seq bigint, t string")
    got = {(r.seq, r.t): r.n for r in dense_number(df, "n", "seq", tie=["t"], block_bits=1).collect()}
    assert got == {(0, "z"): 1, (1, "a"): 2, (1, "b"): 3, (9, "c"): 4}


@pytest.mark.parametrize("bits", [1, 18])
def test_ingest_time_is_the_recurrence(spark, bits):
    rng = random.Random(7)
    clocks = [rng.randrange(30) for _ in range(60)]
    rows = spark.createDataFrame([(i * 5, t) for i, t in enumerate(clocks)], "seq bigint, us bigint")
    want, last = [], None
    for t in clocks:
        last = t if last is None or t > last else last + 1
        want.append(last)
    got = [r.sys_ingested_us for r in ingest_time(rows, "seq", "us", block_bits=bits).orderBy("seq").collect()]
    assert got == want


def test_no_side_of_a_scan_is_broadcast(spark):
    """Partials of blocks grow with the groups; adaptive execution must not send them through the driver."""
    df = spark.range(300).select((F.col("id") % 50).alias("g"), F.col("id").alias("seq"))
    got = running_scan(df, ["g"], "seq", {"n": Running("count", F.lit(1))}, block_bits=5)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan

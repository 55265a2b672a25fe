import random

import duckdb
import pytest

from driftwell.operators.fuzzy import _packs, fuzzy_classes, fuzzy_join, near_values
from driftwell.plans.source_plans import PLANS
from oracle import compare


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize(("most", "chunk"), [(1, 10_000), (2, 3), (3, 10_000)])
def test_all_pairs(spark, most, chunk):
    rng = random.Random(most)
    words = [["".join(rng.choice("abÉ日") for _ in range(rng.randrange(0, 9))) for _ in range(60)] for _ in range(2)]
    left, right = ([(i, w) for i, w in enumerate(ws + [None, "same", "same", "Same1"])] for ws in words)
    a, b = spark.createDataFrame(left, "i int, x string"), spark.createDataFrame(right, "j int, y string")
    want = sorted((i, j, d) for i, x in left for j, y in right if x is not None and y is not None and (d := distance(x.lower(), y.lower())) <= most)
    got = fuzzy_join(a, b, "x", "y", most, chunk)
    assert sorted((r.i, r.j, r.distance) for r in got.collect()) == want
    assert set(got.columns) == {"i", "x", "j", "y", "distance"}


def test_no_pairs_of_all(spark):
    """Values meet by segments; the plan has no cross join."""
    a = spark.createDataFrame([("some value",), ("another",)], "value string")
    plan = near_values(a, a, "value", 2)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_classes_expand_to_the_join(spark):
    """Copies are members of a class, not rows of all pairs; expanded, classes give the join."""
    left = [(i, w) for i, w in enumerate(["abc"] * 5 + ["Abd", "x", None])]
    right = [(i, w) for i, w in enumerate(["ABC"] * 4 + ["abde", "zzzz", None])]
    a, b = spark.createDataFrame(left, "i int, x string"), spark.createDataFrame(right, "j int, y string")
    rows = [tuple(r) for r in fuzzy_classes(a, b, "i", "x", "j", "y", 1).collect()]
    members = {kind: [(key, name) for k, key, name, _ in rows if k == kind] for kind in ("left", "right")}
    pairs = [(p, q, d) for kind, p, q, d in rows if kind == "pair"]
    assert len(rows) == len(pairs) + 7 + 6 and len(pairs) == 3
    got = sorted((i, j, d) for p, q, d in pairs for i, n in members["left"] if n == p for j, m in members["right"] if m == q)
    assert got == sorted((r.i, r.j, r.distance) for r in fuzzy_join(a, b, "x", "y", 1).collect())


def test_query_gives_all_pairs_of_rows(spark, tmp_path):
    """Every part of an even key meets every part of an odd key whose label is near, copies and rows that come twice too."""
    labels = [("Red bolt", "Brand#1"), ("red bolt", "brand#12"), ("red bolts", "Brand#1"), ("old plate", "Brand#7"), ("red bolt", "Brand#1")]
    parts = [(k, *labels[k * 7 // 3 % 5]) for k in range(40)] + [(4, *labels[0]), (None, *labels[0])]
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    fn, sql = PLANS["x4_fuzzy_join"]
    ok, rows, why = compare(spark, con, str(tmp_path), fn, sql)
    assert ok, why
    sides = [[(k, f"{n} {b}".lower()) for k, n, b in parts if k is not None and k % 2 == odd] for odd in (0, 1)]
    want = sorted((i, j, d) for i, x in sides[0] for j, y in sides[1] if (d := distance(x, y)) <= 2)
    got = fn(spark, str(tmp_path))
    assert got.columns == ["left_key", "right_key", "distance"]
    assert sorted(map(tuple, got.collect())) == want and rows == len(want) > 200


def test_rows_of_a_hot_value_travel_in_packs(spark):
    """A value's rows are dealt to several packs, each row to one; columns may share their names."""
    left = [(i % 250, w) for i, w in enumerate(["Hot"] * 300 + ["hat", "cold", None])]
    right = [(i, w) for i, w in enumerate(["hot"] * 30 + ["cord", "x", None])]
    a, b = spark.createDataFrame(left, "c0 int, distance string"), spark.createDataFrame(right, "c0 int, right_rows string")
    sizes, packs = _packs(a, "distance", 20)
    assert {r.value: r.packs for r in sizes.collect()} == {"hot": 15, "hat": 1, "cold": 1}
    held = [(r.value, len(r.rows)) for r in packs.collect()]
    assert sum(n for _, n in held) == 302 and max(n for _, n in held) < 60 and sum(v == "hot" for v, _ in held) > 10
    got = fuzzy_join(a, b, "distance", "right_rows", 2, copies=20)
    assert got.columns == ["c0", "distance", "distance", "c0", "right_rows"]
    want = sorted((i, x, d, j, y) for i, x in left for j, y in right if x is not None and y is not None and (d := distance(x.lower(), y.lower())) <= 2)
    assert sorted(map(tuple, got.collect())) == want

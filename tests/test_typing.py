import json
import random

import pytest
from pyspark.sql import functions as F

from driftwell.functions import coerce
from driftwell.operators.widening import continue_history, drift_log, resolve, type_history, type_summary

# start type, subtype, input, output, end type
CELLS = [
    ("int", "5", 5, "int"), ("int", "5.5", 5.5, "float"), ("int", "[1, 2, 3]", ["1", "2", "3"], "list<int>"),
    ("int", "[1.2, 2.3]", ["1.2", "2.3"], "list<float>"), ("float", "[1.2, 2.3]", ["1.2", "2.3"], "list<float>"),
    ("bool", 2, 2, "int"), ("list<int>", [1.5, 2.5], ["1.5", "2.5"], "list<float>"), ("list<float>", ["a", "b"], ["a", "b"], "list<str>"),
    ("int", 87.5, 87, "int"), ("UNK", "yes", True, "bool"), ("UNK", "1", 1, "int"), ("UNK", "nan", float("nan"), "float"),
    ("float", None, None, "float"), ("list<UNK>", [], [], "list<UNK>"), ("list<int>", 5, None, "list<int>"), ("bool", 1.0, 1, "int"),
    ("str", [1, 2], "[1,2]", "str"), ("list<bool>", ["yes", 0], ["true", "false"], "list<bool>"), ("list<bool>", [1, 7], ["1", "7"], "list<int>"),
    ("UNK", [1, 2.5], ["1", None], "list<int>"), ("UNK", ["5", "x"], ["5", "x"], "list<str>"), ("int", "['1', 2]", ["1", "2"], "list<int>"),
]


@pytest.fixture(scope="module")
def transitions(spark):
    rows = [(i, 0, json.dumps(v)) for i, (_, v, _, _) in enumerate(CELLS)]
    cells = spark.createDataFrame(rows, "c int, seq bigint, raw string").withColumn("v", F.parse_json("raw"))
    summary = type_summary(cells, ["c"], "seq", "v")
    start = spark.createDataFrame([(i, s) for i, (s, _, _, _) in enumerate(CELLS)], "c int, start string")
    history = start.join(summary, "c", "left").withColumn("known", F.col("start"))
    ended = continue_history(history.where("summary is not null"), ["c", "start"], F.col("known"))
    return {r.c: r.final_type for r in ended.collect()}


@pytest.mark.parametrize("i", range(len(CELLS)))
def test_transition(transitions, i):
    start, value, _, end = CELLS[i]
    assert transitions.get(i, start) == end, (start, value)


def test_values_under_their_type(spark):
    rows = [("a", 0, "1"), ("a", 1, '"5.5"'), ("a", 2, "3"), ("b", 0, "true"), ("b", 1, "2"), ("b", 2, '"yes"'), ("b", 3, "null"),
            ("c", 0, "[1]"), ("c", 1, "4"), ("d", 0, "7"), ("d", 1, "87.9"), ("e", 0, '"x"'), ("e", 1, "5.0"), ("e", 2, "true")]
    cells = spark.createDataFrame(rows, "c string, seq bigint, raw string").withColumn("v", F.parse_json("raw"))
    got = {}
    for r in resolve(cells, ["c"], "seq", "v").collect():
        value = next((x for x in (r.int_value, r.float_value, r.bool_value, r.str_value, r.list_value) if x is not None), None)
        got[(r.c, r.seq)] = (r.resolved_type, value, r.failed)
    assert got[("a", 1)] == ("float", 5.5, False) and got[("a", 2)] == ("float", 3.0, False)
    assert got[("b", 1)] == ("int", 2, False) and got[("b", 2)] == ("str", "yes", False) and got[("b", 3)] == ("str", None, False)
    assert got[("c", 1)] == ("list<int>", None, True)
    assert got[("d", 1)] == ("int", 87, False)
    assert got[("e", 1)] == ("str", "5.0", False) and got[("e", 2)] == ("str", "True", False)


SCALARS = [True, 0, 1, 7, 2.0, 2.5, "1", "12", "3.5", "yes", "FALSE", "abc", " 4 ", "y", "1d", ".5"]


def python_next(state, v):
    """The widening rule for scalars, row by row."""
    words = {"true", "1", "yes", "false", "0", "no"}
    is_bool, is_num, is_text = isinstance(v, bool), isinstance(v, (int, float)), isinstance(v, str)

    def attempt(f):
        try:
            f(v)
            return True
        except ValueError:
            return False

    whole = is_num and (is_bool or float(v).is_integer()) or (is_text and attempt(int))
    number = is_num or (is_text and attempt(float))
    boolean = is_bool or (is_text and v.lower() in words) or (is_num and not isinstance(v, float) and v in (0, 1))
    if state == "UNK":
        if is_bool:
            return "bool"
        if is_num:
            return "float" if isinstance(v, float) else "int"
        return "int" if attempt(int) else "float" if attempt(float) else "bool" if boolean else "str"
    if state == "int":
        return "int" if is_num or attempt(int) else "float" if number else "str"
    if state == "float":
        return "float" if number else "str"
    if state == "bool":
        return "bool" if boolean else "int" if whole else "float" if number else "str"
    return "str"


def test_random_columns_against_the_fold(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for c in range(40):
        state, pool = "UNK", rng.sample(SCALARS, rng.randrange(1, 8))
        log = []
        for seq in range(rng.randrange(1, 40)):
            v = rng.choice(pool)
            rows.append((c, seq, json.dumps(v)))
            new = python_next(state, v)
            if new != state and state != "UNK":
                log.append((seq, state, new))
            state = new
        want[c] = (state, log)
    cells = spark.createDataFrame(rows, "c int, seq bigint, raw string").withColumn("v", F.parse_json("raw")).repartition(5)
    for bits in (1, 14):
        history = type_history(cells, ["c"], "seq", "v", fold_bits=bits)
        assert {r.c: r.final_type for r in history.collect()} == {c: s for c, (s, _) in want.items()}
        logged = sorted((r.c, r.seq, r.old_type, r.new_type) for r in drift_log(history, ["c"]).collect())
        assert logged == sorted((c, *step) for c, (_, log) in want.items() for step in log)


def test_scalar_conversions(spark):
    df = spark.createDataFrame([("y",), ("1d",), (" 12 ",), ("1.5",), ("-.5e1",), ("NO",), ("99999999999999999999",)], "v string")
    v = F.col("v")
    rows = df.select(coerce.is_boolean_text(v), coerce.to_boolean(v), coerce.to_integer(v), coerce.to_float(v)).collect()
    assert [tuple(r) for r in rows] == [
        (False, None, None, None), (False, None, None, None), (False, None, 12, 12.0), (False, None, None, 1.5),
        (False, None, None, -5.0), (True, False, None, None), (False, None, None, 1e20),
    ]

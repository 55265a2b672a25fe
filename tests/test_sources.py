import json
import random

import pytest
from pyspark.sql import functions as F

from driftwell.functions.payload import identity, strict_json
from driftwell.sources import logs, specs, sse

FORMS = [
    (1, 'event: init\r\ndata: {"pilot": {"global_key": "true"}, "plane_id": {"unique": "true"}, "colour": {}, "seats": {"unique": true}}'),
    (2, '\t event:  CREATE \n\t data: {"plane_id": 7}\t'), (3, 'data:{"gate": "g2"}'), (4, ' \n{"plane_id": 8}'),
    (5, '{"event": "\\tGet ", "data": {"plane_id": 7, "COLUMNS": ["seats"]}}'), (6, '{"data": "{\\"seats\\": 90}", "event": "change"}'),
    (7, "{open"), (8, 'event: noise\ndata: {"seats": 1}'), (9, 'event: add\ndata: {"seats": 1} more'), (10, '{"event": "alone"}'),
]


@pytest.fixture(scope="module")
def events(spark):
    return sse.normalise(spark.createDataFrame(FORMS, "seq bigint, raw string"))


def test_forms(events):
    got = {r.seq: (r.event, json.loads(r.j) if r.j else None) for r in events.withColumn("j", F.to_json("record")).collect()}
    assert got[2] == ("create", {"plane_id": 7}) and got[3] == ("create", {"gate": "g2"}) and got[4] == ("create", {"plane_id": 8})
    assert got[5] == ("get", {"plane_id": 7, "COLUMNS": ["seats"]}) and got[6] == ("change", {"seats": 90})
    assert got[7][1] is None and got[8][0] == "noise" and got[9][1] is None and got[10] == ("create", {"event": "alone"})
    counts = {r.event: (r.n, r.known) for r in sse.event_counts(events).collect()}
    assert counts["noise"] == (1, False) and counts["create"] == (5, True)


def test_filters_and_config(events):
    assert {r.seq for r in sse.dead_letters(events).collect()} == {7, 9}
    assert {r.seq for r in sse.forwarded(events).collect()} == {2, 3, 4, 5, 6, 10}
    config = sse.init_config(events).first()
    assert (config.global_key, config.unique_fields) == ("pilot", ["plane_id"])


def test_missing_init_is_an_error(events):
    with pytest.raises(Exception, match="init"):
        sse.init_config(events.where("event <> 'init'")).collect()


def test_frames_and_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("event: create\ndata: {\"a\": 1}\ndata:{\"a\": 2}\n\ndata: {\"a\": 3}\n")
    (tmp_path / "b.txt").write_text("data: {\"a\": 4}\nevent: get\ndata: {\"a\": 5}\n")
    lines = sse.read_lines(spark, str(tmp_path))
    got = [(r.event, json.loads(r.data)["a"]) for r in sse.line_records(lines).orderBy("seq").collect()]
    assert got == [("create", 1), ("create", 2), ("create", 3), (None, 4), ("get", 5)]
    frames = spark.createDataFrame([("event: add\ndata: {}\nevent: get\ndata:[1]",), (": comment",)], "frame string")
    assert [(r.event, r.data) for r in sse.frame_records(frames).collect()] == [("add", "{}"), ("get", "[1]")]


def test_commands_and_statements(spark):
    lines = spark.createDataFrame(
        [('db.t.insertOne({a: 1, "b": [1, 2], c: {d: "x, y: z"}});',), ("db.t.insertOne({a: });",), ("nonsense",), ("db.u.insertOne({n: null})",)], "value string"
    )
    parsed = logs.parse_commands(lines)
    assert logs.command_counts(parsed).first().asDict() == {"inserted": 2, "skipped": 2}
    doc = parsed.where("collection = 't'").select(F.to_json("document").alias("d")).first().d
    assert json.loads(doc) == {"a": 1, "b": [1, 2], "c": {"d": "x, y: z"}}
    pieces = spark.createDataFrame([("SELECT 1",), ("\n-- note\n",), ("  ",), ("\n-- c\nDROP x ",)], "value string")
    assert [r.statement for r in logs.statements(pieces).collect()] == ["SELECT 1", "-- c\nDROP x"]


def test_operation_log_and_specs(spark, tmp_path):
    log = tmp_path / "ops.log"
    log.write_text('{"type": "insert", "table_name": "t", "columns": ["a"], "values": [1], "username": "u"}\n\n{"type": "DELETE", "table_name": "t", "where": {"a": 1}}\n')
    rows = logs.read_operation_log(spark, str(log), "username").collect()
    assert [(r.type, r.columns, r.username) for r in rows] == [("INSERT", ["a"], "u"), ("DELETE", None, None)]
    spec = tmp_path / "specs.json"
    spec.write_text(json.dumps({"queries": [{"action": "get", "entity": "t"}, {"action": "add", "entity": "t"}]}, indent=1))
    got = specs.read_specs(spark, str(spec)).orderBy("query_index").collect()
    assert [(r.query_index, json.loads(r.raw)["action"]) for r in got] == [(1, "get"), (2, "add")]


def spec_document(rng, key):
    """A document with specs, other arrays, objects, scalars and strings that look like brackets, in any spacing."""
    strings = ["a", "}", "{", "]", 'say "hi" }', "back\\\\", "\\" + '"', "x[}{]", "", "é}日"]

    def value(depth):
        kind = rng.randrange(7 if depth < 3 else 4)
        if kind < 2:
            return rng.choice(strings)
        if kind < 4:
            return rng.choice([1, None, True, 2.5])
        if kind < 6:
            return {rng.choice(strings) + str(i): value(depth + 1) for i in range(rng.randrange(4))}
        return [value(depth + 1) for _ in range(rng.randrange(4))]

    held = [value(0) if rng.random() < 0.2 else {"n": i, "v": value(0)} for i in range(rng.randrange(12))]
    parts = {"before": value(0), "o}": [{key: [{"no": 1}]}], key: held, "after": [{"no": 2}, value(0)], "deep": {key: [{"no": 3}]}}
    names = list(parts)
    rng.shuffle(names)
    return json.dumps({n: parts[n] for n in names}, indent=rng.choice([None, 1, 4]), ensure_ascii=rng.random() < 0.5), held


@pytest.mark.parametrize(("seed", "split"), [(1, 40), (2, 97), (3, 1000)])
def test_specs_by_splits(spark, tmp_path, seed, split):
    """Documents cut into splits at any byte, in strings and escapes too, against the whole document parsed."""
    rng = random.Random(seed)
    want = {}
    for i in range(3):
        text, held = spec_document(rng, "queries")
        (tmp_path / f"{i}.json").write_text(text + rng.choice(["", "\n"]), encoding="utf-8")
        want[f"{i}.json"] = [x for x in held if isinstance(x, dict)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = specs.read_specs(spark, str(tmp_path))
        got = {}
        for r in sorted(df.collect(), key=lambda r: (r.file, r.query_index)):
            rows = got.setdefault(r.file.rpartition("/")[2], [])
            rows.append(json.loads(r.raw))
            assert r.query_index == len(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {k: v for k, v in want.items() if v}


def test_one_document_is_many_splits(spark, tmp_path):
    """A document of one line is read by many tasks."""
    body = json.dumps({"generated_queries": [{"query_index": i, "sql": "x" * 200 + "}"} for i in range(20_000)]})
    (tmp_path / "big.json").write_text(body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = specs.read_specs(spark, str(tmp_path), "generated_queries")
        same = F.get_json_object("raw", "$.query_index").cast("bigint") == F.col("query_index") - 1
        assert got.agg(F.count("*"), F.count_if(same)).first()[:] == (20_000, 20_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_identity_follows_python_equality(spark):
    values = ["1", "1.0", "true", '"1"', "0", "false", "null", "2.50", "2.5", '"true"', "10", "100", "1e2"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    ids = {r.i: r.d for r in df.select("i", identity(strict_json(F.col("v"))).alias("d")).collect()}
    for i, a in enumerate(values):
        for j, b in enumerate(values):
            assert (ids[i] == ids[j]) == (json.loads(a) == json.loads(b)), (a, b)


def test_specs_are_walked_once(spark, tmp_path):
    """Passes after the walk read what it found; none walks the text again."""
    (tmp_path / "spec.json").write_text('{"queries": [{"a": 1}, {"a": {"b": 2}}]}')
    found = specs.read_specs(spark, str(tmp_path))
    assert "regexp_extract_all" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r.raw for r in found.orderBy("query_index").collect()] == ['{"a": 1}', '{"a": {"b": 2}}']

import json

from pyspark.sql import functions as F

from driftwell.operators import profiling as pr
from driftwell.operators.widening import type_history
from driftwell.sinks import reports, stores
from driftwell.sources import sse
from driftwell.streaming.ingest import Ingest, build_operations, learn_schema


def frame(event, record):
    return f"event: {event}\ndata: {record if isinstance(record, str) else json.dumps(record)}\n\n"


def test_ingest_restarts_and_equals_batch(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    job = Ingest(str(tmp_path / "out"))
    init = {"username": {"global_key": "true"}, "student_id": {"unique": "true"}}
    first = [frame("init", init)] + [frame("create", {"username": f"u{i}", "student_id": f"S{i % 4}", "credits": i, "meta": {"a": i}}) for i in range(30)]
    (landing / "a.txt").write_text("".join(first) + frame("create", "{oops"))
    job.start(spark, str(landing)).awaitTermination()
    # the second run sees a type drift, a sparse field and no init of its own
    second = [frame("create", {"username": "v", "student_id": "S9", "credits": "many", "extra": 1}), frame("remove", {"username": "v", "student_id": "S1"})]
    (landing / "b.txt").write_text("".join(second))
    job.start(spark, str(landing)).awaitTermination()

    events = job.read_events(spark)
    assert events.count() == 34 and events.select("seq").distinct().count() == 34
    assert sse.dead_letters(events).count() == 1
    stamps = [r.sys_ingested_us for r in events.orderBy("seq").collect()]
    assert all(a < b for a, b in zip(stamps, stamps[1:]))

    records = sse.forwarded(events)
    cells = pr.described_cells(records.select("seq", "record"), "seq", "record")
    whole = pr.final_placement(pr.profile_sums(records, "seq", "record", cells), type_history(cells, ["field"], "seq", "value"))
    kept = {r.field: r.dest for r in job.placement(spark, 1).collect()}
    assert kept == {r.field: r.dest for r in whole.collect()}
    types = {r.field: r.final_type for r in reports.load_state(spark, job.profile, 1).collect()}
    assert types["credits"] == "str" and types["extra"] == "int"

    table = stores.read_relational(spark, f"{job.base}/stores/relational", "root")
    documents = stores.read_documents(spark, f"{job.base}/stores/documents", "root", "seq bigint, document string")
    joined = {r.seq: {**{k: v for k, v in r.asDict().items() if k in ("username", "student_id")}, **json.loads(r.document)} for r in table.join(documents, "seq").collect()}
    want = {r.seq: json.loads(r.j) for r in records.withColumn("j", F.to_json("record")).collect()}
    assert set(joined) == set(want)
    for seq, record in want.items():
        assert joined[seq]["username"] == record["username"] and joined[seq].get("meta") == record.get("meta")

    config = sse.init_config(events).first()
    learned = learn_schema(records, config.unique_fields, config.global_key)
    log = build_operations(events, learned, config.global_key)
    assert {r.type: r.n for r in log.groupBy("type").agg(F.count(F.lit(1)).alias("n")).collect()} == {"INSERT": 5, "UPDATE": 26, "DELETE": 1}


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    rows = [(i, json.dumps({"a": i, "b": "x", "c": {"d": 1}})) for i in range(10)]
    df = spark.createDataFrame(rows, "seq bigint, raw string").select("seq", sse.strict_json(F.col("raw")).alias("record"))
    placement = spark.createDataFrame([("a", "sql"), ("b", "mongodb"), ("c", "mongodb")], "field string, dest string")
    types = spark.createDataFrame([("a", "int"), ("b", "str")], "field string, final_type string")
    for _ in range(2):
        stores.flush(df, "record", placement, types, str(tmp_path), 0, ["seq"])
    table = stores.read_relational(spark, f"{tmp_path}/relational", "root")
    assert sorted((r.seq, r.a) for r in table.collect()) == [(i, i) for i in range(10)]
    docs = stores.read_documents(spark, f"{tmp_path}/documents", "root", "seq bigint, document string")
    assert sorted(json.dumps(json.loads(r.document), sort_keys=True) for r in docs.collect()) == ['{"b": "x", "c": {"d": 1}}'] * 10


def test_records_of_one_split_are_parsed_in_several_tasks(spark, tmp_path):
    lines = [("f", 0, f'data: {{"a":{i}}}') for i in range(200)]
    job = Ingest(str(tmp_path / "job"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        job._keep_events(spark.createDataFrame(lines, "file string, start bigint, line string").coalesce(1), 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(list((tmp_path / "job" / "events" / "batch_id=0").glob("part-*"))) > 2
    assert job.read_events(spark).count() == 200

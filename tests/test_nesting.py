import json
import random

from driftwell.operators import nesting


def python_rows(records):
    """Child rows as a recursion over each record."""
    rows, ids = [], {}

    def visit(table, obj, parent):
        ids[table] = ids.get(table, 0) + 1
        own = ids[table]
        columns, values = [], []
        for k, v in obj.items():
            if isinstance(v, dict):
                columns.append(k)
                values.append(visit(f"{table}_{k}", v, own))
            elif isinstance(v, list) and any(isinstance(x, (dict, list)) for x in v):
                items(f"{table}_{k}", v, own)
            else:
                columns.append(k)
                values.append(v)
        rows.append((table, own, parent, columns, values))
        return own

    def items(table, values, parent):
        for x in values:
            if isinstance(x, dict):
                visit(table, x, parent)
            elif isinstance(x, list):
                items(table, x, parent)

    for r in records:
        visit("root", r, None)
    return rows


def value(rng, depth):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return rng.randrange(9)
    if kind == 1:
        return rng.choice(["{not json}", "[1", "x", ""])
    if kind == 2:
        return None
    if kind == 3:
        return [1, 2]
    if kind == 4:
        return {rng.choice("pqrs"): value(rng, depth + 1) for _ in range(rng.randrange(1, 3))}
    return [{"m": value(rng, depth + 1)} if rng.random() < 0.6 else [{"n": 1}, 5] for _ in range(rng.randrange(1, 3))]


def test_tables_ids_parents_and_inserts(spark):
    rng = random.Random(2)
    records = [{k: value(rng, 0) for k in rng.sample("zyxab", 3)} for _ in range(25)]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "seq bigint, raw string").repartition(3)
    numbered = nesting.number_nodes(nesting.record_nodes(df, "seq", "raw"))
    want = python_rows(records)
    got = sorted((r.table_name, r.table_autogen_id, r.parent_id or 0) for r in numbered.collect())
    assert got == sorted((t, i, p or 0) for t, i, p, _, _ in want)
    ops = nesting.insert_operations(numbered).orderBy("seq", "op_order").collect()
    assert [(r.table_name, r.table_autogen_id, r.columns, [json.loads(v) for v in r["values"]]) for r in ops] == [(t, i, c, v) for t, i, _, c, v in want]


def test_costly_rows_go_to_all_tasks(spark):
    # few bytes in one split: parsing must not stay in its one task
    records = spark.createDataFrame([(i, '{"a":{"b":%d}}' % i) for i in range(200)], "seq bigint, raw string").coalesce(1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        nodes = nesting.record_nodes(records, "seq", "raw")
        assert nesting.node_cells(nodes.coalesce(1)).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert nodes.count() == 400


def test_cells_of_child_tables_are_typed_in_all_tasks(spark, tmp_path, monkeypatch):
    from driftwell.streaming import children

    tasks = []
    monkeypatch.setattr(children, "type_summary", lambda cells, *a, real=children.type_summary, **k: tasks.append(cells.rdd.getNumPartitions()) or real(cells, *a, **k))
    records = spark.createDataFrame([(i, '{"a":%d}' % i) for i in range(200)], "seq bigint, record_text string")
    tables = children.ChildTables(str(tmp_path / "tables"))
    tables.step(spark, records, 0)
    tasks.clear()
    # the rows of a batch lie in one file
    tables.rows(spark, 0).coalesce(1).write.partitionBy("table_name").parquet(str(tmp_path / "tables/rows/batch_id=1"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tables._keep_types(spark, 1)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks[0] > 1
    assert [tuple(r) for r in tables.types(spark, 1).collect()] == [("root", "a", "int")]

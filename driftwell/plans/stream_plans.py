"""Registered queries: streaming forms run to completion and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.functions.payload import strict_json
from driftwell.operators import profiling as pr
from driftwell.operators.dependencies import batch_number
from driftwell.operators.scan import dense_number
from driftwell.operators.widening import type_history
from driftwell.plans.common import change_events, registry, scratch, table
from driftwell.plans.oplog_plans import OPS
from driftwell.session import even_join, materialize
from driftwell.sources import sse
from driftwell.sources.logs import read_operation_log
from driftwell.streaming import incremental
from driftwell.streaming.ingest import Ingest, keep_first_seen, keep_schema
from driftwell.streaming.profiles import SKETCH_BITS, DistinctValues, PlacementLog
from driftwell.streaming.second_stage import SecondStage

PLANS, plan = registry()


def land(spark, sf, path, where="true", end="\n"):
    """SSE files with one frame per event; every eleventh frame is broken."""
    e = table(spark, sf, "events").where(where)
    body = F.to_json(F.struct("event_id", "user_id", "value", F.from_json("props", "k int").alias("props"), F.when(F.col("event_id") % 3 == 0, F.lit("x")).alias("rare")))
    data = F.when(F.col("event_id") % 11 == 0, F.lit("{broken")).otherwise(body)
    kind = F.when(F.col("event_type") == "view", "get").otherwise("create")
    e.select(F.concat(F.lit("event: "), kind, F.lit(f"{end}data: "), data).alias("value")).write.mode("append").option("lineSep", end * 2).text(path)


def ingested(spark, sf, end="\n"):
    """Two landings, the second after the first run has ended: the restart goes on from the checkpoint."""
    landing, job = scratch(spark), Ingest(scratch(spark))
    for where in ("event_type IN ('view', 'click')", "event_type NOT IN ('view', 'click')"):
        land(spark, sf, landing, where, end)
        query = job.start(spark, landing, max_files=1000)
        query.awaitTermination()
    return job


KEPT = "events WHERE event_id % 11 <> 0"


@plan(
    "r7_ingest_event_table",
    f"SELECT event_id, user_id, value, CASE WHEN event_type = 'view' THEN 'get' ELSE 'create' END AS event FROM {KEPT}",
)
def _(spark, sf):
    events = sse.forwarded(ingested(spark, sf).read_events(spark))
    get = lambda n, t: F.variant_get("record", f"$.{n}", t).alias(n)
    return events.select(get("event_id", "bigint"), get("user_id", "bigint"), get("value", "double"), "event")


@plan(
    "r7_ingest_crlf",
    f"SELECT event_id, user_id, value, CASE WHEN event_type = 'view' THEN 'get' ELSE 'create' END AS event FROM {KEPT}",
)
def _(spark, sf):
    """The same text with CRLF line ends."""
    events = sse.forwarded(ingested(spark, sf, "\r\n").read_events(spark))
    get = lambda n, t: F.variant_get("record", f"$.{n}", t).alias(n)
    return events.select(get("event_id", "bigint"), get("user_id", "bigint"), get("value", "double"), "event")


@plan(
    "r2_restart_is_exactly_once",
    "SELECT count(*) AS n, count(*) AS n_seq, count(*) AS n_stamps, count(*) FILTER (event_id % 11 = 0) AS n_broken FROM events",
)
def _(spark, sf):
    events = ingested(spark, sf).read_events(spark)
    return events.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("seq").alias("n_seq"),
        F.countDistinct("sys_ingested_us").alias("n_stamps"), F.count_if(F.col("record").isNull()).alias("n_broken"),
    )


@plan(
    "r5_ingest_profile",
    f"""SELECT f AS field, count(*) AS total_seen, 'int' AS final_type FROM (SELECT unnest(['event_id', 'user_id']) AS f FROM {KEPT}) GROUP BY f
    UNION ALL SELECT 'value', count(*), 'float' FROM {KEPT}
    UNION ALL SELECT 'props', count(*) FILTER (event_id < 0), 'UNK' FROM {KEPT}
    UNION ALL SELECT 'rare', count(*), 'str' FROM {KEPT} AND event_id % 3 = 0""",
)
def _(spark, sf):
    from driftwell.sinks.reports import load_state

    job = ingested(spark, sf)
    return load_state(spark, job.profile, 1).select("field", "total_seen", "final_type")


@plan(
    "r7_ingest_stores",
    f"SELECT event_id, user_id, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 3 = 0 THEN 'x' END AS rare FROM {KEPT}",
)
def _(spark, sf):
    from driftwell.sinks import stores

    base = ingested(spark, sf).base
    relational = stores.read_relational(spark, f"{base}/stores/relational", "root")
    documents = stores.read_documents(spark, f"{base}/stores/documents", "root", "seq bigint, document string")
    return even_join(relational, documents, ["seq"]).select(
        "event_id", "user_id", "value", F.get_json_object("document", "$.props.k").cast("bigint").alias("k"),
        F.get_json_object("document", "$.rare").alias("rare"),
    )


@plan(
    "r1_bounded_micro_batches",
    "SELECT count(*) AS n, true AS bounded FROM events",
)
def _(spark, sf):
    """Lines read one file per micro-batch, their records kept as a table."""
    landing, out = scratch(spark), scratch(spark)
    land(spark, sf, landing, "event_id % 2 = 0")
    land(spark, sf, landing, "event_id % 2 = 1")
    lines = sse.stream_lines(spark, landing, max_files=1)

    def keep(batch, batch_id):
        sse.split_records(batch, F.lit(0)).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    query = lines.writeStream.foreachBatch(keep).option("checkpointLocation", scratch(spark)).trigger(availableNow=True).start()
    query.awaitTermination()
    kept = spark.read.parquet(out)
    return kept.agg(F.count(F.lit(1)).alias("n"), (F.countDistinct("batch_id") > 1).alias("bounded"))


@plan(
    "r3_count_batches",
    "SELECT CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 400) AS BIGINT) AS batch, event_id FROM events",
)
def _(spark, sf):
    numbered = dense_number(table(spark, sf, "events").select("event_id"), "no", "event_id")
    return numbered.select(batch_number(F.col("no"), 400).alias("batch"), "event_id")


def landed_in_turn(spark, parts, schema, step):
    """Land each part, run the stream to its end, and start it anew from its checkpoint for the next part."""
    landing, checkpoint = scratch(spark), scratch(spark)
    for part in parts:
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


@plan("r4_first_seen_over_batches", f"WITH {OPS} SELECT seq, type FROM ops")
def _(spark, sf):
    """A stream of change events in three landings, with the seen keys kept between batches and over restarts."""
    events = change_events(spark, sf)
    keyed = materialize(
        events.select(
            F.lit("user").alias("table_name"), F.get_json_object("record_text", "$.user_id").alias("pk_id"), "seq", "event"
        )
    )
    third = keyed.agg((F.max("seq") / 3 + 1).cast("bigint").alias("n")).scalar()
    base = scratch(spark)
    parts = [keyed.where(F.floor(F.col("seq") / third) == number) for number in range(3)]
    landed_in_turn(spark, parts, keyed.schema, lambda batch, number: keep_first_seen(batch.sparkSession, base, batch, number))
    return spark.read.parquet(f"{base}/typed").select("seq", "type")


def profiled(spark, sf):
    from driftwell.plans.profile_plans import document_records

    return materialize(document_records(spark, sf))


@plan(
    "r5_incremental_profile",
    """WITH d AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT 'lang' AS field, count(*) AS total_seen, count(*) AS present_count, 1 AS alter_count, CAST(sum(length(lang)) AS BIGINT) AS chars, 'str' AS final_type FROM d
    UNION ALL SELECT 'text', count(*), count(*), 1, CAST(sum(length(text)) AS BIGINT), 'str' FROM d
    UNION ALL SELECT 'quality', count(quality), count(quality), 1, 0, 'int' FROM d
    UNION ALL SELECT 'mix', count(*), count(*), 2, count(*) FILTER (doc_id % 7 = 3), 'str' FROM d
    UNION ALL SELECT 'opt', count(*), count(*) FILTER (doc_id % 4 = 1), 1, 0, 'int' FROM d WHERE doc_id % 4 < 2
    UNION ALL SELECT 'source', count(*), count(*), 1, CAST(sum(length(source)) AS BIGINT), 'str' FROM d
    UNION ALL SELECT 'doc_id', count(*), count(*), 1, 0, 'int' FROM d
    UNION ALL SELECT 'toxic', count(toxic), count(toxic), 1, 0, 'int' FROM d
    UNION ALL SELECT 'tags', count(*), count(*), 1, 0, 'list<str>' FROM d
    UNION ALL SELECT 'obj', 0, 0, 1, 0, 'UNK' FROM d HAVING count(*) > 0""",
)
def _(spark, sf):
    records = profiled(spark, sf)
    middle = records.agg((F.max("doc_id") / 2).cast("bigint").alias("m")).scalar()
    state = None
    for late in (False, True):
        part = records.where((F.col("doc_id") > middle) == late)
        state = materialize(incremental.profile_step(state, part, "doc_id", "record"))
    return state.select(
        "field", "total_seen", "present_count", F.col("alter_count").cast("int").alias("alter_count"), "chars", "final_type"
    )


@plan(
    "r5_merged_moments",
    "SELECT lang, count(*) AS n, round(avg(n_chars), 3) AS mean, round(coalesce(var_samp(n_chars), 0), 3) AS variance FROM documents GROUP BY lang",
)
def _(spark, sf):
    d = table(spark, sf, "documents")
    half = lambda p: d.where(F.col("doc_id") % 2 == p).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("mean"), (F.var_pop("n_chars") * F.count(F.lit(1))).alias("m2"))
    a, b = half(0).alias("a"), half(1).alias("b")
    both = a.join(b, "lang", "full_outer")
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    n, mean, m2 = incremental.merge_moments(z("a.n"), z("a.mean"), z("a.m2"), z("b.n"), z("b.mean"), z("b.m2"))
    return both.select(
        "lang", n.cast("bigint").alias("n"), F.round(mean, 3).alias("mean"),
        F.round(F.when(n < 2, 0.0).otherwise(m2 / (n - 1)), 3).alias("variance"),
    )


@plan(
    "r6_schema_evolution",
    "SELECT 'ALTER_TABLE' AS type, 'log' AS table_name, string_agg(event_type, ',' ORDER BY event_type) AS columns FROM (SELECT event_type FROM events GROUP BY 1 HAVING min(event_id) >= 2) HAVING count(*) > 0 "
    "UNION ALL SELECT 'CREATE', 'log', string_agg(DISTINCT event_type, ',' ORDER BY event_type) FROM events WHERE event_id < 2 "
    "UNION ALL SELECT 'CREATE', 'late', string_agg(DISTINCT event_type, ',' ORDER BY event_type) FROM events WHERE event_id >= 2",
)
def _(spark, sf):
    """A stream of columns in two landings with a restart between."""
    e = table(spark, sf, "events")
    seen = lambda df, t: df.select(F.lit(t).alias("table_name"), F.col("event_type").alias("column_name"))
    first, later = seen(e.where("event_id < 2"), "log"), seen(e.where("event_id >= 2"), "log").union(seen(e.where("event_id >= 2"), "late"))
    base = scratch(spark)
    landed_in_turn(spark, [first, later], first.schema, lambda batch, number: keep_schema(batch.sparkSession, base, batch, number))
    changes = spark.read.parquet(f"{base}/changes")
    return changes.groupBy("type", "table_name").agg(F.array_join(F.array_sort(F.flatten(F.collect_list("columns"))), ",").alias("columns"))


def concluded(spark, sf):
    """Creates of users in two landings, the key configuration only in the first, then the second stage."""
    landing, job = scratch(spark), Ingest(scratch(spark))
    init = 'event: init\ndata: {"actor": {"global_key": "true"}, "user_id": {"unique": "true"}}'
    e = table(spark, sf, "events")
    body = F.to_json(F.struct("user_id", (F.col("user_id") % 5).alias("team"), F.lit("a").alias("actor")))
    for late in (False, True):
        frames = e.where((F.col("event_id") % 2 == 1) == late).select(F.concat(F.lit("event: create\ndata: "), body).alias("value"))
        if not late:
            frames = frames.union(spark.createDataFrame([(init,)], "value string"))
        frames.write.mode("append").option("lineSep", "\n\n").text(landing)
        job.start(spark, landing, max_files=1000).awaitTermination()
    job.conclude(spark, 1)
    return job


@plan(
    "r7_operation_log",
    "SELECT type, user_id, count(*) AS n FROM (SELECT user_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1 "
    "THEN 'INSERT' ELSE 'UPDATE' END AS type FROM events) GROUP BY ALL",
)
def _(spark, sf):
    back = read_operation_log(spark, f"{concluded(spark, sf).base}/operations", "actor")
    given = F.try_element_at(F.map_from_arrays("columns", "values"), F.lit("user_id"))
    user = F.try_variant_get(F.coalesce(given, F.try_element_at("where", F.lit("user_id"))), "$", "bigint")
    return back.groupBy("type", user.alias("user_id")).agg(F.count(F.lit(1)).alias("n"))


@plan(
    "r7_schema_document",
    "SELECT 'user' AS table_name, 'user_id' AS primary_key, 'team,user_id' AS columns, count(DISTINCT user_id) > 0 AS filled FROM events",
)
def _(spark, sf):
    job = concluded(spark, sf)
    documents = spark.read.schema("table_name string, primary_key string, columns array<string>").json(f"{job.base}/schema/version=1")
    filled = sse.forwarded(job.read_events(spark)).limit(1).count() > 0
    return documents.select("table_name", "primary_key", F.array_join("columns", ",").alias("columns"), F.lit(filled).alias("filled"))


@plan(
    "r5_stream_equals_batch_placement",
    "SELECT count(*) AS n_fields, 0 AS n_different FROM (VALUES ('doc_id'), ('lang'), ('source'), ('quality'), ('toxic'), ('text'), ('mix'), ('opt'), ('obj'), ('tags')) v(f) "
    "WHERE EXISTS (SELECT 1 FROM documents)",
)
def _(spark, sf):
    """Placement kept over two micro-batches against placement of the whole table."""
    records = profiled(spark, sf)
    middle = records.agg((F.max("doc_id") / 2).cast("bigint").alias("m")).scalar()
    state = None
    for late in (False, True):
        state = materialize(incremental.profile_step(state, records.where((F.col("doc_id") > middle) == late), "doc_id", "record"))
    cells = pr.described_cells(records, "doc_id", "record")
    whole = pr.final_placement(pr.profile_sums(records, "doc_id", "record", cells), type_history(cells, ["field"], "doc_id", "value"))
    both = pr.final_placement(state).join(whole.withColumnRenamed("dest", "batch_dest"), "field", "full_outer")
    return both.agg(
        F.count(F.lit(1)).alias("n_fields"), F.count_if(~F.col("dest").eqNullSafe(F.col("batch_dest"))).cast("int").alias("n_different")
    )


def landed_frames(spark, frames, shares, job):
    """Land frames (order, event, data) in uneven parts, in order, and run the job to its end after each."""
    landing = scratch(spark)
    total = frames.count()
    numbered = materialize(dense_number(frames, "_no", "order"))
    text = F.concat(F.lit("event: "), F.col("event"), F.lit("\ndata: "), F.col("data")).alias("value")
    done = 0
    for share in (*shares, 1.0):
        upto = int(total * share)
        part = numbered.where((F.col("_no") > done) & (F.col("_no") <= upto))
        part.orderBy("_no").select(text).write.mode("append").option("lineSep", "\n\n").text(landing)
        job.start(spark, landing, max_files=1000).awaitTermination()
        done = upto
    return job


def init_frame(spark, **keys):
    """The key configuration, before all other frames."""
    config = "{" + ", ".join(f'"{k}": {{"{v}": "true"}}' for k, v in keys.items()) + "}"
    return spark.createDataFrame([(-1, "init", config)], "order bigint, event string, data string")


def turns(spark, frames, shares):
    """Frames (order, event, data) as events numbered in order, in uneven parts."""
    numbered = materialize(dense_number(frames, "seq", "order").select("seq", "event", "data"))
    total = numbered.count()
    ends = [0, *[int(total * s) for s in shares], total]
    return [numbered.where((F.col("seq") > a) & (F.col("seq") <= b)) for a, b in zip(ends, ends[1:], strict=False)]


def learned_orders(spark, sf):
    """One record per order with its customer, in three uneven landings that end inside windows, learned along."""
    from driftwell.plans.inference_plans import order_texts

    frames = order_texts(spark, sf).select(F.col("o_orderkey").alias("order"), F.lit("create").alias("event"), F.col("raw").alias("data"))
    init = init_frame(spark, username="global_key", c_custkey="unique", o_orderkey="unique")
    stage, kept = SecondStage(scratch(spark), log=False), scratch(spark)

    def step(batch, number):
        sse.normalise_pairs(batch).drop("data").write.mode("overwrite").parquet(f"{kept}/batch_id={number}")
        stage.step(batch.sparkSession, lambda session, i: session.read.parquet(f"{kept}/batch_id={i}"), number)

    landed_in_turn(spark, turns(spark, init.union(frames), (0.09, 0.451)), "seq bigint, event string, data string", step)
    return stage


def _facts_sql():
    from driftwell.plans.inference_plans import IND_SQL, fd_sql, rec_sql

    return (
        f"SELECT 'attribute' AS kind, * FROM (WITH {rec_sql(400)}, {fd_sql('fd')} SELECT DISTINCT key AS a, col AS b FROM fd) "
        f"UNION ALL SELECT 'determines', * FROM (WITH {rec_sql(1000)}, {fd_sql('fd')} SELECT DISTINCT key, col FROM fd) "
        f"UNION ALL SELECT 'included', * FROM (WITH {rec_sql(1000)}, {IND_SQL} SELECT DISTINCT col, ref FROM ind)"
    )


@plan("r7_streamed_facts", _facts_sql())
def _(spark, sf):
    """Dependencies of windows that are carried over three uneven landings."""
    return learned_orders(spark, sf).facts(spark, 2)


OPS_IN_STREAM = f"""WITH {OPS}, places AS (SELECT event_id AS seq, row_number() OVER (ORDER BY event_id) + 1 AS place FROM events)
SELECT place AS seq, type FROM ops JOIN places USING (seq)"""


def logged_changes(spark, sf):
    """Change events in three uneven landings, their operations written along."""
    kinds = change_events(spark, sf).select(F.col("seq").alias("order"), "event")
    body = F.to_json(F.struct("user_id", (F.col("user_id") % 5).alias("team"), F.lit("a").alias("actor")))
    bodies = table(spark, sf, "events").select(F.col("event_id").alias("order"), body.alias("data"))
    frames = even_join(kinds, bodies, ["order"]).select("order", "event", "data")
    init = init_frame(spark, actor="global_key", user_id="unique")
    return landed_frames(spark, init.union(frames), (0.04, 0.6), Ingest(scratch(spark), learn=True))


@plan("r7_streamed_operations", OPS_IN_STREAM)
def _(spark, sf):
    """First-seen keys, numbers and log files go on over landings and restarts."""
    base = logged_changes(spark, sf).base
    lines = spark.read.text(f"{base}/learned/operations").select(F.from_json("value", "type string, op_seq bigint").alias("o"))
    # one entity table and one operation per event, so the n-th operation is that of the n-th event after the init
    return lines.select((F.col("o.op_seq") + 1).alias("seq"), "o.type")


def nested_in_turn(spark, sf):
    """Nested records that name their event, in three uneven landings, as child tables."""
    from driftwell.plans.nesting_plans import nested_records
    from driftwell.streaming.children import ChildTables

    raw = F.concat(F.lit('{"id":'), F.col("seq").cast("string"), F.lit(","), F.substr("raw", F.lit(2)))
    frames = nested_records(spark, sf).select(F.col("seq").alias("order"), F.lit("create").alias("event"), raw.alias("data"))
    tables = ChildTables(scratch(spark))

    def step(batch, number):
        tables.step(batch.sparkSession, batch.select("seq", F.col("data").alias("record_text")), number)

    landed_in_turn(spark, turns(spark, frames, (0.13, 0.7)), "seq bigint, event string, data string", step)
    return tables


@plan(
    "r7_child_tables",
    """WITH p AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) AS pn FROM events WHERE event_type = 'purchase'),
    e AS (SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM events)
    SELECT 'root' AS table_name, event_id AS id, rn AS row_id, CAST(NULL AS BIGINT) AS parent_id, CAST(user_id AS VARCHAR) AS shown FROM e
    UNION ALL SELECT 'root_meta', event_id, rn, rn, event_type FROM e
    UNION ALL SELECT 'root_meta_props', event_id, rn, rn, json_extract_string(props, '$.k') FROM e
    UNION ALL SELECT 'root_items', p.event_id, 2 * pn - 1, e.rn, CAST(p.value AS VARCHAR) FROM p JOIN e USING (event_id)
    UNION ALL SELECT 'root_items', p.event_id, 2 * pn, e.rn, 'x' FROM p JOIN e USING (event_id)""",
)
def _(spark, sf):
    """Rows of four tables with ids that go on over landings, as the stored tables show them."""
    from driftwell.operators.nesting import ROW_ID

    tables = nested_in_turn(spark, sf)
    read = lambda name: tables.read(spark, name, 2)
    root = read("root").select("seq", "id", F.col(ROW_ID).alias("row_id"), "parent_id", F.col("user").cast("string").alias("shown"))
    ids = root.select("seq", "id")
    own = lambda name, column: even_join(read(name), ids, ["seq"]).select(
        F.lit(name).alias("table_name"), "id", F.col(ROW_ID).alias("row_id"), "parent_id", F.col(column).cast("string").alias("shown"))
    parts = [root.select(F.lit("root").alias("table_name"), "id", "row_id", "parent_id", "shown")]
    parts += [own(n, c) for n, c in (("root_meta", "type"), ("root_meta_props", "k"), ("root_items", "p"))]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def profiled_in_turn(spark, sf, step):
    """The profiled records as a stream in three uneven landings with restarts; ``step`` gets records and the batch id."""
    texts = materialize(profiled(spark, sf).select("doc_id", F.to_json("record").alias("raw")))
    last = texts.agg(F.max("doc_id")).first()[0]
    cuts = [0, int(last * 0.07) + 1, int(last * 0.55) + 1, last + 1]
    parts = [texts.where((F.col("doc_id") >= a) & (F.col("doc_id") < b)) for a, b in zip(cuts, cuts[1:], strict=False)]

    def run(batch, number):
        step(batch.sparkSession, batch.select("doc_id", strict_json(F.col("raw")).alias("record")), number)

    landed_in_turn(spark, parts, texts.schema, run)


def _cells_sql(select):
    from driftwell.plans.profile_plans import CELLS

    return f"WITH {CELLS} {select} FROM prof"


@plan("r5_streamed_cardinality", _cells_sql("SELECT field, seen AS total_seen, uniq AS unique_count, round(uniq / seen, 6) AS cardinality_ratio, uniq = seen AS is_unique"))
def _(spark, sf):
    """Exact distinct counts after three landings, from values kept in runs."""
    kept = DistinctValues(scratch(spark))
    profiled_in_turn(spark, sf, lambda session, records, number: kept.step(session, records, "doc_id", "record", number))
    found = kept.exact(spark, 2)
    return found.withColumn("cardinality_ratio", F.round("cardinality_ratio", 6))


@plan("r5_streamed_sketches", _cells_sql("SELECT field, seen AS total_seen, true AS near_exact"))
def _(spark, sf):
    """Merged sketches after three landings, within five standard errors of the exact counts."""
    kept = DistinctValues(scratch(spark))
    profiled_in_turn(spark, sf, lambda session, records, number: kept.step(session, records, "doc_id", "record", number))
    both = kept.estimated(spark, 2).select("field", "total_seen", "unique_estimate").join(kept.exact(spark, 2).select("field", "unique_count"), "field")
    error = 5 * 1.04 / 2 ** (SKETCH_BITS / 2)
    near = F.abs(F.col("unique_estimate") - F.col("unique_count")) <= error * F.col("unique_count")
    return both.select("field", "total_seen", near.alias("near_exact"))


def _replay_sql(select):
    from driftwell.plans.profile_plans import REPLAY

    return f"WITH {REPLAY} {select}"


@plan(
    "r7_streamed_demotions",
    _replay_sql(
        "SELECT field, seq AS doc_id, old_dest, dest AS new_dest FROM (SELECT *, lag(dest) OVER (PARTITION BY field ORDER BY seq) AS old_dest FROM placed) WHERE old_dest <> dest"
    ),
)
def _(spark, sf):
    """Changes of store as records arrive, with running figures carried over three landings."""
    kept = PlacementLog(scratch(spark))
    profiled_in_turn(spark, sf, lambda session, records, number: kept.step(session, records, "doc_id", "record", number))
    return kept.changes(spark).select("field", "doc_id", "old_dest", "new_dest")

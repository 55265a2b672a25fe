"""Registered queries: field profiles and placement."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.functions.payload import is_nested, strict_json
from driftwell.operators import profiling as pr
from driftwell.plans.common import registry, table

PLANS, plan = registry()


def document_records(spark, sf):
    """Documents as open records: sparse labels, a column that drifts, a nullable one, an object, a flat list."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    body = F.to_json(F.struct("doc_id", "lang", "source", "quality", "toxic", "text"))
    n = F.col("doc_id")
    extra = F.concat(
        F.when(n % 7 == 3, F.lit(',"mix":"x"')).otherwise(F.concat(F.lit(',"mix":'), n.cast("string"))),
        F.when(n % 4 == 0, F.lit(',"opt":null')).when(n % 4 == 1, F.lit(',"opt":1')).otherwise(F.lit("")),
        F.lit(',"obj":{"a":1},"tags":["a","b"]}'),
    )
    raw = F.concat(F.substring(body, F.lit(1), F.length(body) - 1), extra)
    return d.select("doc_id", strict_json(raw).alias("record"))


def string(field):
    return f"SELECT doc_id AS seq, '{field}' AS field, 's:' || {field} AS id, false AS z, length({field}) AS len, false AS nested FROM d"


def number(field, where="true"):
    return f"SELECT doc_id, '{field}', 'n:' || {field}, false, NULL, false FROM d WHERE {where}"


CELLS = f"""
d AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
cells AS (
  {string('lang')} UNION ALL {string('source')} UNION ALL {string('text')} UNION ALL {number('doc_id')}
  UNION ALL {number('quality', 'quality IS NOT NULL')} UNION ALL {number('toxic', 'toxic IS NOT NULL')}
  UNION ALL SELECT doc_id, 'mix', CASE WHEN doc_id % 7 = 3 THEN 's:x' ELSE 'n:' || doc_id END, false, CASE WHEN doc_id % 7 = 3 THEN 1 END, false FROM d
  UNION ALL SELECT doc_id, 'opt', CASE WHEN doc_id % 4 = 0 THEN 'z' ELSE 'n:1' END, doc_id % 4 = 0, NULL, false FROM d WHERE doc_id % 4 < 2
  UNION ALL SELECT doc_id, 'obj', NULL, false, NULL, true FROM d
  UNION ALL SELECT doc_id, 'tags', NULL, false, NULL, false FROM d),
total AS (SELECT count(*) AS n FROM documents),
prof AS (
  SELECT field, count(*) AS seen, count(*) FILTER (NOT z) AS present, count(DISTINCT id) AS uniq, count(len) AS samples,
    coalesce(var_samp(len), 0) AS v, coalesce(avg(len), 0) AS m, CASE WHEN field = 'mix' THEN 2 ELSE 1 END AS alters
  FROM cells WHERE NOT nested GROUP BY field)"""


@plan("p1_nested_test", f"WITH {CELLS} SELECT field, bool_or(nested) AS nested FROM cells GROUP BY field")
def _(spark, sf):
    from driftwell.functions.payload import fields

    cells = document_records(spark, sf).select(F.explode(fields(F.col("record"))).alias("field", "value"))
    return cells.groupBy("field").agg(F.bool_or(is_nested(F.col("value"))).alias("nested"))


def profile(spark, sf):
    return pr.profile_fields(document_records(spark, sf), "doc_id", "record")


@plan(
    "p2_presence",
    f"WITH {CELLS} SELECT field, present AS present_count, n AS total_records, round(present / n, 6) AS presence_ratio FROM prof, total",
)
def _(spark, sf):
    return profile(spark, sf).select("field", "present_count", "total_records", F.round("presence_ratio", 6).alias("presence_ratio"))


@plan(
    "p3_cardinality",
    f"WITH {CELLS} SELECT field, seen AS total_seen, uniq AS unique_count, round(uniq / seen, 6) AS cardinality_ratio FROM prof",
)
def _(spark, sf):
    return profile(spark, sf).select("field", "total_seen", "unique_count", F.round("cardinality_ratio", 6).alias("cardinality_ratio"))


@plan("p3_approx_cardinality", f"WITH {CELLS} SELECT field, seen AS total_seen, true AS near_exact FROM prof")
def _(spark, sf):
    """The estimate against the exact count: within five standard errors."""
    rsd = 0.02
    guess = pr.approx_cardinality(document_records(spark, sf), "doc_id", "record", rsd).select("field", "unique_estimate")
    gap = F.abs(F.col("unique_estimate") - F.col("unique_count"))
    near = F.coalesce(gap <= 5 * rsd * F.col("unique_count"), F.lit(True))
    return profile(spark, sf).join(guess, "field", "left").select("field", "total_seen", near.alias("near_exact"))


@plan("p4_uniqueness", f"WITH {CELLS} SELECT field, uniq = seen AS is_unique FROM prof")
def _(spark, sf):
    return profile(spark, sf).select("field", "is_unique")


@plan(
    "p5_type_stability",
    f"WITH {CELLS} SELECT field, alters AS alter_count, round(alters / seen, 6) AS alter_ratio, alters / seen > 0.05 AS is_unstable FROM prof",
)
def _(spark, sf):
    return profile(spark, sf).select("field", F.col("alter_count").cast("int"), F.round("alter_ratio", 6).alias("alter_ratio"), "is_unstable")


@plan("p6_length_variance", f"WITH {CELLS} SELECT field, round(v, 2) AS variance, v > 2000 AS is_high_variance FROM prof")
def _(spark, sf):
    return profile(spark, sf).select("field", "variance", "is_high_variance")


@plan(
    "p10_profile_report",
    f"WITH {CELLS} SELECT field, seen AS total_seen, samples, round(m, 2) AS mean_length, round(v, 2) AS variance, round(sqrt(v), 2) AS std_dev FROM prof",
)
def _(spark, sf):
    return profile(spark, sf).select("field", "total_seen", "samples", "mean_length", "variance", "std_dev")


REPLAY = CELLS + """,
nos AS (SELECT doc_id AS seq, row_number() OVER (ORDER BY doc_id) AS no FROM documents),
run AS (
  SELECT field, seq, nested, len, no,
    count(*) FILTER (NOT nested) OVER w AS seen, count(*) FILTER (NOT nested AND NOT z) OVER w AS present,
    coalesce(var_samp(len) OVER w, 0) AS v, CASE WHEN field = 'mix' AND seq >= 3 THEN 2 ELSE 1 END AS alters
  FROM cells JOIN nos USING (seq) WINDOW w AS (PARTITION BY field ORDER BY seq)),
placed AS (
  SELECT field, seq, seen, present, CASE WHEN nested THEN 'mongodb' WHEN alters / seen > 0.05 THEN 'mongodb'
    WHEN len IS NOT NULL AND v > 2000 THEN 'mongodb' WHEN present / no >= 0.8 THEN 'sql' ELSE 'mongodb' END AS dest FROM run)"""


def replay(spark, sf):
    return pr.placement_replay(document_records(spark, sf), "doc_id", "record")


@plan("p7_running_placement", f"WITH {REPLAY} SELECT field, seq AS doc_id, dest, seen, present FROM placed")
def _(spark, sf):
    return replay(spark, sf).select("field", "doc_id", "dest", "seen", "present")


@plan("p8_last_decision", f"WITH {REPLAY} SELECT field, arg_max(dest, seq) AS dest FROM placed GROUP BY field")
def _(spark, sf):
    return pr.last_decisions(replay(spark, sf), "doc_id")


def final(spark, sf):
    from driftwell.operators.widening import type_history

    records = document_records(spark, sf)
    cells = pr.described_cells(records, "doc_id", "record")
    history = type_history(cells, ["field"], "doc_id", "value")
    return pr.final_placement(pr.profile_sums(records, "doc_id", "record", cells), history)


@plan(
    "p8_final_placement",
    f"WITH {REPLAY} SELECT field, arg_max(dest, seq) AS dest FROM placed GROUP BY field UNION ALL SELECT 'never', 'mongodb'",
)
def _(spark, sf):
    placement = final(spark, sf)
    names = placement.select("field").union(spark.createDataFrame([("never",)], "field string"))
    return pr.placement_of(names, placement)


@plan(
    "p9_reclassified",
    f"WITH {REPLAY} SELECT field, seq AS doc_id, old_dest, dest AS new_dest FROM (SELECT *, lag(dest) OVER (PARTITION BY field ORDER BY seq) AS old_dest FROM placed) WHERE old_dest <> dest",
)
def _(spark, sf):
    return pr.reclassified(replay(spark, sf), "doc_id")


@plan(
    "p11_vertical_split",
    f"WITH {REPLAY}, last AS (SELECT field, arg_max(dest, seq) AS dest FROM placed GROUP BY field) "
    "SELECT seq AS doc_id, coalesce(string_agg(field, ',' ORDER BY field) FILTER (dest = 'sql'), '') AS relational, "
    "coalesce(string_agg(field, ',' ORDER BY field) FILTER (dest = 'mongodb'), '') AS document "
    "FROM cells JOIN last USING (field) GROUP BY seq",
)
def _(spark, sf):
    split = pr.split_payload(document_records(spark, sf), final(spark, sf), "record")
    names = lambda c: F.array_join(F.array_sort(F.map_keys(c)), ",").alias(c)
    return split.select("doc_id", names("relational"), names("document"))


@plan("p11_split_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def _(spark, sf):
    placement = {"o_custkey": pr.RELATIONAL, "o_totalprice": pr.RELATIONAL}
    left, right = pr.split_by_store(table(spark, sf, "orders"), placement, ["o_orderkey"])
    return left.join(right, "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")

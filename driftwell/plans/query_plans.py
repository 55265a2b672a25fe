"""Registered queries: scan to limit."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.operators.catalog import Catalog, declared_columns
from driftwell.operators.query import get_documents, nest_children, relation_join, run_changes, run_spec, select_related
from driftwell.operators.validate import parse_specs, validate_specs
from driftwell.plans.common import catalog, registry, table
from driftwell.sources.logs import read_table

PLANS, plan = registry()


@plan("s11_table_scan", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, sf):
    return read_table(spark, f"{sf}/customer.parquet", ["c_custkey", "c_name", "c_mktsegment"])


@plan("q1_projection", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, sf):
    return select_related(catalog(spark, sf), "orders", ["o_orderkey", "o_custkey", "o_totalprice"])


@plan("q1_projection_all", "SELECT * FROM supplier")
def _(spark, sf):
    return select_related(catalog(spark, sf), "supplier", ["*"])


@plan(
    "q2_qualified_field",
    "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 5000",
)
def _(spark, sf):
    return select_related(
        catalog(spark, sf), "orders", ["o_orderkey", "customer.c_name"], {"customer.c_acctbal": {"$gt": 5000}}
    )


@plan(
    "q2_nested_path",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props__k FROM events "
    "WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50",
)
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("props", F.from_json("props", "k bigint"))
    return get_documents(e, ["event_id", "props.k"], {"props.k": {"$gte": 50}})


@plan("q3_equality", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    return select_related(catalog(spark, sf), "orders", ["o_orderkey", "o_orderstatus"], {"o_orderstatus": "F"})


@plan("q3_null_equality_sql", "SELECT o_orderkey FROM orders WHERE o_orderstatus = NULL")
def _(spark, sf):
    return select_related(catalog(spark, sf), "orders", ["o_orderkey"], {"o_orderstatus": None})


def labelled(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")


LABELLED = "(SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


@plan("q3_null_equality_document", f"SELECT doc_id, lang FROM {LABELLED} WHERE quality IS NULL")
def _(spark, sf):
    return get_documents(labelled(spark, sf), ["doc_id", "lang"], {"quality": None})


@plan(
    "q4_range",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 10 AND l_quantity <= 20 "
    "AND l_discount >= 0.02 AND l_discount < 0.07",
)
def _(spark, sf):
    return select_related(
        catalog(spark, sf), "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"],
        {"l_quantity": {"$gt": 10, "$lte": 20}, "l_discount": {"$gte": 0.02, "$lt": 0.07}},
    )


@plan("q5_not_equal", f"SELECT doc_id, quality FROM {LABELLED} WHERE quality <> 1")
def _(spark, sf):
    return get_documents(labelled(spark, sf), ["doc_id", "quality"], {"quality": {"$ne": 1}})


@plan("q6_in", "SELECT p_partkey, p_brand, p_size FROM part WHERE p_size IN (1, 5, 9, 50)")
def _(spark, sf):
    return select_related(catalog(spark, sf), "part", ["p_partkey", "p_brand", "p_size"], {"p_size": {"$in": [1, 5, 9, 50]}})


@plan(
    "q7_conjunction",
    "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice >= 100000 AND o_totalprice < 200000 "
    "AND o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def _(spark, sf):
    return select_related(
        catalog(spark, sf), "orders", ["o_orderkey"],
        {"o_orderstatus": {"$ne": "P"}, "o_totalprice": {"$gte": 100000, "$lt": 200000},
         "o_orderpriority": {"$in": ["1-URGENT", "2-HIGH"]}},
    )


@plan(
    "q8_left_fk_join",
    "SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON c_custkey = o_custkey "
    "UNION ALL SELECT -1 - s_suppkey, s_name, NULL, NULL FROM supplier",
)
def _(spark, sf):
    """All customers, and suppliers as customers that have no orders."""
    whole = catalog(spark, sf)
    idle = whole["supplier"].select((-F.col("s_suppkey") - 1).alias("c_custkey"), F.col("s_name").alias("c_name"))
    both = whole["customer"].unionByName(idle, allowMissingColumns=True)
    c = Catalog({"customer": both, "orders": whole["orders"]}, whole.primary_keys, [k for k in whole.foreign_keys if (k.table, k.ref_table) == ("orders", "customer")])
    return select_related(c, "customer", ["c_custkey", "c_name", "orders.o_orderkey", "orders.o_totalprice"])


@plan(
    "q9_fk_path_join",
    "SELECT l_orderkey, l_linenumber, r_name, n_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey "
    "LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE l_quantity > 45",
)
def _(spark, sf):
    return select_related(
        catalog(spark, sf), "lineitem", ["l_orderkey", "l_linenumber", "region.r_name", "nation.n_name"],
        {"l_quantity": {"$gt": 45}},
    )


@plan(
    "q9_junction_path",
    "SELECT o_orderkey, p_name FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey "
    "LEFT JOIN part ON l_partkey = p_partkey WHERE o_totalprice > 490000",
)
def _(spark, sf):
    return select_related(catalog(spark, sf), "orders", ["o_orderkey", "part.p_name"], {"o_totalprice": {"$gt": 490000}})


@plan(
    "q9_grouped_path_topk",
    "SELECT n_name, count(o_orderkey) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders "
    "LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey "
    "WHERE o_totalprice > 50000 GROUP BY n_name ORDER BY n_orders DESC, n_name LIMIT 10",
)
def nation_orders(spark, sf):
    return select_related(
        catalog(spark, sf), "orders",
        ["nation.n_name", "COUNT(orders.o_orderkey) AS n_orders", "ROUND(SUM(orders.o_totalprice), 2) AS total"],
        {"o_totalprice": {"$gt": 50000}}, ["nation.n_name"], ["-n_orders", "n_name"], 10,
    )


@plan(
    "q10_inner_relation",
    "SELECT n_nationkey, n_name, c_custkey FROM nation JOIN customer ON n_nationkey = c_nationkey",
)
def _(spark, sf):
    return relation_join(catalog(spark, sf), "nation", "customer").select("n_nationkey", "n_name", "c_custkey")


@plan(
    "q11_group_by",
    'SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source',
)
def _(spark, sf):
    return get_documents(table(spark, sf, "documents"), ["COUNT(doc_id)"], group_by=["lang", "source"]).withColumnRenamed(
        "COUNT(doc_id)", "n"
    )


@plan(
    "q12_count_rows_and_values",
    f"SELECT source, count(*) AS n_rows, count(quality) AS n_values FROM {LABELLED} GROUP BY source",
)
def _(spark, sf):
    d = labelled(spark, sf)
    rows = get_documents(d, ["COUNT(quality)"], group_by=["source"]).withColumnRenamed("COUNT(quality)", "n_rows")
    values = select_related(
        catalog(spark, sf).with_table("documents", d), "documents", ["source", "COUNT(quality) AS n_values"],
        group_by=["source"],
    )
    return rows.join(values, "source")


@plan(
    "q13_representative",
    "SELECT source, arg_min(lang, doc_id) AS lang, min(doc_id) AS doc_id FROM documents GROUP BY source",
)
def _(spark, sf):
    return get_documents(table(spark, sf, "documents"), ["lang", "doc_id"], group_by=["source"], first_by="doc_id")


@plan(
    "q14_aggregate_passthrough",
    "SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, "
    "round(avg(l_quantity), 4) AS avg_qty, min(l_tax) AS min_tax, max(l_tax) AS max_tax, "
    "count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY l_returnflag",
)
def _(spark, sf):
    return select_related(
        catalog(spark, sf), "lineitem",
        ["l_returnflag", "ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue",
         "ROUND(AVG(l_quantity), 4) AS avg_qty", "MIN(l_tax) AS min_tax", "MAX(l_tax) AS max_tax",
         "COUNT(DISTINCT l_suppkey) AS n_suppliers"],
        group_by=["l_returnflag"],
    )


@plan(
    "q15_sort",
    f"SELECT doc_id, quality FROM {LABELLED} ORDER BY quality DESC NULLS LAST, doc_id",
)
def _(spark, sf):
    return get_documents(labelled(spark, sf), ["doc_id", "quality"], sort=["-quality", ("doc_id", 1)])


@plan("q16_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(spark, sf):
    return select_related(catalog(spark, sf), "orders", ["o_orderkey", "o_totalprice"], sort=["-o_totalprice", "+o_orderkey"], limit=25)


@plan("q16_limit_ignored", "SELECT n_nationkey FROM nation")
def _(spark, sf):
    return select_related(catalog(spark, sf), "nation", ["n_nationkey"], sort=["n_nationkey"], limit=0)


@plan(
    "q17_nested_result",
    "SELECT c_custkey, CAST(floor((rn - 1) / 5) AS BIGINT) AS page, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) "
    "AS orders FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) "
    "JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2 "
    "UNION ALL SELECT c_custkey, 0, '' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
)
def _(spark, sf):
    c = catalog(spark, sf)
    nested = nest_children(
        c["customer"].select("c_custkey"), c["orders"].select("o_orderkey", "o_custkey", "o_totalprice"),
        "c_custkey", "o_custkey", "o_orderkey", "orders", page_rows=5,
    )
    return nested.withColumn("orders", F.array_join(F.transform("orders", lambda o: o["o_orderkey"].cast("string")), ","))


@plan(
    "q18_dispatch_get",
    "SELECT c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal DESC, c_name LIMIT 20",
)
def _(spark, sf):
    return run_spec(
        catalog(spark, sf),
        {"action": "get", "entity": "customer", "fields": ["c_name", "c_acctbal"], "where": {"c_mktsegment": "BUILDING"},
         "options": {"sort": ["-c_acctbal", "c_name"], "limit": 20}},
    )


@plan(
    "q18_dispatch_change",
    "SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey = 3 THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer",
)
def _(spark, sf):
    return run_spec(
        catalog(spark, sf),
        {"action": "change", "entity": "customer", "where": {"c_nationkey": 3}, "data": {"c_acctbal": 0.0}},
    )


@plan("q18_dispatch_remove", "SELECT * FROM customer WHERE NOT (c_acctbal < 0)")
def _(spark, sf):
    return run_spec(catalog(spark, sf), {"action": "remove", "entity": "customer", "where": {"c_acctbal": {"$lt": 0}}})


@plan(
    "q18_dispatch_add",
    "SELECT 'customer' AS table_name, c_custkey AS id, CAST(NULL AS BIGINT) AS parent, CAST(NULL AS BIGINT) AS points FROM customer UNION ALL SELECT 'customer', 99000001, NULL, 5 "
    "UNION ALL SELECT 'orders', o_orderkey, o_custkey, NULL FROM orders UNION ALL SELECT 'orders', 99000002, 99000001, NULL "
    "UNION ALL SELECT 'lineitem', l_orderkey, l_linenumber, NULL FROM lineitem UNION ALL SELECT 'lineitem', 99000002, 1, NULL",
)
def _(spark, sf):
    """A record with a new field and two levels of child records."""
    record = {"c_custkey": 99000001, "c_name": "New", "points": 5, "orders": [{"o_orderkey": 99000002, "o_totalprice": 1.5, "lineitem": [{"l_linenumber": 1}]}]}
    states = run_changes(catalog(spark, sf), {"action": "add", "entity": "customer", "data": record})
    none = F.lit(None).cast("bigint")
    parts = {
        "customer": ("c_custkey", none, F.col("points")), "orders": ("o_orderkey", F.col("o_custkey"), none),
        "lineitem": ("l_orderkey", F.col("l_linenumber").cast("bigint"), none),
    }
    rows = [states[t].select(F.lit(t).alias("table_name"), F.col(i).alias("id"), p.alias("parent"), n.alias("points")) for t, (i, p, n) in parts.items()]
    return rows[0].union(rows[1]).union(rows[2])


@plan(
    "q18_dispatch_nest",
    "SELECT c_custkey, c_name, count(o_orderkey) AS n, coalesce(round(sum(o_totalprice), 2), 0) AS total FROM customer "
    "LEFT JOIN orders ON o_custkey = c_custkey WHERE c_acctbal > 0 GROUP BY ALL",
)
def _(spark, sf):
    nested = run_spec(catalog(spark, sf), {"action": "get", "entity": "customer", "fields": ["c_name"], "where": {"c_acctbal": {"$gt": 0}}, "options": {"nest": "orders"}})
    prices = F.aggregate("orders", F.lit(0.0), lambda a, o: a + o["o_totalprice"])
    return nested.select("c_custkey", "c_name", F.size("orders").alias("n"), prices.alias("p")).groupBy("c_custkey", "c_name").agg(
        F.sum("n").alias("n"), F.round(F.sum("p"), 2).alias("total")
    )


@plan(
    "q18_dispatch_cascade",
    "SELECT 'customer' AS table_name, c_custkey AS id FROM customer WHERE NOT (c_nationkey = 4) UNION ALL "
    "SELECT 'orders', o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 4)",
)
def _(spark, sf):
    states = run_changes(catalog(spark, sf), {"action": "remove", "entity": "customer", "where": {"c_nationkey": 4}, "options": {"cascade": True}})
    pick = lambda t, c: states[t].select(F.lit(t).alias("table_name"), F.col(c).alias("id"))
    return pick("customer", "c_custkey").union(pick("orders", "o_orderkey"))


# one spec per order, some of them wrong, against the declared schema of two tables
DECLARED = (
    '{"orders": {"o_orderkey": ["BIGINT", "PRIMARY KEY"], "o_custkey": ["BIGINT", "FK -> customer(c_custkey)"], '
    '"o_totalprice": ["DECIMAL(12,2)"]}, "customer": {"c_custkey": ["BIGINT", "PRIMARY KEY"], "c_name": ["VARCHAR(25)"]}, '
    '"lineitem": {"l_orderkey": ["BIGINT", "FK -> orders(o_orderkey)"], "l_linenumber": ["INT"], '
    '"table@constraints": ["PRIMARY KEY (l_orderkey, l_linenumber)"]}}'
)


def spec_texts(spark, sf):
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    spec = (
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit('{"action":"add","entity":"orders","data":{"o_orderkey":'), key, F.lit(',"o_custkey":1}}')))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit('{"action":"add","entity":"orders","data":[{"o_custkey":1,"colour":"red"}]}'))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit('{"action":"get","entity":"customer","fields":["c_name","c_age","COUNT(c_custkey)","orders.o_orderkey"],"where":{"c_custkey":'), key, F.lit(',"size":2}}')))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit('{"action":"remove","entity":"orders","where":{}}'))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit('{"action":"change","entity":"orders","where":{"o_orderkey":1},"data":{"weight":2}}'))
        .otherwise(F.lit('{"action":"drop","entity":"nowhere"}'))
    )
    return o.select(F.col("o_orderkey").alias("query_index"), spec.alias("raw"))


@plan(
    "q19_spec_validation",
    """
    WITH s AS (SELECT o_orderkey AS query_index, CASE WHEN o_orderstatus = 'O' THEN 'ok' ELSE o_orderpriority END AS c FROM orders)
    SELECT query_index, 'table ''orders'' has no column ''colour'' (in record 0)' AS error FROM s WHERE c = '1-URGENT'
    UNION ALL SELECT query_index, 'record 0 lacks key column ''o_orderkey''' FROM s WHERE c = '1-URGENT'
    UNION ALL SELECT query_index, 'table ''customer'' has no column ''c_age'' (in fields)' FROM s WHERE c = '2-HIGH'
    UNION ALL SELECT query_index, 'table ''customer'' has no column ''size'' (in where)' FROM s WHERE c = '2-HIGH'
    UNION ALL SELECT query_index, '''remove'' has no condition' FROM s WHERE c = '3-MEDIUM'
    UNION ALL SELECT query_index, 'table ''orders'' has no column ''weight'' (in data)' FROM s WHERE c = '5-LOW'
    UNION ALL SELECT query_index, 'action ''drop'' is not known' FROM s WHERE c NOT IN ('ok', '1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
    """,
)
def _(spark, sf):
    declared = declared_columns(spark.createDataFrame([(DECLARED,)], "value string"))
    return validate_specs(parse_specs(spec_texts(spark, sf)), declared)

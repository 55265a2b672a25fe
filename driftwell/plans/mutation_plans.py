"""Registered queries: table states after mutations (M1–M7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.operators import mutate
from driftwell.operators.catalog import Catalog, ForeignKey
from driftwell.plans.common import catalog, registry, scratch
from driftwell.sinks.touched import FileTable

PLANS, plan = registry()


@plan(
    "m1_insert",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer UNION ALL "
    "SELECT 1000000 + s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier UNION ALL "
    "SELECT 9000000, 'New', NULL, 1.5, NULL",
)
def _(spark, sf):
    c = catalog(spark, sf)
    suppliers = c["supplier"].select(
        (F.lit(1000000) + F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
    )
    state = mutate.insert(c["customer"], suppliers)
    return mutate.insert(state, {"c_custkey": 9000000, "c_name": "New", "c_acctbal": 1.5})


@plan("m1_inserted_count", "SELECT count(*) AS inserted_count FROM orders")
def _(spark, sf):
    return mutate.inserted_count(catalog(spark, sf)["orders"])


@plan(
    "m2_nested_insert",
    "SELECT 'customer' AS table_name, c_custkey AS a, CAST(NULL AS BIGINT) AS b FROM customer "
    "UNION ALL SELECT 'customer', 5000000 + s_suppkey, NULL FROM supplier "
    "UNION ALL SELECT 'orders', o_orderkey, o_custkey FROM orders "
    "UNION ALL SELECT 'orders', 70000000 + 10 * s_suppkey + i, 5000000 + s_suppkey FROM supplier, (VALUES (0), (1)) v(i)",
)
def _(spark, sf):
    c = catalog(spark, sf)
    key = F.col("s_suppkey")
    records = c["supplier"].select(
        (F.lit(5000000) + key).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.array(*[F.struct((F.lit(70000000) + 10 * key + i).alias("o_orderkey"), F.lit("N").alias("o_orderstatus")) for i in (0, 1)]).alias("orders"),
        F.array(F.struct(key.alias("x"))).alias("unknown_children"),
    )
    states = mutate.nested_insert(c, "customer", records, {"c_custkey": "o_custkey"})
    return states["customer"].select(F.lit("customer").alias("table_name"), F.col("c_custkey").alias("a"), F.lit(None).cast("bigint").alias("b")).union(
        states["orders"].select(F.lit("orders"), "o_orderkey", "o_custkey")
    )


@plan(
    "m2_two_levels",
    "SELECT 'orders' AS table_name, o_orderkey AS a, o_custkey AS b FROM orders "
    "UNION ALL SELECT 'orders', 70000000 + s_suppkey, 5000000 + s_suppkey FROM supplier "
    "UNION ALL SELECT 'lineitem', l_orderkey, l_linenumber FROM lineitem "
    "UNION ALL SELECT 'lineitem', 70000000 + s_suppkey, i FROM supplier, (VALUES (1), (2)) v(i)",
)
def _(spark, sf):
    c, key = catalog(spark, sf), F.col("s_suppkey")
    lines = F.array(*[F.struct(F.lit(i).alias("l_linenumber")) for i in (1, 2)]).alias("lineitem")
    records = c["supplier"].select(
        (F.lit(5000000) + key).alias("c_custkey"), F.array(F.struct((F.lit(70000000) + key).alias("o_orderkey"), lines)).alias("orders")
    )
    states = mutate.nested_insert(c, "customer", records)
    return states["orders"].select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("b")).union(
        states["lineitem"].select(F.lit("lineitem"), "l_orderkey", F.col("l_linenumber").cast("bigint"))
    )


WHERE_M3 = {"o_orderpriority": "5-LOW", "o_totalprice": {"$lt": 100000}}
M3_SQL = "o_orderpriority = '5-LOW' AND o_totalprice < 100000"


@plan(
    "m3_update_many",
    f"SELECT o_orderkey, CASE WHEN {M3_SQL} THEN 'X' ELSE o_orderstatus END AS o_orderstatus, "
    f"CASE WHEN {M3_SQL} THEN 'yes' END AS flagged FROM orders",
)
def _(spark, sf):
    state = mutate.update(catalog(spark, sf)["orders"], WHERE_M3, {"o_orderstatus": "X", "flagged": "yes"}).state
    return state.select("o_orderkey", "o_orderstatus", "flagged")


@plan(
    "m3_update_counts",
    "SELECT count(*) AS matched_count, count(*) FILTER (o_orderstatus IS DISTINCT FROM 'F') AS modified_count "
    f"FROM orders WHERE {M3_SQL}",
)
def _(spark, sf):
    return mutate.update(catalog(spark, sf)["orders"], WHERE_M3, {"o_orderstatus": "F"}).counts


@plan(
    "m4_update_one",
    "SELECT c_custkey, CASE WHEN c_custkey = (SELECT min(c_custkey) FROM customer WHERE c_nationkey = 7) THEN 'FIRST' "
    "ELSE c_mktsegment END AS c_mktsegment FROM customer",
)
def _(spark, sf):
    return mutate.update(
        catalog(spark, sf)["customer"], {"c_nationkey": 7}, {"c_mktsegment": "FIRST"}, multi=False, key="c_custkey"
    ).state.select("c_custkey", "c_mktsegment")


@plan(
    "m5_upsert_missing",
    "SELECT p_partkey, p_name, p_size FROM part UNION ALL SELECT -5, 'fresh', 3 "
    "WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = -5)",
)
def _(spark, sf):
    return mutate.update(
        catalog(spark, sf)["part"], {"p_partkey": -5}, {"p_name": "fresh", "p_size": 3}, upsert=True
    ).state.select("p_partkey", "p_name", "p_size")


@plan("m5_upsert_present", "SELECT p_partkey, CASE WHEN p_size = 10 THEN 'ten' ELSE p_name END AS p_name FROM part")
def _(spark, sf):
    return mutate.update(catalog(spark, sf)["part"], {"p_size": 10}, {"p_name": "ten"}, upsert=True).state.select(
        "p_partkey", "p_name"
    )


@plan(
    "m5_upsert_rows",
    "WITH n AS (SELECT o_custkey * 2 AS c_custkey, round(sum(o_totalprice), 2) AS c_acctbal FROM orders GROUP BY 1) "
    "SELECT coalesce(c.c_custkey, n.c_custkey) AS c_custkey, c.c_name, "
    "CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE c.c_acctbal END AS c_acctbal "
    "FROM customer c FULL OUTER JOIN n ON c.c_custkey = n.c_custkey",
)
def _(spark, sf):
    c = catalog(spark, sf)
    incoming = c["orders"].groupBy((F.col("o_custkey") * 2).alias("c_custkey")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("c_acctbal")
    )
    return mutate.upsert_rows(c["customer"].select("c_custkey", "c_name", "c_acctbal"), incoming, ["c_custkey"])


@plan(
    "m5_repeated_keys",
    "WITH n AS (SELECT o_custkey AS c_custkey, arg_max(o_totalprice, o_orderkey) AS c_acctbal FROM orders GROUP BY 1) "
    "SELECT coalesce(c.c_custkey, n.c_custkey) AS c_custkey, c.c_name, CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE c.c_acctbal END AS c_acctbal "
    "FROM customer c FULL OUTER JOIN n ON c.c_custkey = n.c_custkey",
)
def _(spark, sf):
    """Every order is one incoming row of its customer; the latest counts."""
    c = catalog(spark, sf)
    incoming = c["orders"].select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), "o_orderkey")
    return mutate.upsert_rows(c["customer"].select("c_custkey", "c_name", "c_acctbal"), incoming, ["c_custkey"], "o_orderkey")


@plan(
    "m5_touched_files",
    "WITH u AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey < 1000 AND o_orderstatus = 'O' THEN 'X' ELSE o_orderstatus END AS o_orderstatus "
    "FROM orders WHERE NOT (o_orderkey >= 3000 AND o_orderkey < 4000)), "
    "n AS (SELECT s_suppkey * 2 AS o_orderkey FROM supplier) "
    "SELECT coalesce(u.o_orderkey, n.o_orderkey) AS o_orderkey, u.o_custkey, "
    "CASE WHEN n.o_orderkey IS NOT NULL THEN 'N' ELSE u.o_orderstatus END AS o_orderstatus FROM u FULL OUTER JOIN n ON u.o_orderkey = n.o_orderkey",
)
def _(spark, sf):
    """Update, delete and upsert of a stored table, each rewriting the files it touches."""
    c = catalog(spark, sf)
    stored = FileTable(spark, scratch(spark), "o_orderkey").create(c["orders"].select("o_orderkey", "o_custkey", "o_orderstatus"))
    stored.update({"o_orderkey": {"$lt": 1000}, "o_orderstatus": "O"}, {"o_orderstatus": "X"})
    stored.delete({"o_orderkey": {"$gte": 3000, "$lt": 4000}})
    stored.upsert(c["supplier"].select((F.col("s_suppkey") * 2).alias("o_orderkey"), F.lit("N").alias("o_orderstatus")))
    return stored.read()


@plan("m6_delete_many", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_orderstatus = 'O' AND o_totalprice > 200000)")
def _(spark, sf):
    return mutate.delete(
        catalog(spark, sf)["orders"], {"o_orderstatus": "O", "o_totalprice": {"$gt": 200000}}
    ).state.select("o_orderkey", "o_totalprice")


@plan("m6_deleted_count", "SELECT count(*) AS deleted_count FROM orders WHERE o_orderstatus IN ('O', 'P')")
def _(spark, sf):
    return mutate.delete(catalog(spark, sf)["orders"], {"o_orderstatus": {"$in": ["O", "P"]}}).counts


@plan(
    "m6_delete_one",
    "SELECT c_custkey FROM customer WHERE c_custkey <> (SELECT min(c_custkey) FROM customer WHERE c_acctbal < 0)",
)
def _(spark, sf):
    return mutate.delete(
        catalog(spark, sf)["customer"], {"c_acctbal": {"$lt": 0}}, multi=False, key="c_custkey"
    ).state.select("c_custkey")


@plan(
    "m7_cascade_delete",
    "SELECT 'customer' AS table_name, c_custkey AS id FROM customer WHERE NOT (c_nationkey = 4) UNION ALL "
    "SELECT 'orders', o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 4)",
)
def _(spark, sf):
    states = mutate.cascade_delete(catalog(spark, sf), "customer", {"c_nationkey": 4})
    ids = {"customer": "c_custkey", "orders": "o_orderkey"}
    return reduce(DataFrame.union, [states[t].select(F.lit(t).alias("table_name"), F.col(c).alias("id")) for t, c in ids.items()])


@plan(
    "m7_null_operand",
    "WITH c AS (SELECT c_custkey, CASE WHEN c_nationkey <> 4 THEN c_nationkey END AS nation FROM customer) "
    "SELECT 'customer' AS table_name, c_custkey AS id FROM c WHERE nation IS NOT NULL UNION ALL "
    "SELECT 'orders', o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c WHERE nation IS NOT NULL) "
    "UNION ALL SELECT 'sql rule', count(*) FROM c",
)
def _(spark, sf):
    """A null operand removes parents and children alike, or neither under the SQL rule."""
    whole = catalog(spark, sf)
    customer = whole["customer"].select("c_custkey", F.when(F.col("c_nationkey") != 4, F.col("c_nationkey")).alias("nation"))
    c = Catalog({"customer": customer, "orders": whole["orders"]}, whole.primary_keys, [ForeignKey("orders", "o_custkey", "customer", "c_custkey")])
    states = mutate.cascade_delete(c, "customer", {"nation": None})
    kept = mutate.cascade_delete(c, "customer", {"nation": None}, document=False)["customer"]
    pick = lambda t, k: states[t].select(F.lit(t).alias("table_name"), F.col(k).alias("id"))
    return pick("customer", "c_custkey").union(pick("orders", "o_orderkey")).union(kept.agg(F.lit("sql rule").alias("table_name"), F.count(F.lit(1)).alias("id")))


@plan(
    "m7_cascade_targets",
    "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 4)",
)
def _(spark, sf):
    return mutate.cascade_targets(catalog(spark, sf), "customer", {"c_nationkey": 4})["orders"].select("o_orderkey")

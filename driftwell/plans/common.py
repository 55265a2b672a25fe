"""Inputs the registered queries share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.operators.catalog import Catalog, ForeignKey, StoredTables
from driftwell.session import shared_dir, spread
from driftwell.sources.sse import normalise_pairs

PRIMARY_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"],
}
FOREIGN_KEYS = [
    ForeignKey("nation", "n_regionkey", "region", "r_regionkey"),
    ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
    ForeignKey("supplier", "s_nationkey", "nation", "n_nationkey"),
    ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
    ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ForeignKey("lineitem", "l_partkey", "part", "p_partkey"),
    ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"),
]


def registry() -> tuple[dict, Callable]:
    """A dictionary name → (query, oracle SQL or None) and the decorator that fills it."""
    plans: dict = {}

    def plan(name: str, sql: str | None = None) -> Callable:
        def keep(fn: Callable) -> Callable:
            plans[name] = (fn, sql)
            return fn

        return keep

    return plans, plan


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def catalog(spark: SparkSession, sf: str) -> Catalog:
    return Catalog(StoredTables(spark, sf, list(PRIMARY_KEYS)), PRIMARY_KEYS, FOREIGN_KEYS)


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared directory of the session."""
    return f"{shared_dir(spark)}/driftwell-{uuid.uuid4().hex}"


def micros(stamp: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast({stamp} as timestamp_ntz))")


def change_events(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as change events: seq, event, record_text, record.

    signup and purchase are adds, click a change, error a remove, view a get.
    """
    e = spread(table(spark, sf, "events"), "event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    event = (
        F.when(kind.isin("signup", "purchase"), "add").when(kind == "click", "change")
        .when(kind == "error", "remove").otherwise("get")
    )
    record = F.to_json(
        F.struct(
            "user_id",
            F.when(kind != "error", F.concat(F.lit("agent"), (F.col("event_id") % 7).cast("string"))).alias("agent"),
            F.when(kind.isin("signup", "purchase", "click"), F.col("value")).alias("value"),
            F.when(kind.isin("signup", "purchase"), k).alias("k"),
            F.when(kind == "purchase", F.concat(F.lit("it's "), k.cast("string"))).alias("note"),
            F.when(kind == "view", F.array(F.lit("value"), F.lit("note"), F.lit("none"))).alias("COLUMNS"),
        )
    )
    return normalise_pairs(e.select(F.col("event_id").alias("seq"), event.alias("event"), record.alias("data"))).drop("data")


# the same change events for the oracle: one row per event with the fields it carries
CHANGE_SQL = """
ev AS (
  SELECT event_id AS seq, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_type IN ('signup','purchase') THEN 'add' WHEN event_type = 'click' THEN 'change'
              WHEN event_type = 'error' THEN 'remove' ELSE 'get' END AS event
  FROM events)"""

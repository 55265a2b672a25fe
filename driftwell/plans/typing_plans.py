"""Registered queries: type resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.functions import coerce
from driftwell.functions.payload import strict_json
from driftwell.operators.scan import dense_number
from driftwell.operators.widening import drift_log, resolve, type_history
from driftwell.plans.common import registry, table

PLANS, plan = registry()


def raw_texts(spark, sf):
    """A text per event, in every form the scalar rules tell apart."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    form = F.col("event_id") % 9
    v = (
        F.when(form == 0, k).when(form == 1, F.col("value").cast("string")).when(form == 2, F.lit("Yes"))
        .when(form == 3, F.lit("FALSE")).when(form == 4, F.concat(k, F.lit("d"))).when(form == 5, F.lit("y"))
        .when(form == 6, F.concat(F.lit(" -"), k, F.lit(" "))).when(form == 7, (F.col("event_id") % 2).cast("string"))
        .otherwise(F.concat(F.lit(".5e"), (F.col("event_id") % 3).cast("string")))
    )
    return e.select("event_id", v.alias("v"))


RAW = """
raw AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN json_extract_string(props, '$.k') WHEN 1 THEN CAST(value AS VARCHAR) WHEN 2 THEN 'Yes'
  WHEN 3 THEN 'FALSE' WHEN 4 THEN json_extract_string(props, '$.k') || 'd' WHEN 5 THEN 'y' WHEN 6 THEN ' -' || json_extract_string(props, '$.k') || ' '
  WHEN 7 THEN CAST(event_id % 2 AS VARCHAR) ELSE '.5e' || (event_id % 3) END AS v FROM events)"""


@plan("t1_boolean_test", f"WITH {RAW} SELECT event_id, lower(v) IN ('true','1','yes','false','0','no') AS is_boolean FROM raw")
def _(spark, sf):
    return raw_texts(spark, sf).select("event_id", coerce.is_boolean_text(F.col("v")).alias("is_boolean"))


@plan(
    "t2_boolean_convert",
    f"WITH {RAW} SELECT event_id, CASE WHEN lower(v) IN ('true','1','yes') THEN true WHEN lower(v) IN ('false','0','no') THEN false END AS b FROM raw",
)
def _(spark, sf):
    return raw_texts(spark, sf).select("event_id", coerce.to_boolean(F.col("v")).alias("b"))


@plan(
    "t3_first_value_inference",
    f"""WITH {RAW} SELECT event_id, CASE WHEN regexp_full_match(v, '\\s*[+-]?[0-9]+\\s*') THEN 'int'
    WHEN regexp_full_match(v, '\\s*[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*') THEN 'float'
    WHEN lower(v) IN ('true','yes','false','no') THEN 'bool' ELSE 'str' END AS first_type FROM raw""",
)
def _(spark, sf):
    cells = raw_texts(spark, sf).withColumn("value", F.to_variant_object(F.array("v"))).withColumn(
        "value", F.variant_get("value", "$[0]", "variant")
    )
    return coerce.with_traits(cells, "value").select("event_id", F.col("traits.first").alias("first_type"))


@plan(
    "t4_cast_to_int",
    f"""WITH {RAW} SELECT event_id, CASE WHEN regexp_full_match(v, '\\s*[+-]?[0-9]+\\s*') THEN TRY_CAST(trim(v) AS BIGINT) END AS from_text,
    CAST(trunc(value) AS BIGINT) AS from_number FROM raw JOIN events USING (event_id)""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    return raw_texts(spark, sf).join(e, "event_id").select(
        "event_id", coerce.to_integer(F.col("v")).alias("from_text"), F.col("value").cast("bigint").alias("from_number")
    )


@plan(
    "t5_cast_to_float",
    f"""WITH {RAW} SELECT event_id, CASE WHEN regexp_full_match(v, '\\s*[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*')
    THEN TRY_CAST(trim(v) AS DOUBLE) END AS f FROM raw""",
)
def _(spark, sf):
    return raw_texts(spark, sf).select("event_id", coerce.to_float(F.col("v")).alias("f"))


@plan(
    "t6_strict_integer",
    "SELECT event_id, CASE WHEN value * 4 = floor(value * 4) THEN CAST(value * 4 AS BIGINT) END AS i FROM events",
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", coerce.strict_integer(F.col("value") * 4).alias("i"))


@plan(
    "t8_list_normalise",
    "SELECT event_id, CASE event_type WHEN 'view' THEN '1|' || user_id WHEN 'click' THEN 'a|' || user_id || '|true' "
    "WHEN 'error' THEN '' END AS items FROM events",
)
def _(spark, sf):
    u = F.col("user_id").cast("string")
    kind = F.col("event_type")
    v = (
        F.when(kind == "view", F.concat(F.lit("[1, "), u, F.lit("]")))
        .when(kind == "click", F.concat(F.lit("['a', "), u, F.lit(", True]")))
        .when(kind == "error", F.lit(" [] ")).when(kind == "signup", F.lit("{\"a\": [1]}")).otherwise(F.lit("[1, 2"))
    )
    items = F.transform(coerce.list_from_text(v), lambda x: F.variant_get(x, "$", "string"))
    return table(spark, sf, "events").select("event_id", F.array_join(items, "|").alias("items"))


@plan(
    "t9_list_convert",
    "SELECT event_id, CASE WHEN event_type = 'view' THEN user_id || ',7' END AS ints, "
    "CASE WHEN event_type IN ('view', 'click') THEN CAST(user_id AS DOUBLE) + CASE WHEN event_type = 'view' THEN 7 ELSE 0.5 END END AS float_sum FROM events",
)
def _(spark, sf):
    u = F.col("user_id").cast("string")
    kind = F.col("event_type")
    v = (
        F.when(kind == "view", F.concat(F.lit("["), u, F.lit(', "7"]')))
        .when(kind == "click", F.concat(F.lit("["), u, F.lit(", 0.5]")))
        .otherwise(F.concat(F.lit("["), u, F.lit(', "x"]')))
    )
    e = table(spark, sf, "events").select("event_id", F.parse_json(v).alias("v"))
    as_type = lambda t: coerce.converted(
        F.lit(t), F.schema_of_variant("v"), F.lit(None).cast("string"), coerce.elements(F.col("v")))["list_value"]
    floats = F.aggregate(as_type("list<float>"), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return e.select("event_id", F.array_join(as_type("list<int>"), ",").alias("ints"), floats.alias("float_sum"))


def drifting(spark, sf):
    """One column per user, whose values widen as events of other kinds come in."""
    kind = F.col("event_type")
    v = (
        F.when(kind == "signup", F.lit("true")).when(kind == "click", (F.col("user_id") % 5).cast("string"))
        .when(kind == "purchase", F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"')))
        .when(kind == "error", F.lit("null")).otherwise(F.lit('"yes"'))
    )
    return table(spark, sf, "events").select("user_id", F.col("event_id").alias("seq"), F.parse_json(v).alias("v"))


# classes: b true, z 0 or 1, i other int, f float text, w yes
WIDEN = """
WITH RECURSIVE c AS (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i,
    CASE event_type WHEN 'signup' THEN 'b' WHEN 'click' THEN CASE WHEN user_id % 5 < 2 THEN 'z' ELSE 'i' END WHEN 'purchase' THEN 'f' ELSE 'w' END AS c
  FROM events WHERE event_type <> 'error'),
r AS (
  SELECT user_id, event_id, i, CAST('UNK' AS VARCHAR) AS old_type,
    CASE c WHEN 'b' THEN 'bool' WHEN 'w' THEN 'bool' WHEN 'f' THEN 'float' ELSE 'int' END AS new_type FROM c WHERE i = 1
  UNION ALL
  SELECT c.user_id, c.event_id, c.i, r.new_type,
    CASE r.new_type
      WHEN 'bool' THEN CASE c.c WHEN 'i' THEN 'int' WHEN 'f' THEN 'float' ELSE 'bool' END
      WHEN 'int' THEN CASE c.c WHEN 'f' THEN 'float' WHEN 'w' THEN 'str' ELSE 'int' END
      WHEN 'float' THEN CASE c.c WHEN 'w' THEN 'str' ELSE 'float' END
      ELSE 'str' END
  FROM r JOIN c ON c.user_id = r.user_id AND c.i = r.i + 1)
"""


@plan("t7_type_widening", WIDEN + "SELECT user_id, arg_max(new_type, i) AS final_type FROM r GROUP BY user_id")
def _(spark, sf):
    return type_history(drifting(spark, sf), ["user_id"], "seq", "v").select("user_id", "final_type")


@plan(
    "t13_drift_log",
    WIDEN + "SELECT user_id, event_id AS seq, old_type, new_type FROM r WHERE old_type <> new_type AND old_type <> 'UNK'",
)
def _(spark, sf):
    return drift_log(type_history(drifting(spark, sf), ["user_id"], "seq", "v"), ["user_id"])


@plan(
    "t7_resolved_values",
    WIDEN + """SELECT r.user_id, r.event_id AS seq, r.new_type AS resolved_type,
      CASE r.new_type WHEN 'int' THEN CASE e.event_type WHEN 'signup' THEN 1 WHEN 'click' THEN e.user_id % 5 END END AS int_value,
      CASE r.new_type WHEN 'float' THEN CASE e.event_type WHEN 'signup' THEN 1.0 WHEN 'click' THEN CAST(e.user_id % 5 AS DOUBLE) ELSE e.value END END AS float_value,
      CASE r.new_type WHEN 'bool' THEN CASE e.event_type WHEN 'click' THEN e.user_id % 5 = 1 ELSE true END END AS bool_value,
      CASE r.new_type WHEN 'str' THEN CASE e.event_type WHEN 'signup' THEN 'True' WHEN 'click' THEN CAST(e.user_id % 5 AS VARCHAR)
        WHEN 'view' THEN 'yes' ELSE CAST(e.value AS VARCHAR) END END AS str_value
    FROM r JOIN events e USING (event_id)
    UNION ALL SELECT user_id, event_id, NULL, NULL, NULL, NULL, NULL FROM events WHERE event_type = 'error'""",
)
def _(spark, sf):
    out = resolve(drifting(spark, sf), ["user_id"], "seq", "v")
    # a null has no value under any type, so its type is not compared
    shown = F.when(F.schema_of_variant("v") != "VOID", F.col("resolved_type"))
    return out.select("user_id", "seq", shown.alias("resolved_type"), "int_value", "float_value", "bool_value", "str_value")


def drifting_lists(spark, sf):
    kind, u = F.col("event_type"), F.col("user_id").cast("string")
    v = (
        F.when(kind == "signup", F.concat(F.lit("[1, "), u, F.lit("]"))).when(kind == "click", F.lit("[]"))
        .when(kind == "purchase", F.concat(F.lit("["), F.col("value").cast("string"), F.lit(", 0.5]")))
        .when((kind == "error") & (F.col("user_id") % 3 == 0), F.lit('["a"]')).otherwise(F.lit("null"))
    )
    return table(spark, sf, "events").select("user_id", F.col("event_id").alias("seq"), F.parse_json(v).alias("v"))


@plan(
    "t10_list_subtype_widening",
    """WITH f AS (SELECT user_id, min(event_id) FILTER (event_type = 'signup') AS s, min(event_id) FILTER (event_type = 'purchase') AS p,
      min(event_id) FILTER (event_type = 'error' AND user_id % 3 = 0) AS e, min(event_id) FILTER (event_type = 'click') AS c FROM events GROUP BY user_id)
    SELECT user_id, CASE WHEN e IS NOT NULL THEN 'list<str>' WHEN p IS NOT NULL THEN 'list<float>' WHEN s IS NOT NULL THEN 'list<int>'
      ELSE 'list<UNK>' END AS final_type FROM f WHERE coalesce(s, p, e, c) IS NOT NULL""",
)
def _(spark, sf):
    return type_history(drifting_lists(spark, sf), ["user_id"], "seq", "v").select("user_id", "final_type")


@plan(
    "t11_null_and_empty_list",
    "SELECT user_id, min(event_id) AS seq, 'list<UNK>' AS new_type FROM events WHERE event_type = 'click' GROUP BY user_id",
)
def _(spark, sf):
    kind = F.col("event_type")
    cells = table(spark, sf, "events").select(
        "user_id", F.col("event_id").alias("seq"),
        F.parse_json(F.when(kind == "click", F.lit("[]")).otherwise(F.lit("null"))).alias("v"),
    )
    history = type_history(cells, ["user_id"], "seq", "v")
    return history.select("user_id", F.explode("changes").alias("c")).select("user_id", "c.seq", "c.new_type")


@plan(
    "t12_auto_increment_id",
    "SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS id FROM events",
)
def _(spark, sf):
    return dense_number(table(spark, sf, "events").select("event_id", "event_type"), "id", "event_id", ["event_type"], block_bits=12).select("event_id", "id")


@plan("s6_strict_json", "SELECT event_id, event_type NOT IN ('view', 'error') AS parses FROM events")
def _(spark, sf):
    kind = F.col("event_type")
    text = F.when(kind == "view", F.concat(F.col("props"), F.lit(" junk"))).when(kind == "error", F.concat(F.col("props"), F.lit(", {}"))).otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", strict_json(text).isNotNull().alias("parses"))

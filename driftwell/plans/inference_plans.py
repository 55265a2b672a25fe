"""Registered queries: dependencies and schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.functions.payload import strict_json
from driftwell.operators import catalog as cat
from driftwell.operators import dependencies as dep
from driftwell.operators import schema
from driftwell.operators.scan import dense_number
from driftwell.plans.common import catalog, registry, table
from driftwell.session import even_join, materialize

PLANS, plan = registry()


DETERMINES = [
    ("customer", "c_custkey", "c_name"), ("customer", "c_nationkey", "c_name"), ("nation", "n_nationkey", "n_regionkey"),
    ("part", "p_brand", "p_type"), ("orders", "o_orderkey", "o_custkey"), ("lineitem", "l_linenumber", "l_orderkey"),
]


@plan(
    "i1_functional_dependency",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{a}' AS a, '{b}' AS b, max(n) = 1 AS is_dependent FROM (SELECT {a}, count(DISTINCT {b}) AS n FROM {t} GROUP BY {a})"
        for t, a, b in DETERMINES
    ),
)
def _(spark, sf):
    c = catalog(spark, sf)
    tested = [
        dep.determines(c[t], a, b).select(F.lit(t).alias("table_name"), F.lit(a).alias("a"), F.lit(b).alias("b"), "is_dependent")
        for t, a, b in DETERMINES
    ]
    return reduce(DataFrame.unionAll, tested)


KEYS = ["c_custkey", "o_orderkey"]
COLUMNS = {"c_custkey": "n", "o_orderkey": "n", "c_name": "s", "c_nationkey": "n", "c_mktsegment": "s",
           "o_orderstatus": "s", "first_in_batch": "n", "near": "n"}


def order_texts(spark, sf):
    """One open record per order with its customer, as text; some fields are absent in some records."""
    c = catalog(spark, sf)
    joined = c["orders"].hint("merge").join(c["customer"].hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_orderkey")
    raw = F.to_json(
        F.struct(
            "c_custkey", "o_orderkey", "c_name", "c_nationkey",
            F.when(key % 3 == 0, F.col("c_mktsegment")).alias("c_mktsegment"), "o_orderstatus",
            (key - key % 1000).alias("first_in_batch"),
            F.when(key % 5 == 0, key - F.when(key % 1000 < 10, 0).otherwise(10)).alias("near"),
            F.concat(F.lit("u"), key.cast("string")).alias("username"),
        )
    )
    return joined.select("o_orderkey", raw.alias("raw"))


def order_records(spark, sf):
    return order_texts(spark, sf).select("o_orderkey", strict_json(F.col("raw")).alias("record"))


def numbered(spark, sf):
    # numbering needs the order only; the records join it
    numbers = dense_number(table(spark, sf, "orders").select("o_orderkey"), "no", "o_orderkey")
    return even_join(order_records(spark, sf), numbers, ["o_orderkey"])


def batched(records, size):
    return records.withColumn("batch", dep.batch_number(F.col("no"), size))


def rec_sql(size):
    return f"""
rec AS (SELECT CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / {size}) AS BIGINT) AS batch, c_custkey, o_orderkey, c_name, c_nationkey,
  CASE WHEN o_orderkey % 3 = 0 THEN c_mktsegment END AS c_mktsegment, o_orderstatus, o_orderkey - o_orderkey % 1000 AS first_in_batch,
  CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey - CASE WHEN o_orderkey % 1000 < 10 THEN 0 ELSE 10 END END AS near
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def fd_sql(name):
    return f"{name} AS (" + " UNION ALL ".join(
        f"SELECT batch, '{k}' AS key, '{c}' AS col FROM (SELECT batch, {k}, min({c}) AS lo, max({c}) AS hi FROM rec WHERE {c} IS NOT NULL GROUP BY batch, {k}) "
        "GROUP BY batch HAVING bool_and(lo = hi)"
        for k in KEYS for c in COLUMNS if c != k
    ) + ")"


IND_SQL = "ind AS (" + " UNION ALL ".join(
    f"SELECT a.batch, '{c}' AS col, '{k}' AS ref FROM (SELECT DISTINCT batch, {c} AS v FROM rec WHERE {c} IS NOT NULL) a "
    f"LEFT JOIN (SELECT DISTINCT batch, {k} AS v FROM rec) b ON a.batch = b.batch AND a.v = b.v GROUP BY a.batch HAVING count(b.v) = count(*)"
    for k in KEYS for c, t in COLUMNS.items() if c not in KEYS and t == "n"
) + ")"


def attributes(records):
    return dep.window_dependencies(batched(records, dep.ENTITY_BATCH), "batch", "record", KEYS, "username")


@plan("i2_entity_attributes", f"WITH {rec_sql(400)}, {fd_sql('fd')} SELECT DISTINCT key, col AS \"column\" FROM fd")
def _(spark, sf):
    return dep.ever(attributes(numbered(spark, sf)))


def mined(records):
    return dep.window_dependencies(batched(records, dep.RELATION_BATCH), "batch", "record", KEYS, "username")


@plan("i3_fd_mining_per_batch", f"WITH {rec_sql(1000)}, {fd_sql('fd')} SELECT batch, key, col AS \"column\" FROM fd")
def _(spark, sf):
    return mined(numbered(spark, sf))


@plan("i3_fd_mining_whole_table", f"WITH {rec_sql(10**12)}, {fd_sql('fd')} SELECT key, col AS \"column\" FROM fd")
def _(spark, sf):
    whole = order_records(spark, sf).withColumn("batch", F.lit(0).cast("bigint"))
    return dep.ever(dep.functional_dependencies(whole, "batch", "record", KEYS, "username"))


def inclusions(records):
    return dep.window_inclusions(batched(records, dep.RELATION_BATCH), "batch", "record", KEYS, "username")


@plan("i4_inclusion_dependencies", f"WITH {rec_sql(1000)}, {IND_SQL} SELECT batch, col AS \"column\", ref AS \"references\" FROM ind")
def _(spark, sf):
    return inclusions(numbered(spark, sf))


TYPED = [("customer", "c_custkey"), ("orders", "o_custkey"), ("nation", "n_nationkey"), ("customer", "c_nationkey"),
         ("supplier", "s_nationkey"), ("region", "r_regionkey"), ("nation", "n_regionkey"), ("part", "p_size")]
REFERRED = [("customer", "c_custkey"), ("nation", "n_nationkey"), ("region", "r_regionkey")]


@plan(
    "i4_table_inclusions",
    " UNION ALL ".join(
        f"SELECT '{t}.{c}' AS \"column\", '{rt}.{rc}' AS \"references\" WHERE NOT EXISTS (SELECT 1 FROM {t} WHERE {c} NOT IN (SELECT {rc} FROM {rt}))"
        for t, c in TYPED if (t, c) not in REFERRED for rt, rc in REFERRED
    ),
)
def _(spark, sf):
    c = catalog(spark, sf)
    return dep.table_inclusions({(t, col): c[t] for t, col in TYPED}, REFERRED)


def basket_records(spark, sf):
    """Orders with the list of their parts, and parts as records of their own."""
    c = catalog(spark, sf)
    # an order has at most seven lines
    baskets = c["lineitem"].groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_partkey")).alias("p"))
    orders = baskets.select(
        F.col("l_orderkey").alias("seq"),
        F.to_json(F.struct(F.col("l_orderkey").alias("order_id"), F.col("p").alias("part_id"), (F.col("l_orderkey") % 4).alias("lane"))).alias("raw"),
    )
    parts = c["part"].select(
        (F.lit(10**9) + F.col("p_partkey")).alias("seq"),
        F.to_json(F.struct(F.col("p_partkey").alias("part_id"), "p_name", "p_size")).alias("raw"),
    )
    return orders.union(parts).select("seq", strict_json(F.col("raw")).alias("record"))


@plan("i5_list_columns", "SELECT 'part_id' AS \"column\" FROM lineitem LIMIT 1")
def _(spark, sf):
    return dep.list_columns(basket_records(spark, sf), "record")


OWNERS = f"""{rec_sql(400)}, {fd_sql('fd')}, attrs AS (SELECT DISTINCT key, col FROM fd),
sizes AS (SELECT key, count(*) AS n FROM attrs GROUP BY key),
owner AS (SELECT col, key FROM attrs JOIN sizes USING (key) QUALIFY row_number() OVER (PARTITION BY col ORDER BY n DESC, key) = 1)"""


@plan("i6_column_owners", f"WITH {OWNERS} SELECT key, col AS \"column\" FROM owner")
def _(spark, sf):
    return schema.column_owners(materialize(dep.ever(attributes(numbered(spark, sf)))))


TABLES = """tabs AS (SELECT DISTINCT lower(replace(key, '_id', '')) AS table_name, key AS primary_key, col AS column_name
  FROM (SELECT key, col FROM owner UNION ALL SELECT * FROM (VALUES ('c_custkey', 'c_custkey'), ('o_orderkey', 'o_orderkey')) v(key, col)))"""


def tables(records):
    # the tables read the attributes several times; they are mined once
    return schema.entity_tables(materialize(dep.ever(attributes(records))), KEYS)


@plan("i7_entity_tables", f"WITH {OWNERS}, {TABLES} SELECT * FROM tabs")
def _(spark, sf):
    return tables(numbered(spark, sf))


def baskets_junction(spark, sf):
    records = basket_records(spark, sf)
    found = dep.ever(dep.functional_dependencies(records.withColumn("batch", F.lit(0)), "batch", "record", ["order_id", "part_id"]))
    owners = schema.list_owners(records, "record", ["order_id", "part_id"], dep.list_columns(records, "record"), found)
    return schema.junction_tables(owners)


@plan(
    "i8_junction_tables",
    "SELECT 'order_part' AS table_name, 'order_id' AS owner, 'part_id' AS list_column, 'order' AS owner_table, 'part' AS list_table FROM lineitem LIMIT 1",
)
def _(spark, sf):
    return baskets_junction(spark, sf)


@plan(
    "i8_junction_rows",
    "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS part_id FROM lineitem",
)
def _(spark, sf):
    return schema.junction_rows(basket_records(spark, sf), "record", "order_id", "part_id")


FOREIGN = f"""{rec_sql(400)}, {fd_sql('fd')}, attrs AS (SELECT DISTINCT key, col FROM fd),
sizes AS (SELECT key, count(*) AS n FROM attrs GROUP BY key),
owner AS (SELECT col, key FROM attrs JOIN sizes USING (key) QUALIFY row_number() OVER (PARTITION BY col ORDER BY n DESC, key) = 1), {TABLES},
rec2 AS (SELECT * REPLACE (CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1000) AS BIGINT) AS batch) FROM rec), {IND_SQL.replace('FROM rec', 'FROM rec2')},
fks AS (SELECT DISTINCT t.table_name, ind.col AS column_name, r.table_name AS references_table, ind.ref AS references_column
  FROM ind JOIN tabs t ON t.column_name = ind.col JOIN tabs r ON r.primary_key = ind.ref)"""


@plan("i9_foreign_keys", f"WITH {FOREIGN} SELECT * FROM fks")
def _(spark, sf):
    # both miners read the same stored records
    records = materialize(dep.described(numbered(spark, sf), "record", "username"))
    return schema.foreign_keys(tables(records), dep.ever(inclusions(records)))


@plan(
    "i10_schema_changes",
    "SELECT 'CREATE' AS type, 'lineitem' AS table_name, 'l_orderkey,l_partkey' AS columns FROM lineitem LIMIT 1",
)
def _(spark, sf):
    # columns seen in the first thousand orders against those seen in all, with their line items as a new table
    def columns_of(df, name):
        return df.select(F.explode(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in df.columns])).alias("column_name")).where(
            "column_name is not null"
        ).distinct().select(F.lit(name).alias("table_name"), "column_name")

    c = catalog(spark, sf)
    before = columns_of(c["orders"].select("o_orderkey", "o_custkey"), "orders")
    now = columns_of(c["orders"].select("o_orderkey", "o_custkey"), "orders").union(
        columns_of(c["lineitem"].select("l_orderkey", "l_partkey"), "lineitem")
    )
    return schema.schema_changes(before, now).withColumn("columns", F.array_join("columns", ","))


@plan(
    "i10_added_columns",
    "SELECT 'ALTER_TABLE' AS type, 'documents' AS table_name, c AS columns FROM (VALUES ('quality'), ('toxic')) v(c)",
)
def _(spark, sf):
    def columns_of(df):
        present = [F.max(F.when(F.col(c).isNotNull(), c)).alias(c) for c in df.columns]
        return df.agg(*present).select(F.explode(F.array(*df.columns)).alias("column_name")).where("column_name is not null").select(
            F.lit("documents").alias("table_name"), "column_name"
        )

    d = table(spark, sf, "documents").select("doc_id", "lang")
    return schema.schema_changes(
        columns_of(d), columns_of(d.join(table(spark, sf, "labels"), "doc_id", "left"))
    ).withColumn("columns", F.array_join("columns", ","))


@plan(
    "i11_schema_assembly",
    f"""WITH {FOREIGN}, big AS (SELECT * EXCLUDE (batch), batch FROM rec2), {fd_sql('fd2').replace('FROM rec', 'FROM rec2')}
    SELECT 'tables' AS section, table_name AS name, column_name AS item, CASE WHEN column_name = primary_key THEN 'PRIMARY KEY' END AS detail FROM tabs
    UNION ALL SELECT DISTINCT 'functional_dependencies', key, col, NULL FROM fd2
    UNION ALL SELECT 'foreign_keys', table_name, column_name, references_table || '(' || references_column || ')' FROM fks""",
)
def _(spark, sf):
    records = materialize(dep.described(numbered(spark, sf), "record", "username"))
    entities = tables(records)
    foreign = schema.foreign_keys(entities, dep.ever(inclusions(records)))
    return schema.assemble(entities, dep.ever(mined(records)), foreign, dep.list_columns(records, "record", "username"))


@plan(
    "i12_declared_schema",
    """SELECT 't' || c_custkey AS table_name, column_name, data_type, is_primary_key, CASE WHEN column_name = 'home' THEN 'n' || c_nationkey END AS ref_table,
    CASE WHEN column_name = 'home' THEN 'key' END AS ref_column FROM customer,
    (VALUES ('id', 'BIGINT', true), ('home', 'INT', false), ('name', 'VARCHAR(25)', false), ('line', 'INT', true)) v(column_name, data_type, is_primary_key)""",
)
def _(spark, sf):
    """One declared document per customer, each with a table of its own."""
    c = table(spark, sf, "customer")
    text = F.concat(
        F.lit('{"t'), F.col("c_custkey").cast("string"), F.lit('": {"id": ["BIGINT", "PRIMARY KEY"], "home": ["INT", "FK -> n'), F.col("c_nationkey").cast("string"),
        F.lit('(key)"], "name": ["VARCHAR(25)"], "line": ["INT"], "table@constraints": ["PRIMARY KEY (id, line)"]}}'),
    )
    return cat.declared_columns(c.select(text.alias("value")))

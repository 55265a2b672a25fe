"""Functional and inclusion dependencies, list columns.

Batches are runs of N consecutive records. All pairs of columns are tested in
one job: the keys travel as data, and every step groups on values, so that hot
batches and hot columns are reduced before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from driftwell.functions.payload import each, elements, fields, fixed_width, identity, is_list, once, short_identity, short_identity_of_json

ENTITY_BATCH, RELATION_BATCH = 400, 1000


def batch_number(record_no: Column, size: int) -> Column:
    """Batch of the n-th record, n from 1."""
    return F.floor((record_no - 1) / size)


def by_window(records: DataFrame, batch: str = "batch") -> DataFrame:
    """Records with each window in one place, so that what is grouped by window later needs no other exchange.

    For windows of bounded length only: a record travels once, instead of one row per pair of its columns.
    """
    return records.repartition(batch)


def described(records: DataFrame, payload: str, global_key: str | None = None) -> DataFrame:
    """Records whose payload is what the miners read of it, once: array of (field, listed, ids).

    ``ids`` are the bounded identities of the value, or of the elements of a list
    that are no lists. Where several miners read the same records, all of them take
    this form in place of the VARIANT.
    """
    return records.withColumn(payload, _cells(payload, global_key))


def is_described(records: DataFrame, payload: str) -> bool:
    return isinstance(records.schema[payload].dataType, ArrayType)


def _texts(payload: str) -> Column:
    """The fields of a record as structs: field, value, its JSON text, which is taken once and tells all the rest."""
    return F.transform(F.map_entries(fields(F.col(payload))), lambda e: F.struct(e["key"].alias("field"), e["value"].alias("value"), F.to_json(e["value"]).alias("text")))


def _cells(payload: str, global_key: str | None) -> Column:
    return F.transform(
        _without(_texts(payload), global_key),
        lambda e: F.struct(
            e["field"].alias("field"), e["text"].startswith("[").alias("listed"),
            F.when(
                e["text"].startswith("["),
                F.transform(F.filter(elements(e["value"]), lambda x: ~is_list(x)), lambda x: once(F.to_json(x), short_identity_of_json)),
            ).otherwise(F.array(short_identity_of_json(e["text"]))).alias("ids"),
        ),
    )


def _without(cells: Column, global_key: str | None) -> Column:
    return F.filter(cells, lambda e: e["field"] != F.lit(global_key)) if global_key else cells


def _entries(payload: str, global_key: str | None) -> Column:
    """The fields of a record as structs: field, bounded identity of the value, two hashes of it, whether a list.

    Hashes are taken once per cell, before cells are paired.
    """
    return F.transform(
        _without(_texts(payload), global_key),
        lambda e: once(
            short_identity_of_json(e["text"]),
            lambda t: F.struct(
                e["field"].alias("field"), t.alias("id"), *[h.alias(n) for n, h in zip(("h1", "h2"), fixed_width(t), strict=True)],
                e["text"].startswith("[").alias("listed"),
            ),
        ),
    )


def _one_value(identity_text: Column) -> Column:
    """Whether all texts of a group are equal, from fixed-width values, so that no text is kept or sorted."""
    first, second = fixed_width(identity_text)
    return (F.min(first) == F.max(first)) & (F.min(second) == F.max(second))


def determines(df: DataFrame, left: str, right: str) -> DataFrame:
    """Whether column ``left`` determines ``right`` in a typed table: one row."""
    shown = lambda c: F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("z"))
    per_value = df.select(short_identity(shown(left)).alias("a"), shown(right).alias("b")).groupBy("a").agg(_one_value(F.col("b")).alias("one"))
    return per_value.agg(F.coalesce(F.bool_and("one"), F.lit(False)).alias("is_dependent"))


def dependency_partials(
    records: DataFrame, batch: str, payload: str, keys: list[str], global_key: str | None = None
) -> DataFrame:
    """What records say on which columns a key determines: per batch, key, value of the key and column the span of two hashes.

    Partials of parts of a batch are merged by ``merged_dependencies``.
    """
    entries = F.filter(_entries(payload, global_key), lambda e: ~e["listed"])
    cells = records.select(F.col(batch).cast("bigint").alias("batch"), entries.alias("e"))
    rows = each(each(cells, F.filter("e", lambda e: e["field"].isin(keys)), "k"), F.col("e"), "c").drop("e")
    pairs = rows.where(F.col("c.field") != F.col("k.field"))
    return pairs.groupBy(
        "batch", F.col("k.field").alias("key"), F.col("k.id").alias("key_id"), F.col("c.field").alias("column")
    ).agg(
        F.min("c.h1").alias("low1"), F.max("c.h1").alias("high1"), F.min("c.h2").alias("low2"), F.max("c.h2").alias("high2")
    )


def merged_dependencies(partials: DataFrame) -> DataFrame:
    """Partials of several parts as one."""
    return partials.groupBy("batch", "key", "key_id", "column").agg(
        F.min("low1").alias("low1"), F.max("high1").alias("high1"), F.min("low2").alias("low2"), F.max("high2").alias("high2")
    )


def held_dependencies(partials: DataFrame) -> DataFrame:
    """batch, key, column of what every value of the key bears out."""
    one = (F.col("low1") == F.col("high1")) & (F.col("low2") == F.col("high2"))
    return partials.groupBy("batch", "key", "column").agg(F.bool_and(one).alias("holds")).where("holds").drop("holds")


def functional_dependencies(
    records: DataFrame, batch: str, payload: str, keys: list[str], global_key: str | None = None
) -> DataFrame:
    """Columns each key determines, per batch: batch, key, column.

    Only records with both columns count; nulls are values; lists are left out.
    """
    return held_dependencies(dependency_partials(records, batch, payload, keys, global_key))


def _named(records: DataFrame, batch: str, payload: str, keys: list[str], global_key: str | None) -> tuple[DataFrame, Column]:
    """Per record the names of its scalar columns and its keys with their values, and its column that gives all values hashed."""
    number = F.col(batch).cast("bigint").alias("batch")
    if is_described(records, payload):
        # the values travel without the structs around them
        held = F.filter(_without(F.col(payload), global_key), lambda e: ~e["listed"])
        cells = records.select(number, held.alias("_held")).select(
            "batch", F.flatten("_held.ids").alias("_record"),
            F.struct(
                F.col("_held.field").alias("names"),
                F.transform(
                    F.filter("_held", lambda e: e["field"].isin(keys)), lambda e: F.struct(e["field"].alias("field"), F.get(e["ids"], F.lit(0)).alias("id"))
                ).alias("keys"),
            ).alias("_named"),
        )
        hashed = F.zip_with(
            "names", "_record", lambda n, t: F.struct(n.alias("field"), *[h.alias(c) for c, h in zip(("h1", "h2"), fixed_width(t), strict=True)])
        )
        return cells, hashed
    fits = lambda k, v: ~is_list(v)
    if global_key:
        fits = lambda k, v: (k != F.lit(global_key)) & ~is_list(v)
    named = once(
        F.map_filter(fields(F.col(payload)), fits),
        lambda held: F.struct(
            F.map_keys(held).alias("names"),
            F.transform(
                F.filter(F.map_keys(held), lambda k: k.isin(keys)),
                lambda k: F.struct(k.alias("field"), short_identity(identity(F.try_element_at(held, k))).alias("id")),
            ).alias("keys"),
        ),
    )
    hashed = F.transform(
        F.filter(_entries("_record", global_key), lambda e: ~e["listed"]),
        lambda e: F.struct(e["field"].alias("field"), e["h1"].alias("h1"), e["h2"].alias("h2")),
    )
    return records.select(number, F.col(payload).alias("_record"), named.alias("_named")), hashed


def window_dependencies(
    records: DataFrame, batch: str, payload: str, keys: list[str], global_key: str | None = None
) -> DataFrame:
    """``functional_dependencies`` of windows of bounded length: batch, key, column.

    A record alone with its value of a key contradicts nothing. Such records tell
    only which columns there are: their values are not hashed, and records with the
    same columns are one row before these are told apart.
    """
    cells, hashed = _named(by_window(records, batch), batch, payload, keys, global_key)
    rows = each(cells, F.col("_named.keys"), "k").select(
        "batch", "_record", F.col("_named.names").alias("names"), F.col("k.field").alias("key"), F.col("k.id").alias("key_id")
    )
    alone = F.count(F.lit(1)).over(Window.partitionBy("batch", "key", "key_id")) == 1
    told = rows.withColumn("_alone", alone).select(
        "batch", "key", F.when(~F.col("_alone"), F.col("key_id")).alias("key_id"),
        F.when(F.col("_alone"), F.col("names")).alias("names"), F.when(~F.col("_alone"), hashed).alias("hashed"),
    ).distinct()
    zero = F.lit(0).cast("bigint")
    unhashed = F.transform("names", lambda n: F.struct(n.alias("field"), zero.alias("h1"), zero.alias("h2")))
    pairs = each(told, F.coalesce("hashed", unhashed), "c").where(F.col("c.field") != F.col("key"))
    return held_dependencies(
        pairs.groupBy("batch", "key", "key_id", F.col("c.field").alias("column")).agg(
            F.min("c.h1").alias("low1"), F.max("c.h1").alias("high1"), F.min("c.h2").alias("low2"), F.max("c.h2").alias("high2")
        )
    )


def ever(found: DataFrame) -> DataFrame:
    """Union over batches: what held once is kept."""
    return found.drop("batch").distinct()


def inclusion_partials(records: DataFrame, batch: str, payload: str, global_key: str | None = None) -> DataFrame:
    """The distinct values of each column of a batch: batch, field, id, and whether the column's value was a list.

    Elements of lists are values too. Partials of parts of a batch are merged by
    ``merged_inclusions``.
    """
    entries = _without(F.col(payload), global_key) if is_described(records, payload) else _cells(payload, global_key)
    columns = each(records.select(F.col(batch).cast("bigint").alias("batch"), entries.alias("all")), F.col("all"), "e")
    values = columns.select(
        "batch", F.col("e.field").alias("field"), F.col("e.listed").alias("listed"), F.explode_outer("e.ids").alias("id")
    )
    return merged_inclusions(values)


def merged_inclusions(partials: DataFrame) -> DataFrame:
    """Partials of several parts as one."""
    return partials.groupBy("batch", "field", "id").agg(F.bool_or("listed").alias("listed"))


def held_inclusions(values: DataFrame, keys: list[str]) -> DataFrame:
    """batch, column, references: the columns whose values are all among a key's.

    ``values`` are read once. A value that only empty lists have is null, and counts as none.
    """
    same = Window.partitionBy("batch", "id")
    held = values.withColumns({f"_in{i}": F.max(F.col("field") == k).over(same) for i, k in enumerate(keys)}).where(~F.col("field").isin(keys))
    # a column with a list anywhere in the batch cannot refer
    sizes = held.groupBy("batch", F.col("field").alias("column")).agg(
        F.bool_or("listed").alias("any_list"), F.count("id").alias("n"),
        *[F.count_if(F.col("id").isNotNull() & F.col(f"_in{i}")).alias(f"_k{i}") for i in range(len(keys))],
    ).where("not any_list and n > 0")
    tested = sizes.select(
        "batch", "column", "n",
        F.explode(F.array(*[F.struct(F.lit(k).alias("references"), F.col(f"_k{i}").alias("hits")) for i, k in enumerate(keys)])).alias("t"),
    )
    return tested.where(F.col("t.hits") == F.col("n")).select("batch", "column", "t.references")


def inclusion_dependencies(
    records: DataFrame, batch: str, payload: str, keys: list[str], global_key: str | None = None
) -> DataFrame:
    """Foreign-key candidates per batch: batch, column, references (I4).

    A non-key scalar column refers to a key when all its values in the batch
    are among the key's values; elements of a key's lists are values too.
    """
    return held_inclusions(inclusion_partials(records, batch, payload, global_key), keys)


def window_inclusions(
    records: DataFrame, batch: str, payload: str, keys: list[str], global_key: str | None = None
) -> DataFrame:
    """``inclusion_dependencies`` of windows of bounded length: batch, column, references."""
    return inclusion_dependencies(by_window(records, batch), batch, payload, keys, global_key)


def list_columns(records: DataFrame, payload: str, global_key: str | None = None) -> DataFrame:
    """Columns that ever hold a list."""
    if is_described(records, payload):
        held = F.filter(F.col(payload), lambda e: e["listed"])["field"]
    else:
        held = F.map_keys(F.map_filter(fields(F.col(payload)), lambda k, v: F.coalesce(is_list(v), F.lit(False))))
    found = records.select(F.explode(held).alias("column")).distinct()
    return found.where(F.col("column") != global_key) if global_key else found


def table_inclusions(tables: dict[tuple[str, str], DataFrame], references: list[tuple[str, str]]) -> DataFrame:
    """The same test between columns of typed tables.

    ``tables`` maps (table, column) to the table. Result: column, references as
    ``table.column`` names.
    """
    from functools import reduce

    values = reduce(
        DataFrame.unionAll,
        [
            df.select(F.lit(f"{t}.{c}").alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("id"), F.col(c).isNull().alias("z")).distinct()
            for (t, c), df in tables.items()
        ],
    )
    names = [f"{t}.{c}" for t, c in references]
    holders = values.groupBy("id", "z").agg(F.collect_set("column").alias("f"))
    hits = holders.select(F.explode(F.filter("f", lambda c: ~c.isin(names))).alias("column"), "f").groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.array_contains("f", k)).alias(f"_k{i}") for i, k in enumerate(names)]
    )
    return hits.select(
        "column", "n",
        F.explode(F.array(*[F.struct(F.lit(k).alias("references"), F.col(f"_k{i}").alias("hits")) for i, k in enumerate(names)])).alias("t"),
    ).where(F.col("t.hits") == F.col("n")).select("column", "t.references")

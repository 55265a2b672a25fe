"""Reading open JSON records without fixing a schema.

A payload stays a VARIANT until the last step, so that an absent key, a null and
an empty list remain three different things.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed a single time.

    Catalyst may inline a column into a lambda, which would compute it again
    for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def each(rows: DataFrame, values: Column, *names: str) -> DataFrame:
    """One row per element, or per key and value, of ``values``; the first name is not null.

    ``explode`` alone lets Catalyst infer that ``values`` is not empty, push that
    below the projections and joins underneath, and compute ``values`` there again.
    """
    return rows.select("*", F.explode_outer(values).alias(*names)).where(F.col(names[0]).isNotNull())


def strict_json(raw: Column) -> Column:
    """Parse exactly one JSON value; null when the text is anything else.

    ``try_parse_json`` ignores text after the first value, so the value is
    parsed inside brackets, where such text is an error or a second element.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    return once(
        F.try_variant_get(wrapped, "$", "array<variant>"),
        lambda found: F.when(F.size(found) == 1, F.get(found, F.lit(0))),
    )


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def is_list(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("ARRAY")


def elements(value: Column) -> Column:
    """The elements of a list value, null for any other value."""
    return F.try_variant_get(value, "$", "array<variant>")


def fields(value: Column) -> Column:
    """The fields of an object value, null for any other value."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def is_nested(value: Column) -> Column:
    """An object, or a list that holds an object or a list."""
    holds = F.exists(
        elements(value), lambda x: F.schema_of_variant(x).rlike("^(OBJECT|ARRAY)")
    )
    return is_object(value) | (is_list(value) & F.coalesce(holds, F.lit(False)))


def field(value: Column, name: str) -> Column:
    """One field of an object value, without reading the others."""
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(value, f"$['{quoted}']", "variant")


def text(value: Column) -> Column:
    """Scalars as plain text, lists and objects as JSON text."""
    return F.try_variant_get(value, "$", "string")


def identity(value: Column) -> Column:
    """A text that is equal for two values exactly when they compare equal.

    It is the JSON text, so strings keep their quotes and stay apart from
    numbers; numbers and booleans share one domain (1 = 1.0 = true), and null is
    a value of its own.
    """
    return once(F.to_json(value), identity_of_json)


def identity_of_json(j: Column) -> Column:
    """``identity`` from the JSON text of a value; never longer than that."""
    return (
        F.when(F.substring(j, 1, 1).isin('"', "[", "{"), j)
        .when(j == "true", "1")
        .when(j == "false", "0")
        .when(F.contains(j, F.lit(".")) & j.rlike(r"^-?[0-9.]+$"), F.regexp_replace(j, r"\.?0+$", ""))
        .otherwise(j)
    )


def short_identity(identity_text: Column) -> Column:
    """An identity of bounded width, to group by: long texts are replaced by 128 bits of their SHA-256.

    The mark in front keeps it apart from texts that stand for themselves.
    """
    digest = F.concat(F.lit("#"), F.substring(F.sha2(identity_text, 256), 1, 32))
    return F.when(F.length(identity_text) > 48, digest).otherwise(identity_text)


def short_identity_of_json(j: Column) -> Column:
    """``short_identity`` of ``identity`` from the JSON text; few texts are long enough to be looked at twice."""
    return F.when(F.length(j) <= 48, identity_of_json(j)).otherwise(short_identity(identity_of_json(j)))


def fixed_width(identity_text: Column) -> list[Column]:
    """Two independent 64-bit values of a text: equal together exactly for equal texts, but for a chance of 2^-128."""
    return [F.xxhash64(identity_text), F.xxhash64(F.lit(0x5EED), identity_text)]

"""Scalar and list conversions between the engine's types.

A value is described once by its *traits*; every later decision reads those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.functions.payload import elements, strict_json, text

# fixed values: the words that mean true and false, and the number forms
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]
INT_FORM = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_FORM = r"(?i)^\s*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"


def is_boolean_text(value: Column) -> Column:
    """Whether a string, or the text of an integer or boolean, reads as boolean."""
    return F.coalesce(F.lower(value).isin(TRUE_WORDS + FALSE_WORDS), F.lit(False))


def to_boolean(value: Column) -> Column:
    """The boolean a text stands for; null when it stands for none."""
    return F.when(F.lower(value).isin(TRUE_WORDS), F.lit(True)).when(
        F.lower(value).isin(FALSE_WORDS), F.lit(False)
    )


def to_integer(value: Column) -> Column:
    """Whole-number text to BIGINT; null otherwise."""
    return F.when(value.rlike(INT_FORM), F.trim(value).try_cast("bigint"))


def to_float(value: Column) -> Column:
    """Number text to DOUBLE; null otherwise. ``1d`` and the like are not numbers."""
    return F.when(value.rlike(FLOAT_FORM), F.trim(value).try_cast("double"))


def strict_integer(value: Column) -> Column:
    """A double to BIGINT only when nothing is lost."""
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def list_items(value: Column) -> Column:
    """A list, or the list a JSON or single-quoted literal text spells."""
    return F.coalesce(elements(value), list_from_text(text(value)))


def list_from_text(raw: Column) -> Column:
    literal = F.from_json(
        F.regexp_replace(F.regexp_replace(F.regexp_replace(
            raw, r"\bTrue\b", "true"), r"\bFalse\b", "false"), r"\bNone\b", "null"),
        "array<variant>",
        {"allowSingleQuotes": "true"},
    )
    listlike = raw.rlike(r"(?s)^\s*\[.*\]\s*$")
    return F.when(listlike, F.coalesce(elements(strict_json(raw)), literal))


def scalar_traits(kind: Column, shown: Column) -> Column:
    """What a scalar can become, from its variant kind and its text.

    ``cut_int`` is plain truncation (T4), ``int`` the strict form (T6).
    """
    is_text = kind == "STRING"
    is_bool = kind == "BOOLEAN"
    # a variant keeps 5.0 as DECIMAL(1,0); integers are BIGINT, or wider than 18 digits
    is_int = kind.rlike(r"^(BIGINT|DECIMAL\((19|2\d|3\d),0\))$")
    is_real = kind.rlike("^(DECIMAL|DOUBLE|FLOAT)") & ~is_int
    # inside a CASE, so that no text is ever cast just to fail
    number = F.when(is_real, shown.try_cast("double"))
    whole = is_real & (number == F.floor(number))
    int_text = is_text & shown.rlike(INT_FORM)
    float_text = is_text & shown.rlike(FLOAT_FORM)
    word = is_text & is_boolean_text(shown)
    return F.struct(
        (is_bool | is_int | is_real | int_text).alias("cut_int"),
        (is_bool | is_int | whole | int_text).alias("int"),
        (is_bool | is_int | is_real | float_text).alias("float"),
        (is_bool | word | (is_int & shown.isin("0", "1"))).alias("bool"),
        F.when(is_bool, "bool").when(is_int, "int").when(is_real, "float")
        .when(int_text, "int").when(float_text, "float").when(word, "bool")
        .otherwise("str").alias("first"),
        (kind == "VOID").alias("null"),
    )


def shown_text(kind: Column, plain: Column) -> Column:
    """Text of a scalar as the reference language prints it: 5.0 stays 5.0, true is True."""
    return (
        F.when(kind == "BOOLEAN", F.initcap(plain))
        .when(kind == "VOID", F.lit("None"))
        .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)") & plain.rlike(r"^-?\d{1,17}$"), F.concat(plain, F.lit(".0")))
        .otherwise(plain)
    )


def with_traits(cells: DataFrame, value: str, name: str = "traits") -> DataFrame:
    """Add the traits of each VARIANT value; null for null values."""
    from driftwell.functions.widening import next_scalar_type

    df = cells.withColumns(
        {"_kind": F.schema_of_variant(value), "_text": text(F.col(value)), "_list": elements(F.col(value))}
    )
    df = df.withColumns(
        {
            "_own": F.col("_list").isNotNull(),
            "_json": F.when(
                (F.col("_kind") == "STRING") & F.col("_text").rlike(r"^\s*\["),
                elements(strict_json(F.col("_text"))),
            ),
        }
    ).withColumn(
        "_list",
        F.coalesce("_list", "_json", F.when(F.col("_kind") == "STRING", list_from_text(F.col("_text")))),
    )
    df = df.withColumns(
        {
            "_items": F.transform("_list", lambda x: scalar_traits(F.schema_of_variant(x), text(x))),
            "_self": scalar_traits(F.col("_kind"), F.col("_text")),
        }
    ).withColumn("_sub", F.aggregate("_items", F.lit("UNK"), next_scalar_type))
    every = lambda trait: F.coalesce(F.forall("_items", lambda t: t[trait]), F.lit(False))
    subtype, own = F.col("_sub"), F.col("_self")
    listed = F.col("_list").isNotNull()
    first = F.when(
        F.col("_own") | (F.col("_json").isNotNull()), F.concat(F.lit("list<"), subtype, F.lit(">"))
    ).otherwise(own["first"])
    full = F.struct(
        *[(own[t] & ~F.col("_own")).alias(t) for t in ("cut_int", "int", "float", "bool")],
        first.alias("first"),
        listed.alias("listed"),
        every("int").alias("list_int"),
        every("float").alias("list_float"),
        every("bool").alias("list_bool"),
        F.coalesce(subtype, F.lit("UNK")).alias("subtype"),
    )
    # a value that is no list and spells none is most of a table: nothing of a list is computed for it
    scalar = ~F.col("_kind").startswith("ARRAY") & ~((F.col("_kind") == "STRING") & F.col("_text").rlike(r"^\s*\["))
    no = F.lit(False)
    bare = F.struct(
        *[own[t].alias(t) for t in ("cut_int", "int", "float", "bool")], own["first"].alias("first"),
        no.alias("listed"), no.alias("list_int"), no.alias("list_float"), no.alias("list_bool"), F.lit("UNK").alias("subtype"),
    )
    traits = F.when(scalar, bare).otherwise(full)
    return df.withColumn(
        name, F.when(F.col(value).isNotNull() & (F.col("_kind") != "VOID"), traits)
    ).drop("_own", "_json", "_items", "_self", "_sub")


def converted(type_name: Column, kind: Column, plain: Column, items: Column) -> dict[str, Column]:
    """A value under a type, one column per physical type.

    Exactly the column of ``type_name`` is set; none is set when the value does
    not convert.
    """
    number = F.coalesce(
        F.when(kind == "BOOLEAN", (plain == "true").cast("double")), to_float(plain)
    )
    # integers go through BIGINT so that large ones lose no digits
    whole = F.coalesce(
        F.when(kind == "BOOLEAN", (plain == "true").cast("bigint")),
        to_integer(plain),
        F.when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), plain.try_cast("double").try_cast("bigint")),
    )
    bool_source = F.when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), F.lit(None)).otherwise(plain)
    shown = shown_text(kind, plain)

    def item(x: Column) -> Column:
        k, s = F.schema_of_variant(x), text(x)
        as_int = F.coalesce(
            F.when(k == "BOOLEAN", (s == "true").cast("bigint")),
            to_integer(s),
            F.when(k.rlike("^(DECIMAL|DOUBLE|FLOAT)"), strict_integer(s.try_cast("double"))),
        ).cast("string")
        as_float = F.coalesce(
            F.when(k == "BOOLEAN", (s == "true").cast("double")), to_float(s)
        ).cast("string")
        as_bool = to_boolean(F.when(k.rlike("^(DECIMAL|DOUBLE|FLOAT)"), F.lit(None)).otherwise(s)).cast("string")
        return (
            F.when(type_name == "list<int>", as_int)
            .when(type_name == "list<float>", as_float)
            .when(type_name == "list<bool>", as_bool)
            .otherwise(shown_text(k, s))
        )

    listed = F.transform(items, item)
    return {
        "int_value": F.when(type_name == "int", whole),
        "float_value": F.when(type_name == "float", number),
        "bool_value": F.when(type_name == "bool", to_boolean(bool_source)),
        "str_value": F.when((type_name == "str") & (kind != "VOID"), shown),
        "list_value": F.when(
            type_name.startswith("list<") & F.forall(listed, lambda x: x.isNotNull()), listed
        ),
    }

"""The type transition rule: current type + value traits → next type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: all types a column can have
TYPES = [
    "UNK", "int", "float", "bool", "str",
    "list<UNK>", "list<int>", "list<float>", "list<bool>", "list<str>",
]


def next_scalar_type(state: Column, traits: Column) -> Column:
    """The rule among scalars, as it applies to the elements of a new list."""
    return (
        F.when(traits["null"], state)
        .when(state == "UNK", traits["first"])
        .when(state == "int", F.when(traits["cut_int"], "int").when(traits["float"], "float").otherwise("str"))
        .when(state == "float", F.when(traits["float"], "float").otherwise("str"))
        .when(
            state == "bool",
            F.when(traits["bool"], "bool").when(traits["int"], "int")
            .when(traits["float"], "float").otherwise("str"),
        )
        .otherwise(state)
    )


def next_type(state: Column, traits: Column) -> Column:
    """The full rule. A list column keeps its type on a value that is no list."""
    as_list = F.when(traits["list_int"], "list<int>").when(traits["list_float"], "list<float>")
    wider_list = as_list.otherwise("list<str>")
    return (
        F.when(traits.isNull(), state)
        .when(state == "UNK", traits["first"])
        .when(
            state == "int",
            F.when(traits["cut_int"], "int").otherwise(
                F.when(traits["float"], F.lit("float")).otherwise(F.coalesce(as_list, F.lit("str")))
            ),
        )
        .when(
            state == "float",
            F.when(traits["float"], "float").when(traits["list_float"], "list<float>").otherwise("str"),
        )
        .when(
            state == "bool",
            F.when(traits["bool"], "bool").when(traits["int"], "int").when(traits["float"], "float")
            .otherwise(F.coalesce(as_list, F.lit("str"))),
        )
        .when(state == "str", "str")
        .when(~traits["listed"], state)
        .when(state == "list<UNK>", F.concat(F.lit("list<"), traits["subtype"], F.lit(">")))
        .when(state == "list<int>", wider_list)
        .when(state == "list<float>", F.when(traits["list_float"], "list<float>").otherwise("list<str>"))
        .when(
            state == "list<bool>", F.when(traits["list_bool"], "list<bool>").otherwise(wider_list)
        )
        .otherwise(state)
    )

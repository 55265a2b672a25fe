"""Query-spec documents of any size, read by many tasks.

A document ``{"queries": [{…}, {…}]}`` may be one line of a gigabyte. It is read
in pieces that end at closing braces, so that files are split by bytes like any
text. Whether a piece starts inside a string, and how deep, depends on all
before it; a block of pieces (one split of a file) is therefore summarised as a
function of the state it starts in: the quotes in it, and its change of depth
for either kind of start. Only these summaries, one row per split, are put
together in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftwell.session import even_join, materialize

# strings with the bracket they name, strings that do not end here, brackets, and what is between
TOKEN = r'"[^"]*"(?:\s*:\s*[\[{])?|"[^"]*$|[\[{\]}]|[^"\[{\]}]+'
_BEFORE = (Window.unboundedPreceding, -1)


def read_specs(spark: SparkSession, path: str, key: str = "queries") -> DataFrame:
    """Query-spec documents as one JSON text per spec: file, query_index, raw.

    ``key`` is ``generated_queries`` for documents of rendered statements. A spec
    is an object in the array that the document's ``key`` holds; its text is as
    in the file. ``query_index`` counts from 1 in each file.
    """
    blocks = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.concat("value", F.lit("}")).alias("text"),
    )
    return _specs(_opened(_placed(blocks), key))


def _masked(text: Column) -> Column:
    """The text with escapes blotted out, each by as many characters: what quotes remain begin or end strings."""
    return F.regexp_replace(text, r"(?s)\\.", "__")


def _depth(parts: Column) -> Column:
    """By how much brackets outside strings deepen."""
    outside = F.array_join(parts, "")
    return F.length(F.translate(outside, "]}", "")) - F.length(F.translate(outside, "[{", ""))


def _placed(pieces: DataFrame) -> DataFrame:
    """Pieces with the state they start in: ``inside`` a string, and ``depth``."""
    inside = Window.partitionBy("file", "start").orderBy("at").rowsBetween(*_BEFORE)
    masked = pieces.withColumn("masked", _masked(F.col("text")))
    parts = F.split("masked", '"', -1)
    masked = masked.withColumns({
        "quotes": F.size(parts) - 1,
        "if_out": _depth(F.filter(parts, lambda x, i: i % 2 == 0)),
        "if_in": _depth(F.filter(parts, lambda x, i: i % 2 == 1)),
    }).withColumn("seen", F.coalesce(F.sum("quotes").over(inside), F.lit(0)))
    even = F.col("seen") % 2 == 0
    # change of depth of a piece for a block that starts outside, and inside, a string
    masked = masked.withColumns({
        "d0": F.when(even, F.col("if_out")).otherwise(F.col("if_in")), "d1": F.when(even, F.col("if_in")).otherwise(F.col("if_out")),
    }).withColumns({"r0": F.coalesce(F.sum("d0").over(inside), F.lit(0)), "r1": F.coalesce(F.sum("d1").over(inside), F.lit(0))})
    blocks = masked.groupBy("file", "start").agg(F.sum("quotes").alias("quotes"), F.sum("d0").alias("d0"), F.sum("d1").alias("d1"))
    # one row per split of a file
    in_order = Window.partitionBy("file").orderBy("start").rowsBetween(*_BEFORE)
    blocks = blocks.withColumn("odd", F.coalesce(F.sum("quotes").over(in_order), F.lit(0)) % 2 == 1)
    grown = F.when(F.col("odd"), F.col("d1")).otherwise(F.col("d0"))
    blocks = blocks.select("file", "start", "odd", F.coalesce(F.sum(grown).over(in_order), F.lit(0)).alias("base"))
    return even_join(masked, blocks, ["file", "start"]).select(
        "file", "start", "at", "text", "masked",
        ((F.col("seen") % 2 == 1) != F.col("odd")).alias("inside"),
        (F.col("base") + F.when(F.col("odd"), F.col("r1")).otherwise(F.col("r0"))).cast("int").alias("depth"),
    )


def _walk(key: str) -> Column:
    """Over the tokens of a piece: where an object starts at depth 2, what was last opened at depth 1, whether a brace closes it.

    ``held`` tells whether what was opened is the array of ``key``; it is null
    where the piece opens nothing at depth 1.
    """
    shift = F.when(F.col("inside"), 1).otherwise(0)
    tokens = F.regexp_extract_all(F.when(F.col("inside"), F.concat(F.lit('"'), "masked")).otherwise(F.col("masked")), F.lit(TOKEN), F.lit(0))
    begin = F.struct(
        F.lit(0).alias("place"), F.col("depth").alias("depth"), F.lit(None).cast("boolean").alias("held"), F.lit(None).cast("int").alias("opens"),
        F.lit(False).alias("closes"),
    )

    def step(acc: Column, token: Column) -> Column:
        last = F.right(token, F.lit(1))
        named = token.startswith('"')
        # a string and a bracket, or a bracket alone
        opening = last.isin("[", "{") & (~named | token.rlike(r':\s*[\[{]$'))
        closing = token.isin("]", "}")
        # the name as it is written; the rest of a string that began before is no name
        name = F.substr("text", acc["place"] - shift + 1, F.length(F.regexp_extract(token, '^"[^"]*"', 0)))
        spelt = F.map_keys(F.from_json(F.concat(F.lit("{"), name, F.lit(":0}")), "map<string,string>"))
        top = opening & (acc["depth"] == 1)
        is_key = F.when(top & named & ~(F.col("inside") & (acc["place"] == 0)), F.coalesce(F.get(spelt, F.lit(0)) == key, F.lit(False))).otherwise(F.lit(False))
        return F.struct(
            (acc["place"] + F.length(token)).alias("place"),
            (acc["depth"] + F.when(opening, 1).when(closing, -1).otherwise(0)).alias("depth"),
            F.when(top, (last == "[") & is_key).otherwise(acc["held"]).alias("held"),
            F.when(opening & (acc["depth"] == 2) & (last == "{") & ~named, acc["place"] - shift + F.length(token)).otherwise(acc["opens"]).alias("opens"),
            (token == "}").alias("closes"),
        )

    return F.aggregate(tokens, begin, step)


def _opened(pieces: DataFrame, key: str) -> DataFrame:
    """Pieces of objects with their number in the file, 0 for the pieces between them."""
    # three passes read what the walk finds; walking happens once
    walked = materialize(pieces.withColumn("w", _walk(key)).select(
        "file", "start", "at", "text", F.col("w.held").alias("held"), F.col("w.opens").alias("opens"), ((F.col("w.depth") == 2) & F.col("w.closes")).alias("leaves"),
    ))
    so_far = Window.partitionBy("file", "start").orderBy("at")
    own = walked.withColumn("own", F.last("held", True).over(so_far))
    ends = own.groupBy("file", "start").agg(F.max_by("own", "at").alias("own"))
    in_order = Window.partitionBy("file").orderBy("start").rowsBetween(*_BEFORE)
    ends = ends.select("file", "start", F.last("own", True).over(in_order).alias("carried"))
    known = even_join(own, ends, ["file", "start"])
    ours = F.coalesce("own", "carried", F.lit(False))
    known = known.withColumns({
        "starts": (ours & F.col("opens").isNotNull()).cast("int"), "ends": (ours & F.col("leaves")).cast("int"),
    })
    counted = known.withColumns({"n": F.sum("starts").over(so_far), "m": F.sum("ends").over(so_far)})
    blocks = known.groupBy("file", "start").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    blocks = blocks.select(
        "file", "start", F.coalesce(F.sum("starts").over(in_order), F.lit(0)).alias("n0"), F.coalesce(F.sum("ends").over(in_order), F.lit(0)).alias("m0"),
    )
    number, ended = F.col("n") + F.col("n0"), F.col("m") + F.col("m0") - F.col("ends")
    inside = (F.col("starts") == 1) | (number > ended)
    return even_join(counted, blocks, ["file", "start"]).select("file", "start", "at", "text", "starts", "opens", F.when(inside, number).otherwise(0).alias("number"))


def _specs(pieces: DataFrame) -> DataFrame:
    """The pieces of each object put together, from its opening brace."""
    text = F.when(F.col("starts") == 1, F.substr("text", F.col("opens"))).otherwise(F.col("text"))
    whole = pieces.where("number > 0").groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("start", "at", text.alias("text")))).alias("p"))
    return whole.select("file", F.col("number").alias("query_index"), F.array_join("p.text", "").alias("raw"))

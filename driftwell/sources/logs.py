"""Log, spec and table sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.functions.payload import once
from driftwell.functions.text import stripped

OPERATION = (
    "type string, table_name string, columns array<string>, `values` array<variant>, "
    "`where` map<string,variant>, sql string"
)


def read_operation_log(spark: SparkSession, path: str, global_key: str | None = None) -> DataFrame:
    """JSON-lines operation log as rows; blank lines are skipped."""
    schema = OPERATION + (f", `{global_key}` string" if global_key else "")
    return (
        spark.read.text(path)
        .where(stripped(F.col("value")) != "")
        .select(F.from_json("value", schema).alias("op"))
        .select("op.*")
        .withColumn("type", F.upper("type"))
    )


def parse_commands(lines: DataFrame, column: str = "value") -> DataFrame:
    """``db.<collection>.insertOne({bare: keys});`` lines.

    Result: collection, document (map of VARIANT), skipped. A line is cut at its
    first opening brace and its last closing one: what comes before must name the
    collection and the command, what comes after may only close it. Blanks
    between the parts do not matter. A line that has another form, or whose
    document does not decode, is marked skipped.
    """
    kept = [c for c in lines.columns if c != column]
    # arrays hold each step's result, so that the next step does not compute it again;
    # one row comes of each line, and a filter on it stays above, where the line is read already
    return lines.select(*kept, F.explode_outer(F.transform(F.array(stripped(F.col(column))), _command)).alias("_c")).select(
        *kept, F.when(F.col("_c.document").isNotNull(), F.col("_c.name")).alias("collection"),
        F.col("_c.document").alias("document"), F.col("_c.document").isNull().alias("skipped"),
    )


def _command(line: Column) -> Column:
    """name and document of a trimmed command line; the document is null if the line has another form."""
    opens = F.instr(line, "{")
    closes = F.length(line) - F.instr(F.reverse(line), "}") + 1
    cut = F.struct(
        F.split(F.regexp_replace(F.substr(line, F.lit(1), opens - 1), r"\s", ""), r"\.").alias("parts"),
        F.regexp_replace(F.substr(line, closes + 1), r"\s", "").alias("tail"),
        F.when((opens > 0) & (closes >= opens), F.substr(line, opens, closes - opens + 1)).alias("body"),
    )

    def read(c: Column) -> Column:
        name = F.get(c["parts"], F.lit(1))
        fits = (
            (F.size(c["parts"]) == 3) & (F.get(c["parts"], F.lit(0)) == "db") & (name != "") & ~name.rlike(r"\W")
            & (F.get(c["parts"], F.lit(2)) == "insertOne(") & c["tail"].isin(")", ");")
        )
        document = F.from_json(F.when(fits, c["body"]), "map<string,variant>", {"allowUnquotedFieldNames": "true"})
        return F.struct(name.alias("name"), document.alias("document"))

    return once(cut, read)


def command_counts(commands: DataFrame) -> DataFrame:
    """Lines inserted and skipped."""
    return commands.agg(
        F.count_if(~F.col("skipped")).alias("inserted"), F.count_if("skipped").alias("skipped")
    )


def read_statement_log(spark: SparkSession, path: str) -> DataFrame:
    """``;``-terminated statements; blank and comment-only pieces are skipped.

    A ``;`` inside a literal also ends a statement.
    """
    return statements(spark.read.option("lineSep", ";").text(path))


def statements(pieces: DataFrame, column: str = "value") -> DataFrame:
    lines = F.transform(F.split(F.col(column), r"\r?\n"), lambda x: stripped(x))
    real = F.exists(lines, lambda x: (x != "") & ~x.startswith("--"))
    return pieces.where(real).select(
        *[c for c in pieces.columns if c != column], stripped(F.col(column)).alias("statement")
    )


def spec_rows(documents: DataFrame, key: str = "queries", column: str = "value") -> DataFrame:
    """Specs of documents that are rows of a column; for files see ``specs.read_specs``."""
    specs = F.from_json(column, f"struct<`{key}`:array<string>>")[key]
    return documents.select(
        *[c for c in documents.columns if c != column], F.posexplode(specs).alias("_at", "raw")
    ).select(*[c for c in documents.columns if c != column], (F.col("_at") + 1).alias("query_index"), "raw")


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A stored table; only the named columns are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df

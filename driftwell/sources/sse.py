"""Change-event sources: Server-Sent-Event text and JSON envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftwell.functions.payload import strict_json, text
from driftwell.functions.text import stripped
from driftwell.operators.scan import Running, running_scan
from driftwell.session import even_join

# fixed values: the events the engine acts on
KNOWN_EVENTS = ["init", "create", "add", "change", "remove", "get"]
_FRAME = "event string, data string"


def stream_lines(
    spark: SparkSession, path: str, max_files: int = 100, max_bytes: str | None = None
) -> DataFrame:
    """Landed SSE files as a stream of lines with the file and split they come from.

    Lines, not frames, so that blank lines with any line end separate frames.
    """
    # the two limits exclude each other
    limit = ("maxBytesPerTrigger", max_bytes) if max_bytes else ("maxFilesPerTrigger", max_files)
    return spark.readStream.option(*limit).text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def _after(line: Column, n: int) -> Column:
    """What follows the first ``n`` characters of a line."""
    return stripped(F.substr(line, F.lit(n + 1)))


def _event_of(line: Column) -> Column:
    return F.when(line.startswith("event:"), _after(line, 6))


def _data_of(line: Column) -> Column:
    return F.when(line.startswith("data:"), _after(line, 5))


def split_records(lines: DataFrame, base: Column) -> DataFrame:
    """``data:`` lines of file splits, numbered in (file, offset) order after ``base``: seq, event, data.

    Input: file, start, line. The event is carried forward inside a file, over
    the bounds of its splits. Only one row per split is scanned in one place.
    """
    line = stripped(F.col("line"))
    placed = lines.select("file", "start", F.monotonically_increasing_id().alias("_at"), _event_of(line).alias("_event"), _data_of(line).alias("data"))
    inside = Window.partitionBy("file", "start").orderBy("_at")
    placed = placed.where("_event is not null or data is not null").withColumns(
        {"_n": F.count("data").over(inside), "_own": F.last("_event", True).over(inside)}
    )
    splits = placed.groupBy("file", "start").agg(F.count("data").alias("_size"), F.max_by("_own", "_at").alias("_last"))
    before = (Window.unboundedPreceding, -1)
    splits = splits.select(
        "file", "start",
        F.coalesce(F.sum("_size").over(Window.orderBy("file", "start").rowsBetween(*before)), F.lit(0)).alias("_before"),
        F.last("_last", True).over(Window.partitionBy("file").orderBy("start").rowsBetween(*before)).alias("_carried"),
    )
    # the split list may look larger before it is computed: broadcasting the lines instead would put them in one place
    return even_join(placed.where("data is not null"), splits, ["file", "start"]).select(
        (base + F.col("_before") + F.col("_n")).alias("seq"), F.coalesce("_own", "_carried").alias("event"), "data"
    )


def frame_records(frames: DataFrame, frame: str = "frame") -> DataFrame:
    """Each ``data:`` line of a frame as a row, under the last ``event:`` line before it."""
    lines = F.transform(F.split(F.col(frame), r"\r?\n"), lambda x: stripped(x))
    begin = F.struct(
        F.lit(None).cast("string").alias("event"),
        F.array().cast(f"array<struct<{_FRAME.replace(' string', ':string').replace(', ', ',')}>>").alias("out"),
    )

    def step(acc: Column, line: Column) -> Column:
        return F.struct(
            F.coalesce(_event_of(line), acc["event"]).alias("event"),
            F.when(
                line.startswith("data:"),
                F.array_append(
                    acc["out"], F.struct(acc["event"].alias("event"), _data_of(line).alias("data"))
                ),
            ).otherwise(acc["out"]).alias("out"),
        )

    rest = [c for c in frames.columns if c != frame]
    return frames.select(*rest, F.explode(F.aggregate(lines, begin, step, lambda a: a["out"])).alias("r")).select(
        *rest, "r.event", "r.data"
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines numbered 1, 2, … in file order: seq, file, line.

    Lines are ordered inside each file split, and splits by (file, offset); only
    the list of splits is scanned in one place.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("line"),
    )
    sizes = lines.groupBy("file", "_start").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn(
        "_before",
        F.coalesce(
            F.sum("_n").over(
                Window.orderBy("file", "_start").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    ).drop("_n")
    inside = F.row_number().over(Window.partitionBy("file", "_start").orderBy("_at"))
    return even_join(lines.withColumn("_in", inside), offsets, ["file", "_start"]).select(
        (F.col("_before") + F.col("_in")).alias("seq"), "file", "line"
    )


def line_records(lines: DataFrame, seq: str = "seq", line: str = "line", source: str | None = "file") -> DataFrame:
    """``data:`` lines with the event carried forward from earlier lines.

    Works where frames are not separated by blank lines. The event is carried
    within one ``source`` (pass None for a single corpus).
    """
    bare = stripped(F.col(line))
    named = lines.withColumns({"_event": _event_of(bare), "data": _data_of(bare)}).where(F.col("_event").isNotNull() | F.col("data").isNotNull())
    group = [source] if source else []
    scanned = running_scan(
        named.select(*group, seq, "_event", "data"), group, seq, {"event": Running("last", F.col("_event"))}
    )
    return scanned.where(F.col("data").isNotNull()).select(*group, seq, "event", "data")


def corpus_records(records: DataFrame) -> DataFrame:
    """The corpus form keeps ``init`` and ``create`` only."""
    return records.where(F.col("event").isin("init", "create"))


def normalise(items: DataFrame, raw: str = "raw") -> DataFrame:
    """Any of the event forms to (event, record, record_text) (S3).

    Understood: a JSON envelope ``{"event", "data"}`` whose data is an object or
    JSON text, SSE text, and a bare JSON record, which is a ``create``. Text
    that holds no JSON gives a null record. For (event, record) pairs see
    ``normalise_pairs``.
    """
    body = stripped(F.col(raw))
    df = items.withColumn("_body", body).withColumn(
        "_object", F.when(F.col("_body").startswith("{"), strict_json(F.col("_body")))
    )
    has = lambda k: F.array_contains(F.json_object_keys("_body"), k)
    lines = F.transform(F.split(F.col("_body"), r"\r?\n"), lambda x: stripped(x))
    last = lambda prefix: F.try_element_at(F.filter(lines, lambda x: x.startswith(prefix)), F.lit(-1))
    df = df.withColumns(
        {
            "_form": F.when(
                F.col("_object").isNotNull(), F.when(has("event") & has("data"), "envelope").otherwise("plain")
            ).otherwise("sse"),
            "_event_line": _event_of(last("event:")),
            "_data_line": _data_of(last("data:")),
        }
    )
    # get_json_object keeps object text in source order and unwraps JSON strings
    record_text = (
        F.when(F.col("_form") == "envelope", F.get_json_object("_body", "$.data"))
        .when(F.col("_form") == "plain", F.col("_body"))
        .otherwise(F.coalesce("_data_line", "_body"))
    )
    event = (
        F.when(F.col("_form") == "envelope", text(F.variant_get(F.col("_object"), "$.event", "variant")))
        .when(F.col("_form") == "plain", F.lit("create"))
        .otherwise(F.coalesce("_event_line", F.lit("create")))
    )
    return (
        df.withColumns({"event": F.lower(stripped(event)), "record_text": record_text})
        .withColumn("record", strict_json(F.col("record_text")))
        .drop("_body", "_object", "_form", "_event_line", "_data_line")
    )


def normalise_pairs(items: DataFrame, event: str = "event", data: str = "data") -> DataFrame:
    """Already split (event, JSON text) pairs to the same columns (S3)."""
    return items.withColumns(
        {
            "record_text": F.col(data),
            "record": strict_json(F.col(data)),
            "event": F.lower(stripped(F.coalesce(F.col(event), F.lit("create")))),
        }
    )


def event_counts(events: DataFrame) -> DataFrame:
    """Records per event name, whether the engine knows it, and how many have no JSON: nothing is dropped unseen."""
    return events.groupBy("event").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("record").isNull()).alias("broken")
    ).withColumn("known", F.col("event").isin(KNOWN_EVENTS))


def known_events(events: DataFrame) -> DataFrame:
    """Drop events the engine does not know."""
    return events.where(F.col("event").isin(KNOWN_EVENTS))


def forwarded(events: DataFrame) -> DataFrame:
    """What goes on to the operators: known events with a record, without ``init``."""
    return known_events(events).where((F.col("event") != "init") & F.col("record").isNotNull())


def dead_letters(events: DataFrame) -> DataFrame:
    """Events whose data is not JSON."""
    return events.where(F.col("record").isNull())


def init_config(events: DataFrame, seq: str = "seq") -> DataFrame:
    """Key configuration of the latest ``init`` event: global_key, unique_fields.

    Fails when there is no ``init`` event at all.
    """
    latest = events.where((F.col("event") == "init") & F.col("record").isNotNull()).agg(
        F.max_by("record_text", seq).alias("config_text")
    )
    checked = latest.select(
        F.when(
            F.col("config_text").isNull(),
            F.raise_error(F.lit("no 'init' event: unique fields and global key are unknown")),
        ).otherwise(F.col("config_text")).alias("config_text")
    )
    config = checked.select("config_text", strict_json(F.col("config_text")).alias("config"))
    says = lambda k, flag: F.coalesce(
        F.to_json(F.try_variant_get(
            F.try_variant_get(F.col("config"), "$", "map<string,variant>")[k], f"$.{flag}", "variant")) == '"true"',
        F.lit(False))
    keys = F.json_object_keys("config_text")
    return config.select(
        F.try_element_at(F.filter(keys, lambda k: says(k, "global_key")), F.lit(-1)).alias("global_key"),
        F.filter(keys, lambda k: says(k, "unique") & ~says(k, "global_key")).alias("unique_fields"),
    )

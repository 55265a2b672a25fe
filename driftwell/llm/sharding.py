"""Shards of near equal bytes that keep equal texts together: balanced label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.common import number_within, whole_text
from driftwell.session import materialize

SHARDS = 16
ROUNDS = 24
#: A group of equal texts moves in at most this many pieces.
PIECES = 64
#: Requests to move into a shard are admitted in this many lots.
LOTS = 4096
PER_CELL = 20_000


def propagate(pieces: DataFrame, capacity: float, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """Move pieces (link, piece, bytes, shard) to the shard where most bytes of their link are.

    A round: every link takes the shard with its most bytes among those open to
    it; its pieces elsewhere ask to move there; each shard admits requests in a
    seeded order while their bytes fit what it has free, counted before anything
    leaves. A shard is open to a link if what it has free holds the smallest
    piece the link has elsewhere, and if it refused none of its pieces in the
    round before. So no shard ever exceeds its capacity by a move, and each move
    takes links together, never apart. Rounds end when nothing moves and nothing
    was refused. Only one sum per shard reaches the driver.
    """
    pieces = pieces.withColumn("refused", F.lit(None).cast("int"))
    for step in range(rounds):
        held = {r.shard: r.bytes for r in pieces.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}
        free = F.array(*[F.lit(float(max(0.0, capacity - (held.get(s) or 0)))) for s in range(shards)])
        of_link = Window.partitionBy("link")
        own = F.sum("bytes").over(Window.partitionBy("link", "shard"))
        voted = pieces.withColumns({
            "votes": F.struct(own.alias("bytes"), F.xxhash64("link", "shard").alias("tie"), F.col("shard").alias("shard")),
            "least": F.min(F.struct("bytes", "shard")).over(of_link), "shut": F.max("refused").over(of_link),
        })
        voted = voted.withColumn("second", F.min(F.when(F.col("shard") != F.col("least.shard"), F.col("bytes"))).over(of_link))
        smallest = F.when(F.col("shard") == F.col("least.shard"), F.col("second")).otherwise(F.col("least.bytes"))
        fits = (F.get(free, F.col("shard")) >= smallest) & ~F.coalesce(F.col("shut") == F.col("shard"), F.lit(False))
        wanted = F.max(F.when(fits, F.col("votes"))).over(of_link)
        voted = materialize(voted.withColumn("wanted", wanted).drop("least", "second", "shut", "refused"))
        asks = voted.where("wanted is not null and wanted > votes").withColumn("to", F.col("wanted.shard"))
        lot = F.pmod(F.xxhash64("link", "piece", F.lit(step)), F.lit(LOTS)).alias("lot")
        lots = asks.groupBy("to", lot).agg(F.sum("bytes").alias("bytes"))
        so_far = F.sum("bytes").over(Window.partitionBy("to").orderBy("lot"))
        admitted = lots.withColumn("so_far", so_far).where(F.col("so_far") <= F.get(free, F.col("to"))).select("to", "lot", F.lit(True).alias("admitted"))
        moved = voted.withColumn("to", F.when(F.col("wanted") > F.col("votes"), F.col("wanted.shard"))).withColumn("lot", lot)
        moved = moved.join(admitted, ["to", "lot"], "left")
        goes = F.coalesce(F.col("admitted"), F.lit(False))
        pieces = materialize(moved.select(
            "link", "piece", "bytes", "home", F.when(goes, F.col("to")).otherwise(F.col("shard")).alias("shard"),
            F.when(~goes, F.col("to")).alias("refused"), goes.alias("went"),
        ))
        if pieces.where("went or refused is not null").limit(1).count() == 0:
            break
        pieces = pieces.drop("went")
    return pieces.select("link", "piece", "bytes", "shard")


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, per_cell: int = PER_CELL) -> DataFrame:
    """A shard and a slot for each document; law ``bytes``: shards are near equal in size.

    Documents with equal texts are linked. They start spread evenly by hash of
    their id and then propagate (see ``propagate``) with a sixteenth (one part in
    ``shards``) of all bytes as capacity. Documents without a link have no
    neighbours: they fill what each shard lacks, so sizes end within one document
    of each other unless links alone fill a shard. A group larger than a shard
    spreads over as many as it needs.

    Slots number the documents of a shard from 0 without gaps. A null text has
    no bytes, size 1; null ids are dealt like any other; repeated rows get a slot
    each. An empty table gives an empty result. Other columns are ignored.
    """
    rows = materialize(
        docs.select(
            "doc_id",
            (F.octet_length(whole_text()) + 1).cast("bigint").alias("size"),
            F.crc32(whole_text().cast("binary")).alias("text_crc32"),
            F.xxhash64(whole_text()).alias("hash"),
        ).withColumn("link", F.xxhash64("hash", "text_crc32", "size")).drop("hash")
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    capacity = total / shards
    links = materialize(rows.groupBy("link").agg(F.count("*").alias("n")).where("n > 1").select("link"))
    piece = F.pmod(F.xxhash64("doc_id"), F.lit(PIECES)).cast("int")
    rows = materialize(
        rows.join(links.withColumn("linked", F.lit(True)), "link", "left")
        .withColumn("linked", F.coalesce("linked", F.lit(False))).withColumn("piece", piece)
    )
    home = (F.col("piece") % shards).cast("int")
    pieces = rows.where("linked").groupBy("link", "piece").agg(F.sum("size").alias("bytes"))
    pieces = materialize(pieces.withColumn("shard", home).withColumn("home", home))
    placed = materialize(propagate(pieces, capacity, shards, rounds))

    held = {r.shard: r.bytes for r in placed.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}
    loose = rows.where("not linked").select("doc_id", "size", "text_crc32")
    left = loose.agg(F.sum("size"), F.count("*")).first()
    lacks = [max(0.0, capacity - (held.get(s) or 0)) for s in range(shards)]
    ends, filled = [], 0.0
    for lack in lacks:
        filled += lack * (left[0] or 0) / (sum(lacks) or 1)
        ends.append(filled)
    # bytes of all loose documents before this one, in hash order
    cells = max(1, -(-left[1] // per_cell))
    loose = loose.withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(cells)))
    before = F.sum("bytes").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    starts = loose.groupBy("cell").agg(F.sum("size").alias("bytes")).select("cell", F.coalesce(before, F.lit(0)).alias("start"))
    inside = F.sum("size").over(Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1))
    filler = loose.withColumn("inside", F.coalesce(inside, F.lit(0))).join(starts, "cell")
    middle = F.col("start") + F.col("inside") + F.col("size") / 2
    filled_shard = F.size(F.filter(F.array(*[F.lit(x) for x in ends[:-1]]), lambda x: x <= middle))
    filler = filler.select("doc_id", "size", "text_crc32", filled_shard.cast("int").alias("shard"))
    tied = rows.where("linked").join(placed.select("link", "piece", "shard"), ["link", "piece"])
    kept = materialize(tied.select("doc_id", "size", "text_crc32", "shard").unionByName(filler))
    return number_within(kept, ["shard"], ["doc_id", "text_crc32", "size"], "slot", per_cell).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

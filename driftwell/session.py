"""Session helpers: a local session for tests, and lineage cutting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Parts of a hot key in a salted join.
SALTS = 64
_own_dirs: dict[str, str] = {}
_owner = threading.local()


def local_session(cpus: str = "8", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("driftwell")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # small inputs still go to all tasks
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.files.openCostInBytes", "64k")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as ``spark.checkpoint.dir`` names it.

    On a cluster it must be named. In a local session without one, as in tests,
    each application gets a temporary folder.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="driftwell-")
        atexit.register(shutil.rmtree, _own_dirs[context.applicationId], ignore_errors=True)
    return _own_dirs[context.applicationId]


@contextmanager
def owned_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that ``materialize`` stores inside this context when it ends.

    Results that are still needed must be written before.
    """
    outer, mine = getattr(_owner, "paths", None), []
    _owner.paths = mine
    try:
        yield
    finally:
        _owner.paths = outer
        jvm = spark.sparkContext._jvm
        for path in mine:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute once, reliably: a table in the shared folder outlives any executor.

    What reads it knows its size, so Catalyst can plan with it. Inside
    ``owned_tables`` it is removed at the end; else it stays until the folder's
    owner clears it.
    """
    path = f"{shared_dir(df.sparkSession)}/driftwell-{uuid.uuid4().hex}"
    if getattr(_owner, "paths", None) is not None:
        _owner.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """Rows dealt to all tasks by a hash of ``by``, before work that is costly per row.

    Stored rows are few bytes each, so that one split of a file holds very many, and few tasks would have them all.
    """
    return rows.repartition(*by)


def even_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join sides that both grow with the input, by a sorted merge.

    Adaptive execution goes by compressed bytes: rows that are few bytes in a
    shuffle are many in the driver, which holds a broadcast side whole.
    """
    return left.hint("merge").join(right.hint("merge"), on, how)


def lookup_join(rows: DataFrame, small: DataFrame, on: list[str], how: str = "left", salt: Column | None = None) -> DataFrame:
    """Join many rows to a metadata-sized side.

    In an inner join it is broadcast by name: adaptive execution may else take
    the rows for the smaller side, and put them in the driver and in one task.
    In others adaptive execution broadcasts it when its measured bytes are few.
    Beyond that, ``salt`` spreads a hot key on the left over ``SALTS`` tasks: the small
    side is repeated once per salt.
    """
    if how == "inner":
        return rows.join(F.broadcast(small), on, how)
    if salt is None:
        return rows.join(small, on, how)
    salted = rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")

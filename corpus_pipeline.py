"""A corpus pipeline: quality, exact duplicates, near duplicates, mixture, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftwell.llm.common import whole_text
from driftwell.llm.mixing import mix
from driftwell.llm.naming import identities
from driftwell.llm.packing import pack
from driftwell.llm.quality import THRESHOLD, scorer
from driftwell.llm.simhash import near_groups
from driftwell.session import materialize, owned_tables, shared_dir


def _free(docs: DataFrame, stem: str) -> str:
    """A column name that the input does not have, so that each of its columns stays as it is."""
    taken = {c.lower() for c in docs.columns}
    while stem in taken:
        stem = f"_{stem}"
    return stem


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """Documents with a number for each row, stored so that it stays the same, and the name of that column."""
    uid = _free(docs, "uid")
    return materialize(docs.withColumn(uid, F.monotonically_increasing_id())), uid


def _one_of_each(numbered: DataFrame, uid: str, groups: DataFrame, names: list[str], first: list[Column]) -> DataFrame:
    """The greatest row of each group by ``first``; ``groups`` has the columns ``names`` for each ``uid``.

    A row is carried by its number, whatever other rows have its id or text. Both
    sides grow with the corpus, so both are dealt by number. Rows equal in
    ``first`` are told apart by the hash of their text.
    """
    order = F.struct(*first, F.xxhash64(whole_text()).alias("hash"), F.col(uid).alias("uid")).alias("best")
    best = numbered.select(F.col(uid).alias("uid"), order).join(groups, "uid").groupBy(*names).agg(F.max("best").alias("best"))
    uids = materialize(best.select(F.col("best.uid").alias(uid)))
    return numbered.hint("merge").join(uids.hint("merge"), uid, "left_semi").drop(uid)


def _smallest_id() -> list[Column]:
    """An order by id downwards, a null id before all others."""
    return [F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("minus")]


def _longest() -> list[Column]:
    return [F.char_length(whole_text()).alias("n_chars")]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the quality classifier accepts, scored where they are read.

    Null and empty texts have the score of the class shares; without labels all
    documents stay. Rows with a null or repeated id are scored by their own text.
    """
    score = scorer(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(score(whole_text()) >= THRESHOLD)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each group of equal texts the longest, then the one with the smallest id.

    Null, empty and white texts are one group. A null id comes after all others;
    rows that share an id are told apart.
    """
    rows, uid = _numbered(docs)
    names = ["level", "name"]
    return _one_of_each(rows, uid, identities(rows, uid=uid).select("uid", *names), names, _longest() + _smallest_id())


def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9 with its own shingle length and radius: of each component the smallest id, then the longest.

    Texts without words are one group. A null id comes after all others; rows
    that share an id are told apart.
    """
    rows, uid = _numbered(docs)
    return _one_of_each(rows, uid, near_groups(rows, uid), ["root"], _smallest_id() + _longest())


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: as many copies of each document as the mix takes; copies are repeated rows.

    Texts without words are taken no time. Rows are numbered, so that rows that
    share an id, null included, have copies of their own.
    """
    rows, uid = _numbered(docs)
    size, copies = F.col("taken") / F.col("size"), _free(rows, "copies")
    taken = materialize(mix(rows, uid=uid).where("taken > 0").select(F.col("uid").alias(uid), size.cast("int").alias(copies)))
    both = rows.hint("merge").join(taken.hint("merge"), uid)
    copy = _free(both, "copy")
    return both.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: pieces of the documents in length buckets and batches.

    Texts without words have one empty piece and no bucket.
    """
    return pack(docs)


STAGES = [
    ("quality classifier", good),
    ("exact dedup", distinct_texts),
    ("SimHash near-dedup", distinct_contents),
    ("mixing to target weights", mixture),
    ("packing", packed),
]

#: The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is stored and read again.

    Columns of the input keep their names and values, whatever they are called.
    An empty table gives an empty result. Texts of any length are taken whole.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        with owned_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)

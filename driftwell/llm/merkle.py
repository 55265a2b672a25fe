"""A Merkle manifest of a dataset: trees per language, folded superblock by superblock."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.common import id_text, number_in_order, with_id
from driftwell.session import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of the tree that one group folds: 2 to this power of nodes.
HEIGHT = 10
TAMPER_EVERY = 7


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with its length in front, so that no two rows have the same fields run together; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    return F.sha2(F.concat(*[field(changed.get(name, F.col(name))) for name in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """tree, pos, doc_id, node and tampered: every row as a leaf, at its place in the tree of its lang.

    Texts are read once; only digests are sorted. The order is by lang, doc_id
    (null last) and digest, by range partitions, so that a lang with most rows
    is many partitions; a place is the rows of the lang in the partitions before
    and the place inside.
    """
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    changed = F.when(chosen & F.col("n_chars").isNotNull(), leaf(n_chars=F.col("n_chars") + 1))
    rows = materialize(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), field(F.col("lang")).alias("tree"), leaf().alias("node"), changed.alias("tampered")
    ))
    order = [F.col("doc_id").asc_nulls_last(), F.col("node")]
    dealt = materialize(rows.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id()))
    before = F.sum("count").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # one row per partition and lang in it
    starts = dealt.groupBy("tree", "part").count().select("tree", "part", F.coalesce(before, F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order)) - 1
    placed = dealt.withColumn("inside", inside).join(starts, ["tree", "part"])
    return materialize(placed.select("tree", (F.col("start") + F.col("inside")).alias("pos"), "doc_id", "node", "tampered"))


def reduced(nodes: list[str], block: int, height: int) -> list[list[str]]:
    """The nodes of a superblock level by level, the given ones first.

    Block 0 is folded until one node remains, which takes ``height`` levels if it
    is full. Later blocks are always folded that far: in a tree of several
    blocks a node without a neighbour goes up alone.
    """
    levels = [nodes]
    while len(levels[-1]) > 1 or (block and len(levels) <= height):
        last = levels[-1]
        levels.append([digest("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """What node ``at`` meets on its way up: L or R and the sibling, or S where it has none."""
    out = []
    for level in levels[:-1]:
        other = at ^ 1
        out.append("S" if other >= len(level) else ("L" if other < at else "R") + level[other])
        at >>= 1
    return out


def folded(node: str, path: list[str]) -> str:
    """The root that a node and its siblings lead to."""
    for step in path:
        node = digest({"L": step[1:] + node, "R": node + step[1:], "S": node}[step[0]])
    return node


def climb(nodes: DataFrame, height: int) -> list[DataFrame]:
    """Tables (tree, pos, node): ``nodes``, then the tops of their superblocks, and so on up to one root per tree."""

    def top(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        nodes = rows.sort_values("pos")["node"].tolist()
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "node": [reduced(nodes, key[1], height)[-1][0]]})

    floors = [nodes.select("tree", "pos", "node")]
    while len(floors) == 1 or not floors[-1].where("pos > 0").isEmpty():
        block = F.shiftright("pos", height).alias("block")
        floors.append(materialize(floors[-1].groupBy("tree", block).applyInPandas(top, "tree string, pos bigint, node string")))
    return floors


def descend(floors: list[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """The paths of the nodes on floor 1, from the paths ``outer`` (tree, pos, path) of those on the last floor.

    On each floor the nodes and the path of their superblock's top are
    cogrouped by superblock; the group is folded again for what its nodes meet
    inside.
    """

    def paths(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels, rest = reduced(rows["node"].tolist(), key[1], height), list(above["path"].iloc[0])
        return pd.DataFrame({"tree": rows["tree"], "pos": rows["pos"], "path": [siblings(levels, i) + rest for i in range(len(rows))]})

    for floor in floors[-2:0:-1]:
        below = floor.groupBy("tree", F.shiftright("pos", height).alias("block"))
        outer = materialize(below.cogroup(outer.groupBy("tree", "pos")).applyInPandas(paths, "tree string, pos bigint, path array<string>"))
    return outer


COLUMNS = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and the root its tampered form leads to; one row per input row.

    Up: superblocks of 2 ** ``height`` neighbours are folded to their tops, the
    tops in superblocks again, until each lang has one subroot; the subroots,
    in order of lang, are one more such tree. Down: each floor's nodes get what
    lies outside their superblock. At the end leaves and the outer nodes of
    their superblock are cogrouped, and one function folds the superblock, joins
    the proofs and recomputes the roots. No group has more than 2 ** ``height``
    nodes, whatever a lang holds; only the root reaches the driver.

    Rows of one lang ascend by doc_id, null ids last, rows of one id by digest.
    Nulls have a leaf like any value; repeated rows are leaves of their own; an
    id that is null is never tampered with. Texts of any length are hashed where
    they are read. An empty table gives an empty result. Other columns are
    ignored.
    """
    rows = leaves(docs)
    floors = climb(rows, height)
    lang = F.when(F.col("tree") != "-", F.expr("substring(tree, instr(tree, ':') + 1)"))
    langs = floors[-1].select(F.col("tree").alias("lang_tree"), lang.alias("lang"), "node")
    langs = materialize(number_in_order(langs, [F.col("lang").asc_nulls_first()], "pos").select("lang_tree", F.lit("").alias("tree"), "pos", "node"))
    upper = climb(langs, height)
    top = upper[-1].first()
    root = top.node if top else ""
    # the tree of the subroots, folded once more for their own paths
    outer = descend([langs.limit(0), *upper], upper[-1].select("tree", "pos", F.array().cast("array<string>").alias("path")), height)
    subroots = materialize(langs.join(outer.drop("tree"), "pos").select(F.col("lang_tree").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "path", F.col("node").alias("subroot")))
    outer = descend(floors, subroots.select("tree", "pos", "path"), height)
    outer = materialize(outer.join(subroots.select("tree", "subroot"), "tree").withColumn("root", F.lit(root)))

    def finish(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        nodes, up = rows["node"].tolist(), above.iloc[0]
        levels, rest, out = reduced(nodes, key[1], height), list(up["path"]), []
        for i, (doc_id, node, tampered) in enumerate(zip(rows["doc_id"], nodes, rows["tampered"], strict=True)):
            path = siblings(levels, i) + rest
            reached = folded(tampered if isinstance(tampered, str) else node, path)
            out.append((doc_id, node, up["subroot"], up["root"], digest("".join(s[1:] for s in path)), reached, reached == up["root"]))
        return pd.DataFrame(out, columns=[c.split()[0] for c in COLUMNS.split(", ")])

    rows = rows.select("tree", F.shiftright("pos", height).alias("block"), "pos", id_text().alias("doc_id"), "node", "tampered")
    return with_id(rows.groupBy("tree", "block").cogroup(outer.groupBy("tree", "pos")).applyInPandas(finish, COLUMNS))


ORACLE_SQL = r"""
WITH RECURSIVE
t AS (SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS tbl
      FROM (SELECT unnest(range(256)) AS i)),
f AS (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
             coalesce(strlen(text) || ':' || text, '-') AS z FROM documents),
g AS (SELECT doc_id, lang, sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS leaf,
             CASE WHEN xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                                       lambda c, b: xor(c // 256, tbl[xor(c, b) % 256 + 1])), 4294967295) % 7 = 0
                  THEN sha256(a || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || z) END AS tampered FROM f, t),
l AS MATERIALIZED (SELECT *, row_number() OVER () AS uid, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos,
             dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n FROM g),
up AS (SELECT tree, 0 AS lvl, pos, leaf AS node, n FROM l
       UNION ALL SELECT tree, lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (max(n) + 1) // 2 FROM up WHERE n > 1 GROUP BY tree, lvl, pos // 2),
subs AS (SELECT tree, node, lvl AS height, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS lvl, tree AS pos, node, n FROM subs
        UNION ALL SELECT lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (max(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, pos // 2),
steps AS (
  SELECT l.uid, lv.lvl AS k, (l.pos // lv.w) % 2 AS odd, s.node AS sib
  FROM l JOIN subs u USING (tree) JOIN (SELECT i AS lvl, (1::BIGINT << i) AS w FROM (SELECT unnest(range(40)) AS i)) lv ON lv.lvl < u.height
  LEFT JOIN up s ON s.tree = l.tree AND s.lvl = lv.lvl AND s.pos = xor(l.pos // lv.w, 1)
  UNION ALL
  SELECT l.uid, u.height + lv.lvl, (l.tree // lv.w) % 2, s.node
  FROM l JOIN subs u USING (tree) JOIN (SELECT i AS lvl, (1::BIGINT << i) AS w FROM (SELECT unnest(range(40)) AS i)) lv ON lv.lvl < (SELECT max(lvl) FROM top)
  LEFT JOIN top s ON s.lvl = lv.lvl AND s.pos = xor(l.tree // lv.w, 1)),
fold AS (SELECT uid, 0 AS k, coalesce(tampered, leaf) AS node FROM l
         UNION ALL SELECT f.uid, f.k + 1, sha256(CASE WHEN s.sib IS NULL THEN f.node WHEN s.odd = 1 THEN s.sib || f.node ELSE f.node || s.sib END) FROM fold f JOIN steps s ON s.uid = f.uid AND s.k = f.k),
reached AS (SELECT uid, arg_max(node, k) AS node FROM fold GROUP BY uid),
proof AS (SELECT uid, sha256(coalesce(string_agg(sib, '' ORDER BY k), '')) AS proof FROM steps GROUP BY uid),
r AS (SELECT node AS root FROM top WHERE n = 1)
SELECT l.doc_id, l.leaf, subs.node AS subroot, r.root, coalesce(proof.proof, sha256('')) AS proof_sha256, reached.node AS folded_root, reached.node = r.root AS verified
FROM l JOIN subs USING (tree) JOIN reached USING (uid) LEFT JOIN proof USING (uid), r
"""

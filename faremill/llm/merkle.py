"""Merkle manifest of a table: digests of rows, groups and the whole, and proofs of every row.

1. Every row becomes a leaf (sha256 of its columns). The leaves of a group are ranked in the order of
   their ids, by range partitions and the counts of these, never in one window over a group.
2. Aligned blocks of ``BLOCK`` leaves are trees of their own, built in one task each. The blocks' roots
   are the leaves of the next round, until each group has one root; the groups' roots, in the order of
   their names, are one more group. What a block needs from above is its path: for each upper level the
   digests left and right of its ancestor.
3. Trees are persistent: a tampered leaf makes a version that shares all untouched nodes with the first
   one and copies only its ancestors. Inside the block the copy is a new ``Node`` at each level; above
   it the version continues along the block's path, so versions need no further shuffle.

A block has at most ``BLOCK`` leaves and a path of some hundred bytes a level, so no group, however
large, meets in one task, and nothing but the count of levels reaches the driver.

Defined results: nulls are ``-`` in a leaf, so they differ from empty texts; a null group comes first;
null ids come first in their group and are never tampered with; repeated ids are ordered by their
leaves, and equal rows take successive places; a group of one row has that leaf as its root, as has a
table of one group; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.llm.common import ascii_lower, small_side, stored

#: Consecutive nodes under one parent, and the levels and leaves of a block.
RUN, DEEP = 16, 2
BLOCK = RUN**DEEP
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"
PROVED = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


@dataclass(frozen=True, slots=True)
class Node:
    digest: str
    children: tuple[Node, ...] = ()


def parent(children: Sequence[Node]) -> Node:
    return Node(digest("".join(c.digest for c in children)), tuple(children))


def grown(leaves: Sequence[str], levels: int | None = None) -> tuple[Node, int]:
    """A tree and its levels: until one node remains, or exactly ``levels`` where the group goes on above."""
    row, made = [Node(leaf) for leaf in leaves], 0
    while len(row) > 1 if levels is None else made < levels:
        row, made = [parent(row[i : i + RUN]) for i in range(0, len(row), RUN)], made + 1
    return row[0], made


def trail(place: int, levels: int) -> list[int]:
    """Which child to take at each level, from the top."""
    return [place // RUN**level % RUN for level in reversed(range(levels))]


def replaced(root: Node, steps: Sequence[int], leaf: str) -> Node:
    """A version with another leaf; only the ancestors on the way are new, all else is shared."""
    if not steps:
        return Node(leaf)
    at = steps[0]
    below = replaced(root.children[at], steps[1:], leaf)
    return parent((*root.children[:at], below, *root.children[at + 1 :]))


def siblings(root: Node, steps: Sequence[int]) -> list[tuple[str, str]]:
    """The digests left and right of the path, from the lowest level up."""
    found, node = [], root
    for at in steps:
        kids = [c.digest for c in node.children]
        found.append(("".join(kids[:at]), "".join(kids[at + 1 :])))
        node = node.children[at]
    return found[::-1]


def folded(leaf: str, path: Sequence[tuple[str, str]]) -> str:
    for before, after in path:
        leaf = digest(before + leaf + after)
    return leaf


# --- leaves and their places ------------------------------------------------------------


def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column, names: Sequence[str] = COLUMNS) -> Column:
    """The leaf of a row whose last column is replaced by ``text``."""
    return F.sha2(F.concat(*(_field(F.col(c)) for c in names[:-1]), _field(text)), 256)


def leaves_of(docs: DataFrame, names: Sequence[str] = COLUMNS, one_in: int = 5) -> DataFrame:
    """grp, doc_id, leaf and, for one of ``one_in`` rows, the leaf of the text with A-Z lower-cased."""
    doc_id, group, text = F.col(names[0]), F.col(names[1]), F.col(names[-1])
    hit = F.crc32(doc_id.cast("string")) % one_in == 0
    return docs.select(
        # a null group sorts before all others, and joins like them
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("grp"),
        doc_id.alias("doc_id"),
        leaf_of(text, names).alias("leaf"),
        F.when(hit, leaf_of(ascii_lower(text), names)).alias("tampered"),
    )


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """Adds place (from 0, by ``order``) and size (rows) in each ``grp``; written to the shared folder."""
    dealt = df.withColumn("tie", F.monotonically_increasing_id())
    keys = ["grp", *order, "tie"]
    dealt = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    laid = stored(dealt.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "merkle-leaves")
    whole = Window.partitionBy("grp")  # one row per partition of the group
    runs = laid.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "grp",
        "part",
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("size"),
    )
    placed = laid.join(small_side(runs), ["grp", "part"])
    return placed.withColumn("place", F.col("at") + F.col("shift")).drop("part", "at", "shift")


# --- trees, block by block --------------------------------------------------------------


def _tree(frame: pd.DataFrame) -> tuple[pd.DataFrame, Node, int]:
    frame = frame.astype({"grp": object, "leaf": object}).sort_values("place", kind="stable")
    root, levels = grown(frame["leaf"].tolist(), DEEP if frame["size"].iloc[0] > BLOCK else None)
    return frame, root, levels


def _block_root(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    size = -(-int(frame["size"].iloc[0]) // BLOCK)
    return pd.DataFrame({"grp": [key[0]], "place": [key[1]], "size": [size], "leaf": [_tree(frame)[1].digest]})


def _block_paths(frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    frame, root, levels = _tree(frame)
    upper, top = _path_of(above), above["top"].iloc[0]
    path = [[*siblings(root, trail(p % BLOCK, levels)), *upper] for p in frame["place"]]
    return pd.DataFrame({"grp": frame["grp"], "place": frame["place"], "path": path, "top": top})


def _path_of(above: pd.DataFrame) -> list[tuple[str, str]]:
    return [(step["before"], step["after"]) for step in above["path"].iloc[0]]


def _proofs(frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Every leaf's proof, and its version's root by the path-copying tree."""
    frame, root, levels = _tree(frame)
    upper = _path_of(above)
    upper_text = "".join(before + after for before, after in upper)
    subroot, top = above["subroot"].iloc[0], above["top"].iloc[0]
    first = folded(root.digest, upper)  # the version that all untouched leaves share
    proofs, ends = [], []
    for place, tampered in zip(frame["place"], frame["tampered"]):
        steps = trail(place % BLOCK, levels)
        mine = "".join(before + after for before, after in siblings(root, steps))
        proofs.append(digest(mine + upper_text))
        ends.append(first if tampered is None else folded(replaced(root, steps, tampered).digest, upper))
    made = pd.DataFrame({"doc_id": frame["doc_id"].astype(object), "leaf": frame["leaf"], "subroot": subroot, "root": top})
    return made.assign(proof_sha256=proofs, folded_root=ends, verified=[end == top for end in ends])


def _by_block(nodes: DataFrame):
    return nodes.withColumn("block", F.floor(F.col("place") / BLOCK)).groupBy("grp", "block")


def roots(nodes: DataFrame) -> DataFrame:
    """(grp, place, size, leaf) of the aligned blocks of nodes, which are nodes themselves."""
    light = nodes.select("grp", "place", "size", "leaf")
    return stored(_by_block(light).applyInPandas(_block_root, "grp string, place long, size long, leaf string"), "merkle-roots")


def paths(nodes: DataFrame) -> DataFrame:
    """(grp, place, path, top): the path of every node to the root of its group."""
    if nodes.agg(F.max("size")).first()[0] in (None, 1):
        empty = F.array().cast(PATH)
        return nodes.select("grp", "place", empty.alias("path"), F.col("leaf").alias("top"))
    above = paths(roots(nodes))
    made = _by_block(nodes.select("grp", "place", "size", "leaf")).cogroup(
        above.withColumnRenamed("place", "block").groupBy("grp", "block")
    )
    return stored(made.applyInPandas(_block_paths, f"grp string, place long, path {PATH}, top string"), "merkle-paths")


def manifest(docs: DataFrame, names: Sequence[str] = COLUMNS, one_in: int = 5) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    ``names``: the id, the group, further columns and last the text that tampering lower-cases.
    """
    kind = docs.schema[names[0]].dataType.simpleString()
    nodes = ranked(leaves_of(docs, names, one_in), "doc_id", "leaf")
    inside = paths(roots(nodes))  # of the blocks, to the roots of their groups
    subroots = inside.where(F.col("place") == 0).select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("top").alias("leaf"))
    tops = ranked(subroots, "name")
    outside = paths(tops).select("place", F.col("path").alias("rest"), F.col("top").alias("root"))
    named = tops.select("place", "name").join(outside, "place").select(F.col("name").alias("grp"), "rest", "root")
    above = inside.join(named, "grp").select(
        "grp",
        F.col("place").alias("block"),
        F.concat("path", "rest").alias("path"),
        F.col("top").alias("subroot"),
        F.col("root").alias("top"),
    )
    # ids travel as text: pandas would make floats of integers beside a null
    named_rows = _by_block(nodes.withColumn("doc_id", F.col("doc_id").cast("string")))
    proved = named_rows.cogroup(above.groupBy("grp", "block")).applyInPandas(_proofs, PROVED)
    return proved.withColumn("doc_id", F.col("doc_id").cast(kind))


# --- the same in SQL --------------------------------------------------------------------


def _climb(name: str, levels: int) -> str:
    """CTEs of the levels above ``{name}0`` (grp, pos, n, digest), and each node's siblings."""
    parts = []
    for k in range(levels):
        by = "OVER (PARTITION BY grp, pos // 16 ORDER BY pos ROWS BETWEEN"
        parts.append(
            f"""{name}s{k} AS (SELECT grp, pos, n,
              coalesce(string_agg(digest, '') {by} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
              coalesce(string_agg(digest, '') {by} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"""
        )
        parts.append(
            f"""{name}{k + 1} AS (SELECT grp, pos // 16 AS pos, (n + 15) // 16 AS n,
              CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE min(digest) END AS digest
              FROM {name}{k} GROUP BY grp, pos // 16, n)"""
        )
    return ",\n".join(parts)


def _walk(name: str, start: str, levels: int, final: str) -> str:
    """CTEs that carry (id, grp, pos, proof, fold) from ``start`` up the levels of ``name``."""
    parts, before = [], start
    for k in range(levels):
        here = f"{final}{k}" if k < levels - 1 else final
        parts.append(
            f"""{here} AS (SELECT w.* REPLACE (w.pos // 16 AS pos,
                CASE WHEN s.n > 1 THEN w.proof || s.l || s.r ELSE w.proof END AS proof,
                CASE WHEN s.n > 1 THEN sha256(s.l || w.fold || s.r) ELSE w.fold END AS fold)
              FROM {before} w JOIN {name}s{k} s ON w.grp = s.grp AND w.pos = s.pos)"""
        )
        before = here
    return ",\n".join(parts)


def manifest_sql(levels: int = 7, upper: int = 5) -> str:
    """The result over ``documents``; 16**levels rows a source and 16**upper sources at most."""
    from faremill.llm.sql_text import ascii_lower_sql, crc32_sql, crc_table

    fields = [
        f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')" for c in COLUMNS
    ]
    lowered = fields[-1].replace("text", ascii_lower_sql("text"))
    return f"""
WITH {crc_table()},
leaves AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS grp,
    sha256({" || ".join(fields)}) AS leaf,
    CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN sha256({" || ".join([*fields[:-1], lowered])}) END AS tampered
  FROM documents CROSS JOIN crc
),
placed AS (
  SELECT *, row_number() OVER () AS id, count(*) OVER (PARTITION BY grp) AS n,
    row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaves
),
a0 AS (SELECT grp, pos, n, leaf AS digest FROM placed),
{_climb("a", levels)},
subs AS (SELECT grp AS name, digest FROM a{levels}),
b0 AS (SELECT '' AS grp, row_number() OVER (ORDER BY encode(name)) - 1 AS pos, count(*) OVER () AS n, digest, name FROM subs),
{_climb("b", upper)},
start AS (SELECT id, grp, pos, '' AS proof, coalesce(tampered, leaf) AS fold FROM placed),
{_walk("a", "start", levels, "inside")},
middle AS (SELECT i.id, '' AS grp, b.pos, i.proof, i.fold FROM inside i JOIN b0 b ON i.grp = b.name),
{_walk("b", "middle", upper, "walked")}
SELECT p.doc_id, p.leaf, s.digest AS subroot, t.digest AS root, sha256(w.proof) AS proof_sha256,
  w.fold AS folded_root, w.fold = t.digest AS verified
FROM placed p JOIN walked w USING (id) JOIN subs s ON s.name = p.grp CROSS JOIN b{upper} t"""

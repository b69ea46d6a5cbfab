"""Merkle manifest of a dataset: one tree per group of rows, one tree over the groups.

A row's leaf is the SHA-256 (lower-case hex) of its fields. In each group the leaves ascend by
id; every three consecutive nodes become their hash until one is left, and the groups' nodes,
ascending by group, become the root in the same way.

Trees are cut into superblocks of 3^7 nodes. Superblocks are reduced to one node each, those
nodes form the next layer, and so on (a layer is 2187 times smaller than the one below). On the
way down the nodes of each layer meet the outer nodes of their superblock: both are cogrouped
by superblock, and one function finishes the reduction inside it, joins the proofs and, for the
leaves, folds the leaf that was read back up to the root. No task holds more than a superblock.

* A null field counts as ``-``; any other as its UTF-8 byte count, ``:`` and its value.
* A row without id comes first in its group; rows without group form the first group.
* Rows with one id in one group ascend by leaf. Equal rows have one leaf each and a proof each;
  which copy has which of these proofs is not fixed, the set of results is.
* An empty table gives no rows. A dataset of one row has its leaf as root and an empty proof.
* Only the named fields are read; other columns, whatever their names, take no part.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import findable, written
from quarrylake.llm.ordered import ranked

ARITY = 3
#: Heights within a superblock, which thus has at most 2187 nodes.
HEIGHTS = 7
#: Characters of a digest.
DIGEST = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(text: str) -> str:
    return sha256(text.encode("ascii")).hexdigest()


def leaf(values: dict[str, Column]) -> Column:
    """Hash of the values in their order, each with its length, so that no two rows share an input."""
    parts = []
    for value in values.values():
        value = value.cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _heights(members: int, most: int) -> int:
    """How often a superblock of a tree with so many nodes in this layer is reduced."""
    heights = 0
    while heights < most and members > ARITY**heights:
        heights += 1
    return heights


def _levels(nodes: list[str], heights: int) -> list[list[str]]:
    levels = [nodes]
    for _ in range(heights):
        below = levels[-1]
        levels.append([_hash("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return levels


def _paths(levels: list[list[str]]) -> list[list[tuple[int, str]]]:
    """Of each node of the lowest level: its place in its run and the run's others, height by height."""
    paths: list[list[tuple[int, str]]] = [[] for _ in levels[-1]]
    for nodes in reversed(levels[:-1]):
        above, paths = paths, []
        for i in range(len(nodes)):
            start, place = i - i % ARITY, i % ARITY
            others = nodes[start:i] + nodes[i + 1 : start + ARITY]
            paths.append([(place, "".join(others)), *above[i // ARITY]])
    return paths


def fold(node: str, path: list[tuple[int, str]]) -> str:
    """The node at the end of a path of (place in the run, the run's others)."""
    for place, others in path:
        node = _hash(others[: place * DIGEST] + node + others[place * DIGEST :])
    return node


def _by_superblock(nodes: DataFrame, most: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("rank") / ARITY**most).cast("long"))


def _reduced(most: int, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("rank")
    members = int(group["members"].iloc[0])
    top = _levels(list(group["node"]), _heights(members, most))[-1]
    return pd.DataFrame(
        {
            "tree": [group["tree"].iloc[0]],
            "rank": [int(group["block"].iloc[0])],
            "members": [-(-members // ARITY**most)],
            "node": top,
        }
    )


def _climb(nodes: DataFrame, most: int, purpose: str) -> tuple[list[DataFrame], DataFrame]:
    """The layers (tree, rank, members, node) of all trees, and each tree's last node with its layer."""
    layers, ends = [nodes], []
    while True:
        above = _by_superblock(layers[-1].select("tree", "rank", "members", "node"), most).groupBy("tree", "block")
        above = written(above.applyInPandas(lambda group: _reduced(most, group), "tree string, rank long, members long, node string"), purpose)
        ends.append(above.where("members = 1").select("tree", "node", F.lit(len(layers) - 1).alias("layer")))
        rest = above.where("members > 1")
        if rest.isEmpty():
            break
        layers.append(rest)
    last = ends[0]
    for more in ends[1:]:
        last = last.unionByName(more)
    return layers, last


#: The outer nodes of superblocks: one row per height above it, with the run's others.
OUTER = "layer int, tree string, block long, height int, place int, others string, in_top boolean"


def _outer_path(outer: pd.DataFrame) -> list[tuple[int, str, bool]]:
    outer = outer.sort_values("height")
    return list(zip(map(int, outer["place"]), outer["others"], map(bool, outer["in_top"])))


def _descended(most: int, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The outer nodes of the superblock that lies below each node."""
    rows = []
    if len(nodes):
        nodes = nodes.sort_values("rank")
        above = _outer_path(outer)
        inside = _paths(_levels(list(nodes["node"]), _heights(int(nodes["members"].iloc[0]), most)))
        in_top = bool(nodes["in_top"].iloc[0])
        for layer, tree, block, path in zip(nodes["below_layer"], nodes["below"], nodes["below_block"], inside):
            whole = [(place, others, in_top) for place, others in path] + above
            rows += [(layer, tree, block, height, *step) for height, step in enumerate(whole)]
    return pd.DataFrame(rows, columns=["layer", "tree", "block", "height", "place", "others", "in_top"])


def _descend(layer: int, nodes: DataFrame, outer: DataFrame, most: int) -> DataFrame:
    outer = outer.where(F.col("layer") == layer)
    met = _by_superblock(nodes, most).groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
    return written(met.applyInPandas(lambda inner, above: _descended(most, inner, above), OUTER), "manifest-outer")


PROVED = (
    "id string, grouped string, rank long, leaf string, subroot string, root string,"
    " proof string, path string, folded_root string, verified boolean"
)


def _proved(most: int, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    columns = [field.split()[0] for field in PROVED.split(", ")]
    if not len(rows):
        return pd.DataFrame(columns=columns)
    rows = rows.sort_values("rank")
    levels = _levels(list(rows["node"]), _heights(int(rows["members"].iloc[0]), most))
    above = _outer_path(outer)
    subroot = fold(levels[-1][0], [(place, others) for place, others, top in above if not top])
    root = fold(subroot, [(place, others) for place, others, top in above if top])
    outside = [(place, others) for place, others, _ in above]
    out = []
    for id_, grouped, rank, node, seen, inside in zip(
        rows["id"], rows["grouped"], rows["rank"], rows["node"], rows["seen"], _paths(levels)
    ):
        path = inside + outside
        folded = fold(seen if isinstance(seen, str) else node, path)
        shape = "".join(f"{place}{len(others) // DIGEST + 1}" for place, others in path)
        proof = "".join(others for _, others in path)
        out.append((id_, grouped, rank, node, subroot, root, proof, shape, folded, folded == root))
    return pd.DataFrame(out, columns=columns)


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_field: str = "doc_id",
    group_field: str = "source",
    seen: dict[str, Column] | None = None,
    heights: int = HEIGHTS,
) -> DataFrame:
    """Every row's id, group, rank, leaf, subroot, root and proof, and whether what was seen of it folds to the root.

    ``proof`` is the siblings' digests from the leaf to the root, ``path`` has for each height
    the row's place in its run and the run's length, one digit each. ``seen`` names fields that
    are read otherwise than they were (in an exchange, from a copy): ``folded_root`` starts at
    the leaf of the fields as seen. Superblocks have ``heights`` levels above their nodes.
    """
    findable(docs.sparkSession)
    kept = {name: F.col(name) for name in fields}
    seen_row = kept | (seen or {})
    changed = F.lit(False)
    for name in seen or {}:
        changed = changed | ~seen_row[name].eqNullSafe(kept[name])
    grouped = F.col(group_field).cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("+"), grouped), F.lit("")).alias("tree"),
        F.col(id_field).alias("sorted_id"),
        leaf(kept).alias("node"),
        F.when(changed, leaf(seen_row)).alias("seen"),
    )
    leaves = ranked(written(leaves, "manifest-leaves"), "tree", ["sorted_id", "node"], "manifest-ranked")
    leaves = written(leaves, "manifest-placed")

    layers, ends = _climb(leaves, heights, "manifest-layer")
    groups = ranked(
        ends.select(F.lit("").alias("tree"), F.col("tree").alias("below"), "node", F.col("layer").alias("below_layer")),
        "tree", ["below"], "manifest-groups",
    )
    groups = written(groups, "manifest-groups")
    tops, _ = _climb(groups, heights, "manifest-top")

    spark = docs.sparkSession
    outer = spark.createDataFrame([], OUTER)
    for layer in range(len(tops) - 1, 0, -1):
        outer = _descend(layer, _own(tops[layer], layer - 1, True), outer, heights)
    from_top = groups.withColumns({"below_block": F.lit(0).cast("long"), "in_top": F.lit(True)})
    from_top = _descend(0, from_top, outer, heights)

    outer = from_top
    for layer in range(len(layers) - 1, 0, -1):
        inner = _descend(layer, _own(layers[layer], layer - 1, False), outer, heights)
        outer = inner.unionByName(from_top.where(F.col("layer") == layer - 1))

    rows = _by_superblock(leaves, heights).select(
        "tree", "block", "rank", "members", "node", "seen",
        F.col("sorted_id").cast("string").alias("id"),
        F.when(F.col("tree") != "", F.substring("tree", 2, 2**31 - 1)).alias("grouped"),
    )
    met = rows.groupBy("tree", "block").cogroup(outer.where("layer = 0").groupBy("tree", "block"))
    proved = met.applyInPandas(lambda own, above: _proved(heights, own, above), PROVED)
    return proved.select(
        F.col("id").cast(docs.schema[id_field].dataType).alias(id_field),
        F.col("grouped").alias(group_field),
        "rank", "leaf", "subroot", "root", "proof", "path", "folded_root", "verified",
    )


def _own(nodes: DataFrame, below_layer: int, in_top: bool) -> DataFrame:
    """Nodes of a layer, each above the superblock of its rank in the layer below."""
    return nodes.withColumns(
        {
            "below_layer": F.lit(below_layer),
            "below": F.col("tree"),
            "below_block": F.col("rank"),
            "in_top": F.lit(in_top),
        }
    )

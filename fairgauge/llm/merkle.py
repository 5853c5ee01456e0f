"""Merkle manifest of a dataset in a van Emde Boas layout (operator 11).

Every row is a leaf: the SHA-256 of its fields, each written with its length. Leaves of one
``tree_col`` value ascend by id, and consecutive pairs become their hash (a last lone one:
its own hash) until one remains, the tree's subroot; the subroots, ordered by value, become
the root of the whole in the same way.

A tree is cut into aligned blocks of 2 ** ``height`` leaves. A block is built in one task
and kept as a row: its nodes stand in a byte array in van Emde Boas order, that is the top
half of its levels first, then each subtree of the bottom half, both laid out likewise, so
that a path from leaf to root touches few cache lines whatever their size. Addresses follow
from depth and index alone, for building as for fetching siblings. The blocks' roots are
the leaves of the next level of blocks, and so on until a tree has one block. On the way
back each block hands its children the path above them, so a leaf's proof needs its block's
row and one path.

What is shuffled are digests and ids, never fields; a task holds one block at a time,
however large a tree is. Leaves are numbered by ``number_rows``, without a window over a
tree.

Defined cases: a null field is ``-``; rows without id come first; rows of equal id ascend
by digest, equal ones are leaves of their own; a tree of one leaf has that as its subroot,
one subroot is the root; an empty table has no rows and no root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairgauge.llm.common import materialise, number_rows

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves of a block, as a power of two: 0.26 MB of nodes.
HEIGHT = 12
DIGEST = 32

BLOCK_SCHEMA = "tree string, block long, n int, nodes binary, root string, up string"
PATH_SCHEMA = "tree string, block long, above string"
PROOF_SCHEMA = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields: Sequence[str] = FIELDS, changed: dict[str, Column] | None = None) -> Column:
    """The leaf of a row; ``changed`` puts other values in the place of columns."""
    parts = []
    for name in fields:
        value = (changed or {}).get(name, F.col(f"`{name}`")).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


@lru_cache(maxsize=None)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Place of each node, by depth and index, in the layout of a tree of ``levels`` levels."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    below = addresses(levels - top)
    first = np.arange(1 << top)[:, None] * ((1 << (levels - top)) - 1) + (1 << top) - 1
    return addresses(top) + tuple((first + places).ravel() for places in below)


def levels_of(n: int) -> int:
    """Levels of nodes of a tree of n leaves."""
    return (n - 1).bit_length() + 1


def build_block(leaves: list[str], height: int) -> tuple[bytes, str, str]:
    """The nodes of a block in their layout, the root of the block as a tree of its own, and
    as one of several blocks of ``height``."""
    levels = levels_of(len(leaves))
    places = addresses(levels)
    nodes = np.zeros(((1 << levels) - 1, DIGEST), np.uint8)
    row = leaves
    for depth in range(levels - 1, -1, -1):
        nodes[places[depth][: len(row)]] = np.frombuffer(bytes.fromhex("".join(row)), np.uint8).reshape(-1, DIGEST)
        if depth:
            row = [digest("".join(row[k : k + 2])) for k in range(0, len(row), 2)]
    up = row[0]
    for _ in range(height - levels + 1):
        up = digest(up)
    return nodes.tobytes(), row[0], up


def siblings(nodes: bytes, n: int) -> list[list[str]]:
    """By level from the leaves: the sibling of each node ('' if it has none)."""
    levels, text = levels_of(n), nodes.hex()
    places, out = addresses(levels), []
    for depth in range(levels - 1, 0, -1):
        at = places[depth][:n].tolist()
        row = [text[2 * DIGEST * a : 2 * DIGEST * (a + 1)] for a in at]
        out.append([row[k ^ 1] if k ^ 1 < n else "" for k in range(n)])
        n = (n + 1) // 2
    return out


def step(side: int, sibling: str) -> str:
    """A step of a path as text: ``l``, ``r`` (where the sibling stands) or ``-``."""
    return ("l" if side else "r") + sibling if sibling else "-"


def steps(path: str) -> list[tuple[str, str]]:
    out, k = [], 0
    while k < len(path):
        width = 1 if path[k] == "-" else 1 + 2 * DIGEST
        out.append((path[k], path[k + 1 : k + width]))
        k += width
    return out


def fold(start: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and the steps of its path make."""
    for side, sibling in path:
        start = digest(sibling + start if side == "l" else start + sibling)
    return start


def _rest(n: int, height: int, above: str | None) -> str:
    """The steps behind those within a block of n leaves: a block that isn't its whole tree
    (``above`` is given) is hashed on to the height of the others first."""
    return "" if above is None else "-" * (height - levels_of(n) + 1) + above


def _built(leaves: DataFrame, height: int) -> DataFrame:
    """``tree, at, digest`` rows as blocks."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        nodes, root, up = build_block(group["digest"].tolist(), height)
        first = group.iloc[0]
        return pd.DataFrame({"tree": [first["tree"]], "block": [first["block"]], "n": [len(group)], "nodes": [nodes], "root": [root], "up": [up]})

    blocks = leaves.withColumn("block", F.shiftright("at", height))
    return blocks.groupBy("tree", "block").applyInPandas(build, BLOCK_SCHEMA)


@dataclass
class Forest:
    """Blocks by level, from the leaves' up, and ``tree, subroot`` of each tree."""

    levels: list[DataFrame]
    subroots: DataFrame
    height: int

    def _above(self, k: int) -> DataFrame | None:
        """``tree, block, above`` of the blocks of level k that aren't whole trees."""
        return self._handed_down(k + 1) if k + 1 < len(self.levels) else None

    def _with_above(self, k: int) -> DataFrame:
        """The blocks of level k with ``above``, their path to the subroot; null where the
        block is its whole tree."""
        above = self._above(k)
        if above is None:
            return self.levels[k].withColumn("above", F.lit(None).cast("string"))
        return self.levels[k].join(above, ["tree", "block"], "left")

    def _handed_down(self, k: int) -> DataFrame:
        height = self.height

        def hand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for tree, block, n, nodes, above in batch.itertuples(index=False, name=None):
                    own, rest = siblings(nodes, n), _rest(n, height, above)
                    ways = ["".join(step(x >> d & 1, row[x >> d]) for d, row in enumerate(own)) + rest for x in range(n)]
                    yield pd.DataFrame({"tree": tree, "block": [(block << height) + x for x in range(n)], "above": ways})

        return self._with_above(k).select("tree", "block", "n", "nodes", "above").mapInPandas(hand, PATH_SCHEMA)

    def blocks(self) -> DataFrame:
        """The blocks of the leaves with their paths above."""
        return self._with_above(0)

    def leaf_paths(self) -> DataFrame:
        """``tree, at, path`` of every leaf, for trees of few leaves."""
        return self._handed_down(0).withColumnsRenamed({"block": "at", "above": "path"})


def plant(leaves: DataFrame, path: str, height: int = HEIGHT) -> Forest:
    """The trees of ``tree, at, digest`` rows, each level of blocks written below ``path``."""
    spark, levels, done = leaves.sparkSession, [], []
    while True:
        place = f"{path}/level-{len(levels)}"
        _built(leaves, height).write.parquet(place)
        level = spark.read.schema(BLOCK_SCHEMA).parquet(place)
        levels.append(level)
        sizes = level.groupBy("tree").agg(F.count("*").alias("blocks"), F.max("root").alias("subroot"))
        done.append(sizes.where(F.col("blocks") == 1).select("tree", "subroot"))
        going = sizes.where(F.col("blocks") > 1).select("tree")
        if going.isEmpty():
            break
        leaves = level.select("tree", F.col("block").alias("at"), F.col("up").alias("digest")).join(going, "tree", "left_semi")
    subroots = done[0]
    for more in done[1:]:
        subroots = subroots.unionByName(more)
    return Forest(levels, materialise(subroots, "subroots"), height)


@dataclass
class Manifest:
    """``leaves``: tree, at, doc_id, leaf and what was carried; ``trees`` and ``top``: the
    trees and the one over their subroots; ``ways``: tree, subroot, and the path from it to
    the root. ``root`` is None for an empty table."""

    leaves: DataFrame
    trees: Forest
    top: Forest
    ways: DataFrame
    root: str | None


def write_manifest(
    docs: DataFrame, path: str, fields: Sequence[str] = FIELDS, tree_col: str = "lang", id_col: str = "doc_id",
    height: int = HEIGHT, carried: dict[str, Column] | None = None,
) -> Manifest:
    """Leaves and blocks of ``docs`` as tables below ``path``. ``carried`` are further
    columns of the leaves, by name."""
    spark = docs.sparkSession
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{tree_col}`").cast("string")), F.lit(""))
    more = [value.alias(name) for name, value in (carried or {}).items()]
    hashed = docs.select(tree.alias("tree"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), leaf(fields).alias("leaf"), *more)
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    numbered = number_rows(materialise(hashed, "merkle-leaves"), order, "at", within="tree")
    numbered.write.parquet(f"{path}/leaves")
    leaves = spark.read.schema(numbered.schema).parquet(f"{path}/leaves")
    trees = plant(leaves.select("tree", "at", F.col("leaf").alias("digest")), f"{path}/trees", height)
    ordered = materialise(number_rows(trees.subroots, [F.col("tree").asc()], "at"), "merkle-ordered")
    top = plant(ordered.select(F.lit("top").alias("tree"), "at", F.col("subroot").alias("digest")), f"{path}/top", height)
    ways = ordered.join(top.leaf_paths().select("at", F.col("path").alias("tail")), "at").drop("at")
    last = top.subroots.first()
    return Manifest(leaves, trees, top, materialise(ways, "merkle-ways"), last and last["subroot"])


def prove(manifest: Manifest, presented: str = "leaf") -> DataFrame:
    """Of every leaf: its subroot, the root, the digest of its proof, and the root that the
    column ``presented`` makes with the leaf's siblings."""
    height, root = manifest.trees.height, manifest.root

    def one_block(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        kept = block.iloc[0]
        n, own = int(kept["n"]), siblings(kept["nodes"], int(kept["n"]))
        rest = steps(_rest(n, height, kept["above"]) + kept["tail"])
        rest_text = "".join(s for _, s in rest)
        first, out = int(kept["block"]) << height, []
        for at, doc_id, of, shown in zip(rows["at"], rows["doc_id"], rows["leaf"], rows["presented"], strict=True):
            x = int(at) - first
            way = [("l" if x >> d & 1 else "r", row[x >> d]) for d, row in enumerate(own)]
            folded = fold(shown, way + rest)
            proof = digest("".join(s for _, s in way) + rest_text)
            out.append((doc_id, of, kept["subroot"], root, proof, folded, folded == root))
        return pd.DataFrame(out, columns=[c.split()[0] for c in PROOF_SCHEMA.split(", ")])

    blocks = manifest.trees.blocks().select("tree", "block", "n", "nodes", "above").join(manifest.ways, "tree")
    # Ids travel as text: pandas would turn a null among them and the rest into floats.
    rows = manifest.leaves.select(
        "tree", F.shiftright("at", height).alias("block"), "at", F.col("doc_id").cast("string"), "leaf", F.col(presented).alias("presented")
    )
    proved = rows.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInPandas(one_block, PROOF_SCHEMA)
    return proved.withColumn("doc_id", F.col("doc_id").cast("long"))

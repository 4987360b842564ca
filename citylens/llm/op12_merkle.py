"""Merkle manifest of a dataset as a persistent, path-copying tree.

A row is a leaf; leaves of one group (``lang``) ascend by id, and every run of
up to ``FAN`` consecutive nodes becomes their digest until one node, the
subroot, remains; the subroots, ordered by group, give the root the same way.

Method.  The tree of a group is cut into aligned blocks of ``FAN ** HEIGHT``
consecutive nodes.  A block is a small immutable tree in one task.  Every
tampered leaf creates a version of it: the ancestors on its path are copied,
all other nodes are shared with the untouched version.  Above the block the
versions go on in the task that holds their block: a block's row carries the
path of its block root through the upper blocks (the untouched siblings level
by level), so a version copies its upper ancestors from that path.  Upper
blocks are built by the same grouping of block roots, round by round.

Scale.  Texts are read once and never move: what is shuffled is 32 bytes a
digest and the id.  Positions come from a range partitioning by (group, id)
and running counts per partition, so a group that holds a third of all rows
spreads over many tasks; a task holds ``FAN ** HEIGHT`` (4,096) nodes and one
path of ``FAN * depth`` digests.  A round divides the number of nodes by 4,096,
so three rounds serve 6 * 10^10 rows.

Defined results.  NULL values are written ``-``; an empty text is ``0:``.  The
NULL group comes first and NULL ids before all others; rows of one id are
ordered by their leaf digest, and rows equal in both are interchangeable.  A
NULL id is never tampered with.  Empty table: no rows.  Very long texts are
hashed where they are read.  Only the named columns are read, so other columns
cannot clash.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylens.llm.common import materialise

# Nodes in a run, columns of a leaf, letters that tampering changes.
FAN = 8
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Levels in an aligned block.
HEIGHT = 4

MANIFEST = ("doc_id long, leaf string, subroot string, root string, siblings array<string>, "
            "folded_root string, verified boolean")
_NODES = "tree string, pos long, n long, digest binary"
_PATHS = "tree string, pos long, path string, subroot string, root string"


def H(digests) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Node(NamedTuple):
    """A node of an immutable tree; versions share nodes."""
    digest: str
    children: tuple = ()


def build(digests: list[str], height: int) -> Node:
    """The tree over a block's nodes, ``height`` levels up (a run may be short, even one node)."""
    nodes = [Node(d) for d in digests]
    for _ in range(height):
        runs = [tuple(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)]
        nodes = [Node(H(c.digest for c in run), run) for run in runs]
    return nodes[0]


def path_copy(node: Node, height: int, at: int, digest: str) -> Node:
    """A version of the tree in which leaf ``at`` has ``digest``: its ancestors are copied, the rest is shared."""
    if not height:
        return Node(digest)
    child, below = divmod(at, FAN ** (height - 1))
    children = node.children[:child] + (path_copy(node.children[child], height - 1, below, digest),) + node.children[child + 1:]
    return Node(H(c.digest for c in children), children)


def sibling_runs(node: Node, height: int, at: int) -> list[tuple[list[str], list[str]]]:
    """(left, right) siblings of leaf ``at`` and of its ancestors, from the leaf up."""
    runs = []
    while height:
        height -= 1
        child, at = divmod(at, FAN ** height)
        digests = [c.digest for c in node.children]
        runs.append((digests[:child], digests[child + 1:]))
        node = node.children[child]
    return runs[::-1]


def climb(n: int) -> int:
    """Levels of a block in a group of n nodes: up to HEIGHT, fewer if one node remains before."""
    height = 0
    while n > 1 and height < HEIGHT:
        n, height = -(-n // FAN), height + 1
    return height


def _written(path: list[tuple[list[str], list[str]]]) -> str:
    return "|".join("".join(left) + "," + "".join(right) for left, right in path)


def _read(path: str) -> list[tuple[str, str]]:
    return [tuple(level.split(",")) for level in path.split("|")] if path else []


def _block(table: pa.Table) -> tuple[pa.Table, list[str], int]:
    """A block's rows in order, their digests and the block's height."""
    table = table.sort_by("pos")
    n = table["n"][0].as_py() if table.num_rows else 0
    return table, [d.hex() for d in table["digest"].to_pylist()], climb(n)


def _block_root(table: pa.Table) -> pa.Table:
    table, digests, height = _block(table)
    n, first = table["n"][0].as_py(), table["pos"][0].as_py()
    row = {"tree": table["tree"][0].as_py(), "pos": first // FAN ** HEIGHT, "n": -(-n // FAN ** height),
           "digest": bytes.fromhex(build(digests, height).digest)}
    return pa.Table.from_pylist([row], pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())]))


_PATH_ROWS = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("path", pa.string()), ("subroot", pa.string()), ("root", pa.string())])


def _node_paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """Path to the root for every node of a block: its siblings in the block, then the block root's path."""
    nodes, digests, height = _block(nodes)
    if not digests:
        return pa.Table.from_pylist([], _PATH_ROWS)
    tree, up = build(digests, height), above.to_pylist()[0]
    rows = []
    for at, pos in enumerate(nodes["pos"].to_pylist()):
        here = _written(sibling_runs(tree, height, at))
        rows.append({"tree": up["tree"], "pos": pos, "path": "|".join(p for p in (here, up["path"]) if p),
                     "subroot": up["subroot"], "root": up["root"]})
    return pa.Table.from_pylist(rows, _PATH_ROWS)


_MANIFEST_ROWS = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                            ("siblings", pa.list_(pa.string())), ("folded_root", pa.string()), ("verified", pa.bool_())])


def _versions(leaves: pa.Table, above: pa.Table) -> pa.Table:
    """The manifest rows of a block of leaves: every tampered leaf is a version of the block's tree,
    continued through the upper blocks along the block root's path."""
    leaves, digests, height = _block(leaves)
    if not digests:
        return pa.Table.from_pylist([], _MANIFEST_ROWS)
    tree, up = build(digests, height), above.to_pylist()[0]
    upper = _read(up["path"])
    upper_siblings = [side[i:i + 64] for level in upper for side in level for i in range(0, len(side), 64)]
    rows = []
    for at, (doc_id, tampered) in enumerate(zip(leaves["doc_id"].to_pylist(), leaves["tampered"].to_pylist())):
        version = path_copy(tree, height, at, tampered.hex() if tampered is not None else digests[at])
        folded = version.digest
        for left, right in upper:
            folded = H((left, folded, right))
        siblings = [d for run in sibling_runs(tree, height, at) for side in run for d in side] + upper_siblings
        rows.append({"doc_id": doc_id, "leaf": digests[at], "subroot": up["subroot"], "root": up["root"], "siblings": siblings,
                     "folded_root": folded, "verified": folded == up["root"]})
    return pa.Table.from_pylist(rows, _MANIFEST_ROWS)


def leaf_digest(columns: tuple[str, ...], replaced: dict[str, Column] | None = None) -> Column:
    """Digest of a row's values, each ``-`` if NULL, else its UTF-8 length, ``:`` and the value."""
    values = [(replaced or {}).get(c, F.col(c)).cast("string") for c in columns]
    written = [F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in values]
    return F.sha2(F.concat(*written), 256)


def lower_cased(text_col: str = "text", id_col: str = "doc_id") -> Column:
    """The text as tampering leaves it: A-Z lower-cased where 3 divides the CRC of the id, else NULL."""
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate(text_col, UPPER, LOWER))


def numbered(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``pos``, the place of a row in its ``tree`` by ``order``, and ``n``, the rows of the tree.

    Rows are range partitioned by (tree, order) and written; a row's place is
    its number in its partition plus the tree's rows in earlier partitions.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())         # equal rows need not stay together
    keys = ["tree", *order, "_tie"]
    placed = materialise(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_tie").withColumns(
        {"_part": F.spark_partition_id(), "_seq": F.monotonically_increasing_id()}), label)
    counts = placed.groupBy("tree", "_part").agg(F.min("_seq").alias("_first"), F.count("*").alias("_rows"))
    by_tree = Window.partitionBy("tree")                                     # a row per tree and partition
    counts = counts.withColumns({
        "_before": F.coalesce(F.sum("_rows").over(by_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "n": F.sum("_rows").over(by_tree)})
    return placed.join(counts.drop("_rows"), ["tree", "_part"]).withColumn(
        "pos", F.col("_seq") - F.col("_first") + F.col("_before")).drop("_part", "_seq", "_first", "_before")


def _by_block(rows: DataFrame):
    return rows.withColumn("_block", F.expr(f"pos div {FAN ** HEIGHT}")).groupBy("tree", "_block")


def _levels(nodes: DataFrame, label: str) -> list[DataFrame]:
    """The nodes, their block roots, the block roots of those, ... until every tree has one."""
    levels = [nodes]
    while not levels[-1].where("n > 1").isEmpty():
        levels.append(materialise(_by_block(levels[-1].select("tree", "pos", "n", "digest")).applyInArrow(_block_root, _NODES), label))
    return levels


def _with_paths(nodes: DataFrame, paths: DataFrame, of, schema: str) -> DataFrame:
    """``of`` on every block of nodes and the path of its root."""
    roots = paths.withColumnRenamed("pos", "_block").groupBy("tree", "_block")
    return _by_block(nodes).cogroup(roots).applyInArrow(of, schema)


def _down(levels: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the lowest blocks' roots, from the paths of the trees' single nodes."""
    for nodes in reversed(levels[1:-1]):
        paths = _with_paths(nodes, paths, _node_paths, _PATHS)
    return paths


def manifest(docs: DataFrame, columns: tuple[str, ...] = LEAF_COLUMNS, id_col: str = "doc_id", group_col: str = "lang",
             tampered: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: leaf, subroot of its group, root, siblings from the leaf to the root (left to
    right, level by level), and the root folded from the tampered leaf (where ``tampered`` gives a value that is
    not NULL for one of the columns), else from the leaf itself."""
    if tampered is None:
        tampered = {"text": lower_cased("text", id_col)}
    changed = F.lit(False)
    for c in tampered.values():
        changed = changed | c.isNotNull()
    leaves = docs.select(
        F.when(F.col(group_col).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(group_col).cast("string"))).alias("tree"),
        F.col(id_col).cast("long").alias("doc_id"), F.unhex(leaf_digest(columns)).alias("digest"),
        F.when(changed, F.unhex(leaf_digest(columns, {k: F.coalesce(c, F.col(k)) for k, c in tampered.items()}))).alias("tampered"))
    nodes = materialise(numbered(materialise(leaves, "merkle-leaves"), ["doc_id", "digest"], "merkle-order"), "merkle-nodes")
    levels = _levels(nodes, "merkle-blocks")

    # the subroots, in the order of their groups, are the leaves of one more tree
    subroots = levels[-1].select(F.col("tree").alias("of"), F.lit("").alias("tree"), "digest")
    of_groups = materialise(numbered(subroots, ["of"], "merkle-groups"), "merkle-subroots")
    upper = _levels(of_groups.select("tree", "pos", "n", "digest"), "merkle-upper")
    root = upper[-1].select("tree", F.lit(0).cast("long").alias("pos"), F.lit("").alias("path"), F.lit("").alias("subroot"),
                            F.lower(F.hex("digest")).alias("root"))
    of_subroots = _with_paths(upper[0], _down(upper, root), _node_paths, _PATHS)
    top = of_groups.join(of_subroots.select("pos", "path", "root"), "pos").select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.lower(F.hex("digest")).alias("subroot"), "root")
    return _with_paths(nodes, materialise(_down(levels, top), "merkle-paths"), _versions, MANIFEST)

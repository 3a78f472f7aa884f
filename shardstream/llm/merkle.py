"""A Merkle manifest of a dataset: a tree over the rows of each group, and one over the groups.

Trees are append logs in postorder: a node is written when its last child is. Builders take aligned blocks of leaves and
write their nodes in that order, so each is a segment whose places follow from the number of its leaves alone; where a
node's siblings stand is computed, not searched. The roots of blocks are the leaves of the next round of builders, so
the rounds grow with the logarithm of the largest group, and no group is in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardstream.llm.common import add_columns, map_rows, partitions, pin

ARITY = 16
#: Levels of a builder: its block has ARITY ** LEVELS leaves.
LEVELS = 2

#: From a node to a root: on every level, the digests of the siblings before and after, each joined.
PATH = "array<struct<before: string, after: string>>"

Path = list[tuple[str, str]]


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column | str) -> Column:
    """A value as a manifest writes it: its length in UTF-8 bytes and itself, or ``-`` where it is null."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column | str]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def height(leaves: int, arity: int = ARITY) -> int:
    """Levels above the leaves; a lone leaf is its own root."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // arity), levels + 1
    return levels


def place(level: int, index: int, leaves: int, levels: int, arity: int = ARITY) -> int:
    """Place of a node in the postorder log of a tree of ``leaves`` leaves and ``levels`` levels, from 0.

    Before it stand the nodes of its own subtree, and on every level those of the subtrees that ended earlier. Up to its
    own level these are all nodes that begin before its last leaf, above it the complete ones before its first.
    """
    first = index * arity**level
    end = min(first + arity**level, leaves)
    return sum(-(-end // arity**k) for k in range(level + 1)) + sum(first // arity**k for k in range(level + 1, levels + 1)) - 1


@lru_cache(1 << 14)
def siblings(level: int, index: int, leaves: int, levels: int, arity: int = ARITY) -> tuple[list[int], list[int]]:
    """Places of the nodes that share a parent with a node: those before it and those after it."""
    run = range(index // arity * arity, min((index // arity + 1) * arity, -(-leaves // arity**level)))
    places = [place(level, k, leaves, levels, arity) for k in run]
    at = index - run.start
    return places[:at], places[at + 1 :]


def append_log(leaves: list[str], levels: int, arity: int = ARITY) -> list[str]:
    """The nodes over some leaves in the order they are complete, the leaves among them.

    A run of siblings closes when it is full, or when nothing more comes.
    """
    log: list[str] = []
    open_runs: list[list[str]] = [[] for _ in range(levels + 1)]

    def close(level: int) -> None:
        node = digest("".join(open_runs[level]))
        open_runs[level].clear()
        write(level + 1, node)

    def write(level: int, node: str) -> None:
        log.append(node)
        open_runs[level].append(node)
        if level < levels and len(open_runs[level]) == arity:
            close(level)

    for leaf in leaves:
        write(0, leaf)
    for level in range(levels):
        if open_runs[level]:
            close(level)
    return log


def numbered(leaves: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Leaves with ``rank`` in their tree, from 0, and ``size``, the number of leaves of it.

    Leaves are written once, in order over partitions of about the same size whatever the trees; ranks come from
    what each partition counts, one row for each tree that it holds a part of.
    """
    n = partitions(leaves.sparkSession)
    ranged = leaves.repartitionByRange(n, tree, *order).sortWithinPartitions(tree, *order)
    # The lower bits of the generated id are the row's number in its partition.
    ranged = ranged.withColumns({"_at": F.monotonically_increasing_id(), "_part": F.spark_partition_id()})
    ranged = pin(ranged, "leaves")
    parts = ranged.groupBy(tree, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(before), F.lit(0))
    parts = parts.withColumns({"_before": before, "size": F.sum("_n").over(whole)})
    ranked = ranged.join(parts, [tree, "_part"]).withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before"))
    return ranked.drop("_at", "_part", "_first", "_n", "_before")


def segments(leaves: DataFrame, carried: Sequence[str] = (), arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """(tree, size, block, members, leaves, nodes): a row for every builder, with its log segment.

    ``leaves``: (tree, size, rank, digest). ``members`` has rank and digest of its leaves and the ``carried`` columns.
    """
    member = F.struct("rank", "digest", *carried)
    blocks = leaves.groupBy("tree", "size", F.expr(f"rank div {arity**levels}").alias("block"))
    blocks = blocks.agg(F.array_sort(F.collect_list(member)).alias("members"))
    blocks = blocks.withColumn("digests", F.transform("members", lambda m: m["digest"]))

    def start():
        def build(size, digests):
            return len(digests), append_log(digests, min(levels, height(size, arity)), arity)

        return build

    return add_columns(blocks, ["size", "digests"], "leaves int, nodes array<string>", start).drop("digests")


def build_rounds(
    leaves: DataFrame, carried: Sequence[str] = (), arity: int = ARITY, levels: int = LEVELS
) -> list[DataFrame]:
    """The segments of all rounds of builders, until one block of every tree is left."""
    width = arity**levels
    if width < 2:
        raise ValueError("a block must hold several leaves")
    rounds = [pin(segments(leaves, carried, arity, levels), "segments")]
    while not (going := rounds[-1].filter(F.col("size") > width)).isEmpty():
        tops = going.select(
            "tree",
            F.expr(f"(size + {width - 1}) div {width}").alias("size"),
            F.col("block").alias("rank"),
            F.element_at("nodes", -1).alias("digest"),
        )
        rounds.append(pin(segments(tops, (), arity, levels), "segments"))
    return rounds


def tree_roots(rounds: Sequence[DataFrame], arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """(tree, root): the last node of the only segment that every tree has in the end."""
    ends = [r.filter(F.col("size") <= arity**levels).select("tree", F.element_at("nodes", -1).alias("root")) for r in rounds]
    together = ends[0]
    for more in ends[1:]:
        together = together.unionByName(more)
    return together


def own_path(nodes: list[str], index: int, leaves: int, levels: int, arity: int = ARITY) -> Path:
    """From a leaf of a segment to its last node."""
    steps = []
    for level in range(levels):
        before, after = siblings(level, index, leaves, levels, arity)
        steps.append(("".join([nodes[k] for k in before]), "".join([nodes[k] for k in after])))
        index //= arity
    return steps


def with_paths(rounds: Sequence[DataFrame], ends: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """The first round's segments with the ``path`` from their last node on, and the other columns of ``ends``.

    ``ends``: (tree, path, ...), the path from every tree's root on. Paths are made from the last round down, one for each
    segment; where a tree has one segment left it meets its row of ``ends``, so that no key is met by many rows.
    """
    width = arity**levels
    more = [f for f in ends.schema.fields if f.name not in ("tree", "path")]
    names = [f.name for f in more]
    schema = f"tree string, block bigint, path {PATH}" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in more)
    paths = None
    for built in reversed(rounds):
        here = built.filter(F.col("size") <= width).join(ends, "tree")
        if paths is not None:
            here = here.unionByName(built.filter(F.col("size") > width).join(paths, ["tree", "block"]))
        if built is rounds[0]:
            return here

        def start():
            def lead_down(tree, size, block, leaves, nodes, path, *other):
                path = [(s["before"], s["after"]) for s in path]
                own = min(levels, height(size, arity))
                return [
                    (tree, block * width + k, own_path(nodes, k, leaves, own, arity) + path, *other) for k in range(leaves)
                ]

            return lead_down

        columns = ["tree", "size", "block", "leaves", "nodes", "path", *names]
        paths = pin(map_rows(here, columns, schema, start, many=True), "paths")


def fold(node: str, path: Path) -> str:
    """The digest that a node and the siblings on its path lead to."""
    for before, after in path:
        node = digest(before + node + after)
    return node


def map_leaves(
    segments_with_paths: DataFrame,
    columns: Sequence[str],
    schema: str,
    make: Callable,
    arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """Rows made for every leaf: ``make(path)`` is called for a segment with the path from its last node on, and what it
    returns for each member, with the path to the segment's last node and the values of ``columns``."""

    def start():
        def each(size, leaves, nodes, members, path, *values):
            row = make([(s["before"], s["after"]) for s in path])
            own = min(levels, height(size, arity))
            return [row(m, own_path(nodes, k, leaves, own, arity), *values) for k, m in enumerate(members)]

        return each

    read = ["size", "leaves", "nodes", "members", "path", *columns]
    return map_rows(segments_with_paths, read, schema, start, many=True)


@dataclass(frozen=True)
class Manifest:
    """The trees of a table: the rounds of the groups' trees, and those of the tree over the groups, whose name is empty."""

    rounds: list[DataFrame]
    upper: list[DataFrame]
    id_type: str
    arity: int
    levels: int

    def root(self) -> str | None:
        """The root over all groups; None for an empty table."""
        top = tree_roots(self.upper, self.arity, self.levels).first()
        return top["root"] if top else None

    def groups(self) -> DataFrame:
        """(tree, path, subroot): every group's root and the path from it."""
        shape = self.arity, self.levels
        end = self.upper[0].select("tree").distinct().withColumn("path", F.array().cast(PATH))

        def make(path):
            return lambda member, own: (member["group_tree"], own + path, member["digest"])

        return map_leaves(
            with_paths(self.upper, end, *shape), [], f"tree string, path {PATH}, subroot string", make, *shape
        )

    def proofs(self) -> DataFrame:
        """(id, leaf, subroot, path) of every row, the path leading to the root over all groups."""

        def make(path):
            return lambda member, own, subroot: (member["id"], member["digest"], subroot, own + path)

        return self._each(f"id {self.id_type}, leaf string, subroot string, path {PATH}", make)

    def check(self) -> DataFrame:
        """(id, leaf, subroot, proof_sha256, folded_root): what the proof of every row hashes to, and the root that the
        row's claimed digest leads to with it."""

        def make(path):
            above, seen = "".join([before + after for before, after in path]).encode(), {}

            def row(member, own, subroot):
                proof = sha256("".join([before + after for before, after in own]).encode())
                proof.update(above)
                node = fold(member["claimed"] or member["digest"], own)
                if node not in seen:  # most rows of a segment lead to its last node
                    seen[node] = fold(node, path)
                return member["id"], member["digest"], subroot, proof.hexdigest(), seen[node]

            return row

        return self._each(f"id {self.id_type}, leaf string, subroot string, proof_sha256 string, folded_root string", make)

    def log(self) -> DataFrame:
        """(tree, place, level, index, digest): the append log of every group's tree, one row for each node."""
        arity, levels, out = self.arity, self.levels, None
        sizes = self.rounds[0].groupBy("tree").agg(F.first("size").alias("total"))
        for k, built in enumerate(self.rounds):

            def start(k=k):
                def nodes_of(tree, size, block, leaves, nodes, total):
                    own, all_levels = min(levels, height(size, arity)), height(total, arity)
                    return [
                        (tree, place(k * levels + level, index, total, all_levels, arity), k * levels + level, index,
                         nodes[place(level, index - block * arity ** (levels - level), leaves, own, arity)])
                        for level in range(k > 0, own + 1)  # the last nodes of one round are the leaves of the next
                        for first in [block * arity ** (levels - level)]
                        for index in range(first, first + -(-leaves // arity**level))
                    ]

                return nodes_of

            rows = map_rows(
                built.join(sizes, "tree"),
                ["tree", "size", "block", "leaves", "nodes", "total"],
                "tree string, place bigint, level int, index bigint, digest string",
                start,
                many=True,
            )
            out = rows if out is None else out.unionByName(rows)
        return out

    def _each(self, schema: str, make: Callable) -> DataFrame:
        shape = self.arity, self.levels
        return map_leaves(with_paths(self.rounds, pin(self.groups(), "groups"), *shape), ["subroot"], schema, make, *shape)


def build_manifest(
    rows: DataFrame,
    group_col: str,
    id_col: str,
    leaf: Column,
    claimed: Column | None = None,
    arity: int = ARITY,
    levels: int = LEVELS,
) -> Manifest:
    """A manifest of a table: a tree for each group over its rows in the order of their ids, and one over the groups' roots.

    ``leaf`` is the digest of a row. ``claimed`` is a digest to check in place of it, null where there is none. Every
    ``arity`` consecutive nodes of a level have a parent, the last run with fewer, until one node is left; a
    single row is its tree's root. Groups come in the order of their names, null first and then by UTF-8 bytes.

    Rows of the null group are a tree like others. Rows with a null id come first in theirs; rows that repeat an id
    come in the order of their digests. Any value that ``leaf`` covers may be null, empty or very long. An empty table has no
    trees, no rows of proofs, and None for its root. Columns of other names are not read, whatever their names.
    """
    checked = F.lit(None).cast("string") if claimed is None else claimed
    leaves = rows.select(
        field(group_col).alias("tree"),
        F.col(group_col).cast("string").alias("group"),
        F.col(id_col).alias("id"),
        leaf.alias("digest"),
        checked.alias("claimed"),
    )
    # Ranges are sampled before rows are dealt out: what they are read from must not hash the texts again.
    leaves = pin(numbered(pin(leaves, "digests"), "tree", ["id", "digest"]), "numbered")
    rounds = build_rounds(leaves, ["id", "claimed"], arity, levels)
    roots = leaves.filter("rank = 0").select("tree", "group").join(tree_roots(rounds, arity, levels), "tree")
    tops = roots.select(
        F.lit("").alias("tree"), "group", F.col("tree").alias("group_tree"), F.col("root").alias("digest")
    )
    upper = build_rounds(numbered(tops, "tree", ["group"]), ["group_tree"], arity, levels)
    return Manifest(rounds, upper, leaves.schema["id"].dataType.simpleString(), arity, levels)

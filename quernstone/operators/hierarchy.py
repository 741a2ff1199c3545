"""Parent-child rows to full hierarchies, by contraction of partition-local chains.

Every level of the recursion

1. sets leaves aside (they only need their parent's answer),
2. cuts random edges so that whole runs of parents stay together: a parent of k inner children keeps
   each of them with a chance of 0.9 / k, of 0.8 at most, so fragments are small on average whatever
   the tree's shape and no fragment is hot; pointers doubled ``HOPS`` times give every node its
   fragment's top, by which the nodes are spread over partitions,
3. follows the chains inside each partition, vectorised, up to the node where they leave it
   (the fragment's exit), end in a root or close into a cycle,
4. keeps only those nodes that are the exit of some other fragment - the quotient forest - and
   solves it the same way, until it fits into one task,
5. expands the answers along fragments and then to the leaves.

Nothing is collected to the driver but the number of rows of each level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.errors import TransformError
from quernstone.session import cut

ROOT, CYCLE, TO_CYCLE, EXIT = "root", "cycle", "to_cycle", "exit"
CYCLE_ROOT = "(cycle)"
HOPS = 3  #: doublings of the pointers to a fragment's top: up to 8 steps stay together
KEPT, SPREAD = 0.8, 0.9  #: chance that an edge is kept, and the most children a parent keeps on average


def chase(parent: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pointer doubling over ``parent`` (-1: none here).

    Returns for each node the last node of its chain, the steps to it, whether the chain never
    ends, and whether the node itself lies on a cycle.
    """
    n = len(parent)
    jump = np.where(parent < 0, np.arange(n), parent)
    total = np.where(parent < 0, 0, steps).astype(np.int64)
    rounds = max(1, int(np.ceil(np.log2(n + 1))) + 1)
    for _ in range(rounds):
        total = np.where(jump == np.arange(n), total, total + total[jump])
        jump = jump[jump]
    endless = parent[jump] >= 0
    on = np.zeros(n, bool)
    on[jump[endless]] = True  # after n or more steps exactly the nodes of cycles are reached
    return jump, total, endless, on & endless


def _segments(parent: np.ndarray, end: np.ndarray, stop: np.ndarray, seg: list) -> list:
    """For each node the labels from itself to the end of its chain, ends included.

    Cyclic chains (``stop``) keep only the node's own part.
    """
    out: list = [None] * len(parent)
    for i in range(len(parent)):
        if out[i] is not None:
            continue
        trail, j = [], i
        while out[j] is None and parent[j] >= 0 and not stop[j]:
            trail.append(j)
            j = parent[j]
        if out[j] is None:
            out[j] = list(seg[j])
        for k in reversed(trail):
            out[k] = list(seg[k]) + out[parent[k]]
    return out


def _local(rows: pd.DataFrame, paths: bool) -> pd.DataFrame:
    """Contracts the chains of the rows of one partition."""
    rows = rows.reset_index(drop=True)
    at = pd.Index(rows["node"])
    parent = np.where(rows["parent"].isna(), -1, at.get_indexer(rows["parent"].fillna("")))
    steps = rows["steps"].to_numpy(np.int64)
    last, total, endless, on = chase(parent, steps)
    ends = rows.iloc[last].reset_index(drop=True)
    leaves = ends["parent"].notna().to_numpy()  # its parent is in another partition
    out = pd.DataFrame({"node": rows["node"], "parent": rows["parent"], "label": rows["label"]})
    # what ends in a node known to be cyclic only leads into its cycle
    led = (last != np.arange(len(rows))) & ends["term_kind"].isin([CYCLE, TO_CYCLE]).to_numpy()
    out["kind"] = np.where(on, CYCLE, np.where(endless | led, TO_CYCLE, np.where(leaves, EXIT, ends["term_kind"])))
    out["to"] = np.where(endless, CYCLE_ROOT, np.where(leaves, ends["parent"], ends["term_root"]))
    # steps of the last node lead on to its own parent or to its terminal
    out["steps"] = np.where(endless, 0, total + ends["steps"].to_numpy(np.int64))
    out["seg"] = _segments(parent, last, endless, rows["seg"].tolist()) if paths else None
    return out


_LOCAL = "node string, parent string, label string, kind string, to string, steps bigint, seg array<string>"
_SOLVED = "node string, root string, depth bigint, kind string, seg array<string>"


def _contracted(df: DataFrame, paths: bool) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            yield _local(pd.concat(parts, ignore_index=True), paths)

    return df.select("node", "parent", "label", "steps", "term_root", "term_kind", "seg").mapInPandas(run, _LOCAL)


def _mark(rows: DataFrame) -> DataFrame:
    """node of every row that a flagged node reaches inside its partition (itself included)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        r = pd.concat(parts, ignore_index=True)
        parent = np.where(r["parent"].isna(), -1, pd.Index(r["node"]).get_indexer(r["parent"].fillna("")))
        marked = np.zeros(len(r), bool)
        for i in np.flatnonzero(r["flag"].to_numpy(bool)):
            while i >= 0 and not marked[i]:
                marked[i] = True
                i = parent[i]
        yield r.loc[marked, ["node"]]

    return rows.select("node", "parent", "flag").mapInPandas(run, "node string")


def _labels(inner: DataFrame, level: int) -> DataFrame:
    """(node, label): the top of the run of kept edges above each node, at most 2 ** HOPS steps up."""
    kids = inner.where("parent is not null").groupBy(F.col("parent").alias("p")).agg(F.count("*").alias("kids"))
    chance = F.least(F.lit(KEPT), F.lit(SPREAD) / F.col("kids"))
    coin = F.shiftrightunsigned(F.xxhash64("node", F.lit(level)), 11) / F.lit(float(1 << 53))
    label = F.when(F.col("kids").isNotNull() & (coin < chance), F.col("parent")).otherwise(F.col("node"))
    now = cut(inner.select("node", "parent").join(kids, F.col("parent") == F.col("p"), "left").select("node", label.alias("label")))
    for _ in range(HOPS):
        up = now.select(F.col("node").alias("x"), F.col("label").alias("top"))
        now = cut(now.join(up, F.col("label") == F.col("x")).select("node", F.col("top").alias("label")))
    return now


def _bad(kind) -> F.Column:
    return kind.isin(CYCLE, TO_CYCLE)


def _solve(edges: DataFrame, level: int, paths: bool, base_rows: int, part_rows: int) -> DataFrame:
    """edges(node, parent, steps, term_root, term_kind, seg) -> (node, root, depth, kind, seg)."""
    n = edges.count()
    if level > 80:
        raise TransformError("the hierarchy does not contract")
    if level > 0 and n <= base_rows:
        one = _contracted(edges.withColumn("label", F.lit("")).repartition(1), paths)
        return one.select("node", F.col("to").alias("root"), F.col("steps").alias("depth"), "kind", "seg")

    kids = edges.where("parent is not null").select(F.col("parent").alias("p")).distinct()
    inner = cut(edges.join(kids, F.col("node") == F.col("p"), "left_semi"))
    parts = max(edges.sparkSession.sparkContext.defaultParallelism, -(-n // part_rows))
    local = cut(_contracted(inner.join(_labels(inner, level), "node").repartition(parts, "label"), paths))

    exits = local.where(F.col("kind") == EXIT).select(F.col("to").alias("q")).distinct()
    last = F.col("kind") == EXIT
    quotient = cut(
        local.join(exits, F.col("node") == F.col("q"), "left_semi").select(
            "node", F.when(last, F.col("to")).alias("parent"), "steps",
            F.when(~last, F.col("to")).alias("term_root"), F.when(~last, F.col("kind")).alias("term_kind"), "seg",
        )
    )
    solved = cut(_solve(quotient, level + 1, paths, base_rows, part_rows))
    s = solved.select(F.col("node").alias("x"), F.col("root").alias("x_root"), F.col("depth").alias("x_depth"), F.col("kind").alias("x_kind"), F.col("seg").alias("x_seg"))
    went = F.col("kind") == EXIT
    through = local.join(s, went & (F.col("to") == F.col("x")), "left").select(
        "node", "parent", "label",
        F.when(went, F.col("x_root")).otherwise(F.col("to")).alias("root"),
        F.when(~went, F.col("steps")).when(_bad(F.col("x_kind")), F.lit(0)).otherwise(F.col("steps") + F.col("x_depth")).alias("depth"),
        F.when(~went, F.col("kind")).when(_bad(F.col("x_kind")), F.lit(TO_CYCLE)).otherwise(F.col("x_kind")).alias("kind"),
        F.when(~went | _bad(F.col("x_kind")), F.col("seg")).otherwise(F.concat("seg", "x_seg")).alias("seg"),
    )
    # A cycle over several fragments passes the chains of its quotient nodes.
    on = solved.where(F.col("kind") == CYCLE).select(F.col("node").alias("x"), F.lit(True).alias("flag"))
    suspects = through.where(F.col("kind") == TO_CYCLE).join(on, F.col("node") == F.col("x"), "left").withColumn("flag", F.coalesce("flag", F.lit(False)))
    marked = _mark(suspects.repartition(parts, "label")).withColumnRenamed("node", "x").withColumn("on", F.lit(True))
    through = cut(
        through.join(marked, F.col("node") == F.col("x"), "left")
        .withColumn("kind", F.when(F.col("on"), F.lit(CYCLE)).otherwise(F.col("kind")))
        .select("node", "root", "depth", "kind", "seg")
    )

    leaves = edges.join(kids, F.col("node") == F.col("p"), "left_anti")
    up = through.select(F.col("node").alias("x"), F.col("root").alias("x_root"), F.col("depth").alias("x_depth"), F.col("kind").alias("x_kind"), F.col("seg").alias("x_seg"))
    top = F.col("parent").isNull()
    hung = leaves.join(up, F.col("parent") == F.col("x"), "left").select(
        "node",
        F.when(top, F.col("term_root")).otherwise(F.col("x_root")).alias("root"),
        F.when(top, F.col("steps")).when(_bad(F.col("x_kind")), F.lit(0)).otherwise(F.col("steps") + F.col("x_depth")).alias("depth"),
        F.when(top, F.col("term_kind")).when(_bad(F.col("x_kind")), F.lit(TO_CYCLE)).otherwise(F.col("x_kind")).alias("kind"),
        F.when(top | _bad(F.col("x_kind")), F.col("seg")).otherwise(F.concat("seg", "x_seg")).alias("seg"),
    )
    return through.unionByName(hung)


def hierarchy(nodes: DataFrame, paths: bool = False, base_rows: int = 2_000, part_rows: int = 100_000) -> DataFrame:
    """Root, depth and path of every node.

    ``nodes``: (node, parent), ``node`` unique and not null; other columns are ignored. Returns
    (node, root, depth, kind, path, chain, parent): kind is ``root`` for nodes whose chain ends,
    ``cycle`` for nodes of a cycle (root ``(cycle)``, depth -1) and ``to_cycle`` for nodes whose
    chain leads into one (root ``(cycle)``, depth -2). path runs from the root to the node if
    ``paths``, else it is null; for cyclic chains it holds only the node. chain is the same with
    cyclic chains kept: it begins at the cycle's first node that the chain meets, which for a node
    of a cycle is the node itself. parent is null where it is no node of the table. A parent that is
    null or no node of the table makes a root of depth 0; a node that is its own parent is a cycle
    of length one. An empty table gives an empty result.

    base_rows: a quotient forest of at most that many nodes is solved in one task; the table itself
    is contracted at any size.
    part_rows: nodes of a partition.
    """
    nodes = cut(nodes.select("node", "parent"))
    known = nodes.join(nodes.select(F.col("parent").alias("p")).where("p is not null").distinct(), F.col("node") == F.col("p"), "left_semi").select(F.col("node").alias("p"))
    edges = _edges(nodes.join(known, F.col("parent") == F.col("p"), "left").select("node", F.col("p").alias("parent")), paths)
    out = _solve(edges, 0, paths, base_rows, part_rows)
    if paths:
        out = cut(out)
    bad = _bad(F.col("kind"))
    none = F.lit(None).cast("array<string>")
    tree = out.select(
        "node",
        F.when(bad, F.lit(CYCLE_ROOT)).otherwise(F.col("root")).alias("root"),
        F.when(F.col("kind") == CYCLE, -1).when(bad, -2).otherwise(F.col("depth")).cast("int").alias("depth"),
        "kind",
        (F.when(bad, F.array("node")).otherwise(F.reverse("seg")) if paths else none).alias("path"),
    ).join(edges.select("node", "parent"), "node")
    if not paths:
        return tree.select("node", "root", "depth", "kind", "path", none.alias("chain"), "parent")
    tails = _tails(out, edges, base_rows, part_rows)
    if tails is None:
        return tree.select("node", "root", "depth", "kind", "path", F.col("path").alias("chain"), "parent")
    return tree.join(tails, "node", "left").select("node", "root", "depth", "kind", "path", F.coalesce("tail", "path").alias("chain"), "parent")


def _edges(nodes: DataFrame, paths: bool) -> DataFrame:
    """The first level's rows of (node, parent), every parent being a node or null."""
    top = F.col("parent").isNull()
    return cut(
        nodes.select(
            "node", "parent",
            F.when(top, 0).otherwise(1).cast("bigint").alias("steps"),
            F.when(top, F.col("node")).alias("term_root"),
            F.when(top, F.lit(ROOT)).alias("term_kind"),
            (F.array("node") if paths else F.lit(None).cast("array<string>")).alias("seg"),
        )
    )


def _tails(solved: DataFrame, edges: DataFrame, base_rows: int, part_rows: int) -> DataFrame | None:
    """(node, tail) of the nodes that lead into a cycle, tail running from the cycle's node to them.

    With the parents of its cycles' nodes taken away, what is left of the cyclic chains is a forest.
    """
    bad = solved.where(_bad(F.col("kind"))).select("node", "kind")
    if bad.where(F.col("kind") == TO_CYCLE).isEmpty():
        return None
    up = F.when(F.col("kind") == TO_CYCLE, F.col("parent")).alias("parent")
    forest = _edges(bad.join(edges.select("node", "parent"), "node").select("node", up), True)
    return cut(_solve(forest, 0, True, base_rows, part_rows).select("node", F.reverse("seg").alias("tail")))


def rings(cycles: DataFrame) -> DataFrame:
    """(node, ring, at, length): the cycle of each node, named by its least node, and the steps up to that.

    cycles: (node, parent), nodes of cycles alone. Every round doubles the steps that are looked
    ahead; once no node finds a lesser one, all nodes of a cycle have found its least.
    """
    now = cut(cycles.select("node", F.col("parent").alias("jump"), F.col("node").alias("ring"), F.lit(0).cast("bigint").alias("at")))
    span = 1
    while True:
        on = now.select(F.col("node").alias("x"), F.col("jump").alias("x_jump"), F.col("ring").alias("x_ring"), F.col("at").alias("x_at"))
        less = F.col("x_ring") < F.col("ring")
        new = cut(
            now.join(on, F.col("jump") == F.col("x")).select(
                "node", F.col("x_jump").alias("jump"), F.when(less, F.col("x_ring")).otherwise(F.col("ring")).alias("ring"),
                F.when(less, F.col("x_at") + span).otherwise(F.col("at")).alias("at"), less.alias("moved"),
            )
        )
        now, span = new.drop("moved"), 2 * span
        if new.where("moved").isEmpty():
            break
    return now.select("node", "ring", "at").join(now.groupBy("ring").agg(F.count("*").alias("length")), "ring").select("node", "ring", "at", "length")


def descendants(tree: DataFrame) -> DataFrame:
    """(ancestor, descendant, distance) of every pair on a chain; needs ``hierarchy(paths=True)``.

    One row per ancestor of each node, so the result is as long as all chains together. A node
    whose chain leads into a cycle has the nodes up to the cycle and every node of the cycle as
    ancestors, a node of a cycle all its other nodes; each comes once, at the least distance, and no
    node is its own ancestor.
    """
    tree = cut(tree.select("node", "parent", "kind", "chain"))
    pairs = tree.select(F.col("node").alias("descendant"), F.size("chain").alias("n"), F.posexplode("chain").alias("i", "ancestor"))
    out = pairs.where(F.col("i") < F.col("n") - 1).select("ancestor", "descendant", (F.col("n") - 1 - F.col("i")).cast("int").alias("distance"))
    cyclic = tree.where(_bad(F.col("kind")))
    if cyclic.isEmpty():
        return out
    ring = cut(rings(cyclic.where(F.col("kind") == CYCLE)))
    # from the cycle's node that begins the chain on to the others
    others = ring.select("ring", F.col("node").alias("ancestor"), F.col("at").alias("a_at"))
    below = cyclic.select(F.col("node").alias("descendant"), F.col("chain")[0].alias("entry"), (F.size("chain") - 1).alias("steps"))
    round_ = below.join(ring, F.col("entry") == F.col("node")).join(others, "ring").where("ancestor != entry")
    return out.unionByName(round_.select("ancestor", "descendant", (F.col("steps") + F.pmod(F.col("at") - F.col("a_at"), F.col("length"))).cast("int").alias("distance")))

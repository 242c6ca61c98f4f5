"""Random forest whose trees, votes and out-of-bag errors stay distributed.

A bag is a fixed Poisson draw of hash(row, tree), so it is known again at any time which
rows a tree has not seen. All rows travel down every tree as it grows: those drawn decide
the splits, the others only take their votes along, also for the case that one of their
features is shuffled. No tree is ever sent to a task or to the driver; a node of more than
`local_rows` rows is split by one grouping over all such nodes, a smaller one is grown to
its end by the task that holds its rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from switchflow.operators.running import smaller
from switchflow.operators.topk import positions
from switchflow.session import materialize

# Rows of a node, the unseen ones included, that one task may hold.
LOCAL_ROWS = 200_000
# Cuts per feature that the splits of larger nodes choose from.
CUTS = 63
# The distribution function of Poisson(1) at 0 to 9.
POISSON = (
    0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563,
    0.9994058151824183, 0.9999167588507119, 0.9999897508033253, 0.9999988747974020, 0.9999998885745216,
)
GAIN = 1e-12  # share of a node's sum of squares that a split must gain


@dataclass
class ForestFit:
    """Votes of every tree for every row: the forest as far as its results go.

    rows: _r, _new, label and the features' array x. votes: one row per tree and row:
    tree, _r, _new, seen (drawn by the tree), label, vote, and shuffled: the votes for the
    row with feature j taken from another row (unseen rows only).
    """

    rows: DataFrame
    votes: DataFrame
    features: list[str]

    def predictions(self, new: bool = False) -> DataFrame:
        """(label, prediction) of the fitted rows, or of the further ones: the mean of all trees' votes."""
        own = self.votes.filter(F.col("_new") == new).groupBy("_r").agg(F.first("label").alias("label"), F.avg("vote").alias("prediction"))
        return own.select("label", "prediction")

    def out_of_bag(self) -> DataFrame:
        """(label, prediction) of the fitted rows by the trees that have not seen them."""
        own = self.votes.filter("NOT _new AND NOT seen").groupBy("_r").agg(F.first("label").alias("label"), F.avg("vote").alias("prediction"))
        return own.select("label", "prediction")

    def importance(self) -> DataFrame:
        """(variable, importance): rise of a tree's out-of-bag mean squared error when the
        feature is shuffled, its mean over the trees divided by the mean's standard error.
        """
        unseen = self.votes.filter("NOT _new AND NOT seen")
        miss = (F.col("label") - F.col("vote")) ** 2
        rises = [F.avg((F.col("label") - F.get("shuffled", F.lit(j))) ** 2 - miss).alias(f"_{j}") for j in range(len(self.features))]
        trees = unseen.groupBy("tree").agg(*rises)
        named = [F.struct(F.lit(f).alias("variable"), F.col(f"_{j}").alias("rise")) for j, f in enumerate(self.features)]
        each = trees.select(F.explode(F.array(*named)).alias("e")).select("e.*")
        error = F.stddev_samp("rise") / F.sqrt(F.count("rise"))
        scaled = F.when(error > 0, F.avg("rise") / error).otherwise(F.avg("rise"))
        return each.groupBy("variable").agg(scaled.alias("importance")).orderBy(F.desc("importance"), "variable")


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def numbered_rows(flat: DataFrame, others: DataFrame | None, seed: int) -> DataFrame:
    """(_r, _new, label, x, q): rows numbered in a hashed order; q_j is feature j of the row shift_j places on.

    Every value of a feature moves by one shift of its own, so a shuffled feature keeps
    its distribution. `flat` and `others` have the columns label and x.
    """
    spread = F.xxhash64("label", "x", F.lit(seed))
    rows = materialize(positions(flat.withColumn("_h", spread), ["_h", "label", "x"], "_r").drop("_h"), "forest-rows")
    n = rows.count()
    if n < 2:
        raise ValueError("a forest needs at least two complete rows")
    k = F.size("x")
    shift = lambda j: F.lit(1) + F.pmod(F.lit(seed * 7919) + (j + 1) * F.greatest(F.floor(F.lit(n) / (k + 1)), F.lit(1)), F.lit(n - 1))
    given = rows.select(F.posexplode("x").alias("j", "v"), F.col("_r"), "x")
    given = given.select(F.pmod(F.col("_r") - shift(F.col("j")), F.lit(n)).alias("_r"), "j", "v")
    moved = given.groupBy("_r").agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("m"))  # one entry per feature
    whole = rows.join(moved, "_r").select("_r", F.lit(False).alias("_new"), "label", "x", F.transform("m", lambda e: e["v"]).alias("q"))
    if others is not None:
        again = positions(others.select("label", "x"), ["label", "x"], "_r")
        whole = whole.union(again.select("_r", F.lit(True), "label", "x", F.lit(None).cast("array<double>")))
    return materialize(whole, "forest-rows")


def _started(rows: DataFrame, trees: Sequence[int], seed: int) -> DataFrame:
    """A packet for every row and tree: (tree, node, _r, _new, w, label, x, q, go).

    w: how often the tree has drawn the row. go: for which cases the packet travels; -1 is
    the row itself, j the row with feature j shuffled (of rows that the tree has not seen).
    """
    each = rows.withColumn("tree", F.explode(F.array(*[F.lit(t) for t in trees])))
    u = _unit(F.lit(seed), F.col("tree"), F.col("_r"))
    drawn = sum((F.when(u >= p, 1).otherwise(0) for p in POISSON), F.lit(0))
    each = each.withColumn("w", F.when(F.col("_new"), 0).otherwise(drawn))
    shuffled = (F.col("w") == 0) & ~F.col("_new")
    go = F.when(shuffled, F.sequence(F.lit(-1), F.size("x") - 1)).otherwise(F.array(F.lit(-1)))
    q = F.when(shuffled, F.col("q"))
    return each.select("tree", F.lit(0).cast("long").alias("node"), "_r", "_new", "w", "label", "x", q.alias("q"), go.alias("go"))


def _large_splits(large: DataFrame, cuts: list[list[float]], per_split: int, min_node: int, seed: int) -> DataFrame:
    """(tree, node, mean, f, cut) of the large nodes; f is null for a node that ends."""
    at = ["tree", "node"]
    k = len(cuts)
    order = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.struct(F.xxhash64(F.lit(seed), "tree", "node", j).alias("h"), j.alias("j")))
    every = F.array(*[F.array(*[F.lit(c) for c in own]).cast("array<double>") for own in cuts])
    drawn = large.filter("w > 0").select(*at, "w", (F.col("w") * F.col("label")).alias("wy"), "x", F.explode(F.slice(F.array_sort(order), 1, per_split)).alias("o"))
    binned = drawn.select(*at, "w", "wy", F.col("o.j").alias("f"), smaller(F.get(every, F.col("o.j")), F.get("x", F.col("o.j"))).alias("b"))
    cells = binned.groupBy(*at, "f", "b").agg(F.sum("w").alias("n"), F.sum("wy").alias("s"))
    group = W.partitionBy(*at, "f")  # a row per cut
    run = group.orderBy("b")
    sums = cells.select(*at, "f", "b", *[F.sum(c).over(w).alias(c + i) for c in "ns" for w, i in ((run, "l"), (group, "t"))])
    loss = F.col("st") ** 2 / F.col("nt")
    right = F.col("nt") - F.col("nl")
    gain = F.col("sl") ** 2 / F.col("nl") + (F.col("st") - F.col("sl")) ** 2 / F.nullif(right, F.lit(0)) - loss
    valid = (right > 0) & (F.col("nt") > min_node) & (gain > GAIN * (1 + F.abs(loss)))
    best = F.max(F.when(valid, F.struct(gain.alias("gain"), (-F.col("f")).alias("f"), (-F.col("b")).alias("b"))))
    found = sums.groupBy(*at).agg(best.alias("x"), F.max(F.struct("f", F.col("st") / F.col("nt"))).alias("t"))
    f, b = -F.col("x.f"), -F.col("x.b")
    return found.select(*at, F.col("t").getField("col2").alias("mean"), f.alias("f"), F.get(F.get(every, f), b).alias("cut"))


def _moved(large: DataFrame, splits: DataFrame) -> DataFrame:
    """Packets of split nodes at their children; a packet whose cases part goes on as two."""
    joined = large.join(splits, ["tree", "node"])
    value = lambda v: F.get(F.when(v == F.col("f"), F.col("q")).otherwise(F.col("x")), F.col("f"))
    sides = [F.struct(F.xxhash64("node", F.lit(i)).alias("node"), F.filter("go", lambda v: (value(v) <= F.col("cut")) == F.lit(i == 0)).alias("go")) for i in (0, 1)]
    parted = joined.filter("f IS NOT NULL").withColumn("to", F.explode(F.filter(F.array(*sides), lambda s: F.size(s["go"]) > 0)))
    return parted.select("tree", "to.node", "_r", "_new", "w", "label", "x", "q", "to.go")


def _case_votes(packets: DataFrame, vote: Column) -> DataFrame:
    """(tree, _r, _new, seen, label, go, votes) of packets that end where they are."""
    votes = F.transform("go", lambda _: vote)
    return packets.select("tree", "_r", "_new", (F.col("w") > 0).alias("seen"), "label", "go", votes.alias("votes"))


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, per_split: int, min_node: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """(feature, cut, left, value) of a tree's nodes; a leaf has feature -1, the right child is left + 1.

    Nodes of one level are split together. Of `per_split` features drawn for a node the
    cut between two values with the greatest gain is taken; nodes of min_node draws or
    fewer are not split.
    """
    k = x.shape[1]
    orders = [np.argsort(x[:, f], kind="stable") for f in range(k)]
    feature, cut, left = [np.full(1, -1)], [np.zeros(1)], [np.full(1, -1)]
    at = np.zeros(len(y), np.int64)  # the row's node among those of the level, -1 when it has ended
    wy = w * y
    value = [np.array([wy.sum() / w.sum()])]
    n_nodes, width = 1, 1
    while width:
        live = at >= 0
        size = np.bincount(at[live], w[live], width)
        total = np.bincount(at[live], wy[live], width)
        base = total**2 / size
        best = np.where(size > min_node, base + GAIN * (1 + np.abs(base)), np.inf)
        of, to = np.full(width, -1), np.zeros(width)
        drawn = rng.random((width, k)).argsort(axis=1) < per_split
        for f in range(k):
            o = orders[f]
            o = o[live[o]]
            o = o[drawn[at[o], f] & (size[at[o]] > min_node)]
            o = o[np.argsort(at[o], kind="stable")]  # by node, then value
            if len(o) < 2:
                continue
            node, v = at[o], x[o, f]
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            n, s = np.cumsum(w[o]), np.cumsum(wy[o])
            start = np.repeat(first, np.diff(np.append(first, len(o))))
            n, s = n - (n[start] - w[o][start]), s - (s[start] - wy[o][start])
            ends = np.flatnonzero((node[1:] == node[:-1]) & (v[1:] > v[:-1]))
            if not len(ends):
                continue
            at_end = node[ends]
            gain = s[ends] ** 2 / n[ends] + (total[at_end] - s[ends]) ** 2 / (size[at_end] - n[ends])
            heads = np.flatnonzero(np.concatenate([[True], at_end[1:] != at_end[:-1]]))
            most = np.maximum.reduceat(gain, heads)
            hit = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(heads, len(ends)))))
            hit = hit[np.concatenate([[True], at_end[hit][1:] != at_end[hit][:-1]])]  # the first of equals
            better = gain[hit] > best[at_end[hit]]
            hit, nodes = ends[hit[better]], at_end[hit[better]]
            best[nodes], of[nodes] = most[better], f
            middle = v[hit] + (v[hit + 1] - v[hit]) / 2
            to[nodes] = np.where(middle < v[hit + 1], middle, v[hit])
        split = np.flatnonzero(of >= 0)
        child = np.full(width, -1)
        child[split] = 2 * np.arange(len(split))
        for store, level in ((feature, of), (cut, to), (left, np.where(child >= 0, n_nodes + child, -1))):
            store[-1] = level
            store.append(np.full(2 * len(split), -1) if store is not cut else np.zeros(2 * len(split)))
        rows = np.flatnonzero(live)
        rows = rows[child[at[rows]] >= 0]
        down = child[at[rows]] + (x[rows, of[at[rows]]] > to[at[rows]])
        at = np.full(len(y), -1)
        at[rows] = down
        width = 2 * len(split)
        n_nodes += width
        value.append(np.bincount(down, wy[rows], width) / np.bincount(down, w[rows], width) if width else np.zeros(0))
    return tuple(np.concatenate(c) for c in (feature, cut, left, value))


def descend(tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """The value of the leaf that each row ends in."""
    feature, cut, left, value = tree
    node = np.zeros(len(x), np.int64)
    moving = np.flatnonzero(feature[node] >= 0)
    while len(moving):
        at = node[moving]
        node[moving] = left[at] + (x[moving, feature[at]] > cut[at])
        moving = moving[feature[node[moving]] >= 0]
    return value[node]


def _finished(packets: DataFrame, k: int, per_split: int, min_node: int, seed: int) -> DataFrame:
    """Votes of packets whose nodes are small: each (tree, node) is grown to its end by one task."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("_r", "ascending"), ("_new", "ascending"), ("w", "descending")]).combine_chunks()
        matrix = lambda c: c.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
        x, w = matrix(table["x"]), table["w"].to_numpy().astype(float)
        y = table["label"].to_numpy().astype(float)
        drawn = np.flatnonzero(w)
        go = table["go"].combine_chunks()
        lengths = np.diff(go.offsets.to_numpy())
        case, row = go.flatten().to_numpy(), np.repeat(np.arange(len(x)), lengths)
        votes = np.full(len(case), np.nan)
        rng = np.random.default_rng([seed, key[0].as_py(), key[1].as_py() & ((1 << 63) - 1)])
        if len(drawn):  # a tree that has drawn no row has no vote
            tree = grow(x[drawn], y[drawn], w[drawn], per_split, min_node, rng)
            moved = np.full((len(x), k), np.nan)
            has = np.flatnonzero(table["q"].combine_chunks().is_valid().to_numpy(zero_copy_only=False))
            if len(has):
                moved[has] = matrix(table["q"].take(pa.array(has)))
            for j in range(-1, k):
                at = np.flatnonzero(case == j)
                there = x[row[at]]
                if j >= 0:
                    there[:, j] = moved[row[at], j]
                votes[at] = descend(tree, there)
        ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, v) for v in (pa.array(case, pa.int32()), pa.array(votes, mask=np.isnan(votes)))]
        return pa.table([table["tree"], table["_r"], table["_new"], pa.array(w > 0), table["label"], *lists], names=["tree", "_r", "_new", "seen", "label", "go", "votes"])

    schema = "tree int, _r long, _new boolean, seen boolean, label double, go array<int>, votes array<double>"
    return packets.groupBy("tree", "node").applyInArrow(run, schema)


def grow_forest(
    flat: DataFrame, features: Sequence[str], trees: int = 500, per_split: int = 3, min_node: int = 5, seed: int = 123,
    others: DataFrame | None = None, local_rows: int = LOCAL_ROWS,
) -> ForestFit:
    """A forest of `trees` on the rows of flat (label, x), without a limit to their depth.

    others: further rows (label may be null) that get votes too. A fit depends on the
    rows' values and the seed alone.
    """
    rows = numbered_rows(flat, others, seed)
    k = len(features)
    packets = _started(rows, range(trees), seed)
    ended = []
    if rows.count() > local_rows:
        each = [F.percentile_approx(F.get("x", F.lit(j)), [i / (CUTS + 1) for i in range(1, CUTS + 1)], 10 * CUTS) for j in range(k)]
        cuts = [sorted(set(c)) for c in rows.filter("NOT _new").agg(*each).first()]
        small = []
        while True:
            packets = materialize(packets, "forest-packets")
            sizes = packets.groupBy("tree", "node").agg(F.count("*").alias("_n")).filter(F.col("_n") > local_rows).drop("_n")
            sizes = materialize(sizes, "large-nodes")
            small.append(packets.join(sizes, ["tree", "node"], "left_anti"))
            if sizes.isEmpty():
                break
            large = packets.join(sizes, ["tree", "node"], "left_semi")
            splits = materialize(_large_splits(large, cuts, per_split, min_node, seed), "large-splits")
            leaves = large.join(splits.filter("f IS NULL"), ["tree", "node"])
            ended.append(_case_votes(leaves, F.col("mean")))
            packets = _moved(large, splits)
        packets = small[0]
        for more in small[1:]:
            packets = packets.union(more)
    votes = _finished(packets, k, per_split, min_node, seed)
    for more in ended:
        votes = votes.union(more)
    if ended:
        # The cases of a row may have ended in different nodes.
        case = votes.withColumn("e", F.explode(F.arrays_zip("go", "votes"))).groupBy("tree", "_r", "_new")
        votes = case.agg(F.first("seen").alias("seen"), F.first("label").alias("label"), F.array_sort(F.collect_list("e")).alias("e"))
        votes = votes.withColumn("votes", F.transform("e", lambda e: e["votes"]))
    shuffled = F.when(F.size("votes") > 1, F.slice("votes", 2, k))
    votes = votes.select("tree", "_r", "_new", "seen", "label", F.get("votes", F.lit(0)).alias("vote"), shuffled.alias("shuffled"))
    return ForestFit(rows, materialize(votes, "forest-votes"), list(features))

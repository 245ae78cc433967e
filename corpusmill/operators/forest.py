"""Random forests grown by Spark: no tree is ever whole on the driver or in one task.

A row counts by its cell: the bins of its columns, at most 32 each, cut where
Spark's own learner cuts. How often a tree draws a cell follows from a hash of
cell, tree and seed, so a forest depends on the rows alone and not on their
layout. Nodes with many cells are split one level at a time from summed counts;
only these upper splits, about one per ``local`` cells, reach the driver. What
lies below a node with few cells is grown in one group and written as one row.
To predict, distinct cells go down the upper splits, meet the node they reach
by a join, and their votes are summed. The forests of all folds of a
cross-validation are grown, and vote, together: jobs do not grow with folds.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, fields, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.runtime import materialise
from corpusmill.sources.tables import table_exists

BINS, DEPTH = 32, 30
# Rows that the cuts are taken from, as many as Spark's own learner takes.
CUT_ROWS = 10_000
# A node with at most this many cells is grown in one group.
LOCAL = 16_384
# Counts that a task sums up at once, and that are compared at once within a node.
_COUNTS, _AT_ONCE = 2_000_000, 1_000_000
# Rows times trees that are worth a task: to draw them, and to grow from them.
_DRAW, _GROW = 500_000, 100_000
# Votes are whole numbers, so that their sum has no order.
_VOTE = 1 << 40
_DRAWN = "at int, cells binary, y binary, w binary"
_GROWN = "at int, feature binary, cut binary, child binary, counts binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed function of 64-bit numbers (the finaliser of splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn_by(seed: int, *parts: np.ndarray) -> np.ndarray:
    h = _mixed(np.array([seed & (1 << 64) - 1], np.uint64))
    for part in parts:
        h = _mixed(h ^ part.astype(np.uint64))
    return h


def _chances(n: int) -> np.ndarray:
    """The distribution function of the Poisson law of mean ``n``, up to where it is 1."""
    k = np.arange(1, n + 12 * math.isqrt(n) + 30)
    return np.cumsum(np.exp(np.r_[-n, k * math.log(n) - n - np.cumsum(np.log(k))]))


_SMALL = 30
_TABLES = {n: _chances(n) for n in range(1, _SMALL + 1)}


def bag(bins: np.ndarray, y: np.ndarray, n: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """How often each tree draws each cell of ``n`` rows: independent Poisson numbers of mean ``n``, ``(cell, tree)``."""
    cell = _drawn_by(seed, y, *bins.T)
    out = np.empty((len(y), trees), np.int64)
    u = (_mixed(cell[:, None] ^ _mixed(np.arange(trees, dtype=np.uint64))[None]) >> np.uint64(11)) * 2.0**-53
    for size in np.unique(n[n <= _SMALL]).tolist():
        out[n == size] = np.searchsorted(_TABLES[size], u[n == size], side="right")
    for i in np.flatnonzero(n > _SMALL):
        out[i] = np.random.Generator(np.random.Philox(key=int(cell[i]))).poisson(n[i], trees)
    return out


@dataclass(frozen=True)
class Spec:
    """A forest that learns from all rows outside ``out`` of the column ``fold``, or from all rows with None."""

    fold: str | None = None
    out: int | None = None


@dataclass(frozen=True)
class Shape:
    """What a task must know of a forest."""

    columns: int
    classes: int
    trees: int
    seed: int
    min_leaf: int

    @property
    def tried(self) -> int:
        """Columns that a split chooses from."""
        return math.ceil(math.sqrt(self.columns))

    def chosen(self, tree: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The columns that each node tries, ascending."""
        keys = np.stack([_drawn_by(self.seed + 1, tree, node, np.full(len(node), j)) for j in range(self.columns)], axis=1)
        return np.sort(np.argsort(keys, axis=1, kind="stable")[:, :self.tried], axis=1)


def _best(tally: np.ndarray, min_leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ``(node, bin, class)`` counts the sum of squares over size of both sides at the best cut, the cut, and the left side."""
    left = tally.cumsum(axis=1)
    whole = left[:, -1:]
    left = left[:, :-1]
    right = whole - left
    sizes = left.sum(axis=2), right.sum(axis=2)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (left * left).sum(axis=2) / sizes[0] + (right * right).sum(axis=2) / sizes[1]
    score[(sizes[0] < min_leaf) | (sizes[1] < min_leaf)] = -np.inf
    cut, each = score.argmax(axis=1), np.arange(len(score))
    return score[each, cut], cut, left[each, cut]


def _gains(score: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a split makes a node purer, beyond rounding."""
    return score > (counts * counts).sum(axis=1) / np.maximum(counts.sum(axis=1), 1) * (1 + 1e-12)


def _ended(node: np.ndarray, counts: np.ndarray, min_leaf: int) -> np.ndarray:
    """Nodes that cannot be split: too deep, too small or of one class."""
    size = counts.sum(axis=1)
    return (node >= 1 << DEPTH) | (size < 2 * min_leaf) | (counts.max(axis=1) == size)


def _pruned(feature: np.ndarray, child: np.ndarray, counts: np.ndarray, levels: list[int]) -> None:
    """Two leaves of one node that predict the same class become one, from the deepest level up."""
    winner = counts.argmax(axis=1)
    for low, high in zip(levels[-2::-1], levels[:0:-1], strict=True):
        at = low + np.flatnonzero(feature[low:high] >= 0)
        first = child[at]
        same = (feature[first] < 0) & (feature[first + 1] < 0) & (winner[first] == winner[first + 1])
        feature[at[same]] = -1


def grown(bins: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, root: int, shape: Shape) -> tuple[np.ndarray, ...]:
    """The subtree over drawn cells: per node column (-1 for a leaf), cut, first child and counts, level by level.

    A level's nodes are split together; the two children of a node are neighbours.
    """
    k, at, node = shape.classes, np.zeros(len(y), np.int64), np.array([root])
    parts, levels = [], [0]
    while len(node):
        counts = np.bincount(at * k + y, w, len(node) * k).reshape(-1, k)
        feature, cut = np.full(len(node), -1), np.zeros(len(node), np.int64)
        open_ = np.flatnonzero(~_ended(node, counts, shape.min_leaf))
        tried = shape.chosen(np.full(len(open_), tree), node[open_])
        place = np.full(len(node), -1)
        place[open_] = np.arange(len(open_))
        kept = place[at] >= 0
        bins, y, w, at = bins[kept], y[kept], w[kept], at[kept]
        step = max(1, _AT_ONCE // (BINS * k))
        for low in range(0, len(open_), step):
            some = slice(low, low + step)
            c = len(open_[some])
            rows = np.flatnonzero((place[at] >= low) & (place[at] < low + step)) if c < len(open_) else slice(None)
            own, best = place[at[rows]] - low, np.full(c, -np.inf)
            for s in range(shape.tried):
                f = tried[some, s]
                b = bins[rows][np.arange(len(own)), f[own]]
                tally = np.bincount((own * BINS + b) * k + y[rows], w[rows], c * BINS * k).reshape(c, BINS, k)
                score, where, _ = _best(tally, shape.min_leaf)
                better = (score > best) & _gains(score, counts[open_[some]])
                best[better] = score[better]
                feature[open_[some][better]], cut[open_[some][better]] = f[better], where[better]
        split = feature >= 0
        first = levels[-1] + len(node) + 2 * (np.cumsum(split) - 1)
        parts.append((feature, cut, np.where(split, first, 0), counts))
        levels.append(levels[-1] + len(node))
        kept = split[at]
        bins, y, w, at = bins[kept], y[kept], w[kept], at[kept]
        right = bins[np.arange(len(y)), feature[at]] > cut[at]
        at = 2 * (np.cumsum(split) - 1)[at] + right
        node = (2 * node[split][:, None] + np.arange(2)).ravel()
    feature, cut, child, counts = (np.concatenate(p) for p in zip(*parts, strict=True))
    _pruned(feature, child, counts, levels)
    # What hangs below a pruned node goes; order and neighbours stay.
    reached = np.zeros(len(feature), bool)
    reached[0] = True
    for low, high in zip(levels, levels[1:], strict=False):
        below = child[low:high][reached[low:high] & (feature[low:high] >= 0)]
        reached[below] = reached[below + 1] = True
    new = np.cumsum(reached) - 1
    return feature[reached], cut[reached], new[child[reached]], counts[reached]


def _walk(bins: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, child: np.ndarray) -> np.ndarray:
    """Where cells that start at ``at`` end."""
    at, going = at.copy(), np.flatnonzero(feature[at] >= 0)
    while len(going):
        here = at[going]
        at[going] = child[here] + (bins[going, feature[here]] > cut[here])
        going = going[feature[at[going]] >= 0]
    return at


@dataclass(frozen=True)
class Upper:
    """The splits that the driver knows; node t is the root of tree t. ``node`` numbers as in a heap.

    Of several forests the roots of the first come first, then those of the next.
    """

    model: np.ndarray
    tree: np.ndarray
    node: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    counts: np.ndarray
    state: np.ndarray  # 0: to be split, 1: grown apart, 2: leaf or split


def _cells_of(batch: pa.RecordBatch, columns: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch["cell"].to_pylist()), np.uint8).reshape(-1, columns)


def _met(batches, shape: Shape, upper: Upper):
    """Per batch and forest its cells, classes and draws, and per tree the place a cell reaches."""
    for batch in batches:
        for m, part in _by_model(batch):
            bins, y, n = _cells_of(part, shape.columns), part["y"].to_numpy(), part["n"].to_numpy()
            draws = bag(bins, y, n, shape.trees, shape.seed)
            for t in range(shape.trees):
                rows = np.flatnonzero(draws[:, t])
                at = _walk(bins[rows], np.full(len(rows), m * shape.trees + t), upper.feature, upper.cut, upper.child)
                yield bins[rows], y[rows], draws[rows, t], at


def _by_model(batch: pa.RecordBatch):
    """The rows of each forest; written rows are sorted by it, so a batch holds few."""
    model = batch["model"].to_numpy()
    for m in np.unique(model).tolist():
        yield m, batch.filter(pa.array(model == m))


def _counted(cells: DataFrame, shape: Shape, upper: Upper, open_: np.ndarray) -> DataFrame:
    """``(at, feature, cut, left, right, cells)``: the best split of each open node, from counts summed up over all tasks."""
    s, k = shape.tried, shape.classes
    tried = shape.chosen(upper.tree[open_], upper.node[open_])
    place = np.full(len(upper.tree), -1)
    place[open_] = np.arange(len(open_))

    def count(batches):
        drawn, seen = np.zeros(len(open_) * s * BINS * k, np.int64), np.zeros(len(open_) * s * BINS * k, np.int64)
        for bins, y, w, at in _met(batches, shape, upper):
            rows = np.flatnonzero(place[at] >= 0)
            own = place[at[rows]]
            for i in range(s if len(rows) else 0):
                key = ((own * s + i) * BINS + bins[rows, tried[own, i]]) * k + y[rows]
                keys, back = np.unique(key, return_inverse=True)
                drawn[keys] += np.bincount(back, w[rows]).astype(np.int64)
                seen[keys] += np.bincount(back)
        for low in range(0, len(seen), 100_000):
            keys = low + np.flatnonzero(seen[low:low + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array((keys // (s * BINS * k)).astype(np.int32)), pa.array(
                (keys % (s * BINS * k)).astype(np.int32)), pa.array(drawn[keys]), pa.array(seen[keys])], ["open", "key", "w", "m"])

    def choose(table: pa.Table) -> pa.Table:
        i, key = table["open"][0].as_py(), table["key"].to_numpy()
        tally = np.bincount(key, table["w"].to_numpy(), s * BINS * k).reshape(s, BINS, k)
        seen = np.bincount(key, table["m"].to_numpy(), s * BINS * k).reshape(s, BINS, k).sum(axis=2)
        counts = tally[0].sum(axis=0)
        score, cut, left = _best(tally, shape.min_leaf)
        best = int(score.argmax())
        feature = int(tried[i, best]) if _gains(score[best:best + 1], counts[None])[0] else -1
        sides = np.array([left[best], counts - left[best]]).astype(np.int64)
        below = int(seen[best, :cut[best] + 1].sum())
        return pa.table({"at": pa.array([open_[i]], pa.int32()), "feature": pa.array([feature], pa.int32()),
                         "cut": pa.array([cut[best]], pa.int32()), "counts": pa.array([counts.astype(np.int64)]),
                         "left": pa.array([sides[0]]), "right": pa.array([sides[1]]),
                         "cells": pa.array([np.array([below, seen[best].sum() - below], np.int64)])})

    sums = cells.mapInArrow(count, "open int, key int, w long, m long").groupBy("open", "key").agg(
        F.sum("w").alias("w"), F.sum("m").alias("m"))
    return sums.groupBy("open").applyInArrow(choose, "at int, feature int, cut int, counts array<long>, left array<long>, "
                                             "right array<long>, cells array<long>")


def _split_further(cells: DataFrame, shape: Shape, upper: Upper, local: int) -> Upper:
    """One more level below the nodes that are to be split."""
    todo = np.flatnonzero(upper.state == 0)
    step = max(1, _COUNTS // (shape.tried * BINS * shape.classes))
    new: dict[str, list] = {f.name: getattr(upper, f.name).tolist() for f in fields(Upper)}
    found = [r for low in range(0, len(todo), step) for r in _counted(cells, shape, upper, todo[low:low + step]).collect()]
    for i in todo.tolist():
        new["state"][i] = 2
    for r in sorted(found, key=lambda r: r["at"]):
        i = r["at"]
        new["counts"][i] = r["counts"]
        ended = _ended(np.array([new["node"][i]]), np.array([r["counts"]]), shape.min_leaf)[0]
        if ended or r["feature"] < 0:
            continue
        new["feature"][i], new["cut"][i], new["child"][i] = r["feature"], r["cut"], len(new["tree"])
        for side, counts, m in zip((0, 1), (r["left"], r["right"]), r["cells"], strict=True):
            node = 2 * new["node"][i] + side
            leaf = _ended(np.array([node]), np.array([counts]), shape.min_leaf)[0]
            for name, value in dict(model=new["model"][i], tree=new["tree"][i], node=node, feature=-1, cut=0, child=0, counts=counts,
                                    state=2 if leaf else int(m <= local)).items():
                new[name].append(value)
    return Upper(**{name: np.array(values, np.int64) for name, values in new.items()})


def _drawn(cells: DataFrame, shape: Shape, upper: Upper) -> DataFrame:
    """The drawn cells of the nodes that are grown apart, those of a batch together."""

    def deal(batches):
        for bins, y, w, at in _met(batches, shape, upper):
            order = np.argsort(at, kind="stable")
            order = order[upper.state[at[order]] == 1]
            places, starts = np.unique(at[order], return_index=True)
            parts = [order[a:b] for a, b in zip(starts, np.append(starts, len(order))[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), *[
                pa.array([v[p].tobytes() for p in parts], pa.binary()) for v in (bins, y.astype(np.int32), w)]], ["at", "cells", "y", "w"])

    return cells.mapInArrow(deal, _DRAWN)


def _subtrees(drawn: DataFrame, shape: Shape, upper: Upper, tasks: int) -> DataFrame:
    """A row per node that is grown apart, numbered within its forest."""
    place = _places(upper)

    def grow(table: pa.Table) -> pa.Table:
        at = table["at"][0].as_py()
        join = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
        return _stored([(int(upper.model[at]), int(place[at]), grown(
            join("cells", np.uint8).reshape(-1, shape.columns), join("y", np.int32).astype(np.int64), join("w", np.int64),
            int(upper.tree[at]), int(upper.node[at]), shape))])

    return drawn.repartition(tasks, "at").groupBy("at").applyInArrow(grow, "model int, " + _GROWN)


def _places(upper: Upper) -> np.ndarray:
    """The number of each node among those of its forest."""
    out = np.zeros(len(upper.model), np.int64)
    for m in np.unique(upper.model):
        own = np.flatnonzero(upper.model == m)
        out[own] = np.arange(len(own))
    return out


def _one_of(upper: Upper, model: int) -> Upper:
    """The splits of one forest alone."""
    own, place = np.flatnonzero(upper.model == model), _places(upper)
    alone = Upper(**{f.name: getattr(upper, f.name)[own] for f in fields(Upper)})
    return replace(alone, model=alone.model * 0, child=place[alone.child] * (alone.child > 0))


def _stored(trees: list[tuple]) -> pa.Table:
    kinds = np.int32, np.uint8, np.int32, np.int64
    return pa.table({"model": pa.array([m for m, _, _ in trees], pa.int32()), "at": pa.array([at for _, at, _ in trees], pa.int32()), **{
        name: pa.array([tree[j].astype(kinds[j]).tobytes() for _, _, tree in trees], pa.binary())
        for j, name in enumerate(("feature", "cut", "child", "counts"))}})


def _tasks(spark: SparkSession, work: int, each: int) -> int:
    """As many tasks as the session asks for, but beyond two per core none for less than ``each`` of the work."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(2 * spark.sparkContext.defaultParallelism, work // each)))


def _sampled(rows: DataFrame, specs: list[Spec], sizes: list[int], folds: dict[str, str], names: list[str], labels: list[str],
             seed: int) -> list[tuple]:
    """Per forest the values and sizes of its distinct rows, at most ``CUT_ROWS``: the first in the order of a hash.

    Only rows below a hash that leaves a few more than that are fetched. Should
    it leave fewer, as copies in several folds are one row, it is raised.
    """
    keyed = rows.withColumn("key", F.xxhash64(F.lit(seed), *names)).withColumn(
        "label", F.array_position(F.array(*map(F.lit, labels)), F.col("label")))
    shares = [min(1.0, 1.1 * CUT_ROWS / n) for n in sizes]
    while True:
        ends = [min(int(share * 2**64), 2**64 - 1) - 2**63 for share in shares]
        wanted = [F.col("key") <= end if s.fold is None else (F.col(folds[s.fold]) != s.out) & (F.col("key") <= end)
                  for s, end in zip(specs, ends, strict=True)]
        found = keyed.where(reduce(Column.__or__, wanted)).toArrow()
        key, n = found["key"].to_numpy(), found["n"].to_numpy()
        values = np.stack([found[x].to_numpy() for x in names], axis=1)
        label = found["label"].to_numpy()
        order = np.lexsort((label, *values.T[::-1], key))
        outside = {(s.fold, s.out): np.array(pc.fill_null(pc.not_equal(found[folds[s.fold]], s.out), False))
                   for s in specs if s.fold is not None}
        out = []
        for i, (s, end) in enumerate(zip(specs, ends, strict=True)):
            own = order[key[order] <= end]
            if s.fold is not None:
                own = own[outside[s.fold, s.out][own]]
            other = np.r_[True, (label[own][1:] != label[own][:-1]) | (values[own][1:] != values[own][:-1]).any(axis=1)][:len(own)]
            which = np.cumsum(other)
            if shares[i] < 1 and (not len(which) or which[-1] < CUT_ROWS):
                shares[i] = min(1.0, 2 * shares[i])
                break
            own = own[which <= CUT_ROWS]
            out.append((values[own], n[own]))
        else:
            return out


def _cuts(values: np.ndarray, n: np.ndarray) -> list[float]:
    """At most 31 cuts of a column between its values, at even shares of the rows."""
    values, back = np.unique(values, return_inverse=True)
    values, sums = values.tolist(), np.bincount(back, n).astype(np.int64).tolist()
    middle = lambda i: (values[i - 1] + values[i]) / 2
    if len(values) <= BINS:
        return [c for c in map(middle, range(1, len(values))) if c == c]
    share = sum(sums) / BINS
    out, seen, wanted = [], sums[0], share
    for i in range(1, len(values)):
        before, seen = seen, seen + sums[i]
        if abs(before - wanted) < abs(seen - wanted):
            out.append(middle(i))
            wanted += share
    return [c for c in out[:BINS - 1] if c == c]


def _cell(columns: list[str], cuts: list[Column]) -> Column:
    """A byte per column: how many cuts lie below its value. A missing value is an error."""
    def below(v: Column, at: Column) -> Column:
        return F.size(F.filter(at, lambda c: c < v))

    found = [F.lpad(F.hex(below(_number(c), at)), 2, "0") for c, at in zip(columns, cuts, strict=True)]
    bad = F.exists(F.array(*map(_number, columns)), lambda v: v.isNull() | F.isnan(v))
    return F.unhex(F.when(bad, F.raise_error(F.lit("a forest takes no missing values"))).otherwise(
        F.concat(*found)))


def _number(column: str) -> Column:
    return F.col(f"`{column}`").cast("double")


@dataclass(frozen=True)
class Forest:
    """A fitted forest: its upper splits, and a written row per node in which they end."""

    labels: list[str]
    columns: list[str]
    cuts: list[list[float]]
    shape: Shape
    upper: Upper
    parts: DataFrame

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column ``pred``: the class with most votes, the first by name on a tie."""
        cuts = [F.array(*map(F.lit, at)).cast("array<double>") for at in self.cuts]
        marked = rows.withColumn("__cell", _cell(self.columns, cuts)).withColumn("__model", F.lit(0))
        return _voted(marked, [self], self.parts.withColumn("model", F.lit(0))).select(*[F.col(f"`{c}`") for c in rows.columns], "pred")

    def save(self, path: str) -> None:
        """Replace what is at ``path``."""
        spark = self.parts.sparkSession
        parts = materialise(self.parts, "forest") if table_exists(spark, path) else self.parts
        known = {"labels": self.labels, "columns": self.columns, "cuts": self.cuts, "shape": vars(self.shape),
                 "upper": {name: values.tolist() for name, values in vars(self.upper).items()}}
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        parts.write.parquet(f"{path}/parts")
        spark.createDataFrame([(json.dumps(known),)], "value string").coalesce(1).write.text(f"{path}/forest")


def _voted(marked: DataFrame, forests: list[Forest], parts: DataFrame) -> DataFrame:
    """Rows with a forest's number ``__model`` and a ``__cell`` of it, and the class ``pred`` it votes for."""
    k = forests[0].shape.classes
    votes = _votes(marked.select(F.col("__model").alias("model"), F.col("__cell").alias("cell")).distinct(), forests, parts)
    most = F.greatest(*[F.col(f"v{y}") for y in range(k)], F.lit(0))
    winner = F.coalesce(*[F.when(F.col(f"v{y}") == most, y) for y in range(k)])
    labels = F.array(*[F.array(*map(F.lit, f.labels)) for f in forests])
    pred = votes.select(F.col("model").alias("__by"), F.col("cell").alias("__of"), labels[F.col("model")][winner].alias("pred"))
    return marked.join(pred, (F.col("__model") == F.col("__by")) & (F.col("__cell") == F.col("__of")), "left")


def _votes(cells: DataFrame, forests: list[Forest], parts: DataFrame) -> DataFrame:
    """``(model, cell, v0, ..)``: the votes of all trees of a forest for every class."""
    shape, uppers = forests[0].shape, [f.upper for f in forests]
    p, k = shape.columns, shape.classes
    names = [f"v{y}" for y in range(k)]

    def deal(batches):
        for batch in batches:
            for m, part in _by_model(batch):
                bins, upper = _cells_of(part, p), uppers[m]
                for t in range(shape.trees):
                    at = _walk(bins, np.full(len(bins), t), upper.feature, upper.cut, upper.child)
                    order = np.argsort(at, kind="stable")
                    places, starts = np.unique(at[order], return_index=True)
                    ends = np.append(starts, len(order))[1:]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), m), pa.int32()), pa.array(places, pa.int32()), pa.array(
                        [bins[order[a:b]].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())], ["model", "at", "cells"])

    def vote(asked: pa.Table, known: pa.Table) -> pa.Table:
        bins = np.frombuffer(b"".join(asked["cells"].to_pylist()), np.uint8).reshape(-1, p)
        own = np.zeros((len(bins), k))
        if len(known) and len(bins):  # a tree that drew nothing has no node and no votes
            feature, cut, child, counts = (np.frombuffer(known[c][0].as_py(), kind) for c, kind in (
                ("feature", np.int32), ("cut", np.uint8), ("child", np.int32), ("counts", np.int64)))
            own = counts.reshape(-1, k)[_walk(bins, np.zeros(len(bins), np.int64), feature, cut, child)]
        shares = np.rint(own / np.maximum(own.sum(axis=1, keepdims=True), 1) * _VOTE).astype(np.int64)
        model = asked["model"][0].as_py() if len(bins) else 0
        return pa.table([pa.array(np.full(len(bins), model), pa.int32()), pa.array([c.tobytes() for c in bins], pa.binary()),
                         *[pa.array(shares[:, y]) for y in range(k)]], names=["model", "cell", *names])

    asked = cells.sortWithinPartitions("model").mapInArrow(deal, "model int, at int, cells binary")
    met = asked.groupBy("model", "at").cogroup(parts.groupBy("model", "at")).applyInArrow(
        vote, "model int, cell binary, " + ", ".join(f"{v} long" for v in names))
    return met.groupBy("model", "cell").agg(*[F.sum(v).alias(v) for v in names])


def is_forest(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, f"{path}/forest")


def load(spark: SparkSession, path: str) -> Forest:
    known = json.loads("".join(r["value"] for r in spark.read.text(f"{path}/forest").collect()))
    upper = {name: np.array(values, np.int64) for name, values in known["upper"].items()}
    upper = Upper(**{"model": upper["tree"] * 0, **upper})
    return Forest(known["labels"], known["columns"], known["cuts"], Shape(**known["shape"]), upper,
                  spark.read.schema(_GROWN).parquet(f"{path}/parts"))


def fit(train: DataFrame, *, label: str, columns: list[str], seed: int, trees: int = 300, min_leaf: int = 2,
        local: int = LOCAL) -> Forest:
    """A forest of ``trees`` trees of Gini splits over the root of the number of columns each, at most 30 deep.

    Leaves hold at least ``min_leaf`` draws. ``local`` only says where nodes
    are grown, not how.
    """
    return fit_many(train, [Spec()], label=label, columns=columns, seed=seed, trees=trees, min_leaf=min_leaf, local=local)[0]


def fit_many(rows: DataFrame, specs: list[Spec], *, label: str, columns: list[str], seed: int, trees: int = 300,
             min_leaf: int = 2, local: int = LOCAL) -> Forests:
    """A forest per spec, each as ``fit`` grows it from its rows alone; all are grown in the same jobs."""
    spark, columns = rows.sparkSession, list(columns)
    names = [f"x{j}" for j in range(len(columns))]
    folds = {f: f"g{i}" for i, f in enumerate(sorted({s.fold for s in specs if s.fold is not None}))}
    rows = rows.select(F.col(label).cast("string").alias("label"), *[_number(c).alias(n) for c, n in zip(columns, names, strict=True)],
                       *[F.col(f"`{f}`").cast("int").alias(g) for f, g in folds.items()])
    rows = materialise(rows.groupBy("label", *names, *folds.values()).agg(F.count("*").alias("n")), "distinct-rows")
    missing = [F.col(n).isNull() | F.isnan(n) for n in names]
    known = rows.groupBy("label", *folds.values()).agg(F.max(F.greatest(F.col("label").isNull(), *missing)).alias("bad"),
                                                       F.count("*").alias("n")).collect()
    own = [[r for r in known if s.fold is None or r[folds[s.fold]] not in (None, s.out)] for s in specs]
    if not all(own) or any(r["bad"] for some in own for r in some):
        raise ValueError("a forest needs rows, and no missing values or labels")
    labels = [sorted({r["label"] for r in some}) for some in own]
    sizes = [sum(r["n"] for r in some) for some in own]
    cuts = [[_cuts(values[:, j], n) for j in range(len(columns))]
            for values, n in _sampled(rows, specs, sizes, folds, names, sorted({r["label"] for r in known}), seed)]
    shape = Shape(len(columns), max(map(len, labels)), trees, seed, min_leaf)
    learns = [F.col(f"__out_{g}").isNull() | (F.col(f"__out_{g}") != F.col(g)) for g in folds.values()]
    number = F.array_position("__labels", F.col("label")) - 1
    met = rows.join(_models(spark, specs, folds, labels, cuts), reduce(Column.__and__, learns, F.lit(True)))
    cells = materialise(met.select(F.col("__model").alias("model"), _cell(names, _cuts_of(names)).alias("cell"), number.alias("y"), "n")
                        .groupBy("model", "cell", "y").agg(F.sum("n").alias("n"))
                        .repartition(_tasks(spark, sum(sizes) * trees, _DRAW), "model", "cell").sortWithinPartitions("model"), "cells")
    few = {r["model"]: r["count"] <= local for r in cells.groupBy("model").count().collect()}
    each, model = np.tile(np.arange(trees, dtype=np.int64), len(specs)), np.repeat(np.arange(len(specs), dtype=np.int64), trees)
    upper = Upper(model, each, each * 0 + 1, each * 0 - 1, each * 0, each * 0, np.zeros((len(each), shape.classes), np.int64),
                  np.array([few[m] for m in model.tolist()], np.int64))
    while (upper.state == 0).any():
        upper = _split_further(cells, shape, upper, local)
    tasks = min(_tasks(spark, sum(sizes) * trees, _GROW), max(1, int((upper.state == 1).sum())))
    parts = materialise(_subtrees(_drawn(cells, shape, upper), shape, upper, tasks), "forest")
    uppers, parts = _joined([_one_of(upper, m) for m in range(len(specs))], parts, shape)
    return Forests([Forest(labels[m], columns, cuts[m], shape, u, parts.where(F.col("model") == m).drop("model"))
                    for m, u in enumerate(uppers)], specs, parts)


def _models(spark: SparkSession, specs: list[Spec], folds: dict[str, str], labels: list[list[str]], cuts: list[list[list[float]]]) -> DataFrame:
    """A row per forest: its number, the fold it leaves out, its classes and the cuts of each column."""
    numbers = pa.list_(pa.float64())
    return F.broadcast(spark.createDataFrame(pa.table({
        "__model": pa.array(range(len(specs)), pa.int32()), "__labels": pa.array(labels, pa.list_(pa.string())),
        **{f"__out_{g}": pa.array([s.out if s.fold == f else None for s in specs], pa.int32()) for f, g in folds.items()},
        **{f"__cuts{j}": pa.array([c[j] for c in cuts], numbers) for j in range(len(cuts[0]))}})))


def _cuts_of(columns: list[str]) -> list[Column]:
    return [F.col(f"__cuts{j}") for j in range(len(columns))]


class Forests(list):
    """Forests that were grown together, in the order of their specs."""

    def __init__(self, forests: list[Forest], specs: list[Spec], parts: DataFrame):
        super().__init__(forests)
        self.specs, self.parts = specs, parts

    def predict_folds(self, rows: DataFrame, *, keep: list[str]) -> DataFrame:
        """``(keep.., split, fold, pred)``: every row once per column of folds, by the forest that left out its fold."""
        columns, specs = self[0].columns, self.specs
        folds = {f: f"g{i}" for i, f in enumerate(sorted({s.fold for s in specs if s.fold is not None}))}
        names = [f"__x{j}" for j in range(len(columns))]
        flat = rows.select(*keep, *[F.col(f"`{f}`").cast("int").alias(f"__{g}") for f, g in folds.items()],
                           *[_number(c).alias(n) for c, n in zip(columns, names, strict=True)])
        models = _models(rows.sparkSession, specs, folds, [f.labels for f in self], [f.cuts for f in self])
        outs = {f: F.col(f"__out_{g}") for f, g in folds.items()}
        left_out = reduce(Column.__or__, [out == F.col(f"__{folds[f]}") for f, out in outs.items()])
        split = F.coalesce(*[F.when(out.isNotNull(), F.lit(f)) for f, out in outs.items()])
        marked = flat.join(models, left_out).select(*keep, split.alias("split"), F.coalesce(*outs.values()).alias("fold"), "__model",
                                                    _cell(names, _cuts_of(columns)).alias("__cell"))
        return _voted(marked, self, self.parts).select(*keep, "split", "fold", "pred")


def _joined(uppers: list[Upper], parts: DataFrame, shape: Shape) -> tuple[list[Upper], DataFrame]:
    """Leaves of one upper node that predict the same become one, and upper leaves get their rows."""
    spark, out, rows = parts.sparkSession, [], []
    whole = parts.where(F.length("counts") == 8 * shape.classes).select("model", "at", "counts").collect()
    for m, upper in enumerate(uppers):
        feature, counts = upper.feature.copy(), upper.counts.copy()
        leaf = upper.state == 2
        apart = {r["at"]: r["counts"] for r in whole if r["model"] == m}
        for at, found in apart.items():
            counts[at], leaf[at] = np.frombuffer(found, np.int64), True
        leaf &= feature < 0
        winner = counts.argmax(axis=1)
        for i in np.flatnonzero(feature >= 0)[::-1].tolist():
            one = upper.child[i]
            if leaf[one] and leaf[one + 1] and winner[one] == winner[one + 1]:
                feature[i], leaf[i] = -1, True
        own = [i for i in np.flatnonzero(leaf).tolist() if i not in apart]
        rows += [(m, i, (np.array([-1]), np.array([0]), np.array([0]), counts[i])) for i in own]
        out.append(replace(upper, feature=feature, counts=counts))
    if rows:
        parts = parts.unionByName(spark.createDataFrame(_stored(rows).to_pylist(), "model int, " + _GROWN))
    return out, parts

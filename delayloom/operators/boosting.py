"""Boosted trees over category codes, grown level by level on the cluster.

The trees are those Spark ML grows on one-hot vectors: variance gain, the first tree whole and the others at the step size,
rows drawn anew for each tree, features for each node.  A one-hot place needs no column of its own, though: the rows of a
category are one cell of a histogram.  So a pass over the rows costs a few steps a column, however many categories the
columns have, where a vector costs one a category.

Rows become arrays in blocks, stored once.  A pass returns the cells that are not empty, the driver adds them up and picks
the splits of a level.  The predictions of the trees so far are carried along from the stored blocks every few trees, so
nothing builds on a chain of earlier passes.  A job costs more than a pass over few rows, and there is one for each level of
each tree; up to a fixed number of rows, one task therefore does all passes by itself, with the same code.
"""

from __future__ import annotations

import json
import math
import pickle
import uuid
from dataclasses import dataclass, field
from typing import Iterable, Iterator, Mapping, Sequence

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayloom.session import ensure_checkpoint_dir

#: Ranges a number is split between, as in Spark ML.
BINS = 32
#: Trees whose predictions are worked out in every pass before they are stored with the rows.
PENDING = 8
#: Rows of a block, rows a task should have at least and at most, and passes' results that the driver adds up itself.
BLOCK_ROWS, LEAST_ROWS, MOST_ROWS, MOST_RESULTS = 65_536, 16_384, 200_000, 64
#: Rows up to which one task grows all trees, about 100 bytes each.
ONE_TASK_ROWS = 500_000
#: Bytes of the histograms that one pass fills; levels with more are grown in several passes.
PASS_BYTES = 64 * 1024 * 1024
#: Bytes of the histograms of a level that are kept for the next one; beyond that both sides of a split are counted.
KEPT_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class Layout:
    """Columns of a block, numbers first: the cells each has in a histogram and the features they stand for."""

    numbers: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    columns: tuple[str, ...]
    places: tuple[int, ...]

    @property
    def widths(self) -> list[int]:
        # a category that training does not know, or none, has the cell behind the places
        return [len(own) + 1 for own in self.cuts] + [n + 1 for n in self.places]

    @property
    def starts(self) -> list[int]:
        return [0, *np.cumsum(self.widths).tolist()]

    @property
    def features(self) -> int:
        return len(self.numbers) + sum(self.places)


@dataclass
class Tree:
    """A complete binary tree in arrays; ``column`` is -1 at leaves.

    A number goes right with its range above ``cut``, a category with the place ``cut``.
    """

    depth: int
    column: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)
    #: gain, weight, sum and sum of squares of the target, and rows of each node
    stats: np.ndarray = field(init=False)

    def __post_init__(self):
        size = 2 ** (self.depth + 1) - 1
        self.column, self.cut = np.full(size, -1, np.int32), np.zeros(size, np.int64)
        self.value, self.stats = np.zeros(size), np.zeros((size, 5))

    def reached(self, block: np.ndarray, rows: np.ndarray, numbers: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the rows that end in them."""
        waiting = [(0, rows)]
        while waiting:
            node, own = waiting.pop()
            column = self.column[node]
            if column < 0 or not len(own):
                yield node, own
                continue
            values = block[column][own]
            right = values > self.cut[node] if column < numbers else values == self.cut[node]
            waiting += [(2 * node + 2, own[right]), (2 * node + 1, own[~right])]

    def add_to(self, scores: np.ndarray, block: np.ndarray, numbers: int, step: float) -> None:
        for node, own in self.reached(block, np.arange(len(scores)), numbers):
            scores[own] += step * self.value[node]

    def merge_equal_leaves(self) -> None:
        """A split whose sides predict the same is none, as in Spark ML."""
        for node in range(2**self.depth - 2, -1, -1):
            left, right = 2 * node + 1, 2 * node + 2
            if self.column[node] >= 0 and self.column[left] < 0 and self.column[right] < 0 and self.value[left] == self.value[right]:
                self.column[node] = -1


def _target(labels: np.ndarray, scores: np.ndarray, logistic: bool, first: bool) -> np.ndarray:
    """What a tree is fitted to: the labels (-1 and 1 for classes), then the negative gradient of the loss."""
    signed = 2 * labels - 1 if logistic else labels
    if first:
        return signed
    with np.errstate(over="ignore"):
        return 4 * signed / (1 + np.exp(2 * signed * scores)) if logistic else 2 * (signed - scores)


def _packed(numbers: int, cuts: Sequence[Sequence[float]], places: Sequence[int]):
    """Arrow batches to pickled blocks: ranges and codes by column, labels and weights."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        part, kept, size, made = TaskContext.get().partitionId(), [], 0, 0

        def block():
            table = pa.Table.from_batches(kept)
            values = [table.column(k).to_numpy() for k in range(table.num_columns)]
            ranges = [np.searchsorted(own, values[k], side="left") for k, own in enumerate(cuts)]
            codes = [np.minimum(values[numbers + k], n) for k, n in enumerate(places)]
            rows = np.stack([np.asarray(x, np.int32) for x in (*ranges, *codes)]) if ranges or codes else np.zeros((0, size), np.int32)
            # rows of a category side by side, so that a pass fills neighbouring cells
            order = np.argsort(codes[int(np.argmax(places))], kind="stable") if codes else np.arange(size)
            labels, weights = (np.asarray(x, float)[order] for x in values[-2:])
            content = (part, made), rows[:, order], labels, weights, np.zeros(size)
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(content, protocol=5)], pa.binary())], ["block"])

        for batch in batches:
            kept, size = [*kept, batch], size + batch.num_rows
            if size >= BLOCK_ROWS:
                yield block()
                kept, size, made = [], 0, made + 1
        if size:
            yield block()

    return run


@dataclass(frozen=True)
class _Pass:
    """What a task needs for the histograms of some nodes: the trees not yet in the scores, and the tree that grows."""

    layout: Layout
    logistic: bool
    unit: bool
    seed: int
    row_share: float
    step: float
    number: int
    pending: tuple[Tree, ...]
    growing: Tree
    nodes: tuple[int, ...]

    def __call__(self, blocks: Iterable) -> Iterator:
        starts, widths, m = self.layout.starts, self.layout.widths, len(self.nodes)
        count, numbers = starts[-1], len(self.layout.numbers)
        place = {node: k for k, node in enumerate(self.nodes)}
        cells, totals, any_rows = None, np.zeros((4, m)), False
        for (part, made), rows, labels, weights, scores in blocks:
            scores = scores.copy()
            for k, tree in enumerate(self.pending, self.number - len(self.pending)):
                tree.add_to(scores, rows, numbers, self.step if k else 1.0)
            target = _target(labels, scores, self.logistic, self.number == 0)
            drawn = np.arange(len(labels))
            if self.row_share < 1:
                draws = np.random.default_rng([self.seed, self.number, part, made]).random(len(labels))
                drawn = np.flatnonzero(draws < self.row_share)
            found = [(place[node], own) for node, own in self.growing.reached(rows, drawn, numbers) if node in place and len(own)]
            if not found:
                continue
            order = np.concatenate([own for _, own in found])
            at = np.repeat([k for k, _ in found], [len(own) for _, own in found])
            y, w = target[order], weights[order]
            totals += [np.bincount(at, x, m) for x in (np.ones(len(at)), w, w * y, w * y * y)]
            if cells is None:
                cells = np.zeros((2 if self.unit else 3, m, count))
            sums = (None, y) if self.unit else (None, w * y, w)
            for column, (start, width) in enumerate(zip(starts, widths)):
                key = at * width + rows[column][order]
                for into, values in zip(cells, sums):
                    into[:, start:start + width] += np.bincount(key, values, m * width).reshape(m, width)
        if cells is not None:
            flat = cells.reshape(len(cells), -1)
            full = np.flatnonzero(flat[0])
            yield full, flat[:, full], totals


def _added(a, b):
    """Two results of a pass as one."""
    full, back = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    values = np.concatenate([a[1], b[1]], axis=1)
    return full, np.stack([np.bincount(back, own, len(full)) for own in values]), a[2] + b[2]


class _Here:
    """Blocks in the memory of one task."""

    pending = 1

    def __init__(self, blocks: Iterable):
        self.blocks = list(blocks)

    def run(self, task: _Pass) -> list:
        return list(task(self.blocks))

    def advance(self, trees: Sequence[Tree], numbers: int, step: float) -> None:
        last = len(trees) - 1
        for _, rows, _, _, scores in self.blocks:
            trees[last].add_to(scores, rows, numbers, step if last else 1.0)


class _Spread:
    """Blocks dealt over the cluster, kept with the scores of the trees so far."""

    pending = PENDING

    def __init__(self, base):
        self.base, self.kept, self.earlier = base, base.cache(), None

    def run(self, task: _Pass) -> list:
        found = self.kept.mapPartitions(task)
        results = found.collect() if found.getNumPartitions() <= MOST_RESULTS else [found.treeReduce(_added)]
        self._drop_earlier()
        return results

    def advance(self, trees: Sequence[Tree], numbers: int, step: float) -> None:
        # from the stored blocks by all trees: a lost block needs no chain of earlier ones
        self._drop_earlier()
        self.earlier, self.kept = self.kept, self.base.map(_advanced(tuple(trees), numbers, step)).cache()

    def _drop_earlier(self) -> None:
        if self.earlier is not None and self.earlier is not self.base:
            self.earlier.unpersist()
        self.earlier = None

    def release(self) -> None:
        self._drop_earlier()
        self.kept.unpersist()
        self.base.unpersist()


def _advanced(trees: tuple[Tree, ...], numbers: int, step: float):
    """Blocks with the scores of all trees so far."""
    def run(block):
        name, rows, labels, weights, scores = block
        scores = scores.copy()
        for k, tree in enumerate(trees):
            tree.add_to(scores, rows, numbers, step if k else 1.0)
        return name, rows, labels, weights, scores

    return run


def _histograms(blocks: _Here | _Spread, task: _Pass) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, sums of the target and weights by node and cell, and the totals of the nodes."""
    m, count = len(task.nodes), task.layout.starts[-1]
    cells, totals = np.zeros((2 if task.unit else 3, m * count)), np.zeros((4, m))
    for full, values, own in blocks.run(task):
        cells[:, full] += values
        totals += own
    rows, sums, weights = cells[0], cells[1], cells[0] if task.unit else cells[2]
    return *(x.reshape(m, count) for x in (rows, sums, weights)), totals


def _allowed(layout: Layout, share: float, seed: int, number: int, node: int) -> np.ndarray | None:
    """The features a node may split on."""
    count = layout.features
    wanted = math.ceil(share * count)
    if wanted >= count:
        return None
    allowed = np.zeros(count, bool)
    allowed[np.random.default_rng([seed, number, node, 1]).choice(count, wanted, replace=False)] = True
    return allowed


def _best(layout: Layout, rows, sums, weights, total, allowed, scale: float) -> tuple[float, int, int] | None:
    """Gain, column and cut of a node's best split; the first feature of equal ones.

    ``scale`` is the mean square of the whole tree's target: sums differ from one another by rounding, which is no gain.
    """
    n, w, s, ss = total
    starts, numbers = layout.starts, len(layout.numbers)
    if n < 2 or w <= 0:
        return None
    least = 1e-12 * scale
    if ss / w - (s / w) ** 2 <= least:
        return None

    def gain(rows_of, sums_of, weights_of):
        """Of the cells on one side against the others."""
        other = w - weights_of
        good = (rows_of > 0) & (rows_of < n) & (weights_of > 0) & (other > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            both = sums_of**2 / weights_of + (s - sums_of) ** 2 / other
        return np.where(good, (both - s * s / w) / w, -np.inf)

    best = (least, -1, 0)
    for column in range(numbers):
        own = slice(starts[column], starts[column + 1])
        if len(layout.cuts[column]) and (allowed is None or allowed[column]):
            gains = gain(*(np.cumsum(x[own])[:-1] for x in (rows, sums, weights)))
            if gains[k := int(np.argmax(gains))] > best[0]:
                best = (float(gains[k]), column, k)
    feature = numbers
    for column, places in enumerate(layout.places, numbers):
        own = slice(starts[column], starts[column] + places)
        gains = gain(rows[own], sums[own], weights[own])
        if allowed is not None:
            gains = np.where(allowed[feature:feature + places], gains, -np.inf)
        if places and gains[k := int(np.argmax(gains))] > best[0]:
            best = (float(gains[k]), column, k)
        feature += places
    return best if best[1] >= 0 else None


def _split(layout: Layout, tree: Tree, node: int, column: int, cut: int, cells, total) -> None:
    """Make ``node`` a split and give its sides what they predict."""
    start = layout.starts[column]
    own = slice(start + cut, start + cut + 1) if column >= len(layout.numbers) else slice(start + cut + 1, layout.starts[column + 1])
    rows, sums, weights = (float(x[own].sum()) for x in cells)
    tree.column[node], tree.cut[node] = column, cut
    for side, (n, w, s) in ((2 * node + 1, (total[0] - rows, total[1] - weights, total[2] - sums)), (2 * node + 2, (rows, weights, sums))):
        tree.value[side] = s / w
        tree.stats[side] = 0.0, w, s, np.nan, n  # the squares are known when a pass reaches the node


def _grow(
    blocks: _Here | _Spread, layout: Layout, settings, number: int, pending: tuple[Tree, ...], logistic: bool, unit: bool
) -> Tree:
    """One tree, level by level.  Of two sides only the smaller one is counted: the other is what is left of their node."""
    tree, level, parents, scale = Tree(settings.depth), [0], {}, 0.0
    cell_bytes = 24 * layout.starts[-1]
    for _ in range(settings.depth):
        found: dict[int, tuple] = {}
        counted = [node for node in level if (node - 1) // 2 not in parents or node == _smaller(tree, (node - 1) // 2)]
        group = max(1, PASS_BYTES // cell_bytes)
        for some in (counted[k:k + group] for k in range(0, len(counted), group)):
            task = _Pass(layout, logistic, unit, settings.seed, settings.row_share, settings.step, number, pending, tree, tuple(some))
            *cells, totals = _histograms(blocks, task)
            found |= {node: ([x[k] for x in cells], totals[:, k]) for k, node in enumerate(some)}
        following, kept = [], {}
        for node in level:
            if node in found:
                own, total = found[node]
            else:
                (whole, whole_total), (side, side_total) = parents[(node - 1) // 2], found[node - 1 if node % 2 == 0 else node + 1]
                own, total = [x - y for x, y in zip(whole, side)], whole_total - side_total
            n, w, s, ss = total
            scale = scale or (ss / w if w > 0 else 0.0)
            tree.stats[node] = 0.0, w, s, ss, n
            tree.value[node] = s / w if w > 0 else 0.0
            allowed = _allowed(layout, settings.column_share, settings.seed, number, node)
            if best := _best(layout, *own, total, allowed, scale):
                gain, column, cut = best
                _split(layout, tree, node, column, cut, own, total)
                tree.stats[node, 0] = gain
                following += [2 * node + 1, 2 * node + 2]
                kept[node] = own, total
        if not following:
            break
        level, parents = following, kept if len(kept) * cell_bytes <= KEPT_BYTES else {}
    tree.merge_equal_leaves()
    return tree


def _smaller(tree: Tree, node: int) -> int:
    left, right = 2 * node + 1, 2 * node + 2
    return left if tree.stats[left, 4] <= tree.stats[right, 4] else right


def _cuts(rows: DataFrame, numbers: Sequence[str], bins: int = BINS) -> tuple[tuple[float, ...], ...]:
    """Values between the ranges of each number: between all values when there are few, else quantiles of all rows."""
    if not numbers:
        return ()
    values = rows.select(F.inline(F.array(*(
        F.struct(F.lit(k).alias("k"), F.col(f"`{name}`").alias("value")) for k, name in enumerate(numbers))))).distinct()
    few = [row.k for row in values.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= bins).collect()]
    found: list[list[float]] = [[] for _ in numbers]
    for row in values.filter(F.col("k").isin(*few)).collect() if few else ():
        found[row.k].append(row.value)
    cuts = [sorted(own) for own in found]
    cuts = [[low + (high - low) / 2 for low, high in zip(own, own[1:])] for own in cuts]
    if many := [k for k in range(len(numbers)) if k not in few]:
        shares = [k / bins for k in range(1, bins)]
        one = rows.agg(*(F.percentile_approx(f"`{numbers[k]}`", shares, 10_000).alias(str(k)) for k in many)).first()
        for k in many:
            cuts[k] = sorted(set(one[str(k)]))
    return tuple(map(tuple, cuts))


def fit(rows: DataFrame, numbers: Sequence[str], places: Mapping[str, int], settings, logistic: bool) -> tuple[Layout, list[Tree]]:
    """Trees over ``numbers`` and the codes in the columns of ``places`` (from 0, a higher one is no category).

    ``rows`` also has ``label`` and may have ``weight``.  Places are split off one by one, as one-hot features are.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    weight = F.col("weight").cast("double") if "weight" in rows.columns else F.lit(1.0)
    stored = rows.select(
        *(F.col(f"`{name}`").cast("double").alias(name) for name in numbers),
        *(F.col(f"`{name}`").cast("int").alias(name) for name in places),
        F.col("label").cast("double").alias("label"), weight.alias("weight"),
    ).checkpoint()
    missing = lambda name: F.col(f"`{name}`").isNull() | F.isnan(f"`{name}`")
    odd = missing("label") | missing("weight") | (F.col("weight") < 0)
    odd = odd | (~F.col("label").isin(0.0, 1.0) if logistic else F.abs("label") == float("inf"))
    for name in numbers:
        odd = odd | missing(name)
    known = stored.agg(F.count(F.lit(1)).alias("n"), F.count_if(odd).alias("odd"),
                       F.count_if(F.col("weight") != 1.0).alias("weighted")).first()
    if not known.n or known.odd:
        raise ValueError(f"{known.odd} of {known.n} training rows without a usable label, weight or number")
    layout = Layout(tuple(numbers), _cuts(stored, numbers), tuple(places), tuple(places.values()))
    parts = max(math.ceil(known.n / MOST_ROWS), min(spark.sparkContext.defaultParallelism, math.ceil(known.n / LEAST_ROWS)))
    alone = known.n <= ONE_TASK_ROWS
    if alone:
        dealt = stored.coalesce(1)
    elif places:
        # neighbours in the widest column share tasks, so that a task fills few cells of the columns that go with it
        widest = max(places, key=places.get)
        dealt = stored.repartitionByRange(parts, F.col(f"`{widest}`"), F.xxhash64(*(f"`{name}`" for name in stored.columns)))
    else:
        dealt = stored.repartition(parts)
    # stored, so that a block read again has the same rows in the same order, and the same ones are drawn
    packed = dealt.mapInArrow(_packed(len(layout.numbers), layout.cuts, layout.places), "block binary").checkpoint()
    base = packed.coalesce(1 if alone else parts).rdd.map(lambda row: pickle.loads(row[0]))
    own = _Boost(layout, settings, logistic, not known.weighted)
    if alone:
        return layout, base.mapPartitions(own.in_one_task).first()
    spread = _Spread(base)
    try:
        return layout, own.trees(spread)
    finally:
        spread.release()


@dataclass(frozen=True)
class _Boost:
    layout: Layout
    settings: object
    logistic: bool
    unit: bool

    def trees(self, blocks: _Here | _Spread) -> list[Tree]:
        found: list[Tree] = []
        numbers, step, kept = len(self.layout.numbers), self.settings.step, 0
        for number in range(self.settings.trees):
            if number - kept == blocks.pending:
                blocks.advance(found, numbers, step)
                kept = number
            found.append(_grow(blocks, self.layout, self.settings, number, tuple(found[kept:]), self.logistic, self.unit))
        return found

    def in_one_task(self, blocks: Iterable) -> Iterator:
        yield self.trees(_Here(blocks))


def _node_rows(layout: Layout, tree: Tree, number: int) -> list[tuple]:
    """Nodes in Spark's own order: a node, all of its left side, all of its right side."""
    firsts = np.cumsum([len(layout.numbers), *layout.places]).tolist()
    found: list[tuple] = []

    def add(node: int) -> int:
        place, column = len(found), int(tree.column[node])
        gain, w, s, ss, n = map(float, tree.stats[node])
        impurity, leaf = ss / w - (s / w) ** 2 if w > 0 else 0.0, column < 0
        found.append(())
        left, right = (-1, -1) if leaf else (add(2 * node + 1), add(2 * node + 2))
        if leaf:
            split = (-1, [], -1)
        elif column < len(layout.numbers):
            split = (column, [layout.cuts[column][int(tree.cut[node])]], -1)
        else:
            split = (firsts[column - len(layout.numbers)] + int(tree.cut[node]), [0.5], -1)
        found[place] = (number, (place, float(tree.value[node]), impurity, [w, s, ss], int(n), -1.0 if leaf else gain, left, right, split))
        return place

    add(0)
    return found


def spark_model(estimator, layout: Layout, trees: Sequence[Tree], step: float, sample: DataFrame):
    """The trees as the model that ``estimator`` makes: a model of one split says how Spark stores it."""
    spark = sample.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    tiny = estimator.copy({estimator.maxIter: 1, estimator.maxDepth: 1}).fit(sample)
    tiny.write().save(f"{folder}/form")
    about = json.loads(spark.read.text(f"{folder}/form/metadata").first()[0])
    about |= {"numFeatures": layout.features, "numTrees": len(trees)}
    about["paramMap"] |= {"maxIter": len(trees), "maxDepth": estimator.getMaxDepth()}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{folder}/model/metadata")
    form = spark.read.parquet(f"{folder}/form/treesMetadata")
    first = form.first()
    own = json.loads(next(value for value in first if isinstance(value, str)))

    def tree_row(number: int) -> tuple:
        text = json.dumps(own | {"uid": f"{own['uid']}_{number}", "paramMap": own["paramMap"] | {"maxDepth": estimator.getMaxDepth()}})
        by_type = {T.IntegerType(): number, T.StringType(): text, T.DoubleType(): step if number else 1.0}
        return tuple(by_type[column.dataType] for column in form.schema)

    numbered = range(len(trees))
    spark.createDataFrame([tree_row(k) for k in numbered], form.schema).coalesce(1).write.parquet(f"{folder}/model/treesMetadata")
    nodes = [row for k in numbered for row in _node_rows(layout, trees[k], k)]
    schema = spark.read.parquet(f"{folder}/form/data").schema
    spark.createDataFrame(nodes, schema).coalesce(1).write.parquet(f"{folder}/model/data")
    return type(tiny).load(f"{folder}/model")

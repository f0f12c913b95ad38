"""A random forest grown level by level from rows of small bin numbers.

Spark's classifier holds every row as one number for each slot, and two for each tree. Here a row is
one bin for each input column and, for the trees grown at once, one small number each: the
row's weight in the tree's bag and the node it has reached. Tasks count the classes of each bin,
counts of all tasks are added up by tree, and the best splits come back to the driver. The rules
are those of Spark's classifier: a Poisson bag for each tree, a drawn subset of slots for each node,
thresholds from a sample of the rows, Gini gain, and leaves of one parent merged if they predict
the same. What comes out is a model of Spark's.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import delete, fresh_folder, release

# Rows that a task works on at once, blocks that one task has at most, and trees grown at once.
BLOCK, BLOCKS, GROUP = 1 << 15, 256, 20
# One row of a block stands for this many copies at most, so that a weight fits its bits.
COPIES, WEIGHT_BITS = 16, 7
# Counts of one tree and column are made for so many cells at a time.
CELLS = 1 << 22
# Rows that thresholds are sought in; Spark's figure.
DRAWN = 10_000


def can_grow(classifier: RandomForestClassifier) -> bool:
    """Whether the settings are those that `grow` has; Spark's classifier has more."""
    return (classifier.getImpurity() == "gini" and classifier.getBootstrap()
            and classifier.getFeatureSubsetStrategy() in ("auto", "sqrt")
            and classifier.getMinWeightFractionPerNode() == 0 and not classifier.isDefined("weightCol")
            and not classifier.isDefined("thresholds"))


@dataclass(frozen=True)
class Layout:
    """Columns of the binned rows: numbers with their thresholds, then categories with their sizes."""

    thresholds: list[np.ndarray]
    sizes: list[int]
    classes: int

    @property
    def slots(self) -> int:
        return len(self.thresholds) + sum(self.sizes)

    @property
    def width(self) -> int:
        """Most bins that a column has."""
        return max([len(t) + 1 for t in self.thresholds] + self.sizes)

    @property
    def bins(self) -> int:
        """Most bins that a number has."""
        return max([len(t) + 1 for t in self.thresholds], default=1)

    @property
    def kind(self) -> np.dtype:
        return np.min_scalar_type(max(self.width, self.classes, COPIES))

    def place(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The column of each slot, and its category there; a number has none, so -1."""
        numbers = len(self.thresholds)
        starts = numbers + np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        which = np.searchsorted(starts, slots, side="right") - 1
        is_number = slots < numbers
        return (np.where(is_number, slots, numbers + which),
                np.where(is_number, -1, slots - starts[np.maximum(which, 0)]))


def thresholds(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Midpoints that part the weight of `values` evenly, `most` of them; all if there are no more."""
    found, at = np.unique(values, return_inverse=True)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) <= most:
        return middles
    counts = np.bincount(at, weights)
    before = np.cumsum(counts)
    stride = counts.sum() / (most + 1)
    kept, target = [], stride
    for i in range(1, len(found)):
        if abs(before[i - 1] - target) < abs(before[i] - target):
            kept.append(middles[i - 1])
            target += stride
    return np.array(kept)


@lru_cache(maxsize=1)
def _bag_tables(rate: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """For 0 to COPIES copies: the draw for each 16-bit number, 255 where that does not decide it, and
    the cumulated chances that do."""
    edges = np.arange(65537) / 65536
    table, chances = [], []
    for copies in range(COPIES + 1):
        mean = rate * copies
        share = [math.exp(-mean)]
        for j in range(1, 1 << WEIGHT_BITS):
            share.append(share[-1] * mean / j)
        chance = np.cumsum(share)[:-1]
        low, high = np.searchsorted(chance, edges[:-1], "right"), np.searchsorted(chance, edges[1:], "left")
        table.append(np.where(low == high, low, 255).astype(np.uint8))
        chances.append(chance)
    return np.concatenate(table), chances


def bag(copies: np.ndarray, rate: float, seed: list[int]) -> np.ndarray:
    """How often each row is drawn for a tree: a Poisson draw for each of its copies, added up."""
    table, chances = _bag_tables(rate)
    source = np.random.Generator(np.random.SFC64(np.random.SeedSequence(seed)))
    numbers = source.integers(0, 65536, len(copies), dtype=np.uint16)
    drawn = _at(table, copies.astype(np.int64) * 65536 + numbers)
    for i in np.flatnonzero(drawn == 255):
        drawn[i] = np.searchsorted(
            chances[copies[i]], (numbers[i] + source.random()) / 65536, "right")
    return drawn


def cut_blocks(rows: DataFrame, layout: Layout, size: int) -> DataFrame:
    """Rows of number columns, category indexes, label and copies as blocks of bins, a row of bytes
    for each column."""
    numbers = len(layout.thresholds)

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = pa.Table.from_batches(parts).columns
        values = [c.to_numpy() for c in columns]
        copies = values[-1].astype(np.int64)
        binned = [np.searchsorted(t, v, "left") for t, v in zip(layout.thresholds, values)]
        binned += [*values[numbers:-1]]
        if copies.max() > COPIES:
            times = -(-copies // COPIES)
            binned = [np.repeat(b, times) for b in binned]
            at = np.arange(len(binned[-1])) - np.repeat(np.cumsum(times) - times, times)
            copies = np.minimum(COPIES, np.repeat(copies, times) - at * COPIES)
        cells = np.stack([*binned, copies]).astype(layout.kind)
        return pa.record_batch([pa.array([cells.shape[1]], pa.int32()),
                                pa.array([cells.tobytes()], pa.binary())], ["n", "cells"])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == size:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    return rows.mapInArrow(cut, "n int, cells binary")


@dataclass(frozen=True)
class Level:
    """The nodes of one tree that a level splits: the slots drawn for each, in order."""

    chosen: np.ndarray

    @property
    def nodes(self) -> int:
        return len(self.chosen)

    def numbers(self, layout: Layout) -> np.ndarray:
        """How many of the slots of each node are numbers; they come first."""
        return (self.chosen < len(layout.thresholds)).sum(axis=1)

    def categories(self, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
        """Node and slot of each category drawn."""
        node, at = np.nonzero(self.chosen >= len(layout.thresholds))
        return node, self.chosen[node, at]


class Counts:
    """Class counts of one tree and level: by node, by category drawn, by bin of the numbers drawn."""

    def __init__(self, level: Level, layout: Layout) -> None:
        self.level, self.layout = level, layout
        self.per_node = level.numbers(layout)
        self.first = np.cumsum(self.per_node) - self.per_node
        self.node, slot = level.categories(layout)
        self.column, self.category = layout.place(slot)
        self.of_column = {c: np.flatnonzero(self.column == c) for c in self.category_columns}
        classes, pairs = layout.classes, int(self.per_node.sum())
        self.totals = np.zeros((level.nodes, classes))
        self.with_category = np.zeros((len(self.node), classes))
        self.by_bin = np.zeros(pairs * layout.bins * classes)

    @property
    def category_columns(self) -> range:
        numbers = len(self.layout.thresholds)
        return range(numbers, numbers + len(self.layout.sizes))

    def add(self, flat: np.ndarray, n: int, label: np.ndarray, row: np.ndarray, node: np.ndarray,
            weight: np.ndarray) -> None:
        """Rows in the bag. `flat`: bin x classes + label of all rows, column after column."""
        layout, classes = self.layout, self.layout.classes
        key = node * classes
        key += _at(label, row)
        self.totals += np.bincount(key, weight, self.totals.size).reshape(-1, classes)
        for column, pairs in self.of_column.items():
            if len(pairs):
                self._add_column(_at(flat[column * n:(column + 1) * n], row), column, pairs, node, weight)
        for j in range(int(self.per_node.max(initial=0))):
            has = self.per_node > j
            if not has.all():
                some = np.flatnonzero(_at(has, node))
                row, node, weight = _at(row, some), _at(node, some), _at(weight, some)
            key = _at((self.first + j) * (layout.bins * classes), node)
            place = _at(self.level.chosen[:, j] * n, node)
            place += row
            key += _at(flat, place)
            self.by_bin += np.bincount(key, weight, self.by_bin.size)

    def _add_column(self, cells: np.ndarray, column: int, pairs: np.ndarray, node: np.ndarray,
                    weight: np.ndarray) -> None:
        size, classes = self.layout.sizes[column - len(self.layout.thresholds)], self.layout.classes
        step = max(1, CELLS // (size * classes))  # nodes counted at a time
        for low in range(0, self.level.nodes, step):
            nodes = min(step, self.level.nodes - low)
            some, of, part, by = pairs, node, cells, weight
            if nodes < self.level.nodes:
                here = np.flatnonzero((node >= low) & (node < low + nodes))
                of, part, by = _at(node, here) - low, _at(cells, here), _at(weight, here)
                some = pairs[(self.node[pairs] >= low) & (self.node[pairs] < low + nodes)]
            key = of * (size * classes)
            key += part
            found = np.bincount(key, by, nodes * size * classes)
            self.with_category[some] += found.reshape(nodes, size, classes)[
                self.node[some] - low, self.category[some]]


def _at(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """`values.take(places)` for places within bounds, which are not checked; three times as fast."""
    return values.take(places, mode="wrap")


def impurity(counts: np.ndarray) -> np.ndarray:
    total = np.maximum(counts.sum(axis=-1, keepdims=True), 1e-300)
    return 1 - ((counts / total) ** 2).sum(axis=-1)


@dataclass(frozen=True)
class Splits:
    """The best split of each node of a level; a slot of -1 for none.

    `at`: the last bin that goes left, or the category that goes right.
    """

    slot: np.ndarray
    at: np.ndarray
    gain: np.ndarray
    totals: np.ndarray
    left: np.ndarray


def best_splits(
    counts: tuple[np.ndarray, np.ndarray, np.ndarray], level: Level, layout: Layout, least: int,
    least_gain: float,
) -> Splits:
    totals, with_category, by_bin = counts
    node, slot = level.categories(layout)
    _, at = layout.place(slot)
    left = totals[node] - with_category
    per_node = level.numbers(layout)
    if per_node.sum():
        of = np.repeat(np.arange(level.nodes), per_node)
        column = level.chosen[of, np.arange(len(of)) - np.repeat(np.cumsum(per_node) - per_node, per_node)]
        below = by_bin.reshape(len(of), layout.bins, layout.classes).cumsum(axis=1)
        most = np.array([len(t) for t in layout.thresholds])
        pair, last = np.nonzero(np.arange(layout.bins)[None] < most[column][:, None])
        node, slot = np.concatenate([of[pair], node]), np.concatenate([column[pair], slot])
        at, left = np.concatenate([last, at]), np.concatenate([below[pair, last], left])
    whole = totals[node]
    right = whole - left
    a, b = left.sum(axis=1), right.sum(axis=1)
    gain = impurity(whole) - (a * impurity(left) + b * impurity(right)) / np.maximum(a + b, 1)
    sound = np.flatnonzero((a >= least) & (b >= least) & (gain > 0) & (gain >= least_gain))
    order = sound[np.lexsort((at[sound], slot[sound], -gain[sound], node[sound]))]
    nodes, first = np.unique(node[order], return_index=True)
    best = order[first]
    out = Splits(np.full(level.nodes, -1), np.zeros(level.nodes, np.int64), np.zeros(level.nodes), totals,
                 np.zeros_like(totals))
    for all_of, found in ((out.slot, slot), (out.at, at), (out.gain, gain), (out.left, left)):
        all_of[nodes] = found[best]
    return out


@dataclass(frozen=True)
class Route:
    """Where a level sends the rows of one tree: by node, the column asked and, by bin, the next node."""

    column: np.ndarray
    target: np.ndarray  # -1: the row has arrived in a leaf


class Tree:
    """Nodes in the order they were made, and those that the next level splits."""

    def __init__(self, classes: int) -> None:
        self.counts = np.zeros((1, classes))
        self.slot, self.at, self.gain = np.array([-1]), np.array([0]), np.array([0.0])
        self.child = np.array([-1])  # the left one; the right one is next to it
        self.active = np.array([0])

    def split(self, found: Splits, layout: Layout, is_last: bool) -> Route:
        """Add the children of a level; those of one class, and all of the last level, are leaves."""
        self.counts[self.active] = found.totals
        split = np.flatnonzero(found.slot >= 0)
        parents = self.active[split]
        child = len(self.counts) + 2 * np.arange(len(split))
        self.slot[parents], self.at[parents] = found.slot[split], found.at[split]
        self.gain[parents], self.child[parents] = found.gain[split], child
        pairs = np.stack([found.left[split], found.totals[split] - found.left[split]], axis=1)
        made = pairs.reshape(-1, pairs.shape[-1])
        self.counts = np.concatenate([self.counts, made])
        for name, empty in (("slot", -1), ("at", 0), ("gain", 0.0), ("child", -1)):
            held = getattr(self, name)
            setattr(self, name, np.concatenate([held, np.full(len(made), empty, held.dtype)]))
        goes_on = (impurity(made) >= np.finfo(float).eps) & (not is_last)
        self.active = len(self.counts) - len(made) + np.flatnonzero(goes_on)
        number = np.where(goes_on, np.cumsum(goes_on) - 1, -1).reshape(-1, 2)
        column, category = layout.place(found.slot[split])
        bins = np.arange(layout.width)
        right = np.where((category >= 0)[:, None], bins == category[:, None], bins > found.at[split][:, None])
        target = np.full((len(found.slot), layout.width), -1, np.int32)
        target[split] = np.where(right, number[:, 1:], number[:, :1])
        asked = np.zeros(len(found.slot), np.int64)
        asked[split] = column
        return Route(asked, target)

    def rows(self, layout: Layout) -> list[tuple]:
        """Nodes from the top, left before right, leaves of one parent merged if they predict the same."""
        guess, mixed = self.counts.argmax(axis=1), impurity(self.counts)
        is_leaf = self.child < 0
        for i in range(len(self.child) - 1, -1, -1):  # children come after their parents
            c = self.child[i]
            if c >= 0 and is_leaf[c] and is_leaf[c + 1] and guess[c] == guess[c + 1]:
                is_leaf[i] = True
        out: list[list] = []
        waiting = [(0, -1)]
        while waiting:
            i, parent = waiting.pop()
            if parent >= 0:
                out[parent][7] = len(out)  # its right child
            stats = self.counts[i]
            row = [len(out), float(guess[i]), float(mixed[i]), stats.tolist(), int(stats.sum())]
            if is_leaf[i]:
                out.append([*row, -1.0, -1, -1, (-1, [], -1)])
                continue
            slot = int(self.slot[i])
            value = layout.thresholds[slot][self.at[i]] if slot < len(layout.thresholds) else 0.5
            out.append([*row, float(self.gain[i]), len(out) + 1, -1, (slot, [float(value)], -1)])
            waiting += [(int(self.child[i]) + 1, len(out) - 1), (int(self.child[i]), -1)]
        return [tuple(r) for r in out]


Record = tuple[int, np.ndarray, np.ndarray]  # number of the block, its bins, its state by tree


def _kind(bits: int) -> np.dtype:
    return np.min_scalar_type((1 << (bits + WEIGHT_BITS)) - 1)


def _counted(
    records: Iterable[Record], levels: list[Level], layout: Layout, bits: int,
) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The class counts of each tree over the blocks of one task."""
    sums = [Counts(level, layout) for level in levels]
    for _, block, state in records:
        n = block.shape[1]
        label = block[-2].astype(np.int64)
        flat = (block[:-2].astype(np.int64) * layout.classes + label).ravel()
        for counts, cells in zip(sums, state):
            row = np.flatnonzero(cells != 0)
            if len(row):
                cell = _at(cells, row)
                counts.add(flat, n, label, row, (cell & ((1 << bits) - 1)).astype(np.int64),
                           (cell >> bits).astype(np.float64))
    for i, counts in enumerate(sums):
        if counts.level.nodes:
            yield i, (counts.totals, counts.with_category, counts.by_bin)


def _routed(record: Record, routes: list[Route], bits: int) -> Record:
    """The rows of a block one level further down; those in leaves drop out."""
    number, block, state = record
    n, flat, out = block.shape[1], block.ravel(), np.zeros_like(state)
    mask = (1 << bits) - 1
    for cells, moved, route in zip(state, out, routes):
        row = np.flatnonzero(cells != 0)
        if len(row):
            cell = _at(cells, row)
            node = (cell & mask).astype(np.int64)
            place = _at(route.column * n, node)
            place += row
            node *= route.target.shape[1]
            node += _at(flat, place)
            target = _at(route.target, node)
            moved[row] = np.where(target < 0, 0, (cell & ~cell.dtype.type(mask)) | target)
    return number, block, out


def _grow_group(
    blocks: RDD, trees: range, layout: Layout, classifier: RandomForestClassifier,
) -> list[Tree]:
    context = blocks.context
    depth, seed = classifier.getMaxDepth(), classifier.getSeed() & (2**64 - 1)
    least, least_gain = classifier.getMinInstancesPerNode(), classifier.getMinInfoGain()
    rate = classifier.getSubsamplingRate()
    bits = max(depth - 1, 1)
    few = max(1, math.ceil(math.sqrt(layout.slots)))

    def start(record: tuple[int, np.ndarray]) -> Record:
        number, block = record
        state = np.stack([bag(block[-1], rate, [seed, 0, t, number]) for t in trees])
        return number, block, state.astype(_kind(bits)) << bits

    def drawn_slots(tree: int, level: int, nodes: int) -> np.ndarray:
        source = np.random.Generator(np.random.PCG64([seed, 1, tree, level]))
        order = np.argpartition(source.random((nodes, layout.slots)), min(few, layout.slots) - 1, axis=1)
        return np.sort(order[:, :few], axis=1)

    grown = [Tree(layout.classes) for _ in trees]
    state, routes = blocks.map(start).persist(StorageLevel.MEMORY_AND_DISK), None
    sent = []  # a lost state is made again from all of them
    try:
        for level in range(max(depth, 1)):
            held = state
            if routes is not None:
                sent.append(ways := context.broadcast(routes))
                state = held.map(lambda r, ways=ways: _routed(r, ways.value, bits)).persist(
                    StorageLevel.MEMORY_AND_DISK)
            plan = context.broadcast([
                Level(drawn_slots(t, level, len(tree.active))) for t, tree in zip(trees, grown)])
            counts = state.mapPartitions(lambda r, plan=plan: _counted(r, plan.value, layout, bits))
            found = dict(
                counts.reduceByKey(lambda a, b: tuple(x + y for x, y in zip(a, b)),
                                   min(len(trees), blocks.getNumPartitions()))
                .map(lambda x, plan=plan: (
                    x[0], best_splits(x[1], plan.value[x[0]], layout, least, least_gain)))
                .collect())
            if held is not state:
                held.unpersist()
            plan.destroy()
            nothing = Splits(*(np.zeros(0, np.int64),) * 3, *(np.zeros((0, layout.classes)),) * 2)
            if depth == 0:
                for i, tree in enumerate(grown):
                    tree.counts[:] = found[i].totals
                break
            routes = [tree.split(found.get(i, nothing), layout, level + 1 == depth)
                      for i, tree in enumerate(grown)]
            if not any(len(tree.active) for tree in grown):
                break
    finally:
        state.unpersist()
        for ways in sent:
            ways.destroy()
    return grown


def grow(
    classifier: RandomForestClassifier, rows: DataFrame, numbers: list[str], categories: dict[str, int],
    copies: str,
) -> RandomForestClassificationModel:
    """Fit `classifier` to `rows`, each of which stands for as many as `copies` says.

    `categories` are columns of category indexes with their numbers of slots; the model's features are
    the numbers and then one 0/1 slot for each category. `rows` should be a written table, as it
    is read several times.
    """
    spark, label = rows.sparkSession, classifier.getLabelCol()
    known = rows.agg(F.count("*").alias("n"), F.sum(copies).alias("copies"), F.max(label).alias("last")).first()
    drawn = rows.select(*numbers, copies).sample(
        False, min(1.0, max(DRAWN, classifier.getMaxBins() ** 2) / known["n"]), classifier.getSeed())
    *sample, weights = np.array(drawn.collect(), float).reshape(-1, len(numbers) + 1).T
    most = min(classifier.getMaxBins(), known["copies"]) - 1
    layout = Layout([thresholds(values, weights, most) for values in sample],
                    list(categories.values()), int(known["last"]) + 1)
    context = spark.sparkContext
    tasks = 2 * context.defaultParallelism
    size = min(BLOCK, max(1024, math.ceil(known["n"] / tasks)))
    columns = [F.col(c).cast("double") for c in numbers] + [
        F.col(c).cast("int") for c in [*categories, label, copies]]
    kind = layout.kind
    cut = cut_blocks(rows.select(*columns), layout, size).rdd.map(
        lambda r: np.frombuffer(r.cells, kind).reshape(-1, r.n)).persist(StorageLevel.MEMORY_AND_DISK)
    numbered = cut.zipWithIndex().map(lambda x: (x[1], x[0]))
    tasks = max(tasks, math.ceil(known["n"] / (BLOCK * BLOCKS)))
    blocks = numbered.partitionBy(tasks, lambda number: number).persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[Tree] = []
    try:
        blocks.count()
        cut.unpersist()
        for first in range(0, classifier.getNumTrees(), GROUP):
            group = range(first, min(first + GROUP, classifier.getNumTrees()))
            trees += _grow_group(blocks, group, layout, classifier)
    finally:
        cut.unpersist()
        blocks.unpersist()
    return _as_model(spark, classifier, trees, layout)


NODE_TYPE = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
    ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
    ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([
        ("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
        ("numCategories", pa.int32())]))])
MODEL_CLASS = "org.apache.spark.ml.classification.{}ClassificationModel"
FOREST_ONLY = ["numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap", "leafCol"]


def _as_model(
    spark: SparkSession, classifier: RandomForestClassifier, trees: list[Tree], layout: Layout,
) -> RandomForestClassificationModel:
    """The trees in the files of a stored model, loaded by Spark."""
    path = fresh_folder(spark, "forest")
    classifier.write().save(f"{path}/classifier")
    known = json.loads(spark.read.text(f"{path}/classifier/metadata").first()[0])
    of_forest = {**known, "class": MODEL_CLASS.format("RandomForest"), "numFeatures": layout.slots,
                 "numClasses": layout.classes, "numTrees": len(trees)}
    of_tree = {**known, "class": MODEL_CLASS.format("DecisionTree")} | {
        part: {k: v for k, v in known[part].items() if k not in FOREST_ONLY}
        for part in ("paramMap", "defaultParamMap")}
    stamp = {"timestamp": int(time.time() * 1000)}
    spark.createDataFrame([(json.dumps(of_forest | stamp),)], "value string").coalesce(1).write.text(
        f"{path}/model/metadata")
    spark.createDataFrame(
        [(i, json.dumps(of_tree | stamp | {"uid": f"{known['uid']}_{i}"}), 1.0) for i in range(len(trees))],
        "_1 int, _2 string, _3 double").write.parquet(f"{path}/model/treesMetadata")
    names = [field.name for field in NODE_TYPE]
    parts = [field.name for field in NODE_TYPE.field("split").type]
    numbers, nodes = [], []
    for i, tree in enumerate(trees):
        for *row, split in tree.rows(layout):
            numbers.append(i)
            nodes.append(dict(zip(names, [*row, dict(zip(parts, split))])))
    table = pa.table({"treeID": pa.array(numbers, pa.int32()), "nodeData": pa.array(nodes, NODE_TYPE)})
    spark.createDataFrame(table).write.parquet(f"{path}/model/data")
    model = RandomForestClassificationModel.load(f"{path}/model")
    delete(spark, path)
    release(spark)
    return model

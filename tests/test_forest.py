import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from skyledger.operators import forest, ml
from skyledger.plans import catalog
from skyledger.session import materialize, release
from skyledger.sources.star import train_flights

SLOTS = {f"{c}Index": 4 for c in ml.CATEGORICAL}


def flights_with_a_rule(spark, n):
    """Rows whose class follows the departure hour and the carrier, but for a part."""
    i = F.col("id")
    hour, carrier = (i * 13 % 24).cast("int"), i * 7 % 5
    rule = F.when(carrier == 1, 3).when(hour < 8, 0).when(hour < 15, 1).otherwise(2)
    numbers = {c: (i * (3 + k) % (9 + k)).cast("int") for k, c in enumerate(ml.NUMERIC)} | {
        "DepHour": hour, "Distance": (i * 37 % 1999).cast("double")}
    return spark.range(n).select(
        F.when(F.xxhash64("id") % 10 == 0, (i % 4).cast("int")).otherwise(rule).alias(ml.LABEL),
        *(numbers[c].alias(c) for c in ml.NUMERIC), F.concat(F.lit("A"), carrier).alias("UniqueCarrier"),
        F.concat(F.lit("B"), i % 6).alias("Origin"), F.concat(F.lit("C"), i % 7).alias("Dest"),
        F.lit("same").alias("RouteType"))


def naive_counts(block, weight, node, level, layout):
    """Class counts by node, by drawn category and by bin of each drawn number, row by row."""
    totals = np.zeros((level.nodes, layout.classes))
    cells = {}
    for r in range(block.shape[1]):
        label = block[-2, r]
        totals[node[r], label] += weight[r]
        for slot in level.chosen[node[r]]:
            column, category = layout.place(np.array([slot]))
            if category[0] < 0 or block[column[0], r] == category[0]:
                key = (node[r], slot, block[column[0], r] if category[0] < 0 else 0, label)
                cells[key] = cells.get(key, 0) + weight[r]
    return totals, cells


@pytest.fixture(scope="module")
def counted():
    source = np.random.default_rng(5)
    layout = forest.Layout([np.arange(4) + 0.5, np.array([]), np.arange(2) + 0.5], [6, 3], 3)
    n, nodes = 700, 5
    block = np.stack([source.integers(0, k, n) for k in (5, 1, 3, 6, 3, 3, 2)]).astype(layout.kind)
    level = forest.Level(np.sort(np.array([
        source.permutation(layout.slots)[:4] for _ in range(nodes)]), axis=1))
    node, weight = source.integers(0, nodes, n), source.integers(0, 4, n)
    state = np.where(weight > 0, weight << 9 | node, 0).astype(forest._kind(9))[None]
    return block, level, layout, node, weight, state


@pytest.mark.parametrize("cells", [forest.CELLS, 18])
def test_counts_equal_a_loop_over_rows(counted, monkeypatch, cells):
    monkeypatch.setattr(forest, "CELLS", cells)  # few cells: nodes are counted in parts
    block, level, layout, node, weight, state = counted
    halves = [(i, block[:, part], state[:, part]) for i, part in enumerate((slice(300), slice(300, None)))]
    (tree, (totals, with_category, by_bin)), = forest._counted(halves, [level], layout, 9)
    wanted, cells = naive_counts(block, weight, node, level, layout)
    assert tree == 0 and (totals == wanted).all()
    numbers = [(n, s) for n in range(level.nodes) for s in level.chosen[n] if s < 3]
    categories = [(n, s) for n in range(level.nodes) for s in level.chosen[n] if s >= 3]
    by_bin = by_bin.reshape(len(numbers), layout.bins, 3)
    for i, (n, s) in enumerate(numbers):
        assert by_bin[i].tolist() == [
            [cells.get((n, s, b, c), 0) for c in range(3)] for b in range(layout.bins)]
    for i, (n, s) in enumerate(categories):
        assert with_category[i].tolist() == [cells.get((n, s, 0, c), 0) for c in range(3)]


def test_the_best_split_is_that_of_a_search(counted):
    block, level, layout, node, weight, state = counted
    (_, counts), = forest._counted([(0, block, state)], [level], layout, 9)
    found = forest.best_splits(counts, level, layout, 1, 0.0)

    def gini(label, w):
        share = np.bincount(label, w, 3) / max(w.sum(), 1)
        return 1 - (share ** 2).sum()

    for n in range(level.nodes):
        here = (node == n) & (weight > 0)
        label, w, gains = block[-2][here], weight[here], {}
        for slot in level.chosen[n]:
            (column,), (category,) = layout.place(np.array([slot]))
            bins = block[column][here]
            ways = {category: bins != category} if category >= 0 else {
                t: bins <= t for t in range(len(layout.thresholds[slot]))}
            for at, left in ways.items():
                if w[left].sum() and w[~left].sum():
                    parts = w[left].sum() * gini(label[left], w[left]) + w[~left].sum() * gini(
                        label[~left], w[~left])
                    gains[slot, at] = gini(label, w) - parts / w.sum(), left
        best = max(gains, key=lambda k: gains[k][0])
        assert (found.slot[n], found.at[n]) == best
        assert found.gain[n] == pytest.approx(gains[best][0])
        left = gains[best][1]
        assert found.left[n].tolist() == np.bincount(label[left], w[left], 3).tolist()


def test_rows_go_where_the_splits_say(counted):
    block, level, layout, node, weight, state = counted
    (_, counts), = forest._counted([(0, block, state)], [level], layout, 9)
    found = forest.best_splits(counts, level, layout, 1, 0.0)
    tree = forest.Tree(layout.classes)
    tree.counts, tree.active = np.zeros((5, 3)), np.arange(5)
    tree.slot, tree.at, tree.child = np.full(5, -1), np.zeros(5, int), np.full(5, -1)
    tree.gain = np.zeros(5)
    _, _, moved = forest._routed((0, block, state), [tree.split(found, layout, False)], 9)
    for r in np.flatnonzero(weight):
        (column,), (category,) = layout.place(found.slot[node[r]:node[r] + 1])
        at, value = found.at[node[r]], block[column, r]
        right = value == category if category >= 0 else value > at
        child = tree.child[node[r]] + right
        if child in tree.active:
            assert moved[0, r] >> 9 == weight[r] and tree.active[moved[0, r] & 511] == child
        else:
            assert moved[0, r] == 0 and (tree.counts[child] > 0).sum() == 1
    assert not moved[0, weight == 0].any()


def test_bags_are_poisson_draws():
    copies = np.repeat([1, 2, 9, forest.COPIES], 40_000).astype(np.uint8)
    drawn = forest.bag(copies, 1.0, [42, 0, 3, 7])
    assert (drawn == forest.bag(copies, 1.0, [42, 0, 3, 7])).all()
    assert (drawn != forest.bag(copies, 1.0, [42, 0, 4, 7])).any()
    for k in np.unique(copies):
        part = drawn[copies == k].astype(float)
        assert part.mean() == pytest.approx(k, rel=0.03) and part.var() == pytest.approx(k, rel=0.06)
    assert (drawn[copies == 1] == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)


def test_thresholds():
    assert forest.thresholds(np.array([3.0, 1, 1, 7]), np.ones(4), 31).tolist() == [2.0, 5.0]
    assert forest.thresholds(np.ones(9), np.ones(9), 31).tolist() == []
    assert len(forest.thresholds(np.arange(5000.0), np.ones(5000), 31)) == 31
    # the weight of a value counts as often as its copies
    assert forest.thresholds(np.arange(4.0), np.array([1, 1, 1, 9]), 1).tolist() == [2.5]


def test_blocks_hold_a_byte_for_each_column_and_many_copies_in_parts(spark):
    rows = spark.createDataFrame(
        [(1.0, 0, 1, 1), (2.5, 1, 0, 40), (9.0, 2, 2, 16)], "x double, c int, label int, copies int")
    layout = forest.Layout([np.array([2.0, 3.0])], [3], 3)
    found = forest.cut_blocks(rows.coalesce(1), layout, 1000).collect()
    cells = np.frombuffer(found[0].cells, layout.kind).reshape(-1, found[0].n)
    assert len(found) == 1 and layout.kind.itemsize == 1
    assert cells.tolist() == [
        [0, 1, 1, 1, 2], [0, 1, 1, 1, 2], [1, 0, 0, 0, 2], [1, 16, 16, 8, 16]]


def test_a_grown_forest_is_as_good_as_that_of_spark(spark):
    rows = flights_with_a_rule(spark, 12_000).repartition(3).localCheckpoint()
    pipeline = ml.build_pipeline("forest", {"numTrees": 25, "maxDepth": 6})
    plain = pipeline.fit(rows)
    *_, classifier = pipeline.getStages()
    drawn = plain.stages[0].transform(rows).withColumn("copies", F.lit(1))
    sizes = dict(zip(SLOTS, plain.stages[1].categorySizes))
    model = forest.grow(classifier, drawn, ml.NUMERIC, sizes, "copies")
    grown = ml.PipelineModel([*plain.stages[:-1], model])
    a, b = model, plain.stages[-1]
    assert (a.getNumTrees, a.numClasses, a.numFeatures, a.getMaxDepth()) == (
        b.getNumTrees, b.numClasses, b.numFeatures, b.getMaxDepth())
    assert np.abs(a.featureImportances.toArray() - b.featureImportances.toArray()).max() < 0.1
    assert a.totalNumNodes == pytest.approx(b.totalNumNodes, rel=0.2)
    assert max(t.depth for t in a.trees) <= 6
    evaluator = MulticlassClassificationEvaluator(labelCol=ml.LABEL, metricName="accuracy")
    fresh = flights_with_a_rule(spark, 15_000).filter("pmod(xxhash64(DepHour, Distance, Month), 3) = 0")
    found, wanted = (evaluator.evaluate(m.transform(fresh)) for m in (grown, plain))
    assert wanted > 0.7 and found == pytest.approx(wanted, abs=0.04)


def test_a_large_forest_is_not_held_by_the_classifier_of_spark(spark, sf_dir, monkeypatch):
    def fit(*_):
        raise AssertionError("every copy would be held as a number for each slot and tree")

    monkeypatch.setattr(ml, "LARGE", 0)
    monkeypatch.setattr(RandomForestClassifier, "_fit", fit)
    held = set(spark.sparkContext._jsc.getPersistentRDDs())
    flights = train_flights(spark, sf_dir)
    run = ml.train(flights, "forest", {"numTrees": 23, "maxDepth": 4})  # more than one group
    model = run.model.stages[-1]
    assert (model.getNumTrees, model.numClasses, len(model.trees)) == (23, 4, 23)
    assert model.featureImportances.toArray().sum() == pytest.approx(1)
    found = {r.feature: r.importance for r in ml.feature_importance(run.model).collect()}
    assert sum(found.values()) == pytest.approx(1) and len(found) == 12
    scored = run.model.transform(run.test)
    assert scored.count() == run.test.count() > 0
    total = F.aggregate(ml.vector_to_array("probability"), F.lit(0.0), lambda x, y: x + y)
    assert scored.filter(F.abs(total - 1) > 1e-9).count() == 0
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= held  # blocks and states are let go


def test_drawn_rows_stand_for_the_copies(spark, sf_dir, monkeypatch):
    given = []
    monkeypatch.setattr(ml, "fit_drawn", lambda pipeline, drawn: given.append(drawn))
    ml.train(train_flights(spark, sf_dir), "forest")
    drawn, = given
    sizes = {r[0]: r[1] for r in drawn.groupBy(ml.LABEL).agg(F.sum(ml.DRAWS)).collect()}
    largest = max(sizes.values())
    assert all(n == pytest.approx(largest, rel=0.15) for n in sizes.values())
    assert drawn.count() == drawn.drop(ml.DRAWS).distinct().count()


def test_settings_that_only_spark_has():
    def classifier(**params):
        return ml.build_pipeline("forest", params).getStages()[-1]

    assert forest.can_grow(classifier())
    for params in ({"impurity": "entropy"}, {"bootstrap": False}, {"featureSubsetStrategy": "all"},
                   {"weightCol": "w"}):
        assert not forest.can_grow(classifier(**params))


def test_streamed_payloads_are_stored_compressed(spark, sf_dir, monkeypatch):
    run = ml.train(train_flights(spark, sf_dir), "forest", {"numTrees": 3, "maxDepth": 3})
    made, fresh = {}, catalog.fresh_folder
    monkeypatch.setattr(catalog, "_run", lambda *_: run)
    monkeypatch.setattr(catalog, "fresh_folder", lambda s, name: made.setdefault(name, fresh(s, name)))
    found = catalog.stream_score(spark, sf_dir)
    assert found.agg(F.sum("flights"), F.bool_and("as_batch")).first()[:] == (
        train_flights(spark, sf_dir).count(), True)
    files = list(Path(made["score-in"].removeprefix("file:")).glob("part-*"))
    assert files and all(f.name.endswith(".gz") for f in files)


def test_release_deletes_shuffle_files_of_written_tables(spark):
    folders = [Path(p) for p in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
               .blockManager().diskBlockManager().localDirsString()]

    def stored():
        return sum(f.stat().st_size for p in folders for f in p.glob("*/shuffle_*.data") if f.exists())

    release(spark)
    time.sleep(2)
    before = stored()
    rows = spark.range(300_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    written = materialize(rows.repartition(4, "x"), "shuffled")
    assert stored() > before + 10_000_000
    release(spark)
    for _ in range(50):
        if stored() < before + 1_000_000:
            break
        time.sleep(0.2)
    assert stored() < before + 1_000_000 and written.count() == 300_000

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from skyledger.functions.columns import CLASS_TEXT
from skyledger.operators import ml
from skyledger.plans import catalog
from skyledger.session import fresh_folder
from skyledger.sources.files import literal_flights
from skyledger.sources.schemas import TRAIN_SCHEMA
from skyledger.sources.star import labelled_predictions, train_flights

# one flight per delay class and an early one, the last with unseen carrier and airports
SAMPLE = [
    ("Brand#13", "AS12", "AS21", 6, 28, "4711", "0517", -7.0, 1183.0, "0744", 0, 0, "Domestic"),
    ("Brand#52", "EU19", "AF05", 11, 3, "86", "2341", 31.0, 2466.0, "0312", 0, 0, "International"),
    ("Brand#24", "AM03", "ME20", 9, 17, "3302", "1109", 78.0, 151.0, "1258", 1, 0, "International"),
    ("Brand#35", "AF16", "AF00", 2, 25, "909", "1826", 143.0, 905.0, "1950", 0, 0, "Domestic"),
    (None, "ZZ77", None, 12, 8, "17", None, None, None, "0702", 0, 0, None),
]


@pytest.fixture(scope="module")
def flights(spark, sf_dir):
    df = train_flights(spark, sf_dir).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def logistic(flights):
    return ml.train(flights, "logistic", {"maxIter": 8})


@pytest.fixture(scope="module")
def forest(flights):
    return ml.train(flights, "forest", {"numTrees": 4, "maxDepth": 4})


def test_preprocess_fills(spark):
    row = ml.preprocess(literal_flights(spark, SAMPLE[-1:]), with_label=True).first()
    assert (row.UniqueCarrier, row.Origin, row.Dest, row.RouteType) == (
        "UNKNOWN", "ZZ77", "UNKNOWN", "UNKNOWN")
    assert (row.Distance, row.DepHour, row.DepMinute, row.ArrHour, row.DelayCategory) == (
        0.0, 0, 0, 7, 0)


def test_split_keeps_every_row_once(flights):
    numbered = flights.withColumn("row", F.monotonically_increasing_id())
    first, second = ml.train_test_split(numbered)
    a = {r.row for r in first.select("row").collect()}
    b = {r.row for r in second.select("row").collect()}
    assert not a & b
    assert len(a) + len(b) == flights.count()
    assert abs(len(a) / (len(a) + len(b)) - 0.8) < 0.03
    assert {r.row for r in first.select("row").collect()} == a


def test_split_divides_copies_of_one_row_too(spark):
    first, second = ml.train_test_split(spark.range(2000).select(F.lit("same").alias("x")))
    assert abs(first.count() / 2000 - 0.8) < 0.05 and first.count() + second.count() == 2000


def test_oversample_matches_the_largest_class(spark):
    df = spark.range(12000).select(
        F.when(F.col("id") % 12 < 8, 0).when(F.col("id") % 12 < 11, 1).otherwise(3)
        .alias(ml.LABEL), "id")
    out = ml.oversample(df)
    sizes = {r[0]: r[1] for r in out.groupBy(ml.LABEL).count().collect()}
    assert sizes[0] == 8000 and 2 not in sizes
    assert sizes[1] == pytest.approx(8000, rel=0.1) and sizes[3] == pytest.approx(8000, rel=0.1)
    assert out.filter(f"{ml.LABEL} = 0").distinct().count() == 8000
    assert out.join(df, ["id", ml.LABEL], "left_anti").count() == 0


def test_a_rare_class_is_drawn_by_all_tasks(spark):
    df = spark.range(100_000).select(
        F.when(F.col("id") < 20, 3).otherwise(0).alias(ml.LABEL), "id").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        drawn = ml.oversample(df).filter(f"{ml.LABEL} = 3")
        sizes = [r[1] for r in drawn.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == pytest.approx(100_000, rel=0.1)
    assert len(sizes) == 16 and max(sizes) <= 2 * sum(sizes) / 16


def test_class_zero_is_never_resampled(spark):
    df = spark.createDataFrame([(0, 1), (1, 2), (1, 3), (1, 4)], f"{ml.LABEL} int, id int")
    assert ml.oversample(df).filter(f"{ml.LABEL} = 0").count() == 1


def test_metrics_equal_the_library_evaluator(spark, sf_dir):
    predictions = labelled_predictions(spark, sf_dir).withColumn(
        "label", F.col("label").cast("double"))
    row = ml.classification_metrics(predictions, "label").first()
    for metric, found in (("accuracy", row.accuracy), ("f1", row.f1_score)):
        evaluator = MulticlassClassificationEvaluator(
            labelCol="label", predictionCol="prediction", metricName=metric)
        assert found == pytest.approx(evaluator.evaluate(predictions), abs=1e-12)


def plain_vector(model, row):
    """The unscaled features of one preprocessed flight, by the documented rules."""
    out = [float(row[c]) for c in ml.NUMERIC]
    for name, labels in zip(ml.CATEGORICAL, model.stages[0].labelsArray):
        slots = [0.0] * (len(labels) + 1)
        slots[labels.index(row[name]) if row[name] in labels else len(labels)] = 1.0
        out += slots
    return out


def test_logistic_probabilities_against_plain_numpy(spark, logistic):
    sample = literal_flights(spark, SAMPLE)
    scaler, model = logistic.model.stages[3], logistic.model.stages[4]
    x = np.array([plain_vector(logistic.model, r) for r in ml.preprocess(sample).collect()])
    scale = np.array(scaler.std.toArray())
    scaled = x * np.divide(1.0, scale, out=np.zeros_like(scale), where=scale != 0)
    margin = scaled @ model.coefficientMatrix.toArray().T + model.interceptVector.toArray()
    wanted = np.exp(margin - margin.max(axis=1, keepdims=True))
    wanted /= wanted.sum(axis=1, keepdims=True)
    found = ml.class_probabilities(sample, logistic.model).select("probability").collect()
    assert np.allclose([r.probability for r in found], wanted, atol=1e-9)
    predicted = ml.score(sample, logistic.model).select("prediction").collect()
    assert [r.prediction for r in predicted] == list(wanted.argmax(axis=1))


def test_scoring_a_literal_sample(spark, forest):
    rows = ml.score(
        literal_flights(spark, SAMPLE), forest.model, [*ml.RESULT_COLUMNS, "DepDelay"]).collect()
    assert len(rows) == 5
    assert all(r.DelayDescription == CLASS_TEXT[int(r.prediction)] for r in rows)


def test_rows_of_one_task_are_scored_by_all(spark, flights, forest):
    alone = flights.coalesce(1)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = forest.model.transform(ml.preprocess(alone))
    for scored in (ml.score(alone, forest.model), ml.class_probabilities(alone, forest.model)):
        tasks = scored.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len(tasks) == width and sum(r["count"] for r in tasks) == flights.count()
        names = [c for c in scored.columns if c in plain.columns and c != "probability"]
        assert scored.select(names).exceptAll(plain.select(names)).count() == 0


def test_train_settings(logistic, forest):
    model = logistic.model.stages[-1]
    assert model.numClasses == 4
    assert model.getOrDefault("elasticNetParam") == 0.3 and model.getOrDefault("regParam") == 0.01
    tree = forest.model.stages[-1]
    assert (tree.getNumTrees, tree.getMaxDepth(), tree.getMaxBins(), tree.getImpurity()) == (
        4, 4, 32, "gini")
    assert ml.build_pipeline("forest").getStages()[-1].getNumTrees() == 100
    with pytest.raises(ValueError, match="unknown"):
        ml.build_pipeline("svm")


def test_test_part_is_not_balanced(flights, forest):
    features = ml.preprocess(flights, with_label=True)
    whole = {r[0]: r[1] for r in features.groupBy(ml.LABEL).count().collect()}
    part = {r[0]: r[1] for r in forest.test.groupBy(ml.LABEL).count().collect()}
    assert all(part[c] == pytest.approx(0.2 * whole[c], rel=0.25) for c in whole)


def test_importances_carry_the_right_names(forest, flights):
    found = {r.feature: r.importance for r in ml.feature_importance(forest.model).collect()}
    assert sum(found.values()) == pytest.approx(1.0)
    assert list(found.values()) == sorted(found.values(), reverse=True)
    vectors = forest.model.transform(ml.preprocess(flights, with_label=True))
    weights = forest.model.stages[-1].featureImportances.toArray()
    groups = vectors.schema["features"].metadata["ml_attr"]["attrs"]
    by_name = dict.fromkeys(found, 0.0)
    for attribute in (a for group in groups.values() for a in group):
        name = attribute["name"]
        owner = name if name in by_name else name.split("Vec_")[0] + "Vec"
        by_name[owner] += weights[attribute["idx"]]
    assert found == pytest.approx(by_name)


def test_forest_probabilities_are_shares(forest, flights):
    scored = ml.class_probabilities(flights, forest.model)
    total = F.aggregate("probability", F.lit(0.0), lambda a, b: a + b)
    assert scored.filter((F.abs(total - 1) > 1e-9) | (F.size("probability") != 4)).count() == 0


def test_saved_run_scores_the_same(spark, forest):
    path = fresh_folder(spark, "run")
    assert ml.load_run(spark, path) is None
    ml.save_run(forest, path)
    loaded = ml.load_run(spark, path)
    assert loaded.test.count() == forest.test.count()
    sample = literal_flights(spark, SAMPLE)
    assert ml.score(sample, loaded.model).collect() == ml.score(sample, forest.model).collect()


def test_metadata(spark, forest, logistic):
    metrics = ml.classification_metrics(forest.model.transform(forest.test))
    record = ml.model_metadata(forest.model, metrics)
    path = fresh_folder(spark, "metadata")
    ml.write_metadata(record, path)
    row = spark.read.schema(record.schema).json(path).first()
    assert row.metrics.accuracy == metrics.first().accuracy
    assert row.features.categorical == ml.CATEGORICAL and row.features.numeric == ml.NUMERIC
    assert (row.model_params.numTrees, row.model_params.maxDepth) == (4, 4)
    assert len(row.training_date) == 19
    assert ml.model_metadata(logistic.model, metrics).first().model_params is None


def test_the_test_part_is_scored_once(spark, forest):
    scored = catalog._scored_test(forest)
    assert scored.inputFiles() and scored.columns == [ml.LABEL, "prediction"]
    plain = forest.model.transform(forest.test).select(*scored.columns)
    assert scored.exceptAll(plain).count() == plain.exceptAll(scored).count() == 0
    assert "UDF" not in scored._jdf.queryExecution().optimizedPlan().toString()


def test_confusion_matrix_adds_up(forest):
    scored = forest.model.transform(forest.test)
    matrix = ml.confusion_matrix(scored).collect()
    assert sum(r["count"] for r in matrix) == forest.test.count()
    assert [(r[0], r[1]) for r in matrix] == sorted((r[0], r[1]) for r in matrix)


def test_schema_is_the_training_schema(flights):
    assert flights.columns == TRAIN_SCHEMA.fieldNames()
    assert [f.dataType for f in flights.schema] == [f.dataType for f in TRAIN_SCHEMA]


def test_class_weights_balance_without_copies(spark):
    rows = [(0,)] * 6 + [(1,)] * 3 + [(3,)]
    df = spark.createDataFrame(rows, f"{ml.LABEL} int")
    found = ml.class_weights(df)
    assert found.count() == 10
    sums = {r[ml.LABEL]: r["w"] for r in found.groupBy(ml.LABEL).agg(
        F.sum(ml.WEIGHT).alias("w")).collect()}
    assert sums == pytest.approx({0: 6.0, 1: 6.0, 3: 6.0})
    assert ml.class_weights(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["logistic", "forest"])
def test_training_by_weights(spark, sf_dir, kind):
    flights = train_flights(spark, sf_dir)
    params = {"maxIter": 3} if kind == "logistic" else {"numTrees": 2, "maxDepth": 2}
    run = ml.train(flights, kind, params, balance="weights")
    assert run.model.stages[-1].getOrDefault("weightCol") == ml.WEIGHT
    scored = run.model.transform(run.test)
    assert scored.count() == run.test.count() > 0
    # without balance a weak model would give the largest class only
    assert scored.select("prediction").distinct().count() > 1


def test_unknown_balance(spark, sf_dir):
    with pytest.raises(ValueError, match="unknown balance"):
        ml.train(train_flights(spark, sf_dir), "forest", balance="magic")


def test_slots_as_numbers_give_the_same_forest(spark):
    """20,000 rows, so thresholds are sought in a part of them; one category is rare."""
    rows = spark.range(20_000).select(
        (F.col("id") * 7 % 11 % 4).cast("int").alias(ml.LABEL),
        *(((F.col("id") * (3 + i)) % (5 + i)).cast("int").alias(c) for i, c in enumerate(ml.NUMERIC)),
        F.concat(F.lit("A"), F.col("id") % 11).alias("UniqueCarrier"),
        F.when(F.col("id") == 77, "rare").otherwise(F.concat(F.lit("B"), F.col("id") % 5)).alias("Origin"),
        F.concat(F.lit("C"), F.col("id") % 7).alias("Dest"), F.lit("same").alias("RouteType"))
    rows = rows.repartition(3, "Month").sortWithinPartitions(*rows.columns).localCheckpoint()
    pipeline = ml.build_pipeline("forest", {"numTrees": 5, "maxDepth": 6})
    fast, plain = ml.fit(pipeline, rows), pipeline.fit(rows)
    a, b = fast.stages[-1], plain.stages[-1]
    assert a.totalNumNodes == b.totalNumNodes > 50
    assert a.featureImportances == b.featureImportances
    assert [r[0] for r in fast.transform(rows).select("probability").collect()] == [
        r[0] for r in plain.transform(rows).select("probability").collect()]


def test_only_slots_that_the_drawn_rows_show_become_numbers(spark):
    rows = spark.range(20_000).select(
        *(F.lit(1).alias(c) for c in ml.NUMERIC),
        F.when(F.col("id") < 30, "rare").otherwise(F.concat(F.lit("A"), F.col("id") % 3))
        .alias("UniqueCarrier"),
        F.when(F.col("id") < 30, "few").otherwise("most").alias("Origin"),
        F.lit("x").alias("Dest"), F.lit("y").alias("RouteType"))
    vectors = ml.Pipeline(stages=ml.feature_stages("features")).fit(rows).transform(rows)
    groups = ml.numeric_slots(vectors).schema["features"].metadata["ml_attr"]["attrs"]
    assert [slot["name"] for slot in groups["binary"]] == [
        "UniqueCarrierVec_rare", "OriginVec_most", "OriginVec_few"]
    assert len(groups["numeric"]) == vectors.first().features.size - 3
    few = vectors.where(vectors["Origin"] == "few")  # all rows are looked at
    assert "binary" not in ml.numeric_slots(few).schema["features"].metadata["ml_attr"]["attrs"]

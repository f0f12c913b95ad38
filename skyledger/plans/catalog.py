"""Every operator as a named query over the star-schema tables in a folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.functions import columns as rules
from skyledger.operators import cleaning, graph, landing, ml, reports
from skyledger.plans import incremental
from skyledger.plans.timing import REPORT_INPUT, report_row_counts
from skyledger.session import application_folder, fresh_folder, materialize, release
from skyledger.sources import files, kafka, sinks, star
from skyledger.sources.schemas import RAW_COLUMNS, STREAM_SCHEMA, TRAIN_SCHEMA
from skyledger.streaming import scorer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = dict(incremental.QUERIES)

KEYS = ["ok", "pk", "sk", "ln"]
STREAM_COLUMNS = STREAM_SCHEMA.fieldNames()


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def cleaned(spark: SparkSession, sf: str, columns: list[str]) -> DataFrame:
    return cleaning.clean_flights(star.raw_flights(spark, sf, columns))


def as_text(df: DataFrame, column: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """A timestamp as text, so that a result does not depend on a reader's zone."""
    return df.withColumn(column, F.date_format(column, pattern))


# Scans and sources

@query
def scan_csv_raw(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "raw-csv")
    flights = star.raw_flights(spark, sf)
    # other files have other orders and more columns
    flights.select(F.lit("x").alias("note"), *reversed(flights.columns), F.lit(1).alias("more")
                   ).write.option("header", True).csv(path)
    return files.read_flights_csv(spark, path)


@query
def scan_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "inferred-csv")
    star.raw_flights(spark, sf).write.option("header", True).csv(path)
    return files.read_flights_csv_inferred(spark, path)


@query
def scan_csv_schema(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "training-csv")
    star.train_flights(spark, sf).write.option("header", True).csv(path)
    return files.read_training_csv(spark, path, header=True)


@query
def scan_flight_json(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "payloads")
    star.flight_payloads(spark, sf).select("value").write.text(path)
    return files.read_flight_json(spark, path)


@query
def kafka_record_view(spark: SparkSession, sf: str) -> DataFrame:
    return as_text(
        kafka.kafka_record_view(star.kafka_records(spark, sf)), "timestamp",
        "yyyy-MM-dd HH:mm:ss.SSS")


@query
def message_source(spark: SparkSession, sf: str) -> DataFrame:
    return files.messages(star.table(spark, sf, "events"), "event_id")


# Sinks

@query
def write_report_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "report")
    report = reports.delay_severity_analysis(
        cleaned(spark, sf, reports.REPORT_COLUMNS["delay_severity_analysis"]))
    sinks.write_report(report, "delay_severity_analysis", options={"path": path})
    return spark.read.parquet(path)


@query
def export_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "export")
    flights, _ = landing.normalize_flights(star.flight_payloads(spark, sf))
    sinks.export_csv(flights, path)
    return files.read_training_csv(spark, path, header=True)


@query
def land_raw(spark: SparkSession, sf: str) -> DataFrame:
    source, target = fresh_folder(spark, "upload"), fresh_folder(spark, "lake")
    star.raw_flights(spark, sf).write.option("header", True).csv(source)
    sinks.land_raw(spark, source, target)
    return spark.read.parquet(target)


@query
def to_kafka_json(spark: SparkSession, sf: str) -> DataFrame:
    flights, _ = landing.normalize_flights(star.flight_payloads(spark, sf), with_delay=False)
    return kafka.to_kafka_json(flights)


# Projection, filter, conditional columns, null handling

@query
def prune_airport(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.prune(
        cleaned(spark, sf, reports.AIRPORT_COLUMNS), reports.AIRPORT_COLUMNS)


@query
def clean_flights(spark: SparkSession, sf: str) -> DataFrame:
    return as_text(cleaned(spark, sf, RAW_COLUMNS), "FL_DATE")


@query
def dep_hour(spark: SparkSession, sf: str) -> DataFrame:
    return star.raw_flights(spark, sf, ["DEP_TIME"]).select(
        "DEP_TIME", rules.dep_hour("DEP_TIME").alias("DEP_HOUR"))


@query
def fill_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.fill_report_numbers(
        cleaned(spark, sf, [*cleaning.REPORT_FILLED, "TAXI_IN", "TAXI_OUT"]))


@query
def fill_all_numeric(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["OP_CARRIER", "ORIGIN", "DEP_DELAY", "ARR_DELAY", "AIR_TIME", "TAXI_IN"]
    return cleaning.fill_all_numbers(cleaned(spark, sf, columns))


@query
def fill_strings(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.fill_text(
        star.train_flights(spark, sf, ml.CATEGORICAL, keep=KEYS), ml.CATEGORICAL)


@query
def filter_class(spark: SparkSession, sf: str) -> DataFrame:
    flights = star.train_flights(spark, sf, ["DepDelay"], keep=KEYS)
    return cleaning.of_class(
        flights.withColumn(ml.LABEL, rules.delay_class("DepDelay")), ml.LABEL, 2)


@query
def distance_band(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf, ["DISTANCE"]).select(
        "DISTANCE", rules.distance_band("DISTANCE").alias("DISTANCE_CATEGORY"))


@query
def delay_severity_label(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf, ["CANCELLED", "DIVERTED", "ARR_DELAY"]).select(
        "*", rules.delay_severity("CANCELLED", "DIVERTED", "ARR_DELAY").alias("DELAY_CATEGORY"))


@query
def delay_label(spark: SparkSession, sf: str) -> DataFrame:
    return star.train_flights(spark, sf, ["DepDelay"], keep=KEYS).withColumn(
        ml.LABEL, rules.delay_class("DepDelay"))


@query
def describe_prediction(spark: SparkSession, sf: str) -> DataFrame:
    return star.labelled_predictions(spark, sf).withColumn(
        "DelayDescription", rules.describe_prediction("prediction"))


# Reports

def _report(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return reports.REPORTS[name](cleaned(spark, sf, reports.REPORT_COLUMNS[name]))
    return run


for _name in reports.REPORTS:
    QUERIES[_name] = _report(_name)


@query
def airport_metrics_join(spark: SparkSession, sf: str) -> DataFrame:
    # three aggregates read the flights, so the joins behind them are run once and written
    flights = materialize(cleaned(spark, sf, reports.AIRPORT_COLUMNS), "airport-flights")
    return reports.airport_metrics_join(flights)


@query
def top_airports(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_airports(cleaned(spark, sf, reports.AIRPORT_COLUMNS))


QUERIES["report_row_counts"] = lambda spark, sf: report_row_counts(
    star.raw_flights(spark, sf, sorted(REPORT_INPUT)))


@query
def repartition_stable(spark: SparkSession, sf: str) -> DataFrame:
    """One report over two forced partitionings of the flights."""
    flights = cleaned(spark, sf, ["OP_CARRIER", "ARR_DELAY"])
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = None
    for label, partitions in (("shuffle width", width), ("twice the width", 2 * width)):
        counted = flights.repartition(partitions).groupBy("OP_CARRIER").agg(
            F.count("*").alias("total_flights"), reports.mean("ARR_DELAY").alias("avg_arrival_delay"))
        counted = counted.select(F.lit(label).alias("partitions"), "*")
        out = counted if out is None else out.unionAll(counted)
    return out


@query
def aggregate_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Every aggregate function; the distinct count and the percentile run over small grains."""
    flights = materialize(
        cleaned(spark, sf, ["OP_CARRIER", "ORIGIN", "ARR_DELAY", "DISTANCE"]), "measures")
    late, carrier = F.col("ARR_DELAY"), Window.partitionBy("OP_CARRIER")
    plain = flights.groupBy("OP_CARRIER").agg(
        F.count("*").alias("flights"),
        reports.mean("DISTANCE").alias("mean_distance"),
        F.sum(reports.indicator(late > 15)).alias("late_flights"),
        F.max(late).alias("worst"),
        F.round(F.stddev(late), 2).alias("spread"))
    origins = flights.select("OP_CARRIER", "ORIGIN").distinct().groupBy("OP_CARRIER").agg(
        F.count("ORIGIN").alias("origins"))
    delays = flights.where(late.isNotNull()).groupBy("OP_CARRIER", "ARR_DELAY").agg(
        F.count("*").alias("n")).select(
        "OP_CARRIER", "ARR_DELAY", F.sum("n").over(carrier.orderBy("ARR_DELAY")).alias("upto"),
        F.sum("n").over(carrier).alias("all"))
    high = delays.where(F.col("upto") * 100 >= F.col("all") * 95).groupBy("OP_CARRIER").agg(
        F.min("ARR_DELAY").alias("p95"))
    return plain.join(origins, "OP_CARRIER").join(high, "OP_CARRIER", "left")


# Set operations

@query
def distinct_airports(spark: SparkSession, sf: str) -> DataFrame:
    return star.raw_flights(spark, sf, ["ORIGIN"]).distinct()


@query
def union_classes(spark: SparkSession, sf: str) -> DataFrame:
    flights = star.train_flights(spark, sf, ["DepDelay"], keep=KEYS).withColumn(
        ml.LABEL, rules.delay_class("DepDelay"))
    by_class = materialize(flights, "classes", [ml.LABEL])
    return ml.union_classes(by_class, ml.LABEL, [0, 1, 2, 3])


# Scalar functions

@query
def cast_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return star.raw_flights(spark, sf, ["FL_DATE", "DISTANCE", "CANCELLED", "DEP_TIME"]).select(
        "*",
        F.col("FL_DATE").try_cast("double").alias("date_number"),
        rules.to_double("DISTANCE").alias("miles"),
        rules.to_double("CANCELLED").alias("cancelled_number"),
        F.col("DEP_TIME").try_cast("int").alias("dep_number"))


@query
def parse_date(spark: SparkSession, sf: str) -> DataFrame:
    flights = star.raw_flights(spark, sf, ["FL_DATE"])
    return as_text(
        flights.withColumn("flown", F.try_to_timestamp(F.col("FL_DATE"))), "flown")


@query
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf, ["FL_DATE"]).select(
        F.month("FL_DATE").alias("MONTH"), F.dayofweek("FL_DATE").alias("DAY_OF_WEEK"),
        F.dayofmonth("FL_DATE").alias("DAY"))


@query
def round_half_up(spark: SparkSession, sf: str) -> DataFrame:
    return star.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.round("l_extendedprice", 1).alias("one_place"),
        F.round(F.col("l_quantity") / 8, 2).alias("eighths"))


@query
def hhmm_parts(spark: SparkSession, sf: str) -> DataFrame:
    return star.train_flights(spark, sf, ["CRSDepTime", "CRSArrTime"]).select(
        "*",
        rules.hhmm_hour("CRSDepTime").alias("DepHour"),
        rules.hhmm_minute("CRSDepTime").alias("DepMinute"),
        rules.hhmm_hour("CRSArrTime").alias("ArrHour"),
        rules.hhmm_minute("CRSArrTime").alias("ArrMinute"))


# Landed payloads

@query
def normalize_flights(spark: SparkSession, sf: str) -> DataFrame:
    return landing.normalize_flights(star.flight_payloads(spark, sf))[0]


@query
def normalize_flights_stream(spark: SparkSession, sf: str) -> DataFrame:
    return landing.normalize_flights(star.flight_payloads(spark, sf), with_delay=False)[0]


@query
def rejected_flights(spark: SparkSession, sf: str) -> DataFrame:
    payloads = star.flight_payloads(spark, sf).select("event_id", "value")
    return landing.normalize_flights(payloads)[1]


@query
def flights_in_window(spark: SparkSession, sf: str) -> DataFrame:
    # begin lies more than a week before the end, and the end after now
    payloads = star.flight_payloads(spark, sf).select("event_id", "value")
    return landing.flights_in_window(
        payloads, begin=1704067200, end=1705999999, now=1704800000)


@query
def parse_flight_json(spark: SparkSession, sf: str) -> DataFrame:
    flights = star.train_flights(spark, sf, STREAM_COLUMNS)
    return scorer.parse_flights(kafka.to_kafka_json(flights))


# Graph

@query
def graph_vertices(spark: SparkSession, sf: str) -> DataFrame:
    return graph.flight_vertices(star.raw_flights(spark, sf, ["ORIGIN", "DEST"]))


@query
def graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.flight_edges(star.raw_flights(spark, sf, [
        "ORIGIN", "DEST", "DISTANCE", "DEP_DELAY", "ARR_DELAY", "OP_CARRIER", "CANCELLED",
        "DIVERTED"]))


@query
def graph_counts(spark: SparkSession, sf: str) -> DataFrame:
    return graph.graph_counts(star.raw_flights(spark, sf, ["ORIGIN", "DEST"]))


def _ranks(spark: SparkSession, sf: str) -> DataFrame:
    flights = star.raw_flights(spark, sf, ["ORIGIN", "DEST"])
    return graph.pagerank(
        flights.select(F.col("ORIGIN").alias("src"), F.col("DEST").alias("dst")))


@query
def airport_pagerank(spark: SparkSession, sf: str) -> DataFrame:
    return _ranks(spark, sf).select("id", F.round("pagerank", 6).alias("pagerank"))


@query
def top_pagerank(spark: SparkSession, sf: str) -> DataFrame:
    ranks = _ranks(spark, sf).select("id", F.round("pagerank", 6).alias("pagerank"))
    return graph.top_airports_by_rank(ranks)


# Models

TRAINING_INPUT = [c for c in TRAIN_SCHEMA.fieldNames() if c not in ("FlightNum", "Cancelled")]


def _training_flights(spark: SparkSession, sf: str) -> DataFrame:
    return star.train_flights(spark, sf, TRAINING_INPUT)


def _features(spark: SparkSession, sf: str, keep: Sequence[str] = ()) -> DataFrame:
    flights = star.train_flights(spark, sf, TRAINING_INPUT, keep=keep)
    return ml.preprocess(flights, with_label=True)


def _run(spark: SparkSession, sf: str, kind: str) -> ml.Trained:
    """Trained once per application and folder, then loaded by every query that needs it."""
    name = hashlib.sha256(sf.encode()).hexdigest()[:16]
    path = application_folder(spark, f"run-{kind}-{name}")
    stored = ml.load_run(spark, path)
    if stored is None:
        ml.save_run(ml.train(_training_flights(spark, sf), kind), path)
        stored = ml.load_run(spark, path)
    return stored


def _scored_test(run: ml.Trained) -> DataFrame:
    """True and predicted class of the test part, written, so that it is scored once."""
    scored = run.model.transform(ml.spread(run.test, run.model))
    return materialize(scored.select(ml.LABEL, "prediction"), "scored")


def _test_metrics(run: ml.Trained) -> DataFrame:
    return ml.classification_metrics(_scored_test(run))


def _fit_summary(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """What holds of a trained classifier whatever its weights are.

    rows: flights it was split from; test_share_as_wanted: a fifth is the test part, within 2
    points; accuracy_as_counted and f1_as_counted: the metrics follow from the confusion counts.
    """
    run = _run(spark, sf, kind)
    scored = _scored_test(run)
    cells = ml.confusion_matrix(scored).withColumnsRenamed({ml.LABEL: "t", "prediction": "p"})
    n, label = F.col("count"), Window.partitionBy("t")
    sides = cells.select(
        "*", F.sum(n).over(label).alias("actual"),
        F.sum(n).over(Window.partitionBy("p")).alias("guessed"))
    hits = F.when(F.col("t") == F.col("p"), n).otherwise(0)
    counted = sides.agg(
        F.sum(n).alias("test"), (F.sum(hits) / F.sum(n)).alias("a"),
        (F.sum(2 * hits * F.col("actual") / (F.col("actual") + F.col("guessed"))) / F.sum(n))
        .alias("f"))
    whole = star.table(spark, sf, "lineitem").agg(F.count("*").alias("rows"))
    # three rows with different columns become one
    parts = whole.unionByName(counted, True).unionByName(ml.classification_metrics(scored), True)
    return parts.agg(*(F.max(c).alias(c) for c in parts.columns)).select(
        "rows", (F.abs(F.col("test") / F.col("rows") - 0.2) < 0.02).alias("test_share_as_wanted"),
        (F.abs(F.col("accuracy") - F.col("a")) < 1e-9).alias("accuracy_as_counted"),
        (F.abs(F.col("f1_score") - F.col("f")) < 1e-9).alias("f1_as_counted"))


@query
def ml_features(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf, keep=KEYS)


@query
def stream_preprocess(spark: SparkSession, sf: str) -> DataFrame:
    source, target = fresh_folder(spark, "stream-in"), fresh_folder(spark, "stream-out")
    kafka.to_kafka_json(star.train_flights(spark, sf, STREAM_COLUMNS)).write.text(source)
    done = scorer.preprocess_stream(scorer.json_stream(spark, source))
    scorer.run_query(scorer.file_sink(done, target, fresh_folder(spark, "stream-checkpoint")))
    return spark.read.schema(done.schema).parquet(target)


@query
def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    flights = star.train_flights(spark, sf, ["DepDelay"])
    return ml.class_distribution(
        flights.select(rules.delay_class("DepDelay").alias(ml.LABEL)))


@query
def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    flights = star.train_flights(spark, sf, ["DepDelay"])
    return ml.class_counts(flights.select(rules.delay_class("DepDelay").alias(ml.LABEL)))


@query
def oversample_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Class sizes before balancing, whether each then lies within 10 % of the largest, and
    whether no task holds more than twice its share of a drawn class."""
    flights = star.train_flights(spark, sf, ["DepDelay"])
    labelled = materialize(
        flights.withColumn(ml.LABEL, rules.delay_class("DepDelay")), "classes", [ml.LABEL])
    before = ml.class_counts(labelled)
    parts = ml.oversample(labelled).groupBy(
        ml.LABEL, F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
    after = parts.groupBy(ml.LABEL).agg(
        F.sum("n").alias("after"), (F.max("n") <= 2 * F.avg("n")).alias("even"))
    near = F.abs(F.col("after") / F.col("largest") - 1) < 0.1
    same, drawn = F.col("after") == F.col("count"), F.col(ml.LABEL) > 0
    return before.join(after, ml.LABEL).select(
        ml.LABEL, "count", "largest", F.when(drawn, near).otherwise(same).alias("as_wanted"),
        F.when(drawn, F.col("even")).otherwise(True).alias("spread_as_wanted"))


@query
def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of both parts together, and whether the first holds 80 % within 2 points."""
    flights = star.train_flights(spark, sf, ["DepDelay"], keep=KEYS)
    training, test = ml.train_test_split(flights)
    tagged = training.select(F.lit(1).alias("part")).unionAll(test.select(F.lit(0).alias("part")))
    return tagged.agg(
        F.count("*").alias("rows"),
        (F.abs(F.avg("part") - 0.8) < 0.02).alias("share_as_wanted"))


@query
def string_index(spark: SparkSession, sf: str) -> DataFrame:
    flights = materialize(_features(spark, sf).select(*ml.CATEGORICAL), "categories")
    return ml.indexers().fit(flights).transform(flights)


@query
def ml_vector(spark: SparkSession, sf: str) -> DataFrame:
    """Per flight: length of the vector, its numeric slots, and the slot set for each category."""
    features = materialize(
        _features(spark, sf).select(*ml.NUMERIC, *ml.CATEGORICAL), "features")
    fitted = ml.Pipeline(stages=ml.feature_stages("features")).fit(features)
    numbers = len(ml.NUMERIC)
    out = [F.size("slots").alias("length")]
    out += [F.element_at("slots", i + 1).alias(name) for i, name in enumerate(ml.NUMERIC)]
    for name, (start, size) in ml.feature_slots(fitted).items():
        if start >= numbers:
            part = F.slice("slots", start + 1, size)
            out.append((F.array_position(part, 1.0) - 1).alias(f"{name}Slot"))
    vectors = fitted.transform(features).select(vector_to_array("features").alias("slots"))
    return vectors.select(*out)


@query
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return ml.confusion_matrix(star.labelled_predictions(spark, sf), "label")


@query
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    found = ml.classification_metrics(star.labelled_predictions(spark, sf), "label")
    return found.select(
        F.round("accuracy", 6).alias("accuracy"), F.round("f1_score", 6).alias("f1_score"))


@query
def logistic_model(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_summary(spark, sf, "logistic")


@query
def random_forest_model(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_summary(spark, sf, "forest")


@query
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Whose importance is measured, and that all of them are shares of one."""
    found = ml.feature_importance(_run(spark, sf, "forest").model)
    total = F.sum("importance").over(Window.partitionBy())  # one row for each input column
    return found.select(
        "feature", F.col("importance").between(0, 1).alias("is_share"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


@query
def model_metadata(spark: SparkSession, sf: str) -> DataFrame:
    run = _run(spark, sf, "forest")
    path = fresh_folder(spark, "metadata")
    record = ml.model_metadata(run.model, _test_metrics(run))
    ml.write_metadata(record, path)
    stored = spark.read.schema(record.schema).json(path)
    return stored.select(
        F.array_join("features.categorical", ",").alias("categorical"),
        F.array_join("features.numeric", ",").alias("numeric"), "model_params.numTrees",
        "model_params.maxDepth", "model_params.featureSubsetStrategy", "model_params.impurity",
        (F.col("metrics.accuracy").between(0, 1) & F.col("metrics.f1_score").between(0, 1)).alias(
            "metrics_are_shares"),
        F.try_to_timestamp(F.col("training_date")).isNotNull().alias("dated"))


def _keyed_flights(spark: SparkSession, sf: str) -> DataFrame:
    return star.train_flights(spark, sf, TRAINING_INPUT, keep=KEYS)


@query
def ml_score_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Each flight, that its class is one of four, and that its text is that of the class."""
    scored = ml.score(_keyed_flights(spark, sf), _run(spark, sf, "forest").model, KEYS)
    fits = F.col("DelayDescription") == rules.describe_prediction("prediction")
    return scored.select(
        *KEYS, F.col("prediction").isin(0, 1, 2, 3).alias("known_class"), fits.alias("text_fits"))


@query
def ml_probabilities(spark: SparkSession, sf: str) -> DataFrame:
    """Each flight, its number of probabilities, that they sum to 1, and that the largest is
    that of the predicted class."""
    model = _run(spark, sf, "logistic").model
    shares = ml.class_probabilities(_keyed_flights(spark, sf), model, [*KEYS, "prediction"])
    total = F.aggregate("probability", F.lit(0.0), lambda a, b: a + b)
    best = F.get("probability", F.col("prediction").cast("int")) == F.array_max("probability")
    return shares.select(*KEYS, F.size("probability").alias("classes"),
                         (F.abs(total - 1) < 1e-9).alias("sums_to_one"), best.alias("best_is_predicted"))


@query
def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    """Streamed flights by what is shown of them, and whether their scores are the batch's."""
    source, target = fresh_folder(spark, "score-in"), fresh_folder(spark, "score-out")
    payloads = kafka.to_kafka_json(star.train_flights(spark, sf, STREAM_COLUMNS))
    payloads.write.text(source, compression="gzip")  # texts are a tenth of their size so
    release(spark)
    model = _run(spark, sf, "forest").model
    done = scorer.score_stream(scorer.json_stream(spark, source), model)
    scorer.run_query(scorer.file_sink(done, target, fresh_folder(spark, "score-checkpoint")))
    streamed = spark.read.schema(done.schema).parquet(target)
    batch = ml.score(star.train_flights(spark, sf, STREAM_COLUMNS), model)
    both = streamed.withColumn("n", F.lit(1)).unionAll(batch.withColumn("n", F.lit(-1)))
    pairs = both.groupBy(*streamed.columns).agg(
        F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).alias("streamed"),
        F.sum("n").alias("surplus"))
    return pairs.groupBy(*ml.RESULT_COLUMNS).agg(
        F.sum("streamed").alias("flights"), F.bool_and(F.col("surplus") == 0).alias("as_batch"))

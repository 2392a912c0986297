"""The registered queries: each runs one operator over the whole given tables.

Queries of sources, sinks and streams first land the flight records as files in
the shared folder, run to completion, and return a scan of what was written.
"""

from __future__ import annotations

import math

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.checks.fixtures import (
    LINE_ID, documents, flights_lines, flights_raw, flights_table, flights_typed, lines_of, table, typed_of,
)
from tarmac.checks.oracle import VOCABULARY_ROWS
from tarmac.contract import FLIGHTS
from tarmac.operators import clean, encoding, evaluate, sampling, statistics, vocabulary, words
from tarmac.operators.generations import GrowingVocabulary
from tarmac.plans import replay, training
from tarmac.plans.store import ModelStore, OneModel
from tarmac.session import exists, fresh_folder, materialize, publish_text
from tarmac.sources import files, headers, streams
from tarmac.streaming import commits, progress, scoring

ID = ("FLIGHT_ID",)


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_any_null(flights_typed(spark, sf), FLIGHTS.columns)


def _landed_csv(spark: SparkSession, sf: str) -> str:
    path = fresh_folder(spark, "csv")
    files.write_csv(flights_raw(spark, sf), path)
    return path


def landed_lines(spark: SparkSession, sf: str) -> str:
    path = fresh_folder(spark, "lines")
    flights_lines(spark, sf).write.text(path)
    return path


def _written(df: DataFrame, purpose: str, partition_by: tuple[str, ...] = (), fmt: str = "parquet") -> DataFrame:
    """Run a stream to its end into files and scan them."""
    spark = df.sparkSession
    path, checkpoint = fresh_folder(spark, purpose), fresh_folder(spark, f"{purpose}-checkpoint")
    streams.to_files(df, path, checkpoint, fmt=fmt, partition_by=partition_by).awaitTermination()
    return spark.read.schema(df.schema).format(fmt).load(path)


# Sources and sinks


def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_csv(spark, _landed_csv(spark, sf))


def scan_csv_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """The records in files of three headers: their columns in order, reversed, and with one more between."""
    path, raw = fresh_folder(spark, "mixed-csv"), flights_raw(spark, sf)
    middle = len(raw.columns) // 2
    more = [*raw.columns[:middle], F.lit("x").alias("REMARK"), *raw.columns[middle:]]
    for i, columns in enumerate((raw.columns, raw.columns[::-1], more)):
        files.write_csv(raw.where(F.col("FLIGHT_ID") % 3 == i).select(columns), f"{path}/{i}")
    return headers.read_csv_by_name(spark, path, raw.columns)


def scan_lines(spark: SparkSession, sf: str) -> DataFrame:
    return files.scan_lines(spark, _landed_csv(spark, sf))


def stream_source(spark: SparkSession, sf: str) -> DataFrame:
    return _written(streams.stream_text(spark, landed_lines(spark, sf)), "source")


def replay_sink(spark: SparkSession, sf: str) -> DataFrame:
    records = files.read_csv(spark, _landed_csv(spark, sf))
    path = fresh_folder(spark, "topic")
    files.to_lines(records).write.text(path)
    return spark.read.text(path)


def _ordered_csv(spark: SparkSession, sf: str) -> str:
    """The records as CSV files in the order of their ids, of the full width of a line."""
    path = fresh_folder(spark, "ordered-csv")
    files.write_csv(flights_table(spark, sf).orderBy(F.col("_c1").cast("bigint")), path)
    return path


def replay_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The lines in their order, a seventh of them per batch; the stream is stopped on its way and started again."""
    data = _ordered_csv(spark, sf)
    index, path, checkpoint = (fresh_folder(spark, p) for p in ("index", "replay", "replay-checkpoint"))
    per_batch = math.ceil(table(spark, sf, "orders").count() / 7)
    for stop_after in (3, None):
        lines = replay.replay_in_order(spark, data, index, per_batch, stride=1000)
        query = streams.to_files(lines, path, checkpoint, seconds=0)
        while stop_after and query.isActive and len(query.recentProgress) < stop_after:
            query.awaitTermination(0.1)
        query.stop() if stop_after else streams.drain(query)
    return spark.read.schema(lines.schema).parquet(path)


def replay_staged(spark: SparkSession, sf: str) -> DataFrame:
    """The lines cut into files, some files per batch; in no order over files."""
    path = fresh_folder(spark, "staged")
    rows = table(spark, sf, "orders").count()
    replay.stage(flights_lines(spark, sf), path, math.ceil(rows / 8))
    staged = len(spark.read.text(path).inputFiles())
    return _written(replay.replay(flights_lines(spark, sf), path, 1, math.ceil(staged / 4)), "replay", fmt="text")


def preview_top(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.preview_top(_clean(spark, sf), 100, "FLIGHT_ID")


# Projection, filter, parsing


def project_cast(spark: SparkSession, sf: str) -> DataFrame:
    return clean.project_cast(flights_raw(spark, sf), keep=ID)


def drop_any_null(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf)


def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = _clean(spark, sf)
    encoded = encoding.encode(rows, *vocabulary.to_indexers(vocabulary.fit_vocabulary(rows)))
    return clean.drop_columns(encoded, [FLIGHTS.label, *FLIGHTS.categorical])


def parse_lines(spark: SparkSession, sf: str) -> DataFrame:
    return clean.parse_lines(flights_lines(spark, sf), extra=LINE_ID)


def parse_wide_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a long quoted field, or with very many fields, behind those in use."""
    wide = F.when(F.crc32("value") % 2 == 0, F.concat(F.lit('"'), F.repeat(F.lit(","), 21_000), F.lit('"')))
    lines = flights_lines(spark, sf).withColumn("value", F.concat("value", F.lit(","), F.coalesce(wide, F.repeat(F.lit(","), 21_000))))
    return clean.parse_lines(lines, extra=LINE_ID)


def split_fields(spark: SparkSession, sf: str) -> DataFrame:
    return clean.split_fields(flights_lines(spark, sf), extra={"FLIGHT_ID": 1})


# Sampling and splitting


def sample_bernoulli(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_bernoulli(_clean(spark, sf), 0.3, seed=42)


def sample_bernoulli_check(spark: SparkSession, sf: str) -> DataFrame:
    """What is certain about a random sample: no foreign and no repeated row, about its share of the rows."""
    rows = _clean(spark, sf).select("FLIGHT_ID", F.lit(1).alias("source"), F.lit(0).alias("drawn"))
    sampled = sample_bernoulli(spark, sf).select("FLIGHT_ID", F.lit(0).alias("source"), F.lit(1).alias("drawn"))
    per_flight = rows.unionByName(sampled).groupBy("FLIGHT_ID")
    per_flight = per_flight.agg(F.sum("source").alias("source"), F.sum("drawn").alias("drawn"))
    return per_flight.agg(
        F.sum("source").alias("n_source"),
        F.count_if(F.col("source") == 0).alias("n_foreign"),
        F.count_if(F.col("drawn") > 1).alias("n_repeated"),
        F.abs(F.sum("drawn") / F.sum("source") - 0.3).between(0.0, 0.03).alias("share_holds"),
    )


def sample_hash(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_hash(_clean(spark, sf), 0.3, key="FLIGHT_ID")


def sample_hash_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """The share of rows without a text key that is kept, at several fractions."""
    rows = flights_typed(spark, sf).where("FLIGHT_ID % 2 = 0").withColumn("key", F.lit(None).cast("string"))
    counts = [F.lit(f).alias("fraction") for f in (0.1, 0.5, 0.9)]
    total = rows.count()
    shares = [
        sampling.sample_hash(rows, f, key="key").agg(F.count("*").alias("n"))
        .select(fraction, (F.abs(F.col("n") / total - f) <= 0.02 + 2 / math.sqrt(total)).alias("share_holds"))
        for f, fraction in zip((0.1, 0.5, 0.9), counts, strict=True)
    ]
    return shares[0].unionByName(shares[1]).unionByName(shares[2])


def _parts(first: DataFrame, second: DataFrame) -> DataFrame:
    return (
        first.select("FLIGHT_ID", F.lit("train").alias("part"))
        .unionByName(second.select("FLIGHT_ID", F.lit("test").alias("part")))
    )


def split_random(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(*sampling.split_random(_clean(spark, sf), 0.7, seed=42))


def split_random_cover(spark: SparkSession, sf: str) -> DataFrame:
    """In how many parts of the random split each flight is: one."""
    return split_random(spark, sf).groupBy("FLIGHT_ID").agg(F.count("*").alias("n_parts"))


def split_hash(spark: SparkSession, sf: str) -> DataFrame:
    rows = _clean(spark, sf)
    part = F.when(sampling.in_first_part(rows, 0.7, "FLIGHT_ID"), "train").otherwise("test")
    return rows.select("FLIGHT_ID", part.alias("part"))


# Vocabularies, encoding, vectors


def vocab_fit(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary.fit_vocabulary(_clean(spark, sf)).table


def vocab_fit_distributed(spark: SparkSession, sf: str) -> DataFrame:
    """The numbering for vocabularies of any size."""
    return vocabulary.fit_vocabulary(_clean(spark, sf), max_labels=0).table


def vocab_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    fitted = vocabulary.fit_vocabulary(_clean(spark, sf))
    path = fresh_folder(spark, "vocabulary")
    training.save_vocabularies(fitted, f"{path}/indexers")
    training.save_vocabulary_table(fitted, f"{path}/table")
    loaded = vocabulary.from_indexers(spark, training.load_vocabularies(f"{path}/indexers"))
    stored = training.load_vocabulary_table(spark, f"{path}/table")
    return stored.join(loaded.withColumnRenamed("idx", "loaded_idx"), ["field", "label"], "full")


def vocab_generations(spark: SparkSession, sf: str) -> DataFrame:
    """Five days added one after another and compacted on the way, then numbered."""
    store = GrowingVocabulary(spark, fresh_folder(spark, "generations"))
    rows = _clean(spark, sf)
    for day in range(5):
        store.add(rows.where(F.col("FLIGHT_ID") % 5 == day), f"day {day}", most=3)
    return store.fit().table


def hot_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels with more rows than a quarter of an eighth, and how many such shares they have, by the sketch."""
    found = encoding.hot_labels(_clean(spark, sf), FLIGHTS.categorical, 8)
    rows = [(field, label, shares) for field, labels in found.items() for label, shares in labels.items()]
    return spark.createDataFrame(rows, "field string, label string, shares int")


def label_statistics(spark: SparkSession, sf: str) -> DataFrame:
    fitted = statistics.fit_statistics(_clean(spark, sf), FLIGHTS.categorical)
    return fitted.table.where("fold = -1").select("field", "label", "n", "total")


def encode_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Airports as means over the flights of two carriers in three; unseen and null ones as the mean of all."""
    airports = ["DEPARTING_AIRPORT", "PREVIOUS_AIRPORT"]
    fitted = statistics.fit_statistics(_clean(spark, sf).where(VOCABULARY_ROWS), airports)
    found = statistics.with_statistics(_encode_inputs(spark, sf), fitted, max_labels=0)
    return found.select("FLIGHT_ID", *[F.round(FLIGHTS.index_columns[c], 9).alias(FLIGHTS.index_columns[c]) for c in airports])


def encode(spark: SparkSession, sf: str) -> DataFrame:
    rows = _clean(spark, sf)
    indexers = vocabulary.to_indexers(vocabulary.fit_vocabulary(rows))
    return encoding.encode(rows, *indexers).select("FLIGHT_ID", *FLIGHTS.indexes)


def _seen_part(spark: SparkSession, sf: str) -> vocabulary.Vocabulary:
    """A vocabulary that lacks some of the labels the flights have."""
    return vocabulary.fit_vocabulary(_clean(spark, sf).where(VOCABULARY_ROWS))


def _encode_inputs(spark: SparkSession, sf: str) -> DataFrame:
    return flights_typed(spark, sf).select(*ID, *FLIGHTS.inputs)


def encode_keep(spark: SparkSession, sf: str) -> DataFrame:
    indexers = vocabulary.to_indexers(_seen_part(spark, sf), handle_invalid="keep")
    return encoding.encode(_encode_inputs(spark, sf), *indexers)


def encode_join(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.encode_join(_encode_inputs(spark, sf), _seen_part(spark, sf))


def encode_join_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The lookup for vocabularies too large to broadcast."""
    return encoding.encode_join(_encode_inputs(spark, sf), _seen_part(spark, sf), max_labels=0)


def assemble(spark: SparkSession, sf: str) -> DataFrame:
    rows = _clean(spark, sf)
    indexers = vocabulary.to_indexers(vocabulary.fit_vocabulary(rows))
    return encoding.vector_slots(encoding.assemble(encoding.encode(rows, *indexers)), keep=ID)


# Counts, accuracy, words


def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.row_count(_clean(spark, sf))


def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    rule = F.when(F.col("AWND") > 200000, 1.0).otherwise(0.0)
    return evaluate.accuracy(_clean(spark, sf).withColumn("prediction", rule))


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return words.word_count(documents(spark, sf), "text")


def word_count_files(spark: SparkSession, sf: str) -> DataFrame:
    source, target = fresh_folder(spark, "texts"), fresh_folder(spark, "counts")
    documents(spark, sf).select("text").write.text(source)
    words.count_directory(spark, source, target)
    return words.read_counts(spark, target)


# Training and prediction


def _train(spark: SparkSession, sf: str, estimator=training.forest) -> training.Trained:
    return _train_on(flights_typed(spark, sf), estimator)


def _train_on(typed: DataFrame, estimator=training.forest) -> training.Trained:
    return training.train(typed, estimator, sample=1.0, key="FLIGHT_ID")


def trained_model(spark: SparkSession, sf: str) -> PipelineModel:
    return _train(spark, sf).pipeline


def _scores(predictions: DataFrame, *keep: str) -> DataFrame:
    chance = F.get(vector_to_array("probability"), F.lit(1)).alias("probability_late")
    return predictions.select("FLIGHT_ID", *keep, "prediction", chance)


def _metrics(spark: SparkSession, trained: training.Trained) -> DataFrame:
    return spark.createDataFrame([trained.metrics], "n bigint, n_correct bigint, accuracy double")


def rf_predict(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(_train(spark, sf).predictions(), FLIGHTS.label)


def _bounds(scored: DataFrame) -> DataFrame:
    """What is certain about scores: a label as the prediction, the likelier one, and a chance."""
    chance, prediction = F.col("probability_late"), F.col("prediction")
    sound = prediction.isin(0.0, 1.0) & chance.between(0, 1) & ((chance > 0.5) <= (prediction == 1))
    return scored.select("FLIGHT_ID", F.coalesce(sound, F.lit(False)).alias("sound"))


def rf_predict_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return _bounds(rf_predict(spark, sf))


def rf_train_eval(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, _train(spark, sf))


def _inputs_of(trained: training.Trained) -> DataFrame:
    """What is certain about the inputs of a trained model: the sizes of the parts and of the vocabulary."""
    return _parts(trained.train, trained.test).agg(
        F.count_if(F.col("part") == "train").alias("n_train"),
        F.count_if(F.col("part") == "test").alias("n_test"),
        F.lit(trained.vocabulary.largest()).cast("bigint").alias("largest_vocabulary"),
    )


def rf_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The label follows from the features, so a forest is nearly always right on held-out flights."""
    trained = _train(spark, sf)
    return _inputs_of(trained).withColumn("nearly_always_right", F.lit(trained.metrics["accuracy"] >= 0.99))


def lr_quality(spark: SparkSession, sf: str) -> DataFrame:
    """A maximum-likelihood fit has less log loss on its own flights than the best constant."""
    trained = _train(spark, sf, training.logistic)
    late, chance = F.col(FLIGHTS.label), F.col("probability_late")
    scored = _scores(trained.pipeline.transform(trained.train), FLIGHTS.label)
    of_label = F.when(late == 1, chance).otherwise(1 - chance)
    loss = F.avg(-F.log(F.greatest(of_label, F.lit(1e-15))))  # certain but wrong counts in full
    row = scored.agg(loss.alias("loss"), F.avg(late).alias("share")).first()
    entropy = -sum(p * math.log(p) for p in (row["share"], 1 - row["share"]))
    return _inputs_of(trained).withColumn("beats_constant", F.lit(row["loss"] < entropy))


def lr_train_eval(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, _train(spark, sf, training.logistic))


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each held-out flight gets the same prediction from the saved and loaded pipeline."""
    trained = _train(spark, sf)
    path = fresh_folder(spark, "model")
    training.save_pipeline(trained.pipeline, path)
    before = _scores(trained.predictions(), *FLIGHTS.inputs)
    before = before.withColumnsRenamed({"prediction": "before", "probability_late": "before_late"})
    after = _scores(training.load_pipeline(path).transform(before), "before", "before_late")
    same = (F.col("prediction") == F.col("before")) & (F.col("probability_late") == F.col("before_late"))
    return after.select("FLIGHT_ID", same.alias("same_prediction"))


def artefact_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """As ``model_roundtrip``, with vocabularies and statistics as tables that no driver holds."""
    rows, path = flights_typed(spark, sf), fresh_folder(spark, "artefact")
    trained = training.train(rows, training.logistic, sample=1.0, key="FLIGHT_ID", max_labels=0, statistics_above=20)
    training.save_vocabularies(trained.vocabulary, f"{path}/vocabularies", statistics=trained.statistics, max_labels=0)
    training.save_model(trained.model, f"{path}/classifier")
    before = _scores(trained.predictions(), *FLIGHTS.inputs)
    before = materialize(before.withColumnsRenamed({"prediction": "before", "probability_late": "before_late"}), "before")
    loaded = training.pipeline_of(f"{path}/vocabularies", f"{path}/classifier")
    after = _scores(loaded.transform(before), "before", "before_late")
    same = (F.col("prediction") == F.col("before")) & (F.col("probability_late") == F.col("before_late"))
    return after.select("FLIGHT_ID", same.alias("same_prediction"))


# Streams


def stream_parse_filter(spark: SparkSession, sf: str) -> DataFrame:
    lines = streams.stream_text(spark, landed_lines(spark, sf))
    return _written(scoring.parse_filter(lines, require_label=True, extra=LINE_ID), "parsed")


def stream_foreach_batch(spark: SparkSession, sf: str) -> DataFrame:
    rows = scoring.parse_filter(streams.stream_text(spark, landed_lines(spark, sf)), extra=LINE_ID)
    path, checkpoint = fresh_folder(spark, "batches"), fresh_folder(spark, "batches-checkpoint")
    scoring.each_batch(rows, scoring.write_batch(path), checkpoint).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs on one checkpoint, each after half of the lines has landed."""
    lines = flights_lines(spark, sf).withColumn("half", F.pmod(F.xxhash64("value"), F.lit(2)))
    landed, path, checkpoint = (fresh_folder(spark, p) for p in ("landing", "restart", "restart-checkpoint"))
    for half in (0, 1):
        lines.where(F.col("half") == half).select("value").write.mode("append").text(landed)
        rows = scoring.parse_filter(streams.stream_text(spark, landed), extra=LINE_ID)
        streams.to_files(rows, path, checkpoint).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def stream_dead_letter(spark: SparkSession, sf: str) -> DataFrame:
    lines = streams.stream_text(spark, landed_lines(spark, sf))
    routed = _written(scoring.route(lines, extra=LINE_ID), "routed", partition_by=("route",))
    return routed.select("FLIGHT_ID", "missing", "value", "route")


def _fail_once(spark: SparkSession, path: str):
    """A callback that fails after the first commit it sees, and not again."""

    def failing(rows: DataFrame, commit: dict) -> None:
        if not exists(spark, path):
            publish_text(spark, path, commit["attempt"])
            raise RuntimeError("as if the driver were lost")

    return failing


def stream_committed(spark: SparkSession, sf: str) -> DataFrame:
    """Good and dead rows of committed batches; the run fails after its first commit and is started again."""
    landed, out, checkpoint = landed_lines(spark, sf), fresh_folder(spark, "committed"), fresh_folder(spark, "committed-checkpoint")
    models, after = OneModel(trained_model(spark, sf)), _fail_once(spark, f"{out}-failed")
    per_batch = max(1, math.ceil(len(spark.read.text(landed).inputFiles()) / 3))
    for _ in range(2):
        routed = scoring.route(streams.stream_text(spark, landed, per_batch), extra=LINE_ID)
        try:
            commits.score_committed(routed, models, out, checkpoint, after=after).awaitTermination()
            break
        except StreamingQueryException as e:
            if "as if the driver were lost" not in str(e):
                raise
    found = commits.read_committed(spark, out)
    return found.select("FLIGHT_ID", "route", "missing", F.col("prediction").isNotNull().alias("is_scored"))


def stream_model_switch(spark: SparkSession, sf: str) -> DataFrame:
    """Each scored flight, and whether the version its batch names gives it the same prediction again."""
    landed, out, checkpoint = (fresh_folder(spark, p) for p in ("lines", "switched", "switched-checkpoint"))
    raw = materialize(flights_raw(spark, sf), "flights")  # joined once, for the lines and both trainings
    lines_of(raw).write.text(landed)
    store = ModelStore(spark, fresh_folder(spark, "models"))
    store.add(_train_on(typed_of(raw)).pipeline)
    second = store.add(_train_on(typed_of(raw), training.logistic).pipeline, use=False)
    per_batch = max(1, math.ceil(len(spark.read.text(landed).inputFiles()) / 2))
    routed = scoring.route(streams.stream_text(spark, landed, per_batch), extra=LINE_ID)
    switch = lambda rows, commit: store.use(second)
    commits.score_committed(routed, store, out, checkpoint, after=switch).awaitTermination()
    found, parts = commits.read_committed(spark, out).where("route = 'good'"), []
    for version in store.versions():
        of_version = found.where(F.col("version") == version).withColumnRenamed("prediction", "streamed")
        again = store.load(version).transform(of_version.select("FLIGHT_ID", "streamed", *FLIGHTS.inputs))
        parts.append(again.select("FLIGHT_ID", (F.col("streamed") == F.col("prediction")).alias("same_prediction")))
    return parts[0].unionByName(parts[1])


def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """What a listener stored of a stream's batches, over a restart."""
    landed, told = landed_lines(spark, sf), fresh_folder(spark, "progress")
    path, checkpoint = fresh_folder(spark, "counted"), fresh_folder(spark, "counted-checkpoint")
    per_batch = max(1, math.ceil(len(spark.read.text(landed).inputFiles()) / 2))
    log = progress.ProgressLog(spark, told)
    spark.streams.addListener(log)
    try:
        for _ in range(2):
            routed = progress.counted(scoring.route(streams.stream_text(spark, landed, per_batch), extra=LINE_ID))
            query = streams.to_files(routed, path, checkpoint, partition_by=("route",))
            query.awaitTermination()
            log.wait_for(str(query.id), [p["batchId"] for p in query.recentProgress if p["numInputRows"]])
    finally:
        spark.streams.removeListener(log)
    records = progress.read_progress(spark, told)
    return records.agg(*[F.sum(c).alias(c) for c in ("good", "dead", "failed")])


def score_stream(spark: SparkSession, path: str, model: PipelineModel) -> DataFrame:
    rows = scoring.parse_filter(streams.stream_text(spark, path), extra=LINE_ID)
    return _written(_scores(scoring.score(rows, model)), "scored")


def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    return score_stream(spark, landed_lines(spark, sf), trained_model(spark, sf))


def stream_score_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return _bounds(stream_score(spark, sf))


def stream_score_parity(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each flight gets the same prediction as a stream record and as a table row."""
    model = trained_model(spark, sf)
    streamed = score_stream(spark, landed_lines(spark, sf), model)
    streamed = streamed.withColumnsRenamed({"prediction": "streamed", "probability_late": "late"})
    rows = clean.drop_any_null(flights_typed(spark, sf), FLIGHTS.inputs)
    batch = _scores(scoring.score(rows, model))
    same = (F.col("streamed") == F.col("prediction")) & (F.col("late") == F.col("probability_late"))
    joined = batch.join(streamed, "FLIGHT_ID", "full")
    return joined.select("FLIGHT_ID", F.coalesce(same, F.lit(False)).alias("same_prediction"))


QUERIES = {
    f.__name__: f
    for f in (
        scan_csv, scan_csv_by_name, scan_lines, stream_source, replay_sink, replay_stream, replay_staged, preview_top,
        project_cast, drop_any_null, drop_columns, parse_lines, parse_wide_lines, split_fields,
        sample_bernoulli, sample_bernoulli_check, sample_hash, sample_hash_nulls, split_random, split_random_cover, split_hash,
        vocab_fit, vocab_fit_distributed, vocab_roundtrip, vocab_generations,
        hot_labels, label_statistics, encode_statistics,
        encode, encode_keep, encode_join, encode_join_shuffled, assemble,
        row_count, accuracy, word_count, word_count_files,
        rf_train_eval, rf_predict, rf_predict_bounds, rf_quality, lr_train_eval, lr_quality, model_roundtrip,
        artefact_roundtrip,
        stream_parse_filter, stream_foreach_batch, stream_restart, stream_dead_letter,
        stream_committed, stream_model_switch, stream_progress,
        stream_score, stream_score_bounds, stream_score_parity,
    )
}

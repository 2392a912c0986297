from dataclasses import replace

import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tarmac.contract import FLIGHTS
from tarmac.operators.clean import drop_any_null
from tarmac.operators.evaluate import accuracy, preview_top, row_count
from tarmac.operators.vocabulary import Size, Vocabulary
from tarmac.operators.statistics import SMOOTHING, fit_statistics, fold_of, with_other_folds, with_statistics
from tarmac.plans.artefact import ArtefactError
from tarmac.plans.training import (
    LookupPipeline, draw, forest, load_pipeline, load_vocabularies, logistic, pipeline_of, save_model, save_pipeline, save_vocabularies, scoring_pipeline, train,
)


def predictions(df):
    return {r["FLIGHT_ID"]: (r["prediction"], tuple(r["probability"])) for r in df.collect()}


def test_forest_beats_the_majority_class(trained):
    late = trained.test.agg(F.avg(FLIGHTS.label)).first()[0]
    assert trained.metrics["accuracy"] > max(late, 1 - late)


def test_vector_order_of_the_pipeline_is_pinned(trained):
    assert trained.pipeline.stages[-2].getInputCols() == FLIGHTS.features
    assert [i.getInputCol() for i in trained.indexers] == FLIGHTS.categorical
    assert {i.getHandleInvalid() for i in trained.indexers} == {"keep"}


def test_same_seed_same_forest(typed, trained):
    again = train(typed, sample=1.0, key="FLIGHT_ID")
    assert predictions(again.predictions()) == predictions(trained.predictions())


def test_accuracy_agrees_with_the_evaluator(trained):
    scored = trained.predictions().persist()
    evaluator = MulticlassClassificationEvaluator(labelCol=FLIGHTS.label, metricName="accuracy")
    row = accuracy(scored).first()
    assert row["accuracy"] == pytest.approx(evaluator.evaluate(scored)) == pytest.approx(trained.metrics["accuracy"])
    assert row["n"] == trained.metrics["n"] == row_count(scored).first()["n"]
    scored.unpersist()


def test_accuracy_of_nothing_is_null(trained):
    row = accuracy(trained.predictions().where("false")).first()
    assert (row["n"], row["accuracy"]) == (0, None)


def test_pipeline_round_trip(trained, tmp_path):
    save_pipeline(trained.pipeline, str(tmp_path / "model"))
    save_pipeline(trained.pipeline, str(tmp_path / "model"))  # overwrites
    loaded = load_pipeline(str(tmp_path / "model"))
    assert predictions(loaded.transform(trained.test)) == predictions(trained.predictions())


def test_separate_vocabularies_and_model_give_the_same_predictions(trained, tmp_path):
    save_vocabularies(trained.vocabulary, str(tmp_path / "indexers") + "/")
    save_model(trained.model, str(tmp_path / "forest"))
    assert sorted(p.name for p in (tmp_path / "indexers").iterdir()) == sorted(FLIGHTS.categorical)
    indexers = load_vocabularies(str(tmp_path / "indexers"))
    assert [i.getInputCol() for i in indexers] == FLIGHTS.categorical
    model = RandomForestClassificationModel.load(str(tmp_path / "forest"))
    parts = scoring_pipeline(indexers, model)
    assert predictions(parts.transform(trained.test)) == predictions(trained.predictions())


def test_unseen_labels_are_scored(trained):
    strange = trained.test.withColumn("CARRIER_NAME", F.lit("never seen"))
    assert trained.pipeline.transform(strange).where("prediction IS NOT NULL").count() == trained.metrics["n"]


def test_bins_grow_with_the_vocabulary(trained):
    assert forest(FLIGHTS, trained.vocabulary, 1).getMaxBins() == 343
    assert forest(FLIGHTS, trained.vocabulary, 1, max_bins=2).getMaxBins() == trained.vocabulary.largest() + 1
    huge = Vocabulary(trained.vocabulary.table, {"DEP_BLOCK": Size(100_000, 1_000_000)})
    assert forest(FLIGHTS, huge, 1).getMaxBins() == 100_001
    assert logistic(FLIGHTS, huge, 1).getFeaturesCol() == FLIGHTS.vector


def test_vocabulary_of_the_training_part(typed):
    result = train(typed, logistic, sample=0.5, key="FLIGHT_ID", vocabulary_from="train")
    assert 0.0 <= result.metrics["accuracy"] <= 1.0
    seen = {r[0] for r in result.train.select("DEPARTING_AIRPORT").distinct().collect()}
    assert set(result.indexers[2].labels) == seen


def test_logistic_regression(typed):
    result = train(typed, logistic, sample=1.0, key="FLIGHT_ID")
    assert {"rawPrediction", "probability", "prediction"} <= set(result.predictions().columns)
    assert result.metrics["n"] == result.test.count()


def test_vocabulary_past_the_driver(spark, typed, tmp_path):
    """A vocabulary that is looked up as a table gives the model that indexers give, and it is saved and loaded."""
    small = train(typed, logistic, sample=1.0, key="FLIGHT_ID")
    large = train(typed, logistic, sample=1.0, key="FLIGHT_ID", max_labels=0)
    assert isinstance(large.pipeline, LookupPipeline) and large.metrics == small.metrics
    expected = predictions(small.predictions())  # sums of floats come in another order
    for key, (label, chances) in predictions(large.predictions()).items():
        assert label == expected[key][0] and list(chances) == pytest.approx(list(expected[key][1]))
    save_pipeline(large.pipeline, str(tmp_path / "large"))
    loaded = load_pipeline(str(tmp_path / "large"))
    assert isinstance(loaded, LookupPipeline)
    assert predictions(loaded.transform(large.test)) == predictions(large.predictions())
    save_pipeline(small.pipeline, str(tmp_path / "small"))
    assert predictions(load_pipeline(str(tmp_path / "small")).transform(small.test)) == predictions(small.predictions())


def test_forest_of_many_labels(typed):
    """More labels than the forest once allowed."""
    many = typed.withColumn("PREVIOUS_AIRPORT", F.concat(F.lit("x"), F.col("FLIGHT_ID") * 10 % 5003))
    rows = many.unionByName(many.withColumn("PREVIOUS_AIRPORT", F.concat("PREVIOUS_AIRPORT", F.lit("y"))))
    rows = rows.unionByName(rows.withColumn("PREVIOUS_AIRPORT", F.concat("PREVIOUS_AIRPORT", F.lit("z"))))
    copies = F.explode(F.array(*[F.lit(i) for i in range(5)]))  # a forest has no more bins than rows
    rows = rows.select("*", copies.alias("copy")).drop("copy")
    result = train(rows, forest, sample=1.0, key="FLIGHT_ID")
    assert result.vocabulary.largest() > 4096 and result.metrics["n"] > 0


def _other_means(rows, column, label):
    """Out-of-fold and whole means of a label, by plain Python."""
    rows = [r.asDict() for r in rows.withColumn("fold", fold_of(rows)).collect()]
    prior = sum(r[label] for r in rows) / len(rows)
    smooth = lambda some: (sum(r[label] for r in some) + SMOOTHING * prior) / (len(some) + SMOOTHING)
    by_label = {}
    for r in rows:
        by_label.setdefault(r[column], []).append(r)
    folds = {r["FLIGHT_ID"]: smooth([o for o in by_label[r[column]] if o["fold"] != r["fold"]]) for r in rows}
    return folds, {r["FLIGHT_ID"]: smooth(by_label[r[column]]) for r in rows}, prior


@pytest.mark.parametrize("max_labels", [0, 1000])
def test_statistics_equal_plain_means(typed, max_labels):
    rows = drop_any_null(typed)
    column, output = "PREVIOUS_AIRPORT", "PreviousAirportIndex"
    statistics = fit_statistics(rows, [column])
    folds, whole, prior = _other_means(rows, column, FLIGHTS.label)
    for encoded, expected in ((with_other_folds(rows, statistics, max_labels=max_labels), folds),
                              (with_statistics(rows, statistics, max_labels=max_labels), whole)):
        assert encoded.columns == [*rows.columns, output]
        found = {r["FLIGHT_ID"]: r[output] for r in encoded.collect()}
        assert found.keys() == expected.keys() and all(found[k] == pytest.approx(expected[k]) for k in found)
    strange = rows.withColumn(column, F.when(F.col("FLIGHT_ID") % 2 == 0, "never seen"))
    means = with_statistics(strange, statistics, max_labels=max_labels).select(output).distinct().collect()
    assert [r[0] for r in means] == [pytest.approx(prior)]


def test_forest_on_statistics_is_as_right(typed, trained):
    """The airports as means of their flights, and the rest as categories."""
    result = train(typed, forest, sample=1.0, key="FLIGHT_ID", statistics_above=20)
    assert result.statistics.columns == ["DEPARTING_AIRPORT", "PREVIOUS_AIRPORT"]
    assert result.pipeline.numbered == ["DEP_BLOCK", "CARRIER_NAME"] and result.indexers == []
    assert abs(result.metrics["accuracy"] - trained.metrics["accuracy"]) <= 0.005


def test_forest_bins_do_not_grow_with_labels(spark, typed):
    """A hundred thousand labels, whose flights are late or not by the label, are learned with 343 bins."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(int(300_000 / typed.count()))))
    rows = typed.select("*", copies.alias("copy")).withColumn("PREVIOUS_AIRPORT", F.concat(F.lit("x"), F.pmod(F.xxhash64("FLIGHT_ID", "copy"), F.lit(100_000))))
    rows = rows.withColumn(FLIGHTS.label, (F.crc32("PREVIOUS_AIRPORT") % 2).cast("double"))
    rows = rows.withColumn("FLIGHT_ID", F.col("FLIGHT_ID") * 1000 + F.col("copy")).drop("copy")
    bins = []

    def counted(contract, vocabulary, seed):
        estimator = forest(contract, vocabulary, seed)
        bins.append(estimator.getMaxBins())
        return estimator

    result = train(rows, counted, sample=1.0, key="FLIGHT_ID")
    late = result.test.agg(F.avg(FLIGHTS.label)).first()[0]
    assert bins == [343] and result.vocabulary.largest() > 80_000
    assert result.metrics["accuracy"] > max(late, 1 - late) + 0.1


def test_artefacts_of_any_size(spark, typed, trained, tmp_path):
    """Vocabularies past the driver, with and without statistics, as parts and as a whole."""
    for above in (None, 20):
        large = train(typed, logistic, sample=1.0, key="FLIGHT_ID", max_labels=0, statistics_above=above)
        parts, whole = str(tmp_path / f"parts-{above}"), str(tmp_path / f"whole-{above}")
        save_vocabularies(large.vocabulary, f"{parts}/vocabularies", statistics=large.statistics, max_labels=0)
        save_model(large.model, f"{parts}/classifier")
        save_pipeline(large.pipeline, whole)
        expected = predictions(large.predictions())
        for loaded in (pipeline_of(f"{parts}/vocabularies", f"{parts}/classifier"), load_pipeline(whole)):
            assert isinstance(loaded, LookupPipeline) and loaded.numbered == large.pipeline.numbered
            assert predictions(loaded.transform(large.test)) == expected


def test_incomplete_and_foreign_artefacts_are_refused(spark, typed, trained, tmp_path):
    large = train(typed, logistic, sample=1.0, key="FLIGHT_ID", max_labels=0)
    path = tmp_path / "model"
    with pytest.raises(ArtefactError, match="no manifest"):
        load_pipeline(str(path))
    save_pipeline(large.pipeline, str(path))
    load_pipeline(str(path))
    other = replace(FLIGHTS, index_columns=dict(reversed(FLIGHTS.index_columns.items())))
    with pytest.raises(ArtefactError, match="other columns"):
        load_pipeline(str(path), other)
    folder = next(path.glob("parts-*"))
    one = next((folder / "vocabulary").glob("*.parquet"))
    one.rename(tmp_path / "aside")
    with pytest.raises(ArtefactError, match="not what was saved"):
        load_pipeline(str(path))
    (tmp_path / "aside").rename(one)
    load_pipeline(str(path))
    (path / "manifest.json").rename(tmp_path / "manifest")
    with pytest.raises(ArtefactError, match="no manifest"):
        load_pipeline(str(path))
    save_pipeline(trained.pipeline, str(tmp_path / "plain"))
    part = next((tmp_path / "plain" / "stages").rglob("part-*"))
    part.write_bytes(part.read_bytes()[:-1])
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(ArtefactError, match="not what was saved"):
        load_pipeline(str(tmp_path / "plain"))


def test_an_artefact_is_replaced_in_one_step(typed, tmp_path):
    path = tmp_path / "model"
    large = train(typed, logistic, sample=0.5, key="FLIGHT_ID", max_labels=0)
    for _ in range(3):
        save_pipeline(large.pipeline, str(path))
    assert len(list(path.glob("parts-*"))) == 2 and not list(path.glob("*.draft"))
    assert predictions(load_pipeline(str(path)).transform(large.test)) == predictions(large.predictions())


def test_infinite_numbers_are_missing(typed):
    spoiled = typed.withColumn("AWND", F.when(F.col("FLIGHT_ID") % 40 == 0, F.lit(float("inf"))).otherwise(F.col("AWND")))
    result = train(spoiled, logistic, sample=1.0, key="FLIGHT_ID")
    assert result.train.where("FLIGHT_ID % 40 = 0").count() == 0


def test_nothing_stays_in_memory(spark, typed):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    train(typed, logistic, sample=0.3, key="FLIGHT_ID")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_preview_is_a_top_k(typed, plan):
    top = preview_top(drop_any_null(typed), 10, "FLIGHT_ID")
    ids = [r["FLIGHT_ID"] for r in top.collect()]
    assert len(ids) == 10 and ids == sorted(ids)
    assert "TakeOrderedAndProject" in plan(top)
    assert preview_top(typed, 3).count() == 3


def test_random_draw_without_a_key(typed):
    result = train(typed, logistic, sample=0.5, seed=3)
    again = train(typed, logistic, sample=0.5, seed=3)
    first, second = (sorted(r["FLIGHT_ID"] for r in part.collect()) for part in (result.train, result.test))
    everything = [r["FLIGHT_ID"] for r in drop_any_null(typed).collect()]
    assert not set(first) & set(second) and set(first + second) <= set(everything)
    assert 0.4 < len(first + second) / len(everything) < 0.6
    assert 0.6 < len(first) / len(first + second) < 0.8
    assert result.metrics == again.metrics and result.train.columns == typed.columns


def test_copies_of_one_row_are_drawn_apart(typed):
    """A third of all rows are copies of one row; both parts and the sample keep their share of them."""
    flights = drop_any_null(typed).drop("FLIGHT_ID")
    n = flights.count()
    copies = flights.limit(1).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(n // 2)))).drop("copy")
    drawn = draw(flights.unionByName(copies), 0.3, 0.7, 1).groupBy("_first").count().collect()
    sizes = {r["_first"]: r["count"] for r in drawn}
    assert 0.25 < sum(sizes.values()) / (n + n // 2) < 0.35
    assert 0.6 < sizes[True] / sum(sizes.values()) < 0.8

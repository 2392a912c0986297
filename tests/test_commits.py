import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tarmac.checks.fixtures import LINE_ID, flights_lines
from tarmac.contract import FLIGHTS
from tarmac.operators.clean import drop_any_null
from tarmac.plans import training
from tarmac.plans.store import ModelStore, OneModel
from tarmac.plans.training import LookupPipeline, logistic, train
from tarmac.sources.streams import stream_text, to_files
from tarmac.streaming import commits, scoring
from tarmac.streaming.progress import ProgressLog, counted, read_progress


@pytest.fixture(scope="module")
def landed(spark, sf, tmp_path_factory):
    """Lines in four files."""
    path = str(tmp_path_factory.mktemp("lines") / "all")
    flights_lines(spark, sf).repartition(4).write.text(path)
    return path


@pytest.fixture
def routed(spark, landed):
    return lambda files=1: scoring.route(stream_text(spark, landed, files), extra=LINE_ID)


def rows(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def batch_scores(model, typed):
    scored = scoring.flatten_vectors(model.transform(drop_any_null(typed, FLIGHTS.inputs)))
    return rows(scored, "FLIGHT_ID", "prediction", "probability")


def test_both_outputs_of_every_batch(spark, typed, trained, routed, tmp_path):
    out = str(tmp_path / "out")
    commits.score_committed(routed(), OneModel(trained.pipeline), out, str(tmp_path / "cp")).awaitTermination()
    found = commits.read_committed(spark, out)
    good, dead = found.where("route = 'good'"), found.where("route = 'dead'")
    assert rows(good, "FLIGHT_ID", "prediction", "probability") == batch_scores(trained.pipeline, typed)
    assert dead.count() == typed.count() - good.count() > 0
    assert dead.where("prediction IS NOT NULL OR value IS NULL OR missing = ''").isEmpty()
    assert good.where("value IS NOT NULL OR prediction IS NULL").isEmpty()
    told = commits.read_commits(spark, out).agg(F.count("*"), F.sum("good"), F.sum("dead")).first()
    assert tuple(told) == (4, good.count(), dead.count())


def test_a_crash_before_the_commit_shows_neither_output(spark, typed, trained, routed, tmp_path, monkeypatch):
    out, cp = tmp_path / "out", str(tmp_path / "cp")
    put, puts = commits.publish_text, []

    def failing(spark, path, text):
        puts.append(path)
        if "/commits/" in path and sum("/commits/" in p for p in puts) == 3:
            raise OSError("no commit")
        put(spark, path, text)

    monkeypatch.setattr(commits, "publish_text", failing)
    start = lambda: commits.score_committed(routed(), OneModel(trained.pipeline), str(out), cp)
    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    batch = next(p for p in (out / "data").rglob("batch=2"))
    assert list(batch.rglob("*.parquet"))  # both were written
    half = commits.read_committed(spark, str(out))
    assert {r[0] for r in half.select("batch").distinct().collect()} == {0, 1}
    start().awaitTermination()
    whole = commits.read_committed(spark, str(out))
    assert rows(whole.where("route = 'good'"), "FLIGHT_ID", "prediction", "probability") == batch_scores(trained.pipeline, typed)
    assert whole.count() == typed.count() and len(list(batch.iterdir())) == 1


def test_nothing_is_held_and_a_batch_is_read_once(spark, trained, routed, tmp_path):
    query = commits.score_committed(routed(4), OneModel(trained.pipeline), str(tmp_path / "o"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= 1  # the typed flights of the tests
    scanned = commits.score_all(scoring.route(spark.range(1).selectExpr("'a,b' AS value"), extra=LINE_ID), trained.pipeline)
    assert scanned._jdf.queryExecution().executedPlan().toString().count("Range (") == 1


def test_lookups_leave_no_tables_behind(spark, typed, routed, tmp_path):
    """Ten batches scored by lookup, and no more folders in the shared folder than before."""
    from tarmac import session

    pipeline = train(typed, logistic, sample=1.0, key="FLIGHT_ID", max_labels=0).pipeline
    assert isinstance(pipeline, LookupPipeline)
    before = set(session._WRITTEN)
    out = str(tmp_path / "out")
    commits.score_committed(routed(), OneModel(pipeline), out, str(tmp_path / "cp")).awaitTermination()
    assert session._WRITTEN == before
    good = commits.read_committed(spark, out).where("route = 'good'")
    assert rows(good, "FLIGHT_ID", "prediction") == rows(pipeline.transform(drop_any_null(typed, FLIGHTS.inputs)), "FLIGHT_ID", "prediction")


@pytest.fixture(scope="module")
def two_models(typed, trained):
    """The forest, and one that always says late."""
    always = train(typed.withColumn(FLIGHTS.label, (F.col("FLIGHT_ID") % 50 > 0).cast("double")), logistic, sample=1.0, key="FLIGHT_ID")
    return trained.pipeline, always.pipeline


def test_the_model_is_switched_between_batches(spark, typed, two_models, routed, tmp_path, monkeypatch):
    """A batch that is repeated after the switch takes the version it began with."""
    store, out, cp = ModelStore(spark, str(tmp_path / "models")), str(tmp_path / "out"), str(tmp_path / "cp")
    with pytest.raises(LookupError, match="no model"):
        store.current()
    first, second = store.add(two_models[0]), store.add(two_models[1], use=False)
    assert (first, second, store.current()) == ("v000001", "v000002", first)
    failed = []

    def fail_once(batch, commit):
        if commit["batch"] == 0:
            store.use(second)

    scored = commits.score_all

    def broken(batch, pipeline):
        if store.current() == second and not failed:
            failed.append(True)
            store.use(first)  # the batch has begun with the second
            raise ValueError("lost")
        return scored(batch, pipeline)

    monkeypatch.setattr(commits, "score_all", broken)
    start = lambda after: commits.score_committed(routed(), store, out, cp, after=after)
    with pytest.raises(StreamingQueryException):
        start(fail_once).awaitTermination()
    start(None).awaitTermination()
    versions = {r["batch"]: r["version"] for r in commits.read_commits(spark, out).collect()}
    assert versions == {0: first, 1: second, 2: first, 3: first}
    found = commits.read_committed(spark, out).where("route = 'good'")
    for version, pipeline in ((first, two_models[0]), (second, two_models[1])):
        part = found.where(F.col("version") == version)
        again = scoring.flatten_vectors(pipeline.transform(part.select("FLIGHT_ID", *FLIGHTS.inputs)))
        assert rows(part, "FLIGHT_ID", "prediction", "probability") == rows(again, "FLIGHT_ID", "prediction", "probability")


def test_an_incomplete_version_is_not_put_in_use(spark, trained, tmp_path):
    store = ModelStore(spark, str(tmp_path / "models"))
    version = store.add(trained.pipeline)
    (tmp_path / "models" / "v000002").mkdir()
    with pytest.raises(training.artefact.ArtefactError):
        store.use("v000002")
    assert store.current() == version and store.versions() == [version, "v000002"]


def test_counts_of_a_stream_equal_its_sink_after_a_restart(spark, routed, tmp_path):
    out, cp, told = (str(tmp_path / n) for n in ("out", "cp", "told"))
    log = ProgressLog(spark, told)
    spark.streams.addListener(log)
    try:
        broken = counted(routed()).withColumn("value", F.raise_error(F.lit("lost")).cast("string"))
        with pytest.raises(StreamingQueryException):
            to_files(broken, out, cp, partition_by=("route",)).awaitTermination()
        for _ in range(2):  # the second run finds nothing new
            to_files(counted(routed()), out, cp, partition_by=("route",)).awaitTermination()
        for _ in range(100):
            records = read_progress(spark, told)
            if records.where("failed = 0").count() == 4 and records.where("failed = 1").count() == 1:
                break
            spark.sparkContext._jvm.java.lang.Thread.sleep(200)
    finally:
        spark.streams.removeListener(log)
    written = spark.read.parquet(out).groupBy("route").count().collect()
    sums = records.agg(F.sum("good"), F.sum("dead"), F.sum("failed")).first()
    assert tuple(sums) == (*(dict(map(tuple, written))[r] for r in ("good", "dead")), 1)
    assert "lost" in records.where("failed = 1").first()["error"] and json.loads(json.dumps(records.count())) == 5

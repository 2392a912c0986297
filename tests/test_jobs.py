import re
from pathlib import Path

import pytest

from tarmac.__main__ import parser
from tarmac.checks.fixtures import flights_lines, flights_table, flights_typed
from tarmac.contract import FLIGHTS
from tarmac.operators.clean import drop_any_null, project_cast
from tarmac.sources.files import write_csv


def run(spark, *argv):
    args = parser().parse_args([str(a) for a in argv])
    args.run(spark, args)


@pytest.fixture(scope="module")
def home(tmp_path_factory):
    return tmp_path_factory.mktemp("jobs")


@pytest.fixture(scope="module")
def data(spark, sf, home):
    write_csv(flights_table(spark, sf), str(home / "data"))
    return home / "data"


def test_train_replay_score(spark, sf, home, data, capsys):
    run(
        spark, "train", "--data", data, "--model", home / "model", "--vocabularies", home / "indexers",
        "--sample", 0.5, "--preview", 5,
    )
    out = capsys.readouterr().out
    assert re.search(r"accuracy (0\.\d+|1\.0) on \d+ held-out rows", out)
    assert {p.name for p in (home / "indexers").iterdir()} == set(FLIGHTS.categorical)

    run(
        spark, "replay", "--data", data, "--staged", home / "staged", "--out", home / "topic",
        "--checkpoint", home / "replay-cp", "--lines-per-file", 200, "--files-per-interval", 3, "--once",
    )
    again = sorted(spark.read.text(str(home / "topic")).inputFiles())
    run(
        spark, "replay", "--data", data, "--staged", home / "staged", "--out", home / "topic",
        "--checkpoint", home / "replay-cp", "--lines-per-file", 200, "--files-per-interval", 3, "--once",
    )
    assert sorted(spark.read.text(str(home / "topic")).inputFiles()) == again
    lines = spark.read.text(str(home / "topic"))
    assert sorted(lines.collect()) == sorted(flights_lines(spark, sf).collect())

    run(
        spark, "score", "--model", home / "model", "--lines", home / "topic", "--out", home / "scored",
        "--dead", home / "dead", "--checkpoint", home / "cp", "--once", "--show", 3,
    )
    assert "prediction" in capsys.readouterr().out
    typed = flights_typed(spark, sf)
    good = drop_any_null(typed, FLIGHTS.inputs)
    scored = spark.read.parquet(str(home / "scored"))
    assert sorted(scored.select(*FLIGHTS.inputs).collect()) == sorted(good.select(*FLIGHTS.inputs).collect())
    assert spark.read.parquet(str(home / "dead")).count() == typed.count() - good.count()


def test_replay_without_staging(spark, sf, home, data):
    run(
        spark, "replay", "--data", data, "--out", home / "direct", "--checkpoint", home / "direct-cp",
        "--files-per-interval", 1, "--once",
    )
    lines = spark.read.text(str(home / "direct"))
    assert sorted(lines.collect()) == sorted(flights_lines(spark, sf).collect())


def test_replay_in_order(spark, sf, home, data):
    """All lines arrive, in the order of the files, and a second run adds none."""
    for _ in range(2):
        run(
            spark, "replay", "--data", data, "--index", home / "index", "--out", home / "ordered",
            "--checkpoint", home / "ordered-cp", "--lines-per-interval", 400, "--once",
        )
    lines = [r["value"] for r in spark.read.text(str(home / "ordered")).collect()]
    assert sorted(lines) == sorted(r["value"] for r in flights_lines(spark, sf).collect())


def test_score_with_separate_parts(spark, home, data, capsys):
    run(
        spark, "train", "--data", data, "--model", home / "model2", "--vocabularies", home / "indexers2",
        "--classifier", home / "classifier2", "--estimator", "logistic", "--key", "MONTH", "--sample", 1, "--max-bins", 400,
    )
    for name, parts in (("whole", ("--model", home / "model2")),
                        ("parts", ("--vocabularies", home / "indexers2", "--classifier", home / "classifier2"))):
        run(
            spark, "score", *parts, "--lines", home / "topic", "--out", home / name, "--dead", home / f"{name}-dead",
            "--checkpoint", home / f"{name}-cp", "--once", "--max-files", 2,
        )
    columns = [*FLIGHTS.inputs, "prediction", "probability"]
    whole, parts = (sorted(map(repr, spark.read.parquet(str(home / n)).select(*columns).collect())) for n in ("whole", "parts"))
    assert whole == parts and whole


def test_what_a_job_wrote_is_deleted(spark, monkeypatch):
    from tarmac import session
    from tarmac.session import delete_written, materialize, shared_folder

    monkeypatch.setattr(session, "_WRITTEN", set())  # that of this test only
    table = materialize(spark.range(5), "test-of-deletion")
    path = table.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert path.startswith(shared_folder(spark).removeprefix("file:")) and Path(path).exists()
    delete_written(spark)
    assert not Path(path).exists()


def test_a_label_can_be_required(spark, sf, home):
    run(
        spark, "score", "--model", home / "model", "--lines", home / "topic", "--out", home / "labelled",
        "--dead", home / "unlabelled", "--checkpoint", home / "label-cp", "--once", "--require-label",
    )
    assert spark.read.parquet(str(home / "labelled")).count() == drop_any_null(flights_typed(spark, sf)).count()
    reasons = spark.read.parquet(str(home / "unlabelled")).select("missing").distinct().collect()
    assert ("DEP_DEL15",) in {tuple(r) for r in reasons}


def test_words(spark, home):
    (home / "texts").mkdir()
    (home / "texts" / "a.txt").write_text("b a b\n")
    run(spark, "words", home / "texts", home / "counts")
    assert sorted(r[0] for r in spark.read.text(str(home / "counts")).collect()) == ["a\t1", "b\t2"]


def test_csv_and_table_give_the_same_typed_rows(spark, sf, data):
    from_csv = project_cast(spark.read.option("header", True).csv(str(data)))
    assert sorted(map(repr, from_csv.collect())) == sorted(
        map(repr, flights_typed(spark, sf).drop("FLIGHT_ID").collect())
    )

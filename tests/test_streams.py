import gzip

import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tarmac.checks.fixtures import LINE_ID, flights_lines
from tarmac.contract import FLIGHTS
from tarmac.operators.clean import drop_any_null
from tarmac.operators.encoding import encode_join
from tarmac.operators.vocabulary import fit_vocabulary
from tarmac.plans import replay
from tarmac.sources.ordered import OrderedLinesReader, index_lines, save_index
from tarmac.sources.streams import Topic, drain, stream_text, to_files
from tarmac.streaming import scoring

GOOD = "1,7,0,4,0600,,,,Acme,,,,,,,,7,Here,,,There,0.5,0,,,8.5"
BAD = "one,8,0,4,0600,,,,Acme,,,,,,,,7,Here,,,There,0.5,0,,,"


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


@pytest.fixture(scope="module")
def landed(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines") / "all")
    flights_lines(spark, sf).write.text(path)
    return path


def test_topic_options_name_one_topic():
    topic = Topic("broker:9092", "planes")
    read = topic.read_options(max_records=1000, min_partitions=64)
    assert read == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "planes",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }
    assert topic.read_options(starting="earliest", group_prefix="scoring") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "planes",
        "startingOffsets": "earliest",
        "groupIdPrefix": "scoring",
    }
    assert topic.write_options() == {"kafka.bootstrap.servers": "broker:9092", "topic": "planes"}


def test_stream_and_batch_scoring_agree(spark, typed, trained, landed, tmp_path):
    rows = scoring.parse_filter(stream_text(spark, landed), extra=LINE_ID)
    scored = scoring.flatten_vectors(scoring.score(rows, trained.pipeline))
    to_files(scored, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = scoring.flatten_vectors(scoring.score(drop_any_null(typed, FLIGHTS.inputs), trained.pipeline))
    columns = ["FLIGHT_ID", "prediction", "probability"]
    streamed = spark.read.parquet(str(tmp_path / "out")).select(columns)
    assert sorted(streamed.collect()) == sorted(batch.select(columns).collect())
    assert streamed.count() > 0


def test_label_requirement(spark, typed, landed, tmp_path):
    for required, columns in ((False, FLIGHTS.inputs), (True, FLIGHTS.columns)):
        rows = scoring.parse_filter(stream_text(spark, landed), require_label=required, extra=LINE_ID)
        out = str(tmp_path / f"out-{required}")
        to_files(rows, out, f"{out}-cp").awaitTermination()
        assert spark.read.parquet(out).count() == drop_any_null(typed, columns).count()


def test_restart_delivers_every_row_once(spark, landing, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    for part in range(3):
        (landing / f"{part}.txt").write_text("".join(GOOD.replace(",7,", f",{part}{i},", 1) + "\n" for i in range(10)))
        to_files(scoring.parse_filter(stream_text(spark, str(landing)), extra=LINE_ID), out, cp).awaitTermination()
    ids = [r["FLIGHT_ID"] for r in spark.read.parquet(out).collect()]
    assert sorted(ids) == list(range(30))


def test_dead_letters_keep_the_line_and_the_reason(spark, landing, tmp_path):
    (landing / "a.txt").write_text(f"{GOOD}\n{BAD}\n\n")
    routed = scoring.route(stream_text(spark, str(landing)), extra=LINE_ID)
    to_files(routed, str(tmp_path / "out"), str(tmp_path / "cp"), partition_by=("route",)).awaitTermination()
    written = spark.read.parquet(str(tmp_path / "out"))
    assert [r["FLIGHT_ID"] for r in written.where("route = 'good'").collect()] == [7]
    dead = {r["value"]: r["missing"] for r in written.where("route = 'dead'").collect()}
    assert dead == {BAD: "MONTH,AWND", "": ",".join(FLIGHTS.inputs)}


def test_empty_batches_are_skipped(spark, landing, tmp_path):
    (landing / "a.txt").write_text(f"{BAD}\n")
    (landing / "b.txt").write_text(f"{GOOD}\n")
    seen = []
    rows = scoring.parse_filter(stream_text(spark, str(landing), files_per_trigger=1))
    scoring.each_batch(rows, lambda batch, i: seen.append(batch.count()), str(tmp_path / "cp")).awaitTermination()
    assert seen == [1]


def test_a_failing_batch_stops_the_query_and_is_repeated(spark, landing, tmp_path):
    (landing / "a.txt").write_text(f"{GOOD}\n")
    rows, cp, out = scoring.parse_filter(stream_text(spark, str(landing))), str(tmp_path / "cp"), str(tmp_path / "out")
    write = scoring.write_batch(out)

    def broken(batch, batch_id):
        write(batch, batch_id)
        raise ValueError("after the write")

    with pytest.raises(StreamingQueryException):
        scoring.each_batch(rows, broken, cp).awaitTermination()
    scoring.each_batch(rows, write, cp).awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_a_new_checkpoint_does_not_replace_older_batches(spark, landing, tmp_path):
    (landing / "a.txt").write_text(f"{GOOD}\n")
    rows, out = scoring.parse_filter(stream_text(spark, str(landing))), str(tmp_path / "out")
    for cp in ("first", "second"):
        scoring.each_batch(rows, scoring.write_batch(out), str(tmp_path / cp)).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_replay_paces_and_delivers_everything(spark, landed, tmp_path):
    lines = spark.read.text(landed)
    staged, out = str(tmp_path / "staged"), str(tmp_path / "out")
    stream = replay.replay(lines, staged, lines_per_file=100, files_per_trigger=4)
    n_files = len(spark.read.text(staged).inputFiles())
    query = to_files(stream, out, str(tmp_path / "cp"), fmt="text")
    query.awaitTermination()
    batches = [p for p in query.recentProgress if p["numInputRows"] > 0]
    assert n_files >= lines.count() / 100 and len(batches) == -(-n_files // 4)
    assert max(p["numInputRows"] for p in batches) <= 400
    assert sorted(spark.read.text(out).collect()) == sorted(lines.collect())


@pytest.fixture
def files_in_order(tmp_path):
    """Files of odd names and ends, a compressed one and an empty one, and their lines in order."""
    folder, expected = tmp_path / "files", []
    folder.mkdir()
    for name, end in (("a 1%.csv", "\n"), ("b.csv", ""), ("c.csv.gz", "\n"), ("d.csv", "\r\n")):
        lines = [f"{name} {i} " + "é" * (i % 40) for i in range(250)] + ["", "", "last"]
        sep = "\r\n" if end == "\r\n" else "\n"
        content = (sep.join(["header", *lines]) + end).encode()
        (folder / name).write_bytes(gzip.compress(content) if name.endswith("gz") else content)
        expected += lines
    (folder / "e.csv").write_text("")
    (folder / "f.csv").write_text("only a header\n")
    return str(folder), expected


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_lines_are_numbered_in_order_over_files_and_splits(spark, files_in_order, small_splits):
    path, expected = files_in_order
    index = index_lines(spark, path, stride=37).orderBy("first").collect()
    assert [r["first"] for r in index] == [0, *(r["last"] for r in index[:-1])] and index[-1]["last"] == len(expected)
    assert len({r["file"] for r in index}) == 4 and max(r["last"] - r["first"] for r in index) <= 37
    assert index_lines(spark, f"{path}/f.csv").count() == 0


def test_replay_in_order_goes_on_within_a_file(spark, files_in_order, small_splits, tmp_path):
    path, expected = files_in_order
    out, batches = str(tmp_path / "out"), []
    for _ in range(50):  # one batch a run, until nothing is left
        lines = replay.replay_in_order(spark, path, str(tmp_path / "index"), 301, stride=20)
        query = lines.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(once=True)
        query = query.foreachBatch(lambda b, i: b.write.mode("append").parquet(out)).start()
        query.awaitTermination()
        rows = sum(p["numInputRows"] for p in query.recentProgress)
        if not rows:
            break
        batches.append(rows)
    assert max(batches) <= 301 and sum(batches) == len(expected) and len(batches) == -(-len(expected) // 301)
    found = [tuple(r) for r in spark.read.parquet(out).orderBy("line").collect()]
    assert found == list(enumerate(expected))


def test_a_batch_of_many_stretches_has_few_tasks(spark, files_in_order, small_splits, tmp_path):
    path, expected = files_in_order
    save_index(index_lines(spark, path, stride=10), str(tmp_path / "index"))
    total = len(expected)
    reader = OrderedLinesReader({"path": str(tmp_path / "index"), "linespertrigger": "300", "total": str(total), "tasks": "6"})
    for start, end in ((0, total), (7, total - 5)):
        planned = reader.partitions({"at": start}, {"at": end})
        assert len(planned) <= 2 * 6 + 4  # two that follow each other in one of the four files are more than a share
        read = pa.Table.from_batches([batch for part in planned for batch in reader.read(part)])
        assert list(zip(read["line"].to_pylist(), read["value"].to_pylist())) == list(enumerate(expected))[start:end]


def test_a_failed_batch_of_an_ordered_replay_is_repeated(spark, files_in_order, tmp_path):
    path, expected = files_in_order
    seen = []

    def handle(batch, batch_id):
        seen.append((batch_id, sorted(r["line"] for r in batch.collect())))
        if len(seen) == 3:
            raise ValueError("lost")

    for _ in range(2):
        lines = replay.replay_in_order(spark, path, str(tmp_path / "index"), 200)
        writer = lines.writeStream.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(handle)
        query = writer.trigger(processingTime="0 seconds").start()
        if len(seen) < 3:
            with pytest.raises(StreamingQueryException):
                query.awaitTermination()
        else:
            drain(query)
    assert seen[2] == seen[3]
    delivered = [line for _, lines in seen[:2] + seen[3:] for line in lines]
    assert delivered == list(range(len(expected)))


def test_records_for_a_topic(spark, trained):
    records = scoring.to_records(trained.predictions())
    assert records.columns == ["value"]
    one = records.select(F.from_json("value", "prediction double, probability array<double>").alias("r")).first()["r"]
    assert one["prediction"] in (0.0, 1.0) and len(one["probability"]) == 2


def test_interval_trigger_runs_until_stopped(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    (landing / "a.txt").write_text(f"{GOOD}\n")
    rows = scoring.parse_filter(stream_text(spark, str(landing)), extra=LINE_ID)
    query = to_files(rows, out, str(tmp_path / "cp"), seconds=0.5)
    try:
        query.processAllAvailable()
        (landing / "b.txt").write_text(f"{GOOD}\n{BAD}\n")
        query.processAllAvailable()
        assert query.isActive and not query.awaitTermination(1)
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == 2


def test_a_stream_is_encoded_by_lookup_too(spark, typed, landed, tmp_path):
    vocabulary = fit_vocabulary(drop_any_null(typed))
    rows = scoring.parse_filter(stream_text(spark, landed), extra=LINE_ID)
    to_files(encode_join(rows, vocabulary), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    columns = ["FLIGHT_ID", *FLIGHTS.indexes]
    batch = encode_join(drop_any_null(typed, FLIGHTS.inputs), vocabulary).select(columns)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).select(columns).collect()) == sorted(batch.collect())

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tarmac.checks.compare import _sorted_rows
from tarmac.contract import FLIGHTS
from tarmac.operators import generations
from tarmac.operators.clean import drop_any_null
from tarmac.operators.encoding import assemble, encode, encode_join, hot_labels, trained_hot_labels, vector_slots
from tarmac.operators.generations import GrowingVocabulary
from tarmac.operators.vocabulary import VocabularyTooLarge, fit_vocabulary, from_indexers, to_indexers
from tarmac.session import materialize


def rows_of(df):
    return _sorted_rows(df.columns, df.collect())


@pytest.fixture(scope="module")
def flights(typed):
    return drop_any_null(typed)


@pytest.fixture(scope="module")
def vocabulary(flights):
    return fit_vocabulary(flights)


@pytest.fixture(scope="module")
def partial(flights):
    """Knows neither every carrier nor every departing airport."""
    return fit_vocabulary(flights.where("CARRIER_NAME <> 'AUTOMOBILE' AND DEPARTING_AIRPORT > 'NATION_2'"))


def test_labels_match_the_built_in_indexer(flights, vocabulary):
    for column in FLIGHTS.categorical:
        expected = StringIndexer(inputCol=column, outputCol="i").fit(flights).labels
        table = vocabulary.of(column).orderBy("idx").collect()
        assert [r["label"] for r in table] == list(expected)
        assert [r["idx"] for r in table] == [float(i) for i in range(len(expected))]
        assert vocabulary.sizes[column].labels == len(expected)


def test_ties_resolve_by_label_and_nulls_are_no_label(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "x string")
    table = fit_vocabulary(df, ["x"]).table.orderBy("idx").collect()
    assert [(r["label"], r["n"]) for r in table] == [("c", 2), ("a", 1), ("b", 1)]


def test_distributed_numbering_is_the_same(spark, flights, vocabulary):
    assert rows_of(fit_vocabulary(flights, max_labels=0).table) == rows_of(vocabulary.table)
    many = spark.range(5000).selectExpr("concat('l', id) AS x", "concat('m', id % 40) AS y", "'z' AS z")
    columns = ["x", "y", "z"]
    assert rows_of(fit_vocabulary(many, columns, max_labels=0).table) == rows_of(fit_vocabulary(many, columns).table)


def test_empty_input_gives_empty_vocabularies(flights):
    empty = fit_vocabulary(flights.where("false"))
    assert empty.table.count() == 0 and empty.largest() == 0
    encoded = encode_join(flights, empty)
    assert encoded.where("DepBlockIndex = 0.0").count() == flights.count()


def test_generations_equal_one_fit(spark, flights, tmp_path, monkeypatch):
    """Days added one by one, compacted on the way, number the labels as all rows at once do."""
    store, counted = GrowingVocabulary(spark, str(tmp_path / "counts")), []
    count = generations.count_labels
    monkeypatch.setattr(generations, "count_labels", lambda rows, columns: counted.append(rows.count()) or count(rows, columns))
    assert store.fit().table.isEmpty()
    day = F.col("FLIGHT_ID") % 5
    for i in range(5):
        assert store.add(flights.where(day == i), f"day {i}", most=3)
        assert not store.add(flights.where(day == i), f"day {i}", most=3)
        merged = store.fit(max_labels=0 if i == 2 else 1_000_000)
        assert rows_of(merged.table) == rows_of(fit_vocabulary(flights.where(day <= i)).table)
    assert sum(counted) == flights.count()  # no row was counted twice
    assert [g["names"] for g in store.generations()] == [["day 0", "day 1", "day 2", "day 3"], ["day 4"]]
    store.compact()
    assert len(store.generations()) == 1 and rows_of(store.fit().table) == rows_of(fit_vocabulary(flights).table)


def test_a_generation_counts_whole_or_not(spark, flights, tmp_path, monkeypatch):
    store = GrowingVocabulary(spark, str(tmp_path / "counts"))
    store.add(flights.where("FLIGHT_ID % 2 = 0"), "even")
    before = rows_of(store.counts())
    monkeypatch.setattr(generations, "publish_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.add(flights.where("FLIGHT_ID % 2 = 1"), "odd")
    assert rows_of(store.counts()) == before
    monkeypatch.undo()
    assert store.add(flights.where("FLIGHT_ID % 2 = 1"), "odd")
    assert rows_of(store.fit().table) == rows_of(fit_vocabulary(flights).table)


def test_indexers_keep_label_lists_of_unequal_length(spark, vocabulary):
    indexers = to_indexers(vocabulary)
    assert [len(i.labels) for i in indexers] == [vocabulary.sizes[c].labels for c in FLIGHTS.categorical]
    assert rows_of(from_indexers(spark, indexers)) == rows_of(vocabulary.table.select("field", "label", "idx"))


def test_large_vocabulary_does_not_reach_the_driver(vocabulary):
    with pytest.raises(VocabularyTooLarge, match="encode_join"):
        to_indexers(vocabulary, max_labels=4)


@pytest.mark.parametrize("max_labels", [0, 10, 1000])
def test_lookup_equals_the_indexers(typed, partial, max_labels):
    """Every vocabulary shuffled, only the airports shuffled, every one broadcast."""
    inputs = typed.select("FLIGHT_ID", *FLIGHTS.inputs)
    by_indexer = encode(inputs, *to_indexers(partial, handle_invalid="keep"))
    by_join = encode_join(inputs, partial, max_labels=max_labels)
    assert by_join.columns == by_indexer.columns
    assert rows_of(by_join) == rows_of(by_indexer)


def test_unseen_and_null_get_the_number_of_labels(typed, partial):
    n = float(partial.sizes["CARRIER_NAME"].labels)
    encoded = encode_join(typed, partial)
    unseen = encoded.where("CARRIER_NAME = 'AUTOMOBILE'").select("CarrierNameIndex").distinct().collect()
    assert [r[0] for r in unseen] == [n] == [4.0]
    nulls = encoded.where("PREVIOUS_AIRPORT IS NULL").select("PreviousAirportIndex").distinct().collect()
    assert [r[0] for r in nulls] == [float(partial.sizes["PREVIOUS_AIRPORT"].labels)]


def test_error_on_unseen(typed, flights, vocabulary, partial):
    assert encode_join(flights, vocabulary, unseen="error").count() == flights.count()
    with pytest.raises(PySparkException, match="unseen label in (CARRIER_NAME: AUTOMOBILE|DEPARTING_AIRPORT: NATION_)"):
        encode_join(flights, partial, unseen="error").collect()
    with pytest.raises(Exception, match="Unseen label"):
        encode(flights, *to_indexers(partial)).collect()


def test_shuffled_lookup_with_hot_labels(spark):
    """A third of the rows each: one seen label, one unseen label, one null; plus many rare labels."""
    from tarmac.contract import Contract, Field

    one = Contract((Field(0, "x", "string"),), 1, "y", {"x": "xi"})
    df = spark.range(9000).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 AND id > 600 THEN 'unseen' "
        "WHEN id % 3 = 2 AND id > 600 THEN NULL ELSE concat('r', id) END AS x",
    )
    vocabulary = fit_vocabulary(df.where("x <> 'unseen'"), ["x"], one)
    hot = hot_labels(df, ["x"], 8)["x"]
    assert set(hot) == {"hot", "unseen"} and min(hot.values()) > 8
    trained = trained_hot_labels(vocabulary.table, ["x"], 8)["x"]
    assert set(trained) == {"hot"}
    shuffled = encode_join(df, vocabulary, one, max_labels=0)
    assert rows_of(shuffled) == rows_of(encode_join(df, vocabulary, one))
    assert shuffled.count() == 9000


def test_shuffled_lookup_is_shuffled_and_copies_nothing(flights, partial, plan):
    text = plan(encode_join(materialize(flights, "test"), partial, max_labels=0))
    assert text.count("ShuffledHashJoin") == 4 and "Union" not in text


def test_a_hot_label_is_dealt_over_tasks(spark):
    """No task of the lookup gets more than a few times an even share of the rows."""
    from tarmac.contract import Contract, Field

    one = Contract((Field(0, "x", "string"),), 1, "y", {"x": "xi"})
    df = spark.range(40_000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('r', id % 9999) END AS x")
    vocabulary = fit_vocabulary(df, ["x"], one)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        encoded = encode_join(df, vocabulary, one, max_labels=0).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in encoded.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 40_000 and max(sizes) < 3 * 40_000 / 8


def test_a_sketch_misses_no_hot_label(spark):
    """Five labels of two hundredths each among a hundred thousand rare ones, in every partition alike."""
    df = spark.range(0, 200_000, 1, 16).selectExpr(
        "CASE WHEN id % 50 < 5 THEN concat('hot', id % 50) ELSE concat('r', id % 99991) END AS x", "cast(null AS string) AS y"
    )
    hot = hot_labels(df, ["x", "y"], 16)
    assert set(hot["x"]) == {f"hot{i}" for i in range(5)} and hot["y"] == {}


def test_a_lookup_writes_nothing(flights, partial, monkeypatch):
    from tarmac import session

    flights.count()
    monkeypatch.setattr(session, "fresh_folder", lambda *a: pytest.fail("a table was written"))
    assert encode_join(flights, partial, max_labels=0).count() == flights.count()


def test_lookup_on_a_stream(spark, typed, partial, tmp_path):
    """Large vocabularies too, with hot and null labels."""
    inputs = typed.select("FLIGHT_ID", *FLIGHTS.inputs)
    inputs.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(inputs.schema).parquet(str(tmp_path / "in"))
    encoded = encode_join(stream, partial, max_labels=0)
    writer = encoded.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
    writer.option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
    found = spark.read.schema(encoded.schema).parquet(str(tmp_path / "out"))
    assert rows_of(found) == rows_of(encode_join(inputs, partial))


def test_broadcast_lookup_does_not_move_the_rows(flights, vocabulary, plan):
    text = plan(encode_join(materialize(flights, "test"), vocabulary))
    assert text.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in text


def test_vector_slots(flights, vocabulary):
    encoded = encode_join(flights, vocabulary)
    slots = vector_slots(assemble(encoded), keep=("FLIGHT_ID",))
    expected = encoded.select("FLIGHT_ID", *[F.col(c).cast("double").alias(f"slot_{i}") for i, c in enumerate(FLIGHTS.features)])
    assert rows_of(slots) == rows_of(expected)

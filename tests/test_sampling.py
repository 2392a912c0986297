import pytest
from hypothesis import given, settings, strategies as st

from tarmac.operators.clean import drop_any_null
from tarmac.operators.sampling import sample_bernoulli, sample_hash, split_hash, split_random, threshold


def ids(df):
    return sorted(r["FLIGHT_ID"] for r in df.select("FLIGHT_ID").collect())


def test_samples_are_subsets_of_about_the_size_asked(typed):
    everything, n = set(ids(typed)), typed.count()
    for part in (sample_bernoulli(typed, 0.3, seed=1), sample_hash(typed, 0.3, "FLIGHT_ID"), sample_hash(typed, 0.3)):
        found = ids(part)
        assert len(found) == len(set(found)) and set(found) <= everything
        assert 0.22 * n < len(found) < 0.38 * n


def test_seeds_hold(typed):
    assert ids(sample_bernoulli(typed, 0.3, seed=5)) == ids(sample_bernoulli(typed, 0.3, seed=5))
    assert ids(sample_bernoulli(typed, 0.3, seed=5)) != ids(sample_bernoulli(typed, 0.3, seed=6))


def test_splits_are_disjoint_and_cover(typed):
    everything = ids(typed)
    for first, second in (
        split_hash(typed, 0.7, "FLIGHT_ID"),
        split_hash(typed, 0.7, "DEPARTING_AIRPORT"),
        split_hash(typed, 0.7),
        split_random(typed, 0.7, seed=3),
    ):
        assert sorted(ids(first) + ids(second)) == everything


def test_hash_forms_do_not_depend_on_partitioning(typed):
    for key in ("FLIGHT_ID", None):
        for cut in (lambda df: sample_hash(df, 0.3, key), lambda df: split_hash(df, 0.7, key)[0]):
            assert ids(cut(typed)) == ids(cut(typed.repartition(7)))


def test_split_of_a_sample_keeps_its_share(typed):
    for key in ("FLIGHT_ID", None):
        sampled = sample_hash(typed, 0.3, key)
        share = split_hash(sampled, 0.7, key)[0].count() / sampled.count()
        assert 0.6 < share < 0.8


def test_rows_with_a_null_key_stay(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (2, None)], "FLIGHT_ID bigint, s string")
    for key in ("FLIGHT_ID", "s", None):
        first, second = split_hash(df, 0.7, key)
        assert first.count() + second.count() == 3


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "string"])
def test_keys_of_any_type_and_null_keys_keep_their_share(spark, kind):
    df = spark.range(20_000).selectExpr("id", f"CAST(IF(id % 2 = 0, NULL, id % 120) AS {kind}) AS key")
    for fraction in (0.1, 0.5, 0.9):
        kept = sample_hash(df.where("key IS NULL"), fraction, "key").count()
        assert abs(kept / 10_000 - fraction) < 0.02
    first, second = split_hash(df, 0.7, "key")
    assert first.count() + second.count() == 20_000
    assert abs(first.where("key IS NULL").count() / 10_000 - 0.7) < 0.02


def test_no_sort_and_no_shuffle(spark, sf, plan):
    orders = drop_any_null(spark.read.parquet(f"{sf}/orders.parquet"))
    for key in ("o_orderkey", None):
        text = plan(split_hash(sample_hash(orders, 0.3, key), 0.7, key)[0])
        assert "Sort" not in text and "Exchange" not in text


def test_strides_of_the_key_do_not_matter(spark):
    for stride in (10, 1000, 4096, 1_000_000, 2**40):
        df = spark.range(20_000).selectExpr(f"id * {stride} AS FLIGHT_ID")
        sampled = sample_hash(df, 0.3, "FLIGHT_ID")
        n = sampled.count()
        assert 0.28 < n / 20_000 < 0.32
        assert 0.65 < split_hash(sampled, 0.7, "FLIGHT_ID")[0].count() / n < 0.75


def test_thresholds():
    assert [threshold(f, 1000) for f in (0.0, 0.00001, 0.3, 1.0)] == [0, 1, 300, 1000]
    with pytest.raises(ValueError):
        threshold(1.5, 1000)


@settings(max_examples=20, deadline=None)
@given(key=st.integers(min_value=-(2**63), max_value=2**63 - 1))
def test_any_integer_key_falls_into_one_part(spark, key):
    df = spark.createDataFrame([(key,)], "FLIGHT_ID bigint")
    first, second = split_hash(sample_hash(df, 1.0, "FLIGHT_ID"), 0.7, "FLIGHT_ID")
    assert len(first.collect()) + len(second.collect()) == 1

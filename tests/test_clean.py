import math
from time import perf_counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions

from tarmac.contract import FLIGHTS, Contract, Field
from tarmac.operators.clean import drop_any_null, drop_columns, parse_lines, project_cast, split_fields, with_validity


def line(**fields):
    """A 26-field line; keys are ``f<position>``."""
    default = {0: "1", 2: "0", 3: "4", 4: "0600", 8: "Acme Air", 16: "7", 17: "Here", 20: "There"}
    default.update({21: "0.5", 22: "0", 25: "8.5"})
    default.update({int(k[1:]): v for k, v in fields.items()})
    return ",".join(default.get(i, "") for i in range(26))


GOOD = (1, 0.0, 4.0, "0600", "Acme Air", 7, "Here", "There", 0.5, 0.0, 8.5)


def changed(**values):
    row = dict(zip(FLIGHTS.columns, GOOD))
    row.update(values)
    return tuple(row.values())


EMPTY = (None,) * 11
CASES = {
    "normal": (line(), GOOD),
    "25 fields": (line().rsplit(",", 1)[0], changed(AWND=None)),
    "27 fields": (line() + ",extra", GOOD),
    "empty middle field": (line(f8=""), changed(CARRIER_NAME=None)),
    "empty last field": (line(f25=""), changed(AWND=None)),
    "quoted comma": (line(f8='"Acme, Air"'), changed(CARRIER_NAME="Acme, Air")),
    "decimal text as int": (line(f0="3.0"), changed(MONTH=None)),
    "letters as double": (line(f21="wet"), changed(PRCP=None)),
    "letters as int": (line(f16="old"), changed(PLANE_AGE=None)),
    "empty line": ("", EMPTY),
    "null line": (None, EMPTY),
    "unclosed quote": ('"' + line(), changed(**dict.fromkeys(FLIGHTS.columns))),
    "leading hash": ("#" + line(), changed(MONTH=None)),
    "more fields than the parser takes": ("," * 30_000, EMPTY),
    "long text": (line(f8="x" * 50_000), changed(CARRIER_NAME="x" * 50_000)),
}


@pytest.fixture(scope="module")
def parsed(spark):
    lines = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "case string, value string")
    return {r[0]: tuple(r[1:]) for r in parse_lines(lines, keep=("case",)).collect()}


@pytest.mark.parametrize("case", CASES)
def test_parse_lines(parsed, case):
    if case == "unclosed quote":
        assert parsed[case][1:] == EMPTY[1:]
    else:
        assert parsed[case] == CASES[case][1]


def test_every_bad_line_is_dead_and_named(spark):
    lines = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "case string, value string")
    judged = {r["case"]: r for r in with_validity(parse_lines(lines, keep=("case",))).collect()}
    assert {c for c, r in judged.items() if r["is_valid"]} == {"normal", "27 fields", "quoted comma", "long text"}
    assert judged["empty last field"]["missing"] == "AWND"
    assert judged["empty line"]["missing"] == ",".join(FLIGHTS.inputs)
    assert judged["normal"]["missing"] == ""


def test_label_is_required_only_on_request(spark):
    rows = parse_lines(spark.createDataFrame([(line(f2=""),)], "value string"))
    assert with_validity(rows).first()["is_valid"] is True
    assert with_validity(rows, require_label=True).first()["missing"] == "DEP_DEL15"


def test_split_fields_ignores_quotes(spark):
    lines = spark.createDataFrame([(line(f8='"Acme, Air"'),), ("a,b",), (line(f25=""),)], "value string")
    quoted, short, empty = split_fields(lines).collect()
    assert quoted["CARRIER_NAME"] == '"Acme' and quoted["DEPARTING_AIRPORT"] == "7"  # shifted by one
    assert short["MONTH"] == "a" and short["AWND"] is None
    assert empty["AWND"] == ""


def test_lines_are_parsed_once(spark, plan):
    lines = spark.createDataFrame([(line(),)], "value string")
    kept = plan(drop_any_null(parse_lines(lines)))
    assert kept.count("from_csv") == 1
    cut = plan(split_fields(lines).where("MONTH IS NOT NULL AND AWND IS NOT NULL"))
    assert cut.count("split(") == 1


def test_bad_text_becomes_null_and_rows_stay(spark):
    text = {f.name: "x" if f.type != "string" else "s" for f in FLIGHTS.fields}
    row = project_cast(spark.createDataFrame([text])).first()
    assert [row[c] for c in FLIGHTS.categorical] == ["s"] * 4
    assert sum(v is None for v in row) == 7


def test_drop_any_null_counts_nan_as_absent(spark):
    rows = [(1, 1.0, "a"), (2, math.nan, "b"), (3, None, "c"), (4, 1.0, None)]
    df = spark.createDataFrame(rows, "id int, x double, s string")
    assert [r["id"] for r in drop_any_null(df).collect()] == [1]
    assert sorted(r["id"] for r in drop_any_null(df, ["s"]).collect()) == [1, 2, 3]
    assert drop_any_null(df).count() == df.dropna("any").count()


def test_null_tests_reach_the_scan(spark, sf, plan):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderpriority")
    text = plan(drop_any_null(orders))
    assert "PushedFilters: [IsNotNull(o_orderkey), IsNotNull(o_orderpriority)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in text


def test_drop_columns_keeps_order(typed):
    assert drop_columns(typed, ["DEP_BLOCK", "DEP_DEL15"]).columns == [
        c for c in typed.columns if c not in ("DEP_BLOCK", "DEP_DEL15")
    ]


FIELD = st.text(alphabet="ab1.- \t;'#", max_size=6)


@settings(max_examples=25, deadline=None)
@given(lines=st.lists(st.lists(FIELD, min_size=1, max_size=30), min_size=1, max_size=5))
def test_parser_and_plain_split_agree_without_quotes(spark, lines):
    """Field by field, but that the parser gives null for empty text."""
    texts = [",".join(fields) for fields in lines]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    every = Contract(tuple(Field(p, c, "string") for p, c in enumerate(FLIGHTS.line_columns)), 26, "", {})
    parsed = [tuple(r) for r in parse_lines(df, every).collect()]
    cut = [tuple(v or None for v in r) for r in split_fields(df, every).collect()]
    assert parsed == cut == [tuple((f + [""] * 26)[i] or None for i in range(26)) for f in lines]


@pytest.mark.parametrize("tail", ['"' + "," * 21_000 + '"', "," * 21_000, '"' + "x" * 1_000_000 + '"' + "," * 21_000])
def test_wide_lines_are_read(spark, tail):
    """A quoted field with many commas, very many fields, and a field of a megabyte before them."""
    line = ",".join(str(i) for i in range(26))
    df = spark.createDataFrame([(f"{line},{tail}",), (line,)], "value string")
    first, second = parse_lines(df).collect()
    assert first == second and first["MONTH"] == 0 and first["AWND"] == 25.0


def test_commas_behind_the_fields_in_use_are_not_looked_at(spark):
    """A long line is parsed in less time than it takes to find all its commas."""
    tail = functions.when(functions.col("id") % 2 == 0, functions.lit("," * 21_000)).otherwise("," + '"' + "," * 21_000 + '"')
    lines = spark.range(0, 20_000, 1, 8).select(functions.concat(functions.lit(line()), tail).alias("value"))
    left = functions.length(functions.replace("value", functions.lit(","), functions.lit("")))

    def seconds(df):
        began = perf_counter()
        df.distinct().collect()
        return perf_counter() - began

    parsed, counted = parse_lines(lines), lines.select(left)
    assert [tuple(r) for r in parsed.distinct().collect()] == [GOOD]
    seconds(counted)
    assert seconds(parsed) < seconds(counted)


@pytest.mark.parametrize("body", ["", "1,", "1,2,3", line(), line() + ",x", " 1 , 2", "\n" + line(), "é," * 30, line(f8='"Acme, Air"')])
@pytest.mark.parametrize("tail", ["x" * 30_000, "," * 20_400, "," + "é" * 15_000, ',"' + "x," * 15_000 + '"'])
def test_a_long_line_is_read_as_the_parser_reads_it(spark, body, tail):
    df = spark.createDataFrame([(body + tail,)], "value string")
    schema = ", ".join(f"`{c}` STRING" for c in FLIGHTS.line_columns)
    whole = df.select(functions.from_csv("value", schema, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    every = Contract(tuple(Field(p, c, "string") for p, c in enumerate(FLIGHTS.line_columns)), 26, "", {})
    assert parse_lines(df, every).collect() == whole.collect()


def test_wide_fields_among_those_in_use(spark):
    fields = [str(i) for i in range(26)]
    fields[8] = '"' + "a," * 21_000 + '\\"z"'
    row = parse_lines(spark.createDataFrame([(",".join(fields) + "," * 21_000,)], "value string")).first()
    assert row["CARRIER_NAME"] == "a," * 21_000 + '"z' and row["AWND"] == 25.0


def test_an_infinite_number_is_missing(spark):
    fields = [str(i) for i in range(26)]
    for text in ("Infinity", "-Infinity", "1e999", "NaN"):
        fields[25] = text
        rows = parse_lines(spark.createDataFrame([(",".join(fields),)], "value string"))
        assert drop_any_null(rows).count() == 0
        assert with_validity(rows).first()["missing"] == "AWND"


def test_a_key_may_be_a_column_of_the_contract(spark, sf):
    from tarmac.checks.fixtures import flights_raw

    typed = project_cast(flights_raw(spark, sf), keep=("MONTH", "FLIGHT_ID"))
    assert typed.columns == ["FLIGHT_ID", *FLIGHTS.columns]

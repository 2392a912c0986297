"""Flight records derived from the given tables; one SQL text for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.contract import FLIGHTS
from tarmac.operators.clean import project_cast
from tarmac.session import spread

# Columns in use of the given tables; naming them spares a job that would infer them.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "documents": "doc_id bigint, text string",
}

FLIGHTS_RAW = """
SELECT o.o_orderkey AS FLIGHT_ID,
       CAST(month(o.o_orderdate) AS VARCHAR(20)) AS MONTH,
       CASE WHEN o.o_orderkey % 29 = 0 THEN NULL
            WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') AND o.o_totalprice > 150000
            THEN '1' ELSE '0' END AS DEP_DEL15,
       CAST(o.o_orderkey % 11 + 1 AS VARCHAR(20)) AS DISTANCE_GROUP,
       o.o_orderpriority AS DEP_BLOCK,
       c.c_mktsegment AS CARRIER_NAME,
       CASE WHEN o.o_orderkey % 17 = 0 THEN 'n/a'
            WHEN o.o_orderkey % 19 = 0 THEN ''
            ELSE CAST(o.o_orderkey % 30 AS VARCHAR(20)) END AS PLANE_AGE,
       n.n_name AS DEPARTING_AIRPORT,
       CASE WHEN o.o_orderkey % 23 = 0 THEN NULL
            ELSE concat('NATION_', CAST((c.c_nationkey + o.o_orderkey) % 25 AS VARCHAR(20))) END AS PREVIOUS_AIRPORT,
       CAST((o.o_orderkey % 8) * 0.25 AS VARCHAR(20)) AS PRCP,
       CAST((o.o_orderkey % 5) * 0.5 AS VARCHAR(20)) AS SNOW,
       CAST(o.o_totalprice AS VARCHAR(30)) AS AWND
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

# A raw line holds FLIGHT_ID in field 1, which the contract does not use.
FLIGHTS_LINES = """
SELECT concat_ws(',', MONTH, CAST(FLIGHT_ID AS VARCHAR(20)), coalesce(DEP_DEL15, ''), DISTANCE_GROUP,
                 DEP_BLOCK, '', '', '', CARRIER_NAME, '', '', '', '', '', '', '', PLANE_AGE,
                 DEPARTING_AIRPORT, '', '', coalesce(PREVIOUS_AIRPORT, ''), PRCP, SNOW, '', '', AWND) AS value
FROM flights_raw
"""

LINE_ID = {"FLIGHT_ID": (1, "bigint")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def flights_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: table(spark, sf_dir, name) for name in ("orders", "customer", "nation")}
    tables["orders"] = spread(tables["orders"])
    sql = FLIGHTS_RAW
    for name in tables:
        sql = sql.replace(f" {name} ", f" {{{name}}} ")
    return spark.sql(sql, **tables)


def flights_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(flights_raw(spark, sf_dir))


def lines_of(raw: DataFrame) -> DataFrame:
    return raw.sparkSession.sql(FLIGHTS_LINES.replace("flights_raw", "{raw}"), raw=raw)


def flights_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as a table of the full width of a line, so that its CSV can be replayed and scored."""
    raw = flights_raw(spark, sf_dir)
    held = {1: F.col("FLIGHT_ID").cast("string"), **{f.position: F.col(f.name) for f in FLIGHTS.fields}}
    empty = F.lit(None).cast("string")
    return raw.select(*[held.get(i, empty).alias(name) for i, name in enumerate(FLIGHTS.line_columns)])


def flights_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_of(flights_raw(spark, sf_dir))


def typed_of(raw: DataFrame) -> DataFrame:
    return project_cast(raw, FLIGHTS, keep=("FLIGHT_ID",))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))

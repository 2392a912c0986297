"""ANSI SQL giving the expected rows of the registered queries, for DuckDB."""

from __future__ import annotations

from tarmac.checks.fixtures import FLIGHTS_LINES, FLIGHTS_RAW
from tarmac.contract import FLIGHTS
from tarmac.operators.sampling import SAMPLE_RULE, SPLIT_RULE, threshold
from tarmac.operators.statistics import SMOOTHING

COLUMNS = ", ".join(FLIGHTS.columns)
INPUTS = ", ".join(FLIGHTS.inputs)
SQL_TYPES = {"int": "INTEGER", "double": "DOUBLE"}
VOCABULARY_ROWS = "CARRIER_NAME <> 'AUTOMOBILE' AND DEP_BLOCK <> '5-LOW'"


def _all_present(columns: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def _typed(columns) -> str:
    return ", ".join(
        f"TRY_CAST({f.name} AS {SQL_TYPES[f.type]}) AS {f.name}" if f.type in SQL_TYPES else f.name for f in columns
    )


def _bucket(rule: tuple[int, int, int]) -> str:
    multiplier, offset, modulus = rule
    return f"((FLIGHT_ID % {modulus}) * {multiplier} + {offset}) % {modulus}"


def _labels(source: str) -> str:
    parts = [f"SELECT '{c}' AS field, {c} AS label FROM {source}" for c in FLIGHTS.categorical]
    return f"""
SELECT field, label, count(*) AS n,
       CAST(row_number() OVER (PARTITION BY field ORDER BY count(*) DESC, label) - 1 AS DOUBLE) AS idx
FROM ({' UNION ALL '.join(parts)}) AS long
WHERE label IS NOT NULL
GROUP BY field, label"""


def _encoded(rows: str, vocabulary: str, columns: str) -> str:
    indexes, joins = [], []
    for i, (column, output) in enumerate(FLIGHTS.index_columns.items()):
        unseen = f"(SELECT count(*) FROM {vocabulary} WHERE field = '{column}')"
        indexes.append(f"CAST(coalesce(v{i}.idx, {unseen}) AS DOUBLE) AS {output}")
        joins.append(f"LEFT JOIN {vocabulary} v{i} ON v{i}.field = '{column}' AND v{i}.label = {column}")
    return f"SELECT FLIGHT_ID, {columns}, {', '.join(indexes)} FROM {rows} {' '.join(joins)}"


CTES = {
    "flights_raw": FLIGHTS_RAW,
    "flights_lines": FLIGHTS_LINES,
    "typed": f"SELECT FLIGHT_ID, {_typed(FLIGHTS.fields)} FROM flights_raw",
    "clean": f"SELECT * FROM typed WHERE {_all_present(FLIGHTS.columns)}",
    "scorable": f"SELECT * FROM typed WHERE {_all_present(FLIGHTS.inputs)}",
    "sampled": f"SELECT * FROM clean WHERE {_bucket(SAMPLE_RULE)} < {threshold(0.3, SAMPLE_RULE[2])}",
    "parts": f"""SELECT *, CASE WHEN {_bucket(SPLIT_RULE)} < {threshold(0.7, SPLIT_RULE[2])}
                 THEN 'train' ELSE 'test' END AS part FROM clean""",
    "vocabulary": _labels("clean"),
    "part_vocabulary": _labels(f"(SELECT * FROM clean WHERE {VOCABULARY_ROWS}) AS seen"),
    "encoded": _encoded("clean", "vocabulary", COLUMNS),
    "words": """SELECT word, count(*) AS n
                FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents) AS w
                WHERE word <> '' GROUP BY word""",
}


def _query(body: str) -> str:
    """``body`` behind the common table expressions."""
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())
    return f"WITH {ctes}\n{body}"


RAW_LINE = "concat_ws(',', CAST(FLIGHT_ID AS VARCHAR), " + ", ".join(f"coalesce({c}, '')" for c in FLIGHTS.columns) + ")"
FIELD_TEXTS = ", ".join(f"string_split(value, ',')[{f.position + 1}] AS {f.name}" for f in FLIGHTS.fields)
SLOTS = ", ".join(f"CAST({c} AS DOUBLE) AS slot_{i}" for i, c in enumerate(FLIGHTS.features))
MISSING = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in FLIGHTS.inputs) + ")"
CORRECT = "count(*) FILTER (WHERE (CASE WHEN AWND > 200000 THEN 1.0 ELSE 0.0 END) = DEP_DEL15)"

QUALITY = """SELECT count(*) FILTER (WHERE part = 'train') AS n_train,
              count(*) FILTER (WHERE part = 'test') AS n_test,
              (SELECT max(labels) FROM (SELECT count(*) AS labels FROM vocabulary GROUP BY field) AS sizes)
                  AS largest_vocabulary,
              TRUE AS {claim}
       FROM parts"""

SEEN = f"(SELECT * FROM clean WHERE {VOCABULARY_ROWS}) AS seen"


def _statistics(source: str, columns: list[str]) -> str:
    parts = [f"SELECT '{c}' AS field, {c} AS label, DEP_DEL15 AS target FROM {source}" for c in columns]
    return f"""SELECT field, label, count(*) AS n, sum(target) AS total
               FROM ({" UNION ALL ".join(parts)}) AS long WHERE label IS NOT NULL GROUP BY field, label"""


def _means(column: str) -> str:
    prior = f"(SELECT avg(DEP_DEL15) FROM {SEEN})"
    return f"""SELECT {column} AS label, (sum(DEP_DEL15) + {SMOOTHING} * {prior}) / (count(*) + {SMOOTHING}) AS mean
               FROM {SEEN} GROUP BY {column}"""


ORACLE = {
    "scan_csv": _query(
        "SELECT CAST(FLIGHT_ID AS VARCHAR) AS FLIGHT_ID, "
        + ", ".join(f"nullif({c}, '') AS {c}" for c in FLIGHTS.columns)
        + " FROM flights_raw"
    ),
    "scan_csv_by_name": _query(
        "SELECT CAST(FLIGHT_ID AS VARCHAR) AS FLIGHT_ID, "
        + ", ".join(f"nullif({c}, '') AS {c}" for c in FLIGHTS.columns)
        + " FROM flights_raw"
    ),
    "scan_lines": _query(f"SELECT {RAW_LINE} AS value FROM flights_raw"),
    "stream_source": _query("SELECT value FROM flights_lines"),
    "replay_sink": _query(f"SELECT {RAW_LINE} AS value FROM flights_raw"),
    "replay_stream": _query(
        "SELECT value, row_number() OVER (ORDER BY CAST(string_split(value, ',')[2] AS BIGINT)) - 1 AS line FROM flights_lines"
    ),
    "replay_staged": _query("SELECT value FROM flights_lines"),
    "project_cast": _query(f"SELECT FLIGHT_ID, {COLUMNS} FROM typed"),
    "drop_any_null": _query(f"SELECT FLIGHT_ID, {COLUMNS} FROM clean"),
    "drop_columns": _query(
        "SELECT FLIGHT_ID, MONTH, DISTANCE_GROUP, PLANE_AGE, PRCP, SNOW, AWND, "
        + ", ".join(FLIGHTS.indexes)
        + " FROM encoded"
    ),
    "parse_lines": _query(f"SELECT FLIGHT_ID, {COLUMNS} FROM typed"),
    "parse_wide_lines": _query(f"SELECT FLIGHT_ID, {COLUMNS} FROM typed"),
    "split_fields": _query(f"SELECT string_split(value, ',')[2] AS FLIGHT_ID, {FIELD_TEXTS} FROM flights_lines"),
    "sample_bernoulli_check": _query(
        "SELECT count(*) AS n_source, CAST(0 AS BIGINT) AS n_foreign, "
        "CAST(0 AS BIGINT) AS n_repeated, TRUE AS share_holds FROM clean"
    ),
    "sample_hash": _query(f"SELECT FLIGHT_ID, {COLUMNS} FROM sampled"),
    "sample_hash_nulls": "SELECT CAST(f AS DOUBLE) AS fraction, TRUE AS share_holds FROM (VALUES (0.1), (0.5), (0.9)) AS t(f)",
    "split_hash": _query("SELECT FLIGHT_ID, part FROM parts"),
    "split_random_cover": _query("SELECT FLIGHT_ID, CAST(1 AS BIGINT) AS n_parts FROM clean"),
    "row_count": _query("SELECT count(*) AS n FROM clean"),
    "vocab_fit": _query("SELECT field, label, n, idx FROM vocabulary"),
    "vocab_fit_distributed": _query("SELECT field, label, n, idx FROM vocabulary"),
    "vocab_generations": _query("SELECT field, label, n, idx FROM vocabulary"),
    "hot_labels": _query(
        """SELECT field, label, CAST(ceil(n / (total / 32.0)) AS INTEGER) AS shares
           FROM (SELECT *, sum(n) OVER (PARTITION BY field) AS total FROM vocabulary) AS counted
           WHERE n > total / 32.0"""
    ),
    "label_statistics": _query(_statistics("clean", FLIGHTS.categorical)),
    "encode_statistics": _query(
        f"""SELECT FLIGHT_ID,
              round(coalesce(d.mean, (SELECT avg(DEP_DEL15) FROM {SEEN})), 9) AS DepartingAirportIndex,
              round(coalesce(p.mean, (SELECT avg(DEP_DEL15) FROM {SEEN})), 9) AS PreviousAirportIndex
            FROM typed
            LEFT JOIN ({_means("DEPARTING_AIRPORT")}) d ON d.label = DEPARTING_AIRPORT
            LEFT JOIN ({_means("PREVIOUS_AIRPORT")}) p ON p.label = PREVIOUS_AIRPORT"""
    ),
    "vocab_roundtrip": _query("SELECT field, label, n, idx, idx AS loaded_idx FROM vocabulary"),
    "encode": _query(f"SELECT FLIGHT_ID, {', '.join(FLIGHTS.indexes)} FROM encoded"),
    "encode_keep": _query(_encoded("typed", "part_vocabulary", INPUTS)),
    "encode_join": _query(_encoded("typed", "part_vocabulary", INPUTS)),
    "encode_join_shuffled": _query(_encoded("typed", "part_vocabulary", INPUTS)),
    "assemble": _query(f"SELECT FLIGHT_ID, {SLOTS} FROM encoded"),
    "accuracy": _query(
        f"SELECT count(*) AS n, {CORRECT} AS n_correct, CAST({CORRECT} AS DOUBLE) / count(*) AS accuracy FROM clean"
    ),
    "preview_top": _query(f"SELECT FLIGHT_ID, {COLUMNS} FROM clean ORDER BY FLIGHT_ID LIMIT 100"),
    "word_count": _query("SELECT word, n FROM words ORDER BY word"),
    "word_count_files": _query("SELECT word, n FROM words ORDER BY word"),
    "model_roundtrip": _query("SELECT FLIGHT_ID, TRUE AS same_prediction FROM parts WHERE part = 'test'"),
    "artefact_roundtrip": _query("SELECT FLIGHT_ID, TRUE AS same_prediction FROM parts WHERE part = 'test'"),
    "rf_quality": _query(QUALITY.format(claim="nearly_always_right")),
    "rf_predict_bounds": _query("SELECT FLIGHT_ID, TRUE AS sound FROM parts WHERE part = 'test'"),
    "stream_score_bounds": _query("SELECT FLIGHT_ID, TRUE AS sound FROM scorable"),
    "lr_quality": _query(QUALITY.format(claim="beats_constant")),
    "stream_parse_filter": _query(f"SELECT FLIGHT_ID, {COLUMNS} FROM clean"),
    "stream_foreach_batch": _query(f"SELECT FLIGHT_ID, {COLUMNS} FROM scorable"),
    "stream_restart": _query(f"SELECT FLIGHT_ID, {COLUMNS} FROM scorable"),
    "stream_dead_letter": _query(
        f"""SELECT FLIGHT_ID, {MISSING} AS missing, value,
                   CASE WHEN {_all_present(FLIGHTS.inputs)} THEN 'good' ELSE 'dead' END AS route
            FROM typed
            JOIN (SELECT value, CAST(string_split(value, ',')[2] AS BIGINT) AS line_id FROM flights_lines) AS lines
              ON line_id = FLIGHT_ID"""
    ),
    "stream_committed": _query(
        f"""SELECT FLIGHT_ID, CASE WHEN {_all_present(FLIGHTS.inputs)} THEN 'good' ELSE 'dead' END AS route,
                   {MISSING} AS missing, {_all_present(FLIGHTS.inputs)} AS is_scored
            FROM typed"""
    ),
    "stream_model_switch": _query("SELECT FLIGHT_ID, TRUE AS same_prediction FROM scorable"),
    "stream_progress": _query(
        "SELECT (SELECT count(*) FROM scorable) AS good, (SELECT count(*) FROM typed) - (SELECT count(*) FROM scorable) AS dead, "
        "CAST(0 AS BIGINT) AS failed"
    ),
    "stream_score_parity": _query("SELECT FLIGHT_ID, TRUE AS same_prediction FROM scorable"),
}

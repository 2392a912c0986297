"""Projection, lenient typing, null filtering and line parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarmac.contract import FLIGHTS, Contract
from tarmac.functions.columns import all_usable, lenient, usable

# The CSV parser behind from_csv refuses a line with more columns than this. Such a
# line is cut behind the fields in use; the rest would be ignored anyway.
PARSER_COLUMNS = 20_480


def project_cast(df: DataFrame, contract: Contract = FLIGHTS, keep: tuple[str, ...] = ()) -> DataFrame:
    """The contract's columns, typed from text; ``keep`` names further columns to carry along."""
    typed = [lenient(F.col(f.name), f.type).alias(f.name) for f in contract.fields]
    extra = [name for name in keep if name not in contract.columns]
    return df.select(*[F.col(f"`{name}`") for name in extra], *typed)


def drop_any_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows whose ``columns`` (default: all) are all present.

    A conjunction of null tests rather than ``dropna``: each ``IS NOT NULL``
    can be pushed to the scan on its own. NaN counts as absent, as in ``dropna``.
    """
    wanted = df.columns if columns is None else columns
    types = dict(df.dtypes)
    return df.where(all_usable((c, types[c]) for c in wanted))


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """All columns but ``columns``, in their order."""
    return df.drop(*columns)


def _line_struct(value: Column, contract: Contract) -> Column:
    schema = ", ".join(f"`{c}` STRING" for c in contract.line_columns)
    head = F.substring_index(value, ",", contract.line_width)
    commas = F.length(value) - F.length(F.replace(value, F.lit(","), F.lit("")))
    # Without a quote in them the fields in use end at the first commas, so only other long lines are looked at in full.
    held = (
        F.when(F.octet_length(value) < PARSER_COLUMNS, value)
        .when(~F.contains(head, F.lit('"')), head)
        .when(commas < PARSER_COLUMNS, value)
        .otherwise(first_fields(value, contract.line_width))
    )
    return F.from_csv(held, schema, {"mode": "PERMISSIVE"})


def first_fields(value: Column, n: int) -> Column:
    """A line up to its field ``n``. Commas within quotes do not end a field; a quote without an end is text.

    The quantifiers are possessive: a field of any length is passed over once, without a stack.
    """
    field = r'(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^,]*+|[^,]*+)'
    return F.regexp_extract(value, f"(?s)^{field}(?:,{field}){{0,{n - 1}}}+", 0)


def parse_lines(
    lines: DataFrame,
    contract: Contract = FLIGHTS,
    keep: tuple[str, ...] = (),
    extra: dict[str, tuple[int, str]] | None = None,
    value: str = "value",
) -> DataFrame:
    """Typed rows from raw CSV lines, by position.

    A missing, empty or unparsable field becomes null; quoted commas are
    respected; surplus fields are ignored. Works on batch and streaming frames.
    ``keep`` names columns of ``lines`` to carry along (such as the raw value),
    ``extra`` maps a new column to its position and type.
    """
    names = contract.line_columns
    wanted = {**(extra or {}), **{f.name: (f.position, f.type) for f in contract.fields}}
    # A generator of one row per line keeps later filters above the parser. Pushed
    # below it, they would parse the line again for every column they test.
    fields = lines.select(*keep, F.inline(F.array(_line_struct(F.col(value), contract))))
    return fields.select(*keep, *[lenient(F.col(names[p]), t).alias(name) for name, (p, t) in wanted.items()])


def split_fields(
    lines: DataFrame,
    contract: Contract = FLIGHTS,
    extra: dict[str, int] | None = None,
    value: str = "value",
) -> DataFrame:
    """Raw field texts by a plain split on commas, quotes not respected.

    A position past the end of the line gives null; an empty field stays empty.
    """
    cut = lines.select(F.explode(F.array(F.split(F.col(value), ","))).alias("_parts"))
    positions = {**(extra or {}), **{f.name: f.position for f in contract.fields}}
    return cut.select(*[F.get("_parts", F.lit(p)).alias(name) for name, p in positions.items()])


def required_columns(contract: Contract, require_label: bool) -> list[str]:
    return contract.columns if require_label else contract.inputs


def with_validity(df: DataFrame, contract: Contract = FLIGHTS, require_label: bool = False) -> DataFrame:
    """Add ``is_valid`` and ``missing``, the comma-joined names of the absent columns."""
    types = dict(df.dtypes)
    required = required_columns(contract, require_label)
    missing = [F.when(~usable(c, types[c]), F.lit(c)) for c in required]
    return df.withColumns(
        {
            "is_valid": all_usable((c, types[c]) for c in required),
            "missing": F.concat_ws(",", *missing),
        }
    )

"""The record contract shared by training, batch scoring and stream scoring.

Everything that must agree between training and serving is derived from one
frozen ``Contract``: column names and types, positions in a raw line, the
label, and above all the order of the slots in the feature vector.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}


@dataclass(frozen=True)
class Field:
    position: int
    name: str
    type: str


@dataclass(frozen=True)
class Contract:
    fields: tuple[Field, ...]
    line_width: int
    label: str
    index_columns: dict[str, str]
    vector: str = "Features"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def categorical(self) -> list[str]:
        return list(self.index_columns)

    @property
    def indexes(self) -> list[str]:
        return list(self.index_columns.values())

    @property
    def inputs(self) -> list[str]:
        """Columns a record needs before it can be scored: all but the label."""
        return [c for c in self.columns if c != self.label]

    @property
    def features(self) -> list[str]:
        """Vector slots in their pinned order: numeric columns, then indexes."""
        numeric = [c for c in self.inputs if c not in self.index_columns]
        return numeric + self.indexes

    @property
    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, TYPES[f.type]) for f in self.fields])

    @property
    def line_columns(self) -> list[str]:
        """One name per position of a raw line; unused positions are ``_c<i>``."""
        names = {f.position: f.name for f in self.fields}
        return [names.get(i, f"_c{i}") for i in range(self.line_width)]

    @property
    def line_schema(self) -> T.StructType:
        """All-string schema of a raw line."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.line_columns])


# Position in a line, column name and type of every field in use,
# the label, the index column of every categorical, and the width of a line.
FLIGHTS = Contract(
    fields=(
        Field(0, "MONTH", "int"),
        Field(2, "DEP_DEL15", "double"),
        Field(3, "DISTANCE_GROUP", "double"),
        Field(4, "DEP_BLOCK", "string"),
        Field(8, "CARRIER_NAME", "string"),
        Field(16, "PLANE_AGE", "int"),
        Field(17, "DEPARTING_AIRPORT", "string"),
        Field(20, "PREVIOUS_AIRPORT", "string"),
        Field(21, "PRCP", "double"),
        Field(22, "SNOW", "double"),
        Field(25, "AWND", "double"),
    ),
    line_width=26,
    label="DEP_DEL15",
    index_columns={
        "DEP_BLOCK": "DepBlockIndex",
        "CARRIER_NAME": "CarrierNameIndex",
        "DEPARTING_AIRPORT": "DepartingAirportIndex",
        "PREVIOUS_AIRPORT": "PreviousAirportIndex",
    },
)

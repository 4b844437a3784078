"""The three price-history datasets and their fixed, wide schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

# The grains a stored period can have, coarsest first, and the
# length of a period name ("2024", "2024-01", "2024-01-05") that marks each.
GRAINS = ("year", "month", "day")
NAME_LENGTH = {"year": 4, "month": 7, "day": 10}

_TYPES = {
    "string": StringType(),
    "timestamp_ntz": TimestampNTZType(),
    "bigint": LongType(),
    "double": DoubleType(),
}


@dataclass(frozen=True)
class Dataset:
    """One dataset: its stored schema, time column and text layout."""

    name: str
    time: str
    ddl: str
    text_ddl: str

    @property
    def schema(self) -> StructType:
        parts = [column.split() for column in self.ddl.split(", ")]
        return StructType([StructField(name, _TYPES[kind]) for name, kind in parts])

    @property
    def text_fields(self) -> list[tuple[str, str]]:
        """(name, type) of the tab-separated fields of a text line."""
        return [tuple(part.split()) for part in self.text_ddl.split(", ")]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def key(self) -> list[str]:
        return ["symbol", self.time]

    @property
    def values(self) -> list[str]:
        return [c for c in self.columns if c not in self.key]

    @property
    def floats(self) -> list[str]:
        return [f.name for f in self.schema if f.dataType.typeName() == "double"]

    @property
    def intraday(self) -> bool:
        return self.time == "dt"

    def canonical(self, df: DataFrame, *extra: str) -> DataFrame:
        """Select the stored columns in order, cast to the stored types."""
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        return df.select(*cols, *extra)


KR_1D = Dataset(
    "KR-1d",
    "date",
    "symbol string, date timestamp_ntz, open bigint, high bigint, low bigint, close bigint, volume bigint",
    "symbol string, open bigint, high bigint, low bigint, close bigint, volume bigint",
)
KR_1M = Dataset(
    "KR-1m",
    "dt",
    "symbol string, dt timestamp_ntz, price bigint, volume bigint",
    "symbol string, price bigint, volume bigint, time string",
)
US_5M = Dataset(
    "US-5m",
    "dt",
    "symbol string, dt timestamp_ntz, price double, volume bigint",
    "symbol string, price double, volume double, time string",
)

DATASETS = {d.name: d for d in (KR_1D, KR_1M, US_5M)}


def dataset(which: str | Dataset) -> Dataset:
    """Look a dataset up by name; a Dataset passes through."""
    return which if isinstance(which, Dataset) else DATASETS[which]

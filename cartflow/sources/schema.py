"""Canonical event schema and the data-quality predicates (V1-V4).

The checks look at the schema only (no Spark job) except ``is_non_empty``,
which runs a one-row probe (``isEmpty``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartflow.functions.labels import REQUIRED_EVENT_COLUMNS

# Canonical cleaned events.  Times are wall-clock (no zone), like the
# source data; ``event_id`` is optional and only serves as a tie-breaker.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)


def raw_string_schema(columns: Iterable[str]) -> T.StructType:
    """All-STRING schema for a CSV header (types are applied by try_cast)."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


class EventSchemaError(ValueError):
    """The input does not have the shape of event data; ``problems`` says why."""

    def __init__(self, problems: list[str]):
        self.problems = problems
        super().__init__("not event data: " + "; ".join(problems))


def absent_fields(names: Iterable[str], needed: Iterable[str] = REQUIRED_EVENT_COLUMNS) -> list[str]:
    """V1: the needed names that ``names`` lacks, in alphabetical order."""
    have = frozenset(names)
    return sorted(n for n in needed if n not in have)


def covers(names: Iterable[str], needed: Iterable[str] = REQUIRED_EVENT_COLUMNS) -> bool:
    """V2: whether all needed names are there."""
    return frozenset(needed) <= frozenset(names)


def has_rows(df: DataFrame) -> bool:
    """V3: whether there is a row at all (a probe for one, not a count)."""
    return not df.isEmpty()


def schema_problems(df: DataFrame) -> list[str]:
    """What keeps ``df`` from being typed event data, from its schema alone: fields
    that are missing, or whose type cannot be read as the canonical one."""
    missing = absent_fields(df.columns)
    found = [f"no field {name}" for name in missing]
    for field in EVENT_SCHEMA:
        if field.name in missing:
            continue
        kind = df.schema[field.name].dataType
        text = isinstance(kind, T.StringType)
        number = isinstance(kind, T.NumericType) and isinstance(field.dataType, T.NumericType)
        time = isinstance(kind, (T.TimestampType, T.TimestampNTZType)) and field.name == "event_time"
        if not (text or number or time or kind == field.dataType):
            found.append(f"{field.name} is {kind.simpleString()}, not {field.dataType.simpleString()}")
    return found


def check_events(df: DataFrame) -> DataFrame:
    """V4: ``df`` itself if it is event data with rows; schema faults are reported
    before any row is read."""
    problems = schema_problems(df)
    if not problems and not has_rows(df):
        problems.append("no rows")
    if problems:
        raise EventSchemaError(problems)
    return df

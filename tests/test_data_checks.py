import pytest

from cartflow.functions.labels import REQUIRED_EVENT_COLUMNS
from cartflow.sources.schema import (
    EVENT_SCHEMA,
    EventSchemaError,
    absent_fields,
    check_events,
    covers,
    has_rows,
    schema_problems,
)


def test_names():
    assert absent_fields(REQUIRED_EVENT_COLUMNS) == [] and covers(REQUIRED_EVENT_COLUMNS)
    some = [c for c in REQUIRED_EVENT_COLUMNS if c not in ("price", "brand")] + ["extra"]
    assert absent_fields(some) == ["brand", "price"] and not covers(some)


def test_schema_faults_come_before_rows(spark):
    df = spark.createDataFrame([(True, 1)], "event_time boolean, user_id int")
    problems = schema_problems(df)
    assert "no field brand" in problems and "event_time is boolean, not timestamp_ntz" in problems
    assert not any("user_id" in p for p in problems)
    with pytest.raises(EventSchemaError) as error:
        check_events(df.limit(0))
    assert error.value.problems == problems


def test_rows(spark):
    empty = spark.createDataFrame([], EVENT_SCHEMA)
    assert schema_problems(empty) == [] and not has_rows(empty)
    with pytest.raises(EventSchemaError, match="no rows"):
        check_events(empty)
    one = spark.createDataFrame([tuple([None] * len(EVENT_SCHEMA))], EVENT_SCHEMA)
    assert check_events(one) is one
    text = one.select(*[one[c].cast("string").alias(c) for c in one.columns])
    assert schema_problems(text) == []

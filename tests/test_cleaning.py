import datetime as dt

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from contest_analytics.functions import cleaning


def test_coerce_turns_unparsable_text_into_null(rows):
    raw = rows("k string, v string, other string", ("7", "1.0", "a"), ("x", " 5 ", "b"), (None, "9999999999", "c"))
    typed = cleaning.coerce(raw, {"k": "bigint", "v": "int"})
    assert typed.dtypes == [("k", "bigint"), ("v", "int"), ("other", "string")]
    assert [tuple(r) for r in typed.collect()] == [(7, 1, "a"), (None, 5, "b"), (None, None, "c")]


def test_whole_numbers_with_a_decimal_point(rows):
    raw = rows("v string", ("1500.0",), ("1234567890123456789.0",), ("1234567890123456789",), ("1e30",), ("x",), ("-3.9",))
    got = [r.v for r in cleaning.coerce(raw, {"v": "bigint"}).collect()]
    assert got == [1500, 1234567890123456789, 1234567890123456789, None, None, -3]


@pytest.mark.parametrize(
    "text, wide, narrow, flag",
    [
        ("1", True, True, 1),
        ("true", True, True, 1),
        ("True", True, True, 1),
        ("TRUE", True, None, 1),
        (" \tYes\n", True, None, 1),
        ("y", True, None, 1),
        ("0", False, False, 0),
        ("False", False, False, 0),
        ("No", False, None, 0),
        ("maybe", None, None, 0),
        ("", None, None, 0),
        (None, None, None, 0),
    ],
)
def test_bool_normalize(rows, text, wide, narrow, flag):
    got = (
        rows("v string", (text,))
        .select(
            cleaning.bool_normalize("v"),
            cleaning.bool_normalize("v", ("1", "true", "True"), ("0", "false", "False"), fold=False),
            cleaning.flag_normalize("v"),
        )
        .first()
    )
    assert tuple(got) == (wide, narrow, flag)


def test_bool_normalize_accepts_typed_columns(rows):
    df = rows("b boolean, i int", (True, 0), (False, 1), (None, 2))
    got = df.select(cleaning.bool_normalize("b"), cleaning.bool_normalize("i")).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (None, None)]


def test_time_parts_uses_first_present_candidate(rows):
    raw = rows("match_start_time string, start_time string", ("2020-01-31 10:00:00", "2021-05-06 07:08:09"), (None, "zz"))
    got = cleaning.time_parts(raw).select("yr", "mo").collect()
    assert [tuple(r) for r in got] == [(2021, 5), (None, None)]


def test_time_parts_without_candidate_gives_nulls(rows):
    got = cleaning.time_parts(rows("k int", (1,))).first()
    assert (got.yr, got.mo) == (None, None)


def test_time_parts_of_timestamps(rows):
    got = cleaning.time_parts(rows("start_time timestamp", (dt.datetime(2022, 12, 1, 5),))).first()
    assert (got.yr, got.mo) == (2022, 12)


def test_drop_null_keys(rows):
    df = rows("a int, b int", (1, 2), (None, 2), (1, None))
    assert cleaning.drop_null_keys(df, ["a", "b"]).count() == 1
    assert cleaning.drop_null_keys(df, "a").count() == 2


def test_fill_defaults_also_replaces_nan(rows):
    df = rows("a int, d double", (None, float("nan")), (3, 1.5))
    assert [tuple(r) for r in cleaning.fill_defaults(df, {"a": 5, "d": 30}).collect()] == [(5, 30.0), (3, 1.5)]


def test_fill_defaults_keeps_other_columns(rows):
    df = rows("a int, b int", (None, None)).withColumn("c", F.lit(None).cast("int"))
    assert as_dicts(cleaning.fill_defaults(df, {"a": 1})) == [{"a": 1, "b": None, "c": None}]

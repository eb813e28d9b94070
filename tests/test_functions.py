from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import at, changed, cutoff, midnight, stamp14
from tidemark.functions.status import any_right, status_of, yes_no
from tidemark.functions.text import (
    blank_to_null,
    capped,
    first_match,
    joined,
    nth_position,
    piece,
    position,
    replace_pattern,
    replace_text,
    text_before,
)


def value(spark, column, s="a,b,,c"):
    return spark.createDataFrame([(s, None)], "s string, n string").select(column).first()[0]


@pytest.mark.parametrize(
    ("column", "expected"),
    [
        (lambda: joined("s", "n"), "a,b,,c"),
        (lambda: joined("n", "n"), None),
        (lambda: first_match("s", "[b-z]"), "b"),
        (lambda: first_match("s", "[0-9]"), None),
        (lambda: replace_pattern("s", "[a-c]", "x"), "x,x,,x"),
        (lambda: replace_pattern("s", ".*", ""), None),
        (lambda: replace_text("s", ","), "abc"),
        (lambda: replace_text("s", ",", ";"), "a;b;;c"),
        (lambda: piece("s", 3, 1), "b"),
        (lambda: piece("s", 3, 0), None),
        (lambda: piece("s", 1, -2), None),
        (lambda: piece("s", 3, 100), "b,,c"),
        (lambda: piece("s", 9, 2), None),
        (lambda: piece("n", 1, 2), None),
        (lambda: position("s", ","), 2),
        (lambda: position("s", "z"), 0),
        (lambda: nth_position("s", ",", 1), 2),
        (lambda: nth_position("s", ",", 3), 5),
        (lambda: nth_position("s", ",", 4), 0),
        (lambda: nth_position("n", ",", 1), None),
        (lambda: text_before("s", ",,"), "a,b"),
        (lambda: text_before("s", "a"), None),
        (lambda: text_before("s", "PCT"), None),
        (lambda: text_before("n", "PCT"), None),
        (lambda: capped("s", 3), "a,b"),
        (lambda: blank_to_null(F.lit("")), None),
        (lambda: yes_no("n"), "N"),
        (lambda: yes_no("s"), "a,b,,c"),
    ],
)
def test_text(spark, column, expected):
    assert value(spark, column()) == expected


def test_nth_position_at_the_end(spark):
    assert value(spark, nth_position("s", ",", 2), "a,b,") == 4


@pytest.mark.parametrize(
    ("codes", "approved", "expected"),
    [
        (("A", "A"), ..., "OK"),
        (("A", "D"), ..., "BLIND"),
        (("A", None), ..., "BLIND"),
        ((None,), ..., "BLIND"),
        (("A",), ..., "OK"),
        (("A", "A"), "Y", "OK"),
        (("A", "A"), None, "BLIND"),
        (("A", "A"), "N", "BLIND"),
    ],
)
def test_status(spark, codes, approved, expected):
    columns = [F.lit(c).cast("string") for c in codes]
    column = status_of(*columns, approved=None if approved is ... else F.lit(approved).cast("string"))
    assert value(spark, column) == expected


def test_any_right(spark):
    df = spark.createDataFrame([(1, "Y"), (2, "N"), (3, "Y"), (2, None), (1, "N")], "service_id long, right_yn string")
    assert [tuple(r) for r in df.where(any_right((1, 2))).collect()] == [(1, "Y")]


def test_cutoff():
    as_of = datetime(2024, 1, 10, 9, 0)
    assert cutoff(as_of) == datetime(2024, 1, 9)
    assert cutoff(as_of, 0) == datetime(2024, 1, 10)
    assert cutoff(as_of, -0.5) == datetime(2024, 1, 9)
    assert cutoff(as_of, -0.25) == datetime(2024, 1, 10)
    assert cutoff(as_of, -30) == datetime(2023, 12, 11)


def test_changed_is_strict_and_ignores_null(spark):
    cut = datetime(2024, 1, 9)
    data = [
        (1, cut, None), (2, datetime(2024, 1, 9, 0, 0, 1), None), (3, None, None),
        (4, None, datetime(2024, 2, 1)), (5, datetime(2020, 1, 1), datetime(2020, 1, 1)),
    ]
    df = spark.createDataFrame(data, "id long, crt_dt timestamp_ntz, upd_dt timestamp_ntz")
    assert sorted(r[0] for r in df.where(changed(cut, "crt_dt", "upd_dt")).collect()) == [2, 4]
    assert sorted(r[0] for r in df.where(changed(cut, "upd_dt")).collect()) == [4]


def test_stamps_do_not_depend_on_the_time_zone(spark):
    moment = datetime(2024, 3, 31, 2, 30, 15)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Berlin", "Asia/Seoul"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = spark.range(1).select(at(moment), stamp14(at(moment)), midnight(at(moment))).first()
            assert tuple(row) == (moment, "20240331023015", datetime(2024, 3, 31))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)

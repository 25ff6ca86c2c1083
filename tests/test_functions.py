"""Scalar functions on the literal cases their users rely on."""

import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from seriesmart.functions import dates, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head()[0]


def lit_date(value):
    return F.lit(value).cast("date")


@pytest.mark.parametrize(
    "start, end, unit, expected",
    [
        ("2026-01-31", "2026-03-01", "month", 2),
        ("2026-01-31", "2026-02-01", "month", 1),
        ("2025-12-31", "2026-01-01", "year", 1),
        ("2025-12-31", "2026-01-01", "quarter", 1),
        ("2026-01-01", "2026-03-31", "quarter", 0),
        ("2026-01-01", "2026-01-08", "day", 7),
        ("2026-03-01", "2026-01-31", "month", -2),
    ],
)
def test_periods_count_boundaries(spark, start, end, unit, expected):
    assert one(spark, dates.periods_between(lit_date(end), lit_date(start), unit)) == expected


def test_calendar_expressions(spark):
    day = lit_date("2026-09-27")  # a Sunday
    assert one(spark, dates.date_key(day)) == 20260927
    assert one(spark, dates.is_weekend(day)) is True
    assert one(spark, dates.day_name(day)) == "Sunday"
    assert one(spark, dates.month_name(day)) == "September"


def test_zone_date_shifts_the_day(spark):
    instant = F.lit("2026-01-01 02:00:00").cast("timestamp")
    assert one(spark, dates.zone_date(instant, "America/Santiago")) == date(2025, 12, 31)
    assert one(spark, dates.zone_date(instant, "UTC")) == date(2026, 1, 1)


def test_zone_date_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        instant = F.timestamp_seconds(F.lit(1767232800))  # 2026-01-01T02:00:00Z
        assert one(spark, dates.zone_date(instant, "America/Santiago")) == date(2025, 12, 31)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("100", 100.0),
        (" 1e2 ", 100.0),
        ("inf", float("inf")),
        ("-Infinity", float("-inf")),
        ("invalid", None),
        ("1d", None),
        ("1F ", None),
        ("NaN", None),
        ("", None),
        (None, None),
    ],
)
def test_lenient_number(spark, raw, expected):
    assert one(spark, text.lenient_number(F.lit(raw).cast("string"))) == expected


def test_lenient_date(spark):
    assert one(spark, text.lenient_date(F.lit("2026-01-05 10:00:00"))) == date(2026, 1, 5)
    assert one(spark, text.lenient_date(F.lit("2026-02-30"))) is None
    assert one(spark, text.lenient_date(F.lit("n/a"))) is None


def test_redaction_covers_every_token(spark):
    url = "GET https://api.test/?user=a&token=s3cret&firstdate=2026 and TOKEN=other'x"
    assert one(spark, text.redact_tokens(F.lit(url))) == (
        "GET https://api.test/?user=a&token=***&firstdate=2026 and TOKEN=***'x"
    )


def test_short_message_keeps_the_limit(spark):
    capped = one(spark, text.short_message(F.lit("x" * 50_000)))
    assert len(capped) == 1000 and capped.endswith(text.MESSAGE_SUFFIX)
    assert one(spark, text.short_message(F.lit("x" * 1000))) == "x" * 1000
    assert one(spark, text.short_message(F.lit(None).cast("string"))) is None


def test_run_ids(spark):
    at = F.lit("2026-10-05 22:57:11.123456").cast("timestamp")
    assert one(spark, text.timestamp_run_id(at)) == "20261005T225711123456Z"
    first = one(spark, text.run_id(at))
    stamp, suffix = first.split("-")
    assert stamp == "20261005T225711123456Z"
    assert len(suffix) == 8 and int(suffix, 16) >= 0
    assert one(spark, text.run_id(at)) != first


def test_surrogate_key_spells_out_nulls(spark):
    expected = hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()
    assert one(spark, text.surrogate_key(F.lit("a"), F.lit(None).cast("string"))) == expected


def test_label_value(spark):
    label = one(spark, text.label_value(F.lit("Manual__2026-10-05T22:57:11+00:00" + "x" * 80)))
    assert label.startswith("manual__2026-10-05t22_57_11_00_00") and len(label) == 63


def test_hours_since_rounds_to_one_decimal(spark):
    assert one(spark, dates.hours_since(F.lit("2026-01-02 00:00:00"), F.lit("2025-12-31 21:33:00"))) == 26.5
    assert one(spark, dates.hours_since(F.lit("2026-01-02 00:00:00"), F.lit(None))) is None


def test_safe_divide_and_finite(spark):
    assert one(spark, text.safe_divide(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, text.not_finite(F.lit(float("nan")))) is True
    assert one(spark, text.not_finite(F.lit(float("-inf")))) is True
    assert one(spark, text.not_finite(F.lit(1.5))) is False
    assert one(spark, text.not_finite(F.lit(None).cast("double"))) is None


def test_seconds_between(spark):
    start, end = (F.lit(t).cast("timestamp") for t in ("2026-01-01 00:00:00", "2026-01-01 00:01:30"))
    assert one(spark, dates.seconds_between(end, start)) == 90


def test_label_search(spark):
    labels = spark.sql("SELECT array(struct('run_id' AS key, '20261003t1' AS value)) AS labels")
    assert labels.filter(text.has_label("labels", "run_id", "20261003t%")).count() == 1
    assert labels.filter(text.has_label("labels", "pipeline", "20261003t%")).count() == 0


def test_datetime_literal_round_trip(spark):
    assert one(spark, F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")) == datetime(2026, 1, 1)

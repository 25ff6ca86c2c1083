"""Every join strategy, and the split windows, against brute force."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from collecting import collected
from seriesmart.operators import asof, digests, joins, scd2, windows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, some NULL keys, some without a lookup row."""
    rng = random.Random(7)
    data = [("hot" if i % 3 == 0 else rng.choice([None, *"abcdefg"]), i, i * 1.5) for i in range(3000)]
    rows = spark.createDataFrame(data, "k string, id long, v double").repartition(6)
    lookup = spark.createDataFrame(
        [("hot", 10, 100), ("a", 20, 200), ("b", 30, 300), ("c", 40, 400), ("zz", 50, 500)],
        "k string, w long, top long",
    )
    return data, rows, lookup


@pytest.fixture(params=["broadcast", "shuffle"])
def strategy(request, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_strategies_agree(skewed, strategy, how):
    data, rows, lookup = skewed
    known = {"hot": 10, "a": 20, "b": 30, "c": 40}
    got = collected(joins.lookup_join(rows, lookup, "k", how))
    if how == "inner":
        expected = [(k, i, v, known[k], known[k] * 10) for k, i, v in data if k in known]
    elif how == "left":
        expected = [
            (k, i, v, known.get(k), known[k] * 10 if k in known else None) for k, i, v in data
        ]
    elif how == "left_semi":
        expected = [row for row in data if row[0] in known]
    else:
        expected = [row for row in data if row[0] not in known]
    assert got == sorted(expected, key=repr)


def test_lookup_join_residual_condition(skewed, strategy):
    data, rows, lookup = skewed
    known = {"hot": 100, "a": 200, "b": 300, "c": 400}
    joined = joins.lookup_join(rows, lookup, ["k"], "inner", condition=F.col("id") < F.col("top"))
    assert joined.columns == ["k", "id", "v", "w", "top"]
    assert collected(joined, "k", "id") == sorted(
        ((k, i) for k, i, _ in data if k in known and i < known[k]), key=repr
    )


def test_lookup_join_reads_the_large_side_once(skewed, tmp_path, spark):
    _, rows, lookup = skewed
    rows.write.parquet(str(tmp_path / "rows"))
    plan = joins.lookup_join(spark.read.parquet(str(tmp_path / "rows")), lookup, "k")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Relation") == 1


def test_null_keys_do_not_meet_in_one_task(spark):
    rows = spark.range(4000).select(F.expr("if(id % 10 = 0, 'a', null)").alias("k"), "id")
    lookup = spark.createDataFrame([("a", 1)], "k string, w int")
    threshold, coalesce = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled"
    before = {name: spark.conf.get(name) for name in (threshold, coalesce)}
    spark.conf.set(threshold, "-1")
    spark.conf.set(coalesce, "false")
    try:
        joined = joins.lookup_join(rows, lookup, "k")
        placed = joined.select("k", F.spark_partition_id().alias("p")).collect()
        sizes = Counter(r.p for r in placed if r.k is None).values()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 3600 and max(sizes) < 1800


def test_unknown_join_type(skewed):
    _, rows, lookup = skewed
    with pytest.raises(ValueError):
        joins.lookup_join(rows, lookup, "k", "full_outer")


def test_as_of_join_picks_one_version(rows):
    history = rows(
        "k string, valid_from timestamp, valid_to timestamp, x int",
        ("a", datetime(2020, 1, 1), datetime(2021, 1, 1), 1),
        ("a", datetime(2021, 1, 1), None, 2),
        ("b", datetime(2022, 1, 1), datetime(2022, 6, 1), 3),
    )
    seen = rows(
        "k string, at timestamp",
        ("a", datetime(2019, 12, 31)),
        ("a", datetime(2020, 12, 31, 23)),
        ("a", datetime(2021, 1, 1)),
        ("b", datetime(2023, 1, 1)),
    )
    got = asof.as_of_join(seen, history, "k", "at")
    assert collected(got, "k", "x") == sorted([("a", None), ("a", 1), ("a", 2), ("b", None)], key=repr)


def test_orphans_and_missing_children(rows):
    children = rows("k string", ("a",), ("a",), ("x",), (None,))
    parents = rows("k string", ("a",), ("b",))
    assert collected(joins.orphans(children, parents, "k")) == [("x",)]
    assert collected(joins.missing_children(parents, children, "k")) == [("b",)]


def test_reconcile_names_each_difference(rows):
    schema = "k string, d int, value double, run string"
    nan = float("nan")
    expected = rows(schema, ("a", 1, 1.0, "r"), ("a", 2, 2.0, "r"), ("a", 3, 3.0, None), ("a", 5, nan, "r"), ("a", 6, 1.0, None))
    actual = rows(schema, ("a", 2, 2.5, "r"), ("a", 3, 3.0, "q"), ("a", 4, 4.0, "r"), ("a", 5, nan, "r"), ("a", 6, 1.0, None))
    got = joins.reconcile(expected, actual, ["k", "d"], "value", "run")
    assert collected(got, "d", "issue") == [
        (1, "missing from fact"),
        (2, "value differs"),
        (3, "ingestion run differs"),
        (4, "not in staging"),
    ]


@pytest.mark.parametrize("forward", [False, True])
def test_split_shift_equals_plain_window(spark, forward):
    """Random series over decades with empty years, one of them hot, one with a NULL key."""
    rng = random.Random(3)
    data = []
    for key, share in (("hot", 0.5), ("thin", 0.002), (None, 0.05), ("one", 0)):
        days = [date(1990, 1, 1) + timedelta(i) for i in range(0, 9000) if rng.random() < share]
        days = [d for d in days if d.year not in (1995, 1996, 2003)] or [date(2001, 5, 5)]
        data += [(key, d, rng.choice([None, rng.random()])) for d in days]
    rows = spark.createDataFrame(data, "k string, d date, v double").repartition(5)
    got = windows.shifted(rows, ["k"], "d", {"d": "other_d", "v": "other_v"}, forward=forward)
    assert got.columns == ["k", "d", "v", "other_d", "other_v"]
    expected = []
    for key in {k for k, _, _ in data}:
        series = sorted(
            ((d, v) for k, d, v in data if k == key), key=lambda x: x[0]
        )
        for i, (d, v) in enumerate(series):
            j = i + 1 if forward else i - 1
            other = series[j] if 0 <= j < len(series) else (None, None)
            expected.append((key, d, v, *other))
    assert collected(got) == sorted(expected, key=repr)


def test_rows_are_sorted_once_for_window_and_join(spark, rows):
    data = rows("k string, d date, v double", *[(f"k{i % 7}", date(2020, 1, 1) + timedelta(days=i), float(i)) for i in range(60)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = windows.shifted(data, ["k"], "d", {"v": "previous"})
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Sort [_part" not in plan
        assert found.filter("previous = v - 7").count() == 53
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_percent_change_flags_and_passes(rows):
    observations = rows(
        "series_code string, observation_date date, value double",
        ("s", date(2026, 1, 1), 100.0),
        ("s", date(2026, 1, 2), None),
        ("s", date(2026, 1, 3), 110.0),  # exactly ten percent passes
        ("s", date(2026, 1, 4), 0.0),
        ("s", date(2026, 1, 5), 50.0),  # previous value zero: no ratio
        ("s", date(2027, 1, 5), 56.0),
        ("t", date(2026, 1, 1), float("nan")),
        ("t", date(2026, 1, 2), 1.0),
    )
    got = windows.change_over_limit(observations)
    assert collected(got, "observation_date", "change_pct") == [
        (date(2026, 1, 4), -100.0),
        (date(2027, 1, 5), 12.0),
    ]


def test_gaps_by_frequency(rows):
    schema = "series_code string, frequency string, observation_date date, value double"
    got = windows.gaps(
        rows(
            schema,
            ("d", "daily", date(2026, 1, 1), 1.0),
            ("d", "daily", date(2026, 1, 8), 1.0),
            ("d", "daily", date(2026, 1, 16), 1.0),
            ("m", "monthly", date(2026, 1, 31), 1.0),
            ("m", "monthly", date(2026, 2, 1), 1.0),
            ("m", "monthly", date(2026, 3, 1), None),
            ("m", "monthly", date(2026, 4, 1), 1.0),
            ("y", "annual", date(2020, 1, 1), 1.0),
            ("y", "annual", date(2021, 12, 31), 1.0),
            ("w", "weekly", date(2020, 1, 1), 1.0),
            ("w", "weekly", date(2025, 1, 1), 1.0),
        )
    )
    assert collected(got, "series_code", "observation_date", "gap_days") == [
        ("d", date(2026, 1, 16), 8),
        ("m", date(2026, 4, 1), 59),
    ]


def test_version_overlaps(rows):
    def at(day):
        return datetime(2026, 1, day)

    got = windows.version_overlaps(
        rows(
            "series_code string, valid_from timestamp, valid_to timestamp",
            ("ok", at(1), at(5)),
            ("ok", at(7), None),
            ("open", at(1), None),
            ("open", at(3), None),
            ("over", at(1), at(5)),
            ("over", at(4), None),
            ("back", at(5), at(5)),
        )
    )
    assert collected(got, "series_code", "issue") == [
        ("back", "ends before it starts"),
        ("open", "superseded version still current"),
        ("over", "overlaps next version"),
    ]


def test_not_sequential(rows):
    days = rows("date_day date", (date(2025, 12, 31),), (date(2026, 1, 1),), (date(2026, 1, 3),))
    assert collected(windows.not_sequential(days)) == [(date(2026, 1, 3), date(2026, 1, 1))]


def test_duplicate_ordinals_count_unreadable_dates_as_one_value(rows):
    got = windows.duplicate_ordinals(
        rows("k string, observation_date date", ("a", None), ("a", None), ("a", date(2026, 1, 1))), "k"
    )
    assert collected(got) == [("a", 1)]

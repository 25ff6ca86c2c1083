"""As-of streams, digest trees and folded loads against plain definitions, and odd rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from collecting import collected
from seriesmart.operators import asof, digests, joins, scd2, windows

START = datetime(2020, 1, 1)


def instant(hours):
    return START + timedelta(hours=hours)


# -- as-of ---------------------------------------------------------------------

ROWS = "n int, k string, j int, at timestamp, held string"
VERSIONS = "k string, j int, valid_from timestamp, valid_to timestamp, x int"


def brute_as_of(rows, versions, how="left"):
    out = []
    for n, k, j, at, held in rows:
        found = [
            v for v in versions
            if None not in (k, j, at, v[2]) and v[:2] == (k, j) and v[2] <= at and (v[3] is None or at < v[3])
        ]
        assert len(found) < 2
        if found or how == "left":
            out.append((n, k, j, at, held, found[0][4] if found else None))
    return sorted(out, key=repr)


def random_history(rng, keys):
    versions, x = [], 0
    for k, j in keys:
        at = rng.randrange(3000)
        for _ in range(rng.choice([0, 1, 3, 40])):
            end = at + rng.choice([0, 1, 5, 900, 4000])
            last = rng.random() < 0.05
            versions.append((k, j, instant(at), None if last else instant(end), x))
            x += 1
            if last:
                break
            if rng.random() < 0.2:
                versions.append((k, j, instant(end + 3), instant(end), -x))  # ends before it starts
            at = end + rng.choice([0, 0, 7, 2000])
    return versions


@pytest.mark.parametrize("bucket", ["day", "month", "year"])
def test_as_of_matches_brute_force(rows, bucket):
    rng = random.Random(bucket)
    keys = [(k, j) for k in "abc" for j in (1, 2)]
    versions = random_history(rng, keys) + [(None, 1, instant(0), None, 7), ("a", None, instant(0), None, 8), ("a", 1, None, None, 9)]
    starts = [v[2] for v in versions if v[2]]
    seen = []
    for n in range(900):
        k, j = rng.choice([*keys, (None, 1), ("a", None), ("zz", 1)])
        at = rng.choice([instant(rng.randrange(30_000)), rng.choice(starts), None])
        seen.append((n, k, j, at, "same"))
    seen += [(0, "a", 1, instant(5), "same")] * 2
    left, right = rows(ROWS, *seen).repartition(5), rows(VERSIONS, *versions).repartition(3)
    for how in ("left", "inner"):
        got = asof.as_of_join(left, right, ["k", "j"], "at", how=how, bucket=bucket)
        assert got.columns == ["n", "k", "j", "at", "held", "valid_from", "valid_to", "x"]
        assert collected(got.drop("valid_from", "valid_to")) == brute_as_of(seen, versions, how)


def test_as_of_of_empty_sides_and_clashes(rows):
    left, right = rows(ROWS, (1, "a", 1, instant(0), None)), rows(VERSIONS, ("a", 1, instant(0), None, 5))
    assert collected(asof.as_of_join(left, right.limit(0), ["k", "j"], "at"), "n", "x") == [(1, None)]
    assert asof.as_of_join(left.limit(0), right, ["k", "j"], "at").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        asof.as_of_join(left.withColumn("x", F.lit(1)), right, ["k", "j"], "at")
    with pytest.raises(ValueError, match="unsupported"):
        asof.as_of_join(left, right, ["k", "j"], "at", how="full")


def test_as_of_does_not_fan_out(spark):
    """Ten thousand versions and as many rows of one key: no join, no key alone in an exchange."""
    at = F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit(START).cast("timestamp"))
    versions = spark.range(10_000).select(
        F.lit("k").alias("k"), at.alias("valid_from"), F.timestamp_add("MINUTE", F.lit(59), at).alias("valid_to"), F.col("id").alias("x")
    )
    seen = spark.range(10_000).select(F.lit("k").alias("k"), F.timestamp_add("MINUTE", F.lit(30), at).alias("at"), F.col("id").alias("n"))
    got = asof.as_of_join(seen, versions, "k", "at")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning(_part" in plan
    assert got.filter("x = n").count() == 10_000


def test_overlapping_versions_go_to_the_one_that_started_last(rows):
    versions = [("a", 1, instant(0), None, 1), ("a", 1, instant(10), instant(20), 2), ("a", 1, instant(10), instant(30), 3)]
    seen = [(n, "a", 1, instant(h), None) for n, h in enumerate((5, 15, 25, 35, 3000))]
    got = asof.as_of_join(rows(ROWS, *seen), rows(VERSIONS, *versions), ["k", "j"], "at")
    assert collected(got, "n", "x") == [(0, 1), (1, 3), (2, 3), (3, None), (4, None)]


# -- digests -------------------------------------------------------------------

FACTS = "k string, d date, value double, run string"


def day(n):
    return (START + timedelta(days=n)).date()


def changed_facts(seed=3):
    rng = random.Random(seed)
    expected = [(f"k{k}", day(d), float(k * d), "r") for k in range(20) for d in range(0, 400, 3)]
    actual = [list(r) for r in expected]
    actual[5][2] = float("nan")
    actual[900][3] = None
    actual[901][2] = None
    del actual[1500]
    actual.append(["new", day(70), 1.0, "r"])
    return expected, [tuple(r) for r in rng.sample(actual, len(actual))]


def test_digest_reconcile_equals_the_plain_one(rows):
    expected, actual = changed_facts()
    left, right = rows(FACTS, *expected).repartition(3), rows(FACTS, *actual).repartition(2)
    got = digests.reconcile(left, right, ["k", "d"], "value", "run", day="d")
    found = collected(got, "k", "d", "issue")
    assert [x[2] for x in sorted(found, key=lambda x: x[2])] == [
        "ingestion run differs", "missing from fact", "not in staging", "value differs", "value differs",
    ]
    assert set(collected(joins.reconcile(left, right, ["k", "d"], "value", "run"), "k", "d", "issue")) <= set(found)
    for ranges in (1, 7):
        assert collected(digests.reconcile(left, right, ["k", "d"], "value", "run", ranges=ranges), "k", "d", "issue") == found


def test_only_differing_leaves_are_read_further(rows):
    expected, actual = changed_facts()
    left, right = rows(FACTS, *expected), rows(FACTS, *actual)
    leaves = digests.tree(left, right, ["k", "d"], ["value", "run"], "d")
    months = {r.month: r for r in digests.month_summary(leaves).collect()}
    wrong = {f"{d:%Y-%m}" for _, d, *_ in set(map(repr_row, expected)) ^ set(map(repr_row, actual))}
    assert {m for m, r in months.items() if r.differs} == wrong and len(wrong) < 6
    assert sum(r.n_expected for r in months.values()) == len(expected)
    assert digests.narrowed(left, leaves, ["k", "d"], "d").count() < 60
    same = digests.tree(left, left, ["k", "d"], ["value", "run"], "d")
    assert same.filter("differs OR month_differs").count() == 0
    assert digests.reconcile(left, left, ["k", "d"], "value", "run", day="d").count() == 0


def repr_row(row):
    return (row[0], row[1], repr(row[2]), row[3])


def test_digests_of_odd_rows(rows):
    odd = [(None, day(1), 1.0, "r"), (None, day(1), 1.0, "r"), ("a", None, None, None), ("a", day(1), -0.0, None), ("b", day(1), float("nan"), "r")]
    left, right = rows(FACTS, *odd), rows(FACTS, ("a", day(1), 0.0, None), ("b", day(1), float("nan"), "r"), (None, day(1), 1.0, "r"))
    got = digests.reconcile(left, right, ["k", "d"], "value", "run", day="d")
    assert collected(got, "k", "d", "issue") == sorted(
        [(None, day(1), "missing from fact")] * 2 + [("a", None, "missing from fact"), (None, day(1), "not in staging")], key=repr
    )
    # Rows that stand twice on one side do not cancel out.
    twice = rows(FACTS, ("a", day(1), 1.0, "r"), ("a", day(1), 1.0, "r"))
    other = rows(FACTS, ("b", day(1), 1.0, "r"), ("b", day(1), 1.0, "r"))
    assert digests.tree(twice, other, ["k", "d"], ["value"], "d", ranges=1).filter("differs").count() == 1
    empty = left.limit(0)
    assert digests.reconcile(empty, empty, ["k", "d"], "value", "run", day="d").count() == 0
    assert digests.reconcile(twice, empty, ["k", "d"], "value", "run", day="d").count() == 2


def test_symmetric_difference_counts_null_as_a_value(rows):
    left, right = rows("k string", ("a",), ("a",), (None,), ("b",)), rows("k string", ("b",), ("c",))
    assert collected(digests.symmetric_difference(left, right, "k")) == sorted([("a", "left"), (None, "left"), ("c", "right")], key=repr)
    assert collected(digests.symmetric_difference(left, right.unionAll(rows("k string", (None,))), "k")) == [("a", "left"), ("c", "right")]


# -- loads ---------------------------------------------------------------------

LOADS = "k string, x int, y string, note int, as_of timestamp"
CHECKED = ["x", "y"]


def random_loads(rng, loads=9, keys=25):
    rows, state = [], {}
    for n in range(loads):
        for k in range(keys):
            if rng.random() < 0.25:
                state.pop(k, None)
            elif rng.random() < 0.4 or (k not in state and rng.random() < 0.6):
                state[k] = (rng.choice([1, 2, None]), rng.choice(["p", None]))
        if n != 4:  # one load has no rows
            rows += [(f"k{k}", x, y, n, instant(n)) for k, (x, y) in state.items()]
    return rows


def one_by_one(frame, loads, **options):
    history = scd2.empty_history(frame.drop("as_of"))
    for n in loads:
        at = F.lit(instant(n)).cast("timestamp")
        # A checkpoint keeps the plan of nine loads small.
        history = scd2.snapshot(history, frame.filter(F.col("as_of") == at).drop("as_of"), "k", CHECKED, at, **options).checkpoint()
    return history


@pytest.fixture
def loaded(spark, rows, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    return rows(LOADS, *random_loads(random.Random(12))).repartition(4)


def ledger(rows, loads):
    return rows("as_of timestamp", *[(instant(n),) for n in loads])


@pytest.mark.parametrize("invalidate", [True, False])
def test_fold_equals_the_loads_one_by_one(loaded, rows, invalidate):
    expected = one_by_one(loaded, range(9), invalidate_deletes=invalidate)
    got = scd2.fold(loaded, "k", CHECKED, instants=ledger(rows, range(9)), invalidate_deletes=invalidate)
    assert got.columns == expected.columns
    assert collected(got) == collected(expected)
    assert windows.version_overlaps(got, "k").count() == 0


@pytest.mark.parametrize("late", [[0], [8], [4], [3, 4], [7, 2, 5], [1, 0]])
def test_late_loads_equal_loads_in_order(loaded, rows, late):
    """note is no check column: a version opened again carries what it was cut from."""
    frame = loaded.drop("note")
    first = [n for n in range(9) if n not in late]
    history = scd2.fold(frame.filter(F.col("as_of").isin([F.lit(instant(n)) for n in first])), "k", CHECKED, instants=ledger(rows, first))
    for n in late:
        at = F.lit(instant(n)).cast("timestamp")
        load = frame.filter(F.col("as_of") == at).drop("as_of")
        history = scd2.insert_load(history, ledger(rows, first), load, "k", CHECKED, at).checkpoint()
        first.append(n)
    expected = scd2.fold(frame, "k", CHECKED, instants=ledger(rows, range(9)))
    assert collected(history) == collected(expected)


def test_loads_that_are_refused(loaded, rows):
    some = ledger(rows, range(9))
    with pytest.raises(Exception, match="duplicate key in snapshot"):
        scd2.fold(loaded.unionAll(loaded.limit(1)), "k", CHECKED, instants=some).collect()
    with pytest.raises(Exception, match="NULL in snapshot"):
        scd2.fold(loaded.unionAll(rows(LOADS, (None, 1, "p", 1, instant(1)))), "k", CHECKED, instants=some).collect()
    with pytest.raises(Exception, match="load not among the instants"):
        scd2.fold(loaded, "k", CHECKED, instants=ledger(rows, range(3))).collect()
    with pytest.raises(ValueError, match="part of the history"):
        scd2.insert_load(scd2.empty_history(loaded.drop("as_of")), some, loaded.drop("as_of"), "k", CHECKED, F.lit(instant(2)))
    assert scd2.fold(loaded.limit(0), "k", CHECKED).count() == 0

"""Summaries beside a stored table equal what the whole table gives, after any batch."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from collecting import collected
from seriesmart.operators import freshness, monthly, validate, windows
from seriesmart.session import folder_names
from seriesmart.sources import summaries, tables

SCHEMA = "series_code string, observation_date date, value double, frequency string, ingested_at timestamp"
KEYS = ["series_code", "observation_date"]
START, END = date(2020, 2, 15), date(2020, 5, 10)
FREQUENCIES = {"A": "daily", "B": "monthly", "C": "quarterly", "D": "annual", "E": "daily"}


def batch(rng, n=60, months=(0, 210)):
    held = {}
    for _ in range(n):
        code, day = rng.choice("ABCDE"), date(2020, 1, 1) + timedelta(days=rng.randrange(*months))
        value = rng.choice([None, float("nan"), 0.0, 1.0, 1.05, 3.0, -2.0])
        held[code, day] = (code, day, value, FREQUENCIES[code], datetime(2021, 1, 1) + timedelta(hours=rng.randrange(900)))
    return list(held.values())


@pytest.fixture
def config(rows):
    return rows(
        "series_code string, min_value double, frequency string",
        ("A", 0.5, "daily"), ("B", None, "monthly"), ("C", 2.0, "quarterly"), ("D", -5.0, "annual"), ("ghost", 1.0, "daily"),
    )


def kinds(config):
    return {
        "profile": summaries.Summary("profile", monthly.profile_partials(config)),
        "gaps": summaries.Summary("gaps_inside", monthly.pairs_inside(monthly.gap())),
        "jumps": summaries.Summary("jumps_inside", monthly.pairs_inside(monthly.jump(0.1))),
        "edges": summaries.Summary("edges", monthly.edges),
    }


def same_as_whole(spark, path, kept, config):
    table = tables.stored(spark, path)
    read = {name: summaries.read(spark, path, s) for name, s in kept.items()}
    got = monthly.profile(read["profile"], config, START, END, table)
    expected = validate.profile(table, config, START, END, by="series_code")
    assert got.columns == expected.columns
    assert collected(got) == collected(expected)
    assert collected(read["profile"]) == collected(kept["profile"].build(table))
    gaps = monthly.broken_pairs(read["gaps"], read["edges"], monthly.gap())
    assert collected(gaps, *KEYS, "previous_date") == collected(windows.gaps(table), *KEYS, "previous_date")
    jumps = monthly.broken_pairs(read["jumps"], read["edges"], monthly.jump(0.1))
    columns = (*KEYS, "value", "previous_date", "previous_value")
    assert collected(jumps, *columns) == collected(windows.change_over_limit(table), *columns)
    rules = freshness.cadence_rules(config)
    at = F.lit("2021-01-20 00:00:00")
    assert collected(freshness.freshness(monthly.latest(read["profile"]), rules, at)) == collected(freshness.freshness(table, rules, at))


def test_summaries_follow_merges_and_deletes(spark, rows, config, tmp_path):
    rng, path, kept = random.Random(1), f"{tmp_path}/obs", kinds(config)
    listed = list(kept.values())
    summaries.merge(spark, path, rows(SCHEMA, *batch(rng)), KEYS, listed)
    same_as_whole(spark, path, kept, config)
    # A batch with new months and rows in old ones; then one that changes nothing.
    news = rows(SCHEMA, *batch(rng, 30, (150, 330)))
    assert summaries.merge(spark, path, news, KEYS, listed)["rows_changed"] > 0
    same_as_whole(spark, path, kept, config)
    assert summaries.merge(spark, path, news, KEYS, listed)["rows_changed"] == 0
    # One month goes whole, another in part.
    doomed = tables.stored(spark, path).filter("observation_date < '2020-02-01' OR day(observation_date) = 3").select(*KEYS)
    gone = rows("series_code string, observation_date date", *[tuple(x) for x in doomed.collect()])
    assert summaries.delete(spark, path, gone, KEYS, listed) > 0
    same_as_whole(spark, path, kept, config)
    home = folder_names(spark, f"{path}_summaries/profile")
    assert not any("2020-01" in n for n in home)
    assert not any(n.startswith("_pending") for n in folder_names(spark, f"{path}_summaries"))
    assert summaries.delete(spark, path, gone, KEYS, listed) == 0


def test_only_touched_months_are_made_anew(spark, rows, config, tmp_path):
    rng, path, kept = random.Random(2), f"{tmp_path}/obs", kinds(config)
    summaries.merge(spark, path, rows(SCHEMA, *batch(rng)), KEYS, list(kept.values()))
    files = {m: set(folder_names(spark, f"{path}_summaries/profile/{m}")) for m in folder_names(spark, f"{path}_summaries/profile") if "=" in m}
    row = ("A", date(2020, 3, 31), 77.0, "daily", datetime(2021, 5, 1))
    summaries.merge(spark, path, rows(SCHEMA, row), KEYS, list(kept.values()))
    anew = {m for m, held in files.items() if set(folder_names(spark, f"{path}_summaries/profile/{m}")) != held}
    assert anew == {"observation_month=2020-03"}
    same_as_whole(spark, path, kept, config)


def test_a_job_broken_off_is_made_good(spark, rows, config, tmp_path, monkeypatch):
    rng, path, kept = random.Random(3), f"{tmp_path}/obs", kinds(config)
    listed = list(kept.values())
    summaries.merge(spark, path, rows(SCHEMA, *batch(rng)), KEYS, listed)
    news = rows(SCHEMA, *batch(rng, 40, (0, 120)))
    with monkeypatch.context() as m:
        m.setattr(summaries, "settle", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            summaries.merge(spark, path, news, KEYS, listed)
    # The rerun changes nothing in the table, and still finds the months to be done.
    assert summaries.merge(spark, path, news, KEYS, listed)["rows_changed"] == 0
    same_as_whole(spark, path, kept, config)
    # A mark whose writing was broken off has no _SUCCESS and stands for nothing.
    spark.range(1).selectExpr("'2020-01' AS observation_month").write.parquet(f"{path}_summaries/_pending-x")
    (tmp_path / "obs_summaries" / "_pending-x" / "_SUCCESS").unlink()
    assert summaries.settle(spark, path, listed) == []
    same_as_whole(spark, path, kept, config)


def test_changed_minimum_and_late_summaries(spark, rows, config, tmp_path):
    rng, path = random.Random(4), f"{tmp_path}/obs"
    kept = kinds(config)
    summaries.merge(spark, path, rows(SCHEMA, *batch(rng)), KEYS, [kept["profile"]])
    summaries.settle(spark, path, list(kept.values()))  # the others are built whole now
    same_as_whole(spark, path, kept, config)
    stricter = config.withColumn("min_value", F.when(F.col("series_code") == "B", 1.04).otherwise(F.col("min_value")))
    kept = kinds(stricter)
    old = [r[0] for r in monthly.outdated(summaries.read(spark, path, kept["profile"]), stricter).collect()]
    assert old
    summaries.refresh(spark, path, kept["profile"], old)
    assert monthly.outdated(summaries.read(spark, path, kept["profile"]), stricter).count() == 0
    same_as_whole(spark, path, kept, stricter)


def test_refused_rows_and_emptied_tables(spark, rows, config, tmp_path):
    path, kept = f"{tmp_path}/obs", kinds(config)
    listed = list(kept.values())
    with pytest.raises(Exception, match="NULL in merge key"):
        summaries.merge(spark, path, rows(SCHEMA, ("A", None, 1.0, "daily", None)), KEYS, listed)
    one = rows(SCHEMA, ("A", date(2020, 3, 1), None, "daily", None))
    summaries.merge(spark, path, one, KEYS, listed)
    same_as_whole(spark, path, kept, config)  # no value: neither edges nor pairs
    assert summaries.read(spark, path, kept["edges"]).count() == 0
    summaries.delete(spark, path, one, KEYS, listed)
    assert not any("=" in n for n in folder_names(spark, f"{path}_summaries/profile"))


def test_dates_of_a_month_are_counted_in_one_pass(rows, config):
    days = [date(2020, 3, 1), date(2020, 3, 31), date(2020, 3, 31), date(2020, 4, 15)]
    held = rows(SCHEMA, *[("A", d, 1.0, "daily", None) for d in days]).withColumn(tables.MONTH, tables.month_of("observation_date"))
    built = monthly.profile_partials(config)(held)
    assert collected(built, tables.MONTH, "row_count", "dates") == [("2020-03", 3, 2), ("2020-04", 1, 1)]
    assert "distinct" not in built._jdf.queryExecution().executedPlan().toString()

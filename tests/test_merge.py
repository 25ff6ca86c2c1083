"""Upserts, deletes, history and the incremental fact: literal cases and invariants."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from collecting import collected
from seriesmart import session
from seriesmart.operators import merge, scd2
from seriesmart.plans import ingest, marts
from seriesmart.schemas import OBSERVATIONS, RUN_COMPLETION_COLUMNS, RUNS
from seriesmart.session import ensure_checkpoint_dir
from seriesmart.sources import tables

SCHEMA = "series_code string, observation_date date, value double, ingestion_run_id string"
KEYS = ["series_code", "observation_date"]
D1, D2, D3 = date(2026, 1, 1), date(2026, 1, 2), date(2026, 2, 1)


@pytest.fixture(params=["broadcast", "shuffle"])
def strategy(request, spark):
    """Run a test with and without broadcasts."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def target(rows):
    return rows(SCHEMA, ("a", D1, 1.0, "r1"), ("a", D2, None, "r1"), ("b", D1, float("nan"), "r1"), ("c", D1, 5.0, "r1"))


def actions(plan):
    return collected(plan, "series_code", "observation_date", "value", "ingestion_run_id", "_action")


def test_merge_updates_only_real_changes(rows, target, strategy):
    source = rows(
        SCHEMA,
        ("a", D1, 1.0, "r2"),  # audit-only change
        ("a", D2, 2.0, "r2"),  # NULL to value
        ("b", D1, float("nan"), "r2"),  # NaN equals NaN
        ("d", D1, 9.0, "r2"),  # new
    )
    plan = merge.merge_plan(target, source, KEYS)
    assert merge.merge_counts(plan).head().asDict() == {
        "inserted": 1,
        "updated": 1,
        "deleted": 0,
        "rows_changed": 2,
    }
    assert collected(merge.merge_apply(plan), "series_code", "observation_date", "ingestion_run_id") == [
        ("a", D1, "r1"),
        ("a", D2, "r2"),
        ("b", D1, "r1"),
        ("c", D1, "r1"),
        ("d", D1, "r2"),
    ]


def test_rerun_changes_nothing(rows, target, strategy):
    source = rows(SCHEMA, ("a", D2, 2.0, "r2"), ("d", D1, None, "r2"))
    once = merge.merge_apply(merge.merge_plan(target, source, KEYS))
    assert merge.merge_counts(merge.merge_plan(once, source, KEYS)).head().rows_changed == 0


def test_update_always_rewrites_matches(rows, target, strategy):
    source = rows(SCHEMA, ("a", D1, 1.0, "r2"))
    counts = merge.merge_counts(merge.merge_plan(target, source, KEYS, update="always")).head()
    assert (counts.inserted, counts.updated) == (0, 1)


def test_unmatched_rows_are_deleted_unless_retained(rows, strategy):
    target = rows("series_code string, name string", ("a", "x"), ("b", "y"), ("c", "z"))
    source = rows("series_code string, name string", ("a", "x"))
    retained = rows("series_code string", ("b",))
    plan = merge.merge_plan(target, source, ["series_code"], retained=retained)
    assert collected(plan, "series_code", "_action") == [("a", "keep"), ("b", "keep"), ("c", "delete")]


def test_empty_source_deletes_nothing(rows, strategy):
    target = rows("series_code string, name string", ("a", "x"))
    empty = target.filter(F.lit(False))
    plan = merge.merge_plan(target, empty, ["series_code"], retained=rows("series_code string"))
    assert merge.merge_counts(plan).head().rows_changed == 0


def test_delete_needs_a_single_key(rows, target):
    with pytest.raises(ValueError):
        merge.merge_plan(target, target, KEYS, retained=rows("series_code string"))


def test_repeated_source_key_fails(rows, target, strategy):
    source = rows(SCHEMA, ("a", D1, 1.0, "r2"), ("a", D1, 2.0, "r2"))
    with pytest.raises(Exception, match="duplicate merge key"):
        merge.merge_counts(merge.merge_plan(target, source, KEYS)).collect()


def test_prune_refuses_an_empty_configuration(rows, target):
    assert collected(merge.prune(target, rows("series_code string", ("a",))), "series_code") == [("a",), ("a",)]
    with pytest.raises(ValueError):
        merge.prune(target, rows("series_code string"))


def test_run_upsert_touches_listed_columns_only(rows, strategy):
    schema = "run_id string, status string, started_at int, rows_changed long"
    target = rows(schema, ("r1", "running", 1, None), ("r2", "success", 2, 5))
    source = rows("run_id string, status string, started_at int", ("r1", "success", 99), ("r3", "crashed", 3))
    updated = merge.upsert_columns(target, source, ["run_id"], ["status"])
    assert collected(updated) == [
        ("r1", "success", 1, None),
        ("r2", "success", 2, 5),
        ("r3", "crashed", 3, None),
    ]
    untouched = merge.upsert_columns(target, source, ["run_id"])
    assert collected(untouched, "run_id", "status") == [("r1", "running"), ("r2", "success"), ("r3", "crashed")]
    with pytest.raises(ValueError):
        merge.upsert_columns(target, source, ["run_id"], RUN_COMPLETION_COLUMNS)


def test_migration_fills_only_new_columns_and_registers_runs(spark, rows):
    at = datetime(2026, 1, 2, 3, 4, 5, 678)
    schema = ", ".join(
        f"{f.name} {f.dataType.simpleString()}"
        for f in OBSERVATIONS.fields
        if f.name not in ("ingested_at", "ingestion_run_id")
    )
    old = rows(schema, (D1, "a", "A", 1.0, "daily", "u", D1, at, "x"), (D2, "a", "A", 2.0, "daily", "u", D1, at, "x"))
    migrated, runs = ingest.migrate(old, spark.createDataFrame([], RUNS), "x", "p", "raw.observations")
    assert collected(migrated, "ingested_at", "ingestion_run_id") == [(at, "20260102T030405000678Z")] * 2
    assert collected(runs, "run_id", "status", "started_at") == [("20260102T030405000678Z", "unknown", at)]
    again, same = ingest.migrate(migrated, runs, "x", "p", "raw.observations")
    assert again.columns == migrated.columns and same is runs


def test_evolve_and_backfill_count(rows):
    evolved, added = merge.evolve(rows("series_code string", ("a",)), OBSERVATIONS)
    assert added == [f.name for f in OBSERVATIONS.fields if f.name != "series_code"]
    assert merge.backfill_count(evolved, ["unit"]).head().rows_updated == 1


def test_needs_rebuild(rows):
    steps = rows("p string, rows_changed long", ("none", 0), ("none", 0), ("some", 0), ("some", 2), ("lost", None), ("lost", 0))
    got = dict(collected(merge.needs_rebuild(steps, "p"), "p", "needs_rebuild"))
    assert got == {"none": False, "some": True, "lost": True}
    assert all(r.needs_rebuild for r in merge.needs_rebuild(steps, "p", stale=True).collect())


# -- history ------------------------------------------------------------------

T1, T2, T3 = (datetime(2026, m, 1) for m in (1, 2, 3))


def taken(history, source, at):
    return scd2.snapshot(history, source, "k", ["name"], F.lit(at).cast("timestamp"))


def test_snapshot_life_cycle(rows):
    first = rows("k string, name string, source string", ("a", "x", "s"), ("b", "y", "s"), ("n", None, "s"))
    second = rows("k string, name string, source string", ("a", "x2", "s"), ("n", None, "s2"))
    third = rows("k string, name string, source string", ("a", "x2", "s"), ("b", "y", "s"), ("n", "set", "s"))
    history = taken(taken(taken(scd2.empty_history(first), first, T1), second, T2), third, T3)
    assert collected(history, "k", "name", "valid_from", "valid_to") == sorted(
        [
            ("a", "x", T1, T2),
            ("a", "x2", T2, None),
            ("b", "y", T1, T2),  # vanished
            ("b", "y", T3, None),  # returned
            ("n", None, T1, T3),  # an untracked column changed at T2: nothing
            ("n", "set", T3, None),
        ],
        key=repr,
    )
    assert history.select("scd_id").distinct().count() == 6


def test_snapshot_without_changes_keeps_history(rows):
    first = rows("k string, name string", ("a", "x"))
    history = taken(scd2.empty_history(first), first, T1)
    assert collected(taken(history, first, T2)) == collected(history)


def test_deletes_may_be_ignored(rows):
    first = rows("k string, name string", ("a", "x"))
    history = taken(scd2.empty_history(first), first, T1)
    kept = scd2.snapshot(history, first.filter("false"), "k", ["name"], F.lit(T2), invalidate_deletes=False)
    assert collected(kept, "valid_to") == [(None,)]


# -- marts --------------------------------------------------------------------


def staged(rows, *data):
    return rows(
        "series_code string, observation_date date, value double, extracted_at timestamp, ingestion_run_id string", *data
    )


@pytest.fixture
def dim(rows):
    return rows("series_code string, series_key string", ("a", "ka"), ("b", "kb"))


def test_incremental_fact_equals_full_refresh(rows, dim, strategy):
    before = staged(
        rows,
        ("a", D1, 1.0, T1, "r1"),
        ("a", D2, 2.0, T1, "r1"),
        ("b", D1, 3.0, T1, "r1"),
        ("b", D2, None, T1, "r1"),
        ("zz", D1, 7.0, T1, "r1"),  # no metadata
    )
    after = staged(
        rows,
        ("a", D1, 1.5, T2, "r2"),  # revised
        ("a", D2, None, T2, "r2"),  # retracted
        ("b", D1, 3.0, T1, "r1"),  # unchanged
        ("b", D2, 4.0, T2, "r2"),  # arrived late, at an old date
        ("b", D3, 5.0, T2, "r2"),
        ("zz", D1, 7.0, T2, "r2"),
    )
    fact = marts.full_fact(before, dim, marts.dim_date(before))
    dates = marts.dim_date(after)
    built = marts.incremental_fact(fact, after, dim, dates)
    assert collected(built) == collected(marts.full_fact(after, dim, dates))
    assert built.count() == 4
    assert collected(marts.incremental_fact(built, after, dim, dates)) == collected(built)


def test_first_build_on_an_empty_fact(rows, dim):
    observations = staged(rows, ("a", D1, 1.0, T1, "r1"))
    dates = marts.dim_date(observations)
    full = marts.full_fact(observations, dim, dates)
    assert collected(marts.incremental_fact(full.filter("false"), observations, dim, dates)) == collected(full)


def test_calendar_is_contiguous(rows):
    calendar = marts.dim_date(staged(rows, ("a", date(2024, 2, 27), None, T1, "r"), ("b", date(2024, 3, 2), 1.0, T1, "r")))
    assert collected(calendar, "date_key", "day_of_week", "is_weekend") == [
        (20240227, 3, False),
        (20240228, 4, False),
        (20240229, 5, False),
        (20240301, 6, False),
        (20240302, 7, True),
    ]
    assert marts.dim_date(staged(rows)).count() == 0


def test_backfill_windows_cover_empty_months(rows):
    config = rows("series_code string", ("a",), ("b",))
    observations = rows("series_code string, observation_date date", ("a", D1), ("a", D2), ("a", D3), ("c", D1))
    got = ingest.backfill_windows(config, observations, date(2026, 1, 15), date(2026, 2, 10))
    assert collected(got) == [
        ("a", date(2026, 1, 1), date(2026, 1, 31), 2),
        ("a", date(2026, 2, 1), date(2026, 2, 28), 1),
        ("b", date(2026, 1, 1), date(2026, 1, 31), 0),
        ("b", date(2026, 2, 1), date(2026, 2, 28), 0),
    ]


# -- stored tables --------------------------------------------------------------


def test_stored_merge_rewrites_only_changed_months(spark, rows, tmp_path):
    ensure_checkpoint_dir(spark)
    path = str(tmp_path / "observations")
    tables.write_observations(rows(SCHEMA, ("a", D1, 1.0, "r1"), ("a", D3, 3.0, "r1")), path)

    def files():
        return {p.name for p in (tmp_path / "observations").glob("*/*.parquet")}

    before = files()
    news = rows(SCHEMA, ("a", D1, 1.0, "r2"), ("a", D3, 3.5, "r2"), ("b", D3, 1.0, "r2"))
    counts = tables.merge_into_path(spark, path, news, KEYS)
    assert counts == {"inserted": 1, "updated": 1, "deleted": 0, "rows_changed": 2}
    assert len(before & files()) == 1  # January's file is still there
    assert collected(spark.read.parquet(path), "series_code", "observation_date", "value", "ingestion_run_id") == [
        ("a", D1, 1.0, "r1"),
        ("a", D3, 3.5, "r2"),
        ("b", D3, 1.0, "r2"),
    ]
    unchanged = files()
    assert tables.merge_into_path(spark, path, news, KEYS)["rows_changed"] == 0
    assert files() == unchanged


def test_stored_delete_drops_emptied_months(spark, rows, tmp_path):
    path = str(tmp_path / "observations")
    tables.write_observations(rows(SCHEMA, ("a", D1, 1.0, "r"), ("a", D2, 2.0, "r"), ("a", D3, 3.0, "r")), path)
    assert tables.delete_from_path(spark, path, rows("series_code string, observation_date date"), KEYS) == 0
    doomed = rows("series_code string, observation_date date", ("a", D2), ("a", D3), ("zz", D1))
    assert tables.delete_from_path(spark, path, doomed, KEYS) == 2
    assert collected(tables.stored(spark, path), "observation_date") == [(D1,)]
    assert not (tmp_path / "observations/observation_month=2026-02").exists()


def test_stored_fact_build_equals_full_refresh(spark, rows, dim, tmp_path):
    path = str(tmp_path / "fact")
    before = staged(rows, ("a", D1, 1.0, T1, "r1"), ("a", D3, 2.0, T1, "r1"), ("b", D1, 3.0, T1, "r1"))
    after = staged(rows, ("a", D1, 1.5, T2, "r2"), ("a", D3, None, T2, "r2"), ("b", D1, 3.0, T1, "r1"), ("b", D2, 4.0, T2, "r2"))
    tables.write_observations(marts.full_fact(before, dim, marts.dim_date(before)), path, cluster="series_key")
    dates = marts.dim_date(after)
    counts = marts.build_fact_table(spark, path, after, dim, dates)
    assert counts == {"inserted": 1, "updated": 1, "deleted": 1, "rows_changed": 3}
    assert collected(tables.stored(spark, path).drop(tables.MONTH)) == collected(marts.full_fact(after, dim, dates))
    assert marts.build_fact_table(spark, path, after, dim, dates)["rows_changed"] == 0


def test_a_build_without_a_mark_compares_once(spark, rows, dim, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    before = staged(rows, ("a", D1, 1.0, T1, "r1"), ("a", D3, 2.0, T1, "r1"), ("b", D1, 3.0, T1, "r1"), ("b", D2, 5.0, T1, "r1"))
    after = staged(rows, ("a", D1, 1.5, T2, "r2"), ("a", D3, None, T2, "r2"), ("b", D1, 3.0, T1, "r1"))
    tables.write_observations(marts.full_fact(before, dim, marts.dim_date(before)), path, cluster="series_key")
    broken_off(monkeypatch, "delete_from_path", lambda calls: True)
    dates = marts.dim_date(before)
    counts = marts.build_fact_table(spark, path, after, dim, dates)
    assert counts == {"inserted": 0, "updated": 1, "deleted": 2, "rows_changed": 3}
    assert collected(tables.stored(spark, path).drop(tables.MONTH)) == collected(marts.full_fact(after, dim, dates))
    assert not (tmp_path / f"fact/observation_month={D3:%Y-%m}").exists()


def test_recent_retractions_and_dropped_series_leave_the_fact(spark, rows, dim, tmp_path):
    path = str(tmp_path / "fact")
    before = staged(rows, ("a", D1, 1.0, T1, "r1"), ("a", D3, 2.0, T1, "r1"), ("b", D1, 3.0, T1, "r1"))
    after = staged(rows, ("a", D1, 1.0, T1, "r1"), ("a", D3, None, T2, "r2"), ("b", D1, 3.0, T1, "r1"))
    dates = marts.dim_date(before)
    tables.write_observations(marts.full_fact(before, dim, dates), path, cluster="series_key")
    kept = dim.filter("series_code = 'a'")
    counts = marts.build_fact_table(spark, path, after, kept, dates)
    assert counts == {"inserted": 0, "updated": 0, "deleted": 2, "rows_changed": 2}
    assert collected(tables.stored(spark, path), "series_key", "observation_date") == [("ka", D1)]


def broken_off(monkeypatch, name, when):
    """Let a function of ``tables`` fail as soon as ``when`` holds for its calls."""
    real, calls = getattr(tables, name), []

    def stop(*args, **options):
        calls.append(args)
        if when(calls):
            raise RuntimeError("broken off")
        return real(*args, **options)

    monkeypatch.setattr(tables, name, stop)


@pytest.mark.parametrize("at", ["half the months", "before the delete"])
def test_a_broken_build_is_made_good(spark, rows, dim, tmp_path, monkeypatch, at):
    path = str(tmp_path / "fact")
    before = staged(rows, ("a", D1, 1.0, T1, "r1"), ("a", D3, 2.0, T1, "r1"), ("b", D1, 3.0, T1, "r1"))
    marts.build_fact_table(spark, path, before, dim, marts.dim_date(before))
    after = staged(rows, ("a", D1, 1.5, T2, "r2"), ("a", D3, None, T2, "r2"), ("b", D1, 3.0, T1, "r1"), ("b", D3, 4.0, T2, "r2"))
    dates = marts.dim_date(after)
    if at == "half the months":
        # Only February's rows of the batch get into the table.
        part = marts.fact_rows(after, dim, dates).filter(F.col("observation_date") == F.lit(D3))
        tables.merge_into_path(spark, path, part, marts.FACT_KEY, (), "changed", cluster="series_key")
    else:
        with monkeypatch.context() as patched:
            broken_off(patched, "delete_from_path", lambda calls: True)
            with pytest.raises(RuntimeError):
                marts.build_fact_table(spark, path, after, dim, dates)
    marts.build_fact_table(spark, path, after, dim, dates)
    assert collected(tables.stored(spark, path).drop(tables.MONTH)) == collected(marts.full_fact(after, dim, dates))
    assert marts.build_fact_table(spark, path, after, dim, dates)["rows_changed"] == 0


def test_first_merge_creates_the_table_and_an_emptied_one_is_filled(spark, rows, tmp_path):
    path = str(tmp_path / "new")
    news = rows(SCHEMA, ("a", D1, 1.0, "r1"), ("a", D3, 3.0, "r1"))
    assert tables.merge_into_path(spark, path, news, KEYS)["inserted"] == 2
    assert tables.delete_from_path(spark, path, news.select(*KEYS), KEYS) == 2
    assert tables.delete_from_path(spark, path, news.select(*KEYS), KEYS) == 0
    assert tables.merge_into_path(spark, path, news, KEYS)["inserted"] == 2
    assert collected(tables.stored(spark, path), "observation_date") == [(D1,), (D3,)]


def test_months_new_to_the_table_are_not_compared(spark, rows, tmp_path, monkeypatch):
    path, compared = str(tmp_path / "new"), []
    real = tables.merge_plan
    monkeypatch.setattr(tables, "merge_plan", lambda t, s, *a, **o: compared.append(collected(s, "observation_date")) or real(t, s, *a, **o))
    assert tables.merge_into_path(spark, path, rows(SCHEMA, ("a", D1, 1.0, "r1")), KEYS)["inserted"] == 1
    assert compared == []
    news = rows(SCHEMA, ("a", D1, 2.0, "r2"), ("b", D3, 3.0, "r2"))
    counts = tables.merge_into_path(spark, path, news, KEYS)
    assert counts == {"inserted": 1, "updated": 1, "deleted": 0, "rows_changed": 2}
    assert compared == [[(D1,)]]
    assert collected(tables.stored(spark, path), "observation_date", "value") == [(D1, 2.0), (D3, 3.0)]


def test_a_repeated_key_of_a_new_month_leaves_the_table_as_it_was(spark, rows, tmp_path):
    path = str(tmp_path / "new")
    tables.merge_into_path(spark, path, rows(SCHEMA, ("a", D1, 1.0, "r1")), KEYS)
    twice = rows(SCHEMA, ("a", D1, 2.0, "r2"), ("b", D3, 3.0, "r2"), ("b", D3, 4.0, "r2"))
    with pytest.raises(Exception, match="duplicate merge key"):
        tables.merge_into_path(spark, path, twice, KEYS)
    assert collected(tables.stored(spark, path), "observation_date", "value") == [(D1, 1.0)]


@pytest.mark.parametrize("row", [("a", None, 1.0, "r"), (None, D1, 1.0, "r")])
def test_a_null_key_fails(spark, rows, tmp_path, row):
    with pytest.raises(Exception, match="NULL in merge key"):
        tables.merge_into_path(spark, str(tmp_path / "t"), rows(SCHEMA, row), KEYS)


def test_ingestion_into_a_stored_table(spark, rows, tmp_path):
    path, checks = str(tmp_path / "observations"), str(tmp_path / "checks")
    config = rows(
        "series_name string, series_code string, frequency string, unit string, max_null_ratio double, min_value double",
        ("a", "A", "daily", "u", None, None),
        ("low", "L", "daily", "u", None, 0.0),
    )
    at = F.lit(T1)

    def ingest_rows(run, *data, config=config, **options):
        long = rows("series_name string, observation_date date, value double", *data)
        if not (tmp_path / "observations").exists():
            columns = ingest.canonical_observations(long, config, at, at, F.lit("r0"), "bank")
            tables.write_observations(columns, path)
        return ingest.ingest_into_table(
            spark, path, checks, long, config, D1, D3, at, at, F.lit(run), "bank", explicit_window=True, **options
        )

    assert ingest_rows("r1", ("a", D1, 1.0), ("low", D1, 1.0))["rows_changed"] == 0
    counts = ingest_rows("r2", ("a", D1, 1.5), ("a", D2, 2.0), ("low", D1, -1.0))
    assert counts == {"inserted": 1, "updated": 1, "deleted": 0, "rows_changed": 2}
    assert collected(spark.read.parquet(checks), "series_name", "passed") == [("a", True), ("low", False)]
    assert collected(tables.stored(spark, path), "series_code", "value", "ingestion_run_id") == [
        ("A", 1.5, "r2"),
        ("A", 2.0, "r2"),
        ("L", 1.0, "r0"),
    ]
    pruned = ingest_rows("r3", config=config.filter("series_name = 'a'"), prune=True)
    assert pruned == {"inserted": 0, "updated": 0, "deleted": 1, "rows_changed": 1}


def test_staged_files_are_removed(spark, rows):
    with session.staged(rows("a int", (1,))) as frame:
        files = frame.inputFiles()
        assert collected(frame) == [(1,)]
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_window_scan_prunes_months(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.write_observations(rows(SCHEMA, ("a", D1, 1.0, "r1"), ("a", D2, 1.0, "r1"), ("a", D3, 3.0, "r1")), path)
    scan = tables.scan_window(spark, path, D2, date(2026, 1, 31))
    assert collected(scan, "observation_date") == [(D2,)]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "observation_month" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_window_filter_prunes_partitions_and_columns(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.write_observations(rows(SCHEMA, ("a", D1, 1.0, "r1"), ("a", D3, 3.0, "r1")), path)
    scan = spark.read.parquet(path).filter(F.col("observation_date") >= F.lit(D3)).select("value")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(observation_date" in plan
    assert "series_code" not in plan.split("ReadSchema")[1]


def test_ensure_table_is_idempotent(spark, tmp_path):
    for _ in range(2):
        table = tables.ensure_table(spark, "ensured_runs", RUNS, location=str(tmp_path / "runs"))
    assert table.columns == RUNS.names
    spark.sql("DROP TABLE ensured_runs")

"""Snapshots of the series metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmart.operators import scd2, sets

from .relations import SNAPSHOT_1, SNAPSHOT_2, SNAPSHOT_3
from .sql import query

CHECKED = ("series_name", "frequency", "unit", "category")


def _taken(history, source, at):
    return scd2.snapshot(history, source, "series_code", CHECKED, F.lit(at).cast("timestamp"))


def history_after_first(r):
    return _taken(scd2.empty_history(r.snapshot_1), r.snapshot_1, SNAPSHOT_1)


def history_after_second(r):
    return _taken(history_after_first(r), r.snapshot_2, SNAPSHOT_2)


def history_after_third(r):
    return _taken(history_after_second(r), r.snapshot_3, SNAPSHOT_3)


HISTORY_SQL = f"""
    history AS (
      SELECT a.*, md5(a.series_code || '|{SNAPSHOT_1}') AS scd_id, TIMESTAMP '{SNAPSHOT_1}' AS updated_at,
        TIMESTAMP '{SNAPSHOT_1}' AS valid_from,
        CASE WHEN b.series_code IS NULL OR a.category <> b.category THEN TIMESTAMP '{SNAPSHOT_2}' END AS valid_to
      FROM snapshot_1 a LEFT JOIN snapshot_2 b USING (series_code)
      UNION ALL
      SELECT b.*, md5(b.series_code || '|{SNAPSHOT_2}'), TIMESTAMP '{SNAPSHOT_2}', TIMESTAMP '{SNAPSHOT_2}', NULL
      FROM snapshot_2 b LEFT JOIN snapshot_1 a USING (series_code)
      WHERE a.series_code IS NULL OR a.category <> b.category)
"""


@query("mrg_08_scd2_snapshot", HISTORY_SQL + "SELECT * FROM history")
def _(r):
    return history_after_second(r)


RETURNED_SQL = f""",
    current AS (SELECT * FROM history WHERE valid_to IS NULL)
    SELECT * FROM history WHERE valid_to IS NOT NULL
    UNION ALL
    SELECT c.* REPLACE (CASE WHEN s.series_code IS NULL OR s.category <> c.category
      THEN TIMESTAMP '{SNAPSHOT_3}' END AS valid_to)
    FROM current c LEFT JOIN snapshot_3 s USING (series_code)
    UNION ALL
    SELECT s.*, md5(s.series_code || '|{SNAPSHOT_3}'), TIMESTAMP '{SNAPSHOT_3}', TIMESTAMP '{SNAPSHOT_3}', NULL
    FROM snapshot_3 s LEFT JOIN current c USING (series_code)
    WHERE c.series_code IS NULL OR s.category <> c.category
"""


@query("mrg_08_scd2_returned_key", HISTORY_SQL + RETURNED_SQL)
def _(r):
    return history_after_third(r)


@query("mrg_08_fold_loads", HISTORY_SQL + RETURNED_SQL)
def _(r):
    """The three loads in one pass, whatever their order."""
    taken = ((r.snapshot_3, SNAPSHOT_3), (r.snapshot_1, SNAPSHOT_1), (r.snapshot_2, SNAPSHOT_2))
    loads = sets.union_all([rows.withColumn("as_of", F.lit(at).cast("timestamp")) for rows, at in taken])
    return scd2.fold(loads, "series_code", CHECKED)


# Customers as loads of every month with orders: a customer without orders is missing then.
MONTHLY_SQL = """
    loads AS (
      SELECT o_custkey AS customer, date_trunc('month', o_orderdate) AS taken, max(o_orderstatus) AS status, count(*) AS n_orders
      FROM orders GROUP BY 1, 2),
    ledger AS (
      SELECT taken, lag(taken) OVER (ORDER BY taken) AS before_at, lead(taken) OVER (ORDER BY taken) AS after_at
      FROM (SELECT DISTINCT taken FROM loads)),
    opened AS (
      SELECT l.*, after_at, CAST(lag(l.taken) OVER w IS DISTINCT FROM before_at OR lag(status) OVER w IS DISTINCT FROM status AS INTEGER) AS opens
      FROM loads l JOIN ledger g ON l.taken = g.taken WINDOW w AS (PARTITION BY customer ORDER BY l.taken)),
    islands AS (SELECT *, sum(opens) OVER (PARTITION BY customer ORDER BY taken) AS island FROM opened),
    folded AS (
      SELECT customer, arg_min(status, taken) AS status, arg_min(n_orders, taken) AS n_orders, min(taken) AS valid_from,
        CASE WHEN NOT bool_or(after_at IS NULL) THEN max(after_at) END AS valid_to
      FROM islands GROUP BY customer, island)
    SELECT customer, status, {carried} md5(customer || '|' || valid_from) AS scd_id, valid_from AS updated_at, valid_from, valid_to FROM folded
"""


def monthly_loads(r):
    month = F.trunc("o_orderdate", "month").cast("timestamp")
    return r.table("orders").groupBy(F.col("o_custkey").alias("customer"), month.alias("as_of")).agg(
        F.max("o_orderstatus").alias("status"), F.count("*").alias("n_orders")
    )


@query("mrg_08_fold_monthly", MONTHLY_SQL.format(carried="n_orders,"))
def _(r):
    return scd2.fold(monthly_loads(r), "customer", ["status"])


LATE_LOADS = ("1996-02-01", "1997-11-01", "1997-12-01")


@query("mrg_08_late_loads", MONTHLY_SQL.format(carried=""))
def _(r):
    """Loads that arrive after later ones are put where they belong."""
    loads = monthly_loads(r).drop("n_orders")
    late = F.col("as_of").isin([F.lit(d).cast("timestamp") for d in LATE_LOADS])
    history = scd2.fold(loads.filter(~late), "customer", ["status"])
    instants = loads.filter(~late).select("as_of").distinct()
    for day in reversed(LATE_LOADS):
        at = F.lit(day).cast("timestamp")
        load = loads.filter(F.col("as_of") == at).drop("as_of")
        history = scd2.insert_load(history, instants, load, "customer", ["status"], at)
        instants = instants.unionByName(load.sparkSession.range(1).select(at.alias("as_of")))
    return history

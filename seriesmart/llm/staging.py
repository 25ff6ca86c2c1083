"""Intermediate tables in the shared folder, gapless numbering and connected components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir, remove_folder


#: Bytes of rows that a Python worker gets at a time; Spark's default is 64 MB, of which
#: both sides hold several copies.
ARROW_BYTES = 4 << 20
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as a zip that Spark hands out; once a session."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings, their dots written ``__``, that hold for the jobs run inside."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def staged(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """The frame written once to the shared folder and read back.

    Cuts the lineage and gives the optimizer a known size; a lost executor costs
    a rerun of its tasks only, because the files are not on its disk.
    """
    path = shared_path(df.sparkSession, name)
    with settings(df.sparkSession, spark__sql__execution__arrow__maxBytesPerBatch=str(ARROW_BYTES)):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files behind a frame of ``staged`` that nothing reads any more."""
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        remove_folder(df.sparkSession, path)


def numbered(df: DataFrame, order: list[str], group: str, index: str, name: str) -> DataFrame:
    """Gapless numbers from 0 within each ``group`` value, in the order of ``order``.

    Rows are dealt out by ranges of (group, order, a row number), so neither a
    large group nor a repeated key meets in one task. Each range counts its rows
    per group; only those counts, one row per range and group, are summed up.
    The row number breaks ties and is made once: the ranges are staged.
    """
    spark = df.sparkSession
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    ranged = staged(
        tied.repartitionByRange(width, F.col(group), *[F.col(c) for c in order], F.col("__tie"))
        .withColumn("__range", F.spark_partition_id()),
        name,
    )
    counts = ranged.groupBy("__range", F.col(group).alias("__group")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__group").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__range", "__group", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    # One row per range and group: as many as there are shuffle partitions, plus one per group.
    within = Window.partitionBy("__range", group).orderBy(*[F.col(c) for c in order], F.col("__tie"))
    local = ranged.withColumn("__row", F.row_number().over(within) - 1)
    joined = local.join(
        offsets.withColumnRenamed("__range", "__r"),
        (F.col("__range") == F.col("__r")) & F.col(group).eqNullSafe(F.col("__group")),
    )
    return joined.withColumn(index, (F.col("__offset") + F.col("__row")).cast("long")).drop(
        "__tie", "__range", "__r", "__group", "__row", "__offset"
    )


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """The smallest reachable id of every id on an edge: columns id, component.

    Alternating large-star and small-star steps: each id's neighbours are tied to
    the smallest of them. Every step is a partial aggregate and an equi-join, so a
    hub's neighbours are never gathered. One job a round, written to the shared
    folder; rounds end when the edges stop changing. Paths shrink exponentially,
    so ``rounds`` is a guard that raises.
    """
    clean = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    current, seen = _staged_edges(clean.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    for _ in range(rounds):
        if not seen[0]:
            break
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(lowest, "u")
            .where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u != v")
        after, now = _staged_edges(small)
        drop_staged(current)
        current = after
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"Components did not settle in {rounds} rounds.")
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def _staged_edges(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """Distinct edges in the shared folder, their number and a digest."""
    seen = Observation()
    written = staged(
        edges.distinct().observe(seen, F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")), "edges"
    )
    return written, (seen.get["n"], seen.get["x"] or 0)


def staged_count(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``staged``, and how many rows were written."""
    seen = Observation()
    written = staged(df.observe(seen, F.count("*").alias("n")), name)
    return written, seen.get["n"]


def fresh_name(base: str, taken: list[str]) -> str:
    """``base``, or ``base`` with underscores in front until no column has that name."""
    low = {c.lower() for c in taken}
    while base.lower() in low:
        base = "_" + base
    return base


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")

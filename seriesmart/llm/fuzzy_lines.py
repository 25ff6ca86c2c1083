"""Line de-duplication by MinHash over character shingles, in DataFrame functions.

A line's shingles are the strings of ``WIDTH`` characters at every position of the
lower-cased line; a shorter line is one shingle. Equal lines meet by a 64-bit hash.

1. Distinct lines are cut into shingles, whose hashes fall into ``BINS`` bins. ``SLOTS``
   minima of each bin give its bands, of ``ROWS`` minima each, and four bits of every
   minimum a sketch. The text goes through one shuffle, by line, and its shingles
   stay in the task that holds the line.
2. Lines of a band meet the smallest and the largest of them; pairs whose sketches agree are
   verified on full shingle sets. Linked lines form components.
3. In bands that still hold several components lines meet a few of another component, at
   random. Where several are left after that, every line meets every one of another
   component, in blocks. The first line of a component stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .staging import components, drop_staged, settings, staged, staged_count

WIDTH = 5
BINS, SLOTS, ROWS = 4, 16, 5
#: Minima of each band of a bin; every one is used, four of them twice.
BANDS = ((0, 1, 2, 3, 4), (5, 6, 7, 8, 9), (10, 11, 12, 13, 14), (15, 0, 5, 10, 1))
#: Minima of ``BINS * SLOTS`` whose four bits may differ. At a similarity of 0.8, 12 do on
#: average, and more than this with 1e-4.
APART = 24
#: Lines of one band that meet in a task; a band of more is cut into blocks.
BLOCK = 1_024
#: Places, in a random order of its band, at which a line meets others in the second turn.
BESIDE = (1, 2, 3, 5, 8)
#: Tasks in which lines are signed, as a multiple of the session's shuffle partitions.
TASKS = 3

#: Minima are taken of hashes turned by these: every constant asks for the hash nearest to it.
_TURNS = [((i * 0x9E3779B97F4A7C15 + 0x1234567) & (2**64 - 1)) - 2**63 for i in range(1, SLOTS + 1)]


def lines_of(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """doc, version, n, line, key of every line with more than white space in rows with an id.

    ``line`` is lower-cased and without spaces at its ends. ``version`` is a hash of the
    row's text: it tells rows of one id apart."""
    cut = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("version"),
        F.posexplode(F.split(F.col(text), "\n")).alias("n", "line"),
    )
    lowered = cut.where(~F.col("line").rlike(r"^\s*$")).withColumn("line", F.lower(F.trim("line")))
    return lowered.withColumn("key", F.xxhash64("line"))


def _places(line: Column) -> tuple[Column, Column, Column]:
    """UTF-16 of a line, UTF-32 where it holds characters of two units (else null), and how
    many shingles it has. Bytes are cut in time that does not depend on their place."""
    narrow = F.encode(line, "UTF-16BE")
    wide = F.when(F.octet_length(narrow) != 2 * F.char_length(line), F.encode(line, "UTF-32"))
    length = F.coalesce(F.octet_length(wide).cast("long") * F.lit(2), F.octet_length(narrow).cast("long") * F.lit(4))
    return narrow, wide, F.greatest(F.shiftright(length, 3).cast("int") - (WIDTH - 1), F.lit(1))


def _shingle(narrow: Column, wide: Column, at: Column) -> Column:
    """Hash of the shingle at a place from 0: of its UTF-16, or of its UTF-32 if that has other
    than 16 bits somewhere, so that equal shingles have equal hashes in all lines."""
    unit = F.substring(wide, at * 4 + 1, F.lit(4 * WIDTH))
    high = F.concat(*[F.substring(unit, F.lit(4 * k + 1), F.lit(2)) for k in range(WIDTH)])
    low = F.concat(*[F.substring(unit, F.lit(4 * k + 3), F.lit(2)) for k in range(WIDTH)])
    zeros = F.substring(F.lit(bytes(2 * WIDTH)), F.lit(1), F.octet_length(high))
    return F.xxhash64(
        F.when(wide.isNull(), F.substring(narrow, at * 2 + 1, F.lit(2 * WIDTH))).when(high == zeros, low).otherwise(unit)
    )


def shingle_set(line: Column) -> Column:
    """Hashes of a line's distinct shingles."""
    narrow, wide, n = _places(line)
    # The bytes are made once, and not for every place: lambdas take them from an array of one.
    plain = F.transform(F.array(narrow), lambda x: F.transform(
        F.sequence(F.lit(1), 2 * n - 1, F.lit(2)), lambda at: F.xxhash64(F.substring(x, at, F.lit(2 * WIDTH)))
    ))
    other = F.transform(F.array(wide), lambda x: F.transform(
        F.sequence(F.lit(0), n - 1), lambda at: _shingle(F.lit(None).cast("binary"), x, at)
    ))
    return F.array_distinct(F.get(F.when(wide.isNull(), plain).otherwise(other), F.lit(0)))


def signed(lines: DataFrame) -> DataFrame:
    """key, sketch (a long for each bin), bands of every distinct line."""
    # Text is grouped by key before it is shuffled: a frequent line is sent once a task.
    distinct = lines.groupBy("key").agg(F.first("line").alias("line"))
    narrow, wide, n = _places(F.col("line"))
    shingles = distinct.select("key", narrow.alias("narrow"), wide.alias("wide"), n.alias("n")).select(
        "key", "narrow", "wide", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("at")
    ).select("key", _shingle(F.col("narrow"), F.col("wide"), F.col("at")).alias("s"))
    minima = shingles.withColumn("bin", F.col("s").bitwiseAND(F.lit(BINS - 1))).groupBy("key", "bin").agg(
        *[F.min(F.col("s").bitwiseXOR(F.lit(turn))).alias(f"m{i}") for i, turn in enumerate(_TURNS)]
    )
    bits = [F.shiftleft(F.shiftright(f"m{i}", 8).bitwiseAND(F.lit(15)), 4 * i) for i in range(SLOTS)]
    sketch = bits[0]
    for more in bits[1:]:
        sketch = sketch.bitwiseOR(more)
    bands = minima.select(
        "key", "bin", sketch.alias("sketch"),
        *[F.xxhash64("bin", F.lit(k), *[f"m{i}" for i in used]).alias(f"b{k}") for k, used in enumerate(BANDS)],
    )
    # One row a bin and line; a bin without shingles has none, and null here.
    by_bin = bands.groupBy("key").agg(*[
        F.max(F.when(F.col("bin") == i, F.col(c))).alias(f"{c}_{i}")
        for i in range(BINS) for c in ("sketch", *[f"b{k}" for k in range(len(BANDS))])
    ])
    return by_bin.select(
        "key", F.array(*[F.coalesce(f"sketch_{i}", F.lit(0).cast("long")) for i in range(BINS)]).alias("sketch"),
        F.array_compact(F.array(*[f"b{k}_{i}" for i in range(BINS) for k in range(len(BANDS))])).alias("bands"),
    )


def _agree(a: str, b: str) -> Column:
    """Whether at most ``APART`` of two sketches' minima differ."""
    differ = "0x1111111111111111"
    parts = []
    for i in range(BINS):
        x = f"({a}[{i}] ^ {b}[{i}])"
        y = f"({x} | shiftrightunsigned({x}, 1) | shiftrightunsigned({x}, 2) | shiftrightunsigned({x}, 3))"
        parts.append(f"bit_count({y} & {int(differ, 16)}L)")
    return F.expr(f"{' + '.join(parts)} <= {APART}")


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of lines whose shingle sets are as similar as ``percent``; ``texts``
    holds key and line."""
    a = texts.select(F.col("key").alias("a"), F.col("line").alias("a_line"))
    b = texts.select(F.col("key").alias("b"), F.col("line").alias("b_line"))
    sets = F.struct(shingle_set(F.col("a_line")).alias("one"), shingle_set(F.col("b_line")).alias("other"))
    # A generated row holds its sets: a filter on plain columns would work them out once more each time it names them.
    joined = pairs.join(b, "b").join(a, "a").select("a", "b", F.explode(F.array(sets)).alias("x"))
    common = F.size(F.array_intersect("x.one", "x.other")).cast("long")
    return joined.where((100 + percent) * common >= percent * (F.size("x.one").cast("long") + F.size("x.other"))).select("a", "b")


def line_components(signatures: DataFrame, lines: DataFrame, percent: int = 80) -> DataFrame:
    """id, component for every distinct line (by key) that is linked to another one.

    ``signatures`` comes from ``signed`` and is read more than once; ``lines`` holds key
    and line.
    """
    own = Window.partitionBy("band")
    members = staged(
        signatures.select("key", F.explode("bands").alias("band")).select(
            "band", "key", F.min("key").over(own).alias("low"), F.max("key").over(own).alias("high"), F.count("*").over(own).alias("c")
        ).where("c > 1"),
        "members",
    )
    wanted = staged(members.select("key").distinct(), "wanted")
    known = staged(signatures.select("key", "sketch").join(wanted, "key", "left_semi"), "sketches")
    # The keys are written first: with a known size they may be broadcast, and no text is shuffled.
    texts = staged(lines.join(wanted, "key", "left_semi").groupBy("key").agg(F.first("line").alias("line")), "texts")
    drop_staged(wanted)

    def sketches(c: str) -> DataFrame:
        return known.select(F.col("key").alias(c), F.col("sketch").alias(f"{c}_sketch"))

    def labelled(rows: DataFrame) -> DataFrame:
        """Rows of bands that hold several components, with their components."""
        if grouped is None:
            named = rows.withColumn("component", F.col("key"))
        else:
            named = rows.join(grouped.withColumnRenamed("id", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
        several = named.groupBy("band").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 != c1")
        return named.join(several.select("band"), "band", "left_semi")

    def linked(pairs: DataFrame) -> DataFrame | None:
        """Components after the links among further pairs."""
        links, n = staged_count(verified(pairs, texts, percent), "links")
        if not n:
            return grouped
        if grouped is not None:
            links = links.union(grouped.where("id != component").select(F.col("id").alias("a"), F.col("component").alias("b")))
        return staged(components(links), "components")

    def untried(pairs: DataFrame) -> DataFrame:
        for before in tried:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        return staged(pairs, "pairs")

    def compared(proposed: DataFrame) -> DataFrame | None:
        """Components after the links among the proposed pairs whose sketches agree."""
        pairs = proposed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()
        tried.append(untried(
            pairs.join(sketches("a"), "a").join(sketches("b"), "b").where(_agree("a_sketch", "b_sketch")).select("a", "b")
        ))
        return linked(tried[-1])

    grouped, tried = None, []
    grouped = compared(members.select(F.col("low").alias("a"), F.col("key").alias("b")).union(
        members.where("c > 2").select(F.col("key").alias("a"), F.col("high").alias("b"))
    ))
    # Where several components are left, lines meet others at random: most of a family join up.
    members_left = labelled(members.where("c > 2").select("band", "key", "c"))
    order = Window.partitionBy("band").orderBy(F.xxhash64("key", "band"))
    beside = members_left.withColumns({
        f"near{k}": F.lag(F.struct("key", "component"), k).over(order) for k in BESIDE
    }).select("key", "component", F.explode(F.array(*[f"near{k}" for k in BESIDE])).alias("near")).where(
        "component != near.component"
    ).select(F.col("key").alias("a"), F.col("near.key").alias("b"))
    grouped = compared(beside)
    # What is left: every pair of lines of different components.
    bands = signatures.select("key", "sketch", "bands")
    rest = staged(
        labelled(members.where("c > 2").select("band", "key", "c")).join(bands, "key")
        .withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int")),
        "rest",
    )
    left = rest.select(
        "band", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"),
        F.col("key").alias("a"), F.col("component").alias("ca"), F.col("sketch").alias("a_sketch"), F.col("bands").alias("a_bands"),
    )
    right = rest.select(
        "band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.col("key").alias("b"), F.col("component").alias("cb"), F.col("sketch").alias("b_sketch"), F.col("bands").alias("b_bands"),
    )
    # Lines meet once: in the first band that they share. If that has no other line, they have met before.
    met = left.join(
        right.withColumnRenamed("band", "b_band").withColumnRenamed("block", "b_block"),
        F.expr("band = b_band AND block = b_block AND a < b AND ca != cb") & _agree("a_sketch", "b_sketch")
        & (F.array_min(F.array_intersect("a_bands", "b_bands")) == F.col("band")),
    ).select("a", "b")
    tried.append(untried(met))
    grouped = linked(tried[-1])
    for spent in (members, known, texts, rest, *tried):
        drop_staged(spent)
    return grouped if grouped is not None else lines.sparkSession.createDataFrame([], "id long, component long")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """doc, version, dropped (sorted line numbers from 0): the lines that are not the first
    of their component, in the order of document id, text hash and line number."""
    lines = lines_of(docs, id_col, text)
    place = ("doc", "version", "n")
    occurrences = staged(lines.select(*place, "key"), "lines")
    first = occurrences.groupBy("key").agg(
        F.min(F.struct(*place)).alias("first"), F.count("*").alias("times")
    )
    spark = docs.sparkSession
    # Few lines a task: its minima lie in a small table.
    width = TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    with settings(spark, spark__sql__shuffle__partitions=str(width), spark__sql__adaptive__coalescePartitions__enabled="false"):
        signatures = staged(signed(lines.select("key", "line")), "signatures")
    grouped = line_components(signatures, lines.select("key", "line"), percent).withColumnRenamed("id", "key")
    drop_staged(signatures)
    # Only lines that repeat or are linked can be dropped.
    judged = staged(
        first.join(grouped, "key", "left").where("times > 1 OR component IS NOT NULL")
        .withColumn("component", F.coalesce("component", "key")), "judged",
    )
    keepers = judged.groupBy("component").agg(F.min("first").alias("keeper"))
    decisions = staged(judged.join(keepers, "component").select("key", "keeper"), "decisions")
    return (
        occurrences.join(decisions, "key").where(F.struct(*place) != F.col("keeper"))
        .groupBy("doc", "version").agg(F.sort_array(F.collect_set("n")).alias("dropped"))
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``docs`` with the repeated lines cut out of ``text``, and n_lines, dropped.

    ``n_lines`` counts the lines that are more than white space; ``dropped`` lists the
    numbers of those cut out. Blank lines are never dropped and link nothing. Null and
    empty texts stay as they are, with 0 lines; rows without an id keep their lines and
    hold no other row's line. Rows of one id with different texts are documents of their
    own; rows equal in id and text count as one, and are cut alike. Extra columns stay;
    where one is called n_lines or dropped, it is replaced.
    """
    with settings(docs.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        dropped = staged(dropped_lines(docs, id_col, text, percent), "dropped")
    base = docs.drop("n_lines", "dropped")
    joined = base.join(
        dropped.select(F.col("doc").alias("__doc"), F.col("version").alias("__version"), "dropped"),
        (F.col(id_col).cast("long") == F.col("__doc")) & (F.xxhash64(text) == F.col("__version")), "left",
    ).drop("__doc", "__version")
    cut = F.split(F.col(text), "\n")
    kept = F.array_join(F.filter(cut, lambda x, i: ~F.array_contains(F.col("dropped"), i)), "\n")
    return joined.select(
        *[
            F.when(F.col("dropped").isNotNull(), kept).otherwise(F.col(text)).alias(text) if c == text else F.col(f"`{c}`")
            for c in base.columns
        ],
        F.coalesce(F.size(F.filter(cut, lambda x: ~x.rlike(r"^\s*$"))), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )

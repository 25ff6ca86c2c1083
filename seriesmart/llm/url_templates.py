"""URL filter: fixed rules first, then a path-template tree learnt for each host.

The tree is grown level by level over a host's distinct paths. At a node, a segment
that holds a fair share of the paths stays as it is where few values share the place
or it stands out among many; all others are the wildcard ``*``. Kept siblings whose
labelled shares do not differ by a two-proportion test grow on as one branch. All
these are shares, so copies of the same urls change nothing. A template is rejected
if its share of blocked labels, smoothed towards its siblings', is high enough.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .staging import drop_staged, staged

WILDCARD = "*"
#: Parts of a node's different segments, which tasks look through before the node is put together.
PARTS = 64


@dataclass(frozen=True)
class Rule:
    """``action`` (allow or block) for a host with its subdomains and a path prefix."""

    action: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as struct(action, text); null where none does.

    Rules are written in code: each is one branch of an expression.
    """
    found = F.lit(None).cast("struct<action:string,text:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        this = F.struct(F.lit(rule.action).alias("action"), F.lit(rule.text).alias("text"))
        found = F.when(fits, this).otherwise(found)
    return found


def _literal(segment: Column) -> Column:
    """A segment as it stands in a template, where ``* { | }`` mean something else."""
    for sign in "*{|}":
        segment = F.replace(segment, F.lit(sign), F.lit(f"%{ord(sign):02X}"))
    return segment


def _merged(children: Column, z: float) -> Column:
    """Tested children (share, segment, labels, blocked), lowest share first, as branches
    (labels, blocked, segments): a child joins the pooled branch before it if their
    shares do not differ at ``z``."""
    none = F.array().cast("array<struct<labels:bigint,blocked:bigint,segments:array<string>>>")

    def step(branches: Column, child: Column) -> Column:
        last = F.get(branches, F.size(branches) - 1)
        labels, blocked = last["labels"] + child["labels"], last["blocked"] + child["blocked"]
        pooled = blocked / labels
        error = F.sqrt(pooled * (1 - pooled) * (1 / last["labels"] + 1 / child["labels"]))
        alike = F.abs(child["share"] - last["blocked"] / last["labels"]) <= z * error

        def branch(n: Column, b: Column, segments: Column) -> Column:
            return F.array(F.struct(n.alias("labels"), b.alias("blocked"), segments.alias("segments")))

        own = branch(child["labels"], child["blocked"], F.array(child["segment"]))
        joined = branch(labels, blocked, F.concat(last["segments"], F.array(child["segment"])))
        before = F.slice(branches, 1, F.greatest(F.size(branches) - 1, F.lit(0)))
        return F.when(F.coalesce(alike, F.lit(False)), F.concat(before, joined)).otherwise(F.concat(branches, own))

    return F.aggregate(children, none, step)


def _steps(now: DataFrame, least_share: float, variety: float, stands_out: float, least_labels: int, z: float) -> DataFrame:
    """host, template, __segment, __step: what each kept segment of a node is called."""
    counts = staged(
        now.where("__segment IS NOT NULL").groupBy("host", "template", "__segment").agg(
            F.count("*").alias("n"), F.count("blocked").alias("labels"),
            F.coalesce(F.sum("blocked"), F.lit(0)).cast("long").alias("blocked"),
        ),
        "segments",
    )
    nodes = counts.groupBy("host", "template").agg(F.sum("n").alias("paths"), F.count("*").alias("values"))
    n, paths, values = F.col("n"), F.col("paths"), F.col("values")
    out = (values > 1) & (n * (values - 1) >= stands_out * (paths - n))
    # What is short of its share of a part of the node is short of it in the node too.
    part = Window.partitionBy("host", "template", F.pmod(F.xxhash64("__segment"), F.lit(PARTS)))
    counts_left = counts.withColumn("part", F.sum("n").over(part)).where(n >= least_share * F.col("part")).drop("part")
    kept = counts_left.join(nodes, ["host", "template"]).where((n >= least_share * paths) & ((values < variety * paths) | out))
    # At most 1 / least_share children of a node are left.
    child = F.struct((F.col("blocked") / F.greatest("labels", F.lit(1))).alias("share"), F.col("__segment").alias("segment"), "labels", "blocked")
    family = kept.groupBy("host", "template").agg(F.sort_array(F.collect_list(child)).alias("children"))
    tested = _merged(F.filter("children", lambda c: c["labels"] >= least_labels), z)
    alone = F.transform(F.filter("children", lambda c: c["labels"] < least_labels), lambda c: F.array(c["segment"]))
    groups = F.concat(F.transform(tested, lambda b: F.array_sort(b["segments"])), alone)
    named = family.select("host", "template", F.explode(groups).alias("group")).withColumn(
        "__step", F.array_join(F.transform("group", _literal), "|")
    )
    step = F.when(F.size("group") > 1, F.concat(F.lit("{"), F.col("__step"), F.lit("}"))).otherwise(F.col("__step"))
    named = staged(named.select("host", "template", F.explode("group").alias("__segment"), step.alias("__step")), "steps")
    drop_staged(counts)
    return named


def templates(
    paths: DataFrame,
    depth: int = 6,
    least_share: float = 0.05,
    variety: float = 0.5,
    stands_out: float = 4.0,
    least_labels: int = 5,
    z: float = 1.96,
) -> DataFrame:
    """Adds ``template`` to distinct rows of (host, path, blocked 0/1/null).

    A path is cut at ``/``; segments beyond ``depth`` share one tail wildcard ``**``.
    Each level counts the paths of (host, template so far, segment). A segment is kept
    if it holds ``least_share`` of its node's paths and either the node has fewer
    different values than ``variety`` of its paths, or the segment holds ``stands_out``
    times the paths of the node's other values on average. Kept siblings with
    ``least_labels`` labels each are merged into ``{a|b}`` where their blocked shares do
    not differ at ``z``: from the lowest share on, each is held against the branch pooled
    so far. Paths are only counted (combined before the shuffle) and joined with the few
    kept segments, so a large host is split like any skewed join.
    """
    grown = paths.withColumn("__segments", F.split(F.substring(F.col("path"), 2, 1 << 30), "/")).withColumn(
        "template", F.lit("")
    )
    deepest = grown.agg(F.max(F.size("__segments"))).first()[0] or 0
    for level in range(min(depth, deepest)):
        now = grown.withColumn("__segment", F.get(F.col("__segments"), F.lit(level)))
        steps = _steps(now, least_share, variety, stands_out, least_labels, z)
        step = F.coalesce("__step", F.lit(WILDCARD))
        grown = now.join(steps, ["host", "template", "__segment"], "left").withColumn(
            "template",
            F.when(F.col("__segment").isNull(), F.col("template")).otherwise(F.concat(F.col("template"), F.lit("/"), step)),
        ).drop("__segment", "__step")
    tail = F.when(F.size("__segments") > depth, F.concat(F.col("template"), F.lit("/" + WILDCARD * 2)))
    return grown.withColumn("template", F.coalesce(tail, F.col("template"))).drop("__segments")


def judged_templates(labelled: DataFrame, threshold: float = 0.9, prior: float = 1.0) -> DataFrame:
    """host, template, labels, blocked, expected, purity, reject from rows of
    (host, template, blocked 0/1/null).

    ``purity`` is ``(blocked + 2 * prior * expected) / (labels + 2 * prior)``. What is
    expected of a branch is the mean blocked share of its labelled siblings, each
    counting once whatever its size, smoothed in the same way towards what is expected
    of their parent; at a host's root that is 0.5. So a template without labels takes
    what its siblings and its parent's siblings tell, and no label counts twice. A
    template is rejected from ``threshold`` on.
    """
    leaves = staged(
        labelled.groupBy("host", "template").agg(
            F.count("blocked").alias("labels"), F.coalesce(F.sum("blocked"), F.lit(0)).cast("long").alias("blocked")
        ),
        "leaves",
    )
    # A leaf's way: the inner nodes '/a', '/a/b', ... below the root, then the leaf itself.
    parts = F.slice(F.split("template", "/"), 2, 1 << 30)
    inner = F.transform(parts, lambda x, i: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, i + 1), "/")))
    steps = F.concat(
        F.transform(inner, lambda name: F.struct(F.regexp_replace(name, r"/[^/]*$", "").alias("parent"), name.alias("name"), F.lit(False).alias("leaf"))),
        F.array(F.struct(F.col("template").alias("parent"), F.col("template").alias("name"), F.lit(True).alias("leaf"))),
    )
    ways = leaves.select("host", "template", "labels", "blocked", F.posexplode(steps).alias("place", "step")).select(
        "host", "template", "labels", "blocked", "place", "step.*"
    )
    branches = ways.groupBy("host", "parent", "name", "leaf").agg(F.sum("labels").alias("n"), F.sum("blocked").alias("b"))
    branches = staged(branches.withColumn("share", F.when(F.col("n") > 0, F.col("b") / F.col("n"))), "branches")
    families = branches.groupBy("host", "parent").agg(F.sum("share").alias("shares"), F.count("share").alias("known"))
    others = branches.join(families, ["host", "parent"]).select(
        "host", "name", "leaf",
        (F.coalesce("shares", F.lit(0.0)) - F.coalesce("share", F.lit(0.0))).alias("shares"),
        (F.col("known") - F.col("share").isNotNull().cast("long")).alias("known"),
    )
    seen = ways.join(others, ["host", "name", "leaf"]).groupBy("host", "template").agg(
        F.first("labels").alias("labels"), F.first("blocked").alias("blocked"),
        F.sort_array(F.collect_list(F.struct("place", "shares", "known"))).alias("way"),  # depth + 2 at most
    )
    expected = F.aggregate(
        "way", F.lit(0.5), lambda up, x: (x["shares"] + 2 * prior * up) / (x["known"] + 2 * prior)
    )
    return (
        seen.withColumn("expected", expected)
        .withColumn("purity", (F.col("blocked") + 2 * prior * F.col("expected")) / (F.col("labels") + 2 * prior))
        .withColumn("reject", F.col("purity") >= threshold)
        .select("host", "template", "labels", "blocked", "expected", "purity", "reject")
    )


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url: str = "url", **tree: float) -> DataFrame:
    """page_id, host, path, rule, verdict, template, labels, purity for every row.

    A rule's verdict stands; the paths that rules judge are the labels from which
    templates of the rest are judged. Null urls and urls without ``://`` have empty
    host and path and are allowed. Repeated rows are judged each; the tree counts a
    host's path once, however often it occurs. Other columns are not read; an empty
    table gives an empty result.
    """
    source = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    ruled = source.withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = ruled.select(
        "page_id", "host", "path", F.col("__rule.text").alias("rule"), F.col("__rule.action").alias("action")
    )
    paths = rows.groupBy("host", "path").agg(F.first("action").alias("action")).select(
        "host", "path", (F.col("action") == "block").cast("int").alias("blocked")
    )
    judging = {k: tree.pop(k) for k in ("threshold", "prior") if k in tree}
    grown = staged(templates(staged(paths, "paths"), **tree), "templates")
    nodes = staged(judged_templates(grown, **judging), "nodes")
    by_method = F.when(F.col("reject") & (F.col("host") != ""), "block").otherwise("allow")
    known = grown.drop("blocked").join(nodes, ["host", "template"]).select(
        "host", "path", "template", "labels", "purity", by_method.alias("by_method")
    )
    return rows.join(known, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("action", "by_method").alias("verdict"),
        "template", F.col("labels").cast("long").alias("labels"), "purity",
    )

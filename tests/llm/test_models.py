"""Toxicity, neighbours, urls and the pipeline against brute force, held-out labels and odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

import corpus_pipeline
from seriesmart.llm import neighbour_graph, queries, toxicity, url_templates
from seriesmart.llm.staging import staged

FOLDER, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows_of(name, folder=FOLDER):
    return duckdb.sql(f"SELECT * FROM '{folder}/{name}.parquet'").fetchall()


# -- toxicity ------------------------------------------------------------------


def random_index(seed, n=300, terms=12):
    rng = random.Random(seed)
    index = toxicity.Index(
        {f"t{i}": i for i in range(terms)}, np.array([*(1 + 3 * rng.random() for _ in range(terms)), 1.0]),
        list(range(n)), np.array([float(rng.random() < 0.4) for _ in range(n)]), np.ones(n), 0.1, 0.4,
    )
    vectors = [index.vector(Counter(rng.choices(range(terms + 1), k=rng.randint(1, 9)))) for _ in range(n)]
    index.fill(vectors)
    return index, vectors


@pytest.mark.parametrize("k", [1, 7, 25, 400])
def test_block_max_search_is_exact(k):
    index, vectors = random_index(k)
    dense = np.zeros((len(vectors), 13))
    for i, (terms, w) in enumerate(vectors):
        dense[i, list(terms)] = w
    for i in range(0, len(vectors), 11):
        cosines = np.round(dense @ dense[i], 12)
        order = [r for r in np.lexsort((np.arange(len(cosines)), -cosines)) if cosines[r] > 0 and r != i][:k]
        near = index.nearest(*vectors[i], k, without=i)
        assert [s for s, _ in near] == pytest.approx([cosines[r] for r in order], abs=1e-9)
        assert {r for s, r in near if s > near[-1][0] + 1e-9} <= set(order)


def test_toxicity_of_held_out_documents(spark):
    labels = {i: toxic for i, _, toxic in rows_of("labels", LARGER)}
    found = queries.QUERIES["op6_toxicity"](spark, LARGER).collect()
    assert len(found) == len(rows_of("documents", LARGER))
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    hits = sum(r.predicted and labels[r.doc_id] for r in held)
    assert hits >= 0.6 * sum(labels[r.doc_id] for r in held)
    assert sum(r.predicted and not labels[r.doc_id] for r in held) <= 0.02 * len(held)


def test_op6_scores_match_brute_force_on_whole_documents(spark):
    """Every score from all cosines with all examples, without bounds, blocks or caches."""
    from seriesmart.llm.staging import ship

    ship(spark)
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    index = toxicity.learn(docs, labels, ~queries.held_out())
    size, every = len(index.vocabulary) + 1, []
    for terms, weights in index.blocks:
        for column in weights.T:
            row = np.zeros(size)
            row[terms] = column
            every.append(row)
    assert len(every) == len(index.ids) and np.linalg.norm(every, axis=1) == pytest.approx(1.0)
    got = {r.doc_id: r.score for r in queries.QUERIES["op6_toxicity"](spark, FOLDER).collect()}
    rows = rows_of("documents")
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        vector, told = np.zeros(size), False
        for word in re.findall(r"[^\W_]+", (text or "").lower()):
            here = [t for t in {word, *(word[:n] + "*" for n in (4, 6) if len(word) > n)} if t in index.vocabulary]
            told |= bool(here)
            for t in here:
                vector[index.vocabulary[t]] += 1
            vector[-1] += not here
        if not told:
            assert got[doc_id] == pytest.approx(index.rate_without_terms)
            continue
        vector = np.where(vector > 0, 1 + np.log(np.maximum(vector, 1)), 0) * index.idf
        cosines = np.round(np.array(every) @ (vector / np.linalg.norm(vector)), 12)
        near = [r for r in np.lexsort((np.arange(len(every)), -cosines)) if cosines[r] > 0][: toxicity.Limits.neighbours]
        if not near:
            assert got[doc_id] == pytest.approx(index.rate_without_terms)
            continue
        w = cosines[near] ** 2 * index.weights[near]
        vote = (w @ index.labels[near] + 0.05 * w.mean() * index.prior) / (w.sum() + 0.05 * w.mean())
        assert got[doc_id] == pytest.approx(float(np.interp(vote, *index.curve)), abs=1e-9)


def test_repeated_ids_and_equal_distances(spark, docs):
    """Rows of one id are scored each by its own text; equally near examples are taken by place."""
    table = docs((1, "vile brute"), (1, "calm day"), (1, "vile brute"), *((i, "vile brute") for i in range(2, 40)), *((i, "calm day") for i in range(40, 80)))
    label = spark.createDataFrame([(i, int(i < 40)) for i in range(2, 80)], "doc_id long, toxic int")
    index = toxicity.learn(table, label, limits=toxicity.Limits(least_evidence=0.5))
    scored = toxicity.annotate(table, index).collect()
    by = {}
    for r in scored:
        by.setdefault(r.text, set()).add(r.toxicity)
    assert len(scored) == 81 and all(len(v) == 1 for v in by.values()) and max(by["vile brute"]) > max(by["calm day"])


def test_toxicity_of_odd_rows(spark, docs):
    table = docs("you idiot there", None, "", "a calm day", "idiot " * 3000).withColumn("toxicity", F.lit("x"))
    label = "doc_id long, toxic int"
    none = toxicity.learn(table, spark.createDataFrame([], label))
    assert {r.score for r in toxicity.score(table, none).collect()} == {0.5}
    odd = spark.createDataFrame([(None, 1), (0, None), (0, 1), (0, 0), (99, 1)], label)
    scored = toxicity.annotate(table, toxicity.learn(table, odd))
    assert scored.count() == 5 and scored.columns[-2:] == ["toxicity", "toxicity_evidence"]
    assert toxicity.score(table.limit(0), none).count() == 0


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(queries.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    from seriesmart.llm.staging import ship

    ship(spark)
    scores = [
        {r.doc_id: r.score for r in toxicity.score(docs, toxicity.learn(docs, t, ~queries.held_out())).collect()}
        for t in (labels, flipped)
    ]
    assert scores[0] == scores[1]


# -- neighbours ----------------------------------------------------------------


def test_recall_against_brute_force(spark):
    found = queries.QUERIES["op4_neighbour_graph"](spark, LARGER).collect()
    rows = rows_of("embeddings", LARGER)
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    by = defaultdict(list)
    for r in found:
        by[r.query_id].append(r)
    recall = []
    for q in ids[ids % 20 == 0].tolist():
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        got = sorted(by[q], key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, 21))
        assert all(r.score == pytest.approx(float(scores[ids == r.vec_id][0]), abs=1e-12) for r in got)
        recall.append(len(best & {r.vec_id for r in got}) / 20)
    assert np.mean(recall) >= 0.9


@pytest.mark.parametrize("named,least,most,share", [(64, 8192, 32_768, 1), (2240, 512, 4096, 20)])
def test_vectors_sent_to_blocks_grow_with_the_table(named, least, most, share):
    """Five times the nodes: about five times the vectors, in tasks that hold no more than before."""
    sent = {}
    for nodes in (10_260, 51_300, 256_500, 1_282_500, 6_412_500, 32_062_500):
        members = nodes // share
        blocks = neighbour_graph.block_count(members, nodes, named, least, most)
        held = nodes * -np.expm1(-members / blocks * named / nodes)
        assert held <= 1.001 * least * named and blocks >= min(neighbour_graph.TASKS, members // least)
        sent[nodes] = blocks * held / nodes
    assert sent[51_300] <= 4 and max(sent.values()) < 1.05 * named / share
    assert neighbour_graph.block_count(0, 0, 1, 512, 4096) == 1


def test_best_keeps_the_largest_of_different_others():
    node, other, score = np.array([1, 1, 1, 2, 1]), np.array([5, 6, 5, 7, 4]), np.array([0.1, 0.3, 0.2, 0.9, 0.3])
    a, b, s = neighbour_graph.best(node, other, score, 2)
    assert list(zip(a, b, s, strict=True)) == [(1, 4, 0.3), (1, 6, 0.3), (2, 7, 0.9)]


def test_neighbours_of_odd_vectors(spark):
    from seriesmart.llm.staging import ship

    ship(spark)
    schema = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("node", T.StringType()),
    ])
    copies = [(100 + i, [1.0, 2.0], "x") for i in range(40)]
    odd = [(1, None, "x"), (2, [0.0, 0.0], "x"), (3, [float("nan"), 1.0], "x"), (4, [None, 1.0], "x"), (5, [1.0], "x"),
           (6, [float("inf"), 1.0], "x"), (None, [1.0, 1.0], "x"), (20, [3.0, 1.0], "x"), (40, [-1.0, 0.5], "x")]
    table = spark.createDataFrame([*copies, *odd], schema)
    got = defaultdict(list)
    for r in neighbour_graph.nearest(table, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {20, 40, 100, 120}
    assert got[20] == [(100 + i, 5.0) for i in range(20)]
    assert got[100] == [(20, 5.0), *((101 + i, 5.0) for i in range(19))]
    assert neighbour_graph.nearest(table.limit(0), F.col("id") % 20 == 0).count() == 0
    assert neighbour_graph.nearest(table.where("vec_id = 20"), F.col("id") % 20 == 0).count() == 0


# -- urls ----------------------------------------------------------------------


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((i for i, c in enumerate(rest) if c in "/?#"), default=len(rest))
    path = rest[cut:]
    end = min((i for i, c in enumerate(path) if c in "?#"), default=len(path))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, path[:end]


def fitting_rule(host, path):
    fits = [
        r for r in queries.URL_RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.text), default=None)


URLS = [None, "", "no scheme.com/en/", "http://", "HTTP://Example.COM/en/x?y#z", "https://www.example.com/en/1", "http://example.com",
        "ftp://a.net/es/1://b.com/", "http://ÄB.net/fr/", "http://notcom/", "http://xcom/a", "http://x.com/a\nb", "a://b://c/d", "http://x.net/de/1",
        "http://q.net?x=/es/"]


def check_judged(rows, urls):
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path) == split_url(urls[r.page_id])
        rule = fitting_rule(r.host, r.path)
        assert r.rule == (rule.text if rule else None)
        assert r.verdict == rule.action if rule else r.verdict in ("allow", "block")


def test_urls_and_rules(spark):
    table = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("template", F.lit(1))
    check_judged(url_templates.judge(table, queries.URL_RULES).collect(), dict(enumerate(URLS)))
    assert url_templates.judge(table.limit(0), queries.URL_RULES).count() == 0


def test_op7_on_whole_pages(spark):
    urls = {i: u for i, u, _ in rows_of("pages")}
    check_judged(queries.QUERIES["op7_url_templates"](spark, FOLDER).collect(), urls)


def test_templates_generalise_and_are_judged_by_purity(spark):
    urls = [f"http://h.net/{part}/{i}" for part, n in (("good", 60), ("bad", 60), ("odd", 3)) for i in range(n)]
    urls += [f"http://h.net/bad/{i}/x" for i in range(20)]
    rules = [url_templates.Rule("allow", "h.net/good/1"), *(url_templates.Rule("block", f"h.net/bad/{d}") for d in range(1, 6))]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_templates.judge(table, rules).collect()
    assert {r.template for r in rows} == {"/good/*", "/bad/*", "/*/*", "/bad/*/x"}
    free = {(r.template, r.verdict) for r in rows if r.rule is None}
    assert free == {("/good/*", "allow"), ("/bad/*", "block"), ("/*/*", "allow"), ("/bad/*/x", "block")}


def test_similar_branches_merge_and_grow_on(spark):
    """Merging is by share against the pooled branch, at any depth; no branch without labels is merged."""
    shares = (("a", 38), ("b", 39), ("c", 2), ("d", 0))
    paths = [("h", f"/x/{t}/{i}/{end}", int(i < n) if t != "d" else None) for t, n in shares for i in range(40) for end in "uv"]
    table = spark.createDataFrame(paths, "host string, path string, blocked int")
    grown = url_templates.templates(table)
    assert {r.template for r in grown.select("template").distinct().collect()} == {
        f"/x/{x}/*/{y}" for x in ("{a|b}", "c", "d") for y in ("{u|v}" if x != "d" else "u", "v" if x == "d" else "{u|v}")
    }
    by = {r.template: r for r in url_templates.judged_templates(grown).collect()}
    merged = by["/x/{a|b}/*/{u|v}"]
    assert (merged.labels, merged.blocked, merged.reject) == (160, 154, True)
    assert not by["/x/c/*/{u|v}"].reject and by["/x/d/*/u"].labels == 0
    # Of two labelled siblings, one blocked and one not, nothing can be told.
    assert by["/x/d/*/u"].purity == pytest.approx(0.5, abs=0.02)


def test_unlabelled_branches_take_what_siblings_tell(spark):
    blocked = [("h", f"/{i:02}/{j}", 1) for i in range(19) for j in range(4)] + [("h", f"/new/{j}", None) for j in range(4)]
    table = spark.createDataFrame(blocked, "host string, path string, blocked int")
    judged = url_templates.judged_templates(url_templates.templates(table)).where("labels = 0").collect()
    assert [(r.template, r.reject) for r in judged] == [("/new/*", True)]
    assert judged[0].purity == pytest.approx(20 / 21)


def brute_templates(known):
    """Template of each (host, path) of ``known``, which gives its label, one node at a time."""
    out = {}

    def escaped(x):
        return "".join(f"%{ord(c):02X}" if c in "*{|}" else c for c in x)

    def grow(host, level, name, group):
        ends = [p for p, parts in group if len(parts) == level or level == 6]
        for p in ends:
            out[host, p] = name + ("/**" if len(dict(group)[p]) > 6 else "")
        by = {}
        for p, parts in group:
            if level < 6 and len(parts) > level:
                by.setdefault(parts[level], []).append((p, parts))
        total, steps = sum(map(len, by.values())), {}
        kept = []
        for x, held in by.items():
            others = (total - len(held)) / (len(by) - 1) if len(by) > 1 else None
            if len(held) >= 0.05 * total and (len(by) < 0.5 * total or (others is not None and len(held) >= 4 * others)):
                marks = [known[host, p] for p, _ in held if known[host, p] is not None]
                kept.append((sum(marks) / max(len(marks), 1), x, len(marks), sum(marks)))
        branches = []
        for share, x, n, b in sorted(kept):
            if n < 5:
                steps[x] = escaped(x)
                continue
            if branches:
                pn, pb, names = branches[-1]
                pooled = (pb + b) / (pn + n)
                if abs(share - pb / pn) <= 1.96 * (pooled * (1 - pooled) * (1 / pn + 1 / n)) ** 0.5:
                    branches[-1] = (pn + n, pb + b, [*names, x])
                    continue
            branches.append((n, b, [x]))
        for _, _, names in branches:
            joined = "|".join(map(escaped, sorted(names)))
            steps.update(dict.fromkeys(names, "{" + joined + "}" if len(names) > 1 else joined))
        below = {}
        for x, held in by.items():
            below.setdefault(steps.get(x, "*"), []).extend(held)
        for step, held in below.items():
            grow(host, level + 1, f"{name}/{step}", held)

    for host in {h for h, _ in known}:
        grow(host, 0, "", [(p, p[1:].split("/")) for h, p in known if h == host])
    return out


def brute_purity(known, template):
    """Purity of each (host, template), by walking down from the host's root."""
    out = {}
    for host in {h for h, _ in known}:
        rows = [(template[k].split("/")[1:], known[k]) for k in known if k[0] == host]

        def walk(prefix, rows, up):
            ways = {}
            for parts, mark in rows:
                ways.setdefault(parts[len(prefix)] if len(parts) > len(prefix) else None, []).append((parts, mark))
            shares = {}
            for w, held in ways.items():
                marks = [m for _, m in held if m is not None]
                if marks:
                    shares[w] = sum(marks) / len(marks)
            for w, held in ways.items():
                rest = [v for x, v in shares.items() if x != w]
                expected = (sum(rest) + 2 * up) / (len(rest) + 2)
                if w is not None:
                    walk([*prefix, w], held, expected)
                else:
                    marks = [m for _, m in held if m is not None]
                    out[host, "".join("/" + x for x in prefix)] = (sum(marks) + 2 * expected) / (len(marks) + 2)

        walk([], rows, 0.5)
    return out


@pytest.mark.parametrize("folder", [FOLDER, LARGER])
def test_op7_matches_brute_force_on_whole_pages(spark, folder):
    urls = {i: u for i, u, _ in rows_of("pages", folder)}
    known = {}
    for u in urls.values():
        rule = fitting_rule(*split_url(u))
        known[split_url(u)] = None if rule is None else int(rule.action == "block")
    template = brute_templates(known)
    purity = brute_purity(known, template)
    rows = queries.QUERIES["op7_url_templates"](spark, folder).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert r.template == template[r.host, r.path]
        assert r.purity == pytest.approx(purity[r.host, r.template])
        if r.rule is None:
            assert r.verdict == ("block" if purity[r.host, r.template] >= 0.9 and r.host else "allow")


def test_op7_verdicts_do_not_change_with_copies(spark):
    urls = [u for _, u, _ in rows_of("pages", LARGER)]
    urls += [f"http://h.net/{part}/{i}" for part in ("es", "fr", "de", "x*{|}") for i in range(12)] + URLS
    once = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    many = once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(10))))
    pick = ("page_id", "template", "verdict", "labels", "purity")
    seen = {tuple(r) for r in url_templates.judge(once, queries.URL_RULES).select(*pick).collect()}
    again = [tuple(r) for r in url_templates.judge(many, queries.URL_RULES).select(*pick).collect()]
    assert len(again) == 10 * len(urls) and set(again) == seen


def test_op7_odd_paths(spark):
    deep = "http://h.net/" + "/".join("abcdefgh")
    rows = [(1, deep), (1, deep), (2, "http://h.net/" + "x" * 200_000), (3, "http://h.net//"), (4, "http://h.net")]
    table = spark.createDataFrame(rows, "page_id long, url string").withColumn("path", F.lit(1)).withColumn("blocked", F.lit(1))
    out = url_templates.judge(table, queries.URL_RULES).collect()
    assert sorted(r.page_id for r in out) == [1, 1, 2, 3, 4] and {r.verdict for r in out} == {"allow"}
    assert {r.template for r in out if r.page_id == 1} == {"/*/*/*/*/*/*/**"}


# -- pipeline ------------------------------------------------------------------


def test_pipeline_stages(spark):
    from test_texts import brute_components, brute_dropped

    read = spark.read.parquet(f"{LARGER}/documents.parquet")
    before = {r.doc_id: r for r in read.collect()}
    docs = read
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, LARGER), "test-stage")
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name != "sentencepiece":
            assert docs.columns == list(corpus_pipeline.COLUMNS)

    scores = {r.doc_id: r.score for r in queries.QUERIES["op6_toxicity"](spark, LARGER).collect()}
    assert set(kept["toxicity"]) == {i for i in before if scores[i] < corpus_pipeline.REJECT_FROM}

    known = {i: r.text for i, r in kept["toxicity"].items()}
    left = {}
    for i, dropped in brute_dropped(known).items():
        lines = known[i].split("\n")
        if not any(x.strip() for x in lines) or any(x.strip() and n not in dropped for n, x in enumerate(lines)):
            left[i] = "\n".join(x for n, x in enumerate(lines) if n not in dropped)
    assert {i: r.text for i, r in kept["line dedup"].items()} == left
    assert all(r.n_chars == len(r.text) for r in kept["line dedup"].values())

    _, roots = brute_components(left)
    assert set(kept["near duplicates"]) == {i for i in left if roots[i] == i}

    items = [t for _, t in rows_of("benchmark", LARGER)]
    leaking = {i for i in kept["near duplicates"] if any(t in left[i] for t in items)}
    gone = set(kept["near duplicates"]) - set(kept["decontamination"])
    assert leaking <= gone and len(gone - leaking) <= 2
    assert set(kept["sentencepiece"]) == set(kept["decontamination"])
    assert all(r.round_trip and len(r.tokens) == r.n_tokens for r in kept["sentencepiece"].values())


CLEAN = " ".join(f"plain{i}" for i in range(40))
ROWS = [(0, CLEAN), (1, None), (2, ""), (3, " \n\t "), (4, "x" * 200_000), (5, " ".join(f"many{i}" for i in range(20_000))),
        (6, " ".join(f"twice{i}" for i in range(40))), (6, " ".join(f"twice{i}" for i in range(40))), (None, None), (None, "nobody's words are kept too")]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, docs, name, stage):
    """Nulls, empty and very long texts, repeated rows, no rows, and columns with the names of results."""
    table = docs(*ROWS)
    for c in ("toxicity", "dropped", "n_lines", "contaminated", "matched", "tokens", "decoded", "key"):
        table = table.withColumn(c, F.lit("taken"))
    before = [tuple(r) for r in table.select(*corpus_pipeline.COLUMNS).collect()]
    out = stage(spark, table, FOLDER)
    if name == "sentencepiece":
        rows = out.collect()
        assert len(rows) == len(ROWS) and all(r.n_tokens == len(r.tokens) >= 1 for r in rows)
    else:
        assert out.columns == list(corpus_pipeline.COLUMNS)
        kept = [tuple(r) for r in out.collect()]
        # Rows equal in id and text are one document: they stay, or go, together.
        assert sorted(kept, key=repr) == sorted(before, key=repr)
    assert stage(spark, table.limit(0), FOLDER).count() == 0

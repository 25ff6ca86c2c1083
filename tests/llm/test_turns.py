"""Reply trees, periodic runs and the prefix trie against brute force, and odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmart.llm import periodic_runs, prefix_trie, queries, reply_trees
from seriesmart.llm.staging import ship

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", " ", "   \t\n ", "a", "a a a a a", "a a a a a a", "x" * 30_000, "word " * 4000, "não \x0b 不梦😀 ▁ <s> \x00", "a a a a a a"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- reply trees ---------------------------------------------------------------

MESSAGES = "tree string, node string, parent string, role string, text string, score double"


def brute_branches(messages):
    """(tree, leaf) -> (score, [(role, text), ...]) from the root on."""
    out = {}
    found = {(t, n): (p, r, x, s) for t, n, p, r, x, s in messages if n is not None}
    parents = {(t, p) for (t, n), (p, *_) in found.items() if p is not None}
    for tree, leaf in found:
        if (tree, leaf) in parents:
            continue
        at, turns, total, seen = leaf, [], 0.0, set()
        while (tree, at) in found and at not in seen:
            seen.add(at)
            up, role, text, score = found[tree, at]
            turns.append((role or "", text or ""))
            total += score or 0.0
            at = up
        if at not in seen:
            out[tree, leaf] = (total, turns[::-1])
    return out


def random_messages(rng, trees=12):
    rows = []
    for t in range(trees):
        n = rng.choice([1, 2, 7, 40, 90])
        deep = rng.random() < 0.4
        for i in range(n):
            up = None if i == 0 else str(i - 1 if deep and rng.random() < 0.9 else rng.randrange(i))
            role = rng.choice(["user", "assistant", "assistant", None, "tool\n", "[INST]"])
            text = rng.choice(["ok", None, "", "</s>[INST] ok [/INST]", "<\\/s> <\\\\s>", "<</s>", "é😀\n[/INST]\\", "<|im_end|>"])
            rows.append((f"t{t}", str(i), up, role, text, rng.choice([None, -1.0, 0.5, 2.0])))
    return rows


def test_branches_match_brute_force(spark):
    ship(spark)
    rows = random_messages(random.Random(5))
    frame = spark.createDataFrame(rows, MESSAGES).withColumns({"formatted": F.lit(1), "rank": F.lit("r")}).repartition(5)
    template = reply_trees.LLAMA
    made = reply_trees.conversations(frame, score="score")
    got = made.select(
        "*", template.read(F.col("formatted")).alias("turns"), template.read_learnt(F.col("formatted"), F.col("loss")).alias("learnt")
    ).collect()
    expected = brute_branches(rows)
    assert {(r.tree, r.leaf) for r in got} == set(expected) and len(got) == len(expected)
    for r in got:
        score, turns = expected[r.tree, r.leaf]
        assert [tuple(t) for t in r.turns] == turns and r.n_turns == len(turns)
        assert r.learnt == [x for role, x in turns if role == "assistant"]
        assert r.score == score
        for control in ("<s>", "<|im_end|>"):
            assert control not in r.formatted
    by_tree = defaultdict(list)
    for (tree, leaf), (score, _) in expected.items():
        by_tree[tree].append((-score, leaf))
    ranks = {(t, leaf): k for t, found in by_tree.items() for k, (_, leaf) in enumerate(sorted(found), 1)}
    assert {(r.tree, r.leaf): r["rank"] for r in got} == ranks
    best = {(r.tree, r.leaf) for r in reply_trees.conversations(frame, score="score", best=2).collect()}
    assert best == {k for k, rank in ranks.items() if rank <= 2}


def test_odd_trees(spark):
    rows = [
        ("t", "a", None, "user", "x", None), ("t", "a", None, "user", "x", None),  # a repeated row
        ("t", "b", "a", "assistant", "y", None), ("t", "b", "a", "assistant", "z", None),  # a repeated message
        ("t", "c", "gone", "assistant", "orphan", None),
        ("t", None, "a", "user", "without an id", None),
        (None, "a", None, "user", "null tree", None), (None, "b", "a", "assistant", None, None),
        ("ring", "p", "q", "user", "1", None), ("ring", "q", "p", "user", "2", None), ("ring", "r", "q", "user", "3", None),
        ("self", "p", "p", "user", "1", None),
    ]
    made = reply_trees.conversations(spark.createDataFrame(rows, MESSAGES).repartition(3))
    got = {(r.tree, r.leaf): r.formatted for r in made.collect()}
    assert got == {
        ("t", "b"): "[INST]user[/INST]x</s>[INST]assistant[/INST]y</s>",
        ("t", "c"): "[INST]assistant[/INST]orphan</s>",
        (None, "b"): "[INST]user[/INST]null tree</s>[INST]assistant[/INST]</s>",
    }
    assert reply_trees.conversations(spark.createDataFrame([], MESSAGES)).count() == 0


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    rng = random.Random(6)
    parts = ["<", ">", "[", "]", "/", "\\", "s", "INST", "</s>", "<s>", "[INST]", "[/INST]", "<|im_start|>", "$1", "\n", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(3000)]
    template = reply_trees.LLAMA
    escaped = template.escape(F.col("text"))
    for text, written, back in spark.createDataFrame([(t,) for t in texts], "text string").select("text", escaped, template.unescape(escaped)).collect():
        assert back == text
        assert not any(c in written for c in template.controls)
    with pytest.raises(ValueError):
        reply_trees.Template(others=("<<SYS>>",))


def test_long_conversation_and_hot_root(spark):
    rows = [("long", str(i), str(i - 1) if i else None, "user", f"turn {i}", None) for i in range(700)]
    rows += [("wide", "0", None, "user", "root", None)] + [("wide", str(i), "0", "assistant", str(i), float(i % 7)) for i in range(1, 1500)]
    made = reply_trees.conversations(spark.createDataFrame(rows, MESSAGES).repartition(4), score="score", best=3)
    got = {(r.tree, r.leaf): r for r in made.collect()}
    assert got["long", "699"].formatted == "".join(f"[INST]user[/INST]turn {i}</s>" for i in range(700))
    assert {k: r["rank"] for k, r in got.items() if k[0] == "wide"} == {("wide", "1000"): 1, ("wide", "1007"): 2, ("wide", "1014"): 3}


# -- periodic runs -------------------------------------------------------------


def brute_runs(words):
    found, n = {}, len(words)
    ids = {w: i for i, w in enumerate(set(words))}
    array = np.array([ids[w] for w in words], np.int64)
    for period in range(1, n // 4 + 1):
        edges = np.diff(np.concatenate(([0], (array[period:] == array[:-period]).astype(int), [0])))
        for begin, end in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
            if end - begin + period >= max(6, 4 * period):
                found.setdefault((int(begin), int(end + period)), period)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def periodic_words(rng):
    words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 5, 50])) for _ in range(rng.choice([0, 1, 5, 6, 20, 60, 150, 700]))]
    for _ in range(rng.randrange(5)):
        if len(words) > 10:
            at, period = rng.randrange(len(words)), rng.randrange(1, max(2, len(words) // 4))
            for i in range(at + period, min(len(words), at + period * rng.randrange(3, 9) + rng.randrange(period))):
                words[i] = words[i - period]
    return words


def test_runs_match_brute_force():
    rng = random.Random(7)
    lists = [periodic_words(rng) for _ in range(900)]
    expected = [brute_runs(w) for w in lists]
    assert periodic_runs.runs_of(lists) == expected
    assert max(r[2] for runs in expected for r in runs) > 60
    assert periodic_runs.runs_of([]) == [] and periodic_runs.runs_of([[]]) == [[]]


def test_synchronising_positions_are_consistent_and_dense():
    rng = random.Random(8)
    words = np.array([rng.randrange(3) for _ in range(3000)] * 2 + [0] * 200 + [rng.randrange(9) for _ in range(900)], np.int64)
    runs = [(s, s + length, q) for s, length, q in brute_runs(words.tolist())]
    for scale in (8, 16, 32):
        at, _ = periodic_runs.synchronising(words, scale, runs)
        chosen, seen = set(at.tolist()), {}
        for i in range(len(words) - 2 * scale + 1):
            context = tuple(words[i : i + 2 * scale])
            assert seen.setdefault(context, i in chosen) == (i in chosen)
        for i in range(len(words) - 3 * scale + 2):
            if not chosen & set(range(i, i + scale)):
                window = words[i : i + 3 * scale - 1]
                assert any((window[q:] == window[:-q]).all() for q in range(1, scale // 4 + 1))


def test_runs_of_odd_rows(docs):
    frame = docs(*[(i if i % 3 else None, t) for i, t in enumerate(ODD)]).withColumns({"runs": F.lit("mine"), "collapsed": F.lit(3)})
    for batch_bytes in (periodic_runs.BATCH_BYTES, 10):
        out = periodic_runs.annotate(frame, batch_bytes=batch_bytes).collect()
        got = sorted((r.doc_id or 0, r.text or "", r.n_words, [tuple(x) for x in r["_runs"]], r["_collapsed"], r.runs, r.collapsed) for r in out)
        expected = []
        for i, t in enumerate(ODD):
            words = (t or "").encode().split()
            runs = brute_runs(words)
            expected.append((i if i % 3 else 0, t or "", len(words), runs, brute_collapsed(words, runs), "mine", 3))
        assert got == sorted(expected)
    assert periodic_runs.annotate(frame.limit(0)).count() == 0


def brute_op12(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *longest, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(brute_collapsed(words, runs)))


def test_op12_on_whole_documents(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op12_periodic_runs"](spark, FOLDER).collect()}
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())
    assert got == {i: brute_op12(i, t) for i, t in texts.items()}
    assert sum(v[0] > 0 for v in got.values()) > 10


def test_op12_of_odd_rows(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD * 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()}
    assert got == {i: brute_op12(i, t) for i, t in rows}


# -- prefix trie ---------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def brute_trie(convs):
    """Node rows of {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in children[node])
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
    return sorted(
        (
            min(found), len(node), min(members[node[:-1]]) if node else -1, len(found), len(children[node]), leaves[node],
            saved[node], sha(",".join(map(str, sorted(ends[node])))),
        )
        for node, found in members.items()
    )


def trie_rows(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if v is None else v for v in (r[c] for c in columns)) for r in df.collect())


@pytest.mark.parametrize("limit", [1, 9, 60, 65_536])
def test_trie_matches_brute_force(spark, limit):
    rng = random.Random(limit)
    common = [("user", f"shared {i}") for i in range(30)]
    convs = {}
    for c in range(400):
        turns = list(common[: rng.choice([0, 0, 1, 3, 29, 30])])
        turns += [(rng.choice(["user", "assistant"]), rng.choice(["a", "é", "", "long text"])) for _ in range(rng.randrange(5))]
        convs[c * 977 - 5000] = turns
    for c in range(200):
        convs[10**12 + c * 3000] = common[:7]
    rows = [(c, n, role, text) for c, turns in convs.items() for n, (role, text) in enumerate(turns)]
    said = prefix_trie.sequences(spark.createDataFrame(rows, TURNS).repartition(4), "conv_id", "turn")
    turnless = spark.createDataFrame([(c, None) for c, t in convs.items() if not t], f"conv_id long, turns {prefix_trie.TURNS}")
    both = said.unionByName(turnless).withColumns({"members": F.lit("x"), "container": F.lit(1)})
    assert trie_rows(prefix_trie.nodes(both, limit=limit)) == brute_trie(convs)


def test_trie_of_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, "x"), (1, 1, "", None), (2, None, "user", "first"), (2, 5, "", "x"), (2, 9, None, ""),
        (None, 0, "user", "nobody"), (3, 0, "user", "z" * 40_000), (3, 1, "user", "z" * 40_000), (4, 0, "us", "er"), (5, 0, "user", ""),
    ]
    said = prefix_trie.sequences(spark.createDataFrame(rows, TURNS).withColumn("id", F.lit(0)).repartition(3), "conv_id", "turn")
    same = [("user", "first"), ("", "x"), ("", "")]
    expected = brute_trie({1: same, 2: same, 3: [("user", "z" * 40_000)] * 2, 4: [("us", "er")], 5: [("user", "")]})
    for limit in (1, 100):
        assert trie_rows(prefix_trie.nodes(said, limit=limit)) == expected
    assert prefix_trie.nodes(said.limit(0)).count() == 0


def test_op13_matches_brute_force(spark, tmp_path):
    rng = random.Random(11)
    rows = []
    for c in (c for c in range(300) if c % 7):
        turns = list(range(rng.randrange(1, 12)))
        rows += [(c, None if n == 0 and c % 3 == 0 else n, rng.choice(["user", None]), rng.choice(["a", "b", None])) for n in turns]
    spark.createDataFrame(rows, TURNS).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    own = defaultdict(list)
    for c, n, role, text in sorted(rows, key=lambda r: (r[0], -1 if r[1] is None else r[1])):
        own[c].append((role or "", text or ""))
    convs = {}
    for c in list(own):
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    assert any(not t for t in convs.values())
    assert trie_rows(queries.QUERIES["op13_prefix_trie"](spark, str(tmp_path))) == brute_trie(convs)

"""The registered queries over the text, vector and page tables, with their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (
    fuzzy_lines, minhash_docs, neighbour_graph, periodic_runs, piece_bpe, prefix_trie, reply_trees, sharding, spaced_seeds,
    toxicity, training_order, unigram_count, url_templates,
)
from .staging import numbered, shared_path, ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op9_piece_bpe")
def op9_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = piece_bpe.encode(docs, model).select("doc_id", "tokens")
    return piece_bpe.decode(encoded, model).select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op1_minhash_near_dedup")
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_docs.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_unigram_counts")
def op5_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return unigram_count.count_tokens(docs, vocabulary("piece_bpe_32k.model")).select("doc_id", "n_tokens")


@query("op2_training_order")
def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per written sequence, with the digest of its record as read from the
    shard file and the ids of the documents it holds."""
    import public_tokenizers

    path = shared_path(spark, "training-order")
    places = training_order.materialise(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        path, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
    )
    held = places.groupBy("slot").agg(
        F.first("seq").alias("seq"),
        F.sum("n").alias("n_tokens"),
        F.transform(F.sort_array(F.collect_list(F.struct("place", "doc_id"))), lambda x: x["doc_id"]).alias("doc_ids"),
    )
    records = training_order.read_slots(spark, path).select(
        "slot", "shard", "byte_offset", F.crc32("ids").alias("ids_crc32")
    )
    return records.join(held, "slot").select("slot", "shard", "byte_offset", "seq", "n_tokens", "doc_ids", "ids_crc32")


_DIGEST = "CAST(('0x' || substr(md5(doc_id || ':' || {s}), 1, 13)) AS BIGINT)"


def _rendezvous_sql(shards: int) -> str:
    """The shard of the largest digest: of equal weights it has the largest score."""
    listed = ", ".join(f"{{'d': {_DIGEST.format(s=s)}, 's': {-s}}}" for s in range(shards))
    return f"CAST(-list_max([{listed}]).s AS INTEGER)"


@query(
    "op3_rendezvous_shards",
    f"""
WITH crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n] || range(8), lambda c, i:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(n))),
bytes AS (
  SELECT *, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
    lambda h: CAST('0x' || h AS BIGINT)) AS b
  FROM documents),
sharded AS (
  SELECT doc_id, xor(list_reduce([4294967295] || b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)
      AS text_crc32, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size, 'key' AS law,
    {_rendezvous_sql(8)} AS shard, {_rendezvous_sql(9)} AS grown_shard
  FROM bytes, crc_table)
SELECT doc_id, size, text_crc32, law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM sharded""",
)
def op3_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards and slots of every row, repeated ones too; null ids are one key, null texts
    empty ones. Other columns are not read; an empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    sharded = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        sharding.shard_of(F.col("doc_id"), [1.0] * 8).alias("shard"),
        sharding.shard_of(F.col("doc_id"), [1.0] * 9).alias("grown_shard"),
    )
    return numbered(sharded, ["doc_id"], "shard", "slot", "shards").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


URL_RULES = [
    url_templates.Rule("allow", "com/"),
    url_templates.Rule("block", "example.com/en/"),
    url_templates.Rule("allow", "www.example.com/en/"),
    url_templates.Rule("block", "net/es/"),
    url_templates.Rule("block", "net/fr/"),
]


@query("op7_url_templates")
def op7_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


@query("op8_spaced_seeds")
def op8_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: whether it holds benchmark text, of which items, and how much."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return spaced_seeds.contaminated(docs, items)


def held_out(doc_id: str = "doc_id") -> Column:
    """The third of the ids of which no label is learnt."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    index = toxicity.learn(docs, labels, ~held_out())
    return toxicity.score(docs, index).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.transform("evidence", lambda e: e["doc_id"]).alias("evidence"),
    )


@query("op10_fuzzy_lines")
def op10_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines, the numbers of those dropped, and the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fuzzy_lines.dedup_lines(docs).select(
        "doc_id", "n_lines", "dropped", F.octet_length("text").cast("long").alias("kept_bytes"), F.md5("text").alias("kept_md5")
    )


@query("op4_neighbour_graph")
def op4_neighbour_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbour_graph.nearest(vectors, F.col("id") % 20 == 0)


_ESCAPED = r"""regexp_replace(regexp_replace({x}, '<(\\*(?:/s>|s>|\|im_start\|>|\|im_end\|>|\|endoftext\|>))', '<\\\1', 'g'),
  '\[(\\*(?:INST\]|/INST\]))', '[\\\1', 'g')"""


@query(
    "op11_reply_trees",
    f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM said)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_ESCAPED.format(x='role')}) + length({_ESCAPED.format(x='text')}) + 17) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id""",
)
def op11_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, a tree of one branch, read back from its formatted text."""
    said = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    planted = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", planted), (-1, 1, "assistant", planted)], said.schema)
    template = reply_trees.LLAMA
    formatted = reply_trees.conversations(reply_trees.chains(said.union(more), "conv_id", "turn"), template=template, repeats=False)
    read = formatted.select(
        F.col("tree").alias("conv_id"), "formatted", template.read(F.col("formatted")).alias("turns"),
        F.array_join(template.read_learnt(F.col("formatted"), F.col("loss")), "").alias("learnt"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def with_periods(doc_id: Column, text: Column) -> Column:
    """The text, made periodic from some word on where the id's checksum ends in 0."""
    sums = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(sums / 10)

    def periodic(words: Column) -> Column:
        n = F.size(words)
        at = (g % F.greatest(n, F.lit(1))).cast("int")
        period = (F.floor((n - at) / (3 + g % 8)) + 1).cast("int")
        # The period is more than a tenth of the words it fills.
        filled = F.flatten(F.array_repeat(F.slice(words, at + 1, period), 10))
        return F.array_join(F.concat(F.slice(words, 1, at), F.slice(filled, 1, n - at)), " ")

    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    made = F.transform(F.array(words), periodic)[0]
    return F.when(sums % 10 == 0, made).otherwise(text)


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", with_periods(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.annotate(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@query(
    "op13_prefix_trie",
    """
WITH crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n] || range(8), lambda c, i:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(n))),
turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n, octet_length(encode(coalesce(text, ''))) AS bytes,
    md5(coalesce(role, '') || chr(10) || coalesce(text, '')) AS said
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, size, xor(list_reduce([4294967295] || list_transform(range(length(c::VARCHAR)), lambda i: ascii(substr(c::VARCHAR, i + 1, 1))::BIGINT),
    lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT c, count(*) AS size FROM turns GROUP BY c), crc_table),
rebuilt AS (
  SELECT k.c, t.n AS d, said, bytes FROM convs k JOIN turns t ON t.c = k.c - k.c % 5 AND t.n <= k.h
  UNION ALL
  SELECT k.c, least(k.h, coalesce(b.size, 0)) + t.n - k.h, said, bytes
  FROM convs k JOIN turns t ON t.c = k.c AND t.n > k.h LEFT JOIN convs b ON b.c = k.c - k.c % 5),
prefixes AS (
  SELECT c, 0 AS d, '' AS p, 0 AS bytes FROM convs
  UNION ALL SELECT c, d, md5(string_agg(said, '' ORDER BY d) OVER (PARTITION BY c ORDER BY d)), bytes FROM rebuilt),
lengths AS (SELECT c, max(d) AS size FROM prefixes GROUP BY c),
trie AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = size), '')) AS ends_sha256
  FROM prefixes JOIN lengths USING (c) GROUP BY d, p),
linked AS (
  SELECT x.*, u.p AS up, (SELECT t.conv_id FROM trie t WHERE t.d = x.d - 1 AND t.p = u.p) AS parent_conv_id
  FROM trie x LEFT JOIN prefixes u ON u.c = x.conv_id AND u.d = x.d - 1),
counted AS (SELECT x.*, (SELECT count(*) FROM linked y WHERE y.d = x.d + 1 AND y.up = x.p) AS n_children FROM linked x),
sums AS (
  SELECT a.d, a.p, sum(x.saved) AS saved_tokens, count(*) FILTER (x.n_children = 0) AS n_leaves
  FROM counted x JOIN prefixes a ON a.c = x.conv_id AND a.d <= x.d GROUP BY a.d, a.p)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN sums USING (d, p)""",
)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = prefix_trie.sequences(table(spark, sf_dir, "conversations").where("conv_id IS NOT NULL"), "conv_id", "turn")
    base = F.col("conv_id") - F.col("conv_id") % 5
    firsts = said.where(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("firsts"))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    none = F.array().cast(prefix_trie.TURNS)
    rebuilt = F.concat(F.coalesce(F.slice("firsts", 1, shared), none), F.slice("turns", shared + 1, F.size("turns")))
    seqs = said.withColumn("base", base).join(firsts, "base", "left").select("conv_id", rebuilt.alias("turns"))
    return prefix_trie.nodes(seqs)

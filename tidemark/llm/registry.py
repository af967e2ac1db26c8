"""The queries of the training-data operators over the driver tables, and their DuckDB SQL.

Queries whose method SQL cannot express (boosted trees, tiling, tokenizing and
packing, bin packing, the window network) have no SQL;
``tests/llm`` holds them against brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, language, minhash, packing, passages, periodic, quality, secrets, sharding, substrings, tiling, trie, urls
from tidemark.llm.common import table
from tidemark.llm.secrets_sql import SECRETS_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op1_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies."""
    return minhash.near_classes(table(spark, sf_dir, "documents"))


@query
def op2_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged; a page's url ends in the number of its document, whose quality label it takes."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    numbered = pages.select("url", F.regexp_extract("url", r"/(\d{1,18})", 1).alias("number")).where(F.col("number") != "")
    labelled = numbered.join(labels, F.col("number").cast("bigint") == F.col("doc_id")).select("url", (1 - F.col("quality")).alias("bad"))
    return urls.judge_urls(pages, labelled)


@query
def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that occur earlier."""
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op5_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contaminated document with the items it contains."""
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight shards of near equal bytes."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings, formatted and read back."""
    first = F.col("id") == 0
    odd = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(first, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    chats = chat.format_chats(turns)
    chats = chats.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("learned", chat.learned(F.col("formatted"), F.col("loss")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query
def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's rule features and verdict."""
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@query
def op9_randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda t: t["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans"),
    )


@query
def op10_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pseudo-log-likelihood."""
    return language.score_documents(table(spark, sf_dir, "documents"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs, after a tenth of the documents were made periodic."""
    found = periodic.periodic_runs(periodic.planted(table(spark, sf_dir, "documents")))
    order = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", order)
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.floor(1000 * F.col("best.n") / -F.col("best.q")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


@query
def op12_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality; a fifth of the ids (by checksum) is never learnt from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = passages.fit(docs, labels.where(~held_out).select("doc_id", F.col("quality").alias("label")))
    out = passages.score_documents(docs, model)
    return out.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_passages", "top_word", "top_weight"
    )


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    turns, convs = trie.rebuilt(table(spark, sf_dir, "conversations"))
    ends = F.sha2(F.array_join(F.col("ends").cast("array<string>"), ","), 256)
    nodes = trie.prefix_trie(turns, convs).withColumn("ends_sha256", ends)
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE["op1_bag_minhash"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, text, {_WORDS} AS w FROM documents),
shingle AS (
    SELECT doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
bag AS (SELECT doc_id, s, count(*) AS n FROM shingle GROUP BY ALL),
total AS (SELECT doc_id, sum(n) AS n FROM bag GROUP BY doc_id),
meet AS (
    SELECT a.doc_id AS u, b.doc_id AS v, sum(least(a.n, b.n)) AS n
    FROM bag a JOIN bag b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
    SELECT u, v FROM meet JOIN total x ON x.doc_id = u JOIN total y ON y.doc_id = v
    WHERE 10 * meet.n >= 8 * (x.n + y.n - meet.n)
    UNION SELECT a.doc_id, b.doc_id FROM d a JOIN d b ON a.text = b.text AND a.doc_id <> b.doc_id),
reach AS (
    SELECT doc_id AS node, doc_id AS other FROM d
    UNION SELECT reach.node, link.v FROM reach JOIN link ON link.u = reach.other)
SELECT node AS doc_id, min(other) AS class_id FROM reach GROUP BY node
"""

ORACLE["op3_substrings"] = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
win AS (
    SELECT doc_id, i, list_aggregate(w[i:i + 19], 'string_agg', ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
judged AS (
    SELECT word.doc_id, word.i, word.word,
        max(later.i) OVER (PARTITION BY word.doc_id ORDER BY word.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
    FROM word LEFT JOIN later ON later.doc_id = word.doc_id AND later.i = word.i)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(x.gone, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(x.kept, '')) AS kept_sha256
FROM d LEFT JOIN (
    SELECT doc_id, sum(gone::INT) AS gone, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM judged GROUP BY doc_id
) x ON x.doc_id = d.doc_id
"""

ORACLE["op7_chat_format"] = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
x AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
        length(regexp_replace(text, '[\\\[<]', '..', 'g')) AS n, length(regexp_replace(role, '[\\\[<\]]', '..', 'g')) AS m
    FROM t)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(n + CASE WHEN before = role THEN 3 ELSE m + 8 END) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id
"""

# each rule: whether a document fails it, its share, the limit of the share
_RULES_SQL = (
    ("base", "base_failed", "0", "1"),
    ("symbols", "symbols > 0.1", "symbols", "0.1"),
    ("lines", "dup_lines > 0.5", "dup_lines", "0.5"),
    ("long", "chars > 10", "chars", "10"),
    ("short", "1 / nullif(chars, 0) > 1 / 3", "1 / nullif(chars, 0)", "1 / 3"),
)
ORACLE["op8_host_rules"] = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
lines AS (
    SELECT doc_id, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM d),
gram AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_aggregate(w[i:i + 2], 'string_agg', ' ')) AS n
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
repeated AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM gram, (VALUES (0), (1), (2)) AS t(j) WHERE gram.n > 1 GROUP BY doc_id),
feature AS (
    SELECT d.doc_id, d.source, CAST(len(w) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum([length(x) for x in w]), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines
    FROM d JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_lines,
        coalesce(word_chars / nullif(n_words, 0), 0) AS chars
    FROM feature),
failed AS (
    {" UNION ALL ".join(f"SELECT source, '{r}' AS rule, coalesce({fails}, false)::INT AS f FROM judged" for r, fails, _, _ in _RULES_SQL)}),
host AS (SELECT source, rule, count(*) AS n, sum(f) AS f FROM failed GROUP BY ALL),
fit AS (
    SELECT rule, sum(f) / sum(n) AS mean, greatest(sum(n * (f / n) * (f / n)) / sum(n) - (sum(f) / sum(n)) ** 2, 1e-9) AS spread
    FROM host GROUP BY rule),
prior AS (SELECT rule, mean, greatest(mean * (1 - mean) / spread - 1, 0) AS strength FROM fit),
rate AS (SELECT source, rule, (f + mean * strength) / (n + strength) AS rate FROM host JOIN prior USING (rule)),
verdict AS (
    SELECT source, max(rate) > 0.5 AS bad, {", ".join(f"max(rate) FILTER (rule = '{r}') AS rate_{r}" for r, _, _, _ in _RULES_SQL)}
    FROM rate GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT bad AND {" AND ".join(f"coalesce({share}, 0) <= ({limit}) * (1 - rate_{r})" for r, _, share, limit in _RULES_SQL[1:])} AS kept
FROM judged JOIN verdict ON judged.source IS NOT DISTINCT FROM verdict.source
"""

ORACLE["op9_randomness"] = SECRETS_SQL

ORACLE["op13_prefix_trie"] = r"""
WITH t AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base,
        xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
            lambda h, b: list_reduce([xor(h, b)] || range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
    SELECT c.conv_id, place, role, text FROM c JOIN t ON t.conv_id = c.base AND place < h
    UNION ALL SELECT c.conv_id, place + 6, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND place >= h),
path AS (
    SELECT conv_id, row_number() OVER w AS d, length(text) AS chars, string_agg(sha256(sha256(role) || text), '') OVER w AS p
    FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY place)
    UNION ALL SELECT conv_id, 0, 0, '' FROM c),
size AS (SELECT conv_id, max(d) AS n FROM path GROUP BY conv_id),
node AS (
    SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = n) AS ends
    FROM path JOIN size USING (conv_id) GROUP BY p, d),
up AS (SELECT node.*, a.p AS parent FROM node LEFT JOIN path a ON a.conv_id = node.conv_id AND a.d = node.d - 1),
child AS (SELECT parent AS p, d - 1 AS d, count(*) AS n FROM up WHERE d > 0 GROUP BY ALL),
below AS (
    SELECT a.p, a.d, sum((u.n_convs - 1) * u.chars) AS saved, count(*) FILTER (child.n IS NULL) AS leaves
    FROM node u LEFT JOIN child ON child.p = u.p AND child.d = u.d JOIN path a ON a.conv_id = u.conv_id AND a.d <= u.d GROUP BY a.p, a.d)
SELECT up.conv_id, up.d AS depth, above.conv_id AS parent_conv_id, up.n_convs, coalesce(child.n, 0) AS n_children,
    below.leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, sha256(coalesce(up.ends, '')) AS ends_sha256
FROM up JOIN below ON below.p = up.p AND below.d = up.d
LEFT JOIN child ON child.p = up.p AND child.d = up.d LEFT JOIN node above ON above.p = up.parent AND above.d = up.d - 1
"""

"""The registered queries: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstrata.llm import (
    bpe, chat, decontaminate, embeddings, hard_negatives, language, packing, prefix_trie, secrets, simhash, substrings,
    toxicity, url_filters,
)
from marketstrata.llm.common import table
from marketstrata.session import stored

#: Fixed values of the URL query: host, path, action.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors, stored once; their recall against brute force is measured and must reach 0.9."""
    found = stored(embeddings.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98), "near-vectors")
    embeddings.require_recall(found, 0.9)
    return found.drop("audit_links")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and lexed secrets of every whole text."""
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the fixed rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    judged = url_filters.match_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the place and the shares that confirm it."""
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    finder = decontaminate.fit_leak_finder(documents, benchmark)
    return decontaminate.benchmark_leaks(documents, finder, benchmark.schema["item_id"].dataType.simpleString())


def tokenizer_path() -> str:
    """The tokenizer named by the packing query's contract."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message in canonical JSON, with what is known of its calls or its result."""
    return chat.format_chat(table(spark, sf_dir, "conversations"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), width=3, seed=42, budget=3)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from the documents that are not held out."""
    documents = table(spark, sf_dir, "documents")
    return language.identify_language(documents, language.train_language(documents))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from the labels that are not held out."""
    documents = table(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(documents, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(documents, model)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that a document with a smaller id holds in the same window."""
    return substrings.remove_repeated(table(spark, sf_dir, "documents"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, and decoded from its ids; a NULL text is empty. One row per document row."""
    vocabulary = bpe.read_vocabulary(tokenizer_path())
    encoded = bpe.encode_texts(table(spark, sf_dir, "documents"), vocabulary)
    digest = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    counted = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), "ids")
    decoded = bpe.decode_ids(counted, vocabulary)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie over all conversations, rebuilt with the first turns of every twentieth one."""
    lists = prefix_trie.turn_lists(table(spark, sf_dir, "conversations"), every=20)
    return prefix_trie.prefix_trie(prefix_trie.shared_starts(lists, most=4))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows against the anchors, every fiftieth id; the label of every seventh is moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=moved)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_url_filter": op3_url_filter,
    "op4_decontamination": op4_decontamination,
    "op5_packing": op5_packing,
    "op6_chat_format": op6_chat_format,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_language_id": op8_language_id,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_bpe": op11_bpe,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
}

_HOST = r"""CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END"""
_PATH = r"""CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END"""

#: CRC-32 of a decimal id: each byte is added, then eight times (marked 256) the register is shifted.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(
  string_split(conv_id::VARCHAR, ''), lambda s: list_concat([ascii(s)::UBIGINT], list_transform(range(8), lambda k: 256::UBIGINT))))),
  lambda a, x: CASE WHEN x < 256 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""

ORACLE: dict[str, str] = {
    "op1_embedding_dedup": """
WITH RECURSIVE vectors AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
fit AS (SELECT * FROM vectors WHERE label IS NOT NULL AND v IS NOT NULL
  AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM fit AS a JOIN fit AS b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach(x, y) AS (SELECT vec_id, vec_id FROM vectors UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
components AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
counts AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN components USING (vec_id) LEFT JOIN counts USING (vec_id)""",
    "op10_substring_dedup": """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
windows AS (SELECT r, doc_id, i, sha256(array_to_string(list_slice(ws, i, i + 49), ' ')) AS k
  FROM (SELECT *, unnest(range(1, len(ws) - 48)) AS i FROM texts WHERE len(ws) >= 50 AND doc_id IS NOT NULL)),
firsts AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
gone AS (SELECT DISTINCT r, i + j AS p FROM (SELECT r, i, unnest(range(50)) AS j FROM windows JOIN firsts USING (k) WHERE first < doc_id)),
words AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM texts),
judged AS (SELECT r, string_agg(w, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS kept, count(gone.p) AS n
  FROM words LEFT JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN judged USING (r)""",
    "op12_prefix_trie": f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
rebuilt AS (
  SELECT c.conv_id, 0 AS half, n, r, x FROM convs AS c JOIN own ON own.conv_id = base AND n <= h
  UNION ALL SELECT c.conv_id, 1, n, r, x FROM convs AS c JOIN own ON own.conv_id = c.conv_id AND n > h),
turns AS (
  SELECT conv_id, r || ':' || md5(x) AS t, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY half, n) AS d FROM rebuilt),
lists AS (
  SELECT c.conv_id, coalesce(list(t ORDER BY d) FILTER (t IS NOT NULL), []) AS ts,
    coalesce(list(words ORDER BY d) FILTER (t IS NOT NULL), []) AS ws FROM convs AS c LEFT JOIN turns USING (conv_id) GROUP BY 1),
prefixes AS (
  SELECT conv_id, d, len(ts) = d AS stops, list_slice(ts, 1, d) AS p, coalesce(ws[d], 0) AS words
  FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM lists)),
nodes AS (
  SELECT d, md5(p::VARCHAR) AS id, any_value(p) AS p, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * max(words) AS own_saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (stops), '')) AS ends_sha256
  FROM prefixes GROUP BY d, p),
children AS (SELECT d - 1 AS d, md5(list_slice(p, 1, d - 1)::VARCHAR) AS id, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
above AS (
  SELECT up AS d, md5(list_slice(p, 1, up)::VARCHAR) AS id, sum(own_saved) AS saved, count(*) FILTER (leaf) AS leaves
  FROM (SELECT nodes.*, children.n IS NULL AS leaf, unnest(range(nodes.d + 1)) AS up FROM nodes LEFT JOIN children USING (d, id))
  GROUP BY 1, 2)
SELECT nodes.conv_id, nodes.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, nodes.n_convs,
  coalesce(children.n, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN above USING (d, id) LEFT JOIN children USING (d, id)
LEFT JOIN nodes AS parent ON parent.d = nodes.d - 1 AND parent.id = md5(list_slice(nodes.p, 1, nodes.d - 1)::VARCHAR)""",
    "op13_hard_negatives": """
WITH vectors AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT row_number() OVER () AS row, * FROM vectors WHERE vec_id % 50 = 0),
scored AS (
  SELECT a.row, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CASE WHEN len(a.v) = 0 THEN 0 ELSE list_dot_product(a.v, b.v) END::BIGINT AS score
  FROM anchors AS a JOIN vectors AS b ON len(a.v) = len(b.v)),
positives AS (
  SELECT row, anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same AND other <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, other) <= 5),
wanted AS (
  SELECT p.row, s.positive_score, p.other AS negative_id, p.score AS negative_score,
    row_number() OVER (PARTITION BY p.row, s.positive_score ORDER BY p.score DESC, p.other) AS rank
  FROM (SELECT DISTINCT row, positive_score FROM positives) AS s JOIN scored AS p ON p.row = s.row AND NOT same
    AND 50 * s.positive_score <= 100 * p.score AND 100 * p.score <= 95 * s.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM positives JOIN wanted USING (row, positive_score) WHERE rank <= 3""",
    "op3_url_filter": f"""
WITH p AS (SELECT page_id, row_number() OVER () AS r, {_HOST} AS host, {_PATH} AS path FROM pages),
rules(h, q, action) AS (VALUES {", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)}),
m AS (SELECT r, arg_max(h || q, length(h) * 10000 + length(q)) AS rule,
 arg_max(action, length(h) * 10000 + length(q)) AS action
 FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN m USING (r)""",
}

"""One query for each operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.llm import (
    decontaminate, embedding_dedup, language_id, licenses, manifest, near_dedup, packing, sentencepiece_codec,
    sharding, spelling, substring_dedup, token_counts, toxicity,
)
from funnelspark.llm.common import table

#: Where the public vocabularies lie.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def remainder(id_column: str, n: int) -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % n


def edits_of(docs: DataFrame) -> DataFrame:
    """``docs`` with three edits each, placed by hash: a deletion, an insertion, a replacement."""
    size = F.length(F.coalesce("text", F.lit("")))

    def place(seed: int) -> Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(seed)), size + 1)

    def change(start: Column, length: int, insert: Column) -> Column:
        return F.struct(
            start.alias("start"), F.lit(length).cast("long").alias("length"), insert.alias("insert")
        )

    edits = F.array(
        change(place(1), 12, F.lit("")),
        change(place(2), 0, F.concat(F.lit(" ("), F.coalesce("source", F.lit("?")), F.lit(") "))),
        change(place(3), 7, F.lit("  \n edited  x1")),
    )
    return docs.withColumn("edits", F.when(F.col("text").isNotNull(), edits).cast(token_counts.EDITS))


def op1_edit_aware_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = sentencepiece_codec.read_model(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    docs = edits_of(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    counted = token_counts.count(docs, ranks, PATTERN)
    return token_counts.recount(counted, ranks, PATTERN).select(
        "doc_id", "n_tokens", "n_edits", "n_tokens_edited", "chars_encoded",
        F.length("text").cast("long").alias("n_chars_edited"),
    )


def op2_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), 24)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.fitted(docs)).select("doc_id", "n_paragraphs", "statements")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = F.aggregate(
        "hit_spans", F.lit(0).cast("long"), lambda n, span: n + span["last"] - span["first"] + F.lit(1)
    )
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs).select("doc_id", "class_id", "kept")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece_codec.read_model(f"{TOKENIZERS}/piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode(docs, model).select("doc_id", "n_tokens", "same", "ids")


def op7_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    return toxicity.tag(docs, toxicity.fitted(docs, labels)).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "spans",
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fitted(docs.where(remainder("doc_id", 4) != 2))
    return language_id.identify(docs.drop("lang"), model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op9_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.links(table(spark, sf_dir, "embeddings"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = sentencepiece_codec.read_model(f"{TOKENIZERS}/word_bpe_49k.json").decode()
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants_of(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    text = F.col("text")
    lowered = F.when(remainder("doc_id", 3) == 0, F.translate(text, _UPPER, _UPPER.lower())).otherwise(text)
    return manifest.manifest(docs, docs.columns, "lang", "doc_id", {"text": lowered})


QUERIES = {
    job.__name__: job
    for job in (
        op1_edit_aware_token_counts, op2_sampled_splitters, op3_license_scan, op4_decontaminate,
        op5_order_minhash, op6_sentencepiece, op7_toxic_spans, op8_language_id, op9_embedding_links,
        op10_substring_dedup, op11_best_fit_packing, op12_spelling_variants, op13_merkle_manifest,
    )
}

_PLAIN = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

# The table of the checksum by its rule, and the checksum of a text.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    [i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crcs
)"""


def _crc(text: str) -> str:
    data = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || hex(encode({text}))[2 * i + 1 : 2 * i + 2])::BIGINT)"
    step = "lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce([4294967295] || {data}, {step}), 4294967295)"


def _leaf(text: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    parts = " || ".join(f"coalesce(octet_length(encode({x})) || ':' || {x}, '-')" for x in fields)
    return f"sha256({parts})"


ORACLE = {
    "op4_decontaminate": f"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
b AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
g AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS id, least(len(w), 10) AS n,
    array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT n FROM g),
runs AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)
),
hits AS (SELECT doc_id, i, n, id FROM runs JOIN g USING (n, gram)),
hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op9_embedding_links": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM roots LEFT JOIN counts USING (vec_id)
""",
    "op10_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
),
firsts AS (SELECT gram, min(doc_id) AS first FROM windows GROUP BY gram),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM windows JOIN firsts USING (gram) WHERE first < doc_id
),
words AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
""",
    "op12_spelling_variants": rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[a-zÀ-ÿ]{{7,}}')) AS run
    FROM documents
  ) GROUP BY doc_id, run
),
hashed AS (SELECT run, n, {_crc("doc_id || ':' || run")} AS h FROM runs, crc_table),
cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM hashed
),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
holes AS (
  SELECT word, n, i, word[:i] AS l, word[i + 2 :] AS q FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
pairs AS (
  SELECT a.word, b.word AS near, b.n FROM holes AS a JOIN holes AS b ON a.l = b.l AND a.q = b.q AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes AS a JOIN words AS b ON a.l || a.q = b.word
  UNION SELECT b.word, a.word, a.n FROM holes AS a JOIN words AS b ON a.l || a.q = b.word
),
ranked AS (
  SELECT word, near, n, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place,
    count(*) OVER (PARTITION BY word) AS n_near
  FROM pairs
),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN r.n >= 10 * w.n THEN near END AS form, CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
  FROM words AS w LEFT JOIN ranked AS r ON r.word = w.word AND place = 1
),
chains(word, upto) AS (
  SELECT word, word FROM words
  UNION SELECT chains.word, form FROM chains JOIN formed ON formed.word = chains.upto WHERE form IS NOT NULL
),
ends AS (
  SELECT chains.word, upto AS root FROM chains JOIN formed ON formed.word = chains.upto WHERE form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
""",
    "op13_merkle_manifest": rf"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree,
    {_leaf("text")} AS leaf,
    CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 3 = 0
      THEN {_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} ELSE {_leaf("text")} END AS other
  FROM documents, crc_table
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
    count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
),
nodes(level, tree, r, n, d) AS (
  SELECT 0, tree, r, n, leaf FROM ranked
  UNION ALL
  SELECT level + 1, tree, r // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY r))
  FROM nodes WHERE n > 1 GROUP BY level, tree, n, r // 8
),
subroots AS (
  SELECT tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS r, count(*) OVER () AS n FROM nodes WHERE n = 1
),
upper(level, r, n, d) AS (
  SELECT 0, r, n, subroot FROM subroots
  UNION ALL
  SELECT level + 1, r // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY r))
  FROM upper WHERE n > 1 GROUP BY level, n, r // 8
),
every AS (
  SELECT 0 AS part, level, tree, r, n, d FROM nodes UNION ALL SELECT 1, level, '', r, n, d FROM upper
),
steps AS (
  SELECT part, level, tree, r,
    coalesce(string_agg(d, '') OVER (run ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER (run ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS q
  FROM every WHERE n > 1 WINDOW run AS (PARTITION BY part, level, tree, r // 8)
),
ids AS (
  SELECT row_number() OVER () AS row_id, k.doc_id, k.tree, k.leaf, k.other, k.r, s.r AS s_r, subroot
  FROM ranked AS k JOIN subroots AS s ON s.tree = k.tree
),
met AS (
  SELECT row_id, part, level, l, q FROM ids JOIN steps
    ON part = 0 AND steps.tree = ids.tree AND steps.r = ids.r >> CAST(3 * level AS BIGINT)
  UNION ALL
  SELECT row_id, part, level, l, q FROM ids JOIN steps ON part = 1 AND steps.r = s_r >> CAST(3 * level AS BIGINT)
),
paths AS (SELECT row_id, list({{'l': l, 'q': q}} ORDER BY part, level) AS path FROM met GROUP BY row_id),
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT d FROM upper WHERE n = 1) AS root,
    sha256(list_reduce([''] || list_transform(coalesce(path, []), lambda x: x.l || x.q), lambda a, b: a || b)) AS proof_sha256,
    list_reduce([{{'l': other, 'q': ''}}] || coalesce(path, []),
      lambda a, x: {{'l': sha256(x.l || a.l || x.q), 'q': ''}}).l AS folded_root
  FROM ids LEFT JOIN paths USING (row_id)
)
SELECT *, folded_root = root AS verified FROM folded
""",
}

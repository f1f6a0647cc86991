"""The operators as named queries over the whole given tables, and what SQL can say of them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    ann,
    conversation_repair,
    decontamination,
    html_extraction,
    jaccard_join,
    language_id,
    licenses,
    packing,
    pii,
    sharding,
    spelling,
    suffix_dedup,
    token_counts,
)

#: Folder of the tokenizer files; ``None`` for those of the installed package.
TOKENIZERS: str | None = None
TOKEN_LIMIT, SEQUENCE_TOKENS, END_ID, SHARDS = 4096, 1024, 2, 40
REPEATED_BYTES, SLIPS = 400, 199


def tokenizer(name: str) -> str:
    return f"{TOKENIZERS}/{name}" if TOKENIZERS else public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), TOKEN_LIMIT)
    over = (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    return counted.select("doc_id", "n_bytes", "n_tokens", over, "chars_in_budget")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, read(spark, sf_dir, "documents"))


def pack(spark: SparkSession, docs: DataFrame) -> DataFrame:
    names = tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    packed = packing.pack_documents(spark, docs, *names, SEQUENCE_TOKENS, END_ID)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(spark, read(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *(f"n_{k}" for k in pii.KINDS), digest, "spans")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(spark, read(spark, sf_dir, "pages"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(spark, read(spark, sf_dir, "documents"), width=3, threshold=0.9)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    now, grown = dict.fromkeys(range(SHARDS), 1.0), dict.fromkeys(range(SHARDS + 1), 1.0)
    placed = sharding.assign_shards(read(spark, sf_dir, "documents"), now, grown)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(spark, read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.is_contaminated().alias("contaminated"),
    )


def held_out(doc_id: Column) -> Column:
    """A quarter of the ids; a null id is not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    filters = language_id.fit(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    predicted = language_id.predict(docs.select("doc_id", "text"), filters)
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licences(spark, read(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spark, read(spark, sf_dir, "documents"), slips=SLIPS)


def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(spark, read(spark, sf_dir, "documents"), REPEATED_BYTES)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = read(spark, sf_dir, "conversations")
    return conversation_repair.repair(spark, conversation_repair.damaged(whole), whole)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_token_counts,
        op2_best_fit_packing,
        op3_pii,
        op4_html_extraction,
        op5_ngram_jaccard_join,
        op6_sharding,
        op7_nearest_neighbours,
        op8_decontamination,
        op9_language_id,
        op10_license_scan,
        op11_spelling_variants,
        op12_suffix_array_dedup,
        op13_conversation_repair,
    )
}

# Words as the operators take them; windows of thirteen words, or all of a shorter item.
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = rf"regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+')"

ORACLE: dict[str, str] = {
    "op8_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
b AS (SELECT item_id, words FROM (SELECT item_id, {_WORDS} AS words FROM benchmark) WHERE len(words) > 0),
w AS (SELECT DISTINCT item_id, least(13, len(words)) AS size,
        array_to_string(words[k:k + least(13, len(words)) - 1], ' ') AS gram
      FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS k FROM b)),
p AS (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS k
      FROM d, (SELECT DISTINCT size FROM w) s WHERE len(words) >= size),
m AS (SELECT p.doc_id, p.k, p.size, w.item_id FROM p JOIN w
      ON p.size = w.size AND array_to_string(p.words[p.k:p.k + p.size - 1], ' ') = w.gram),
h AS (SELECT doc_id, count(DISTINCT place) AS n_hit
      FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
      FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
  coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.words) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)""",
    "op5_ngram_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED} AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[k:k + 2], ' ') AS gram
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS k FROM d WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
      FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
      WHERE 100 * shared >= 90 * (p.size + q.size - shared)),
r AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.node)
SELECT d.doc_id, coalesce(n.size, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT node, min(root) AS component_id FROM r GROUP BY node) c ON c.node = d.doc_id""",
}

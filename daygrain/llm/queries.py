"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.llm import (
    embedding_duplicates,
    fingerprints,
    html_extraction,
    language_id,
    near_duplicates,
    packing,
    sentencepiece_codec,
    sharding,
    source_divergence,
    suffix_dedup,
    token_counts,
    toxicity,
    whitening,
)
from daygrain.llm.registry import query
from daygrain.llm.tables import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated(table(spark, sf_dir, "documents"), length=100)


@query("op2_hilbert_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.hilbert_shards(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


@query("op5_sentencepiece_codes")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sentencepiece_codec.sentencepiece_codes(docs, tokenizer("piece_bpe_32k.model"), digest=True)


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"), with_ids=False)


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.unigram_token_counts(docs, tokenizer("piece_bpe_32k.model"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    lexicon = toxicity.learn_from(toxicity.chosen_texts(docs, toxicity.training_labels(labels)))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return toxicity.toxicity_scores(docs, lexicon).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted", "weight"
    )


@query("op7_near_duplicates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), size=4, threshold=80)


@query("op3_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op8_embedding_duplicates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates.embedding_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = language_id.train(language_id.training_sample(docs))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return language_id.languages(docs, network).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"), components=8)


_SHARE = "1 + 1000000000 * ({n} + 2) // ({total} + 2 * v)"


@query(
    "op12_source_divergence",
    sql=f"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
words AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
sizes AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
here AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
),
own AS (SELECT lang, source, sum(n) AS group_n FROM here GROUP BY lang, source),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n, {_SHARE.format(n="coalesce(h.n, 0)", total="coalesce(o.group_n, 0)")} AS p,
         {_SHARE.format(n="k.total", total="s.lang_n")} AS q
  FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang)
  LEFT JOIN own o USING (lang, source) LEFT JOIN here h USING (lang, source, term)
),
priced AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
),
found AS (
  SELECT * FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM grid WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergence(table(spark, sf_dir, "documents"))


@query("op13_html_extraction")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extraction.extract_main_text(pages, html_extraction.learn_weights(pages))

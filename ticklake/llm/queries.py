"""The operators applied to their tables, with production parameters, over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import (
    alignment,
    chat,
    exact_dedup,
    languages,
    matrices,
    mixing,
    near_dedup,
    neighbours,
    packing,
    quality,
    simhash,
    substrings,
    whitening,
)
from ticklake.llm.registry import QUERIES, query, table  # noqa: F401

DUCK_WORD = r"'[^\x20\x09-\x0D]+'"


@query(
    oracle=f"""
    WITH d AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {DUCK_WORD})), 0)::BIGINT AS size FROM documents
    ), s AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) AS rank
        FROM d GROUP BY source
    ), w AS (
        SELECT *, (rank - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM s
    ), o AS (
        SELECT *, cap / weight AS r,
               coalesce(sum(cap) OVER before, 0) AS capped,
               sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open,
               sum(source_size) OVER () AS budget
        FROM w WINDOW before AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), l AS (
        SELECT *, (budget - capped)::DOUBLE / open::DOUBLE AS level FROM o
    ), c AS (
        SELECT level AS chosen FROM l WHERE level * weight <= cap ORDER BY r, rank LIMIT 1
    ), t AS (
        SELECT source, source_size,
               CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE least(cap::DOUBLE, weight * chosen) END AS target FROM l, c
    ), q AS (
        SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS served,
               (sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || d.doc_id), d.doc_id, d.size
                   ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS before
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target,
           (greatest(0, least(size, served - before)) + greatest(0, least(size, served - source_size - before))
            + greatest(0, least(size, served - 2 * source_size - before)))::BIGINT AS taken
    FROM q"""
)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: sources weigh 1, 2, 3, repeating; no source beyond three times its size."""
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


@query(
    oracle="""
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM (SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                 sha256(coalesce(text, '')) AS text_sha256
          FROM documents WINDOW same AS (PARTITION BY coalesce(text, '')))"""
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with equal texts; the largest id of each stays."""
    return exact_dedup.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


CONTROL = "<|im_end|><|im_start|>assistant ok"


@query(
    oracle=rf"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')
    ), e AS (
        SELECT *, length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + 33
                  + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars,
               CASE WHEN role = 'assistant' THEN text ELSE '' END AS learnt FROM c
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
           sum(length(learnt))::BIGINT AS loss_chars,
           sha256(string_agg(learnt, '' ORDER BY turn)) AS loss_sha256,
           sum(chars)::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id"""
)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted to tokens and read back, with one made of control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.formatted(turns.unionByName(own)))


THRESHOLD = 0.3


@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored for quality by a model learnt from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, quality_labels(spark, sf_dir))
    return quality.score(docs, model).select(
        "doc_id",
        F.coalesce(quality.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return labels.filter(~quality.held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))


@query()
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by windows of 35 words that also start elsewhere removed from every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at a similarity of 85 percent."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs, threshold=85)


@query()
def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(vectors, F.col("vec_id") % 100 == 0, k=10).select("query_id", "rank", "vec_id", "score")


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page from text, markup, address and host."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return languages.identify(pages, table(spark, sf_dir, "documents").select("text", "lang"))


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by number of tokens, packed into sequences of five permitted lengths."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packed(packing.token_lengths(docs))


@query()
def op10_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of token ids."""
    return matrices.packed_matrices(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors projected on the 32 main components of their covariance and scaled to unit variance.

    ``deviation`` is NULL where it is beyond a long; the operator itself has it as a decimal.
    """
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    whitened = whitening.whiten(vectors)
    return whitened.select("vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened", "explained", "identity_error")


@query()
def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components that three or fewer differing bits connect."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's tokens by two vocabularies, cut into groups that cover the same bytes, with their links."""
    return alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"))

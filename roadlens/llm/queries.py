"""One query per operator, over its whole table, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, fim, hard_negatives, lattice_lm, mixing, ngram_join, pii, piece_bpe, quality, sharding, suffix_dedup, topk
from .common import table


def held_out(doc_id, parts: int):
    """Rows whose crc32 of the id as text leaves the remainder 1; never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == 1, F.lit(False))


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """The quality model, fitted on labelled rows that are not held out."""
    return quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), lambda i: ~held_out(i, 3))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    scored = table(spark, sf_dir, "documents").select(
        "doc_id", held_out(F.col("doc_id"), 3).alias("held_out"), quality.score(quality_model(spark, sf_dir)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix of all sources takes."""
    rows = table(spark, sf_dir, "documents").select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), "source", mixing.word_count().alias("size"))
    return mixing.decide(rows).select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "copies",
                                      (F.col("size") * F.col("copies")).alias("taken"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products of every hundredth vector with all others."""
    return topk.search(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, k=10)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when passages of 400 bytes that repeat are removed."""
    cut, whole = suffix_dedup.cut_repeats(table(spark, sf_dir, "documents"))
    none = F.lit(0).cast("bigint")
    return (cut.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
            .unionByName(whole.select(F.col("id").alias("doc_id"), "n_bytes", none.alias("n_removed"), none.alias("n_spans"),
                                      F.col("sha256").alias("kept_sha256"))))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its group of equal texts."""
    marked, c = exact_dedup.mark_copies(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", F.col(c["keep"]).alias("keep_id"), F.col(c["copies"]).alias("group_size"),
                         F.col(c["kept"]).alias("kept"), F.lower(F.hex(c["digest"])).alias("text_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot under the ``rows`` law."""
    placed, c = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", F.col(c["size"]).alias("size"), F.col(c["crc"]).alias("text_crc32"),
                         F.lit("rows").alias("law"), F.col(c["shard"]).alias("shard"), F.col(c["slot"]).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text that they decode to."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates for personal data and secrets."""
    changed, c = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return changed.select("doc_id", "text", F.col(c["n_entities"]).alias("n_entities"), F.col(c["kinds"]).alias("kinds"))


def op9_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the lattice model and under plain word counts."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id"), 5).alias("held_out"))
    return lattice_lm.score(docs, ~F.col("held_out"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of 3-word shingle sets with a Jaccard similarity of 0.9 or more."""
    joined = ngram_join.join(table(spark, sf_dir, "documents"), size=3, t=90)
    return joined.withColumnRenamed("id", "doc_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every hundredth vector's five best positives; every seventh row's label is moved on first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(rows, lambda i: i % 100 == 0)


def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's SentencePiece ids and of the text that they decode to."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_bpe.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), F.col("differing").alias("n_differing"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its middle moved to the end, and the text restored from that."""
    done, c = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    output, form = F.col(c["output"]), F.col(c["form"])
    return done.select("doc_id", F.col(c["units"]).alias("n"), form.alias("form"), F.col(c["prefix_chars"]).alias("prefix_chars"),
                       F.col(c["middle_chars"]).alias("middle_chars"), F.sha2(output, 256).alias("output_sha256"),
                       F.sha2(fim.restore(output, form), 256).alias("restored_sha256"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_mixing": op2_mixing,
    "op3_topk": op3_topk,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_sharding": op6_sharding,
    "op7_bpe": op7_bpe,
    "op8_pii": op8_pii,
    "op9_lattice_lm": op9_lattice_lm,
    "op10_ngram_join": op10_ngram_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_piece_bpe": op12_piece_bpe,
    "op13_fim": op13_fim,
}

ORACLE = {
    "op3_topk": """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT * FROM r WHERE rank <= 10
""",
    "op5_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positive AS (
  SELECT anchor_id, other_id, score FROM p WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
r AS (
  SELECT a.anchor_id, a.other_id AS positive_id, n.other_id AS negative_id, a.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY a.anchor_id, a.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank
  FROM positive a JOIN p n ON n.anchor_id = a.anchor_id AND NOT n.same AND 80 * a.score <= 100 * n.score AND 100 * n.score <= 100 * a.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 5
""",
}

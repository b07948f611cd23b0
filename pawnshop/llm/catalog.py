"""Registered queries of the training-data operators, and their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pawnshop.llm import spans as sp
from pawnshop.llm.frames import settled, table
from pawnshop.session import scratch_path

#: A text is kept from this score on.
QUALITY_LEAST = 0.3
#: The vocabulary's end-of-text token, which separates documents.
END_TOKEN = 50256


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _span_digests(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts and digests of base spans, and all spans as text."""
    return found.select("doc_id", *[sp.counted(F.col("base"), k).alias(f"n_{k}") for k in kinds],
                        F.sha2(sp.joined(F.col("base")), 256).alias("base_sha256"), sp.joined(F.col("spans")).alias("spans"))


def op3_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm import pii

    return _span_digests(pii.personal_data(table(spark, sf_dir, "documents")), pii.KINDS)


def op4_union_free_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm import wrappers

    return wrappers.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm import secret_scan

    return _span_digests(secret_scan.secrets(table(spark, sf_dir, "documents")), secret_scan.KINDS)


def _fold(folds: int = 5):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def quality_model(docs: DataFrame, labels: DataFrame):
    """The quality classifier, fitted on the rows of the training folds; only the labels of good texts are used."""
    from pawnshop.llm import quality

    train = docs.filter(_fold() != 0)
    return quality.fit_on(train, labels.filter((F.col("quality") == 1) & (_fold() != 0)))


def op6_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm import ngram_lm

    docs = table(spark, sf_dir, "documents")
    held_out = _fold() == 1
    model = ngram_lm.fit(docs.filter(F.coalesce(~held_out, F.lit(True))))
    return ngram_lm.scored(docs, model).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
                                               F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op7_positive_unlabelled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm import quality

    docs = table(spark, sf_dir, "documents")
    found = quality.scored(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (_fold() == 0).alias("held_out"), "score", (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"))


def op8_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm import hash_forest

    vectors = table(spark, sf_dir, "embeddings")
    return hash_forest.nearest(vectors, vectors.filter(F.pmod("vec_id", F.lit(100)) == 0))


def op9_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm.bpe import Tokenizer

    docs = table(spark, sf_dir, "documents")
    return Tokenizer(vocabulary_path()).compile(docs).digests(docs)


def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm import training_order as order
    from pawnshop.llm.bpe import Tokenizer

    packed = order.sequences(table(spark, sf_dir, "documents"), Tokenizer(vocabulary_path()), END_TOKEN)
    place = scratch_path(spark, "shards")
    manifest = settled(order.write_shards(order.shards(packed, key=2024), place), "manifest")
    return order.index(order.read_shards(manifest, place))


#: Labels are shifted where the id is divisible by the first number, anchors are rows whose id is divisible by the second.
SHIFTED_LABELS, ANCHORS = 7, 100


def op11_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm import hard_negatives

    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % SHIFTED_LABELS == 0, (label + 1) % 10).otherwise(label)
    rows = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return hard_negatives.mine(rows, F.col("id") % ANCHORS == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10"""


def op12_offset_preserving_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm.sentence_pieces import Encoder

    return Encoder(piece_model_path()).digests(table(spark, sf_dir, "documents"))


def op13_path_ranked_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pawnshop.llm import conversation_repair as repair

    rows = table(spark, sf_dir, "conversations")
    return repair.report(repair.damaged(rows), rows.select("conv_id"))


Q = {f.__name__: f for f in (op1_order_minhash, op2_spaced_seed_decontamination, op3_bootstrapped_pii,
                              op4_union_free_wrappers, op5_randomness_battery, op6_elias_fano_lm,
                              op7_positive_unlabelled_quality, op8_hash_prefix_forest, op9_transducer_bpe, op10_feistel_shards,
                              op11_threshold_negatives, op12_offset_preserving_pieces, op13_path_ranked_repair)}
SQL: dict[str, str] = {"op11_threshold_negatives": OP11_SQL}

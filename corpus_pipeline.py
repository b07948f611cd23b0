"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and returns documents with their columns
(the last one: the encoded documents); what it rejects is gone for the stages
after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pawnshop.llm import catalog, decontaminate, near_dedup, pii, quality
from pawnshop.llm.bpe import Tokenizer
from pawnshop.llm.frames import settled, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on the training folds of ``labels``."""
    model = catalog.quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model, "__score").filter(F.col("__score") >= catalog.QUALITY_LEAST).drop("__score")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one of the smallest id; a row without an id stays.

    Where that id occurs with several texts, each different text stays once."""
    classes = near_dedup.near_duplicates(docs.select("doc_id", "text"))
    kept = settled(classes.filter("doc_id = class_id").select("doc_id").distinct(), "kept")
    one = docs.join(kept, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
    return one.unionByName(docs.filter("doc_id is null"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    found = decontaminate.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    leaked = settled(found.select("doc_id").distinct(), "leaked")
    return docs.join(leaked, "doc_id", "left_anti").select(docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.masked(docs, pii.personal_data(docs.select("doc_id", "text")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document."""
    return Tokenizer(catalog.vocabulary_path()).compile(docs).digests(docs)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("personal_data", hide_personal_data),
    ("encoding", encode),
]

#: The stages learn, align and merge; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs

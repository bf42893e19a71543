"""A training corpus from raw documents, in five stages; each reads what the one before has written.

1. `quality`: the co-trained classifier; documents that it rejects go.
2. `near_duplicates`: of each component of near duplicates (five-word shingles, similarity 0.8) the row with the smallest id stays, null
   last; of a component's rows that share that id, the first by the hash of its text. A row is its id and text, so two different
   texts of one id, or without an id, are two documents. Rows without a word all stay.
3. `decontaminate`: rows that hold a passage of the benchmark go, whatever other rows their id has.
4. `mix`: documents are taken as often as their source's target asks.
5. `tokens`: the corpus as token files, read back as one row per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyford.llm import decontaminate, mixing, ngram_join, quality_classifier, token_files
from tallyford.llm.registry import ship, table
from tallyford.llm.work import Work, result
from tallyford.session import prepare


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.keep(docs, table(ship(prepare(spark)), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(ship_frame(spark, docs), k=5, num=80, den=100).where("component is not null")
    # A row's key is its id and its text, so that two texts of one id, or without an id, are two documents.
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    stays = found.groupBy("component").agg(F.min(row).alias("stays"))
    gone = (
        found.withColumn("row", row).join(stays, "component").where(~F.col("row").eqNullSafe(F.col("stays")))
        .select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_text")).distinct().hint("merge"))
    rest = docs.join(gone, docs.doc_id.eqNullSafe(gone.gone_id) & (F.xxhash64(docs.text) == gone.gone_text), "left_anti")
    # Equal rows of one id are copies too; rows without a word are nobody's copy.
    worded = F.coalesce(F.col("text").rlike(mixing.WORD), F.lit(False))
    return rest.where(worded).dropDuplicates(["doc_id", "text"]).unionByName(rest.where(~worded))


def ship_frame(spark: SparkSession, docs: DataFrame) -> DataFrame:
    ship(prepare(spark))
    return docs


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Found by row, not by id, which may repeat or be null.
    key = F.xxhash64("doc_id", "text")
    keyed = ship_frame(spark, docs).select(key.alias("row_key"), "text")
    found = decontaminate.contaminated(keyed, table(spark, sf_dir, "benchmark"), id_col="row_key")
    return docs.join(found.select("row_key").distinct(), key == F.col("row_key"), "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(ship_frame(spark, docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.encode_and_read(ship_frame(spark, docs), token_files.vocabulary(), end_id=2)


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", without_benchmark), ("mix", mix), ("tokens", tokens)]

# The quality classifier, the token files and the hashes of the mix cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    with Work(spark, "pipeline") as work:
        for i, (name, stage) in enumerate(STAGES):
            made = stage(spark, docs, sf_dir)
            if i + 1 == len(STAGES):
                return result(made)
            kept = work.keep(made, name)
            if i:
                work.drop(docs)
            docs = kept

"""From raw documents to packed training sequences, stage by stage.

Every stage takes the documents that the one before it kept and returns documents with the same columns,
the last one the pieces of packed sequences. Columns beyond those of the documents table are left out.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerloom.llm import language, packing, private, quality, simhash
from tellerloom.llm.common import documents, remainder
from tellerloom.staging import Staging

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
VOCABULARY = "word_bpe_49k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the corpus, learned from a part of them.

    Texts that are null, have no letter, or are far from every language are rejected; so is everything
    where no document names its language.
    """
    docs = docs.select(*COLUMNS)
    model = language.fit(docs.where(remainder(F.col("doc_id"), 5) != 0))
    found = docs.withColumn("_found", language.prediction(spark, model, F.col("text")))
    return found.where(~F.col("_found.rejected")).drop("_found")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at least as likely good as bad, learned from the labels of a part of them.

    Null and empty texts have a score like any other. Without labels every document stays.
    """
    docs = docs.select(*COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels.where(remainder(F.col("doc_id"), 3) != 1))
    scored = docs.withColumn("_score", quality.score(spark, model, F.col("text")))
    return scored.where(F.col("_score") >= 0.5).drop("_score")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Rows are told apart by their place in a written copy, so repeated rows, repeated ids and rows without
    an id are documents like all others; of a group without ids the first row stays. Texts without words
    are a group.
    """
    staging = Staging(spark)
    rows = staging.table(
        docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "documents"
    )
    grouped = simhash.near_duplicates(rows, id_col="_row", staging=staging)
    ids = rows.select("_row", F.col("doc_id").alias("own"))
    # Ranks of 1 are found within partitions before the shuffle, so a large group is a few rows.
    order = Window.partitionBy("component_id").orderBy(F.asc_nulls_last("own"), "_row")
    first = (
        grouped.select(F.col("doc_id").alias("_row"), "component_id")
        .join(ids, "_row")
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") == 1)
        .select("_row")
    )
    return rows.join(first, "_row", "left_semi").drop("_row")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind, ``n_chars`` counted anew.

    What is replaced are the spans that the operator finds, overlapping ones as one. Patterns are looked
    for once: the rows are stored with their candidates. Null texts stay null.
    """
    candidates = private.candidates_in_rows(docs.select(*COLUMNS))
    found = Staging(spark).table(candidates, "candidates")
    masked = private.masked_rows(found, private.fit(found))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens, as the packing query has them."""
    cut = packing.pieces(docs, public_tokenizers.path(VOCABULARY))
    return packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

# Its stages learn models and tokenize, which SQL can't; tests compare it with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what a stage returns is written and read again."""
    staging = Staging(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staging.table(stage(spark, docs, sf_dir), name)
    return docs

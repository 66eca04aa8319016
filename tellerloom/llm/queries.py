"""The operators of this folder as queries over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerloom.llm import (
    bpe,
    filter_audit,
    grammar_runs,
    hidden_markov,
    language,
    lempel_ziv,
    neighbours,
    oracle,
    packing,
    private,
    quality,
    rendering,
    simhash,
    url_filters,
)
from tellerloom.llm.common import documents, remainder
from tellerloom.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
# DuckDB SQL of those queries that SQL can express.
ORACLE = {"op11_potential": oracle.FILTER_AUDIT, "op12_link_graph": oracle.URL_VERDICTS}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_lempel_ziv(spark: SparkSession, folder: str) -> DataFrame:
    return lempel_ziv.neighbours(documents(spark, folder))


@query
def op2_rendering(spark: SparkSession, folder: str) -> DataFrame:
    return rendering.extract(spark.read.parquet(f"{folder}/pages.parquet"))


@query
def op3_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 7) == 2
    return hidden_markov.score(documents(spark, folder), held_out)


@query
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, folder))
    return found.withColumn(
        "fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    )


@query
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(documents(spark, folder), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    return neighbours.neighbours(rows, F.col("vec_id") % 100 == 0)


@query
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    cut = packing.pieces(documents(spark, folder), vocabulary)
    return packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = remainder(F.col("doc_id"), 3) == 1
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(docs, labels.where(~held_out))
    scored = docs.select(
        "doc_id", held_out.alias("held_out"), quality.score(spark, model, F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = language.fit(docs.where(~held_out))
    found = language.prediction(spark, model, F.col("text"))
    return docs.select("doc_id", held_out.alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", "found.*"
    )


@query
def op10_private(spark: SparkSession, folder: str) -> DataFrame:
    with_candidates = private.candidates(documents(spark, folder))
    # Small rows without text, read for the model and again for the result.
    found = Staging(spark).table(with_candidates, "candidates")
    marked = private.spans(found, private.fit(found))

    def of_kind(kind: str) -> Callable[[Column], Column]:
        return lambda span: span["kind"] == kind

    return marked.select(
        "doc_id",
        *[
            F.size(F.filter("base", of_kind(kind))).cast("long").alias(f"n_{kind}")
            for kind in private.KINDS
        ],
        F.sha2(private.listed("base"), 256).alias("base_sha256"),
        private.listed("all").alias("spans"),
    )


@query
def op11_potential(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return filter_audit.audit(documents(spark, folder), labels)


@query
def op12_link_graph(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.verdicts(spark.read.parquet(f"{folder}/pages.parquet"))


@query
def op13_grammar_runs(spark: SparkSession, folder: str) -> DataFrame:
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = grammar_runs.runs(grammar_runs.repeated(documents(spark, folder), number))
    # The longest, of equally long ones the first, then that of the smaller period.
    order = F.transform(
        "runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"])
    )
    best = F.array_min(order)
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.less") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

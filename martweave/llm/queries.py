"""The operators as queries over the given tables, and SQL where SQL can say the same."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.llm import (
    byte_bpe, decontamination, html_text, jaccard_join, lang_id, licenses, line_quality, mtree, quotations,
    source_divergence, token_counts, token_output, vector_codes,
)
from martweave.session import work_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = lambda spark, folder: make(shipped(spark), folder)
    return make


def shipped(spark: SparkSession) -> SparkSession:
    """Give the executors this package, which they may not have; once for each application."""
    context = spark.sparkContext
    if not getattr(context, "_martweave_shipped", False):
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / "martweave.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in root.rglob("*.py"):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))
        context._martweave_shipped = True
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_quotations(spark: SparkSession, folder: str) -> DataFrame:
    return quotations.conversations(table(spark, folder, "conversations"))


SQL["op1_quotations"] = quotations.SQL


@query
def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents").select("doc_id", "text"), licenses.known_licenses(spark))


SQL["op2_licenses"] = licenses.sql()


@query
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.round_trip(table(spark, folder, "documents").select("doc_id", "text"), path))


@query
def op8_token_output(spark: SparkSession, folder: str) -> DataFrame:
    files = work_folder(spark, "token_output")
    token_output.write(table(spark, folder, "documents"), files, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.digests(token_output.read(spark, files))


@query
def op4_mtree(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.top_k(table(spark, folder, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


@query
def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return decontamination.digests(decontamination.decontaminate(documents, table(spark, folder, "benchmark")))


@query
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(documents, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_pieces")


@query
def op10_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = table(spark, folder, "labels").where(~held_out).select("doc_id", "quality")
    scored = line_quality.classify(documents, line_quality.train(documents, labels))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )


@query
def op11_lang_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = lang_id.train(documents.where(~lang_id.held_out()))
    found = lang_id.classify(documents.drop("lang"), model)
    return found.select("doc_id", lang_id.held_out().alias("held_out"), "lang_pred", "score", "accepted")


@query
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.digests(table(spark, folder, "embeddings"))


SQL["op12_vector_codes"] = vector_codes.sql()


@query
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.audit(table(spark, folder, "documents"))


SQL["op13_source_divergence"] = source_divergence.SQL


SQL["op4_mtree"] = """
    WITH p AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    s AS (
        SELECT q.vec_id AS query_id, p.vec_id, list_inner_product(q.v::DOUBLE[], p.v::DOUBLE[])::BIGINT AS score
        FROM p q JOIN p ON q.vec_id % 100 = 0 AND p.vec_id <> q.vec_id
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM s QUALIFY rank <= 10
"""

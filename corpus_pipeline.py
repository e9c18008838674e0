"""A corpus made ready for training: four stages, each one operator of ``martweave.llm``.

Documents of low quality go, one document of each group of near copies stays, documents
with benchmark passages go, and what is left is encoded. Each stage is written as Parquet
in the shared folder and read again, so a lost executor costs part of one stage, and goes
when the next one is written. The
filtering stages keep the columns of their input, also those named like an operator's.
The second stage goes by rows, not by doc_id: of a row that repeats, of copies without
doc_id and of copies that share a doc_id with another text one stays as well.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.llm import byte_bpe, decontamination, jaccard_join, line_quality
from martweave.session import remove, work_folder

KEPT_FROM = 0.3
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _put_aside(docs: DataFrame, made: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named like ``made`` under other names, and the way back."""
    back = {f"_own_{k}": c for k, c in enumerate(docs.columns) if c.lower() in made}
    return docs.withColumnsRenamed({c: k for k, c in back.items()}), back


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model scores ``KEPT_FROM`` or more; it learns from labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    learnt = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = line_quality.train(docs, learnt)
    own, back = _put_aside(docs, ("score", "lines"))
    kept = line_quality.classify(own, model).where(F.col("score") >= KEPT_FROM)
    return kept.drop("score", "lines").withColumnsRenamed(back).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of copies and near copies the row with the least id, of equal ids one.

    Rows without doc_id come last in a class. Each row gets a key, written once, by which
    it is joined and chosen.
    """
    own, back = _put_aside(docs, ("_row",))
    folder = work_folder(spark, "keyed")
    own.withColumn("_row", F.monotonically_increasing_id()).write.parquet(folder)
    keyed = spark.read.parquet(folder)
    classes = jaccard_join.jaccard_join(keyed.select(F.col("_row").alias("doc_id"), "text"))
    of = classes.select(F.col("doc_id").alias("_row"), "class_id").join(keyed.select("_row", "doc_id"), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row"))
    chosen = of.groupBy("class_id").agg(first.alias("first")).select(F.col("first._row").alias("_row"))
    return keyed.join(chosen, "_row", "left_semi").drop("_row").withColumnsRenamed(back).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    own, back = _put_aside(docs, decontamination.MADE)
    kept = decontamination.decontaminate(own, benchmark).where("n_hit = 0")
    return kept.drop(*decontamination.MADE).withColumnsRenamed(back).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids, their number, and as text what the ids decode to."""
    path = public_tokenizers.path(VOCABULARY)
    kept = docs.select(*(f"`{c}`" for c in docs.columns if c.lower() not in ("ids", "decoded", "n_tokens")))
    both = byte_bpe.round_trip(kept, path)
    decoded = both.withColumn("text", F.col("decoded").cast("string")).drop("decoded")
    return decoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_documents),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", without_benchmark),
    ("byte_level_bpe", encoded),
]

#: SQL has no fitted model and no tokenizer; tests hold each stage against a plain version.
ORACLE_SQL = None


#: Rows and bytes that go to Python at once; whole texts are long, and all stages share an executor's memory.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    own = {key: spark.conf.get(key, None) for key in BATCHES}
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    try:
        return _run(spark, sf_dir)
    finally:
        for key, value in own.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        folder = work_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before is not None:
            remove(spark, before)
        before = folder
    return docs

"""From raw documents to token files: language, near copies, benchmark leaks, mix, output.

``run`` applies the stages to ``documents``.  Every stage reads what its predecessor kept,
written as Parquet; all but the last return the columns of the documents.

Defined results: null, empty and letterless texts have no language and go at the first stage, and
so does everything if no document has a language to learn from; copies and repeated rows are
one document after the second, the one with the smallest id, a null id being the largest; null
ids and null sources are kept like any others, and ids that differ in their texts stay as they
are; texts of any length are read whole; extra columns are carried to the last stage, whatever
they are called; an empty table gives empty stages and an output without documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.layout import workspace
from terrace.llm import decontamination, language_id, mixing, simhash, token_files
from terrace.llm.tables import materialize, table, whole_rows

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Texts that go to a Python worker at a time; ten times as many, Spark's default, take ten times the memory there.
TEXTS_IN_A_BATCH = 1000
#: Bytes after which a batch is closed: few shards are held at once, in the worker and off the heap beside it, and no
#: more texts than are encoded at a time.
BYTES_IN_A_BATCH = 1 << 20
#: Bytes of word pieces a Python worker remembers, where earlier stages have filled the executor's heap.
REMEMBERED = 8 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS_IN_A_BATCH)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_IN_A_BATCH)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go; the others are kept as they are."""
    small_batches(spark)
    model = language_id.fit(docs)
    found = language_id.predict(docs, model).alias("found")
    return (
        docs.select(whole_rows(docs), found)
        .where(F.col("found.lang_pred") != language_id.UNKNOWN)
        .select("row.*")
    )


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    small_batches(spark)
    return simhash.keep_one(docs, shingle=3, radius=2)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return decontamination.remove_documents(found)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks."""
    sizes = materialize(docs.groupBy("source").agg(F.sum(mixing.word_count()).alias("size")))
    return mixing.emit(mixing.copies(docs, mixing.source_targets(sizes), mixing.draw_key()))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; a row per document read back from them."""
    small_batches(spark)
    path = workspace(spark)
    token_files.write_tokens(docs, path, TOKENIZER, escape_special=False, remembered=REMEMBERED, give_back=True)
    return token_files.read_documents(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing sources to target weights", source_mix),
    ("token-ID / binary output", token_output),
]

#: String kernels, XXH64 and the tokenizer are beyond SQL; the tests hold the rows against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs

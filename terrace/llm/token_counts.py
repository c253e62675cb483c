"""Token counts through a digest cache.

A table in the shared folder holds the count of every text that was ever encoded, by the digest
of its normalised content and the digest of the tokenizer's version.  Rows are joined to the
stored counts; only the distinct contents that are missing are encoded, and their counts are
appended.  Where most texts are known, the missing ones are few enough for the planner to
broadcast their digests, and no text is moved at all.

A content that many rows share is sent on once per scanning task, so no task gathers the copies.
A worker remembers the counts of words by their bytes, in two generations: once the younger is
full, the older one is dropped.

Defined results: a null text is an empty one and has no tokens; repeated rows are counted each;
texts that differ only in what normalisation takes away share an entry; special strings
in a text are tokens as the library reads them by default; texts of any length are counted
whole; an empty table gives no rows; other columns are carried if named in ``keep``.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from importlib.metadata import version
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.layout import workspace
from terrace.llm.tables import ascii_lower, materialize, ship_library, text_or_empty, whole_rows
from terrace.sources.files import directory_exists

CACHE = "digest binary, n_tokens long, version string"
#: Bytes of words a worker remembers in a generation, with 100 for each entry.
REMEMBERED = 24 << 20
#: Characters that go to the library at a time.
BATCH = 1 << 20


def exact(text: Column) -> Column:
    """For tokenizers that read everything: the text itself."""
    return text


def lower_words(text: Column) -> Column:
    """For tokenizers that lower-case and drop white space: words, single spaces, a-z.

    Capitals stay where lowering them first could matter: beside the marks of special strings,
    which are compared as they are, and before combining marks, which compose with some small
    letters only (a small j and a caron are one character, a capital one and a caron are two).
    """
    flat = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    return F.when(flat.rlike(r"<\||\p{M}"), flat).otherwise(ascii_lower(flat))


@dataclass(frozen=True)
class Tokenizer:
    """A vocabulary file of tokenizers (.json) or sentencepiece (.model), and how texts are normalised.

    ``by_word`` says that white space never reaches a token, so that a text has the tokens of its words.
    """

    path: str
    by_word: bool = False

    def normal(self, text: Column) -> Column:
        return lower_words(text) if self.by_word else exact(text)

    def version(self) -> str:
        """Digest of all that counts depend on: file, library and normalisation."""
        library = "sentencepiece" if self.path.endswith(".model") else "tokenizers"
        described = f"{library} {version(library)} {'lower_words 1' if self.by_word else 'exact 1'}\n"
        return hashlib.sha256(described.encode() + Path(self.path).read_bytes()).hexdigest()


class Counter:
    """Counts tokens by the library, remembering words if the tokenizer works by word."""

    def __init__(self, tokenizer: Tokenizer):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.by_word = tokenizer.by_word
        if tokenizer.path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=tokenizer.path)
            self.library = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer as Library

            model = Library.from_file(tokenizer.path)
            model.no_truncation()
            model.no_padding()
            self.library = lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.held = 0

    def _encoded(self, texts: list[str]) -> Iterator[int]:
        """Counts in order, a bounded number of characters at a time."""
        first, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text) + 64
            if size >= BATCH or i + 1 == len(texts):
                yield from self.library(texts[first : i + 1])
                first, size = i + 1, 0

    def _learn(self, words: set[str]) -> None:
        fresh = []
        for word in words:
            if word in self.old:
                self._remember(word, self.old[word])
            else:
                fresh.append(word)
        for word, n in zip(fresh, self._encoded(fresh), strict=True):
            self._remember(word, n)

    def _remember(self, word: str, n: int) -> None:
        self.young[word] = n
        self.held += len(word) * 2 + 100

    def count(self, texts: list[str]) -> list[int]:
        if not self.by_word:
            return list(self._encoded(texts))
        counts = []
        for text in texts:
            words = text.split(" ") if text else []
            missing = set(words).difference(self.young)
            if missing:
                self._learn(missing)
            counts.append(sum(map(self.young.__getitem__, words)))
            if self.held > REMEMBERED:
                self.old, self.young, self.held = self.young, {}, 0
        return counts


@lru_cache(maxsize=1)
def counter(tokenizer: Tokenizer) -> Counter:
    return Counter(tokenizer)


def _first_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each digest in this task."""
    seen: set[bytes] = set()
    for batch in batches:
        digests = batch.column("digest").to_pylist()
        first = [not (d in seen or seen.add(d)) for d in digests]
        yield batch.filter(pa.array(first, pa.bool_()))


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """``digest, n_tokens`` of one tokenizer version, once each however often it was appended."""
    if not directory_exists(spark, cache):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("version") == version)
    return stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def encode_missing(contents: DataFrame, missing: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``digest, n_tokens`` for the ``missing`` digests, from ``contents`` (``digest, content``)."""
    ship_library(contents.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer).count
        for batch in _first_in_task(batches):
            found = count(batch.column("content").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(found, pa.int64())], ["digest", "n_tokens"])

    wanted = (
        contents.mapInArrow(_first_in_task, "digest binary, content string")
        .join(missing, "digest", "left_semi")
        .repartition("digest")
    )
    counts = wanted.mapInArrow(encode, "digest binary, n_tokens long")
    return counts.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, tokenizer: Tokenizer, cache: str | None = None, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``row`` (the columns of ``keep``, one at least), ``n_bytes`` and ``n_tokens`` per row.

    ``cache`` is the folder of the stored counts, which is made if it is missing; without one, a new one is used.
    """
    spark = docs.sparkSession
    cache = cache or workspace(spark)
    whole = text_or_empty(F.col(f"`{text}`"))
    content = tokenizer.normal(whole)
    digest = F.unhex(F.sha2(content, 256)).alias("digest")
    kept = whole_rows(docs.select(*[F.col(f"`{c}`") for c in keep]))
    rows = materialize(docs.select(kept, F.octet_length(whole).cast("long").alias("n_bytes"), digest))

    version = tokenizer.version()
    stored = materialize(rows.select("digest").distinct().join(read_cache(spark, cache, version), "digest", "left"))
    missing = stored.where("n_tokens IS NULL").select("digest")
    counts = stored.where("n_tokens IS NOT NULL")
    if not missing.isEmpty():
        fresh = materialize(encode_missing(docs.select(digest, content.alias("content")), missing, tokenizer))
        fresh.withColumn("version", F.lit(version)).write.mode("append").parquet(cache)
        counts = counts.unionByName(fresh)
    return rows.join(counts, "digest").select("row", "n_bytes", "n_tokens")

"""Token counts against the libraries, and what the digest cache spares."""

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import TESTDATA
from terrace.llm import token_counts
from terrace.llm.queries import QUERIES

WORDS, BYTES, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", " ", "a  b\t\nC", "The CAT's 12 hats", "<|endoftext|> a", "<|STARTOFTEXT|>x <|startoftext|>", "x<|endoftext|>y",
    "J̌ ja", "H̱ T̈", "İx", "K K", "é É", "a b　c", "\x1ca\x1d b\x85c", "́ x ́", "日本語 テキスト",
    "Straße ẞ Σας ΣΑΣ", "\U0001f600\U0001f600 ok", "don't DON'T", "x" * 50_000, "Ab cd " * 30_000, "A b", "<| A", "a\x00b",
]


def library(path, texts):
    if path.endswith(".model"):
        return [len(i) for i in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    return [len(e) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path, by_word", [(WORDS, True), (WORDS, False), (BYTES, False), (PIECES, False)])
def test_odd_texts_have_the_library_s_counts(spark, path, by_word):
    rows = [(i, t, "d", 1) for i, t in enumerate(ODD)] * 2
    docs = spark.createDataFrame(rows, "id long, text string, digest string, n_tokens int").repartition(3)
    counts = token_counts.count_tokens(docs, token_counts.Tokenizer(path, by_word), keep=["id", "digest", "n_tokens"])
    got = sorted((r["row"]["id"], r["row"]["n_tokens"], r["n_bytes"], r["n_tokens"]) for r in counts.collect())
    texts = [t or "" for t in ODD]
    want = [(i, 1, len(t.encode()), n) for i, (t, n) in enumerate(zip(texts, library(path, texts)))]
    assert got == sorted(want * 2)


def test_every_document_of_the_table(spark):
    found = {r["doc_id"]: r for r in QUERIES["op12_token_counts"](spark, TESTDATA).collect()}
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text").collect()
    counts = library(WORDS, [r["text"] or "" for r in docs])
    assert len(found) == len(docs)
    for row, n in zip(docs, counts):
        got = found[row["doc_id"]]
        assert (got["n_tokens"], got["n_bytes"], got["over_limit"]) == (n, len((row["text"] or "").encode()), n > 2048)


def test_known_texts_are_not_encoded_again(spark, tmp_path):
    cache, words = str(tmp_path / "cache"), token_counts.Tokenizer(WORDS, by_word=True)

    def run(texts, tokenizer=words):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        rows = token_counts.count_tokens(docs, tokenizer, cache).collect()
        return [r["n_tokens"] for r in sorted(rows, key=lambda r: r["row"]["doc_id"])]

    def stored():
        return spark.read.parquet(cache)

    assert run(["One two", "one  TWO ", "three"]) == [2, 2, 1]
    assert stored().count() == 2
    # A wrong count in the cache shows that the text is looked up.
    digest = F.unhex(F.sha2(F.lit("known"), 256)).alias("digest")
    planted = spark.range(1).select(digest, F.lit(77).cast("long").alias("n_tokens"), F.lit(words.version()).alias("version"))
    for _ in range(2):  # appended twice, as by two runs at once
        planted.write.mode("append").parquet(cache)
    assert run(["KNOWN", "three", "four"]) == [77, 1, 1]
    assert stored().count() == 5
    assert run(["known"], token_counts.Tokenizer(WORDS)) == [1]
    assert run([]) == [] and stored().count() == 6


def test_a_worker_forgets_words_by_their_bytes(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 20_000)
    counter = token_counts.Counter(token_counts.Tokenizer(WORDS, by_word=True))
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(60)] + ["y" * 30_000, "y" * 30_000 + " z"]
    assert counter.count(texts) == library(WORDS, texts)
    size = sum(2 * len(w) + 100 for w in [*counter.young, *counter.old])
    assert size <= 2 * (20_000 + 2 * 30_100)

"""The pipeline as a whole on odd tables, against what its stages are to do by hand."""

import os
import random
import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terrace.llm import token_files

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, row string, key string, size long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


@pytest.fixture
def run(spark, tmp_path):
    def go(rows, items):
        full = [(*r, 1, "x.y", "r", "k", 2) for r in rows]
        spark.createDataFrame(full, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
        frames, frame = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
        columns = frame.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, frame, str(tmp_path)).write.parquet(str(tmp_path / f"stage{i}"))
            frame = spark.read.parquet(str(tmp_path / f"stage{i}"))
            assert i == 4 or frame.columns == columns
            frames.append(frame.collect())
        return frames

    return go


def test_odd_rows_go_where_they_belong(run):
    rng = random.Random(7)
    plain = [(i, " ".join(rng.choices(WORDS, k=30)), "en", rng.choice(["a", "b", None])) for i in range(30)]
    leak = " ".join(WORDS[:11])
    long = " ".join(rng.choices(WORDS, k=60_000))
    rows = [
        *plain, *[plain[4]] * 5, (None, plain[5][1], "en", "a"), (None, "psi chi phi omega " * 9, "en", "a"),
        (70, None, "en", "a"), (71, "", None, "a"), (72, "123 -- 4", "en", None), (73, f"x {leak.upper()}! y", "en", "b"),
        (74, long, "en", "b"), (75, long, None, None), (3, "another text under an id that is taken " * 3, "en", "b"),
    ]
    language, near, leaks, mix, out = run(rows, [(1, leak), (None, None), (2, "")])
    assert len(language) == len(rows) - 3 and not {70, 71, 72} & {r["doc_id"] for r in language}
    kept = sorted(((r["doc_id"], r["text"]) for r in near), key=repr)
    texts = {r[1] for r in rows if r[0] not in (70, 71, 72)}
    assert {t for _, t in kept} == texts and len(kept) == len(texts)
    assert (5, plain[5][1]) in kept and (74, long) in kept and (None, "psi chi phi omega " * 9) in kept
    assert {r["doc_id"] for r in near} - {r["doc_id"] for r in leaks} == {73} and len(leaks) == len(near) - 1
    assert {(r["doc_id"], r["text"]) for r in mix} <= {(r["doc_id"], r["text"]) for r in leaks}
    assert len(out) == len(mix) and sum(r["n_tokens"] for r in out) == max(r["start"] + r["n_tokens"] for r in out)


def test_no_documents_and_no_language_give_empty_stages(run):
    assert run([], []) == [[], [], [], [], []]


def test_documents_without_languages_to_learn_from_all_go(run):
    assert run([(i, "some words here", None, "a") for i in range(5)], [(1, "x")]) == [[], [], [], [], []]


def test_the_mix_writes_a_size_for_each_source_alone(spark, monkeypatch, tmp_path):
    rows = [(i, "one two three " * (i % 4), None if i % 5 == 0 else "ab"[i % 2]) for i in range(60)] + [(60, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    written, write = [], corpus_pipeline.materialize
    monkeypatch.setattr(corpus_pipeline, "materialize", lambda df: (written.append(write(df)), written[-1])[1])
    mixed = corpus_pipeline.source_mix(spark, docs, "").collect()
    want = {s: sum(3 * (i % 4) for i, t, of in rows if t and of == s) for s in ("a", "b", None)}
    assert sorted(map(tuple, written[0].collect()), key=repr) == sorted(want.items(), key=repr)
    taken = sum(len((r["text"] or "").split()) for r in mixed)
    assert 0.9 * 1.5 * sum(want.values()) < taken < 1.1 * 1.5 * sum(want.values())


def test_few_shards_are_held_at_once(spark, monkeypatch):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    shard = 1 << 20
    shards = spark.range(24, numPartitions=1).select(F.unhex(F.repeat(F.lit("ab"), shard)).alias("data"))

    def held(batches):
        for batch in batches:
            row = [batch.num_rows, 0, batch.nbytes, 0]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], ["doc_id", "start", "n_tokens", "ids_crc32"])

    monkeypatch.setattr(token_files, "write_tokens", lambda *a, **k: None)
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long"
    monkeypatch.setattr(token_files, "read_documents", lambda *a: shards.mapInArrow(held, kind))
    found = corpus_pipeline.token_output(spark, shards, "").collect()
    assert sum(r["doc_id"] for r in found) == 24
    assert max(r["n_tokens"] for r in found) <= corpus_pipeline.BYTES_IN_A_BATCH + 2 * shard


def test_giving_memory_back_changes_no_id_and_the_pipeline_does_it(spark, monkeypatch, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randrange(900)))) for i in range(80)]
    docs, found = spark.createDataFrame([*rows, (None, None)], "doc_id long, text string"), []
    for give_back in (False, True):
        path = str(tmp_path / str(give_back))
        token_files.write_tokens(docs, path, corpus_pipeline.TOKENIZER, give_back=give_back)
        read = token_files.read_documents(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
        found.append(sorted(map(repr, read.collect())))
    assert found[0] == found[1] and len(found[0]) == 81

    asked = []
    write = token_files.write_tokens
    monkeypatch.setattr(token_files, "write_tokens", lambda *a, **k: (asked.append(k["give_back"]), write(*a, **k)))
    assert corpus_pipeline.token_output(spark, docs, "").count() == 81
    assert asked == [True]


GROWTH = """
import random, re
import corpus_pipeline
from terrace.llm import token_files

def held():
    return int(re.search(r"Pss_Anon: +(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

encoder = token_files.Encoder(corpus_pipeline.TOKENIZER, False, corpus_pipeline.REMEMBERED)
rng = random.Random(5)
texts = [" ".join("".join(rng.choices("abcdefghij", k=8)) for _ in range(1000)) for _ in range(10)]
encoder.encode(texts)
before = held()
for _ in range(60):
    texts = [" ".join("".join(rng.choices("abcdefghij", k=8)) for _ in range(1000)) for _ in range(10)]
    encoder.encode(texts)
print(held() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory is read from /proc")
def test_a_worker_of_the_pipeline_remembers_few_words():
    home = os.path.dirname(corpus_pipeline.__file__)
    ran = subprocess.run([sys.executable, "-c", GROWTH], cwd=home, capture_output=True, text=True, check=True)
    assert float(ran.stdout) < 32


def test_a_megabyte_of_texts_goes_to_a_worker_at_a_time(spark):
    corpus_pipeline.small_batches(spark)
    texts = spark.range(400, numPartitions=1).select(F.repeat(F.lit("abcd "), 4000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    found = texts.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in found) == 400
    assert max(r["size"] for r in found) < 1.5 * (1 << 20)

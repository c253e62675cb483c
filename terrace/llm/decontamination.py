"""Benchmark decontamination.

The word n-grams of the benchmark items form a hash set.  Training texts are scanned
window by window; a window whose hash is in the set is verified word by word.  The hits
of a text come back as word spans, by which spans or whole documents are removed.
DataFrame functions throughout.

The set is written first, so that the planner knows its true size: it is broadcast
below ``spark.sql.autoBroadcastJoinThreshold`` and joined by a shuffle of windows beyond it.

Defined results: a null or empty text has no words and no hits; an item without words has no
window; an item without an id is listed as ``null``; repeated items count once; repeated
documents each get their row; an empty benchmark hits nothing; other columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.tables import ascii_lower, materialize, merged_spans, text_or_empty, whole_rows

#: Words of a lower-cased text: runs of letters, digits and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same runs in a text as it stands.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, width: int = 10) -> DataFrame:
    """``span, hash, gram, items``: the distinct windows and the sorted ids of their items."""
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    split = benchmark.select(item.alias("item"), words(text_or_empty("text")).alias("w"))
    spans = split.withColumn("span", F.least(F.size("w"), F.lit(width))).where("span > 0")
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("span") + 1))
    return (
        spans.select("item", "span", "w", starts.alias("start"))
        .select("item", "span", F.slice("w", F.col("start"), F.col("span")).alias("gram"))
        .groupBy("span", "gram")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .select("span", F.xxhash64("gram").alias("hash"), F.array_join("gram", " ").alias("gram"), "items")
    )


def _merged(hits: Column) -> Column:
    """Sorted hits as disjoint word spans: struct(start, end), end exclusive."""
    spans = F.transform(hits, lambda h: F.struct(h["pos"].alias("start"), (h["pos"] + h["span"]).alias("end")))
    return merged_spans(spans, touching=True)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, keep: list[str] | None = None
) -> DataFrame:
    """``row`` (the columns of ``docs``, or ``keep`` of them), ``n_words``, ``spans`` and ``items``.

    ``spans`` are the word spans inside benchmark windows, ``items`` the sorted ids of the
    items they come from.  One scan of the texts: windows are probed as they are made, and
    only rows that hit, and one row per text, go on to be gathered, inside their own task
    first.  Nothing is gathered over more than one text.
    """
    windows = materialize(benchmark_windows(benchmark, width))
    lengths = sorted(r["span"] for r in windows.select("span").distinct().collect()) or [width]
    split = docs.select(
        whole_rows(docs.select(*keep) if keep else docs),
        F.monotonically_increasing_id().alias("key"),
        words(text_or_empty("text")).alias("w"),
    ).select("row", "key", "w", F.size("w").alias("n_words"))
    at = split.select("row", "key", "w", "n_words", F.posexplode_outer("w").alias("pos", "word"))
    spans = at.select(
        "row", "key", "w", "n_words", F.coalesce("pos", F.lit(0)).alias("pos"),
        F.explode(F.array(*[F.lit(n) for n in lengths])).alias("length"),
    ) if len(lengths) > 1 else at.select(
        "row", "key", "w", "n_words", F.coalesce("pos", F.lit(0)).alias("pos"), F.lit(lengths[0]).alias("length")
    )
    fits = F.col("pos") + F.col("length") <= F.col("n_words")
    first = (F.col("pos") == 0) & (F.col("length") == lengths[0])
    window = F.slice("w", F.col("pos") + 1, F.col("length"))
    probes = spans.where(fits | first).select(
        F.when(first, F.col("row")).alias("row"), "key", "n_words", "pos", "length",
        F.when(fits, F.xxhash64(window)).alias("probe"),
        F.when(fits, F.array_join(window, " ")).alias("seen"),
    )
    verified = (
        (F.col("probe") == F.col("hash")) & (F.col("length") == F.col("span")) & (F.col("seen") == F.col("gram"))
    )
    hit = F.struct("pos", "span", "items")
    gathered = (
        probes.join(windows, verified, "left")
        .where(F.col("row").isNotNull() | F.col("hash").isNotNull())
        .groupBy("key")
        .agg(
            F.first("row", ignorenulls=True).alias("row"),
            F.first("n_words").alias("n_words"),
            F.array_sort(F.collect_list(F.when(F.col("hash").isNotNull(), hit))).alias("hits"),
        )
    )
    return gathered.select(
        "row", "n_words", _merged(F.col("hits")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"])))).alias("items"),
    )


def hit_words(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and without what stands between them."""
    found = F.regexp_extract_all(text, F.lit(WORD_ANY_CASE), F.lit(0))
    gaps = F.split(text, WORD_ANY_CASE, -1)

    def kept(gap, i):
        inside = F.exists(spans, lambda s: (s["start"] <= i) & (i < s["end"]))
        between = F.exists(spans, lambda s: (s["start"] < i) & (i < s["end"]))
        word = F.when(inside, F.lit("")).otherwise(F.coalesce(F.get(found, i), F.lit("")))
        return F.concat(F.when(between, F.lit("")).otherwise(gap), word)

    return F.when(F.size(spans) > 0, F.array_join(F.transform(gaps, kept), "")).otherwise(text)


def remove_documents(found: DataFrame) -> DataFrame:
    """The documents no benchmark window occurs in."""
    return found.where(F.size("spans") == 0).select("row.*")


def remove_spans(found: DataFrame) -> DataFrame:
    """All documents, without the words that are hit."""
    text = without_spans(F.col("row.text"), F.col("spans"))
    return found.select(F.col("row").withField("text", text).alias("row")).select("row.*")

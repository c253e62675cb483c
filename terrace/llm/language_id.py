"""Language identification by string kernels.

The kernel of two texts counts the character n-grams, of one character up to four, that
both hold, divided by the root of the product of their own counts (a blended-spectrum
presence kernel).  A bounded sample of labelled texts is described by its kernels with a few
landmarks (Nystroem), and one ridge regression per language is fitted on that.  A batch of
texts is scored by one product of its presence matrix X with the landmarks' matrix L and
the regression's weights A.  As X (L' A) = (X L') A, the small product L' A is made once.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every
text if nothing was labelled; texts are read whole; repeated rows score alike, and count once
in the sample, whatever ids they have; ties go to the first language; an empty table gives
no rows; other columns are carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.ngrams import Presence, letters_only, sums
from terrace.llm.tables import ship_library, text_or_empty, uniform_draw

SIZES, SLOT_BITS = (1, 2, 3, 4), 18
#: Labelled texts in the sample over all languages, landmarks, and the ridge.
SAMPLE, LANDMARKS, RIDGE = 1600, 256, 1e-2
#: Languages that are learned at most, those with the most texts.  They bound the model that is sent
#: to the executors: a number per language and slot, 134 MB if landmarks filled all slots.
LANGUAGES = 64
#: Texts described at a time.
BLOCK = 256
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    #: For each slot its row in ``weights``; the last row is for slots no landmark has.
    rows: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def scores(self, slots: list[np.ndarray]) -> np.ndarray:
        norms = np.sqrt(np.maximum([len(s) for s in slots], 1))[:, None]
        return sums(self.weights, [self.rows[s] for s in slots]) / norms + self.bias


def sample(docs: DataFrame, learn: Column, size: int) -> list[tuple[str, np.ndarray]]:
    """At most ``size`` labelled texts as (language, slots), spread evenly over the languages.

    Texts are drawn by a hash of language and text, at a rate that follows the number of different
    texts of each language, so copies are drawn once however many there are.  What comes to the
    driver is bounded: ``LANGUAGES`` languages at most, those of most texts, and of each its quota.
    """
    usable = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    texts = F.approx_count_distinct(F.xxhash64("text")).alias("n")
    most = usable.groupBy("lang").agg(texts).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    counts = {r["lang"]: r["n"] for r in most}
    if not counts:
        return []
    quota = max(2, size // len(counts))
    rate = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.5 * quota / max(n, 1)))])
    drawn = usable.select("lang", "text", uniform_draw("lang", "text", F.lit("sample")).alias("draw")).where(
        F.col("draw") < F.element_at(rate, F.col("lang"))
    )

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        presence, seen = Presence(SIZES, SLOT_BITS), set()
        for batch in batches:
            fresh = [not (d in seen or seen.add(d)) for d in zip(batch["lang"], batch["draw"])]
            batch = batch[fresh]
            for i in range(0, len(batch), BLOCK):
                some = batch.iloc[i : i + BLOCK]
                points = [letters_only(t) for t in some["text"]]
                slots = [presence.slots(p).tobytes() if any_letter else None for p, any_letter in points]
                yield pd.DataFrame({"lang": some["lang"], "draw": some["draw"], "slots": slots})

    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "slots"))
    rows = (
        drawn.mapInPandas(describe, "lang string, draw double, slots binary")
        .where("slots is not null")
        .distinct()
        .withColumn("place", first)
        .where(F.col("place") <= quota)
        .collect()
    )
    chosen: list[tuple[str, np.ndarray]] = []
    for lang in sorted(counts):
        own = sorted((r["draw"], bytes(r["slots"])) for r in rows if r["lang"] == lang)
        chosen += [(lang, np.frombuffer(s, np.int32)) for _, s in own]
    return chosen


def fit(docs: DataFrame, learn: Column | None = None, size: int = SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """Learn from the ``text`` and ``lang`` of a bounded sample of the rows where ``learn`` holds."""
    ship_library(docs.sparkSession)
    rows = sample(docs, F.lit(True) if learn is None else learn, size)
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return Model([], np.zeros(1 << SLOT_BITS, np.int32), np.zeros((1, 0)), np.zeros(0))
    slots = [s for _, s in rows]
    truth = np.array([languages.index(lang) for lang, _ in rows])
    each = max(1, landmarks // len(languages))
    marks = np.concatenate([np.flatnonzero(truth == c)[:each] for c in range(len(languages))])

    used = np.unique(np.concatenate([slots[m] for m in marks]))
    place = np.full(1 << SLOT_BITS, len(used), np.int32)
    place[used] = np.arange(len(used))
    matrix = np.zeros((len(used) + 1, len(marks)), np.float32)
    for j, m in enumerate(marks):
        matrix[place[slots[m]], j] = 1 / np.sqrt(len(slots[m]))

    def kernels(some: list[np.ndarray]) -> np.ndarray:
        blocks = []
        for i in range(0, len(some), 32):
            present = np.zeros((len(some[i : i + 32]), len(used) + 1), np.float32)
            for row, s in zip(present, some[i : i + 32], strict=True):
                row[place[s]] = 1
            present[:, -1] = 0
            blocks.append(present @ matrix)
        return np.concatenate(blocks).astype(np.float64) / np.sqrt([len(s) for s in some])[:, None]

    values, vectors = np.linalg.eigh(kernels([slots[m] for m in marks]))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    features = np.hstack([kernels(slots) @ root, np.ones((len(slots), 1))])
    target = np.where(truth[:, None] == np.arange(len(languages)), 1.0, -1.0)
    penalty = RIDGE * np.eye(features.shape[1])
    penalty[-1, -1] = 0
    solved = np.linalg.lstsq(features.T @ features + penalty, features.T @ target, rcond=None)[0]
    weights = np.asfortranarray(matrix.astype(np.float64) @ (root @ solved[:-1]))
    return Model(languages, place, weights, solved[-1])


def predict(docs: DataFrame, model: Model) -> Column:
    """struct(lang_pred, score) from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ship_library(docs.sparkSession)

    def batch(texts: pd.Series) -> pd.DataFrame:
        fitted, presence = shared.value, Presence(SIZES, SLOT_BITS)
        names, best = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        for i in range(0, len(texts) if fitted.languages else 0, BLOCK):
            read = [letters_only(t) for t in texts.iloc[i : i + BLOCK]]
            some = np.array([i + k for k, (_, letter) in enumerate(read) if letter], np.int64)
            scores = fitted.scores([presence.slots(points) for points, letter in read if letter])
            if len(some):
                names[some] = np.array(fitted.languages, object)[scores.argmax(axis=1)]
                best[some] = np.clip((scores.max(axis=1) + 1) / 2, 0, 1)
        return pd.DataFrame({"lang_pred": names, "score": best})

    return F.pandas_udf(batch, "lang_pred string, score double")(text_or_empty("text"))

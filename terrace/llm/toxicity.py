"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over words and their beginnings learns from confirmed toxic texts and from
unlabelled ones.  With the class prior p the risk is p R+(g) + max(0, Ru-(g) - p R+-(g)): the
unlabelled texts taken as negative, less the share that positives have among them, which
must not fall below zero.  When it does in a batch, the step goes back up that part.  The
classifier is numpy on a bounded sample; every whole text is scored in the executors.

Defined results: a null or empty text gets the score of the bias; without a confirmed toxic
text all scores are 0; texts are read whole, long runs of letters and scripts without
spaces at every place; repeated rows score alike, and count once in the samples, whatever ids
they have; an empty table gives no rows; other columns are carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.ngrams import Presence, letters_only, sums
from terrace.llm.tables import materialize, ship_library, text_or_empty, uniform_draw

SIZES, SLOT_BITS = (4, 5, 6), 20
#: Texts described at a time.
BLOCK = 256
#: Bounds of the sample: confirmed toxic texts and unlabelled ones.
POSITIVES, UNLABELLED = 3000, 9000
#: Standard errors by which a feature must be more common in the positives to be used.
SIGNIFICANT = 4.5
#: Training: passes over the sample, texts in a batch, step, weight decay.
EPOCHS, BATCH, RATE, DECAY = 50, 10000, 0.05, 1e-3


@dataclass
class Model:
    rows: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, slots: list[np.ndarray]) -> np.ndarray:
        return _sigmoid(sums(self.weights, [self.rows[s] for s in slots]) + self.bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _sample(rows: DataFrame, size: int, salt: str) -> list[np.ndarray]:
    """The slots of at most ``size`` different texts of ``rows``, drawn by a hash of the text.

    The rate follows the number of different texts, so copies are drawn once however many
    there are, and no more than ``size`` texts come to the driver.
    """
    texts = rows.select(text_or_empty("text").alias("text"))
    count = texts.agg(F.approx_count_distinct(F.xxhash64("text"))).first()[0]
    share = min(1.0, 1.1 * size / max(count, 1))
    drawn = texts.withColumn("draw", uniform_draw("text", F.lit(salt))).where(F.col("draw") < share)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        presence, seen = Presence(SIZES, SLOT_BITS), set()
        for batch in batches:
            batch = batch[[not (d in seen or seen.add(d)) for d in batch["draw"]]]
            for i in range(0, len(batch), BLOCK):
                some = batch.iloc[i : i + BLOCK]
                points = [letters_only(t)[0] for t in some["text"]]
                yield pd.DataFrame({"draw": some["draw"], "slots": [s.tobytes() for s in presence.word_slots(points)]})

    described = drawn.mapInPandas(describe, "draw double, slots binary").distinct()
    found = described.orderBy("draw", "slots").limit(size).collect()
    return [np.frombuffer(s, np.int32) for s in sorted(bytes(r["slots"]) for r in found)]


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """Learn from the texts of ``docs`` and the confirmed toxic ids of ``labels`` where ``learn`` holds.

    ``labels`` has ``doc_id, toxic``; ``learn`` is a condition on ``doc_id``.  The class prior is the
    share of toxic ids among the labelled ones.
    """
    ship_library(docs.sparkSession)
    known = labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    total, toxic = known.agg(F.count(F.lit(1)), F.sum(F.col("toxic").cast("long"))).first()
    empty = Model(np.zeros(1 << SLOT_BITS, np.int32), np.zeros(1), -40.0)
    if not toxic:
        return empty
    usable = docs.where(learn).select("doc_id", "text")
    confirmed = known.where("toxic = 1").select("doc_id").distinct()
    share = 1.5 * POSITIVES / max(confirmed.count(), 1)
    # Written, so that the planner sees how few they are and moves no text for them.
    drawn = materialize(confirmed.where(uniform_draw("doc_id", F.lit("confirmed")) < share))
    positive = _sample(usable.join(drawn, "doc_id", "left_semi"), POSITIVES, "toxic")
    unlabelled = _sample(usable, UNLABELLED, "unlabelled")
    if not positive:
        return empty
    return train(positive, unlabelled or positive, toxic / total)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Fit the weights of the features significantly more common in the positives."""
    in_p, in_u = (np.bincount(np.concatenate(part), minlength=1 << SLOT_BITS) for part in (positive, unlabelled))
    n_p, n_u = len(positive), len(unlabelled)
    pooled = (in_p + in_u) / (n_p + n_u)
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / n_p + 1 / n_u))
    used = np.flatnonzero((in_p / n_p - in_u / n_u) / error >= SIGNIFICANT)
    place = np.full(1 << SLOT_BITS, len(used), np.int32)
    place[used] = np.arange(len(used))
    theta, bias = np.zeros(len(used) + 1), float(np.log(prior / (1 - prior))) if prior < 1 else 0.0
    first, second = np.zeros(len(theta) + 1), np.zeros(len(theta) + 1)
    pos, unl = ([r[r < len(used)] for r in (place[s] for s in part)] for part in (positive, unlabelled))
    rng, step = np.random.default_rng(0), 0

    def gradient(part: list[np.ndarray], pull: np.ndarray) -> np.ndarray:
        """Of the sum of ``pull`` times each text's value, by weights and bias."""
        sizes = [len(s) for s in part]
        flat = np.concatenate(part) if part else np.empty(0, np.int32)
        return np.append(np.bincount(flat, np.repeat(pull, sizes), len(theta)), pull.sum())

    batches = max(1, -(-len(unl) // BATCH))
    for _ in range(EPOCHS):
        order_p, order_u = rng.permutation(len(pos)), rng.permutation(len(unl))
        for p_at, u_at in zip(np.array_split(order_p, batches), np.array_split(order_u, batches), strict=True):
            if not len(p_at) or not len(u_at):
                continue
            p, u = [pos[i] for i in p_at], [unl[i] for i in u_at]
            g_p, g_u = _sigmoid(sums(theta, p) + bias), _sigmoid(sums(theta, u) + bias)
            # Logistic losses: -log(g) for positives, -log(1 - g) for negatives.
            negative = -np.log1p(-np.minimum(g_u, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(g_p, 1 - 1e-12)).mean()
            towards_negative = gradient(u, g_u / len(u)) - gradient(p, prior * g_p / len(p))
            towards_positive = gradient(p, prior * (g_p - 1) / len(p))
            slope = towards_positive + towards_negative if negative >= 0 else -towards_negative
            slope[:-1] += DECAY * theta
            step += 1
            first += 0.1 * (slope - first)
            second += 0.001 * (slope**2 - second)
            move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            theta -= move[:-1]
            theta[-1] = 0
            bias -= float(move[-1])
    return Model(place, theta, bias)


def score(docs: DataFrame, model: Model) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ship_library(docs.sparkSession)

    def batch(texts: pd.Series) -> pd.Series:
        fitted, presence = shared.value, Presence(SIZES, SLOT_BITS)
        out = [
            fitted.scores(presence.word_slots([letters_only(t)[0] for t in texts.iloc[i : i + BLOCK]]))
            for i in range(0, len(texts), BLOCK)
        ]
        return pd.Series(np.concatenate(out) if out else [], dtype="float64")

    return F.pandas_udf(batch, "double")(text_or_empty("text"))

"""Quality classifier: a linear support vector machine on Naive Bayes features.

N-gram indicators are scaled by the log-count ratio of the two classes, so rare
words start out harmless and telling ones large; a linear hinge-loss model is
then fitted by dual coordinate descent and drawn a little towards the Naive Bayes
weights.  Margins become probabilities by a logistic curve fitted on margins of
rows that the model in question did not see, corrected to the classes' true shares.

The fit uses at most ``PER_CLASS`` labelled rows of each class, those of the
smallest hash: a bounded sample, so it runs in one task.  Shares are counted over
all labels.  Scoring is a map over the documents with the weights (one float per
hashed feature, a fixed size) in the closure.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import packed, stored, unpacked
from .ngrams import BITS, indicators, slices

#: Labelled rows of each class that the fit uses at most.
PER_CLASS = 2000
#: A document is kept at this score or more.
THRESHOLD = 0.3
HELD_OUT_EVERY = 5
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20
#: Weight of the mean magnitude against the fitted weights.
BLEND = 0.25
FOLDS = 3


def held_out(doc_id: Column) -> Column:
    """The rows that training never sees; a null id counts as empty and is one of them."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_EVERY == 0


class Svm:
    """Fitted on rows of sorted feature numbers with labels 1 and -1, both present."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS) -> None:
        seen = [np.zeros(1 << bits) for _ in range(2)]
        for features, label in zip(rows, labels, strict=True):
            seen[int(label > 0)][features] += 1
        bad, good = (n + SMOOTHING for n in seen)
        ratio = np.where(seen[0] + seen[1] > 0, np.log(good / good.sum()) - np.log(bad / bad.sum()), 0.0)
        weights, self.bias = self._descend(rows, labels, ratio)
        weights = (1 - BLEND) * weights + BLEND * np.abs(weights).mean()
        #: per feature: weight times scaled value, and the squared scaled value
        self.parts, self.squares = (weights * ratio).astype(np.float32), (ratio * ratio).astype(np.float32)

    @staticmethod
    def _descend(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
        """Dual coordinate descent for the L2-regularised hinge loss; rows are scaled to length one, the bias is a feature of value one."""
        weights, bias = np.zeros(len(ratio)), 0.0
        values = [ratio[f] for f in rows]
        norms = [float(np.sqrt(v @ v)) or 1.0 for v in values]
        values = [v / n for v, n in zip(values, norms, strict=True)]
        share = {s: COST * len(labels) / (2 * max(1, int((labels == s).sum()))) for s in (1, -1)}  # both classes weigh the same
        alpha = np.zeros(len(rows))
        square = [float(v @ v) + 1.0 for v in values]
        turns = np.random.default_rng(7)
        for _ in range(EPOCHS):
            largest = 0.0
            for i in turns.permutation(len(rows)):
                label = labels[i]
                slope = label * (weights[rows[i]] @ values[i] + bias) - 1.0
                new = min(max(alpha[i] - slope / square[i], 0.0), share[int(label)])
                if new != alpha[i]:
                    step = (new - alpha[i]) * label
                    weights[rows[i]] += step * values[i]
                    bias += step
                    largest = max(largest, abs(new - alpha[i]))
                    alpha[i] = new
            if largest < 1e-3:
                break
        return weights, bias

    def margins(self, numbers: np.ndarray, features: np.ndarray, count: int) -> np.ndarray:
        return margins(self.parts, self.squares, self.bias, numbers, features, count)


def margins(parts: np.ndarray, squares: np.ndarray, bias: float, numbers: np.ndarray, features: np.ndarray, count: int) -> np.ndarray:
    """Margin of each text from its (text number, feature) pairs; a text without known features has the bias alone."""
    length = np.sqrt(np.bincount(numbers, squares[features], minlength=count))
    return np.bincount(numbers, parts[features], minlength=count) / np.where(length > 0, length, 1.0) + bias


def logistic(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1, with targets drawn in from 0 and 1, by Newton's method."""
    positive, negative = int((labels > 0).sum()), int((labels <= 0).sum())
    target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    design = np.stack([margin, np.ones(len(margin))])
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(theta @ design, -30, 30)))
        slope = design @ (chance - target) + 1e-4 * theta
        step = np.linalg.solve((design * (chance * (1 - chance))) @ design.T + 1e-4 * np.eye(2), slope)
        theta = theta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, share: float) -> tuple[Svm, float, float]:
    """The model, and slope and offset of its log odds.  ``share`` is the true share of label 1."""
    fold = np.arange(len(rows)) % FOLDS
    unseen = np.zeros(len(rows))
    for k in range(FOLDS):
        inner, outer = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(set(labels[inner])) == 2 and len(outer):
            part = Svm([rows[i] for i in inner], labels[inner])
            numbers = np.repeat(np.arange(len(outer)), [len(rows[i]) for i in outer])
            unseen[outer] = part.margins(numbers, np.concatenate([rows[i] for i in outer]).astype(np.int64), len(outer))
    slope, offset = logistic(unseen, labels)
    here = float((labels > 0).mean())
    odds = lambda p: np.log(p / (1 - p))
    return Svm(rows, labels), slope, offset + odds(share) - odds(here)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict:
    """A small model from the labelled rows that are not held out.

    Null labels and ids are left out; a repeated id counts once, with its smallest
    label and text.  With a single class, or none, every text scores the smoothed
    share of label 1.
    """
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")).filter(~held_out(F.col("doc_id")))
    known = known.select("doc_id", (F.col("quality") > 0).cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    bad, good = counts.get(0, 0), counts.get(1, 0)
    model = {"share": (good + 1) / (good + bad + 2), "parts": None}
    if not (good and bad):
        return model
    first = W.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = stored(known.withColumn("_no", F.row_number().over(first)).filter(F.col("_no") <= per_class).drop("_no"), "quality-sample")
    sample = docs.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    share = model["share"]

    def fitted(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        texts, features = rows["text"].tolist(), []
        for begin, end in slices(texts):
            numbers, found = indicators(texts[begin:end])
            cuts = np.searchsorted(numbers, np.arange(end - begin + 1))
            features += [found[a:b].astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        target = np.where(rows["label"].to_numpy() > 0, 1, -1)
        if len(set(target)) < 2:
            return pd.DataFrame({"parts": [], "squares": [], "numbers": []}, dtype=object)
        svm, slope, offset = fit(features, target, share)
        return pd.DataFrame({"parts": [svm.parts.tobytes()], "squares": [svm.squares.tobytes()], "numbers": [[svm.bias, slope, offset]]})

    # A bounded sample: at most ``per_class`` rows of each class meet in this one task.
    result = sample.groupBy(F.lit(1).alias("one")).applyInPandas(fitted, "parts binary, squares binary, numbers array<double>").collect()
    if result:
        model |= {"parts": np.frombuffer(result[0]["parts"], np.float32), "squares": np.frombuffer(result[0]["squares"], np.float32), "numbers": list(result[0]["numbers"])}
    return model


def score(docs: DataFrame, model: dict, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns plus score and predicted.  Null text counts as empty; input columns named like an output are replaced."""

    @F.pandas_udf("double")
    def chance(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts, found = batch.fillna("").tolist(), np.full(len(batch), model["share"])
            for begin, end in slices(texts) if model["parts"] is not None else ():
                bias, slope, offset = model["numbers"]
                margin = margins(model["parts"], model["squares"], bias, *indicators(texts[begin:end]), end - begin)
                found[begin:end] = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -700, 700)))
            yield pd.Series(found)

    scored = packed(docs, _text=F.col(f"`{text}`")).withColumn("score", chance("_text"))
    return unpacked(scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")), docs.columns, "score", "predicted")

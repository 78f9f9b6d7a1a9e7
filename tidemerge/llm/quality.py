"""Quality classifier learned from trusted positives and unlabelled text (positive-unlabelled learning).

A linear model over text statistics minimises the non-negative unbiased risk

    prior * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - prior * E_pos[loss(-f)])

with the logistic loss: documents labelled 1 are the positives, a sample of all training documents is the unlabelled
part, whatever their labels say. When the second part falls below zero, the step goes back up on that part alone. The
class prior is estimated as the share of label 1 among all labelled training rows. Labels of rows held out
(crc32 of the id modulo 5 is 0) take no part, and labels, language, source and id are no inputs.

The fit uses samples of about ``SAMPLE_ROWS`` documents and ``POSITIVE_ROWS`` labelled positives, each chosen by a hash of
id and text; their statistics (a few dozen numbers a document) reach the driver. Every document is scored.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidemerge.llm.base import query, remainder, table

FOLDS = 5
SAMPLE_ROWS = 20_000
POSITIVE_ROWS = 20_000
THRESHOLD = 0.3
STEPS = 600
RATE = 0.05
RIDGE = 1e-3

LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = b"0123456789"
SPACES = b" \t\n\r\x0b\x0c"
STOPS = b".,;:!?"
MARKS = bytes(b for b in range(33, 127) if b not in LETTERS and b not in DIGITS and b not in STOPS)


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text; a null text counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.lower().split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    size, n = max(1, len(data)), max(1, len(words))

    def share(chars: bytes) -> float:
        return (len(data) - len(data.translate(None, chars))) / size

    counts = Counter(words)
    top = [c for _, c in counts.most_common(5)]
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    sentences = data.count(b".") + data.count(b"!") + data.count(b"?")
    return [
        np.log1p(len(words)), np.log1p(len(data)), lengths.mean(), lengths.std(), (lengths <= 2).mean(), (lengths >= 12).mean(),
        len(counts) / n, len(counts) / n ** 0.8, sum(top) / n, (top or [0])[0] / n,
        sum(map(eq, words, words[1:])) / n, sum(map(eq, words, words[2:])) / n,
        share(LETTERS), share(DIGITS), share(SPACES), share(STOPS), share(MARKS), share(b"|"), share(b"#$%&*"),
        share(bytes(range(65, 91))), share(bytes(range(128, 256))), share(b"\n"),
        sum(w[-1] in STOPS for w in words) / n, sum(w[-1] in MARKS for w in words) / n, sum(w[0] in MARKS for w in words) / n,
        len(set(lines)) / max(1, len(lines)), np.log1p(len(data) / max(1, len(lines))), np.log1p(n / max(1, sentences)),
    ]


@F.pandas_udf(ArrayType(DoubleType()))
def statistics_column(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [float(x) for x in statistics(t)], na_action=None)


class Model:
    """Standardised statistics and their squares, weighted."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights

    def inputs(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -6, 6)
        return np.hstack([z, z * z - 1, np.ones((len(z), 1))])

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.inputs(rows) @ self.weights))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> Model:
    """The model of least non-negative risk, by Adam over all rows; without positives each text scores the prior."""
    width = unlabelled.shape[1]
    if not len(positive) or not len(unlabelled):
        weights = np.zeros(2 * width + 1)
        weights[-1] = np.log(prior / (1 - prior)) if 0 < prior < 1 else 40 * (1 if prior >= 1 else -1)
        return Model(np.zeros(width), np.ones(width), weights)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0)
    model = Model(mean, np.where(scale > 1e-9, scale, 1), np.zeros(2 * width + 1))
    p, u = model.inputs(positive), model.inputs(unlabelled)
    w, first, second = model.weights, np.zeros_like(model.weights), np.zeros_like(model.weights)
    for step in range(1, steps + 1):
        fp, fu = p @ w, u @ w
        up = 1 / (1 + np.exp(-fp))  # also the slope of loss(-f)
        un = 1 / (1 + np.exp(-fu))
        rest = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        slope_rest = (un @ u) / len(u) - prior * (up @ p) / len(p)
        slope = -slope_rest if rest < 0 else prior * ((up - 1) @ p) / len(p) + slope_rest
        slope = slope + RIDGE * np.append(w[:-1], 0)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
        w -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learnt from; false for a null id."""
    return F.coalesce(remainder(doc_id, FOLDS) == 0, F.lit(False))


def _chosen(rows: DataFrame, share: float) -> DataFrame:
    """About ``share`` of the different documents, by a hash of id and text; copies of one are a single row."""
    h = F.xxhash64(F.lit(3), "doc_id", "text")
    some = rows.select("doc_id", "text", h.alias("h")).where(F.shiftrightunsigned("h", 33) < int(min(1.0, share) * (1 << 31)))
    return some.groupBy("doc_id", "h").agg(F.first("text").alias("text"))


def _inputs(rows: DataFrame) -> np.ndarray:
    """The statistics of a bounded sample."""
    got = rows.select(statistics_column("text").alias("x")).toArrow()
    return got["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(got), len(statistics("")))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, positive_rows: int = POSITIVE_ROWS) -> Model:
    """Fits on ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    Positives are drawn from all documents labelled 1 (about ``positive_rows``), unlabelled ones from all documents
    outside the held-out part (about ``sample_rows``). Documents with unequal labels are no positives. Rows with a null id
    are unlabelled documents; repeated rows count once in a sample. Without positives each text scores the prior.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    n, good = known.agg(F.count("*"), F.sum((F.col("quality") == 1).cast("long"))).first()
    rows = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    x = _inputs(_chosen(rows, sample_rows / max(1, docs.count())))
    liked = known.where("quality = 1").select("doc_id")
    p = _inputs(_chosen(rows, positive_rows / max(1, good or 0)).join(liked, "doc_id", "left_semi"))
    return fit(p, x, (good or 0) / n if n else 1.0)


def scored(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1; null and empty texts get the score of an empty text."""

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.array([statistics(t) for t in texts], np.float64)))

    return docs.withColumn(into, score(F.col(text)))


@query("op3_quality")
def op3_quality(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    model = train(docs, table(spark, folder, "labels", "doc_id", "quality"))
    out = scored(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

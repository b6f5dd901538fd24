"""Operator 10, quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

The Gaussian kernel over standardised document statistics is approximated by cosine features with fixed
random frequencies.  Each partition of the labelled sample sums its part of the normal equations, Spark
adds the parts, and the driver solves one small system.  The ridge scores are calibrated by isotonic
regression over a fixed grid of score bins, counted by Spark.

Defined results: a null or empty text is scored on zero statistics; null ids are scored like others with
``held_out`` null; a column that is called like a result column is replaced; without labels of both
classes every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.common import SAMPLE_ROWS, append_columns, fold, labelled_sample, stage
from roadlens.llm.textstats import FEATURES, column_stats

N_COSINES = 200
KERNEL_WIDTH = 3.0
RIDGE = 1.0
BINS = 500
PREDICT_FROM = 0.3
SEED = 20


@dataclass
class Calibrated:
    """Standardisation, frequencies, ridge weights, and a non-decreasing step from raw score to probability."""

    mean: np.ndarray
    spread: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    steps: np.ndarray

    def cosines(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.spread, -6, 6)
        waves = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.omega + self.phase)
        return np.concatenate((waves, np.ones((len(z), 1))), axis=1)

    def bin(self, features: np.ndarray) -> np.ndarray:
        raw = self.cosines(features) @ self.weights if len(features) else np.zeros(0)
        return np.clip(((raw + 0.5) / 2 * BINS).astype(np.int64), 0, BINS - 1)  # raw scores lie near 0 to 1

    def score(self, features: np.ndarray) -> np.ndarray:
        return self.steps[self.bin(features)]


def isotonic(ones: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Least-squares non-decreasing probabilities by bin (pool adjacent violators); empty bins take their lower neighbour's."""
    pools: list[list[float]] = []
    for one, total, at in zip(ones, totals, range(len(ones)), strict=True):
        if total == 0:
            continue
        pools.append([one, total, at])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1][0] += last[0]
            pools[-1][1] += last[1]
    out = np.empty(len(ones))
    starts = [p[2] for p in pools] + [len(ones)]
    for i, (one, total, _) in enumerate(pools):
        out[0 if i == 0 else starts[i]:starts[i + 1]] = one / total
    return out


def _features_of(text: pa.Array) -> list[pa.Array]:
    return [pa.array(list(column_stats(text)[1]), type=pa.list_(pa.float64()))]


def _normal_equations(sample: DataFrame, model: Calibrated) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y: summed within each partition, then by Spark; at most (N_COSINES + 1)^2 sums come back."""
    n = N_COSINES + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((n, n + 1))
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column(0).to_numpy(zero_copy_only=False))
                z = model.cosines(x)
                both[:, :n] += z.T @ z
                both[:, n] += z.T @ batch.column(1).to_numpy(zero_copy_only=False)
        i, j = np.nonzero(np.ones_like(both))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(both.reshape(-1))], names=["i", "j", "v"])

    sums = sample.select("features", F.col("label").cast("double")).mapInArrow(partial, "i long, j long, v double")
    out = np.zeros((n, n + 1))
    for r in sums.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = r["v"]
    return out[:, :n], out[:, n]


def fit_classifier(docs: DataFrame, labels: DataFrame, label: str = "quality",
                   sample_rows: int = SAMPLE_ROWS) -> Calibrated | float:
    """The model of at most ``sample_rows`` labelled documents that are not held out; a constant if they show one class."""
    schema = T.StructType([T.StructField("features", T.ArrayType(T.DoubleType()))])
    sample = stage(append_columns(labelled_sample(docs, labels, label, sample_rows), "text", schema, _features_of,
                                  ["label"]), "op10-sample")
    numbers = [F.avg("label").alias("share")]
    for i in range(len(FEATURES)):
        value = F.col("features")[i]
        numbers += [F.avg(value).alias(f"mean{i}"), F.stddev_pop(value).alias(f"spread{i}")]
    found = sample.agg(*numbers).first()
    if found["share"] is None or found["share"] in (0.0, 1.0):
        return 0.5 if found["share"] is None else float(found["share"])
    rng = np.random.default_rng(SEED)
    model = Calibrated(
        mean=np.array([found[f"mean{i}"] for i in range(len(FEATURES))]),
        spread=np.maximum([found[f"spread{i}"] for i in range(len(FEATURES))], 1e-9),
        omega=rng.normal(size=(len(FEATURES), N_COSINES)) / KERNEL_WIDTH,
        phase=rng.uniform(0, 2 * np.pi, N_COSINES),
        weights=np.zeros(N_COSINES + 1),
        steps=np.zeros(BINS),
    )
    gram, target = _normal_equations(sample, model)
    penalty = RIDGE * np.eye(len(target))
    penalty[-1, -1] = 0  # the constant is free
    model.weights = np.linalg.solve(gram + penalty, target)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column(0).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.array(model.bin(x)), batch.column(1)], names=["bin", "label"])

    ones, totals = np.zeros(BINS), np.zeros(BINS)
    counted = sample.select("features", "label").mapInArrow(binned, "bin long, label int")
    for r in counted.groupBy("bin").agg(F.sum("label").alias("ones"), F.count("*").alias("total")).collect():
        ones[r["bin"]], totals[r["bin"]] = r["ones"], r["total"]
    model.steps = isotonic(ones, totals)
    return model


def apply_classifier(docs: DataFrame, model: Calibrated | float, text_col: str = "text",
                     carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (calibrated probability of label 1) and ``predicted`` (1 from 0.3 up)."""

    def compute(text: pa.Array) -> list[pa.Array]:
        if isinstance(model, float):
            score = np.full(len(text), model)
        else:
            score = model.score(column_stats(text)[1])
        return [pa.array(score), pa.array((score >= PREDICT_FROM).astype(np.int32))]

    schema = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return append_columns(docs, text_col, schema, compute, carry)


def quality_classifier(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Fit on the labels that are not held out, then score every document."""
    scored = apply_classifier(docs, fit_classifier(docs, labels), carry=carry)
    return scored.withColumn("held_out", fold() == 0)

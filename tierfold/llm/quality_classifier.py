"""A quality score from document statistics: random Fourier features, ridge, isotonic calibration.

Statistics of each text are computed by Spark expressions. Random Fourier features of them
approximate a Gaussian kernel; every partition adds up its part of the normal equations, Spark sums
the parts row by row, and the driver solves one small system. Scores of labelled documents, from
models that have not seen them, are summed into a histogram of fixed size, and isotonic regression
over it turns scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import name_of, text_of, words, written

#: Random features, their seed, the ridge penalty per labelled row, folds for calibration.
FEATURES, SEED, PENALTY, FOLDS, BINS = 192, 20_26, 1e-3, 4, 2048


def statistics(text: Column) -> dict[str, Column]:
    """Expressions over the columns ``text`` and ``words`` that describe a text, all finite."""
    n = F.greatest(F.size("words"), F.lit(1))
    chars = F.greatest(F.length(text), F.lit(1))
    lines = F.split(text, "\n")
    n_lines = F.greatest(F.size(lines), F.lit(1))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    long_words = F.size(F.filter("words", lambda w: F.length(w) > 12))
    pairs = F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0)))
    return {
        "log_words": F.log1p(F.size("words")),
        "word_length": F.least(F.length(F.array_join("words", "")) / n, F.lit(40.0)),
        "long_words": long_words / n,
        "distinct_words": F.size(F.array_distinct("words")) / n,
        "doubled_words": F.size(F.filter(pairs, lambda w, i: w == F.get("words", i))) / n,
        "symbols": F.least(count(r"[#*$%&|<>]") / n, F.lit(6.0)),
        "stops": F.least(count(r"[.!?]") / n, F.lit(4.0)),
        "commas": F.least(count(r"[,;:]") / n, F.lit(4.0)),
        "exclamations": F.least(count("!") / n, F.lit(4.0)),
        "digits": count("[0-9]") / chars,
        "capitals": count(r"\p{Lu}") / chars,
        "other_signs": count(r"[^\p{L}\p{N}\s.,;:!?'\"()-]") / chars,
        "white_space": count(r"\s") / chars,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "log_line_words": F.log1p(F.size("words") / n_lines),
        "log_lines": F.log1p(n_lines),
        "links": F.least(count(r"https?://|www\.|@") / n, F.lit(2.0)),
    }


def with_statistics(docs: DataFrame, *keep: str) -> tuple[DataFrame, list[str]]:
    """(kept columns, one double per statistic), written since several passes read it."""
    text = text_of()
    df = docs.select(*(name_of(c) for c in keep), text.alias("text")).withColumn("words", words(F.col("text")))
    made = statistics(F.col("text"))
    return written(df.select(*keep, *(c.cast("double").alias(k) for k, c in made.items())), "statistics"), list(made)


@dataclass(frozen=True)
class Kernel:
    """Scaling of the statistics and the random directions of the Fourier features."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([np.ones((len(rows), 1)), z / 6, waves])


def fit_kernel(stats: DataFrame, names: list[str], features: int = FEATURES, seed: int = SEED) -> Kernel:
    """Means and deviations over all rows; directions for a bandwidth of the root of their number."""
    sums = stats.agg(*(F.avg(c).alias(f"m{i}") for i, c in enumerate(names)), *(F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(names))).first()
    mean = np.array([sums[f"m{i}"] or 0.0 for i in range(len(names))])
    scale = np.array([sums[f"s{i}"] or 1.0 for i in range(len(names))])
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(len(names), features)) / np.sqrt(len(names))
    return Kernel(mean, scale, directions, rng.uniform(0, 2 * np.pi, features))


def _normal_equations(labelled: DataFrame, names: list[str], kernel: Kernel) -> np.ndarray:
    """For each fold, the sums of x xT and of x y side by side, from (fold, label, statistics)."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for fold, rows in batch.groupby("fold"):
                x = kernel.features(rows[names].to_numpy(float))
                sums = x.T @ np.hstack([x, rows[["label"]].to_numpy(float)])
                total[fold] = total.get(fold, 0) + sums
        for fold, sums in total.items():
            yield pd.DataFrame({"fold": fold, "i": range(len(sums)), "row": list(sums)})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": rows["fold"][:1], "i": rows["i"][:1], "row": [np.sum(np.stack(rows["row"]), axis=0)]})

    schema = "fold INT, i INT, row ARRAY<DOUBLE>"
    # one row for each fold and feature, a few hundred in all
    summed = labelled.mapInPandas(part, schema).groupBy("fold", "i").applyInPandas(add, schema).collect()
    n = 1 + len(names) + len(kernel.phases)
    out = np.zeros((FOLDS, n, n + 1))
    for r in summed:
        out[r["fold"], r["i"]] = r["row"]
    return out


def _solve(sums: np.ndarray) -> np.ndarray:
    """Ridge weights; the constant feature, whose sum counts the rows, is not penalised."""
    penalty = np.eye(len(sums)) * PENALTY * max(sums[0, 0], 1.0)
    penalty[0, 0] = 1e-9
    return np.linalg.solve(sums[:, :-1] + penalty, sums[:, -1])


@dataclass(frozen=True)
class Calibration:
    """Isotonic steps as points of a rising line."""

    scores: np.ndarray
    probabilities: np.ndarray

    def __call__(self, scores: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(scores, self.scores, self.probabilities), 0.0, 1.0)


def isotonic(scores: np.ndarray, positives: np.ndarray, counts: np.ndarray) -> Calibration:
    """Pool-adjacent-violators over points in rising order of score.

    A slight slope inside each pool keeps scores in order, where the pool itself is flat.
    """
    pools: list[list[float]] = []  # positives, count, first score, last score
    for s, p, n in zip(scores, positives, counts, strict=True):
        pools.append([p, n, s, s])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            p2, n2, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + p2, pools[-1][1] + n2, pools[-1][2], last]
    xs, ys = [], []
    for p, n, first, last in pools:
        level = (p + 0.5) / (n + 1)  # of few rows, nothing is certain
        xs += [first, last]
        ys += [level, level]
    ys = np.maximum.accumulate(ys)
    slope = 1e-4 * (np.array(xs) - xs[0]) / max(xs[-1] - xs[0], 1e-12)
    keep = np.concatenate([[True], np.diff(xs) > 0])
    return Calibration(np.array(xs)[keep], (ys * (1 - 1e-4) + slope)[keep])


@dataclass(frozen=True)
class QualityModel:
    names: list[str]
    kernel: Kernel
    weights: np.ndarray
    calibration: Calibration

    def score(self, rows: np.ndarray) -> np.ndarray:
        return self.calibration(self.kernel.features(rows) @ self.weights)


def fit(stats: DataFrame, names: list[str], labels: DataFrame) -> QualityModel:
    """A model of the 0/1 ``label`` in (doc_id, label), of the statistics of all labelled rows.

    Null ids and labels say nothing; if an id has several labels, their mean counts. Without any
    label the model gives 0.5 throughout.
    """
    kernel = fit_kernel(stats, names)
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.avg("label").alias("label"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    labelled = written(stats.join(known, "doc_id").select(fold, "label", *names), "labelled")
    sums = _normal_equations(labelled, names, kernel)
    total = sums.sum(axis=0)
    if not total[0, 0]:
        return QualityModel(names, kernel, np.zeros(len(total)), Calibration(np.zeros(1), np.full(1, 0.5)))
    unseen = [_solve(total - part) for part in sums]
    low, high = -0.5, 1.5

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = kernel.features(batch[names].to_numpy(float))
            score = np.choose(batch["fold"].to_numpy(), [x @ w for w in unseen]) if len(batch) else np.empty(0)
            at = np.clip(((score - low) / (high - low) * BINS).astype(int), 0, BINS - 1)
            yield pd.DataFrame({"bin": at, "label": batch["label"], "score": score})

    bins = labelled.mapInPandas(binned, "bin INT, label DOUBLE, score DOUBLE").groupBy("bin")
    rows = sorted(bins.agg(F.sum("label"), F.count("*"), F.avg("score")).collect())  # BINS rows at most
    counts = np.array([r[1:] for r in rows], float)
    return QualityModel(names, kernel, _solve(total), isotonic(counts[:, 2], counts[:, 0], counts[:, 1]))


def score(stats: DataFrame, model: QualityModel, *keep: str) -> DataFrame:
    """The kept columns with ``score``, the probability of label 1, and ``predicted``."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in stats.select(*keep).schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[list(keep)].copy()
            out["score"] = model.score(batch[model.names].to_numpy(float))
            out["predicted"] = (out["score"] >= 0.5).astype("int32")
            yield out

    return stats.mapInPandas(run, ", ".join([*fields, "score DOUBLE", "predicted INT"]))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from: crc32 of the id's text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text).

    ``labels`` has doc_id and quality. Null texts are empty and get a score as well; rows that
    repeat a text get the same score. A null id is not held out, and has no label.
    """
    stats, names = with_statistics(docs.select(name_of("doc_id").cast("long").alias("doc_id"), name_of("text")), "doc_id")
    known = labels.select("doc_id", F.col("quality").cast("double").alias("label")).where(~held_out(F.col("doc_id")))
    scored = score(stats, fit(stats, names, known), "doc_id")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

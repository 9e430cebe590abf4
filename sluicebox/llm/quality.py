"""Quality: a regularised quadratic discriminant over transformed document statistics.

Class means and covariances come from all labelled rows outside the held-out fold, as sums that tasks add up; nothing but
two vectors and two matrices reaches the driver. Covariances are shrunk towards the pooled one and its diagonal. A score
is the logistic of the difference of log densities, each from a Mahalanobis distance by its class's Cholesky factor, which
is computed once.

Defined results: null and empty texts get the statistics of an empty text and hence a score; equal texts get equal scores;
a document labelled several times counts once, with the mean of its labels rounded up from one half; null labels are
ignored; without two labelled rows of each class the score is the share of label 1 (one half without labels). Other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import fold, whole_text, written
from sluicebox.llm.toxicity import labelled

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5
TO_POOLED, TO_DIAGONAL = 0.1, 0.1
FLOOR = 1e-3  # least variance that is added to each statistic

MARK_RUN = re.compile(r"[^\w\s]{2,}")

STATISTICS = (
    "log_words", "distinct_words", "repeats_in_a_row", "top_word", "word_length", "capitals", "digits", "marks",
    "mark_runs", "lone_marks", "sentence_ends", "repeated_lines", "other_bytes",
)


def _log_share(part: float, whole: float) -> float:
    """Share on a log scale that separates none, few and many."""
    return float(np.log10(1e-3 + part / max(1.0, whole)))


def statistics_of(text: str) -> list[float]:
    """The transformed statistics of one text, in the order of ``STATISTICS``."""
    words = text.lower().split()
    n = len(words)
    counts = Counter(words)
    in_a_row = sum(map(str.__eq__, words, words[1:]))
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    of = np.bincount(raw, minlength=256)
    chars = len(raw)
    upper, lower = int(of[65:91].sum()), int(of[97:123].sum())
    marks = int(of[33:48].sum() + of[58:65].sum() + of[91:97].sum() + of[123:127].sum())
    runs = len(MARK_RUN.findall(text))
    lone = sum(c for w, c in counts.items() if not any(map(str.isalnum, w)))
    lines = [x for x in text.split("\n") if x]
    return [
        float(np.log1p(n)),
        float(np.log(len(counts) / n)) if n else 0.0,
        _log_share(in_a_row, n),
        _log_share(max(counts.values(), default=0), n),
        float(np.log1p(sum(map(len, counts)) / max(1, len(counts)))),
        _log_share(upper, upper + lower),
        _log_share(int(of[48:58].sum()), chars),
        _log_share(marks, chars),
        _log_share(runs, n),
        _log_share(lone, n),
        _log_share(int(of[[33, 46, 63]].sum()), n),
        _log_share(len(lines) - len(set(lines)), len(lines)),
        _log_share(int(of[128:].sum()), chars),
    ]


def text_statistics(documents: DataFrame) -> DataFrame:
    """doc_id and ``statistics``, one row per document."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "statistics": [statistics_of(t) for t in batch["text"]]})

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", whole_text().alias("text"))
    return rows.mapInPandas(compute, f"doc_id {kind}, statistics array<double>")


class Discriminant:
    """Means, Cholesky factors and log constants of both classes."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> None:
        rows = {k: n for k, (n, _, _) in moments.items()}
        self.constant = rows.get(1, 0.0) / sum(rows.values()) if rows else 0.5
        self.parts = None
        if min(rows.get(0, 0), rows.get(1, 0)) < 2:
            return
        means = {k: s / n for k, (n, s, _) in moments.items()}
        spread = {k: q / n - np.outer(means[k], means[k]) for k, (n, _, q) in moments.items()}
        pooled = sum(rows[k] * spread[k] for k in rows) / sum(rows.values())
        self.parts = []
        for k in (0, 1):
            mixed = (1 - TO_POOLED) * spread[k] + TO_POOLED * pooled
            shrunk = (1 - TO_DIAGONAL) * mixed + TO_DIAGONAL * np.diag(np.diag(mixed)) + FLOOR * np.eye(len(mixed))
            factor = np.linalg.cholesky(shrunk)
            inverse = np.linalg.inv(factor)
            constant = np.log(rows[k] / sum(rows.values())) - np.log(np.diag(factor)).sum()
            self.parts.append((means[k], inverse, constant))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.parts is None or not len(x):
            return np.full(len(x), self.constant)
        logs = [c - 0.5 * (((x - mean) @ inverse.T) ** 2).sum(1) for mean, inverse, c in self.parts]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -700, 700)))


def train(statistics: DataFrame, labels: DataFrame) -> Discriminant:
    """Moments per class: tasks add up rows, and one sum per class and moment remains."""
    size = len(STATISTICS)
    once = statistics.groupBy("doc_id").agg(F.min("statistics").alias("statistics"))
    joined = once.join(labelled(labels, "quality", FOLDS, HELD_OUT), "doc_id").select("label", "statistics")

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {k: np.zeros(1 + size + size * size) for k in (0, 1)}
        for batch in batches:
            for k, rows in batch.groupby("label"):
                x = np.array(rows["statistics"].tolist(), float)
                sums[int(k)] += np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
        yield pd.DataFrame({"label": list(sums), "sums": [s.tolist() for s in sums.values()]})

    partial = joined.mapInPandas(add_up, "label int, sums array<double>")
    totals = partial.select("label", F.posexplode("sums").alias("at", "value")).groupBy("label", "at").agg(F.sum("value").alias("value"))
    found: dict[int, np.ndarray] = {}
    for row in totals.collect():  # two classes, 1 + 13 + 13 * 13 sums each
        found.setdefault(row["label"], np.zeros(1 + size + size * size))[row["at"]] = row["value"]
    return Discriminant({
        k: (v[0], v[1 : 1 + size], v[1 + size :].reshape(size, size)) for k, v in found.items() if v[0] > 0
    })


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    statistics = written(text_statistics(documents), "quality")
    model = train(statistics, labels)

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["statistics"].tolist(), float).reshape(len(batch), len(STATISTICS))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": model.score(x)})

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = statistics.mapInPandas(compute, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
